"""Line-first cleaning of documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ratelens.llm.common import id_field, map_texts, texts_of

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

# Words and phrases of page furniture.
NAVIGATION = "home next previous back menu search login logout sitemap top".split() + ["sign in", "log in", "read more"]
BOILERPLATE = [
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "lorem ipsum",
    "subscribe to our newsletter",
    "click here",
]


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules of a line and of a document.

    A line of ``end_words`` words or more has to end with one of ``ends`` (after
    closing quotes and brackets). A line is navigation if at least
    ``link_share`` of its words are separators, or if it is nothing but an
    entry of ``navigation``; boilerplate if it has a phrase of ``boilerplate``;
    noise if over ``symbol_share`` of its characters are symbols. A document
    is rejected if it loses over ``max_lost`` of its words.
    """

    end_words: int = 12
    ends: str = ".!?…:;。！？"
    link_share: float = 0.25
    symbol_share: float = 0.08
    max_lost: float = 0.5
    navigation: tuple[str, ...] = tuple(NAVIGATION)
    boilerplate: tuple[str, ...] = tuple(BOILERPLATE)


def words_of(text: str) -> list[bytes]:
    """Words as UTF-8: the bytes of ASCII white space, and no others, part them."""
    return text.encode().split()


def count_symbols(text: str) -> int:
    return sum(map(text.count, SYMBOLS))


class LineCleaner:
    def __init__(self, rules: LineRules):
        self.rules = rules
        self.navigation = frozenset(rules.navigation)
        self.separators = frozenset(mark.encode() for mark in "|·•»›>/-")

    def fails(self, line: str, words: list[bytes]) -> str | None:
        """The name of the rule that a line with these words breaks."""
        rules = self.rules
        if count_symbols(line) > rules.symbol_share * len(line):
            return "punctuation"
        if len(words) >= rules.end_words and line.rstrip().rstrip("\"'”’»)]")[-1:] not in rules.ends:
            return "punctuation"
        if not self.separators.isdisjoint(words):
            if sum(word in self.separators for word in words) >= rules.link_share * len(words):
                return "navigation"
        if len(words) <= 2 and " ".join(line.lower().split()).strip(".:!>»› ") in self.navigation:
            return "navigation"
        lower = line.lower()
        if any(phrase in lower for phrase in rules.boilerplate):
            return "boilerplate"
        return None

    def clean(self, lines: list[str], words: list[list[bytes]]) -> tuple[str, int, int]:
        """The lines that stay, how many failed, and the words that they had."""
        kept, failed, lost = [], 0, 0
        for line, own in zip(lines, words, strict=True):
            if own and self.fails(line, own):
                failed += 1
                lost += len(own)
            else:
                kept.append(line)
        return "\n".join(kept), failed, lost


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three words that occur twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(word, len(known)) for word in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) >= 2**21:  # pairs are numbered first, so that numbers of triples don't overflow
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, window, count = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def measures(text: str, lines: list[str], words: list[list[bytes]]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text with these lines and their words."""
    full = [line for line, own in zip(lines, words, strict=True) if own]
    every = [word for own in words for word in own]
    blank = sum(map(text.count, " \t\n\v\f\r"))
    return len(every), len(text) - blank, count_symbols(text), len(full) - len(set(full)), repeated_words(every)


SCHEMA = [
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("n_failed_lines", T.LongType()),
    T.StructField("n_lost_words", T.LongType()),
    T.StructField("kept", T.BooleanType()),
]


def clean_lines(
    docs: DataFrame,
    rules: LineRules | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """Drop failing lines, then reject documents that lose too much.

    One row for each row of ``docs``: the measures of the whole text,
    base_failed (under 50 words, or over half of them in repeated windows of
    three), the failed lines and the words lost with them, kept, and with
    ``with_text`` clean_text. A NULL or empty text has no words and is not
    kept; lines without a word stay as they are. Repeated rows give repeated
    results. No shuffle.
    """
    rules = rules or LineRules()
    fields = [id_field(docs, id_col), *SCHEMA]
    if with_text:
        fields.append(T.StructField("clean_text", T.StringType()))

    def start():
        cleaner = LineCleaner(rules)

        def judged(doc_id, text):
            lines = text.split("\n")
            words = [words_of(line) for line in lines]
            counts = measures(text, lines, words)
            n_words, repeated = counts[0], counts[4]
            base_failed = n_words < 50 or 100 * repeated > 50 * n_words
            left, failed, lost = cleaner.clean(lines, words)
            kept = not base_failed and lost <= rules.max_lost * n_words
            return (doc_id, *counts, base_failed, failed, lost, kept, *([left] if with_text else []))

        def step(ids, texts):
            return list(zip(*(judged(i, text or "") for i, text in zip(ids, texts, strict=True)), strict=True))

        return step

    return map_texts(texts_of(docs, id_col, text_col), start, T.StructType(fields), "text")
