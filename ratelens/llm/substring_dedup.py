"""Substring deduplication by sliding spans of sentences, and by words where a passage starts inside one."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.checkpoints import checkpointed
from ratelens.llm.common import free_name, id_field, map_texts, texts_of, written

# A span with more than this share of the spans of one document in SAMPLED is hot.
HOT_SHARE = 1 / 500
SAMPLED = 16
PARTS = 64

# Bytes of a digest: among 10**12 spans two different ones share one with a chance of 10**-5.
DIGEST = 12

# Distinct words that a task remembers: bounds memory, not results.
WORDS_KEPT = 500_000

# An odd factor and its inverse modulo 2**64, for hashes of windows from running sums.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))

_SENTENCES = re.compile(r"[^.!?\n]+[.!?]*").finditer
_WORDS = re.compile(r"\S+").finditer


@dataclass(frozen=True)
class Spans:
    """A span starts with any sentence and takes the fewest that follow on to have ``words`` words in ``sentences`` or more.

    A sentence of over ``longest`` words counts as several, cut after every
    ``longest``; so no span is longer than words + longest - 1, and a repeated
    passage of that many words from a sentence's start on holds one. Of the
    windows of ``words`` words, whatever their sentences, the words themselves
    choose some, so that every repeated passage of ``passage`` words or more
    holds a chosen one, wherever it starts.
    """

    sentences: int = 2
    words: int = 30
    longest: int = 20
    passage: int = 50

    def __post_init__(self):
        if self.passage < self.words:
            raise ValueError("a passage has at least the words of a span")


def sentence_parts(text: str, longest: int) -> list[tuple[int, int, str, int]]:
    """(start, end, words in lower case, number of words) of each sentence or part of one."""
    parts = []
    for found in _SENTENCES(text):
        words = found[0].split()
        if not words:
            continue
        if len(words) <= longest:
            parts.append((*found.span(), " ".join(words).lower(), len(words)))
        else:
            places = [word.span() for word in _WORDS(text, *found.span())]
            for at in range(0, len(places), longest):
                part = places[at : at + longest]
                own = " ".join(text[a:b] for a, b in part).lower()
                parts.append((part[0][0], part[-1][1], own, len(part)))
    return parts


def spans_of(text: str, settings: Spans) -> list[tuple[bytes, int, int]]:
    """(digest, start, end) of every span."""
    parts = sentence_parts(text, settings.longest)
    before = [0, *accumulate(part[3] for part in parts)]
    out, end = [], 0
    for at in range(len(parts)):
        end = max(end, at + settings.sentences)
        while end <= len(parts) and before[end] - before[at] < settings.words:
            end += 1
        if end > len(parts):
            break  # later spans would need more sentences too
        whole = "\n".join(part[2] for part in parts[at:end])
        out.append((xxhash.xxh3_128_digest(whole)[:DIGEST], parts[at][0], parts[end - 1][1]))
    return out


class Windows:
    """Windows of words that every long enough passage holds, by winnowing: the least hash of each run of windows."""

    def __init__(self, settings: Spans):
        self.size = settings.words
        self.run = settings.passage - settings.words + 1
        self.hashes: dict[str, int] = {}

    def chosen(self, words: list[str]) -> list[int]:
        """Places of the chosen windows; a window equal to the last one chosen is spared where that serves too."""
        count = len(words) - self.size + 1
        if count < self.run:
            return []
        if len(self.hashes) > WORDS_KEPT:
            self.hashes = {}
        for word in set(words).difference(self.hashes):
            self.hashes[word] = xxhash.xxh3_64_intdigest(word)
        own = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        powers = np.cumprod(np.full(len(words), _BASE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * powers)])
        total = (sums[self.size :] - sums[: -self.size]) * np.cumprod(np.full(count, _INVERSE))
        total = (total ^ total >> np.uint64(32)) * _BASE
        total ^= total >> np.uint64(29)
        runs = np.lib.stride_tricks.sliding_window_view(total[::-1], self.run)
        last = (count - 1 - np.arange(len(runs)) - runs.argmin(axis=1))[::-1]  # the last least one of each run
        ends = np.append(np.flatnonzero(np.diff(last)), len(last) - 1)  # the last run with the same one
        out = []
        for place, end in zip(last[ends].tolist(), ends.tolist(), strict=True):
            if not out or out[-1] < end or total[out[-1]] != total[place]:
                out.append(place)
        return out

    def spans_of(self, text: str) -> list[tuple[bytes, int, int]]:
        """(digest, start, end) of the chosen windows."""
        words = text.split()
        if len(words) < self.size + self.run - 1:
            return []
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        if ends[-1] == len(text):  # one character between words, none around them
            places = list(zip([0, *(ends[:-1] + 1).tolist()], ends.tolist(), strict=True))
        else:
            places = [word.span() for word in _WORDS(text)]
        words = [word.lower() for word in words]
        return [
            (xxhash.xxh3_128_digest(" ".join(words[at : at + self.size]))[:DIGEST], places[at][0], places[at + self.size - 1][1])
            for at in self.chosen(words)
        ]


def uncovered(found: list[dict]) -> tuple[list, list]:
    """Spans and their sources, without the windows that lie within the joined spans of sentences."""
    joined: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in found if not s["window"]):
        if joined and start <= joined[-1][1] + 1:  # a sentence ends where the next one's white space starts
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    starts = [start for start, _ in joined]

    def covered(s) -> bool:
        at = bisect_right(starts, s["start"]) - 1
        return at >= 0 and s["end"] <= joined[at][1]

    left = [s for s in found if not (s["window"] and covered(s))]
    return sorted({(s["start"], s["end"]) for s in left}), sorted({s["source"] for s in left})


def repeated_spans(
    docs: DataFrame, settings: Spans = Spans(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents with spans that stand elsewhere before.

    The first occurrence of a span, by doc_id and position, stays; all others
    are covered. One row for each document with any: doc_id, spans (start, end in
    code points, by start; they may overlap) and copied_from (doc_ids of the
    first occurrences). Windows of words count where no spans of sentences cover
    them. Case and white space don't count. NULL ids, NULL and
    empty texts have no spans; rows that repeat an id and its text are one
    document and cover nothing in one another. Other columns don't matter; an
    empty table gives no rows.

    Spans are digests of 12 bytes, shuffled once, by span. A span that has more
    than ``HOT_SHARE`` of the spans of some documents chosen by their ids is dealt
    out to ``PARTS`` tasks: the first occurrences of those, fewer than
    1 / ``HOT_SHARE``, are found by partial aggregates and sent to all tasks.
    """
    schema = T.StructType(
        [
            T.StructField("span", T.BinaryType()),
            id_field(docs, id_col),
            T.StructField("start", T.IntegerType()),
            T.StructField("size", T.IntegerType()),
            T.StructField("window", T.BooleanType()),
        ]
    )

    def start():
        windows = Windows(settings)

        def step(ids, texts):
            rows = []
            for i, text in zip(ids, texts, strict=True):
                rows += [(span, i, a, b - a, False) for span, a, b in spans_of(text, settings)]
                rows += [(span, i, a, b - a, True) for span, a, b in windows.spans_of(text)]
            return list(zip(*rows, strict=True)) if rows else [[]] * 5

        return step

    texts = texts_of(docs, id_col, text_col).filter("doc_id is not null and text is not null")
    spans = written(map_texts(texts, start, schema, "text"))
    chosen = spans.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0).groupBy("span").agg(F.count("*").alias("n"))
    limit = chosen.agg(F.sum("n") * F.lit(HOT_SHARE)).scalar()
    hot = [row["span"] for row in chosen.filter((F.col("n") > 1) & (F.col("n") > limit)).select("span").collect()]
    place = F.struct("doc_id", "start")
    is_hot = F.col("span").isin(hot) if hot else F.lit(False)
    firsts = checkpointed(spans.filter(is_hot).groupBy("span").agg(F.min(place).alias("hot_first")))
    marked = spans.join(F.broadcast(firsts), "span", "left")
    part = F.when(F.col("hot_first").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).otherwise(0).alias("part")
    in_order = Window.partitionBy("span", "part").orderBy("doc_id", "start")
    first = F.coalesce("hot_first", F.first(place).over(in_order)).alias("first")
    occurrences = marked.select("*", part).select("doc_id", "start", "size", "window", first)
    found = F.struct(
        "start", (F.col("start") + F.col("size")).alias("end"), "window", F.col("first.doc_id").alias("source")
    )
    of_doc = occurrences.filter(place != F.col("first")).groupBy("doc_id").agg(F.collect_set(found).alias("found"))
    span_type = T.StructType([T.StructField(name, T.IntegerType()) for name in ("start", "end")])
    schema = T.StructType(
        [
            T.StructField("spans", T.ArrayType(span_type)),
            T.StructField("copied_from", T.ArrayType(docs.schema[id_col].dataType)),
        ]
    )
    left = F.udf(uncovered, schema)
    return of_doc.select("doc_id", left("found").alias("left")).select("doc_id", "left.spans", "left.copied_from")


def without_spans(text: str | None, spans: list[dict] | None) -> str | None:
    """What is left of a text."""
    if text is None or spans is None:
        return text
    out, at = [], 0
    for span in spans:
        if span["start"] > at:
            out.append(text[at : span["start"]])
        at = max(at, span["end"])
    out.append(text[at:] if text[at:].strip() else "")
    return "".join(out)


def drop_repeats(docs: DataFrame, settings: Spans = Spans()) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text, others), texts without the sentences of non-first spans."""
    of_id, of_spans = free_name("id", docs), free_name("spans", docs)
    spans = repeated_spans(docs, settings).select(F.col("doc_id").alias(of_id), F.col("spans").alias(of_spans))
    cut = F.udf(without_spans, "string")
    return docs.join(spans, F.col("doc_id") == F.col(of_id), "left").select(
        *(cut("text", of_spans).alias(name) if name == "text" else F.col(f"`{name}`") for name in docs.columns)
    )
