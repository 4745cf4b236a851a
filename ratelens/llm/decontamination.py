"""Benchmark decontamination by templates that survive other numbers, names and units."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import map_texts, texts_of, written

# Words, numbers and the marks that end a sentence.
_TOKENS = re.compile(r"[^\W\d_]+|\d+(?:[.,:/]\d+)*|[.!?\n]").findall

# Fixed values.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion "
    "dozen half twice".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres mg g kg gram grams kilogram "
    "kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds minute "
    "minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros degree degrees "
    "percent mph kmh hz khz mhz ghz watt watts volt volts".split()
)

# The filter of benchmark windows has about 64 bits for each of them, and no
# more than 2**27 (16 MB). It only spares rows the exact join that follows.
FILTER_BITS = range(16, 28)

# Distinct tokens that a task remembers: bounds memory, not results.
TOKENS_KEPT = 500_000

# An odd factor and its inverse modulo 2**64, for hashes of windows from running
# sums, and what tells windows of the words themselves from templates.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_PLAIN = np.uint64(0xD6E8FEB86659FD93)

PLACEHOLDERS = ("<num>", "<unit>", "<name>")


@dataclass(frozen=True)
class Templates:
    """Windows of ``window`` canonical tokens with at least ``literals`` of them not placeholders (as a share).

    A document has an item if matching windows cover ``coverage`` of those of the
    item that have so many literals, or its very words ``coverage`` of all.
    """

    window: int = 8
    literals: float = 0.5
    coverage: float = 0.5


class Canonical:
    """Canonical tokens of texts, as hashes, with their surface forms kept for slots."""

    def __init__(self):
        self._reset()

    def _reset(self):
        self.known = defaultdict(count().__next__)  # numbers of the tokens
        self.names: list[str] = []
        self.hashes = np.empty((0, 2), np.uint64)  # in a sentence, and at its start
        self.plain = np.empty(0, np.uint64)  # of the words themselves, in lower case
        self.slots = np.empty((0, 2), bool)
        self.marks = np.empty(0, bool)

    @staticmethod
    def forms_of(token: str) -> tuple[str, str]:
        lower = token.lower()
        if token[0].isdigit() or lower in NUMBER_WORDS:
            return "<num>", "<num>"
        if lower in UNITS:
            return "<unit>", "<unit>"
        return ("<name>" if token[0].isupper() else lower), lower

    def _grow(self) -> None:
        new = list(islice(reversed(self.known), len(self.known) - len(self.names)))[::-1]
        self.names += new
        plain = np.array([xxhash.xxh64_intdigest(token.lower()) for token in new], np.uint64)
        forms = [self.forms_of(token) for token in new]
        places = [np.array([PLACEHOLDERS.index(form) if form[0] == "<" else -1 for form in side]) for side in zip(*forms, strict=True)]
        named = np.array([xxhash.xxh64_intdigest(form) for form in PLACEHOLDERS], np.uint64)
        self.plain = np.concatenate([self.plain, plain])
        self.hashes = np.concatenate([self.hashes, np.stack([np.where(at < 0, plain, named[at]) for at in places], axis=1)])
        self.slots = np.concatenate([self.slots, np.stack([at >= 0 for at in places], axis=1)])
        self.marks = np.concatenate([self.marks, np.array([token in ".!?\n" for token in new], bool)])

    def learn(self, texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """Words and marks of each text, and their numbers; the arrays grow once for all texts."""
        if len(self.known) > TOKENS_KEPT:
            self._reset()
        number, out = self.known.__getitem__, []
        for text in texts:
            surface = _TOKENS(text)
            out.append((surface, np.fromiter(map(number, surface), np.int64, len(surface))))
        if len(self.known) > len(self.names):
            self._grow()
        return iter(out)

    def tokens(self, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the canonical tokens: hash, slot flag, number, place among words and marks, and whether at a start."""
        marks = self.marks[ids]
        starts = np.append(True, marks[:-1]).astype(np.int64)[: len(ids)]
        places = np.flatnonzero(~marks)
        ids, starts = ids[places], starts[places]
        return self.hashes[ids, starts], self.slots[ids, starts], ids, places, starts

    def template(self, ids: np.ndarray, starts: np.ndarray) -> str:
        return " ".join(self.forms_of(self.names[i])[s] for i, s in zip(ids.tolist(), starts.tolist(), strict=True))


class WindowHashes:
    """Hashes of all windows of a text, of any length, from one running sum."""

    powers = np.ones((2, 1), np.uint64)  # of the factor and its inverse

    def __init__(self, hashes: np.ndarray):
        if len(hashes) > self.powers.shape[1]:
            factors = np.array([[_BASE], [_INVERSE]]) * np.ones((1, 2 * len(hashes)), np.uint64)
            factors[:, 0] = 1
            WindowHashes.powers = np.cumprod(factors, axis=1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.powers[0, : len(hashes)], out=self.sums[1:])

    def of(self, size: int) -> np.ndarray:
        total = (self.sums[size:] - self.sums[:-size]) * self.powers[1, : len(self.sums) - size]
        total = (total ^ total >> np.uint64(32)) * _BASE
        return total ^ total >> np.uint64(29)


WINDOW = [
    T.StructField("hash", T.LongType()),
    T.StructField("template", T.StringType()),
    T.StructField("at", T.IntegerType()),
    T.StructField("slots", T.ArrayType(T.StringType())),
    T.StructField("plain", T.BooleanType()),  # of the words themselves
    T.StructField("literal", T.BooleanType()),  # has literal tokens enough
]


# Of a text: windows with literal tokens enough, and all windows.
COUNTS = ["windows", "all_windows"]


def _windows(texts: DataFrame, sizes_of, settings: Templates, keep=None, filter_bits: int = 0) -> DataFrame:
    """Windows of texts, as templates and as their words; ``sizes_of`` gives their lengths by the number of tokens, ``keep`` the filter's bytes."""
    schema = T.StructType([texts.schema["doc_id"], *(T.StructField(name, T.IntegerType()) for name in COUNTS), *WINDOW])

    def start():
        canonical = Canonical()
        bits = None if keep is None else np.frombuffer(keep.value, np.uint8)

        def step(ids, texts):
            out = [[] for _ in schema]
            for doc_id, (surface_of, numbers) in zip(ids, canonical.learn([text or "" for text in texts]), strict=True):
                hashes, slots, names, places, starts = canonical.tokens(numbers)
                sizes = [size for size in sizes_of(len(hashes)) if size <= len(hashes)]
                if not sizes:
                    continue
                placeholders = np.append(0, np.cumsum(slots))
                forms = WindowHashes(hashes), WindowHashes(canonical.plain[names])
                for size in sizes:
                    literal = placeholders[size:] - placeholders[:-size] <= (1 - settings.literals) * size
                    # shorter ones without literals can't be told from other text
                    any_words = np.ones_like(literal) if size == settings.window else literal
                    counts = int(literal.sum()), int(any_words.sum())
                    for plain, used in ((False, literal), (True, any_words)):
                        found = forms[plain].of(size)
                        if plain:
                            found = found ^ _PLAIN
                        if bits is not None:
                            bit = found >> np.uint64(64 - filter_bits)
                            used = used & ((bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1)
                        at = np.flatnonzero(used)
                        found = found[at]
                        for place, value in zip(at.tolist(), found.view(np.int64).tolist(), strict=True):
                            own = slice(place, place + size)
                            if plain:
                                values = []
                                form = "=" + " ".join(surface_of[p].lower() for p in places[own].tolist())
                            else:
                                values = [surface_of[p].lower() for p in places[own][slots[own]].tolist()]
                                form = canonical.template(names[own], starts[own])
                            row = (doc_id, *counts, value, form, place, values, plain, bool(literal[place]))
                            for column, x in zip(out, row, strict=True):
                                column.append(x)
            return out

        return step

    return map_texts(texts, start, schema, "text")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    settings: Templates = Templates(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Items of the benchmark that documents hold, word by word or with other slots.

    Numbers, units and names (capitalised inside a sentence) become typed
    placeholders. Windows of canonical tokens are joined by hash and template,
    and those of the words themselves, whatever their case, likewise.
    An occurrence is one offset of an item in a document. Windows with the
    item's own words or slots count; others do if every changed slot value of
    the item stands for one value there, wherever it changes.
    One row for each document and item it holds: doc_id, item_id, n_windows
    (of the item, found in the document), coverage (their share of the windows
    with literal words enough, or that of the windows found word by word of all,
    whichever is greater) and
    reparameterised (some slot has another value). Items shorter than a window
    are one window of their own length; such ones without literal words enough
    can't be told from other text and are never found. NULL ids,
    NULL and empty texts take no part; repeated rows count as one document;
    other columns don't matter; an empty table on either side gives no rows.

    Documents are read once, where they lie: only windows that pass a filter
    of bounded size are shuffled.
    """
    size = settings.window
    items = texts_of(benchmark, item_id_col, item_text_col).filter("doc_id is not null").distinct()
    item_windows = (
        _windows(items, lambda n: [min(n, size)] if n else [], settings)
        .withColumnsRenamed({"doc_id": "item_id", "at": "item_at", "slots": "item_slots", "windows": "item_windows"})
        .withColumnRenamed("literal", "item_literal")
        .withColumn("length", F.size(F.split("template", " ")))
    )
    spark = docs.sparkSession
    lengths = sorted(row["length"] for row in item_windows.select("length").distinct().collect())  # at most window
    filter_bits = min(max((64 * item_windows.count()).bit_length(), FILTER_BITS[0]), FILTER_BITS[-1])
    bit = F.shiftrightunsigned("hash", 64 - filter_bits)
    bytes_set = (
        item_windows.select(
            F.shiftright(bit, 3).cast("int").alias("byte"),
            F.call_function("shiftleft", F.lit(1), bit.bitwiseAND(F.lit(7)).cast("int")).alias("bit"),
        )
        .groupBy("byte")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()  # a row for each byte of the filter at most
    )
    bitmap = np.zeros(2 ** (filter_bits - 3), np.uint8)
    for row in bytes_set:
        bitmap[row["byte"]] = row["bits"]
    keep = spark.sparkContext.broadcast(bitmap.tobytes())
    texts = texts_of(docs, id_col, text_col).filter("doc_id is not null and text is not null")
    found = _windows(texts, lambda n: lengths, settings, keep, filter_bits).select("doc_id", "hash", "template", "at", "slots")
    matches = found.join(item_windows, ["hash", "template"]).withColumn("offset", F.col("at") - F.col("item_at"))
    matches = written(matches)
    occurrence = ["doc_id", "item_id", "offset"]
    changed = F.col("item_slots") != F.col("slots")
    inconsistent = (
        matches.filter(changed)
        .select(*occurrence, F.explode(F.arrays_zip("item_slots", "slots")).alias("pair"))
        .select(*occurrence, "pair.item_slots", "pair.slots")
        .filter(changed)
        .distinct()
        .groupBy(*occurrence)
        .agg((F.count("item_slots") > F.count_distinct("item_slots")).alias("inconsistent"))
        .filter("inconsistent")
    )
    windows = (
        matches.select(*occurrence, "item_at", "item_windows", "all_windows", "item_literal", "plain", changed.alias("changed"))
        .distinct()
        .join(inconsistent, occurrence, "left")
        .filter("not (changed and coalesce(inconsistent, false))")
    )
    share = F.greatest(
        F.coalesce(F.try_divide("n_literal", "item_windows"), F.lit(0.0)), F.col("n_plain") / F.col("all_windows")
    )
    return (
        windows.groupBy("doc_id", "item_id", "item_windows", "all_windows")
        .agg(
            F.count_distinct("item_at").alias("n_windows"),
            F.count_distinct(F.when(F.col("item_literal"), F.col("item_at"))).alias("n_literal"),
            F.count_distinct(F.when(F.col("plain"), F.col("item_at"))).alias("n_plain"),
            F.max("changed").alias("reparameterised"),
        )
        .withColumn("coverage", share.cast("double"))
        .filter(F.col("coverage") >= settings.coverage)
        .select("doc_id", "item_id", "n_windows", "coverage", "reparameterised")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Templates = Templates()) -> DataFrame:
    """The rows of ``docs`` whose document holds no item; rows without an id stay."""
    held = leaks(docs, benchmark, settings).select("doc_id").distinct()
    return docs.join(held, "doc_id", "left_anti")
