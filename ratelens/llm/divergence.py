"""How the sources of a language differ in their words: chunks of text are counted first and made terms once each."""

from __future__ import annotations

import re
import string
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import slices, written

# Terms: ASCII letters and everything that isn't ASCII.
_TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+").findall

# A block of documents has so many characters or documents at most (a longer
# text is a block alone). It bounds what a task remembers: postings of a block
# name its documents with two bytes. The blocks of so many tasks are united at once.
BLOCK_CHARS = 64_000_000
BLOCK_DOCS = 60_000
TASKS = 64

# Postings of a chunk in a block: the task among those united at once, numbers
# of documents and of sources, then the documents and, of each source, six bytes
# of its hash and its occurrences (in several parts, if they are many).
HEAD = struct.Struct("<BHH")
MOST = 65_535
SOURCE_BITS = 48

# Cells of the tables of p that are compared at once, and groups in a block of them.
CELLS = 4_000_000
GROUPS = 512

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def filled(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """text, lang and source under fixed names, NULL as the empty string."""
    names = {"text": text_col, "lang": lang_col, "source": source_col}
    return docs.select(
        *(F.coalesce(F.col(f"`{own}`").cast("string"), F.lit("")).alias(name) for name, own in names.items())
    )


class Block:
    """Chunks of some documents of one language: of each chunk the documents that hold it, and how often."""

    def __init__(self):
        self.names: dict[str, int] = {}
        self.docs = 0
        self.chars = 0
        self.sources: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, texts: pa.Array, sources: list[str]) -> None:
        tokens = pc.ascii_split_whitespace(texts)
        sizes = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        coded = tokens.flatten().dictionary_encode()
        own, local = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        pairs, n = np.unique(doc * max(len(own), 1) + local, return_counts=True)
        doc, local = np.divmod(pairs, max(len(own), 1))
        code = np.array([self.names.setdefault(name, len(self.names)) for name in own.to_pylist()], np.int32)
        self.parts.append((code[local] if len(code) else local.astype(np.int32), (doc + self.docs).astype(np.uint16), n))
        self.sources += [xxhash.xxh64_intdigest(source, 42) % 2**SOURCE_BITS for source in sources]  # as Spark's
        self.docs += len(sizes)
        self.chars += pc.sum(pc.binary_length(texts)).as_py() or 0

    def rows(self, task: int) -> tuple[pa.Array, pa.Array]:
        """chunk and postings."""
        code, doc, n = (np.concatenate(part) for part in zip(*self.parts, strict=True))
        order = np.argsort(code, kind="stable")  # documents of a chunk stay in order
        code, doc, n = code[order], doc[order].astype(np.uint64), n[order]
        known, source = np.unique(np.array(self.sources, np.uint64), return_inverse=True)
        pairs, place = np.unique(code.astype(np.int64) * len(known) + source[doc.astype(np.int64)], return_inverse=True)
        times = np.bincount(place, n, len(pairs)).astype(np.int64)
        of, at = np.divmod(pairs, len(known))
        again = np.repeat(np.arange(len(pairs)), (times - 1) // MOST + 1)
        last = np.append(np.diff(again) > 0, True)[: len(again)]
        part = np.where(last, (times[again] - 1) % MOST + 1, MOST).astype(np.uint64)
        of, counted = of[again], known[at[again]] | part << np.uint64(SOURCE_BITS)

        ids = np.arange(len(self.names) + 1)
        of_doc, of_source = np.searchsorted(code, ids), np.searchsorted(of, ids)
        ends = HEAD.size * ids + 2 * of_doc + 8 * of_source
        data = np.empty(ends[-1], np.uint8)
        _fill(data, ends[:-1], np.full(len(self.names), task % TASKS), 1)
        _fill(data, ends[:-1] + 1, np.diff(of_doc), 2)
        _fill(data, ends[:-1] + 3, np.diff(of_source), 2)
        own = ends[code] + HEAD.size
        _fill(data, own + 2 * (np.arange(len(code)) - of_doc[code]), doc, 2)
        own = ends[of] + HEAD.size + 2 * np.diff(of_doc)[of]
        _fill(data, own + 8 * (np.arange(len(of)) - of_source[of]), counted, 8)
        buffers = [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
        return pa.array(list(self.names), pa.string()), pa.BinaryArray.from_buffers(pa.binary(), len(self.names), buffers)


def _fill(data: np.ndarray, at: np.ndarray, values: np.ndarray, size: int) -> None:
    """Write numbers of ``size`` bytes, the low one first."""
    values = values.astype(np.uint64)
    for byte in range(size):
        data[at + byte] = (values >> np.uint64(8 * byte)).astype(np.uint8)


def postings(found: bytes) -> Iterator[tuple[int, bytes, list[int]]]:
    """(task, documents, counted sources) of joined postings."""
    at = 0
    while at < len(found):
        task, docs, sources = HEAD.unpack_from(found, at)
        middle = at + HEAD.size + 2 * docs
        end = middle + 8 * sources
        yield task, found[at + HEAD.size : middle], struct.unpack_from(f"<{sources}Q", found, middle)
        at = end


def chunk_counts(docs: DataFrame) -> DataFrame:
    """(chunk, lang, tasks, postings) of blocks of documents (text, lang, source)."""
    names = ["chunk", "lang", "tasks", "postings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, Block] = {}
        task = TaskContext.get().partitionId()
        number = Counter()  # of blocks by language

        def ended(langs: list[str]) -> Iterator[pa.RecordBatch]:
            for lang in langs:
                chunk, found = blocks.pop(lang).rows(task)
                tasks = (task // TASKS << 32) + number[lang]
                number[lang] += 1
                for at in range(0, len(chunk), 20_000):
                    own = chunk.slice(at, 20_000)
                    same = [pa.array([lang] * len(own)), pa.array([tasks] * len(own), pa.int64())]
                    yield pa.RecordBatch.from_arrays([own, *same, found.slice(at, 20_000)], names)

        for batch in batches:
            for part in slices(batch, 0):
                text, lang, source = part.columns
                for own in lang.unique().to_pylist():
                    chosen = pc.equal(lang, own)
                    texts, sources = text.filter(chosen), source.filter(chosen).to_pylist()
                    for at in range(0, len(texts), BLOCK_DOCS):
                        own_part = slice(at, at + BLOCK_DOCS)
                        if own in blocks and blocks[own].docs + len(sources[own_part]) > BLOCK_DOCS:
                            yield from ended([own])
                        blocks.setdefault(own, Block()).add(texts[own_part], sources[own_part])
                if sum(block.chars for block in blocks.values()) > BLOCK_CHARS:
                    yield from ended(list(blocks))
        yield from ended(list(blocks))

    return docs.select("text", "lang", "source").mapInArrow(run, "chunk string, lang string, tasks long, postings binary")


def terms_of(chunk: str) -> Counter:
    """The terms of a chunk, with how often they stand there."""
    return Counter(_TERMS(chunk.translate(_LOWER)))


def _changes(batch: pa.RecordBatch) -> np.ndarray:
    """Whether each row differs from the one before; the first one does."""
    out = np.ones(batch.num_rows, bool)
    if batch.num_rows > 1:
        differs = [pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)) for c in batch.columns]
        out[1:] = np.logical_or.reduce([d.to_numpy(zero_copy_only=False) for d in differs])
    return out


def _joined(found: pa.Array, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Postings of consecutive rows as one, and their documents."""
    offsets, data = np.frombuffer(found.buffers()[1], np.int32)[found.offset :][: len(found) + 1], found.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8)
    docs = bytes_[offsets[:-1] + 1].astype(np.int64) + (bytes_[offsets[:-1] + 2].astype(np.int64) << 8)
    ends = np.append(offsets[starts], offsets[-1])
    joined = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), data])
    return joined, np.add.reduceat(docs, starts)


def term_counts(rows: DataFrame) -> DataFrame:
    """(lang, term, tasks, times, docs, postings): a chunk's rows with its terms; postings of like tasks are joined.

    Rows come sorted by chunk, from all blocks, so that each distinct one is made terms once.
    """
    names = ["lang", "term", "tasks", "times", "docs", "postings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, terms = None, []  # the last one: it may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(_changes(batch.select(["chunk", "lang", "tasks"])))
            group = batch.take(pa.array(starts))
            found, docs = _joined(batch.column("postings"), starts)
            row, term, times = [], [], []
            for n, text in enumerate(group.column("chunk").to_pylist()):
                if text != chunk:
                    chunk, terms = text, terms_of(text).items()
                for own, often in terms:
                    row.append(n)
                    term.append(own)
                    times.append(often)
            at = pa.array(row, pa.int64())
            columns = [
                group.column("lang").take(at),
                pa.array(term, pa.string()),
                group.column("tasks").take(at),
                pa.array(times, pa.int32()),
                pa.array(docs).take(at),
                found.take(at),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    by_chunk = rows.repartition("chunk").sortWithinPartitions("chunk", "lang", "tasks")
    return by_chunk.mapInArrow(run, "lang string, term string, tasks long, times int, docs long, postings binary")


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n) of the terms in ``min_docs`` documents of their language, with source as its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []  # the term that rows are still to come of
        total, n_docs = {}, 0
        place, held, sure = None, {}, 0  # and of the tasks, by task: documents
        out: list[tuple] = []

        def united() -> int:
            return sum(
                len(own[0]) // 2 if len(own) == 1 else len(np.unique(np.frombuffer(b"".join(own), "<u2"))) for own in held.values()
            )

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 4
            out.clear()
            types = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang", "source", "term", "n"]
            )

        def added() -> None:
            nonlocal place, held, n_docs
            for tasks, times, found in rows:
                if tasks != place:
                    n_docs += united()
                    place, held = tasks, {}
                for task, docs, sources in postings(found):
                    held.setdefault(task, []).append(docs)
                    for counted in sources:
                        source = counted & (1 << SOURCE_BITS) - 1
                        total[source] = total.get(source, 0) + times * (counted >> SOURCE_BITS)
            rows.clear()

        for batch in batches:
            for lang, term, tasks, times, docs, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, term) != now:
                    if sure >= min_docs:  # fewer postings can't be more documents
                        added()
                        if n_docs + united() >= min_docs:
                            out.extend((now[0], source, now[1], n) for source, n in total.items())
                    now, total, n_docs, place, held, sure = (lang, term), {}, 0, None, {}, 0
                    rows.clear()
                sure += docs
                rows.append((tasks, times, found))
                if sure >= min_docs:
                    added()
            yield flushed()
        if sure >= min_docs and n_docs + united() >= min_docs:
            yield pa.RecordBatch.from_pylist([dict(lang=now[0], source=source, term=now[1], n=n) for source, n in total.items()])

    by_term = term_counts(chunk_counts(docs)).repartition("lang", "term").sortWithinPartitions("lang", "term", "tasks")
    return by_term.mapInArrow(run, "lang string, source long, term string, n long")


def _p(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10**9 (count + 5) / (n + 5 v)), exactly."""
    whole = F.expr("decimal(1000000000)").cast("decimal(10,0)")
    top = whole * (count + 5).cast("decimal(20,0)")
    # the remainder is taken off first, so that the quotient is a whole number
    under = (n + 5 * v).cast("decimal(20,0)")
    return ((top - top % under) / under).cast("long") + 1


def _differences(terms: DataFrame) -> DataFrame:
    """(lang, i, j, f): the summed differences of p, from rows (lang, groups, at, p, rest) of the kept terms.

    A row has p of the groups that have the term, by their numbers ``at``;
    ``rest`` has p of every group for a term that it lacks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rest, total = None, None, None

        def made() -> Iterator[pa.RecordBatch]:
            first = key[1] * GROUPS
            for n, row in enumerate(total):
                size = len(row)
                fields = [pa.array([key[0]] * size), pa.array([first + n] * size, pa.int32())]
                fields += [pa.array(np.arange(size, dtype=np.int32)), pa.array(row)]
                yield pa.RecordBatch.from_arrays(fields, ["lang", "i", "j", "f"])

        for batch in batches:
            langs, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            edges = [0, *(n for n in range(1, len(langs)) if (langs[n], numbers[n]) != (langs[n - 1], numbers[n - 1])), len(langs)]
            for a, b in zip(edges, edges[1:]):  # noqa: B905
                if a == b:
                    continue
                if (langs[a], numbers[a]) != key:
                    if key is not None:
                        yield from made()
                    key = (langs[a], numbers[a])
                    rest = np.asarray(batch.column(4)[a].values)
                    own = slice(key[1] * GROUPS, (key[1] + 1) * GROUPS)
                    total = np.zeros((len(rest[own]), len(rest)), np.int64)
                step = max(1, CELLS // len(rest))
                for at in range(a, b, step):
                    part = batch.slice(at, min(step, b - at))
                    sizes = pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False)
                    p = np.tile(rest, (part.num_rows, 1))
                    p[np.repeat(np.arange(part.num_rows), sizes), np.asarray(part.column(2).flatten())] = np.asarray(
                        part.column(3).flatten()
                    )
                    for n, column in enumerate(p[:, own].T):
                        total[n] += np.abs(p - column[:, None]).sum(axis=0)
        if key is not None:
            yield from made()

    rows = terms.select("lang", F.explode(F.sequence(F.lit(0), F.expr(f"(size(rest) - 1) div {GROUPS}").cast("int"))), "at", "p", "rest")
    rows = rows.toDF("lang", "part", "at", "p", "rest").sortWithinPartitions("lang", "part")
    partial = rows.mapInArrow(run, "lang string, i int, j int, f long")
    return partial.groupBy("lang", "i", "j").agg(F.sum("f").alias("f"))


def source_divergence(
    docs: DataFrame,
    min_docs: int = 30,
    top_terms: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """How far each source of a language is from each other one, and its typical terms.

    Columns lang, source, part, item, value, rank. Each language keeps the terms
    in ``min_docs`` or more of its documents; p of a term in a group, smoothed by
    five occurrences, is in parts of 10**9. Part ``pair``: each other source of
    the language, with the summed difference of p over all kept terms. Part
    ``term``: the ``top_terms`` terms whose p is farthest above the language's.
    Ranks are by value, then by item.

    Every row is a document: repeated rows count as often as they stand there.
    NULL text, language and source are the empty string; a group without terms
    has its pairs; other columns don't matter; an empty table gives no rows.

    A chunk between white space is counted in blocks of documents, each distinct
    one is made terms once, and postings of a term are united by block, as
    chunks of a document may share terms. A frequent chunk has a row for each
    block, a frequent term one for each ``TASKS`` of them and each of its chunks. The sums over pairs of sources are matrices of a task, in blocks of
    rows; no row is made for a term and a pair.
    """
    texts = filled(docs, text_col, lang_col, source_col)
    groups = texts.select("lang", F.col("source").alias("name")).distinct().withColumn(
        "source", F.xxhash64("name").bitwiseAND((1 << SOURCE_BITS) - 1)
    )
    same = F.count("*").over(Window.partitionBy("lang", "source")) == 1  # two names of a hash would be one group
    one = F.when(same, F.col("source")).otherwise(F.raise_error(F.lit("two sources have one hash")).cast("long"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("name")) - 1
    groups = written(groups.select("lang", "name", one.alias("source"), number.alias("number")))
    kept = written(kept_terms(texts, min_docs))

    of_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.countDistinct("term").alias("v"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    zero = F.lit(0).cast("long")
    totals = (
        groups.join(of_lang, "lang", "left")
        .join(of_group, ["lang", "source"], "left")
        .select("lang", "source", "name", "number", *(F.coalesce(c, zero).alias(c) for c in ("lang_n", "v", "group_n")))
    )
    rest = F.when(F.col("v") > 0, _p(zero, F.col("group_n"), F.col("v")))
    totals = written(totals.withColumn("rest", rest))
    p = _p(F.col("n"), F.col("group_n"), F.col("v")).alias("p")
    scored = kept.join(totals, ["lang", "source"]).select("lang", "name", "number", "term", "n", p)

    of_term = scored.groupBy("lang", "term").agg(
        F.collect_list(F.struct("number", "p")).alias("of"), F.sum("n").alias("n")
    )  # as many as the language has sources
    rests = totals.filter("v > 0").groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("number", "rest"))), lambda x: x["rest"]).alias("rest"),
        F.max("lang_n").alias("lang_n"),
        F.max("v").alias("v"),
    )
    of_term = written(of_term.join(rests, "lang").withColumn("q", _p(F.col("n"), F.col("lang_n"), F.col("v"))))
    sums = _differences(of_term.select("lang", F.col("of.number").alias("at"), F.col("of.p").alias("p"), "rest"))

    of_j = totals.select("lang", F.col("number").alias("j"), F.col("name").alias("item"))
    of_i = totals.select("lang", F.col("number").alias("i"), F.col("name").alias("source"), (F.col("v") > 0).alias("some"))
    summed = of_i.join(of_j, "lang").filter("i <> j").join(sums, ["lang", "i", "j"], "left")
    pairs = summed.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("f", zero).alias("value"))

    term = of_term.select("lang", "term", "q", F.inline("of")).filter("p > q")
    names = totals.select("lang", "number", F.col("name").alias("source"))
    terms = term.join(names, ["lang", "number"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).filter(F.col("rank") <= top_terms))
