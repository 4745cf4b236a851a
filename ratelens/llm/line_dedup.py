"""Deduplication of lines, exact and within a few edits.

Only DataFrame functions. A line and one within ``edits`` edits of it share
one of its edits + 1 segments, at nearly the same place.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.checkpoints import checkpointed
from ratelens.llm.common import free_name, may_be_in, text_key, texts_of, written

#: Keys that are sent to all executors (16 MB); of more, a filter is, and the lines that pass it are shuffled.
BROADCAST_KEYS = 1_000_000

#: Indexed lines that a probing line is compared with under one key. Keys of
#: more lines are refined by what the key leaves out, up to ``LEVELS`` times.
#: Lines that still agree then are mostly near: they agree in several of the next
#: segments too, so that more levels repeat their pairs and tell few apart.
INDEXED = 16
LEVELS = 2

#: Lines that still crowd a key are compared with a consensus of theirs, made of
#: so many parts, and then with those that differ from it near the same place:
#: in bins of so many characters, with so many characters beside a difference.
PARTS = 32
BIN = 16
BESIDE = 2


@dataclass(frozen=True)
class Lines:
    """Lines of ``min_chars`` or more take part; near ones differ by ``edits`` insertions, deletions and replacements.

    With ``short``, shorter lines that aren't blank take part as exact copies.
    """

    edits: int = 2
    min_chars: int = 20
    short: bool = False


def segment(length: Column, count: Column, number: Column) -> tuple[Column, Column]:
    """Start (from 1) and length of a segment, when a length is parted evenly; the last ones are the longer."""
    short = F.floor(length / count).cast("int")
    shorter = count - length % count  # so many have the short length
    start = (number - 1) * short + F.greatest(number - 1 - shorter, F.lit(0)) + 1
    return start, short + F.when(number > shorter, 1).otherwise(0)


def _literals(names: str, rows: list[tuple]) -> Column:
    """Constant rows, as an array of structs to be inlined."""
    return F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(names.split(), row, strict=True))) for row in rows))


def widened(rows: DataFrame) -> DataFrame:
    """With four bytes for each character of the line, to cut it without counting."""
    return rows.withColumn("wide", F.encode("line", "UTF-32"))


def whole_lines(lines: DataFrame, edits: int) -> DataFrame:
    """Each line once as indexed, and once for each length that an indexed line within the edits of it may have.

    State of a row: the part of the line from ``start`` of ``length`` characters
    is yet to be matched, within ``left`` edits, with a part of ``other``
    characters of an indexed line; ``key`` stands for what has matched.
    """
    roles = _literals("indexed longer", [(True, 0), *((False, longer) for longer in range(edits + 1))])
    return widened(lines).select("line", "wide", F.char_length("line").alias("length")).select("*", F.inline(roles)).select(
        "line",
        "wide",
        "indexed",
        F.lit(1).alias("start"),
        "length",
        (F.col("length") - F.col("longer")).alias("other"),
        F.lit(edits).alias("left"),
        F.xxhash64((F.col("length") - F.col("longer"))).alias("key"),
    )


def _places(edits: int) -> Column:
    """Constant arrays of (number, shift): the segments that may match and how far they may have moved.

    One array for each role (a row as indexed is cut where it stands), number of
    edits left and difference in length, in this order.
    """
    kind = "array<struct<number:int,shift:int>>"
    out = []
    for indexed in (False, True):
        for left in range(edits + 1):
            for longer in range(-edits, edits + 1):
                fits = [
                    F.struct(F.lit(number).alias("number"), F.lit(shift).alias("shift"))
                    for number in range(1, left + 2)
                    for shift in range(1 - number, number)
                    if abs(shift - longer) <= left + 1 - number and (shift == 0 or not indexed)
                ]
                out.append(F.array(*fits).cast(kind))
    return F.array(*out)


def refined(rows: DataFrame, edits: int) -> DataFrame:
    """Match one segment of what is left; a row for each segment and each place it may have moved to.

    Parted into left + 1 segments, some segment matches with fewer edits before
    it than segments, and no more behind it than it leaves: so it has moved by
    no more than either. What remains is the part behind the first segment, or
    before another one. One short expression serves all places, so that the JVM
    compiles it.
    """
    c = F.col
    longer = c("length") - c("other")
    choice = (c("indexed").cast("int") * (edits + 1) + c("left")) * (2 * edits + 1) + longer + edits
    fitting = F.when(F.abs(longer) <= edits, F.get(_places(edits), choice))
    placed = rows.select("*", F.inline(fitting))
    first, size = segment(c("other"), c("left") + 1, c("number"))
    placed = placed.select("*", first.alias("first"), size.alias("size"))
    at = c("first") + c("shift")
    behind = c("number") == 1
    piece = F.substring("wide", 4 * (c("start") + at - 1) - 3, 4 * c("size"))
    return placed.filter((at >= 1) & (at + c("size") - 1 <= c("length"))).select(
        "line",
        "indexed",
        F.when(behind, c("start") + at + c("size") - 1).otherwise(c("start")).alias("start"),
        F.when(behind, c("length") - at - c("size") + 1).otherwise(at - 1).alias("length"),
        F.when(behind, c("other") - c("size")).otherwise(c("first") - 1).alias("other"),
        F.when(behind, c("left")).otherwise(c("number") - 1).alias("left"),
        F.xxhash64("key", "number", "other", piece).alias("key"),
    )


def letters_of(line: Column) -> Column:
    """The characters, to be kept as a column: lambdas would part the line anew at each character."""
    return F.regexp_extract_all(line, F.lit("(?s)."), 0)


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether two strings, as arrays of characters, differ by ``edits`` edits or fewer.

    One bit for each diagonal of a band around the main one and a word for each
    number of edits: a bit is set if that many edits lead to this place. For
    each character of ``a`` the words are shifted and combined as a whole.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1

    def closed(words: list[Column]) -> list[Column]:
        """Characters of ``b`` may be inserted: a diagonal up for each edit."""
        out = [words[0]]
        for word in words[1:]:
            out.append(word.bitwiseOR(F.shiftleft(out[-1], 1)).bitwiseAND(F.lit(full)))
        return out

    def named(words: list[Column]) -> Column:
        return F.struct(*(word.cast("int").alias(f"e{n}") for n, word in enumerate(words)))

    def matches(at: Column) -> Column:
        letter = F.element_at(a, at)
        same = (F.get(b, at + F.lit(diagonal - edits - 1)) == letter for diagonal in range(width))
        return reduce(Column.__add__, (F.when(x, F.lit(1 << d)).otherwise(F.lit(0)) for d, x in enumerate(same)))

    def step(state: Column, match: Column) -> Column:
        words = []
        for n in range(edits + 1):
            word = state[f"e{n}"].bitwiseAND(match)
            if n:
                less = state[f"e{n - 1}"]
                word = word.bitwiseOR(less).bitwiseOR(F.shiftright(less, 1))  # replaced, deleted
            words.append(word)
        return named(closed(words))

    first = named(closed([F.lit(1 << edits)] + [F.lit(0)] * edits))
    last = F.aggregate(F.transform(F.sequence(F.lit(1), F.size(a)), matches), first, step)[f"e{edits}"]
    final = F.size(b) - F.size(a) + edits
    near = F.abs(F.size(b) - F.size(a)) <= edits
    reached = F.call_function("shiftright", last, F.greatest(final, F.lit(0))).bitwiseAND(F.lit(1)) == 1
    return F.when(F.size(a) == 0, near).when(near, reached).otherwise(F.lit(False))


def lines_of(docs: DataFrame, settings: Lines, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, at, line) of the lines that take part; ``at`` counts all lines of a text from 0."""
    texts = texts_of(docs, id_col, text_col).filter("doc_id is not null and text is not null")
    every = texts.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    long = F.char_length("line") >= settings.min_chars
    return every.filter(long | F.col("line").rlike(r"\S") if settings.short else long)


def candidate_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """(line_a, line_b) of distinct lines, in this order, that share a segment at a fitting place.

    First only keys are counted, with partial aggregates: those under which two
    lines meet are few. Then the lines of these follow. Under a key with many
    indexed lines another segment has to match, and so on; what crowds a key
    after that goes by where it differs from the usual line.
    """
    rows = refined(whole_lines(lines.select("line"), edits), edits)
    name = F.xxhash64("line")
    met = (
        rows.groupBy("key")
        .agg(F.min(name).alias("low"), F.max(name).alias("high"), F.max("indexed").alias("some"), F.min("indexed").alias("all"))
        .filter("low <> high and some and not all")
        .select("key")
    )
    met = checkpointed(met)
    if met.count() <= BROADCAST_KEYS:
        met = F.broadcast(met)
    else:
        rows = may_be_in(rows, F.col("key"), met, "may").filter("may").drop("may")
    rows = written(rows.join(met, "key", "left_semi").distinct())
    found = []
    for level in range(LEVELS + 1):
        crowded = rows.filter("indexed").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > INDEXED).select("key")
        crowded = checkpointed(crowded)
        last = crowded.isEmpty()
        few = rows if last else rows.join(crowded, "key", "left_anti")
        a = few.filter("indexed").select("key", F.col("line").alias("a"))
        b = few.filter("not indexed").select("key", F.col("line").alias("b"))
        found.append(a.join(b, "key").filter(F.col("a") != F.col("b")).filter(shares_parts(F.col("a"), F.col("b"), edits)).select("a", "b"))
        if last:
            break
        if level == LEVELS:
            found.append(crowded_pairs(rows.join(crowded, "key", "left_semi").select("key", "line").distinct(), edits))
            break
        rows = written(refined(widened(rows.join(crowded, "key", "left_semi")), edits).distinct())
    pairs = reduce(DataFrame.unionByName, found)
    return pairs.select(F.least("a", "b").alias("line_a"), F.greatest("a", "b").alias("line_b")).distinct()


def consensus(lines: DataFrame) -> DataFrame:
    """(key, pivot): of the lines of a key that have its most frequent length, the most frequent parts, joined."""
    lengths = lines.groupBy("key", F.char_length("line").alias("n")).agg(F.count("*").alias("many"))
    usual = lengths.groupBy("key").agg(F.max(F.struct("many", "n"))["n"].alias("n"))
    own = lines.join(usual, "key").filter(F.char_length("line") == F.col("n"))
    start = lambda at: F.floor(at * F.col("n") / PARTS).cast("int")
    piece = lambda at: F.substring("line", start(at) + 1, start(at + 1) - start(at))
    parts = own.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), piece)).alias("at", "part"))
    often = parts.groupBy("key", "at", "part").agg(F.count("*").alias("many"))
    best = often.groupBy("key", "at").agg(F.max(F.struct("many", "part"))["part"].alias("part"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"])
    return best.groupBy("key").agg(F.array_join(ordered, "").alias("pivot"))


def shared_start(a: Column, b: Column) -> Column:
    """Number of characters that two strings begin with alike (found by halving; less for those of over a million)."""
    most = F.least(F.char_length(a), F.char_length(b))
    steps = F.array(*(F.lit(1 << n) for n in range(19, -1, -1)))

    def longer(known: Column, step: Column) -> Column:
        size = known + step
        return F.when((size <= most) & (F.substring(a, F.lit(1), size) == F.substring(b, F.lit(1), size)), size).otherwise(known)

    return F.aggregate(steps, F.lit(0), longer)


def _stands_in(window: Column, text: Column, edits: int) -> Column:
    """Whether one of edits + 1 pieces of a window stands in a text, as it must if the window does, within the edits."""
    size = F.char_length(window)
    held = F.lit(False)
    for number in range(1, edits + 2):
        start, length = segment(size, F.lit(edits + 1), F.lit(number))
        held = held | F.contains(text, F.substring(window, start, length))
    return held


def crowded_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """(a, b) of the lines of a key that may be near, without comparing all with all.

    Each line is compared with the key's consensus: they are alike up to the
    place ``first`` and, from their ends, behind ``last`` (places in the
    consensus). Take the part of a line between the two, with a few characters
    beside it. In another line that is like the consensus there, a near line's
    part must stand within the edits; so must the consensus' part in the line.
    Where neither does, a near line differs from the consensus near this place as
    well, and is found in a bin of places. Lines of which the part does stand in
    the consensus, as of those a letter or two away, are compared with one another.
    """
    c = F.col
    own = lines.join(consensus(lines), "key")
    size, whole = F.char_length("line"), F.char_length("pivot")
    own = own.withColumns({"size": size, "whole": whole, "first": shared_start(c("line"), c("pivot"))})
    behind = shared_start(F.reverse("line"), F.reverse("pivot"))
    own = own.withColumn("behind", F.least(behind, F.least("size", "whole") - c("first")))
    own = own.withColumn("last", c("whole") - c("behind"))
    longer = c("size") - c("whole")
    slack = F.abs(longer) + edits

    def cut(text: str, start: Column, end: Column) -> Column:
        start = F.greatest(start, F.lit(0))
        return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))

    start = F.greatest(c("first") - BESIDE, F.lit(0))
    line_end = F.least(c("size") - c("behind") + BESIDE, c("size"))
    pivot_end = F.least(c("last") + BESIDE, c("whole"))
    apart = ~_stands_in(cut("line", start, line_end), cut("pivot", start - slack, line_end + slack), edits) | ~_stands_in(
        cut("pivot", start, pivot_end), cut("line", start - slack, pivot_end + slack), edits
    )
    placed = own.select(
        "key",
        "line",
        "first",
        "last",
        apart.alias("apart"),
        F.least(start - longer - edits, start).alias("low"),
        F.greatest(line_end + edits, pivot_end).alias("high"),
    )
    placed = written(placed)

    def bins(low: Column, high: Column) -> Column:
        return F.sequence(F.floor(F.greatest(low, F.lit(0)) / BIN), F.floor(F.greatest(low, high, F.lit(0)) / BIN))

    names = ["line", "first", "last", "low", "high", "apart"]
    asking = placed.filter("apart").select(
        "key", *(c(name).alias(f"x_{name}") for name in names), F.explode(bins(c("low"), c("high"))).alias("bin")
    )
    held = placed.select("key", *(c(name).alias(f"y_{name}") for name in names), F.explode(bins(c("first"), c("last"))).alias("bin"))
    first_bin = F.greatest(*(F.floor(F.greatest(c(low), F.lit(0)) / BIN) for low in ("x_low", "y_first")))
    meets = (c("y_first") < c("x_high")) & (c("y_last") > c("x_low"))
    mutual = ~c("y_apart") | ((c("x_first") < c("y_high")) & (c("x_last") > c("y_low")) & (c("x_line") < c("y_line")))
    near = shares_parts(c("x_line"), c("y_line"), edits)
    some = asking.join(held, ["key", "bin"]).filter(
        (c("bin") == first_bin) & (c("x_line") != c("y_line")) & meets & mutual & near
    )
    plain = placed.filter("not apart").select("key", "line")
    a, b = plain.select("key", c("line").alias("x_line")), plain.select("key", c("line").alias("y_line"))
    others = a.join(b, "key").filter((c("x_line") < c("y_line")) & near)
    return some.select("x_line", "y_line").unionByName(others.select("x_line", "y_line")).toDF("a", "b").distinct()


def shares_parts(a: Column, b: Column, edits: int) -> Column:
    """Whether enough parts of one string stand somewhere in the other: each edit spoils one of them."""
    count = 4 * (edits + 1)
    held = F.lit(0)
    for number in range(1, count + 1):
        start, size = segment(F.char_length(a), F.lit(count), F.lit(number))
        held = held + F.contains(b, F.substring(a, start, size)).cast("int")
    return held >= count - edits


def near_pairs(lines: DataFrame, settings: Lines) -> DataFrame:
    """(line_a, line_b), distinct and in this order, that differ by the edits or fewer."""
    letters = [letters_of(F.col(f"line_{x}")).alias(f"letters_{x}") for x in "ab"]
    pairs = written(candidate_pairs(lines, settings.edits).select("line_a", "line_b", *letters))
    return pairs.filter(within_edits(F.col("letters_a"), F.col("letters_b"), settings.edits)).select("line_a", "line_b")


def repeated_lines(
    docs: DataFrame, settings: Lines = Lines(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Lines that repeat an earlier one, or come within the edits of one.

    Earlier is by doc_id and place of the first occurrence. One row for each
    document with any line that has a copy or a near line: doc_id, n_linked (its
    lines with near ones), n_links (distinct lines that these are near to) and
    repeated (places of lines to remove, from 0, sorted). A line goes if it is
    not the first of its copies, or if a near line stands before the first of
    them. Shorter lines take part as ``settings`` say; NULL texts and NULL ids don't. Rows that repeat
    an id and its text are one document.

    Distinct lines are made by partial aggregates, so a line that is in a third
    of all documents is sent once by each task; links are only between distinct
    lines.
    """
    lines = lines_of(docs, settings, id_col, text_col)
    key_a, key_b = text_key(F.col("line_a")).alias("key_a"), text_key(F.col("line_b")).alias("key_b")
    long = lines.filter(F.char_length("line") >= settings.min_chars)
    pairs = checkpointed(near_pairs(long, settings).select(key_a, key_b))
    placed = written(lines.select("doc_id", "at", text_key(F.col("line")).alias("line_key")))
    place = F.struct("doc_id", "at")
    firsts = placed.groupBy("line_key").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    of_a = firsts.select(F.col("line_key").alias("key_a"), F.col("first").alias("first_a"))
    of_b = firsts.select(F.col("line_key").alias("key_b"), F.col("first").alias("first_b"))
    order_a, order_b = F.struct("first_a", "key_a"), F.struct("first_b", "key_b")
    sides = _literals("of_a", [(True,), (False,)])
    near = (
        pairs.join(of_a, "key_a")
        .join(of_b, "key_b")
        .select("key_a", "key_b", (order_b < order_a).alias("b_earlier"), F.inline(sides))
        .groupBy(F.when(F.col("of_a"), F.col("key_a")).otherwise(F.col("key_b")).alias("line_key"))
        .agg(F.count("*").alias("n_links"), F.max(F.col("of_a") == F.col("b_earlier")).alias("earlier"))
    )
    known = checkpointed(firsts.filter("n > 1").join(near, "line_key", "full"))
    again = F.coalesce("earlier", F.lit(False)) | F.coalesce(place != F.col("first"), F.lit(False))
    return (
        placed.join(known, "line_key")
        .groupBy("doc_id")
        .agg(
            F.count("n_links").alias("n_linked"),
            F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_links"),
            F.array_sort(F.collect_set(F.when(again, F.col("at")))).alias("repeated"),
        )
    )


def drop_repeated_lines(docs: DataFrame, settings: Lines = Lines()) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text, others), texts without their repeated lines.

    A text may become empty; its row stays. Only texts that may lose lines are
    shuffled.
    """
    found = repeated_lines(docs, settings).filter(F.size("repeated") > 0)
    of_id, gone, may = free_name("id", docs), free_name("repeated", docs), free_name("may", docs)
    found = written(found.select(F.col("doc_id").alias(of_id), F.col("repeated").alias(gone)))
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda line, at: ~F.array_contains(gone, at)), "\n")
    text = F.when(F.col(gone).isNull() | F.col("text").isNull(), F.col("text")).otherwise(kept)
    flagged = may_be_in(docs, F.col("doc_id"), found.select(of_id), may)
    changed = flagged.filter(F.col(may)).join(found, F.col("doc_id") == F.col(of_id), "left").select(
        *(text.alias(name) if name == "text" else F.col(f"`{name}`") for name in docs.columns)
    )
    return flagged.filter(~F.col(may)).drop(may).unionByName(changed)
