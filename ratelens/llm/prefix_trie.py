"""Shared beginnings of conversations: a trie whose subtrees are summed along its Euler tour."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.ordered import range_chunks, running_sums, with_next
from ratelens.llm.common import written

# Turns of the base conversation that a rebuilt one can take: crc32 % 9.
HEADS = 9

# Positions in a chunk of a conversation or of the tour.
CHUNK = 65_536

# A list of so many arcs is ranked by one task; a longer one is contracted first.
LAST_ARCS = 50_000

# Conversation ids in a piece of the text that is hashed.
IDS_AT_ONCE = 50_000

KEY = ["depth", "k1", "k2"]


def original_turns(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, place, item, bytes): the turns in order, from 0; ``item`` is the digest of role and text."""
    role, text = (F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in (role_col, text_col))
    item = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        item.alias("item"),
        F.octet_length(text).cast("long").alias("bytes"),
    ).filter("conv is not null")
    order = ["conv", "turn", "item"]
    placed = running_sums(range_chunks(turns, order), ["conv"], order[1:], {"place": F.lit(1)})
    return placed.select("conv", (F.col("place") - 1).alias("place"), "item", "bytes")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, length) of the rebuilt conversations and (conv, depth, item, bytes) of their turns, depth from 1."""
    sizes = turns.groupBy("conv").agg(
        F.count("*").alias("own"),
        F.array_sort(F.collect_list(F.when(F.col("place") < HEADS - 1, F.struct("place", "item", "bytes")))).alias("head"),
    )  # eight turns at most
    base = sizes.select(F.col("conv").alias("base"), F.col("head").alias("of_base"))
    taken = (F.crc32(F.col("conv").cast("string")) % HEADS).cast("int")
    convs = (
        sizes.select("conv", "own", taken.alias("h"), (F.col("conv") - F.col("conv") % 5).alias("base"))
        .join(base, "base", "left")
        .withColumn("of_base", F.slice(F.coalesce("of_base", F.array().cast(base.schema["of_base"].dataType)), 1, F.col("h")))
        .withColumn("taken", F.size("of_base"))
        .select("conv", "h", "of_base", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    )
    convs = written(convs)
    taken_turns = convs.select("conv", F.inline("of_base")).withColumn("depth", F.col("place") + 1)
    own_turns = turns.join(convs.select("conv", "h", "taken"), "conv").filter(F.col("place") >= F.col("h"))
    own_turns = own_turns.withColumn("depth", F.col("taken") + F.col("place") - F.col("h") + 1)
    names = ["conv", "depth", "item", "bytes"]
    return convs.select("conv", "length"), taken_turns.select(names).unionByName(own_turns.select(names))


def _lanes() -> dict[str, Column]:
    """Four numbers of 32 bits from a turn and its depth: sums of them stand for a sequence of turns."""
    digest = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("item")))
    return {f"s{n}": F.conv(F.substring(digest, 8 * n + 1, 8), 16, 10).cast("long") for n in range(4)}


def _key(lanes: list[Column]) -> list[Column]:
    """Two longs of four sums."""
    low = [lane % 2**32 for lane in lanes]
    return [F.shiftleft(low[n], 32).bitwiseXOR(low[n + 1]) for n in (0, 2)]


def trie_nodes(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, and (depth, k1, k2, conv) of the conversations' ends.

    Nodes have depth, k1, k2, conv_id, n_convs, bytes, p1 and p2, the key of the parent.
    """
    c = F.col
    single = turns.select("conv", "depth", "bytes", *(lane.alias(f"t{n}") for n, lane in enumerate(_lanes().values())))
    chunked = written(single.withColumn("chunk", F.floor(c("depth") / CHUNK)))
    summed = running_sums(chunked, ["conv"], ["depth"], {f"s{n}": c(f"t{n}") for n in range(4)})
    own = [c(f"s{n}") for n in range(4)]
    before = [c(f"s{n}") - c(f"t{n}") for n in range(4)]
    names = ["k1", "k2", "p1", "p2"]
    keyed = summed.select(
        "conv", "depth", "bytes", *(key.alias(name) for key, name in zip([*_key(own), *_key(before)], names, strict=True))
    )
    keyed = written(keyed.withColumn("depth", c("depth").cast("long")))
    nodes = keyed.groupBy(KEY).agg(
        F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *(F.min(name).alias(name) for name in ("bytes", "p1", "p2")),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(*(zero.alias(name) for name in KEY), "conv_id", "n_convs", *(zero.alias(x) for x in ("bytes", "p1", "p2")))
    last = keyed.join(convs.withColumnRenamed("length", "depth"), ["conv", "depth"]).select(*KEY, "conv")
    none = convs.filter("length = 0").select(*(zero.alias(name) for name in KEY), "conv")
    return nodes.unionByName(root), last.unionByName(none)


def ids_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): the digest of the ids of each node, ascending, as one text.

    Ids are joined to pieces where they lie, in ranges, and the pieces of a node are hashed one after another.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(KEY, key, strict=True), first=ids[0], ids=",".join(map(str, ids)))])

        for batch in batches:
            for *own, conv in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if own != key or len(ids) == IDS_AT_ONCE:
                    if ids:
                        yield piece()
                    key, ids = own, []
                ids.append(conv)
        if ids:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for *own, _, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if own == key:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    out.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
            yield made(out)
            out = []
        if state:
            yield made([(*key, state.hexdigest())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], [*KEY, "ends_sha256"])

    ranges = ends.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    joined = ranges.mapInArrow(pieces, "depth long, k1 long, k2 long, first long, ids string")
    hashed = joined.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return hashed.mapInArrow(digests, "depth long, k1 long, k2 long, ends_sha256 string")


def list_ranks(links: DataFrame) -> DataFrame:
    """(arc, rank): how many arcs stand before each one, of a list of (arc, next); next is NULL behind the last.

    In a round an arc whose coin shows heads takes up the one behind it if that
    shows tails: the list loses about a quarter, and a record tells where the
    arc taken up stands. What is left in the end is ranked by one task, and the
    records are undone in reverse.
    """
    state = written(links.select("arc", "next", F.lit(1).cast("long").alias("size")))
    records: list[DataFrame] = []
    while state.count() > LAST_ARCS:
        coin = lambda arc, n=len(records): F.xxhash64(F.lit(n), arc) % 2 == 0
        heads, tails = coin("arc"), ~coin("arc")
        takes = heads & F.col("next").isNotNull() & ~coin("next")
        taken = state.filter(tails).select(*(F.col(name).alias(f"t_{name}") for name in state.columns))
        met = written(state.filter(takes).join(taken, F.col("next") == F.col("t_arc"), "full"))
        grown = met.filter("arc is not null").select(
            "arc", F.col("t_next").alias("next"), (F.col("size") + F.col("t_size")).alias("size")
        )
        alone = met.filter("arc is null").select(*(F.col(f"t_{name}").alias(name) for name in state.columns))
        others = state.filter(heads & ~takes)
        records.append(met.filter("arc is not null").select("t_arc", "arc", F.col("size").alias("behind")))
        state = written(others.unionByName(grown).unionByName(alone))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=_LIST)
        rows = {tuple(arc.values()): (following, size) for arc, following, size in zip(*(c.to_pylist() for c in table.columns), strict=True)}
        at = next(iter(rows.keys() - {tuple(following.values()) for following, _ in rows.values() if following}), None)
        arcs, ranks, rank = [], [], 0
        while at is not None:
            arcs.append(dict(zip(("conv", "code"), at, strict=True)))
            ranks.append(rank)
            following, size = rows[at]
            rank += size
            at = following and tuple(following.values())
        yield pa.RecordBatch.from_arrays([pa.array(arcs, _LIST.field("arc").type), pa.array(ranks, pa.int64())], ["arc", "rank"])

    ranks = state.repartition(1).mapInArrow(walked, "arc struct<conv:long,code:long>, rank long")
    for record in reversed(records):
        ranks = written(ranks)
        own = record.join(ranks, "arc").select(F.col("t_arc").alias("arc"), (F.col("rank") + F.col("behind")).alias("rank"))
        ranks = ranks.unionByName(own)
    return ranks


_ARC = pa.struct([("conv", pa.int64()), ("code", pa.int64())])
_LIST = pa.schema([("arc", _ARC), ("next", _ARC), ("size", pa.int64())])


def prefix_trie(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    Conversation c is rebuilt from the first h turns of conversation c - c % 5,
    h = crc32(c) % 9, and its own turns behind its first h. A node is a distinct
    beginning of d turns, from the root of none. Columns conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (bytes of the last text times members but one, over the subtree) and
    ends_sha256 (ids of the members that end there).

    Turns go by ``turn``, NULL first; ties by a digest of role and text, and
    repeated rows are turns of their own. NULL role and text are empty, rows
    without an id take no part, other columns don't matter, and an empty table gives no rows.

    Sequences are named by 128 bits that add up over their turns. Every node has
    an enter and an exit arc, each linked to the arc behind it; their places
    along the tour come from list ranking, and sums over subtrees from running
    sums at those places. Long conversations, popular beginnings and the
    children of a node are parted in chunks.
    """
    c = F.col
    convs, turns = rebuilt_turns(written(original_turns(rows, id_col, turn_col, role_col, text_col)))
    nodes, ends = trie_nodes(convs, turns)
    nodes = written(nodes)
    parents = nodes.select((c("depth") + 1).alias("depth"), c("k1").alias("p1"), c("k2").alias("p2"), c("conv_id").alias("parent_conv_id"))
    children = nodes.filter("depth > 0").join(parents, ["depth", "p1", "p2"])
    children = range_chunks(children.select(*nodes.columns, "parent_conv_id"), ["depth", "parent_conv_id", "conv_id"])
    sibling = (c("next.depth") == c("depth")) & (c("next.parent_conv_id") == c("parent_conv_id"))
    children = with_next(children, ["depth", "parent_conv_id", "conv_id"]).withColumn("sibling", F.when(sibling, c("next.conv_id")))
    names = [*nodes.columns, "parent_conv_id"]
    none = F.lit(None).cast("long")
    root = nodes.filter("depth = 0").withColumns({"parent_conv_id": none, "sibling": none})
    linked = written(children.select(*names, "sibling").unionByName(root.select(*names, "sibling")))
    first = linked.filter("depth > 0").groupBy((c("depth") - 1).alias("depth"), c("parent_conv_id").alias("conv_id"))
    first = first.agg(F.min("conv_id").alias("first_child"), F.count("*").alias("n_children"))
    tree = written(linked.join(first, ["depth", "conv_id"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    def arc(conv: Column | str, depth: Column, leaves: int) -> Column:
        return F.struct((c(conv) if isinstance(conv, str) else conv).alias("conv"), (2 * depth + leaves).alias("code"))

    depth = c("depth")
    enter = F.struct(
        arc("conv_id", depth, 0).alias("arc"),
        F.when(c("first_child").isNull(), arc("conv_id", depth, 1)).otherwise(arc("first_child", depth + 1, 0)).alias("next"),
    )
    leave = F.struct(
        arc("conv_id", depth, 1).alias("arc"),
        F.when(c("sibling").isNotNull(), arc("sibling", depth, 0))
        .when(depth > 0, arc("parent_conv_id", depth - 1, 1))
        .alias("next"),
    )
    ranks = list_ranks(tree.select(F.inline(F.array(enter, leave))))
    weights = tree.select(
        arc("conv_id", depth, 0).alias("arc"),
        (c("n_children") == 0).cast("long").alias("leaves"),
        ((c("n_convs") - 1) * c("bytes")).alias("saved"),
    )
    toured = ranks.join(weights, "arc", "left").withColumn("chunk", F.floor(c("rank") / CHUNK))
    toured = written(toured.select("arc", "rank", "chunk", *(F.coalesce(x, F.lit(0)).alias(x) for x in ("leaves", "saved"))))
    sums = running_sums(toured.withColumn("tour", F.lit(0)), ["tour"], ["rank"], {"all_leaves": c("leaves"), "all_saved": c("saved")})
    leaving = c("arc.code") % 2 == 1
    inside = [
        F.sum(F.when(leaving, c(f"all_{x}")).otherwise(c(x) - c(f"all_{x}"))).alias(name)
        for x, name in (("leaves", "n_leaves"), ("saved", "saved_tokens"))
    ]
    subtrees = sums.groupBy(c("arc.conv").alias("conv_id"), F.expr("arc.code div 2").alias("depth")).agg(*inside)
    digests = ids_digests(ends)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        tree.join(digests, KEY, "left")
        .join(subtrees, ["conv_id", "depth"])
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        )
    )
