"""Operator 7: shards cut from a Hilbert curve over document metadata (DataFrame operations only).

Language, source and size of a document are each quantised to 2^``BITS`` steps: names by their place among
all names in order, sizes by powers of two. The cell's index on the Hilbert curve orders the documents, so that
near documents agree in all three, and a run of the curve is cut into shards of near equal bytes
(law ``bytes``). Equal texts are a group, at the lowest place on the curve of any of them, and a group goes whole into shard floor(shards *
bytes before the group's middle / all bytes). No shard is farther from the mean than one group.
Minima and maxima of a shard's files then prune by each dimension.

Groups and rows are ranged along the curve and written with their part number; bytes and rows before each part
are sums by part, and windows run within a part. A group of many copies is found by an aggregate and handed
back to its rows, by a broadcast table if there can be only ``HOT_GROUPS`` of its size, else by a join. Only
ids, sizes and checksums travel, not texts.

NULL texts count as empty (size 1); a NULL name comes first among names. Documents in one cell
are ordered by checksum, then id; repeated rows keep a slot each.
An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.tables import checked_broadcast, partition_starts
from ledgerline.operators.cuts import cut

DIMS = 3
BITS = 5
#: Groups of equal texts that may be broadcast: 28 bytes each.
HOT_GROUPS = 100_000


def curve_tables(dims: int = DIMS) -> tuple[list[int], list[int]]:
    """The Hilbert curve as a state machine. A state is an entry corner and a direction; for each
    state and each orthant, the orthant's place on the curve and the state inside it. Entry corners and
    directions follow from the Gray code."""
    n, size = dims, 1 << dims

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def turn(x: int, by: int) -> int:
        by %= n
        return ((x >> by) | (x << (n - by))) & (size - 1)

    def trailing_ones(i: int) -> int:
        return (~i & (i + 1)).bit_length() - 1

    place_of = {gray(i): i for i in range(size)}
    rank, follow = [], []
    for state in range(size * n):
        entry, direction = divmod(state, n)
        for orthant in range(size):
            i = place_of[turn(orthant ^ entry, direction + 1)]
            start = 0 if i == 0 else gray(2 * ((i - 1) // 2))
            step = 0 if i == 0 else trailing_ones(i - 1 if i % 2 == 0 else i) % n
            rank.append(i)
            follow.append((entry ^ turn(start, n - direction - 1)) * n + (direction + step + 1) % n)
    return rank, follow


def hilbert_index(coordinates: list[Column], bits: int = BITS) -> Column:
    """Place on the curve of the cell with these coordinates, each from 0 to 2^bits - 1."""
    dims = len(coordinates)
    rank, follow = curve_tables(dims)
    ranks = F.array(*map(F.lit, rank))
    follows = F.array(*map(F.lit, follow))
    levels = F.array(
        *(
            sum(
                F.shiftleft(F.shiftright(c.cast("int"), level).bitwiseAND(1), d)
                for d, c in enumerate(coordinates)
            )
            for level in reversed(range(bits))
        )
    )

    def descend(at: Column, orthant: Column) -> Column:
        cell = at["state"] * (1 << dims) + orthant + 1
        return F.struct(
            (at["index"] * (1 << dims) + F.element_at(ranks, cell)).cast("long").alias("index"),
            F.element_at(follows, cell).cast("int").alias("state"),
        )

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    return F.aggregate(levels, start, descend, lambda at: at["index"])


def _in_parts(df: DataFrame, order: list, amounts: list[str], name: str) -> DataFrame:
    """The table along an order, with ``<amount>_at``: the sum of an amount over all rows before. Written in parts of the
    order; windows run within a part, on top of the sums of the parts before."""
    ranged = df.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    parts = cut(ranged, name)
    starts = checked_broadcast(cut(partition_starts(parts, "part", amounts), f"{name}-starts"))
    before = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    at = (
        (F.coalesce(F.sum(a).over(before), F.lit(0)) + F.col(f"{a}_before")).alias(f"{a}_at") for a in amounts
    )
    return parts.join(starts, "part").select(*parts.columns, *at).drop("part")


def _name_steps(df: DataFrame, name: str, bits: int) -> DataFrame:
    """Each name's step among 2^bits, by its place in order: one row for each name."""
    names = df.select(F.col(name).alias("name"), F.lit(1).cast("long").alias("one")).distinct()
    placed = cut(_in_parts(names, [F.col("name").asc_nulls_first()], ["one"], f"{name}s"), f"{name}-places")
    last = max(placed.count() - 1, 1)
    step = F.least(F.floor(F.col("one_at") / last * (1 << bits)), F.lit((1 << bits) - 1)).cast("int")
    return checked_broadcast(cut(placed.select("name", step.alias(f"{name}_step")), f"{name}-steps"))


def _with_groups(placed: DataFrame, n_shards: int) -> DataFrame:
    """The rows with the curve place and shard of their group of equal texts."""
    groups = placed.groupBy("text_md5").agg(
        F.min("curve").alias("curve"), F.sum("size").alias("bytes"), F.count("*").alias("copies")
    )
    along = _in_parts(groups, ["curve", "text_md5"], ["bytes"], "groups")
    total = placed.agg(F.sum("size")).first()[0] or 1
    middle = (2 * F.col("bytes_at") + F.col("bytes")).cast("decimal(38,0)")
    dealt = cut(along.withColumn("shard", F.floor(middle * n_shards / (2 * total)).cast("int")), "dealt-groups")
    # at most HOT_GROUPS groups can have more rows than this
    often = placed.count() // HOT_GROUPS + 1
    columns = ["text_md5", "curve", "shard"]
    hot = cut(dealt.where(F.col("copies") > often).select(columns), "hot-groups")
    rows = placed.drop("curve")
    others = rows.join(F.broadcast(hot.select("text_md5")), "text_md5", "left_anti")
    met = others.join(dealt.where(F.col("copies") <= often).select(columns), "text_md5")
    return met.unionByName(rows.join(F.broadcast(hot), "text_md5"))


def hilbert_shards(
    docs: DataFrame, n_shards: int = 16, bits: int = BITS, law: str = "bytes"
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and ``curve``, the place on the
    curve. ``law`` is ``bytes`` or ``rows`` (counts at most one apart)."""
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law {law}")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = cut(
        docs.select(
            "doc_id",
            "lang",
            "source",
            (F.length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.unhex(F.md5(raw)).alias("text_md5"),
        ),
        "sized",
    )
    placed = slim
    for name in ("lang", "source"):
        steps = _name_steps(slim, name, bits)
        same = placed[name].eqNullSafe(steps["name"])
        placed = placed.join(steps, same, "left").drop("name")
    size_step = F.least(F.floor(F.log2("size")), F.lit((1 << bits) - 1))
    curve = hilbert_index([F.col("lang_step"), F.col("source_step"), size_step], bits)
    placed = cut(
        placed.select(
            "doc_id", "size", "text_crc32", "text_md5", curve.alias("curve"), F.lit(1).cast("long").alias("row")
        ),
        "curve",
    )
    order = ["curve", "text_md5", "doc_id"]
    if law == "bytes":
        along = _in_parts(_with_groups(placed, n_shards), order, ["row"], "rows")
    else:
        total = max(placed.count(), 1)
        along = _in_parts(placed, order, ["row"], "rows")
        along = along.withColumn("shard", F.floor(F.col("row_at") * n_shards / total).cast("int"))
    sharded = cut(along, "sharded")
    first = checked_broadcast(sharded.groupBy("shard").agg(F.min("row_at").alias("first")))
    return sharded.join(first, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(law).alias("law"),
        "shard",
        (F.col("row_at") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
