"""Operator 8: sources mixed to target weights by a low-discrepancy schedule.

The mix is a row of slots, each of which takes a block of one source. The documents of a source, shuffled by hash and laid
end to end, are cut into blocks of nearly equal size, about ``BLOCK`` words, and begun again for each pass. A source has
a share of the slots in proportion to the blocks that its target takes. Slot i gets the point frac(i * golden ratio),
in integers modulo 2^30; the cumulative shares of the sources map it to a source. A slot's rank among those of its source is the
block it takes. The last slot of a source takes the words that its target still lacks; slots beyond that
take nothing, and those that a source got too few of (no more than the sequence's discrepancy) follow at the end. So a source of any size
comes within a word of its target.

Targets: sources in code-point order (NULL last) weigh 1, 2, 3, 1, 2, 3 ... and share all words; none
gets over three times its words, and what is cut off goes to the others by weight.

Ranks and positions are sums by chunk of slots or bucket of documents, then windows within a chunk
or bucket: no task sees a whole source. Every choice comes from md5 and integers, so reruns agree.

NULL texts have no words; documents without words are never taken. Repeated rows each have
their own place. An empty table gives no rows. Extra columns are kept by ``mixed_documents``, and ignored
by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.tables import checked_broadcast, partition_starts
from ledgerline.operators.cuts import cut

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 32
PASSES = 3
#: The golden ratio times 2^30, made odd.
GOLDEN, MODULUS = 663608941, 1 << 30
#: Documents are shuffled into this many buckets by the leading digits of their hash.
BUCKETS = 4096
CHUNK = 1 << 16


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_hash() -> Column:
    return F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("text")).cast("binary"))


def targets(sizes: DataFrame, passes: int = PASSES) -> DataFrame:
    """``source, source_size, target`` from one row (source, source_size) for each source.

    With sources in order of cap / weight, all before some place are at their cap and share the rest
    by weight; the place is the first whose cap is above its share.
    """
    everyone = Window.partitionBy(F.lit(0))
    by_name = everyone.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.select(
        "source",
        "source_size",
        (F.pmod(F.row_number().over(by_name) - 1, F.lit(3)) + 1).cast("double").alias("weight"),
        (F.col("source_size") * passes).cast("double").alias("cap"),
    )
    by_ratio = everyone.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = weighed.select(
        "*",
        (
            (F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(after)
        ).alias("level"),
    )
    free = F.col("cap") >= F.col("level") * F.col("weight")
    # past that place levels only fall, so its level is the highest among the free sources
    shared = level.select("*", F.max(F.when(free, F.col("level"))).over(everyone).alias("water"))
    target = F.least(F.col("cap"), F.coalesce(F.col("water"), F.lit(0.0)) * F.col("weight"))
    return shared.select("source", "source_size", target.alias("target"))


def _key() -> Column:
    """A source as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))


def _least() -> Column:
    """The words of a source's smaller blocks; the first ones have one more."""
    return F.floor(F.col("source_size") / F.col("blocks"))


def _edge(number: Column) -> Column:
    """The words of a source before its block of this number."""
    return number * _least() + F.least(number, F.pmod("source_size", "blocks"))


def _block_of(word: Column) -> Column:
    """The block in which a word of a source lies."""
    more = F.pmod("source_size", "blocks")
    rest = word - more * (_least() + 1)
    return F.when(rest < 0, F.floor(word / (_least() + 1))).otherwise(more + F.floor(rest / _least()))


def quotas(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """Targets with ``key``, ``blocks`` of the source, the whole ``words`` of its target and the ``slots`` that these
    take; of sources that take any."""
    words = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    sized = plan.where("source_size > 0").select(
        "*", _key().alias("key"), F.ceil(F.col("source_size") / block).alias("blocks"), words.alias("words")
    )
    last = _block_of(F.pmod(F.col("words") - 1, "source_size"))
    slots = F.floor((F.col("words") - 1) / F.col("source_size")) * F.col("blocks") + last + 1
    return sized.where("words > 0").withColumn("slots", slots.cast("long"))


def schedule(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """The slots that take words: ``slot, key, pass, block, first, words`` (from word ``first`` of the laid out
    source). ``plan`` is a written table of targets, one row for each source."""
    spark = plan.sparkSession
    shares = cut(quotas(plan, block), "quotas")
    n_slots = shares.agg(F.sum("slots")).first()[0] or 0
    upto = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    upper = F.sum("slots").over(upto.rowsBetween(Window.unboundedPreceding, 0))
    edges = shares.select(
        "*",
        F.round((upper - F.col("slots")) / n_slots * MODULUS).cast("long").alias("low"),
        F.round(upper / n_slots * MODULUS).cast("long").alias("high"),
    )
    point = F.pmod(F.pmod(F.col("id"), F.lit(MODULUS)) * GOLDEN, F.lit(MODULUS))
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), point.alias("point"))
    # sources are found by the point's leading bits, so this is a join on equal keys
    step = MODULUS >> 10
    first, last = F.floor(F.col("low") / step), F.floor((F.col("high") - 1) / step)
    cells = edges.where("high > low").select("key", "low", "high", F.explode(F.sequence(first, last)).alias("cell"))
    cells = checked_broadcast(cut(cells, "share-cells"))
    hit = slots.withColumn("cell", F.floor(F.col("point") / step)).join(cells, "cell")
    hit = hit.where("point >= low and point < high").select(
        "slot", "key", F.floor(F.col("slot") / CHUNK).alias("chunk"), F.lit(1).cast("long").alias("one")
    )
    hit = cut(hit, "slots")
    starts = partition_starts(hit, "chunk", ["one"], ["key"])
    within = Window.partitionBy("chunk", "key").orderBy("slot")
    ranked = hit.join(starts, ["key", "chunk"]).select(
        "slot", "key", (F.row_number().over(within) - 1 + F.col("one_before")).alias("rank")
    )
    # slots that a source lacks come after all others
    got = hit.groupBy("key").agg(F.count("*").alias("got"))
    short = shares.join(got, "key", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    short = short.where("got < slots").select("key", F.explode(F.expr("sequence(got, slots - 1)")).alias("rank"))
    late = short.select((F.lit(n_slots) + F.col("rank")).alias("slot"), "key", "rank")
    known = checked_broadcast(shares.select("key", "source_size", "blocks", "words", "slots"))
    every = ranked.unionByName(late).join(known, "key").where("rank < slots")
    taken = every.select(
        "*", F.floor(F.col("rank") / F.col("blocks")).alias("pass"), F.pmod("rank", "blocks").alias("block")
    ).select("*", _edge(F.col("block")).alias("first"), _edge(F.col("block") + 1).alias("end"))
    left = F.col("words") - F.col("pass") * F.col("source_size") - F.col("first")
    words = F.least(F.col("end") - F.col("first"), left).alias("words")
    return taken.select("slot", "key", "pass", "block", "first", words)


def layout(docs: DataFrame) -> DataFrame:
    """Documents (with ``hash`` and ``size``) with ``at``, the words before them in their source."""
    bucket = F.conv(F.substring("hash", 1, 3), 16, 10).cast("int")
    keyed = docs.withColumn("bucket", bucket).withColumn("key", _key())
    starts = partition_starts(keyed, "bucket", ["size"], ["key"])
    order = Window.partitionBy("key", "bucket").orderBy("hash", "size", "doc_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("size_before")
    return keyed.join(starts, ["key", "bucket"]).withColumn("at", at).drop("bucket", "size_before")


def _spans(laid: DataFrame, plan: DataFrame, block: int) -> DataFrame:
    """Documents with each block that they reach into."""
    known = checked_broadcast(quotas(plan, block).select("key", "source_size", "blocks"))
    reach = F.sequence(_block_of(F.col("at")), _block_of(F.col("at") + F.col("size") - 1))
    worded = laid.where("size > 0").select("key", "at", "size").join(known, "key")
    return worded.select("key", "at", "size", F.explode(reach).alias("block"))


def _planned(docs: DataFrame, passes: int) -> tuple[DataFrame, DataFrame]:
    slim = docs.select(
        "doc_id", "source", n_words().alias("size"), shuffle_hash().alias("hash")
    )
    slim = cut(slim, "counted")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    return slim, cut(targets(sizes, passes), "targets")


def mix(docs: DataFrame, block: int = BLOCK, passes: int = PASSES) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken``: the words that the mix takes of each
    document, repeats counted."""
    slim, plan = _planned(docs, passes)
    uses = schedule(plan, block).groupBy("key", "block", "first", "words").agg(F.count("*").alias("uses"))
    laid = cut(layout(slim), "layout")
    start = F.greatest("at", "first")
    end = F.least(F.col("at") + F.col("size"), F.col("first") + F.col("words"))
    taken = (
        _spans(laid, plan, block)
        .join(uses, ["key", "block"])
        .groupBy("key", "at")
        .agg(F.sum(F.greatest(end - start, F.lit(0)) * F.col("uses")).alias("taken"))
    )
    worded = laid.where("size > 0").join(taken, ["key", "at"], "left")
    silent = laid.where("size = 0").withColumn("taken", F.lit(None).cast("long"))
    plan = checked_broadcast(plan)
    both = worded.unionByName(silent)
    return both.join(plan, both["source"].eqNullSafe(plan["source"])).select(
        "doc_id",
        "size",
        both["source"],
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).alias("taken"),
    )


def _first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word."""
    spaced = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    return F.array_join(F.slice(spaced, 1, words), "")


def mixed_documents(docs: DataFrame, block: int = BLOCK, passes: int = PASSES) -> DataFrame:
    """The mix itself: the table's rows, each as often as it is taken. The last pass over a source
    ends inside a document, which is cut behind the last word taken; ``n_chars``, if there, is
    counted anew. Texts are shuffled once, by source and hash, to find their places."""
    _, plan = _planned(docs, passes)
    used = schedule(plan, block).groupBy("key").agg(F.sum("words").alias("used"))
    ends = plan.withColumn("key", _key()).join(used, "key").select(
        "key",
        F.floor(F.col("used") / F.col("source_size")).cast("int").alias("whole_passes"),
        F.pmod("used", "source_size").alias("rest"),
    )
    ends = checked_broadcast(cut(ends, "taken-of-sources"))
    helpers = {"size": n_words(), "hash": shuffle_hash()}
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    laid = layout(docs.select("doc_id", "source", row, *(c.alias(n) for n, c in helpers.items())))
    part = F.least(F.greatest(F.col("rest") - F.col("at"), F.lit(0)), "size")
    counts = F.array_repeat(F.col("size"), F.col("whole_passes"))
    copies = F.when(part > 0, F.array_append(counts, part)).otherwise(counts)
    taken = laid.where("size > 0").join(ends, "key").withColumn("words", F.explode(copies))
    whole = F.col("words") == F.col("size")
    text = F.when(whole, F.col("row.text")).otherwise(
        _first_words(F.col("row.text"), F.col("words").cast("int"))
    )
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return taken.select(
        *(new.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns)
    )
