"""Operator 13: repeated lines go, by levelled sorted runs of line hashes (DataFrame operations only).

The key of a line is the line without ASCII white space at its ends, A-Z in lower case; its hash is md5. Documents
come in batches of falling ids. The index of what came before is a set of runs: tables (key, documents, largest id), one row for each
key, in sorted buckets by key. A new batch is summed by key and merge-anti-joined with every run: keys that a run already holds
often enough are settled, as their largest document came before, and the others become a run of their own on level 0.
Two runs of a level are compacted into one of the next by a merge join. As all runs have the same
buckets, neither join shuffles a run. At last the runs are compacted into one, and the lines meet it.

Lines of the index's keys are dropped, except in the key's largest document. Keys on so many lines that there can be only
``HOT_KEYS`` of them are looked up in a broadcast table, all others by a join on the key, so no key fills a task.
Texts are shuffled once, to meet the places of their dropped lines.

NULL texts count as empty: one empty line. Rows of one id are one document; a NULL id is an id, smaller than all
others. Repeated rows each lose or keep the same lines. An empty table gives no rows. Extra columns are kept; those
named as an output are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.operators.cuts import bucketed_cut, cut

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
#: Runs of one level that are compacted into one of the next.
FAN = 2
#: 16-byte keys with an id that may be broadcast: 3 MB.
HOT_KEYS = 100_000

_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_md5, pos, key`` of every line whose key is long enough."""
    folded = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _LOWER)
    lines = docs.select(
        "doc_id", _text_md5().alias("text_md5"), F.posexplode(split_lines(folded)).alias("pos", "line")
    )
    key = F.btrim("line", F.lit(_WHITE))
    keyed = lines.select("doc_id", "text_md5", "pos", key.alias("key"))
    return keyed.where(F.length("key") >= min_chars).withColumn("key", F.unhex(F.md5("key")))


def _text_md5() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


class Runs:
    """The index: runs by level. A batch must hold no id larger than those before it."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fan: int = FAN):
        self.min_docs, self.fan = min_docs, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    def live(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """A batch (key, doc_id) by key, without the keys that some run holds often enough."""
        pairs = batch.select("key", "doc_id").distinct()
        own = pairs.groupBy("key").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
        for run in self.live():
            settled = run.where(F.col("docs") >= self.min_docs).select("key")
            own = own.join(settled.hint("merge"), "key", "left_anti")
        return own

    def add(self, batch: DataFrame) -> None:
        self._put(0, self._written(self.unsettled(batch)))

    def compacted(self, runs: list[DataFrame]) -> DataFrame:
        """One run of several: documents are summed, the largest id stays."""

        def merge(a: DataFrame, b: DataFrame) -> DataFrame:
            both = a.alias("a").join(b.alias("b").hint("merge"), "key", "full")
            docs = F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))
            keeper = F.greatest("a.keeper", "b.keeper")
            return both.select("key", docs.alias("docs"), keeper.alias("keeper"))

        return self._written(reduce(merge, runs))

    def sealed(self) -> DataFrame:
        """The one run that all live runs come to."""
        if len(self.live()) > 1:
            self.levels = [[self.compacted(self.live())]]
        return self.live()[0]

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan:
            merged, self.levels[level] = self.compacted(self.levels[level]), []
            self._put(level + 1, merged)

    def _written(self, run: DataFrame) -> DataFrame:
        return bucketed_cut(run, "line-run", ["key"], self.buckets)


def _batch(docs: DataFrame, batches: int) -> Column:
    """The number of a row's batch, by falling ids; the edges are approximate quantiles, which decide only
    how even the batches are."""
    shares = [k / batches for k in range(1, batches)]
    edges = docs.agg(F.percentile_approx("doc_id", shares)).first()[0] if shares else None
    number = sum(((F.col("doc_id") <= edge).cast("int") for edge in edges or []), F.lit(0))
    return F.coalesce(number, F.lit(batches))


def repeated_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """``doc_id, text_md5, pos`` of the lines to drop."""
    lines = keyed_lines(docs, min_chars).withColumn("batch", _batch(docs, batches))
    lines = cut(lines, "keyed-lines", ["batch"])
    runs = Runs(docs.sparkSession, min_docs)
    for number in range(batches + 1):
        runs.add(lines.where(F.col("batch") == number))
    index = runs.sealed().where(F.col("docs") >= min_docs).select("key", "keeper")
    # at most hot_keys keys can have more lines than this
    often = lines.count() // hot_keys + 1
    hot = cut(lines.groupBy("key").count().where(F.col("count") > often).select("key"), "hot-keys")
    hot_index = cut(index.join(F.broadcast(hot), "key", "left_semi"), "hot-index")
    spread = lines.join(F.broadcast(hot), "key", "left_anti").join(index.hint("merge"), "key")
    both = spread.unionByName(lines.join(F.broadcast(hot_index), "key"))
    return both.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "text_md5", "pos")


def _kept(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped places (in order), one slice for each gap."""

    def gap(k: Column) -> Column:
        before = F.coalesce(F.get(dropped, k - 1), F.lit(-1))
        after = F.coalesce(F.get(dropped, k), F.size(lines))
        return F.slice(lines, before + 2, after - before - 1)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(dropped)), gap))


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """The table with ``text`` of the kept lines, ``n_lines`` (before) and ``n_dropped``."""
    gone = repeated_lines(docs, min_chars, min_docs, batches, hot_keys)
    places = gone.groupBy("doc_id", "text_md5").agg(F.sort_array(F.collect_set("pos")).alias("_gone"))
    places = places.withColumnsRenamed({"doc_id": "_doc", "text_md5": "_md5"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (_text_md5() == F.col("_md5"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    met = docs.select(*(F.col(f"`{c}`") for c in names)).join(places, same, "left")
    # the lines are an element of an array, so that they are split once and not for each gap
    joined = F.transform(
        F.array(split_lines(F.col("text"))), lambda lines: F.array_join(_kept(lines, F.col("_gone")), "\n")
    )[0]
    text = F.when(F.col("_gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(joined)
    return met.select(
        *(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in names),
        F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
