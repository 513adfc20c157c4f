"""Operator 10: exact n-gram Jaccard join in metric space.

Jaccard distance is a metric, but nearly all documents lie at distance 1 from any document, so Voronoi cells around
whole documents would not tell them apart. The first cells are therefore taken in projections: the universe of
shingles is cut by hash into classes, and a document's pivot in a class is its own part there. Two linked
documents of at most n shingles differ in at most 0.3/1.85 n of them; with more classes than that, some class holds the same
part of both, at distance 0 in that projection. So each document goes to the cell of its part in every class, and no link
is lost. Classes depend on a size bracket; a document near the upper end of its bracket goes by the next one too, as
a triangle-inequality window on sizes. Equal empty parts say nothing: there are ``spare`` more classes than needed, and
documents with more empty parts than that also go to the cells of their prefix shingles, which linked documents share.

Documents that meet in cells form regions. A linked document meets the other in all cells of its parts but as many
as the elements in which they may differ, so those that met others in fewer cells leave. Passages that many documents share chain cells together, so regions are
parted again by the shingles that are rarest in them. A region is joined on whole sets: pivots split it into Voronoi
cells, a document within 2 x 0.15 of another cell's pivot, compared with its own, is copied to that cell, cells are
joined recursively, and pairs are dropped by the triangle inequality, by their rarest shingles or as already connected.
Regions of more than ``LEAF`` documents are split the same way by Spark, in blocks; what pivots do not split is joined
block against block. All of it is exact.

Documents with one set are one node, so copies cost nothing. Only hashes travel; whole sets travel once, for documents
in regions. Shingles, parts and sets are 64-bit hashes.

Words are lower-cased in A-Z. NULL or empty texts and texts without words have no set and are linked with nothing;
texts of one to three words have the whole sequence as their one shingle. Repeated rows keep a row each. A NULL
``doc_id`` counts for no component's smallest id. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerline.llm.arrow import per_text, text_bytes
from ledgerline.llm.components import connected_components
from ledgerline.llm.tables import checked_broadcast, long_field
from ledgerline.llm.words import Words, mix
from ledgerline.operators.cuts import cut

SHINGLE = 4
PERCENT = 85
LEAF = 2048
PIVOTS = 8
#: Pivots count as of no use if their cells together hold over so many times the region's members.
COPIES = 1.5
_SLACK = 1e-9


def _brackets(top: int = 1 << 40) -> np.ndarray:
    """Lower ends of the size brackets, each 1.5 times the one before."""
    ends = [1]
    while ends[-1] < top:
        ends.append(max(ends[-1] + 1, ends[-1] * 3 // 2))
    return np.array(ends, np.int64)


BRACKETS = _brackets()


def classes(bracket: int, percent: int = PERCENT) -> tuple[int, int]:
    """How many classes a bracket has, and how many of them may be empty in a document."""
    largest = int(BRACKETS[bracket + 1]) - 1
    # |A ^ B| <= (|A| + |B|) (1 - t) / (1 + t)
    differ = 2 * largest * (100 - percent) // (100 + percent)
    spare = 2 + math.ceil(0.05 * differ) if differ else 0
    return differ + 1 + spare, spare


def linked(a: np.ndarray, b: np.ndarray, shared: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of these sizes with so many common elements are linked."""
    return 100 * shared >= percent * (a + b - shared)


def _parts(members: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per bracket that a set, given as sorted hashes, goes by: the bracket, the classes in which it
    has a part, and where these parts start."""
    n = len(members)
    own = int(np.searchsorted(BRACKETS, n, "right")) - 1
    for bracket in (own, own + 1):
        if bracket > own and 100 * n < percent * int(BRACKETS[bracket]):
            continue
        k, _ = classes(bracket, percent)
        part = ((members >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        first = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        yield bracket, part[first], first


def cells_of(members: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The cells of a set, given as sorted hashes. The last bit tells odd brackets from even ones."""
    n = len(members)
    mixed, out = mix(members), []
    for bracket, part, first in _parts(members, percent):
        label = part + (np.uint64(bracket) << np.uint64(48))
        cells = [mix(np.add.reduceat(mixed, first) + mix(label))]
        k, spare = classes(bracket, percent)
        if k - len(first) > spare:
            prefix = n - -(-percent * n // 100) + 1
            cells.append(mix(mixed[:prefix] ^ mix(np.uint64([(bracket << 48) + (1 << 47)]))))
        out += [c >> np.uint64(1) << np.uint64(1) | np.uint64(bracket & 1) for c in cells]
    return np.concatenate(out)


def needed(members: np.ndarray, percent: int = PERCENT) -> list[int | None]:
    """In how many cells of its even and of its odd bracket a set meets every set linked with it
    there: all its parts but as many as the elements in which the two may differ. At least one, as
    sets with fewer parts than that also meet in cells of their prefix."""
    n, out = len(members), [None, None]
    for bracket, part, _ in _parts(members, percent):
        other = min(int(BRACKETS[bracket + 1]) - 1, 100 * n // percent)
        differ = (n + other) * (100 - percent) // (100 + percent)
        out[bracket & 1] = max(1, len(part) - differ)
    return out


def sets_of(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The set of each text: its distinct shingles as sorted hashes."""
    data, bounds = text_bytes(column)
    words = Words(data, bounds, fold=True)
    grams, at = words.grams(size)
    ends = np.searchsorted(words.doc[at], np.arange(words.n_docs + 1))
    starts = np.searchsorted(words.doc, np.arange(words.n_docs + 1))
    short = {n: words.grams(n) for n in range(1, size)} if (words.counts < size).any() else {}
    out = []
    for k in range(words.n_docs):
        n = int(words.counts[k])
        if 0 < n < size:
            values, where = short[n]
            out.append(mix(values[np.searchsorted(where, starts[k])][None] + np.uint64(n)))
        else:
            out.append(np.unique(grams[ends[k] : ends[k + 1]]))
    return out


def _node(members: np.ndarray) -> int:
    total = mix(members).sum(dtype=np.uint64) + np.uint64(len(members))
    return int(mix(total[None] if total.ndim else np.array([total]))[0].astype(np.int64))


def set_rows(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, node`` and what is ``needed`` for every row; no node without a set."""
    schema = T.StructType(long_field("doc_id", "n_shingles", "node", "need_even", "need_odd"))

    def work(part: pa.RecordBatch) -> dict:
        sets = sets_of(part.column("text"), size)
        need = [needed(s, percent) if len(s) else (None, None) for s in sets]
        return {
            "doc_id": part.column("doc_id"),
            "n_shingles": [len(s) for s in sets],
            "node": [_node(s) if len(s) else None for s in sets],
            "need_even": [even for even, _ in need],
            "need_odd": [odd for _, odd in need],
        }

    return per_text(docs.select(F.col("doc_id").cast("long"), "text"), "text", schema, work)


def cell_rows(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``cell, node``: the cells that each set goes to. These are the most rows of the join, so they
    are made anew from the texts where they are shuffled, and never written."""

    def work(part: pa.RecordBatch) -> dict:
        sets = {_node(s): s for s in sets_of(part.column("text"), size) if len(s)}
        cells = [cells_of(s, percent) for s in sets.values()]
        flat = np.concatenate([np.zeros(0, np.uint64), *cells]).view(np.int64)
        return {"cell": flat, "node": np.repeat(np.array(list(sets), np.int64), [len(c) for c in cells])}

    return per_text(docs.select("text"), "text", T.StructType(long_field("cell", "node")), work)


def _meetings(cells: DataFrame) -> DataFrame:
    """``a, b, odd, met``: in how many cells, of odd or of even brackets, the first node ``a`` met
    ``b``; of equal ones, in how many it met any. Counts are parts of sums. Rows are sorted by cell, and
    a cell is a run of rows, of which only the first and the last are kept in mind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot, alone = (None, None), 0, False
        for batch in batches:
            cell, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(cell):
                continue
            more = np.concatenate([[cell[0] == last[0]], cell[1:] == cell[:-1]])
            again = more & np.concatenate([[node[0] == last[1]], node[1:] == node[:-1]])
            cell, node, more = cell[~again], node[~again], more[~again]
            if not len(cell):
                continue
            first = np.maximum.accumulate(np.where(more, -1, np.arange(len(cell))))
            pivots = np.where(first >= 0, node[first], pivot)
            second = more & np.concatenate([[alone], ~more[:-1]])
            last, pivot, alone = (cell[-1], node[-1]), pivots[-1], not more[-1]
            a = np.concatenate([pivots[more], pivots[second]])
            b = np.concatenate([node[more], pivots[second]])
            odd = np.concatenate([cell[more], cell[second]]) & 1
            rows, met = np.unique(np.column_stack([a, b, odd]), axis=0, return_counts=True)
            columns = [*(rows[:, k] for k in range(3)), met]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["a", "b", "odd", "met"]
            )

    by_cell = cells.repartition("cell").sortWithinPartitions("cell", "node")
    return by_cell.mapInArrow(run, T.StructType(long_field("a", "b", "odd", "met")))


def _regions(meetings: DataFrame) -> DataFrame:
    """``node, region`` of all nodes that meetings connect."""
    found = connected_components(meetings.where("a != b").select("a", "b"))
    return found.select("node", F.col("root").alias("region"))


class LocalJoin:
    """Joins the sets of one task. ``links`` gets (a, b) of a spanning forest of all links."""

    def __init__(self, nodes: np.ndarray, sets: list[np.ndarray], labels: np.ndarray, percent: int):
        self.nodes, self.percent = nodes, percent
        self.size = np.array([len(s) for s in sets], np.int64)
        self.start = np.cumsum(self.size) - self.size
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        self.codes = codes
        self.mark = np.zeros(int(codes.max()) + 1, bool)
        self.links: list[tuple[int, int]] = []
        # rows of one label are known to be connected
        _, first, where = np.unique(labels, return_index=True, return_inverse=True)
        self.root = first[where].tolist()

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def one(self, rows: np.ndarray) -> bool:
        first = self.find(int(rows[0]))
        return all(self.find(i) == first for i in rows.tolist())

    def distances(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        """To all rows; those linked with the pivot are joined to it."""
        own = self.codes[self.start[pivot] : self.start[pivot] + self.size[pivot]]
        self.mark[own] = True
        size = self.size[rows]
        at = np.cumsum(size) - size
        where = np.repeat(self.start[rows] - at, size) + np.arange(int(size.sum()))
        shared = np.add.reduceat(self.mark[self.codes[where]].astype(np.int64), at)
        self.mark[own] = False
        union = size + self.size[pivot] - shared
        for i in rows[linked(size, self.size[pivot], shared, self.percent)].tolist():
            a, b = self.find(pivot), self.find(i)
            if a != b:
                self.root[max(a, b)] = min(a, b)
                self.links.append((int(self.nodes[pivot]), int(self.nodes[i])))
        return 1 - shared / union

    def solve(self, rows: np.ndarray) -> None:
        width = 1 - self.percent / 100
        work = [rows]
        while work:
            rows = work.pop()
            if len(rows) < 2 or self.one(rows):
                continue
            far = [self.distances(int(rows[0]), rows)]
            pivots = [0]
            while len(pivots) < min(PIVOTS, len(rows)) and not self.one(rows):
                nearest = np.min(far, axis=0)
                nearest[pivots] = -1
                pivots.append(int(nearest.argmax()))
                far.append(self.distances(int(rows[pivots[-1]]), rows))
            table = np.array(far)
            if len(rows) <= len(pivots) or self.one(rows):
                continue
            rest = np.ones(len(rows), bool)
            rest[pivots] = False
            nearest = table.min(axis=0)
            cells = [
                rest & (d <= nearest + 2 * width + _SLACK) & (table.argmin(axis=0) >= 0) for d in table
            ]
            if sum(c.sum() for c in cells) > COPIES * len(rows):
                self._by_rows(rows, table, np.flatnonzero(rest), width)
            else:
                work += [rows[c] for c in cells]

    def _by_rows(self, rows: np.ndarray, table: np.ndarray, rest: np.ndarray, width: float) -> None:
        """Every pair that its sizes, the distances to the pivots, the links so far and the rarest
        elements leave open: linked sets share one of their rarest elements, as many as may differ
        and one more."""
        size = self.size[rows]
        sets = [self.codes[self.start[i] : self.start[i] + self.size[i]] for i in rows[rest]]
        met = np.bincount(np.concatenate(sets), minlength=len(self.mark))
        rare: list[np.ndarray] = []
        for codes in sets:
            n = len(codes)
            codes = codes[np.lexsort((codes, met[codes]))][: n - -(-self.percent * n // 100) + 1]
            rare.append(codes[met[codes] > 1])
        owner = np.repeat(np.arange(len(rest)), [len(c) for c in rare])
        flat = np.concatenate(rare)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        for k, i in enumerate(rest.tolist()):
            first = np.searchsorted(flat, rare[k], "left")
            last = np.searchsorted(flat, rare[k], "right")
            near = [owner[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            others = np.unique(np.concatenate(near)) if near else np.zeros(0, np.int64)
            others = rest[others[others > k]]
            small = np.minimum(size[others], size[i])
            others = others[100 * small >= self.percent * np.maximum(size[others], size[i])]
            gap = np.abs(table[:, others] - table[:, [i]])
            others = others[(gap <= width + _SLACK).all(axis=0)]
            own = self.find(int(rows[i]))
            others = [j for j in others.tolist() if self.find(int(rows[j])) != own]
            if others:
                self.distances(int(rows[i]), rows[others])


def _local(table: pa.Table, percent: int) -> LocalJoin | None:
    nodes = table.column("node").to_numpy()
    nodes, first = np.unique(nodes, return_index=True)
    if len(nodes) < 2:
        return None
    members = table.column("members").combine_chunks()
    sets = [np.frombuffer(members[int(k)].as_buffer(), np.uint64) for k in first]
    labels = table.column("label").to_numpy()[first]
    join = LocalJoin(nodes, sets, labels, percent)
    join.solve(np.argsort(-join.size, kind="stable"))
    return join


def _pairs(join: LocalJoin | None) -> pa.Table:
    links = join.links if join else []
    return pa.table(
        {"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())}
    )


def _links(members: DataFrame, percent: int, keys: list[str]) -> DataFrame:
    return members.groupBy(*keys).applyInArrow(
        lambda t: _pairs(_local(t, percent)), "a long, b long"
    )


def join_large(members: DataFrame, percent: int = PERCENT, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) that connect all linked members of regions of more than ``leaf`` members
    (``region, node, label, members, n``). Members of one label are known to be connected."""
    found = [members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)]
    while not members.isEmpty():
        members = cut(members, "large-regions")
        cells = cut(_voronoi(members, percent, leaf), "voronoi-cells")
        links = cells.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        found.append(links.where("a != b").distinct())
        sizes = cells.where("inside").groupBy("region", "cell").agg(F.count("*").alias("n_cell"))
        whole = members.groupBy("region").agg(F.first("n").alias("n"))
        verdict = sizes.groupBy("region").agg(
            F.max("n_cell").alias("largest"), F.sum("n_cell").alias("copies")
        )
        crowded = (F.col("copies") > COPIES * F.col("n")) | (F.col("largest") > 0.9 * F.col("n"))
        useless = verdict.join(whole, "region").where(crowded).select("region")
        useless = checked_broadcast(cut(useless, "useless-pivots"))
        labels = cells.where("linked").groupBy("region", "node").agg(F.min("pivot").alias("to"))
        labelled = cut(
            members.join(labels, ["region", "node"], "left")
            .withColumn("label", F.coalesce("to", "label"))
            .drop("to"),
            "labelled-regions",
        )
        stuck = labelled.join(useless, "region", "left_semi")
        found.append(cut(_block_pairs(stuck, percent, leaf), "block-links"))
        split = cells.where("inside").join(useless, "region", "left_anti")
        key = F.xxhash64("region", "cell").alias("next")
        placed = split.join(sizes, ["region", "cell"]).select("region", "node", key, "n_cell")
        parts = labelled.drop("n").join(placed, ["region", "node"]).select(
            F.col("next").alias("region"), "node", "label", "members", F.col("n_cell").alias("n")
        )
        parts = cut(parts, "cells")
        found.append(cut(_links(parts.where(F.col("n") <= leaf), percent, ["region"]), "cell-links"))
        members = parts.where(F.col("n") > leaf)
    links = found[0]
    for table in found[1:]:
        links = links.unionByName(table)
    return links


def _voronoi(members: DataFrame, percent: int, leaf: int) -> DataFrame:
    """``region, node, cell, pivot, linked, inside`` of the members and pivots of large regions:
    whether the pair is linked, and whether the member goes to that pivot's cell. Without sets."""
    rows = members.withColumn("blocks", F.ceil(F.col("n") / leaf).cast("int"))
    place = F.xxhash64("node", "region")
    # about four times the pivots needed, so that a region hardly ever gets none
    drawn = rows.where(
        F.pmod(place, F.lit(1 << 30)) * F.col("n") < F.lit(4 * PIVOTS * (1 << 30))
    ).withColumn("rank", F.row_number().over(Window.partitionBy("region").orderBy(place, "node")))
    chosen = drawn.where(F.col("rank") <= PIVOTS).select("region", "node", "members", "blocks")
    pivots = cut(chosen, "pivots").select(
        "region",
        "node",
        "members",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.select("region", "block", "node", "members")
    width = 1 - percent / 100

    def assign(right: pa.Table, left: pa.Table) -> pa.Table:
        nodes = left.column("node").to_numpy()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in left.column("members").combine_chunks()]
        size = np.array([len(s) for s in sets], np.int64)
        # a region without a drawn pivot is one cell, which counts as of no use
        names = right.column("node").to_numpy() if right.num_rows else np.zeros(1, np.int64)
        far, near = np.zeros((len(names), len(nodes))), np.zeros((len(names), len(nodes)), bool)
        if len(nodes) and right.num_rows:
            whole, at = np.concatenate(sets), np.cumsum(size) - size
            for k, pivot in enumerate(right.column("members").combine_chunks()):
                own = np.frombuffer(pivot.as_buffer(), np.uint64)
                spot = np.minimum(np.searchsorted(own, whole), len(own) - 1)
                shared = np.add.reduceat((own[spot] == whole).astype(np.int64), at)
                near[k] = linked(size, len(own), shared, percent)
                far[k] = 1 - shared / (size + len(own) - shared)
        inside = far <= far.min(axis=0, initial=2) + 2 * width + _SLACK
        cell, row = np.nonzero(inside | near)
        region = left.column("region")[0].as_py() if len(nodes) else 0
        return pa.table(
            {
                "region": np.full(len(row), region, np.int64),
                "node": nodes[row],
                "cell": names[cell],
                "pivot": names[cell],
                "linked": near[cell, row],
                "inside": inside[cell, row],
            }
        )

    return (
        pivots.groupBy("region", "block")
        .cogroup(dealt.groupBy("region", "block"))
        .applyInArrow(
            assign,
            "region long, node long, cell long, pivot long, linked boolean, inside boolean",
        )
    )


def _block_pairs(members: DataFrame, percent: int, leaf: int) -> DataFrame:
    """Regions that pivots do not split: every block against every block."""
    rows = members.withColumn("blocks", F.ceil(2 * F.col("n") / leaf).cast("int"))
    copied = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    copied = copied.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = copied.select(
        "region",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "node",
        "label",
        "members",
    )
    return _links(keyed, percent, ["region", "low", "high"])


def _region_members(docs: DataFrame, regions: DataFrame, slim: DataFrame, size: int) -> DataFrame:
    """The sets of the nodes in ``regions`` (node, region, even, odd: cells in which they met others)
    that met others in as many cells as any link needs, from one document of each node."""
    enough = (F.col("even") >= F.col("need_even")) | (F.col("odd") >= F.col("need_odd"))
    found = slim.join(checked_broadcast(regions), "node").where(enough)
    wanted = cut(found.groupBy("region", "node").agg(F.min("doc_id").alias("id")), "candidates")
    ids = wanted.select("id").distinct()
    regions = checked_broadcast(wanted.select("region", "node"))
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    texts = texts.join(checked_broadcast(ids), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")

    def work(part: pa.RecordBatch) -> dict:
        sets = {_node(s): s.tobytes() for s in sets_of(part.column("text"), size) if len(s)}
        return {"node": list(sets), "members": list(sets.values())}

    schema = T.StructType([*long_field("node"), T.StructField("members", T.BinaryType())])
    whole = per_text(texts.select("text"), "text", schema, work).join(regions, "node")
    return whole.select("region", "node", F.col("node").alias("label"), "members")


def _rare_cells(members: DataFrame, percent: int) -> DataFrame:
    """``cell, node``: the cells of members of regions, by the elements that are rarest in their
    region. Linked sets share one of as many as may differ and one more; passages that many
    members share are no longer what brings them together. Elements that one member alone holds
    are its rarest and meet nobody, so only their number is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column("members")]
            size = np.array([len(s) for s in sets], np.int64)
            region = mix(batch.column("region").to_numpy().astype(np.uint64))
            flat = np.concatenate([np.zeros(0, np.uint64), *sets])
            cell = mix(flat + np.repeat(region, size)).view(np.int64)
            columns = [cell, np.repeat(batch.column("node").to_numpy(), size), np.repeat(size, size)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["cell", "node", "size"]
            )

    elements = members.select("region", "node", "members").mapInArrow(
        run, T.StructType(long_field("cell", "node", "size"))
    )
    met = elements.groupBy("cell").agg(F.count("*").alias("met")).where("met > 1")
    by_node = Window.partitionBy("node")
    rank = F.dense_rank().over(by_node.orderBy("met", "cell"))
    ranked = elements.join(met, "cell").withColumn("rank", rank)
    ranked = ranked.withColumn("alone", F.col("size") - F.max("rank").over(by_node))
    prefix = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    return ranked.where(F.col("alone") + F.col("rank") <= prefix).select("cell", "node")


def jaccard_components(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, leaf: int = LEAF
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row."""
    slim = cut(set_rows(docs, size, percent), "sets")
    meetings = cut(_meetings(cell_rows(docs, size, percent)), "meetings")
    counts = meetings.groupBy(F.col("b").alias("node")).agg(
        F.sum(F.when(F.col("odd") == 0, F.col("met"))).alias("even"),
        F.sum(F.when(F.col("odd") == 1, F.col("met"))).alias("odd"),
    )
    regions = cut(_regions(meetings).join(counts, "node"), "met-regions")
    members = cut(_region_members(docs, regions, slim, size), "region-members")
    finer = cut(_regions(_meetings(_rare_cells(members, percent))), "finer-meetings")
    sizes = finer.groupBy("region").agg(F.count("*").alias("n"))
    finer = checked_broadcast(cut(finer.join(sizes, "region"), "regions"))
    parts = members.drop("region").join(finer, "node")
    links = cut(_links(parts.where(F.col("n") <= leaf), percent, ["region"]), "leaf-links")
    large = parts.where(F.col("n") > leaf)
    if not finer.where(F.col("n") > leaf).isEmpty():
        links = links.unionByName(join_large(large, percent, leaf))
    roots = checked_broadcast(cut(connected_components(links), "components"))
    rooted = slim.join(roots, "node", "left")
    rooted = cut(rooted.withColumn("root", F.coalesce("root", "node")), "rooted")
    least = rooted.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("n")
    )
    # most documents are alone and need not be asked about
    shared = checked_broadcast(cut(least.where("n > 1").drop("n"), "shared-components"))
    return rooted.join(shared, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows that stay when one document of each component is kept: the one of the smallest id.
    Other rows of an id that goes go too; rows without an id stay."""
    found = jaccard_components(docs, size, percent).select("doc_id", "component_id")
    dropped = cut(found.where("doc_id != component_id").select("doc_id").distinct(), "dropped")
    return docs.join(checked_broadcast(dropped), "doc_id", "left_anti").select(docs.columns)
