"""Sharding, mixing, search, the pipeline and the queries."""

import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from conftest import TESTDATA  # noqa: E402
from odd import DOCUMENTS, documents, words  # noqa: E402

import corpus_pipeline  # noqa: E402
from ledgerline.llm import components, hilbert, knn, mixing  # noqa: E402
from ledgerline.llm.components import connected_components  # noqa: E402
from ledgerline.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(documents(), DOCUMENTS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


def test_curve_visits_neighbours(spark):
    cells = spark.range(512).select(
        *(F.pmod(F.floor(F.col("id") / 8**k), F.lit(8)).cast("int").alias(c) for k, c in enumerate("abc"))
    )
    index = hilbert.hilbert_index([F.col(c) for c in "abc"], 3).alias("h")
    rows = sorted(cells.select(index, "a", "b", "c").collect())
    assert [r[0] for r in rows] == list(range(512))
    steps = np.abs(np.diff(np.array([r[1:] for r in rows]), axis=0)).sum(axis=1)
    assert (steps == 1).all()


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards(odd, none, law):
    rows = hilbert.hilbert_shards(odd, 4, law=law).collect()
    raw = sorted((r[0] is None, r[0] or 0, (r[1] or "").encode()) for r in documents())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text_crc32"], r["size"]) for r in rows) == sorted(
        (a, b, zlib.crc32(t), len(t) + 1) for a, b, t in raw
    )
    shards: dict = {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r)
    for members in shards.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    if law == "rows":
        counts = [len(m) for m in shards.values()]
        assert max(counts) - min(counts) <= 1 and len(counts) == 4
    else:
        total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
        assert all(sum(r["size"] for r in m) <= total / 4 + largest for m in shards.values())
    curve = [[r["curve"] for r in shards[s]] for s in sorted(shards)]
    assert all(max(a) <= min(b) for a, b in zip(curve, curve[1:]))
    assert hilbert.hilbert_shards(none).count() == 0


@pytest.mark.parametrize("hot_groups", [1, 100_000])
def test_equal_texts_share_a_shard(spark, monkeypatch, hot_groups):
    monkeypatch.setattr(hilbert, "HOT_GROUPS", hot_groups)
    texts = [f"text {k % 40 if k % 3 else k} " + "x" * (k % 7) for k in range(600)]
    rows = [(k, t, "en" if k % 2 else "de", f"s{k % 5}") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    made = hilbert.hilbert_shards(docs, 8).collect()
    assert len(made) == 600
    shards: dict = {}
    for r in made:
        shards.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())
    sizes = np.bincount([r["shard"] for r in made], [r["size"] for r in made], 8)
    largest = max(texts.count(t) * (len(t) + 1) for t in shards)
    assert abs(sizes - sizes.mean()).max() <= largest
    for shard in range(8):
        assert sorted(r["slot"] for r in made if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in made)))


def test_plan_of_shards_runs_no_python(odd, capsys):
    hilbert.hilbert_shards(odd).explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Arrow", "Pandas"))


def test_targets_share_all_words_by_weight(spark):
    sizes = {"a": 1000, "b": 10, "c": 400, "d": 5, None: 85}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(table).collect()}
    weight = dict(zip([*"abcd", None], [1, 2, 3, 1, 2], strict=True))
    target, capped = {}, set()
    while True:  # cap, reshare the excess, until none is above
        free = [s for s in sizes if s not in capped]
        rest = 1500 - sum(3 * sizes[s] for s in capped)
        target = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    target |= {s: 3.0 * sizes[s] for s in capped}
    assert found == pytest.approx(target)


def test_mix(odd, none):
    rows = mixing.mix(odd, block=8).collect()
    assert sorted(r["size"] for r in rows) == sorted(len(words(r[1])) for r in documents())
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    sources: dict = {}
    for r in rows:
        s = sources.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        s[0] += r["taken"]
        s[1] += r["size"]
    for taken, size, target, source_size in sources.values():
        assert size == source_size and abs(taken - target) <= max(32, 0.02 * target)
    again = mixing.mix(odd, block=8).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    texts = mixing.mixed_documents(odd, block=8)
    assert texts.columns == odd.columns
    given = {words(r[1])[0]: None for r in documents() if words(r[1])}
    made = texts.collect()
    assert sum(len(words(r["text"])) for r in made) == sum(r["taken"] for r in rows)
    assert all(words(r["text"])[0] in given and r["n_chars"] == len(r["text"]) for r in made)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_small_sources_meet_their_targets(spark):
    rows = [(k, "w " * n, source) for k, (n, source) in enumerate(
        [(33, "a"), (5, "b"), (1, None), (2, "c"), (0, "d"), *((40, "e") for _ in range(100)), (20, "f"), (13, "f")]
    )]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs).collect()
    taken: dict = {}
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        have = taken.setdefault(r["source"], [0, r["target"]])
        have[0] += r["taken"]
    assert all(abs(n - target) <= 0.5 for n, target in taken.values()), taken
    made = mixing.mixed_documents(docs).collect()
    for source, (n, _) in taken.items():
        assert sum(len(words(r["text"])) for r in made if r["source"] == source) == n


def test_every_slot_takes_the_next_block_of_its_source(spark):
    plan = spark.createDataFrame(
        [("a", 33, 99.0), ("b", 5, 15.0), ("c", 4000, 3924.0), (None, 70, 45.2)],
        "source string, source_size long, target double",
    )
    slots = mixing.schedule(plan).orderBy("slot").collect()
    assert len({r["slot"] for r in slots}) == len(slots)
    for key, size, target in (("=a", 33, 99), ("=b", 5, 15), ("=c", 4000, 3924), ("", 70, 45)):
        mine = [r for r in slots if r["key"] == key]
        place = 0
        for r in mine:
            assert (r["pass"], r["first"]) == divmod(place, size) and 0 < r["words"] <= 32
            place += r["words"]
        assert place == target
    # low discrepancy: the large source is spread evenly
    at = np.array([k for k, r in enumerate(slots) if r["key"] == "=c"])
    assert np.diff(at).max() <= 4


def brute(rows, k):
    good = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = set()
    for i, q in good:
        if i % 5 == 0:
            best: dict = {}
            for j, v in good:
                if j != i:
                    score = sum(a * b for a, b in zip(q, v))
                    best[j] = max(best.get(j, score), score)
            for rank, (score, j) in enumerate(sorted((-s, j) for j, s in best.items())[:k]):
                out.add((i, rank + 1, j, -score))
    return out


@pytest.mark.parametrize("parts", [{}, {"n_pivots": 4, "group_queries": 3, "slice_rows": 20}])
def test_search_against_all_pairs(spark, parts):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=6).round(2).tolist()) for k in range(90)]
    rows += [(k, [0.5] * 6) for k in range(100, 130)]  # ties
    rows += [(200, None), (205, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (210, [float("nan")] * 6), (None, [1.0] * 6)]
    rows += [(215, [1.0]), (220, []), (7, [3.0] * 6), (300, [1e9] * 6)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    found = knn.top_k(table, F.expr("vec_id % 5 = 0"), 5, **parts)
    unique = {r for r in map(tuple, found.collect())}
    padded = [(i, None if v is None else v + [0.0] * (6 - len(v))) for i, v in rows]
    assert unique == brute(padded, 5)
    assert knn.top_k(table.limit(0), F.expr("vec_id % 5 = 0")).count() == 0


@pytest.mark.parametrize("parts", [{}, {"n_pivots": 4, "group_queries": 3, "slice_rows": 20}])
def test_search_among_repeated_ids(spark, parts):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(40, 4))
    points = (5 * points / np.sqrt((points**2).sum(axis=1))[:, None]).round(2).tolist()
    rows = list(enumerate(points))
    for k in range(0, 40, 5):
        rows += [(k, points[k])] * 8  # a query's own
        rows += [(100 + k, points[k])] * 8
    rows += [(301, [1.0, 2.0, 3.0, 2.0])] * 200
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = knn.top_k(table, F.expr("vec_id % 5 = 0"), 5, **parts)
    assert {r for r in map(tuple, found.collect())} == brute(rows, 5)


def test_bounds_rest_on_different_ids(spark):
    rows = [(0, 0.5, 7), (0, 0.1, 7), (0, 0.1, 7), (0, 0.2, 9), (0, 0.3, 8), (1, 0.4, 7)]
    data = spark.createDataFrame(rows, "cell long, r double, vec_id long")
    assert knn._smallest(data, 2) == {0: [(0.1, 7), (0.2, 9)], 1: [(0.4, 7)]}


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (20, 21), (5, 5)] + [(100 + k, 101 + k) for k in range(40)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {found[k] for k in (1, 2, 3)} == {1} and {found[k] for k in (7, 8, 9)} == {7}
    assert {found[100 + k] for k in range(41)} == {100}


@pytest.mark.parametrize("hubs", [1, 20, 100_000])
def test_components_with_hubs(spark, monkeypatch, hubs):
    monkeypatch.setattr(components, "HUBS", hubs)
    rng = np.random.default_rng(hubs)
    links = [(0, k) for k in range(1, 200)] + [(500, k) for k in range(300, 400)] + [(199, 1000), (1000, 1001)]
    links += [tuple(int(x) for x in rng.integers(2000, 2200, 2)) for _ in range(120)]
    parent = {n: n for link in links for n in link}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    found = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: root(n) for n in linked}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS FROM '{TESTDATA}/{table}.parquet'")
    expected = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    found = QUERIES[name](spark, TESTDATA).select(names).collect()
    assert sorted(map(tuple, found)) == sorted(expected.fetchall())


CONTRACT = {
    "op1_token_blocks": "doc_id start n_tokens ids_crc32",
    "op2_quality_classifier": "doc_id held_out score predicted",
    "op3_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op6_html_text": "page_id url text n_chars",
    "op7_hilbert_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_toxicity": "doc_id held_out score predicted",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query_returns_its_columns(spark, name):
    df = QUERIES[name](spark, TESTDATA)
    assert set(CONTRACT[name].split()) <= set(df.columns)
    table = "pages" if "html" in name else "documents"
    assert df.count() >= spark.read.parquet(f"{TESTDATA}/{table}.parquet").count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    ids = {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, TESTDATA)
        assert made.columns == docs.columns
        kept = {r[0] for r in made.select("doc_id").collect()}
        assert kept and kept <= ids, name
        docs, ids = made, kept
    packed = corpus_pipeline.run(spark, TESTDATA).collect()
    assert {r["doc_id"] for r in packed} == ids


def test_near_duplicates_of_the_pipeline_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    fresh = iter(f"w{k}" for k in rng.permutation(100_000))
    rows = []

    def add(text):
        rows.append((len(rows), " ".join(text), "en", "s", 1, "x", 7))

    for _ in range(4):
        text = [next(fresh) for _ in range(200)]
        add(text)
        # by shingles of five words: 0.845, 0.831, 0.813, 0.8, and below 0.8
        for more in rng.choice([36, 40, 45, 49, 50], 3, replace=False):
            add(text + [next(fresh) for _ in range(more)])
        for changed in (4, 5):
            copy = list(text)
            for at in range(changed):
                copy[20 + 30 * at] = next(fresh)
            add(copy)
    for text in ("a b c d", "a b c d", "a b c e", "a b c d e"):
        add(text.split())
    sets = []
    for row in rows:
        w = words(row[1])
        sets.append({tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))})
    least = list(range(len(rows)))
    between = 0
    for a in range(len(rows)):
        for b in range(a):
            alike = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            between += 0.8 <= alike < 0.85
            if alike >= 0.8:
                old, new = max(least[a], least[b]), min(least[a], least[b])
                least = [new if x == old else x for x in least]
    assert between >= 8
    docs = spark.createDataFrame(rows, DOCUMENTS)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, TESTDATA)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least))
