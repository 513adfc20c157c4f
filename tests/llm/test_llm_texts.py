"""Operators on texts against plain Python, on the odd table and the smallest test tables."""

import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from conftest import TESTDATA  # noqa: E402
from odd import DOCUMENTS, documents, words  # noqa: E402

from ledgerline.llm import (  # noqa: E402
    html_text, jaccard, packing, pfor, quality_classifier, quality_rules, toxicity,
)
from ledgerline.llm.statistics import FEATURES, features  # noqa: E402
from ledgerline.llm.tokens import Encoder, vocabulary_path  # noqa: E402
from ledgerline.llm.words import Words  # noqa: E402
from ledgerline.llm.arrow import text_bytes  # noqa: E402


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(documents(), DOCUMENTS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary_path())
    return lambda text: model.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_and_windows():
    texts = ["", "a b  a", None, " x\ty\n", "é ñandú a", "  ", "z", "a\x0bb\x0cc\x1cd"]
    data, bounds = text_bytes(pa.array(texts))
    found = Words(data, bounds)
    split = [[] for _ in texts]
    for a, b, k in zip(found.start, found.end, found.doc, strict=True):
        split[k].append(bytes(data[a:b]).decode())
    assert split == [words(t) for t in texts]
    grams, at = found.grams(3)
    assert [found.doc[k] for k in at] == [1, 4, 7] and len(set(grams.tolist())) == 3


def test_words_are_encoded_as_in_whole_texts(whole):
    odd_texts = [
        "ΑΣ ΟΔΟΣ", "á ́b", "x y z's don't", "'s 've", "a\u0085b c", "İstanbul ẞ ß", "１２３ ①", "가 가",
        "<|endoftext|> a<|startoftext|>b", "🙂👍🏽 ok", " ", "", None, "it 's", "\x1c a\x1db", "A.B,C!!", "ÀÉ.",
    ]
    texts = [*odd_texts, *(row[1] for row in documents())]
    encoder = Encoder(vocabulary_path(), remembered=500)
    for _ in range(2):
        ids, bounds = encoder.encode(pa.array(texts), 2)
        for k, text in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == [*whole(text), 2]


@pytest.mark.parametrize("top", [1, 2, 50_000, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, max(top // 1000, 1) + 1, n, dtype=np.uint32)
    ids[rng.random(n) < 0.05] = top
    data, start = pfor.encode_blocks(ids)
    assert (pfor.decode_blocks(data, start)[:n] == ids).all()


def test_token_file(spark, odd, none, tmp_path, whole):
    path = str(tmp_path / "tokens")
    pfor.write_tokens(odd, path)
    rows = sorted(pfor.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    given = sorted(documents(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in rows] == [r[0] for r in given]
    at = 0
    for row in rows:
        assert row["start"] == at and row["n_tokens"] == len(row["ids"])
        assert row["ids_crc32"] == crc(row["ids"])
        at += row["n_tokens"]
    expected = Counter((r[0], *whole(r[1]), 2) for r in given)
    assert Counter((r["doc_id"], *r["ids"]) for r in rows) == expected
    segment = pfor.Segment(bytes(spark.read.parquet(path).first()["data"]))
    assert (segment.block(0) == segment.ids()[:128]).all()
    pfor.write_tokens(none, str(tmp_path / "none"))
    assert pfor.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_packing(odd, none, whole):
    rows = packing.pack_documents(odd, lot_size=40).collect()
    expected = Counter()
    for row in documents():
        ids = [*whole(row[1]), 0]
        for k in range(0, len(ids), 2048):
            piece = ids[k : k + 2048]
            expected[row[0], k // 2048, k, len(piece), crc(piece)] += 1
    assert Counter((r[0], r[1], r[2], r[3], r[4]) for r in rows) == expected
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // 2048) + 2
    assert packing.pack_documents(none).count() == 0


def test_crossover_keeps_every_piece():
    import random

    rng = random.Random(1)
    lengths = [rng.randint(1, 100) for _ in range(300)]
    one = packing.best_fit(lengths, list(range(300)), [], 100)
    two = packing.best_fit(lengths, list(range(299, -1, -1)), [], 100)
    for child in (packing.crossover(lengths, one, two, 100, rng), packing.mutate(lengths, one, 100, rng)):
        assert sorted(i for b in child for i in b) == list(range(300))
        assert all(sum(lengths[i] for i in b) <= 100 for b in child)
    best = packing.evolve(lengths, 100, [two], rng)
    assert len(best) <= min(len(one), len(two))


def base_counts(text):
    found = words(text)
    windows = [tuple(found[k : k + 3]) for k in range(len(found) - 2)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, odd, none):
    extra = [(900, "a b c a b c # |\nx y\nx y\n\nx y ", None, None, None, None, None)]
    table = odd.unionByName(spark.createDataFrame(extra, DOCUMENTS))
    ratios = quality_rules.log_ratios(table, table.where("doc_id % 2 = 0").select("doc_id"))
    rows = quality_rules.judge(table, ratios).collect()
    assert len(rows) == len(documents()) + 1
    for r in rows:
        got = [r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        assert got == list(base_counts(r["text"]))
        failed = got[0] < 50 or 100 * got[4] > 50 * got[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["llr"] >= quality_rules.THRESHOLD)
    assert quality_rules.judge(none, quality_rules.log_ratios(none, none)).count() == 0


def test_window_counts_cover_all_texts(spark):
    table = spark.createDataFrame([("a b a", True), ("a b", False), (None, False)], "text string, trusted boolean")
    sums = quality_rules.window_counts(table).agg(F.sum("target"), F.sum("corpus")).first()
    assert tuple(sums) == (5, 8)


def test_classifiers_on_held_out_rows(spark, odd, none):
    docs = spark.read.parquet(f"{TESTDATA.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA.replace('0.001', '0.01')}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    for column, work in (("quality", quality_classifier), ("toxic", toxicity)):
        known = labels.select("doc_id", F.col(column).alias("label"))
        seen = known.where(fold != 0)
        if work is quality_classifier:
            model = work.fit(work.text_statistics(docs), seen)
        else:
            model = work.fit(docs, seen)
        scored = work.score_documents(docs, model)
        held = scored.join(known, "doc_id").where(fold == 0).select("score", "label").toPandas()
        assert held["score"].between(0, 1).all()
        one, zero = (held.loc[held["label"] == k, "score"].to_numpy() for k in (1, 0))
        wins = (one[:, None] > zero).mean() + 0.5 * (one[:, None] == zero).mean()
        assert wins > 0.8
        made = work.score_documents(odd, model)
        assert made.columns.count("score") == 1 and dict(made.dtypes)["score"] == "double"
        assert made.where("score between 0 and 1").count() == len(documents())
        assert work.score_documents(none, model).count() == 0
    empty = labels.select("doc_id", F.col("toxic").alias("label")).limit(0)
    assert toxicity.fit(odd, empty).constant == 0.0
    unfitted = quality_classifier.fit(quality_classifier.text_statistics(odd), empty)
    assert quality_classifier.score_documents(odd, unfitted).agg(F.min("score")).first()[0] >= 0.4


def test_features_have_a_value_for_every_text():
    x = features(pa.array([row[1] for row in documents()]))
    assert x.shape == (len(documents()), len(FEATURES)) and np.isfinite(x).all()


def test_pool_adjacent():
    out = quality_classifier.pool_adjacent(np.array([1.0, 0.0, 2.0, 1.0]), np.ones(4))
    assert out.tolist() == [0.5, 0.5, 1.5, 1.5]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav>
<div class="notice">Read this, please.</div><article><h1>A &amp; B</h1><p>One,  two.<br>Three<p><b>Four
 five</b> &copy; six.</p><ul><li>x<li>y</ul><form>Name</form><aside>More, here.</aside></article>
<section id="comments"><p>I disagree, strongly, and at length, with all of this.</p></section><footer>End.</footer>"""


@pytest.mark.parametrize(
    "page, text",
    [
        (PAGE, "A & B\nOne, two. Three\nFour five © six.\nx\ny"),
        ("<div id=menu>A</div><div class=story><h2>T</h2><p>Long text, here. And more.</div>", "T\nLong text, here. And more."),
        ("plain &lt;text&gt; &am", "plain <text> &am"),
        ("<article><p>cut off<p", "cut off"),
        ("<!-- x --><script>var a='</p>';", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "opened, closed",
    [
        ('<body class="has-sidebar">', ""),
        ('<html class="no-cookie"><body id="page-header">', ""),
        ('<main class="with-ads">', "</main>"),
        ('<article class="post comments-open">', "</article>"),
        ('<body><div class="page-with-sidebar">', "</div>"),
        ('<body><div class="widget">', "</div>"),
    ],
)
def test_names_of_what_holds_the_page_are_no_asides(opened, closed):
    story = "<h1>Title</h1><p>A long text, here. And some more of it.</p><p>The end, at last.</p>"
    aside = '<div class="sidebar"><p>Other, things.</p></div>'
    expected = "Title\nA long text, here. And some more of it.\nThe end, at last."
    assert html_text.main_text(opened + story + aside + closed) == expected


def test_comments_that_outweigh_the_text_stay_asides():
    page = "<div class=story><p>A short text, here.</p></div><div id=comments><p>I disagree, strongly, with it all.</p></div>"
    assert html_text.main_text(page) == "A short text, here."


LONG = "A long text, here. And some more of it, and more, and more. The end, at last, of a long text."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<nav>N</nav><div id=content><h1>Title</h1><div class=body><p>{LONG}</p></div></div>", f"Title\n{LONG}"),
        (f"<nav>N</nav><div><div><p>Lead.</div><h2><a href=/>T</a></h2><div><div><p>{LONG}</div></div></div>", f"Lead.\nT\n{LONG}"),
        (f"<div><div><p><a href=/>Home</a></div><div class=body><p>{LONG}</div></div>", LONG),
        (f"<article><h1><a href=/>T</a></h1><p>{LONG}</p><ul><li><a href=/>x</a></ul><nav>N</nav></article>", f"T\n{LONG}\nx"),
        (f"<nav>N</nav><div><h2><a href=/>T</a></h2><p>{LONG}</p></div>", f"T\n{LONG}"),
    ],
)
def test_headlines_and_links_of_the_text_stay(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<main><article><p>{LONG}</article><div class=more-stories><h2>More stories</h2><p>One, teaser.<p>Two, teaser.</div></main>", LONG),
        (f"<article class=post><p>{LONG}</article><article><p>I disagree, with it.</article><article><p>Me too.</article>", LONG),
        (f"<article class=post><p>{LONG}<article class=c><p>I disagree, with it.</article></article>", LONG),
        (f"<main><h1>T</h1><article><p>{LONG}</article></main>", f"T\n{LONG}"),
        (f"<main><div><h2>Stories</h2><p>x</div><article><p>{LONG}</article></main>", LONG),
        ("<main><article><p>A first part, here.</article><article><p>A second part, too.</article></main>", "A first part, here.\nA second part, too."),
        (f"<article><p hidden>Not, shown.</p><p>{LONG}</p><div style='color:red; display: none'><p>Nor, this.</p></div></article>", LONG),
        (f"<div><div aria-hidden=true><p>Not, shown, at all, here.</p></div><p>{LONG}</p><p data-hidden=x>Shown, it is.</p></div>", f"{LONG}\nShown, it is."),
        (f"<main><p>{LONG}</p><p class=hidden-gem>A gem, here.</p></main>", f"{LONG}\nA gem, here."),
    ],
)
def test_the_article_and_nothing_beside_it(page, text):
    assert html_text.main_text(page) == text


def test_pages(spark):
    schema = "page_id long, url string, html string, text int"
    pages = spark.createDataFrame([(1, "u", PAGE, 5), (1, "u", PAGE, 5), (None, None, None, None)], schema)
    rows = html_text.extract_pages(pages).collect()
    assert len(rows) == 3 and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html_text.extract_pages(pages.limit(0)).count() == 0
    whole = spark.read.parquet(f"{TESTDATA}/pages.parquet")
    assert html_text.extract_pages(whole).where("n_chars > 0").count() == whole.count()


def components(rows, percent=85):
    sets = []
    for _, text in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[k : k + 4]) for k in range(max(len(w) - 3, 1))} if w else set())
    root = list(range(len(rows)))
    for a, one in enumerate(sets):
        for b in range(a):
            both = len(one & sets[b])
            if one and sets[b] and 100 * both >= percent * len(one | sets[b]):
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return Counter((i, len(s), least.get(r)) for (i, _), s, r in zip(rows, sets, root, strict=True))


def near_copies(seed=5):
    import random

    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out, shared = [], rng.choices(vocabulary, k=25)
    for base in range(6):
        text = rng.choices(vocabulary, k=rng.choice([12, 40, 90]))
        for _ in range(25):
            copy = list(text)
            for _ in range(rng.randint(0, len(text) // 10)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append((len(out) + 100 * base, " ".join(copy + (shared if rng.random() < 0.3 else []))))
    return out


@pytest.mark.parametrize("leaf", [4, 20, 2048])
def test_near_copies_against_all_pairs(spark, leaf):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.jaccard_components(docs, leaf=leaf).collect()
    assert Counter(map(tuple, found)) == components(rows)


def test_odd_documents_against_all_pairs(odd, none):
    rows = [(r[0], r[1]) for r in documents()]
    assert Counter(map(tuple, jaccard.jaccard_components(odd).collect())) == components(rows)
    assert jaccard.jaccard_components(none).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in components(rows)} | {None}


def test_blocks_of_regions_lose_no_link(spark):
    rows = near_copies(8)
    sets = jaccard.sets_of(pa.array([t for _, t in rows]))
    nodes = [jaccard._node(s) for s in sets]
    table = [(1, n, n, bytearray(s.tobytes()), len(set(nodes))) for n, s in dict(zip(nodes, sets)).items()]
    members = spark.createDataFrame(table, "region long, node long, label long, members binary, n long")
    for links in (jaccard.join_large(members, leaf=16), jaccard._block_pairs(members, 85, 16)):
        root = {n: n for n in nodes}
        for a, b in links.collect():
            old, new = root[a], root[b]
            root = {k: new if r == old else r for k, r in root.items()}
        groups = Counter(root[n] for n in nodes)
        expected = Counter(c for _, _, c in components(rows).elements())
        assert sorted(groups.values()) == sorted(expected.values())


def test_linked_sets_meet_in_as_many_cells_as_needed():
    rng = np.random.default_rng(5)
    for n in [*range(1, 40), 97, 149, 150, 151, 1000, 7000]:
        for _ in range(10):
            union = np.unique(rng.integers(0, 2**64, n, np.uint64))
            # as far apart as a link allows, and the difference dealt to both sides at random
            apart = len(union) * 15 // 100
            where = rng.choice(len(union), apart, replace=False)
            left = rng.random(apart) < rng.choice([0, 0.5, 1])
            a, b = np.delete(union, where[left]), np.delete(union, where[~left])
            met = np.intersect1d(jaccard.cells_of(a), jaccard.cells_of(b))
            for members in (a, b):
                need = jaccard.needed(members)
                assert any(k is not None and (met & 1 == odd).sum() >= k for odd, k in enumerate(need))


def test_an_island_with_a_best_solution_does_not_pack_again(monkeypatch):
    """A given solution that meets the lower bound is the answer; nothing is packed for it once more."""
    import random

    lengths, calls = [60, 40, 70, 30], []
    fit = packing.best_fit
    monkeypatch.setattr(packing, "best_fit", lambda *a: calls.append(1) or fit(*a))
    seed = [[0, 1], [2, 3]]
    assert packing.evolve(lengths, 100, [seed, seed], random.Random(1)) == seed and not calls
    assert len(packing.evolve(lengths, 100, [[[0], [1], [2], [3]]], random.Random(1))) == 2 and calls
