"""Vector codes: the dual descent against all distances, and whole runs against plain Lloyd."""

import math
from collections import defaultdict

import numpy as np
import pytest

from ledgerline.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code int, other string"


@pytest.mark.parametrize(
    ("n", "k", "w", "high"),
    [(1, 1, 1, 5), (5, 3, 2, 4), (100, 5, 3, 6), (2048, 256, 16, 300), (900, 256, 16, 1), (700, 200, 4, 10**8)],
)
def test_descent_finds_the_nearest_entry(n, k, w, high):
    rng = np.random.default_rng(n)
    x, e = rng.integers(-high, high + 1, (n, w)), rng.integers(-high, high + 1, (k, w))
    e[k // 2 :] = e[: k - k // 2]  # ties
    ordered = x[vc.Tree(n, vc.LEAF).order(x)]
    sums, counts = np.zeros((k, w), np.int64), np.zeros(k, np.int64)
    found = vc.nearest(vc.Points.of(ordered), vc.Book(e), sums, counts)
    expected = ((ordered[:, None] - e) ** 2).sum(axis=2).argmin(axis=1)
    assert (found == expected).all()
    totals = np.zeros((k, w), np.int64)
    np.add.at(totals, expected, ordered)
    assert (totals == sums).all() and (counts == np.bincount(expected, minlength=k)).all()


def test_far_groups_are_assigned_by_their_sums(monkeypatch):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-5, 6, (256, 4)) + 1000 * c for c in range(4)])
    e = np.arange(4)[:, None] * 1000 * np.ones((1, 4), np.int64)
    ordered = x[vc.Tree(len(x), vc.LEAF).order(x)]
    monkeypatch.setattr(vc, "_compare", None)  # no vector is looked at
    sums, counts = np.zeros((4, 4), np.int64), np.zeros(4, np.int64)
    vc.nearest(vc.Points.of(ordered), vc.Book(e.astype(np.int64)), sums, counts)
    assert counts.tolist() == [256] * 4 and (sums.sum(axis=0) == x.sum(axis=0)).all()


def plain(rows: list[tuple], parts: int, entries: int, rounds: int):
    """Lloyd in plain integers."""
    kept = [
        r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])
    ]
    width = -(-max((len(r[1]) for r in kept), default=1) // parts) * parts
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(1024 * float(np.float32(v))) for v in r[1]] for r in kept]
    whole = [v + [0] * (width - len(v)) for v in whole]
    w = width // parts
    out = [["" , 0] for _ in kept]
    books = []
    for p in range(parts):
        x = [v[p * w : (p + 1) * w] for v in whole]
        book = x[:entries]

        def near(v, book):
            return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            groups = defaultdict(list)
            for v in x:
                groups[near(v, book)[1]].append(v)
            book = [
                [sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e
                for k, e in enumerate(book)
            ]
        for o, v in zip(out, x, strict=True):
            d, k = near(v, book)
            o[0] += f"{k:02x}"
            o[1] += d
        books.append(book)
    return [(r[0], r[2], *o) for r, o in zip(kept, out, strict=True)], books


def rows(n: int = 300, dims: int = 10) -> list[tuple]:
    rng = np.random.default_rng(3)
    x = rng.normal(0, 0.2, (n, dims)).astype(np.float32)
    made = [(k, x[k].tolist(), int(k % 3) if k % 7 else None, 9, "z") for k in range(n)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [nan] * dims, [inf] + [0.0] * 9, [-inf], [None, 1.0], [0.5], x[0].tolist(), [1.0] * 12]
    made += [(n + k, v, 1, 9, None) for k, v in enumerate(odd)]
    made += [made[4], made[4], (None, x[5].tolist(), None, None, None), (7, x[8].tolist(), 1, 1, "again")]
    return made


@pytest.mark.parametrize(("entries", "rounds"), [(16, 3), (256, 2)])
def test_codes_against_plain_lloyd(spark, entries, rounds, monkeypatch):
    monkeypatch.setattr(vc, "SLICE", 64)
    data = rows()
    table = spark.createDataFrame(data, SCHEMA).repartition(3)
    expected, books = plain(data, 4, entries, rounds)
    codes, found = vc.vector_codes(table, entries=entries, rounds=rounds)
    assert codes.columns == ["vec_id", "label", "other", "code", "error"]
    assert found.tolist() == books
    key = lambda r: tuple((v is None, v) for v in r)
    got = [(r["vec_id"], r["label"], r["code"], r["error"]) for r in codes.collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    summed = vc.with_label_errors(vc.cut(codes, "codes"))
    by_label = defaultdict(int)
    for r in expected:
        by_label[r[1]] += r[3]
    assert {(r["label"], r["label_error"]) for r in summed.collect()} == set(by_label.items())


def test_huge_components_fit(spark):
    table = spark.createDataFrame([(k, [1e300 * (-1) ** k, 0.5, -0.5, 0.0]) for k in range(4)], "vec_id long, embedding array<double>")
    codes, books = vc.vector_codes(table, entries=2)
    assert {r["error"] for r in codes.collect()} == {0}
    assert books[0].ravel().tolist() == [vc._limit(4), -vc._limit(4)]


def test_no_vectors(spark):
    for data in ([], [(1, None, 1, 1, "x")]):
        codes, _ = vc.vector_codes(spark.createDataFrame(data, SCHEMA))
        assert vc.with_label_errors(vc.cut(codes, "codes")).count() == 0
