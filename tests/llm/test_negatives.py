import numpy as np
import pytest

from longspan.llm import negatives
from test_topk import SCHEMA, odd_rows, product, whole


def plain(rows, every=50):
    rows, out = [r for r in whole(rows, 256) if r[2] is not None], []
    for q, (i, v, label) in enumerate(rows):
        if i is None or i % every:
            continue
        order = sorted((-product(v, w), j is None, j or 0, c) for c, (j, w, _) in enumerate(rows) if c != q)
        same = [x for x in order if rows[x[3]][2] == label][:5]
        other = [x for x in order if rows[x[3]][2] != label]
        for p in same:
            good = [n for n in other if 50 * -p[0] <= 100 * -n[0] <= 95 * -p[0]][:3]
            out += [(i, None if p[1] else p[2], r + 1, None if n[1] else n[2], -p[0], -n[0]) for r, n in enumerate(good)]
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"strip_rows": 60, "codes": 4, "sample_rows": 50}])
def test_equals_plain_search(spark, options):
    rows = odd_rows()
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), every=10, **options)
    want = plain(rows, 10)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and len(want) > 100
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0], "p", 1, 1), (1, [0.5, 0.0], "p", 1, 1), (2, [0.3, 0.0], "p", 1, 0), (3, [0.3, 0.0], "p", 1, None)]
    assert sorted(map(tuple, negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == plain(rows)
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sums_come_in_descending_order_and_once():
    a, b = np.sort(np.random.default_rng(1).normal(size=9))[::-1], np.sort(np.random.default_rng(2).normal(size=6))[::-1]
    got = list(negatives.descending_sums(a, b))
    assert [x[0] for x in got] == sorted((x[0] for x in got), reverse=True)
    assert sorted(x[1:] for x in got) == [(i, j) for i in range(9) for j in range(6)]
    assert list(negatives.descending_sums(a, b[:0])) == []


def test_bounds_hold_for_every_row():
    random = np.random.default_rng(4)
    v = np.floor(random.normal(size=(600, 7)) * 200)
    books = negatives.fit(v[:80], codes=6)
    halves = books.halves(v)
    codes, far = zip(*(negatives.nearest(h, c) for h, c in zip(halves, books.centroids)))
    books.radius = tuple(np.array([d[c == k].max(initial=0) for k in range(6)]) for c, d in zip(codes, far))
    first, second = books.bounds(v[:50])
    assert (first[:, codes[0]] + second[:, codes[1]] >= v[:50] @ v.T).all()


def test_the_visit_ends_before_all_cells():
    """On clustered rows most rows are never multiplied."""
    from longspan.llm.vectors import Rows
    random = np.random.default_rng(8)
    centre = random.normal(size=(40, 8)) * 300
    v = np.floor(centre[random.integers(0, 40, 4000)] + random.normal(size=(4000, 8)) * 5)
    books = negatives.fit(v[:500], codes=16)
    codes, far = zip(*(negatives.nearest(h, c) for h, c in zip(books.halves(v), books.centroids)))
    books.radius = tuple(np.array([d[c == k].max(initial=0) for k in range(16)]) for c, d in zip(codes, far))
    label = np.zeros(4000, np.int64)
    order = np.lexsort((label, codes[1], codes[0]))
    rows = Rows({"place": order, "id": order, "known": label + 1, "label": label, "first": codes[0][order], "second": codes[1][order]}, v[order])
    strip, seen = negatives.Strip(rows, books), []
    count, negatives.products = negatives.products, lambda a, b: seen.append(len(b)) or count(a, b)
    try:
        wanted = [negatives.Wanted(negatives.LOWEST, negatives.HIGHEST, 5)]
        bounds = books.bounds(v[:1])
        strip.visit(v[0], 0, 0, True, wanted, (bounds[0][0], bounds[1][0]))
    finally:
        negatives.products = count
    score = v @ v[0]
    score[0] = -np.inf
    assert wanted[0].score.tolist() == np.sort(score)[::-1][:5].astype(int).tolist()
    assert sum(seen) < 2000
