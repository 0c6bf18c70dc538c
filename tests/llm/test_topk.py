import numpy as np
import pytest

from longspan.llm import topk, vectors

SCHEMA = "vec_id bigint, embedding array<float>, place string, v int, label int"


def odd_rows(seed=3, n=400, width=12):
    """Unequal lengths, many equal vectors, repeated rows, and vectors that take no part."""
    random = np.random.default_rng(seed)
    base = random.normal(size=(n, width)) * random.exponential(size=(n, 1))
    base[50:130] = base[50]
    base[130:140] = 0
    rows = [(i, [float(np.float32(x)) for x in v], "p", 1, i % 4) for i, v in enumerate(base)]
    rows += [rows[20], rows[20], rows[40]]
    rows += [(1000, None, "p", 1, 1), (1020, [], "p", 1, 1), (1040, [1.0, None] + [0.0] * 10, "p", 1, 1), (1060, [float("nan")] * 12, "p", 1, 1),
             (1080, [float("inf")] * 12, "p", 1, 1), (None, rows[3][1], None, None, 2), (1100, rows[5][1][:7], "p", 1, 3), (-40, rows[9][1], "p", 1, None)]
    return rows


def whole(rows, scale):
    """The rows that take part as (id, integer vector, label)."""
    out = []
    for i, v, *_, label in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            out.append((i, [int(np.floor(scale * x)) for x in v], label))
    return out


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def plain(rows, k=20, every=20):
    rows, out = whole(rows, 64), []
    for q, (i, v, _) in enumerate(rows):
        if i is not None and i % every == 0:
            all_ = sorted((-product(v, w), j is None, j or 0, c) for c, (j, w, _) in enumerate(rows) if c != q)
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j, _) in enumerate(all_[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"strip_rows": 50, "cosine_from": 0.05, "bucket_rows": 16}])
def test_equals_plain_search(spark, options):
    rows = odd_rows()
    got = topk.top_products(spark.createDataFrame(rows, SCHEMA), **options)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0], "p", 1, 1), (20, [0.5, 0.0], "p", 1, 1), (21, [0.5, 0.0], "p", 1, 1)]
    assert sorted(map(tuple, topk.top_products(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == plain(rows)
    assert topk.top_products(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("cosine_from", [2.0, 0.5, 0.0])
def test_pruning_keeps_all_that_reach_the_floor(cosine_from):
    random = np.random.default_rng(5)
    v = np.floor(random.normal(size=(900, 8)) * random.exponential(size=(900, 1)) * 64)
    v[100:300] = v[100]
    v = v[np.argsort(-topk.lengths(v), kind="stable")]
    ids = random.permutation(len(v)).astype(np.int64)
    rows = vectors.Rows({"place": np.arange(len(v)), "id": ids, "known": np.ones(len(v), np.int64)}, v)
    queries = rows.take(np.arange(0, 900, 9))
    best = topk.search(queries, rows, np.full(len(queries), -(2.0 ** 62)), 7, cosine_from, 64)
    by_id = np.argsort(ids)
    for q in range(len(queries)):
        score = (v @ queries.v[q]).astype(int)
        score[queries["place"][q]] = -(2 ** 40)
        want = np.lexsort((ids, -score))[:7]
        mine = best.query == q
        got = sorted(zip(-best.score[mine], ids[by_id[best.rank[mine]]]))
        assert got == [(-score[c], ids[c]) for c in want]


def test_coordinates_are_looked_at_and_prune():
    random = np.random.default_rng(6)
    v = np.floor(random.normal(size=(500, 6)) * 100)
    bucket = topk.Bucket(v, topk.lengths(v), 0)
    kept = bucket.reachable(bucket.unit[7], 0.95)
    near = np.flatnonzero(bucket.unit @ bucket.unit[7] >= 0.95)
    assert set(near) <= set(kept) and len(kept) < 100


def test_too_large_components_are_an_error():
    with pytest.raises(ValueError, match="too large"):
        vectors.products(np.full((1, 2), 2.0 ** 40), np.full((1, 2), 2.0 ** 40))
