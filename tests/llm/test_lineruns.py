"""Winnowed line runs against plain search."""

import random

import pytest

from longspan.llm import lineruns as L


def expected(docs, least):
    """Lines to delete: all windows that stand earlier, with their matches extended from the first place of each window."""
    rows = sorted(range(len(docs)), key=lambda r: (docs[r][0] is None, docs[r][0] if docs[r][0] is not None else 0, r))
    seqs = {}
    for r in rows:
        lines = [(i, x.strip(" \t\n\r\x0b\x0c"), len(x.split())) for i, x in enumerate((docs[r][1] or "").split("\n"))]
        seqs[r] = [x for x in lines if x[1]]
    first, runs = {}, set()
    for r in rows:
        s = seqs[r]
        for i in range(len(s)):
            j, n = i, 0
            while j < len(s) and n < least:
                n += s[j][2]
                j += 1
            if n < least:
                break
            key = tuple(x[1] for x in s[i:j])
            if key not in first:
                first[key] = (r, i)
                continue
            q, k = first[key]
            a, shift = seqs[q], i - k
            lo, hi = i, j
            while lo > 0 and lo - 1 - shift >= 0 and s[lo - 1][1] == a[lo - 1 - shift][1]:
                lo -= 1
            while hi < len(s) and hi - shift < len(a) and s[hi][1] == a[hi - shift][1]:
                hi += 1
            runs.add((docs[r][0], s[lo][0], s[hi - 1][0], hi - lo, sum(x[2] for x in s[lo:hi]), docs[q][0], a[lo - shift][0], r))
    return runs


def corpus(seed):
    rng = random.Random(seed)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([1, 3, 8, 20]))) for _ in range(25)]
    docs = []
    for i in range(40):
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"own {i} {k} " + "x " * rng.randrange(9) for k in range(rng.randrange(14))]
        if rng.random() < 0.5 and docs:
            other = rng.choice(docs)[1].split("\n")
            a = rng.randrange(len(other))
            lines[len(lines) // 2:len(lines) // 2] = other[a:a + rng.randrange(1, 8)] + [" "]
        docs.append((rng.randrange(60) if rng.random() < 0.95 else None, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("least", [1, 12])
def test_runs_like_plain_search(spark, seed, least):
    docs = corpus(seed) + [(3, None), (3, ""), (4, "\n\n"), (5, "a b\n" * 400), (6, "p q r s t u v w x y z a b"), (6, "p q r s t u v w x y z a b")]
    df = spark.createDataFrame([(*d, "m") for d in docs], "doc_id bigint, text string, mark string").coalesce(1)
    got = {tuple(r) for r in L.repeated_runs(df, min_words=least).collect()}
    assert got == {r[:-1] for r in expected(docs, least)}


def test_removal_keeps_columns(spark):
    run = "\n".join(f"line {k} with five words" for k in range(12))
    docs = [(1, f"start\n{run}\nend", 9, "a"), (2, f"other\n{run}\n\ntail", 9, "b"), (3, run, 9, "c"), (4, None, 9, "d"), (5, "short", 9, "e"),
            (None, "start", 9, "f")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, n_chars bigint, row string")
    got = sorted(map(tuple, L.remove_repeats(df).collect()), key=str)
    assert got == sorted([docs[0], (2, "other\n\ntail", 11, "b"), docs[3], docs[4], docs[5]], key=str)
    assert L.remove_repeats(df).schema == df.schema
    assert L.remove_repeats(df.limit(0)).count() == 0 and L.repeated_runs(df.limit(0)).count() == 0


def test_guarantee_of_window_minima():
    """Texts that share a window share its selected hash, whatever stands around it."""
    import numpy as np
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 1 << 62, 6).astype(np.uint64)
    size = np.full(6, 10)
    marks = []
    for n in (0, 3, 9):
        h = np.concatenate((rng.integers(0, 1 << 62, n).astype(np.uint64), shared, rng.integers(0, 1 << 62, 4).astype(np.uint64)))
        start, content, least, _ = L.windows(h, np.full(len(h), 10), np.array([0, len(h)]), 50)
        marks.append({(int(c), int(m)) for s, c, m in zip(start, content, least, strict=True) if n <= s <= n + 1})
    assert marks[0] == marks[1] == marks[2] and len(marks[0]) == 2 and size.sum() == 60


def test_many_equal_lines_in_one_text(spark):
    """20,000 equal lines, and a text of two lines in turn: one run a start, and one pass over the lines to delete them."""
    line, other = " ".join(f"w{k}" for k in range(50)), " ".join(f"v{k}" for k in range(50))
    n = 20_000
    docs = [(1, "\n".join([line] * n)), (2, "\n".join([other, line] * 500)), (3, "\n".join(f"own line {k}" for k in range(60)))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = L.repeated_runs(df).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {1: n - 1, 2: 500 + 499}
    left = {r.doc_id: r.text for r in L.remove_repeats(df).collect()}
    assert left == {1: line, 2: other, 3: docs[2][1]}
