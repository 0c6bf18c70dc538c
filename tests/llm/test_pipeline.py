"""The whole pipeline against plain Python, stage by stage."""

import re

import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import words as item_words
from test_lineruns import expected as expected_runs
from test_nearprints import classes, fingerprint
from test_quality import expected as counted
from tokenizers import Tokenizer

import corpus_pipeline
from longspan.llm import quality
from longspan.llm.lineruns import MIN_WORDS


def all_features(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    own = counted(t)
    own |= {"n_upper": len(re.findall("[A-Z]", t)), "n_lower": len(re.findall("[a-z]", t)), "n_exclaim": t.count("!"),
            "n_digits": len(re.findall("[0-9]", t)), "n_punctuated": sum(x[-1] in ".!?,;:\"')" for x in w),
            "n_lines": sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in t.split("\n"))}
    return own


def good(docs):
    rows = [all_features(t) for _, t in docs]
    f = {k: np.array([r[k] for r in rows]) for k in rows[0]}
    v = quality.votes(f)
    some = f["n_words"] > 0
    patterns, count = np.unique(v[some], axis=0, return_counts=True)
    p = quality.fit(patterns, count.astype(float)).posterior(v)
    failed = (f["n_words"] < 50) | (2 * f["n_repeat_words"] > f["n_words"])
    return [d for d, a, b in zip(docs, ~failed, p >= 0.5, strict=True) if a and b]


def without_repeats(docs):
    cut = {}
    for run in expected_runs(docs, MIN_WORDS):
        cut.setdefault(run[-1], set()).update(range(run[1], run[2] + 1))
    out = []
    for i, (d, t) in enumerate(docs):
        if i in cut:
            t = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut[i])
            if not t.split():
                continue
        out.append((d, t))
    return out


def one_of_each(docs):
    first = {}
    for (d, _), c in zip(docs, classes([fingerprint(t) for _, t in docs]), strict=True):
        first[c] = min(first.get(c, d), d)
    return [x for x in docs if x[0] in set(first.values())]


def clean(docs, items):
    windows = {}
    for t in items:
        w = item_words(t)
        n = min(10, len(w))
        windows.setdefault(n, set()).update(tuple(w[i:i + n]) for i in range(len(w) - n + 1) if n)
    out = []
    for d, t in docs:
        w = item_words(t)
        if not any(tuple(w[i:i + n]) in s for n, s in windows.items() if n for i in range(len(w) - n + 1)):
            out.append((d, t))
    return out


@pytest.fixture
def sf(spark, tmp_path):
    """The smallest tables, with near copies that differ by a word within one long line."""
    given = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{given}/documents.parquet")
    rows = [r for r in docs.orderBy("doc_id").collect() if len(r.text.split()) > 300][:8]
    planted = []
    for i, r in enumerate(rows):
        words = r.text.split()
        for k, end in enumerate(("alpha", "beta")):
            text = " ".join([*words[:-1], end])
            planted.append((10_000 + 2 * i + k, text, r.lang, r.source, len(text)))
    docs.unionByName(spark.createDataFrame(planted, docs.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{given}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_like_plain_python(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = [good(docs)]
    kept.append(without_repeats(kept[-1]))
    kept.append(one_of_each(kept[-1]))
    kept.append(clean(kept[-1], items))
    assert len(docs) > len(kept[0]) >= len(kept[1]) > len(kept[2]) > len(kept[3]) > 0

    current = spark.read.parquet(f"{sf}/documents.parquet")
    schema = current.schema
    for (_, stage), want in zip(corpus_pipeline.STAGES[:-1], kept, strict=True):
        current = stage(spark, current, sf).cache()
        assert current.schema == schema
        assert sorted((r.doc_id, r.text) for r in current.collect()) == sorted(want)
        assert all(r.n_chars == len(r.text) for r in current.collect())

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    final = {r.doc_id: (r.n_tokens, r.token_ids) for r in corpus_pipeline.run(spark, sf).collect()}
    want = {d: library.encode(t, add_special_tokens=False).ids for d, t in kept[-1]}
    assert final == {d: (len(ids), ids) for d, ids in want.items()}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_documents(spark, sf, name, stage):
    rows = [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, "x"), (1, "", "en", "s", 0, "x"), (2, "w " * 30_000, None, None, 60_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, match string")
    assert stage(spark, docs, sf).count() <= len(rows)
    assert stage(spark, docs.limit(0), sf).count() == 0
