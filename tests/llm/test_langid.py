"""Language identification: the sparse product against plain naive Bayes, and held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from longspan.llm import langid as L
from longspan.llm.words import mix

DOCS = [(1, "The cat sat, on the mat.", "en"), (2, "Le chat est sur la table ÉTÉ", "fr"), (3, "Die Katze sitzt für uns", "de"),
        (5, "the dog and the cat", "en"), (6, "la table et le chien", "fr"), (7, None, "en"), (9, "ohne Sprache", None), (10, "", "de")]


def grams(text):
    out = []
    word = ""
    for c in (text or "").encode() + b" ":
        c = c + 0x20 if 0x41 <= c <= 0x5A else c
        if 0x61 <= c <= 0x7A or c >= 0x80:
            word = (word or b"") + bytes([c])
        elif word:
            w = f" {word.decode().lower()} "
            out += [(n, w[i:i + n]) for n in L.WIDTHS for i in range(len(w) - n + 1)]
            word = b""
    return out


def bucket(n, s):
    key = np.full(1, n, np.uint64)
    for c in s:
        key = mix(key + np.uint64(ord(c)))
    return int(key[0] % np.uint64(L.BUCKETS))


def test_scores_like_plain_naive_bayes(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string, lang string")
    model = L.fit(docs)
    assert model.langs == ["de", "en", "fr"]
    counts = {g: Counter() for g in model.langs}
    n_docs = Counter(lang for *_, lang in DOCS if lang)
    for _, t, lang in DOCS:
        if lang:
            counts[lang].update(bucket(*g) for g in grams(t))
    texts = ["the cat", "über Été le", "", "x"]
    got = L.log_scores(model, pa.array(texts))
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.langs):
            total = sum(counts[lang].values()) + L.SMOOTHING * L.BUCKETS
            want = math.log(n_docs[lang] / sum(n_docs.values())) + sum(
                math.log((counts[lang][bucket(*g)] + L.SMOOTHING) / total) for g in grams(t))
            assert abs(got[i, j] - want) < 1e-3


def test_odd_rows(spark):
    rows = [(i, t, lang, "x") for i, t, lang in DOCS] + [(20, "123 !!", None, "x"), (None, "the cat", None, "x"), (1, DOCS[0][1], "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = L.digest(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (7, 10, 20))
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.digest(none).collect()} == {"und"}
    assert L.digest(docs.limit(0)).count() == 0


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    got = L.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


@pytest.mark.parametrize("parts", [1, 4])
def test_too_many_languages_are_an_error(spark, parts):
    """In one task, and where only all tasks together have too many."""
    docs = spark.createDataFrame([(i, "some words", f"l{i}", "x") for i in range(300)], "doc_id bigint, text string, lang string, score string")
    with pytest.raises(Exception, match="more than 8388608 cells"):
        L.fit(docs.repartition(parts))
