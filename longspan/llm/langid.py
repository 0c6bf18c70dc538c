"""Language identification by multinomial naive Bayes over hashed character n-grams.

N-grams are taken inside words, with a space at either side, and hashed into a fixed number of buckets; the log-probability
matrix is languages times buckets and its size does not depend on the corpus. Counting sums per bucket in each task before
the shuffle. Scoring is a sparse product: n-grams of the different words of a block times the matrix, then words of the texts
times that.

A null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing was learned. Rows are judged one
by one, so repeated rows get equal results; of equally probable languages the first in alphabetical order counts. Rows without
language are not learned from. Texts of any length are read whole, and no column but the named ones is looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longspan.llm.words import LETTERS, blocks, map_batches, map_blocks, mix, ragged, words

#: Buckets and n-gram widths; what is added to each count.
BUCKETS, WIDTHS, SMOOTHING = 1 << 15, (1, 2, 3, 4), 0.5
#: Bucket number under which documents are counted.
DOCUMENTS = -1
UNKNOWN = "und"
#: Cells (languages times buckets) of a model at most: 32 MB as it is sent to the executors.
MODEL_CELLS = 1 << 23


def word_grams(dictionary: pa.Array, buckets: int = BUCKETS, widths: tuple[int, ...] = WIDTHS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words on end, and how many each word has."""
    padded = [f" {w.decode('utf-8', 'replace').lower()} " for w in dictionary.to_pylist()]
    size = np.fromiter(map(len, padded), np.int64, len(padded))
    points = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    first = np.cumsum(size) - size
    found, count = [], []
    for width in widths:
        n = np.maximum(size - width + 1, 0)
        at = ragged(first, n)
        key = np.full(len(at), width, np.uint64)
        for k in range(width):
            key = mix(key + points[at + k])
        found.append((key % np.uint64(buckets)).astype(np.int64))
        count.append(n)
    return np.concatenate(found), np.stack(count) if count else np.zeros((0, len(padded)), np.int64)


def _gram_words(count: np.ndarray) -> np.ndarray:
    """The word of each n-gram that ``word_grams`` returns."""
    return np.tile(np.arange(count.shape[1]), count.shape[0]).repeat(count.ravel())


def count_grams(docs: DataFrame, *, text: str = "text", lang: str = "lang", buckets: int = BUCKETS,
                widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """``lang, bucket, n``: n-grams per language and bucket; bucket -1 counts documents."""
    source = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("_lang"), F.col(text).cast("string").alias("_text"))

    def run(batches):
        total: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}
        for batch in batches:
            for block in blocks(batch, "_text"):
                found = words(block.column("_text"), LETTERS, fold=True)
                bucket, count = word_grams(found.dictionary, buckets, widths)
                word, of = _gram_words(count), found.text_of
                names = np.array(block.column("_lang").to_pylist(), dtype=object)
                for name in set(names):
                    if name not in total and (len(total) + 1) * buckets > MODEL_CELLS:
                        raise ValueError(f"the model of the languages in {lang} has more than {MODEL_CELLS} cells; take fewer languages or buckets")
                    mine = names == name
                    times = np.bincount(found.ids[mine[of]], minlength=len(found.dictionary))
                    sums = np.bincount(bucket, weights=times[word], minlength=buckets)
                    total[name] = total.get(name, 0) + sums
                    documents[name] = documents.get(name, 0) + int(mine.sum())
        for name, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(at) + 1), pa.string()), pa.array(np.append(at, DOCUMENTS), pa.int64()),
                 pa.array(np.append(sums[at], documents[name]).astype(np.int64))], names=["lang", "bucket", "n"])

    return map_batches(source, run, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Languages in alphabetical order, log share of each, and log probability of each bucket in each."""

    langs: list[str]
    prior: np.ndarray
    gram: np.ndarray
    widths: tuple[int, ...]


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", buckets: int = BUCKETS, widths: tuple[int, ...] = WIDTHS,
        smoothing: float = SMOOTHING) -> Model:
    """Learn from all documents that have a language; the driver gets languages times buckets numbers, ``MODEL_CELLS`` at most. More
    (a column that holds no languages, say) is an error, as the matrix goes to every executor."""
    counts = count_grams(docs, text=text, lang=lang, buckets=buckets, widths=widths).limit(MODEL_CELLS + 1).toPandas()
    if max(len(counts), counts["lang"].nunique() * buckets) > MODEL_CELLS:
        raise ValueError(f"the model of the languages in {lang} has more than {MODEL_CELLS} cells; take fewer languages or buckets")
    langs = sorted(counts["lang"].unique())
    place = counts["lang"].map({n: i for i, n in enumerate(langs)}).to_numpy(np.int64)
    matrix, documents = np.zeros((len(langs), buckets)), np.zeros(len(langs))
    is_doc = (counts["bucket"] == DOCUMENTS).to_numpy()
    n = counts["n"].to_numpy(float)
    documents[place[is_doc]] = n[is_doc]
    matrix[place[~is_doc], counts["bucket"].to_numpy(np.int64)[~is_doc]] = n[~is_doc]
    matrix += smoothing
    gram = np.log(matrix / matrix.sum(axis=1, keepdims=True)) if langs else matrix
    return Model(langs, np.log(documents / documents.sum()) if langs else documents, gram.T.astype(np.float32).copy(), widths)


def log_scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Log probability of each text (rows) with each language (columns)."""
    found = words(texts, LETTERS, fold=True)
    n_words = len(found.dictionary)
    per_word = np.zeros((n_words, len(model.langs)))
    bucket, count = word_grams(found.dictionary, len(model.gram), model.widths)
    at = 0
    for n in count:
        own, stop = np.flatnonzero(n), at + int(n.sum())
        if len(own):
            per_word[own] += np.add.reduceat(model.gram[bucket[at:stop]], (np.cumsum(n) - n)[own], axis=0, dtype=np.float64)
        at = stop
    out = np.tile(model.prior, (len(found.counts), 1))
    some = np.flatnonzero(found.counts)
    if len(some):
        out[some] += np.add.reduceat(per_word[found.ids], found.first[:-1][some], axis=0)
    return out


def predict(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) plus ``lang_pred`` and its posterior probability ``score``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(text).cast("string").alias("_text"))

    def one(block):
        m = sent.value
        texts = block.column("_text")
        lettered = np.asarray(pc.match_substring_regex(texts, r"\p{L}").fill_null(False))
        names, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
        if m.langs and lettered.any():
            logs = log_scores(m, texts)
            best = logs.argmax(axis=1)
            share = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            names = np.where(lettered, np.array(m.langs, dtype=object)[best], UNKNOWN)
            score = np.where(lettered, share, 0.0)
        return pa.RecordBatch.from_arrays([block.column("_row"), pa.array(names.tolist(), pa.string()), pa.array(score)],
                                          names=["_row", "lang_pred", "score"])

    schema = source.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return map_blocks(source, "_text", one, schema).select(*[F.col("_row")[c].alias(c) for c in keep], "lang_pred", "score")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: learned from three quarters of the documents, predicted for all."""
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4))
    docs = docs.select("doc_id", "text", "lang", (part == 2).alias("held_out"))
    model = fit(docs.where(~F.col("held_out")))
    return predict(docs, model, keep=["doc_id", "held_out"])
