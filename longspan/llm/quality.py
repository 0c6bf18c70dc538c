"""Document quality by weak supervision.

Rules look at a document and vote good or bad, or abstain. How far each rule is to be believed is not set by hand: documents
are counted by their vote pattern, and expectation-maximisation on these counts estimates each rule's accuracy, the probability
that its vote is right. A document is kept if its posterior probability of being good reaches one half; no vote at all keeps it.
The driver only ever sees the counts of patterns, at most three to the power of the number of rules, whatever the corpus.

With ``DEFECTS`` as they stand, a document with a bad vote is beyond the good limit too and so never clean: its votes never
contradict each other, the fit moves probabilities but no verdict, and kept are exactly the documents above the floor on which no
defect fires. Rules that vote good on their own evidence were tried and are worse: nearly every document that the labels call bad
has one bad vote and many good ones.

Features are counted over whole texts, in blocks of bounded size, and nothing is shuffled but pattern counts. A null text has
no words. Repeated rows vote alike and all count. A corpus without documents keeps none. Other columns take no part in a vote,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longspan.llm.words import SOLID, map_blocks, raw_bytes, slices, spans, words

#: The contract's floor: fewer words, or more than half of the words in repeated windows, fail outright.
MIN_WORDS, MAX_REPEATED_PERCENT, REPEAT_WIDTH = 50, 50, 3
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
_LOWER = (np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A)
_ENDS = np.isin(np.arange(256), np.frombuffer(b".!?,;:\"')", np.uint8))
_LINE = np.arange(256) != 0x0A
_FIRST = (np.arange(256) & 0xC0) != 0x80

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_exclaim",
            "n_punctuated", "n_distinct", "n_digits")
GOOD, BAD, ABSTAIN = 1, -1, 0
#: Where accuracies start, and how many imagined votes hold them there.
ACCURACY, HELD = 0.9, 20.0


@dataclass(frozen=True)
class Defect:
    """Votes bad if ``top`` is more than ``bad`` times ``bottom`` (with ``under``, less), and abstains otherwise. A document
    beyond ``good`` in the same way is not clean. Where ``bottom`` is below ``least`` neither holds."""

    name: str
    top: str
    bottom: str
    good: float
    bad: float
    least: int = 1
    under: bool = False

    def beyond(self, f: dict[str, np.ndarray], limit: float) -> np.ndarray:
        top, bottom = f[self.top], f[self.bottom]
        return (bottom >= self.least) & ((top < limit * bottom) if self.under else (top > limit * bottom))


DEFECTS = (
    Defect("symbols", "n_symbols", "n_words", 0.02, 0.2),
    Defect("shouting", "n_upper", "n_letters", 0.15, 0.5, 20),
    Defect("exclaiming", "n_exclaim", "n_words", 0.05, 0.3),
    Defect("repeated_lines", "n_dup_lines", "n_lines", 0.2, 0.6, 5),
    Defect("repeated_words", "n_repeat_words", "n_words", 0.1, 0.3),
    Defect("monotonous", "n_distinct", "n_words", 0.45, 0.2, 50, True),
    Defect("long_words", "word_chars", "n_words", 9.0, 14.0),
    Defect("short_words", "word_chars", "n_words", 4.0, 2.0, 1, True),
    Defect("digits", "n_digits", "word_chars", 0.1, 0.4),
    Defect("unpunctuated", "n_punctuated", "n_words", 0.02, 0.002, 100, True),
)
#: Each defect is a rule; one more, "clean", votes good on documents within the good limit of every defect.
RULES = (*[d.name for d in DEFECTS], "clean")


def features(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts per text: words and characters in them, symbols, repeated lines, words in repeated windows and more."""
    found = words(texts, SOLID)
    data, offsets, first = found.data, found.offsets, found.first
    n = len(found.counts)

    def bytes_in(kind: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(kind[data])
        return np.diff(np.searchsorted(at, offsets))

    def per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[edges])

    out = {"n_words": found.counts, "n_symbols": bytes_in(_SYMBOLS), "n_upper": bytes_in(_UPPER), "n_lower": bytes_in(_LOWER),
           "word_chars": bytes_in(_FIRST & SOLID), "n_exclaim": bytes_in(np.arange(256) == 0x21),
           "n_digits": bytes_in((np.arange(256) >= 0x30) & (np.arange(256) <= 0x39)),
           "n_punctuated": per_text(_ENDS[data[found.end - 1]], first) if len(found.end) else np.zeros(n, np.int64)}
    text = found.text_of
    _, at = np.unique(text * (len(found.dictionary) + 1) + found.ids, return_index=True)
    out["n_distinct"] = np.bincount(text[at], minlength=n)

    start, end, lines = spans(data, offsets, _LINE)
    has_word = np.searchsorted(found.start, end) > np.searchsorted(found.start, start)
    line = np.asarray(slices(data[_LINE[data]], end - start).dictionary_encode().indices).astype(np.int64)
    of = np.repeat(np.arange(n), np.diff(lines))
    _, at = np.unique(of * (len(line) + 1) + line, return_index=True)
    again = np.ones(len(line), bool)
    again[at] = False
    out["n_dup_lines"] = per_text(again & has_word, lines)
    out["n_lines"] = per_text(has_word, lines)

    out["n_repeat_words"] = per_text(_in_repeats(found.ids, text, len(found.dictionary)), first)
    return {k: v.astype(np.int64) for k, v in out.items()}


def _in_repeats(ids: np.ndarray, text: np.ndarray, n_ids: int, width: int = REPEAT_WIDTH) -> np.ndarray:
    """Which words lie in a window of ``width`` words that stands at least twice in its text."""
    hit = np.zeros(len(ids), bool)
    m = len(ids) - width + 1
    if m <= 0:
        return hit
    window = ids[:m]
    for k in range(1, width):  # numbers for ever longer windows; always below the number of words squared
        _, window = np.unique(window * (n_ids + 1) + ids[k:k + m], return_inverse=True)
    whole = text[:m] == text[width - 1:]
    at = np.flatnonzero(whole)
    _, which, count = np.unique(text[at] * (m + 1) + window[at], return_inverse=True, return_counts=True)
    at = at[count[which] > 1]
    for k in range(width):
        hit[at + k] = True
    return hit


def base_failed(f: dict[str, np.ndarray]) -> np.ndarray:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEATED_PERCENT * f["n_words"])


def votes(f: dict[str, np.ndarray], defects: tuple[Defect, ...] = DEFECTS) -> np.ndarray:
    """One column of votes for each rule."""
    f = f | {"n_letters": f["n_upper"] + f["n_lower"]}
    cast = [np.where(d.beyond(f, d.bad), BAD, ABSTAIN) for d in defects]
    clean = ~np.any([d.beyond(f, d.good) for d in defects], axis=0) & (f["n_words"] >= MIN_WORDS)
    return np.stack([*cast, np.where(clean, GOOD, ABSTAIN)], axis=1).astype(np.int8)


def pattern(v: np.ndarray) -> np.ndarray:
    """The votes of a document as one number."""
    return (v.astype(np.int64) + 1) @ (3 ** np.arange(v.shape[1]))


@dataclass
class LabelModel:
    """The probability of each rule's votes to be right."""

    accuracy: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of being good, one half before any vote."""
        weight = np.log(self.accuracy / (1 - self.accuracy))
        return 1 / (1 + np.exp(-np.clip(v @ weight, -700, 700)))


def fit(v: np.ndarray, count: np.ndarray, rounds: int = 500, tolerance: float = 1e-9) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns with their counts: posteriors from accuracies, then accuracies
    from the votes that the posteriors call right, with the imagined votes that hold a rule nobody confirms or contradicts."""
    model = LabelModel(np.full(v.shape[1], ACCURACY))
    for _ in range(rounds):
        p = model.posterior(v)
        right = ((v == GOOD) * (p * count)[:, None] + (v == BAD) * ((1 - p) * count)[:, None]).sum(0)
        accuracy = (right + HELD * ACCURACY) / (((v != ABSTAIN) * count[:, None]).sum(0) + HELD)
        accuracy = np.clip(accuracy, 0.5, 1 - 1e-6)
        moved = np.abs(accuracy - model.accuracy).max(initial=0)
        model = LabelModel(accuracy)
        if moved < tolerance:
            break
    return model


def _unpack(numbers: np.ndarray, n_rules: int) -> np.ndarray:
    return (numbers[:, None] // 3 ** np.arange(n_rules) % 3 - 1).astype(np.int8)


def fit_label_model(docs: DataFrame, *, text: str = "text", defects: tuple[Defect, ...] = DEFECTS) -> LabelModel:
    """The label model of all documents that have a word."""
    def one(block):
        f = features(block.column(0))
        numbers, count = np.unique(pattern(votes(f, defects))[f["n_words"] > 0], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(count, pa.int64())], names=["pattern", "n"])

    counted = map_blocks(docs.select(F.col(text).cast("string").alias("_text")), "_text", one, "pattern bigint, n bigint")
    rows = counted.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()  # at most 3 ** rules rows
    numbers, count = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
    return fit(_unpack(numbers, len(defects) + 1), count.astype(float))


def score(docs: DataFrame, model: LabelModel, *, text: str = "text", keep: list[str] | None = None,
          defects: tuple[Defect, ...] = DEFECTS, threshold: float = 0.5) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) plus the struct ``quality`` (``_quality`` if that name is taken): the
    counts, base_failed, the votes of each rule, the probability of being good and whether the document is kept."""
    keep = docs.columns if keep is None else keep
    name = "_quality" if "quality" in keep else "quality"
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(text).cast("string").alias("_text"))

    def one(block):
        f = features(block.column("_text"))
        v, failed = votes(f, defects), base_failed(f)
        p = model.posterior(v)
        cast = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel(), pa.int8()))
        out = pa.StructArray.from_arrays(
            [*[pa.array(f[c]) for c in FEATURES], pa.array(failed), cast, pa.array(p), pa.array(~failed & (p >= threshold))],
            names=[*FEATURES, "base_failed", "votes", "probability", "kept"])
        return pa.RecordBatch.from_arrays([block.column("_row"), out], names=["_row", "_out"])

    counts = ", ".join(f"{c} bigint" for c in FEATURES)
    added = T.StructType.fromDDL(f"{counts}, base_failed boolean, votes array<tinyint>, probability double, kept boolean")
    schema = source.drop("_text").schema.add("_out", added)
    scored = map_blocks(source, "_text", one, schema)
    return scored.select(*[F.col("_row")[c].alias(c) for c in keep], F.col("_out").alias(name))


def keep_good(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The documents that the label model keeps, with their own columns."""
    scored = score(docs, fit_label_model(docs, text=text), text=text)
    return scored.where(F.col("_quality" if "quality" in docs.columns else "quality")["kept"]).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, and the probability."""
    scored = score(docs, fit_label_model(docs), keep=["doc_id"])
    return scored.select("doc_id", *[F.col("quality")[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")])
