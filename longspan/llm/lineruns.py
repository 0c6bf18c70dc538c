"""Line deduplication by winnowing over line hashes.

Lines without a word are passed over. A window is the shortest run of consecutive lines from some line on that has at least
``min_words`` words; the smallest line hash in each window is selected, so any two texts that share a window share the
selected place: fingerprints are guaranteed. Windows whose fingerprint stands at one place only are left; the others are
joined with the first place where the same window stands. From there the match is extended line by line both ways, and the
later run is deleted.

First means: smallest document id (absent ids last), then the earlier row, then the earlier line. Lines are compared without
the white space around them. Null and empty texts have no lines. A repeated row is a repeat like any other, so its lines go;
documents are only dropped by ``remove_repeats``, where they lose their last word. Overlapping repeats within one text (a
line three times on end) leave the first. Other columns are kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longspan.llm.words import SOLID, Runs, map_batches, map_blocks, mix, ragged, raw_bytes, spans
from longspan.session import pin

#: A run with fewer words is no repeat.
MIN_WORDS = 50
_LINE = np.arange(256) != 0x0A


def lines_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, words and number of every line that has a word, and the offsets of the texts in these."""
    import xxhash
    data, offsets = raw_bytes(texts)
    start, end, _ = spans(data, offsets, _LINE)
    word_start, word_end, _ = spans(data, offsets, SOLID)
    a, b = np.searchsorted(word_start, start), np.searchsorted(word_start, end)
    solid = b > a
    start, a, b = start[solid], a[solid], b[solid]
    buffer, digest = data.tobytes(), xxhash.xxh3_64_intdigest
    left, right = (word_start[a], word_end[b - 1]) if len(a) else (a, b)
    hashed = np.fromiter((digest(buffer[i:j]) for i, j in zip(left.tolist(), right.tolist(), strict=True)), np.uint64, len(a))
    newline = np.flatnonzero(data == 0x0A)
    first = np.searchsorted(start, offsets)
    number = np.searchsorted(newline, start) - np.repeat(np.searchsorted(newline, offsets[:-1]), np.diff(first))
    return hashed, (b - a).astype(np.int64), number.astype(np.int64), first


def windows(hashed: np.ndarray, size: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS):
    """Start, content hash, smallest line hash of each window, and whether its place is selected here for the first time."""
    total = np.concatenate(([0], np.cumsum(size)))
    start = np.arange(len(hashed))
    stop = np.searchsorted(total, total[:-1] + min_words)
    text_end = np.repeat(first[1:], np.diff(first))
    whole = stop <= text_end
    start, count = start[whole], (stop - np.arange(len(hashed)))[whole]
    if not len(start):
        empty = np.zeros(0, np.uint64)
        return start, empty, empty, np.zeros(0, bool)
    at = ragged(start, count)
    edge = np.cumsum(count) - count
    offset = (np.arange(len(at)) - np.repeat(edge, count)).astype(np.uint64)
    content = np.add.reduceat(mix(hashed[at] + offset * np.uint64(0x9E3779B97F4A7C15)), edge)
    value = mix(hashed)[at]
    least = np.minimum.reduceat(value, edge)
    place = np.maximum.reduceat(np.where(value == np.repeat(least, count), at, -1), edge)
    return start, content, least, np.concatenate(([True], place[1:] != place[:-1]))


def _sequences(held: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``place, doc`` and the arrays ``hashes, sizes, numbers`` of the lines of each text that has any."""
    def one(block):
        hashed, size, number, first = lines_of(block.column("_text"))
        offsets = pa.array(first, pa.int32())
        rows = pa.RecordBatch.from_arrays(
            [block.column("place"), block.column("doc"), pa.ListArray.from_arrays(offsets, pa.array(hashed.view(np.int64))),
             pa.ListArray.from_arrays(offsets, pa.array(size)), pa.ListArray.from_arrays(offsets, pa.array(number))],
            names=["place", "doc", "hashes", "sizes", "numbers"])
        return rows.filter(pa.array(np.diff(first) > 0))

    source = held.select("place", F.col(doc_id).cast("bigint").alias("doc"), F.col(text).cast("string").alias("_text"))
    return map_blocks(source, "_text", one, "place bigint, doc bigint, hashes array<bigint>, sizes array<bigint>, numbers array<bigint>")


def _flat(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten())


def _window_rows(sequences: DataFrame, min_words: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            lists = batch.column("hashes")
            first = np.asarray(lists.offsets).astype(np.int64)
            hashed, size = _flat(lists).view(np.uint64), _flat(batch.column("sizes"))
            first = first - first[0]
            start, content, least, fresh = windows(hashed, size, first, min_words)
            row = np.searchsorted(first, start, side="right") - 1
            of = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("place").take(of), batch.column("doc").take(of), pa.array(start - first[row]),
                 pa.array(content.view(np.int64)), pa.array(least.view(np.int64)), pa.array(fresh)],
                names=["place", "doc", "at", "content", "mark", "fresh"])

    return map_batches(sequences.select("place", "doc", "hashes", "sizes"), run,
                       "place bigint, doc bigint, at bigint, content bigint, mark bigint, fresh boolean")


def _extend(batches):
    """The runs of equal lines of two texts that hold a matched window, from any line of it on both ways."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = {c: (_flat(batch.column(c)), np.asarray(batch.column(c).offsets).astype(np.int64)) for c in ("hashes", "src_hashes")}
        (b, b_first), (a, a_first) = ((v, o - o[0]) for v, o in lists.values())
        offsets = np.asarray(batch.column("matched").offsets).astype(np.int64)
        matched = batch.column("matched").flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        at, src = (np.asarray(matched.field(k)) for k in (0, 1))
        at, src = at + b_first[row], src + a_first[row]
        runs = Runs(a, b)
        back = runs.common(src, at, np.minimum(at - b_first[row], src - a_first[row]), back=True)
        size = back + runs.common(src, at, np.minimum(b_first[row + 1] - at, a_first[row + 1] - src))
        # one run for all windows that lie on it
        _, one = np.unique(np.stack((at - back, src - back)), axis=1, return_index=True)
        low, start, size, row = (at - back)[one], (src - back)[one], size[one], row[one]
        words_of = np.concatenate(([0], np.cumsum(_flat(batch.column("sizes")))))
        number, src_number = _flat(batch.column("numbers")), _flat(batch.column("src_numbers"))
        of = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [batch.column("place").take(of), batch.column("doc").take(of), pa.array(number[low]), pa.array(number[low + size - 1]),
             pa.array(size), pa.array(words_of[low + size] - words_of[low]), batch.column("src_doc").take(of), pa.array(src_number[start])],
            names=["place", "doc_id", "first_line", "last_line", "n_lines", "n_words", "source_doc_id", "source_line"])


def _order(prefix: str = "") -> Column:
    """Earlier documents first, absent ids last."""
    return F.struct(F.col(prefix + "doc").isNull().alias("none"), F.col(prefix + "doc").alias("doc"),
                    F.col(prefix + "place").alias("place"), F.col(prefix + "at").alias("at"))


def _runs(held: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    lines = pin(_sequences(held, doc_id, text))
    rows = _window_rows(lines, min_words)
    marks = pin(rows.where("fresh").groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"))
    # Written before the next join on the same key, so that a line of very many documents can be split in each of the two.
    rows = pin(rows.drop("fresh").join(marks, "mark", "left_semi"))
    first = pin(rows.groupBy("mark", "content").agg(F.min(_order()).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    later = rows.join(first, ["mark", "content"]).where(
        (F.col("place") != F.col("first.place")) | (F.col("at") != F.col("first.at")))
    pairs = pin(later.groupBy("place", F.col("first.place").alias("src_place")).agg(
        F.collect_list(F.struct("at", F.col("first.at").alias("src_at"))).alias("matched")))
    source = lines.select(F.col("place").alias("src_place"), F.col("doc").alias("src_doc"), F.col("hashes").alias("src_hashes"),
                          F.col("numbers").alias("src_numbers"))
    joined = pairs.join(source, "src_place").join(lines, "place")
    return map_batches(joined, _extend, "place bigint, doc_id bigint, first_line bigint, last_line bigint, n_lines bigint, "
                                        "n_words bigint, source_doc_id bigint, source_line bigint")


def repeated_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each later run and the first place it repeats: the lines (from 0, last one included) and their words."""
    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("place"))
    return _runs(pin(held), "doc_id", "text", min_words).drop("place")


def _without(batches):
    """Texts without the lines of their cuts, in one pass over the lines however the cuts overlap."""
    for batch in batches:
        cuts, left = batch.column("cuts"), batch.column("left").to_pylist()
        for i in np.flatnonzero(np.asarray(cuts.is_valid())).tolist():
            lines = left[i].split("\n")
            edge = np.zeros(len(lines) + 1, np.int64)
            spans_ = cuts[i].values
            np.add.at(edge, np.asarray(spans_.field(0)), 1)
            np.add.at(edge, np.asarray(spans_.field(1)) + 1, -1)
            left[i] = "\n".join([lines[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(left, pa.string()), cuts], names=["row", "left", "cuts"])


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without their later runs and with their own columns; ``n_chars``, where there is one, follows the text.

    A document whose last words were in such runs is dropped.
    """
    names = docs.columns
    held = pin(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.monotonically_increasing_id().alias("place")))
    found = _runs(held.select("place", F.col("row")[doc_id].alias("doc_id"), F.col("row")[text].alias("text")), "doc_id", "text", min_words)
    cuts = pin(found.groupBy("place").agg(F.collect_set(F.struct("first_line", "last_line")).alias("cuts")))
    joined = held.join(cuts, "place", "left").select("row", F.col("row")[text].alias("left"), "cuts")
    joined = map_batches(joined, _without, joined.schema)
    joined = joined.where(F.col("cuts").isNull() | F.col("left").rlike("[^ \\t\\n\\x0B\\f\\r]"))

    def column(c: str) -> Column:
        if c == text:
            return F.col("left").alias(c)
        if c == n_chars:
            kind = docs.schema[c].dataType
            return F.when(F.col("cuts").isNull(), F.col("row")[c]).otherwise(F.length("left").cast(kind)).alias(c)
        return F.col("row")[c].alias(c)

    return joined.select(*[column(c) for c in names])
