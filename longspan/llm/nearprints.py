"""Near copies at a Jaccard similarity of 0.8 or more, by SimHash fingerprints of 256 bits and the trie self-join.

Shingles are runs of five words (texts of fewer words have one, of all their words), each counted once a text. Two sets of
similarity J have vectors at the angle acos(2 J / (1 + J)), and each bit of their fingerprints differs with that angle over pi:
0.1515 at 0.8, so 38.8 of 256 bits differ with a deviation of 5.7. ``BUDGET`` lies 1.4 deviations beyond. 64 bits can't tell 0.8
from 0.5; with 256, pairs at 0.7 are linked four times in ten, at 0.6 one in twenty and at 0.5 one in a thousand.

Pigeonhole blocks would be too short for that budget. So a fingerprint is the member of ``TABLES`` groups, each keyed by
``KEY_BITS`` of its bits, drawn by a rule: so many that of pairs at the budget itself, the farthest that are linked, 0.99 share a
group, and nearer ones nearly all. The tables are worked on some at a time, so that their rows take little disk. A group is a trie, walked as in ``simhash``; a group beyond ``CENTRED`` first links all that lie within the budget of a central member,
which needs one comparison each, and compares only the others with all. Groups beyond ``group_rows`` are cut into chunks that
meet in pairs. All links are told as stars.

A null or empty text has fingerprint 0 and is linked like any other; equal shingle sets are one class. Documents without id come
after all others, so of a class the smallest id stays, and of equal ids the first row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longspan.llm.components import components, local_components
from longspan.llm.simhash import trie_links
from longspan.llm.words import SOLID, batches_of, hashes, map_batches, map_blocks, mix, ragged, shingles, words
from longspan.session import brief_shuffles, pin

#: Words of a shingle, 64-bit words of a fingerprint, and differing bits that still link.
WIDTH, PRINT_WORDS, BUDGET = 5, 4, 47
#: Groups that a fingerprint belongs to, bits that all members of a group share, and tables that are dealt out at a time.
TABLES, KEY_BITS, TABLES_AT_ONCE = 132, 16, 33
#: Beyond so many rows a group is linked through a central member first; and comparisons made at a time.
CENTRED, CHUNK = 512, 1 << 20
#: Rows of a group that meet in one task; larger groups meet chunk by chunk.
GROUP_ROWS = 200_000
#: Text that is fingerprinted at a time (working memory is twenty to thirty times that), and rows that travel to a task at a time.
TEXT_BYTES, BATCH_BYTES = 1 << 20, 8 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def key_bits(table: int) -> np.ndarray:
    """The bits that key a table's groups: the first ``KEY_BITS`` in the order of a hash of table and bit."""
    order = mix(np.arange(64 * PRINT_WORDS, dtype=np.uint64) + np.array([1000 * (table + 1)], np.uint64) * _STEP)
    return np.sort(np.argsort(order, kind="stable")[:KEY_BITS])


def fingerprints(texts: pa.Array) -> np.ndarray:
    """A row of ``PRINT_WORDS`` unsigned words for each text."""
    found = words(texts, SOLID, fold=True)
    n, counts = len(found.counts), found.counts
    out = np.zeros((n, PRINT_WORDS), np.uint64)
    if not len(found.ids):
        return out
    own = mix(hashes(found.dictionary))[found.ids]
    whole = np.flatnonzero(counts >= WIDTH)
    runs = shingles(own, WIDTH)
    size = counts[whole] - WIDTH + 1
    value, doc = [runs[ragged(found.first[whole], size)]], [np.repeat(whole, size)]
    for width in range(1, WIDTH):
        short = np.flatnonzero(counts == width)
        if len(short):
            value.append(shingles(own, width)[found.first[short]])
            doc.append(short)
    value, doc = np.concatenate(value), np.concatenate(doc)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.concatenate(([True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])))
    value, doc = value[new], doc[new]
    total = np.bincount(doc, minlength=n)
    step = 1 << 14
    for k in range(PRINT_WORDS):
        ones = np.zeros((n, 64), np.int64)
        for a in range(0, len(value), step):  # bounds the unpacked bits, of which each takes eight bytes in the sums
            hashed = mix(value[a:a + step] + np.array([k + 1], np.uint64) * _STEP)
            bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cut = np.concatenate(([0], np.flatnonzero(np.diff(doc[a:a + step])) + 1))
            ones[doc[a + cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
        out[:, k] = np.packbits(ones * 2 > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _as_words(column: pa.Array) -> np.ndarray:
    """Binary fingerprints as rows of words; numbers are big-endian there, so that bytes sort like words."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, ">u8").astype(np.uint64).reshape(-1, PRINT_WORDS)


def _as_bytes(prints: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in prints.astype(">u8")], pa.binary())


def with_fingerprints(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The wanted columns and the binary ``fingerprint``."""
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(text).cast("string").alias("_text"))

    def one(block):
        return pa.RecordBatch.from_arrays([block.column("_row"), _as_bytes(fingerprints(block.column("_text")))], names=["_row", "_print"])

    schema = source.drop("_text").schema.add("_print", "binary")
    return map_blocks(source, "_text", one, schema, TEXT_BYTES).select(*[F.col("_row")[c].alias(c) for c in keep], F.col("_print").alias("fingerprint"))


def _distance(prints: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[x] ^ prints[y]).sum(axis=1, dtype=np.int64)


def centred_links(prints: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """Smallest linked place of each fingerprint of one large group."""
    n = len(prints)
    bits = np.zeros((PRINT_WORDS, 64), np.int64)
    for a in range(0, n, CHUNK >> 4):
        part = np.ascontiguousarray(prints[a:a + (CHUNK >> 4)])
        bits += np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64).reshape(PRINT_WORDS, 64)
    usual = np.packbits(bits * 2 > n, axis=1, bitorder="little").view(np.uint64).ravel()
    centre = int(np.bitwise_count(prints ^ usual).sum(axis=1, dtype=np.int64).argmin())
    own = np.arange(n)
    near = _distance(prints, own, np.full(n, centre)) <= budget
    label = np.where(near, np.flatnonzero(near)[0], own)
    rest = np.flatnonzero(~near)
    rows = max(1, CHUNK // n)
    for a in range(0, len(rest), rows):
        x = np.repeat(rest[a:a + rows], n)
        y = np.tile(own, len(x) // n)
        hit = (x != y) & (_distance(prints, x, y) <= budget)
        label = local_components(n, np.concatenate((x[hit], own)), np.concatenate((y[hit], label)))
    return label


def group_links(prints: np.ndarray, first: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """Smallest linked place of each fingerprint within its group; rows are distinct and ascending in each."""
    size = np.diff(first)
    label = np.arange(len(prints))
    small = np.flatnonzero(size <= CENTRED)
    at = ragged(first[small], size[small])
    if len(at):
        label[at] = at[trie_links(prints[at], np.concatenate(([0], np.cumsum(size[small]))), budget)]
    for g in np.flatnonzero(size > CENTRED):
        label[first[g]:first[g + 1]] = first[g] + centred_links(prints[first[g]:first[g + 1]], budget)
    return label


def _star_rows(batches, budget: int):
    """Links of whole groups as (fingerprint, smallest linked one); rows come sorted by group and fingerprint."""
    held: list[pa.RecordBatch] = []

    def work(table: pa.Table):
        prints = _as_words(table.column("fp").combine_chunks())
        keys = [np.asarray(table.column(c)) for c in ("k1", "k2")]
        new = np.concatenate(([True], (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])))
        label = group_links(prints, np.append(np.flatnonzero(new), len(prints)), budget)
        moved = np.flatnonzero(label != np.arange(len(label)))
        if len(moved):
            column = table.column("fp").combine_chunks()
            yield pa.RecordBatch.from_arrays([column.take(pa.array(moved)), column.take(pa.array(label[moved]))], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < GROUP_ROWS // 4:
            continue
        table = pa.Table.from_batches(held)
        k1, k2 = (np.asarray(table.column(c)) for c in ("k1", "k2"))
        last = np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))
        stop = int(last[-1]) + 1 if len(last) else 0
        if stop:
            yield from work(table.slice(0, stop))
        held = table.slice(stop).combine_chunks().to_batches()
    if held:
        yield from work(pa.Table.from_batches(held))


def _keyed(batches, tables: range):
    """Each fingerprint once for each of some tables, with the key of its group there."""
    chosen = np.array([key_bits(t) for t in tables])
    word, bit = chosen // 64, (chosen % 64).astype(np.uint64)
    weight = np.uint64(1) << np.arange(KEY_BITS, dtype=np.uint64)
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            column = batch.column("fp").slice(a, 4096)
            prints = _as_words(column)
            for k, t in enumerate(tables):
                key = (((prints[:, word[k]] >> bit[k]) & np.uint64(1)) * weight).sum(axis=1, dtype=np.uint64)
                k1 = (key.astype(np.int64) + (t << KEY_BITS)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(k1), column], names=["k1", "fp"])


def links(prints: DataFrame, budget: int = BUDGET, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Stars ``(a, b)`` between the distinct fingerprints of the column ``fp`` that share a group and lie within the budget."""
    found = None
    for a in range(0, TABLES, TABLES_AT_ONCE):
        with brief_shuffles(prints.sparkSession):
            some = pin(_links(prints, budget, group_rows, range(a, min(a + TABLES_AT_ONCE, TABLES))))
        found = some if found is None else found.unionByName(some)
    return found


def _links(prints: DataFrame, budget: int, group_rows: int, tables: range) -> DataFrame:
    rows = map_batches(prints.select("fp"), lambda batches: _keyed(batches, tables), "k1 int, fp binary")
    sizes = rows.groupBy("k1").agg(F.count("*").alias("n")).where(F.col("n") > group_rows)
    sizes = pin(sizes)  # at most one row in ``group_rows``
    rows = rows.withColumn("k2", F.lit(0))
    if sizes.limit(1).count():
        large = rows.drop("k2").join(sizes, "k1").withColumn("k", F.ceil(F.col("n") / group_rows).cast("int"))
        large = large.withColumn("c", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
        large = large.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        pair = F.least("c", "j") * F.col("k") + F.greatest("c", "j")
        rows = rows.join(sizes, "k1", "left_anti").unionByName(large.select("k1", "fp", pair.alias("k2")))
    rows = rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "fp")
    return map_batches(rows, lambda batches: _star_rows(batches, budget), "a binary, b binary")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """One document of each class with its own columns: the one with the smallest id, then the first row."""
    names = docs.columns
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text).alias("text"),
                         F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("place"))
    with batches_of(docs.sparkSession, BATCH_BYTES):  # rows hold their text twice on the way
        held = pin(with_fingerprints(source, "text", ["row", "doc_id", "place"]))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")
    reps = pin(held.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(order).alias("first")))
    roots = components(links(reps, group_rows=group_rows))
    chosen = reps.join(roots, F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(
        F.min("first").alias("first"))
    return held.join(chosen.select(F.col("first.place").alias("place")), "place", "left_semi").select(
        *[F.col("row")[c].alias(c) for c in names])
