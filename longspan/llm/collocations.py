"""Phrase collocations, counted in direct-address tiles.

Texts are cut into pieces and words once and kept as numbers. Frequent (language, word) tokens are numbered by frequency, so a pair
of adjacent tokens is a cell of a matrix whose busy corner comes first. That corner is cut into tiles of ``TILE`` x ``TILE`` cells,
and a task counts a tile in one dense array by ``bincount``; pairs outside the corner are sparse, and are dealt out by hash and
counted as sorted (row, column, count) triples. Frequent pairs are then numbered by frequency themselves, and a pair with the word
after it is again a cell of a matrix: the same step counts phrases of three words, and once more of four. A phrase cannot be more
frequent than its parts, so only frequent parts are extended.

What moves is counted first, over some blocks of a task. Buckets of sparse pairs grow in number with the input as the blocks do, so
a row for each bucket and block would grow with its square: pairs are dealt out twice, to stretches of buckets, as many as the root
of their number, and to groups of blocks, added up there, and then to their own bucket or tile. Numbers of tokens and phrases come
back to the blocks in a broadcast while they are few, which is counted; else by joins on the block's own different words and pairs,
so that no task or driver holds a larger table. Both ways give the same numbers.

A null text has no words, a null language is ``und``. Repeated rows count each time. Blocks hold whole texts, however long; an
empty table gives no rows. Ties are broken down to the phrase, which is unique in its language. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longspan.llm.vectors import numbered
from longspan.llm.words import FOLD, batches_of, map_batches, mix, raw_bytes, slices, spans
from longspan.session import brief_shuffles, pin, remove, scratch_path, temporary

#: Least count of a phrase, most words, results of a language, factor of the score, share of a longer phrase that replaces a shorter.
LEAST, LONGEST, BEST, FACTOR, SHARE = 30, 4, 2000, 2_000_000, 80
#: Cells on a side of a tile, and tiles on a side of the dense corner.
TILE, CORNER = 1024, 4
#: Sparse entries that one task counts at a time, bytes of text in a block, vocabulary rows of a task.
SPARSE_ROWS, BLOCK_BYTES, VOCABULARY_ROWS = 1 << 20, 1 << 20, 1 << 18
#: Places of pairs that a task counts before it deals them out, and numbers of pairs that a task looks up at a time.
HELD_ROWS, KNOWN_ROWS = 1 << 19, 1 << 18
#: Numbers that are sent to all tasks at once, in rows and in bytes of words; beyond that they come by joins.
LOOKUP_ROWS, LOOKUP_BYTES = 1 << 20, 32 << 20
#: Bytes of packed rows that go to a task's Python worker at a time.
BATCH_BYTES = 4 << 20
UNKNOWN = "und"

_BYTES = np.arange(256)
#: Bytes that end a piece, and bytes of a word: all but these, space and tab.
ENDS = np.isin(_BYTES, np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
INSIDE = ~(ENDS | (_BYTES == 0x20) | (_BYTES == 0x09))


def pack(x: np.ndarray) -> bytes:
    """Whole numbers from -1 on in as few bytes each as the greatest needs, told by the first byte."""
    x = x + 1
    x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
    return bytes([x.itemsize]) + x.tobytes()


def unpack(data) -> np.ndarray:
    size = memoryview(data)[0]
    return np.frombuffer(data, f"u{size}", offset=1).astype(np.int64) - 1


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different words of some texts, and the texts as places of words with -1 between two pieces."""
    data, offsets = raw_bytes(texts)
    data = FOLD[data]
    start, end, first = spans(data, offsets, INSIDE)
    encoded = slices(data[INSIDE[data]], end - start).dictionary_encode()
    ids = np.asarray(encoded.indices).astype(np.int64)
    closed = np.cumsum(ENDS[data], dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    new = np.zeros(len(start), bool)  # words that begin a piece
    new[1:] = closed[start[1:]] != closed[start[:-1]]
    new[first[:-1][first[:-1] < len(start)]] = True
    out = np.full(len(ids) + int(new.sum()), -1, np.int64)
    out[np.arange(len(ids)) + np.cumsum(new)] = ids
    return encoded.dictionary, out


def _blocks(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``block, lang, words, counts, sequence, n_words``: texts of one language and about ``BLOCK_BYTES``."""
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def one(lang: str, texts: list[pa.Array]):
        words, sequence = pieces(pa.chunked_array(texts).cast(pa.large_string()).combine_chunks())
        counts = np.bincount(sequence[sequence >= 0], minlength=len(words))
        listed = pa.array([0, len(words)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.ListArray.from_arrays(listed, words.cast(pa.binary())), pa.ListArray.from_arrays(listed, pa.array(counts)),
             pa.array([pack(sequence)], pa.binary()), pa.array([int((sequence >= 0).sum())])], names=["lang", "words", "counts", "sequence", "n_words"])

    def run(batches):
        held: dict[str, list] = {}
        size: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for k, name in enumerate(langs.dictionary.to_pylist()):
                texts = batch.column("text").filter(pa.array(np.asarray(langs.indices) == k))
                bytes_ = np.cumsum(np.asarray(pa.compute.binary_length(texts)).astype(np.int64))
                a = 0
                while a < len(texts):
                    room = BLOCK_BYTES - size.get(name, 0)
                    base = int(bytes_[a - 1]) if a else 0
                    b = max(a + 1, int(np.searchsorted(bytes_, base + room, "right")))
                    held.setdefault(name, []).append(texts.slice(a, b - a))
                    size[name] = size.get(name, 0) + int(bytes_[b - 1]) - base
                    if size[name] >= BLOCK_BYTES or b < len(texts):
                        yield one(name, held.pop(name))
                        size[name] = 0
                    a = b
                if sum(size.values()) > 4 * BLOCK_BYTES:  # many languages: none waits for more of its own
                    for lang, texts in held.items():
                        yield one(lang, texts)
                    held, size = {}, {}
        for lang, texts in held.items():
            yield one(lang, texts)

    rows = map_batches(source, run, "lang string, words array<binary>, counts array<bigint>, sequence binary, n_words bigint")
    return rows.withColumn("block", F.monotonically_increasing_id())


def _cells(rows: np.ndarray, columns: np.ndarray, buckets: int) -> np.ndarray:
    """Where a pair is counted: its tile in the corner, else one of the buckets, which have negative numbers."""
    side = TILE * CORNER
    tile = (rows // TILE) * CORNER + columns // TILE
    spread = mix(mix(rows.view(np.uint64)) + columns.view(np.uint64)) % np.uint64(buckets)
    return np.where((rows < side) & (columns < side), tile, -1 - spread.astype(np.int64))


def _order(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Order by both numbers, sorted as one where they fit into it."""
    span = int(columns.max(initial=0)) + 1
    return np.lexsort((columns, rows)) if (int(rows.max(initial=0)) + 1) * span >= 2 ** 63 else np.argsort(rows * span + columns)


def tallied(rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs in order, and how often each is there."""
    span = int(columns.max(initial=0)) + 1
    if (int(rows.max(initial=0)) + 1) * span >= 2 ** 63:
        return runs(rows, columns, np.ones(len(rows), np.int64))
    keys, counts = np.unique(rows * span + columns, return_counts=True)
    return keys // span, keys % span, counts


def runs(rows: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal pairs added up, by sorting."""
    order = _order(rows, columns)
    rows, columns, counts = rows[order], columns[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(rows) != 0) | (np.diff(columns) != 0)))) if len(rows) else np.zeros(0, int)
    return rows[first], columns[first], np.add.reduceat(counts, first) if len(first) else counts


class Tally:
    """Counts of the pairs of one cell: a dense array for a tile, else sorted triples that are merged as they grow."""

    def __init__(self, cell: int):
        self.cell, self.dense, self.parts, self.held = cell, None, [], 0
        self.corner = (cell // CORNER * TILE, cell % CORNER * TILE)

    def add(self, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> None:
        if self.cell >= 0:
            place = (rows - self.corner[0]) * TILE + columns - self.corner[1]
            if self.dense is None:
                self.dense = np.zeros(TILE * TILE, np.int64)
            if len(place) > TILE * TILE // 8:
                self.dense += np.bincount(place, counts, TILE * TILE).astype(np.int64)
            else:
                np.add.at(self.dense, place, counts)
            return
        self.parts.append((rows, columns, counts))
        self.held += len(rows)
        if self.held > SPARSE_ROWS and len(self.parts) > 1:
            self._merge()
            self.held = 0  # of what came since

    def _merge(self) -> None:
        self.parts = [runs(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.cell >= 0:
            place = np.flatnonzero(self.dense)
            return place // TILE + self.corner[0], place % TILE + self.corner[1], self.dense[place]
        self._merge()
        return self.parts[0]


_PARTIAL = "cell bigint, block bigint, rows binary, columns binary, counts binary"


def _dealt(cell: np.ndarray, block: int, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Triples with a row for each cell. They come in order, so the pairs' first numbers are told by their steps."""
    order = np.argsort(cell, kind="stable")
    cell, rows, columns, counts = (x[order] for x in (cell, rows, columns, counts))
    first = np.flatnonzero(np.diff(cell, prepend=cell[:1] - 1))
    steps = np.diff(rows, prepend=0)
    steps[first] = rows[first]
    cells = [pa.array([pack(x[a:b]) for a, b in zip(first, np.append(first[1:], len(cell)), strict=True)], pa.binary()) for x in (steps, columns, counts)]
    return pa.RecordBatch.from_arrays([pa.array(cell[first]), pa.array(np.full(len(first), block, np.int64)), *cells],
                                      names=["cell", "block", "rows", "columns", "counts"])


def _read(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps, columns, counts = (unpack(batch.column(c)[k].as_buffer()) for c in ("rows", "columns", "counts"))
    return np.cumsum(steps), columns, counts


def _pairs_of(block: pa.RecordBatch, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where a frequent phrase of ``width`` words is followed by a frequent word and its own end by that word, and both numbers."""
    heads, tokens = (unpack(block.column(c)[k].as_buffer()) for c in ("heads", "tokens"))
    n = max(0, len(tokens) - width)
    at = np.flatnonzero((heads[:n] >= 0) & (heads[1:n + 1] >= 0) & (tokens[width:width + n] >= 0))
    return at, heads[at], tokens[at + width]


def _count_blocks(blocks: DataFrame, width: int, buckets: int, step: int | None = None, held_rows: int = HELD_ROWS) -> DataFrame:
    """Different pairs of some blocks of a task with their counts, told by the first of the blocks, by cell; ``step`` buckets (the
    root of their number if not given) are one cell. With ``held_rows`` 0 each block is on its own."""
    step = step or max(1, round(buckets ** 0.5))

    def run(batches):
        held, size, first = [], 0, None

        def done():
            if size:
                rows, columns, counts = tallied(*(np.concatenate(x) for x in zip(*held, strict=True)))
                cell = _cells(rows, columns, buckets)
                yield _dealt(np.where(cell < 0, -1 - (-1 - cell) // step, cell), first, rows, columns, counts)

        for batch in batches:
            for k in range(batch.num_rows):
                _, rows, columns = _pairs_of(batch, k, width)
                if size and size + len(rows) > held_rows:
                    yield from done()
                    held, size = [], 0
                if not size:
                    first = batch.column("block")[k].as_py()
                held.append((rows, columns))
                size += len(rows)
        yield from done()

    return map_batches(blocks.select("block", "heads", "tokens"), run, _PARTIAL)


def _add_up(partial: DataFrame, group, least: int, buckets: int = 0) -> DataFrame:
    """Partial counts of each cell and group added up, those of at least ``least``; stretches of buckets are cut into buckets."""
    def run(batches):
        key = tally = None

        def done():
            if tally is not None:
                rows, columns, counts = tally.result()
                good = counts >= least
                if good.any():
                    rows, columns, counts = rows[good], columns[good], counts[good]
                    cell = _cells(rows, columns, buckets) if key[0] < 0 and buckets else np.full(len(rows), key[0], np.int64)
                    yield _dealt(cell, key[1], rows, columns, counts)

        for batch in batches:
            for k in range(batch.num_rows):
                now = batch.column("cell")[k].as_py(), batch.column("block")[k].as_py()
                if now != key:
                    yield from done()
                    key, tally = now, Tally(now[0])
                tally.add(*_read(batch, k))
        yield from done()

    return map_batches(partial.select("cell", group, "rows", "columns", "counts").repartition("cell", "block").sortWithinPartitions("cell", "block"), run, _PARTIAL)


def _frequent(blocks: DataFrame, places: int, width: int, buckets: int) -> DataFrame:
    """``head, token, f`` of the frequent pairs of some ``places``."""
    # A tile of the corner and a stretch of buckets have a row from all blocks: these are added up in groups of about as many rows as there are groups.
    groups = max(1, round((places / HELD_ROWS) ** 0.5))
    first = pin(_add_up(_count_blocks(blocks, width, buckets), F.pmod(F.xxhash64("block"), F.lit(groups)).alias("block"), 1, buckets))
    # Written before they are unpacked: a task needs one Python worker at a time.
    whole = pin(_add_up(first, F.lit(0).cast("bigint").alias("block"), LEAST))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _read(batch, k)], names=["head", "token", "f"])

    return map_batches(whole, run, "head bigint, token bigint, f bigint")


def _near_heads(blocks: DataFrame, frequent: DataFrame, width: int) -> DataFrame:
    """As ``_next_heads``, with all numbers in a broadcast."""
    table = frequent.select("head", "token", "id").toArrow()
    known, ids, _ = _keyed(*(table.column(c).to_numpy() for c in ("head", "token", "id")))
    sent = blocks.sparkSession.sparkContext.broadcast((known, ids))

    def run(batches):
        known, ids = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                places, rows, columns = _pairs_of(batch, k, width)
                at = find_pairs(known, rows, columns)
                heads = np.full(len(unpack(batch.column("tokens")[k].as_buffer())), -1, np.int64)
                heads[places[at >= 0]] = ids[at[at >= 0]]
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(k, 1), pa.array([pack(heads)], pa.binary()), batch.column("tokens").slice(k, 1)],
                                                 names=["block", "heads", "tokens"])

    return map_batches(blocks.select("block", "heads", "tokens"), run, "block bigint, heads binary, tokens binary")


def _next_heads(blocks: DataFrame, frequent: DataFrame, n_frequent: int, width: int, n_blocks: int) -> DataFrame:
    """The blocks with the number of the frequent phrase of ``width + 1`` words at each place as ``heads``.

    A cell's numbers go to each group of its blocks, meet the blocks' own pairs there, and return to the blocks.
    """
    groups, buckets = max(1, round(n_blocks ** 0.5)), max(1, -(-n_frequent // KNOWN_ROWS))

    def by_cell(batches):
        held, size = [], 0

        def done():
            if size:
                (rows, columns), ids, _ = _keyed(*(np.concatenate(x) for x in zip(*held, strict=True)))
                yield _dealt(_cells(rows, columns, buckets), -1, rows, columns, ids)

        for batch in batches:
            held.append(tuple(np.array(batch.column(c)) for c in ("head", "token", "id")))
            size += batch.num_rows
            if size >= KNOWN_ROWS:
                yield from done()
                held, size = [], 0
        yield from done()

    salt = F.pmod(F.xxhash64("block"), F.lit(groups))
    own = _count_blocks(blocks, width, buckets, 1, 0).select("cell", salt.alias("salt"), "block", "rows", "columns", F.lit(bytes([1])).alias("counts"))
    known = map_batches(frequent.select("head", "token", "id"), by_cell, _PARTIAL).select(
        "cell", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")).alias("salt"), "block", "rows", "columns", "counts")
    rows = known.unionByName(own).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "block")

    def look_up(batches):
        key, parts, table = None, [], None
        for batch in batches:
            for k in range(batch.num_rows):
                now = batch.column("cell")[k].as_py(), batch.column("salt")[k].as_py()
                if now != key:
                    key, parts, table = now, [], None
                block = batch.column("block")[k].as_py()
                if block < 0:
                    parts.append(_read(batch, k))
                    continue
                if not parts:
                    continue
                if table is None:
                    known, ids, _ = _keyed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                    table = known, ids
                rows, columns, _ = _read(batch, k)
                at = find_pairs(table[0], rows, columns)
                good = at >= 0
                if good.any():
                    yield _dealt(np.full(int(good.sum()), now[0], np.int64), block, rows[good], columns[good], table[1][at[good]])

    def fill(batches):
        held, parts = None, []

        def done():
            if held is not None:
                heads = np.full(len(unpack(held[1])), -1, np.int64)
                if parts:
                    known, ids, _ = _keyed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                    batch = pa.RecordBatch.from_arrays([pa.array([held[2]], pa.binary()), pa.array([held[1]], pa.binary())], names=["heads", "tokens"])
                    places, rows, columns = _pairs_of(batch, 0, width)
                    at = find_pairs(known, rows, columns)
                    heads[places[at >= 0]] = ids[at[at >= 0]]
                yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([pack(heads)], pa.binary()), pa.array([held[1]], pa.binary())],
                                                 names=["block", "heads", "tokens"])

        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.column("block")[k].as_py()
                if batch.column("cell")[k].as_py() is None:
                    yield from done()
                    held, parts = (block, batch.column("tokens")[k].as_py(), batch.column("heads")[k].as_py()), []
                else:
                    parts.append(_read(batch, k))
        yield from done()

    absent = F.lit(None).cast("binary")
    found = map_batches(rows, look_up, _PARTIAL).select("*", absent.alias("heads"), absent.alias("tokens"))
    texts = blocks.select(F.lit(None).cast("bigint").alias("cell"), "block", *[absent.alias(c) for c in ("rows", "columns", "counts")], "heads", "tokens")
    both = texts.unionByName(found).repartition("block").sortWithinPartitions("block", F.col("cell").asc_nulls_first())
    return map_batches(both, fill, "block bigint, heads binary, tokens binary")


def _keyed(rows: np.ndarray, columns: np.ndarray, ids: np.ndarray):
    """Pairs in order, and their numbers in that order."""
    order = _order(rows, columns)
    return (rows[order], columns[order]), ids[order], order


def find_pairs(known: tuple[np.ndarray, np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Place of each pair among ordered ones, or -1."""
    if not len(known[0]) or not len(rows):
        return np.full(len(rows), -1, np.int64)
    span = int(max(known[1].max(), columns.max())) + 1
    if (int(max(known[0].max(), rows.max())) + 1) * span >= 2 ** 63:  # too large for one number: the first numbers are renumbered
        names = np.unique(known[0])
        at = np.minimum(np.searchsorted(names, rows), len(names) - 1)
        out = find_pairs((np.searchsorted(names, known[0]), known[1]), at, columns)
        return np.where(names[at] == rows, out, -1)
    keys, wanted = known[0] * span + known[1], rows * span + columns
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _ranked(table: DataFrame, order: list[str]) -> DataFrame:
    """``id`` by falling frequency."""
    return numbered(table, [F.col("f").desc(), *[F.col(c) for c in order]], VOCABULARY_ROWS).withColumnRenamed("number", "id")


def _kept(df: DataFrame, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, written; tables that it pins on the way are removed then."""
    path = scratch_path(df.sparkSession, "kept")
    with temporary(df.sparkSession):
        make().write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _vocabulary(blocks: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entries ``block, at, lang, word`` of all blocks; numbered frequent tokens; words of each language."""
    entries = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "e")).select(
        "block", "lang", "at", F.col("e.words").alias("word"), F.col("e.counts").alias("c"))
    counts = entries.groupBy("lang", "word").agg(F.sum("c").alias("f"))
    totals = blocks.select("lang", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("c")).groupBy("lang").agg(F.sum("c").alias("n"))
    return entries, _kept(blocks, lambda: _ranked(pin(counts.where(F.col("f") >= least)), ["lang", "word"])), pin(totals)


def _near_tokens(blocks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """As ``_tokens``, with the vocabulary in a broadcast."""
    table = vocabulary.select("lang", "word", "id").toArrow()
    langs, ids = np.array(table.column("lang").to_pylist(), object), table.column("id").to_numpy()
    words = table.column("word").combine_chunks().cast(pa.binary())
    of = {lang: np.flatnonzero(langs == lang) for lang in set(langs)}
    sent = blocks.sparkSession.sparkContext.broadcast({lang: (words.take(pa.array(at)), ids[at]) for lang, at in of.items()})

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                own, sequence = batch.column("words")[k].values, unpack(batch.column("sequence")[k].as_buffer())
                names = np.full(len(own) + 1, -1, np.int64)  # the last is for -1
                if (known := sent.value.get(batch.column("lang")[k].as_py())) is not None:
                    at = pa.compute.index_in(own.cast(pa.binary()), value_set=known[0])
                    found = np.asarray(at.is_valid())
                    names[:-1][found] = known[1][np.asarray(at.drop_null())]
                tokens = pa.array([pack(names[sequence])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(k, 1), tokens, tokens], names=["block", "heads", "tokens"])

    return map_batches(blocks.select("block", "lang", "words", "sequence"), run, "block bigint, heads binary, tokens binary")


def _tokens(blocks: DataFrame, entries: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``block, heads, tokens``: the sequences as numbers of frequent tokens, -1 elsewhere."""
    known = entries.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).select("block", "at", "id", F.lit(None).cast("binary").alias("sequence"))
    texts = blocks.select("block", F.lit(-1).alias("at"), F.lit(-1).cast("bigint").alias("id"), "sequence")
    rows = texts.unionByName(known).repartition("block").sortWithinPartitions("block", "at")

    def run(batches):
        held, parts = None, []

        def done():
            if held is not None:
                sequence = unpack(held[1])
                names = np.full(int(sequence.max(initial=-1)) + 2, -1, np.int64)  # the last is for -1
                for at, ids in parts:
                    names[at] = ids
                tokens = pa.array([pack(names[sequence])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([held[0]]), tokens, tokens], names=["block", "heads", "tokens"])

        for batch in batches:
            at, ids = (np.array(batch.column(c)) for c in ("at", "id"))
            for some in np.split(np.arange(len(at)), np.flatnonzero(at < 0)):
                if len(some) and at[some[0]] < 0:
                    yield from done()
                    held, parts = (batch.column("block")[int(some[0])].as_py(), batch.column("sequence")[int(some[0])].as_py()), []
                    some = some[1:]
                parts.append((at[some], ids[some]))
        yield from done()

    return map_batches(rows, run, "block bigint, heads binary, tokens binary")


def phrase_counts(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", lookup_rows: int = LOOKUP_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``words`` (token numbers), ``size`` and ``f`` of all frequent phrases of up to four words; the tokens; words of each language."""
    with batches_of(docs.sparkSession, BATCH_BYTES), brief_shuffles(docs.sparkSession):
        return _phrase_counts(docs, text, lang, lookup_rows)


def _phrase_counts(docs: DataFrame, text: str, lang: str, lookup_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    spark = docs.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "blocks")
        df.write.parquet(path)
        return spark.read.parquet(path), path

    blocks, path = written(_blocks(docs, text, lang))
    entries, vocabulary, totals = _vocabulary(blocks, LEAST)
    n_blocks, words = blocks.agg(F.count("*"), F.sum("n_words")).first()
    n_tokens, size = vocabulary.agg(F.count("*"), F.sum(F.length("word"))).first()
    words = int(words or 0)
    buckets = max(1, -(-words // SPARSE_ROWS))
    near = n_tokens <= lookup_rows and (size or 0) <= LOOKUP_BYTES
    coded, at = written(_near_tokens(blocks, vocabulary) if near else _tokens(blocks, entries, vocabulary))
    remove(spark, path)
    phrases = vocabulary.select(F.array("id").alias("words"), F.col("id"), "f")
    all_ = [phrases]
    for width in range(1, LONGEST):
        frequent = _kept(coded, lambda now=coded, width=width: _ranked(pin(_frequent(now, words, width, buckets)), ["head", "token"]))
        before = phrases.select(F.col("id").alias("head"), "words")
        phrases = pin(frequent.join(before, "head").select(F.concat("words", F.array("token")).alias("words"), "id", "f"))
        all_.append(phrases)
        if width + 1 < LONGEST:
            path, n_frequent = at, frequent.count()
            near = n_frequent <= lookup_rows
            coded, at = written(_near_heads(coded, frequent, width) if near else _next_heads(coded, frequent, n_frequent, width, n_blocks))
            remove(spark, path)
    remove(spark, at)
    whole = all_[0]
    for more in all_[1:]:
        whole = whole.unionByName(more)
    return pin(whole.select("words", F.size("words").alias("size"), "f")), vocabulary, totals


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", best: int = BEST, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases of two to four words."""
    phrases, vocabulary, totals = phrase_counts(docs, text=text, lang=lang, lookup_rows=lookup_rows)
    counts = phrases.select(F.col("words").alias("part"), F.col("f").alias("part_f"))
    cuts = phrases.where("size > 1").select("words", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("words", F.lit(1), F.col("k")).alias("first"), F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cuts = cuts.join(counts.withColumnsRenamed({"part": "first", "part_f": "l"}), "first").join(counts.withColumnsRenamed({"part": "rest", "part_f": "r"}), "rest")
    score = F.expr(f"({FACTOR} * CAST(a AS DECIMAL(38, 0))) div CAST(l + r AS DECIMAL(38, 0))")
    scored = cuts.withColumn("score", score).groupBy("words").agg(
        F.first("size").alias("size"), F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # A phrase gives way to a longer one that it nearly always stands in.
    inner = phrases.where("size > 2").select(F.col("f").alias("longer"), "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inner = inner.select("longer", "words", "size", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("p")).select(
        F.slice("words", F.col("p"), F.col("m")).alias("words"), "longer").groupBy("words").agg(F.max("longer").alias("longer"))
    kept = scored.join(inner, "words", "left").where(
        F.col("longer").isNull() | (F.lit(100).cast("decimal(38,0)") * F.col("longer") < F.lit(SHARE).cast("decimal(38,0)") * F.col("a")))
    named = kept.select(F.struct("words", "a", "cut").alias("row"), F.posexplode("words").alias("at", "id")).join(vocabulary.select("id", "lang", "word"), "id")
    named = named.groupBy("row").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w")).select(
        "lang", F.array_join(F.transform("w", lambda x: x["word"].cast("string")), " ").alias("phrase"), "row.a", "row.cut.l", "row.cut.r", "row.cut.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    top = named.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= best)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
