"""Substring deduplication: paragraph MinHash banding.

Paragraphs are blocks of a text: from a cut, the fewest stretches between cuts with at least ``MIN_WORDS`` words. A text is cut
after words whose hash is the smallest of the ``APART`` words on either side, where sentence marks and empty lines go before all
other words; so copies are cut alike wherever they stand, text without marks is cut as often, and line ends have no part in it: a
passage is cut alike in lines of any width. Each line of ``MIN_WORDS`` words and more also has a block at its start and one at its
end. Every start is taken, so blocks overlap, and each whole block of a copied passage is found in every copy, at any place and
behind any text. Cuts are far enough apart that blocks of one text are similar only where one holds the other or both start alike.

Equal paragraphs are one content, told once a task before the shuffle. Of a paragraph only its place, the hash of its words, the
hashes of its MinHash bands and a sketch of its shingles are stored; words are cut from the texts again for contents that may be
linked, so the documents are read twice and must be the same both times. Contents whose bands collide are verified by exact
Jaccard similarity of their word shingles, and the links that hold make components. The sketches of a pair (how many shingles, and
the parity of those that fall on each bit) bound its similarity from above: pairs that cannot reach the threshold are dropped
where the bucket is read, and no others. In a bucket of up to ``FEW`` contents all pairs are looked at. In a larger one nothing is
told pairwise: its members are compared with its first content; where that leaves more than one component, members of different
components are compared among themselves, a very large bucket in pairs of chunks, and only what links is told. Shuffle files go as
soon as a step has ended.

The first place of a component stays: smallest document id (absent ids last), then the earlier row, then the earlier word, then
the shorter; all others are removals, but ``remove_repeats`` leaves those that overlap the first place itself. Null and empty
texts, and texts with fewer than ``MIN_WORDS`` words, have no paragraph. Repeated rows repeat each other. Other columns are kept
by ``remove_repeats``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longspan.llm.components import components
from longspan.llm.words import ALNUM, FOLD, blocks, map_batches, mix, raw_bytes, shingles, words
from longspan.session import brief_shuffles, pin, scratch_path

#: Words of a paragraph at least, words of a shingle, and similarity that links.
MIN_WORDS, WIDTH, SIMILARITY = 16, 5, 0.8
#: Share of linked pairs whose bands must collide.
RECALL = 0.99
#: Contents of a bucket up to which all its pairs are looked at.
FEW = 16
#: Members of a bucket that one task compares; larger buckets are compared in pairs of such chunks.
CHUNK = 4000
#: Contents a task remembers in order to tell each once; it forgets them beyond that, which only repeats rows.
REMEMBERED = 2_000_000
_ENDS = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))
#: Sentence marks beyond ASCII, which are part of the word before them.
_WIDE_ENDS = np.array([int.from_bytes(c.encode(), "big") for c in "\u3002\uff01\uff1f\uff0e\uff61\u2026\u203c\u061f\u06d4\u0964\u0965\u0589\u1362"])
#: Cuts are more than so many words apart.
APART = 5
#: Bits of a bucket's key that are the sketch of its content: parities, and above them how many shingles (0: not sketched).
_PARITY, _SKETCH = 18, 24
_MOST = (1 << _SKETCH - _PARITY) - 1
#: Bytes of words lower-cased, all others a space.
_SPACED = np.where(ALNUM[FOLD], FOLD, 0x20).astype(np.uint8).tobytes()


def run_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of bytes."""
    import xxhash
    one, data = xxhash.xxh3_64_intdigest, data.tobytes()
    return np.fromiter((one(data[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)), np.uint64, len(start))


def _cuts(value: np.ndarray, text: np.ndarray, n_texts: int, apart: int = APART) -> np.ndarray:
    """Which words have a smaller value than the words around them in their text; of equal ones the first."""
    place = np.arange(len(value)) + apart * (text + 1)
    around = np.full(len(value) + apart * (n_texts + 1), np.iinfo(np.uint64).max, np.uint64)
    around[place] = value
    least = np.ones(len(value), bool)
    for k in range(1, apart + 1):
        least &= (value < around[place - k]) & (value <= around[place + k])
    return least


def blocks_of(texts: pa.Array, min_words: int = MIN_WORDS):
    """The words of the texts, their hashes, and the first and last-but-one words of the blocks."""
    found = words(texts, ALNUM, fold=True)
    n = len(found.ids)
    none = np.zeros(0, np.int64)
    if not n:
        return found, np.zeros(0, np.uint64), none, none
    spelled, edge = raw_bytes(found.dictionary)
    hashed = run_hashes(spelled, edge[:-1], edge[1:])[found.ids]
    data = found.data
    newline = np.concatenate((np.zeros(1, np.int32), np.cumsum(data == 0x0A, dtype=np.int32)))
    text = found.text_of
    last = np.append(text[1:] != text[:-1], True)
    breaks = np.append(newline[found.start[1:]] - newline[found.end[:-1]], 0)
    marked = _ENDS[np.append(data, 0x20)[found.end]] | (breaks > 1)
    wide = np.flatnonzero(data[found.end - 1] >= 0x80)
    letter = np.zeros(len(wide), np.int64)
    for k in (3, 2, 1):
        letter = letter << 8 | data[np.maximum(found.end[wide] - k, 0)]
    marked[wide] |= np.isin(letter, _WIDE_ENDS) | np.isin(letter & 0xFFFF, _WIDE_ENDS)
    value = hashed >> np.uint64(1) | (~marked).astype(np.uint64) << np.uint64(63)
    ends = last | _cuts(value, text, len(found.counts))
    begins = np.concatenate(([True], ends[:-1]))
    text_end = found.first[1:][text]

    def stops_of(start: np.ndarray) -> np.ndarray:
        """Past the last word of the fewest stretches from there; beyond the text where they are too few."""
        at = np.searchsorted(stops, start + min_words)
        return np.append(stops, n + 1)[at]

    stops, start = np.flatnonzero(ends) + 1, np.flatnonzero(begins)
    stop = stops_of(start)
    whole = stop <= text_end[start]
    start, stop = start[whole], stop[whole]
    # the first and the last block of a line
    line_end = np.flatnonzero(last | (breaks > 0)) + 1
    line = np.concatenate(([0], line_end[:-1]))
    long = line_end - line >= min_words
    line, line_end = line[long], line_end[long]
    opened = np.append(np.flatnonzero(begins), n)
    back = np.maximum(opened[np.searchsorted(opened, line_end - min_words, side="right") - 1], line)
    start = np.concatenate((start, line, back))
    stop = np.concatenate((stop, np.minimum(stops_of(line), line_end), line_end))
    both = np.unique(start * (n + 1) + stop)
    return found, hashed, both // (n + 1), both % (n + 1)


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = 2) -> tuple[int, int]:
    """Bands and rows of a band: the fewest bands of ``rows`` minima that find a pair at the threshold with the wanted recall."""
    bands = 1
    while 1 - (1 - similarity ** rows) ** bands < recall:
        bands += 1
    return bands, rows


def band_values(every: np.ndarray, start: np.ndarray, end: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """MinHash bands (columns) of runs of shingles (rows), cut down to the bits beside the sketch."""
    edge = np.column_stack((start, end)).ravel()
    out = np.zeros((len(start), bands), np.int64)
    for b in range(bands):
        value = np.full(len(start), b, np.uint64)
        for r in range(rows):
            salt = mix(np.array([b * rows + r + 1], np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            value = mix(value ^ np.minimum.reduceat(mix(every ^ salt), edge)[::2])
        out[:, b] = (value >> np.uint64(_SKETCH)).view(np.int64)
    return out


def sketches(every: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Number and parities of the shingles of runs; 0 where a shingle comes twice or there are too many to count."""
    before, short = np.full(len(every), -1), every.astype(np.uint32)
    for k in range(1, min(_MOST, len(every))):
        at = np.flatnonzero(short[k:] == short[:-k]) + k
        before[at] = np.maximum(before[at], at - k)
    twice = np.maximum.reduceat(before, np.column_stack((start, end)).ravel())[::2] >= start
    parity = np.zeros(len(every) + 1, np.int64)
    parity[1:] = np.bitwise_xor.accumulate(np.int64(1) << (mix(every) % np.uint64(_PARITY)).astype(np.int64))
    size = end - start
    return np.where(twice | (size > _MOST), 0, size << _PARITY | parity[start] ^ parity[end])


def may_link(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Whether sketches leave it open that the Jaccard similarity reaches the threshold. Parities differ in no more bits than there
    are shingles in one of the sets alone, and of sets at the threshold those are few."""
    m, n = a >> _PARITY, b >> _PARITY
    alone = np.maximum(np.abs(m - n), np.bitwise_count((a ^ b) & ((1 << _PARITY) - 1)))
    return (a == 0) | (b == 0) | (alone <= (m + n) * (1 - similarity) / (1 + similarity) + 1e-6)


def _paragraphs(docs: DataFrame, doc_id: str, text: str, min_words: int, bands: int, rows: int) -> DataFrame:
    """One row per paragraph: its content's hash, where it stands (words and bytes, and the hash of the text), and, each content once
    a task, bands and sketch."""
    def run(batches):
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for block in blocks(batch, "_text"):
                found, hashed, start, stop = blocks_of(block.column("_text"), min_words)
                if not len(start):
                    continue
                content = run_hashes(hashed, 8 * start, 8 * stop).view(np.int64)
                distinct, at = np.unique(content, return_index=True)
                new = ~np.isin(distinct, seen)
                seen = np.union1d(seen if len(seen) < REMEMBERED else seen[:0], distinct[new])
                at = np.sort(at[new])
                every = shingles(np.concatenate((hashed, np.zeros(WIDTH, np.uint64))), WIDTH)
                first, end = start[at], np.maximum(stop[at] - WIDTH, start[at]) + 1
                told = np.zeros(len(start), np.int64)
                told[at] = bands
                sketch = np.zeros(len(start), np.int32)
                sketch[at] = sketches(every, first, end)
                values = pa.array(band_values(every, first, end, bands, rows).ravel())
                row = found.text_of[start]
                of = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [*(block.column(c).take(of) for c in ("place", "doc", "text_id")), pa.array(start - found.first[row]), pa.array(stop - start),
                     pa.array(found.start[start] - found.offsets[row]), pa.array(found.end[stop - 1] - found.offsets[row]), pa.array(content),
                     pa.array(sketch), pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(told))), pa.int32()), values)],
                    names=["place", "doc", "text_id", "first_word", "n_words", "first_byte", "end_byte", "content", "sketch", "bands"])

    source = docs.select("place", F.col(doc_id).cast("bigint").alias("doc"), _text_id(text), F.col(text).cast("string").alias("_text"))
    return map_batches(source, run, "place bigint, doc bigint, text_id bigint, first_word bigint, n_words bigint, first_byte bigint, "
                                    "end_byte bigint, content bigint, sketch int, bands array<bigint>")


def _text_id(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string")).alias("text_id")


def _bucket_pairs(paragraphs: DataFrame, similarity: float, few: int) -> DataFrame:
    """``a, b, bucket``: contents of a bucket that may be linked (bucket null), or, where a bucket has more than ``few``, its first
    content and each of its contents. Buckets of one content are left out."""
    def buckets_of(key, content):
        bucket = key >> _SKETCH
        same = bucket[1:] == bucket[:-1]
        more = np.append(same, False) | np.append(False, same)
        key, content = key[more], content[more]
        order = np.lexsort((content, key))
        key, content = key[order], content[order]
        new = np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1]))[:len(key)]
        key, content = key[new], content[new]
        if not len(key):
            return
        bucket, sketch = key >> _SKETCH, key & ((1 << _SKETCH) - 1)
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        size = np.diff(np.append(first, len(key)))
        of = np.repeat(np.arange(len(first)), size)
        place, n = np.arange(len(key)) - first[of], size[of]
        a, b, large = [], [], n > few
        for k in range(1, few):
            i = np.flatnonzero(~large & (place + k < n))
            if not len(i):
                break
            i = i[may_link(sketch[i], sketch[i + k], similarity)]
            a.append(np.minimum(content[i], content[i + k]))
            b.append(np.maximum(content[i], content[i + k]))
        a.append(content[first[of[large]]])
        b.append(content[large])
        told = sum(map(len, a[:-1]))
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            bucket = pa.array(np.concatenate((np.zeros(told, np.int64), bucket[large])), mask=np.arange(len(a)) < told)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), bucket], names=["a", "b", "bucket"])

    def run(batches):
        held = []
        for batch in batches:
            key, content = (np.asarray(batch.column(c)) for c in ("key", "content"))
            if not len(key):
                continue
            last = int(np.searchsorted(key >> _SKETCH, key[-1] >> _SKETCH))
            if last or held and held[-1][0][-1] >> _SKETCH != key[0] >> _SKETCH:  # what came before the last bucket is whole
                held.append((key[:last], content[:last]))
                yield from buckets_of(*map(np.concatenate, zip(*held, strict=True)))
                held = []
            held.append((key[last:], content[last:]))
        if held:
            yield from buckets_of(*map(np.concatenate, zip(*held, strict=True)))

    told = paragraphs.select(F.explode("bands").alias("band"), "sketch", "content")
    told = told.select(F.shiftleft("band", _SKETCH).bitwiseOR(F.col("sketch").cast("bigint")).alias("key"), "content")
    told = told.repartition(F.shiftright("key", _SKETCH)).sortWithinPartitions("key")
    return map_batches(told, run, "a bigint, b bigint, bucket bigint")


def _texts(docs: DataFrame, text: str, paragraphs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``content, words`` of the wanted contents, each cut from one text in which it stands."""
    spans = paragraphs.select("content", "text_id", "first_byte", "end_byte")
    spans = spans.join(wanted.hint("shuffle_hash"), "content", "left_semi")
    spans = spans.dropDuplicates(["content"]).groupBy("text_id").agg(F.collect_list(F.struct("content", "first_byte", "end_byte")).alias("spans"))
    whole = docs.where(F.col(text).isNotNull()).select(_text_id(text), F.col(text).cast("string").alias("_text")).groupBy("text_id").agg(F.first("_text").alias("_text"))

    def run(batches):
        for block in (b for batch in batches for b in blocks(batch, "_text")):
            contents, cut = [], []
            for t, spans in zip(block.column("_text").cast(pa.binary()), block.column("spans").to_pylist(), strict=True):
                data = t.as_py().translate(_SPACED)
                contents += [s["content"] for s in spans]
                cut += [b" ".join(data[s["first_byte"]:s["end_byte"]].split()).decode() for s in spans]
            yield pa.RecordBatch.from_arrays([pa.array(contents, pa.int64()), pa.array(cut, pa.string())], names=["content", "words"])

    return map_batches(whole.join(spans, "text_id").select("_text", "spans"), run, "content bigint, words string")


def word_shingles(text: str, width: int = WIDTH) -> frozenset[tuple[str, ...]]:
    """Runs of ``width`` words; fewer words are one run."""
    w = text.split(" ")
    return frozenset(zip(*(w[k:] for k in range(width)), strict=False)) if len(w) > width else frozenset([tuple(w)])


def similar(a: frozenset, b: frozenset, similarity: float = SIMILARITY) -> bool:
    """Whether the Jaccard similarity reaches the threshold."""
    both = len(a & b)
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` of contents that are similar."""
    def run(batches):
        for batch in batches:
            keep = [similar(word_shingles(x), word_shingles(y), similarity)
                    for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(texts.select(F.col("content").alias("a"), F.col("words").alias("left")), "a")
    joined = joined.join(texts.select(F.col("content").alias("b"), F.col("words").alias("right")), "b")
    return map_batches(joined.select("a", "b", "left", "right"), run, "a bigint, b bigint")


def _candidates(sets: list[frozenset], similarity: float) -> Iterator[tuple[int, int]]:
    """Pairs of places that share one of their rarest shingles, as similar sets must: of n shingles, more than
    ``(1 - similarity) * n`` in any common order hold one of the other set's."""
    times: dict[tuple, int] = {}
    for s in sets:
        for x in s:
            times[x] = times.get(x, 0) + 1
    holders: dict[tuple, list[int]] = {}
    for i, s in enumerate(sets):
        own = sorted(s, key=lambda x: (times[x], x))
        for x in own[:len(s) - int(np.ceil(similarity * len(s) - 1e-9)) + 1]:
            if times[x] > 1:
                holders.setdefault(x, []).append(i)
    for places in holders.values():
        for k, j in enumerate(places):
            for i in places[:k]:
                yield i, j


def _compare(rows: list[tuple], similarity: float) -> Iterator[tuple[int, int]]:
    """Links between members of different components: rows are (component, content, words), told as a forest."""
    sets = [word_shingles(r[2]) for r in rows]
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    tried = set()
    for i, j in _candidates(sets, similarity):
        a, b = find(rows[i][0]), find(rows[j][0])
        if a == b or (i, j) in tried:
            continue
        tried.add((i, j))
        if similar(sets[i], sets[j], similarity):
            root[max(a, b)] = min(a, b)
            yield rows[i][1], rows[j][1]


def _residual(members: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float, chunk: int) -> DataFrame:
    """Links inside buckets that still hold more than one component."""
    joined = members.join(roots, F.col("content") == F.col("node"), "left").select(
        "bucket", "content", F.coalesce("root", "content").alias("root"))
    joined = pin(joined)
    open_ = joined.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    open_ = pin(open_.where("low < high").select("bucket", F.ceil(F.col("n") / chunk).cast("int").alias("k")))
    split = joined.join(open_, "bucket")
    own = F.pmod(F.xxhash64("content"), F.col("k")).cast("int")
    rows = split.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "root", "content")
    rows = rows.join(texts, "content").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def run(batches):
        key, held = None, []

        def links():
            found = list(_compare(held, similarity)) if len(held) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

        for batch in batches:
            for b, i, j, root, content, text in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                if (b, i, j) != key:
                    yield from links()
                    key, held = (b, i, j), []
                held.append((root, content, text))
        yield from links()

    return map_batches(rows.select("bucket", "i", "j", "root", "content", "words"), run, "a bigint, b bigint")


def _classes(docs: DataFrame, text: str, paragraphs: DataFrame, similarity: float, chunk: int) -> DataFrame:
    """``node, root`` of the contents that are linked to others."""
    told = pin(_bucket_pairs(paragraphs, similarity, min(FEW, chunk)))
    members = told.where("bucket IS NOT NULL").select("bucket", F.col("b").alias("content"))
    pairs = pin(told.where("a != b").select("a", "b").distinct())
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("content")).distinct()
    texts = pin(_texts(docs, text, paragraphs, wanted))
    links = pin(_verify(pairs, texts, similarity))
    roots = pin(components(links))
    more = pin(_residual(members, roots, texts, similarity, chunk))
    return _joined(roots, more) if more.limit(1).count() else roots


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """``node, root`` after more links between the components and contents that are in none."""
    ends = more.join(roots.select(F.col("node").alias("a"), F.col("root").alias("left")), "a", "left")
    ends = ends.join(roots.select(F.col("node").alias("b"), F.col("root").alias("right")), "b", "left")
    up = pin(components(ends.select(F.coalesce("left", "a").alias("a"), F.coalesce("right", "b").alias("b"))))
    moved = roots.join(up.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return moved.select("node", F.coalesce("top", "root").alias("root")).unionByName(up.join(roots, "node", "left_anti"))


def _held(docs: DataFrame, doc_id: str, text: str, min_words: int, bands: int, rows: int) -> DataFrame:
    path = scratch_path(docs.sparkSession, "paragraphs")
    _paragraphs(docs, doc_id, text, min_words, bands, rows).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def _order() -> Column:
    return F.struct(F.col("doc").isNull().alias("none"), F.col("doc").alias("doc"), F.col("place").alias("place"),
                    F.col("first_word").alias("first_word"), F.col("n_words").alias("n_words"), F.col("end_byte").alias("end_byte"))


def _members(docs: DataFrame, doc_id: str, text: str, similarity: float, recall: float, min_words: int,
             chunk: int) -> DataFrame:
    with brief_shuffles(docs.sparkSession):
        paragraphs = _held(docs, doc_id, text, min_words, *tune_bands(similarity, recall))
        roots = pin(_classes(docs, text, paragraphs, similarity, chunk))
        light = paragraphs.drop("text_id", "sketch", "bands")
        copied = light.groupBy("content").agg(F.count("*").alias("n")).where("n > 1").select(F.col("content").alias("node"))
        classes = copied.join(roots, "node", "full").select(F.col("node").alias("content"), F.coalesce("root", "node").alias("class_id"))
        members = pin(light.join(pin(classes).hint("shuffle_hash"), "content"))
        first = pin(members.groupBy("class_id").agg(F.min(_order()).alias("first"), F.count("*").alias("n")).where("n > 1"))
    return members.join(first.drop("n"), "class_id")


def repeated_passages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                      recall: float = RECALL, min_words: int = MIN_WORDS, chunk: int = CHUNK) -> DataFrame:
    """Each paragraph that stands, exactly or nearly, at another place too: where it stands, its class, the class's first place,
    and whether it is removed (all but that first place are)."""
    placed = docs.select(F.monotonically_increasing_id().alias("place"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = _members(placed, "doc_id", "text", similarity, recall, min_words, chunk)
    same = F.col("place").eqNullSafe(F.col("first.place"))
    same &= (F.col("first_word") == F.col("first.first_word")) & (F.col("n_words") == F.col("first.n_words"))
    return found.select(F.col("doc").alias("doc_id"), "first_word", "n_words", "class_id", F.col("first.doc").alias("first_doc_id"),
                        F.col("first.first_word").alias("first_doc_word"), (~same).alias("removed"))


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, with their own columns, without the paragraphs that repeat an earlier one. Of overlapping paragraphs that are
    similar to each other only, none is a repeat."""
    names = docs.columns
    held = pin(docs.select(F.monotonically_increasing_id().alias("place"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")))
    defaults = dict(similarity=SIMILARITY, recall=RECALL, min_words=MIN_WORDS, chunk=CHUNK) | options
    found = _members(held.select("place", F.col("row")[doc_id].alias("doc_id"), F.col("row")[text].alias("text")), "doc_id", "text", **defaults)
    later = found.where((F.col("place") != F.col("first.place")) | (F.col("first_byte") >= F.col("first.end_byte")))
    cuts = later.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("first_byte", "end_byte"))).alias("cuts"))
    joined = held.join(pin(cuts), "place", "left").select("row", F.col("row")[text].alias("text"), "cuts")

    def run(batches):
        for batch in batches:
            out = []
            for t, spans in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist(), strict=True):
                if spans:
                    data, at, parts = t.encode(), 0, []
                    for s in spans:
                        parts.append(data[at:max(at, s["first_byte"])])
                        at = max(at, s["end_byte"])
                    t = b"".join([*parts, data[at:]]).decode()
                out.append(t)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "text"])

    kept = map_batches(joined, run, joined.drop("cuts").schema)
    return kept.select(*[F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in names])
