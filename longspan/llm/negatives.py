"""Hard negatives by an inverted multi-index.

A codebook for each half of the vectors, fitted on a bounded sample, gives every row a cell: the pair of its nearest centroids.
With a half's centroid and the radius of all rows at it, a half-score is at most ``q.c + |q| * radius``, and a row's score at most
the sum of its cell's two. A heap visits the cells in the order of these sums without listing all pairs of centroids.

Two searches run. The first finds an anchor's positives, its best rows of the same label: the visit ends when the next cell's bound
is below the last positive. Each positive sets a window of scores; the second finds the best rows of other labels in it: a window is
certified when the next bound is below its lower end or below its last negative, and the visit ends when all are.

Rows lie in strips ordered by cell, so a hot cell is split like any other. An anchor's first search runs in its own strip; that gives
a floor, and then only strips with an open cell are searched: one whose bound reaches the floor, or the lowest window. All rows are
indexed and all bounds hold for all rows, so results don't depend on the sample, the codebooks or the strips.

Rows with a null label, a null vector or a null, NaN or infinite component take no part. Rows are told apart by their place; an
absent id is no anchor, comes last among ties and is returned as null. Fewer rows than asked for are all returned; an empty table
gives no rows. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longspan.llm.vectors import STRIP_ROWS, Rows, integer_vectors, meet, numbered, packed, products, rows_of, widened
from longspan.llm.words import map_batches
from longspan.session import pin

#: Positives of an anchor, negatives of a positive, window in hundredths of the positive's score, factor before the floor.
POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 3, 50, 95, 256
#: Centroids of a half, rows that they are fitted on, and rounds of the fit.
CODES, SAMPLE_ROWS, ROUNDS = 32, 8192, 8
#: Rows gathered from visited cells before they are multiplied.
BATCH_ROWS = 512
SLACK = 1e-9
LOWEST, HIGHEST = -(2 ** 62), 2 ** 62
_FOUND = "place bigint, anchor_id bigint, wanted bigint, candidate bigint, vec_id bigint, score bigint"


@dataclass
class Codebooks:
    """Centroids of the two halves and, once all rows have a cell, the greatest distance of a row from each."""

    centroids: tuple[np.ndarray, np.ndarray]
    radius: tuple[np.ndarray, np.ndarray] | None = None

    @property
    def width(self) -> int:
        return sum(c.shape[1] for c in self.centroids)

    def halves(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = widened(v, self.width)
        cut = self.centroids[0].shape[1]
        return v[:, :cut], v[:, cut:]

    def bounds(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector and centroid of a half, what a row's half-score cannot exceed."""
        out = []
        for half, centroids, radius in zip(self.halves(v), self.centroids, self.radius, strict=True):
            length = np.sqrt((half * half).sum(axis=1))
            bound = half @ centroids.T + length[:, None] * radius
            out.append(bound + SLACK * (1 + np.abs(bound) + length[:, None] * np.sqrt((centroids * centroids).sum(axis=1))))
        return out[0], out[1]


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, and its distance."""
    code = ((centroids * centroids).sum(axis=1) - 2 * (v @ centroids.T)).argmin(axis=1)
    gap = v - centroids[code]
    return code, np.sqrt((gap * gap).sum(axis=1))


def fit(sample: np.ndarray, codes: int = CODES, rounds: int = ROUNDS, seed: int = 11) -> Codebooks:
    """Lloyd's rounds on each half of a sample of vectors."""
    cut = -(-sample.shape[1] // 2)
    random, out = np.random.default_rng(seed), []
    for half in (sample[:, :cut], sample[:, cut:]):
        apart = np.unique(half, axis=0) if half.shape[1] else half[:1]
        centroids = apart[random.permutation(len(apart))[:codes]]
        for _ in range(rounds if half.shape[1] else 0):
            code, _ = nearest(half, centroids)
            rows = np.bincount(code, minlength=len(centroids))
            total = np.zeros_like(centroids)
            np.add.at(total, code, half)
            centroids = np.where(rows[:, None] > 0, total / np.maximum(rows, 1)[:, None], centroids)
        out.append(centroids)
    return Codebooks((out[0], out[1]))


def descending_sums(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """``first[i] + second[j]`` and (i, j) from the largest sum on, for two descending arrays."""
    if not len(first) or not len(second):
        return
    a, b = first.tolist(), second.tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, i, j
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if not j and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


class Wanted:
    """The best ``k`` rows found with a score from ``low`` to ``high``; ``need`` is what a further row must reach."""

    def __init__(self, low: int, high: int, k: int):
        self.need, self.high, self.k = low, high, k
        self.score = self.rank = np.zeros(0, np.int64)

    def add(self, score: np.ndarray, rank: np.ndarray) -> None:
        good = (score >= self.need) & (score <= self.high)
        if not good.any():
            return
        score, rank = np.concatenate((self.score, score[good])), np.concatenate((self.rank, rank[good]))
        best = np.lexsort((rank, -score))[:self.k]
        self.score, self.rank = score[best], rank[best]
        if len(best) == self.k:
            self.need = max(self.need, int(self.score[-1]))


class Strip:
    """Rows ordered by cell and label, with the places where each cell and each label in it begin."""

    def __init__(self, rows: Rows, books: Codebooks):
        self.rows, self.books, self.v = rows, books, widened(rows.v, books.width)
        self.rank = np.empty(len(rows), np.int64)
        self.rank[np.lexsort((rows["place"], rows["id"]))] = np.arange(len(rows))
        first, second = rows["first"], rows["second"]
        self.codes = np.unique(first), np.unique(second)
        run = np.concatenate(([True], (np.diff(first) != 0) | (np.diff(second) != 0) | (np.diff(rows["label"]) != 0)))
        start = np.flatnonzero(run)
        self.runs: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for a, b in zip(start.tolist(), np.append(start[1:], len(rows)).tolist(), strict=True):
            self.runs.setdefault((int(first[a]), int(second[a])), []).append((int(rows["label"][a]), a, b))

    def visit(self, query: np.ndarray, place: int, label: int, same: bool, wanted: list[Wanted], bounds) -> None:
        """Fill ``wanted`` from cells by descending bound, until no cell left can matter."""
        codes = [c[np.argsort(-b[c], kind="stable")] for c, b in zip(self.codes, bounds, strict=True)]
        need, held, n = min(w.need for w in wanted), [], 0

        def multiply() -> None:
            at = np.concatenate([np.arange(a, b) for a, b in held])
            at = at[self.rows["place"][at] != place]
            score = products(query[None], self.v[at])[0].astype(np.int64)
            for w in wanted:
                w.add(score, self.rank[at])

        for bound, i, j in descending_sums(bounds[0][codes[0]], bounds[1][codes[1]]):
            if bound < need:
                break
            for other, a, b in self.runs.get((int(codes[0][i]), int(codes[1][j])), ()):
                if (other == label) == same:
                    held.append((a, b))
                    n += b - a
            if n >= BATCH_ROWS:
                multiply()
                held, n, need = [], 0, min(w.need for w in wanted)
        if held:
            multiply()


def _searcher(books: Codebooks, same: bool, k: int):
    """Query rows are (anchor, window); those of an anchor are visited together."""
    def run(queries: Rows, targets: Rows):
        strip = Strip(targets, books)
        row = np.lexsort((targets["place"], targets["id"]))
        order = np.lexsort((queries["wanted"], queries["place"]))
        cut = np.flatnonzero(np.concatenate(([True], np.diff(queries["place"][order]) != 0)))
        firsts = queries.take(order[cut])
        bounds = books.bounds(firsts.v)
        vectors = widened(firsts.v, books.width)
        out = []
        for q, (a, b) in enumerate(zip(cut.tolist(), np.append(cut[1:], len(order)).tolist(), strict=True)):
            windows = [Wanted(int(queries["low"][x]), int(queries["high"][x]), k) for x in order[a:b]]
            strip.visit(vectors[q], int(firsts["place"][q]), int(firsts["label"][q]), same, windows, (bounds[0][q], bounds[1][q]))
            for x, w in zip(order[a:b], windows, strict=True):
                out += [(int(x), int(r), int(s)) for r, s in zip(w.rank, w.score, strict=True)]
        if out:
            x, r, s = np.array(out, np.int64).T
            at = row[r]
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries["place"][x]), pa.array(queries["id"][x]), pa.array(queries["wanted"][x]), pa.array(targets["place"][at]),
                 pa.array(targets["id"][at], mask=targets["known"][at] == 0), pa.array(s)],
                names=["place", "anchor_id", "wanted", "candidate", "vec_id", "score"])
    return run


def _open_cells(queries: DataFrame, books: Codebooks) -> DataFrame:
    """``query, first, second``: the cells whose bound reaches the lowest score that some anchor of the strip still wants."""
    def run(batches):
        for batch in batches:
            rows, strips = rows_of(batch, ["strip", "low"]), np.asarray(batch.column("strip"))
            a, b = books.bounds(rows.v)
            for strip in np.unique(strips):
                of = np.flatnonzero(strips == strip)
                open_ = np.zeros((a.shape[1], b.shape[1]), bool)
                for q in of:
                    open_ |= a[q][:, None] + b[q][None, :] >= rows["low"][q]
                first, second = np.nonzero(open_)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), strip)), pa.array(first), pa.array(second)],
                                                 names=["query", "first", "second"])
    return map_batches(queries.select("strip", "low", "v"), run, "query bigint, first bigint, second bigint")


def codebooks(rows: DataFrame, width: int, codes: int, sample_rows: int) -> Codebooks:
    """Fitted on the ``sample_rows`` rows that come first by a hash of their id and place."""
    sample = rows.select("id", "place", "v").orderBy(F.xxhash64("id", "place"), "place").limit(sample_rows).select("v").toArrow()
    parts = [widened(rows_of(b, []).v, width) for b in sample.to_batches()]
    return fit(np.concatenate(parts), codes)


def with_cells(rows: DataFrame, books: Codebooks) -> DataFrame:
    """The rows with their cell and their distance from its two centroids."""
    names = [c for c in rows.columns]

    def run(batches):
        for batch in batches:
            a, b = books.halves(rows_of(batch, []).v)
            (first, far), (second, off) = nearest(a, books.centroids[0]), nearest(b, books.centroids[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in (first, second, far, off))],
                                             names=[*batch.schema.names, "first", "second", "far", "off"])

    schema = rows.schema
    for n, t in (("first", "long"), ("second", "long"), ("far", "double"), ("off", "double")):
        schema = schema.add(n, t)
    return map_batches(rows.select(names), run, schema)


def _with_radii(rows: DataFrame, books: Codebooks) -> Codebooks:
    radii = []
    for code, far, centroids in (("first", "far", books.centroids[0]), ("second", "off", books.centroids[1])):
        radius = np.zeros(len(centroids))
        for r in rows.groupBy(code).agg(F.max(far).alias("m")).collect():  # one row for each centroid
            radius[r[0]] = r["m"] * (1 + SLACK)
        radii.append(radius)
    return Codebooks(books.centroids, (radii[0], radii[1]))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("place", "wanted").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "candidate")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                   is_anchor: Column | None = None, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, scale: int = SCALE, codes: int = CODES, sample_rows: int = SAMPLE_ROWS,
                   strip_rows: int = STRIP_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, the best negatives of each positive of each anchor.

    Anchors are by default the rows whose id divides by ``every``. A negative's score is ``low`` to ``high`` hundredths of its
    positive's.
    """
    spark = vectors.sparkSession
    asked = F.pmod(F.col(vec_id), F.lit(every)) == 0 if is_anchor is None else is_anchor
    rows = pin(integer_vectors(vectors, scale, vec_id, vector, label=F.col(label) if isinstance(label, str) else label,
                               asked=F.coalesce(asked, F.lit(False))))
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    books = codebooks(rows, width, codes, sample_rows)
    rows = numbered(with_cells(rows, books), [F.col(c) for c in ("first", "second", "label", "id", "place")], 4 * strip_rows)
    rows = rows.withColumn("strip", F.floor(F.col("number") / strip_rows))
    books = _with_radii(rows, books)
    names, asks = ["place", "id", "known", "label", "first", "second"], ["place", "id", "label", "wanted", "low", "high"]
    targets = pin(packed(rows, names))
    cells = pin(rows.select("strip", "first", "second").distinct())

    def search(queries: DataFrame, same: bool, k: int, skip_own: bool) -> DataFrame:
        needs = _open_cells(queries, books).distinct().join(cells, ["first", "second"]).select("strip", "query").distinct()
        needs = pin(needs.where("strip <> query") if skip_own else needs)
        return meet(targets, names, packed(queries, asks), asks, needs, _searcher(books, same, k), _FOUND)

    anchors = rows.where("asked = 1").select("strip", "number", "place", "id", "label", "v")
    whole = anchors.select("*", F.lit(0).cast("bigint").alias("wanted"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"))
    own = anchors.select("strip", F.col("strip").alias("query")).distinct()
    home = pin(meet(targets, names, packed(whole, asks), asks, own, _searcher(books, True, positives), _FOUND))
    floors = home.groupBy("place").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == positives).drop("n")
    whole = pin(whole.join(floors, "place", "left").withColumn("low", F.coalesce("floor", "low")).drop("floor"))
    chosen = pin(_best(home.unionByName(search(whole, True, positives, True)), positives))
    # 100 n is from 50 p to 95 p: whole scores from the ceiling of the one to the floor of the other.
    window = chosen.select("place", F.col("rank").cast("bigint").alias("wanted"),
                           F.expr(f"{low} * score div 100 + int(pmod({low} * score, 100) <> 0 AND {low} * score > 0)").alias("low"),
                           F.expr(f"{high} * score div 100 - int(pmod({high} * score, 100) <> 0 AND {high} * score < 0)").alias("high"))
    asked_for = pin(anchors.join(window.where("low <= high"), "place"))
    found = _best(search(asked_for, False, negatives, False), negatives)
    positive = chosen.select("place", F.col("rank").cast("bigint").alias("wanted"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(positive, ["place", "wanted"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                                                           "positive_score", F.col("score").alias("negative_score"))
