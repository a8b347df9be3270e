"""Vector code compression: product codes learned over anchors-hierarchy metric trees.

A component x becomes the integer floor(1024 * x); vectors are cut into equal
parts, and each part position has a codebook of up to 256 entries, learned by
rounds of nearest-entry assignment.

Trees.  Slices of at most ``tree`` vectors get a metric tree for each part
position, built middle-out: about sqrt(n) anchors are drawn, each the point
furthest from its anchor so far, which takes over only points that the
triangle inequality leaves open; each anchor's points become a subtree; and
the balls are merged upwards, always the two with the smallest common ball.
Every ball caches the count and the component sums of its rows; equal points
of a slice are one point with a count.

Rounds.  A round walks down from the root with the list of entries that may
own points of the ball.  An entry goes when it is further from the centre
than the nearest one by more than the ball's diameter, and the children
inherit what is left.  When one entry is left the ball is wholly owned: its
cached count and sums are added, and its points are not looked at.  In
leaves the entries left are compared exactly, in integers.  Tasks add up
their trees, so a round shuffles at most parts x entries rows a task.  Trees
are written once; a round reads them and the codebooks only (parts x entries
x components numbers, at any input size).

Defined cases: vectors that are null or empty, or hold null or non-finite
components, are dropped, and so are those whose length is not that of the
smallest kept vec_id; a length that is no multiple of the number of parts is
cut at floor(length * p / parts); components beyond +-2**17 count as +-2**17,
so that all sums are exact; rows that share a vec_id are a row each, ordered
by their components, and a null vec_id comes last in the first codebook; an
empty table gives no rows; columns besides vec_id, embedding and label are
not read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
TREE, LEAF = 2048, 32
#: Largest magnitude of a component, in units of 1/SCALE.
_MOST = 1 << 27
#: Below this the squared distances of parts are exact in double precision.
_EXACT = 1 << 20


def quantized(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(np.asarray(x, np.float64).clip(-1e6, 1e6) * SCALE), -_MOST, _MOST).astype(np.int64)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points, a row for each of ``a``."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < _EXACT and a.shape[1] <= 1024:
        a, b = a.astype(np.float64), b.astype(np.float64)
        return (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.stack([((b - x) ** 2).sum(1) for x in a]) if len(a) else np.zeros((0, len(b)), np.int64)


def _anchors(x: np.ndarray, most: int) -> np.ndarray:
    """The anchor that owns each point."""
    owner, at = np.zeros(len(x), np.int64), [0]
    dist = np.sqrt(((x - x[0]) ** 2).sum(1))
    while len(at) < most and dist[far := int(dist.argmax())] > 0:
        gap = np.sqrt(((x[at] - x[far]) ** 2).sum(1))
        # a point closer to its anchor than half the way to the new one stays
        open_ = np.flatnonzero(2 * dist >= gap[owner])
        d = np.sqrt(((x[open_] - x[far]) ** 2).sum(1))
        take = open_[d < dist[open_]]
        owner[take], dist[take] = len(at), d[d < dist[open_]]
        at.append(far)
    return owner


class Tree:
    """A metric tree over the distinct points of a slice."""

    def __init__(self, points: np.ndarray):
        own, self.row, n = np.unique(points, axis=0, return_inverse=True, return_counts=True)
        self.row = self.row.ravel()
        self._x, self._n = own.astype(np.float64), n
        self.center: list[np.ndarray] = []
        self.radius: list[float] = []
        self.sides: list[tuple[int, int] | None] = []
        self._rows: list[np.ndarray] = []
        self.root = self._grow(np.arange(len(own)))
        self._lay(own, n)

    def _ball(self, rows: np.ndarray, sides: tuple[int, int] | None) -> int:
        x = self._x[rows]
        center = (x * self._n[rows, None]).sum(0) / self._n[rows].sum()
        self.center.append(center)
        self.radius.append(float(np.sqrt(((x - center) ** 2).sum(1)).max(initial=0)))
        self.sides.append(sides)
        self._rows.append(rows)
        return len(self.center) - 1

    def _grow(self, rows: np.ndarray) -> int:
        if len(rows) <= LEAF:
            return self._ball(rows, None)
        owner = _anchors(self._x[rows], int(np.ceil(np.sqrt(len(rows)))))
        return self._merged([self._grow(rows[owner == k]) for k in range(int(owner.max()) + 1)])

    def _merged(self, balls: list[int]) -> int:
        """Merge the two balls with the smallest common ball until one is left."""
        c, r = np.stack([self.center[b] for b in balls]), np.array([self.radius[b] for b in balls])
        common = self._common(c[:, None], r[:, None], c, r)
        np.fill_diagonal(common, np.inf)
        alive = list(balls)
        for _ in range(len(balls) - 1):
            i, j = divmod(int(common.argmin()), len(alive))
            new = self._ball(np.concatenate([self._rows[alive[i]], self._rows[alive[j]]]), (alive[i], alive[j]))
            alive[i] = new
            c[i], r[i] = self.center[new], self.radius[new]
            common[j, :] = common[:, j] = np.inf
            gone = np.isinf(common[i])
            common[i] = common[:, i] = np.where(gone, np.inf, self._common(c[i], r[i], c, r))
            common[i, i] = np.inf
            last = new
        return last if len(balls) > 1 else balls[0]

    @staticmethod
    def _common(c1, r1, c2, r2) -> np.ndarray:
        """Radius of the smallest ball that holds two balls."""
        gap = np.sqrt(((c1 - c2) ** 2).sum(-1))
        return np.maximum(np.maximum(r1, r2), (gap + r1 + r2) / 2)

    def _lay(self, own: np.ndarray, n: np.ndarray) -> None:
        """Points in tree order, so that a ball is a range; counts and sums by ball."""
        m = len(self.center)
        order, first, last, stack = [], np.zeros(m, np.int64), np.zeros(m, np.int64), [(self.root, False)]
        at = 0
        while stack:
            ball, done = stack.pop()
            if done:
                last[ball] = at
                continue
            first[ball] = at
            if self.sides[ball]:
                stack += [(ball, True), (self.sides[ball][1], False), (self.sides[ball][0], False)]
            else:
                order.append(self._rows[ball])
                at += len(self._rows[ball])
                last[ball] = at
        order = np.concatenate(order)
        self.points, self.n, place = own[order], n[order], np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.row = place[self.row]
        held = np.concatenate([np.zeros((1, own.shape[1]), np.int64), np.cumsum(self.points * self.n[:, None], axis=0)])
        count = np.concatenate([[0], np.cumsum(self.n)])
        self.first, self.last = first, last
        self.total, self.count = held[last] - held[first], count[last] - count[first]
        self.center, self.radius = np.stack(self.center), np.array(self.radius)
        del self._x, self._n, self._rows

    def walk(self, book: np.ndarray) -> Iterator[tuple[int, int | np.ndarray]]:
        """(ball, owner) of the wholly owned balls, (leaf, owners of its points) of the others."""
        entries = book.astype(np.float64)
        stack = [(self.root, np.arange(len(book)))]
        while stack:
            ball, left = stack.pop()
            d = np.sqrt(((entries[left] - self.center[ball]) ** 2).sum(1))
            # in doubles, so with some room; what it leaves open is settled in integers
            left = left[d <= d.min() + 2 * self.radius[ball] + 1e-7 * (1 + d)]
            if len(left) == 1:
                yield ball, int(left[0])
            elif self.sides[ball]:
                stack += [(side, left) for side in self.sides[ball]]
            else:
                near = _squares(self.points[self.first[ball] : self.last[ball]], book[left])
                yield ball, left[near.argmin(1)]  # the first of equals is the lower index

    def sums(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and component sums of the rows that each entry owns."""
        n, total = np.zeros(len(book), np.int64), np.zeros_like(book)
        for ball, owner in self.walk(book):
            if isinstance(owner, int):
                n[owner] += self.count[ball]
                total[owner] += self.total[ball]
            else:
                own = slice(self.first[ball], self.last[ball])
                np.add.at(n, owner, self.n[own])
                np.add.at(total, owner, self.points[own] * self.n[own, None])
        return n, total

    def owners(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owner and squared distance of every row of the slice."""
        owner = np.zeros(len(self.points), np.int64)
        for ball, own in self.walk(book):
            owner[self.first[ball] : self.last[ball]] = own
        error = ((self.points - book[owner]) ** 2).sum(1)
        return owner[self.row], error[self.row]


def _cuts(length: int, parts: int) -> list[tuple[int, int]]:
    at = [length * p // parts for p in range(parts + 1)]
    return list(zip(at, at[1:]))


def trees(vectors: DataFrame, length: int, parts: int = PARTS, tree: int = TREE) -> DataFrame:
    """(ids, labels, trees): a row for each slice of at most ``tree`` vectors, with a tree for each part position."""
    cuts = _cuts(length, parts)
    ids, labels = vectors.schema["vec_id"].dataType.simpleString(), vectors.schema["label"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, tree):
                own = batch.slice(at, tree)
                q = quantized(own.column("e").flatten().to_numpy(zero_copy_only=False)).reshape(-1, length)
                blobs = [pickle.dumps(Tree(q[:, a:b]), protocol=5) for a, b in cuts]
                ends = pa.array([0, own.num_rows], pa.int32())
                columns = [pa.ListArray.from_arrays(ends, own.column(c)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([blobs], pa.list_(pa.binary()))], ["ids", "labels", "trees"])

    return vectors.select("vec_id", "label", "e").mapInArrow(build, f"ids array<{ids}>, labels array<{labels}>, trees array<binary>")


def learn(forest: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after ``rounds`` rounds over the trees."""
    for _ in range(rounds):

        def add(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            n, total = [np.zeros(len(b), np.int64) for b in books], [np.zeros_like(b) for b in books]
            for batch in batches:
                for row in batch.column("trees"):
                    for p, blob in enumerate(row):
                        a, b = pickle.loads(blob.as_py()).sums(books[p])
                        n[p] += a
                        total[p] += b
            out = [(p, e, int(n[p][e]), total[p][e].tolist()) for p in range(len(books)) for e in np.flatnonzero(n[p]).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], ["part", "entry", "n", "total"])

        widest = max(b.shape[1] for b in books)
        summed = forest.select("trees").mapInArrow(add, "part int, entry int, n long, total array<long>").groupBy("part", "entry")
        got = summed.agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("total", F.lit(k))) for k in range(widest))).alias("total"))
        books = [b.copy() for b in books]
        for r in got.collect():  # a row for each entry at most
            book = books[r.part]
            book[r.entry] = np.array(r.total[: book.shape[1]], np.int64) // r.n
    return books


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, tree: int = TREE) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) for every sound vector, and the codebooks.

    ``entries`` is 256 at most, so that an index is two hex digits.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    bounded_batches(vectors.sparkSession)
    sound = F.expr("e is not null and size(e) > 0 and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
    kept = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e")).where(sound)
    smallest = kept.orderBy(F.col("vec_id").asc_nulls_last(), "e").select("vec_id", "e").limit(1).collect()
    length = len(smallest[0].e) if smallest else parts
    kept = kept.where(F.size("e") == length)
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "e").select("e").limit(entries).collect()
    first = quantized(np.array([r.e for r in start], np.float64).reshape(-1, length))
    books = [np.ascontiguousarray(first[:, a:b]) for a, b in _cuts(length, parts)]
    forest = written(trees(kept, length, parts, tree), "trees")
    if len(first):
        books = learn(forest, books, rounds)
    ids, labels = vectors.schema["vec_id"].dataType.simpleString(), vectors.schema["label"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                got = [pickle.loads(blob.as_py()).owners(books[p]) for p, blob in enumerate(batch.column("trees")[k])]
                codes = np.stack([o for o, _ in got], 1).astype(np.uint8).tobytes().hex()
                error = np.sum([e for _, e in got], axis=0)
                step = 2 * len(got)
                own = [batch.column(c)[k].values for c in ("ids", "labels")]
                yield pa.RecordBatch.from_arrays([*own, pa.array([codes[i : i + step] for i in range(0, len(codes), step)], pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return forest.mapInArrow(assign, f"vec_id {ids}, label {labels}, code string, error long"), books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, **how: int) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every sound vector; null labels are one label."""
    coded, books = encode(vectors, **how)
    coded = written(coded, "codes")
    label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    got = coded.join(label, F.col("label").eqNullSafe(F.col("of")))
    return got.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
