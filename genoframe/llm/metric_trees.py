"""Operator 12: product codes of vectors, with codebooks fitted by exact rounds over metric trees.

Entries become whole numbers, vectors are cut into ``PARTS`` parts, and each part position has a codebook of ``ENTRIES`` entries.

1. Rows stay where the scan puts them. Each block of at most ``BLOCK`` rows gets a metric tree for each part position, built middle-out: a number of anchors (the square root
   of the number of points) takes points from each other, skipping by the triangle inequality those that can't move; anchors
   are merged upwards, the pair with the smallest common ball first, and divided downwards in the same way until balls hold ``LEAF`` points. A ball caches its
   radius, count and sums. Equal parts are one point with a count. The trees are written once to the shared folder.
2. In each round the codebooks (``PARTS x ENTRIES`` entries) go to all tasks. From the root down, a ball inherits the list of entries that may own points of it and strikes
   out those that are farther away than another one for all of its points. A ball with one entry left gives its cached count and sums; only points of
   leaves with several are compared themselves. Tasks send sums and counts by entry; the driver holds one codebook's worth of them.
3. After the last round the trees are walked once more for codes and errors.

Distances are whole numbers and exact; bounds have slack for rounding, so that ties always go to the lower index and results don't depend on partitions.

Defined results: rows are dropped whose vector is null, empty, has null or non-finite entries or entries of ``LIMIT`` or more in magnitude (their squared distances
would not fit a long), or has another number of entries than most vectors have. A length that 8 doesn't divide gives parts that differ by one
entry. Fewer than 16 rows give smaller codebooks; null ids come after all others, and equal ids are ordered by their vectors. Repeated rows each have a code.
``label_error`` is null where the sum is beyond a long. An empty table gives an empty result. Only the columns vec_id, embedding and label are read.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm.common import settle
from genoframe.llm.vectors import matrix, sound, usual_length

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LIMIT = float(1 << 15)
BLOCK = 4096
LEAF = 32


# --- trees


class Tree:
    """Balls over weighted points: point ranges, children (-1: none), centres, radii, cached counts and sums. Points are in the order of the leaves."""

    FIELDS = ("points", "weights", "place", "begin", "end", "left", "right", "centre", "radius", "count", "sums")

    def __init__(self, **arrays: np.ndarray) -> None:
        self.__dict__.update(arrays)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data), allow_pickle=False) as found:
            return cls(**{k: found[k] for k in cls.FIELDS})


def anchors(points: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Groups of points around about sqrt(n) anchors; fewer where all points are anchors already."""
    wanted = max(2, int(np.ceil(np.sqrt(len(points)))))
    mean = weights @ points / weights.sum()
    at = [int(((points - mean) ** 2).sum(axis=1).argmin())]
    distance = np.sqrt(((points - points[at[0]]) ** 2).sum(axis=1))
    owner = np.zeros(len(points), np.int64)
    while len(at) < wanted and distance[far := int(distance.argmax())] > 0:
        # a point nearer to its anchor than half the way to the new one stays
        half = np.sqrt(((points[at] - points[far]) ** 2).sum(axis=1)) / 2
        open_ = np.flatnonzero(distance >= half[owner])
        new = np.sqrt(((points[open_] - points[far]) ** 2).sum(axis=1))
        moved = new < distance[open_]
        owner[open_[moved]], distance[open_[moved]] = len(at), new[moved]
        at.append(far)
    order = np.argsort(owner, kind="stable")
    return [g for g in np.split(order, np.searchsorted(owner[order], np.arange(1, len(at)))) if len(g)]


def build(points: np.ndarray, weights: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of distinct points (whole numbers) with their counts."""
    exact, flat = points, points.astype(float)
    nodes: list[list] = []

    def ball(members: np.ndarray, left: int, right: int) -> int:
        w, p = weights[members], flat[members]
        centre = w @ p / w.sum()
        radius = np.sqrt(((p - centre) ** 2).sum(axis=1).max())
        nodes.append([members, left, right, centre, radius * (1 + 1e-9) + 1e-9])
        return len(nodes) - 1

    def grow(members: np.ndarray) -> int:
        groups = anchors(flat[members], weights[members]) if len(members) > leaf else []
        if len(groups) < 2:
            return ball(members, -1, -1)
        tops = [grow(members[g]) for g in groups]
        # upwards: the two whose common ball is the smallest
        centre, radius = np.array([nodes[t][3] for t in tops]), np.array([nodes[t][4] for t in tops])

        def around(k: int) -> np.ndarray:
            apart = np.sqrt(((centre - centre[k]) ** 2).sum(axis=1))
            common = np.maximum(np.maximum(radius, radius[k]), (apart + radius + radius[k]) / 2)
            common[k] = np.inf
            return np.where(np.isinf(radius), np.inf, common)

        cost = np.array([around(k) for k in range(len(tops))])
        for _ in range(len(tops) - 1):
            a, b = divmod(int(cost.argmin()), len(tops))
            tops[a] = ball(np.concatenate((nodes[tops[a]][0], nodes[tops[b]][0])), tops[a], tops[b])
            centre[a], radius[a], radius[b] = nodes[tops[a]][3], nodes[tops[a]][4], np.inf
            cost[b], cost[:, b] = np.inf, np.inf
            cost[a] = around(a)
            cost[:, a] = cost[a]
        return tops[a]

    grow(np.arange(len(points)))
    members = nodes[-1][0]
    place = np.empty(len(points), np.int64)
    place[members] = np.arange(len(points))
    begin = np.array([place[n[0][0]] for n in nodes], np.int64)
    end = begin + np.array([len(n[0]) for n in nodes])
    points, weights = exact[members], weights[members]
    total = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(points * weights[:, None], axis=0)))
    held = np.append(0, np.cumsum(weights))
    least = np.min_scalar_type(-max(1, int(np.abs(points).max(initial=0))))
    return Tree(
        points=points.astype(least), weights=weights.astype(np.int32), place=place.astype(np.int32), begin=begin.astype(np.int32), end=end.astype(np.int32), left=np.array([n[1] for n in nodes], np.int32), right=np.array([n[2] for n in nodes], np.int32),
        centre=np.array([n[3] for n in nodes]), radius=np.array([n[4] for n in nodes]), count=held[end] - held[begin], sums=total[end] - total[begin],
    )


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (points x entries) of whole numbers below 2**28."""
    out = np.zeros((len(points), len(entries)), np.int64)
    for k in range(points.shape[1]):
        out += (points[:, k, None].astype(np.int64) - entries[None, :, k]) ** 2
    return out


def owners(tree: Tree, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Who owns what: first (balls, entries, None) for wholly owned balls, level by level, then (None, entries, points) for single points."""
    flat = entries.astype(float)
    gap = np.sqrt(((flat[:, None] - flat[None]) ** 2).sum(axis=2))
    front, open_ = np.array([len(tree.begin) - 1]), np.ones((1, len(entries)), bool)
    singles: list[tuple[np.ndarray, np.ndarray]] = []
    while len(front):
        away = ((tree.centre[front][:, None] - flat[None]) ** 2).sum(axis=2)
        best = np.where(open_, away, np.inf).argmin(axis=1)
        nearest = np.take_along_axis(away, best[:, None], axis=1)
        # over the whole ball, an entry's squared distance exceeds that of the nearest one by at least the difference at the centre less 2 r |a - b|
        beyond = away - nearest - 2 * tree.radius[front][:, None] * gap[best] > 1e-9 * (away + nearest + 1)
        open_ &= ~beyond
        alone = open_.sum(axis=1) == 1
        yield front[alone], best[alone], None
        front, open_ = front[~alone], open_[~alone]
        leaf = tree.left[front] < 0
        if leaf.any():
            sizes = (tree.end - tree.begin)[front[leaf]]
            rows = np.repeat(tree.begin[front[leaf]] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
            singles.append((rows, np.repeat(open_[leaf], sizes, axis=0)))
        front, open_ = np.concatenate((tree.left[front[~leaf]], tree.right[front[~leaf]])), np.tile(open_[~leaf], (2, 1))
    for rows, inherited in singles:
        away = np.where(inherited, distances(tree.points[rows], entries), np.iinfo(np.int64).max)
        yield None, away.argmin(axis=1), rows


def gathered(tree: Tree, entries: np.ndarray) -> np.ndarray:
    """Count and sums (columns) of what each entry owns."""
    out = np.zeros((len(entries), 1 + entries.shape[1]), np.int64)
    for balls, own, rows in owners(tree, entries):
        if rows is None:
            np.add.at(out, own, np.column_stack((tree.count[balls], tree.sums[balls])))
        else:
            w = tree.weights[rows].astype(np.int64)
            np.add.at(out, own, np.column_stack((w, tree.points[rows] * w[:, None])))
    return out


def codes_of(tree: Tree, entries: np.ndarray) -> np.ndarray:
    """The entry of each point, in the order in which the tree was given them."""
    out = np.empty(len(tree.points), np.int64)
    for balls, own, rows in owners(tree, entries):
        if rows is None:
            for b, e in zip(balls.tolist(), own.tolist(), strict=True):
                out[tree.begin[b] : tree.end[b]] = e
        else:
            out[rows] = own
    return out[tree.place]


# --- jobs


def _bounds(width: int) -> list[int]:
    return [k * width // PARTS for k in range(PARTS + 1)]


def planted(numbers: DataFrame, width: int) -> DataFrame:
    """Blocks of rows with their trees: vec_id, label (arrays), of (the point of each row in each part), trees."""
    kind, cuts = numbers.schema["label"].dataType.simpleString(), _bounds(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                x, trees, of = matrix(part.column(2), width), [], []
                for a, b in zip(cuts, cuts[1:], strict=False):
                    points, inverse, counts = np.unique(x[:, a:b], axis=0, return_inverse=True, return_counts=True) if b > a else (np.empty((1, 0), np.int64), np.zeros(len(x), np.int64), np.array([len(x)]))
                    trees.append(build(points, counts.astype(np.int64)).to_bytes())
                    of.append(inverse.ravel().astype("<u2").tobytes())
                one = [pa.array([0, part.num_rows], pa.int32())]
                ids, labels = (pa.ListArray.from_arrays(one[0], c) for c in (part.column(0), part.column(1)))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([of], pa.list_(pa.binary())), pa.array([trees], pa.list_(pa.binary()))], names=["vec_id", "label", "of", "trees"])

    return settle(numbers.mapInArrow(run, f"vec_id array<long>, label array<{kind}>, of array<binary>, trees array<binary>"), "code-trees")


def refined(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: each entry the floor of the mean of what it owns, unused entries as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(b), 1 + b.shape[1]), np.int64) for b in books]
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                for t, data, book in zip(total, packed, books, strict=True):
                    t += gathered(Tree.from_bytes(data), book)
        flat = np.concatenate([t.ravel() for t in total])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int64()), pa.array(flat)], names=["at", "value"])

    found = trees.select("trees").mapInArrow(run, "at long, value long").groupBy("at").agg(F.sum("value").alias("s")).collect()
    flat, out, start = np.zeros(sum(b.size + len(b) for b in books), np.int64), [], 0
    for r in found:
        flat[r["at"]] = r["s"]
    for book in books:
        sums = flat[start : start + book.size + len(book)].reshape(len(book), -1)
        start += sums.size
        used = sums[:, :1] > 0
        out.append(np.where(used, sums[:, 1:] // np.maximum(sums[:, :1], 1), book))
    return out


def coded(trees: DataFrame, books: list[np.ndarray], kind: str) -> DataFrame:
    """vec_id, label, code and error of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, labels = batch.column(0)[k].values, batch.column(1)[k].values
                codes, error = np.empty((len(ids), PARTS), np.uint8), np.zeros(len(ids), np.int64)
                for p, (data, of, book) in enumerate(zip(batch.column(3)[k].as_py(), batch.column(2)[k].as_py(), books, strict=True)):
                    tree = Tree.from_bytes(data)
                    own = codes_of(tree, book)
                    away = ((tree.points[tree.place].astype(np.int64) - book[own]) ** 2).sum(axis=1)
                    of = np.frombuffer(of, "<u2")
                    codes[:, p], error = own[of], error + away[of]
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([text[2 * PARTS * r : 2 * PARTS * (r + 1)] for r in range(len(ids))], pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def compress(rows: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of the rows (vec_id, embedding, label), written, and the codebooks."""
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").where(sound(LIMIT))
    width = usual_length(kept)
    whole = F.expr(f"transform(embedding, c -> floor({SCALE} * double(c)))").alias("x")
    numbers = kept.where(F.size("embedding") == width).select("vec_id", "label", whole)
    kind = numbers.schema["label"].dataType.simpleString()
    first = numbers.select("vec_id", "x").orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    start, cuts = np.array([r["x"] for r in first], np.int64).reshape(len(first), width), _bounds(width)
    books = [start[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    trees = planted(numbers, width)
    for _ in range(rounds if first else 0):
        books = refined(trees, books)
    return settle(coded(trees, books, kind), "codes"), books


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()
    sums = out.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error"))
    joined = out.alias("o").join(sums.alias("s"), F.col("o.label").eqNullSafe(F.col("s.label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
