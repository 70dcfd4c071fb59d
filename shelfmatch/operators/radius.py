"""All pairs of vectors within a radius, by pivots.

Every vector of one side lies with its nearest pivot, and there in a ring by its distance to it. A
vector of the other side looks into the cells and rings that its ball of the radius can reach: the
cells across whose border plane it can reach, the rings that the triangle inequality leaves. Cells
and rings that hold many rows are cut into a grid of blocks, so no task holds more than BLOCK_ROWS
rows of a side, however the vectors lie. No row stands for a pair that is merely compared.

In a block the vectors are turned to the principal axes of a sample, and squared distances are
summed over a quarter of the axes at a time; a pair whose partial sum reaches the squared radius
is left. Distances of the pairs that remain come from the vectors as given. All bounds are a little
wider than the radius, for the rounding of sums, and none decides on a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.operators.simjoin import distinct_values, put_ids_back, unit_side, vector_side
from shelfmatch.sources.tables import cut_lineage, tell_workers

SAMPLE_ROWS = 4096  # vectors of both sides that pivots, axes and the plan are taken from
MOST_PIVOTS = 256
RINGS = 64  # of a cell at most
BLOCK_ROWS = 1 << 15  # of a side of a block at most
SMALL_BLOCK = 4096  # rows that are not cut for more tasks
GRID = 8  # blocks that a smaller side is cut into
STRIPE_ROWS = 256  # rows of a block compared with the others at a time
STRIPE_COLUMNS = 2048  # and with so many at a time, which stay in the processor's cache
STAGES = 4  # parts of a squared distance
SHARE = 0.25  # of what a stripe's pairs take; when those left take less, only they are summed on
EXACT_PAIRS = 1 << 16  # whose distances are taken together
SHIPPED = 200  # pairs that are compared in the time that a row takes to move
PLANNED = (1, 4, 16, 64, 256)  # numbers of pivots that a plan chooses from
_SLACK = 1e-9
SHORT_SLACK = 1e-6  # of sums of 32-bit numbers, for each dimension; some times what they are rounded by
SHORT_SCALE = 1e30


@dataclass
class Pivots:
    places: np.ndarray
    axes: np.ndarray  # columns, those of the greatest variance first
    low: np.ndarray  # least and greatest distance of a vector of side b in each cell
    high: np.ndarray
    width: float  # of rings

    def home(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot, of equally near ones the first, and the distance to it."""
        far = distances(vectors, self.places)
        cell = far.argmin(1)
        return cell, far[np.arange(len(cell)), cell]

    def ring(self, distance: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return np.clip((distance - self.low[cell]) // self.width, 0, RINGS - 1).astype(np.int32)

    def reached(self, vectors: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, cell and ring that the ball around a vector can reach."""
        far = distances(vectors, self.places)
        near = far.argmin(1)
        own = far[np.arange(len(far)), near][:, None]
        apart = distances(self.places, self.places)[near]
        with np.errstate(divide="ignore", invalid="ignore"):
            to_border = np.where(apart > 0, (far**2 - own**2) / (2 * apart), 0.0)
        wide = radius + _SLACK * (1 + far)
        fits = (to_border <= wide) & (far - wide <= self.high) & (far + wide >= self.low)
        row, cell = np.nonzero(fits)
        far, wide = far[row, cell], wide[row, cell]
        first, last = self.ring(far - wide, cell), self.ring(far + wide, cell)
        many = last - first + 1
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(row, many), np.repeat(cell, many), np.repeat(first, many) + at


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def near_pairs(a: np.ndarray, b: np.ndarray, radius: float, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows of a and b below the radius, their distances, and how many pairs were summed to the end."""
    centre = b[0] if len(b) else 0.0  # a place near all of them, as numbers are short in what follows
    turned_a, turned_b = (a - centre) @ axes, (b - centre) @ axes
    scale = max((turned_a**2).sum(1).max(initial=0), (turned_b**2).sum(1).max(initial=0))
    limit = radius**2 + _SLACK * (1 + radius**2 + scale)
    if scale < SHORT_SCALE:  # else their squares might not be numbers
        turned_a, turned_b = turned_a.astype(np.float32), turned_b.astype(np.float32)
        limit = np.float32(radius**2 + SHORT_SLACK * (a.shape[1] + 8) * (radius**2 + scale) + _SLACK)
    cuts = np.linspace(0, a.shape[1], STAGES + 1).astype(int)
    parts = [slice(x, y) for x, y in zip(cuts, cuts[1:]) if y > x]
    norms_a, norms_b = ([(side[:, part] ** 2).sum(1) for part in parts] for side in (turned_a, turned_b))
    found, candidates = [], 0
    for at, begin in product(range(0, len(a), STRIPE_ROWS), range(0, len(b), STRIPE_COLUMNS)):
        rows, columns = slice(at, at + STRIPE_ROWS), slice(begin, begin + STRIPE_COLUMNS)
        left, right = turned_a[rows], turned_b[columns]
        squares, kept, i, j, sums = None, None, None, None, None
        for k, part in enumerate(parts):
            x, y = left[:, part], right[:, part]
            if k == len(parts) - 1:
                candidates += len(left) * len(right) if kept is None else np.count_nonzero(kept) if i is None else len(i)
            if i is not None:
                sums = sums + ((x[i] - y[j]) ** 2).sum(1)
                near = sums < limit
                i, j, sums = i[near], j[near], sums[near]
                continue
            here = x @ y.T
            here *= -2
            here += norms_a[k][rows, None]
            here += norms_b[k][columns]
            squares = here if squares is None else np.add(squares, here, out=squares)
            kept = squares < limit
            if np.count_nonzero(kept) <= SHARE * kept.size / STAGES:
                i, j = np.nonzero(kept)
                sums = squares[i, j]
        if i is None:
            i, j = np.nonzero(kept) if kept is not None else np.indices((len(left), len(right))).reshape(2, -1)
        for cut in range(0, len(i), EXACT_PAIRS):
            row, other = i[cut : cut + EXACT_PAIRS] + at, j[cut : cut + EXACT_PAIRS] + begin
            exact = np.sqrt(((a[row] - b[other]) ** 2).sum(1))
            near = exact < radius
            found.append((row[near], other[near], exact[near]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0), candidates
    row, other, exact = map(np.concatenate, zip(*found))
    return row, other, exact, candidates


def _matrix(values: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], pa.list_(pa.float64()))
    return np.asarray(values.flatten(), dtype=float).reshape(-1, dim)


def _sample(sides: list[DataFrame], rows: int) -> np.ndarray:
    """Vectors by the order of their digests, so the same ones in any partitioning."""
    both = sides[0] if len(sides) == 1 else sides[0].unionAll(sides[1]).dropDuplicates(["key"])
    found = both.orderBy("key").limit(rows).select("value").collect()
    return np.array([r[0] for r in found], dtype=float)


def _axes(sample: np.ndarray) -> np.ndarray:
    centred = sample - sample.mean(0)
    return np.linalg.svd(centred, full_matrices=True)[2].T


def plan(sample: np.ndarray, radius: float, rows_a: int, rows_b: int) -> int:
    """The number of pivots for which moving and comparing together take least, by the sample."""
    best, least = 1, math.inf
    for n in PLANNED:
        if n > max(1, len(sample) // 8):
            break
        pivots = _ranged(Pivots(sample[:n], np.zeros((0, 0)), *_none(n), 1.0), sample, radius)
        row, cell, ring = pivots.reached(sample, radius)
        home, far = pivots.home(sample)
        size = np.bincount(home * RINGS + pivots.ring(far, home), minlength=n * RINGS)
        compared = size[cell * RINGS + ring].sum() / len(sample) ** 2 * rows_a * rows_b
        cost = SHIPPED * (len(row) / len(sample) * rows_a + rows_b) + compared
        if cost < least:
            best, least = n, cost
    return best


def _none(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full(n, np.inf), np.full(n, -np.inf)


def _ranged(pivots: Pivots, vectors: np.ndarray, radius: float) -> Pivots:
    cell, far = pivots.home(vectors)
    np.minimum.at(pivots.low, cell, far)
    np.maximum.at(pivots.high, cell, far)
    return _with_width(pivots, radius)


def _with_width(pivots: Pivots, radius: float) -> Pivots:
    full = pivots.high >= pivots.low
    widest = (pivots.high[full] - pivots.low[full]).max(initial=0.0)
    pivots.width = max(radius, widest / RINGS, 1e-300)
    pivots.low = np.where(full, pivots.low, np.inf)
    return pivots


def _usable(vec: str, dim: int) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    return (F.size(vec) == dim) & F.forall(vec, number)


def _pivots_for(
    sides: dict[str, DataFrame], dim: int, radius: float, pivots: int | None
) -> Pivots:
    """Pivots and axes from a sample; the ranges of the cells from all vectors of side b."""
    sample = _sample(list(sides.values()), SAMPLE_ROWS)
    if pivots is None:
        rows = {name: side.count() for name, side in sides.items()}
        pivots = plan(sample, radius, rows["a"], rows.get("b", rows["a"])) if len(sample) else 1
    pivots = min(pivots, MOST_PIVOTS)
    found = Pivots(sample[:pivots].reshape(-1, dim), _axes(sample.reshape(-1, dim)) if len(sample) else np.eye(dim),
                   *_none(min(pivots, len(sample))), 1.0)
    if not len(sample):
        return found

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = found.low.copy(), found.high.copy()
        for batch in batches:
            cell, far = found.home(_matrix(batch[0], dim))
            np.minimum.at(low, cell, far)
            np.maximum.at(high, cell, far)
        used = np.flatnonzero(high >= low)
        yield pa.record_batch([pa.array(used, pa.int32()), low[used], high[used]], names=["cell", "low", "high"])

    held = sides.get("b", sides["a"]).select("value").mapInArrow(ranges, "cell int, low double, high double")
    for r in held.groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        found.low[r.cell], found.high[r.cell] = r.low, r.high  # as many rows as pivots
    return _with_width(found, radius)


def _placed(side: DataFrame, pivots: Pivots, dim: int, radius: float, looking: bool) -> DataFrame:
    """The keyed vectors with ``_cell`` and ``_ring``: where each lies, or all it looks into."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STRIPE_ROWS):
                part = batch.slice(at, STRIPE_ROWS)
                vectors = _matrix(part[1], dim)
                if looking:
                    row, cell, ring = pivots.reached(vectors, radius)
                    part = part.take(pa.array(row))
                else:
                    cell, far = pivots.home(vectors)
                    ring = pivots.ring(far, cell)
                columns = [part[0], part[1], pa.array(cell, pa.int32()), pa.array(ring, pa.int32())]
                yield pa.record_batch(columns, names=["key", "value", "_cell", "_ring"])

    schema = "key binary, value array<double>, _cell int, _ring int"
    return side.select("key", "value").mapInArrow(work, schema)


def block_rows(rows: int) -> int:
    """Rows of a side of a block, for sides of as many rows: few blocks repeat a row few times."""
    return min(BLOCK_ROWS, max(SMALL_BLOCK, -(-rows // GRID)))


def _blocks(a: DataFrame, b: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt out to blocks of at most about ``rows`` rows: _cell, _ring, _i, _j."""
    place = ["_cell", "_ring"]
    size = lambda side, n: side.groupBy(*place).agg(F.ceil(F.count("*") / rows).cast("int").alias(n))
    # at most as many rows as pivots times rings
    parts = F.broadcast(size(a, "_parts_a").join(size(b, "_parts_b"), place))
    one = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    all_ = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = a.join(parts, place).select(*place, one("_parts_a").alias("_i"), all_("_parts_b").alias("_j"), "key", "value")
    right = b.join(parts, place).select(*place, all_("_parts_a").alias("_i"), one("_parts_b").alias("_j"), "key", "value")
    return left, right


def _compared(
    a: DataFrame, b: DataFrame, dim: int, radius: float, pivots: int | None, counts: bool
) -> DataFrame:
    spark = a.sparkSession
    tell_workers(spark)
    sides = {"a": a} if b is a else {"a": a, "b": b}
    found = _pivots_for(sides, dim, radius, pivots)
    looking = cut_lineage(_placed(a, found, dim, radius, True))
    lying = cut_lineage(_placed(b, found, dim, radius, False))
    left, right = _blocks(looking, lying, block_rows(max(side.count() for side in sides.values())))

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        x, y = _matrix(one["value"], dim), _matrix(two["value"], dim)
        row, other, far, candidates = near_pairs(x, y, radius, found.axes)
        if counts:
            return pa.table({"compared": [len(x) * len(y)], "candidates": [candidates], "pairs": [len(row)]})
        return pa.table(
            {"key_a": one["key"].take(pa.array(row)), "key_b": two["key"].take(pa.array(other)), "distance": far}
        )

    block = ["_cell", "_ring", "_i", "_j"]
    kind = "compared long, candidates long, pairs long" if counts else "key_a binary, key_b binary, distance double"
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(compare, kind)


def _sides(
    a: DataFrame, b: DataFrame, id_: str, vec: str, dim: int, threshold: float, metric: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, float]:
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    same = a is b
    doubles = lambda side: side.select(id_, F.col(vec).cast("array<double>").alias(vec))
    a, b = (doubles(side).where(_usable(vec, dim)) for side in (a, b))
    if metric == "cosine":
        a, b = (unit_side(side, id_, vec) for side in (a, b))
    keyed_a = vector_side(a, id_, vec)
    keyed_b = keyed_a if same else vector_side(b, id_, vec)
    values_a = cut_lineage(distinct_values(keyed_a))
    values_b = values_a if same else cut_lineage(distinct_values(keyed_b))
    return keyed_a, keyed_b, values_a, values_b, math.sqrt(2 * threshold) if metric == "cosine" else threshold


def radius_join(
    a: DataFrame,
    b: DataFrame,
    id_: str,
    vec: str,
    dim: int,
    threshold: float,
    metric: str = "euclidean",
    pivots: int | None = None,
) -> DataFrame:
    """``id_a, id_b, distance`` of all pairs below a Euclidean or cosine distance.

    Cosine distance ``d`` is Euclidean distance ``sqrt(2 d)`` of the scaled vectors. Vectors that
    are null, of another length, or hold null, NaN or infinity have no partner, nor have zero
    vectors by cosine. Equal vectors are compared once. ``pivots`` is planned from a sample and the
    numbers of rows unless given; it changes the work and not the result. Distinct vectors and
    where they lie are written once, as they are read several times.
    """
    keyed_a, keyed_b, values_a, values_b, radius = _sides(a, b, id_, vec, dim, threshold, metric)
    pairs = _compared(values_a, values_b, dim, radius, pivots, False)
    result = put_ids_back(pairs, keyed_a, keyed_b)
    if metric == "cosine":
        return result.withColumn("distance", F.col("distance") * F.col("distance") / 2)
    return result


def radius_join_work(
    a: DataFrame,
    b: DataFrame,
    id_: str,
    vec: str,
    dim: int,
    threshold: float,
    metric: str = "euclidean",
    pivots: int | None = None,
) -> DataFrame:
    """What ``radius_join`` does: compared (pairs of distinct vectors that meet in a block),
    candidates (of which the last part of the distance is summed) and pairs (results)."""
    *_, values_a, values_b, radius = _sides(a, b, id_, vec, dim, threshold, metric)
    work = _compared(values_a, values_b, dim, radius, pivots, True)
    return work.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in work.columns])
