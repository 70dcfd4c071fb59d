"""Distances of vectors that share a bucket, computed where the bucket is.

A row of a bucket has the vector with it, so that no candidate pair is ever a row: the vectors of a
bucket are compared in blocks, and only pairs below the threshold come out, each from the first
table that has them in one bucket. Large buckets are cut into a grid.

Where a vector looks into many buckets, ``sketched_pairs`` sends a sketch with each, a byte a number,
that tells how near two vectors can be at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.operators.hotkeys import COLUMN, ROW, dealt, frequent_keys
from shelfmatch.sources.tables import cut_lineage, tell_workers

CELL_ROWS = 2048  # of a side of a bucket that are compared at a time
BIN_ROWS = 1 << 14  # of a side that a task takes together, about


SMALL_CELL = 32  # pairs of a cell, up to which cells are compared together
PAIRS = 1 << 16  # compared together


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of rows, summed from the first place to the last."""
    return np.sqrt(np.cumsum((x - y) ** 2, axis=1)[:, -1])


def _in_buckets(vectors: DataFrame) -> DataFrame:
    """``bucket, at, key, value, hashes``: a row for each table of each vector."""
    return vectors.select("key", "value", "hashes", F.posexplode("hashes").alias("at", "hash")).select(
        F.xxhash64("at", "hash").alias("bucket"), "at", "key", "value", "hashes"
    )


def near_in_buckets(a: DataFrame, b: DataFrame, dim: int, threshold: float) -> DataFrame:
    """``key_a, key_b, distance`` below the threshold of vectors with a hash in common in one place.

    Both sides have ``key, value, hashes``: distinct keys, ``dim`` numbers, as many hashes as there
    are tables. Others have no partner.
    """
    tell_workers(a.sparkSession)
    whole = F.col("key").isNotNull() & (F.size("value") == dim) & F.forall("value", lambda x: x.isNotNull())
    whole = whole & F.forall("hashes", lambda h: h.isNotNull())
    kept = lambda side: cut_lineage(side.where(whole).select("key", "value", "hashes"))
    side_a = kept(a)
    side_b = side_a if a is b else kept(b)
    left, right = _in_buckets(side_a), _in_buckets(side_b)
    counts_a = frequent_keys(left, ["bucket"])
    counts_b = counts_a if a is b else frequent_keys(right, ["bucket"])
    left, right = dealt(left, right, ["bucket"], ["key"], counts_a, counts_b, CELL_ROWS)
    rows = max(side.agg(F.sum(F.size("hashes"))).first()[0] or 0 for side in (side_a, side_b))
    cell = F.xxhash64("bucket", ROW, COLUMN)
    bin_ = F.pmod(cell, F.lit(max(1, -(-rows // BIN_ROWS)))).cast("int").alias("bin")
    one, two = (s.select(bin_, cell.alias("cell"), "at", "key", "value", "hashes") for s in (left, right))
    two = two.toDF(*[f"{c}_b" for c in two.columns])  # the sides may be one frame

    def numbers(table: pa.Table, name: str) -> np.ndarray:
        flat = table[name].combine_chunks().flatten()
        return flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if one.num_rows and two.num_rows:
            (x, hx, cx), (y, hy, cy) = (
                (numbers(t, f"value{n}"), numbers(t, f"hashes{n}"), t[f"cell{n}"].to_numpy())
                for t, n in ((one, ""), (two, "_b"))
            )
            at, by_x, by_y = one["at"].to_numpy(), np.argsort(cx, kind="stable"), np.argsort(cy, kind="stable")
            cells = np.intersect1d(cx, cy)
            bounds = [np.searchsorted(c, cells, side) for c in (cx[by_x], cy[by_y]) for side in ("left", "right")]
            for p, q, r, s in zip(*bounds):
                i, j = by_x[p:q], by_y[r:s]
                m, n = x[i], y[j]
                size = (m * m).sum(1)[:, None] + (n * n).sum(1)
                near = np.nonzero(size - 2 * (m @ n.T) <= threshold**2 + 1e-9 * (size + 1))
                i, j = i[near[0]], j[near[1]]
                before = np.arange(hx.shape[1]) < at[i][:, None]  # both lie in one bucket of an earlier table
                new = ~((hx[i] == hy[j]) & before).any(1)
                i, j = i[new], j[new]
                distance = _exact(x[i], y[j])
                below = distance < threshold
                found.append((i[below], j[below], distance[below]))
        i, j, distance = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int),) * 2 + (np.zeros(0),)
        return pa.table(
            {"key_a": one["key"].take(pa.array(i)), "key_b": two["key_b"].take(pa.array(j)), "distance": distance}
        )

    schema = "key_a binary, key_b binary, distance double"
    return one.groupBy("bin").cogroup(two.groupBy("bin_b")).applyInArrow(compare, schema)


def sketches(vectors: np.ndarray) -> pa.Array:
    """Of each row: a step, how far the row is from its rounding to whole steps, and these in bytes."""
    step = np.maximum(np.abs(vectors).max(axis=1) / 127, 1e-300)
    whole = np.clip(np.rint(vectors / step[:, None]), -127, 127)
    off = np.sqrt(((vectors - whole * step[:, None]) ** 2).sum(axis=1))
    out = np.hstack([np.column_stack([step, off]).view(np.int8), whole.astype(np.int8)])
    offsets = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(offsets), pa.py_buffer(out.tobytes())])


def _read_sketches(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Roundings, and how far the vectors are from them."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), -1)
    step, off = np.ascontiguousarray(raw[:, :16]).view(np.float64).T
    return raw[:, 16:] * step[:, None], off


def _may_be_near(squares, size, off, threshold: float) -> np.ndarray:
    """Whether vectors can be below the threshold whose roundings have these squared distances."""
    return ~(squares > (threshold + off) ** 2 * (1 + 1e-9) + 1e-9 * (size + 1))  # not a number: unknown


def sketched_pairs(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """``key_a, key_b`` of vectors with a hash in common whose sketches do not rule out the threshold.

    Both sides have ``key, sketch, hashes``, without nulls, and distinct keys. All pairs below the threshold
    that share a hash come out, once for each they share, and few others.
    """
    tell_workers(a.sparkSession)
    side_a, side_b = (cut_lineage(side.select("key", "sketch", "hashes")) for side in (a, b))
    left, right = (s.select("key", "sketch", F.explode("hashes").alias("bucket")) for s in (side_a, side_b))
    counts_a, counts_b = (frequent_keys(side, ["bucket"]) for side in (left, right))
    left, right = dealt(left, right, ["bucket"], ["key"], counts_a, counts_b, CELL_ROWS)
    rows = max(side.agg(F.sum(F.size("hashes"))).first()[0] or 0 for side in (side_a, side_b))
    cell = F.xxhash64("bucket", ROW, COLUMN)
    bin_ = F.pmod(cell, F.lit(max(1, -(-rows // BIN_ROWS)))).cast("int").alias("bin")
    one, two = (s.select(bin_, cell.alias("cell"), "key", "sketch") for s in (left, right))
    two = two.toDF(*[f"{c}_b" for c in two.columns])

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        found = [(np.zeros(0, int), np.zeros(0, int))]
        if one.num_rows and two.num_rows:
            (x, off_x), (y, off_y) = _read_sketches(one["sketch"]), _read_sketches(two["sketch_b"])
            cx, cy = one["cell"].to_numpy(), two["cell_b"].to_numpy()
            size_x, size_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
            by_x, by_y = np.argsort(cx, kind="stable"), np.argsort(cy, kind="stable")
            cells = np.intersect1d(cx, cy)
            p, q, r, s = (np.searchsorted(c, cells, side) for c in (cx[by_x], cy[by_y]) for side in ("left", "right"))
            pairs = (q - p) * (s - r)
            small = pairs <= SMALL_CELL
            i, j = _all_pairs(p[small], r[small], (s - r)[small], pairs[small])
            i, j = by_x[i], by_y[j]
            for at in range(0, len(i), PAIRS):
                m, n = i[at : at + PAIRS], j[at : at + PAIRS]
                squares = ((x[m] - y[n]) ** 2).sum(axis=1)
                near = _may_be_near(squares, size_x[m] + size_y[n], off_x[m] + off_y[n], threshold)
                found.append((m[near], n[near]))
            for p, q, r, s in zip(p[~small], q[~small], r[~small], s[~small]):
                m, n = by_x[p:q], by_y[r:s]
                size = size_x[m][:, None] + size_y[n]
                off = off_x[m][:, None] + off_y[n]
                near = np.nonzero(_may_be_near(size - 2 * (x[m] @ y[n].T), size, off, threshold))
                found.append((m[near[0]], n[near[1]]))
        i, j = (np.concatenate(c) for c in zip(*found))
        return pa.table({"key_a": one["key"].take(pa.array(i)), "key_b": two["key_b"].take(pa.array(j))})

    return one.groupBy("bin").cogroup(two.groupBy("bin_b")).applyInArrow(compare, "key_a binary, key_b binary")


def _all_pairs(p: np.ndarray, r: np.ndarray, width: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of cells that begin at ``p`` and ``r``, ``width`` wide on the second side."""
    place = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    wide = np.repeat(width, pairs)
    return np.repeat(p, pairs) + place // wide, np.repeat(r, pairs) + place % wide
