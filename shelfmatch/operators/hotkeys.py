"""Joins whose hot keys, of either side, are spread over a grid of tasks.

Which keys are hot comes from a mergeable sketch of frequent items that each task fills and that is
put together on the way to the driver: no shuffle of counts. Rows that are dear to compute are
written first, and the sketch reads the keys of what was written. (Taking it while they are written,
as observed metrics, leaves a session in which Spark ML can't send its models to tasks.) A key of
more than 3.5 in TRACKED of the rows is sure to be found, and its count is over the truth by that
share at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.operators.relational import HOT_ROWS
from shelfmatch.sources.tables import cut_lineage

TRACKED = 10_000  # keys of a sketch, and at most so many hot ones
KEY, ROW, COLUMN = "_key_hash", "_grid_row", "_grid_column"


def _quoted(names: list[str]) -> list[str]:
    return [f"`{c.replace('`', '``')}`" for c in names]


def key_hash(on: list[str]) -> Column:
    """Keys that share a hash are spread alike, which changes no result."""
    return F.xxhash64(*_quoted(on))


def _sketch(on: list[str], tracked: int) -> Column:
    hashed = "xxhash64({})".format(", ".join(_quoted(on)))
    return F.expr(f"approx_top_k({hashed}, {tracked}, {tracked})").alias("top")


def frequent_keys(df: DataFrame, on: list[str], tracked: int = TRACKED) -> dict[int, int]:
    """Hash and number of rows of the most frequent keys; reads the keys alone."""
    return {r["item"]: r["count"] for r in df.agg(_sketch(on, tracked)).first()["top"] or []}


def kept_with_frequent_keys(
    df: DataFrame, on: list[str], tracked: int = TRACKED
) -> tuple[DataFrame, dict[int, int]]:
    """The rows, computed and written once, and their most frequent keys, from the key columns of
    what was written."""
    kept = cut_lineage(df)
    return kept, frequent_keys(kept, on, tracked)


def is_hot(key: int, left_counts: dict[int, int], right_counts: dict[int, int], hot_rows: int) -> bool:
    return left_counts.get(key, 0) > hot_rows or right_counts.get(key, 0) > hot_rows


def dealt(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: list[str],
    left_counts: dict[int, int],
    right_counts: dict[int, int],
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the place in the grid of their key at which rows meet, ROW and COLUMN.

    Rows of a key that is hot on the left are dealt out to the rows of the grid, and the right
    side's are repeated for each; keys hot on the right have columns in the same way.
    """
    parts = lambda n: -(-n // hot_rows)
    hot = sorted(k for k in left_counts.keys() | right_counts.keys() if is_hot(k, left_counts, right_counts, hot_rows))
    grid = [(k, parts(left_counts.get(k, 1)), parts(right_counts.get(k, 1))) for k in hot]
    # at most as many rows as two sketches hold
    table = F.broadcast(left.sparkSession.createDataFrame(grid, f"{KEY} long, _rows int, _columns int"))
    n = {c: F.coalesce(F.col(c), F.lit(1)) for c in ("_rows", "_columns")}
    one = lambda by, c: F.pmod(key_hash(by), n[c].cast("long")).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), n[c] - 1))

    def side(df: DataFrame, by: list[str], own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        found = df.withColumn(KEY, key_hash(on)).join(table, KEY, "left")
        found = found.withColumn(own[1], one(by, own[0])).withColumn(other[1], every(other[0]))
        return found.drop(KEY, "_rows", "_columns")

    rows, columns = ("_rows", ROW), ("_columns", COLUMN)
    return side(left, spread, rows, columns), side(right, right.columns, columns, rows)


def grid_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: list[str],
    left_counts: dict[int, int] | None = None,
    right_counts: dict[int, int] | None = None,
    hot_rows: int = HOT_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Inner or left equi-join in which a key may be hot on either side or both.

    No task gets more than about ``hot_rows`` rows of a key from a side, and no row is dropped.
    ``spread`` are columns by which rows of the left side differ; the right side is dealt out by all
    its columns. Frequent keys are counted by a pass over the keys unless given. In a left join the right
    side is not dealt out, as rows without a match must come once. Null keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"{how!r} is neither an inner nor a left join")
    left_counts = frequent_keys(left, on) if left_counts is None else left_counts
    if how == "left":
        right_counts = {}
    elif right_counts is None:
        right_counts = frequent_keys(right, on)
    if how == "inner":
        known = lambda df: df.where(" and ".join(f"{c} is not null" for c in _quoted(on)))
        left, right = known(left), known(right)
    if not any(is_hot(k, left_counts, right_counts, hot_rows) for k in left_counts.keys() | right_counts.keys()):
        return left.join(right, on, how)
    left, right = dealt(left, right, on, spread, left_counts, right_counts, hot_rows)
    return left.join(right, [*on, ROW, COLUMN], how).drop(ROW, COLUMN)


def consolidate(
    pairs: DataFrame,
    descriptions: DataFrame,
    attribute: DataFrame,
    spread: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pairs with their product's description and attribute value.

    The pairs are computed once and written; the hot products among them serve both joins. Repeated keys on the right multiply, pairs without a match drop, and a product may have
    any share of the rows of any table.
    """
    on = ["product_uid"]
    kept, counts = kept_with_frequent_keys(pairs, on)
    described_by, valued_by = (frequent_keys(df, on) for df in (descriptions, attribute))
    described = grid_join(kept, descriptions, on, spread, counts, described_by, hot_rows)
    after = {k: counts.get(k, 1) * described_by.get(k, 1) for k in counts.keys() | described_by.keys()}
    spread = [*spread, *(c for c in descriptions.columns if c not in on)]
    return grid_join(described, attribute, on, spread, after, valued_by, hot_rows)
