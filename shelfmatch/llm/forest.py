"""Near-duplicate vectors by a forest of random-projection trees.

Each tree cuts the vectors again and again by random directions, at the median; vectors close to a
cut go to both sides. Vectors are compared with those in their leaves, by cosine in double
precision. The trees are fitted on a bounded sample, all vectors are put into them. There are as many
trees as pairs at the similarity need to meet: that is tried with vectors of the sample and partners
made at just that similarity, which are spread as the sample is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .kept import keep

SIMILARITY = 0.9
RECALL = 0.9  # least share of the pairs at the similarity that meet in a leaf
TREES = 6  # at least
MOST_TREES = 24  # beyond that leaves get larger, up to one with all vectors
TRIED_PAIRS = 1000
SPILL = 0.05  # share of a node's vectors on either side of the cut that go to both sides
LEAF_ROWS = 512
SAMPLE_ROWS = 20_000
LEAST_SAMPLE = 16  # of the sample in a leaf
CELL_ROWS = 4096  # a larger leaf is compared in cells of so many rows against so many


class Tree:
    """Nodes as arrays: a direction, a cut range and two children, or none."""

    def __init__(self, sample: np.ndarray, leaf: int, spill: float, seed: int):
        rng = np.random.default_rng(seed)
        self.direction, self.low, self.high, self.child = [], [], [], []
        todo = [(sample, self._add())]
        while todo:
            rows, node = todo.pop()
            if len(rows) <= leaf:
                continue
            direction = rng.standard_normal(sample.shape[1])
            at = rows @ direction
            low, high = np.quantile(at, [0.5 - spill, 0.5 + spill])
            left, right = at <= high, at > low
            if left.all() or right.all():  # the vectors are too alike to be cut
                continue
            children = (self._add(), self._add())
            self.direction[node], self.low[node], self.high[node] = direction, low, high
            self.child[node] = children
            todo += [(rows[left], children[0]), (rows[right], children[1])]

    def _add(self) -> int:
        for x in (self.direction, self.low, self.high, self.child):
            x.append(None)
        return len(self.child) - 1

    def leaves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of row and leaf; a row can be in several leaves."""
        found, todo = [], [(np.arange(len(rows)), 0)]
        while todo:
            index, node = todo.pop()
            if self.child[node] is None:
                found.append((index, np.full(len(index), node)))
                continue
            at = rows[index] @ self.direction[node]
            todo.append((index[at <= self.high[node]], self.child[node][0]))
            todo.append((index[at > self.low[node]], self.child[node][1]))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Unit vectors in double precision; all of one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)  # so that no square over- or underflows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vector: str) -> F.Column:
    """Not null, not zero, no null or non-finite component."""
    c = F.col(vector)
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(c.isNotNull() & ~F.exists(c, odd) & F.exists(c, lambda x: x != 0), F.lit(False))


def near_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    similarity: float = SIMILARITY,
    trees: int = TREES,
    spill: float = SPILL,
    leaf_rows: int = LEAF_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 1,
    recall: float = RECALL,
) -> DataFrame:
    """Key, n_links, component_id and kept, a row for each row of ``df``.

    Of the pairs at the similarity a share of ``recall`` meets, more of the closer ones; ``trees`` and
    ``leaf_rows`` are raised as far as that takes.

    Equal vectors are one class while they are compared. Vectors of different length, and those
    that aren't usable, link with nothing: such a row is its own component. A null key has null
    component and isn't kept. The other columns aren't read.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("good", usable("v") & F.col("id").isNotNull())
    good = rows.where("good")
    classes = keep(
        good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")).select("rep", "n", F.size("v").alias("size"), "v")
    )
    total = classes.count()
    forest = _fit(classes, total, similarity, recall, trees, spill, leaf_rows, sample_rows, seed)
    found = keep(_compare(classes, forest, similarity))
    star = components(found.where("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    answer = (
        classes.join(links, "rep", "left")
        .join(star.withColumnRenamed("id", "rep"), "rep", "left")
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    linked = good.select("id", "v").join(answer, "v").select("id", "n_links", "component_id")
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"))
    out = linked.unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    return out.select(F.col("id").alias(key), "n_links", "component_id", kept)


def _fit(classes, total, similarity, recall, trees, spill, leaf_rows, sample_rows, seed) -> dict[int, list[Tree]]:
    """By vector length. The sample is chosen by a hash, as many rows as asked for, more or less."""
    share = min(1.0, sample_rows / max(1, total))
    chosen = F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1)
    sample = classes.where(chosen).select("size", "v").toArrow()
    forest = {}
    for size in sorted(set(sample["size"].to_pylist())):
        own = sample.filter(pc.equal(sample["size"], size))["v"].combine_chunks()
        leaf = max(LEAST_SAMPLE, int(leaf_rows * share))
        forest[size] = _grow(_matrix(own), similarity, recall, trees, spill, leaf, seed)
    return forest


def _grow(sample, similarity, recall, trees, spill, leaf, seed) -> list[Tree]:
    """Trees in which enough pairs at the similarity meet, by two standard errors."""
    one, two = _partners(sample, similarity, seed)
    while True:
        grown, met = [], np.zeros(len(one), bool)
        while len(grown) < max(trees, MOST_TREES):
            grown.append(Tree(sample, leaf, spill, seed * 1000 + len(grown)))
            met |= _meet(grown[-1], one, two)
            share = met.mean() if len(met) else 1.0
            enough = share - 2 * np.sqrt(share * (1 - share) / max(1, len(met))) >= recall
            if len(grown) >= trees and enough:
                return grown
        if leaf >= len(sample):  # a single leaf, in which all meet
            return grown[:trees]
        leaf *= 2


def _partners(sample: np.ndarray, similarity: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the sample, and for each one at the similarity, as far from the mean as itself.

    Each is turned around the mean towards another vector of the sample, by a right angle at most.
    """
    rng = np.random.default_rng(seed)
    i, j = rng.integers(0, max(1, len(sample)), (2, TRIED_PAIRS if len(sample) > 1 else 0))
    length = lambda x: np.linalg.norm(x, axis=1, keepdims=True)
    mean = sample.mean(0)
    own, other = sample[i] - mean, sample[j] - mean
    some = length(own)[:, 0] > 1e-9
    own, other = own[some], other[some]
    other = other - (other * own).sum(1, keepdims=True) / length(own) ** 2 * own
    some = length(other)[:, 0] > 1e-9
    own, other = own[some], other[some]
    other *= length(own) / length(other)
    one = mean + own
    low, high = np.zeros((len(own), 1)), np.full((len(own), 1), np.pi / 2)
    for _ in range(40):
        angle = (low + high) / 2
        two = mean + np.cos(angle) * own + np.sin(angle) * other
        near = (one * two).sum(1, keepdims=True) >= similarity * length(one) * length(two)
        low, high = np.where(near, angle, low), np.where(near, high, angle)
    return one, two / length(two)


def _meet(tree: Tree, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether the rows share a leaf."""
    (i, a), (j, b) = tree.leaves(one), tree.leaves(two)
    nodes = len(tree.child)
    both = np.intersect1d(i * nodes + a, j * nodes + b)
    met = np.zeros(len(one), bool)
    met[both // nodes] = True
    return met


def _compare(classes: DataFrame, forest: dict[int, list[Tree]], similarity: float) -> DataFrame:
    """Rows rep, links, root: in each leaf the number of vectors linked there first, and a tie."""
    spark = classes.sparkSession
    model = spark.sparkContext.broadcast(forest)  # bounded by the sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["size"].to_numpy()
            leaves: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for size in np.unique(sizes).tolist():
                of = np.flatnonzero(sizes == size)
                unit = _matrix(batch["v"].take(pa.array(of)))
                own = model.value.get(size, [])
                for t, tree in enumerate(own):
                    for i, leaf in zip(*(x.tolist() for x in tree.leaves(unit))):
                        leaves[of[i]].append((size << 40) | (t << 32) | leaf)
                if not own:
                    for i in of:
                        leaves[i].append(size << 40)
            yield pa.record_batch(
                [batch["rep"], batch["n"], batch["v"], pa.array([sorted(x) for x in leaves], pa.list_(pa.int64()))],
                names=["rep", "n", "v", "leaves"],
            )

    placed = classes.mapInArrow(place, "rep long, n long, v array<double>, leaves array<long>")
    placed = placed.withColumn("leaf", F.explode("leaves"))
    # a large leaf is cut into chunks, and each pair of chunks is a cell
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("rows"))
    large = sizes.where(F.col("rows") > CELL_ROWS).select("leaf", F.ceil(F.col("rows") / CELL_ROWS).cast("int").alias("chunks"))
    chunked = placed.join(large, "leaf", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    chunked = chunked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = chunked.select(
        "leaf", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "chunk", "rep", "n", "v", "leaves"
    )
    return cells.groupBy("leaf", "a", "b").applyInArrow(
        lambda table: _cell(table, similarity), "rep long, links long, root long"
    )


def _cell(table: pa.Table, similarity: float) -> pa.Table:
    """Compare the rows of one cell: chunk a with chunk b, or one chunk with itself."""
    table = table.combine_chunks()
    unit = _matrix(table["v"].combine_chunks())
    chunk, a, b = table["chunk"].to_numpy(), table["a"][0].as_py(), table["b"][0].as_py()
    leaf, n, rep = table["leaf"][0].as_py(), table["n"].to_numpy(), table["rep"].to_numpy()
    left, right = np.flatnonzero(chunk == a), np.flatnonzero(chunk == b)
    earlier = _earlier(table["leaves"].combine_chunks(), leaf)
    links, root = np.zeros(len(rep), np.int64), np.arange(len(rep))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at in range(0, len(left), 1024):
        rows = left[at : at + 1024]
        near = unit[rows] @ unit[right].T >= similarity
        near &= rows[:, None] != right[None, :]
        i, j = np.nonzero(near)
        if not len(i):
            continue
        one, two = rows[i], right[j]
        new = ~(earlier[one] & earlier[two]).any(1) if len(one) < 1 << 16 else _new(earlier, one, two)
        np.add.at(links, one[new], n[two[new]])
        if a != b:
            np.add.at(links, two[new], n[one[new]])
        # a star from each row's first partner is enough to tie all of them
        for x in np.unique(one[new]) if new.any() else []:
            partners = two[new][one[new] == x]
            top = find(int(x))
            for y in partners.tolist():
                other = find(y)
                if other != top:
                    root[max(top, other)] = min(top, other)
                    top = min(top, other)
    used = np.flatnonzero(links)
    ties = rep[[find(int(i)) for i in used]] if len(used) else rep[:0]
    return pa.table({"rep": pa.array(rep[used], pa.int64()), "links": pa.array(links[used], pa.int64()), "root": pa.array(ties, pa.int64())})


def _new(earlier: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    out = np.empty(len(one), bool)
    for at in range(0, len(one), 1 << 16):
        s = slice(at, at + (1 << 16))
        out[s] = ~(earlier[one[s]] & earlier[two[s]]).any(1)
    return out


def _earlier(leaves: pa.ListArray, leaf: int) -> np.ndarray:
    """For each row the leaves before this one, as bits: two rows that share one met there."""
    flat = leaves.flatten().to_numpy()
    row = np.repeat(np.arange(len(leaves)), np.diff(leaves.offsets.to_numpy()))
    known, index = np.unique(flat[flat < leaf], return_inverse=True)
    bits = np.zeros((len(leaves), max(1, len(known))), bool)
    bits[row[flat < leaf], index] = True
    return np.packbits(bits, axis=1)
