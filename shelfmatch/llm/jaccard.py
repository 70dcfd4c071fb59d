"""Jaccard join of word n-gram sets by token-combination prefixes.

The n-grams of a document are ordered by how many documents have them, rare ones first. Documents
that are similar enough share an n-gram in their prefixes. Rare n-grams of the prefix are indexed
alone. If the prefix reaches frequent ones, it is extended: the two documents then share more than
C frequent n-grams, so that of C hash classes one has two of them, and pairs of frequent n-grams of
one class are indexed. Documents meet under an index key and are verified with their whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import LETTERS, answers, asked, bucket_count, in_blocks, letters, shared_counts
from .components import components
from .kept import keep
from .words import combine, mix, split_words, windows

SHINGLE = 4
PERCENT = 85
FREQUENT = 6  # an n-gram of 2 ** 6 documents or more is frequent
COMBINED_FROM = 4  # documents of fewer than 2 ** 4 n-grams index frequent ones alone
PER_CLASS = 16  # a band of sizes from 2 ** b on has 2 ** b / 16 classes
CELL_ROWS, CELL_GRAMS = 1024, 1 << 20  # what is compared at a time, on each side
SETS = "id long, size long, keys array<long>, grams array<long>"


class Block:
    """The documents of a block that stand for their copies, and their sets."""

    def __init__(self, table: pa.Table, shingle: int, chosen: np.ndarray | None):
        row = table["_row"].combine_chunks()
        if isinstance(row, pa.ChunkedArray):
            row = pa.concat_arrays(row.chunks)
        ids, texts = row.field("id"), row.field("text")
        order = pc.sort_indices(pa.table({"id": ids, "text": texts}), sort_keys=[("id", "ascending"), ("text", "ascending")])
        ids, texts = ids.take(order), texts.take(order)
        if chosen is not None:  # one text of each chosen id
            number = ids.to_numpy()
            new = np.concatenate([[True], number[1:] != number[:-1]]) & np.isin(number, chosen)
            ids, texts = ids.filter(pa.array(new)), texts.filter(pa.array(new))
        self.ids = ids.to_numpy()
        words = split_words(texts, lower=True)
        hashes, n = words.hashes(), np.diff(words.first)
        doc = words.doc
        full = np.flatnonzero(words.fits(shingle))
        found, owner = [windows(hashes, shingle)[full]], [doc[full]]
        for k in range(1, shingle):
            those = np.flatnonzero(n == k)
            if len(those):
                # a sequence shorter than an n-gram is no n-gram, whatever its words
                found.append(mix(windows(hashes, k)[words.first[those]] ^ np.uint64(k)))
                owner.append(those)
        grams, owner = np.concatenate(found), np.concatenate(owner)
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        self.grams, self.owner = grams[new], owner[new]
        self.first = np.searchsorted(self.owner, np.arange(len(self.ids) + 1))

    def send(self, block: int, buckets: int) -> pa.Table:
        h, count = np.unique(self.grams, return_counts=True)
        low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return letters(block, h, buckets, low, count.astype(np.uint32), self.ids.tobytes())

    def commonness(self, found: list[bytes]) -> np.ndarray:
        _, inverse = np.unique(self.grams, return_inverse=True)
        return np.concatenate([np.frombuffer(f, np.uint8) for f in found] or [np.zeros(0, np.uint8)])[inverse]

    def rows(self, common: np.ndarray, percent: int) -> pa.Table:
        order = np.lexsort((self.grams, common, self.owner))
        grams, common = self.grams[order], common[order]
        size = np.diff(self.first)
        prefix = size - -(-percent * size // 100) + 1
        # only documents with a shared n-gram in the prefix have keys
        seen = np.concatenate([[0], np.cumsum(common > 0)])
        some = seen[self.first[:-1] + np.minimum(prefix, size)] > seen[self.first[:-1]]
        keys, sets = [None] * len(size), [None] * len(size)
        for i in np.flatnonzero(some).tolist():
            own = slice(self.first[i], self.first[i + 1])
            keys[i] = index_keys(grams[own], common[own], percent).view(np.int64)
            sets[i] = grams[own].view(np.int64)
        lists = pa.list_(pa.int64())
        return pa.table(
            {
                "id": pa.array(self.ids, pa.int64()),
                "size": pa.array(size, pa.int64()),
                "keys": pa.array(keys, lists),
                "grams": pa.array(sets, lists),
            }
        )


def _commonness(keys: list[bytes], more: list[bytes]) -> list[bytes]:
    """The logarithm, to base 2 and rounded down, of the number of documents."""
    total = shared_counts(keys, np.uint32, [np.frombuffer(m, np.uint32) for m in more])
    return [np.log2(np.maximum(t, 1)).astype(np.uint8).tobytes() for t in total]


def bands(size: int, percent: int = PERCENT) -> list[int]:
    """Of a document: that of its size, and the next if a document in it can be similar enough."""
    band = size.bit_length() - 1
    return [band, band + 1] if 100 * size >= percent << (band + 1) else [band]


def index_keys(grams: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of one document, whose n-grams come by commonness and hash. N-grams that no other
    document has count as part of the prefix but need no key."""
    size = len(grams)
    least = -(-percent * size // 100)  # n-grams shared with any similar document
    prefix = size - least + 1
    rare = int(np.searchsorted(common, FREQUENT))
    keys = [grams[: min(prefix, rare)][common[: min(prefix, rare)] > 0]]
    if prefix > rare:
        for band in bands(size, percent):
            mark = np.uint64(band + 1)
            if band < COMBINED_FROM:
                keys.append(mix(grams[rare:prefix] ^ mark))
                continue
            classes = (1 << band) // PER_CLASS
            longer = grams[rare : prefix + classes]
            group = (mix(longer) >> np.uint64(32)) % np.uint64(classes)
            order = np.argsort(group, kind="stable")
            longer, group = longer[order], group[order]
            for distance in range(1, len(longer)):
                same = group[distance:] == group[:-distance]
                if not same.any():
                    break
                a, b = longer[:-distance][same], longer[distance:][same]
                keys.append(combine(np.minimum(a, b) ^ mark, np.maximum(a, b)))
    return np.unique(np.concatenate(keys))


def _sets(base: DataFrame, standing: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Of each document that stands for its copies: size, index keys and, if it has any, its set."""
    buckets = bucket_count(base.sparkSession)
    placed = in_blocks(base, "id")
    chosen = in_blocks(standing.select("id"), "id").select("_block", F.col("_row.id").alias("id"))

    def begin(table: pa.Table, ids: pa.Table) -> pa.Table:
        block = Block(table, shingle, ids["id"].to_numpy())
        return block.send(table["_block"][0].as_py(), buckets)

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        found, echo = answers(replies)
        block = Block(table, shingle, np.frombuffer(echo, np.int64))
        return block.rows(block.commonness(found), percent)

    sent = placed.groupBy("_block").cogroup(chosen.groupBy("_block")).applyInArrow(begin, LETTERS)
    replies = asked(sent, _commonness, buckets)
    return placed.groupBy("_block").cogroup(replies.groupBy("_block")).applyInArrow(finish, SETS)


def _compatible(a: str, b: str, percent: int) -> F.Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b that link, compared by their whole sets."""
    grams = sets.where(F.col("grams").isNotNull())
    b = grams.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    a = grams.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    shared = F.size(F.array_intersect("ga", "gb"))
    link = 100 * shared >= percent * (F.size("ga") + F.size("gb") - shared)
    return pairs.join(b, "b").join(a, "a").where(link).select("a", "b")


def links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links enough to tie all similar documents together, columns a and b.

    Each document is first compared with the one that it meets most often as the first under a key,
    which puts most documents of a large group of near copies into one component. Then all that
    meet under a key and are in different components are compared; no pair that could tie two
    components is left out.
    """
    index = sets.select("id", "size", F.explode("keys").alias("key"))
    least = F.min(F.struct("id", "size")).alias("first")
    shared = index.groupBy("key").agg(least, F.count("*").alias("n")).where("n > 1").drop("n")
    met = keep(index.join(shared, "key"))
    candidates = (
        met.select(F.col("first.id").alias("a"), F.col("id").alias("b"), "size", F.col("first.size").alias("other"))
        .where((F.col("a") != F.col("b")) & _compatible("size", "other", percent))
        .groupBy("b", "a")
        .agg(F.count("*").alias("n"))
    )
    best = candidates.groupBy("b").agg(F.max(F.struct("n", -F.col("a"))).alias("best"))
    tried = keep(best.select((-F.col("best.col2")).alias("a"), "b"))
    first = keep(_verified(tried, sets, percent))
    tied = components(first)

    named = met.join(tied, "id", "left").select(
        "key", "id", "size", F.coalesce("component", "id").alias("component"), F.col("first.id").alias("first")
    )
    ends = [F.min("component").alias("low"), F.max("component").alias("high")]
    mixed = named.groupBy("key").agg(*ends).where("low < high").select("key")
    left = keep(named.join(mixed, "key").select("key", "id", "size", "component", "first").distinct())
    return first.unionByName(keep(_across(left, sets, percent)))


def _across(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components that meet under a key.

    Documents that meet, also by way of others, are a cluster. In each cluster the documents that
    are not in its largest component are compared with all others, a chunk of the ones with a chunk
    of the others at a time. Pairs are never rows; a cell gives links that tie what it finds.
    """
    cluster = components(left.select(F.col("first").alias("a"), F.col("id").alias("b")))
    cluster = cluster.withColumnRenamed("component", "cluster")
    docs = left.select("id", "size", "component").distinct().join(cluster, "id")
    parts = docs.groupBy("cluster", "component").agg(
        F.count("*").alias("n"), F.sum("size").alias("grams")
    )
    whole = parts.groupBy("cluster").agg(
        F.max(F.struct("n", "grams", "component")).alias("main"),
        F.sum("n").alias("n"),
        F.sum("grams").alias("grams"),
    )
    chunks = lambda n, grams: F.greatest(F.ceil(n / CELL_ROWS), F.ceil(grams / CELL_GRAMS), F.lit(1))
    n, grams, main = F.col("n"), F.col("grams"), F.col("main")
    whole = whole.select(
        "cluster",
        main["component"].alias("main"),
        chunks(n, grams).cast("int").alias("all_chunks"),
        chunks(n - main["n"], grams - main["grams"]).cast("int").alias("own_chunks"),
    )
    rows = docs.drop("size").join(whole, "cluster").join(sets.select("id", "grams"), "id")
    part = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = rows.where("component != main").select(
        "cluster", part("own_chunks", 1).alias("i"), each("all_chunks").alias("j"),
        F.lit(True).alias("own"), "id", "component", "grams",
    )
    others = rows.select(
        "cluster", each("own_chunks").alias("i"), part("all_chunks", 2).alias("j"),
        F.lit(False).alias("own"), "id", "component", "grams",
    )
    cells = own.unionByName(others).groupBy("cluster", "i", "j")
    return cells.applyInArrow(lambda table: _cell(table, percent), "a long, b long")


def _cell(table: pa.Table, percent: int) -> pa.Table:
    """Compare the own documents of a cell with the others by counting shared n-grams."""
    own = table["own"].to_numpy()
    ids, component = table["id"].to_numpy(), table["component"].to_numpy()
    lists = pa.concat_arrays(table["grams"].chunks)
    size = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(ids)), size)
    _, gram = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    mine, theirs = np.flatnonzero(own), np.flatnonzero(~own)
    place = np.empty(len(ids), np.int64)
    place[mine], place[theirs] = np.arange(len(mine)), np.arange(len(theirs))
    # only n-grams of both sides count
    sides = [np.zeros(gram.max() + 1, bool), np.zeros(gram.max() + 1, bool)]
    sides[0][gram[own[row]]] = sides[1][gram[~own[row]]] = True
    number = np.cumsum(sides[0] & sides[1]) - 1
    both = (sides[0] & sides[1])[gram]
    row, gram = row[both], number[gram[both]]
    order = np.argsort(gram, kind="stable")
    row, gram = row[order], gram[order]
    shared = np.zeros((len(mine), len(theirs)), np.float32)
    step = 4096  # n-grams at a time
    for low in range(0, int(number.max(initial=-1)) + 1, step):
        a, b = np.searchsorted(gram, [low, low + step])
        some, at = row[a:b], gram[a:b] - low
        left = np.zeros((len(mine), step), np.float32)
        right = np.zeros((len(theirs), step), np.float32)
        left[place[some[own[some]]], at[own[some]]] = 1
        right[place[some[~own[some]]], at[~own[some]]] = 1
        shared += left @ right.T
    union = size[mine][:, None] + size[theirs][None, :] - shared
    link = (100 * shared >= percent * union) & (component[mine][:, None] != component[theirs][None, :])
    # one link between two components is enough
    i, j = np.nonzero(link)
    ties = np.stack([component[mine[i]], component[theirs[j]]], axis=1)
    _, once = np.unique(ties, axis=0, return_index=True)
    return pa.table({"a": pa.array(ids[mine[i[once]]], pa.int64()), "b": pa.array(ids[theirs[j[once]]], pa.int64())})


def link_similar(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Key, n_shingles, component_id: a row for each row of ``docs``.

    Documents link when 100 * shared n-grams >= percent * n-grams of either. A document without
    words has an empty set and is its own component. Rows of equal text are one document while sets
    are compared; rows of equal key are one document too, with the least of their texts. A null key
    can't be named: such a row gets the component of its text, or null if no row of that text has a
    key. The key must be an integer; other columns aren't read.
    """
    base = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    members = keep(base.select("id", F.unhex(F.sha2(folded, 256)).alias("same")))
    standing = keep(members.where("id is not null").groupBy("same").agg(F.min("id").alias("id")))
    sets = keep(_sets(base.where("id is not null"), standing, shingle, percent))
    tied = components(links(sets, percent))
    # texts without words don't link with each other, so their rows stay alone
    found = standing.join(sets.select("id", "size"), "id").join(tied, "id", "left")
    found = found.select("same", F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component"))
    alone = F.col("id").isNotNull() & (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("id")).otherwise(F.col("component"))
    return members.join(found, "same", "left").select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id")
    )
