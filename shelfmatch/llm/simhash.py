"""SimHash fingerprints of texts, their likeness, and search within a Hamming radius.

Terms are shingles of five words; each occurrence votes, by the bits of its hash, on the bits of
the fingerprint. The radius follows from the similarity of texts that are to be found. So many bits
are too many for tables by parts of the fingerprint: each fingerprint asked about is compared with
all, in groups, without a row for a pair.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import partitions
from .kept import keep
from .words import mix, split_words, windows

BITS = 256
SHINGLE = 5
SIMILARITY = 0.8  # Jaccard similarity of the sets of terms of near copies
DEVIATIONS = 2  # of the number of bits that differ: at least 97 of 100 pairs at just that similarity are found
PACKS = 16  # groups of the fingerprints asked about
_ASKED, _HELD = 16, 4096  # compared at once, so that the steps stay in a core's cache
_ROWS = 64  # votes added as bytes before they are widened
_LANES = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) % 2**64) for i in range(BITS // 64)]
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def radius_of(similarity: float, deviations: float = DEVIATIONS) -> int:
    """Bits by which texts of such a similarity differ, those of equally many terms."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(BITS * share + deviations * math.sqrt(BITS * share * (1 - share)))


RADIUS = radius_of(SIMILARITY)


def terms(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and where those of each text begin.

    A text of fewer words than a shingle has one term, its whole sequence; without words none.
    """
    words = split_words(texts)
    hashes = words.hashes()
    n = np.diff(words.first)
    full = windows(hashes, shingle)[words.fits(shingle)[: max(0, len(hashes) - shingle + 1)]]
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(first[-1], np.uint64)
    short = np.zeros(first[-1], bool)
    for k in range(1, shingle):
        those = np.flatnonzero(n == k)
        if len(those):
            out[first[those]] = windows(hashes, k)[words.first[those]]
            short[first[those]] = True
    out[~short] = full
    return out, first


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """A row of bytes for each text. No terms, no votes: all bits 0."""
    hashes, first = terms(texts, shingle)
    n = np.diff(first)
    # rows of votes, so many for each text that they are a multiple of _ROWS
    parts = -(-n // _ROWS)
    start = np.concatenate([[0], np.cumsum(parts)])
    votes = np.zeros((len(n), BITS), np.int32)
    step = 2048  # parts at a time: 32 MB of votes
    row = np.arange(len(hashes)) + np.repeat(start[:-1] * _ROWS - first[:-1], n)
    owner = np.repeat(np.arange(len(n)), parts)
    for a in range(0, int(start[-1]), step):
        b = min(a + step, int(start[-1]))
        low, high = np.searchsorted(row, [a * _ROWS, b * _ROWS])
        some = hashes[low:high]
        bits = np.zeros(((b - a) * _ROWS, BITS // 8), np.uint8)
        wide = np.stack([mix(some ^ lane) for lane in _LANES], axis=1)
        bits[row[low:high] - a * _ROWS] = wide.view(np.uint8).reshape(len(some), BITS // 8)
        sums = np.unpackbits(bits, axis=1).reshape(b - a, _ROWS, BITS).sum(1, dtype=np.uint8)
        begin = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
        votes[owner[a:b][begin]] += np.add.reduceat(sums, begin, axis=0, dtype=np.int32)
    return np.packbits(2 * votes > n[:, None], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated cosine of the term vectors, 0 at least. Nothing is like a text without terms."""
    apart = np.unpackbits(a ^ b, axis=1).sum(1)
    like = np.maximum(0.0, np.cos(np.pi * apart / BITS))
    return np.where(apart == 0, 1.0, np.where(a.any(1) & b.any(1), like, 0.0))


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the beginning of another text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and likeness to that and to the next text.

    Documents follow each other by descending key, equal keys by text, a null key last; after the
    last comes the first. They are range-partitioned and sorted, so each text moves once; the ends
    of partitions are put together from one row each. A null text is empty. Other columns aren't
    read.
    """
    spark = docs.sparkSession
    order = F.col("doc_id").desc_nulls_last()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(partitions(spark), order).sortWithinPartitions(order, "text")
    made = keep(rows.mapInArrow(_with_next, f"{RESULT}, part int, end string, text string"))
    inner = made.where("end is null").select(COLUMNS)
    # one or two rows of each partition; a text here is a whole document
    ends = made.where("end is not null").select("part", "end", "doc_id", "text")
    heads = ends.where("end = 'head'").select("part", F.col("text").alias("next"))
    tails = ends.where("end = 'tail'").select("part", "doc_id", "text")
    parts = [r[0] for r in heads.select("part").orderBy("part").collect()]  # as many as partitions
    follow = spark.createDataFrame(
        [(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, after int"
    )
    joined = tails.join(F.broadcast(follow), "part").join(
        heads.withColumnRenamed("part", "after"), "after"
    )
    return inner.unionByName(joined.select("doc_id", "text", "next").mapInArrow(_pairs, RESULT))


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    ids, texts = [], []
    for batch in batches:
        if not ids and batch.num_rows:
            yield _ends(part, "head", batch[0][0].as_py(), batch[1][0].as_py())
        ids += batch[0].to_pylist()
        texts += batch[1].to_pylist()
        if len(ids) > 1:
            done = _compared(ids[:-1], texts[:-1], texts[1:])
            n = len(ids) - 1
            none = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())]
            yield pa.record_batch(done.columns + none, names=[*done.schema.names, "part", "end", "text"])
        ids, texts = ids[-1:], texts[-1:]
    if ids:
        yield _ends(part, "tail", ids[0], texts[0])


def _ends(part: int, end: str, doc_id: int | None, text: str) -> pa.RecordBatch:
    none = {c: pa.nulls(1, t) for c, t in zip(COLUMNS, _KINDS)}
    none |= {"doc_id": pa.array([doc_id], pa.int64()), "part": pa.array([part], pa.int32())}
    return pa.record_batch(none | {"end": pa.array([end]), "text": pa.array([text])})


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _compared(*(c.to_pylist() for c in batch.columns))


COLUMNS = [c.split()[0] for c in RESULT.split(", ")]
_KINDS = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in RESULT.split(", ")]


def _compared(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    changed = [edited(a, b) for a, b in zip(texts, following)]
    n = len(texts)
    # each text's own fingerprint, and that of the text after the last
    own = fingerprints(pa.array([*texts, *following[-1:]], pa.large_string()))
    after = own[1:]
    if any(a != b for a, b in zip(following, texts[1:])):
        after = fingerprints(pa.array(following, pa.large_string()))
    own, other = own[:n], fingerprints(pa.array(changed, pa.large_string()))
    columns = [
        ids,
        [len(t) for t in texts],
        [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        [f.tobytes().hex() for f in own],
        [f.tobytes().hex() for f in other],
        likeness(own, other),
        likeness(own, after),
    ]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=COLUMNS)


def near_counts(
    prints: DataFrame, queries: DataFrame, fingerprint: str = "fingerprint", radius: int = RADIUS
) -> DataFrame:
    """For each fingerprint of ``queries`` the number of rows of ``prints`` within the radius.

    Equal fingerprints are one class. All classes are found: they are dealt to as many groups as
    partitions, and each group sees all fingerprints asked about, packed into few rows. Near a text
    without terms are only other such texts.
    """
    groups = partitions(prints.sparkSession)
    bytes_ = F.unhex(fingerprint).alias("print")
    dealt = lambda n: F.pmod(F.xxhash64("print"), F.lit(n)).cast("int")
    classes = prints.groupBy(bytes_).agg(F.count("*").alias("n")).withColumn("_group", dealt(groups))
    asked = queries.select(bytes_).distinct().withColumn("_pack", dealt(PACKS))
    packs = asked.groupBy("_pack").applyInArrow(_packed, "prints binary")
    packs = packs.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def count(held: pa.Table, packs: pa.Table) -> pa.Table:
        prints, n = _longs(held["print"].to_pylist()), held["n"].to_numpy()
        asked = _longs(packs["prints"].to_pylist())
        found = _count_near(asked, prints, n, radius) if len(prints) else np.zeros(len(asked), np.int64)
        some = np.flatnonzero(found)
        return pa.table(
            {
                fingerprint: pa.array([asked[i].tobytes().hex() for i in some], pa.string()),
                "n": pa.array(found[some], pa.int64()),
            }
        )

    met = classes.groupBy("_group").cogroup(packs.groupBy("_group"))
    met = met.applyInArrow(count, T.StructType().add(fingerprint, "string").add("n", "long"))
    return met.groupBy(fingerprint).agg(F.sum("n").alias("n_near"))


def _packed(table: pa.Table) -> pa.Table:
    return pa.table({"prints": pa.array([b"".join(table["print"].to_pylist())], pa.binary())})


def _longs(prints: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(prints), np.uint64).reshape(-1, BITS // 64)


def _count_near(asked: np.ndarray, held: np.ndarray, n: np.ndarray, radius: int) -> np.ndarray:
    """For each row asked about, the sum of n over the rows held within the radius."""
    found = np.zeros(len(asked), np.int64)
    for b in range(0, len(held), _HELD):
        some = held[b : b + _HELD]
        lanes = np.ascontiguousarray(some.T)
        # used again and again: new memory would take longer than the arithmetic
        bits, one, two = (np.empty((_ASKED, len(some)), t) for t in (np.uint64, np.uint8, np.uint8))
        for a in range(0, len(asked), _ASKED):
            rows = asked[a : a + _ASKED]
            x, c, d = bits[: len(rows)], one[: len(rows)], two[: len(rows)]
            # three quarters of the bits tell nearly all pairs apart
            np.bitwise_count(np.bitwise_xor(rows[:, :1], lanes[0], out=x), out=c)
            for lane in (1, 2):
                np.bitwise_count(np.bitwise_xor(rows[:, lane : lane + 1], lanes[lane], out=x), out=d)
                c += d
            i, j = np.divmod(np.flatnonzero(c <= radius), len(some))
            if not len(i):
                continue
            apart = np.bitwise_count(rows[i] ^ some[j]).sum(1, dtype=np.int64)
            near = (apart <= radius) & (rows[i].any(1) == some[j].any(1))
            np.add.at(found, a + i[near], n[b + j[near]])
    return found
