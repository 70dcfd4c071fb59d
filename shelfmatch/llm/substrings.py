"""Removal of word sequences that have occurred before, found by level-wise doubling.

Windows of a few words are looked up in the whole corpus; only where two of them that overlap or
touch are both repeated, a window of twice the length can be, and only those are looked up next,
until the wanted length is reached or no candidates are left. At the last level the first of all
occurrences is told from the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import LETTERS, answers, asked, bucket_count, in_blocks, letters, shared_counts
from .words import mix, split_words, windows

WINDOW = 20
SHORTEST = 5  # words of the windows at the first level
_LANE = np.uint64(0xA0761D6478BD642F)


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths, each at most twice the one before."""
    found = [window]
    while found[0] > shortest:
        found.insert(0, (found[0] + 1) // 2)
    return found


def _low(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class Block:
    """The documents of a block in order, their words, and what is known of their windows."""

    def __init__(self, table: pa.Table, key: str, text: str, lengths: list[int]):
        row = table["_row"].combine_chunks()
        if isinstance(row, pa.ChunkedArray):
            row = pa.concat_arrays(row.chunks)
        order = pa.table({"key": row.field(key), "text": row.field(text)})
        order = pc.sort_indices(
            order, sort_keys=[("key", "ascending"), ("text", "ascending")], null_placement="at_start"
        )
        self.rows = row.take(order)
        self.keys = self.rows.field(key)
        self.words = split_words(self.rows.field(text))
        self.hashes, self.lengths = self.words.hashes(), lengths

    def candidates(self, level: int, repeated: np.ndarray | None) -> np.ndarray:
        """Places where a window of this level can be repeated, from those of the level before."""
        fits = self.words.fits(self.lengths[level])
        if repeated is None:
            return np.flatnonzero(fits)
        step = self.lengths[level] - self.lengths[level - 1]
        shifted = np.zeros(len(fits), bool)
        end = max(0, len(fits) - step)  # a block can hold fewer words than the step
        shifted[:end] = repeated[step : step + end]
        return np.flatnonzero(fits & repeated & shifted)

    def window_hashes(self, level: int, places: np.ndarray, seed: int = 0) -> np.ndarray:
        words = mix(self.hashes ^ _LANE) if seed else self.hashes
        return windows(words, self.lengths[level])[places]

    def repeated(self, level: int, replies: pa.Table) -> np.ndarray:
        """For each word, whether a window of this level that is repeated begins there."""
        found, echo = answers(replies)
        mask = np.unpackbits(np.frombuffer(echo, np.uint8), count=len(self.hashes)).astype(bool)
        places = np.flatnonzero(mask)
        _, inverse = np.unique(self.window_hashes(level, places), return_inverse=True)
        flags = np.concatenate([np.frombuffer(f, np.uint8) for f in found] or [np.zeros(0, np.uint8)])
        out = np.zeros(len(self.hashes), bool)
        out[places] = flags[inverse] > 0
        return out

    def send(self, block: int, level: int, places: np.ndarray, buckets: int) -> pa.Table:
        mask = np.zeros(len(self.hashes), bool)
        mask[places] = True
        echo = np.packbits(mask).tobytes()
        if level < len(self.lengths) - 1:
            h, count = np.unique(self.window_hashes(level, places), return_counts=True)
            return letters(block, h, buckets, _low(h), (count > 1).astype(np.uint8), echo)
        h, lane, first, _ = self.last_windows(places)
        sent = np.empty(len(h), [("hash", "<u8"), ("lane", "<u4"), ("key", "<i8")])
        sent["hash"], sent["lane"], sent["key"] = h, lane, self.key_of(places[first])
        return letters(block, h, buckets, sent, np.zeros(len(h), np.uint8), echo)

    def last_windows(self, places: np.ndarray) -> tuple:
        """Distinct windows by hash, the first place of each, and for each place its window."""
        level = len(self.lengths) - 1
        h, lane = self.window_hashes(level, places), _low(self.window_hashes(level, places, 1))
        order = np.lexsort((lane, h))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (lane[order][1:] != lane[order][:-1])
        of = np.empty(len(h), np.int64)
        of[order] = np.cumsum(new) - 1
        first = order[new]
        return h[first], lane[first], first, of

    def key_of(self, places: np.ndarray) -> np.ndarray:
        """Keys as numbers; a null key comes before all others."""
        keys = pc.fill_null(self.keys, -(1 << 63)).to_numpy(zero_copy_only=False)
        return keys[self.words.doc[places]]

    def covered(self, replies: pa.Table) -> np.ndarray:
        """Words in windows that also begin earlier."""
        found, echo = answers(replies)
        n = len(self.hashes)
        places = np.flatnonzero(np.unpackbits(np.frombuffer(echo, np.uint8), count=n))
        _, _, first, of = self.last_windows(places)
        here = np.concatenate([np.frombuffer(f, np.uint8) for f in found] or [np.zeros(0, np.uint8)]) > 0
        earliest = np.zeros(len(places), bool)
        earliest[first[here]] = True
        ends = np.zeros(n + 1, np.int64)
        begin = places[~earliest]
        ends[begin] += 1
        ends[begin + self.lengths[-1]] -= 1  # distinct places, so no index comes twice
        return np.cumsum(ends[:-1]) > 0


def _repeated(keys: list[bytes], more: list[bytes]) -> list[bytes]:
    """Which hashes occur at least twice in all blocks."""
    total = shared_counts(keys, np.uint32, [1 + np.frombuffer(m, np.uint8) for m in more])
    return [(t > 1).astype(np.uint8).tobytes() for t in total]


def _first(keys: list[bytes], more: list[bytes]) -> list[bytes]:
    """Which windows have no occurrence under a smaller key. Equal keys share a block."""
    kind = [("hash", "<u8"), ("lane", "<u4"), ("key", "<i8")]
    arrays = [np.frombuffer(k, kind) for k in keys]
    everything = np.concatenate(arrays)
    order = np.lexsort((everything["key"], everything["lane"], everything["hash"]))
    ordered = everything[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered["hash"][1:] != ordered["hash"][:-1]) | (ordered["lane"][1:] != ordered["lane"][:-1])
    flags = np.zeros(len(order), np.uint8)
    flags[order[new]] = 1
    parts = np.split(flags, np.cumsum([len(a) for a in arrays])[:-1])
    return [p.tobytes() for p in parts]


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shortest: int = SHORTEST,
) -> DataFrame:
    """The columns of ``docs`` and a struct ``repeats`` of n_words, n_removed and kept.

    A word is removed if it lies in a window of ``window`` words that also begins earlier: in a
    document of smaller key, or before in the same one. ``kept`` are the other words, joined by one
    space. A null text has no words; a null key comes first; rows of equal key follow each other by
    text. The key must be an integer. A column named ``repeats`` is replaced.
    """
    lengths = levels(window, shortest)
    buckets = bucket_count(docs.sparkSession)
    docs = docs.drop("repeats")
    docs = docs.withColumn(key, F.col(key).cast("long"))
    placed = in_blocks(docs, key)

    def begin(table: pa.Table) -> pa.Table:
        block = Block(table, key, text, lengths)
        return block.send(table["_block"][0].as_py(), 0, block.candidates(0, None), buckets)

    sent = placed.groupBy("_block").applyInArrow(begin, LETTERS)
    def further(level: int):
        def look(table: pa.Table, replies: pa.Table) -> pa.Table:
            block = Block(table, key, text, lengths)
            places = block.candidates(level, block.repeated(level - 1, replies))
            return block.send(table["_block"][0].as_py(), level, places, buckets)

        return look

    for level in range(1, len(lengths)):
        replies = asked(sent, _repeated, buckets).groupBy("_block")
        sent = placed.groupBy("_block").cogroup(replies).applyInArrow(further(level), LETTERS)

    answer = T._parse_datatype_string("n_words long, n_removed long, kept string")
    schema = T.StructType([T.StructField("_row", docs.schema), T.StructField("repeats", answer)])

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(table, key, text, lengths)
        covered = block.covered(replies)
        before = np.concatenate([[0], np.cumsum(covered)])
        removed = before[block.words.first[1:]] - before[block.words.first[:-1]]
        repeats = pa.StructArray.from_arrays(
            [
                pa.array(np.diff(block.words.first), pa.int64()),
                pa.array(removed, pa.int64()),
                block.words.kept(~covered),
            ],
            names=["n_words", "n_removed", "kept"],
        )
        return pa.table({"_row": block.rows, "repeats": repeats})

    replies = asked(sent, _first, buckets)
    out = placed.groupBy("_block").cogroup(replies.groupBy("_block")).applyInArrow(finish, schema)
    return out.select("_row.*", "repeats")
