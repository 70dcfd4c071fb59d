"""Packing documents into token sequences of fixed length by best-fit decreasing.

A document longer than a sequence is cut into full windows first. What remains of each document is
packed longest first, each piece into the open window it fills best, which a segment tree over
remaining capacity finds. Pieces are dealt out by a hash to groups that are packed independently;
only lengths and keys move.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kept import keep
from .worker import held
from .words import LOWER, flat

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END = 2  # id after each document
GROUP_ROWS = 2000  # pieces packed together: enough that the last windows hardly count
KNOWN_WORDS = 200_000  # words a worker remembers with their ids, twice
ENCODED_WORDS = 4096  # words encoded in one call, a kilobyte or more each until their ids are taken
SPLIT_BYTES = 1 << 24  # of texts whose words are looked up together, some 20 times that in memory; a longer text goes alone
_SPACE, _NAME = 32, b"<|"  # what the name of a special token begins with
# the vocabulary cuts between a letter and such a mark, so that a space there changes nothing
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[*b".,"]] = True


def with_spaces(texts: pa.Array) -> pa.Array:
    """The texts with a space between a letter and a mark that ends a word; null is empty.

    A to Z are lower-cased, as the vocabulary does, unless a text may name a special token, which
    has no capitals.
    """
    data, places = flat(texts)
    if len(data):
        if not ((data[:-1] == _NAME[0]) & (data[1:] == _NAME[1])).any():
            data = LOWER[data]
        ends = np.zeros(len(data), bool)  # whether a space or the end of a text comes next
        ends[:-1] = data[1:] == _SPACE
        ends[places[1:][places[1:] > 0] - 1] = True
        cut = _MARK[data] & ends
        cut[1:] &= _LETTER[data[:-1]]
        cut[0] = False
        cut[places[:-1][places[:-1] < len(data)]] = False
        cuts = np.flatnonzero(cut)
        data = np.insert(data, cuts, _SPACE)
        places = places + np.searchsorted(cuts, places)
    buffers = [None, pa.py_buffer(places.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(texts), buffers)


class KnownWords(dict):
    """Ids of the words met lately, as bytes. Words between spaces are encoded independently."""

    def __init__(self, name: str, most: int | None = None):
        super().__init__()
        self.most = most or KNOWN_WORDS
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.older: dict[str, bytes] = {}

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and where those of each begin. White space is dropped by the vocabulary.

        Each different word is looked up once; its ids are then gathered wherever it stands.
        """
        split = pc.split_pattern(with_spaces(texts), " ")
        words = split.flatten().dictionary_encode()
        packed = self.words(words.dictionary.to_pylist())
        place = np.asarray(words.indices)
        ids = np.frombuffer(b"".join(packed), "<u4")
        length = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        first = np.cumsum(length) - length
        many = length[place]
        ends = np.concatenate([[0], np.cumsum(many)])
        source = np.arange(ends[-1]) + np.repeat(first[place] - ends[:-1], many)
        bounds = np.asarray(split.offsets) - split.offsets[0].as_py()
        return ids[source], ends[bounds]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, 4 little-endian bytes each."""
        missing = [w for w in words if w not in self]
        if missing:
            self.update((w, self.older[w]) for w in missing if w in self.older)
            missing = [w for w in missing if w not in self]
            for at in range(0, len(missing), ENCODED_WORDS):
                part = missing[at : at + ENCODED_WORDS]
                found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
                self.update(zip(part, [_pack(e.ids) for e in found]))
        out = [*map(self.__getitem__, words)]
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        return out


def known_words(name: str, most: int | None = None) -> KnownWords:
    """One for all tasks of a worker."""
    return held(("packing", name, most), lambda: KnownWords(name, most))


def _pack(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if packed.itemsize != 4 or sys.byteorder != "little":
        return b"".join(i.to_bytes(4, "little") for i in ids)
    return packed.tobytes()


def token_pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    name: str = VOCABULARY,
    with_ids: bool = False,
    split_bytes: int = SPLIT_BYTES,
    most_words: int | None = None,
) -> DataFrame:
    """Full windows of each document and what remains: key, start, length, ids_crc32, doc_tokens.

    A null or empty text is the end id alone. Repeated rows give repeated pieces, a null key stays
    null; other columns aren't read. ``with_ids`` adds the ids. ``split_bytes`` of texts are treated together
    and ``most_words`` (KNOWN_WORDS) are remembered, twice: fewer take less memory and more time.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind)])
    for c in ("start", "length", "ids_crc32", "doc_tokens"):
        schema.add(c, T.LongType())
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known_words(name, most_words)
        for batch in batches:
            for low, high in _parts(batch[1], split_bytes):
                part = batch.slice(low, high - low)
                ids, bounds = words.texts(part[1])
                ids = np.insert(ids, bounds[1:], end).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                total = np.diff(bounds)
                pieces = -(-total // capacity)
                row = np.repeat(np.arange(len(total)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
                length = np.minimum(total[row] - start, capacity)
                at = bounds[row] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                out = [part[0].take(pa.array(row)), start, length, pa.array(crc, pa.int64()), total[row]]
                if with_ids:  # pieces follow one another as the ids do
                    offsets = pa.array(np.append(at, len(ids)), pa.int32())
                    out.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                yield pa.record_batch(out, names=schema.names)

    return docs.select(key, text).mapInArrow(cut, schema)


def _parts(texts: pa.Array, split_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of so many bytes at most."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + split_bytes, "right")))
        yield at, to
        at = to


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree that tells which capacities occur."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.windows: dict[int, list[int]] = {}

    def add(self, capacity: int, window: int) -> None:
        self.windows.setdefault(capacity, []).append(window)
        node = self.leaves + capacity
        while node and not self.any[node]:
            self.any[node] = True
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """Least remaining capacity that is at least this length."""
        node = self.leaves + length
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1  # to the right of a left child whose sibling has windows
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, capacity: int) -> int:
        own = self.windows[capacity]
        window = own.pop()
        if not own:
            node = self.leaves + capacity
            self.any[node] = False
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = False
                node >>= 1
        return window


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece; pieces of equal length in the order given."""
    window, offset = [0] * len(lengths), [0] * len(lengths)
    tree, used = OpenWindows(capacity), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if not 0 < lengths[i] <= capacity:
            raise ValueError(f"a piece of {lengths[i]} tokens")
        room = tree.tightest(lengths[i])
        if room is None:
            room, window[i] = capacity, used
            used += 1
        else:
            window[i] = tree.take(room)
        offset[i] = capacity - room
        if room > lengths[i]:
            tree.add(room - lengths[i], window[i])
    return window, offset


def pack(
    pieces: DataFrame,
    key: list[str],
    length: str = "length",
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The pieces with sequence_id, unique over all groups, and offset, gapless from 0 in each.

    ``key`` are columns by which pieces are dealt out and by which ties are broken. An empty table
    stays empty. Columns named sequence_id or offset are replaced.
    """
    kept = keep(pieces.drop("sequence_id", "offset"))
    groups = max(1, -(-kept.count() // group_rows))
    group = F.pmod(F.xxhash64(*key), F.lit(groups)).alias("_group")
    rows = kept.select(group, F.struct(*key, F.xxhash64(*kept.columns)).alias("_order"),
                       F.col(length).cast("long").alias("_length"), F.struct("*").alias("_row"))
    schema = T.StructType(
        [
            T.StructField("_row", kept.schema),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def one(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        window, offset = best_fit_decreasing(table["_length"].to_pylist(), capacity)
        first = table["_group"][0].as_py() << 32
        return pa.table(
            {
                "_row": table["_row"],
                "sequence_id": pa.array([first + w for w in window], pa.int64()),
                "offset": pa.array(offset, pa.int64()),
            }
        )

    return rows.groupBy("_group").applyInArrow(one, schema).select("_row.*", "sequence_id", "offset")


def _sorted(table: pa.Table) -> pa.Table:
    """In the order of the key, so that a rerun packs the same way."""
    order = pa.table(
        {str(i): c for i, c in enumerate(table["_order"].combine_chunks().flatten())}
    )
    by = [(c, "ascending") for c in order.column_names]
    return table.take(pc.sort_indices(order, sort_keys=by))
