"""Byte-level BPE by a queue over merge ranks, for vocabularies given as ranks of byte strings.

The tokens of a piece of text are a linked list of places. Each place waits, with the token after
it, in the bucket of the rank that the two have together; a hierarchy of bitmaps tells the least
rank whose bucket holds places, by finding the first bit set in one word a level. A merge makes the
entries of its neighbours stale; they are skipped when their turn comes. A piece of n bytes takes
n log n steps at most, however long it is.

Texts are cut before white space that follows something else, where the pattern always cuts, so
that no more than a group of slices is held as pieces. The pieces of a group that are not known yet
are merged together: side by side in one list with a place between them that merges with nothing,
so that a bucket is emptied for all of them at once.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .worker import held

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD = 8  # binary logarithm of the bits in one word of a bitmap
KNOWN_PIECES = 400_000  # pieces that a worker remembers with their tokens, twice
LONGEST_KNOWN = 64  # characters of a piece that is worth remembering
SLICE = 1 << 16  # characters of a text that are cut into pieces at a time
GROUP = 1 << 19  # characters whose pieces are merged together
BATCH_BYTES = 1 << 24  # of ids answered in one batch
NEVER = -1
_BITS = (1 << WORD) - 1


class RankQueue:
    """Places waiting in a bucket for each rank, and the least rank that has some."""

    def __init__(self, ranks: int):
        self.levels: list[list[int]] = []  # bitmaps; a bit says that a word below is not zero
        words = max(1, ranks)
        while True:
            words = ((words - 1) >> WORD) + 1
            self.levels.append([0] * words)
            if words == 1:
                break
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, place: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(place)
            return
        self.buckets[rank] = [place]
        for level in self.levels:
            bit, rank = 1 << (rank & _BITS), rank >> WORD
            known = level[rank]
            level[rank] = known | bit
            if known:
                return

    def least(self) -> int | None:
        if not self.levels[-1][0]:
            return None
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            at = (at << WORD) + (word & -word).bit_length() - 1
        return at

    def take(self, rank: int) -> list[int]:
        """All places of a rank that has some, from left to right."""
        places = self.buckets.pop(rank)
        for level in self.levels:
            bit, rank = 1 << (rank & _BITS), rank >> WORD
            rest = level[rank] = level[rank] ^ bit
            if rest:
                break
        places.sort()
        return places


class Ranks:
    """A vocabulary: the rank of each byte string is its id."""

    def __init__(self, name: str = VOCABULARY):
        self.ids: dict[bytes, int] = {}
        with open(public_tokenizers.path(name), "rb") as file:
            for line in file:
                if line.strip():
                    token, rank = line.split()
                    self.ids[base64.b64decode(token)] = int(rank)
        self.prepare()

    def prepare(self) -> None:
        self.bytes: list[bytes | None] = [None] * (max(self.ids.values()) + 1)
        for token, rank in self.ids.items():
            self.bytes[rank] = token
        self.single = [self.ids[bytes([b])] for b in range(256)]
        pairs = (bytes([a, b]) for a in range(256) for b in range(256))
        self.double = [self.ids.get(pair, NEVER) for pair in pairs]  # ranks of two bytes
        self.queue = RankQueue(len(self.bytes))

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece. Of all tokens side by side the two of least rank, of equals the
        leftmost, become one, until no two have a rank."""
        found = [self.ids.get(p) for p in pieces]
        todo = [i for i, whole in enumerate(found) if whole is None and pieces[i]]
        out = [[] if whole is None else [whole] for whole in found]
        # a zero byte stands between pieces; its token marks that nothing merges with it
        data = b"\0".join([b"", *(pieces[i] for i in todo), b""])
        token = [*map(self.single.__getitem__, data)]  # at each place where one begins
        rank = [self.double[a << 8 | b] for a, b in zip(data, data[1:])]  # with the token after
        rank.append(NEVER)
        firsts, at = [], 0
        for i in todo:
            token[at] = rank[at] = rank[at - 1] = NEVER
            firsts.append(at + 1)
            at += 1 + len(pieces[i])
        if todo:
            token[at] = rank[at] = rank[at - 1] = NEVER
            self._merge(data, token, rank, after := list(range(1, len(data) + 1)))
        for i, place in zip(todo, firsts):
            while token[place] >= 0:
                out[i].append(token[place])
                place = after[place]
        return out

    def _merge(self, data: bytes, token: list[int], rank: list[int], after: list[int]) -> None:
        before = list(range(-1, len(data) - 1))
        rank_of, push, least, take = self.ids.get, self.queue.push, self.queue.least, self.queue.take
        for place, found in enumerate(rank):
            if found >= 0:
                push(found, place)
        while (now := least()) is not None:
            places, lower = take(now), False
            for k, place in enumerate(places):
                if rank[place] != now:
                    continue  # stale: one of the two tokens has been merged since
                token[place] = now
                gone = after[place]
                end = after[place] = after[gone]
                before[end] = place
                rank[gone] = rank[place] = NEVER
                # a token never gets back a rank that it had, as its bytes have grown
                if token[end] >= 0:
                    found = rank_of(data[place : after[end]])
                    if found is not None:
                        rank[place] = found
                        push(found, place)
                        lower = found < now
                left = before[place]
                if token[left] >= 0:
                    found = rank_of(data[left:end])
                    if found is None:
                        rank[left] = NEVER
                    else:
                        rank[left] = found
                        push(found, left)
                        lower |= found < now
                if lower:  # the rest waits for the rank that comes first now
                    for waiting in places[k + 1 :]:
                        push(now, waiting)
                    break


class Known(dict):
    """Packed ids of the pieces met lately, in two halves, so that frequent ones are never forgotten."""

    def __init__(self, ranks: Ranks):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Learns these pieces and returns those that are too long to be remembered."""
        new = [p for p in pieces if p not in self]
        self.update([(p, self.older[p]) for p in new if p in self.older])
        new = [p for p in new if p not in self]
        made = zip(new, map(pack, self.ranks.merge([p.encode() for p in new])))
        long = {}
        for piece, packed in made:
            (self if len(piece) <= LONGEST_KNOWN else long)[piece] = packed
        return long

    def forget(self) -> None:
        if len(self) >= KNOWN_PIECES:
            self.older = dict(self)
            self.clear()


def pack(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return b"".join([i.to_bytes(4, "little") for i in ids])


def unpack(packed: bytes) -> list[int]:
    return [int.from_bytes(packed[at : at + 4], "little") for at in range(0, len(packed), 4)]


class Tokenizer:
    def __init__(self, name: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN):
        self.ranks = Ranks(name)
        self.known = Known(self.ranks)
        self.pieces = regex.compile(pattern).findall
        self.cut = regex.compile(r"(?<=\S)(?=\s)").search

    def slices(self, text: str) -> Iterator[str]:
        """Stretches that the pattern cuts as it cuts the whole text."""
        at = 0
        while len(text) - at > SLICE:
            found = self.cut(text, at + SLICE)
            end = found.start() if found else len(text)
            yield text[at:end]
            at = end
        yield text[at:] if at else text

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Packed ids of each text. A text of many slices goes through several groups."""
        group: list[tuple[bool, list[str]]] = []  # pieces of a slice, and whether its text ends there
        size, parts = 0, []
        for text in texts:
            slices = self.slices(text)
            part = next(slices)
            while part is not None:
                after = next(slices, None)
                group.append((after is None, self.pieces(part)))
                size, part = size + len(part), after
                if size >= GROUP:
                    yield from self._joined(group, parts)
                    group, size = [], 0
        yield from self._joined(group, parts)

    def _joined(self, group: list[tuple[bool, list[str]]], parts: list[bytes]) -> Iterator[bytes]:
        """``parts`` are what came before of the text that the group begins with."""
        known = self.known
        long = known.pieces(set().union(*(pieces for _, pieces in group)))
        one = known.__getitem__ if not long else lambda p: known.get(p) or long[p]
        for ends, pieces in group:
            parts.append(b"".join(map(one, pieces)))
            if ends:
                yield b"".join(parts)
                parts.clear()
        known.forget()

    def decode(self, packed: bytes) -> bytes:
        ids = array("I")
        if ids.itemsize == 4 and pack([1]) == array("I", [1]).tobytes():
            ids.frombytes(packed)
        else:
            ids = unpack(packed)
        return b"".join(map(self.ranks.bytes.__getitem__, ids))


def tokenizer_of(name: str) -> Tokenizer:
    """One for all tasks of a worker."""
    return held(("rankbpe", name), lambda: Tokenizer(name))


def encode(df: DataFrame, text: str = "text", name: str = VOCABULARY, decode: bool = False) -> DataFrame:
    """The columns of ``df`` and ``tokens``: the ids of each whole text, four little-endian bytes each.

    With ``decode`` also ``decoded``, the bytes that these ids stand for. A null or empty text has
    no tokens: both are empty, never null. Nulls in other columns, repeated rows and ties stay as
    they are; an empty table stays empty. Columns named ``tokens`` or ``decoded`` are replaced.
    """
    made = ["tokens", "decoded"][: 2 if decode else 1]
    kept = [c for c in df.columns if c not in ("tokens", "decoded") or c == text]
    others = [c for c in kept if c not in made]
    # the text moves to Python once, inside its row
    row, at = df.select(F.struct(*kept).alias("_row")), kept.index(text)
    schema = T.StructType([T.StructField("_row", row.schema["_row"].dataType)])
    for c in made:
        schema.add("_" + c, T.BinaryType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(name)
        for batch in batches:
            texts = batch[0].field(at)
            first, size, columns = 0, 0, [[] for _ in made]
            for i, ids in enumerate(tokenizer.encode(one.as_py() or "" for one in texts)):
                columns[0].append(ids)
                if decode:
                    columns[1].append(tokenizer.decode(ids))
                size += len(ids)
                if size > BATCH_BYTES or i == len(texts) - 1:
                    out = [batch[0].slice(first, i + 1 - first)]
                    out += [pa.array(c, pa.binary()) for c in columns]
                    yield pa.record_batch(out, names=schema.names)
                    first, size, columns = i + 1, 0, [[] for _ in made]

    found = row.mapInArrow(work, schema)
    return found.select(
        *[F.col("_row").getField(c).alias(c) for c in others], *[F.col("_" + c).alias(c) for c in made]
    )


def decode(df: DataFrame, tokens: str = "tokens", name: str = VOCABULARY) -> DataFrame:
    """The columns of ``df`` and ``decoded``, the bytes of packed ids; null stays null.

    Repeated rows stay, an empty table stays empty, a column named ``decoded`` is replaced. An id
    that the vocabulary lacks is an error.
    """
    kept = [c for c in df.columns if c != "decoded"]
    row, at = df.select(F.struct(*kept).alias("_row")), kept.index(tokens)
    schema = T.StructType([T.StructField("_row", row.schema["_row"].dataType)]).add("decoded", T.BinaryType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(name)
        for batch in batches:
            ids = [one.as_py() for one in batch[0].field(at)]
            found = [None if i is None else tokenizer.decode(i) for i in ids]
            yield pa.record_batch([batch[0], pa.array(found, pa.binary())], names=schema.names)

    return row.mapInArrow(work, schema).select("_row.*", "decoded")
