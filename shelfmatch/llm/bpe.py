"""Byte-level BPE as a streaming transducer, and decoding with a byte-to-text state machine.

Merging by rank gives the same tokens as reading left to right and keeping, for each prefix, the
one last token that merging would end it with: the longest token that ends there and may follow the
last token of the prefix before it. Two tokens may stand side by side if undoing their merges, the
later first, meets no merge across their border that would have come before. A token is stable as
soon as all prefixes that reads to come can still build on agree on it; no token is longer than the
vocabulary's longest, so those are the prefixes of the last so many bytes. What is kept in memory is
the unstable rest.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .worker import held

VOCABULARY = "byte_bpe_50k.json"
KNOWN_PIECES = 250_000  # pieces of text that a worker remembers with their tokens, twice
STEP = 1 << 12  # bytes that the transducer reads at a time
LONGEST_KNOWN = 64  # characters of a piece that is worth remembering
# fixed value: the public pattern that cuts text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter by which the vocabulary file writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    def __init__(self, name: str = VOCABULARY):
        with open(public_tokenizers.path(name), encoding="utf-8") as f:
            file = json.load(f)
        letter = byte_letters()
        raw = lambda token: bytes(letter[c] for c in token)
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.ids = {raw(t): i for t, i in file["model"]["vocab"].items() if t not in self.special}
        self.bytes = {i: t for t, i in self.ids.items()}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.decimal = {i: str(i) for i in self.bytes}
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], int] = {}  # of a merge, by its two parts
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: its two parts and its rank
        for rank, pair in enumerate(file["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = raw(a), raw(b)
            left, right, made = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank[left, right] = rank
            self.parts.setdefault(made, (left, right, rank))
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.lookahead = self.longest - 1  # bytes beyond a prefix that can still change its tokens
        special = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut_special = regex.compile(f"({special})") if special else None
        self.beside: dict[tuple[int, int], bool] = {}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging would leave these two tokens side by side."""
        known = self.beside.get((left, right))
        if known is None:
            if len(self.beside) > 1_000_000:
                self.beside.clear()
            known = self.beside[left, right] = self._undo(left, right)
        return known

    def _undo(self, left: int, right: int) -> bool:
        """Undo the later merge of the two, until both are single bytes.

        A merge across the border that comes before the one undone last would have been made
        instead. Of equal ranks the left one comes first.
        """
        none = len(self.rank)
        limit = (none, 0)
        while True:
            across = self.rank.get((left, right))
            if across is not None and (across, 1) < limit:
                return False
            a = self.parts.get(left, (0, 0, -1))
            b = self.parts.get(right, (0, 0, -1))
            if a[2] < 0 and b[2] < 0:
                return True
            if a[2] > b[2]:
                limit, left = (a[2], 1), a[1]
            else:
                limit, right = (b[2], 2), b[0]


@lru_cache(2)
def vocabulary(name: str = VOCABULARY) -> Vocabulary:
    return Vocabulary(name)


class Encoder:
    """Feed bytes, get tokens once they are stable; ``finish`` gives the rest."""

    __slots__ = ("vocab", "scan", "given", "last", "before")

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.scan = None
        self.given = 0  # bytes whose tokens were given out
        self.last: list[tuple[int, int]] = []  # for each byte since: last token and its length
        self.before: int | None = None  # the last token given out

    def feed(self, data: bytes) -> list[int]:
        """The automaton tells the tokens that end at each byte, longest first."""
        text = data.decode("latin-1")
        if self.scan is None:
            self.scan = self.vocab.automaton.iter(text)
        else:
            self.scan.set(text)
        last, given, n = self.last, self.given, len(self.last)
        beside, may_follow = self.vocab.beside.get, self.vocab.may_follow
        for end, (token, length) in self.scan:
            if end - given < n:
                continue  # a longer token has been found to end here
            start = n - length
            if start >= 0:
                left = last[start][0]
            elif start == -1:
                left = self.before
            else:
                continue  # reaches into what is stable
            if left is not None:
                fits = beside((left, token))
                if not (may_follow(left, token) if fits is None else fits):
                    continue
            last.append((token, length))
            n += 1
        return self._stable() if n > 2 * self.vocab.lookahead else []

    def _path(self, end: int) -> list[int]:
        """Ends of the tokens of a prefix, last first."""
        ends, last = [], self.last
        while end:
            ends.append(end)
            end -= last[end - 1][1]
        return ends

    def _stable(self) -> list[int]:
        """Give out what all prefixes that can be built on share."""
        n = len(self.last)
        shared = set(self._path(n))
        for end in range(max(1, n - self.vocab.lookahead), n):
            shared &= set(self._path(end))
        return self._give(max(shared, default=0))

    def _give(self, end: int) -> list[int]:
        out = [self.last[e - 1][0] for e in reversed(self._path(end))]
        if out:
            self.before, self.last, self.given = out[-1], self.last[end:], self.given + end
        return out

    def finish(self) -> list[int]:
        out, last, end = [], self.last, len(self.last)
        while end:
            token, length = last[end - 1]
            out.append(token)
            end -= length
        out.reverse()
        return out


class Known(dict):
    """Tokens of the pieces met lately, in two halves, so that frequent pieces are never forgotten."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab, self.older = vocab, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(piece) > LONGEST_KNOWN:
            return self.encode(piece)
        if len(self) >= KNOWN_PIECES:
            self.older = dict(self)
            self.clear()
        found = self[piece] = self.older.get(piece) or self.encode(piece)
        return found

    def encode(self, piece: str) -> tuple[int, ...]:
        encoder, data = Encoder(self.vocab), piece.encode()
        out = []
        for at in range(0, len(data), STEP):
            out += encoder.feed(data[at : at + STEP])
        return (*out, *encoder.finish())


class Tokenizer:
    """Whole texts through the transducer, piece by piece."""

    def __init__(self, name: str = VOCABULARY):
        self.vocab = vocabulary(name)
        self.known = Known(self.vocab)
        self.pieces = regex.compile(PATTERN).findall

    def encode(self, text: str) -> list[int]:
        if self.vocab.cut_special and "<|" in text:
            parts = self.vocab.cut_special.split(text)
        else:
            parts = [text]
        out: list[int] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.vocab.special[part])
            else:
                out += chain.from_iterable(map(self.known.__getitem__, self.pieces(part)))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Bytes that are no UTF-8 become replacement characters, as they come."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        ids, out, step = list(ids), [], 1 << 16
        for at in range(0, len(ids), step):
            out.append(state.decode(b"".join(map(self.vocab.bytes.__getitem__, ids[at : at + step]))))
        out.append(state.decode(b"", True))
        return "".join(out)


def tokenizer_of(name: str) -> Tokenizer:
    """One for all tasks of a worker."""
    return held(("bpe", name), lambda: Tokenizer(name))


def encode(df: DataFrame, text: str = "text", name: str = VOCABULARY, digests: bool = False) -> DataFrame:
    """The columns of ``df`` and a struct ``tokens``: ids and the decoded text.

    Null text counts as empty and has no tokens. With ``digests`` the struct holds n_tokens, ids_sha256 (of the decimal ids
    joined by commas) and decoded_sha256 in their place. A column named ``tokens`` of the input is
    replaced.
    """
    kept = [c for c in df.columns if c != "tokens"]
    # the text moves to Python once, inside its row
    row, at = df.select(F.struct(*kept).alias("_row")), kept.index(text)
    if digests:
        out = T._parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string")
    else:
        out = T._parse_datatype_string("ids array<int>, decoded string")
    schema = T.StructType(
        [
            T.StructField("_row", T.StructType([f for f in df.schema if f.name in kept])),
            T.StructField("tokens", out),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(name)
        for batch in batches:
            found = [_answer(tokenizer, t.as_py() or "", digests) for t in batch[0].field(at)]
            columns = list(zip(*found)) or [[] for _ in out]
            kinds = [pa.int64(), pa.string(), pa.string()] if digests else [pa.list_(pa.int32()), pa.string()]
            answer = pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=out.names
            )
            yield pa.record_batch([batch[0], answer], names=["_row", "tokens"])

    return row.mapInArrow(work, schema).select("_row.*", "tokens")


def _answer(tokenizer: Tokenizer, text: str, digests: bool) -> tuple:
    ids = tokenizer.encode(text)
    decoded = tokenizer.decode(ids)
    if not digests:
        return ids, decoded
    joined = ",".join(map(tokenizer.vocab.decimal.__getitem__, ids)).encode()
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
