"""Rank-queue BPE against the library, on odd rows, and its query."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from shelfmatch.llm import queries, rankbpe

ODD = [None, "", " ", "\n\n", "a", "a" * 9000, "é à 漢字 🙂 " * 40, "\x1c\x85　x", "<|endoftext|>", "THE'S it's"]


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(rankbpe.VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_queue_gives_the_least_rank_and_its_places_in_order():
    rng, queue, held = random.Random(1), rankbpe.RankQueue(100_000), []
    for step in range(6000):
        if held and (rng.random() < 0.3 or step > 5000):
            rank = queue.least()
            assert rank == min(held)[0] and queue.take(rank) == sorted(p for r, p in held if r == rank)
            held = [h for h in held if h[0] != rank]
        elif step < 5000:
            held.append((rng.choice([3, 255, 256, 65_535, 65_536, 99_999, rng.randrange(100_000)]), rng.randrange(50)))
            queue.push(*held[-1])
    assert not held and queue.least() is None and rankbpe.RankQueue(1).least() is None


def test_a_lower_rank_that_a_merge_makes_comes_first():
    ranks = rankbpe.Ranks.__new__(rankbpe.Ranks)
    tokens = [bytes([b]) for b in range(256)] + [b"xab", b"ab", b"abx"]
    ranks.ids = {t: i for i, t in enumerate(tokens)}
    ranks.prepare()
    own = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks.ids, special_tokens={})
    rng = random.Random(3)
    texts = ["".join(rng.choice("abx") for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["abxabxab"]
    assert ranks.merge([t.encode() for t in texts]) == [own.encode_ordinary(t) for t in texts]


def test_merges_equal_the_library(library, monkeypatch):
    own, rng = rankbpe.Tokenizer(), random.Random(2)
    letters = "aethsin   THE'sll\n\t éñ漢🙂0123.,!<|endoftext|>́\x1c\x1d\x85　\xa0\0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(map(chr, (rng.randrange(0x20, 0xD000) for _ in range(4000))))]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(3000)), "ab" * 30_000]
    texts += [t or "" for t in ODD]
    for cut, group in ((40, 100), (40, 1 << 19), (rankbpe.SLICE, rankbpe.GROUP)):
        monkeypatch.setattr(rankbpe, "SLICE", cut)
        monkeypatch.setattr(rankbpe, "GROUP", group)
        got = list(own.encode(texts))
        assert len(got) == len(texts)
        for text, packed in zip(texts, got):
            ids = library.encode_ordinary(text)
            assert rankbpe.unpack(packed) == ids
            assert own.decode(packed) == library.decode_bytes(ids) == text.encode()


def test_pieces_forgotten_are_merged_again(library, monkeypatch):
    monkeypatch.setattr(rankbpe, "KNOWN_PIECES", 7)
    monkeypatch.setattr(rankbpe, "GROUP", 1)
    own, texts = rankbpe.Tokenizer(), ["one two three four five six seven eight nine one two", "one ten two eleven"] * 2
    assert [rankbpe.unpack(p) for p in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    assert len(own.known) < 7 + 9


def test_tables(spark, library, monkeypatch):
    monkeypatch.setattr(rankbpe, "BATCH_BYTES", 100)
    rows = [(i % 7 or None, t, None, "x") for i, t in enumerate(ODD * 3)]
    df = spark.createDataFrame(rows, "id int, text string, _row string, tokens string").repartition(3)
    got = rankbpe.encode(df, decode=True)
    assert got.columns == ["id", "text", "_row", "tokens", "decoded"]
    got = got.collect()
    assert sorted((r.id or 0, r.text or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in rows)
    for r in got:
        assert rankbpe.unpack(r.tokens) == library.encode_ordinary(r.text or "")
        assert r.decoded == (r.text or "").encode()
    again = rankbpe.decode(rankbpe.encode(df).withColumn("decoded", rankbpe.F.lit(1)))
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in again.collect())
    none = spark.createDataFrame([(None,)], "tokens binary")
    assert rankbpe.decode(none).first().decoded is None
    assert rankbpe.encode(df.limit(0)).count() == rankbpe.decode(none.limit(0)).count() == 0
    named = rankbpe.encode(df.select(rankbpe.F.col("text").alias("tokens")), "tokens")  # the text itself replaced
    assert named.columns == ["tokens"] and sorted(map(bytes, (r.tokens for r in named.collect()))) == sorted(
        bytes(r.tokens) for r in got
    )


def test_query(spark, data, library):
    got = {r.doc_id: r for r in queries.op13_byte_bpe(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
        assert tuple(got[r.doc_id])[1:] == want
