"""Runs against brute force, on odd rows, and the query against its contract."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from shelfmatch.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(words, least=24, periods=3):
    """Stretches of agreement at each distance; of one stretch the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, periods * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng):
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(0, 120))]
    for _ in range(rng.randint(0, 4) if words else 0):
        a, p = rng.randrange(len(words)), rng.randint(1, 30)
        for i in range(a, min(len(words), a + rng.randint(0, 100))):
            words[i] = words[a + (i - a) % p]
        if rng.random() < 0.5:
            words += words[: rng.randrange(len(words) + 1)]
    return words


@pytest.mark.parametrize("least,periods", [(24, 3), (2, 2), (6, 2), (5, 3), (9, 4)])
def test_runs_equal_brute_force(least, periods):
    rng = random.Random(least)
    texts = [some_words(rng) for _ in range(300)] + [[], [1], [1] * 200, [1, 2] * 50]
    a, b = [0], [0, 1]
    for _ in range(9):  # a word with as many runs as a text can have
        a, b = b, b + a
    texts += [b, b, [7] + b]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    hashes = np.array([w for t in texts for w in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    got = periodic.runs_of_texts(hashes, first, least, periods)
    want = [brute_force(t, least, periods) for t in texts]
    assert got == want and sum(map(len, want)) > 50


def test_small_batches_find_the_same(monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_WORDS", 7)  # of suffixes tested together
    test_runs_equal_brute_force(5, 3)


def test_suffix_array_and_intervals():
    rng = random.Random(2)
    words = [rng.randrange(2) for _ in range(200)]
    symbols, n = np.array(words, np.int64), len(words)
    levels = periodic.suffix_ranks(symbols, np.full(n, n))
    suffix = np.argsort(levels[-1])
    assert suffix.tolist() == sorted(range(n), key=lambda i: words[i:])
    lcp = np.append([0], periodic.shared_words(levels, suffix[:-1], suffix[1:]))
    for k in range(1, n):
        a, b = words[suffix[k - 1] :], words[suffix[k] :]
        assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    first, last = periodic.intervals(lcp)
    for k in range(1, n):
        assert last[k] == next((j for j in range(k + 1, n) if lcp[j] < lcp[k]), n)
        assert first[k] == next((j for j in range(k - 1, 0, -1) if lcp[j] <= lcp[k]), 0)


def test_long_texts():
    words = ["| " * 30_000, "a b c " * 9000, " ".join(str(i % 5000) for i in range(20_000)), "x" * 100_000]
    found = periodic.split_words(periodic.pa.array(words))
    assert periodic.runs_of_texts(found.hashes(), found.first) == [
        [(0, 30_000, 1)], [(0, 27_000, 3)], [(0, 20_000, 5000)], [],
    ]


def test_tables(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{w}" for w in some_words(rng)) for _ in range(60)]
    texts += [None, "", " \t\n", "é 漢 🙂\n" * 20, "one\x0btwo\x1c " * 30, "a" * 5000]
    rows = [(i % 9 or None, t, "x", None) for i, t in enumerate(texts + texts[:20])]
    df = spark.createDataFrame(rows, "id int, text string, periodic string, _row string").repartition(3)
    got = periodic.find_runs(df)
    assert got.columns == ["id", "text", "_row", "periodic"]
    got = got.collect()
    assert sorted((r.id or 0, r.text or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in rows)
    for r in got:
        words = WORD.findall(r.text or "")
        runs = brute_force(words)
        assert r.periodic.n_words == len(words) and [tuple(x) for x in r.periodic.runs] == runs
        assert r.periodic.collapsed == collapsed(words, runs)
    assert any(r.periodic.runs for r in got) and periodic.find_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(df, periods=1)


def test_query(spark, data):
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    assert len(got) == len(docs)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in docs:
        words = WORD.findall(r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute_force(words)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert tuple(got[r.doc_id])[1:] == (
            len(runs), *best, best[1] and 1000 * best[1] // best[2],
            digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(collapsed(words, runs)),
        )
    assert sum(r.n_runs for r in got.values()) > 10


def test_periodic_ends_of_odd_rows(spark):
    keys = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    rows = [(keys[0], None, 1), (keys[1], "", 2), (keys[2], " \n", 3), (keys[3], "one", 4), (None, "a b", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _h int")
    got = sorted((r.text is None, r.text) for r in periodic.with_periodic_ends(df).collect())
    assert got == sorted((t is None, t) for _, t, _ in rows)
