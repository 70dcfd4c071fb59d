"""The whole pipeline against a brute-force version of its stages."""

import collections
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from shelfmatch.llm import langid, packing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sure_of_a_language(texts, sample, model):
    """Which texts are likely enough for their length, by plain sums over the pieces."""
    languages, table = model
    pieces, known = langid.vocabulary(), {}
    stranger = np.full(len(languages), langid.STRANGER)

    def log_likelihood(word):
        text, sums = langid.WORD_START + word, [np.ones(len(languages))]
        for end in range(1, len(text) + 1):
            total = np.zeros(len(languages))
            for start in range(end):
                piece = pieces.get(text[start:end])
                if piece is not None:
                    total += sums[start] * table[piece]
                elif start == end - 1:
                    total += sums[start] * stranger
            sums.append(total)
        return np.log(sums[-1])

    def told(text):
        """The likeliest language, the log-likelihood in it and the characters."""
        scores, found = np.zeros(len(languages)), langid.words_of(text)
        for word, n in found.items():
            if word not in known:
                known[word] = log_likelihood(word)
            scores += n * known[word]
        best = int(scores.argmax())
        return languages[best], scores[best], sum((1 + len(w)) * n for w, n in found.items())

    ratios = collections.defaultdict(list)
    for lang, text in sample:
        found, score, n = told(text)
        if found == lang and n:
            ratios[lang].append(score / n)
    sure = set()
    for i, text in texts.items():
        found, score, n = told(text)
        if n and score >= langid.FLOOR * np.median(ratios[found]) * n:
            sure.add(i)
    return sure


def first_of_similar(texts):
    """The ids that no chain of similar documents ties to a smaller one."""
    sets = {}
    for i, text in texts.items():
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text)]
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        sets[i] = grams or ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * min(len(sets[a]), len(sets[b])) >= 80 * max(len(sets[a]), len(sets[b])):
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i for i in sets if find(i) == i}


def without_repeats(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        words = WORD.findall(texts[i])
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        if not words or not all(gone):
            out[i] = " ".join(w for w, g in zip(words, gone) if not g) if any(gone) else texts[i]
    return out


def test_pipeline_equals_brute_force(spark, data, tmp_path):
    given = queries.read_table(spark, data, "documents")
    odd = [(9000, "12 ! 34", None, "s", 7), (9001, None, None, "s", None), (9002, "\n \u3000", "en", "s", 3)]
    odd += [(9003, "qxzj wvkq xjzq pqzv kxqj zzvq hjqx wqxz vjqk", None, "s", None)]
    folder = str(tmp_path)
    given.union(spark.createDataFrame(odd, given.schema)).write.parquet(f"{folder}/documents.parquet")
    docs = queries.read_table(spark, folder, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    sample = langid.labelled_sample(docs)
    sure = sure_of_a_language(texts, [tuple(r) for r in sample.collect()], langid.learn_sample(sample))
    assert not sure & {9000, 9001, 9002, 9003}
    first = first_of_similar({i: texts[i] for i in sure})
    assert 0 < len(first) < len(sure) < len(texts)
    left = without_repeats({i: texts[i] for i in first})
    assert any(left.get(i) != texts[i] for i in first)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, text in left.items():
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [packing.END], "<u4")
        for at in range(0, len(ids), packing.CAPACITY):
            piece = ids[at : at + packing.CAPACITY]
            want.add((i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    got = pipeline.run(spark, folder).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got} == want
    assert len(got) == len(want)
    used = collections.defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert len(used) <= 1.1 * math.ceil(sum(r.length for r in got) / packing.CAPACITY) + 1


def test_pipeline_on_odd_tables(spark, tmp_path):
    """No rows, and nothing but nulls, empty texts and equal rows."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row int, key string"
    odd = [(None, None, None, None, None, 1, "k"), (1, None, "en", "s", 0, 2, "k"), (2, "", "en", "s", 0, 3, "k")]
    text = "the house on the hill is old and the garden behind it is older than the road"
    odd += [(3, text, "en", "s", len(text), 4, "k")] * 2 + [(4, text, None, None, None, 5, None)]
    odd += [(None, text, "en", "s", None, 6, None), (5, "x" * 50_000, "en", "s", None, 7, None)]
    for name, rows in (("none", []), ("odd", odd)):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        got = pipeline.run(spark, folder).collect()
        ids = {r.doc_id for r in got}
        assert 4 not in ids and (name == "none" or {None, 3} <= ids) and (rows or not got)


def test_languages_are_learnt_from_all_labelled_documents(spark, monkeypatch):
    learnt, seen = langid.learn_sample, []
    monkeypatch.setattr(langid, "learn_sample", lambda rows: seen.append(rows.count()) or learnt(rows))
    docs = [(i, f"of the sea and number {'abcdefgh'[i % 8]}", "en", "s", 9) for i in range(2 * langid.ROWS_PER_LANGUAGE)]
    docs += [docs[0], (None, "der see und das land", "de", "s", 9), (9001, "of the sea", None, "s", 9), (9002, None, "en", "s", 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.identify_language(spark, df, "")
    assert seen == [2 * langid.ROWS_PER_LANGUAGE + 1]
    assert got.count() == len(docs) - 1 and got.columns == df.columns


def test_words_counted_in_several_goes(monkeypatch):
    monkeypatch.setattr(langid, "COUNTED_WORDS", 3)
    batch = pa.record_batch([pa.array(["x", "y", "x"]), pa.array(["a b a", "b c", None])], names=["lang", "text"])
    total = collections.Counter()
    for made in langid._word_counts(iter([batch, batch])):
        for lang, word, n in zip(*(c.to_pylist() for c in made.columns)):
            total[lang, word] += n
    assert total == {("x", "a"): 4, ("x", "b"): 2, ("y", "b"): 2, ("y", "c"): 2}
