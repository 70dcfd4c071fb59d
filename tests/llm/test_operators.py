"""The operators on small tables, against brute force, and on odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmatch.llm import bpe, chat, forest, html, jaccard, langid, packing, sharding, simhash
from shelfmatch.llm import queries, substrings
from shelfmatch.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row int, _block string"


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, passages, ties, nulls, empty and very long texts."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "|"] * 30
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = make(60), make(200).split(" ")
    out = [make(rng.randint(0, 150)) for _ in range(60)]
    out += [f"{make(30)}\n{passage}\t{make(20)}" for _ in range(15)]
    for _ in range(90):  # a family of near copies, some of which link and some do not
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        out.append(" ".join(copy))
    out += [out[-1]] * 20 + ["a b c", "A b  c", "a b", "", " \n", None, None, "| " * 300, "x" * 5000]
    return out + [make(9000), "é à 漢字 🙂 " * 8]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(7 * i % 1000, t, None, "s", None, i, "b") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_substrings_equal_brute_force(docs):
    rows = sorted(docs.select("doc_id", "text").collect())
    got, seen = by_id(substrings.remove_repeats(docs)), set()
    assert any(r.repeats.n_removed for r in got.values())
    for r in rows:
        words = WORD.findall(r.text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        assert tuple(got[r.doc_id].repeats) == (len(words), sum(gone), kept)
        assert got[r.doc_id]._row is not None and got[r.doc_id]._block == "b"


def test_substrings_in_blocks_of_few_words(spark):
    words = [f"w{i}" for i in range(21)]
    rows = [(n, " ".join(words[:n])) for n in range(22)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = by_id(substrings.remove_repeats(docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert len(got) == 22
    for n, text in rows:  # the 20 words of row 20 begin row 21 as well
        kept = "w20" if n == 21 else text
        assert tuple(got[n].repeats) == (n, 20 if n == 21 else 0, kept)


@pytest.mark.parametrize("frequent", [6, 2])
def test_jaccard_components_equal_brute_force(docs, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "CELL_ROWS", 16)
    sets = {}
    for r in docs.collect():
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(r.text or "")]
        grams = {tuple(words[i : i + 4]) for i in range(len(words) - 3)}
        sets[r.doc_id] = grams or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = by_id(jaccard.link_similar(docs))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {
        i: (len(s), find(i)) for i, s in sets.items()
    }


def test_index_keys_meet_for_all_similar_sets():
    rng = np.random.default_rng(3)
    for _ in range(200):
        size = int(rng.integers(1, 200))
        common_of = {g: int(c) for g, c in enumerate(rng.integers(1, 9, 500))}
        a = rng.choice(500, size, replace=False)
        drop = int(rng.integers(0, size // 7 + 1))
        b = np.concatenate([a[drop:], rng.choice(np.arange(500, 900), int(rng.integers(0, 3)))])
        b = np.unique(b)
        common_of |= {g: 1 for g in range(500, 900)}
        if 100 * len(np.intersect1d(a, b)) < 85 * len(np.union1d(a, b)):
            continue
        keys = []
        for s in (a, b):
            s = np.array(sorted(s.tolist(), key=lambda g: (common_of[g], g)), np.uint64)
            keys.append(jaccard.index_keys(s, np.array([common_of[int(g)] for g in s], np.uint8)))
        assert len(np.intersect1d(*keys))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 150)] + [(5, 5), (None, 3), (3, None)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 150)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bpe_equals_the_library(docs, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng, own = random.Random(2), bpe.Tokenizer()
    letters = "aethsin   THE'sll\n\t éñ漢🙂0123.,!<|endoftext|>́\x1c\x85　"
    odd = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(500)]
    odd += ["".join(rng.choice("abcdefgh") for _ in range(3000)), "a" * 2000, "<|endoftext|>x"]
    for t in [t or "" for t in texts] + odd:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    got = by_id(bpe.encode(docs, digests=True))
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text))
        assert tuple(got[r.doc_id].tokens) == (len(ids), *digests)


def test_bpe_emits_before_the_end_and_keeps_little():
    encoder, out = bpe.Encoder(bpe.vocabulary()), []
    data = b"thenationalinformation" * 2000
    for at in range(0, len(data), 500):
        out += encoder.feed(data[at : at + 500])
        assert len(encoder.last) < 2 * bpe.vocabulary().lookahead + 500
    assert b"".join(bpe.vocabulary().bytes[i] for i in out + encoder.finish()) == data


def test_packing(docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.token_pieces(docs, with_ids=True)
    rows = packing.pack(pieces, ["doc_id", "start"], group_rows=50).collect()
    found, used = collections.defaultdict(dict), collections.defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
        found[r.doc_id][r.start] = r.ids
        used[r.sequence_id].append((r.offset, r.length))
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [packing.END]
        assert sum((found[r.doc_id][s] for s in sorted(found[r.doc_id])), []) == ids
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    with pytest.raises(ValueError):
        packing.best_fit_decreasing([5], 4)


@pytest.mark.parametrize("name", ["", "<|"])
def test_ids_of_odd_words(name, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 300)
    library = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    rng, words = random.Random(4), packing.KnownWords(packing.VOCABULARY)
    letters = "aBİIe.,,. \n\té\u0301\u0307\u0338漢🙂0'sKÅ" + name
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += ["", None, ".", ",", "a.", "A. B.", "a.\n", "x" * 5000, "I\u0307.", "E\u0301,"]
    texts += ["<|ENDOFTEXT|> A", "x<|endoftext|>A", "<|endoftext|>"] if name else ["<", "|"]
    for part in (texts, texts[5:9], [None, ""], []):
        array = packing.pa.array([None, *part], packing.pa.string()).slice(1)
        ids, bounds = words.texts(array)
        for i, text in enumerate(part):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_remembered_words_are_bounded(monkeypatch):
    calls = []
    monkeypatch.setattr(packing, "ENCODED_WORDS", 50)
    few, many = packing.KnownWords(packing.VOCABULARY, 100), packing.KnownWords(packing.VOCABULARY)

    class Counted:
        def encode_batch_fast(self, words, **options):
            calls.append(len(words))
            return many.tokenizer.encode_batch_fast(words, **options)

    few.tokenizer = Counted()
    for part in range(5):
        array = packing.pa.array([f"word{part * 300 + i} again{i}" for i in range(400)])
        for one, other in zip(few.texts(array), many.texts(array)):
            assert one.tolist() == other.tolist()
        assert len(few) <= 100
    assert max(calls) <= 50


def test_packing_of_odd_rows(spark):
    rows = [(None, "one two"), (None, "one two"), (3, None), (3, ""), (4, "a " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("offset", F.lit("x"))
    pieces = packing.token_pieces(df).withColumn("sequence_id", F.lit("y"))
    got = packing.pack(pieces, ["doc_id", "start"]).collect()
    assert sorted((r.doc_id or 0, r.start, r.length) for r in got) == [
        (0, 0, 3), (0, 0, 3), (3, 0, 1), (3, 0, 1), (4, 0, 4096), (4, 4096, 4096), (4, 8192, 809),
    ]
    assert all(isinstance(r.sequence_id, int) and isinstance(r.offset, int) for r in got)


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(1)
    lengths = [rng.randint(1, 40) for _ in range(300)]
    window, offset = packing.best_fit_decreasing(lengths, 40)
    room, want = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in room if r >= lengths[i]]
        want[i] = 40 - min(fits) if fits else 0
        if fits:
            room.remove(min(fits))
        room.append((min(fits) if fits else 40) - lengths[i])
    assert sorted(offset) == sorted(want) and max(window) + 1 == len(room)


def test_sharding(spark, docs):
    rows = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("size"))
    rows = rows.unionByName(rows.limit(5)).unionByName(spark.createDataFrame([(None, 3)] * 4, rows.schema))
    got = sharding.assign(rows, "doc_id", 8).collect()
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(8)]
    assert sum(sizes) == rows.count() and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(rows.limit(0), "doc_id", 8).count() == 0
    counts = [i % 3 for i in range(sharding.PLACES)]  # brute force: key by key
    owner, room = sharding.ring(8), [sum(counts) // 8 + (s < sum(counts) % 8) for s in range(8)]
    want = []
    for place, n in enumerate(counts):
        for rank in range(n):
            at = place
            while not room[owner[at % len(owner)]]:
                at += 1
            room[owner[at % len(owner)]] -= 1
            want.append((place, rank, owner[at % len(owner)]))
    parts = sharding.clockwise(counts, 8)
    assert [(p, r, s) for p, a, b, s, _ in parts for r in range(a, b)] == want


def test_simhash(docs):
    rows = sorted(docs.select("doc_id", "text").collect(), reverse=True)
    got = by_id(simhash.compare_neighbours(docs))
    assert len(got) == len(rows)
    seen = {}
    for r, after in zip(rows, rows[1:] + rows[:1]):
        text, n = r.text or "", len(r.text or "") // 3
        changed = text[: len(text) - n] + (after.text or "")[:n]
        assert got[r.doc_id].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert got[r.doc_id].n_chars == len(text)
        assert seen.setdefault(text, got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint
    prints = simhash.compare_neighbours(docs)
    near = {r.fingerprint: r.n_near for r in simhash.near_counts(prints, prints).collect()}
    number = [int(r.fingerprint, 16) for r in got.values()]
    for r in got.values():
        want = sum((int(r.fingerprint, 16) ^ n).bit_count() <= simhash.RADIUS for n in number)
        assert near[r.fingerprint] == want


def test_simhash_finds_similar_texts(spark):
    """Texts with a few words changed, against the similarity of their sets of five-word shingles."""
    rng = random.Random(11)
    make = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts = []
    for _ in range(25):
        base = make(rng.randint(150, 400))
        for changes in (0, 1, 2, 3, 5):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = "other"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate([*texts, "", None])), "doc_id long, text string")
    prints = simhash.compare_neighbours(docs)
    near = {r.fingerprint: r.n_near for r in simhash.near_counts(prints, prints).collect()}
    rows = by_id(prints)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split(" ") for t in texts)]
    wanted = found = 0
    for i, a in enumerate(sets):
        like = [len(a & b) / len(a | b) for b in sets]
        wanted += sum(x >= simhash.SIMILARITY for x in like)
        got = near[rows[i].fingerprint]
        assert got <= sum(x >= 0.5 for x in like)
        found += min(got, sum(x >= simhash.SIMILARITY for x in like))
    assert wanted > 300 and found >= 0.97 * wanted
    assert near[rows[len(texts)].fingerprint] == 2  # texts without terms are near each other only


def test_forest(spark):
    rng = np.random.default_rng(0)
    centre = rng.standard_normal((12, 16))
    rows = [c + rng.standard_normal(16) * s for c in centre for s in rng.random(30) * 0.5]
    rows += [rows[0]] * 9 + [2 * rows[1]]
    data = [(i, v.tolist()) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, [None] * 16, [1.0, 2.0]]
    data += [(1000 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = by_id(forest.near_vectors(df, leaf_rows=60), "vec_id")
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    found = np.array([got[i].n_links for i in range(len(rows))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.9 * near.sum()
    assert all(tuple(got[1000 + i])[1:] == (0, 1000 + i, True) for i in range(len(odd)))
    assert forest.near_vectors(df.limit(0)).count() == 0


def test_forest_finds_near_vectors_with_a_common_direction(spark):
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    noise, turn = unit(rng.standard_normal((2000, 64))), unit(rng.standard_normal((2000, 64)))
    turn = unit(turn - (turn * noise).sum(1, keepdims=True) * noise)
    noise[1::2] = (0.7 * noise + np.sqrt(0.51) * turn)[::2]  # pairs at about 0.7 * 0.3 + 0.7
    common = np.full(64, np.sqrt(0.7 / 64))
    rows = unit(common + np.sqrt(0.3) * noise)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = by_id(forest.near_vectors(df, leaf_rows=40), "vec_id")
    near = rows @ rows.T >= forest.SIMILARITY
    np.fill_diagonal(near, False)
    found = np.array([got[i].n_links for i in range(len(rows))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.9 * near.sum() > 500


def test_forest_grows_until_pairs_meet():
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    common, shift = np.eye(64)[0] * np.sqrt(0.7), np.sqrt(0.3)
    own = lambda x: unit(x * (np.arange(64) > 0))
    sample = common + shift * own(rng.standard_normal((6000, 64)))
    one, turn = own(rng.standard_normal((1000, 64))), own(rng.standard_normal((1000, 64)))
    turn = unit(turn - (turn * one).sum(1, keepdims=True) * one)
    two = 2 / 3 * one + np.sqrt(5 / 9) * turn  # 0.7 + 0.3 * 2 / 3 = 0.9
    one, two = common + shift * one, common + shift * two
    share = lambda trees: np.any([forest._meet(t, one, two) for t in trees], axis=0).mean()
    grown = forest._grow(sample, 0.9, 0.9, forest.TREES, forest.SPILL, 16, 1)
    assert share(grown[: forest.TREES]) < 0.8 and share(grown) >= 0.9
    # vectors too alike for that many trees lie in larger leaves
    alike = unit(common * 3 + sample)
    assert len(forest._grow(alike, 0.9, 0.9, forest.TREES, forest.SPILL, 16, 1)) <= forest.MOST_TREES


def test_forest_cells_find_what_a_whole_leaf_finds(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(8) + rng.standard_normal(8) * 0.3).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = sorted(forest.near_vectors(df).collect())
    monkeypatch.setattr(forest, "CELL_ROWS", 20)
    assert sorted(forest.near_vectors(df).collect()) == whole


def test_html():
    page = """<html><head><title>no</title><style>p{}</style><script>var a="</p>";</script></head>
    <body><nav><ul><li><a href=/>menu</a></li></ul></nav><div class="ad">Buy this now, please do.</div>
    <article><h1>A title &amp; more</h1><p>First  text<br>goes &eacute; on and on for a while, so that
    it is long.<p>Short.</p><aside>not this one, though it is a long line of text</aside></article>
    <section id="comments"><p>Reader says something rather long here as well.</p></section>
    <form><p>Your mail address, please, so that we can write to you.</p></form>
    <footer>&copy; someone, some rights reserved, and so on and on</footer></body></html>"""
    want = "A title & more\n\nFirst text goes é on and on for a while, so that it is long.\n\nShort."
    assert html.main_text(page) == want
    for odd in (None, "", "<", "<![x", "<!--", "plain", "<p>" * 5000 + "x", "&#xD800;&bogus;"):
        html.main_text(odd)
    assert html.main_text("<nav>only</nav>") == ""


def test_html_keeps_what_an_article_contains():
    long = [f"{c} {'word ' * 80}".strip() for c in "abcdefgh"]
    short = [f"only short line {i:04d}" for i in range(6)]
    p = lambda texts: "".join(f"<p>{t}</p>" for t in texts)
    for inner in ("section", "div", "table><tr><td"):
        nested = f"<{inner}>{p(short)}" + ("</td></tr></table>" if "td" in inner else f"</{inner}>")
        for around in ("article", "main"):
            text = f"<h1>Title</h1>{p(long[:4])}{nested}{p(long[4:])}"
            page = f"<body><div>menu</div><{around}>{text}</{around}><div>end</div></body>"
            want = "\n\n".join(["Title", *long[:4], *short, *long[4:]])
            assert html.main_text(page) == want
    # marked as boilerplate inside an article
    page = f"<article>{p(long)}<div class='related'>{p(long)}</div></article>"
    assert html.main_text(page) == "\n\n".join(long)
    # classes of the page's own elements are about its layout
    for start in ("<body class='has-sidebar'><article class='no-sidebar'>", "<html id='menu'><body><main class=widget><article>"):
        assert html.main_text(f"{start}{p(long)}</article>") == "\n\n".join(long)
    # a link and a menu that were never closed
    page = f"<body><nav><ul><li><a href=/>menu<article>{p(long)}</article></body>"
    assert html.main_text(page) == "\n\n".join(long)


def test_chat_layouts_and_round_trip(spark):
    odd = ["", "<s> <\\s> [INST] [\\INST] <\\\\/s> <|im_end|>\n", "a\\nb", None, "</s>[INST] ok [/INST]"]
    for t in odd:
        turns = [("user", t or ""), ("we\nird\\", t or ""), ("assistant", t or "")]
        text, spans = chat.format_turns(turns)
        assert chat.read_turns(text) == turns and chat.read_loss(text, spans) == (t or "")
    records = [
        '{"prompt": "p", "response": "r"}', '{"instruction": "i", "input": null, "output": "o"}',
        '{"messages": [{"role": "user", "content": "c"}]}', '{"messages": []}',
        '{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}',
        '{"other": 1}', "no json", None,
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "id int, record string")
    got = by_id(chat.canonical(df), "id")
    assert [got[i].chat.layout for i in range(8)] == [
        "prompt", "instruction", "messages", "messages", "conversations", None, None, None,
    ]
    assert [tuple(t) for t in got[4].chat.turns] == [("user", "h"), ("assistant", "g")]


def test_language_spans_and_sums():
    pieces, automaton = langid.vocabulary(), langid._automaton(langid.VOCABULARY)
    table = np.random.default_rng(0).random((len(pieces), 2))
    scorer = langid.Scorer(["a", "b"], table / table.sum(0), langid.VOCABULARY)
    for word in ("hello", "größe", "é漢x", "q🙂"):
        text, sums = langid.WORD_START + word, [np.ones(2)]
        for end in range(1, len(text) + 1):  # brute force over the last piece
            ways = [(s, pieces.get(text[s:end])) for s in range(end)]
            ways = [(s, -1 if i is None else i) for s, i in ways if i is not None or s == end - 1]
            sums.append(sum(sums[s] * scorer.full[i] for s, i in ways))
        scorer.learn_words([word])
        assert np.allclose(scorer.scores[scorer[word]], np.log(sums[-1]))
        assert len(langid.spans(word, automaton))


def test_language_of_long_words_outside_the_vocabulary(spark):
    pieces = langid.vocabulary()
    strange = [c for c in map(chr, range(0x1000, 0x1800)) if c.isalpha() and c not in pieces][:20]
    words = [(strange * 4)[i : i + langid.SPAN] for i in range(10)]
    lao, other = ("".join(w) + " " for w in words[:2])
    rows = [(i, "b", f"{lao} and") for i in range(5)] + [(9 + i, "a", f"{other} oder und die") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    languages, table = langid.learn(docs)
    # every character counts once, the word's beginning as well
    found = langid.spans(lao.strip(), langid._automaton(langid.VOCABULARY))
    uses = langid.expected(found, langid._table(table)[:, 0].tolist())
    assert np.isclose(sum(u for i, u in uses if i < 0), langid.SPAN)
    scorer = langid.Scorer(languages, table, langid.VOCABULARY)
    scorer.learn_words([lao.strip(), "q" + lao.strip()[1:], "and"])
    begin = np.log(table[pieces[langid.WORD_START]])
    assert np.allclose(scorer.scores[0], begin + langid.SPAN * np.log(langid.STRANGER))
    assert (scorer.scores[1] != scorer.scores[0]).all()
    # the word's beginning is more likely where more words consist of it
    got = langid.predict(docs, (languages, table)).select("lang", "language.*").collect()
    assert all(r.lang == r.lang_pred for r in got)
    alone = langid.predict(docs.withColumn("text", F.lit(lao)), (languages, table)).collect()
    assert {r.language.lang_pred for r in alone} == {languages[int(begin.argmax())]}
    assert languages[int(begin.argmax())] == "b"


def test_language_query(spark, data):
    got = queries.op1_language_id(spark, data)
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held) and held
    model = langid.learn(docs.limit(0).withColumn("text", F.lit("x")))
    odd = spark.createDataFrame([(None,), ("",), ("12 !",)], "text string")
    assert {r.language.lang_pred for r in langid.predict(odd, model).collect()} == {langid.UNKNOWN}


def test_language_floors_tell_texts_of_no_language(spark, data):
    rng = random.Random(6)
    docs = queries.read_table(spark, data, "documents")
    sample = langid.labelled_sample(docs, rows_per_language=60)
    assert all(r["count"] <= 60 for r in sample.groupBy("lang").count().collect())
    model = langid.learn_sample(sample)
    floors = langid.floors(sample, model)
    assert sorted(floors) == model[0] and all(-6 < f < -2 for f in floors.values())
    letters = lambda n: " ".join(
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n)
    )
    junk = [letters(rng.randint(10, 80)) for _ in range(100)]
    junk += ["Это предложение написано на русском языке, его здесь не учили", "これは日本語の文です。この言語は学ばれていません。"]
    df = spark.createDataFrame([(t,) for t in junk], "text string").unionByName(docs.select("text"))
    low = lambda r: r.language.log_likelihood < floors[r.language.lang_pred] * r.language.n_chars
    rows = langid.predict(df, model).collect()
    gone = {r.text for r in rows if r.language.lang_pred != langid.UNKNOWN and low(r)}
    assert gone == set(junk)


def test_labelled_sample_of_odd_rows(spark):
    rows = [(1, "a b", "x")] * 50 + [(None, "c", "x"), (2, None, "x"), (3, "d", None), (4, "e", "y"), (4, "f", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(tuple(r) for r in langid.labelled_sample(df).collect())
    assert got == [("x", "a b"), ("x", "c"), ("y", "e"), ("y", "f")]
    assert langid.labelled_sample(df, rows_per_language=1).count() == 2
    none = langid.labelled_sample(df.limit(0))
    assert none.count() == 0 and langid.floors(none, langid.learn_sample(none)) == {}


def test_language_prediction_of_odd_rows(spark):
    docs = [(i, "the and of", "en") for i in range(4)] + [(9 + i, "der und von", "de") for i in range(4)]
    model = langid.learn(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    rows = [(1, "the", "x"), (1, "the", "x"), (None, None, "y"), (3, "", None), (4, "der " * 50_000, "z"), (5, "q", "w")]
    df = spark.createDataFrame(rows, "id int, text string, language string").withColumn("_row", F.lit(1))
    got = langid.predict(df, model)
    assert got.columns == ["id", "text", "_row", "language"]
    found = {(r.id, (r.text or "")[:5]): r.language for r in got.collect()}
    assert found[1, "the"].lang_pred == "en" and found[4, "der d"].lang_pred == "de"
    assert found[4, "der d"].n_chars == 4 * 50_000
    assert tuple(found[None, ""]) == tuple(found[3, ""]) == (langid.UNKNOWN, 0.0, 0.0, 0)
    assert langid.predict(df.limit(0), model).count() == 0 and got.count() == len(rows)
    alike = langid.learn(spark.createDataFrame([(1, "a", "b"), (2, "a", "a")], "doc_id long, text string, lang string"))
    assert {r.language.lang_pred for r in langid.predict(df.where("id = 1"), alike).collect()} == {"a"}  # a tie


def test_empty_tables(docs):
    none = docs.limit(0)
    for made in (
        substrings.remove_repeats(none), jaccard.link_similar(none), bpe.encode(none),
        simhash.compare_neighbours(none), packing.pack(packing.token_pieces(none), ["doc_id"]),
    ):
        assert made.count() == 0


def test_pipeline(spark, data):
    import corpus_pipeline as pipeline

    docs = queries.read_table(spark, data, "documents")
    for _, stage in pipeline.STAGES[:-1]:
        made = stage(spark, docs, data)
        assert made.columns == docs.columns and 0 < made.count() <= docs.count()
        docs = made
    assert pipeline.run(spark, data).count() > 0
