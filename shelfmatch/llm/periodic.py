"""Runs of repeated words in a text, found in its enhanced suffix array.

A run is a stretch whose words recur at a distance, its smallest period, and that no neighbouring
word continues. A square, a word sequence twice in a row, is branching if the word after it breaks
the period; every run ends with just one branching square of its smallest period. The two halves of
a branching square of period d are suffixes that share d words and no more, so they lie on two
sides of an LCP interval of depth d. The suffixes of the smaller side are tested alone: whether the
inverse suffix array has the places d further on and d before on the other side. Squares are then
rotated to the left as far as the words agree, and those of one end merged into the run of the
smallest period. No tree is built: an interval is a place in the LCP array with its two borders.

Texts are treated many at a time. Suffixes of different texts share nothing, as the words of each
are numbered for themselves. Only words covered by a window that occurs twice in its text can lie
in a run: of a run of at least m words and e periods, m (e - 1) / e words at least recur one period
on, and these windows cover it whole. Suffixes of other words are not sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import combine, mix, split_words, windows

LEAST_WORDS = 24  # of a run
LEAST_PERIODS = 3
BATCH_WORDS = 1 << 20  # words of the texts that are treated together; a longer text goes alone
_ROTATED = 64  # words compared at first when a square is rotated
_NUMBER = np.uint64(0x9E3779B97F4A7C15)


def covered(hashes: np.ndarray, doc: np.ndarray, fits: np.ndarray, window: int) -> np.ndarray:
    """Words in a window of so many words that occurs twice in its text."""
    inside = np.zeros(len(hashes) + 1, np.int64)
    places = np.flatnonzero(fits)
    if places.size:
        key = combine(windows(hashes, window)[places], mix(doc[places].astype(np.uint64) + _NUMBER))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(places), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        places = places[twice]
        np.add.at(inside, places, 1)
        np.add.at(inside, places + window, -1)
    return np.cumsum(inside[:-1]) > 0


def dense(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones, from 0."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank


def suffix_ranks(symbols: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of the first 1, 2, 4, ... words from each place, until all differ.

    ``symbols`` of different stretches differ; ``end`` is where the stretch of a place ends. A
    suffix that ends sooner comes first. The last are the places in the suffix array.
    """
    n, levels, step = len(symbols), [dense(symbols)], 1
    place = np.arange(n)
    while levels[-1].max(initial=-1) < n - 1:
        rank = levels[-1]
        after = np.zeros(n, np.int64)
        goes_on = place + step < end
        after[goes_on] = rank[place[goes_on] + step] + 1
        levels.append(dense(rank * (n + 1) + after))
        step *= 2
    return levels


def shared_words(levels: list[np.ndarray], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """How many words the suffixes at two different places share."""
    n = len(levels[0])
    one, two, shared = one.copy(), two.copy(), np.zeros(len(one), np.int64)
    for k in range(len(levels) - 2, -1, -1):
        inside = (one < n) & (two < n)
        same = np.zeros(len(one), bool)
        same[inside] = levels[k][one[inside]] == levels[k][two[inside]]
        shared += same << k
        one += same << k
        two += same << k
    return shared


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the LCP interval that it splits: its first suffix and the one after its last.

    ``lcp[i]`` is what suffixes i - 1 and i share. Of places with the same value in one interval,
    each splits off the child to its left.
    """
    n, values = len(lcp), lcp.tolist()
    first, last, open_ = [0] * n, [n] * n, []
    for i in range(1, n):
        value = values[i]
        while open_ and values[open_[-1]] > value:
            last[open_.pop()] = i
        first[i] = open_[-1] if open_ else 0
        open_.append(i)
    return np.array(first, np.int64), np.array(last, np.int64)


def branching_squares(
    levels: list[np.ndarray], start: np.ndarray, end: np.ndarray, periods: int
) -> tuple[np.ndarray, np.ndarray]:
    """Place and period of the branching squares that end a repetition of so many periods."""
    rank = levels[-1]
    n = len(rank)
    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    lcp[1:] = shared_words(levels, suffix[:-1], suffix[1:])
    first, last = intervals(lcp)
    # a longer period than fits into the stretch so often ends no such repetition
    node = np.flatnonzero((lcp > 0) & (lcp * periods <= (end - start)[suffix]))
    left, right = node - first[node], last[node] - node
    small = np.minimum(left, right)
    from_ = np.where(left <= right, first[node], node)
    places, depths, at = [], [], 0
    bounds = np.concatenate([[0], np.cumsum(small)])
    while at < len(node):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BATCH_WORDS, "right")) - 1)
        part = slice(at, to)
        each = np.repeat(np.arange(at, to), small[part])
        index = np.arange(len(each)) - np.repeat(bounds[part] - bounds[at], small[part]) + from_[each]
        i, d = node[each], lcp[node[each]]
        here = suffix[index]
        left_side = index < i
        for shift in (d, -d):
            other = here + shift
            known = (other >= start[here]) & (other < end[here])
            there = rank[np.where(known, other, 0)]
            across = np.where(left_side, (there >= i) & (there < last[i]), (there >= first[i]) & (there < i))
            hit = known & across
            place = np.minimum(here, other)[hit]
            depth, interval = d[hit], i[hit]
            for k in range(1, periods - 1):  # the periods before must lie in the interval too
                before = place - k * depth
                inside = before >= start[place]
                r = rank[np.where(inside, before, 0)]
                inside &= (r >= first[interval]) & (r < last[interval])
                place, depth, interval = place[inside], depth[inside], interval[inside]
            places.append(place)
            depths.append(depth)
        at = to
    none = [np.zeros(0, np.int64)]
    return np.concatenate(places or none), np.concatenate(depths or none)


def rotated(symbols: np.ndarray, place: int, period: int, start: int) -> int:
    """The first place to which a square can be rotated, not before ``start``."""
    step = _ROTATED
    while place > start:
        low = max(start, place - step)
        differ = np.flatnonzero(symbols[low:place] != symbols[low + period : place + period])
        if differ.size:
            return low + int(differ[-1]) + 1
        place, step = low, 2 * step
    return place


def runs_of_stretches(
    symbols: np.ndarray, start: np.ndarray, end: np.ndarray, least: int, periods: int
) -> list[tuple[int, int, int]]:
    """First place, length and period of each run, by place."""
    if not len(symbols):
        return []
    place, period = branching_squares(suffix_ranks(symbols, end), start, end, periods)
    order = np.lexsort((period, place + 2 * period))
    found: list[tuple[int, int, int]] = []
    last, here = -1, []
    for s, d in zip(place[order].tolist(), period[order].tolist()):
        if s + 2 * d != last:
            last, here = s + 2 * d, []
        # a root that is itself a repetition belongs to the run of its own period
        if any(d % q == 0 and first <= s for first, q in here):
            continue
        first = rotated(symbols, s, d, int(start[s]))
        here.append((first, d))
        if last - first >= max(least, periods * d):
            found.append((first, last - first, d))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of_texts(
    hashes: np.ndarray, first: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> list[list[tuple[int, int, int]]]:
    """Runs of each text as start, length and period. ``first`` is where the words of each begin."""
    texts = len(first) - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(texts)]
    doc = np.repeat(np.arange(texts), np.diff(first))
    window = -(-least * (periods - 1) // periods)
    fits = np.arange(len(hashes)) + window <= np.repeat(first[1:], np.diff(first))
    words = np.flatnonzero(covered(hashes, doc, fits, window))
    if not words.size:
        return out
    # stretches of covered words, with numbers of their own for their words
    begins = np.ones(len(words), bool)
    begins[1:] = (np.diff(words) > 1) | (np.diff(doc[words]) > 0)
    stretch = np.cumsum(begins) - 1
    bounds = np.append(np.flatnonzero(begins), len(words))
    start, end = bounds[stretch], bounds[stretch + 1]
    symbols = dense(stretch * (len(words) + 1) + dense(hashes[words]))
    for at, length, period in runs_of_stretches(symbols, start, end, least, periods):
        text = int(doc[words[at]])
        out[text].append((int(words[at] - first[text]), length, period))
    return out


def repeated_words(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Of n words those that a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def _batches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most BATCH_WORDS words, as a word takes two bytes with what parts it."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + 2 * BATCH_WORDS, "right")))
        yield at, to
        at = to


def find_runs(
    df: DataFrame, text: str = "text", least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> DataFrame:
    """The columns of ``df`` and a struct ``periodic``: n_words, runs by start and period, collapsed.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs`` has start, length and period of
    each run of at least ``least`` words and ``periods`` periods; ``collapsed`` is the text of the
    words kept, joined by one space: those that no run contains after its first period. A null or
    empty text has no words, no runs and an empty collapsed text. Nulls in other columns, repeated
    rows and ties stay; an empty table stays empty; a column named ``periodic`` is replaced.
    """
    if periods < 2 or least < 2:
        raise ValueError("a run has at least two periods and two words")
    kept = [c for c in df.columns if c != "periodic"]
    row, at = df.select(F.struct(*kept).alias("_row")), kept.index(text)
    made = T._parse_datatype_string(
        "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    schema = T.StructType(
        [T.StructField("_row", row.schema["_row"].dataType), T.StructField("periodic", made)]
    )
    run_kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch[0].field(at)
            for low, high in _batches(texts):
                words = split_words(texts.slice(low, high - low))
                found = runs_of_texts(words.hashes(), words.first, least, periods)
                keep = np.ones(len(words.start), bool)
                for runs, first, end in zip(found, words.first.tolist(), words.first[1:].tolist()):
                    if runs:
                        keep[first:end] = ~repeated_words(runs, end - first)
                rows = [[dict(zip(run_kind.names, r)) for r in runs] for runs in found]
                answer = pa.StructArray.from_arrays(
                    [
                        pa.array(np.diff(words.first), pa.int64()),
                        pa.array(rows, pa.list_(run_kind)),
                        words.kept(keep),
                    ],
                    names=made.names,
                )
                yield pa.record_batch([batch[0].slice(low, high - low), answer], names=schema.names)

    return row.mapInArrow(work, schema).select("_row.*", "periodic")


def with_periodic_ends(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A tenth of the texts, chosen by the key's crc32, end in words that repeat; a test of runs.

    Of the n words of a text with h = crc32(key), h % 10 = 0, each word from a = g % n on becomes
    the word a + (i - a) % p, where g = h // 10 and p = 1 + (n - a) // (3 + g % 8). Other texts,
    null keys, null texts and those without words stay as they are.
    """
    others = [c for c in docs.columns if c not in ("_words", "_h")]
    h = F.crc32(F.col(key).cast("string"))
    words = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    found = docs.select(*others, h.alias("_h"), F.when(h % 10 == 0, words).alias("_words"))
    g = F.floor(F.col("_h") / 10)
    n = F.greatest(F.size("_words"), F.lit(1)).cast("long")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    found = found.select("*", a.cast("int").alias("_a"), p.cast("int").alias("_p"))
    period = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    times = (g % 8 + 4).cast("int")  # at least as many as are needed
    repeated = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), F.size("_words") - F.col("_a"))
    changed = F.concat(F.slice("_words", F.lit(1), F.col("_a")), repeated)
    new = F.when(F.size("_words") > 0, F.array_join(changed, " ")).otherwise(F.col(text)).alias(text)
    return found.select(*[new if c == text else F.col(c) for c in others])
