"""Language identification by unigrams of word pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary. A language gives each piece a probability; the
probability of a word is the sum over all ways to cut it into pieces, which a forward pass computes
left to right. A text is as likely as its words together. How likely it is for its length tells
whether it is in any learnt language at all.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import and_

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .kept import keep
from .worker import held

VOCABULARY = "piece_bpe_32k.model"
WORD_START = "▁"  # fixed value: how the vocabulary marks the beginning of a word
UNKNOWN = "und"
ROWS_PER_LANGUAGE = 300  # texts a language is learnt from
FLOOR = 2.75  # times the log-likelihood of a character in its language, below which text is in none
ROUNDS = 2  # of expectation and maximisation
KNOWN_WORDS = 250_000  # words a worker remembers with their scores
STRANGER = 1e-7  # probability of a character that the vocabulary lacks, in any language
SMOOTHING = 0.01  # added to the expected count of each piece
SPAN = 64  # words beyond this many characters are scored in parts
FAINT = 1e-250  # words less likely than this are summed again by logarithms; what sums have lost by then is smaller
NEW_WORDS = 5000  # scored at once
COUNTED_WORDS = 200_000  # that a task counts before it hands them on
RATIO_DIGITS = 4  # of the log-likelihood of a character, of which the median is taken
TEXTS = 64  # read before new words are scored
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


@lru_cache(1)
def vocabulary(name: str = VOCABULARY) -> dict[str, int]:
    """Piece to index, of the pieces that text can hold."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    plain = (
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    )
    return {p: i for i, p in enumerate(dict.fromkeys(plain))}


def words_of(text: str | None) -> Counter:
    """Words of letters in lower case. Words of more than SPAN characters count as several."""
    found = Counter(_WORD.findall((text or "").lower()))
    for w in [w for w in found if len(w) > SPAN]:
        n = found.pop(w)
        for at in range(0, len(w), SPAN):
            found[w[at : at + SPAN]] += n
    return found


@lru_cache(1)
def _automaton(name: str) -> ahocorasick.Automaton:
    """Finds all pieces in a word in one pass, by where they end."""
    found = ahocorasick.Automaton()
    for piece, index in vocabulary(name).items():
        found.add_word(piece, (len(piece), index))
    found.make_automaton()
    return found


def spans(word: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """Where each piece fits, sorted by end: from, to, index; -1 for a character that is no piece."""
    text, found, alone = WORD_START + word, [], 0
    for last, (length, index) in automaton.iter(text):
        end = last + 1
        while alone < end - 1:  # characters before this end at which no single one was a piece
            alone += 1
            found.append((alone - 1, alone, -1))
        found.append((end - length, end, index))
        if length == 1:
            alone = end
    for end in range(alone + 1, len(text) + 1):
        found.append((end - 1, end, -1))
    return found


def expected(found: list[tuple[int, int, int]], column: list[float]) -> list[tuple[int, float]]:
    """Uses of pieces to be expected in a word, by a forward and a backward pass."""
    n = found[-1][1] + 1
    front, back = [0.0] * n, [0.0] * n
    front[0] = back[-1] = 1.0
    for start, end, index in found:  # sorted by end
        front[end] += front[start] * column[index]
    for start, end, index in reversed(found):
        back[start] += column[index] * back[end]
    total = front[-1]
    if total < FAINT:
        return _expected_by_logs(found, column)
    return [(index, front[start] * column[index] * back[end] / total) for start, end, index in found]


def _log_add(a: float, b: float) -> float:
    high, low = max(a, b), min(a, b)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def _expected_by_logs(found: list[tuple[int, int, int]], column: list[float]) -> list[tuple[int, float]]:
    n = found[-1][1] + 1
    front, back = [-math.inf] * n, [-math.inf] * n
    front[0] = back[-1] = 0.0
    logs = [math.log(column[index]) for _, _, index in found]
    for (start, end, _), log in zip(found, logs):
        front[end] = _log_add(front[end], front[start] + log)
    for (start, end, _), log in zip(reversed(found), reversed(logs)):
        back[start] = _log_add(back[start], log + back[end])
    total = front[-1]
    return [
        (index, math.exp(front[start] + log + back[end] - total))
        for (start, end, index), log in zip(found, logs)
    ]


def _table(probabilities: np.ndarray) -> np.ndarray:
    """One more row at the end, which index -1 reads."""
    return np.vstack([probabilities, np.full(probabilities.shape[1], STRANGER)])


def labelled_sample(
    rows: DataFrame,
    text: str = "text",
    language: str = "lang",
    key: str = "doc_id",
    rows_per_language: int | None = ROWS_PER_LANGUAGE,
) -> DataFrame:
    """``lang, text`` of different rows, ``rows_per_language`` a language, written; None takes all, not written.

    Those least by a hash of the key: a bounded sample, as large for any input. Rows are ranked
    without their texts, which are fetched for the ones chosen. Rows without text or language are
    left out; repeated rows count once.
    """
    usable = rows.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(
        F.col(language).alias("lang"), F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("text")
    )
    if rows_per_language is None:
        return usable.dropDuplicates(["lang", "k", "h"]).select("lang", "text")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("k"), "k", "h")
    ranked = usable.select("lang", "k", "h").withColumn("n", F.row_number().over(order))
    chosen = keep(ranked.where(F.col("n") <= rows_per_language).select("lang", "k", "h").distinct())
    same = [F.col(f"usable.{c}").eqNullSafe(F.col(f"chosen.{c}")) for c in ("lang", "k", "h")]
    found = usable.alias("usable").join(chosen.alias("chosen"), reduce(and_, same), "left_semi")
    return keep(found.groupBy("lang", "k", "h").agg(F.first("text").alias("text")).select("lang", "text"))


def learn(
    rows: DataFrame,
    text: str = "text",
    language: str = "lang",
    key: str = "doc_id",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    rounds: int = ROUNDS,
    name: str = VOCABULARY,
) -> tuple[list[str], np.ndarray]:
    """Languages and a table of piece probabilities, a column each, from ``labelled_sample``.

    The model is vocabulary x languages. Without a labelled text there are no languages.
    """
    return learn_sample(labelled_sample(rows, text, language, key, rows_per_language), rounds, name)


def learn_sample(
    sample: DataFrame, rounds: int = ROUNDS, name: str = VOCABULARY
) -> tuple[list[str], np.ndarray]:
    """``learn`` from all rows ``lang, text``."""
    counted = sample.select("lang", "text").mapInArrow(_word_counts, "lang string, word string, n long")
    counts = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    spark = sample.sparkSession
    size = len(vocabulary(name))
    counts = keep(counts.repartition("word"))
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    table = np.full((size, len(languages)), 1.0 / size)
    for _ in range(rounds if languages else 0):
        model = spark.sparkContext.broadcast((languages, table, name))
        uses = counts.mapInArrow(lambda it, m=model: _uses(it, *m.value), "lang int, piece int, n double")
        got = uses.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        table = np.full((size, len(languages)), SMOOTHING)
        np.add.at(table, (got["piece"].to_numpy(), got["lang"].to_numpy()), got["n"].to_numpy())
        table /= table.sum(0)
    return languages, table


def floors(
    sample: DataFrame, model: tuple[list[str], np.ndarray], times: float = FLOOR, name: str = VOCABULARY
) -> dict[str, float]:
    """For each language the log-likelihood of a character below which a text is in none of them:
    ``times`` the median of the sample's texts of the language, whatever their lengths."""
    return floors_of(predict(sample, model, "text", name), times)


def floors_of(predicted: DataFrame, times: float = FLOOR) -> dict[str, float]:
    """``floors`` of texts whose language has been predicted, rows ``lang, language``.

    The median is that of values rounded to RATIO_DIGITS, of which there are few, for any number of rows.
    """
    found = predicted.where("language.lang_pred = lang and language.n_chars > 0")
    ratio = F.round(F.expr("language.log_likelihood / language.n_chars"), RATIO_DIGITS)
    medians = found.groupBy("lang").agg(F.median(ratio))
    return {lang: times * one for lang, one in medians.collect()}  # a row for each language


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Counter] = {}

    def counted() -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, words in found.items() for word, n in words.items()]
        columns = zip(*rows) if rows else ((), (), ())
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch[0].to_pylist(), batch[1].to_pylist()):
            found.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, found.values())) >= COUNTED_WORDS:
                yield counted()
                found.clear()
    yield counted()


def _uses(batches, languages: list[str], table: np.ndarray, name: str) -> Iterator[pa.RecordBatch]:
    """Expected uses of pieces in the words of a task, by language."""
    automaton, columns = _automaton(name), _table(table).T.tolist()
    number = {x: i for i, x in enumerate(languages)}
    total: dict[tuple[int, int], float] = {}
    for batch in batches:
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            one = number[lang]
            for piece, uses in expected(spans(word, automaton), columns[one]):
                if piece >= 0:
                    total[one, piece] = total.get((one, piece), 0.0) + n * uses
    yield pa.record_batch(
        [
            pa.array([k[0] for k in total], pa.int32()),
            pa.array([k[1] for k in total], pa.int32()),
            pa.array(list(total.values()), pa.float64()),
        ],
        names=["lang", "piece", "n"],
    )


class Scorer(dict):
    """Scores texts with a learnt model. Remembers where the scores of a word are."""

    def __init__(self, languages: list[str], table: np.ndarray, name: str):
        super().__init__()
        self.languages, self.full, self.automaton = languages, _table(table), _automaton(name)
        self.scores = np.zeros((1024, len(languages)))
        self.lengths = np.zeros(1024, np.int64)  # of the words, with their beginning

    def learn_words(self, words: list[str]) -> None:
        """Log-probabilities of new words, all words at once: one step for each place in a word."""
        total = self._totals(words, logs=False)
        faint = np.flatnonzero((total < FAINT).any(1))
        with np.errstate(divide="ignore"):
            total = np.log(total)
        if len(faint):
            total[faint] = self._totals([words[i] for i in faint], logs=True)
        at = len(self)
        while at + len(words) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.scores[at : at + len(words)] = total
        self.lengths[at : at + len(words)] = [len(WORD_START) + len(w) for w in words]
        self.update(zip(words, range(at, at + len(words))))

    def _totals(self, words: list[str], logs: bool) -> np.ndarray:
        """Probabilities of words, a column each language, or their logarithms, which no word makes too small."""
        spans_of = [spans(w, self.automaton) for w in words]
        flat = np.array([s for found in spans_of for s in found], np.int64).reshape(-1, 3)
        word = np.repeat(np.arange(len(words)), [len(found) for found in spans_of])
        order = np.lexsort((word, flat[:, 1]))
        word, (start, end, index) = word[order], flat[order].T
        # SPAN bounds the length, so that the sums fit into memory
        sums = np.zeros((int(end.max()) + 1, len(words), len(self.languages)))
        sums[0] = 0.0 if logs else 1.0
        full = np.log(self.full) if logs else self.full
        cuts = np.searchsorted(end, np.arange(1, len(sums) + 1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            before = sums[start[a:b], word[a:b]]
            step = before + full[index[a:b]] if logs else before * full[index[a:b]]
            first = np.flatnonzero(np.diff(word[a:b], prepend=-1))
            if logs:
                high = np.maximum.reduceat(step, first, axis=0)
                step = np.exp(step - np.repeat(high, np.diff(first, append=len(step)), axis=0))
                found = high + np.log(np.add.reduceat(step, first, axis=0))
            else:
                found = np.add.reduceat(step, first, axis=0)
            sums[end[a], word[a:b][first]] = found
        last = np.array([len(WORD_START + w) for w in words])
        return sums[last, np.arange(len(words))]

    def texts(self, texts: list[str | None]) -> list[tuple[str, float, float, int]]:
        """Language, its posterior probability, all languages being as likely before, the
        log-likelihood of the text in it, and of how many characters."""
        found = [words_of(t) for t in texts]
        if len(self) > KNOWN_WORDS:
            self.clear()
        new = list({w for f in found for w in f if w not in self})
        for at in range(0, len(new) if self.languages else 0, NEW_WORDS):
            self.learn_words(new[at : at + NEW_WORDS])
        return [self._best(f) for f in found]

    def _best(self, found: Counter) -> tuple[str, float, float, int]:
        if not found or not self.languages:
            return UNKNOWN, 0.0, 0.0, 0
        places = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        times = np.fromiter(found.values(), float, len(found))
        scores = times @ self.scores[places]
        best = int(scores.argmax())
        posterior = float(1.0 / np.exp(np.minimum(scores - scores[best], 0)).sum())
        return self.languages[best], posterior, float(scores[best]), int(times @ self.lengths[places])


def scorer_of(model_id: str, model: tuple) -> Scorer:
    """One for all tasks of a worker that use the same model."""
    return held(model_id, lambda: Scorer(*model))


def predict(
    df: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", name: str = VOCABULARY
) -> DataFrame:
    """The columns of ``df`` and a struct ``language``: lang_pred, score, log_likelihood, n_chars.

    lang_pred is a learnt language, or ``und`` with score 0 if the text is null or has no letter or
    nothing was learnt. score is its posterior probability, log_likelihood that of the text's words
    in it, of n_chars characters with the beginnings of words: 0 of 0 for ``und``.
    Equal texts get equal answers, whatever the other columns say. Ties go to the language first in
    the alphabet. A column named ``language`` of the input is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast((*model, name))
    model_id = uuid.uuid4().hex
    kept = [c for c in df.columns if c != "language"]
    # the text moves to Python once, inside its row
    row, at = df.select(F.struct(*kept).alias("_row")), kept.index(text)
    row_type = T.StructType([f for f in df.schema if f.name in kept])
    answer_type = T._parse_datatype_string(
        "lang_pred string, score double, log_likelihood double, n_chars long"
    )
    schema = T.StructType([T.StructField("_row", row_type), T.StructField("language", answer_type)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model_id, shared.value)
        for batch in batches:
            found = []
            texts = batch[0].field(at)
            for first in range(0, len(texts), TEXTS):
                found += scorer.texts(texts.slice(first, TEXTS).to_pylist())
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.int64())
            answer = pa.StructArray.from_arrays(
                [pa.array([x[i] for x in found], k) for i, k in enumerate(kinds)],
                names=answer_type.names,
            )
            yield pa.record_batch([batch[0], answer], names=["_row", "language"])

    return row.mapInArrow(score, schema).select("_row.*", "language")
