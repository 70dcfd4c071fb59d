"""Stemming of word lists.

``plural`` is a native expression. ``porter`` is the published Porter (1980) algorithm; it runs on
Arrow batches and stems each distinct word of a task once, so no row is shuffled for it.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmatch.functions.fixed_values import PORTER_STEP_2, PORTER_STEP_3, PORTER_STEP_4

# Send the functions themselves to the executors, so that these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_KNOWN = 1 << 18  # stems a task remembers, those it meets first
STRIPE_ROWS = 1024  # lists that are stemmed together
_LONGEST_FIRST_2 = sorted(PORTER_STEP_2, key=lambda r: -len(r[0]))
_LONGEST_FIRST_3 = sorted(PORTER_STEP_3, key=lambda r: -len(r[0]))
_LONGEST_FIRST_4 = sorted(PORTER_STEP_4, key=lambda s: -len(s))


_NOT_VOWEL, _VOWEL = re.compile("[^aeiouy]"), re.compile("[aeiou]")


def _shape(word: str) -> str:
    """Each letter as c (consonant) or v (vowel); y is a vowel after a consonant."""
    kinds = _VOWEL.sub("v", _NOT_VOWEL.sub("c", word))
    while "y" in kinds:
        i = kinds.index("y")
        kinds = kinds[:i] + ("v" if i > 0 and kinds[i - 1] == "c" else "c") + kinds[i + 1 :]
    return kinds


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_consonant(word: str) -> bool:
    return word[-1:] == word[-2:-1] and _shape(word).endswith("c")


def _short_end(word: str) -> bool:
    """Ends consonant-vowel-consonant, the last one not w, x or y."""
    return not word.endswith(("w", "x", "y")) and _shape(word).endswith("cvc")


def _swap_suffix(word: str, rules, least: int) -> str:
    for suffix, replacement in rules:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + replacement if _measure(stem) >= least else word
    return word


def porter(word: str) -> str:
    """Porter stem of one lower-case word."""
    if len(word) <= 2:
        return word
    # 1a: plurals
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # 1b: past and progressive forms
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        ending = next((e for e in ("ed", "ing") if word.endswith(e)), None)
        if ending and _has_vowel(word[: -len(ending)]):
            word = word[: -len(ending)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _double_consonant(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short_end(word):
                word += "e"
    # 1c: final y
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _swap_suffix(word, _LONGEST_FIRST_2, 1)
    word = _swap_suffix(word, _LONGEST_FIRST_3, 1)
    # 4: one more suffix where enough is left
    for suffix in _LONGEST_FIRST_4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                word = stem
            break
    # 5: final e and double l
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def _stem_lists(lists: pa.Array, known: dict[str, str]) -> pa.Array:
    words = lists.flatten().dictionary_encode()
    stems = []
    for w in words.dictionary.to_pylist():
        stem = known.get(w)
        if stem is None:
            stem = porter(w)
            if len(known) < MOST_KNOWN:
                known[w] = stem
        stems.append(stem)
    # flatten() skips null lists, so offsets are rebuilt from the list lengths
    ends = pc.cumulative_sum(lists.value_lengths().fill_null(0))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
    return pa.ListArray.from_arrays(offsets, pa.array(stems, pa.string()).take(words.indices), mask=lists.is_null())


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stem_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    known: dict[str, str] = {}
    for lists in batches:
        parts = [_stem_lists(lists.slice(at, STRIPE_ROWS), known) for at in range(0, len(lists), STRIPE_ROWS)]
        yield pa.concat_arrays(parts) if parts else _stem_lists(lists, known)


# Declared non-deterministic only so that filters on stems are not moved below the stemming: there
# they would stem every row a second time, or end up in a join condition, which cannot run Python.
_porter_lists = _stem_batches.asNondeterministic()


def _plural(t: Column) -> Column:
    """Harman's (1991) S-stemmer: the first fitting rule decides."""
    return (
        F.when(t.rlike("(?:[^ea]|^)ies$"), F.regexp_replace(t, "ies$", "y"))
        .when(t.rlike("(?:[^aeo]|^)es$"), F.regexp_replace(t, "es$", "e"))
        .when(t.rlike("(?:[^us]|^)s$"), F.regexp_replace(t, "s$", ""))
        .otherwise(t)
    )


def stem_tokens(tokens: Column | str, algo: str = "porter") -> Column:
    """Stems of a word list, by "porter" or by the "plural" rules alone."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    if algo == "porter":
        return _porter_lists(c)
    if algo == "plural":
        return F.transform(c, _plural)
    raise ValueError(f"unknown stemmer {algo!r}")
