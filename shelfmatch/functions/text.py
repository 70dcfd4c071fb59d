"""Text functions: native column expressions, one row at a time, no shuffle and no Python.

Null text counts as the empty string throughout.
"""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.fixed_values import (
    ENGLISH_STOPWORDS,
    HTML_REMNANTS,
    PUNCTUATION,
    UNITS_BARE,
    UNITS_DOTTED,
)

UNIT_STYLES = {"dotted": UNITS_DOTTED, "bare": UNITS_BARE}
WHITESPACE = " \t\n\x0b\f\r"
# Up to this many shared terms are counted one by one; beyond it by sorting.
FEW_SHARED_TERMS = 16


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _by_first_letter(pattern: str) -> str:
    """The same alternatives with a shared first letter tried once: "foot|ft" as "f(?:oot|t)".

    Alternatives of different first letters never fit the same place, so their order is free.
    """
    groups: dict[str, list[str]] = {}
    for alternative in pattern.split("|"):
        groups.setdefault(alternative[0], []).append(alternative[1:])
    return "|".join(
        f"{first}(?:{'|'.join(rest)})" if len(rest) > 1 else first + rest[0]
        for first, rest in groups.items()
    )


def _needed(pattern: str) -> list[str]:
    """Plain texts of which one occurs wherever the pattern fits."""
    found: list[str] = []
    for alternative in sorted(pattern.split("|"), key=len):
        plain = alternative.rstrip(".")
        if not any(f in plain for f in found):
            found.append(plain)
    return found


def _replace_all(c: Column, rules) -> Column:
    """Apply ``(pattern, replacement)`` rules in order.

    Most rules do not fit most texts, and a plain search is far cheaper than a pattern, so a
    pattern only runs on texts that contain one of the words it needs. The rules are one constant
    array, which keeps the plan small.
    """
    entries = ", ".join(
        f"named_struct('needed', array({', '.join(map(_quoted, _needed(p)))}), "
        f"'pattern', {_quoted(_by_first_letter(p))}, 'to', {_quoted(to)})"
        for p, to in rules
    )
    return F.aggregate(
        F.expr(f"array({entries})"),
        c,
        lambda text, rule: F.when(
            F.exists(rule["needed"], lambda w: F.contains(text, w)),
            F.regexp_replace(text, rule["pattern"], rule["to"]),
        ).otherwise(text),
    )


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def to_double(c: Column | str) -> Column:
    """Number in a text, null where it is none."""
    return _col(c).try_cast("double")


def to_int(c: Column | str) -> Column:
    """Whole part of a number (towards zero)."""
    return _col(c).cast("int")


def lower_all(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.lower(_text(c)) for c in cols})


def strip_punct(c: Column | str) -> Column:
    """Drop ASCII punctuation except the hyphen."""
    return F.regexp_replace(_text(c), PUNCTUATION, "")


def strip_html_remnants(c: Column | str) -> Column:
    """Drop left-over HTML entities and tag pieces."""
    return _replace_all(_text(c), HTML_REMNANTS)


def normalize_units(c: Column | str, style: str = "bare", whole_words: bool = False) -> Column:
    """Replace spelled-out units of measure by abbreviations, rule after rule.

    The rules match inside words too ("lamps" becomes "lamp" in bare style); ``whole_words``
    restricts the alternatives that are words to whole words.
    """
    text, rules = _text(c), UNIT_STYLES[style]
    if not whole_words:
        return _replace_all(text, rules)
    for pattern, replacement in rules:
        words = [rf"\b{p}\b" if p[0].isalpha() else p for p in pattern.split("|")]
        text = F.regexp_replace(text, F.lit("|".join(words)), F.lit(replacement))
    return text


def clean(c: Column | str, style: str = "bare", order: str = "punctuation_first") -> Column:
    """Punctuation, HTML remnants and units in one expression.

    With ``punctuation_first`` the remnants that contain punctuation can no longer occur, so only
    the others are looked for. ``html_first`` looks for all of them before punctuation goes.
    """
    if order == "html_first":
        return normalize_units(strip_punct(strip_html_remnants(c)), style)
    if order != "punctuation_first":
        raise ValueError(f"unknown order {order!r}")
    reachable = [(p, to) for p, to in HTML_REMNANTS if p.isalpha()]
    return normalize_units(_replace_all(strip_punct(c), reachable), style)


def clean_text(
    df: DataFrame, cols: list[str], style: str = "bare", order: str = "punctuation_first"
) -> DataFrame:
    return df.withColumns({c: clean(c, style, order) for c in cols})


def tokenize(c: Column | str) -> Column:
    """Lower-cased words split at single whitespace characters.

    Empty words between two whitespace characters stay, those at the end go; the empty text is
    one empty word (as in ``ml.feature.Tokenizer``).
    """
    trimmed = F.rtrim(F.lower(_text(c)), F.lit(WHITESPACE))
    blank = (trimmed == "") & (_text(c) != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[ \t\n\x0B\f\r]")
    )


def stopwords(language: str = "english") -> list[str]:
    if language == "english":
        return ENGLISH_STOPWORDS
    return StopWordsRemover.loadDefaultStopWords(language)


def remove_stopwords(tokens: Column | str, language: str = "english") -> Column:
    """Drop stop words, whatever their case; empty words stay."""
    words = [w.lower() for w in stopwords(language)]
    return F.filter(_col(tokens), lambda t: ~F.lower(t).isin(words))


def join_tokens(tokens: Column | str) -> Column:
    return F.array_join(_col(tokens), " ")


def ngrams(tokens: Column | str, n: int = 1) -> Column:
    """Runs of ``n`` words joined by a space; none when there are fewer than ``n``."""
    t = _col(tokens)
    starts = F.sequence(F.lit(1), F.size(t) - (n - 1))
    return F.when(
        F.size(t) >= n, F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), " "))
    ).otherwise(F.array().cast("array<string>"))


def token_len(c: Column | str) -> Column:
    """Number of space-separated parts of a text; the empty text has one."""
    return F.size(F.split(_text(c), " "))


def token_count(tokens: Column | str) -> Column:
    """``token_len`` of the joined words, without joining them."""
    return F.greatest(F.size(_col(tokens)), F.lit(1))


def len_ratio(numerator: Column, denominator: Column) -> Column:
    return numerator.cast("double") / denominator.cast("double")


def trim_empty_tail(tokens: Column | str) -> Column:
    """Drop empty words at the end."""
    t = _col(tokens)
    last_full = F.array_position(F.transform(F.reverse(t), lambda x: x != ""), F.lit(True))
    kept = F.when(last_full == 0, F.lit(0)).otherwise(F.size(t) - last_full + 1)
    return F.when(F.try_element_at(t, F.lit(-1)) == "", F.slice(t, F.lit(1), kept.cast("int"))).otherwise(t)


def term_counts(tokens: Column | str) -> Column:
    """Distinct words of a row with their counts, ``array<struct<term, n>>`` in term order.

    Null words count nothing."""

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return let(
            starts,
            lambda b: F.transform(
                b,
                lambda p, k: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(b, k + 1), F.size(s)) - p).cast("long").alias("n"),
                ),
            ),
        )

    words = F.filter(_col(tokens), lambda w: w.isNotNull())
    none = F.array().cast("array<struct<term:string,n:bigint>>")
    return F.coalesce(let(F.sort_array(words), lambda s: F.when(F.size(s) > 0, runs(s))), none)


def _numbered(tokens: Column) -> Column:
    """Words with their occurrence number, so that repeated words become distinct."""
    return F.flatten(
        F.transform(
            term_counts(tokens),
            lambda e: F.transform(
                F.sequence(F.lit(1).cast("long"), e["n"]),
                lambda k: F.concat(e["term"], F.lit("\u0001"), k.cast("string")),
            ),
        )
    )


def common_terms(a: Column | str, b: Column | str) -> Column:
    """Size of the multiset intersection of two word lists.

    The distinct shared words are found by hashing. Few of them are counted directly; many are
    counted by giving every occurrence a number, so the cost stays near-linear for long texts.
    """

    def count(lists: Column) -> Column:
        x, y = lists[0], lists[1]

        def times(words: Column, t: Column) -> Column:
            return F.size(words) - F.size(F.array_remove(words, t))

        def counted(shared: Column) -> Column:
            one_by_one = F.aggregate(
                shared, F.lit(0), lambda n, t: n + F.least(times(x, t), times(y, t))
            )
            by_number = let(
                F.transform(lists, _numbered), lambda n: F.size(F.array_intersect(n[0], n[1]))
            )
            return F.when(F.size(shared) <= FEW_SHARED_TERMS, one_by_one).otherwise(by_number)

        return let(F.array_intersect(x, y), counted)

    return let(F.transform(F.array(_col(a), _col(b)), trim_empty_tail), count)


def phrase_hits(query: Column | str, title: Column | str, description: Column | str) -> Column:
    """How many of title and description contain the whole query; 0 for an empty query or title."""
    q, t, d = _text(query), _text(title), _text(description)
    return F.when((q == "") | (t == ""), F.lit(0)).otherwise(
        F.contains(t, q).cast("int") + F.contains(d, q).cast("int")
    )
