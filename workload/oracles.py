"""SQL for DuckDB that gives the result of each query independently: name -> text.

Each text is ``WITH`` building blocks, ``SELECT`` the result. Where it can, the SQL takes another
way than the Spark code: words as rows and joins instead of array functions, brute force instead of
indexes, closed forms instead of fitting.
"""

from __future__ import annotations

from shelfmatch.functions import fixed_values as fixed
from shelfmatch.functions.hashing import PRIME, hash_coefficients, unit_directions
from workload.tables import NEAR, near_plan

SPACES = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
SPACE_CLASS = r"[ \t\n\x0B\f\r]"
DIM = 64


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP = "[" + ", ".join(lit(w) for w in fixed.ENGLISH_STOPWORDS) + "]"


def rules(x: str, table) -> str:
    for pattern, to in table:
        x = f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"
    return x


def punct(x: str) -> str:
    return f"regexp_replace({x}, {lit(fixed.PUNCTUATION)}, '', 'g')"


def html(x: str) -> str:
    return rules(x, fixed.HTML_REMNANTS)


def units(x: str, style: str) -> str:
    return rules(x, fixed.UNITS_DOTTED if style == "dotted" else fixed.UNITS_BARE)


def clean(x: str, style: str) -> str:
    return units(html(punct(x)), style)


def split_words(x: str) -> str:
    end = f"rtrim(lower({x}), {SPACES})"
    return (
        f"CASE WHEN {end} = '' AND {x} <> '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split_regex({end}, {lit(SPACE_CLASS)}) END"
    )


def no_stop(x: str) -> str:
    return f"list_filter({x}, lambda w: NOT list_contains({STOP}, w))"


def words(x: str) -> str:
    return no_stop(split_words(x))


def with_(blocks: list[str], select: str) -> str:
    return "WITH " + ",\n".join(blocks) + "\n" + select


RATED = """rated AS (
  SELECT l.doc_id AS product_uid, d.text AS product_title, b.text AS search_term,
         CAST(1 + l.quality + (1 - l.toxic) AS VARCHAR) AS relevance
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id
  JOIN benchmark b ON b.item_id = l.doc_id % (SELECT count(*) FROM benchmark))"""
DESCRIPTIONS = """descriptions AS (
  SELECT d.doc_id AS product_uid, p.html AS product_description
  FROM documents d JOIN pages p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages))"""
ATTRIBUTES = """attributes AS (
  SELECT p_partkey AS product_uid, 'brand' AS name, p_brand AS value FROM part
  UNION ALL SELECT p_partkey, 'type', p_type FROM part)"""
PAIRS = [
    RATED,
    DESCRIPTIONS,
    ATTRIBUTES,
    """pairs AS (
  SELECT r.product_uid AS pair_id, r.product_title, r.search_term, s.product_description, a.value,
         r.relevance
  FROM rated r JOIN descriptions s ON s.product_uid = r.product_uid
  JOIN attributes a ON a.product_uid = r.product_uid AND a.name = 'brand')""",
]


def pair_words(style: str = "bare") -> list[str]:
    fields = [("title", "product_title"), ("query", "search_term"), ("descr", "product_description")]
    cleaned = ", ".join(f"{clean(f'lower({c})', style)} AS {n}" for n, c in fields)
    split = ", ".join(f"{words(n)} AS {n}" for n, _ in fields)
    return [
        *PAIRS,
        f"cleaned AS (SELECT pair_id, CAST(relevance AS DOUBLE) AS relevance, {cleaned} FROM pairs)",
        f"w AS (SELECT pair_id, relevance, {split} FROM cleaned)",
    ]


DOC_WORDS = f"dw AS (SELECT doc_id, {words('text')} AS words FROM documents)"
PASSAGE_WORDS = f"pw AS (SELECT item_id AS doc_id, {words('text')} AS words FROM benchmark)"

RATINGS = """cents AS (
  SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) % 201 AS c FROM orders),
ratings AS (
  SELECT o_orderkey,
         CAST(1 + c // 100 AS VARCHAR) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS relevance
  FROM cents)"""

VECTOR_PAIRS = """vp AS (
  SELECT a.vec_id AS pair_id, CAST(a.embedding AS DOUBLE[]) AS x, CAST(b.embedding AS DOUBLE[]) AS y
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
cells AS (SELECT pair_id, unnest(x) AS x, unnest(y) AS y FROM vp),
vs AS (
  SELECT pair_id, sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))) AS cosine,
         sqrt(sum((x - y) * (x - y))) AS euclidean
  FROM cells GROUP BY pair_id)"""


def counts(source: str, id_: str, col: str, name: str) -> str:
    """Word counts as rows: id, term, n."""
    return (
        f"{name} AS (SELECT {id_}, term, count(*) AS n FROM "
        f"(SELECT {id_}, unnest({col}) AS term FROM {source}) GROUP BY {id_}, term)"
    )


def jaccard_rows(left: str, right: str) -> str:
    """Jaccard distance of every pair of sets that share a term: tables of (id, term)."""
    return f"""sizes_a AS (SELECT id, count(*) AS n FROM {left} GROUP BY id),
sizes_b AS (SELECT id, count(*) AS n FROM {right} GROUP BY id),
shared AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS n
  FROM {left} a JOIN {right} b ON a.term = b.term GROUP BY a.id, b.id),
jaccards AS (
  SELECT s.id_a, s.id_b, 1 - s.n::DOUBLE / (x.n + y.n - s.n) AS distance
  FROM shared s JOIN sizes_a x ON x.id = s.id_a JOIN sizes_b y ON y.id = s.id_b)"""


SETS = [
    DOC_WORDS,
    PASSAGE_WORDS,
    "sa AS (SELECT doc_id AS id, unnest(list_distinct(words)) AS term FROM dw)",
    "sb AS (SELECT doc_id AS id, unnest(list_distinct(words)) AS term FROM pw)",
]
OWN_JACCARD = [
    *pair_words(),
    """own AS (
  SELECT w.pair_id, w.relevance, len(list_distinct(title)) AS nt, len(list_distinct(query)) AS nq,
         (SELECT count(*) FROM (SELECT unnest(list_distinct(title)) AS t) x
          JOIN (SELECT unnest(list_distinct(query)) AS q) y ON x.t = y.q) AS both_n
  FROM w),
oj AS (SELECT pair_id, relevance, 1 - both_n::DOUBLE / nullif(nt + nq - both_n, 0) AS distance FROM own)""",
]


# --- the Porter stemmer by patterns ---------------------------------------------------------------

_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
MEASURE_0 = f"^({_C})?{_V}{_C}"  # at least one vowel-consonant sequence
MEASURE_1 = f"^({_C})?{_V}{_C}({_V})?$"  # exactly one
MEASURE_2 = f"^({_C})?{_V}{_C}{_V}{_C}"  # at least two
HAS_VOWEL = f"^({_C})?[aeiouy]"
SHORT_END = f"^{_C}[aeiouy][^aeiouwxy]$"


def _stem(suffix: str) -> str:
    return f"left(s, length(s) - {len(suffix)})"


def _fits(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit(pattern)})"


def _suffix_step(table, pattern: str) -> str:
    parts = [
        f"WHEN ends_with(s, {lit(suffix)}) THEN CASE WHEN {_fits(_stem(suffix), pattern)} "
        f"THEN {_stem(suffix)} || {lit(to)} ELSE s END"
        for suffix, to in sorted(table, key=lambda r: -len(r[0]))
    ]
    return "CASE " + " ".join(parts) + " ELSE s END"


def porter_blocks(source: str, name: str) -> list[str]:
    """``name`` (term, stem) for the distinct words of ``source`` (term).

    A first y is written Y, so that the patterns take it for a consonant.
    """
    after_1b = (
        "CASE WHEN regexp_matches(s, '(at|bl|iz)$') THEN s || 'e' "
        "WHEN length(s) > 1 AND right(s, 1) = left(right(s, 2), 1) "
        f"AND {_fits('right(s, 1)', '[^aeiouylsz]')} THEN left(s, length(s) - 1) "
        f"WHEN {_fits('s', SHORT_END)} THEN s || 'e' ELSE s END"
    )
    step_4 = " ".join(
        f"WHEN ends_with(s, {lit(x)}) THEN CASE WHEN {_fits(_stem(x), MEASURE_2)}"
        + (f" AND {_fits(_stem(x), '[st]$')}" if x == "ion" else "")
        + f" THEN {_stem(x)} ELSE s END"
        for x in sorted(fixed.PORTER_STEP_4, key=lambda x: -len(x))
    )
    less_e = "left(s, length(s) - 1)"
    steps = [
        "CASE WHEN ends_with(s, 'sses') OR ends_with(s, 'ies') THEN left(s, length(s) - 2) "
        "WHEN ends_with(s, 's') AND NOT ends_with(s, 'ss') THEN left(s, length(s) - 1) ELSE s END",
        None,
        f"CASE WHEN ends_with(s, 'y') AND {_fits(less_e, HAS_VOWEL)} THEN {less_e} || 'i' ELSE s END",
        _suffix_step(fixed.PORTER_STEP_2, MEASURE_0),
        _suffix_step(fixed.PORTER_STEP_3, MEASURE_0),
        f"CASE {step_4} ELSE s END",
        f"CASE WHEN ends_with(s, 'e') AND ({_fits(less_e, MEASURE_2)} OR ({_fits(less_e, MEASURE_1)} "
        f"AND NOT {_fits(less_e, SHORT_END)})) THEN {less_e} ELSE s END",
        f"CASE WHEN ends_with(s, 'll') AND {_fits('s', MEASURE_2)} THEN left(s, length(s) - 1) ELSE s END",
    ]
    blocks = [
        f"{name}_0 AS (SELECT DISTINCT term, regexp_replace(term, '^y', 'Y') AS s FROM {source} "
        "WHERE length(term) > 2)"
    ]
    at = 0
    for step in steps:
        prev, at = f"{name}_{at}", at + 1
        if step:
            blocks.append(f"{name}_{at} AS (SELECT term, {step} AS s FROM {prev})")
            continue
        # step 1b: cut -ed and -ing, then mend what is left
        blocks.append(
            f"{name}_cut AS (SELECT term, s AS whole, CASE "
            f"WHEN ends_with(s, 'eed') THEN NULL "
            f"WHEN ends_with(s, 'ed') AND {_fits(_stem('ed'), HAS_VOWEL)} THEN {_stem('ed')} "
            f"WHEN ends_with(s, 'ing') AND {_fits(_stem('ing'), HAS_VOWEL)} THEN {_stem('ing')} "
            f"END AS s FROM {prev})"
        )
        blocks.append(
            f"{name}_{at} AS (SELECT term, CASE WHEN s IS NOT NULL THEN {after_1b} "
            f"WHEN ends_with(whole, 'eed') AND "
            f"{_fits('left(whole, length(whole) - 3)', MEASURE_0)} THEN left(whole, length(whole) - 1) "
            f"ELSE whole END AS s FROM {name}_cut)"
        )
    blocks.append(
        f"{name} AS (SELECT term, regexp_replace(s, '^Y', 'y') AS stem FROM {name}_{at} "
        f"UNION ALL SELECT DISTINCT term, term FROM {source} WHERE length(term) <= 2)"
    )
    return blocks


def stemmed_counts(fields: list[str]) -> list[str]:
    """Stems of the fields of ``w`` as rows: stems(pair_id, field, stem)."""
    union = " UNION ALL ".join(
        f"SELECT pair_id, '{f}' AS field, unnest({f}) AS term FROM w" for f in fields
    )
    return [
        *pair_words(),
        f"fw AS ({union})",
        *porter_blocks("fw", "porter"),
        "stems AS (SELECT pair_id, field, stem FROM fw JOIN porter USING (term))",
        """vocabulary AS (
  SELECT stem FROM stems WHERE field = 'title' GROUP BY stem HAVING count(DISTINCT pair_id) >= 5),
sc AS (SELECT pair_id, field, stem, count(*) AS n FROM stems JOIN vocabulary USING (stem)
  GROUP BY pair_id, field, stem)""",
    ]


def jaccard_judged(top: int | None, keep_unmatched: bool) -> list[str]:
    sides = []
    for f in ("title", "query"):
        limit = f"ORDER BY pair_id DESC LIMIT {top}" if top else ""
        sides.append(f"ids_{f} AS (SELECT DISTINCT pair_id FROM sc WHERE field = '{f}' {limit})")
    below = "" if keep_unmatched else "WHERE distance < 1"
    return [
        *stemmed_counts(["title", "query"]),
        *sides,
        f"""tq AS (
  SELECT pair_id, count(*) FILTER (t > 0 AND q > 0) AS both_n, count(*) AS either_n FROM (
    SELECT pair_id, stem, count(*) FILTER (field = 'title') AS t, count(*) FILTER (field = 'query') AS q
    FROM sc WHERE pair_id IN (SELECT pair_id FROM ids_title)
      AND pair_id IN (SELECT pair_id FROM ids_query) GROUP BY pair_id, stem)
  GROUP BY pair_id),
tj AS (SELECT pair_id, 1 - both_n::DOUBLE / either_n AS distance FROM tq),
judged AS (
  SELECT CASE WHEN distance > 0.95 THEN 0 ELSE 1 END AS prediction,
         CASE WHEN relevance >= 1.5 THEN 1 ELSE 0 END AS relevance
  FROM tj JOIN w USING (pair_id) {below})""",
    ]


def joined_judged(top: int) -> list[str]:
    """Titles and queries of one id that share a MinHash and a term."""
    side = lambda f: (
        f"SELECT pair_id AS id, stem AS term FROM sc WHERE field = '{f}' AND pair_id IN "
        f"(SELECT DISTINCT pair_id FROM sc WHERE field = '{f}' ORDER BY pair_id DESC LIMIT {top})"
    )
    return [
        *stemmed_counts(["title", "query"]),
        f"ta AS ({side('title')})", f"tb AS ({side('query')})",
        signatures("ta", "ha"), signatures("tb", "hb"),
        "cand AS (SELECT DISTINCT id FROM ha JOIN hb USING (id, band, h))",
        "na AS (SELECT id, count(*) AS a FROM ta GROUP BY id)", "nb AS (SELECT id, count(*) AS b FROM tb GROUP BY id)",
        "nc AS (SELECT id, count(*) AS c FROM ta JOIN tb USING (id, term) GROUP BY id)",
        """judged AS (
  SELECT CASE WHEN 1 - c::DOUBLE / (a + b - c) > 0.95 THEN 0 ELSE 1 END AS prediction,
         CASE WHEN relevance >= 1.5 THEN 1 ELSE 0 END AS relevance
  FROM cand JOIN na USING (id) JOIN nb USING (id) JOIN nc USING (id) JOIN w ON w.pair_id = id)""",
    ]


def euclid_judged(top: int | None, cut: float, below: str = "") -> list[str]:
    sides = []
    for f in ("title", "query"):
        limit = f"ORDER BY pair_id DESC LIMIT {top}" if top else ""
        sides.append(f"ids_{f} AS (SELECT DISTINCT pair_id FROM sc WHERE field = '{f}' {limit})")
    return [
        *stemmed_counts(["title", "query"]),
        *sides,
        f"""tq AS (
  SELECT pair_id, sqrt(sum((t - q) * (t - q))) AS distance FROM (
    SELECT pair_id, stem, coalesce(sum(n) FILTER (field = 'title'), 0) AS t,
           coalesce(sum(n) FILTER (field = 'query'), 0) AS q
    FROM sc WHERE pair_id IN (SELECT pair_id FROM ids_title)
      AND pair_id IN (SELECT pair_id FROM ids_query) GROUP BY pair_id, stem)
  GROUP BY pair_id),
judged AS (
  SELECT CASE WHEN distance > {cut} THEN 0 ELSE 1 END AS prediction,
         CASE WHEN relevance >= 1.5 THEN 1 ELSE 0 END AS relevance
  FROM tq JOIN w USING (pair_id) {below})""",
    ]


METRICS = """, f AS (
  SELECT sum(CASE WHEN prediction = 1 AND relevance = 1 THEN 1.0::DOUBLE ELSE 0 END) AS tp,
         sum(CASE WHEN prediction = 0 AND relevance = 0 THEN 1.0::DOUBLE ELSE 0 END) AS tn,
         sum(CASE WHEN prediction = 1 AND relevance = 0 THEN 1.0::DOUBLE ELSE 0 END) AS fp,
         sum(CASE WHEN prediction = 0 AND relevance = 1 THEN 1.0::DOUBLE ELSE 0 END) AS fn FROM judged),
g AS (SELECT *, tp / nullif(tp + fn, 0) AS r, tp / nullif(tp + fp, 0) AS p FROM f)
SELECT tp AS "TP", tn AS "TN", fp AS "FP", fn AS "FN",
       round((tp + tn) / nullif(tp + tn + fp + fn, 0), 6) AS accuracy, round(r, 6) AS recall,
       round(p, 6) AS precision, round(2 * (r * p) / nullif(r + p, 0), 6) AS f1 FROM g"""


def metrics(blocks: list[str]) -> str:
    return "WITH " + ",\n".join(blocks) + METRICS


JUDGED_HIGH = [
    *OWN_JACCARD,
    """judged AS (
  SELECT pair_id, CASE WHEN distance > 0.95 THEN 0 ELSE 1 END AS prediction,
         CASE WHEN relevance >= 2.5 THEN 1 ELSE 0 END AS relevance FROM oj)""",
]

FEATURE_NAMES = [
    "product_title_len", "search_term_len", "product_description_len",
    "ratio_desc_len_search_len", "ratio_title_len_search_len", "common_words_ST", "common_words_SD",
]


def shared_words(a: str, b: str, name: str) -> str:
    """Multiset overlap of two word-list columns of ``w``, by counting words as rows.

    Empty words at the end of a list do not count.
    """
    def side(c: str) -> str:
        full = f"rtrim(array_to_string({c}, ' '), ' ')"
        return (
            f"(SELECT pair_id, term, count(*) AS n FROM (SELECT pair_id, unnest(CASE WHEN {full} = '' "
            f"THEN CAST([] AS VARCHAR[]) ELSE string_split({full}, ' ') END) AS term FROM w) "
            "GROUP BY pair_id, term)"
        )

    return (
        f"{name} AS (SELECT pair_id, sum(least(x.n, y.n)) AS n FROM {side(a)} x "
        f"JOIN {side(b)} y USING (pair_id, term) GROUP BY pair_id)"
    )


def features(style: str = "dotted") -> list[str]:
    return [
        *pair_words(style),
        shared_words("query", "title", "st"),
        shared_words("query", "descr", "sd"),
        """sizes AS (
  SELECT pair_id, relevance, greatest(len(title), 1)::DOUBLE AS t, greatest(len(query), 1)::DOUBLE AS q,
         greatest(len(descr), 1)::DOUBLE AS d FROM w),
feat AS (
  SELECT s.pair_id, relevance, t AS product_title_len, q AS search_term_len,
         d AS product_description_len, d / q AS ratio_desc_len_search_len,
         t / q AS ratio_title_len_search_len, coalesce(st.n, 0)::DOUBLE AS "common_words_ST",
         coalesce(sd.n, 0)::DOUBLE AS "common_words_SD"
  FROM sizes s LEFT JOIN st USING (pair_id) LEFT JOIN sd USING (pair_id))""",
    ]


FEATURE_ROWS = "fr AS (" + " UNION ALL ".join(
    f'SELECT pair_id, relevance, {i} AS pos, \'{n}\' AS feature, "{n}" AS x FROM feat'
    for i, n in enumerate(FEATURE_NAMES)
) + ")"


def share(key: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 7))::BIGINT / 268435456.0::DOUBLE)"


def classes(name_cuts: dict) -> str:
    cols = ", ".join(
        "CAST("
        + "CASE "
        + " ".join(f"WHEN r >= {c} THEN {i}" for i, c in reversed(list(enumerate(cuts, 1))))
        + f" ELSE 0 END AS DOUBLE) AS {n}"
        for n, cuts in name_cuts.items()
    )
    return (
        f"WITH {RATINGS} SELECT o_orderkey, {cols} "
        "FROM (SELECT o_orderkey, CAST(relevance AS DOUBLE) AS r FROM ratings)"
    )


def doubles(xs: list[float]) -> str:
    return "[" + ", ".join(repr(x) for x in xs) + "]::DOUBLE[]"


def dot_rows(source: str, col: str, n: int, length: float) -> str:
    """``buckets(id, band, bucket)`` of a vector column along the random directions."""
    directions = " UNION ALL ".join(
        f"SELECT {i} AS band, {doubles(d)} AS u" for i, d in enumerate(unit_directions(n, DIM))
    )
    return (
        f"SELECT id, band, CAST(floor(list_sum(list_transform(list_zip({col}, u), "
        f"lambda z: z[1]::DOUBLE * z[2])) / {length}) AS BIGINT) AS bucket "
        f"FROM {source}, ({directions})"
    )


CENTRES = f"""eb AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
means AS (SELECT label, pos, round(avg(x), 6) AS m FROM
  (SELECT label, unnest(v) AS x, unnest(range({DIM})) AS pos FROM eb) GROUP BY label, pos),
centres AS (SELECT label::BIGINT AS id, list(m ORDER BY pos) AS v FROM means GROUP BY label),
dist AS (
  SELECT a.id AS id_a, b.id AS id_b,
         sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS euclidean,
         1 - list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))
           / (sqrt(list_sum(list_transform(a.v, lambda z: z * z))) * sqrt(list_sum(list_transform(b.v, lambda z: z * z)))) AS cosine
  FROM eb a, centres b)"""


MOVED = """mv AS (
  SELECT a.id, list_transform(list_zip(a.v, b.v), lambda z: z[1] + (1 + a.id % 10) / 10 * z[2]) AS v
  FROM eb a JOIN eb b ON b.id = a.id + 1),
md AS (
  SELECT a.id AS id_a, b.id AS id_b,
         sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance
  FROM eb a, mv b)"""


def planned_pairs() -> str:
    """Pairs whose buckets of a table differ by one in a few projections at most."""
    plan = near_plan()
    rows = lambda source: (
        f"SELECT id, band // {plan.per_table} AS t, list(bucket ORDER BY band) AS b "
        f"FROM ({dot_rows(source, 'v', plan.per_table * plan.tables, plan.bucket_length)}) GROUP BY ALL"
    )
    return (
        f"WITH {CENTRES}, {MOVED}, ta AS ({rows('eb')}), tb AS ({rows('mv')}), "
        "steps AS (SELECT ta.id AS id_a, tb.id AS id_b, "
        "list_transform(list_zip(ta.b, tb.b), lambda z: abs(z[1] - z[2])) AS step FROM ta JOIN tb USING (t)), "
        "cand AS (SELECT DISTINCT id_a, id_b FROM steps "
        f"WHERE list_max(step) <= 1 AND list_sum(step) <= {plan.flips}) "
        "SELECT id_a, id_b, round(distance, 6) AS distance FROM md JOIN cand USING (id_a, id_b) "
        f"WHERE distance < {NEAR}"
    )


def signatures(source: str, name: str, n: int = 5) -> str:
    values = " UNION ALL ".join(
        f"SELECT {i} AS band, {a} AS a, {b} AS b" for i, (a, b) in enumerate(hash_coefficients(n))
    )
    return (
        f"{name} AS (SELECT id, band, min(((1 + t) * a + b) % {PRIME}) AS h FROM "
        f"(SELECT id, ('0x' || substr(md5(term), 1, 7))::BIGINT AS t FROM {source}), ({values}) "
        "GROUP BY id, band)"
    )


def list_words(x: str, name: str) -> str:
    return f"SELECT doc_id, array_to_string({x}, '|') AS {name}"


def _plural(t: str) -> str:
    return (
        f"CASE WHEN regexp_matches({t}, '([^ea]|^)ies$') THEN regexp_replace({t}, 'ies$', 'y') "
        f"WHEN regexp_matches({t}, '([^aeo]|^)es$') THEN regexp_replace({t}, 'es$', 'e') "
        f"WHEN regexp_matches({t}, '([^us]|^)s$') THEN regexp_replace({t}, 's$', '') ELSE {t} END"
    )


def naive_bayes_sql() -> str:
    """Multinomial naive Bayes with smoothing 1, written out."""
    return with_(
        [
            *features(),
            FEATURE_ROWS,
            f"""scaled AS (
  SELECT pair_id, CASE WHEN relevance >= 1.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, pos,
         CASE WHEN max(abs(x)) OVER (PARTITION BY pair_id) = 0 THEN x
              ELSE x / max(abs(x)) OVER (PARTITION BY pair_id) END AS x,
         {share('pair_id')} < 0.6 AS training FROM fr),
rows_c AS (SELECT label, count(DISTINCT pair_id) AS n FROM scaled WHERE training GROUP BY label),
priors AS (SELECT label, ln(n + 1.0::DOUBLE) - ln((SELECT sum(n) FROM rows_c) + (SELECT count(*) FROM rows_c)) AS p
  FROM rows_c),
sums AS (SELECT label, pos, sum(x) AS s FROM scaled WHERE training GROUP BY label, pos),
theta AS (SELECT label, pos, ln(s + 1) - ln(sum(s) OVER (PARTITION BY label) + {len(FEATURE_NAMES)}) AS t FROM sums),
scores AS (
  SELECT c.pair_id, c.label, t.label AS prediction, any_value(p.p) + sum(c.x * t.t) AS score
  FROM scaled c JOIN theta t ON t.pos = c.pos JOIN priors p ON p.label = t.label
  WHERE NOT c.training GROUP BY c.pair_id, c.label, t.label)""",
        ],
        "SELECT pair_id, any_value(label) AS label, arg_max(prediction, score) AS prediction "
        "FROM scores GROUP BY pair_id",
    )


def split_blocks(y: str) -> list[str]:
    """``best``: the one cut of the training rows that leaves the least variance of ``y``."""
    return [
        *features(),
        FEATURE_ROWS,
        f"tr AS (SELECT *, {y} AS y, {share('pair_id')} < 0.6 AS training FROM fr)",
        "byx AS (SELECT pos, x, count(*) AS n, sum(y) AS s FROM tr WHERE training GROUP BY pos, x)",
        """cum AS (
  SELECT pos, x, lead(x) OVER up AS after, sum(n) OVER up AS nl, sum(s) OVER up AS sl,
         sum(n) OVER (PARTITION BY pos) AS nt, sum(s) OVER (PARTITION BY pos) AS st
  FROM byx WINDOW up AS (PARTITION BY pos ORDER BY x))""",
        """best AS (
  SELECT pos, (x + after) / 2 AS cut, sl / nl AS low, (st - sl) / (nt - nl) AS high FROM cum
  WHERE after IS NOT NULL ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, pos, x LIMIT 1)""",
    ]


def split_sql() -> str:
    return with_(
        split_blocks("relevance"),
        "SELECT pair_id, relevance, round(CASE WHEN x <= cut THEN low ELSE high END, 6) AS prediction "
        "FROM tr JOIN best USING (pos) WHERE NOT training",
    )


def class_split_sql() -> str:
    """Labels numbered by how often they occur; the more frequent one of a side is predicted."""
    high = "CASE WHEN relevance >= 2.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return with_(
        [
            *split_blocks(high),
            "named AS (SELECT CASE WHEN y = 1 THEN 'high' ELSE 'low' END AS label, count(*) AS n FROM tr "
            "WHERE training AND pos = 0 GROUP BY ALL)",
            "numbered AS (SELECT label, (row_number() OVER (ORDER BY n DESC, label) - 1)::DOUBLE AS number FROM named)",
            "told AS (SELECT pair_id, CASE WHEN y = 1 THEN 'high' ELSE 'low' END AS label, "
            "CASE WHEN x <= cut THEN low ELSE high END AS p FROM tr JOIN best USING (pos) WHERE NOT training)",
            "guess AS (SELECT *, CASE WHEN p > 0.5 OR (p = 0.5 AND (SELECT number FROM numbered WHERE label = 'high') = 0) "
            "THEN 'high' ELSE 'low' END AS predicted_label FROM told)",
        ],
        "SELECT pair_id, label, a.number AS indexed_label, b.number AS prediction, predicted_label "
        "FROM guess JOIN numbered a USING (label) JOIN numbered b ON b.label = predicted_label",
    )


def shares_sql(y: str, more: str = "", extra: str = "") -> str:
    """Means of ``y`` over the training rows, weighted by each feature."""
    rows = f"(SELECT *, {y} AS target FROM tr{extra} WHERE training)"
    return (
        f"SELECT feature, round(sum(target * x) / sum(x), 3) AS share{more} FROM {rows} GROUP BY ALL "
        f"UNION ALL SELECT '(intercept)', round(avg(target), 3){more} FROM {rows} WHERE pos = 0 GROUP BY ALL"
    )


def ridge_blocks(reg: float) -> list[str]:
    """``beta(pos, b)`` of a ridge regression by its normal equations: covariances of the training
    rows, a penalty in proportion to each variance, and elimination of one feature after another."""
    n = len(FEATURE_NAMES)
    steps = [
        f"""s{k + 1} AS MATERIALIZED (
  SELECT a.i, a.j, CASE WHEN p.v = 0 THEN a.v WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v
  FROM s{k} a JOIN s{k} c ON c.i = a.i AND c.j = {k} JOIN s{k} r ON r.i = {k} AND r.j = a.j
  JOIN s{k} p ON p.i = {k} AND p.j = {k})"""
        for k in range(n)
    ]
    return [
        *features(),
        FEATURE_ROWS,
        f"tr AS MATERIALIZED (SELECT *, {share('pair_id')} < 0.6 AS training FROM fr)",
        "mom AS (SELECT pos, avg(x) AS m FROM tr WHERE training GROUP BY pos)",
        "lab AS (SELECT avg(relevance) AS m, stddev_pop(relevance) AS sd FROM tr WHERE training AND pos = 0)",
        f"""cov AS (
  SELECT a.pos AS i, b.pos AS j, covar_pop(a.x, b.x) AS v FROM tr a JOIN tr b USING (pair_id)
  WHERE a.training GROUP BY a.pos, b.pos
  UNION ALL SELECT pos, {n}, covar_pop(x, relevance) FROM tr WHERE training GROUP BY pos)""",
        f"s0 AS MATERIALIZED (SELECT i, j, CASE WHEN i = j THEN v * (1 + {reg} / lab.sd) ELSE v END AS v FROM cov, lab)",
        *steps,
        f"beta AS (SELECT i AS pos, v AS b FROM s{n} WHERE j = {n})",
    ]


def ridge_sql(reg: float) -> str:
    return with_(
        ridge_blocks(reg),
        "SELECT pair_id, any_value(relevance) AS relevance, round(any_value(lab.m) + sum((x - mom.m) * b), 6) "
        "AS prediction FROM tr JOIN mom USING (pos) JOIN beta USING (pos), lab WHERE NOT training GROUP BY pair_id",
    )


def selected_sql(scores: list[str]) -> str:
    """The five features of highest ``scores(feature, score)``, in their order."""
    return with_(
        [*features(), FEATURE_ROWS, *scores,
         "places AS (SELECT DISTINCT feature, pos AS place FROM fr)",
         "best AS (SELECT feature, place FROM scores JOIN places USING (feature) "
         "ORDER BY score DESC NULLS LAST, place LIMIT 5)",
         "kept AS (SELECT feature, row_number() OVER (ORDER BY place) - 1 AS pos FROM best)"],
        "SELECT pair_id, CAST(kept.pos AS BIGINT) AS pos, round(x, 6) AS x FROM fr JOIN kept USING (feature)",
    )


CHI2 = [
    "o AS (SELECT feature, x, relevance AS c, count(*)::DOUBLE AS n FROM fr GROUP BY feature, x, relevance)",
    "rx AS (SELECT feature, x, sum(n) AS n FROM o GROUP BY feature, x)",
    "cx AS (SELECT feature, c, sum(n) AS n FROM o GROUP BY feature, c)",
    "tx AS (SELECT feature, sum(n) AS n FROM o GROUP BY feature)",
    "grid AS (SELECT rx.feature, rx.x, cx.c, rx.n * cx.n / tx.n AS e FROM rx JOIN cx USING (feature) "
    "JOIN tx USING (feature))",
    """chi2 AS (
  SELECT feature, sum((coalesce(o.n, 0) - e) * (coalesce(o.n, 0) - e) / e) AS statistic,
         CAST((count(DISTINCT grid.x) - 1) * (count(DISTINCT grid.c) - 1) AS BIGINT) AS dof
  FROM grid LEFT JOIN o USING (feature, x, c) GROUP BY feature)""",
]


def isotonic_blocks() -> list[str]:
    """The least-squares rising fit at a point is the largest, over starts before it, of the
    smallest, over ends after it, mean of the labels between start and end."""
    return [
            *features(),
            f"tr AS (SELECT pair_id, relevance, product_title_len AS x FROM feat WHERE {share('pair_id')} < 0.6)",
            """pts AS (SELECT x, sum(relevance) AS s, count(*) AS n,
    row_number() OVER (ORDER BY x) AS i FROM tr GROUP BY x),
cum AS (SELECT x, i, sum(s) OVER (ORDER BY i) AS cs, sum(n) OVER (ORDER BY i) AS cn, s, n FROM pts),
means AS (SELECT a.i AS j, b.i AS k, (b.cs - a.cs + a.s) / (b.cn - a.cn + a.n) AS m
  FROM cum a JOIN cum b ON a.i <= b.i),
low AS (SELECT j, k AS i, min(m) OVER (PARTITION BY j ORDER BY k DESC) AS m FROM means),
fit AS (SELECT i, max(m) AS prediction FROM low GROUP BY i)""",
    ]


def embedded(source: str, id_: str, col: str, name: str) -> str:
    """Mean word vectors as rows: id, pos, x."""
    return f"""{name}_t AS MATERIALIZED (
  SELECT {id_}, ('0x' || substr(md5(term), 1, 7))::BIGINT % n_vectors AS vec_id, sum(times) AS times
  FROM (SELECT {id_}, term, count(*) AS times FROM
    (SELECT {id_}, unnest({col}) AS term FROM {source}) GROUP BY {id_}, term),
    (SELECT count(*) AS n_vectors FROM embeddings)
  GROUP BY ALL),
{name}_n AS MATERIALIZED (SELECT {id_}, len({col}) AS n FROM {source}),
{name} AS (SELECT t.{id_}, c.pos, sum(c.x * t.times / n.n) AS x
  FROM {name}_t t JOIN {name}_n n ON n.{id_} = t.{id_} JOIN cells c ON c.vec_id = t.vec_id
  GROUP BY t.{id_}, c.pos)"""


EMBEDDING_CELLS = f"""cells AS MATERIALIZED (
  SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range({DIM})) AS pos FROM embeddings)"""


def cosine_sql() -> str:
    return metrics(
        [
            *pair_words(),
            EMBEDDING_CELLS,
            embedded("w", "pair_id", "title", "et"),
            embedded("w", "pair_id", "query", "eq"),
            """cs AS (
  SELECT pair_id, sum(et.x * eq.x) / nullif(sqrt(sum(et.x * et.x)) * sqrt(sum(eq.x * eq.x)), 0) AS c
  FROM et JOIN eq USING (pair_id, pos) GROUP BY pair_id),
judged AS (SELECT CASE WHEN c >= 0.6 THEN 1 ELSE 0 END AS prediction,
    CASE WHEN relevance >= 2.0 THEN 1 ELSE 0 END AS relevance
  FROM cs JOIN w USING (pair_id) WHERE c IS NOT NULL)""",
        ]
    )


def oracle_sql() -> dict[str, str]:
    doc = [DOC_WORDS]
    feat = features()
    return {
        "csv_scan": with_(
            PAIRS,
            "SELECT CAST(pair_id AS VARCHAR) AS product_uid, md5(product_title) AS title_md5, "
            "md5(search_term) AS query_md5, md5(product_description) AS desc_md5, value, relevance FROM pairs",
        ),
        "parquet_round_trip": with_(
            [RATED],
            "SELECT product_uid, md5(product_title) AS title_md5, search_term, relevance FROM rated",
        ),
        "model_round_trip": with_(
            [*doc, counts("dw", "doc_id", "words", "c"),
             "v AS (SELECT term FROM c GROUP BY term HAVING count(*) >= 5)"],
            "SELECT dw.doc_id, count(v.term) AS n_terms, CAST(coalesce(sum(c.n) FILTER (v.term IS NOT NULL), 0) "
            "AS BIGINT) AS n_words FROM dw LEFT JOIN c ON c.doc_id = dw.doc_id "
            "LEFT JOIN v ON v.term = c.term GROUP BY dw.doc_id",
        ),
        "attribute_filter": "SELECT p_partkey AS product_uid, p_brand AS value FROM part",
        "prefix_columns": "SELECT p_partkey, p_name AS title_p_name, p_brand AS title_p_brand, "
        "CAST(p_size AS BIGINT) AS title_p_size FROM part",
        "pair_id": "SELECT md5(concat(l_orderkey, chr(1), l_linenumber, chr(1), l_partkey)) AS pair_id, "
        "l_orderkey, l_partkey FROM lineitem",
        "unpivot_fields": with_(
            PAIRS,
            " UNION ALL ".join(
                f"SELECT pair_id, '{c}' AS field, {c} AS text FROM pairs"
                for c in ("product_title", "search_term", "product_description", "value")
            ),
        ),
        "pivot_fields": with_(
            PAIRS,
            "SELECT pair_id, product_title, search_term, product_description, value FROM pairs",
        ),
        "drop_invalid": "SELECT l_orderkey, l_partkey, round(l_discount / l_tax, 6) AS ratio "
        "FROM lineitem WHERE l_tax <> 0",
        "non_empty_vectors": with_(
            [*doc, PASSAGE_WORDS, counts("dw", "doc_id", "words", "c"),
             "v AS (SELECT term FROM c GROUP BY term HAVING count(*) >= 5)",
             "b AS (SELECT doc_id, words, 1 AS side FROM pw UNION ALL SELECT doc_id, words, 2 FROM dw)",
             "bt AS (SELECT DISTINCT side, doc_id, term FROM (SELECT side, doc_id, unnest(words) AS term FROM b))"],
            "SELECT doc_id, count(*) AS n_terms FROM bt JOIN v USING (term) GROUP BY side, doc_id",
        ),
        "number_casts": f"WITH {RATINGS}, b AS (SELECT o_orderkey AS id, relevance FROM ratings "
        "UNION ALL SELECT p_partkey, p_brand FROM part) "
        "SELECT id, relevance, TRY_CAST(relevance AS DOUBLE) AS number, "
        "CAST(trunc(TRY_CAST(relevance AS DOUBLE)) AS BIGINT) AS whole FROM b",
        "consolidate_join": "SELECT l_partkey AS product_uid, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
        "p_name AS product_description, p_brand AS value FROM lineitem JOIN part ON p_partkey = l_partkey",
        "consolidate_join_split": "SELECT l_partkey AS product_uid, l_orderkey, CAST(l_linenumber AS BIGINT) AS "
        "l_linenumber, p_name AS product_description, unnest([p_brand, p_type]) AS value "
        "FROM lineitem JOIN part ON p_partkey = l_partkey",
        "rated_pairs": with_(PAIRS, "SELECT * FROM pairs"),
        "jaccard_own_pairs": with_(
            OWN_JACCARD,
            "SELECT pair_id AS id_a, pair_id AS id_b, round(distance, 6) AS distance FROM oj WHERE distance < 0.99",
        ),
        "jaccard_join": with_(
            [*SETS, jaccard_rows("sa", "sb"), signatures("sa", "ha"), signatures("sb", "hb"),
             "cand AS (SELECT DISTINCT ha.id AS id_a, hb.id AS id_b FROM ha JOIN hb USING (band, h))"],
            "SELECT id_a, id_b, round(distance, 6) AS distance FROM jaccards JOIN cand USING (id_a, id_b) "
            "WHERE distance < 0.95",
        ),
        "jaccard_join_exact": with_(
            [*SETS, jaccard_rows("sa", "sb")],
            "SELECT id_a, id_b, round(distance, 6) AS distance FROM jaccards WHERE distance < 0.95",
        ),
        "jaccard_join_close": with_(
            [*SETS, jaccard_rows("sa", "sa")],
            "SELECT id_a, id_b, round(distance, 6) AS distance FROM jaccards WHERE distance < 0.3",
        ),
        "jaccard_join_banded": with_(
            [*SETS, jaccard_rows("sa", "sa"), signatures("sa", "ha", 10),
             "hb AS (SELECT id, band // 2 AS band, string_agg(CAST(h AS VARCHAR), ',' ORDER BY band) AS h "
             "FROM ha GROUP BY id, band // 2)",
             "cand AS (SELECT DISTINCT x.id AS id_a, y.id AS id_b FROM hb x JOIN hb y USING (band, h))"],
            "SELECT id_a, id_b, round(distance, 6) AS distance FROM jaccards JOIN cand USING (id_a, id_b) "
            "WHERE distance < 0.3",
        ),
        "euclidean_join_close": f"WITH {CENTRES}, ba AS ({dot_rows('eb', 'v', 32, 0.125)}), "
        "bt AS (SELECT id, band // 4 AS band, string_agg(CAST(bucket AS VARCHAR), ',' ORDER BY band) AS bucket "
        "FROM ba GROUP BY id, band // 4), "
        "cand AS (SELECT DISTINCT x.id AS id_a, y.id AS id_b FROM bt x JOIN bt y USING (band, bucket)) "
        "SELECT id_a, id_b, round(distance, 6) AS distance FROM (SELECT id_a, id_b, "
        "sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance "
        "FROM cand JOIN eb a ON a.id = id_a JOIN eb b ON b.id = id_b) WHERE distance < 1.2",
        "euclidean_own_pairs": f"WITH {VECTOR_PAIRS} SELECT pair_id AS id_a, pair_id AS id_b, "
        "round(euclidean, 6) AS distance FROM vs WHERE euclidean < 1.4",
        "euclidean_join": f"WITH {CENTRES}, ba AS ({dot_rows('eb', 'v', 3, 2.0)}), "
        f"bb AS ({dot_rows('centres', 'v', 3, 2.0)}), "
        "cand AS (SELECT DISTINCT ba.id AS id_a, bb.id AS id_b FROM ba JOIN bb USING (band, bucket)) "
        "SELECT id_a, id_b, round(euclidean, 6) AS distance FROM dist JOIN cand USING (id_a, id_b) "
        "WHERE euclidean < 1000",
        "distance_join_exact": f"WITH {CENTRES} SELECT id_a, id_b, round(euclidean, 6) AS distance "
        "FROM dist WHERE euclidean < 0.99",
        "cosine_join_exact": f"WITH {CENTRES} SELECT id_a, id_b, round(cosine, 6) AS distance "
        "FROM dist WHERE cosine < 0.85",
        "radius_join": f"WITH {CENTRES} SELECT id_a, id_b, round(distance, 6) AS distance FROM (SELECT "
        "a.id AS id_a, b.id AS id_b, sqrt(list_sum(list_transform(list_zip(a.v, b.v), "
        "lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance FROM eb a, eb b) WHERE distance < 1.05",
        "radius_join_cosine": f"WITH {CENTRES} SELECT id_a, id_b, round(cosine, 6) AS distance "
        "FROM dist WHERE cosine < 0.85",
        "euclidean_join_planned": planned_pairs(),
        "radius_join_moved": f"WITH {CENTRES}, {MOVED} SELECT id_a, id_b, round(distance, 6) AS distance "
        f"FROM md WHERE distance < {NEAR}",
        "term_model": with_(
            [*doc, counts("dw", "doc_id", "words", "c"),
             "v AS (SELECT term, sum(n) AS tf, count(*) AS df FROM c GROUP BY term HAVING count(*) >= 5)"],
            "SELECT doc_id, term, n, tf::BIGINT AS tf, df FROM c JOIN v USING (term)",
        ),
        "tfidf_fields": with_(
            [*pair_words(),
             "f AS (SELECT pair_id, 'title' AS field, unnest(title) AS term FROM w UNION ALL "
             "SELECT pair_id, 'query', unnest(query) FROM w UNION ALL SELECT pair_id, 'desc', unnest(descr) FROM w)",
             "c AS (SELECT pair_id, field, term, count(*) AS tf FROM f GROUP BY ALL)",
             "v AS (SELECT term, count(*) AS df FROM c WHERE field = 'title' GROUP BY term)"],
            "SELECT pair_id, field, term, tf, round(tf * ln(((SELECT count(*) FROM w) + 1.0::DOUBLE) / "
            "(coalesce(df, 0) + 1.0::DOUBLE)), 6) AS weight FROM c LEFT JOIN v USING (term)",
        ),
        "word_ppmi": with_(
            [*pair_words(),
             "t AS (SELECT pair_id, unnest(title) AS term, generate_subscripts(title, 1) AS pos FROM w)",
             "near AS (SELECT x.term AS word, y.term AS context, count(*) AS n FROM t x JOIN t y "
             "ON x.pair_id = y.pair_id AND abs(x.pos - y.pos) BETWEEN 1 AND 2 GROUP BY x.term, y.term)",
             "often AS (SELECT word FROM near GROUP BY word HAVING sum(n) >= 5)",
             "kept AS (SELECT * FROM near WHERE word IN (FROM often) AND context IN (FROM often))",
             "s AS (SELECT word, sum(n)::DOUBLE AS n_word FROM kept GROUP BY word)",
             "p AS (SELECT kept.word, kept.context, n, ln(n * (SELECT sum(n_word) FROM s) / (a.n_word * b.n_word)) AS ppmi "
             "FROM kept JOIN s a ON a.word = kept.word JOIN s b ON b.word = kept.context)"],
            "SELECT word, context, n, round(ppmi, 6) AS ppmi FROM p WHERE ppmi > 0",
        ),
        "drop_singletons": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey "
        "FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1",
        "dedupe_pairs": "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem",
        "term_stats": with_(
            [*doc, counts("dw", "doc_id", "words", "c")],
            "SELECT term, CAST(sum(n) AS BIGINT) AS tf, count(*) AS df FROM c GROUP BY term",
        ),
        "rank_pairs": with_(
            OWN_JACCARD,
            "SELECT pair_id, round(distance, 6) AS score FROM oj ORDER BY score DESC, pair_id",
        ),
        "top_k": "SELECT p_partkey, p_name FROM part ORDER BY p_partkey DESC LIMIT 500",
        "split_by_key": f"SELECT o_orderkey, CASE WHEN {share('o_orderkey')} < 0.6 THEN 'train' ELSE 'test' END "
        "AS part FROM orders",
        "ranked_orders": "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders",
        "dense_ids": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, "
        "row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_id FROM lineitem",
        "split_by_quota": "SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus "
        "ORDER BY md5('42:' || o_orderkey), o_orderkey::VARCHAR) <= floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.6 + 0.5) "
        "THEN 'train' ELSE 'test' END AS part FROM orders",
        "lower_all": "SELECT doc_id, lower(text) AS text FROM documents",
        "strip_punct": f"SELECT doc_id, {punct('text')} AS text FROM documents",
        "strip_html": f"SELECT page_id, {html('html')} AS text FROM pages",
        "units_dotted": f"SELECT doc_id, {units('lower(text)', 'dotted')} AS text FROM documents",
        "units_bare": f"SELECT doc_id, {units('lower(text)', 'bare')} AS text FROM documents",
        "clean_text": f"SELECT doc_id, {clean('lower(text)', 'dotted')} AS text FROM documents",
        "clean_html": f"SELECT page_id, {clean('lower(html)', 'bare')} AS text, "
        f"{units(punct(html('lower(html)')), 'bare')} AS html_first FROM pages",
        "tokenize": f"SELECT doc_id, array_to_string({split_words('text')}, '|') AS words, "
        f"len({split_words('text')}) AS n_words FROM documents",
        "remove_stopwords": with_(
            doc, "SELECT doc_id, array_to_string(words, '|') AS words, len(words) AS n_words FROM dw"
        ),
        "join_tokens": with_(doc, "SELECT doc_id, array_to_string(words, ' ') AS text FROM dw"),
        "ngrams": with_(
            [*doc, "g AS (SELECT doc_id, list_transform(range(1, len(words)), "
             "lambda i: words[i] || ' ' || words[i + 1]) AS grams FROM dw)"],
            "SELECT doc_id, array_to_string(grams, '|') AS grams, len(grams) AS n_grams FROM g",
        ),
        "stem_rules": with_(
            doc,
            f"SELECT doc_id, array_to_string(list_transform(words, lambda t: {_plural('t')}), '|') AS stems FROM dw",
        ),
        "stem_porter": with_(
            [*doc,
             "t AS (SELECT doc_id, unnest(words) AS term, generate_subscripts(words, 1) AS pos FROM dw)",
             *porter_blocks("t", "porter")],
            "SELECT dw.doc_id, coalesce(string_agg(stem, '|' ORDER BY pos), '') AS stems "
            "FROM dw LEFT JOIN t ON t.doc_id = dw.doc_id LEFT JOIN porter USING (term) GROUP BY dw.doc_id",
        ),
        "token_len": "SELECT doc_id, len(string_split(text, ' ')) AS n_parts FROM documents",
        "len_ratio": with_(
            pair_words(),
            "SELECT pair_id, round(greatest(len(descr), 1)::DOUBLE / greatest(len(query), 1), 6) AS desc_query, "
            "round(greatest(len(title), 1)::DOUBLE / greatest(len(query), 1), 6) AS title_query FROM w",
        ),
        "common_terms": with_(
            [*pair_words(), shared_words("query", "title", "a"), shared_words("query", "descr", "b"),
             shared_words("title", "descr", "c")],
            "SELECT w.pair_id, CAST(coalesce(a.n, 0) AS BIGINT) AS query_title, "
            "CAST(coalesce(b.n, 0) AS BIGINT) AS query_desc, CAST(coalesce(c.n, 0) AS BIGINT) AS title_desc "
            "FROM w LEFT JOIN a USING (pair_id) LEFT JOIN b USING (pair_id) LEFT JOIN c USING (pair_id)",
        ),
        "phrase_hits": with_(
            pair_words(),
            "SELECT pair_id, CASE WHEN query = '' OR title = '' THEN 0 ELSE "
            "CAST(contains(title, query) AS BIGINT) + CAST(contains(descr, query) AS BIGINT) END AS hits FROM cleaned",
        ),
        "overlap_feature_frame": with_(
            feat,
            "SELECT pair_id, relevance, "
            + ", ".join(f'round("{n}", 6) AS "{n}"' for n in FEATURE_NAMES)
            + " FROM feat",
        ),
        "cosine_similarity": f"WITH {VECTOR_PAIRS} SELECT pair_id, round(cosine, 6) AS cosine FROM vs",
        "euclidean_distance": f"WITH {VECTOR_PAIRS} SELECT pair_id, round(euclidean, 6) AS euclidean FROM vs",
        "jaccard": with_(OWN_JACCARD, "SELECT pair_id, round(distance, 6) AS distance FROM oj"),
        "threshold_cosine": f"WITH {VECTOR_PAIRS} SELECT pair_id, CAST(cosine >= 0.1 AS BIGINT) AS prediction FROM vs",
        "threshold_jaccard": with_(
            OWN_JACCARD,
            "SELECT pair_id, CAST(CASE WHEN distance > 0.95 THEN 0 ELSE 1 END AS BIGINT) AS prediction FROM oj",
        ),
        "threshold_euclid": f"WITH {VECTOR_PAIRS} SELECT pair_id, "
        "CAST(CASE WHEN euclidean > 1.4 THEN 0 ELSE 1 END AS BIGINT) AS prediction FROM vs",
        "label_2": classes(
            {"low": fixed.CUTS_BINARY_LOW, "mid": fixed.CUTS_BINARY_MID, "high": fixed.CUTS_BINARY_HIGH}
        ),
        "label_3": classes({"label": fixed.CUTS_3}),
        "label_4": classes({"label": fixed.CUTS_4}),
        "label_13": classes({"label": fixed.CUTS_13}),
        "hashed_tf": with_(
            doc, "SELECT doc_id, 10000::BIGINT AS n_buckets, len(words) AS n_words FROM dw"
        ),
        "tfidf_long": with_(
            [*pair_words(), counts("w", "pair_id", "title", "ct"), counts("w", "pair_id", "descr", "cd"),
             "dfs AS (SELECT term, count(*) AS df FROM ct GROUP BY term)"],
            "SELECT pair_id, term, n AS tf, round(n * ln(((SELECT count(*) FROM w) + 1.0::DOUBLE) / "
            "(coalesce(df, 0) + 1.0::DOUBLE)), 6) AS weight FROM cd LEFT JOIN dfs USING (term)",
        ),
        "count_vectors_long": with_(
            [*pair_words(), counts("w", "pair_id", "title", "ct"), counts("w", "pair_id", "query", "cq"),
             "v AS (SELECT term FROM ct GROUP BY term HAVING count(*) >= 5)"],
            "SELECT pair_id, term, n FROM cq JOIN v USING (term)",
        ),
        "count_vectors": with_(
            [*pair_words(), counts("w", "pair_id", "title", "ct"),
             "v AS (SELECT term FROM ct GROUP BY term HAVING count(*) >= 5)"],
            "SELECT w.pair_id, count(v.term) AS n_terms, "
            "CAST(coalesce(sum(ct.n) FILTER (v.term IS NOT NULL), 0) AS BIGINT) AS n_words "
            "FROM w LEFT JOIN ct ON ct.pair_id = w.pair_id LEFT JOIN v ON v.term = ct.term GROUP BY w.pair_id",
        ),
        "embed_with_table": with_(
            [*doc, EMBEDDING_CELLS, embedded("dw", "doc_id", "words", "em"),
             f"grid AS (SELECT doc_id, unnest(range({DIM})) AS pos FROM dw)"],
            "SELECT doc_id, pos, round(coalesce(x, 0), 6) AS x FROM grid LEFT JOIN em USING (doc_id, pos)",
        ),
        "minhash": with_(
            [*doc, "sa AS (SELECT doc_id AS id, unnest(list_distinct(words)) AS term FROM dw)",
             signatures("sa", "ha"),
             "sg AS (SELECT id, string_agg(CAST(h AS VARCHAR), '|' ORDER BY band) AS signature FROM ha GROUP BY id)"],
            "SELECT doc_id, signature FROM dw LEFT JOIN sg ON sg.id = dw.doc_id",
        ),
        "projection": "WITH eb AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), "
        f"b AS ({dot_rows('eb', 'v', 3, 0.25)}) "
        "SELECT id AS vec_id, string_agg(CAST(bucket AS VARCHAR), '|' ORDER BY band) AS buckets FROM b GROUP BY id",
        "assemble": with_(
            [*feat, FEATURE_ROWS], "SELECT pair_id, CAST(pos AS BIGINT) AS pos, round(x, 6) AS x FROM fr"
        ),
        "normalize": with_(
            [*feat, FEATURE_ROWS],
            "SELECT pair_id, CAST(pos AS BIGINT) AS pos, "
            "round(x / max(abs(x)) OVER (PARTITION BY pair_id), 6) AS x FROM fr",
        ),
        "normalize_l1": with_(
            [*feat, FEATURE_ROWS],
            "SELECT pair_id, CAST(pos AS BIGINT) AS pos, "
            "round(x / sum(abs(x)) OVER (PARTITION BY pair_id), 6) AS x FROM fr",
        ),
        "chi2_scores": with_(
            [*feat, FEATURE_ROWS, *CHI2], "SELECT feature, round(statistic, 6) AS statistic, dof FROM chi2"
        ),
        "label_index": "WITH r AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS n "
        "FROM part GROUP BY p_brand) SELECT p_partkey, p_brand, CAST(n AS DOUBLE) AS number, p_brand AS name "
        "FROM part JOIN r USING (p_brand)",
        "feature_index": "WITH f AS (SELECT DISTINCT ascii(l_returnflag) AS v FROM lineitem), "
        "fi AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS pos FROM f), "
        "s AS (SELECT DISTINCT ascii(l_linestatus) AS v FROM lineitem), "
        "si AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS pos FROM s) "
        "SELECT l_orderkey, l_partkey, l_quantity AS quantity, CAST(fi.pos AS DOUBLE) AS flag, "
        "CAST(si.pos AS DOUBLE) AS status, l_quantity AS kept FROM lineitem "
        "JOIN fi ON fi.v = ascii(l_returnflag) JOIN si ON si.v = ascii(l_linestatus)",
        "naive_bayes": naive_bayes_sql(),
        "isotonic": with_(
            isotonic_blocks(),
            "SELECT pair_id, relevance, round(prediction, 6) AS prediction FROM tr JOIN pts USING (x) "
            "JOIN fit USING (i)",
        ),
        "isotonic_boundaries": with_(
            isotonic_blocks(),
            'SELECT round(prediction, 6) AS prediction, min(x) AS "first", max(x) AS "last" '
            "FROM pts JOIN fit USING (i) GROUP BY round(prediction, 6)",
        ),
        "linear": ridge_sql(0.1),
        "tree_split": split_sql(),
        "rf_reg_split": split_sql(),
        "gbt_split": split_sql(),
        "rf_class_split": class_split_sql(),
        "importances_split": with_(
            split_blocks("relevance"),
            "SELECT feature, CASE WHEN pos = (SELECT pos FROM best) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance "
            "FROM (SELECT DISTINCT pos, feature FROM tr)",
        ),
        "logistic_equations": with_(
            split_blocks("relevance")[:-2],
            shares_sql("CASE WHEN relevance >= 2.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"),
        ),
        "ovr_equations": with_(
            [*split_blocks("relevance")[:-2], "classes AS (SELECT unnest(range(0, 3)) AS class)"],
            shares_sql("CASE WHEN relevance - 1 = class THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END", ", class", ", classes"),
        ),
        "pca_covariances": with_(
            split_blocks("relevance")[:-2],
            "SELECT a.feature AS one, b.feature AS two, round(covar_samp(a.x, b.x), 3) AS covariance "
            "FROM tr a JOIN tr b USING (pair_id) WHERE a.training GROUP BY a.feature, b.feature",
        ),
        "classify_naive_bayes_table": "SELECT 'naive_bayes' AS model, "
        "round(avg((label = prediction)::INT::DOUBLE), 6) AS accuracy, "
        f"round(1 - avg((label = prediction)::INT::DOUBLE), 6) AS error FROM ({naive_bayes_sql()})",
        "empty_tables": "SELECT s.size AS p_size, count(p_size) = 0 AS empty FROM (SELECT unnest([0, 1, 25, 50, 51])::BIGINT AS size) s "
        "LEFT JOIN part ON p_size = s.size GROUP BY s.size",
        "glm": ridge_sql(0.3),
        "linear_coefficients": with_(
            [*ridge_blocks(0.1), "names AS (SELECT DISTINCT pos, feature FROM fr)"],
            "SELECT feature, round(b, 6) AS coefficient FROM beta JOIN names USING (pos) UNION ALL "
            "SELECT '(intercept)', round(any_value(lab.m) - sum(b * mom.m), 6) FROM beta JOIN mom USING (pos), lab",
        ),
        "select_features": selected_sql(
            [*CHI2,
             "scores AS (SELECT feature, CASE WHEN dof > 0 THEN (pow(greatest(statistic, 0) / dof, 1.0::DOUBLE / 3) "
             "- (1 - 2.0::DOUBLE / (9 * dof))) / sqrt(2.0::DOUBLE / (9 * dof)) END AS score FROM chi2)"]
        ),
        "select_features_f": selected_sql(
            ["scores AS (SELECT feature, abs(corr(x, relevance)) AS score FROM fr GROUP BY feature)"]
        ),
        "word2vec_words": with_(
            stemmed_counts(["title"]), "SELECT DISTINCT stem AS word, 100::BIGINT AS size FROM stems"
        ),
        "confusion_flags": with_(
            JUDGED_HIGH,
            "SELECT pair_id, CAST(prediction AS BIGINT) AS prediction, CAST(relevance AS BIGINT) AS relevance, "
            'CAST(prediction = 1 AND relevance = 1 AS DOUBLE) AS "TP", '
            'CAST(prediction = 0 AND relevance = 0 AS DOUBLE) AS "TN", '
            'CAST(prediction = 1 AND relevance = 0 AS DOUBLE) AS "FP", '
            'CAST(prediction = 0 AND relevance = 1 AS DOUBLE) AS "FN" FROM judged',
        ),
        "binary_metrics": metrics(JUDGED_HIGH),
        "multiclass_accuracy": with_(
            [*OWN_JACCARD,
             """j AS (SELECT CASE WHEN relevance >= 2.67 THEN 3 WHEN relevance >= 2.33 THEN 2 WHEN relevance >= 1.67
    THEN 1 ELSE 0 END AS label, 3 * (1 - distance) AS s FROM oj),
h AS (SELECT label = CASE WHEN s >= 0.15 THEN 3 WHEN s >= 0.1 THEN 2 WHEN s >= 0.05 THEN 1 ELSE 0 END AS hit FROM j)"""],
            "SELECT round(avg(hit::DOUBLE), 6) AS accuracy, round(1 - avg(hit::DOUBLE), 6) AS error FROM h",
        ),
        "mse": with_(
            OWN_JACCARD,
            "SELECT round(avg((1 + 2 * (1 - distance) - relevance) * (1 + 2 * (1 - distance) - relevance)), 6) "
            "AS mse FROM oj",
        ),
        "match_by_cosine": cosine_sql(),
        "match_by_jaccard": metrics(jaccard_judged(None, True)),
        "match_by_jaccard_top500": metrics(jaccard_judged(500, False)),
        "match_by_jaccard_joined": metrics(joined_judged(500)),
        "match_by_euclidean": metrics(euclid_judged(None, 5.0)),
        "match_by_euclidean_top500": metrics(euclid_judged(500, 20.0, "WHERE distance < 1000")),
    }
