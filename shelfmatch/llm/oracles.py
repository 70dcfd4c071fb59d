"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

LEVELS, TOP_LEVELS = 8, 3  # of trees with up to 8^8 leaves in a group, and 8^3 groups

# the reflected polynomial of crc32, a fixed value; eight steps for each byte of a short text
_CRC32 = """
    xor(4294967295, list_reduce(
        list_concat([4294967295], flatten(list_transform(range(1, length({0}) + 1),
            lambda i: [ascii(substring({0}, i::int, 1))::bigint, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))))
"""


def crc32(text: str) -> str:
    return _CRC32.format(text)


def _tree(name: str, leaves: str, levels: int) -> str:
    """Tables of the nodes of each level with what lies beside them; a lone node goes up unchanged."""
    sql, below = "", leaves
    for k in range(levels + 1):
        if k:
            sql += f"""
            {name}_{k}_nodes AS (
                SELECT g, r // 8 AS r,
                       CASE WHEN any_value(alive) THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END AS h
                FROM {below} GROUP BY g, r // 8),"""
            below = f"{name}_{k}_nodes"
        sql += f"""
            {name}_{k} AS (
                SELECT g, r, h, count(*) OVER (PARTITION BY g) > 1 AS alive,
                       coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
                       coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
                FROM {below} WINDOW run AS (PARTITION BY g, r // 8 ORDER BY r)),"""
        below = f"{name}_{k}"
    return sql


def merkle_sql() -> str:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    field = lambda c: f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"
    shared = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = f"translate(text, '{capitals}', '{capitals.lower()}')"
    sql = f"""
        WITH digests AS (
            SELECT doc_id, coalesce('=' || lang, '-') AS g, sha256({shared} || {field("text")}) AS leaf,
                   CASE WHEN {crc32("doc_id::varchar")} % 3 = 0
                        THEN sha256({shared} || {field(lowered)}) END AS tampered
            FROM documents),
        leaves AS (
            SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
            FROM digests),
        {_tree("n", "leaves", LEVELS)}
        subroots AS (
            SELECT g AS name, '' AS g, h, row_number() OVER (ORDER BY g) - 1 AS r FROM n_{LEVELS}),
        {_tree("t", "subroots", TOP_LEVELS)}
        steps AS (
            SELECT leaves.doc_id, leaves.leaf, coalesce(leaves.tampered, leaves.leaf) AS f, subroots.h AS subroot,
                   t_{TOP_LEVELS}.h AS root, ["""
    tables = [(f"n_{k}", "leaves.g", f"leaves.r >> {3 * k}") for k in range(LEVELS)]
    tables += [(f"t_{k}", "''", f"subroots.r >> {3 * k}") for k in range(TOP_LEVELS)]
    sql += ", ".join(f"{{'alive': {t}.alive, 'a': {t}.a, 'b': {t}.b}}" for t, _, _ in tables)
    sql += f"] AS path FROM leaves JOIN subroots ON subroots.name = leaves.g CROSS JOIN t_{TOP_LEVELS}"
    for t, g, r in tables:
        sql += f"\n JOIN {t} ON {t}.g = {g} AND {t}.r = {r}"
    fold = "f"
    sql += "),\n f_0 AS (SELECT * FROM steps)"
    for k in range(len(tables)):  # step by step from the leaf up
        fold = f"CASE WHEN path[{k + 1}].alive THEN sha256(path[{k + 1}].a || f || path[{k + 1}].b) ELSE f END"
        sql += f",\n f_{k + 1} AS (SELECT * REPLACE ({fold} AS f) FROM f_{k})"
    beside = " || ".join(
        f"CASE WHEN path[{k + 1}].alive THEN path[{k + 1}].a || path[{k + 1}].b ELSE '' END"
        for k in range(len(tables))
    )
    return sql + f"""
        SELECT doc_id, leaf, subroot, root, sha256({beside}) AS proof_sha256, f AS folded_root,
               f = root AS verified
        FROM f_{len(tables)}"""


def periodic_sql() -> str:
    """Repetitions as stretches of places whose four words recur at a distance."""
    return f"""
        WITH split AS (
            SELECT doc_id, {crc32("doc_id::varchar")} AS h,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents),
        planned AS (
            SELECT *, len(words) AS n, h // 10 % greatest(len(words), 1) AS a, 3 + h // 10 % 8 AS parts FROM split),
        changed AS (
            SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
                THEN words[1:a] || list_transform(range(a, n), lambda i: words[a + (i - a) % (1 + (n - a) // parts) + 1])
                ELSE words END AS words
            FROM planned),
        placed AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i, len(words) AS n FROM changed),
        grams AS (
            SELECT *, word || ' ' || lead(word, 1) OVER here || ' ' || lead(word, 2) OVER here || ' '
                   || lead(word, 3) OVER here AS gram
            FROM placed WINDOW here AS (PARTITION BY doc_id ORDER BY i)),
        pairs AS (
            SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x
            JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
        islands AS (
            SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
        repetitions AS (
            SELECT doc_id, min(i) AS start, count(*) + 3 + q AS length, q FROM islands GROUP BY doc_id, q, island),
        runs AS (
            SELECT doc_id, start, length, min(q) AS period FROM repetitions
            WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
        best AS (
            SELECT * FROM runs QUALIFY row_number() OVER (
                PARTITION BY doc_id ORDER BY length::double / period DESC, start, period) = 1),
        listed AS (
            SELECT doc_id, count(*) AS n_runs,
                   string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
            FROM runs GROUP BY doc_id),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
            FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0)::bigint AS n_runs, start::bigint AS start, length::bigint AS length,
               period::bigint AS period, (length * 1000 // period)::bigint AS exponent_milli,
               sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""


ORACLES = {"op11_periodic_runs": periodic_sql(), "op12_merkle_manifest": merkle_sql()}
