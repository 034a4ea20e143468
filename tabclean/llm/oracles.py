"""SQL for DuckDB that gives the rows of operators 11 to 13."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = (
    rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP11_SQL = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS words FROM documents),
items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, words, least(len(words), 10) AS size
    FROM (SELECT item_id, {_WORDS} AS words FROM benchmark)
    WHERE len(words) > 0
),
windows AS (
    SELECT DISTINCT item, size, array_to_string(words[i : i + size - 1], ' ') AS shown
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM items)
),
places AS (
    SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
    FROM docs, (SELECT DISTINCT size FROM windows)
),
hits AS (
    SELECT p.r, p.i, p.size, w.item
    FROM (SELECT r, i, size, array_to_string(words[i : i + size - 1], ' ') AS shown FROM places) p
    JOIN windows w USING (size, shown)
),
covered AS (
    SELECT r, count(DISTINCT place) AS n_hit
    FROM (SELECT r, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT r, i, size FROM hits))
    GROUP BY r
),
met AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS listed
    FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN met USING (r)
"""


def _field(value: str) -> str:
    shown = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({shown}) || ':' || {shown}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# CRC-32 of the digits of doc_id, bit by bit
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295], [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, step: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP12_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf("text")} AS leaf,
           CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")}
                ELSE {_leaf("text")} END AS found
    FROM documents
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
           count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS r
    FROM leaves
),
nodes AS (
    SELECT lang, 0 AS level, idx, n, leaf AS digest FROM placed
    UNION ALL
    SELECT lang, level + 1, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 8
),
tops AS (
    SELECT lang, digest, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS idx,
           count(*) OVER () AS n
    FROM nodes WHERE n = 1
),
upper_nodes AS (
    SELECT 1000 AS level, idx, n, digest FROM tops
    UNION ALL
    SELECT level + 1, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM upper_nodes WHERE n > 1 GROUP BY level, idx // 8
),
pairs AS (
    SELECT lang, level, idx,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY lang, level, idx // 8 ORDER BY idx)
),
upper_pairs AS (
    SELECT level, idx,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM upper_nodes WHERE n > 1 WINDOW run AS (PARTITION BY level, idx // 8 ORDER BY idx)
),
steps AS (
    SELECT r, row_number() OVER (PARTITION BY r ORDER BY level) AS step, l, rt
    FROM (
        SELECT d.r, p.level, p.l, p.r AS rt
        FROM placed d JOIN pairs p
          ON d.lang IS NOT DISTINCT FROM p.lang AND d.idx // CAST(8 ** p.level AS BIGINT) = p.idx
        UNION ALL
        SELECT d.r, p.level, p.l, p.r
        FROM placed d JOIN tops t ON d.lang IS NOT DISTINCT FROM t.lang
        JOIN upper_pairs p ON t.idx // CAST(8 ** (p.level - 1000) AS BIGINT) = p.idx
    )
),
folds AS (
    SELECT r, 0 AS step, found AS digest FROM placed
    UNION ALL
    SELECT f.r, s.step, sha256(s.l || f.digest || s.rt) FROM folds f JOIN steps s
      ON s.r = f.r AND s.step = f.step + 1
),
folded AS (SELECT r, arg_max(digest, step) AS folded_root FROM folds GROUP BY r),
proofs AS (SELECT r, string_agg(l || rt, '' ORDER BY step) AS proof FROM steps GROUP BY r),
root AS (SELECT digest AS root FROM upper_nodes WHERE n = 1)
SELECT d.doc_id, d.leaf, t.digest AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM placed d JOIN tops t ON d.lang IS NOT DISTINCT FROM t.lang
JOIN folded USING (r) LEFT JOIN proofs USING (r) CROSS JOIN root
"""


def _op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """A CTE for each round: every part's nearest entry, then the entries' means rounded down."""
    steps = [
        f"""vectors AS MATERIALIZED (
    SELECT vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q,
           len(embedding) // {parts} AS m, row_number() OVER (ORDER BY vec_id, embedding) AS r
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
)""",
        f"""parts AS MATERIALIZED (
    SELECT r, p, m, q[p * m + 1 : p * m + m] AS v FROM vectors, range({parts}) t(p)
)""",
        f"books_0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {entries})",
    ]

    def assigned(k: int) -> str:
        distance = "list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, m + 1)])"
        return f"""codes_{k} AS MATERIALIZED (
    SELECT r, p, any_value(v) AS v, any_value(m) AS m, arg_min(e, d * {entries} + e) AS e, min(d) AS d
    FROM (SELECT x.r, x.p, x.v, x.m, b.e, {distance.replace("c[i]", "b.v[i]").replace("(v[i]", "(x.v[i]")} AS d
          FROM parts x JOIN books_{k} b USING (p))
    GROUP BY r, p
)"""

    for k in range(rounds):
        steps.append(assigned(k))
        steps.append(f"""books_{k + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(n.v, b.v) AS v
    FROM books_{k} b LEFT JOIN (
        SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
        FROM (SELECT p, e, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
              FROM (SELECT p, e, v, unnest(range(1, m + 1)) AS i FROM codes_{k}) GROUP BY p, e, i)
        GROUP BY p, e
    ) n USING (p, e)
)""")
    steps.append(assigned(rounds))
    return f"""
WITH {", ".join(steps)},
coded AS (
    SELECT r, string_agg(lpad(to_hex(e), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM codes_{rounds} GROUP BY r
),
digest AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books_{rounds}
)
SELECT vec_id, lower(code) AS code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM vectors JOIN coded USING (r) CROSS JOIN digest
"""


OP13_SQL = _op13_sql()
