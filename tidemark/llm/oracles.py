"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

from tidemark.llm.decontaminate import SHARE, UPPER, WINDOW, WORD
from tidemark.llm.quality_rules import (
    MAX_REPEAT_PERCENT,
    MEASURES,
    MIN_GROUP,
    MIN_WORDS,
    RANGES,
    SYMBOLS,
)

_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
_WHITE = r"[^\x20\x09-\x0D]+"

ORACLES = {}

ORACLES["op1_decontaminate"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, l, array_to_string(w[p:p + l - 1], ' ') AS win
  FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS p
    FROM (SELECT *, least({WINDOW}, len(w)) AS l FROM i WHERE len(w) > 0) a) b),
dw AS (SELECT doc_id, l, p, array_to_string(w[p:p + l - 1], ' ') AS win
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p
    FROM d, (SELECT DISTINCT l FROM iw) ls WHERE len(w) >= l) a),
h AS (SELECT doc_id, p, l, item_id FROM dw JOIN iw USING (l, win)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM h) a GROUP BY 1),
it AS (SELECT doc_id, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS items FROM h GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n, 0) > 0 AND {SHARE} * coalesce(n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id"""


def _fences(keys: str, rows: str) -> str:
    """Quartiles and documents of each group and measure of a sketch."""
    group = f"{keys}, measure" if keys else "measure"
    return (
        f"SELECT {group}, max(total) AS total, min(bucket) FILTER (4 * seen >= total) AS q1, "
        f"min(bucket) FILTER (4 * seen >= 3 * total) AS q3 FROM (SELECT {group}, bucket, "
        f"sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS seen, "
        f"sum(n) OVER (PARTITION BY {group}) AS total "
        f"FROM (SELECT {group}, bucket, sum(n) AS n FROM ({rows}) r GROUP BY ALL) s) c GROUP BY ALL"
    )


_VALUES = " UNION ALL ".join(
    f"SELECT doc_id, lk, sk, '{name}' AS measure, ({scale} * {top}) // {bottom} AS v, "
    f"{least} AS least, {str(both).lower()} AS both_sides "
    f"FROM m WHERE NOT base_failed AND {bottom} > 0"
    for name, (top, bottom, scale, least, both) in MEASURES.items()
)

ORACLES["op3_quality_rules"] = f"""
WITH d AS (SELECT doc_id, coalesce('=' || lang, 'null') AS lk, coalesce('=' || source, 'null') AS sk,
  coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WHITE}') AS w FROM documents),
g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, a, b, c) AS often
  FROM (SELECT doc_id, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3) x) y),
rep AS (SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest(range(p, p + 3)) AS q FROM g WHERE often > 1) x GROUP BY 1),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) x
  WHERE regexp_matches(line, '{_WHITE}') GROUP BY 1),
counted AS (SELECT d.doc_id, lk, sk, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '{SYMBOLS.decode()}', '')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  coalesce(lines.n, 0) AS n_lines
  FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id LEFT JOIN lines ON lines.doc_id = d.doc_id),
m AS (SELECT *, n_words < {MIN_WORDS}
  OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
v AS ({_VALUES}),
sketch AS (SELECT lk, sk, measure, (v >> shift) << shift AS bucket, count(*) AS n
  FROM (SELECT *, greatest(0, length(bin(v)) - 6) AS shift FROM v) x GROUP BY ALL),
own AS ({_fences('lk, sk', 'FROM sketch')}),
lang AS ({_fences('lk', 'FROM sketch')}),
whole AS ({_fences('', 'FROM sketch')}),
documents_of AS (SELECT lk, sk, max(total) AS total FROM own GROUP BY ALL),
documents_in AS (SELECT lk, max(total) AS total FROM lang GROUP BY ALL),
outside AS (SELECT DISTINCT doc_id FROM (
  SELECT v.*, CASE WHEN a.total >= {MIN_GROUP} THEN own.q1 WHEN b.total >= {MIN_GROUP} THEN lang.q1
      ELSE whole.q1 END AS q1,
    CASE WHEN a.total >= {MIN_GROUP} THEN own.q3 WHEN b.total >= {MIN_GROUP} THEN lang.q3
      ELSE whole.q3 END AS q3
  FROM v JOIN documents_of a USING (lk, sk) JOIN documents_in b USING (lk)
  JOIN own USING (lk, sk, measure) JOIN lang USING (lk, measure) JOIN whole USING (measure)) f
  WHERE v > q3 + greatest({RANGES} * (q3 - q1), least)
    OR both_sides AND v < q1 - greatest({RANGES} * (q3 - q1), least))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (FROM outside) AS kept
FROM m"""

ORACLES["op6_ngram_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WHITE}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[p:p + l - 1] AS shingle
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p
    FROM (SELECT *, least(5, len(w)) AS l FROM d WHERE len(w) > 0) a) b),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (SELECT x, y, c = a.n AND c = b.n AS copies
  FROM (SELECT s.doc_id AS x, o.doc_id AS y, count(*) AS c FROM s JOIN s o USING (shingle)
    WHERE s.doc_id <> o.doc_id GROUP BY 1, 2) p
  JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 5 * c >= 4 * (a.n + b.n - c)),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM d
  UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other)
SELECT d.doc_id, class_id, coalesce(n_links, 0) AS n_links, least(d.doc_id, copy_id) AS copy_id
FROM d JOIN (SELECT doc_id, min(other) AS class_id FROM reached GROUP BY 1) c ON c.doc_id = d.doc_id
LEFT JOIN (SELECT x, count(*) AS n_links, min(y) FILTER (copies) AS copy_id FROM links GROUP BY 1) l
  ON l.x = d.doc_id"""

#: Unsigned CRC-32 of the decimal text of an integer column, a bit at a time.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split({0}::VARCHAR, ''), lambda ch: list_concat([ord(ch)::BIGINT],
    [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def _sized(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_sized, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
           CASE WHEN {_CRC32.format("doc_id")} % 7 = 0 THEN {_leaf("(n_chars::HUGEINT + 1)")}
                ELSE {_leaf("n_chars")} END AS given
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), tree AS (
    SELECT lang, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM placed
    UNION ALL
    SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
    FROM tree WHERE n > 1 GROUP BY lang, lvl, pos // 2, n
), subroots AS (
    SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos FROM tree WHERE n = 1
), upper AS (
    SELECT 0 AS lvl, pos, subroot AS h, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
    FROM upper WHERE n > 1 GROUP BY lvl, pos // 2, n
), steps AS (
    SELECT p.lang, p.pos, t.lvl, t.pos % 2 = 1 AS odd, s.h AS sibling
    FROM placed p
    JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang AND t.pos = p.pos >> t.lvl AND t.n > 1
    LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM t.lang AND s.lvl = t.lvl AND s.pos = xor(t.pos, 1)
    UNION ALL
    SELECT p.lang, p.pos, (SELECT max(lvl) FROM tree WHERE lang IS NOT DISTINCT FROM p.lang) + t.lvl, t.pos % 2 = 1, s.h
    FROM placed p
    JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
    JOIN upper t ON t.pos = r.pos >> t.lvl AND t.n > 1
    LEFT JOIN upper s ON s.lvl = t.lvl AND s.pos = xor(t.pos, 1)
), proofs AS (
    SELECT lang, pos, string_agg(sibling, '' ORDER BY lvl) AS proof, max(lvl) + 1 AS height FROM steps GROUP BY lang, pos
), folds AS (
    SELECT lang, pos, 0 AS lvl, given AS v FROM placed
    UNION ALL
    SELECT f.lang, f.pos, f.lvl + 1,
           sha256(CASE WHEN s.odd THEN coalesce(s.sibling, '') || f.v ELSE f.v || coalesce(s.sibling, '') END)
    FROM folds f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.lvl = f.lvl
)
SELECT p.doc_id, p.leaf, r.subroot, (SELECT h FROM upper WHERE n = 1) AS root,
       sha256(coalesce(q.proof, '')) AS proof_sha256, f.v AS folded_root,
       f.v = (SELECT h FROM upper WHERE n = 1) AS verified
FROM placed p
JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.pos = p.pos
JOIN folds f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos AND f.lvl = coalesce(q.height, 0)
"""

ORACLES["op12_prefix_trie"] = f"""
WITH t AS (
    SELECT conv_id, tok, b, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tok) AS k
    FROM (SELECT conv_id, turn, strlen(coalesce(text, '')) AS b,
                 substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')), 1, 32) AS tok
          FROM conversations WHERE conv_id IS NOT NULL) a
), c AS (
    SELECT conv_id AS c, {_CRC32.format("conv_id")} % 9 AS h, count(*) AS n FROM t GROUP BY conv_id
), r AS (
    SELECT c, k AS pos, tok, b FROM c JOIN t ON t.conv_id = c - c % 5 AND k <= h
    UNION ALL
    SELECT c.c, least(c.h, coalesce(g.n, 0)) + k - c.h, tok, b
    FROM c JOIN t ON t.conv_id = c.c AND k > c.h LEFT JOIN c g ON g.c = c.c - c.c % 5
), p AS (
    SELECT c, pos AS d, b, string_agg(tok, '') OVER (PARTITION BY c ORDER BY pos) AS key FROM r
    UNION ALL SELECT c, 0, 0, '' FROM c
), m AS (
    SELECT *, d = max(d) OVER (PARTITION BY c) AS ends FROM p
), v AS (
    SELECT key, d, min(c) AS conv_id, count(*) AS n, min(b) AS b, left(key, 32 * (d - 1)) AS above,
           string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends) AS ids
    FROM m GROUP BY key, d
), kids AS (SELECT above, count(*) AS n FROM v WHERE d > 0 GROUP BY above),
below AS (
    SELECT v.key, sum((u.n - 1) * u.b) AS saved, count(*) FILTER (WHERE u.key NOT IN (SELECT above FROM kids)) AS leaves
    FROM v JOIN v u ON starts_with(u.key, v.key) GROUP BY v.key
)
SELECT v.conv_id, v.d AS depth, o.conv_id AS parent_conv_id, v.n AS n_convs,
       coalesce(kids.n, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens,
       sha256(coalesce(v.ids, '')) AS ends_sha256
FROM v LEFT JOIN kids ON kids.above = v.key JOIN below ON below.key = v.key
LEFT JOIN v o ON v.d > 0 AND o.key = v.above
"""
