"""DuckDB SQL that the operators' results must equal, where SQL can say it."""

from __future__ import annotations

from .common import ASCII_LOWER, ASCII_UPPER
from .licenses import BASE, rules


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_sql() -> str:
    """Words as ' w ' each, so that a match takes whole words and neighbours stay whole."""
    every = [(label, phrase, keyword, 0, True) for label, phrase, keyword in BASE] + [(*r, False) for r in rules()]
    doubled = lambda p: " " + p.replace(" ", "  ") + " "
    # Within a character class a doubled blank means the same as one.
    values = ",\n".join(f"({_text(label)}, {_text(doubled(p))}, {_text(k.replace(' ', ' +'))}, {priority}, {base})" for label, p, k, priority, base in every)
    return f"""
WITH rules(label, rx, kw, priority, base) AS (VALUES {values}),
w AS (
  SELECT row_number() OVER () AS rid, doc_id, len(ws) AS n_words, ' ' || array_to_string(ws, '  ') || ' ' AS s
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents)
),
m AS (
  SELECT rid, label, priority, base, regexp_extract_all(s, rx) AS ms, string_split_regex(s, rx) AS ps
  FROM w JOIN rules ON regexp_matches(s, kw) AND regexp_matches(s, rx)
),
places AS (
  SELECT rid, label, priority, base, ms[k] AS hit, array_to_string(ps[1:k], '') || array_to_string(ms[1:k-1], '') AS before
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM m)
),
h AS (
  SELECT rid, label, priority, base,
    (len(before) - len(replace(before, ' ', ''))) // 2 AS f,
    (len(before) - len(replace(before, ' ', '')) + len(hit) - len(replace(hit, ' ', ''))) // 2 AS p
  FROM places
),
kept AS (
  SELECT * FROM h a WHERE a.base OR NOT EXISTS (
    SELECT 1 FROM h b WHERE b.rid = a.rid AND NOT b.base AND b.f <= a.f AND b.p >= a.p
      AND (b.priority > a.priority OR (b.priority = a.priority AND b.p - b.f > a.p - a.f)))
)
SELECT any_value(w.doc_id) AS doc_id, CAST(any_value(w.n_words) AS BIGINT) AS n_words,
  CAST(count(*) FILTER (WHERE kept.base) AS BIGINT) AS n_base,
  CAST(min(kept.f) FILTER (WHERE kept.base) AS BIGINT) AS first_word,
  CAST(max(kept.f) FILTER (WHERE kept.base) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT kept.label, ',' ORDER BY kept.label) FILTER (WHERE kept.base), '') AS base_labels,
  coalesce(string_agg(DISTINCT kept.label, ',' ORDER BY kept.label), '') AS labels,
  coalesce(max(CASE WHEN kept.base THEN 60 ELSE kept.priority END), 0) / CAST(100 AS DOUBLE) AS score
FROM w LEFT JOIN kept ON kept.rid = w.rid
GROUP BY w.rid
"""


#: Brute force over the quantised vectors.
KNN_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.rid, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.rid <> b.rid
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""

#: Clauses by position with windows; a line is the clauses up to one with a line feed.
UNITS_SQL = r"""
WITH d0 AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
d AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, substr(md5(text), 1, 15), rid) AS rank FROM d0),
x AS (SELECT rid, rank, regexp_extract_all(text, '[^.,!?\n]*(?:[.,!?]+\n*|\n+)|[^.,!?\n]+') AS us FROM d),
u AS (SELECT rid, rank, unnest(us) AS unit, unnest(range(len(us))) AS pos FROM x),
n AS (
  SELECT *, lower(trim(regexp_replace(unit, '[ \t\r\n]+', ' ', 'g'))) AS normal,
    coalesce(sum(length(unit)) OVER before, 0) AS start,
    coalesce(sum(CASE WHEN contains(unit, chr(10)) THEN 1 ELSE 0 END) OVER before, 0) AS line,
    len(regexp_extract_all(unit, '[^ \t\r\n]+')) AS words
  FROM u WINDOW before AS (PARTITION BY rid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
l AS (SELECT rid, rank, line, sum(words) > 0 AS worded, lower(trim(regexp_replace(string_agg(unit, '' ORDER BY pos), '[ \t\r\n]+', ' ', 'g'))) AS normal FROM n GROUP BY rid, rank, line),
lf AS (SELECT normal, min((rank, line)) AS first FROM l GROUP BY normal),
lg AS (SELECT rid, line, worded AND (rank, line) > first AS line_gone FROM l JOIN lf USING (normal)),
f AS (SELECT normal, min((rank, pos)) AS first FROM n GROUP BY normal),
m AS (SELECT n.*, line_gone, (n.rank, n.pos) > f.first AND NOT line_gone AS again FROM n JOIN f USING (normal) JOIN lg ON lg.rid = n.rid AND lg.line = n.line),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY pos) - row_number() OVER (PARTITION BY rid, again ORDER BY pos) AS run FROM m),
k AS (SELECT *, line_gone OR (again AND (max(words) OVER whole >= 12 OR sum(words) OVER whole >= 20)) AS gone FROM r WINDOW whole AS (PARTITION BY rid, again, run)),
i AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY pos) - row_number() OVER (PARTITION BY rid, gone ORDER BY pos) AS island FROM k),
g AS (SELECT rid, gone, min(pos) AS pos, min(start) AS start, sum(length(unit)) AS size, string_agg(unit, '' ORDER BY pos) AS body FROM i GROUP BY rid, gone, island)
SELECT any_value(d.doc_id) AS doc_id,
  CAST(any_value(len(x.us)) AS BIGINT) AS n_units,
  CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_spans,
  CAST(coalesce(sum(size) FILTER (WHERE gone), 0) AS BIGINT) AS n_removed_chars,
  coalesce(string_agg(CAST(start AS BIGINT) || '+' || CAST(size AS BIGINT), ' ' ORDER BY pos) FILTER (WHERE gone), '') AS removed_spans,
  sha256(coalesce(string_agg(body, '' ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d JOIN x USING (rid) LEFT JOIN g USING (rid)
GROUP BY rid
"""

#: Near words by every deletion of each word; the hash is worked out byte by byte from its table.
VARIANTS_SQL = f"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) AS tab),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
c AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY ALL),
h AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(named, ''), lambda s: CASE WHEN unicode(s) < 128 THEN [CAST(unicode(s) AS BIGINT)] ELSE [195, unicode(s) - 64] END))),
    lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM c, crc
),
e AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM e WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
p AS (
  SELECT a.word, b.word AS other FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, w.word FROM d JOIN w ON w.word = d.rest
  UNION SELECT w.word, d.word FROM d JOIN w ON w.word = d.rest
),
f AS (
  SELECT w.word, w.n, count(p.other) AS n_near, max(o.n) AS most
  FROM w LEFT JOIN p ON p.word = w.word LEFT JOIN w o ON o.word = p.other GROUP BY w.word, w.n
),
g AS (SELECT word, n, n_near, CASE WHEN most >= 10 * n THEN (SELECT min(p.other) FROM p JOIN w o ON o.word = p.other WHERE p.word = f.word AND o.n = most) END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n FROM f),
k AS (SELECT word, word AS root FROM g UNION ALL SELECT k.word, g.form FROM k JOIN g ON g.word = k.root WHERE g.form IS NOT NULL)
SELECT g.word, g.form, k.root, g.n, CAST(g.n_near AS BIGINT) AS n_near, g.form_n
FROM g JOIN k ON k.word = g.word JOIN g last ON last.word = k.root AND last.form IS NULL
"""

#: Every document scored for every item.
RANKED_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
g AS (SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM d WHERE len(ts) > 0),
m AS (SELECT rid, doc_id, 75 + (25 * len(ts) * docs) // total AS m FROM d, g WHERE len(ts) > 0),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) GROUP BY rid, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g),
q AS (SELECT row_number() OVER () AS qid, item_id, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM benchmark),
t AS (SELECT qid, term, count(*) AS times FROM (SELECT qid, unnest(ts) AS term FROM q) GROUP BY qid, term),
s AS (
  SELECT qid, rid, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM t JOIN w USING (term) JOIN p USING (term) JOIN m USING (rid) GROUP BY qid, rid
),
k AS (SELECT qid, rid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s JOIN m USING (rid) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k JOIN m USING (rid) JOIN q USING (qid) WHERE rank <= 20
"""
