"""DuckDB SQL for the operators that plain SQL can express, on the same tables."""

from __future__ import annotations

from vitalis.llm import mixing, quality

_WORDS = r"""
w AS (SELECT doc_id, list_filter(string_split_regex(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)"""

#: Components of a table `links` (a, b, both ways) over the ids of a table `ids` (id).
_REACH = """
reach AS (SELECT id, id AS r FROM ids UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.id),
comp AS (SELECT id, MIN(r) AS component FROM reach GROUP BY id)"""

OP3 = rf"""
WITH {_WORDS},
starts AS (SELECT doc_id, w, unnest(range(len(w) - 49)) AS i FROM w WHERE len(w) >= 50),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i + 1 : i + 50], ' ')) AS h FROM starts),
low AS (SELECT h, MIN(doc_id) AS lo FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM windows JOIN low USING (h) WHERE lo < doc_id),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS k FROM w),
kept AS (
  SELECT each.doc_id, string_agg(word, ' ' ORDER BY each.k) FILTER (WHERE gone.k IS NULL) AS t, COUNT(gone.k) AS n
  FROM each LEFT JOIN gone ON each.doc_id = gone.doc_id AND each.k = gone.k GROUP BY each.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n, 0) AS BIGINT) AS n_removed, sha256(COALESCE(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

OP7 = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS h FROM pages),
d AS (
  SELECT page_id, octet_length(encode(h)) AS n,
         array_to_string(list_transform(string_split(sha1(h), ''), lambda c: right('000' || bin(('0x' || c)::INT), 4)), '') AS bits FROM p),
e AS (
  SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST(list_sum(list_transform(range(5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS BIGINT), 1) AS INT) * CAST(pow(2, 4 - j) AS INT))) AS BIGINT), 1)), '') AS payload_digest FROM d),
f AS (SELECT payload_digest, MIN(page_id) AS first FROM e GROUP BY payload_digest)
SELECT page_id, payload_bytes, e.payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM e JOIN f ON e.payload_digest = f.payload_digest"""

OP8 = rf"""
WITH RECURSIVE {_WORDS},
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i + 1 : i + 5], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE c / CAST(p.n + q.n - c AS DOUBLE) >= 0.8),
ids AS (SELECT doc_id AS id FROM w), {_REACH},
same AS (SELECT doc_id, CASE WHEN len(w) > 0 THEN MIN(doc_id) OVER (PARTITION BY array_to_string(w, ' ')) ELSE doc_id END AS copy_of FROM w),
deg AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT id AS doc_id, component AS class_id, CAST(COALESCE(deg.n, 0) AS BIGINT) AS n_links, copy_of, id = component AS kept
FROM comp JOIN same ON same.doc_id = id LEFT JOIN deg ON deg.a = id"""

OP9 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.93),
ids AS (SELECT vec_id AS id FROM v), {_REACH},
deg AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, CAST(COALESCE(deg.n, 0) AS BIGINT) AS n_links, component AS component_id, id = component AS kept
FROM comp LEFT JOIN deg ON deg.a = id"""

_SCALED = """
v AS (
  SELECT * EXCLUDE (embedding), list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS y FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))"""

OP11 = f"""
WITH {_SCALED},
r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, y FROM v WHERE label IS NOT NULL),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.y, b.y) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.y) = len(b.y) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (
  SELECT DISTINCT item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
g AS (SELECT COUNT(*) AS n_docs, CAST(SUM(len(t)) AS BIGINT) AS n_all FROM d WHERE len(t) > 0),
f AS (SELECT doc_id, term, COUNT(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * COUNT(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, g GROUP BY term, n_docs),
m AS (SELECT doc_id, 100 - 90 + (90 * len(t) * n_docs) // n_all AS m FROM d, g WHERE len(t) > 0),
s AS (
  SELECT item_id, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""

OP13 = f"""
WITH {_SCALED}
SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.y, c.y) DESC, c.vec_id) AS INT) AS rank,
       c.vec_id, CAST(list_dot_product(q.y, c.y) AS BIGINT) AS score
FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.y) = len(c.y) WHERE q.vec_id % 50 = 0 QUALIFY rank <= 5"""


def _op6() -> str:
    """Counts by unnested windows; cutoffs by binomial terms from log-gamma, the strictest that passes its test."""
    part = quality.RISK / len(quality.CUTOFFS)
    tests = sum(map(len, quality.CUTOFFS.values()))
    grid = ", ".join(f"('{s}', {i}, CAST({c} AS DOUBLE))" for s, cs in quality.CUTOFFS.items() for i, c in enumerate(cs))
    signal = {
        "symbol_ratio": "n_symbols / CAST(greatest(word_chars, 1) AS DOUBLE)",
        "dup_line_ratio": "n_dup_lines / CAST(greatest(n_lines, 1) AS DOUBLE)",
        "repeat_ratio": "n_repeat_words / CAST(greatest(n_words, 1) AS DOUBLE)",
        "word_length": "word_chars / CAST(greatest(n_words, 1) AS DOUBLE)",
    }
    long = " UNION ALL ".join(f"SELECT doc_id, lang, base_failed, '{s}' AS s, {x} AS v FROM b" for s, x in signal.items())
    return rf"""
WITH t AS (SELECT doc_id, lang, COALESCE(text, '') AS text FROM documents),
{_WORDS.strip()},
win AS (SELECT doc_id, i, md5(array_to_string(w[i + 1 : i + 8], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(len(w) - 7)) AS i FROM w WHERE len(w) >= 8)),
twice AS (SELECT doc_id, h FROM win GROUP BY doc_id, h HAVING COUNT(*) > 1),
rep AS (SELECT doc_id, COUNT(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM win JOIN twice USING (doc_id, h)) GROUP BY doc_id),
c AS (
  SELECT t.doc_id, t.lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         CAST(COALESCE(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM t JOIN w USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
l AS ({long}),
grid AS (SELECT * FROM (VALUES {grid}) g(s, i, cut)),
held AS (SELECT lang, s, l.doc_id, MAX(v) AS v FROM l JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) g ON g.doc_id = l.doc_id WHERE NOT base_failed GROUP BY ALL),
x AS (SELECT lang, grid.s, i, cut, COUNT(*) AS n, COUNT(*) FILTER (WHERE v > cut) AS x FROM held JOIN grid ON grid.s = held.s GROUP BY ALL),
p AS (
  SELECT *, list_sum(list_transform(range(x + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({part}) + (n - j) * ln(1 - {part})))) AS tail
  FROM x WHERE x < n * {part}),
ok AS (SELECT lang, s, arg_min(cut, i) AS cut FROM p WHERE tail <= {quality.DELTA / tests} / (SELECT COUNT(DISTINCT COALESCE(lang, '')) FROM held) GROUP BY lang, s),
bad AS (SELECT DISTINCT doc_id FROM l JOIN ok ON ok.s = l.s AND ok.lang IS NOT DISTINCT FROM l.lang WHERE v > cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM b"""


ORACLE: dict[str, str] = {
    "op2_mixing": mixing.SQL,
    "op3_substring": OP3,
    "op6_quality": _op6(),
    "op7_warc": OP7,
    "op8_jaccard": OP8,
    "op9_embeddings": OP9,
    "op11_negatives": OP11,
    "op12_lexical": OP12,
    "op13_topk": OP13,
}
