"""DuckDB SQL for the operators that SQL can express, stated from their contracts."""

from __future__ import annotations

_PLAIN = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Ratio per 1000: numerator, denominator, lower fence, slack.
_RATIOS = [("word_length", "word_chars", "n_words", True, 100), ("symbols", "n_symbols", "n_words", False, 20),
           ("dup_lines", "n_dup_lines", "n_lines", False, 80), ("repeats", "n_repeat_words", "n_words", False, 80)]


def _quality() -> str:
    value = lambda a, b: f"CAST(floor(1000 * {a} / greatest({b}, 1)) AS BIGINT)"
    long = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{r}' AS ratio, {low} AS two_sided, {slack} AS slack, "
                              f"{value(a, b)} AS v FROM stats WHERE n_words > 0" for r, a, b, low, slack in _RATIOS)
    levels = []
    for n, keys in enumerate((["lang", "source"], ["lang"], [])):
        by = ", ".join([*keys, "ratio"])
        levels.append(f"""l{n} AS (
  SELECT {by}, max(total) AS total, min(CASE WHEN 4 * upto >= total THEN top END) AS q1,
         min(CASE WHEN 4 * upto >= 3 * total THEN top END) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY top) AS upto, sum(n) OVER (PARTITION BY {by}) AS total
        FROM (SELECT {by}, top, count(*) AS n FROM tops GROUP BY ALL))
  GROUP BY {by})""")
    return f"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_PLAIN}') AS words
  FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '{_PLAIN}') GROUP BY doc_id),
thirds AS (SELECT doc_id, s, words[s:s + 2] AS t FROM (SELECT *, unnest(range(1, len(words) - 1)) AS s FROM w)),
twice AS (SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS c FROM thirds) WHERE c > 1),
again AS (SELECT doc_id, count(DISTINCT s + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
stats AS (
  SELECT w.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN again USING (doc_id)),
vals AS ({long}),
-- the sketch keeps a value as the top of its bucket: exact below 64, then 32 steps in each power of two
tops AS (SELECT *, ((v >> k) + 1 << k) - 1 AS top FROM (SELECT *, greatest(length(bin(v)) - 6, 0) AS k FROM vals)),
{", ".join(levels)},
fence AS (
  SELECT l0.lang, l0.source, l0.ratio,
         CASE WHEN l0.total >= 200 THEN l0.q1 WHEN l1.total >= 200 THEN l1.q1 ELSE l2.q1 END AS q1,
         CASE WHEN l0.total >= 200 THEN l0.q3 WHEN l1.total >= 200 THEN l1.q3 ELSE l2.q3 END AS q3
  FROM l0 JOIN l1 ON l0.lang IS NOT DISTINCT FROM l1.lang AND l0.ratio = l1.ratio JOIN l2 ON l0.ratio = l2.ratio),
outside AS (
  SELECT DISTINCT doc_id FROM vals v JOIN fence f
    ON v.lang IS NOT DISTINCT FROM f.lang AND v.source IS NOT DISTINCT FROM f.source AND v.ratio = f.ratio
  WHERE v.v > q3 + 6 * (q3 - q1 + slack) OR (two_sided AND v.v < q1 - 6 * (q3 - q1 + slack)))
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats)"""


_WINDOWS = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_PLAIN}') AS words FROM documents),
win AS (SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS t
        FROM (SELECT *, unnest(range(1, len(words) - 18)) AS s FROM w)),
later AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, s + i AS p FROM later, range(0, 20) r(i)),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

_BYTES = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (SELECT doc_id, s, hash(array_slice(b, s + 1, s + 400)) AS h
        FROM (SELECT doc_id, b, unnest(range(0, octet_length(b) - 399)) AS s FROM d)),
hit AS (SELECT doc_id, s FROM win SEMI JOIN (SELECT h FROM win GROUP BY h HAVING count(*) > 1) USING (h)),
span AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS z
         FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS g
               FROM (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 400 THEN 0 ELSE 1 END AS fresh
                     FROM hit))
         GROUP BY doc_id, g),
cut AS (SELECT doc_id, 0 AS z FROM d UNION ALL SELECT doc_id, z FROM span),
rest AS (SELECT doc_id, z, lead(a) OVER (PARTITION BY doc_id ORDER BY z) AS a
         FROM (SELECT c.doc_id, c.z, (SELECT max(p.a) FROM span p WHERE p.doc_id = c.doc_id AND p.z = c.z) AS a FROM cut c)),
kept AS (SELECT r.doc_id, string_agg(substr(x, 2 * z + 1, 2 * (coalesce(a, length(x) // 2) - z)), '' ORDER BY z) AS t
         FROM rest r JOIN d USING (doc_id) GROUP BY r.doc_id),
n AS (SELECT doc_id, sum(z - a) AS n, count(*) AS k FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       coalesce(k, 0) AS n_spans, sha256(unhex(t)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

_BENCHMARK = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}') AS words
           FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}') AS words
      FROM benchmark),
phrase AS (SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(words[s:s + 12], ' ') AS t
           FROM (SELECT *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS s FROM i WHERE len(words) > 0)),
win AS (SELECT doc_id, s, n, array_to_string(words[s:s + n - 1], ' ') AS t
        FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM w, (SELECT DISTINCT n FROM phrase))),
found AS (SELECT doc_id, s, n, item_id FROM win JOIN phrase USING (n, t)),
hit AS (SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM found, range(0, 13) r(k) WHERE k < n GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
         FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)"""

_JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_PLAIN}') AS words
  FROM documents),
-- as many words as there are, at most three, from each place on
s AS (SELECT DISTINCT doc_id, array_to_string(words[k:k + 2], ' ') AS t
      FROM (SELECT *, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS k FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id
           GROUP BY ALL),
pair AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
link AS (SELECT x, y FROM pair UNION ALL SELECT y, x FROM pair),
reach AS (SELECT doc_id AS d, doc_id AS r FROM w UNION SELECT link.y, reach.r FROM reach JOIN link ON link.x = reach.d)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT d AS doc_id, min(r) AS component_id FROM reach GROUP BY d) USING (doc_id)"""

ORACLES = {"op3_quality_rules": _quality(), "op4_substring_dedup": _WINDOWS, "op5_ngram_jaccard": _JACCARD,
           "op9_decontamination": _BENCHMARK, "op10_suffix_array_dedup": _BYTES}
