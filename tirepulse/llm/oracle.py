"""DuckDB SQL of the queries that SQL can express, each another way to the same rows."""

from __future__ import annotations

from tirepulse.llm.license_scan import MARKS, PHRASES, TEMPLATES

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


#: For each template, what its marks ask of a block's words ``s`` (one space around each).
_MARKED = " ".join(
    f"WHEN {t} THEN " + " AND ".join("(" + " OR ".join(f"contains(s, ' {run} ')" for run in mark.split("|")) + ")" for mark in marks)
    for t, marks in enumerate(MARKS) if marks)

ORACLE: dict[str, str] = {
    "op1_decontamination": f"""
WITH item_words AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, i + 1, i + least(10, len(w))), ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
places AS (
    SELECT doc_id, n, i, array_to_string(list_slice(w, i + 1, i + n), ' ') AS phrase
    FROM (SELECT doc_id, w, n, unnest(range(0, greatest(len(w) - n + 1, 0))) AS i
          FROM doc_words CROSS JOIN (SELECT DISTINCT n FROM windows))),
found AS (SELECT doc_id, i, places.n AS n, item_id FROM places JOIN windows USING (phrase)),
words_hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
items_hit AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)""",
    # every block against every template, no filters
    "op4_license_scan": f"""
WITH templates AS (
    SELECT t, label, list_distinct({_WORDS}) AS tw
    FROM (VALUES {_values((t, label, text) for t, (text, label) in enumerate(TEMPLATES))}) v(t, label, text)),
phrases AS (SELECT * FROM (VALUES {_values((p, len(p.split()), label) for p, label in PHRASES)}) v(phrase, n, label)),
texts AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce({_WORDS}, []) AS w FROM documents),
parts AS (
    SELECT r, w FROM texts
    UNION ALL SELECT r, {_WORDS} AS w FROM (SELECT r, unnest(string_split(text, chr(10))) AS text FROM texts)),
blocks AS (
    SELECT r, list_slice(w, j + 1, j + 64) AS b
    FROM (SELECT r, w, unnest(range(0, CASE WHEN len(w) <= 64 THEN least(len(w), 1) ELSE len(w) END, 32)) AS j FROM parts)),
matched AS (
    SELECT r, t, label, len(list_intersect(list_distinct(b), tw)) AS n, len(tw) AS m, ' ' || array_to_string(b, ' ') || ' ' AS s
    FROM blocks CROSS JOIN templates),
found AS (SELECT r, label, n / m AS score FROM matched WHERE n >= ceil(0.8 * m - 1e-9) AND CASE t {_MARKED} ELSE true END),
places AS (
    SELECT r, label, i
    FROM (SELECT r, w, unnest(range(0, len(w))) AS i FROM texts) CROSS JOIN phrases
    WHERE array_to_string(list_slice(w, i + 1, i + n), ' ') = phrase),
base AS (SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r),
every AS (
    SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
    FROM (SELECT * FROM found UNION ALL SELECT r, label, 1.0 FROM places) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, base.lo AS first_word, base.hi AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels, CAST(coalesce(every.score, 0) AS DOUBLE) AS score
FROM texts LEFT JOIN base USING (r) LEFT JOIN every USING (r)""",
    # every 100-byte string by its MD5; a document's repeats make runs, what lies between them is kept
    "op3_suffix_dedup": """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (
    SELECT doc_id, b, substr(h, 2 * b + 1, 2 * 611) AS part
    FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 99, 0), 512)) AS b FROM texts)),
places AS (
    SELECT doc_id, b + i AS pos, md5_number(substr(part, 2 * i + 1, 200)) AS mark
    FROM (SELECT doc_id, b, part, unnest(range(0, len(part) // 2 - 99)) AS i FROM blocks)),
firsts AS (SELECT mark, min((doc_id, pos)) AS first FROM places GROUP BY mark HAVING count(*) > 1),
again AS (
    SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS last
    FROM places JOIN firsts USING (mark) WHERE (doc_id, pos) <> first),
numbered AS (
    SELECT doc_id, pos, sum(CASE WHEN last IS NULL OR pos > last + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM again),
spans AS (SELECT doc_id, k, min(pos) AS lo, max(pos) + 100 AS hi FROM numbered GROUP BY doc_id, k),
edges AS (
    SELECT doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS before FROM spans
    UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2, coalesce((SELECT max(hi) FROM spans s WHERE s.doc_id = t.doc_id), 0) FROM texts t),
kept AS (
    SELECT doc_id, sum(hi - lo) AS n_removed, count(*) - 1 AS n_spans,
           string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo, hi) AS rest
    FROM edges JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
       sha256(unhex(rest)) AS kept_sha256
FROM texts JOIN kept USING (doc_id)""",
    "op5_substring_dedup": r"""
WITH texts AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i + 1, i + 20), ' ') AS phrase
    FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 19, 0))) AS i FROM texts)),
firsts AS (SELECT phrase, min((doc_id, i)) AS first FROM windows GROUP BY phrase HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j
    FROM windows JOIN firsts USING (phrase) WHERE (doc_id, i) <> first),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS rest
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS j FROM texts) ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)""",
    "op11_filter_audit": """
WITH marked AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS least FROM marked GROUP BY t),
masks AS (
    SELECT doc_id, part,
           (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END)
           + (CASE WHEN 100 * list_unique(w) < 50 * len(w) THEN 2 ELSE 0 END)
           + (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 4 ELSE 0 END)
           + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
           + (CASE WHEN doc_id > least THEN 16 ELSE 0 END) AS m
    FROM marked JOIN firsts USING (t)),
cells AS (
    SELECT part, m, count(*) AS c,
           count(*) FILTER (WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = masks.doc_id AND l.quality = 1)) AS good,
           count(*) FILTER (WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = masks.doc_id AND l.toxic = 1)) AS toxic
    FROM masks GROUP BY part, m),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (
    SELECT filter_order, CAST(step AS INT) AS step, bit,
           (SELECT coalesce(sum(x.bit), 0) FROM letters x WHERE instr(filter_order, x.letter) < step) AS before
    FROM orders, unnest(range(1, 6)) AS s(step) JOIN letters ON letter = substr(filter_order, step, 1)),
counted AS (
    SELECT part, filter_order, step, bit,
           coalesce(sum(c) FILTER (WHERE m & (CAST(before AS INT) | bit) = 0), 0) AS kept,
           coalesce(sum(c) FILTER (WHERE m & CAST(before AS INT) = 0 AND m & bit > 0), 0) AS removed,
           coalesce(sum(c) FILTER (WHERE m & CAST(before AS INT) > 0 AND m & bit > 0), 0) AS redundant,
           coalesce(sum(c) FILTER (WHERE m = bit), 0) AS unique_fails,
           coalesce(sum(good) FILTER (WHERE m & CAST(before AS INT) = 0 AND m & bit > 0), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (WHERE m & CAST(before AS INT) = 0 AND m & bit > 0), 0) AS toxic_lost
    FROM cells CROSS JOIN steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted""",
    # the checksum is that of zlib, from its table of 256 remainders
    "op12_spelling_variants": """
WITH RECURSIVE remainders AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)),
runs AS (
    SELECT d || ':' || w AS told, w, count(*) AS c
    FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
                 translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
          FROM documents)
    WHERE length(w) >= 6 GROUP BY ALL),
sums AS (
    SELECT w, c, xor(4294967295, list_reduce(
               list_prepend(4294967295, flatten(list_transform(string_split(told, ''), lambda x: CASE WHEN unicode(x) < 128
                   THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + CAST(unicode(x) AS BIGINT) // 64, 128 + CAST(unicode(x) AS BIGINT) % 64] END))),
               lambda s, b: xor(s // 256, t[xor(s % 256, b) + 1]))) AS h
    FROM runs, remainders),
vocabulary AS (
    SELECT word, CAST(sum(c) AS BIGINT) AS n
    FROM (SELECT c, CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM sums)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cuts AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM vocabulary, unnest(range(1, length(word) + 1)) AS p(i)),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN vocabulary b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN vocabulary b ON a.rest = b.word),
best AS (
    SELECT word, count(*) AS n_near, (list(near ORDER BY near_n DESC, near))[1] AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
formed AS (
    SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
           CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
    FROM vocabulary v LEFT JOIN best USING (word)),
walk AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN formed f ON f.word = w.next)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM walk WHERE next IS NULL) USING (word)""",
    "op13_embedding_near_dup": """
WITH RECURSIVE fine AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
sized AS (SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS size FROM fine),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sized a JOIN sized b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM classes""",
}
