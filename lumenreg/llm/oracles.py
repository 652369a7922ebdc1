"""DuckDB SQL for the queries that SQL can express: licence scans, quality rules, spelling variants."""

from __future__ import annotations

from lumenreg.llm import licenses as N
from lumenreg.llm import quality_rules as Q
from lumenreg.llm import variants as V

WORD = r"[^\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def licences() -> str:
    templates = ",\n".join(f"({i}, {_text(n)}, {_text(t)})" for i, (n, t) in enumerate(N.TEMPLATES))
    windows = ", ".join(f"({w})" for w in N.WINDOWS)
    term, mit_0 = "[a-z0-9.+]+", ", ".join(map(_text, N.MIT_0))
    return rf"""
WITH files AS (
  SELECT doc_id, text, row_number() OVER () AS file,
         concat_ws('/', source, CAST(doc_id // 1000 AS VARCHAR), CAST(doc_id AS VARCHAR) || '.txt') AS path
  FROM documents),
file_terms AS (
  SELECT file, trim(unnest(regexp_extract_all(replace(lower(text), {mit_0}), '{term}')), '.') AS term FROM files),
template AS (SELECT * FROM (VALUES {templates}) t(template, license, body)),
template_tf AS (
  SELECT template, license, term, count(*) AS tf FROM (
    SELECT template, license, trim(unnest(regexp_extract_all(replace(lower(body), {mit_0}), '{term}')), '.') AS term
    FROM template) WHERE term <> '' GROUP BY ALL),
vocabulary AS (SELECT DISTINCT term FROM template_tf),
total AS (SELECT count(*) AS n FROM files),
idf AS (
  SELECT v.term, ln((1 + any_value(total.n)) / (1 + count(DISTINCT f.file))) + 1 AS idf
  FROM vocabulary v LEFT JOIN file_terms f ON f.term = v.term CROSS JOIN total GROUP BY v.term),
vectors AS (
  SELECT template, license, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY template)) AS v
  FROM template_tf JOIN idf USING (term)),
lines AS (
  SELECT file, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM files),
anchors AS (
  SELECT file, pos FROM lines WHERE regexp_matches(line, {_text(N.ANCHOR)})),
blocks AS (
  SELECT DISTINCT file, block FROM (
    SELECT a.file, a.pos, w.w, string_agg(l.line, ' ' ORDER BY l.pos) AS block
    FROM anchors a CROSS JOIN (VALUES {windows}) w(w)
    JOIN lines l ON l.file = a.file AND l.pos BETWEEN a.pos AND a.pos + w.w - 1
    GROUP BY a.file, a.pos, w.w)),
unit_tf AS (
  SELECT file, block, term, count(*) AS tf, any_value(n) AS n FROM (
    SELECT file, block, term, count(*) OVER (PARTITION BY file, block) AS n FROM (
      SELECT file, block, trim(unnest(regexp_extract_all(replace(lower(block), {mit_0}), '{term}')), '.') AS term FROM blocks)
    WHERE term <> '') GROUP BY file, block, term),
unit AS (
  SELECT u.*, idf.idf, CASE WHEN idf.idf IS NULL THEN tf * (ln(1 + total.n) + 1) ** 2
                            ELSE (tf * idf.idf) ** 2 END AS squares
  FROM unit_tf u LEFT JOIN idf USING (term) CROSS JOIN total),
lengths AS (SELECT file, block, sqrt(sum(squares)) AS len FROM unit GROUP BY ALL),
scored AS (
  SELECT u.file, u.n, v.license, round(sum(u.tf * u.idf * v.v) / any_value(l.len), 6) AS cosine
  FROM unit u JOIN vectors v USING (term) JOIN lengths l ON l.file = u.file AND l.block = u.block
  GROUP BY u.file, u.block, u.n, v.template, v.license
  HAVING round(sum(u.tf * u.idf * v.v) / any_value(l.len), 6) >= {N.MIN_COSINE}),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY file ORDER BY cosine DESC, license, n) = 1),
sizes AS (SELECT file, count(*) AS size FROM file_terms WHERE term <> '' GROUP BY file),
placed AS (
  SELECT f.file, f.path, regexp_replace(regexp_replace(f.path, '[^/]*$', ''), '/+$', '') AS folder FROM files f),
folders AS (
  SELECT p.folder AS above, p.path AS license_path, b.license
  FROM best b JOIN placed p USING (file) JOIN sizes s USING (file)
  WHERE b.n * 2 >= s.size OR regexp_matches(regexp_extract(p.path, '([^/]*)$', 1), {_text(N.LICENCE_FILE)})
  QUALIFY row_number() OVER (PARTITION BY p.folder ORDER BY b.cosine DESC, p.path, b.license) = 1),
above AS (
  SELECT folder, array_to_string(string_split(folder, '/')[1:k], '/') AS above
  FROM (SELECT DISTINCT folder FROM placed), range(0, 20) r(k) WHERE k <= len(string_split(folder, '/'))),
nearest AS (
  SELECT a.folder, f.license_path, f.license FROM above a JOIN folders f USING (above)
  QUALIFY row_number() OVER (PARTITION BY a.folder ORDER BY length(a.above) DESC) = 1)
SELECT f.doc_id, f.path, coalesce(b.license, n.license) AS license, b.cosine,
       CASE WHEN b.license IS NOT NULL THEN 'own' WHEN n.license IS NOT NULL THEN 'inherited'
            ELSE 'none' END AS origin,
       CASE WHEN b.license IS NULL THEN n.license_path END AS license_path
FROM files f JOIN placed p USING (file) LEFT JOIN best b USING (file) LEFT JOIN nearest n ON n.folder = p.folder"""


def quality_rules() -> str:
    grid = ", ".join(f"({i}, CAST('{c!r}' AS DOUBLE))" for i, c in enumerate(Q.GRID))
    ratios = "\n  UNION ALL ".join(
        f"SELECT file, '{rule}' AS rule, {top} / greatest({under}, 1) AS ratio FROM stats"
        for rule, (top, under) in Q.RULES.items())
    risk = f"(CAST('{Q.RISK / len(Q.RULES)!r}' AS DOUBLE))"
    kept = lambda marks: rf"length(regexp_replace(t, '[^{marks}]', '', 'g'))"
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS file, doc_id, lang AS stratum, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '{WORD}') AS words FROM texts),
windows AS (
  SELECT file, i, count(*) OVER (PARTITION BY file, array_to_string(words[i:i + 4], ' ')) AS times
  FROM (SELECT file, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
repeats AS (
  SELECT file, count(DISTINCT i + k) AS n FROM windows, range(0, 5) r(k) WHERE times > 1 GROUP BY file),
lines AS (
  SELECT file, count(*) AS n, count(DISTINCT line) AS kinds
  FROM (SELECT file, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{WORD}') GROUP BY file),
stats AS (
  SELECT s.file, s.doc_id, s.stratum, len(words) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         {kept('#*$%&|<>')} AS n_symbols, {kept('!')} AS n_shouts, {kept('A-Z')} AS n_upper,
         {kept('0-9')} AS n_digits, coalesce(l.n, 0) AS n_lines,
         coalesce(l.n - l.kinds, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN lines l USING (file) LEFT JOIN repeats r USING (file)),
judged AS (
  SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM stats),
ratios AS ({ratios}),
grid AS (SELECT * FROM (VALUES {grid}) g(i, cutoff)),
good AS (
  SELECT doc_id, avg(quality) >= 0.5 AS good FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
labelled AS (
  SELECT j.file, j.stratum, g.good,
         substr(md5('holdout ' || CAST(j.doc_id AS VARCHAR)), 1, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e') AS holdout
  FROM judged j JOIN good g USING (doc_id) WHERE NOT j.base_failed),
strata AS (SELECT count(*) AS n FROM (SELECT DISTINCT stratum FROM labelled)),
cells AS (
  SELECT l.stratum, r.rule, g.i, g.cutoff,
         count(*) FILTER (good AND holdout) AS total,
         count(*) FILTER (good AND holdout AND ratio > cutoff) AS lost,
         count(*) FILTER (NOT good AND NOT holdout AND ratio > cutoff)
           - {Q.GOOD_WEIGHT} * count(*) FILTER (good AND NOT holdout AND ratio > cutoff) AS gain
  FROM labelled l JOIN ratios r USING (file) CROSS JOIN grid g GROUP BY ALL),
tails AS (
  SELECT c.stratum, c.rule, c.i, sum(exp(lgamma(total + 1) - lgamma(k + 1) - lgamma(total - k + 1)
         + k * ln({risk}) + (total - k) * ln(1 - {risk}))) AS tail
  FROM cells c, range(0, 1000000) r(k) WHERE k <= lost AND total > lost GROUP BY ALL),
certified AS (
  SELECT c.*, bool_and(coalesce(t.tail <= {Q.DELTA} / (strata.n * {len(Q.RULES)}), false))
                OVER (PARTITION BY c.stratum, c.rule ORDER BY c.i) AS ok
  FROM cells c CROSS JOIN strata LEFT JOIN tails t
    ON t.stratum IS NOT DISTINCT FROM c.stratum AND t.rule = c.rule AND t.i = c.i),
chosen AS (
  SELECT stratum, rule, cutoff FROM certified WHERE ok AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, i) = 1),
failed AS (
  SELECT DISTINCT j.file FROM judged j JOIN ratios r USING (file)
  JOIN chosen c ON c.stratum IS NOT DISTINCT FROM j.stratum AND c.rule = r.rule AND r.ratio > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND f.file IS NULL AS kept, stratum
FROM judged j LEFT JOIN failed f ON f.file = j.file"""


def spelling_variants() -> str:
    letters = "".join(map(chr, range(65, 91)))
    return rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{letters}', '{letters.lower()}') AS run
    FROM documents) GROUP BY id, run),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
           string_split(id || ':' || run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT]
             ELSE [195::BIGINT, ord(x)::BIGINT - 64] END))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM runs CROSS JOIN crc_table),
vocabulary AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % {V.DAMAGE} = 0
                       THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                       ELSE run END AS word FROM hashed)
  WHERE length(word) >= {V.MIN_LETTERS} GROUP BY word HAVING sum(times) >= {V.MIN_COUNT}),
shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b USING (rest, i)
  WHERE a.word <> b.word
  UNION SELECT s.word, v.word, v.n FROM shorter s JOIN vocabulary v ON v.word = s.rest
  UNION SELECT v.word, s.word, s.n FROM shorter s JOIN vocabulary v ON v.word = s.rest),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
forms AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.near_n >= {V.LEAD} * v.n THEN b.near END AS form,
         CASE WHEN b.near_n >= {V.LEAD} * v.n THEN b.near_n END AS form_n
  FROM vocabulary v LEFT JOIN best b USING (word)),
chain(word, last) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.last AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.last AND e.form IS NULL"""


ORACLES = {"op2_licenses": licences(), "op5_quality_rules": quality_rules(),
           "op12_variants": spelling_variants()}
