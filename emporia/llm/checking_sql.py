"""Checking SQL for the queries that SQL can express."""

from __future__ import annotations

from emporia.llm.secret_scan import BASE, MORE

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""

LINES = rf"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS held FROM documents),
lines AS (SELECT doc_id, unnest(held) AS line, generate_subscripts(held, 1) AS position FROM split),
keyed AS (SELECT *, {LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT *, key IN (SELECT key FROM common) AS dropped FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = r"regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
sized AS (SELECT item_id, words, least(len(words), 10) AS size FROM b WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS w
            FROM sized, unnest(range(1, len(words) - size + 2)) AS t(i)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS w
           FROM d, sizes, unnest(range(1, len(words) - size + 2)) AS t(i)),
found AS (SELECT doc_id, item_id, p.size, i FROM places p JOIN windows w ON p.w = w.w AND p.size = w.size),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(0, size)) AS t(k) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

MIXING = r"""
WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  row_number() OVER (PARTITION BY doc_id, source, text) AS nth FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (capped ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(weight) OVER (capped ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
           FROM weighed WINDOW capped AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
target AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE),
                  max(CASE WHEN level * weight <= 3 * source_size THEN level END) OVER () * weight) AS target FROM levels),
queued AS (SELECT doc_id, d.source, size, source_size, target,
                  sum(size) OVER turn AS up_to, row_number() OVER turn AS place
           FROM d JOIN target ON d.source IS NOT DISTINCT FROM target.source
           WINDOW turn AS (PARTITION BY d.source ORDER BY md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '') || ':' || nth))),
copies AS (SELECT source, place, copy, size, (copy * source_size + up_to) / target AS finish
           FROM queued, unnest([0, 1, 2]) AS t(copy) WHERE size > 0),
served AS (SELECT source, place, size, (SELECT sum(size) FROM d) - coalesce(sum(size) OVER (ORDER BY finish, source NULLS LAST, copy, place
                                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM copies),
taken AS (SELECT source, place, CAST(sum(least(size, room)) AS BIGINT) AS taken FROM served WHERE room > 0 GROUP BY source, place)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM queued LEFT JOIN taken ON queued.source IS NOT DISTINCT FROM taken.source AND queued.place = taken.place
"""

SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS found FROM documents) AS r(doc_id, found),
       LATERAL (SELECT translate(found, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run)
  WHERE length(found) >= 7 GROUP BY ALL),
crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END, b)) AS t),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
           flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + unicode(c)::BIGINT // 64, 128 + unicode(c)::BIGINT % 64] END)),
           lambda r, b: xor(r // 256, t[xor(r % 256, b) + 1]), 4294967295)) AS h
  FROM runs, crc),
vocabulary AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
shorter AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM vocabulary, unnest(range(1, length(word) + 1)) AS t(i)),
near AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, v.word FROM shorter s JOIN vocabulary v ON s.rest = v.word
  UNION SELECT v.word, s.word FROM shorter s JOIN vocabulary v ON s.rest = v.word),
best AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
  FROM near JOIN vocabulary o ON other = o.word),
forms AS (SELECT b.word, other AS form, other_n AS form_n FROM best b JOIN vocabulary v ON b.word = v.word WHERE place = 1 AND other_n >= 10 * v.n),
chain AS (
  SELECT word, word AS root, 0 AS step FROM vocabulary
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON c.root = f.word),
roots AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT v.word, form, root, n, coalesce(n_near, 0) AS n_near, form_n
FROM vocabulary v JOIN roots ON v.word = roots.word LEFT JOIN forms f ON v.word = f.word
     LEFT JOIN (SELECT word, n_near FROM best WHERE place = 1) b ON v.word = b.word
"""

NEGATIVES = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
                  CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
           FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
             QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
                AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def _kind(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of one kind with their places, from the text between them.

    The database knows no look-behind: such a rule matches the character before as well, and the place moves past it.
    """
    before = pattern.startswith("(?<![")
    if before:
        held, rest = pattern[4:].split(")", 1)
        pattern, group = f"(?:^|[^{held[1:]})({rest})", 1
    held = pattern.replace("'", "''")
    moved = " + length(whole) - length(part)" if before else ""
    return rf"""
SELECT doc_id, {number} AS kind, '{kind}' AS name, start{moved} AS start, start + length(whole) AS stop FROM (
  SELECT doc_id, whole, part, CAST(sum(gap) OVER same + coalesce(sum(length(whole)) OVER (same ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM (SELECT doc_id, n, unnest(wholes) AS whole, unnest(parts) AS part, unnest(gaps) AS gap, generate_subscripts(wholes, 1) AS i
        FROM (SELECT doc_id, row_number() OVER () AS n, regexp_extract_all(text, '{held}') AS wholes,
                     regexp_extract_all(text, '{held}', {group}) AS parts,
                     list_transform(string_split_regex(text, '{held}'), lambda x: length(x))[1:len(regexp_extract_all(text, '{held}'))] AS gaps
              FROM documents WHERE regexp_matches(text, '{held}')))
  WINDOW same AS (PARTITION BY n ORDER BY i)) WHERE length(part) >= {least}"""


def secrets() -> str:
    kinds = " UNION ALL ".join(_kind(i, r.kind, r.pattern, r.group, r.least) for i, r in enumerate(BASE + MORE))
    listed = "string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop)"
    return f"""
WITH spans AS ({kinds}),
told AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = {i}) AS n_{r.kind}" for i, r in enumerate(BASE))},
                {listed} FILTER (kind < {len(BASE)}) AS base, {listed} AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN told USING (doc_id)"""
