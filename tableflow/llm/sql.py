"""SQL for DuckDB of the queries that take more than a few lines of it."""

from __future__ import annotations

from itertools import permutations

from tableflow.llm import quality_rules

NGRAM_JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' ')))) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
       JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n
  HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM sizes
  UNION SELECT reached.x, links.y FROM reached JOIN links ON links.x = reached.y)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, min(y) AS component FROM reached GROUP BY x) USING (doc_id)
"""


def quality_rules_sql() -> str:
    """Figures, votes, and the estimation as a recursive query with one row for each round."""
    small = ", ".join(f"'{word}'" for word in dict.fromkeys(quality_rules.SMALL_WORDS))
    rules = range(1, 8)

    def pick(j: int, side: str, vote: int) -> str:
        return f"sum(CASE WHEN v[{j}] = {vote} THEN {side} ELSE 0 END)"

    def share(j: int, side: str, right: int) -> str:
        return f"({pick(j, side, right)} + 1) / ({pick(j, side, right)} + {pick(j, side, -right)} + 2)"

    good = ", ".join(f"least(greatest({share(j, 'g', 1)}, 0.9), 0.9999)" for j in rules)
    bad = ", ".join(f"least(greatest({share(j, 'b', -1)}, 0.01), 0.99)" for j in rules)
    odds = "ln(prior / (1 - prior)) + list_sum([" + ", ".join(
        f"CASE v[{j}] WHEN 1 THEN ln(good[{j}] / (1 - bad[{j}])) WHEN -1 THEN ln((1 - good[{j}]) / bad[{j}]) ELSE 0 END"
        for j in rules) + "])"
    return rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM split, unnest(range(1, len(words) - 1)) AS r(i)),
again AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
repeats AS (
  SELECT doc_id, sum(least(3, i - coalesce(before, -9))) AS n
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM again) GROUP BY doc_id),
figures AS (
  SELECT split.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines, length(regexp_replace(body, '[^A-Z]', '', 'g')) AS n_upper,
         len(list_intersect([{small}], list_distinct(words))) AS n_small
  FROM split LEFT JOIN repeats ON repeats.doc_id = split.doc_id),
votes AS (
  SELECT *, CASE WHEN n_words = 0 THEN [-1, 0, 0, 0, 0, 0, 0] ELSE [
    CASE WHEN n_words < {quality_rules.MIN_WORDS} THEN -1 ELSE 0 END,
    CASE WHEN word_chars / n_words < 2 OR word_chars / n_words > 9 THEN -1 WHEN word_chars / n_words BETWEEN 3 AND 7.5 THEN 1 ELSE 0 END,
    CASE WHEN n_symbols * 10 > n_words THEN -1 WHEN n_symbols * 30 <= n_words THEN 1 ELSE 0 END,
    CASE WHEN n_dup_lines * 10 > n_lines * 3 THEN -1 WHEN n_dup_lines * 10 <= n_lines THEN 1 ELSE 0 END,
    CASE WHEN n_repeat_words * 10 > n_words * 3 THEN -1 WHEN n_repeat_words * 10 <= n_words THEN 1 ELSE 0 END,
    CASE WHEN n_upper * 5 > word_chars THEN -1 WHEN n_upper * 10 <= word_chars THEN 1 ELSE 0 END,
    CASE WHEN n_small = 0 THEN -1 WHEN n_small >= 4 THEN 1 ELSE 0 END] END AS v
  FROM figures),
patterns AS (SELECT v, CAST(count(*) AS DOUBLE) AS n FROM votes GROUP BY v),
em AS (
  SELECT 0 AS round, CAST(0.9 AS DOUBLE) AS prior, list_transform(range(7), lambda j: CAST(0.95 AS DOUBLE)) AS good,
         list_transform(range(7), lambda j: CAST(0.5 AS DOUBLE)) AS bad
  UNION ALL
  SELECT round + 1, least(greatest(sum(g) / sum(g + b), 0.01), 0.99), [{good}], [{bad}]
  FROM (SELECT round, v, n * p AS g, n * (1 - p) AS b
        FROM (SELECT round, v, n, 1 / (1 + exp(-({odds}))) AS p FROM em, patterns WHERE round < {quality_rules.ROUNDS}))
  GROUP BY round)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND odds >= 0 AS kept,
       round(1 / (1 + exp(-odds)), 6) AS probability
FROM (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
             {odds} AS odds
      FROM votes, (SELECT prior, good, bad FROM em WHERE round = {quality_rules.ROUNDS}))
"""


def vector_codes_sql() -> str:
    """One step of common table expressions for each round."""
    rounds = []
    for r in range(4):
        rounds.append(f"""
near{r} AS (
  SELECT i, p, part, min(list_sum(list_transform(list_zip(part, entry), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) * 256 + e) AS best
  FROM parts JOIN book{r} USING (p) GROUP BY i, p, part),
sums{r} AS (
  SELECT p, CAST(best % 256 AS BIGINT) AS e, j, CAST(floor(sum(part[j]) / count(*)) AS BIGINT) AS x
  FROM near{r}, unnest(range(1, len(part) + 1)) AS t(j) GROUP BY ALL),
book{r + 1} AS (
  SELECT p, e, coalesce(moved, entry) AS entry
  FROM book{r} LEFT JOIN (SELECT p, e, list(x ORDER BY j) AS moved FROM sums{r} GROUP BY p, e) USING (p, e))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS i, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT i, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS part FROM kept, unnest(range(4)) AS t(p)),
book0 AS (SELECT p, i AS e, part AS entry FROM parts WHERE i < 256),{",".join(rounds)},
final AS (
  SELECT i, p, min(list_sum(list_transform(list_zip(part, entry), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) * 256 + e) AS best
  FROM parts JOIN book4 USING (p) GROUP BY i, p),
coded AS (
  SELECT i, string_agg(format('{{:02x}}', CAST(best % 256 AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error
  FROM final GROUP BY i)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) FROM book4) AS codebooks_sha256
FROM kept JOIN coded USING (i)
"""


def filter_audit_sql() -> str:
    """All documents against every step of every order."""
    orders = ", ".join(f"('{''.join(order)}')" for order in permutations("ABCDE"))
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
failed AS (
  SELECT doc_id, part, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
         coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, FALSE)] AS fails
  FROM texts),
judged AS (
  SELECT f.part, f.fails, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic
  FROM failed f LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) USING (doc_id)),
cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged GROUP BY part, fails),
steps AS (
  SELECT o AS filter_order, CAST(s AS INT) AS step, ascii(o[s]) - 64 AS own,
         list_transform(range(1, s), lambda j: ascii(o[j]) - 64) AS before
  FROM (VALUES {orders}) AS v(o), unnest(range(1, 6)) AS t(s)),
counted AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT gone AND NOT fails[own] THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND fails[own] THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND fails[own] THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails[own] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND fails[own] THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND fails[own] THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT *, len(list_filter(before, lambda j: fails[j])) > 0 AS gone FROM cells, steps)
  GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
