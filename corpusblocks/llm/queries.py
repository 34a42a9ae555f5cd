"""The queries of the numbered operators, and their SQL where it exists."""

from __future__ import annotations

from corpusblocks.llm.alignment import op11_pair_bitmaps
from corpusblocks.llm.bpe_automaton import op1_bpe_automaton
from corpusblocks.llm.fingerprints import op3_fingerprints
from corpusblocks.llm.language_id import op2_language_id
from corpusblocks.llm.line_dedup import op4_line_dedup
from corpusblocks.llm.mixing import op9_fair_mixing
from corpusblocks.llm.neighbours import op10_graph_neighbours
from corpusblocks.llm.personal import op13_personal_data
from corpusblocks.llm.secrets import RULES, op7_secret_ledger
from corpusblocks.llm.simhash import op8_simhash_groups
from corpusblocks.llm.spelling import op12_spelling_variants
from corpusblocks.llm.token_counts import op5_token_counts
from corpusblocks.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_bpe_automaton": op1_bpe_automaton,
    "op2_language_id": op2_language_id,
    "op3_fingerprints": op3_fingerprints,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_toxicity": op6_toxicity,
    "op7_secret_ledger": op7_secret_ledger,
    "op8_simhash_groups": op8_simhash_groups,
    "op9_fair_mixing": op9_fair_mixing,
    "op10_graph_neighbours": op10_graph_neighbours,
    "op11_pair_bitmaps": op11_pair_bitmaps,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_personal_data": op13_personal_data,
}

# Weighted fair queueing with windows over whole sources, which a single machine can afford.
_MIXING = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::DOUBLE AS w
  FROM totals),
stops AS (SELECT *, (source_size * 2)::DOUBLE / w AS stop FROM weighted),
levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - 2 * coalesce(sum(source_size) OVER (
      ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(w) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM stops),
targets AS (
  SELECT source, source_size, least(source_size * 2.0::DOUBLE, coalesce(
    (SELECT level FROM levels WHERE stop >= level ORDER BY stop, level LIMIT 1) * w, source_size * 2.0::DOUBLE)) AS target
  FROM levels),
queued AS (
  SELECT doc_id, size, source_size, target, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY
      CAST('0x' || substr(md5('9:' || doc_id), 1, 15) AS BIGINT), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
timed AS (
  SELECT *, (before_ + size)::DOUBLE / target AS f0, (source_size + before_ + size)::DOUBLE / target AS f1 FROM queued),
merged AS (
  SELECT finish, sum(size) OVER (ORDER BY finish, size ROWS UNBOUNDED PRECEDING) AS words
  FROM (SELECT size, f0 AS finish FROM timed UNION ALL SELECT size, f1 FROM timed) WHERE size > 0),
cut AS (SELECT min(finish) AS v FROM merged WHERE words > 1.5 * (SELECT sum(size) FROM sizes))
SELECT doc_id, size, source_size, target, CAST(size * (
  CASE WHEN v IS NULL OR f0 < v THEN 1 ELSE 0 END + CASE WHEN v IS NULL OR f1 < v THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM timed, cut"""


def _secrets() -> str:
    """Spans of every rule from the lengths of matches and of what stands between them."""
    parts = []
    for k, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, {str(rule.base).lower()} AS base, start, start + length(h[i]) AS stop FROM (
  SELECT *, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
  FROM (SELECT doc_id, g, h, v, unnest(range(1, len(h) + 1)) AS i FROM (
    SELECT doc_id, string_split_regex(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}', 0) AS h,
      regexp_extract_all(text, '{pattern}', {rule.group}) AS v FROM texts)))
WHERE length(v[i]) >= {rule.least}""")
    spans = " UNION ALL ".join(parts)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES if r.base)
    listed = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k){0}, '')"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({spans})
SELECT doc_id, {counts}, sha256({listed.format(" FILTER (base)")}) AS base_sha256, {listed.format("")} AS spans
FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


ORACLE_SQL: dict[str, str] = {"op7_secret_ledger": _secrets(), "op9_fair_mixing": _MIXING}
