"""DuckDB SQL for the queries that SQL can express."""

from . import mixing, quality_rules

WORD = r"'[^\x20\x09-\x0D]+'"

OP8 = rf"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), {WORD})) AS BIGINT) AS size FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM totals
), placed AS (
  SELECT *,
    CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS budget_left,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY source_size / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
  FROM weighed
), levelled AS (
  SELECT *, max(CASE WHEN budget_left / weight_left * w <= 3 * source_size THEN budget_left / weight_left END) OVER () AS level FROM placed
), targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), coalesce(level * w, CAST(3 * source_size AS DOUBLE))) AS target FROM levelled
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source, doc_id, digest) - 1 AS nth FROM sized
), hashed AS (
  SELECT *, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || nth || ':' || digest) AS h FROM numbered
), rated AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    CAST('0x' || substr(h, 1, {mixing.DRAW_DIGITS}) AS BIGINT) AS first, CAST('0x' || substr(h, {mixing.DRAW_DIGITS + 1}, {mixing.DRAW_DIGITS}) AS BIGINT) AS step
  FROM hashed d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), extras AS (
  SELECT source, salt, abs(max(floor(rate) * source_size) + sum(CASE WHEN CAST((first + salt * step) % {mixing.DRAWS} AS DOUBLE) / {float(mixing.DRAWS)!r}::DOUBLE < rate - floor(rate) THEN size ELSE 0 END) - max(target)) AS off
  FROM rated, (SELECT unnest(range(0, {mixing.SALTS})) AS salt) GROUP BY source, salt
), salts AS (
  SELECT source, salt FROM extras QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, salt) = 1
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN CAST((first + salt * step) % {mixing.DRAWS} AS DOUBLE) / {float(mixing.DRAWS)!r}::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated r JOIN salts s ON r.source IS NOT DISTINCT FROM s.source
"""


def _rules_sql(table: str) -> str:
    """CTEs ending in ``judged``: every row of ``table`` with its measures, base_failed, kept."""
    q = quality_rules
    rate = {m: f"CASE WHEN {e.split(' / ')[1]} > 0 THEN CAST({e.split(' / ')[0]} AS DOUBLE) / {e.split(' / ')[1]} ELSE 0 END" for m, (e, _) in q.METRICS.items()}
    values = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {e} AS x FROM measured WHERE NOT base_failed" for m, e in rate.items())
    spread = " ".join(f"WHEN '{m}' THEN {least}::DOUBLE" for m, (_, least) in q.METRICS.items())

    def fences(level: str, keys: list[str]) -> str:
        k = "".join(f"{x}, " for x in keys)
        limits = ", ".join(f"max(CASE WHEN metric = '{m}' THEN fence END) AS {m}_limit" for m in q.METRICS)
        group = f"GROUP BY {', '.join(keys)}" if keys else ""
        return f"""
{level}_ranked AS (
  SELECT {k}metric, bucket,
    sum(sum(n)) OVER (PARTITION BY {k}metric ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto, sum(sum(n)) OVER (PARTITION BY {k}metric) AS rows_
  FROM sketch GROUP BY {k}metric, bucket
), {level}_quartiles AS (
  SELECT {k}metric, max(rows_) AS rows_, min(CASE WHEN upto >= 0.25 * rows_ THEN bucket END) AS low, min(CASE WHEN upto >= 0.5 * rows_ THEN bucket END) AS mid
  FROM {level}_ranked GROUP BY {k}metric
), {level}_ends AS (
  SELECT {k}metric, rows_, CASE WHEN low = {q.ZERO_BUCKET} THEN 0 ELSE pow({q.GAMMA}::DOUBLE, low) END AS low, CASE WHEN mid = {q.ZERO_BUCKET} THEN 0 ELSE pow({q.GAMMA}::DOUBLE, mid) END AS mid
  FROM {level}_quartiles
), {level}_fences AS (
  SELECT {k}max(rows_) AS rows_, {limits}
  FROM (SELECT *, mid + {q.FENCE}::DOUBLE * greatest(mid - low, CASE metric {spread} END) AS fence FROM {level}_ends) {group}
)"""

    drawn = lambda n, own, to: f"(CAST({n} AS DOUBLE) * {own} + {q.PRIOR_ROWS} * {to}) / ({n} + {q.PRIOR_ROWS})"
    chosen = ", ".join(f"{drawn('o.rows_', f'o.{m}_limit', drawn('w.rows_', f'w.{m}_limit', f'(SELECT {m}_limit FROM all_fences)'))} AS {m}_limit" for m in q.METRICS)
    within = " AND ".join(f"coalesce({e} <= {m}_limit, TRUE)" for m, e in rate.items())
    symbols = r"'[#*$%&|<>]'"
    return rf"""
texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text FROM {table}
), worded AS (
  SELECT *, regexp_extract_all(text, {WORD}) AS words FROM texts
), grams AS (
  SELECT row_id, i, array_to_string(list_slice(words, i, i + {q.WINDOW - 1}), ' ') AS gram
  FROM (SELECT row_id, words, unnest(range(1, len(words) - {q.WINDOW - 2})) AS i FROM worded WHERE len(words) >= {q.WINDOW})
), again AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT row_id, count(*) AS n FROM (SELECT DISTINCT row_id, unnest(range(i, i + {q.WINDOW})) AS at FROM again) GROUP BY row_id
), lines AS (
  SELECT row_id, line FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, {WORD})
), line_counts AS (
  SELECT row_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY row_id
), counted AS (
  SELECT row_id, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, {symbols}, '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM worded LEFT JOIN line_counts USING (row_id) LEFT JOIN covered USING (row_id)
), measured AS (
  SELECT *, (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM counted
), sketch AS (
  SELECT lang, source, metric, CASE WHEN x <= {q.ZERO_BELOW!r} THEN {q.ZERO_BUCKET} ELSE CAST(ceil(ln(x) / ln({q.GAMMA}::DOUBLE)) AS INTEGER) END AS bucket, count(*) AS n
  FROM ({values}) GROUP BY ALL
),{fences("own", ["lang", "source"])},{fences("wide", ["lang"])},{fences("all", [])}
, limits AS (
  SELECT o.lang, o.source, {chosen} FROM own_fences o LEFT JOIN wide_fences w ON o.lang IS NOT DISTINCT FROM w.lang
), judged AS (
  SELECT m.*, (NOT base_failed AND {within}) AS kept
  FROM measured m LEFT JOIN limits l ON m.lang IS NOT DISTINCT FROM l.lang AND m.source IS NOT DISTINCT FROM l.source
)"""


OP9 = f"WITH {_rules_sql('documents')} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"

ORACLES = {"op8_mix_sources": OP8, "op9_quality_rules": OP9}
