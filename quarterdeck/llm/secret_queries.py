"""Query of the secret scan (1) and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm.common import query, table
from quarterdeck.llm.secrets import RULES, report


def _sql() -> str:
    """The rules as whole scans: parts between matches give the places, as positions of a split."""
    def spans(order: int, kind: str, pattern: str, group: int, least: int) -> str:
        quoted = pattern.replace("'", "''")
        return f"""
  SELECT row, {order} AS ord, '{kind}' AS kind, start, start + size AS stop FROM (
    SELECT row, size, value,
           1 + gap_sum + size_sum - size - 1 AS start
    FROM (SELECT row, size, value,
                 sum(gap) OVER w AS gap_sum, sum(size) OVER w AS size_sum
          FROM (SELECT row, unnest(gaps) AS gap, unnest(sizes) AS size, unnest("values") AS value,
                       unnest(range(len(gaps))) AS i
                FROM (SELECT row, list_transform(regexp_split_to_array(text, '{quoted}'),
                                                 lambda x: length(x)) AS gaps,
                             list_transform(regexp_extract_all(text, '{quoted}', 0),
                                            lambda x: length(x)) AS sizes,
                             list_transform(regexp_extract_all(text, '{quoted}', {group}),
                                            lambda x: length(x)) AS "values"
                      FROM docs WHERE regexp_matches(text, '{quoted}')))
          WINDOW w AS (PARTITION BY row ORDER BY i)))
  WHERE value >= {least}"""

    found = " UNION ALL ".join(
        spans(i, r.kind, r.pattern, r.value_group, r.least) for i, r in enumerate(RULES))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found}),
joined AS (
  SELECT row,
         count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord)
           FILTER (kind IN ('assign', 'access', 'hex')) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
  FROM found GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (row)"""


@query("op1_secrets", _sql())
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
