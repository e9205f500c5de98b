"""Query of the n-gram Jaccard join (8) and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm.common import query, table
from quarterdeck.llm.ngram_join import join_report

#: Defines docs (row, doc_id, words), shingles, sizes, links and reach (row, other) over ``{source}``.
LINKS = r"""
docs AS (
  SELECT row, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM (SELECT row_number() OVER () AS row, * FROM {source})),
shingles AS (
  SELECT DISTINCT row, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
                            ELSE array_to_string(words[i:i + 4], ' ') END AS shingle
  FROM (SELECT row, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i
        FROM docs WHERE len(words) > 0)),
sizes AS (SELECT row, count(*) AS n FROM shingles GROUP BY row),
links AS (
  SELECT a, b FROM (
    SELECT x.row AS a, y.row AS b, count(*) AS common_n FROM shingles x JOIN shingles y USING (shingle)
    WHERE x.row <> y.row GROUP BY ALL)
  JOIN sizes s ON s.row = a JOIN sizes t ON t.row = b
  WHERE 100 * common_n >= 75 * (s.n + t.n - common_n)),
reach AS (
  SELECT row, row AS other FROM docs
  UNION
  SELECT reach.row, links.b FROM reach JOIN links ON links.a = reach.other)"""

SQL = f"""
WITH RECURSIVE {LINKS.replace("{source}", "documents")}
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM docs d JOIN reach ON reach.row = d.row JOIN docs o ON o.row = reach.other
LEFT JOIN sizes ON sizes.row = d.row
GROUP BY d.row, d.doc_id"""


@query("op8_ngram_join", SQL)
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_report(table(spark, sf_dir, "documents"))
