"""Query of the Merkle manifest (13) and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm.common import query, table
from quarterdeck.llm.merkle import TAMPERED, manifest


def _leaf(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(
        f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in fields) + ")"


def _levels(name: str, source: str) -> str:
    """All nodes of the trees of ``source`` (tree, pos, hash, n)."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, pos, hash, n FROM {source}
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2, n)"""


def _steps(name: str, source: str, levels: str, after: int) -> str:
    """What each node of ``source`` (key, tree, pos) meets on the way up."""
    return f"""
{name} AS (
  SELECT s.key, {after} + l.level AS step,
         CASE WHEN o.hash IS NULL THEN '' WHEN s.pos >> l.level & 1 = 1 THEN 'L' || o.hash
              ELSE 'R' || o.hash END AS met
  FROM {source} s JOIN (SELECT DISTINCT tree, level, n FROM {levels} WHERE n > 1) l USING (tree)
  LEFT JOIN {levels} o ON o.tree = s.tree AND o.level = l.level
                      AND o.pos = xor((s.pos >> l.level)::BIGINT, 1))"""


SQL = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS key, coalesce('=' || lang, '') AS tree, doc_id,
         {_leaf("n_chars")} AS hash, {_leaf("n_chars + 1")} AS changed, n_chars IS NULL AS unset,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
               lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)),
           4294967295) AS crc
  FROM documents),
leaves AS (
  SELECT key, tree, doc_id, hash, CASE WHEN crc % {TAMPERED} = 0 AND NOT unset THEN changed ELSE hash END
         AS claimed,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM docs),
{_levels("nodes", "leaves")},
subroots AS (
  SELECT tree AS key, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, hash,
         count(*) OVER () AS n FROM nodes WHERE n = 1),
{_levels("tops", "subroots")},
{_steps("inner_steps", "leaves", "nodes", 0)},
{_steps("outer_steps", "subroots", "tops", 1000)},
paths AS (
  SELECT key, string_agg(met[2:], '' ORDER BY step) AS proof, list(met ORDER BY step) AS path
  FROM (SELECT * FROM inner_steps
        UNION ALL SELECT l.key, o.step, o.met FROM leaves l JOIN outer_steps o ON o.key = l.tree)
  GROUP BY key),
folded AS (
  SELECT doc_id, l.hash AS leaf, s.hash AS subroot, t.hash AS root,
         sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_prepend(claimed, coalesce(path, [])), lambda h, e:
           CASE e[1] WHEN 'L' THEN sha256(e[2:] || h) WHEN 'R' THEN sha256(h || e[2:])
                     ELSE sha256(h) END) AS folded_root
  FROM leaves l JOIN subroots s ON s.key = l.tree JOIN tops t ON t.n = 1 LEFT JOIN paths p ON p.key = l.key)
SELECT *, folded_root = root AS verified FROM folded"""


@query("op13_merkle", SQL)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
