"""Stored tables: append, upsert, update, insert-if-absent, key check, loads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from quarterdeck.functions.names import KEY
from quarterdeck.functions.periods import fiscal_ordinal, fiscal_year, ordinal, quarter_date
from quarterdeck.operators import splits
from quarterdeck.plans import loading
from quarterdeck.session import fresh_path
from quarterdeck.sources import readers, schemas, tables
from quarterdeck.streaming.upsert import stream_upsert
from workload import tables as views
from workload.catalog import query
from workload.event_queries import _SPLIT_VIEWS, _TABLE_END, _split_facts
from workload.oracle import fiscal

CUT, OVERLAP = ordinal(1999, 1), ordinal(1998, 1)


def _stored(spark, sf_dir):
    rows = views.facts(spark, sf_dir).select(*KEY, "PriceAvg", "TotalRevenue")
    return rows.withColumn("fy", fiscal_year(F.col("q_ord")))


_STORED = """SELECT entity, q_ord, "PriceAvg", "TotalRevenue",
    CAST(q_ord // 4 AS INTEGER) AS fy FROM facts"""
_UPSERTED = f"""
    SELECT entity, q_ord, fy, "PriceAvg", "TotalRevenue", NULL::DOUBLE AS "Score" FROM stored
    WHERE q_ord < {OVERLAP}
    UNION ALL SELECT entity, q_ord, fy, "PriceAvg" * 2, "TotalRevenue", "PriceAvg" FROM stored
    WHERE q_ord >= {OVERLAP}"""


def _old_and_batch(spark, sf_dir):
    """A table up to 1998 and a batch from 1998 on, with other prices and one column more."""
    rows = _stored(spark, sf_dir)
    batch = (rows.where(F.col("q_ord") >= OVERLAP).withColumn("Score", F.col("PriceAvg"))
             .withColumn("PriceAvg", F.col("PriceAvg") * 2))
    return rows.where(F.col("q_ord") < CUT), batch


@query("upsert", _UPSERTED, stored=_STORED)
def upsert(spark, sf_dir):
    return tables.merge_rows(*_old_and_batch(spark, sf_dir))


@query("upsert_stored", _UPSERTED, stored=_STORED)
def upsert_stored(spark, sf_dir):
    """The same on a stored table, and the batch delivered twice."""
    old, batch = _old_and_batch(spark, sf_dir)
    path = fresh_path(spark, "table")
    tables.append_table(old, path)
    tables.upsert_table(batch, path)
    tables.upsert_table(batch, path)
    return tables.stored(spark, path)


@query("append_stored", "SELECT * FROM stored", stored=_STORED)
def append_stored(spark, sf_dir):
    """Two parts, the second one delivered twice."""
    rows, path = _stored(spark, sf_dir), fresh_path(spark, "table")
    old, new = rows.where(F.col("q_ord") < CUT), rows.where(F.col("q_ord") >= CUT)
    for part in (old, new, new):
        tables.append_table(part, path, KEY)
    return tables.stored(spark, path)


@query("stream_upsert", f"""
    SELECT CAST(o_custkey AS VARCHAR) AS entity, {fiscal('o_orderdate')} AS q_ord,
           CAST({fiscal('o_orderdate')} // 4 AS INTEGER) AS fy, o_orderkey, o_totalprice
    FROM orders QUALIFY row_number() OVER (
        PARTITION BY o_custkey, {fiscal('o_orderdate')} ORDER BY o_orderkey DESC) = 1""")
def stream_upsert_query(spark, sf_dir):
    """Orders as a stream of facts per customer and quarter; the highest order number stays."""
    schema = views.table(spark, sf_dir, "orders").schema
    orders = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
              .parquet(sf_dir))
    q = fiscal_ordinal(F.col("o_orderdate"))
    facts = orders.select(F.col("o_custkey").cast("string").alias("entity"), q.alias("q_ord"),
                          fiscal_year(q).alias("fy"), "o_orderkey", "o_totalprice")
    path = fresh_path(spark, "stream-table")
    stream_upsert(facts, path, fresh_path(spark, "stream-state"), "o_orderkey").awaitTermination()
    return tables.stored(spark, path)


@query("column_update", f"""
    SELECT f.entity, f.q_ord, coalesce(d.dividend, f."DividendPerShare") AS "DividendPerShare"
    FROM facts f LEFT JOIN (
        SELECT entity, {fiscal('date')} AS q_ord, max(dividend) AS dividend
        FROM dividends d WHERE date > DATE '1997-01-01' AND date = (
            SELECT max(date) FROM dividends e WHERE e.entity = d.entity
            AND e.date > DATE '1997-01-01' AND {fiscal('e.date')} = {fiscal('d.date')})
        GROUP BY 1, 2) d ON d.entity = f.entity AND d.q_ord = f.q_ord""")
def column_update(spark, sf_dir):
    """Last dividend of a quarter replaces the stored one; of one day the highest."""
    daily = (views.dividends(spark, sf_dir).where(F.col("date") > F.lit(date(1997, 1, 1)))
             .groupBy("entity", "date").agg(F.max("dividend").alias("DividendPerShare"))
             .withColumn("q_ord", fiscal_ordinal(F.col("date"))))
    rows = views.facts(spark, sf_dir).select(*KEY, "DividendPerShare")
    return tables.update_column(rows, daily, "DividendPerShare")


@query("column_update_stored", f"""
    SELECT f.entity, f.q_ord, CAST(f.q_ord // 4 AS INTEGER) AS fy,
           coalesce(d.dividend, f."DividendPerShare") AS "DividendPerShare"
    FROM facts f LEFT JOIN (
        SELECT entity, {fiscal('date')} AS q_ord, arg_max(dividend, date) AS dividend
        FROM (SELECT entity, date, max(dividend) AS dividend FROM dividends GROUP BY 1, 2)
        GROUP BY 1, 2) d ON d.entity = f.entity AND d.q_ord = f.q_ord""")
def column_update_stored(spark, sf_dir):
    """The last dividend of each quarter written into the stored panel, the events delivered twice."""
    rows = views.facts(spark, sf_dir).select(*KEY, "DividendPerShare")
    path = fresh_path(spark, "panel")
    tables.append_table(rows.withColumn("fy", fiscal_year(F.col("q_ord"))), path)
    events = (views.dividends(spark, sf_dir)
              .withColumnRenamed("dividend", "DividendPerShare")
              .withColumn("q_ord", fiscal_ordinal(F.col("date"))))
    tables.update_column_table(events, path, "DividendPerShare")
    tables.update_column_table(events, path, "DividendPerShare")
    return tables.stored(spark, path)


_DRIFTED = """SELECT entity, make_date(q_ord // 4, (q_ord % 4 + 1) * 3, 15)
        + CASE WHEN "CommonStock" < 2000 THEN 60 ELSE 0 END AS date, "Volume" / 8 AS dividend
    FROM facts"""


@query("dividend_update_repaired", f"""
    SELECT f.entity, f.q_ord, CAST(f.q_ord // 4 AS INTEGER) AS fy,
           coalesce(d.dividend, f."DividendPerShare") AS "DividendPerShare"
    FROM facts f LEFT JOIN (
        SELECT entity, q_ord, arg_max(dividend, date) AS dividend FROM (
            SELECT entity, date, dividend, CASE
                WHEN q = nq AND (p IS NULL OR p <> q) AND (p = q - 2 OR (p IS NULL AND nnq = q + 1))
                    THEN q - 1
                WHEN q = p AND (nq IS NULL OR nq <> q) AND (
                    (nq = q + 2 AND (pp IS NULL OR pp <> q - 2)) OR (nq IS NULL AND pp = q - 1))
                    THEN q + 1
                ELSE q END AS q_ord
            FROM (SELECT *, lag(q) OVER w AS p, lag(q, 2) OVER w AS pp, lead(q) OVER w AS nq,
                         lead(q, 2) OVER w AS nnq
                  FROM (SELECT entity, date, max(dividend) AS dividend, {fiscal('date')} AS q
                        FROM drifted WHERE date > DATE '1993-01-01' GROUP BY entity, date)
                  WINDOW w AS (PARTITION BY entity ORDER BY date)))
        GROUP BY 1, 2) d ON d.entity = f.entity AND d.q_ord = f.q_ord""", drifted=_DRIFTED)
def dividend_update_repaired(spark, sf_dir):
    """Dividends of drifted dates written into the stored panel."""
    facts = views.facts(spark, sf_dir)
    path = fresh_path(spark, "panel")
    tables.append_table(facts.select(*KEY, "DividendPerShare", fiscal_year(F.col("q_ord")).alias("fy")), path)
    slow = F.when(F.col("CommonStock") < 2000, 60).otherwise(0)
    drifted = facts.select("entity", F.date_add(quarter_date(F.col("q_ord"), 15), slow).alias("date"),
                           (F.col("Volume") / 8).alias("dividend"))
    loading.load_dividends(drifted, path, date(1993, 1, 1))
    return tables.stored(spark, path)


@query("dim_insert_stored", """
    SELECT entity, "Sector", "Industry" FROM dimension
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier
    WHERE s_acctbal < 0""")
def dim_insert_stored(spark, sf_dir):
    """The same insert into the stored dimension, delivered twice."""
    path = fresh_path(spark, "dimension")
    tables.insert_absent_table(views.dimension(spark, sf_dir), path)
    rows = views.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("entity"), F.col("s_name").alias("Sector"))
    tables.insert_absent_table(rows, path)
    tables.insert_absent_table(rows, path)
    return tables.stored(spark, path)


@query("dim_insert_absent", """
    SELECT entity, "Sector", "Industry" FROM dimension
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier
    WHERE s_acctbal < 0""")
def dim_insert_absent(spark, sf_dir):
    rows = views.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("entity"), F.col("s_name").alias("Sector"))
    return tables.insert_absent(views.dimension(spark, sf_dir), rows)


@query("key_check", """
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""")
def key_check(spark, sf_dir):
    return schemas.duplicate_keys(views.table(spark, sf_dir, "lineitem"),
                                  ["l_orderkey", "l_linenumber"])


_CSV = ("QuarterEnd", "Shares", "Revenue", "Earnings", "Price", "LongTermDebt")


@query("csv_archive_scan", """
    SELECT n_name AS entity, "QuarterEnd", "Shares", "Revenue", "Earnings", "Price",
           "LongTermDebt"
    FROM archive a JOIN supplier ON a.entity = CAST(s_suppkey AS VARCHAR)
    JOIN nation ON s_nationkey = n_nationkey""")
def csv_archive_scan(spark, sf_dir):
    """The archive as CSV files, a folder per nation: row number first, "None" for missing. The files
    of losses have their columns the other way round and whole numbers written with a point."""
    homes = (views.table(spark, sf_dir, "supplier")
             .join(views.table(spark, sf_dir, "nation"),
                   F.col("s_nationkey") == F.col("n_nationkey"))
             .select(F.col("s_suppkey").cast("string").alias("entity"), "n_name"))
    rows = views.archive(spark, sf_dir).join(homes, "entity").select(
        F.lit(0).alias("row"), "n_name", *_CSV)
    folder = fresh_path(spark, "csv")
    loss = F.coalesce(F.col("Earnings") < 0, F.lit(False))
    pointed = [F.concat(F.col(c).cast("string"), F.lit(".0")).alias(c) if c == "Shares" else F.col(c)
               for c in reversed(_CSV)]
    for name, part in (("plain", rows.where(~loss)),
                       ("turned", rows.where(loss).select("row", "n_name", *pointed))):
        (part.write.option("header", True).option("nullValue", "None")
         .partitionBy("n_name").csv(f"{folder}/{name}"))
    schema = schemas.StructType([f for f in schemas.ARCHIVE_SCHEMA if f.name in _CSV])
    order = schemas.StructType(sorted(schema.fields, key=lambda f: _CSV.index(f.name)))
    return readers.read_archive(spark, folder, order, entity_pattern=r"n_name=([^/]+)/")


_LOADED = f"""
    SELECT * FROM (
        SELECT f.entity, f.q_ord, f."PriceAvg" / CASE WHEN f.q_ord < s.split_quarter
                   THEN s.factor ELSE 1 END AS "PriceAvg", f."Split"
        FROM split_facts f LEFT JOIN fresh_factors s ON s.entity = f.entity
        WHERE f.q_ord < {_TABLE_END} AND NOT EXISTS (
            SELECT 1 FROM batch b WHERE b.entity = f.entity AND b.q_ord = f.q_ord)
        UNION ALL SELECT entity, q_ord, "PriceAvg", "Split" FROM batch)"""
_LOAD_VIEWS = {
    **_SPLIT_VIEWS,
    "batch": f"""SELECT * FROM split_facts WHERE q_ord >= {_TABLE_END - 2} AND entity IN (
        SELECT entity FROM split_facts WHERE q_ord >= {_TABLE_END - 2}
        GROUP BY 1 HAVING max(date) >= DATE '2001-11-04' - 30)""",
    "fresh_factors": f"""SELECT entity, product("Split") AS factor, min(q_ord) AS split_quarter
        FROM batch WHERE q_ord >= {_TABLE_END} AND "Split" IS NOT NULL GROUP BY 1""",
}


def _loaded(spark, sf_dir):
    rows = _split_facts(spark, sf_dir).select(*KEY, "date", "PriceAvg", "Split")
    table = rows.where(F.col("q_ord") < _TABLE_END)
    batch = rows.where(F.col("q_ord") >= _TABLE_END - 2)
    archive = views.archive(spark, sf_dir).select(
        "entity", "QuarterEnd", *splits.ARCHIVE_DIVIDED, *splits.ARCHIVE_MULTIPLIED)
    return loading.incremental_load(table, archive, batch, date(2001, 11, 4), max_age_days=30)


@query("incremental_load", _LOADED, **_LOAD_VIEWS)
def incremental_load(spark, sf_dir):
    """A batch that overlaps the table: stale suppliers skipped, history split-adjusted."""
    return _loaded(spark, sf_dir)[0].drop("date")


_ADJUSTED_ARCHIVE = """
    SELECT a.entity, "QuarterEnd", "Price" / coalesce(factor, 1) AS "Price",
           "PriceHigh" / coalesce(factor, 1) AS "PriceHigh",
           "PriceLow" / coalesce(factor, 1) AS "PriceLow",
           "DividendPerShare" / coalesce(factor, 1) AS "DividendPerShare",
           "SharesSplitAdjusted" * coalesce(factor, 1) AS "SharesSplitAdjusted",
           "SplitFactor" * coalesce(factor, 1) AS "SplitFactor"
    FROM archive a LEFT JOIN fresh_factors s ON s.entity = a.entity"""


@query("incremental_archive", _ADJUSTED_ARCHIVE, **_LOAD_VIEWS)
def incremental_archive(spark, sf_dir):
    """The archive after the same load."""
    return _loaded(spark, sf_dir)[1]


def _loaded_in_place(spark, sf_dir) -> tuple[str, str]:
    """The stored tables after the same load, delivered twice."""
    rows = _split_facts(spark, sf_dir).select(*KEY, "date", "PriceAvg", "Split")
    rows = rows.withColumn("fy", fiscal_year(F.col("q_ord")))
    archive = views.archive(spark, sf_dir).select(
        "entity", "QuarterEnd", *splits.ARCHIVE_DIVIDED,
        *[F.col(c).cast("double").alias(c) for c in splits.ARCHIVE_MULTIPLIED], fiscal_year(fiscal_ordinal(F.col("QuarterEnd"))).alias("fy"))
    panel_path, archive_path = fresh_path(spark, "panel"), fresh_path(spark, "archive")
    tables.append_table(rows.where(F.col("q_ord") < _TABLE_END), panel_path, KEY)
    tables.append_table(archive, archive_path, schemas.ARCHIVE_KEY)
    for _ in range(2):
        loading.load_in_place(spark, panel_path, archive_path,
                              rows.where(F.col("q_ord") >= _TABLE_END - 2), date(2001, 11, 4), max_age_days=30)
    return panel_path, archive_path


@query("load_in_place", _LOADED, **_LOAD_VIEWS)
def load_in_place(spark, sf_dir):
    """The panel, of which only touched parts were written."""
    return tables.stored(spark, _loaded_in_place(spark, sf_dir)[0]).drop("date", "fy")


@query("load_in_place_archive", _ADJUSTED_ARCHIVE, **_LOAD_VIEWS)
def load_in_place_archive(spark, sf_dir):
    """The archive after the same load."""
    return tables.stored(spark, _loaded_in_place(spark, sf_dir)[1]).drop("fy")


@query("bulk_build", f"""
    SELECT entity, {fiscal('"QuarterEnd"')} AS q_ord, count(*) AS rows,
           count("Revenue") AS with_revenue, sum("Shares")::BIGINT AS shares
    FROM archive GROUP BY 1, 2""")
def bulk_build(spark, sf_dir):
    """CSV files of all suppliers, a file each, into the stored archive, then read by quarter."""
    archive = views.archive(spark, sf_dir)
    columns = [F.col(f.name) if f.name in archive.columns
               else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ARCHIVE_SCHEMA]
    folder, path = fresh_path(spark, "csv"), fresh_path(spark, "archive")
    (archive.select(F.lit(0).alias("row"), F.col("entity").alias("supplier"), *columns)
     .repartition("supplier").write.option("header", True)
     # Tasks move their files in, not the driver one by one; a folder that a failed job left is not read.
     .option("mapreduce.fileoutputcommitter.algorithm.version", 2)
     .option("nullValue", "None").partitionBy("supplier").csv(folder))
    built = loading.build_archive(spark, folder, path, r"supplier=([^/]+)/")
    return built.groupBy("entity", fiscal_ordinal(F.col("QuarterEnd")).alias("q_ord")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("Revenue").alias("with_revenue"),
        F.sum("Shares").alias("shares"))
