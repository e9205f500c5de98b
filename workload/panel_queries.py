"""Periods, filters, ratios, changes, targets, merges."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from quarterdeck.functions import cells, periods
from quarterdeck.functions.names import (
    ARCHIVE_TO_PANEL, CHANGE_COLUMNS, INDEX_COMPARED_COLUMNS, KEY, QUARTER_PREFIX, TARGET,
    VERSUS, YEAR_PREFIX,
)
from quarterdeck.functions.ratios import RATIOS, add_formulas, ratio
from quarterdeck.operators import changes, filters, merging
from quarterdeck.plans import features
from quarterdeck.plans.settings import Settings
from quarterdeck.sources import readers, tables
from workload import tables as views
from workload.catalog import query
from workload.oracle import fiscal

START, END = periods.ordinal(1997, 2), periods.ordinal(2000, 2)

# ---------------------------------------------------------------- scalar functions


@query("fiscal_quarter", f"""
    SELECT CAST(l_shipdate AS DATE) AS day, {fiscal('l_shipdate')} AS q_ord,
           {fiscal('l_shipdate', 0)} AS q_ord_plain, count(*) AS lines
    FROM lineitem GROUP BY 1, 2, 3""")
def fiscal_quarter(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    days = (views.table(spark, sf_dir, "lineitem").groupBy(day.alias("day"))
            .agg(F.count(F.lit(1)).alias("lines")))
    return days.select("day", periods.fiscal_ordinal(F.col("day")).alias("q_ord"),
                       periods.fiscal_ordinal(F.col("day"), 0).alias("q_ord_plain"), "lines")


@query("quarter_arithmetic", """
    SELECT entity, q_ord, CAST(q_ord // 4 AS INTEGER) AS fy, CAST(q_ord % 4 + 1 AS INTEGER) AS fq,
           (q_ord % 4 + 1) || 'Q' || (q_ord // 4) AS label, q_ord AS parsed,
           ((q_ord + 5) % 4 + 1) || 'Q' || ((q_ord + 5) // 4) AS five_later,
           ((q_ord - 3) % 4 + 1) || 'Q' || ((q_ord - 3) // 4) AS three_before,
           q_ord >= 7992 AS late,
           make_date(q_ord // 4, (q_ord % 4 + 1) * 3, 1) AS day
    FROM facts""")
def quarter_arithmetic(spark, sf_dir):
    q = F.col("q_ord")
    label = periods.label(q)
    return views.facts(spark, sf_dir).select(
        "entity", "q_ord", periods.fiscal_year(q).alias("fy"),
        periods.fiscal_quarter(q).alias("fq"), label.alias("label"),
        periods.parse_label(label).alias("parsed"), periods.label(q + 5).alias("five_later"),
        periods.label(q - 3).alias("three_before"),
        (q >= periods.ordinal(1998, 1)).alias("late"), periods.quarter_date(q).alias("day"))


@query("text_functions", r"""
    SELECT c_custkey, upper(c_mktsegment) AS symbol,
           regexp_replace(c_name, '[\W_]+', '', 'g') AS plain,
           replace(c_mktsegment || ' & CO', ' ', '') AS firm,
           regexp_extract(c_name, '#0*(\d+)$', 1) AS part FROM customer""")
def text_functions(spark, sf_dir):
    return views.table(spark, sf_dir, "customer").select(
        "c_custkey", F.upper("c_mktsegment").alias("symbol"),
        cells.plain_text(F.col("c_name")).alias("plain"),
        cells.without_blanks(F.concat(F.col("c_mktsegment"), F.lit(" & CO"))).alias("firm"),
        cells.entity_from_path(F.col("c_name"), r"#0*(\d+)$").alias("part"))


@query("date_arithmetic", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso,
           CAST(o_orderdate AS DATE) - 91 AS quarter_before,
           CAST(DATE '2001-08-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS age,
           DATE '2001-08-01' - CAST(o_orderdate AS DATE) > 365 AS stale FROM orders""")
def date_arithmetic(spark, sf_dir):
    day, today = F.col("o_orderdate").cast("date"), F.lit(date(2001, 8, 1))
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", cells.iso_date(F.col("o_orderdate")).alias("iso"),
        F.date_sub(day, 91).alias("quarter_before"), F.datediff(today, day).alias("age"),
        (F.datediff(today, day) > 365).alias("stale"))


@query("grade_scores", """
    SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 1
                            WHEN '5-LOW' THEN -1 ELSE 0 END AS INTEGER) AS score FROM orders""")
def grade_scores(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        cells.grade_score(F.col("o_orderpriority"), views.GRADES).alias("score"))


@query("math_and_nulls", """
    SELECT entity, q_ord, abs("Earnings") AS size, round(sqrt("TotalAssets"), 4) AS root,
           round("TotalAssets" / 3, 4) AS third, CAST(floor("PriceAvg") AS BIGINT) AS whole,
           "ResearchDevelopment" IS NULL AS absent,
           coalesce("ResearchDevelopment", 0) AS filled,
           "Earnings" / nullif("ResearchDevelopment", 0) AS safe FROM facts""")
def math_and_nulls(spark, sf_dir):
    c = F.col
    rnd = cells.missing_to_null(c("ResearchDevelopment"))
    return views.facts(spark, sf_dir).select(
        "entity", "q_ord", F.abs("Earnings").alias("size"),
        F.round(F.sqrt("TotalAssets"), 4).alias("root"),
        F.round(c("TotalAssets") / 3, 4).alias("third"),
        F.floor("PriceAvg").alias("whole"), rnd.isNull().alias("absent"),
        F.coalesce(rnd, F.lit(0.0)).alias("filled"), F.try_divide(c("Earnings"), rnd).alias("safe"))


# ---------------------------------------------------------------- scans, filters, projections


@query("table_scan", "SELECT * FROM supplier")
def table_scan(spark, sf_dir):
    return readers.read_table(spark, f"{sf_dir}/supplier.parquet")


@query("distinct_entities", "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS entity FROM lineitem")
def distinct_entities(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return readers.entities(lines.select(F.col("l_suppkey").alias("entity"))).select(
        F.col("entity").cast("string").alias("entity"))


@query("date_filter", """
    SELECT * FROM orders WHERE o_orderdate >= DATE '1996-03-15' AND o_orderdate < DATE '1999-07-01'
    """)
def date_filter(spark, sf_dir):
    return filters.between_dates(views.table(spark, sf_dir, "orders"), date(1996, 3, 15),
                                 date(1999, 7, 1), "o_orderdate")


@query("quarter_filter", f"""SELECT entity, q_ord, "PriceAvg" FROM facts
    WHERE q_ord >= {START} AND q_ord < {END}""")
def quarter_filter(spark, sf_dir):
    rows = views.facts(spark, sf_dir).select(*KEY, "PriceAvg")
    return filters.between_quarters(rows, START, END)


@query("required_filter", """
    SELECT entity, q_ord, "PriceAvg", "ResearchDevelopment" FROM gappy
    WHERE "PriceAvg" IS NOT NULL AND "ResearchDevelopment" IS NOT NULL""")
def required_filter(spark, sf_dir):
    kept = filters.require(views.gappy(spark, sf_dir), ["PriceAvg", "ResearchDevelopment"])
    return kept.select(*KEY, "PriceAvg", "ResearchDevelopment")


@query("column_filter", """
    SELECT entity, "PriceAvg", "Volume" FROM gappy
    WHERE entity IS NOT NULL AND "PriceAvg" IS NOT NULL AND "Volume" IS NOT NULL""")
def column_filter(spark, sf_dir):
    return filters.keep_columns(views.gappy(spark, sf_dir), ["entity", "PriceAvg", "Volume"])


@query("nonzero_filter", """
    SELECT * FROM (SELECT l_orderkey, l_linenumber, l_suppkey, nullif(l_tax, 0.01) AS l_tax,
                          l_discount FROM lineitem)
    WHERE (l_tax <> 0 OR l_tax IS NULL) AND (l_discount <> 0 OR l_discount IS NULL)""")
def nonzero_filter(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.nullif(F.col("l_tax"), F.lit(0.01)).alias("l_tax"), "l_discount")
    return filters.nonzero(lines, ["l_tax", "l_discount"])


@query("symbol_lists", """
    SELECT entity, q_ord, "PriceAvg", entity IN ('ASIA', 'EUROPE') AS listed FROM region_indices""")
def symbol_lists(spark, sf_dir):
    rows = views.region_indices(spark, sf_dir).select(*KEY, "PriceAvg")
    listed, others = filters.split_symbols(rows, ["ASIA", "EUROPE"])
    return (listed.withColumn("listed", F.lit(True))
            .unionByName(others.withColumn("listed", F.lit(False))))


@query("freshness", """
    SELECT p.entity, p.date, p.close FROM prices p JOIN (
        SELECT entity FROM prices GROUP BY entity
        HAVING max(date) >= DATE '2001-08-01' - 90) USING (entity)""")
def freshness(spark, sf_dir):
    rows = views.prices(spark, sf_dir).select("entity", "date", "close")
    return filters.fresh_entities(rows, date(2001, 8, 1), 90)


@query("rename_map", """
    SELECT entity, "Assets" AS "TotalAssets", "Revenue" AS "TotalRevenue",
           "Liabilities" AS "TotalLiab", "LongTermDebt", "ShareholdersEquity" AS
           "TotalStockholderEquity", "CashAtEndOfPeriod" AS "Cash", "Price" AS "PriceAvg",
           "PriceLow", "PriceHigh", "SplitFactor" AS "Split",
           "SharesSplitAdjusted" AS "CommonStock", "Earnings", "DividendPerShare" FROM archive""")
def rename_map(spark, sf_dir):
    named = views.archive(spark, sf_dir).withColumnsRenamed(ARCHIVE_TO_PANEL)
    return filters.keep_known(named, features.PANEL_COLUMNS)


@query("archive_derivations", f"""
    SELECT entity, {fiscal('"QuarterEnd"')} AS q_ord, "QuarterEnd" AS date,
           "DividendPerShare" * "Shares" AS "DividendsPaid",
           "FreeCashFlowPerShare" * "Shares" AS "OperatingIncome",
           "SharesSplitAdjusted" * "Price" AS "MarketCap",
           0.0::DOUBLE AS "ShortLongTermDebt", "Revenue" - "CapitalExpenditures" AS "Ebit",
           "Earnings" AS "NetIncome", TRY_CAST("LongTermDebt" AS BIGINT) AS "LongTermDebt"
    FROM archive""")
def archive_derivations(spark, sf_dir):
    return features.derive_archive(views.archive(spark, sf_dir)).select(
        "entity", "q_ord", "date", "DividendsPaid", "OperatingIncome", "MarketCap",
        "ShortLongTermDebt", "Ebit", "NetIncome", "LongTermDebt")


@query("casts", """
    SELECT entity, "QuarterEnd", TRY_CAST("LongTermDebt" AS INTEGER) AS debt,
           CAST("Shares" AS DOUBLE) AS shares, upper('s' || entity) AS symbol FROM archive""")
def casts(spark, sf_dir):
    return views.archive(spark, sf_dir).select(
        "entity", "QuarterEnd", F.col("LongTermDebt").try_cast("int").alias("debt"),
        F.col("Shares").cast("double").alias("shares"),
        F.upper(F.concat(F.lit("s"), F.col("entity"))).alias("symbol"))


# ---------------------------------------------------------------- ratios, changes, index, target

_RATIO_SQL = """
    ("PriceHigh" - "PriceLow") / nullif("PriceAvg", 0) AS "Volatility",
    "TotalAssets" / nullif("TotalLiab", 0) AS "AssetsToLiabilitiesRatio",
    "PriceAvg" / nullif("Earnings", 0) AS "AvgPriceToEarningsRatio",
    ("LongTermDebt" + "ShortLongTermDebt") / nullif("TotalStockholderEquity", 0)
        AS "DebtToEquityRatio",
    ("Earnings" - "DividendsPaid") / nullif("TotalStockholderEquity", 0) AS "ReturnOnEquity",
    ("TotalAssets" - "TotalLiab") / nullif("MarketCap", 0) AS "PriceToBookRatio",
    "NetIncome" / nullif("TotalRevenue", 0) AS "ProfitMargin",
    "ResearchDevelopment" / nullif("TotalRevenue", 0) AS "RnDtoRevenue",
    "Cash" / nullif("TotalRevenue", 0) AS "CashToRevenue",
    "TotalOperatingExpenses" / nullif("TotalRevenue", 0) AS "ExpensesToRevenue\""""


@query("ratios", f"SELECT entity, q_ord, {_RATIO_SQL} FROM facts")
def ratios(spark, sf_dir):
    return add_formulas(views.facts(spark, sf_dir)).select(*KEY, *RATIOS)


@query("user_formulas", """
    SELECT entity, q_ord, ("PriceHigh" + "PriceLow") / 2 AS middle,
           "TotalRevenue" / nullif("Volume", 0) AS per_unit FROM facts""")
def user_formulas(spark, sf_dir):
    own = {"middle": lambda: (F.col("PriceHigh") + F.col("PriceLow")) / 2,
           "per_unit": ratio("TotalRevenue", "Volume")}
    return add_formulas(views.facts(spark, sf_dir), own).select(*KEY, *own)


def _change_sql(source: str, columns, quarters, calendar: bool = False, keep: str = "") -> str:
    """Filled columns in an inner query, changes in the outer one."""
    filled = ", ".join(
        f'last_value("{c}" IGNORE NULLS) OVER (PARTITION BY entity ORDER BY q_ord '
        f'ROWS UNBOUNDED PRECEDING) AS "f{i}"' for i, c in enumerate(columns))

    def earlier(i, n):
        if calendar:
            return (f'first_value(f{i}) OVER (PARTITION BY entity ORDER BY q_ord '
                    f'RANGE BETWEEN {n} PRECEDING AND {n} PRECEDING)')
        return f'lag(f{i}, {n}) OVER (PARTITION BY entity ORDER BY q_ord)'

    outer = ", ".join(
        f'f{i} / nullif({earlier(i, n)}, 0) - 1 '
        f'AS "{YEAR_PREFIX if n == 4 else QUARTER_PREFIX}{c}"'
        for n in quarters for i, c in enumerate(columns))
    return f'SELECT entity, q_ord{keep}, {outer} FROM (SELECT *, {filled} FROM {source})'


_ALL = CHANGE_COLUMNS


@query("delta_q", _change_sql("rated", _ALL, (1,)),
       rated=f"SELECT *, {_RATIO_SQL} FROM facts")
def delta_q(spark, sf_dir):
    rated = add_formulas(views.facts(spark, sf_dir))
    changed = changes.add_changes(rated, _ALL, (1,))
    return changed.select(*KEY, *[f"{QUARTER_PREFIX}{c}" for c in _ALL])


@query("delta_yoy", _change_sql("rated", _ALL, (4,)),
       rated=f"SELECT *, {_RATIO_SQL} FROM facts")
def delta_yoy(spark, sf_dir):
    rated = add_formulas(views.facts(spark, sf_dir))
    changed = changes.add_changes(rated, _ALL, (4,))
    return changed.select(*KEY, *[f"{YEAR_PREFIX}{c}" for c in _ALL])


_GAPPY = ("PriceAvg", "TotalRevenue", "Volume", "ResearchDevelopment")


@query("delta_gappy", _change_sql("gappy", _GAPPY, (1, 4)))
def delta_gappy(spark, sf_dir):
    changed = changes.add_changes(views.gappy(spark, sf_dir), _GAPPY)
    return changed.select(*KEY, *[f"{p}{c}" for p in (QUARTER_PREFIX, YEAR_PREFIX)
                                  for c in _GAPPY])


@query("delta_dropna", _change_sql("gappy", ("PriceAvg",), (4,))
       + ' QUALIFY "YOY_Delta_PriceAvg" IS NOT NULL')
def delta_dropna(spark, sf_dir):
    changed = changes.add_changes(views.gappy(spark, sf_dir), ["PriceAvg"], (4,), dropna=True)
    return changed.select(*KEY, "YOY_Delta_PriceAvg")


@query("delta_calendar", _change_sql("gappy", _GAPPY, (1, 4), calendar=True))
def delta_calendar(spark, sf_dir):
    changed = changes.add_changes(views.gappy(spark, sf_dir), _GAPPY, calendar=True)
    return changed.select(*KEY, *[f"{p}{c}" for p in (QUARTER_PREFIX, YEAR_PREFIX)
                                  for c in _GAPPY])


_VERSUS = ("PriceAvg", "Volatility")
_VERSUS_SYMBOLS = ("ASIA", "EUROPE", "ATLANTIS")


@query("vs_index", """
    SELECT f.entity, f.q_ord, """ + ", ".join(
    f'f."{c}" / nullif(max(CASE WHEN i.entity = \'{s}\' THEN i."{c}" END), 0) AS "{c}_vs_{s}"'
    for s in _VERSUS_SYMBOLS for c in _VERSUS) + """
    FROM rated f LEFT JOIN rated_index i ON f.q_ord = i.q_ord
    GROUP BY f.entity, f.q_ord, f."PriceAvg", f."Volatility\"""",
       rated="""SELECT entity, q_ord, "PriceAvg",
            ("PriceHigh" - "PriceLow") / nullif("PriceAvg", 0) AS "Volatility" FROM facts""",
       rated_index="""SELECT entity, q_ord, "PriceAvg",
            ("PriceHigh" - "PriceLow") / nullif("PriceAvg", 0) AS "Volatility"
            FROM region_indices""")
def vs_index(spark, sf_dir):
    """Two region indices and one that does not exist."""
    own = {"Volatility": RATIOS["Volatility"]}
    compared = changes.add_index_comparison(
        add_formulas(views.facts(spark, sf_dir), own),
        add_formulas(views.region_indices(spark, sf_dir), own), _VERSUS_SYMBOLS, _VERSUS)
    return compared.select(*KEY, *[f"{c}{VERSUS}{s}" for s in _VERSUS_SYMBOLS for c in _VERSUS])


def _target_sql(source: str, n: int, dividends: bool, calendar: bool = False) -> str:
    if calendar:
        future = (f'first_value("PriceAvg") OVER (PARTITION BY entity ORDER BY q_ord '
                  f'RANGE BETWEEN {n} FOLLOWING AND {n} FOLLOWING)')
        frame = f"RANGE BETWEEN CURRENT ROW AND {n - 1} FOLLOWING"
    else:
        future = f'lead("PriceAvg", {n}) OVER (PARTITION BY entity ORDER BY q_ord)'
        frame = f"ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING"
    paid = (f' + coalesce(sum("DividendPerShare") OVER (PARTITION BY entity ORDER BY q_ord '
            f'{frame}), 0)' if dividends else "")
    return (f'SELECT entity, q_ord, round_even((({future}{paid}) - "PriceAvg") * 100 '
            f'/ nullif("PriceAvg", 0), 2) AS "{TARGET}" FROM {source}')


@query("target_1q", _target_sql("facts", 1, False))
def target_1q(spark, sf_dir):
    return changes.add_target(views.facts(spark, sf_dir), 1, False).select(*KEY, TARGET)


@query("target_4q_div", _target_sql("gappy", 4, True))
def target_4q_div(spark, sf_dir):
    return changes.add_target(views.gappy(spark, sf_dir), 4).select(*KEY, TARGET)


@query("target_calendar", _target_sql("gappy", 4, True, calendar=True))
def target_calendar(spark, sf_dir):
    return changes.add_target(views.gappy(spark, sf_dir), 4, calendar=True).select(*KEY, TARGET)


@query("forward_lookup", """
    SELECT a.entity, a.q_ord, b."PriceAvg" AS later FROM gappy a
    LEFT JOIN gappy b ON a.entity = b.entity AND b.q_ord = a.q_ord + 4""")
def forward_lookup(spark, sf_dir):
    return views.gappy(spark, sf_dir).select(
        *KEY, changes.value_ahead("PriceAvg", 4, calendar=True).alias("later"))


@query("dividends_ahead", """
    SELECT entity, q_ord, round(coalesce(sum("DividendPerShare") OVER (
        PARTITION BY entity ORDER BY q_ord ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), 0), 6)
        AS paid, lead("PriceAvg", 2) OVER (PARTITION BY entity ORDER BY q_ord) AS ahead
    FROM gappy""")
def dividends_ahead(spark, sf_dir):
    return views.gappy(spark, sf_dir).select(
        *KEY, F.round(changes.sum_ahead("DividendPerShare", 4), 6).alias("paid"),
        changes.value_ahead("PriceAvg", 2).alias("ahead"))


# ---------------------------------------------------------------- merging

_PART = ("PriceAvg", "TotalRevenue", "date")


@query("merge_archive", """
    SELECT entity, q_ord, "PriceAvg", "TotalRevenue", date FROM facts WHERE q_ord >= 7992
    UNION ALL
    SELECT entity, q_ord, "PriceAvg", NULL, date FROM facts a
    WHERE q_ord < 8000 AND NOT EXISTS (
        SELECT 1 FROM facts p WHERE p.q_ord >= 7992 AND p.entity = a.entity
        AND p.q_ord = a.q_ord)""")
def merge_archive(spark, sf_dir):
    rows = views.facts(spark, sf_dir)
    primary = rows.where(F.col("q_ord") >= periods.ordinal(1998, 1)).select(*KEY, *_PART)
    archive = rows.where(F.col("q_ord") < periods.ordinal(2000, 1)).select(*KEY, "PriceAvg", "date")
    return merging.fill_from_archive(primary, archive)


@query("dim_fill", """
    SELECT f.entity, q_ord, coalesce("Sector", 'MissingSector') AS "Sector",
           coalesce("Industry", 'MissingIndustry') AS "Industry",
           coalesce("ShortLongTermDebt", 0) AS "ShortLongTermDebt"
    FROM facts f LEFT JOIN dimension d ON f.entity = d.entity""")
def dim_fill(spark, sf_dir):
    rows = views.facts(spark, sf_dir).select(*KEY, "ShortLongTermDebt")
    return (merging.add_dimension(rows, views.dimension(spark, sf_dir))
            .fillna({"ShortLongTermDebt": 0.0}))


@query("dim_read", """
    SELECT CAST(s_suppkey AS VARCHAR) AS entity, s_name AS "Sector",
           CAST(s_nationkey AS VARCHAR) AS "Industry" FROM supplier""")
def dim_read(spark, sf_dir):
    """The dimension written to a CSV file and read back under panel names."""
    from quarterdeck.session import fresh_path
    path = fresh_path(spark, "dimension")
    (views.table(spark, sf_dir, "supplier")
     .select(F.col("s_suppkey").alias("tickerSymbol"), F.col("s_name").alias("shortName"),
             F.col("s_name").alias("sector"), F.col("s_nationkey").alias("industry"))
     .write.option("header", True).csv(path))
    return readers.read_dimension(spark, path)


@query("dedupe_last", f"""
    SELECT entity, q_ord, "QuarterEnd", "Shares", "Price" FROM (
        SELECT *, row_number() OVER (PARTITION BY entity, q_ord ORDER BY "QuarterEnd") AS place
        FROM (SELECT *, {fiscal('"QuarterEnd"')} AS q_ord FROM archive)) WHERE place = 1""")
def dedupe_last(spark, sf_dir):
    rows = views.archive(spark, sf_dir).withColumn(
        "q_ord", periods.fiscal_ordinal(F.col("QuarterEnd")))
    kept = merging.keep_one(rows, KEY, [F.col("QuarterEnd")])
    return kept.select(*KEY, "QuarterEnd", "Shares", "Price")


@query("dedupe_first", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def dedupe_first(spark, sf_dir):
    """Newest order of every customer: a key with any number of copies."""
    orders = views.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return merging.keep_one(orders, ["o_custkey"],
                            [F.col("o_orderdate").desc(), F.col("o_orderkey")])


# Quarter ends drift: a slow supplier quarter (few lines) is dated a month later, a busy one
# as it is, so that some neighbours fall into one quarter and leave a gap.
_DRIFT = 12


@query("quarter_repair", f"""
    SELECT entity, day, CAST(CASE
        WHEN q = nq AND (p IS NULL OR p <> q) AND (p = q - 2 OR (p IS NULL AND nnq = q + 1))
            THEN q - 1
        WHEN q = p AND (nq IS NULL OR nq <> q) AND (
            (nq = q + 2 AND (pp IS NULL OR pp <> q - 2)) OR (nq IS NULL AND pp = q - 1))
            THEN q + 1
        ELSE q END AS INTEGER) AS q_ord
    FROM (SELECT entity, day, q,
                 lag(q) OVER w AS p, lag(q, 2) OVER w AS pp,
                 lead(q) OVER w AS nq, lead(q, 2) OVER w AS nnq
          FROM (SELECT entity, day, {fiscal('day')} AS q FROM (
                SELECT entity, make_date(q_ord // 4, (q_ord % 4 + 1) * 3, 15)
                       + CASE WHEN "CommonStock" < 10 * 25 * {_DRIFT} THEN 60 ELSE 0 END AS day
                FROM facts))
          WINDOW w AS (PARTITION BY entity ORDER BY day))""")
def quarter_repair(spark, sf_dir):
    slow = F.col("CommonStock") < 10 * 25 * _DRIFT
    day = F.date_add(periods.quarter_date(F.col("q_ord"), 15), F.when(slow, 60).otherwise(0))
    rows = views.facts(spark, sf_dir).select("entity", day.alias("day"))
    return merging.repair_labels(rows, "day")


@query("union_by_name", """
    SELECT entity, date, close, volume, NULL::DOUBLE AS dividend FROM prices
    UNION ALL SELECT entity, date, NULL, NULL, dividend FROM dividends""")
def union_by_name(spark, sf_dir):
    return merging.union_by_name(views.prices(spark, sf_dir), views.dividends(spark, sf_dir))


@query("except_key", """
    SELECT entity, q_ord, quarter_end FROM quarter_ends e WHERE NOT EXISTS (
        SELECT 1 FROM gappy g WHERE g.entity = e.entity AND g.q_ord = e.q_ord)""")
def except_key(spark, sf_dir):
    return merging.except_key(views.quarter_ends(spark, sf_dir), views.gappy(spark, sf_dir))


@query("symbol_union", """
    SELECT upper(CAST(l_suppkey AS VARCHAR)) AS entity FROM lineitem
    UNION SELECT upper(c_mktsegment) FROM customer""")
def symbol_union(spark, sf_dir):
    known = views.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("entity"))
    asked = views.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("entity"))
    return merging.symbol_union(known, asked)


@query("schema_evolution", """
    SELECT CAST(c_custkey AS BIGINT) AS ckey, c_name AS cname, NULL::DOUBLE AS cacctbal
    FROM customer UNION ALL
    SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def schema_evolution(spark, sf_dir):
    """A later batch with messy names and one column more."""
    old = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("c_key"), F.col("c_name"))
    new = views.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c key"), F.col("s_name").alias("c-name"),
        F.col("s_acctbal").alias("c_acct bal"))
    return merging.union_by_name(tables.clean_names(old), tables.clean_names(new))


# ---------------------------------------------------------------- composite jobs

_HP = Settings(market_indices=(views.MARKET,))
_PRIMARY_SQL = """
    SELECT * FROM (SELECT * FROM facts UNION ALL BY NAME SELECT * FROM market)"""


def _primary(spark, sf_dir):
    """Supplier facts with the market index among the entities."""
    return merging.union_by_name(views.facts(spark, sf_dir), views.market(spark, sf_dir))


_PREPARED_SQL = """
    SELECT *, CASE WHEN "AvgRecommendations" IS NULL THEN 0
        ELSE (json_extract_string("AvgRecommendations", '$.a')::DOUBLE
              + json_extract_string("AvgRecommendations", '$.b')::DOUBLE) / 2
        END AS "AvgRecommendationScore"
    FROM primary_rows
    WHERE entity <> '^DJI' AND date IS NOT NULL AND "TotalRevenue" IS NOT NULL
      AND "PriceAvg" IS NOT NULL AND "PriceHigh" IS NOT NULL AND "PriceLow" IS NOT NULL
      AND "Earnings" IS NOT NULL AND "MarketCap" IS NOT NULL
      AND "TotalRevenue" <> 0 AND "Earnings" <> 0 AND "MarketCap" <> 0"""

_ARCHIVE_PREPARED_SQL = f"""
    SELECT entity, q_ord, "QuarterEnd" AS date, "Price" AS "PriceAvg", "PriceHigh", "PriceLow",
           "SplitFactor" AS "Split", CAST("Revenue" AS DOUBLE) - "CapitalExpenditures" AS "Ebit",
           "Revenue" AS "TotalRevenue", "FreeCashFlowPerShare" * "Shares" AS "OperatingIncome",
           "Earnings" AS "NetIncome", "DividendPerShare" * "Shares" AS "DividendsPaid",
           "CashAtEndOfPeriod" AS "Cash", "SharesSplitAdjusted" AS "CommonStock",
           "Assets" AS "TotalAssets", "Liabilities" AS "TotalLiab",
           TRY_CAST("LongTermDebt" AS BIGINT) AS "LongTermDebt",
           "ShareholdersEquity" AS "TotalStockholderEquity", "Earnings",
           0.0::DOUBLE AS "ShortLongTermDebt", "SharesSplitAdjusted" * "Price" AS "MarketCap",
           "DividendPerShare"
    FROM (SELECT *, {fiscal('"QuarterEnd"')} AS q_ord FROM archive
          WHERE "Shares" IS NOT NULL AND "SharesSplitAdjusted" IS NOT NULL
            AND "FreeCashFlowPerShare" IS NOT NULL AND "Earnings" IS NOT NULL
            AND "ShareholdersEquity" IS NOT NULL AND "Liabilities" IS NOT NULL
            AND "Price" IS NOT NULL AND ("Revenue" <> 0 OR "Revenue" IS NULL)
            AND "Earnings" <> 0)
    QUALIFY row_number() OVER (PARTITION BY entity, q_ord ORDER BY "QuarterEnd") = 1"""

_LATE_PRIMARY = "SELECT * FROM prepared WHERE q_ord >= 7992"

_MERGED_SQL = """
    SELECT m.* REPLACE (coalesce("ShortLongTermDebt", 0) AS "ShortLongTermDebt",
                        coalesce("DividendPerShare", 0) AS "DividendPerShare"),
           coalesce(d."Sector", 'MissingSector') AS "Sector",
           coalesce(d."Industry", 'MissingIndustry') AS "Industry"
    FROM (SELECT * FROM late_primary UNION ALL BY NAME
          SELECT * FROM archive_prepared a WHERE NOT EXISTS (
              SELECT 1 FROM late_primary p WHERE p.entity = a.entity AND p.q_ord = a.q_ord)) m
    LEFT JOIN dimension d ON m.entity = d.entity"""

_FEATURE_RATIOS = tuple(RATIOS)
_FEATURE_VIEWS = {
    "primary_rows": _PRIMARY_SQL,
    "prepared": _PREPARED_SQL,
    "archive_prepared": _ARCHIVE_PREPARED_SQL,
    "late_primary": _LATE_PRIMARY,
    "merged": _MERGED_SQL,
    "rated": f"SELECT *, {_RATIO_SQL} FROM merged",
    "changed": _change_sql(
        "rated", CHANGE_COLUMNS, (1, 4),
        keep=', "Industry", "Ebit", "TotalStockholderEquity", "PriceAvg", "DividendPerShare", '
             + ", ".join(f'"{r}"' for r in _FEATURE_RATIOS)),
    "index_rated": """SELECT entity, q_ord, "PriceAvg",
        ("PriceHigh" - "PriceLow") / nullif("PriceAvg", 0) AS "Volatility" FROM primary_rows
        WHERE entity = '^DJI'""",
    "index_changed": _change_sql("index_rated", ("Volatility", "PriceAvg"), (1, 4),
                                 keep=', "Volatility"'),
    "targets": _target_sql("merged", 4, True),
}
_FEATURE_SQL = f"""
    SELECT c.* EXCLUDE ("DividendPerShare"), {", ".join(
    f'c."{c}" / nullif(i."{c}", 0) AS "{c}_vs_^DJI"' for c in INDEX_COMPARED_COLUMNS)},
           t."{TARGET}"
    FROM changed c LEFT JOIN index_changed i ON c.q_ord = i.q_ord
    JOIN targets t ON c.entity = t.entity AND c.q_ord = t.q_ord"""


@query("primary_preparation", """
    SELECT entity, q_ord, "PriceAvg", "AvgRecommendationScore", FALSE AS is_index FROM prepared
    UNION ALL SELECT entity, q_ord, "PriceAvg", NULL, TRUE FROM primary_rows
    WHERE entity = '^DJI'""", primary_rows=_PRIMARY_SQL, prepared=_PREPARED_SQL)
def primary_preparation(spark, sf_dir):
    panel, index_panel = features.prepare_primary(_primary(spark, sf_dir), _HP.market_indices)
    return merging.union_by_name(
        panel.select(*KEY, "PriceAvg", "AvgRecommendationScore", F.lit(False).alias("is_index")),
        index_panel.select(*KEY, "PriceAvg", F.lit(True).alias("is_index")))


@query("archive_preparation", """
    SELECT * REPLACE (CAST("Ebit" AS BIGINT) AS "Ebit") FROM archive_prepared""",
       archive_prepared=_ARCHIVE_PREPARED_SQL)
def archive_preparation(spark, sf_dir):
    return features.prepare_archive(views.archive(spark, sf_dir))


@query("engineered_columns", _change_sql(
    "rated", ("PriceAvg", "TotalRevenue"), (1, 4),
    keep=", " + ", ".join(f'"{r}"' for r in RATIOS)),
       rated=f"SELECT *, {_RATIO_SQL} FROM gappy")
def engineered_columns(spark, sf_dir):
    done = features.engineer(views.gappy(spark, sf_dir), ["PriceAvg", "TotalRevenue"])
    return done.select(*KEY, *RATIOS, *[f"{p}{c}" for p in (QUARTER_PREFIX, YEAR_PREFIX)
                                        for c in ("PriceAvg", "TotalRevenue")])


def feature_rows(spark, sf_dir):
    """Late facts are the primary source, the archive fills the years before."""
    late = _primary(spark, sf_dir).where(
        (F.col("q_ord") >= periods.ordinal(1998, 1)) | (F.col("entity") == views.MARKET))
    return features.feature_table(late, views.archive(spark, sf_dir),
                                  views.dimension(spark, sf_dir), _HP)


@query("feature_table", _FEATURE_SQL, **_FEATURE_VIEWS)
def feature_table(spark, sf_dir):
    return feature_rows(spark, sf_dir)


@query("labelled_candidates", f"""
    SELECT entity, q_ord, "PriceAvg", "{TARGET}" IS NOT NULL AS labelled FROM targets
    JOIN merged USING (entity, q_ord)""", **_FEATURE_VIEWS)
def labelled_candidates(spark, sf_dir):
    labelled, candidates = filters.split_labelled(
        feature_rows(spark, sf_dir).select(*KEY, "PriceAvg", TARGET), TARGET)
    return labelled.drop(TARGET).withColumn("labelled", F.lit(True)).unionByName(
        candidates.withColumn("labelled", F.lit(False)))


@query("feature_projection", """
    SELECT entity, q_ord, "Industry", "Ebit", "TotalStockholderEquity", "Volatility",
           "ProfitMargin", "Q_Delta_PriceAvg", "YOY_Delta_TotalRevenue" FROM changed""",
       **_FEATURE_VIEWS)
def feature_projection(spark, sf_dir):
    rows = feature_rows(spark, sf_dir)
    wanted = [c for c in features.feature_names(rows.columns, _HP.market_indices)
              if c in ("Industry", "Ebit", "TotalStockholderEquity", "Volatility", "ProfitMargin",
                       "Q_Delta_PriceAvg", "YOY_Delta_TotalRevenue")]
    return rows.select(*KEY, *wanted)
