"""Events rolled up to quarters, split corrections, statements, streams."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from quarterdeck.functions.cells import mean_of_json
from quarterdeck.functions.names import KEY, STATEMENT_ITEMS
from quarterdeck.functions.periods import ordinal
from quarterdeck.operators import rollups, splits
from quarterdeck.operators.merging import statements_to_panel, union_by_name
from quarterdeck.operators.metrics import count_rows
from quarterdeck.operators import filters
from quarterdeck.plans import loading
from quarterdeck.session import fresh_path, written
from quarterdeck.streaming.rollup import open_windows, stream_price_rollup
from workload import tables as views
from workload.catalog import query
from workload.oracle import fiscal

START, END = date(1995, 1, 1), date(2001, 8, 1)
_SPAN = (END - START).days
_PRICE_LAST = START + timedelta(days=91 * ((_SPAN - 1) // 91))
_REC_LAST = START + timedelta(days=91 * (_SPAN // 91))


def _bucket(day: str, start: str = f"DATE '{START}'") -> str:
    return f"CAST(floor(CAST({day} - {start} AS DOUBLE) / 91) AS INTEGER)"


_PRICE_AGGREGATES = """
    avg(close) AS "PriceAvg", min(close) AS "PriceLow", max(close) AS "PriceHigh",
    arg_max(close, date) AS "PriceEoQ", arg_max(volume, date) AS "Volume\""""


def rounded(df, *columns: str):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("price_rollup_91d", f"""
    SELECT entity, DATE '{START}' + (bucket + 1) * 91 AS date, round("PriceAvg", 6) AS "PriceAvg",
           "PriceLow", "PriceHigh", "PriceEoQ", "Volume"
    FROM (SELECT entity, {_bucket('date')} AS bucket, {_PRICE_AGGREGATES} FROM prices
          WHERE date >= DATE '{START}' AND date < DATE '{_PRICE_LAST}' GROUP BY 1, 2)""")
def price_rollup_91d(spark, sf_dir):
    return rounded(rollups.price_rollup(views.prices(spark, sf_dir), START, END), "PriceAvg")


_FIRM_MEANS = f"""
    SELECT entity, {_bucket('date')} AS bucket, replace(firm, ' ', '') AS firm,
           avg(CASE grade WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 1 WHEN '5-LOW' THEN -1
               ELSE 0 END) AS score
    FROM recommendations WHERE date >= DATE '{START}' AND date < DATE '{_REC_LAST}'
    GROUP BY 1, 2, 3"""


@query("rec_rollup", f"""
    SELECT entity, DATE '{START}' + (bucket + 1) * 91 AS date, count(*) AS firms,
           round(avg(score), 6) AS mean_score
    FROM firm_means GROUP BY 1, 2""", firm_means=_FIRM_MEANS)
def rec_rollup(spark, sf_dir):
    """The JSON cell of firm scores, read back as its size and mean."""
    cells = rollups.recommendation_rollup(views.recommendations(spark, sf_dir), START, END,
                                          scores=views.GRADES)
    scores = F.map_values(F.from_json("AvgRecommendations", "map<string,double>"))
    return cells.select("entity", "date", F.size(scores).cast("long").alias("firms"),
                        F.round(mean_of_json(F.col("AvgRecommendations")), 6)
                        .alias("mean_score"))


_FIRMS = ("AUTOMOBILE & CO", "BUILDING & CO", "FURNITURE & CO", "HOUSEHOLD & CO",
          "MACHINERY & CO")


@query("rec_rollup_wide", f"""
    SELECT entity, DATE '{START}' + (bucket + 1) * 91 AS date, """ + ", ".join(
    f"""round(max(CASE WHEN firm = '{f.replace(" ", "")}' THEN score END), 6)
        AS "{f.replace(" ", "")}\"""" for f in _FIRMS) + """
    FROM firm_means GROUP BY 1, 2""", firm_means=_FIRM_MEANS)
def rec_rollup_wide(spark, sf_dir):
    wide = rollups.recommendation_rollup(
        views.recommendations(spark, sf_dir), START, END, collapse=False, firms=_FIRMS,
        scores=views.GRADES)
    return rounded(wide, *[f.replace(" ", "") for f in _FIRMS])


@query("json_score", """
    SELECT event_id, coalesce(json_extract_string(props, '$.k')::DOUBLE, 0) AS score
    FROM events""")
def json_score(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select(
        "event_id", mean_of_json(F.col("props")).alias("score"))


_DIVIDENDS_SQL = """
    SELECT e.entity, e.q_ord, e.quarter_end, round(coalesce(sum(d.dividend), 0), 6)
           AS "DividendPerShare"
    FROM (SELECT *, coalesce(lag(quarter_end) OVER (PARTITION BY entity ORDER BY quarter_end),
                             quarter_end - 90) AS low FROM quarter_ends) e
    LEFT JOIN dividends d ON d.entity = e.entity AND d.date >= e.low AND d.date < e.quarter_end
    GROUP BY 1, 2, 3"""


@query("dividends_per_quarter", _DIVIDENDS_SQL)
def dividends_per_quarter(spark, sf_dir):
    paid = rollups.dividends_per_quarter(views.quarter_ends(spark, sf_dir),
                                         views.dividends(spark, sf_dir))
    return rounded(paid, "DividendPerShare")


@query("splits_per_quarter", """
    SELECT e.entity, e.q_ord, e.quarter_end, arg_max(s.split, s.date) AS "Split"
    FROM quarter_ends e LEFT JOIN splits s ON s.entity = e.entity
        AND s.date > e.quarter_end - 91 AND s.date < e.quarter_end
    GROUP BY 1, 2, 3""")
def splits_per_quarter(spark, sf_dir):
    return rollups.splits_per_quarter(views.quarter_ends(spark, sf_dir),
                                      views.splits(spark, sf_dir))


_SPLIT_PRODUCT = """
    SELECT e.entity, e.q_ord, e.quarter_end, product(s.split) AS "Split"
    FROM quarter_ends e LEFT JOIN splits s ON s.entity = e.entity
        AND s.date > e.quarter_end - 91 AND s.date < e.quarter_end
    GROUP BY 1, 2, 3"""


@query("splits_product", _SPLIT_PRODUCT)
def splits_product(spark, sf_dir):
    return rollups.splits_per_quarter(views.quarter_ends(spark, sf_dir),
                                      views.splits(spark, sf_dir), "product")


@query("latest_price", """
    SELECT entity, arg_max(close, date) AS "CurrentPrice" FROM prices
    WHERE date BETWEEN DATE '2001-07-01' - 60 AND DATE '2001-07-01' GROUP BY 1""")
def latest_price(spark, sf_dir):
    return rollups.latest_price(views.prices(spark, sf_dir), date(2001, 7, 1), 60)


# ---------------------------------------------------------------- statements and whole facts

_BALANCE = ["Cash", "CommonStock", "TotalAssets"]
_INCOME = ["TotalRevenue", "ResearchDevelopment", "Ebit", "MarketCap"]
_FLOW = ["NetIncome", "DividendsPaid"]
_ITEMS = ["Cash", "CommonStock", "TotalAssets", "TotalRevenue", "ResearchDevelopment", "Ebit",
          "NetIncome", "DividendsPaid"]


@query("statement_pivot", f"""
    SELECT entity, date, {fiscal('date')} AS q_ord, {", ".join(f'"{i}"' for i in _ITEMS)}
    FROM facts""")
def statement_pivot(spark, sf_dir):
    """Three long statements, one unwanted item among them, back to one row per quarter."""
    facts = views.facts(spark, sf_dir)
    statements = [views.long_form(facts, part) for part in (_BALANCE, _INCOME, _FLOW)]
    return statements_to_panel(*statements, items=_ITEMS)


_STARTS = "SELECT entity, min(quarter_end) - 91 AS start FROM quarter_ends GROUP BY 1"
_WINDOWS = f"""
    SELECT entity, start + (bucket + 1) * 91 AS date, "PriceAvg", "PriceLow", "PriceHigh",
           "PriceEoQ", "Volume"
    FROM (SELECT p.entity, start, {_bucket('date', 'start')} AS bucket, {_PRICE_AGGREGATES}
          FROM supplier_prices p JOIN starts s ON p.entity = s.entity
          WHERE date >= start AND date < DATE '{END}' GROUP BY 1, 2, 3)
    WHERE start + (bucket + 1) * 91 < DATE '{END}'"""
_LABELLED = f"""
    SELECT *, {fiscal('date')} AS q_ord FROM price_windows
    QUALIFY row_number() OVER (PARTITION BY entity, {fiscal('date')} ORDER BY date DESC) = 1"""


@query("aligned_windows", """
    SELECT e.entity, e.q_ord, e.quarter_end, w.date AS window_end, w."PriceHigh", w."PriceEoQ"
    FROM quarter_ends e LEFT JOIN labelled w ON w.entity = e.entity AND w.q_ord = e.q_ord""",
       starts=_STARTS, price_windows=_WINDOWS, labelled=_LABELLED)
def aligned_windows(spark, sf_dir):
    """Windows counted from each supplier's first quarter meet the quarters by label."""
    ends = views.quarter_ends(spark, sf_dir)
    starts = ends.groupBy("entity").agg(F.date_sub(F.min("quarter_end"), 91).alias("start"))
    windows = rollups.label_windows(
        rollups.price_rollup_from(views.supplier_prices(spark, sf_dir), starts, END))
    named = windows.select(*KEY, F.col("date").alias("window_end"), "PriceHigh", "PriceEoQ")
    return ends.join(named, list(KEY), "left")


@query("index_price_history", f"""
    SELECT w.entity, w.date, {fiscal('w.date')} AS q_ord, w."PriceLow", w."PriceHigh",
           w."PriceEoQ", w."Volume", arg_max(s.split, s.date) AS "Split"
    FROM (SELECT entity, DATE '{START}' + (bucket + 1) * 91 AS date, "PriceLow", "PriceHigh",
                 "PriceEoQ", "Volume"
          FROM (SELECT entity, {_bucket('date')} AS bucket, {_PRICE_AGGREGATES}
                FROM supplier_prices WHERE date >= DATE '{START}' AND date < DATE '{_PRICE_LAST}'
                GROUP BY 1, 2)) w
    LEFT JOIN splits s ON s.entity = w.entity AND s.date > w.date - 91 AND s.date < w.date
    GROUP BY ALL""")
def index_price_history(spark, sf_dir):
    return loading.index_price_history(
        views.supplier_prices(spark, sf_dir), views.splits(spark, sf_dir), START, END
    ).drop("PriceAvg")


_RATED = f"""
    SELECT f.*, bucket, start FROM (
        SELECT r.entity, start, {_bucket('date', 'start')} AS bucket, replace(firm, ' ', '') AS firm,
               avg(CASE grade WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 1 WHEN '5-LOW' THEN -1
                   ELSE 0 END) AS score
        FROM supplier_ratings r JOIN starts s ON r.entity = s.entity
        WHERE date >= start AND date < DATE '{END}' GROUP BY 1, 2, 3, 4) f"""
_RATED_QUARTERS = f"""
    SELECT entity, q_ord, arg_max(firms, day) AS firms, arg_max(total, day) AS total FROM (
        SELECT entity, start + (bucket + 1) * 91 AS day,
               {fiscal("start + (bucket + 1) * 91")} AS q_ord, count(*) AS firms, sum(score) AS total
        FROM rated WHERE start + (bucket + 1) * 91 <= DATE '{END}' GROUP BY entity, start, bucket)
    GROUP BY 1, 2"""
_SPLIT_LAST = """SELECT e.entity, e.q_ord, arg_max(s.split, s.date) AS "Split"
    FROM quarter_ends e LEFT JOIN splits s ON s.entity = e.entity
    AND s.date > e.quarter_end - 91 AND s.date < e.quarter_end GROUP BY 1, 2"""
_ALL_ITEMS = ", ".join(f'f."{c}"::DOUBLE AS "{c}"' for c in STATEMENT_ITEMS)
_EVENT_VIEWS = {"starts": _STARTS, "price_windows": _WINDOWS, "labelled": _LABELLED,
                "paid": _DIVIDENDS_SQL, "split_quarters": _SPLIT_LAST, "rated": _RATED,
                "rated_quarters": _RATED_QUARTERS,
                "caps": 'SELECT entity, max("MarketCap") AS "MarketCap" FROM facts GROUP BY 1'}
_EVENT_JOINS = """
    FROM facts f JOIN paid d ON d.entity = f.entity AND d.q_ord = f.q_ord
    JOIN split_quarters s ON s.entity = f.entity AND s.q_ord = f.q_ord
    JOIN caps c ON c.entity = f.entity
    LEFT JOIN labelled w ON w.entity = f.entity AND w.q_ord = f.q_ord
    LEFT JOIN rated_quarters r ON r.entity = f.entity AND r.q_ord = f.q_ord"""
_EVENT_COLUMNS = f"""f.entity, f.date, f.q_ord, CAST(f.q_ord // 4 AS INTEGER) AS fy, {_ALL_ITEMS},
    d."DividendPerShare", s."Split" """
_EVENT_WINDOWS = """round(w."PriceAvg", 6) AS "PriceAvg", w."PriceLow", w."PriceHigh",
    w."PriceEoQ", w."Volume", r.firms AS "RatingFirms", round(r.total, 6) AS "RatingTotal" """


def _statements(facts):
    """The items of a balance sheet, an income statement and a cash flow statement."""
    return [views.long_form(facts, list(STATEMENT_ITEMS[a:b])) for a, b in ((0, 6), (6, 14), (14, 21))]


def _with_ratings(rows):
    """The cell of firm scores, read back as its size and sum."""
    scores = F.map_values(F.from_json("AvgRecommendations", "map<string,double>"))
    total = F.aggregate(scores, F.lit(0.0), lambda a, v: a + v)
    firms = F.when(F.col("AvgRecommendations").isNotNull(), F.size(scores).cast("long"))
    return rounded(rows.withColumn("RatingFirms", firms).withColumn("RatingTotal", total)
                   .drop("AvgRecommendations"), "DividendPerShare", "PriceAvg", "RatingTotal")


@query("quarterly_facts", f"""
    SELECT {_EVENT_COLUMNS}, f."Earnings", c."MarketCap", {_EVENT_WINDOWS} {_EVENT_JOINS}""",
       **_EVENT_VIEWS)
def quarterly_facts(spark, sf_dir):
    """Statements of 21 items, dividends, splits, prices, ratings, earnings and market value."""
    facts = written(views.facts(spark, sf_dir), "facts")
    return _with_ratings(loading.quarterly_facts(
        _statements(facts), views.dividends(spark, sf_dir), views.splits(spark, sf_dir),
        views.supplier_prices(spark, sf_dir), views.supplier_ratings(spark, sf_dir), END,
        earnings=facts.select(*KEY, "Earnings"),
        market_caps=facts.groupBy("entity").agg(F.max("MarketCap").alias("MarketCap")),
        scores=views.GRADES))


@query("collected_batch", f"""
    SELECT {_EVENT_COLUMNS}, {_EVENT_WINDOWS} {_EVENT_JOINS}
    UNION ALL
    SELECT entity, end_day, {fiscal('end_day')}, CAST({fiscal('end_day')} // 4 AS INTEGER),
           {", ".join("NULL" for _ in STATEMENT_ITEMS)}, NULL, NULL, round("PriceAvg", 6), "PriceLow",
           "PriceHigh", "PriceEoQ", "Volume", NULL, NULL
    FROM (SELECT *, first_day + (bucket + 1) * 91 AS end_day FROM (
        SELECT entity, first_day, {_bucket('date', 'first_day')} AS bucket, {_PRICE_AGGREGATES}
        FROM market_prices, (SELECT min(date) AS first_day FROM market_prices)
        WHERE date < DATE '{END}' GROUP BY 1, 2, 3))
    WHERE end_day < DATE '{END}'""", **_EVENT_VIEWS)
def collected_batch(spark, sf_dir):
    """Suppliers with all sources and one index that only has prices, since its first."""
    facts = written(views.facts(spark, sf_dir), "facts")
    market = views.market_prices(spark, sf_dir)
    prices = union_by_name(views.supplier_prices(spark, sf_dir), market)
    return _with_ratings(loading.collect_batch(
        _statements(facts), views.dividends(spark, sf_dir), views.splits(spark, sf_dir), prices,
        views.supplier_ratings(spark, sf_dir), [views.MARKET],
        market.agg(F.min("date")).first()[0], END, scores=views.GRADES))


# ---------------------------------------------------------------- split corrections

_TABLE_END = ordinal(1999, 1)


def _split_facts(spark, sf_dir):
    """Facts with the product of each quarter's splits."""
    found = rollups.splits_per_quarter(views.quarter_ends(spark, sf_dir),
                                       views.splits(spark, sf_dir), "product")
    return written(views.facts(spark, sf_dir).join(found.select(*KEY, "Split"), list(KEY), "left"),
                   "split-facts")


_SPLIT_VIEWS = {
    "split_quarters": _SPLIT_PRODUCT,
    "split_facts": """SELECT f.*, s."Split" FROM facts f
        JOIN split_quarters s ON s.entity = f.entity AND s.q_ord = f.q_ord""",
    "factors": f"""SELECT entity, product("Split") AS factor, min(q_ord) AS split_quarter
        FROM split_facts WHERE q_ord >= {_TABLE_END} AND "Split" IS NOT NULL GROUP BY 1""",
}
_ADJUSTED = ("PriceAvg", "PriceHigh", "PriceLow", "PriceEoQ", "DividendPerShare",
             "IssuanceOfStock", "RepurchaseOfStock", "CommonStock")


def _adjusted_sql(factor: str) -> str:
    return ", ".join(f'f."{c}" {"/" if i < 5 else "*"} {factor} AS "{c}"'
                     for i, c in enumerate(_ADJUSTED))


@query("split_factors", "SELECT entity, factor, split_quarter FROM factors", **_SPLIT_VIEWS)
def split_factors(spark, sf_dir):
    rows = _split_facts(spark, sf_dir)
    return splits.batch_split_factors(rows, rows.where(F.col("q_ord") < _TABLE_END))


@query("split_backfill", f"""
    SELECT f.entity, f.q_ord, {_adjusted_sql(
    "CASE WHEN f.q_ord < s.split_quarter THEN s.factor ELSE 1 END")}
    FROM split_facts f LEFT JOIN factors s ON s.entity = f.entity
    WHERE f.q_ord < {_TABLE_END + 4}""", **_SPLIT_VIEWS)
def split_backfill(spark, sf_dir):
    rows = _split_facts(spark, sf_dir)
    factors = splits.batch_split_factors(rows, rows.where(F.col("q_ord") < _TABLE_END))
    stored = rows.where(F.col("q_ord") < _TABLE_END + 4).select(*KEY, *_ADJUSTED)
    return splits.adjust_panel(stored, factors)


@query("split_archive", """
    SELECT a.entity, "QuarterEnd", "Price" / coalesce(factor, 1) AS "Price",
           "PriceHigh" / coalesce(factor, 1) AS "PriceHigh",
           "PriceLow" / coalesce(factor, 1) AS "PriceLow",
           "DividendPerShare" / coalesce(factor, 1) AS "DividendPerShare",
           "SharesSplitAdjusted" * coalesce(factor, 1) AS "SharesSplitAdjusted",
           "SplitFactor" * coalesce(factor, 1) AS "SplitFactor"
    FROM archive a LEFT JOIN factors s ON s.entity = a.entity""", **_SPLIT_VIEWS)
def split_archive(spark, sf_dir):
    rows = _split_facts(spark, sf_dir)
    factors = splits.batch_split_factors(rows, rows.where(F.col("q_ord") < _TABLE_END))
    stored = views.archive(spark, sf_dir).select(
        "entity", "QuarterEnd", *splits.ARCHIVE_DIVIDED, *splits.ARCHIVE_MULTIPLIED)
    return splits.adjust_archive(stored, factors)


@query("split_running", f"""
    SELECT f.entity, f.q_ord, f."SplitFactor", {_adjusted_sql('f."SplitFactor"')}
    FROM (SELECT *, coalesce(product(coalesce("Split", 1)) OVER (
              PARTITION BY entity ORDER BY q_ord DESC
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS "SplitFactor"
          FROM split_facts) f""", **_SPLIT_VIEWS)
def split_running(spark, sf_dir):
    adjusted = splits.adjust_by_later_splits(_split_facts(spark, sf_dir))
    return adjusted.select(*KEY, "SplitFactor", *_ADJUSTED)


# ---------------------------------------------------------------- audit and streams


@query("row_audit", """
    SELECT 'all' AS step, count(*) AS rows FROM gappy
    UNION ALL SELECT 'priced', count(*) FROM gappy WHERE "PriceAvg" IS NOT NULL
    UNION ALL SELECT 'window', count(*) FROM gappy WHERE "PriceAvg" IS NOT NULL
        AND q_ord >= 7988 AND q_ord < 8000""")
def row_audit(spark, sf_dir):
    """Rows left after each of three steps, counted while one write runs."""
    rows, everything = count_rows(views.gappy(spark, sf_dir), "all")
    rows, priced = count_rows(filters.require(rows, ["PriceAvg"]), "priced")
    rows, window = count_rows(
        filters.between_quarters(rows, ordinal(1997, 1), ordinal(2000, 1)), "window")
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [(name, seen.get["rows"]) for name, seen in
         (("all", everything), ("priced", priced), ("window", window))],
        "step string, rows long")


_STREAM_START = date(2024, 1, 1)


def _tick_stream(spark, sf_dir):
    schema = views.table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir)
            .select(F.col("user_id").cast("string").alias("entity"),
                    F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("close"),
                    F.col("event_id").alias("volume")))


@query("stream_rollup", """
    SELECT entity, DATE '2024-01-01' + (bucket + 1) * 7 AS date, round(avg(close), 6) AS "PriceAvg",
           min(close) AS "PriceLow", max(close) AS "PriceHigh", arg_max(close, ts) AS "PriceEoQ",
           arg_max(volume, ts) AS "Volume"
    FROM (SELECT CAST(user_id AS VARCHAR) AS entity, value AS close, event_id AS volume, ts,
                 CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER)
                     AS bucket FROM events)
    WHERE DATE '2024-01-01' + (bucket + 1) * 7 <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
    GROUP BY 1, 2""")
def stream_rollup(spark, sf_dir):
    """Weekly windows of the event stream whose end the watermark has passed."""
    path, checkpoint = fresh_path(spark, "ticks"), fresh_path(spark, "ticks-state")
    rolled = stream_price_rollup(_tick_stream(spark, sf_dir), _STREAM_START, 7)
    (rolled.writeStream.format("parquet").option("path", path)
     .option("checkpointLocation", checkpoint).outputMode("append")
     .trigger(availableNow=True).start().awaitTermination())
    return rounded(spark.read.schema(rolled.schema).parquet(path), "PriceAvg")


@query("stream_rollup_closed", """
    SELECT entity, DATE '2024-01-01' + (bucket + 1) * 7 AS date, round(avg(close), 6) AS "PriceAvg",
           min(close) AS "PriceLow", max(close) AS "PriceHigh",
           arg_max(close, (ts, close)) AS "PriceEoQ", arg_max(volume, (ts, close)) AS "Volume"
    FROM (SELECT CAST(user_id AS VARCHAR) AS entity, value AS close, event_id AS volume, ts,
                 CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER)
                     AS bucket FROM events)
    GROUP BY entity, bucket""")
def stream_rollup_closed(spark, sf_dir):
    """Every event delivered twice; when the stream has ended its open windows are closed."""
    path, checkpoint = fresh_path(spark, "ticks"), fresh_path(spark, "ticks-state")
    twice = _tick_stream(spark, sf_dir).union(_tick_stream(spark, sf_dir))
    rolled = stream_price_rollup(twice, _STREAM_START, 7, redelivered=True)
    (rolled.writeStream.format("parquet").option("path", path)
     .option("checkpointLocation", checkpoint).outputMode("append")
     .trigger(availableNow=True).start().awaitTermination())
    emitted = spark.read.schema(rolled.schema).parquet(path)
    events = views.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("entity"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("close"), F.col("event_id").alias("volume"))
    rest = open_windows(events, emitted, _STREAM_START, 7)
    return rounded(emitted.unionByName(rest), "PriceAvg")
