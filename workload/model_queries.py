"""Feature transforms, ranking, back-test and models."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from quarterdeck.functions.names import KEY, TARGET
from quarterdeck.functions.periods import ordinal
from quarterdeck.operators import backtest, categories, changes, encoding, metrics, ranking
from quarterdeck.plans import linear_windows as sums, training, walk_forward as walk
from quarterdeck.plans.settings import Settings
from quarterdeck.session import fresh_path, written
from workload import tables as views
from workload.catalog import query
from workload.event_queries import rounded
from workload.panel_queries import feature_rows

# ---------------------------------------------------------------- feature transforms

_STATS = ("PriceAvg", "TotalRevenue", "ResearchDevelopment", "Volume")
_MOMENTS = "SELECT " + ", ".join(
    f'avg("{c}") AS m{i}, stddev_pop("{c}") AS s{i}' for i, c in enumerate(_STATS)) + " FROM gappy"


@query("outliers", 'SELECT entity, q_ord FROM gappy CROSS JOIN moments WHERE ' + " AND ".join(
    f'("{c}" IS NULL OR abs(("{c}" - m{i}) / s{i}) < 2)' for i, c in enumerate(_STATS)),
       moments=_MOMENTS)
def outliers(spark, sf_dir):
    rows = views.gappy(spark, sf_dir)
    kept = encoding.drop_outliers(rows, encoding.fit_moments(rows, _STATS), 2.0)
    return kept.select(*KEY)


@query("scale", "SELECT entity, q_ord, " + ", ".join(
    f'round(("{c}" - m{i}) / s{i}, 6) AS "{c}"' for i, c in enumerate(_STATS))
       + " FROM gappy CROSS JOIN moments", moments=_MOMENTS)
def scale(spark, sf_dir):
    rows = views.gappy(spark, sf_dir).select(*KEY, *_STATS)
    return rounded(encoding.scale(rows, encoding.fit_moments(rows, _STATS)), *_STATS)


@query("column_moments", "SELECT " + ", ".join(
    f'round(m{i}, 4) AS "mean_{c}", round(s{i}, 4) AS "std_{c}"'
    for i, c in enumerate(_STATS)) + " FROM moments", moments=_MOMENTS)
def column_moments(spark, sf_dir):
    fitted = encoding.fit_moments(views.gappy(spark, sf_dir), _STATS)
    names = [f"{kind}_{c}" for c in _STATS for kind in ("mean", "std")]
    row = [round(values[c], 4) for c in _STATS for values in (fitted.mean, fitted.std)]
    return spark.createDataFrame([row], ", ".join(f"`{n}` double" for n in names))


_SECTORED = """SELECT f.entity, q_ord, "Sector", "Industry" FROM facts f
    LEFT JOIN dimension d ON f.entity = d.entity"""


def _sectored(spark, sf_dir):
    """Facts with sector and industry, missing ones left missing."""
    return views.facts(spark, sf_dir).select(*KEY).join(
        views.dimension(spark, sf_dir), "entity", "left")


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")


@query("one_hot", "SELECT o_orderkey, CAST(grade IS NULL AS INTEGER) AS grade_nan, " + ", ".join(
    f"CAST(grade IS NOT DISTINCT FROM '{p}' AS INTEGER) AS \"grade_{p}\""
    for p in _PRIORITIES[1:]) + " FROM graded",
       graded="SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS grade FROM orders")
def one_hot(spark, sf_dir):
    """Order priorities; the unspecified one counts as missing and gets a column of its own."""
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(
        F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("grade"))
    return encoding.one_hot(rows, encoding.fit_categories(rows, ["grade"]))


_CODES = """SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
    FROM (SELECT DISTINCT "Industry" AS v FROM sectored WHERE "Industry" IS NOT NULL)"""


@query("category_codes", """
    SELECT entity, q_ord, "Sector", coalesce(code, -1) AS "Industry"
    FROM sectored LEFT JOIN codes ON "Industry" = v""", sectored=_SECTORED, codes=_CODES)
def category_codes(spark, sf_dir):
    rows = _sectored(spark, sf_dir)
    return encoding.encode(rows, "Industry", encoding.category_codes(rows, "Industry")).select(
        *KEY, "Sector", "Industry")


@query("category_codes_many", """
    SELECT o_orderkey, coalesce(code, -1) AS o_custkey FROM orders LEFT JOIN (
        SELECT o_custkey AS v, CAST(row_number() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT o_custkey FROM orders)) ON o_custkey = v""")
def category_codes_many(spark, sf_dir):
    """Codes of a column with many values, numbered partition by partition."""
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    codes = encoding.category_codes(rows, "o_custkey")
    return encoding.encode(rows, "o_custkey", codes)


@query("distinct_values", """
    SELECT 'Sector' AS name, "Sector" AS value FROM dimension
    UNION SELECT 'Industry', "Industry" FROM dimension""")
def distinct_values(spark, sf_dir):
    found = categories.distinct_values(views.dimension(spark, sf_dir), ["Sector", "Industry"])
    return found.withColumnRenamed("column", "name")


_GRADED = """SELECT o_orderkey, o_totalprice, CAST(o_custkey AS VARCHAR) AS customer,
    nullif(o_orderpriority, '4-NOT SPECIFIED') AS grade FROM orders"""
_COLUMNS = ["grade", "customer"]


def _graded(spark, sf_dir):
    """Orders with a column of few and one of many categories."""
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_custkey").cast("string").alias("customer"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("grade"))


_ALL_CODES = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT {c} AS v FROM graded WHERE {c} IS NOT NULL)""" for c in _COLUMNS)


@query("category_codes_all", _ALL_CODES, graded=_GRADED)
def category_codes_all(spark, sf_dir):
    """The codes of all columns in one pass."""
    return categories.sorted_codes(_graded(spark, sf_dir), _COLUMNS)


@query("one_hot_vectors", """
    SELECT o_orderkey, CAST(0 AS INTEGER) AS slot, 'grade' AS "column", NULL AS value
    FROM graded WHERE grade IS NULL
    UNION ALL SELECT o_orderkey, code, "column", value FROM graded JOIN codes
        ON "column" = 'grade' AND value = grade WHERE code > 0
    UNION ALL SELECT o_orderkey, code + (SELECT max(code) FROM codes WHERE "column" = 'grade'),
        "column", value FROM graded JOIN codes ON "column" = 'customer' AND value = customer
        WHERE code > 0""", graded=_GRADED, codes=_ALL_CODES)
def one_hot_vectors(spark, sf_dir):
    """The entries of a sparse vector that has a place for each grade and each customer but the first."""
    vectors, slots = categories.one_hot_vectors(_graded(spark, sf_dir), _COLUMNS)
    entries = vectors.select("o_orderkey", F.explode(categories.places("categories")).alias("slot"))
    return entries.join(slots, "slot").select("o_orderkey", "slot", "column", "value")


@query("category_means", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", {c} AS value, round((sum(o_totalprice) + 10 * (
        SELECT avg(o_totalprice) FROM graded)) / (count(*) + 10), 4) AS number
    FROM graded GROUP BY {c}""" for c in _COLUMNS), graded=_GRADED)
def category_means(spark, sf_dir):
    """The mean order total of each grade and customer, drawn to that of all orders."""
    means = categories.mean_targets(_graded(spark, sf_dir), _COLUMNS, "o_totalprice")
    return means.withColumn("number", F.round("number", 4))


@query("holdout_split", """
    SELECT entity, q_ord, row_number() OVER (ORDER BY md5(entity || '|' || q_ord || '|7'))
           <= floor((SELECT count(*) FROM facts) * 0.2) AS held_out FROM facts""")
def holdout_split(spark, sf_dir):
    return encoding.hold_out(views.facts(spark, sf_dir).select(*KEY), 0.2)


_WINDOW = """SELECT w.q_ord AS quarter, f.entity, f.q_ord, f."Volume" AS x, f."TotalRevenue" AS y,
        md5(f.entity || '|' || f.q_ord || '|7') AS h,
        row_number() OVER (PARTITION BY w.q_ord ORDER BY md5(f.entity || '|' || f.q_ord || '|7')) AS place,
        count(*) OVER (PARTITION BY w.q_ord) AS n
    FROM (SELECT DISTINCT q_ord FROM facts) w
    JOIN facts f ON f.q_ord >= w.q_ord - 16 AND f.q_ord < w.q_ord - 3"""
_LINEAR = Settings(model="linear", target="TotalRevenue", horizon=4)


def _windows(rows) -> dict[int, range]:
    """The training window of every quarter that has rows in it."""
    quarters = {r["q_ord"] for r in rows.select("q_ord").distinct().collect()}
    windows = {q: training.training_window(q, _LINEAR) for q in sorted(quarters)}
    return {q: w for q, w in windows.items() if quarters & set(w)}


@query("holdout_windows", """
    SELECT CAST(quarter AS INTEGER) AS q_ord, max(h) AS last_held FROM windows
    WHERE place <= floor(n * 0.2) GROUP BY 1""", windows=_WINDOW)
def holdout_windows(spark, sf_dir):
    """The last hash that is held out of each of the overlapping training windows."""
    rows = views.facts(spark, sf_dir)
    hashes = rows.select("q_ord", encoding.key_hash().alias("h"))
    limits = encoding.hold_out_limits(hashes, _windows(rows))
    found = spark.createDataFrame(list(limits.items()), "q_ord int, last string")
    # A limit is a prefix filled up; the hash it lets through last is in the window's rows.
    spans = spark.createDataFrame([(q, w.start, w.stop) for q, w in _windows(rows).items()],
                                  "q_ord int, first int, end int")
    held = hashes.withColumnRenamed("q_ord", "own").join(
        F.broadcast(spans.join(found, "q_ord")), F.expr("own >= first AND own < end AND h <= last"))
    return held.groupBy("q_ord").agg(F.max("h").alias("last_held"))


@query("holdout_parts", """
    SELECT 'train' AS part, entity, q_ord, "PriceAvg" FROM marked WHERE NOT held_out
    UNION ALL SELECT 'test', entity, q_ord, "PriceAvg" FROM marked WHERE held_out""",
       marked="""SELECT *, row_number() OVER (ORDER BY md5(entity || '|' || q_ord || '|7'))
           <= floor((SELECT count(*) FROM facts) * 0.2) AS held_out FROM facts""")
def holdout_parts(spark, sf_dir):
    marked = encoding.hold_out(views.facts(spark, sf_dir).select(*KEY, "PriceAvg"), 0.2)
    train, test = encoding.split_hold_out(marked)
    _, labels = encoding.split_target(train, "PriceAvg")
    return (labels.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test"))))


_SCORED_SQL = """SELECT entity, q_ord, "PriceAvg" AS label,
    lag("PriceAvg") OVER (PARTITION BY entity ORDER BY q_ord) AS guess FROM facts"""


def _guessed(spark, sf_dir):
    """The last quarter's price as a guess of this one's."""
    guess = F.lag("PriceAvg").over(changes.by_quarter())
    return (views.facts(spark, sf_dir)
            .select(*KEY, F.col("PriceAvg").alias("label"), guess.alias("guess"))
            .where(F.col("guess").isNotNull()))


@query("regression_metrics", """
    SELECT round(avg(abs(guess - label)), 4) AS mae, round(avg((guess - label) ** 2), 2) AS mse,
           round(sqrt(avg((guess - label) ** 2)), 4) AS rmse FROM guessed
    WHERE guess IS NOT NULL""", guessed=_SCORED_SQL)
def regression_metrics(spark, sf_dir):
    errors = metrics.regression_metrics(_guessed(spark, sf_dir), "label", "guess")
    return errors.select(F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"),
                         F.round("rmse", 4).alias("rmse"))


@query("absolute_error", """
    SELECT entity, q_ord, label, guess, abs(guess - label) * 100 AS absolute_error_pct
    FROM guessed WHERE guess IS NOT NULL""", guessed=_SCORED_SQL)
def absolute_error(spark, sf_dir):
    return metrics.absolute_error(_guessed(spark, sf_dir), "label", "guess")


# ---------------------------------------------------------------- ranking and back-test

_CHANGED = """SELECT entity, q_ord, p / nullif(lag(p) OVER w, 0) - 1 AS change
    FROM (SELECT entity, q_ord, last_value("PriceAvg" IGNORE NULLS) OVER (
              PARTITION BY entity ORDER BY q_ord ROWS UNBOUNDED PRECEDING) AS p FROM {0})
    WINDOW w AS (PARTITION BY entity ORDER BY q_ord)"""


def _changed(rows):
    return changes.add_changes(rows.select(*KEY, "PriceAvg"), ["PriceAvg"], (1,)).drop("PriceAvg")


def _picks(rows, n=7):
    return ranking.top_n_per_quarter(rows, n, backtest.CHANGE)


@query("top_n", """
    SELECT entity, q_ord, change AS "Q_Delta_PriceAvg" FROM changed
    ORDER BY change DESC NULLS LAST, entity LIMIT 7""", changed=_CHANGED.format("facts"))
def top_n(spark, sf_dir):
    return ranking.top_n(_changed(views.facts(spark, sf_dir)), 7, backtest.CHANGE)


_TOP = """SELECT entity, q_ord, change, CAST(row_number() OVER (
        PARTITION BY q_ord ORDER BY change DESC, entity) AS INTEGER) AS rank
    FROM changed WHERE change IS NOT NULL"""


@query("top_n_per_quarter", """
    SELECT entity, q_ord, change AS "Q_Delta_PriceAvg", rank FROM top WHERE rank <= 7""",
       changed=_CHANGED.format("facts"), top=_TOP)
def top_n_per_quarter(spark, sf_dir):
    return _picks(_changed(views.facts(spark, sf_dir)))


@query("top_many_per_quarter", """
    SELECT entity, q_ord, close, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY q_ord ORDER BY close DESC, entity)
                       AS INTEGER) AS rank
        FROM (SELECT entity, CAST(year(date) AS INTEGER) AS q_ord, max(close) AS close
              FROM prices GROUP BY 1, 2))
    WHERE rank <= 1200""")
def top_many_per_quarter(spark, sf_dir):
    """More rows per group than Spark cuts off before the shuffle by itself."""
    best = (views.prices(spark, sf_dir).groupBy("entity", F.year("date").alias("q_ord"))
            .agg(F.max("close").alias("close")))
    return ranking.top_n_per_quarter(best, 1200, "close")


_ALLOCATION = """
    SELECT entity, q_ord, rank, round({share}, 9) AS weight FROM (
        SELECT *, count(*) OVER (PARTITION BY q_ord) AS n FROM top WHERE rank <= 7)"""
_FIB_TERM = "[1, 1, 2, 3, 5, 8, 13][n - rank + 1] / list_sum([1, 1, 2, 3, 5, 8, 13][1:n])"


@query("allocation_equal", _ALLOCATION.format(share="1.0 / n"),
       changed=_CHANGED.format("facts"), top=_TOP)
def allocation_equal(spark, sf_dir):
    weighted = ranking.add_weights(_picks(_changed(views.facts(spark, sf_dir))), "equal")
    return weighted.select(*KEY, "rank", F.round("weight", 9).alias("weight"))


@query("allocation_fibonacci", _ALLOCATION.format(share=_FIB_TERM),
       changed=_CHANGED.format("facts"), top=_TOP)
def allocation_fibonacci(spark, sf_dir):
    weighted = ranking.add_weights(_picks(_changed(views.facts(spark, sf_dir))), "fibonacci")
    return weighted.select(*KEY, "rank", F.round("weight", 9).alias("weight"))


_START, _END, _HOLD = ordinal(1996, 1), ordinal(2000, 4), 4


def _backtest_views(source: str, share: str) -> dict[str, str]:
    """The closed form in SQL. A live cohort is one up to the first quarter without picks."""
    return {
        "changed": _CHANGED.format(source),
        "top": _TOP,
        "picked": f"""SELECT entity, q_ord, {share} AS weight FROM (
            SELECT *, count(*) OVER (PARTITION BY q_ord) AS n FROM top
            WHERE rank <= 7 AND q_ord BETWEEN {_START} AND {_END})""",
        "spine": f"""SELECT CAST(r.range AS INTEGER) AS k, r.range IN (SELECT q_ord FROM picked)
            AS bought FROM range({_START}, {_END + 1}) r""",
        "last": f"""SELECT coalesce(min(k), {_END}) AS q FROM spine WHERE NOT bought""",
        "live": "SELECT k, bought FROM spine WHERE k <= (SELECT q FROM last)",
        "held": f"""SELECT p.entity, p.q_ord AS k, p.weight, CAST(a.range AS INTEGER) AS age
            FROM picked p, range(1, {_HOLD + 1}) a
            WHERE p.q_ord <= (SELECT q FROM last)
              AND p.q_ord + a.range <= (SELECT q FROM last) + 1""",
        "paths": """SELECT h.k, h.entity, h.weight, h.age, product(
                CASE WHEN c.entity IS NULL THEN 0 ELSE coalesce(1 + c.change, 'nan') END)
                OVER (PARTITION BY h.k, h.entity ORDER BY h.age ROWS UNBOUNDED PRECEDING) AS growth
            FROM held h LEFT JOIN changed c ON c.entity = h.entity AND c.q_ord = h.k + h.age""",
        "growth": """SELECT k, age, sum(weight * growth) AS g FROM paths GROUP BY 1, 2
            UNION ALL SELECT k, 1, 1.0 FROM live WHERE NOT bought""",
        "amounts": f"""SELECT l.k, 1000.0::DOUBLE / {_HOLD} * coalesce(product(g.g) OVER (
                PARTITION BY l.k % {_HOLD} ORDER BY l.k
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS amount
            FROM live l LEFT JOIN growth g ON g.k = l.k AND g.age = {_HOLD}""",
        "worth": """SELECT a.k + g.age AS q_ord, sum(a.amount * g.g) AS held
            FROM amounts a JOIN growth g ON g.k = a.k GROUP BY 1""",
        "quarters": "SELECT k AS q_ord FROM live UNION SELECT k + 1 FROM live",
    }


_PERFORMANCE = f"""
    SELECT CAST(q.q_ord AS INTEGER) AS q_ord, (q.q_ord % 4 + 1) || 'Q' || (q.q_ord // 4) AS label,
           CASE WHEN isnan(v) THEN NULL ELSE round(v, 2) END AS value
    FROM (SELECT q.q_ord, greatest(0, {_HOLD + _START} - q.q_ord) * (1000.0::DOUBLE / {_HOLD})
                 + coalesce(w.held, 0) AS v
          FROM quarters q LEFT JOIN worth w ON w.q_ord = q.q_ord) q"""


def _performance(rows, allocation):
    changed = _changed(rows)
    return backtest.portfolio_values(_picks(changed), changed, _START, _END, _HOLD, 1000.0,
                                     allocation)


@query("backtest_equal", _PERFORMANCE, **_backtest_views("facts", "1.0::DOUBLE / n"))
def backtest_equal(spark, sf_dir):
    return _performance(views.facts(spark, sf_dir), "equal")


@query("backtest_fibonacci", _PERFORMANCE, **_backtest_views("facts", _FIB_TERM))
def backtest_fibonacci(spark, sf_dir):
    return _performance(views.facts(spark, sf_dir), "fibonacci")


@query("backtest_gappy", _PERFORMANCE, **_backtest_views("gappy", "1.0::DOUBLE / n"))
def backtest_gappy(spark, sf_dir):
    """Holdings whose quarter is absent become worthless."""
    return _performance(views.gappy(spark, sf_dir), "equal")


@query("cohort_values", """
    SELECT CAST(k AS INTEGER) AS cohort, entity, age, round(growth, 6) AS growth FROM paths""",
       **_backtest_views("facts", "1.0::DOUBLE / n"))
def cohort_values(spark, sf_dir):
    changed = _changed(views.facts(spark, sf_dir))
    picks = _picks(changed).where(F.col("q_ord").between(_START, _END))
    cohorts = backtest.live_cohorts(picks, _START, _END)
    paths = backtest.holding_paths(ranking.add_weights(picks, "equal"), changed, cohorts,
                                   _HOLD)
    return paths.select("cohort", "entity", "age", F.round("growth", 6).alias("growth"))


@query("price_adjustment", """
    SELECT g.entity, g.q_ord, round(g.guess - 100 * coalesce(
        (coalesce(l.price, g.label) - g.label) / nullif(g.label, 0), 0), 6) AS guess
    FROM guessed g LEFT JOIN (
        SELECT entity, arg_max(close, date) AS price FROM supplier_prices
        WHERE date BETWEEN DATE '2001-08-01' - 5 AND DATE '2001-08-01' GROUP BY 1) l
    ON l.entity = g.entity WHERE g.guess IS NOT NULL""", guessed=_SCORED_SQL)
def price_adjustment(spark, sf_dir):
    from quarterdeck.operators.rollups import latest_price
    guessed = _guessed(spark, sf_dir)
    latest = latest_price(views.supplier_prices(spark, sf_dir), date(2001, 8, 1))
    rows = guessed.withColumnRenamed("label", "PriceAvg")
    adjusted = training.adjust_for_price(rows.select(*KEY, "guess"), rows, latest, "guess")
    return rounded(adjusted, "guess")


# ---------------------------------------------------------------- models

_DEFAULTS = Settings(market_indices=(views.MARKET,))


@query("linear_regression", """
    SELECT round(regr_slope("TotalRevenue", "Volume"), 4) AS slope,
           round(regr_intercept("TotalRevenue", "Volume"), 2) AS intercept,
           round(sqrt(avg(("TotalRevenue" - s * "Volume" - i) ** 2)), 2) AS rmse
    FROM facts, (SELECT regr_slope("TotalRevenue", "Volume") AS s,
                        regr_intercept("TotalRevenue", "Volume") AS i FROM facts)""")
def linear_regression(spark, sf_dir):
    """The linear model on one feature, whose solution SQL has as an aggregate."""
    from pyspark.ml.feature import VectorAssembler
    rows = VectorAssembler(inputCols=["Volume"], outputCol=training.VECTOR).transform(
        views.facts(spark, sf_dir).select(*KEY, "Volume", "TotalRevenue"))
    model = training.linear(Settings(target="TotalRevenue")).fit(rows)
    errors = metrics.regression_metrics(model.transform(rows), "TotalRevenue", "prediction")
    return errors.select(F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
                         F.round(F.lit(float(model.intercept)), 2).alias("intercept"),
                         F.round("rmse", 2).alias("rmse"))


def _linear_rows(spark, sf_dir):
    return views.facts(spark, sf_dir).select(
        *KEY, "Volume", "TotalRevenue").withColumn(training.HASH, encoding.key_hash())


@query("linear_windows", """
    SELECT CAST(quarter AS INTEGER) AS q_ord, count(*) AS rows, round(regr_slope(y, x), 3) AS slope,
           round(regr_intercept(y, x), 1) AS intercept
    FROM windows WHERE place > floor(n * 0.2) GROUP BY 1 HAVING count(DISTINCT x) > 1""", windows=_WINDOW)
def linear_windows(spark, sf_dir):
    """The linear model of every training window, all from one reading of the rows."""
    rows = _linear_rows(spark, sf_dir)
    made, models = sums.linear_windows(rows, _windows(rows), _LINEAR)
    return sums.unscaled(models, made).where("rows > 1").select(
        F.col("window").alias("q_ord"), "rows", F.round(F.col("coefficients")[0], 3).alias("slope"),
        F.round("intercept", 1).alias("intercept"))


_LINEAR_TOP = """SELECT entity, q_ord, CAST(row_number() OVER (
        PARTITION BY q_ord ORDER BY (slope * "Volume" + intercept) DESC, entity) AS INTEGER) AS rank
    FROM facts JOIN models ON quarter = q_ord"""
_LINEAR_MODELS = """SELECT quarter, coalesce(regr_slope(y, x), 0) AS slope,
        coalesce(regr_intercept(y, x), avg(y)) AS intercept
    FROM windows WHERE place > floor(n * 0.2) GROUP BY 1"""


@query("walk_forward_linear", """
    SELECT entity, q_ord, rank FROM top WHERE rank <= 7""",
       windows=_WINDOW, models=_LINEAR_MODELS, top=_LINEAR_TOP)
def walk_forward_linear(spark, sf_dir):
    """The picks of every quarter by a linear model of the quarters before it."""
    rows = views.facts(spark, sf_dir).select(*KEY, "Volume", "TotalRevenue")
    windows = _windows(rows)
    return walk.walk_forward_picks(rows, min(windows), max(windows), _LINEAR).select(*KEY, "rank")


def _features(spark, sf_dir):
    """The whole feature table: archive, ratios, 56 changes, index comparison, target."""
    return written(feature_rows(spark, sf_dir), "features")


def learnable_quarters(rows, settings=_DEFAULTS):
    """(first, last): the first quarter with a labelled one in its training window, the last one."""
    row = rows.agg(F.min(F.when(F.col(settings.target).isNotNull(), F.col("q_ord"))).alias("first"),
                   F.max("q_ord").alias("last")).first()
    return row["first"] + (settings.horizon if settings.purge else 1), row["last"]


@query("train_predict")
def train_predict(spark, sf_dir):
    """Boosted trees on the whole feature table, saved, loaded and applied to the candidates."""
    rows = _features(spark, sf_dir)
    fitted = training.fit(rows.drop("PriceAvg"), _DEFAULTS, stored=True)
    path = fresh_path(spark, "model")
    fitted.save(path)
    candidates = rows.where(F.col(TARGET).isNull()).drop(TARGET, "PriceAvg")
    return training.predict(training.load_pipeline(path), candidates)


@query("train_metrics")
def train_metrics(spark, sf_dir):
    """Errors of the shallow trees on the held-out part, with outliers cut, 0/1 categories and
    scaled numbers."""
    settings = replace(_DEFAULTS, model="shallow_trees", extract_outliers=True,
                       one_hot_encode=True, scale_numerics=True)
    return training.fit(_features(spark, sf_dir).drop("PriceAvg"), settings, stored=True).metrics


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return training.fit(
        _features(spark, sf_dir).drop("PriceAvg"), _DEFAULTS, stored=True).importance


@query("recommendation")
def recommendation(spark, sf_dir):
    """Train on the labelled rows, adjust the candidates of the two quarters before the last price
    by that price, show the best."""
    prices = views.supplier_prices(spark, sf_dir)
    today = prices.agg(F.max("date")).first()[0]
    now = ordinal(today.year, (today.month + 2) // 3)
    _, best = walk.recommend(feature_rows(spark, sf_dir), prices, today, now - 2, now, _DEFAULTS)
    return best


@query("walk_forward")
def walk_forward(spark, sf_dir):
    """Boosted trees for every quarter that has one to learn from, its picks bought and held."""
    rows = _features(spark, sf_dir)
    panel = rows.select(*KEY, "Q_Delta_PriceAvg")
    return walk.walk_forward(rows, panel, *learnable_quarters(rows), _DEFAULTS)
