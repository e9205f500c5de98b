from datetime import date

import pytest
from pyspark.sql import functions as F

from quarterdeck import session
from quarterdeck.operators.metrics import count_rows
from quarterdeck.plans import loading
from quarterdeck.sources import readers, schemas, tables
from quarterdeck.streaming.rollup import open_windows, stream_price_rollup
from pyspark.sql.types import StructType

from quarterdeck.sources.readers import read_archive
from quarterdeck.streaming.upsert import stream_upsert
from quarterdeck.operators.rollups import price_rollup

HEADER = "," + ",".join(n for n, _ in schemas.ARCHIVE_COLUMNS)


def archive_line(row: int, day: str, **known) -> str:
    cells = [str(known.get(n, "None")) for n, _ in schemas.ARCHIVE_COLUMNS]
    cells[0] = day
    return ",".join([str(row), *cells])


@pytest.fixture
def csv_folder(tmp_path):
    for ticker, lines in {
        "AB": [archive_line(0, "2019-06-30", Shares=5, Price=2.5, LongTermDebt=7),
               archive_line(1, "2019-03-31", Shares=4)],
        "^C.D E+F": [archive_line(0, "2019-03-31", Revenue=-3)],
    }.items():
        (tmp_path / f"some_long_name_{ticker}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return str(tmp_path)


def test_archive_files(spark, csv_folder):
    df = readers.read_archive(spark, csv_folder)
    assert df.columns == ["entity", *[n for n, _ in schemas.ARCHIVE_COLUMNS]]
    rows = {(r.entity, r.QuarterEnd): r for r in df.collect()}
    assert set(rows) == {("AB", date(2019, 6, 30)), ("AB", date(2019, 3, 31)),
                         ("^C.D E+F", date(2019, 3, 31))}
    newest = rows["AB", date(2019, 6, 30)]
    assert (newest.Shares, newest.Price, newest.LongTermDebt, newest.ROE) == (5, 2.5, "7", None)
    assert rows["^C.D E+F", date(2019, 3, 31)].Revenue == -3
    built = loading.build_archive(spark, csv_folder, session.fresh_path(spark, "built"))
    assert built.count() == 3 and {r.fy for r in built.select("fy").collect()} == {2019}


def test_dimension_file(spark, tmp_path):
    file = tmp_path / "info.csv"
    file.write_text("tickerSymbol,shortName,sector,industry\nA,Aa,Tech,Chips\nB,Bb,,\n")
    rows = [tuple(r) for r in readers.read_dimension(spark, str(file)).collect()]
    assert rows == [("A", "Tech", "Chips"), ("B", None, None)]


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "entity string, q_ord int, x double, fy int" + extra)


def test_upsert_twice_equals_once(spark):
    path = session.fresh_path(spark, "table")
    old = [("a", 8076, 1.0, 2019), ("a", 8080, 2.0, 2020), ("b", 8080, 3.0, 2020)]
    batch = frame(spark, [("a", 8080, 9.0, 2020, "new"), ("c", 8084, 4.0, 2021, None)],
                  ", note string")
    tables.append_table(frame(spark, old), path)
    meant = {("a", 8076, 1.0, None), ("a", 8080, 9.0, "new"), ("b", 8080, 3.0, None),
             ("c", 8084, 4.0, None)}
    for _ in range(2):
        tables.upsert_table(batch, path)
        stored = tables.stored(spark, path)
        assert {(r.entity, r.q_ord, r.x, r.note) for r in stored.collect()} == meant
        assert stored.count() == 4
    tables.upsert_table(batch.where("false"), path)
    assert tables.stored(spark, path).count() == 4


def test_upsert_leaves_other_years_untouched(spark):
    path = session.fresh_path(spark, "table")
    tables.append_table(frame(spark, [("a", 8076, 1.0, 2019), ("a", 8080, 2.0, 2020)]), path)

    def files(year):
        rows = tables.stored(spark, path).where(F.col("fy") == year)
        return {r[0] for r in rows.select("_metadata.file_path").collect()}

    before = files(2019), files(2020)
    tables.upsert_table(frame(spark, [("a", 8081, 5.0, 2020)]), path)
    assert files(2019) == before[0] and not files(2020) & before[1]


def files(spark, path):
    """The files of a stored table by fiscal year and bucket of the entity."""
    found = {}
    for r in tables._all_stored(spark, path).select(
            "fy", tables.BUCKET, F.col("_metadata.file_path").alias("file")).distinct().collect():
        found.setdefault((r.fy, r[tables.BUCKET]), set()).add(r.file)
    return found


def test_writes_touch_only_the_buckets_of_their_entities(spark):
    path = session.fresh_path(spark, "buckets")
    rows = [(f"e{i}", q, float(q), q // 4) for i in range(40) for q in (8076, 8080, 8081)]
    tables.append_table(frame(spark, rows), path)
    before = files(spark, path)
    assert len(before) > 20
    tables.upsert_table(frame(spark, [("e7", 8081, -1.0, 2020)]), path)
    after = files(spark, path)
    changed = {k for k in after if after[k] != before[k]}
    assert len(changed) == 1 and next(iter(changed))[0] == 2020
    # Of events only those that meet a row cause a write.
    events = spark.createDataFrame(
        [("e9", 8076, date(2020, 1, 1), 7.0), ("nobody", 8080, date(2020, 1, 1), 9.0)],
        "entity string, q_ord int, date date, x double")
    tables.update_column_table(events, path, "x")
    last = files(spark, path)
    assert {k[0] for k in last if last[k] != after[k]} == {2019}
    assert sum(last[k] != after[k] for k in last) == 1
    found = {(r.entity, r.q_ord): r.x for r in tables.stored(spark, path).collect()}
    assert found == {(e, q): x for e, q, x, _ in rows} | {("e7", 8081): -1.0, ("e9", 8076): 7.0}


def test_append_with_a_key_twice_changes_nothing(spark):
    path = session.fresh_path(spark, "keyed")
    rows = frame(spark, [("a", 8076, 1.0, 2019), ("b", 8080, None, 2020)])
    for part in (rows, rows, rows.union(frame(spark, [("c", 8080, 3.0, 2020)])).select("q_ord", "entity", "x", "fy")):
        tables.append_table(part, path, ["entity", "q_ord"])
    assert sorted(map(tuple, tables.stored(spark, path).select("entity", "x").collect())) == [
        ("a", 1.0), ("b", None), ("c", 3.0)]
    with pytest.raises(ValueError, match="stored already"):
        tables.append_table(frame(spark, [("a", 8076, 2.0, 2019)]), path, ["entity", "q_ord"])
    with pytest.raises(ValueError, match="more than once"):
        tables.append_table(frame(spark, [("d", 1, 2.0, 0), ("d", 1, 2.0, 0)]), path, ["entity", "q_ord"])
    assert tables.stored(spark, path).count() == 3


def test_a_write_that_was_cut_off_is_finished_by_the_next(spark, monkeypatch):
    path = session.fresh_path(spark, "cut")
    tables.append_table(frame(spark, [("a", 8076, 1.0, 2019), ("b", 8080, 2.0, 2020)]), path)
    write = tables._write

    def fails(df, target, *rest):
        if target == path:
            raise OSError("lost")
        write(df, target, *rest)

    monkeypatch.setattr(tables, "_write", fails)
    with pytest.raises(OSError):
        tables.upsert_table(frame(spark, [("a", 8076, 5.0, 2019, 1)], ", more int"), path)
    monkeypatch.setattr(tables, "_write", write)
    assert {r.x for r in tables.stored(spark, path).collect()} == {1.0, 2.0}
    tables.upsert_table(frame(spark, [("b", 8080, 6.0, 2020)]), path)
    assert {(r.entity, r.x, r.more) for r in tables.stored(spark, path).collect()} == {
        ("a", 5.0, 1), ("b", 6.0, None)}


def test_files_of_another_layout_are_not_written_to(spark):
    path = session.fresh_path(spark, "other")
    frame(spark, [("a", 8076, 1.0, 2019)]).write.partitionBy("fy").parquet(path)
    with pytest.raises(ValueError, match="another layout"):
        tables.append_table(frame(spark, [("b", 8076, 1.0, 2019)]), path)
    tables.replace_table(tables.stored(spark, path).transform(lambda df: session.written(df, "copy")), path)
    tables.append_table(frame(spark, [("b", 8076, 1.0, 2019)]), path)
    assert tables.stored(spark, path).count() == 2


def test_column_update_and_insert_absent(spark):
    old = frame(spark, [("a", 1, 1.0, 0), ("a", 2, 2.0, 0)])
    events = spark.createDataFrame(
        [("a", 1, date(2020, 1, 1), 7.0), ("a", 1, date(2020, 1, 5), 8.0),
         ("z", 1, date(2020, 1, 1), 9.0)], "entity string, q_ord int, date date, x double")
    done = tables.update_column(old, events, "x").orderBy("q_ord").collect()
    assert [(r.q_ord, r.x) for r in done] == [(1, 8.0), (2, 2.0)]
    dim = spark.createDataFrame([("a", "T")], "entity string, Sector string")
    new = spark.createDataFrame([("a", "U"), ("b", "V")], "entity string, Sector string")
    assert {tuple(r) for r in tables.insert_absent(dim, new).collect()} == {("a", "T"), ("b", "V")}


def test_keys_and_names(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "`a b` int, `c_d` int")
    clean = tables.clean_names(df)
    assert clean.columns == ["ab", "cd"]
    assert [tuple(r) for r in schemas.duplicate_keys(clean, ["ab"]).collect()] == [(1, 2)]
    assert schemas.panel_schema().fieldNames()[:2] == ["entity", "q_ord"]


def test_incremental_load(spark):
    schema = "entity string, q_ord int, date date, PriceAvg double, Split double, fy int"
    day = date(2020, 6, 1)
    table = spark.createDataFrame([("a", 1, day, 8.0, None, 0), ("a", 2, day, 8.0, None, 0),
                                   ("old", 1, day, 8.0, None, 0)], schema)
    batch = spark.createDataFrame([("a", 2, day, 5.0, 3.0, 0), ("a", 3, day, 4.0, 2.0, 0),
                                   ("old", 2, date(2018, 1, 1), 1.0, 2.0, 0)], schema)
    archive = spark.createDataFrame([("a", 6.0), ("old", 6.0)], "entity string, Price double")
    panel, kept = loading.incremental_load(table, archive, batch, day)
    rows = {(r.entity, r.q_ord): r.PriceAvg for r in panel.collect()}
    # Only the row new to the table brings its split, and it reaches back over stored rows.
    assert rows == {("a", 1): 4.0, ("a", 2): 5.0, ("a", 3): 4.0, ("old", 1): 8.0}
    assert {tuple(r) for r in kept.collect()} == {("a", 3.0), ("old", 6.0)}
    plain, same = loading.incremental_load(table, archive, batch, day, backfill_splits=False)
    assert {r.PriceAvg for r in plain.where("q_ord = 1").collect()} == {8.0}
    assert {r.Price for r in same.collect()} == {6.0}


def test_load_tables_writes_new_folders(spark):
    schema = "entity string, q_ord int, date date, PriceAvg double, Split double, fy int"
    day = date(2020, 6, 1)
    panel, archive = session.fresh_path(spark, "p"), session.fresh_path(spark, "a")
    tables.append_table(spark.createDataFrame([("a", 1, day, 8.0, None, 0)], schema), panel)
    tables.append_table(spark.createDataFrame([("a", 6.0, 0)],
                                              "entity string, Price double, fy int"), archive)
    batch = spark.createDataFrame([("a", 2, day, 4.0, 2.0, 0)], schema)
    new_panel, new_archive = loading.load_tables(spark, panel, archive, batch, day)
    assert {r.PriceAvg for r in tables.stored(spark, new_panel).collect()} == {4.0}
    assert tables.stored(spark, new_archive).first().Price == 3.0
    assert tables.stored(spark, panel).count() == 1


def test_load_in_place_writes_what_changed(spark):
    schema = "entity string, q_ord int, date date, PriceAvg double, Split double, fy int"
    day = date(2020, 6, 1)
    old = [(f"e{i}", q, day, 8.0, None, q // 4) for i in range(30) for q in (8072, 8076, 8080)]
    kept = [(f"e{i}", day, 6.0, 2019) for i in range(30)]
    paths = {}
    for name in ("place", "folder"):
        paths[name] = panel, archive = session.fresh_path(spark, "p"), session.fresh_path(spark, "a")
        tables.append_table(spark.createDataFrame(old, schema), panel)
        tables.append_table(spark.createDataFrame(kept, "entity string, QuarterEnd date, Price double, fy int"),
                            archive)
    panel, archive = paths["place"]
    before = files(spark, panel), files(spark, archive)
    plain = spark.createDataFrame([("e3", 8080, day, 5.0, None, 2020)], schema)
    loading.load_in_place(spark, panel, archive, plain, day)
    assert files(spark, archive) == before[1]
    now = files(spark, panel)
    assert {k[0] for k in now if now[k] != before[0][k]} == {2020}
    split = spark.createDataFrame([("e4", 8084, day, 4.0, 2.0, 2021), ("late", 8084, date(2001, 1, 1), 1.0, 2.0, 2021)],
                                  schema)
    for _ in range(2):  # delivered again it changes nothing
        loading.load_in_place(spark, panel, archive, split, day)
    last = files(spark, panel), files(spark, archive)
    assert sum(last[1][k] != before[1][k] for k in last[1]) == 1
    assert len({k[1] for k in last[0] if last[0][k] != now.get(k)}) == 1
    new = paths["folder"]
    for batch in (plain, split):
        new = loading.load_tables(spark, *new, batch, day)
    for mine, theirs in zip(paths["place"], new):
        found, meant = (tables.stored(spark, x) for x in (mine, theirs))
        assert found.select(*meant.columns).exceptAll(meant).isEmpty() and found.count() == meant.count()


def test_row_counts_come_with_the_action(spark):
    df, seen = count_rows(spark.range(10), "ten")
    df.where("id < 3").collect()
    assert seen.get["rows"] == 10


def test_stream_rollup_equals_batch(spark, tmp_path):
    days = spark.range(600).select(
        F.concat(F.lit("e"), F.col("id") % 3).alias("entity"),
        F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") / 3).cast("int")).alias("date"),
        (F.col("id") * 17 % 101).cast("double").alias("close"), F.col("id").alias("volume"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    days.withColumn("ts", F.col("date").cast("timestamp")).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    rolled = stream_price_rollup(stream, date(2020, 1, 1), 30, "0 seconds")
    (rolled.writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
     .start().awaitTermination())
    streamed = {tuple(r) for r in spark.read.schema(rolled.schema).parquet(out).collect()}
    last = date(2020, 7, 18)
    batch = price_rollup(days, date(2020, 1, 1), last, 30).select(*rolled.columns)
    assert streamed == {tuple(r) for r in batch.collect()} and len(streamed) == 18


def test_closed_stream_equals_batch_however_often_prices_come(spark, tmp_path):
    days = spark.range(600).select(
        F.concat(F.lit("e"), F.col("id") % 3).alias("entity"),
        F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") / 3).cast("int")).cast("timestamp").alias("ts"),
        (F.col("id") * 17 % 101).cast("double").alias("close"), F.col("id").alias("volume"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    days.union(days).repartition(2).write.parquet(source)
    stream = spark.readStream.schema(days.schema).parquet(source)
    rolled = stream_price_rollup(stream, date(2020, 1, 1), 30, "0 seconds", redelivered=True)
    (rolled.writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
     .start().awaitTermination())
    emitted = spark.read.schema(rolled.schema).parquet(out)
    rest = open_windows(spark.read.parquet(source), emitted, date(2020, 1, 1), 30)
    assert rest.count() == 3  # 200 days: the seventh window is open
    whole = price_rollup(days.withColumn("date", F.to_date("ts")), date(2020, 1, 1), date(2021, 1, 1), 30)
    found = {tuple(r) for r in emitted.unionByName(rest).select(*whole.columns).collect()}
    assert found == {tuple(r) for r in whole.collect()} and len(found) == 21
    nothing = open_windows(days, emitted.limit(0), date(2020, 1, 1), 30)
    assert nothing.count() == 21


def test_drifted_dividends_do_not_replace_their_neighbours(spark):
    path = session.fresh_path(spark, "dividends")
    tables.append_table(frame(spark, [("a", q, 0.0, q // 4) for q in range(8080, 8084)]).withColumnRenamed(
        "x", "DividendPerShare"), path)
    # The second quarter's dividend drifted into the third.
    paid = spark.createDataFrame(
        [("a", date(2020, 3, 15), 1.0), ("a", date(2020, 8, 3), 2.0), ("a", date(2020, 9, 15), 3.0),
         ("a", date(2020, 12, 15), 4.0), ("a", date(2018, 3, 15), 9.0)], "entity string, date date, dividend double")
    loading.load_dividends(paid, path, date(2019, 1, 1))
    found = {r.q_ord: r.DividendPerShare for r in tables.stored(spark, path).collect()}
    assert found == {8080: 1.0, 8081: 2.0, 8082: 3.0, 8083: 4.0}


def test_stream_upsert_over_several_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    path = session.fresh_path(spark, "stream")
    for number, rows in enumerate([[("a", 8080, 1.0, 2020, 1), ("a", 8080, 2.0, 2020, 2)],
                                   [("a", 8080, 3.0, 2020, 3), ("b", 8084, 4.0, 2021, 4)]]):
        batch = frame(spark, rows, ", n int")
        batch.coalesce(1).write.mode("append").parquet(source)
        facts = spark.readStream.schema(batch.schema).parquet(source)
        stream_upsert(facts, path, str(tmp_path / "state"), "n").awaitTermination()
        found = {(r.entity, r.x) for r in tables.stored(spark, path).collect()}
        assert found == ({("a", 2.0)} if number == 0 else {("a", 3.0), ("b", 4.0)})


def test_stream_upsert_keeps_the_largest_order_whatever_the_batch(spark, tmp_path):
    source, path = str(tmp_path / "in"), session.fresh_path(spark, "late")
    for row in [("a", 8080, 5.0, 2020, 5), ("a", 8080, 3.0, 2020, 3), ("a", 8080, 4.0, 2020, 4)]:
        batch = frame(spark, [row], ", n int")
        batch.coalesce(1).write.mode("append").parquet(source)
        facts = spark.readStream.schema(batch.schema).parquet(source)
        stream_upsert(facts, path, str(tmp_path / "state"), "n").awaitTermination()
        assert [r.x for r in tables.stored(spark, path).collect()] == [5.0]


def test_upsert_refuses_two_rows_of_a_key(spark):
    twice = frame(spark, [("a", 8080, 1.0, 2020), ("a", 8080, 2.0, 2020)])
    with pytest.raises(ValueError):
        tables.upsert_table(twice, session.fresh_path(spark, "twice"))


@pytest.mark.parametrize("cell, meant", [("5.0", 5), ("1e9", 10**9), ("None", None),
                                         ("9007199254740993", 9007199254740993),
                                         ("5.5", ValueError), ("x", ValueError)])
def test_archive_cells_are_never_lost(spark, tmp_path, cell, meant):
    (tmp_path / "some_X.csv").write_text(f",Shares,Price\n0,{cell},1.5\n")
    rows = read_archive(spark, str(tmp_path), StructType.fromDDL("Shares long, Price double"))
    if meant is ValueError:
        with pytest.raises(Exception, match="Shares is not a bigint"):
            rows.collect()
    else:
        assert [tuple(r) for r in rows.collect()] == [("X", meant, 1.5)]
    (tmp_path / "noentity.csv").write_text(",Shares,Price\n0,1,1\n")
    with pytest.raises(Exception):
        rows.collect()
        read_archive(spark, str(tmp_path), StructType.fromDDL("Shares long, Price double")).collect()


def test_archive_columns_go_by_their_names(spark, tmp_path):
    (tmp_path / "some_A.csv").write_text(",Shares,Price\n0,5,1.5\n1,6,2.5\n")
    (tmp_path / "some_B.csv").write_text(",Price,Note,Shares\n0,3.5,x,7\n")
    schema = StructType.fromDDL("Shares long, Price double")
    rows = {tuple(r) for r in read_archive(spark, str(tmp_path), schema).collect()}
    assert rows == {("A", 5, 1.5), ("A", 6, 2.5), ("B", 7, 3.5)}
    (tmp_path / "some_C.csv").write_text(",Shares\n0,5\n")
    with pytest.raises(Exception, match="no column Price"):
        read_archive(spark, str(tmp_path), schema).collect()


def test_archive_built_twice_equals_once(spark, csv_folder):
    path = session.fresh_path(spark, "twice")
    for _ in range(2):
        assert loading.build_archive(spark, csv_folder, path).count() == 3
    (readers_copy := csv_folder + "/again_AB.csv")
    with open(readers_copy, "w") as copy:
        copy.write("\n".join([HEADER, archive_line(0, "2019-06-30", Shares=9)]) + "\n")
    with pytest.raises(ValueError, match="more than one row"):
        loading.build_archive(spark, csv_folder, path)
    assert tables.stored(spark, path).count() == 3


def test_append_keeps_the_stored_types(spark):
    path = session.fresh_path(spark, "types")
    tables.append_table(frame(spark, [("a", 8080, 1.5, 2020)]), path)
    whole = spark.createDataFrame([("b", 8080, 2, 2020)], "entity string, q_ord int, x int, fy int")
    tables.append_table(whole, path)
    tables.upsert_table(whole.withColumn("x", F.lit(3)), path)
    assert {(r.entity, r.x) for r in tables.stored(spark, path).collect()} == {("a", 1.5), ("b", 3.0)}
    ints = session.fresh_path(spark, "ints")
    tables.append_table(whole, ints)
    with pytest.raises(Exception, match="does not fit the stored int"):
        tables.append_table(frame(spark, [("c", 8080, 1.5, 2020)]), ints)


def test_stored_column_update_and_insert(spark):
    path = session.fresh_path(spark, "column")
    tables.append_table(frame(spark, [("a", 8080, 1.0, 2020), ("a", 8084, 2.0, 2021)]), path)
    events = spark.createDataFrame(
        [("a", 8080, date(2020, 1, 1), 7.0), ("a", 8080, date(2020, 1, 1), 8.0),
         ("z", 8080, date(2020, 1, 2), 9.0)], "entity string, q_ord int, date date, x double")
    for _ in range(2):
        tables.update_column_table(events, path, "x")
        found = {(r.entity, r.q_ord, r.x) for r in tables.stored(spark, path).collect()}
        assert found == {("a", 8080, 8.0), ("a", 8084, 2.0)}
    names = session.fresh_path(spark, "names")
    for rows in ([("a", "T")], [("a", "U"), ("b", "V"), ("b", "V")], [("b", "W")]):
        tables.insert_absent_table(spark.createDataFrame(rows, "entity string, Sector string"), names)
    assert sorted(map(tuple, spark.read.parquet(names).collect())) == [("a", "T"), ("b", "V")]


class FakeSession:
    """A session that only knows its settings."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_shared_folder_is_the_one_the_session_names(spark):
    named = session.fresh_path(FakeSession("hdfs://shared/dir/", "yarn"), "x")
    assert named.startswith("hdfs://shared/dir/x-")
    with pytest.raises(RuntimeError):
        session.shared_folder(FakeSession(None, "yarn"))
    assert session.shared_folder(spark) == session.shared_folder(spark)


def test_archive_lines_are_read_once(spark, csv_folder):
    """Few written files are what later steps read, and a column's place is looked up once a file."""
    text = read_archive(spark, csv_folder)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in text and "FileScan parquet" in text
    assert "array_position(" in text and "array_position(" not in text[:text.index("Join")]
