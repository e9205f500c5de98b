"""Stored Parquet tables: append, keyed upsert, keyed update, insert-if-absent.

Pure DataFrame functions say what the new table is; the ``..._table`` functions write it. A table
is partitioned by fiscal year and by ``BUCKETS`` hashes of the entity, and a write replaces only the pairs
of both that it touches. New contents are first written beside the table and then moved in from there, so
that no task ever reads a file that is being replaced; until they are, a note in the table's folder says
where they lie, and the next write finishes what was cut off. The schema lies beside the table, too, so
that no reader has to open all its files for it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from quarterdeck.functions.cells import plain_name
from quarterdeck.functions.names import ENTITY, KEY, Q_ORD
from quarterdeck.functions.periods import fiscal_year
from quarterdeck.operators.merging import except_key, keep_one, union_by_name
from quarterdeck.session import fresh_path, written
from quarterdeck.sources.schemas import duplicate_keys

PARTITION, BUCKET, BUCKETS = "fy", "entity_bucket", 16
_PLACE = (PARTITION, BUCKET)
_SCHEMA_NOTE, _PENDING_NOTE = "_schema", "_pending"


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[plain_name(c) for c in df.columns])


def merge_rows(table: DataFrame, batch: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Batch rows replace table rows of the same key; columns new to either side become null."""
    return union_by_name(except_key(table, batch, key), batch)


def update_column(table: DataFrame, events: DataFrame, column: str, date_column: str = "date",
                  key: Sequence[str] = KEY) -> DataFrame:
    """Set a column where an event has the row's key; the last event by date wins."""
    order = F.struct(date_column, column)
    newest = events.groupBy(*key).agg(F.max_by(column, order).alias("__new"))
    joined = table.join(newest, list(key), "left")
    return joined.select(*[F.coalesce("__new", F.col(c)).alias(c) if c == column else F.col(c)
                           for c in table.columns])


def insert_absent(table: DataFrame, rows: DataFrame, key: Sequence[str] = (ENTITY,)) -> DataFrame:
    return union_by_name(table, except_key(rows, table, key))


def _bucket() -> Column:
    return F.pmod(F.xxhash64(ENTITY), F.lit(BUCKETS)).cast("int")


def _write(df: DataFrame, path: str, mode: str, overwrite: str = "dynamic") -> None:
    # The rebalance hint cuts a crowded part into several files and packs thin ones together.
    (df.withColumn(BUCKET, _bucket()).hint("rebalance", *_PLACE).write.mode(mode)
     .option("partitionOverwriteMode", overwrite).partitionBy(*_PLACE).parquet(path))


def _note(spark: SparkSession, path: str, name: str):
    """A small note in the table's folder, where names with an underscore are no data; or None."""
    try:
        row = spark.read.schema("note string").text(f"{path}/{name}").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return json.loads(row[0]) if row else None


def _leave_note(spark: SparkSession, path: str, name: str, note) -> None:
    (spark.createDataFrame([(json.dumps(note),)], "note string").coalesce(1)
     .write.mode("overwrite").text(f"{path}/{name}"))


def _declare(df: DataFrame, path: str) -> None:
    """Add the columns of ``df`` to the schema beside the table. Done before the rows are written: a
    column that no file has yet is read as nulls."""
    spark = df.sparkSession
    note = _note(spark, path, _SCHEMA_NOTE)
    if note is None and _exists(spark, path):
        raise ValueError(f"{path} holds files of another layout; replace_table makes it a table")
    known = StructType.fromJson(note) if note else StructType()
    names = {f.name for f in known.fields}
    added = [f for f in df.schema.fields if f.name not in names]
    if added or note is None:
        _leave_note(spark, path, _SCHEMA_NOTE, StructType([*known.fields, *added]).jsonValue())


def _move_in(spark: SparkSession, home: str, parts: list[list[str]]) -> None:
    """Replace the parts of tables that occur in [staged, path] pairs; cut off, ``finish(home)`` does
    the rest."""
    _leave_note(spark, home, _PENDING_NOTE, parts)
    finish(spark, home)


def finish(spark: SparkSession, path: str) -> None:
    """Move in what an earlier write to this table left staged; without any, nothing."""
    parts = _note(spark, path, _PENDING_NOTE)
    if not parts:
        return
    for staged, target in parts:
        rows = stored(spark, staged)
        _declare(rows, target)
        _write(rows, target, "overwrite")
    _leave_note(spark, path, _PENDING_NOTE, [])


def _pairs(rows: DataFrame) -> list[tuple[int, int]]:
    """The parts of a table that rows with a fiscal year lie in: at most ``BUCKETS`` a year."""
    return [tuple(r) for r in rows.select(PARTITION, _bucket().alias(BUCKET)).distinct().collect()]


def _part(spark: SparkSession, path: str, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """The stored rows of these parts; other parts are not listed for the scan."""
    years, buckets = ({*found} for found in zip(*pairs))
    wanted = spark.createDataFrame(list(pairs), "__year int, __bucket int")
    near = _all_stored(spark, path).where(F.col(PARTITION).isin(years) & F.col(BUCKET).isin(buckets))
    return near.join(F.broadcast(wanted), (F.col(PARTITION) == F.col("__year"))
                     & (F.col(BUCKET) == F.col("__bucket")), "left_semi").drop(BUCKET)


def _stage(rows: DataFrame, name: str) -> str:
    staged = fresh_path(rows.sparkSession, name)
    _declare(rows, staged)
    _write(rows, staged, "overwrite")
    return staged


def _as_stored(df: DataFrame, path: str) -> DataFrame:
    """The rows in the types of the stored table, so that its files can be read together. A value
    that its column's stored type cannot hold ends the write."""
    spark = df.sparkSession
    if not _exists(spark, path):
        return df
    kinds = {f.name: f.dataType.simpleString() for f in stored(spark, path).schema.fields}

    def cast(name: str, kind: str):
        column = F.col(f"`{name}`")
        wanted = kinds.get(name, kind)
        if wanted == kind:
            return column
        value = column.try_cast(wanted)
        wrong = F.raise_error(F.concat(F.lit(f"{name} does not fit the stored {wanted}: "),
                                       column.cast("string")))
        return F.when(value.try_cast(kind).eqNullSafe(column), value).otherwise(wrong).alias(name)

    return df.select(*[cast(name, kind) for name, kind in df.dtypes])


def append_table(df: DataFrame, path: str, key: Sequence[str] = ()) -> None:
    """Add rows. With a ``key`` no two rows of the table may share it: a row that is stored already is left
    out, so rows delivered twice change nothing, and another row of a stored key ends the write."""
    spark = df.sparkSession
    finish(spark, path)
    df = _as_stored(df, path)
    if key:
        df = written(df, "append")
        if not duplicate_keys(df, key).isEmpty():
            raise ValueError(f"a key of {list(key)} is in the rows more than once")
        pairs = _pairs(df)
        if pairs and _exists(spark, path):
            there = _part(spark, path, pairs)
            met = df.join(there.select(*key), list(key), "left_semi")
            same = [c for c in df.columns if c in there.columns]
            if not met.select(*same).exceptAll(there.select(*same)).isEmpty():
                raise ValueError(f"other rows of a key of {list(key)} are stored already")
            df = except_key(df, there, key)
    _declare(df, path)
    _write(df, path, "append")


def replace_table(df: DataFrame, path: str) -> None:
    """The table holds these rows and no others."""
    _write(df, path, "overwrite", "static")
    _leave_note(df.sparkSession, path, _SCHEMA_NOTE, df.schema.jsonValue())


def update_column_table(events: DataFrame, path: str, column: str, date_column: str = "date",
                        key: Sequence[str] = KEY) -> None:
    """``update_column`` on the stored panel; only parts with a row that an event meets are replaced."""
    spark = events.sparkSession
    finish(spark, path)
    events = written(events, "events")
    placed = events.withColumn(PARTITION, fiscal_year(F.col(Q_ORD)))
    pairs = _pairs(placed)
    if pairs:
        keys = events.select(*key).distinct()
        pairs = _pairs(_part(spark, path, pairs).join(keys, list(key), "left_semi"))
    if pairs:
        rows = update_column(_part(spark, path, pairs), events, column, date_column, key)
        _move_in(spark, path, [[_stage(_as_stored(rows, path), "update"), path]])


def insert_absent_table(rows: DataFrame, path: str, key: Sequence[str] = (ENTITY,)) -> None:
    """Add the rows whose key the stored (unpartitioned) table lacks; what is stored stays as it is.
    Of several new rows of a key one stays, the same whenever it runs."""
    spark = rows.sparkSession
    new = keep_one(rows, key, [F.xxhash64(*[f"`{c}`" for c in rows.columns])])
    if _exists(spark, path):
        new = _as_stored(except_key(new, stored(spark, path), key), path)
    written(new, "absent").write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        stored(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def _all_stored(spark: SparkSession, path: str) -> DataFrame:
    note = _note(spark, path, _SCHEMA_NOTE)
    if note is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    schema = StructType.fromJson(note)
    return spark.read.schema(schema.add(BUCKET, IntegerType())).parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The table with the columns of all its files."""
    return _all_stored(spark, path).drop(BUCKET)


def upsert_table(batch: DataFrame, path: str, key: Sequence[str] = KEY,
                 order: str | None = None) -> None:
    """Merge a batch into the stored table, which need not exist yet. Only the parts that the batch
    lies in are read and replaced; running the same batch again changes nothing.

    With ``order``, the row with the largest value in that column stays of each key, whether it is
    stored or new (of equal ones the new one). Without it a key may be only once in the batch.
    """
    spark = batch.sparkSession
    if order is not None:
        batch = keep_one(batch, key, [F.col(order).desc_nulls_last()])
    batch = written(batch, "batch")
    if order is None and not duplicate_keys(batch, key).isEmpty():
        raise ValueError(f"a key of {list(key)} is in the batch more than once; name an order")
    finish(spark, path)
    pairs = _pairs(batch)
    if not pairs:
        return
    if not _exists(spark, path):
        append_table(batch, path)
        return
    batch = _as_stored(batch, path)
    touched = _part(spark, path, pairs)
    if order is None:
        merged = merge_rows(touched, batch, key)
    else:
        both = batch.withColumn("__new", F.lit(1)).unionByName(
            touched.withColumn("__new", F.lit(0)), allowMissingColumns=True)
        merged = keep_one(both, key, [F.col(order).desc_nulls_last(),
                                      F.col("__new").desc()]).drop("__new")
    _move_in(spark, path, [[_stage(merged, "upsert"), path]])


def replace_in_place(home: str, changed: Sequence[tuple[DataFrame, str]]) -> None:
    """Replace the parts that rows lie in, in several tables, with one note in the first one's folder."""
    spark = changed[0][0].sparkSession
    _move_in(spark, home, [[_stage(_as_stored(rows, path), "part"), path] for rows, path in changed])


def part_of_rows(rows: DataFrame, path: str) -> DataFrame:
    """The stored rows of all parts that these rows (entity, fy) lie in."""
    pairs = _pairs(rows)
    return _part(rows.sparkSession, path, pairs) if pairs else stored(rows.sparkSession, path).limit(0)
