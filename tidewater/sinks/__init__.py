"""Sinks: text, windowed files, day-partitioned tables, schema guard, JSON stream.

All writes are partitioned by the writer (no single-file coalesce) and
idempotent per output path or per micro-batch id.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import day_of_number_field, day_of_time_field, day_of_window, window_label
from ..operators.rows import to_json_text


#: Folders beside a table's data: its declared schema, where its commit log is, and a commit log.
DECLARED, LOG, COMMITS = "_schema", "_log", "_commits"


class SchemaMismatch(ValueError):
    pass


def write_text(df: DataFrame, path: str, col: str = "value", mode: str = "overwrite") -> None:
    """Sharded text output, one line per row (one file per task)."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)


def with_window_files(df: DataFrame, window: str = "window", num_shards: int | None = None,
                      shard_key: str | None = None) -> DataFrame:
    """Add the per-window file columns: ``day`` (yyyyMMdd of the window start),
    ``window_label`` (``HH:mm-HH:mm``) and ``shard``.

    ``HH:mm`` alone repeats every day, so files are also split by day. Unwindowed
    input is refused.
    """
    if window not in df.columns:
        raise ValueError("per-window files need a window column; unwindowed writes are unsupported")
    out = df.withColumn("day", F.date_format(F.col(window)["start"], "yyyyMMdd")) \
            .withColumn("window_label", window_label(window))
    if num_shards:
        key = F.col(shard_key) if shard_key else F.col("value")
        out = out.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(num_shards)).cast("int"))
    return out


def write_per_window(df: DataFrame, path: str, window: str = "window", value: str = "value",
                     num_shards: int | None = None, prefix: str = "output") -> None:
    """One set of text files per event-time window: ``<path>/day=yyyyMMdd/<prefix>-HH:mm-HH:mm-<shard>-of-<N>``.

    With ``num_shards`` a window's rows are dealt into that many files, else the writing tasks decide (a large window
    is split). In file names the colon is written ``%3A``, as Spark does for folders, because many
    stores have no colon. The files are written aside and renamed when all of them are complete; a window's files from
    before are replaced. Read them back with their labels by :func:`read_window_files`.
    """
    spark = df.sparkSession
    files = with_window_files(df, window, num_shards, value)
    parts = ["day", "window_label"] + (["shard"] if num_shards else [])
    aside = f"{path.rstrip('/')}/_{uuid.uuid4().hex}"
    rows = files.select(*parts, F.col(value).cast("string").alias("value"))
    # A fixed number of shards: all rows of a file in one task. Else REBALANCE lets AQE split a window that is
    # much larger than the advisory partition size.
    rows = rows.repartition(*parts) if num_shards else rows.hint("rebalance", *parts)
    rows.write.partitionBy(*parts).text(aside)
    _name_window_files(spark, aside, path.rstrip("/"), prefix, num_shards)


def _name_window_files(spark: SparkSession, aside: str, path: str, prefix: str, num_shards: int | None) -> None:
    """Move written files to their names, one rename each: only names pass through the driver, as in any commit of a job."""
    fs, root = _file_system(spark, aside)
    found: dict[tuple[str, str], list] = {}
    for uri in spark.read.text(aside).inputFiles():
        file = unquote(uri)
        folders = dict(x.split("=", 1) for x in file.split("/")[:-1] if "=" in x)
        found.setdefault((folders["day"], folders["window_label"]), []).append((int(folders.get("shard", 0)), file))
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for day in {day for day, _ in found}:
        folder = new(f"{path}/day={day}")
        fs.mkdirs(folder)
        for old in fs.listStatus(folder):
            if (day, _label_of(old.getPath().getName(), prefix)) in found:
                fs.delete(old.getPath(), False)
    for (day, label), files in found.items():
        files.sort()
        for i, (shard, file) in enumerate(files):
            number, of = (shard, num_shards) if num_shards else (i, len(files))
            target = new(f"{path}/day={day}/{prefix}-{label}-{number}-of-{of}")
            if not fs.rename(new(file), target):
                raise RuntimeError(f"{file} could not be renamed")
    fs.delete(root, True)


def _label_of(name: str, prefix: str) -> str | None:
    """The window label in a file's name."""
    found = re.fullmatch(re.escape(prefix) + r"-(.+)-\d+-of-\d+", name)
    return found and found[1]


def read_window_files(spark: SparkSession, path: str, prefix: str = "output") -> DataFrame:
    """Lines of per-window files: value, window_label, shard, shards and the folders' columns (day)."""
    lines = spark.read.text(path).withColumn("name", F.regexp_replace("_metadata.file_name", "%(25)?3A", ":"))
    part = lambda i: F.regexp_extract("name", f"^{re.escape(prefix)}-(.+)-(\\d+)-of-(\\d+)$", i)
    return lines.withColumns({"window_label": part(1), "shard": part(2).cast("int"), "shards": part(3).cast("int")}).drop("name")


def day_partition(df: DataFrame, mode: str = "window", field: str | None = None,
                  out: str = "part") -> DataFrame:
    """``part`` = yyyyMMdd from (a) the window's max timestamp, (b) a time field, or
    (c) an integer field taken as it is.
    """
    if mode == "window":
        return df.withColumn(out, day_of_window("window"))
    if mode == "time":
        return df.withColumn(out, day_of_time_field(field))
    if mode == "number":
        return df.withColumn(out, day_of_number_field(field))
    raise ValueError(f"unknown partition mode {mode}")


def _strip_nullability(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _strip_nullability(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_strip_nullability(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(_strip_nullability(dt.keyType), _strip_nullability(dt.valueType), True)
    return dt


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _table_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder in one step; whether it was done."""
    fs, jpath = _file_system(spark, source)
    return fs.rename(jpath, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target))


def _noted(spark: SparkSession, path: str, what: str) -> str | None:
    """A line of text kept beside a table's data under a name that readers of data files skip."""
    place = f"{path.rstrip('/')}/{what}"
    return spark.read.text(place).first()[0] if _table_exists(spark, place) else None


def _note(spark: SparkSession, path: str, what: str, line: str) -> None:
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{path.rstrip('/')}/{what}")


def _declared(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema a table was created with, if it was created by :func:`ensure_table`."""
    declared = _noted(spark, path, DECLARED)
    return T.StructType.fromJson(json.loads(declared)) if declared else None


def ensure_table_schema(spark: SparkSession, path: str, schema: T.StructType,
                        partition_cols: tuple[str, ...] = ()) -> None:
    """A table that exists must have ``schema`` (nullability ignored); otherwise
    raise :class:`SchemaMismatch`. A missing table is left missing: see :func:`ensure_table`.
    """
    if not _table_exists(spark, path):
        return
    existing = _declared(spark, path) or spark.read.parquet(path).schema
    have = T.StructType([f for f in existing.fields if f.name not in partition_cols])
    if _strip_nullability(have) != _strip_nullability(schema):
        raise SchemaMismatch(f"table at {path} has schema {have.simpleString()}, "
                             f"expected {schema.simpleString()}")


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 partition_cols: tuple[str, ...] = (), log: str | None = None) -> None:
    """Create the table, empty, with its declared schema if it is missing; else check its schema.

    With ``log`` only what that commit log names can be read from the table, see :func:`commit_batch`.
    The declaration is kept beside the data under a name that readers of data files skip.
    """
    if _declared(spark, path) is not None or (_table_exists(spark, path) and log is None):
        ensure_table_schema(spark, path, schema, partition_cols)
        return
    if log:
        _note(spark, path, LOG, log)
    _note(spark, path, DECLARED, json.dumps(schema.jsonValue()))


def read_table(spark: SparkSession, path: str, part: str = "day") -> DataFrame:
    """A day-partitioned table, with its declared schema also while it has no rows; of a table with a commit log what is committed."""
    declared = _declared(spark, path)
    if declared is None:
        return spark.read.parquet(path)
    log = _noted(spark, path, LOG)
    kept = [T.StructField("commit", T.StringType())] if log else []
    rows = spark.read.schema(T.StructType([*declared.fields, *kept, T.StructField(part, T.StringType())])).parquet(path)
    if log is None:
        return rows
    return rows.join(committed(spark, log), "commit", "left_semi").drop("commit")


def commit_batch(spark: SparkSession, log: str, stream: str, batch_id: int, outputs: dict[str, DataFrame],
                 part: str = "day") -> None:
    """Write a micro-batch to several tables, by path, and make all of its rows visible in one step.

    Every table gets the rows in a folder named for the commit, which no reader sees yet. One rename then adds the
    commit to the log. A batch that fails before it leaves folders that nobody reads and is written anew
    under another name; one that is run again after it does nothing. ``stream`` (the query's checkpoint)
    tells the batches of one query from those of another.
    """
    entry = f"{log.rstrip('/')}/batch={hashlib.sha256(stream.encode()).hexdigest()[:16]}-{batch_id}"
    if _table_exists(spark, entry):
        return
    commit = f"{batch_id:012d}-{uuid.uuid4().hex}"
    for path, rows in outputs.items():
        rows.write.partitionBy(part).parquet(f"{path.rstrip('/')}/commit={commit}")
    draft = f"{log.rstrip('/')}/_{commit}"
    spark.createDataFrame([(commit,)], "commit string").coalesce(1).write.json(draft)
    if not move(spark, draft, entry):
        raise RuntimeError(f"the commit {commit} could not be added to {log}")


def committed(spark: SparkSession, log: str) -> DataFrame:
    """The commits of a log, one row a batch."""
    if not _table_exists(spark, log):
        return spark.createDataFrame([], "commit string")
    return spark.read.schema("commit string").json(log).select("commit")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema (missing columns become typed nulls)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_day_partitioned(df: DataFrame, path: str, schema: T.StructType,
                           time_col: str = "timestamp", part: str = "day") -> None:
    """Append rows with a declared schema, partitioned by the UTC day of ``time_col``."""
    spark = df.sparkSession
    ensure_table(spark, path, schema, (part,))
    rows = conform(df, schema).withColumn(part, F.date_format(F.col(time_col), "yyyyMMdd"))
    # Few files per day, and a day holding most rows is split by AQE (REBALANCE).
    rows.hint("rebalance", part).write.mode("append").partitionBy(part).parquet(path)


def json_lines(df: DataFrame, cols=None) -> DataFrame:
    """Rows -> one JSON text per row (message payloads)."""
    return to_json_text(df, cols)


def batch_writer(path: str, fmt: str = "parquet", json_payload: bool = False):
    """``foreachBatch`` function writing each micro-batch to ``path/batch_id=<id>``.

    Re-running a batch after a failure overwrites the same directory, so the
    output is exactly-once together with the query checkpoint.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        out = json_lines(batch) if json_payload else batch
        target = f"{path.rstrip('/')}/batch_id={batch_id}"
        if fmt == "text":
            out.write.mode("overwrite").text(target)
        else:
            out.write.mode("overwrite").format(fmt).save(target)
    return write
