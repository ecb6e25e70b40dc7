"""Table creation and writes: catalog tables, replay-safe partition overwrite, topic publish, CSV."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.schemas import LOG_ENTRY, TOPIC
from tracelake.session import path_exists, scratch_path

ALREADY_EXISTS = "AlreadyExists"
CREATED = "Created"
REQUIRED = "tracelake.required"


_ENDS = T.StructType([T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("end", T.LongType())])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    *,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    using: str = "parquet",
) -> str:
    """Create the table (and its namespace) when absent. Returns ``"AlreadyExists"`` or ``"Created"``."""
    if "." in name:
        ensure_namespace(spark, name.rsplit(".", 1)[0])
    if spark.catalog.tableExists(name):
        return ALREADY_EXISTS
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING {using}"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        sql += f" LOCATION '{location}'"
    required = [f.name for f in schema.fields if not f.nullable]
    if required:
        sql += f" TBLPROPERTIES ('{REQUIRED}' = '{','.join(required)}')"
    spark.sql(sql)
    return CREATED


def required_columns(spark: SparkSession, table: str) -> list[str]:
    """Columns of ``table`` that take no NULL: those the catalog declares so and those ``ensure_table`` noted.

    Spark's own file tables forget NOT NULL (other catalogs keep it), so ``ensure_table`` also notes the required
    columns as a table property.
    """
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    noted = [c for c in props.get(REQUIRED, "").split(",") if c]
    return list(dict.fromkeys(noted + [f.name for f in spark.table(table).schema.fields if not f.nullable]))


def path_required(df: DataFrame, required: Sequence[str] | None) -> list[str]:
    """Required columns of rows that go to a path: those given, else the log columns if the rows have all of them."""
    if required is not None:
        return list(required)
    log = [f.name for f in LOG_ENTRY.fields if not f.nullable]
    return log if set(log) <= set(df.columns) else []


def checked(df: DataFrame, required: Sequence[str], where: str) -> DataFrame:
    """``df`` with a check that fails the job on a NULL in a required column."""
    for c in required:
        if c in df.columns:
            error = F.raise_error(F.lit(f"{where}: NULL in required column {c}")).cast("boolean")
            df = df.where(F.when(F.col(c).isNull(), error).otherwise(F.lit(True)))
    return df


def with_required(df: DataFrame, table: str) -> DataFrame:
    """``df`` with a check that fails the write on a NULL in a required column of ``table``."""
    return checked(df, required_columns(df.sparkSession, table), table)


def append(df: DataFrame, target: str, *, is_path: bool = False, v2: bool = False, required: Sequence[str] | None = None) -> None:
    """Append rows as one commit; a NULL in a required column fails it.

    ``v2`` tables (Iceberg and other catalogs with a v2 connector) use ``writeTo(...).append()``; catalog v1 tables
    take ``insertInto`` (by position, so the frame is ordered like the table); ``is_path`` appends Parquet files.
    Tables name their required columns themselves (``required_columns``); for a path ``required`` does, by default the
    columns of ``LOG_ENTRY`` if the rows have all of them.
    """
    if df.isEmpty():  # empty-batch guard: do not touch the table
        return
    if is_path:
        checked(df, path_required(df, required), target).write.mode("append").parquet(target)
        return
    if v2:
        checked(df, required_columns(df.sparkSession, target), target).writeTo(target).append()
        return
    cols = df.sparkSession.table(target).columns
    with_required(df.select(*cols), target).write.insertInto(target)


def overwrite_partition(df: DataFrame, target: str, spec: Mapping[str, object], *, is_path: bool = False) -> None:
    """Replace exactly one partition with ``df`` (idempotent: a replay rewrites the same partition).

    Tables use ``INSERT OVERWRITE ... PARTITION (static spec)`` on the frame's own session (inside
    ``foreachBatch`` that is a cloned session); paths use dynamic partition overwrite as a writer option.
    """
    spec = dict(spec)
    if is_path:
        out = checked(df, path_required(df, None), target)
        for k, v in spec.items():
            out = out.withColumn(k, F.lit(v))
        out.write.partitionBy(*spec).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(target)
        return
    session = df.sparkSession
    cols = [c for c in session.table(target).columns if c not in spec]
    view = f"_tracelake_batch_{abs(hash((target, tuple(spec.items())))) % 10**12}"
    with_required(df.select(*cols), target).createOrReplaceTempView(view)
    parts = ", ".join(f"{k}={_sql_literal(v)}" for k, v in spec.items())
    session.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({parts}) SELECT {', '.join(f'`{c}`' for c in cols)} FROM {view}")
    session.catalog.dropTempView(view)


def _sql_literal(v: object) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(v)


def publish(messages: DataFrame, topic: str, brokers: str, options: Mapping[str, str] | None = None) -> None:
    """Send ``value`` (and ``key`` if present) of each row as one Kafka message (needs the Kafka connector)."""
    cols = [c for c in ("key", "value") if c in messages.columns]
    w = messages.select(*[F.col(c).cast("binary") for c in cols]).write.format("kafka")
    w.option("kafka.bootstrap.servers", brokers).option("topic", topic).options(**(options or {})).save()


MAX_RUNS = 20_000

#: Log of a topic table: one row per append and topic partition with the offsets it takes (``first`` up to below ``end``)
#: and the staged rows, written before the rows are, and again with ``done`` behind them.
TOPIC_LOG = T.StructType(
    [
        T.StructField("append_id", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("rows", T.StringType()),
        T.StructField("done", T.BooleanType()),
    ]
)


def _topic_log(session: SparkSession, path: str) -> DataFrame:
    """All log rows of a topic table, with the ends that tables without a log noted, or hold, as done appends."""
    log_path, ends_path = f"{path.rstrip('/')}/_log", f"{path.rstrip('/')}/_ends"
    log = session.createDataFrame([], TOPIC_LOG)
    logged = path_exists(session, log_path)
    if logged:
        log = session.read.schema(TOPIC_LOG).parquet(log_path)
    old = None
    if path_exists(session, ends_path):
        old = session.read.schema(_ENDS).parquet(ends_path)
    elif not logged and path_exists(session, path):  # written before ends were recorded
        old = session.read.schema(TOPIC).parquet(path).select("topic", "partition", (F.col("offset") + 1).alias("end"))
    if old is not None:
        none = F.lit(None).cast("string")
        log = log.unionByName(old.select(none.alias("append_id"), "topic", "partition", F.lit(0).cast("bigint").alias("first"), "end", none.alias("rows"), F.lit(True).alias("done")))
    return log


def _numbered(staged_rows: DataFrame, starts: dict, columns: Sequence[str]) -> tuple[DataFrame | None, dict]:
    """Staged rows with their offsets and the end of each (topic, partition), given where each starts.

    The rows of a topic partition follow each other in the order of the staged partitions and, in those, of their place,
    so the numbers are the same whenever they are made again. Up to ``MAX_RUNS`` runs (Spark and topic partitions that
    meet) are numbered on the driver and broadcast; more are numbered by a window and joined, with the same result.
    """
    session = staged_rows.sparkSession
    fixed = staged_rows.withColumn("_part", F.shiftright("_mid", 33))
    runs = fixed.groupBy("_part", "topic", "partition").agg(F.min("_mid").alias("_first"), F.count("*").alias("_n"))
    few = runs.limit(MAX_RUNS + 1).collect()
    ends: dict = {}
    if len(few) <= MAX_RUNS:
        shifts = []
        for r in sorted(few, key=lambda r: r["_part"]):
            at = ends.get((r["topic"], r["partition"]), starts.get((r["topic"], r["partition"]), 0))
            shifts.append((r["_part"], r["topic"], r["partition"], at - r["_first"]))
            ends[r["topic"], r["partition"]] = at + r["_n"]
        if not shifts:
            return None, ends
        runs = F.broadcast(session.createDataFrame(shifts, "_part long, topic string, partition int, _shift long"))
    else:
        known = session.createDataFrame([(*k, v) for k, v in starts.items()], "topic string, partition int, _end long")
        before = Window.partitionBy("topic", "partition").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(known, ["topic", "partition"], "left")
        start = F.coalesce("_end", F.lit(0)) + F.col("_before")
        runs = runs.select("_part", "topic", "partition", (start - F.col("_first")).alias("_shift"), (start + F.col("_n")).alias("_stop"))
        for r in runs.groupBy("topic", "partition").agg(F.max("_stop").alias("end")).collect():  # one row per topic partition
            ends[r["topic"], r["partition"]] = r["end"]
        runs = runs.drop("_stop")
    numbered = fixed.join(runs, ["_part", "topic", "partition"])
    offset = (F.col("_mid") + F.col("_shift")).alias("offset")
    return numbered.select(*[offset if c == "offset" else F.col(c) for c in columns]), ends


def _note(session: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    session.createDataFrame(rows, TOPIC_LOG).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/_log")


def _write_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def recover_topic_table(spark: SparkSession, path: str) -> int:
    """Complete the appends to a topic table that broke off; returns how many there were. The next append does it, too.

    An append that noted its offsets is carried through: of its staged rows those whose offset the table does not hold
    are written at the offsets that were noted, so no row is lost, doubled or renumbered however far the append got.
    One that broke off before that left nothing.
    """
    return _recover(spark, path, _topic_log(spark, path))


def _recover(spark: SparkSession, path: str, log: DataFrame) -> int:
    last = [F.max(c).alias(c) for c in ("first", "end", "rows", "done")]
    noted = log.where(F.col("append_id").isNotNull()).groupBy("append_id", "topic", "partition").agg(*last)
    open_ = noted.where(~F.col("done")).collect()  # of broken appends: one row per topic partition
    for append_id in sorted({r["append_id"] for r in open_}):
        own = [r for r in open_ if r["append_id"] == append_id]
        columns = TOPIC.fieldNames()
        fixed = spark.read.schema(T.StructType([*TOPIC.fields, T.StructField("_mid", T.LongType())])).parquet(own[0]["rows"])
        numbered, ends = _numbered(fixed, {(r["topic"], r["partition"]): r["first"] for r in own}, columns)
        if ends != {(r["topic"], r["partition"]): r["end"] for r in own}:
            raise RuntimeError(f"{path}: the staged rows of append {append_id} at {own[0]['rows']} are not those it noted")
        key = ["topic", "partition", "offset"]
        low = min(r["first"] for r in own)
        there = spark.read.schema(TOPIC).parquet(path).where(F.col("offset") >= low).select(*key) if path_exists(spark, path) else None
        missing = numbered.join(there, key, "left_anti").select(*columns) if there is not None else numbered
        _write_rows(missing, path)
        _note(spark, path, [(r["append_id"], r["topic"], r["partition"], r["first"], r["end"], r["rows"], True) for r in own])
    return len({r["append_id"] for r in open_})


def note_append(topic_messages: DataFrame, path: str, append_id: str | None = None) -> tuple[DataFrame, list[tuple]] | None:
    """First half of ``write_topic_table``: stage the rows and note the offsets they take.

    Returns the numbered rows and the log rows, or None where there is nothing to append. From here on the append
    happens, whoever writes the rows.
    """
    session = topic_messages.sparkSession
    known: dict = {}
    if path_exists(session, path):
        log = _topic_log(session, path)
        if _recover(session, path, log):
            log = _topic_log(session, path)
        if append_id is not None and not log.where(F.col("append_id") == append_id).isEmpty():
            return None
        known = {(r["topic"], r["partition"]): r["end"] for r in log.groupBy("topic", "partition").agg(F.max("end").alias("end")).collect()}
    append_id = append_id or uuid.uuid4().hex
    columns = topic_messages.columns
    placed = topic_messages.sortWithinPartitions("topic", "partition", "offset").withColumn("_mid", F.monotonically_increasing_id())
    rows = scratch_path(session, "topic-append")
    placed.write.parquet(rows)
    numbered, ends = _numbered(session.read.schema(placed.schema).parquet(rows), known, columns)
    if numbered is None:
        return None
    taken = [(append_id, *k, known.get(k, 0), end, rows) for k, end in ends.items()]
    first = [] if path_exists(session, f"{path.rstrip('/')}/_log") else [(f"before-{append_id}", *k, 0, end, None, True) for k, end in known.items()]
    _note(session, path, first + [(*t, False) for t in taken])
    return numbered, taken


def write_topic_table(topic_messages: DataFrame, path: str, *, append_id: str | None = None) -> None:
    """Append Kafka-shaped rows to a topic table (Parquet directory read by the file-stream source); one writer at a time.

    As in a Kafka partition log, offsets are dense and keep growing: the rows of a topic partition are numbered on from
    the end of the last append, in the order of the Spark partitions and, in those, of their own offset (equal ones
    follow each other). Rows are sorted inside their partitions and staged once, without a shuffle; numbering needs one
    row per Spark and topic partition that meet.

    The offsets are noted in the hidden ``_log`` folder before the rows are written, and the append as done behind them.
    One that broke off is carried through by the next append or by ``recover_topic_table``: once noted, an append happens.
    A caller that cannot know whether its append was noted gives it an ``append_id`` and repeats it: an id that the log
    knows is not appended again.
    """
    noted = note_append(topic_messages, path, append_id)
    if noted:
        numbered, taken = noted
        _write_rows(numbered, path)
        _note(topic_messages.sparkSession, path, [(*t, True) for t in taken])


#: CSV text of a NULL; a backslash in a value is doubled, so no value looks like it.
CSV_NULL = "\\N"


def escape_csv(c: Column) -> Column:
    """Backslash, line feed and carriage return as two characters each, so that a record is one line."""
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "errorifexists", order_by: Sequence[Column | str] = ()) -> None:
    """CSV export without loss: ``"``-escaping, outer spaces kept, NULL as ``\\N``, empty text as ``""``, and line breaks
    inside text escaped, so that files stay splittable. ``sources.csvfiles.read_csv`` undoes it.

    With ``order_by`` the files are ranges of the order, numbered along it and sorted inside: read one after the other by
    name they are the ordered export."""
    if order_by:
        df = df.orderBy(*order_by)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    out = df.select(*[escape_csv(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns])
    w = out.write.mode(mode).option("header", header).option("escape", '"').option("quote", '"')
    w = w.option("nullValue", CSV_NULL).option("emptyValue", '""').option("ignoreLeadingWhiteSpace", False)
    w.option("ignoreTrailingWhiteSpace", False).csv(path)


def create_table_as(spark: SparkSession, name: str, df: DataFrame, *, location: str | None = None, order_by: Sequence[Column | str] = ()) -> None:
    """``CREATE TABLE name AS SELECT [... ORDER BY]`` for a DataFrame (K7); ordered files as in ``write_csv``."""
    if order_by:
        df = df.orderBy(*order_by)
    w = df.write.mode("errorifexists").format("parquet")
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)


def add_columns(spark: SparkSession, name: str, columns: T.StructType) -> None:
    """``ALTER TABLE ... ADD COLUMNS`` (K8)."""
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(columns)})")


def ensure_users_table(spark: SparkSession, name: str = "users", *, location: str | None = None) -> str:
    """``USERS(id bigint, name string)``; constraints are checked by ``quality.validate`` before writes."""
    from tracelake.schemas import USER_ROW

    return ensure_table(spark, name, USER_ROW, location=location)
