"""Stored tables with row changes that last: bucketed versions, and a view that is switched by one statement.

The rows of table ``t`` lie in ``t_rows``, partitioned by the version that wrote them and the bucket of their key. ``t``
itself is a persistent view that names, as constants, which version and bucket partitions are current; readers go by it
and only list those. A change reads and rewrites only the buckets that it touches, as partitions of a new version beside
the old ones, and then replaces the view. Until that statement every reader sees the old rows, also if the job is lost;
what a lost job wrote is in no view. Which partitions are current and what a row must hold are properties of the view, and
every write checks them: key columns are unique and never null, required columns never null.

One writer at a time: a change that finds the view switched by somebody else since it read it raises ``Conflict``.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.operators import tableops
from tracelake.operators.sinks import checked, ensure_namespace
from tracelake.session import staged
from tracelake.sources.catalog import table_exists

BUCKET, VERSION = "_bucket", "_version"
_PROPERTY, _PIECE = "tracelake.stored", 3000
#: Keys of a batch that are looked up in the table by name; more go by their least and greatest.
FEW_KEYS = 500


class Conflict(RuntimeError):
    """Somebody else changed the table meanwhile."""


class KeyExists(ValueError):
    """A row's key is in the table, or twice in the batch."""


@dataclass(frozen=True)
class State:
    """What a table's view says: its key, required columns, number of buckets, and current buckets by version."""

    key: list[str]
    required: list[str]
    buckets: int
    version: int
    current: dict[int, list[int]]
    columns: list[str]

    def text(self) -> str:
        runs = {str(v): _to_runs(b) for v, b in self.current.items()}
        return json.dumps({"key": self.key, "required": self.required, "buckets": self.buckets, "version": self.version, "current": runs, "columns": self.columns})

    def where(self, only: Sequence[int] | None = None) -> str:
        """SQL condition of the current partitions (of some buckets)."""
        parts = []
        for v, bs in sorted(self.current.items()):
            bs = sorted(set(bs) if only is None else set(bs) & set(only))
            if bs:
                runs = [f"{BUCKET} BETWEEN {a} AND {b}" if b > a else f"{BUCKET} = {a}" for a, b in _runs(bs)]
                parts.append(f"({VERSION} = {v} AND ({' OR '.join(runs)}))")
        return " OR ".join(parts) or "false"


def _runs(numbers: Sequence[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for n in sorted(numbers):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [(a, b) for a, b in out]


def _to_runs(numbers: Sequence[int]) -> str:
    return ",".join(f"{a}-{b}" for a, b in _runs(numbers))


def _from_runs(text: str) -> list[int]:
    return [n for run in text.split(",") if run for a, b in [run.split("-")] for n in range(int(a), int(b) + 1)]


def state_of(spark: SparkSession, name: str) -> State:
    """The state that the view ``name`` carries."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    pieces = sorted((int(k.rsplit(".", 1)[1]), v) for k, v in props.items() if re.fullmatch(re.escape(_PROPERTY) + r"\.\d+", k))
    if not pieces:
        raise ValueError(f"{name} is no stored table")
    d = json.loads("".join(v for _, v in pieces))
    return State(d["key"], d["required"], d["buckets"], d["version"], {int(v): _from_runs(b) for v, b in d["current"].items()}, d["columns"])


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _switch(spark: SparkSession, name: str, state: State) -> None:
    """The one statement that makes a version current."""
    text = state.text()
    props = ", ".join(f"'{_PROPERTY}.{i}' = {_quoted(text[at : at + _PIECE])}" for i, at in enumerate(range(0, len(text), _PIECE)))
    cols = ", ".join(f"`{c}`" for c in state.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({props}) AS SELECT {cols} FROM {name}_rows WHERE {state.where()}")


def _with_bucket(df: DataFrame, state: State) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*state.key), F.lit(state.buckets)).cast("int"))


def _touched(df: DataFrame, state: State) -> list[int]:
    """Buckets of some rows' keys: at most ``state.buckets`` numbers."""
    return [r[0] for r in _with_bucket(df.select(*state.key), state).select(BUCKET).distinct().collect()]


def rows_in(spark: SparkSession, name: str, state: State, only: Sequence[int] | None = None) -> DataFrame:
    """Current rows, of some buckets only: the others' files are not listed."""
    return spark.table(f"{name}_rows").where(state.where(only)).select(*state.columns)


def _write(spark: SparkSession, name: str, rows: DataFrame, state: State, version: int) -> None:
    rows = checked(rows, [*state.key, *state.required], name)
    out = _with_bucket(rows.select(*state.columns), state).withColumn(VERSION, F.lit(version).cast("bigint"))
    # few files a bucket; keys are unique, so no bucket is hot, and a large one is split
    out.select(*state.columns, VERSION, BUCKET).hint("rebalance", BUCKET).write.mode("append").insertInto(f"{name}_rows")


def _publish(spark: SparkSession, name: str, before: State, version: int, current: dict[int, list[int]]) -> None:
    if state_of(spark, name).version != before.version:
        raise Conflict(f"{name} was changed by somebody else")
    current = {v: b for v, b in current.items() if b}
    _switch(spark, name, State(before.key, before.required, before.buckets, version, current, before.columns))


def _next_version(state: State) -> int:
    """A number above the current one that no lost job has used: its files may lie there without being registered."""
    return max(state.version + 1, time.time_ns() // 1_000_000)


def create(
    spark: SparkSession, name: str, schema: T.StructType, key: str | Sequence[str], *, buckets: int = 64, location: str | None = None
) -> None:
    """An empty stored table; columns that the schema does not let be null are required."""
    key = [key] if isinstance(key, str) else list(key)
    if "." in name:
        ensure_namespace(spark, name.rsplit(".", 1)[0])
    if table_exists(spark, name):
        raise ValueError(f"{name} exists")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_rows ({cols}, {VERSION} BIGINT, {BUCKET} INT) USING parquet PARTITIONED BY ({VERSION}, {BUCKET}){at}")
    required = [f.name for f in schema.fields if not f.nullable and f.name not in key]
    _switch(spark, name, State(key, required, buckets, 0, {}, schema.fieldNames()))


def existing_keys(spark: SparkSession, name: str, batch: DataFrame) -> DataFrame:
    """The keys of ``batch`` that the table holds.

    Only the buckets of the batch's keys are read, and in them only files and row groups that can hold one: of few keys
    by name, else by the least and greatest value of each key column.
    """
    state = state_of(spark, name)
    keys = batch.select(*state.key).distinct()
    stored = rows_in(spark, name, state, _touched(keys, state)).select(*state.key)
    few = keys.limit(FEW_KEYS + 1).collect()
    if len(few) <= FEW_KEYS:
        for k in state.key:
            stored = stored.where(F.col(k).isin([r[k] for r in few]))
    else:
        bounds = keys.agg(*[F.min(k).alias(f"low_{k}") for k in state.key], *[F.max(k).alias(f"high_{k}") for k in state.key]).first()
        for k in state.key:
            stored = stored.where(F.col(k).between(bounds[f"low_{k}"], bounds[f"high_{k}"]))
    return keys.join(stored, state.key, "left_semi")


def flag_existing(spark: SparkSession, name: str, batch: DataFrame, code: int = 10004) -> DataFrame:
    """``batch`` with ``error_code``: ``code`` where the key is in the table or more than once in the batch, else 0."""
    state = state_of(spark, name)
    batch = staged(batch, "batch")
    twice = batch.groupBy(*state.key).count().where("count > 1").select(*state.key)
    bad = existing_keys(spark, name, batch).union(twice).distinct()
    bad = bad.select(*[F.col(k).alias(f"_bad_{k}") for k in state.key], F.lit(code).alias("_code"))
    on = [F.col(k) == F.col(f"_bad_{k}") for k in state.key]
    return batch.join(bad, on, "left").select(*batch.columns, F.coalesce("_code", F.lit(0)).alias("error_code"))


def insert(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """``INSERT``: rows with new keys; a key that exists or comes twice refuses the whole batch. Missing columns are null.

    Nothing stored is rewritten: the batch becomes partitions of a new version beside those that are current.
    """
    state = state_of(spark, name)
    rows = staged(rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in state.columns]), "insert")
    twice = rows.groupBy(*state.key).count().where("count > 1").select(*state.key).limit(5).collect()
    there = [] if twice else existing_keys(spark, name, rows).limit(5).collect()
    if twice or there:
        raise KeyExists(f"{name}: keys {'twice in the batch' if twice else 'that exist'}, such as {[tuple(r) for r in twice or there]}")
    touched = _touched(rows, state)
    if not touched:
        return
    version = _next_version(state)
    _write(spark, name, rows, state, version)
    _publish(spark, name, state, version, {**state.current, version: touched})


def _replace(spark: SparkSession, name: str, state: State, touched: list[int], make: Callable[[DataFrame], DataFrame]) -> int:
    """Rewrite some buckets by ``make``; returns how many there were."""
    if touched:
        version = _next_version(state)
        _write(spark, name, make(rows_in(spark, name, state, touched)), state, version)
        current = {v: [b for b in bs if b not in set(touched)] for v, bs in state.current.items()}
        _publish(spark, name, state, version, {**current, version: touched})
    return len(touched)


def update(
    spark: SparkSession, name: str, assignments: Mapping[str, Column | str], where: Column | str | None = None, *,
    normalise: Mapping[str, Callable[[Column], Column]] | None = None,
) -> int:
    """``UPDATE``; buckets without a row that the condition hits stay as they are. Key columns cannot be assigned."""
    state = state_of(spark, name)
    if set(assignments) & set(state.key):
        raise ValueError("key columns cannot be assigned")
    hit = F.lit(True) if where is None else where
    touched = _touched(rows_in(spark, name, state).where(hit), state)
    return _replace(spark, name, state, touched, lambda old: tableops.update(old, assignments, where, normalise=normalise))


def delete(spark: SparkSession, name: str, where: Column | str) -> int:
    """``DELETE``; buckets without a row that the condition hits stay as they are."""
    state = state_of(spark, name)
    touched = _touched(rows_in(spark, name, state).where(where), state)
    return _replace(spark, name, state, touched, lambda old: tableops.delete(old, where))


def upsert(spark: SparkSession, name: str, changes: DataFrame, *, order_by: Sequence[str] | None = None) -> int:
    """``UPSERT ... WITH PRIMARY KEY``: only the buckets of the changes' keys are read and written.

    ``order_by`` picks among several changes of a key (``tableops.upsert``); without it the keys must be distinct.
    """
    state = state_of(spark, name)
    changes = staged(changes, "changes")
    if order_by is None and not changes.groupBy(*state.key).count().where("count > 1").isEmpty():
        raise KeyExists(f"{name}: a key comes twice in the changes; say by order_by which one counts")
    touched = _touched(changes, state)
    return _replace(spark, name, state, touched, lambda old: tableops.upsert(old, changes, state.key, order_by=order_by or state.key))


def compact(spark: SparkSession, name: str, least: int = 2) -> int:
    """Draw together the buckets that lie in ``least`` or more versions, as many inserts leave them."""
    state = state_of(spark, name)
    many = [b for b in range(state.buckets) if sum(b in bs for bs in state.current.values()) >= least]
    return _replace(spark, name, state, many, lambda old: old)


def vacuum(spark: SparkSession, name: str) -> list[str]:
    """Drop the partitions that are not current, once no reader of an older view is left; returns their names."""
    state = state_of(spark, name)
    keep = {(v, b) for v, bs in state.current.items() for b in bs}
    gone = []
    for r in spark.sql(f"SHOW PARTITIONS {name}_rows").collect():
        v, b = (int(x) for x in re.findall(r"=(\d+)", r[0]))
        if (v, b) not in keep:
            spark.sql(f"ALTER TABLE {name}_rows DROP IF EXISTS PARTITION ({VERSION} = {v}, {BUCKET} = {b})")
            gone.append(r[0])
    return gone


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}_rows")
