"""Row-level table changes as pure DataFrame functions ``(current, changes) -> next``.

Parquet tables have no row-level operations, so every change returns the next version of the table; write it as a
new table or partition, then switch (never overwrite a path that the same job is reading).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.session import staged

# Position bits of monotonically_increasing_id(); the upper bits hold the partition id.
_POS_BITS = 33


def _cond(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def insert(current: DataFrame, rows: DataFrame) -> DataFrame:
    """``INSERT``: append rows by column name; columns missing in ``rows`` become NULL."""
    return current.unionByName(rows, allowMissingColumns=True)


def update(
    df: DataFrame,
    assignments: Mapping[str, Column | str],
    where: Column | str | None = None,
    *,
    normalise: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """``UPDATE df SET col = expr, ... WHERE cond``.

    SQL three-valued logic: a NULL condition leaves the row unchanged. ``normalise`` maps a column to a function
    applied to its new value, only when that column is assigned (a BEFORE UPDATE OF col trigger).
    """
    hit = F.lit(True) if where is None else F.coalesce(_cond(where), F.lit(False))
    normalise = normalise or {}
    out = []
    for c in df.columns:
        if c in assignments:
            new = _cond(assignments[c])
            if c in normalise:
                new = normalise[c](new)
            out.append(F.when(hit, new).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def delete(df: DataFrame, where: Column | str, *, observation: Observation | None = None) -> DataFrame:
    """``DELETE FROM df WHERE cond``: keeps rows whose condition is false or NULL.

    With ``observation`` the number of deleted rows is counted in the same pass (``observation.get['deleted']``).
    """
    cond = F.coalesce(_cond(where), F.lit(False))
    if observation is not None:
        df = df.observe(observation, F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias("deleted"))
    return df.where(~cond)


def latest_per_key(changes: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` tuple.

    A ``max(struct(order, row))`` aggregate, so the reduction is partial (map-side): a key that holds a third of
    all changes is collapsed before the shuffle instead of being sorted in one task.
    """
    payload = [c for c in changes.columns if c not in key]
    ordered = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], F.struct(*payload).alias("_row"))
    best = changes.groupBy(*key).agg(F.max(ordered).alias("_best"))
    return best.select(*key, *[F.col("_best._row")[c].alias(c) for c in payload])


def upsert(
    current: DataFrame,
    changes: DataFrame,
    key: str | Sequence[str],
    *,
    order_by: Sequence[str] | None = None,
    normalise: Mapping[str, Callable[[Column], Column]] | None = None,
    few_changes: bool = False,
) -> DataFrame:
    """``UPSERT ... WITH PRIMARY KEY``: changed keys take the change row, new keys are inserted, others stay.

    ``order_by`` picks the winning change when a key appears more than once (greatest wins; ties are broken by the
    row values, so the result does not depend on arrival order); ``current`` then has each key once, and one full outer
    join on the aggregate's own partitioning reads both sides once. ``few_changes`` joins the other way for change sets
    far smaller than the table: an anti join, whose small side Spark broadcasts by its measured size, leaves the table
    unshuffled at the price of computing the changes twice. Without ``order_by`` every change row is kept (a repeated
    key stays repeated) and the anti join uses the distinct change keys. Columns of ``current`` define the output;
    ``order_by`` columns that are not table columns are dropped.
    """
    key = [key] if isinstance(key, str) else list(key)
    cols = current.columns
    if order_by:
        changes = latest_per_key(changes, key, order_by)
    changes = changes.select(*[F.col(c) if c in changes.columns else F.lit(None).alias(c) for c in cols])
    if normalise:
        changes = changes.select(*[normalise[c](F.col(c)).alias(c) if c in normalise else F.col(c) for c in cols])
    if order_by and not few_changes:
        old = current.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)])
        new = changes.select(*[F.col(c).alias(f"_n{i}") for i, c in enumerate(cols)], F.lit(True).alias("_new"))
        on = [F.col(f"_c{cols.index(k)}") == F.col(f"_n{cols.index(k)}") for k in key]
        both = old.join(new, on, "full_outer")
        changed = F.coalesce(F.col("_new"), F.lit(False))
        return both.select(*[F.when(changed, F.col(f"_n{i}")).otherwise(F.col(f"_c{i}")).alias(c) for i, c in enumerate(cols)])
    change_keys = changes.select(*key) if order_by else changes.select(*key).distinct()
    kept = current.join(change_keys, on=key, how="left_anti")
    return kept.unionByName(changes.select(*cols))


def assign_ids(df: DataFrame, id_col: str = "id", *, start: int | None = None) -> DataFrame:
    """Identity column ``GENERATED BY DEFAULT``: rows with a NULL id get ``max(id) + 1, + 2, ...``; others keep theirs.

    Only the id-less rows are staged (their place must stay fixed while they are numbered): rows are counted per staged
    partition, the counts become offsets, then id = base + offset(partition) + position in partition. No global sort
    and no single-task window; one number per staged partition reaches the driver and is broadcast back.
    """
    spark = df.sparkSession
    if start is None:
        top = df.agg(F.max(id_col)).first()[0]
        start = 0 if top is None else int(top) + 1
    missing = staged(df.where(F.col(id_col).isNull()).withColumn("_mid", F.monotonically_increasing_id()), "idless")
    missing = missing.withColumn("_pid", F.shiftright("_mid", _POS_BITS))
    counts = sorted((int(r[0]), int(r[1]), int(r[2])) for r in missing.groupBy("_pid").agg(F.count("*"), F.min("_mid")).collect())
    offsets, acc = [], start
    for pid, n, first in counts:
        offsets.append((pid, acc - first))
        acc += n
    off_df = spark.createDataFrame(offsets, "_pid long, _off long")
    numbered = missing.join(F.broadcast(off_df), "_pid").withColumn(id_col, F.col("_off") + F.col("_mid"))
    return df.where(F.col(id_col).isNotNull()).unionByName(numbered.select(*df.columns))


def page(df: DataFrame, order_by: Sequence[Column | str], n: int, offset: int = 0) -> DataFrame:
    """``ORDER BY ... LIMIT n OFFSET m`` (also ``TOP n`` and ``OFFSET m ROWS FETCH NEXT n ROWS ONLY``)."""
    ordered = df.orderBy(*order_by)
    if offset:
        ordered = ordered.offset(offset)
    return ordered.limit(n)


def deep_page(df: DataFrame, order_by: Sequence[Column | str], n: int, offset: int = 0) -> DataFrame:
    """``page`` for any offset: only the rows around the page are sorted, and no task gets the rows before it.

    Rows are dealt by ranges of the order (further columns and the place in the scan part equal ones, so a value that many
    rows share spans ranges) and staged once; ranges are counted, those before the page are skipped whole by their
    number, and the one or few that hold the page are sorted. Rows that are equal in ``order_by`` are told apart by the
    other columns.
    """
    ties = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [*order_by, *ties, "_place"]
    dealt = df.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*order)
    rows = staged(dealt.withColumn("_range", F.spark_partition_id()), "page")
    counts = sorted(tuple(r) for r in rows.groupBy("_range").agg(F.count("*")).collect())  # one row per range
    first = last = None
    before = skipped = 0
    for number, count in counts:
        if before + count > offset and before < offset + n:
            if first is None:
                first, skipped = number, before
            last = number
        before += count
    if first is None:
        return df.limit(0)
    held = rows.where(F.col("_range").between(first, last)).orderBy(*order)
    rest = offset - skipped
    return (held.offset(rest) if rest else held).limit(n).select(*df.columns)


def top(df: DataFrame, order_by: Sequence[Column | str], n: int) -> DataFrame:
    """``SELECT TOP n ... ORDER BY`` -> TakeOrderedAndProject (per-partition top-n, then merge)."""
    return df.orderBy(*order_by).limit(n)


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    """Global ``COUNT(*)`` as a one-row frame (partial counts per partition, one tiny shuffle)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def exists(df: DataFrame, where: Column | str | None = None) -> bool:
    """Existence test without counting everything: stops at the first matching row."""
    d = df if where is None else df.where(_cond(where))
    return not d.isEmpty()
