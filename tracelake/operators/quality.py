"""Row checks and change records (what the handbook's triggers do, as DataFrame operators)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.text import lossy_utf8, parse_unsigned, unicode_trim
from tracelake.schemas import OP_LOG


@dataclass(frozen=True)
class Rule:
    """``violated`` is true for a bad row (NULL counts as not violated)."""

    code: int
    message: str
    violated: Callable[[], Column]


# Error code and text of the empty-name check.
EMPTY_NAME = 10001
EMPTY_NAME_TEXT = "NAME must not be empty"
# Our own codes for the other table constraints.
NAME_TOO_LONG = 10002
BAD_ID = 10003
DUPLICATE_ID = 10004


def user_rules(name: str = "name", id_col: str = "id", max_len: int = 255) -> list[Rule]:
    return [
        Rule(EMPTY_NAME, EMPTY_NAME_TEXT, lambda: F.col(name).isNull() | (F.char_length(name) == 0)),
        Rule(NAME_TOO_LONG, f"NAME longer than {max_len} characters", lambda: F.char_length(name) > max_len),
        Rule(BAD_ID, "ID missing or negative", lambda: F.col(id_col).isNull() | (F.col(id_col) < 0)),
    ]


def _with_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Flag rows whose key occurs more than once (partial count per key, then a join on the key)."""
    dup = df.groupBy(*key).agg((F.count(F.lit(1)) > 1).alias("_dup")).where("_dup")
    return df.join(dup, on=list(key), how="left").withColumn("_dup", F.coalesce("_dup", F.lit(False)))


def validate(
    df: DataFrame,
    rules: Sequence[Rule] | None = None,
    *,
    unique_key: Sequence[str] | None = ("id",),
    mode: str = "flag",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Check rows against ``rules`` (default: the users table constraints) and key uniqueness.

    * ``flag``: add ``error_code`` (first violated rule, 0 when the row is fine);
    * ``split``: return ``(good, bad)``, bad rows carry ``error_code`` and ``error``;
    * ``fail``: same rows back, but the job raises on the first bad row (BEFORE INSERT ... SIGNAL).
    """
    rules = list(rules if rules is not None else user_rules())
    cols = df.columns
    base = df
    checks = [(r.code, r.message, F.coalesce(r.violated(), F.lit(False))) for r in rules]
    if unique_key:
        base = _with_duplicates(df, unique_key).select(*cols, "_dup")
        checks.append((DUPLICATE_ID, "duplicate key", F.col("_dup")))
    code = F.lit(0)
    text = F.lit(None).cast("string")
    for c, msg, bad in reversed(checks):
        code = F.when(bad, F.lit(c)).otherwise(code)
        text = F.when(bad, F.lit(msg)).otherwise(text)
    flagged = base.select(*cols, code.cast("int").alias("error_code"), text.alias("error"))
    if mode == "flag":
        return flagged.drop("error")
    if mode == "split":
        return flagged.where("error_code = 0").select(*cols), flagged.where("error_code <> 0")
    if mode == "fail":
        error = F.concat(F.col("error_code").cast("string"), F.lit(": "), F.col("error"))
        guard = F.when(F.col("error_code") != 0, F.raise_error(error).cast("boolean")).otherwise(F.lit(True))
        return flagged.where(guard).select(*cols)
    raise ValueError("mode must be flag, split or fail")


def audit_changes(
    old: DataFrame,
    new: DataFrame,
    *,
    key: str = "id",
    column: str = "name",
    changed_at: Column | None = None,
    only_changed: bool = False,
) -> DataFrame:
    """Row audit of an update: ``(id, old_name, new_name, changed_at)`` for every row present before and after.

    As the AFTER UPDATE row trigger, every updated row is recorded; ``only_changed`` keeps only rows whose value
    differs (NULL-safe).
    """
    ts = changed_at if changed_at is not None else F.current_timestamp().cast("timestamp_ntz")
    o = old.select(F.col(key).alias("_k"), F.col(column).alias(f"old_{column}"))
    n = new.select(F.col(key).alias("_k"), F.col(column).alias(f"new_{column}"))
    j = o.join(n, "_k")
    if only_changed:
        j = j.where(~F.col(f"old_{column}").eqNullSafe(F.col(f"new_{column}")))
    return j.select(F.col("_k").alias(key), f"old_{column}", f"new_{column}", ts.alias("changed_at"))


def op_log_entry(spark: SparkSession, op: str, n_rows: int | None, happened_at=None) -> DataFrame:
    """One statement-level log row ``(op, happened_at, n_rows)``, written even when 0 rows were affected."""
    import datetime as _dt

    when = happened_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame([(op, when, None if n_rows is None else int(n_rows))], OP_LOG)


def normalise(df: DataFrame, column: str, fn: Callable[[Column], Column] = unicode_trim) -> DataFrame:
    """Apply a normaliser (default: Unicode trim) to one column."""
    return df.withColumn(column, fn(F.col(column)))


def fetch_users(table: DataFrame, id_col: str = "ID", name_col: str = "NAME") -> DataFrame:
    """Users as read from the source table: ``id`` must be an unsigned integer, outer white space aside; the read fails
    otherwise, whatever columns are used later (the check is a filter). ``name`` is decoded leniently (invalid UTF-8
    replaced), trimmed, and NULL becomes ''.
    """
    raw_id = F.col(id_col).cast("string")
    parsed = parse_unsigned(raw_id)
    failed = F.raise_error(F.concat(F.lit("bad ID: "), F.coalesce(raw_id, F.lit("NULL")))).cast("boolean")
    name = unicode_trim(F.coalesce(lossy_utf8(name_col), F.lit("")))
    return table.where(F.when(parsed.isNull(), failed).otherwise(F.lit(True))).select(parsed.alias("id"), name.alias("name"))


# Codes of the user_roles constraints (ours).
ROLE_MISSING = 10011
ROLE_TOO_LONG = 10012
ROLE_USER_MISSING = 10013


def role_rules(user_id: str = "user_id", role: str = "role", max_len: int = 50) -> list[Rule]:
    """``user_roles``: both columns required, role at most ``max_len`` characters."""
    return [
        Rule(ROLE_USER_MISSING, "USER_ID must not be NULL", lambda: F.col(user_id).isNull()),
        Rule(ROLE_MISSING, "ROLE must not be NULL", lambda: F.col(role).isNull()),
        Rule(ROLE_TOO_LONG, f"ROLE longer than {max_len} characters", lambda: F.char_length(role) > max_len),
    ]


def update_with_audit(
    df: DataFrame,
    assignments: dict,
    where: Column | str | None = None,
    *,
    key: str = "id",
    column: str = "name",
    normalise: dict | None = None,
    changed_at: Column | None = None,
    only_changed: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``UPDATE`` plus its AFTER UPDATE row audit, both from one row-local projection (no join, no shuffle).

    Returns ``(next_version, audit)``; audit rows are ``(key, old_<column>, new_<column>, changed_at)`` for every
    row the condition hits (``only_changed``: only where the value differs, NULL-safe).
    """
    from tracelake.operators.tableops import update

    ts = changed_at if changed_at is not None else F.current_timestamp().cast("timestamp_ntz")
    hit = F.lit(True) if where is None else F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))
    nxt = update(df, assignments, where, normalise=normalise)
    staged = df.select(
        F.col(key).alias("_k"), F.col(column).alias("_old"), hit.alias("_hit"),
        _new_value(assignments, column, normalise).alias("_new"),
    )
    audit = staged.where("_hit")
    if only_changed:
        audit = audit.where(~F.col("_old").eqNullSafe(F.col("_new")))
    audit = audit.select(F.col("_k").alias(key), F.col("_old").alias(f"old_{column}"), F.col("_new").alias(f"new_{column}"),
                         ts.alias("changed_at"))
    return nxt, audit


def _new_value(assignments: dict, column: str, normalise: dict | None) -> Column:
    """New value of ``column`` for a row the update hits (the assigned expression, normalised)."""
    if column not in assignments:
        return F.col(column)
    new = F.expr(assignments[column]) if isinstance(assignments[column], str) else assignments[column]
    if normalise and column in normalise:
        new = normalise[column](new)
    return new
