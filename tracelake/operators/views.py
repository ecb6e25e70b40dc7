"""Views over the users tables: plain, filtered, aggregated and joined (temp views or DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.text import unicode_trim
from tracelake.operators.joins import left_join


def create_view(df: DataFrame, name: str, *, replace: bool = True) -> DataFrame:
    """Session view over a DataFrame (``CREATE [OR REPLACE] VIEW``)."""
    if replace:
        df.createOrReplaceTempView(name)
    else:
        df.createTempView(name)
    return df


def create_sql_view(spark: SparkSession, name: str, select_sql: str, *, replace: bool = True, temporary: bool = True) -> DataFrame:
    """``CREATE [OR REPLACE] [TEMPORARY] VIEW name AS select_sql``; persistent views need a catalog table below."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    verb = "CREATE OR REPLACE" if replace else "CREATE"
    spark.sql(f"{verb} {kind} {name} AS {select_sql}")
    return spark.table(name)


def drop_view(spark: SparkSession, name: str, *, temporary: bool = True) -> None:
    if temporary:
        spark.catalog.dropTempView(name)
    else:
        spark.sql(f"DROP VIEW IF EXISTS {name}")


def trimmed_users(users: DataFrame) -> DataFrame:
    """``SELECT ID, TRIM(NAME) AS NAME FROM USERS`` (Unicode whitespace)."""
    return users.select("id", unicode_trim(F.col("name")).alias("name"))


def active_users(users: DataFrame) -> DataFrame:
    """Filter view: users that have a name (``NAME IS NOT NULL``; an empty name is a name)."""
    return users.where(F.col("name").isNotNull())


def users_count(users: DataFrame) -> DataFrame:
    """Aggregate view: ``SELECT COUNT(*) AS n_users FROM USERS``."""
    return users.agg(F.count(F.lit(1)).alias("n_users"))


def users_with_roles(users: DataFrame, roles: DataFrame) -> DataFrame:
    """Join view: every user with each of its roles, NULL role when it has none."""
    return left_join(users, roles, "id", "user_id").select("id", "name", "role")


def create_user_views(users: DataFrame, roles: DataFrame, *, prefix: str = "v_") -> list[str]:
    """Register the handbook's views by name for SQL use: ``<prefix>users`` (trimmed names),
    ``<prefix>users_active`` (filter), ``<prefix>users_count`` (aggregate), ``<prefix>users_with_roles`` (join).
    Returns the view names."""
    views = {
        f"{prefix}users": trimmed_users(users),
        f"{prefix}users_active": active_users(users),
        f"{prefix}users_count": users_count(users),
        f"{prefix}users_with_roles": users_with_roles(users, roles),
    }
    for name, df in views.items():
        create_view(df, name)
    return list(views)


def create_persistent_user_views(spark: SparkSession, users: str, roles: str, *, prefix: str = "v_") -> list[str]:
    """The handbook's views as catalog views over the tables ``users`` and ``roles``; they outlast the session.

    ``<prefix>users_active`` and ``<prefix>users_with_roles`` are views over ``<prefix>users``: when that is replaced
    (``create_sql_view(..., temporary=False)``), they read its new text. Returns the names in order of creation.
    """
    base = f"{prefix}users"
    texts = {
        base: rf"SELECT id, regexp_replace(name, '(?U)^\\s+|\\s+$', '') AS name FROM {users}",
        f"{prefix}users_active": f"SELECT id, name FROM {base} WHERE name IS NOT NULL",
        f"{prefix}users_count": f"SELECT count(*) AS n_users FROM {base}",
        f"{prefix}users_with_roles": f"SELECT u.id, u.name, r.role FROM {base} u LEFT JOIN {roles} r ON r.user_id = u.id",
    }
    for name, text in texts.items():
        create_sql_view(spark, name, text, temporary=False)
    return list(texts)
