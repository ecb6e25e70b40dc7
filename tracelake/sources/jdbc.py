"""JDBC tables: partitioned parallel read with pushed-down projection and filters, and batch write.

Only the option wiring lives here; which driver to use is the caller's choice (its jar must be on the classpath).
Not exercised against a live database in this repository (see README).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 100,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    With a ``partition_column`` (e.g. the id) and its bounds, Spark issues ``num_partitions`` range queries in
    parallel instead of one cursor; rows outside the bounds are still read (by the first and last range).
    ``fetch_size`` is the rows per round trip (default 100).
    """
    if not url or not table:
        raise ValueError("JDBC read needs url and table")
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    opts.update(extra or {})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """``SELECT ... FROM table``; later ``select``/``where`` calls are pushed into the database query."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **kw)).load()


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", batch_size: int = 1000,
               extra: Mapping[str, str] | None = None) -> None:
    """Insert rows (``INSERT INTO table``), one transaction per partition."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    opts.update(extra or {})
    df.write.format("jdbc").options(**opts).mode(mode).save()
