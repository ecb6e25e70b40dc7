"""Identity ranges for several writers: a ledger of reserved ids beside a table.

A reservation is one small file in the ledger folder, named by its number, that says which ids it takes. It is created
without overwriting, which shared file systems let succeed once: of two writers that go for the same number one gets it,
the other reads it and goes for the next. Ids of a reservation whose job is lost are never used; identity ids may have gaps.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.operators import stored
from tracelake.operators.tableops import assign_ids
from tracelake.session import staged

#: Seconds to wait for the content of a reservation that another writer is just making.
PATIENCE = 30


def _files(spark: SparkSession, ledger: str):
    """The ledger's file system and a function from names to paths in it."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(ledger)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(root)
    return fs, root, lambda name: jvm.org.apache.hadoop.fs.Path(root, name)


def _content(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def high_water(spark: SparkSession, ledger: str) -> tuple[int, int | None]:
    """(number of reservations, first id that none has taken; None without reservations)."""
    fs, root, at = _files(spark, ledger)
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().isdigit())
    if not names:
        return 0, None
    waited = time.time()
    while not (text := _content(spark, fs, at(names[-1]))).endswith("."):
        if time.time() - waited > PATIENCE:
            raise RuntimeError(f"{ledger}: reservation {names[-1]} was never finished; remove it if its writer is lost")
        time.sleep(0.1)
    return int(names[-1]) + 1, int(text.split()[1].rstrip("."))


def reserve(spark: SparkSession, ledger: str, n: int, at_least: int = 0) -> int:
    """Reserve ``n`` ids in a row that no other reservation has, none below ``at_least``; returns the first."""
    while True:
        number, end = high_water(spark, ledger)
        first = max(at_least, end or 0)
        fs, _, at = _files(spark, ledger)
        try:
            stream = fs.create(at(f"{number:012d}"), False)
        except Exception as e:  # somebody else was faster: theirs stands
            if "exist" not in str(e).lower():
                raise
            continue
        try:
            stream.write(bytearray(f"{first} {first + n}.".encode()))
        finally:
            stream.close()
        return first


def insert_generated(spark: SparkSession, name: str, rows: DataFrame, ledger: str, id_col: str = "id") -> tuple[int, int]:
    """Insert rows into a stored table; those without an id get reserved ones. Returns (first reserved id, how many).

    The first reservation starts above the table's greatest id; ids that rows bring along lift the mark above theirs.
    """
    if id_col not in rows.columns:
        rows = rows.withColumn(id_col, F.lit(None).cast(T.LongType()))
    rows = staged(rows, "generated")
    n, given = rows.agg(F.count(F.when(F.col(id_col).isNull(), 1)), F.max(id_col)).first()
    low = 0 if given is None else int(given) + 1
    if high_water(spark, ledger)[1] is None:
        top = spark.table(name).agg(F.max(id_col)).first()[0]
        low = max(low, 0 if top is None else int(top) + 1)
    first = reserve(spark, ledger, n, low)
    stored.insert(spark, name, assign_ids(rows, id_col, start=first))
    return first, n
