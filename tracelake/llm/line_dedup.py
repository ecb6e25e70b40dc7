"""Line dedup: hashes are range-partitioned and sorted by document and position, then streamed."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm.common import as_bytes, batch_slices, byte_slices, ship, stored

_DROP, _OPEN, _EDGE, _LAST = 0, 1, 2, 3


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return line.strip().lower()


def _entries(min_chars: int):
    """One row per document and distinct line key: key hash, document, number of lines, positions (uint32)."""

    def run(batches):
        for whole in batches:
            for batch in batch_slices(whole, "text"):
                keys, docs, counts, at = [], [], [], []
                for i, text in enumerate(batch.column(2).to_pylist()):
                    lines = text.split(b"\n")
                    where: dict[bytes, list[int]] = {}
                    for p, line in enumerate(lines):
                        k = line.strip().lower()
                        if len(k) >= min_chars and (min_chars <= 1 or len(k.decode("utf-8", "replace")) >= min_chars):
                            where.setdefault(k, []).append(p)
                    keys += [xxhash.xxh3_128_digest(k) for k in where]
                    at += [np.array(p, "<u4").tobytes() for p in where.values()]
                    docs += [i] * len(where)
                    counts += [len(lines)] * len(where)
                h = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                take = pa.array(docs, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.ascontiguousarray(h[:, 0])),
                        pa.array(np.ascontiguousarray(h[:, 1])),
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array(counts, pa.int32()),
                        pa.array(at, pa.binary()),
                    ],
                    names=["h1", "h2", "doc_id", "body", "n_lines", "at"],
                )

    return run


def _stream(min_docs: int, keep_first: bool, id_type: pa.DataType):
    """Read rows sorted by (hash, document) and emit what is dropped.

    A run of one hash that touches the start or end of the partition may go on in a neighbour: rows whose fate is not
    settled here go out as open rows, and the run's document count as an edge row with its first document and a last row
    with its last one (at most two pairs per partition). Repeated rows stand behind each other and count and go out once.
    """
    names = ["kind", "h1", "h2", "part", "n", "doc_id", "body", "n_lines", "at"]
    kinds = [pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), id_type, pa.int64(), pa.int32(), pa.binary()]

    def run(batches):
        part = TaskContext.get().partitionId()
        out: list[list] = [[] for _ in names]
        cur = last = begun = counted = None
        n, first_run, pending = 0, True, []

        def put(kind, key, count, row):
            for col, value in zip(out, (kind, key[0], key[1], part, count, *row), strict=True):
                col.append(value)

        def close(final: bool):
            if cur is None or not (first_run or final):
                return
            for row in pending:
                put(_OPEN, cur, n, row)
            put(_EDGE, cur, n, (begun[0], begun[1], None, None))
            put(_LAST, cur, n, (last[0], last[1], None, None))

        for batch in batches:
            for h1, h2, doc, body, n_lines, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h1, h2) != cur:
                    close(False)
                    first_run = cur is None
                    cur, last, counted, n, pending = (h1, h2), None, None, 0, []
                    begun = (doc, body)
                row = (doc, body, n_lines, at)
                if (doc, body) == last:
                    continue
                last = (doc, body)
                document = last if keep_first or doc is None else (doc,)
                if document != counted:
                    n += 1
                    counted = document
                if keep_first:
                    if n > 1:
                        put(_DROP, cur, n, row)
                    elif first_run:
                        pending.append(row)
                    elif len(at) > 4:
                        put(_DROP, cur, n, (doc, body, n_lines, at[4:]))
                elif n >= min_docs:
                    for held in pending:
                        put(_DROP, cur, n, held)
                    pending = []
                    put(_DROP, cur, n, row)
                else:
                    pending.append(row)
                if len(out[0]) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
                    out = [[] for _ in names]
        close(True)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return run


def _bitmap(n_lines: int, dropped: list[bytes]) -> bytes:
    keep = np.ones(n_lines, bool)
    for p in dropped:
        keep[np.frombuffer(p, "<u4")] = False
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, keep: str = "none"
) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: (doc_id, body, n_lines, n_dropped, keep_bitmap).

    ``keep="none"``: a line whose key occurs in at least ``min_docs`` documents goes everywhere. ``keep="first"``: the
    first line of a key by (document, position) stays, every later one goes. Keys of under ``min_chars`` code points
    never go. For the count a document is a distinct id, whatever texts its rows have; rows with a null id are told apart
    by their text. For ``keep="first"`` the texts of one id follow each other by their hash. Null text is one empty line. ``body`` is the text's 64-bit hash: with the id it tells rows of equal id apart.
    ``keep_bitmap`` is zlib-packed, one bit per line, high bit first.

    The range bounds cut on (hash, document), so a hot line spans many partitions; runs cut by a bound are settled
    from one count per partition side. Other columns of ``docs`` are not read.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(as_bytes(text_col)).alias("body"), as_bytes(text_col).alias("text"))
    id_field = T.StructField("doc_id", src.schema["doc_id"].dataType)
    head = [T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())]
    tail = [T.StructField("body", T.LongType()), T.StructField("n_lines", T.IntegerType()), T.StructField("at", T.BinaryType())]
    # written down, as the sampling of the ranges reads them, too
    entries = stored(src.mapInArrow(_entries(min_chars), T.StructType([*head, id_field, *tail])), "line-entries")
    order = ["h1", "h2", "doc_id", "body"]
    runs = entries.repartitionByRange(*order).sortWithinPartitions(*order, "at")
    from pyspark.sql.pandas.types import to_arrow_type

    marks = [T.StructField("kind", T.ByteType()), *head, T.StructField("part", T.IntegerType()), T.StructField("n", T.LongType())]
    found = stored(
        runs.mapInArrow(_stream(min_docs, keep == "first", to_arrow_type(id_field.dataType)), T.StructType([*marks, id_field, *tail])),
        "lines",
    )
    side = {"begun": _EDGE, "ended": _LAST}
    sides = found.where(F.col("kind").isin(_EDGE, _LAST)).groupBy("h1", "h2", "part")
    sides = sides.agg(F.max("n").alias("n"), *[F.max(F.when(F.col("kind") == k, F.col("doc_id"))).alias(c) for c, k in side.items()])
    before = F.lag("ended").over(Window.partitionBy("h1", "h2").orderBy("part"))
    twice = F.coalesce((before == F.col("begun")).cast("int"), F.lit(0))  # a document of both sides of a bound
    sides = sides.withColumn("n", F.col("n") - twice)
    edges = sides.groupBy("h1", "h2").agg(F.sum("n").alias("total"), F.min("part").alias("first_part"))
    opened = found.where(F.col("kind") == _OPEN).join(edges, ["h1", "h2"])
    if keep == "none":
        opened = opened.where(F.col("total") >= min_docs)
    else:
        rest = F.when(F.col("part") > F.col("first_part"), F.col("at")).otherwise(F.expr("substring(at, 5)"))
        opened = opened.withColumn("at", rest).where(F.length("at") > 0)
    cols = ["doc_id", "body", "n_lines", "at"]
    dropped = found.where(F.col("kind") == _DROP).select(*cols).unionByName(opened.select(*cols)).distinct()

    @F.arrow_udf("binary")
    def pack(n_lines: pa.Array, at: pa.Array) -> pa.Array:
        return pa.array([_bitmap(n, p) for n, p in zip(n_lines.to_pylist(), at.to_pylist(), strict=True)], pa.binary())

    per_doc = dropped.groupBy("doc_id", "body").agg(
        F.first("n_lines").alias("n_lines"), F.collect_list("at").alias("at"), (F.sum(F.length("at")) / 4).cast("bigint").alias("n_dropped")
    )
    return per_doc.select("doc_id", "body", F.col("n_lines").cast("bigint").alias("n_lines"), "n_dropped", pack("n_lines", "at").alias("keep_bitmap"))


def kept_lines(text: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """(kept text, number of lines, number dropped) of one text."""
    if bitmap is None:
        return text, text.count(b"\n") + 1, 0
    lines = text.split(b"\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines)).tolist()
    left = [x for x, k in zip(lines, keep, strict=True) if k]
    return b"\n".join(left), len(lines), len(lines) - len(left)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str, to: str) -> DataFrame:
    """``docs`` with the bitmap of each row (null: nothing goes) as column ``to``."""
    b = bitmaps.select(F.col("doc_id").alias("__bid"), F.col("body").alias("__bbody"), F.col("keep_bitmap").alias(to))
    d = docs.withColumn("__body", F.xxhash64(as_bytes(text_col)))
    on = F.col(id_col).eqNullSafe(F.col("__bid")) & (F.col("__body") == F.col("__bbody"))
    return d.join(b, on, "left").drop("__bid", "__bbody", "__body")


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, the text cut to the kept lines joined by a line feed; a null text stays null."""
    ship(docs.sparkSession)

    @F.arrow_udf("binary")
    def cut(text: pa.Array, bitmap: pa.Array) -> pa.Array:
        out = [None if t is None else kept_lines(t, b)[0] for t, b in zip(text.to_pylist(), bitmap.to_pylist(), strict=True)]
        return pa.array(out, pa.binary())

    joined = with_bitmaps(docs, bitmaps, id_col, text_col, "__keep")
    text = F.when(F.col("__keep").isNull(), F.col(text_col)).otherwise(cut(F.col(text_col).cast("binary"), "__keep").cast("string"))
    return joined.withColumn(text_col, text).select(*docs.columns)


def line_report(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines (before), n_dropped, kept_sha256 of the kept text's UTF-8 bytes."""
    ship(docs.sparkSession)

    @F.arrow_udf("struct<n_lines:bigint,n_dropped:bigint,kept_sha256:string>")
    def digest(text: pa.Array, bitmap: pa.Array) -> pa.Array:
        rows, at = [], 0
        for part in byte_slices(text):
            for t, b in zip(part.to_pylist(), bitmap.slice(at, len(part)).to_pylist(), strict=True):
                kept, n, gone = kept_lines(t, b)
                rows.append({"n_lines": n, "n_dropped": gone, "kept_sha256": hashlib.sha256(kept).hexdigest()})
            at += len(part)
        kind = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])
        return pa.array(rows, kind)

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = with_bitmaps(src, bitmaps, "doc_id", "text", "__keep")
    out = joined.select("doc_id", digest(as_bytes("text"), "__keep").alias("r"))
    return out.select("doc_id", "r.n_lines", "r.n_dropped", "r.kept_sha256")
