"""Rows <-> JSON message payloads.

``encode`` packs rows into compact JSON arrays of bounded size (one message = one array, field order = struct order).
``decode`` unpacks message values (a JSON array of row objects, or one bare row object) with strict validation:
a message is accepted only if it is one well-formed JSON value and every element carries every field with the
right JSON type. The checks are built from ``try_parse_json`` / variant expressions, so decoding stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.schemas import LOG_ENTRY

# Position bits of monotonically_increasing_id(): the upper 31 bits hold the partition id.
_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1
MAX_CHUNK_ROWS = 100_000


# ---------------------------------------------------------------------------------------------------------------
# encode
# ---------------------------------------------------------------------------------------------------------------


def encode(
    rows: DataFrame,
    fields: Sequence[str] | None = None,
    *,
    chunk_rows: int = 1000,
    max_bytes: int | None = None,
    chunk_by: Column | None = None,
    order_by: Sequence[str] = (),
    group_by: Sequence[str] = (),
    split_keys: bool = True,
) -> DataFrame:
    """Pack rows into JSON-array messages; returns ``(*group_by, chunk, n_rows, value)`` with ``value`` a string.

    ``max_bytes`` (positional mode) also bounds the UTF-8 size of a message - brokers reject messages above their
    limit (about 1 MB by default); a single row larger than the limit becomes a message of its own.

    Two ways to cut messages, both with bounded groups (no message holds a whole data set):

    * positional (default): consecutive rows of a scan partition, at most ``chunk_rows`` per message, in scan
      order, never mixing ``group_by`` values (e.g. files). Streamed per partition, no shuffle (see
      :func:`_pack_positional`). With ``order_by`` the rows are first range-partitioned and sorted on those
      columns (one range shuffle), so messages hold consecutive order ranges and message ids follow the order.
    * keyed: ``chunk_by`` names the message (e.g. ``seq div 1000`` over a unique sequence number) and ``order_by``
      orders rows inside it. Deterministic across runs and engines. A key of more than ``chunk_rows`` rows, or whose
      JSON exceeds ``max_bytes``, becomes several messages with the same ``chunk`` (rows stay in order): rows are
      range-partitioned on key and order, which also splits a hot key, sorted and packed in one streaming pass. A key
      cut by a range bound is cut into messages there, too. ``split_keys=False`` is for keys that the caller knows to
      be bounded (such as ``seq div 1000``): one message per key, gathered by one partially aggregated shuffle.
    """
    if not 1 <= chunk_rows <= MAX_CHUNK_ROWS:
        raise ValueError(f"chunk_rows must be in 1..{MAX_CHUNK_ROWS}")
    fields = list(fields or [c for c in rows.columns if c not in set(order_by) | set(group_by)])
    row = F.struct(*[F.col(f) for f in fields])
    if chunk_by is None:
        if order_by:
            # Ordered messages without a single task: range-partition on the order columns and, because equal keys go to
            # one range, on a hash of the row, so a hot order value spans several ranges; sort inside each partition,
            # then pack positionally. Message ids grow with the order: range partition i holds the i-th key range.
            tie = F.xxhash64(*[F.col(f) for f in fields]).alias("_tie")
            rows = rows.select("*", tie).repartitionByRange(*order_by, "_tie").sortWithinPartitions(*order_by, "_tie")
        return _pack_positional(rows.select(*group_by, F.to_json(row).alias("_json")), chunk_rows, list(group_by), max_bytes)
    if not order_by:
        raise ValueError("keyed chunks need order_by columns")
    key = [*group_by, "_chunk"]
    if split_keys or max_bytes is not None:
        ranged = rows.select(*group_by, chunk_by.cast("bigint").alias("_chunk"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], F.to_json(row).alias("_json"))
        by = [*key, *[f"_o{i}" for i in range(len(order_by))], "_json"]
        ranged = ranged.repartitionByRange(*by).sortWithinPartitions(*by).select(*key, "_json")
        packed = _pack_positional(ranged, chunk_rows, key, max_bytes)
        return packed.select(*group_by, F.col("_chunk").alias("chunk"), "n_rows", "value")
    # Each row is serialized once before the shuffle; the aggregate carries (order, json) pairs and the message is
    # the sorted JSON texts joined - the same bytes as to_json of the row array, with smaller aggregation buffers.
    order = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)]
    staged = rows.select(
        *group_by, chunk_by.cast("bigint").alias("chunk"), F.struct(*order, F.to_json(row).alias("_j")).alias("_e")
    )
    packed = staged.groupBy(*group_by, "chunk").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sort_array(F.collect_list("_e")).alias("_es")
    )
    return packed.select(
        *group_by,
        "chunk",
        "n_rows",
        F.concat(F.lit("["), F.array_join(F.col("_es._j"), ","), F.lit("]")).alias("value"),
    )


def _pack_positional(row_json: DataFrame, chunk_rows: int, group_by: list[str], max_bytes: int | None = None) -> DataFrame:
    """Concatenate runs of per-row JSON objects into ``[o1,o2,...]`` messages, one streaming pass per partition.

    Rows are serialized to JSON in the JVM (``to_json``); Python only sees Arrow batches and joins them with
    Arrow's C++ ``binary_join`` over list offsets - no per-row Python, no shuffle, no sort. At most ``chunk_rows``
    rows are carried between batches, so memory per task is bounded. A message never spans two ``group_by``
    values; chunk ids are ``partition_id * 2^33 + message number in the partition``. The bytes equal Spark's
    ``to_json`` of the row array (compact, ``,``-separated).
    """
    out_fields = [row_json.schema[g] for g in group_by] + [
        T.StructField("chunk", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
    out_schema = T.StructType(out_fields)

    def pack(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << _POS_BITS
        seq = 0
        carry: pa.Table | None = None

        def emit(tbl: pa.Table, final: bool):
            nonlocal seq
            n = tbl.num_rows
            if n == 0:
                return None, tbl
            # run starts: a new group value, or every chunk_rows rows inside a run
            if group_by:
                codes = [
                    np.asarray(pc.dictionary_encode(tbl.column(g).combine_chunks()).indices.fill_null(-1))
                    for g in group_by
                ]
                change = np.zeros(n, dtype=bool)
                change[0] = True
                for c in codes:
                    change[1:] |= c[1:] != c[:-1]
                run_id = np.cumsum(change) - 1
                run_start = np.flatnonzero(change)[run_id]
            else:
                run_start = np.zeros(n, dtype=np.int64)
            if max_bytes is None:
                pos_in_run = np.arange(n) - run_start
                starts = np.flatnonzero((pos_in_run % chunk_rows) == 0)
            else:
                # greedy cut on the cumulative size "[" + rows joined by "," + "]"; one loop step per message
                size = np.asarray(pc.binary_length(tbl.column("_json").combine_chunks()).cast(pa.int64())) + 1
                cum = np.concatenate(([0], np.cumsum(size)))
                run_end = np.append(np.flatnonzero(np.diff(run_start) != 0) + 1, n)
                run_end_of = run_end[np.searchsorted(run_end, np.arange(n), side="right")]
                cuts, i = [], 0
                while i < n:
                    cuts.append(i)
                    limit = int(np.searchsorted(cum, cum[i] + max_bytes - 1, side="right")) - 1
                    i = min(i + chunk_rows, int(run_end_of[i]), max(limit, i + 1))
                starts = np.asarray(cuts, dtype=np.int64)
            ends = np.append(starts[1:], n)
            if not final:  # keep the last (possibly incomplete) message for the next batch
                keep_from = starts[-1]
                starts, ends = starts[:-1], ends[:-1]
                rest = tbl.slice(keep_from)
            else:
                rest = None
            if len(starts) == 0:
                return None, rest
            values = tbl.column("_json").combine_chunks()
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]), pa.int32()), values.slice(0, ends[-1]))
            body = pc.binary_join(lists, ",")
            value = pc.binary_join_element_wise(pa.scalar("["), body, pa.scalar("]"), "")
            cols = [tbl.column(g).combine_chunks().take(pa.array(starts)) for g in group_by]
            chunk = pa.array(base + seq + np.arange(len(starts)), pa.int64())
            seq += len(starts)
            n_rows = pa.array(ends - starts, pa.int64())
            out = pa.RecordBatch.from_arrays(cols + [chunk, n_rows, value], names=[*group_by, "chunk", "n_rows", "value"])
            return out, rest

        for batch in batches:
            tbl = pa.Table.from_batches([batch])
            if carry is not None and carry.num_rows:
                tbl = pa.concat_tables([carry, tbl])
            out, carry = emit(tbl, final=False)
            if out is not None:
                yield out
        if carry is not None and carry.num_rows:
            out, _ = emit(carry, final=True)
            if out is not None:
                yield out

    return row_json.mapInArrow(pack, out_schema)


def encode_each(rows: DataFrame, fields: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One message per row: the row as a bare JSON object (``keep`` columns ride along)."""
    fields = list(fields or [c for c in rows.columns if c not in set(keep)])
    return rows.select(*keep, F.to_json(F.struct(*[F.col(f) for f in fields])).alias("value"))


def as_topic_messages(messages: DataFrame, topic: str, partitions: int = 1, id_col: str = "chunk") -> DataFrame:
    """Messages -> Kafka source/sink columns. Partition and offset are derived from a unique message id."""
    mid = F.col(id_col).cast("bigint")
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(mid, F.lit(partitions)).cast("int").alias("partition"),
        F.call_function("div", mid, F.lit(partitions).cast("bigint")).alias("offset"),  # integers: "/" is exact to 2^53 only
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


# ---------------------------------------------------------------------------------------------------------------
# decode
# ---------------------------------------------------------------------------------------------------------------

# JSON value kinds (as reported by schema_of_variant) accepted for each Spark field type.
_KINDS: dict[type, tuple[str, ...]] = {
    T.StringType: ("STRING",),
    T.LongType: ("BIGINT",),
    T.IntegerType: ("BIGINT",),
    T.ShortType: ("BIGINT",),
    T.BooleanType: ("BOOLEAN",),
    T.DoubleType: ("BIGINT", "DOUBLE"),
    T.FloatType: ("BIGINT", "DOUBLE"),
}

REASON_UTF8 = "invalid_utf8"
REASON_SIZE = "too_large"
REASON_JSON = "malformed_json"
REASON_ROW = "bad_row"
# Spark's variant values are limited in size (128 MiB in Spark 4.1); a message that does not parse and is at least
# that large is reported as too large rather than malformed.
VARIANT_LIMIT = 128 * 1024 * 1024


def _field_ok(got: Column, field: T.StructField) -> Column:
    """``got`` is the field's value as a variant (NULL when the key is missing)."""
    kinds = _KINDS.get(type(field.dataType))
    if kinds is not None:
        kind = F.schema_of_variant(got)
        ok = kind.isin(*kinds)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            ok = ok | kind.startswith("DECIMAL")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            ok = ok & F.try_variant_get(got, "$", field.dataType.simpleString()).isNotNull()
    else:
        ok = F.try_variant_get(got, "$", field.dataType.simpleString()).isNotNull()
    if field.nullable:
        ok = got.isNull() | (F.schema_of_variant(got) == "VOID") | ok
    return F.coalesce(ok, F.lit(False))


def default_constraints(schema: T.StructType) -> dict[str, Callable[[Column], Column]]:
    """``level`` holds exactly one character (a Unicode code point); unsigned ids are >= 0."""
    out: dict[str, Callable[[Column], Column]] = {}
    if "level" in schema.fieldNames():
        out["level"] = lambda c: F.char_length(c) == 1
    if "id" in schema.fieldNames():
        out["id"] = lambda c: c >= 0
    return out


def _variant_struct(schema: T.StructType) -> str:
    return "struct<" + ",".join(f"`{f.name}`:variant" for f in schema.fields) + ">"


def _parsed(messages: DataFrame, schema: T.StructType, value_col: str, lineage: Sequence[str]) -> DataFrame:
    """Per message: lineage, ``_null`` (tombstone), ``_wf`` (one JSON value), ``_fs`` (array of per-element field variants).

    Tombstones are not filtered here: a filter on the value would be pushed below the projection that computes
    it and evaluate that expression twice; the generator in the callers emits nothing for them instead. Each
    stage is a separate projection whose outputs are used more than once, so nothing is parsed twice, and each
    element is cut into its fields by one variant-to-struct cast (unknown keys ignored, missing keys NULL).
    """
    v = F.col(value_col).cast("string")
    # Two wrappers: Spark's JSON reader stops after the first complete value, so "X] zz" passes the array
    # wrapper alone. The object wrapper catches it: '{"p":' + v + ',"q":1}' yields q = 1 only if v is one complete
    # value followed by nothing ("X] zz" is a syntax error there, and "X} zz" closes the object before q). It only
    # needs tokenizing, so get_json_object does it without building a second variant.
    as_array = F.try_parse_json(F.concat(F.lit("["), v, F.lit("]")))
    as_object = F.get_json_object(F.concat(F.lit('{"p":'), v, F.lit(',"q":1}')), "$.q") == F.lit("1")
    stage1 = messages.select(
        *lineage,
        F.col(value_col).isNull().alias("_null"),
        F.coalesce(F.is_valid_utf8(v), F.lit(False)).alias("_utf8"),
        (F.octet_length(F.col(value_col)) >= VARIANT_LIMIT).alias("_big"),
        as_array.alias("_a"),
        F.coalesce(as_object, F.lit(False)).alias("_b"),
    )
    x0 = F.try_variant_get(F.col("_a"), "$[0]", "variant")
    single = F.try_variant_get(F.col("_a"), "$[1]", "variant").isNull()  # JSON null is not SQL NULL
    stage2 = stage1.select(*lineage, "_null", "_utf8", "_big", "_b", x0.alias("_x"), single.alias("_single"))
    well_formed = F.col("_utf8") & F.col("_b") & F.col("_x").isNotNull() & F.col("_single")
    # One native cast per message: an array of objects becomes array<struct<field: variant>>, a lone object a
    # one-element array. A message that is neither, and has no rows by position, ends up with a NULL element and fails
    # the row check.
    vstruct = _variant_struct(schema)
    one = F.try_variant_get("_x", "$", vstruct)
    listed = F.transform(F.try_variant_get("_x", "$", "array<variant>"), lambda e: F.coalesce(F.try_variant_get(e, "$", vstruct), _by_position(e, schema)))
    fields = F.when(
        well_formed,
        F.coalesce(
            _all_there(F.try_variant_get("_x", "$", f"array<{vstruct}>")),
            F.when(one.isNotNull(), F.array(one)),
            # rows given as arrays of their values, in any message that the native casts do not take
            _all_there(listed),
            F.array(_by_position(F.col("_x"), schema)),
        ),
    )
    stage3 = stage2.select(*lineage, "_null", "_utf8", "_big", "_x", well_formed.alias("_wf"), fields.alias("_fs"))

    return stage3


def _all_there(a: Column) -> Column:
    """The array if none of its elements is NULL (an element that is no object casts to NULL), else NULL."""
    return F.when(F.forall(a, lambda e: e.isNotNull()), a)


def _by_position(value: Column, schema: T.StructType) -> Column:
    """A row given as a JSON array of exactly its values in field order, as a struct of variants; NULL for anything else."""
    values = F.try_variant_get(value, "$", "array<variant>")
    return F.when(F.size(values) == len(schema.fields), F.struct(*[values[i].alias(f.name) for i, f in enumerate(schema.fields)]))


def _element_ok(fs: Column, schema: T.StructType, constraints: Mapping[str, Callable[[Column], Column]]) -> Column:
    """Does one element (struct of field variants) carry every field with its type and constraints?"""
    ok = fs.isNotNull()
    for f in schema.fields:
        got = fs[f.name]
        ok = ok & _field_ok(got, f)
        if f.name in constraints:
            typed = F.try_variant_get(got, "$", f.dataType.simpleString())
            ok = ok & F.coalesce(constraints[f.name](typed), F.lit(f.nullable))
    return F.coalesce(ok, F.lit(False))


def _checked(
    messages: DataFrame,
    schema: T.StructType,
    constraints: Mapping[str, Callable[[Column], Column]],
    value_col: str,
    lineage: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """``_parsed`` with ``_ok`` and ``_reason`` of the whole message: it is good only if all its elements are."""
    stage3 = _parsed(messages, schema, value_col, [*lineage, *keep])
    rows_ok = F.coalesce(F.forall("_fs", lambda fs: _element_ok(fs, schema, constraints)), F.lit(False))
    stage4 = stage3.select("*", rows_ok.alias("_rows_ok"))
    reason = F.coalesce(_envelope_reason(), F.when(~F.col("_rows_ok"), F.lit(REASON_ROW)))
    return stage4.select(
        *lineage, *keep, "_null", "_x", "_fs", (F.col("_wf") & F.col("_rows_ok")).alias("_ok"), reason.alias("_reason")
    )


def _envelope_reason() -> Column:
    """Why a message is no well-formed JSON value; NULL if it is one."""
    return (
        F.when(~F.col("_utf8"), F.lit(REASON_UTF8))
        .when(~F.col("_wf") & F.col("_big"), F.lit(REASON_SIZE))
        .when(~F.col("_wf"), F.lit(REASON_JSON))
    )


def _typed_rows(schema: T.StructType) -> Column:
    """The validated elements as ``array<struct<typed fields>>`` (one native cast; types were checked before)."""
    typed = "struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in schema.fields) + ">"
    one = F.try_variant_get("_x", "$", typed)
    each = F.transform("_fs", lambda fs: F.struct(*[F.try_variant_get(fs[f.name], "$", f.dataType.simpleString()).alias(f.name) for f in schema.fields]))
    return F.coalesce(_all_there(F.try_variant_get("_x", "$", f"array<{typed}>")), F.when(one.isNotNull(), F.array(one)), each)


def decode_verdicts(
    messages: DataFrame,
    schema: T.StructType = LOG_ENTRY,
    *,
    constraints: Mapping[str, Callable[[Column], Column]] | None = None,
    value_col: str = "value",
    lineage: Sequence[str] = ("topic", "partition", "offset"),
) -> DataFrame:
    """One pass over the messages: a row per decoded element and a row per rejected message.

    Columns: ``*lineage, pos, verdict ('ok' | 'bad'), <schema fields>, reason, value``. Good messages yield one row per
    element (``pos`` = position in the message, ``reason`` and ``value`` NULL); a bad message yields one row with NULL
    fields and its whole payload in ``value``, so nothing is lost when the topic drops it. NULL values (tombstones)
    yield nothing.
    """
    constraints = default_constraints(schema) if constraints is None else constraints
    lineage = [c for c in lineage if c in messages.columns]
    messages = messages.withColumn("_value", F.col(value_col))
    checked = _checked(messages, schema, constraints, value_col, lineage, ["_value"])
    row_type = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
    null_row = F.array(F.lit(None).cast(row_type.elementType))
    rows = (
        F.when(F.col("_null"), F.array().cast(row_type))
        .when(F.col("_ok"), _typed_rows(schema).cast(row_type))
        .otherwise(null_row)
    )
    payload = F.when(~F.col("_ok"), F.col("_value").cast("binary")).alias("_value")
    exploded = checked.select(*lineage, "_ok", "_reason", payload, F.posexplode(rows).alias("_pos", "_r"))
    return exploded.select(
        *lineage,
        F.when(F.col("_ok"), F.col("_pos").cast("int")).alias("pos"),
        F.when(F.col("_ok"), F.lit("ok")).otherwise(F.lit("bad")).alias("verdict"),
        *[F.col("_r")[f.name].alias(f.name) for f in schema.fields],
        F.col("_reason").alias("reason"),
        F.col("_value").alias("value"),
    )


def decode(
    messages: DataFrame,
    schema: T.StructType = LOG_ENTRY,
    *,
    constraints: Mapping[str, Callable[[Column], Column]] | None = None,
    value_col: str = "value",
    lineage: Sequence[str] = ("topic", "partition", "offset"),
) -> DataFrame:
    """Strict decode that fails the job on the first bad message (nothing downstream is committed).

    Returns ``*lineage, pos, <schema fields>``: one row per element, payload order kept in ``pos``.
    """
    constraints = default_constraints(schema) if constraints is None else constraints
    lineage = [c for c in lineage if c in messages.columns]
    parsed = _parsed(messages, schema, value_col, lineage)
    where = F.concat_ws(
        "/", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in lineage]
    ) if lineage else F.lit("?")
    # Elements are checked one by one after the generator, in generated code. A message that is no JSON value yields one
    # NULL element, so that it fails there, too. The check is a filter: no choice of columns can prune it.
    vstruct = _variant_struct(schema)
    els = F.when(F.col("_null"), F.array().cast(f"array<{vstruct}>")).when(F.col("_wf"), F.col("_fs"))
    els = F.coalesce(els, F.array(F.lit(None).cast(vstruct)))
    exploded = parsed.select(*lineage, F.coalesce(_envelope_reason(), F.lit(REASON_ROW)).alias("_reason"), F.posexplode(els).alias("_pos", "_f"))
    failed = F.raise_error(F.concat(F.lit("bad message at "), where, F.lit(": "), F.col("_reason"))).cast("boolean")
    good = exploded.where(F.when(_element_ok(F.col("_f"), schema, constraints), F.lit(True)).otherwise(failed))
    fields = [F.try_variant_get(F.col("_f")[f.name], "$", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return good.select(*lineage, F.col("_pos").cast("int").alias("pos"), *fields)


def split_verdicts(verdicts: DataFrame, schema: T.StructType = LOG_ENTRY) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad messages) views of :func:`decode_verdicts` output. Persist the input if both are used."""
    lineage = [c for c in verdicts.columns if c not in {"pos", "verdict", "reason", "value", *schema.fieldNames()}]
    good = verdicts.where(F.col("verdict") == "ok").select(*lineage, "pos", *schema.fieldNames())
    bad = verdicts.where(F.col("verdict") == "bad").select(*lineage, "reason", "value")
    return good, bad
