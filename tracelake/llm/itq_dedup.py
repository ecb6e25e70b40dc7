"""Embedding near-dedup: iterative quantisation codes, multi-index Hamming tables, rerank with the original vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import ship, stored
from tracelake.llm.components import connected_components, forest

COSINE = 0.95
#: Vectors that the rotations are learned on at most; every vector is coded, indexed and searched.
SAMPLE = 8192
#: Codes have at least ROTATIONS x 64 bits in blocks of BLOCK_BITS; each block is a table, searched within one bit.
ROTATIONS = 2
BLOCK_BITS = 16
#: The tables must find this share of made pairs at COSINE. Where the common direction of the vectors is taken off, such
#: pairs differ in more bits, the more the vectors have in common: then there are more rotations (up to MOST_ROTATIONS), then fewer bits of a block count.
RECALL = 0.98
MOST_ROTATIONS = 8
COUNTED_BITS = (16, 12, 8)
#: Candidates differ in at most so many of the first 64 bits, or more if the made pairs do. A cosine of 0.95 flips 6 or 7
#: on average where the mean of the vectors is near zero.
RADIUS = 18
#: Index rows and query rows of a cell; larger buckets are cut into cells.
CELL = 1024
_POP16 = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


@dataclass
class Coder:
    mean: np.ndarray
    weights: np.ndarray  #: (dimensions, 64 * rotations)
    bits: int = BLOCK_BITS  #: of each block; the others are zero. With none, all vectors meet in one bucket.
    radius: int = RADIUS

    @property
    def tables(self) -> int:
        return self.weights.shape[1] // BLOCK_BITS

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(n, tables) 16-bit blocks of the codes of unit vectors."""
        bits = (unit - self.mean) @ self.weights > 0
        blocks = np.packbits(bits, axis=1).view(">u2").astype(np.uint16)
        return blocks & np.uint16((1 << self.bits) - 1)


def _across(side: np.ndarray, *axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``side`` at right angles to unit vectors (themselves at right angles), of length 1, and which rows have any length."""
    for axis in axes:
        side = side - (side * axis).sum(1)[:, None] * axis
    size = np.sqrt((side * side).sum(1))
    return side / np.maximum(size, 1e-300)[:, None], size > 1e-6


def made_pairs(unit: np.ndarray, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sets of pairs at cosine COSINE: a vector of the sample turned in any direction or one in which the sample differs,
    freely or around the mean. Vectors turned around the mean share as much with it as those of the sample do, which leaves
    the largest angle once the mean is taken off; where no angle is that large, they face each other."""
    x = unit[:2000]
    if unit.shape[1] < 2 or not len(x):
        return []
    mean = unit.mean(0)
    length = np.sqrt(mean @ mean)
    axis = np.broadcast_to(mean / length if length > 1e-9 else np.zeros_like(mean), x.shape)
    along = (x * axis).sum(1)[:, None]
    flat, has = _across(x, axis)
    size2 = np.maximum(1 - along**2, 1e-12)
    turn = np.clip((COSINE - along**2) / size2, -1, 1)
    out = []
    for side in (rng.normal(size=x.shape), unit[rng.integers(len(unit), size=len(x))] - unit[rng.integers(len(unit), size=len(x))]):
        free, some = _across(side, x)
        out.append((x[some], (COSINE * x + np.sqrt(1 - COSINE**2) * free)[some]))
        around, some = _across(side, axis, flat)
        some &= has
        out.append((x[some], (along * axis + np.sqrt(size2) * (turn * flat + np.sqrt(1 - turn**2) * around))[some]))
    return [(a, b) for a, b in out if len(a)]


def learn(unit: np.ndarray, steps: int = 40, seed: int = 7) -> Coder:
    """Principal directions, then for each code an orthogonal rotation that brings the projections close to their signs.

    With fewer than 64 directions, several rotations of them fill the 64 bits. Rotations beyond ROTATIONS are random. The
    number of tables, the counted bits and the radius are the first that find RECALL of the made pairs; if none does, no
    bit counts and every pair of vectors is compared.
    """
    dims = unit.shape[1]
    mean = unit.mean(0) if len(unit) else np.zeros(dims)
    x = unit - mean
    _, vectors = np.linalg.eigh(x.T @ x + 1e-12 * np.eye(dims))
    k = min(64, dims)
    basis = vectors[:, ::-1][:, :k]
    v = x @ basis
    rng = np.random.default_rng(seed)
    per = -(-64 // k)
    columns = []
    for i in range(per * MOST_ROTATIONS):
        r = np.linalg.qr(rng.normal(size=(k, k)))[0]
        for _ in range(steps if i < per * ROTATIONS else 0):
            u, _, wt = np.linalg.svd(np.sign(v @ r).T @ v)
            r = (u @ wt).T
        columns.append(basis @ r)
    codes = [np.concatenate(columns[i * per : (i + 1) * per], axis=1)[:, :64] for i in range(MOST_ROTATIONS)]
    whole = Coder(mean, np.concatenate(codes, axis=1))
    flips = [whole.codes(a) ^ whole.codes(b) for a, b in made_pairs(unit, rng)]
    for bits in COUNTED_BITS:
        d = [_POP16[f & np.uint16((1 << bits) - 1)] for f in flips]
        first = [x[:, : 64 // BLOCK_BITS].sum(1, dtype=np.int64) for x in d]
        radius = max([RADIUS * bits // BLOCK_BITS, *(int(np.quantile(x, 0.998, method="higher")) for x in first)])
        for n in range(ROTATIONS, MOST_ROTATIONS + 1):
            tables = n * 64 // BLOCK_BITS
            if all(((x[:, :tables] <= 1).any(1) & (f <= radius)).mean() >= RECALL for x, f in zip(d, first, strict=True)):
                return Coder(mean, whole.weights[:, : 64 * n], bits, radius)
    return Coder(mean, whole.weights[:, :BLOCK_BITS], 0, 64)


def unit_rows(vectors: list, dims: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors as doubles, which rows are valid): not null, of ``dims`` finite components, not all zero."""
    ok = np.array([v is not None and (dims is None or len(v) == dims) and None not in v for v in vectors], bool)
    x = np.array([v for v, o in zip(vectors, ok, strict=True) if o], float).reshape(int(ok.sum()), -1)
    with np.errstate(all="ignore"):
        size = np.abs(x).max(axis=1, initial=0)
        good = np.isfinite(x).all(axis=1) & (size > 0)
        x = x[good] / size[good, None]
        x = x / np.sqrt((x * x).sum(1))[:, None]
    at = np.flatnonzero(ok)
    valid = np.zeros(len(vectors), bool)
    valid[at[good]] = True
    return x, valid


def _prepare(dims: int):
    """Per row: id, key of the exact vector (null if it links with nothing), unit vector as bytes."""

    def run(batches):
        for batch in batches:
            unit, valid = unit_rows(batch.column(1).to_pylist(), dims)
            vecs = iter([u.tobytes() for u in unit])
            rows = [next(vecs) if ok else None for ok in valid.tolist()]
            keys = [None if r is None else xxhash.xxh3_128_digest(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(rows, pa.binary())], names=["vec_id", "key", "vec"]
            )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def _code_rows(coder: Coder):
    def run(batches):
        for batch in batches:
            blocks = coder.codes(_matrix(batch.column(1))) if batch.num_rows else np.zeros((0, coder.tables), np.uint16)
            code = pa.array([b.tobytes() for b in blocks], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), code], names=["node", "code"])

    return run


def _blocks(column: pa.Array, tables: int) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint16).reshape(len(values), tables)


def _histogram(tables: int):
    def run(batches):
        total = np.zeros((tables, 1 << BLOCK_BITS), np.int64)
        for batch in batches:
            for t, values in enumerate(_blocks(batch.column(1), tables).T):
                total[t] += np.bincount(values, minlength=1 << BLOCK_BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total.ravel()[at])], names=["slot", "n"])

    return run


def bucket_sizes(codes: DataFrame, tables: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index rows, query rows) of every bucket; at most tables x 2^bits counts reach the driver."""
    rows = codes.mapInArrow(_histogram(tables), "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    index = np.zeros(tables << BLOCK_BITS, np.int64)
    index[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    index = index.reshape(tables, -1)[:, : 1 << bits]
    z = np.arange(1 << bits)
    query = index.copy()
    for b in range(bits):
        query += index[:, z ^ (1 << b)]
    return index, query


def _spread(values: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number of the copy) for ``copies`` copies of each row."""
    row = np.repeat(np.arange(len(values)), copies)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)


def _cells(index_sizes: np.ndarray, query_sizes: np.ndarray):
    """Rows (bucket, cell, role, node, code). A code is in one index bucket per table and asks that and the buckets one
    bit away, if any other code can be there. Buckets of over CELL rows are cut both ways; each pair of parts is a cell."""
    parts_i = np.maximum(1, -(-index_sizes // CELL)).astype(np.int64)
    parts_q = np.maximum(1, -(-query_sizes // CELL)).astype(np.int64)
    tables, values = index_sizes.shape
    flips = np.concatenate([[0], 1 << np.arange(values.bit_length() - 1)])

    def run(batches):
        for batch in batches:
            nodes, blocks = batch.column(0).to_numpy(), _blocks(batch.column(1), tables)
            spin = (nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            out: list[list[np.ndarray]] = [[], [], [], []]
            for t in range(tables):
                z = blocks[:, t].astype(np.int64)
                some = np.flatnonzero(query_sizes[t, z] > 1)
                for role, who, at in (
                    (0, some, z[some]),
                    (1, np.repeat(np.arange(len(z)), len(flips)), (z[:, None] ^ flips).ravel()),
                ):
                    if role:
                        has = index_sizes[t, at] - (at == z[who]) > 0
                        who, at = who[has], at[has]
                    own, other = (parts_i, parts_q) if role == 0 else (parts_q, parts_i)
                    mine = (spin[who] % own[t, at].astype(np.uint64)).astype(np.int64)
                    row, number = _spread(who, other[t, at])
                    i, q = (mine[row], number) if role == 0 else (number, mine[row])
                    out[0].append((t << BLOCK_BITS) | at[row])
                    out[1].append((i << 31) | q)
                    out[2].append(np.full(len(row), role, np.int8))
                    out[3].append(who[row])
            who = np.concatenate(out[3])
            table = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(out[0])),
                    pa.array(np.concatenate(out[1])),
                    pa.array(np.concatenate(out[2])),
                    pa.array(nodes[who]),
                    batch.column(1).take(pa.array(who)),
                ],
                names=["bucket", "cell", "role", "node", "code"],
            )
            for at in range(0, table.num_rows, 20_000):
                yield table.slice(at, 20_000)

    return run


def _whole_cells(batches, enough: int = 20_000):
    """Regroup sorted batches so that every one holds whole cells, several small ones together."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < enough:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        bucket, cell = table.column(0).to_numpy(), table.column(1).to_numpy()
        last = np.flatnonzero((bucket != bucket[-1]) | (cell != cell[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
        rows = table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def candidates(a: np.ndarray, b: np.ndarray, table: np.ndarray | int, radius: int) -> np.ndarray:
    """Which pairs of codes (n, tables) are candidates of this table: within the radius on the first code, and in no
    earlier table within one bit (there the pair has been met already)."""
    d = _POP16[a ^ b]
    first = d[..., : 64 // BLOCK_BITS].sum(-1, dtype=np.int16) <= radius
    met = (d <= 1) & (np.arange(d.shape[-1]) < np.asarray(table)[..., None])
    return first & ~met.any(-1)


def _live(tables: int, radius: int):
    """Members of cells that have at least one candidate there."""

    def run(batches):
        for tab in _whole_cells(batches):
            bucket, cell, role = (tab.column(i).to_numpy() for i in range(3))
            node = tab.column(3).to_numpy()
            blocks = _blocks(tab.column(4).combine_chunks(), tables)
            start = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1])]))
            stop = np.append(start[1:], len(bucket))
            split = start + np.add.reduceat(role == 0, start)  # index rows come first
            live = np.zeros(len(bucket), bool)
            pairs = (split - start) * (stop - split)
            at = 0
            while at < len(start):
                upto = at + 1
                total = pairs[at]
                while upto < len(start) and total + pairs[upto] <= 300_000:
                    total += pairs[upto]
                    upto += 1
                if total:
                    s, m, e = start[at:upto], split[at:upto], stop[at:upto]
                    queries = np.concatenate([np.arange(x, y) for x, y in zip(m.tolist(), e.tolist(), strict=True)])
                    group = np.repeat(np.arange(upto - at), e - m)
                    for part in range(0, len(queries), max(1, 300_000 // int((m - s).max()))):
                        q = queries[part : part + max(1, 300_000 // int((m - s).max()))]
                        g = group[part : part + len(q)]
                        row, number = _spread(q, (m - s)[g])
                        qi, ii = q[row], s[g][row] + number
                        hit = candidates(blocks[qi], blocks[ii], bucket[qi] >> BLOCK_BITS, radius) & (node[qi] != node[ii])
                        live[qi[hit]] = True
                        live[ii[hit]] = True
                at = upto
            if live.any():
                yield tab.select([0, 1, 2, 3]).filter(pa.array(live)).combine_chunks().to_batches()[0]

    return run


def _rerank(tables: int, radius: int):
    """Links of the cells by cosine: per query node the number of vectors linked, and a forest of the links."""

    def run(batches):
        names = ["node", "other", "n"]
        for tab in _whole_cells(batches, 4000):
            bucket, cell, role = (tab.column(i).to_numpy() for i in range(3))
            node, copies = tab.column(3).to_numpy(), tab.column(5).to_numpy()
            blocks, unit = _blocks(tab.column(4).combine_chunks(), tables), _matrix(tab.column(6).combine_chunks())
            start = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1])]))
            stop = np.append(start[1:], len(bucket))
            out: list[list[np.ndarray]] = [[], [], []]
            for a, b in zip(start.tolist(), stop.tolist(), strict=True):
                m = a + int((role[a:b] == 0).sum())
                for q in range(m, b, 256):
                    e = min(b, q + 256)
                    link = unit[q:e] @ unit[a:m].T >= COSINE
                    link &= candidates(blocks[q:e, None], blocks[None, a:m], int(bucket[a]) >> BLOCK_BITS, radius)
                    link &= node[q:e, None] != node[None, a:m]
                    y, x = np.nonzero(link)
                    if not len(y):
                        continue
                    n = link @ copies[a:m]
                    some = n > 0
                    u, v = forest(node[q:e][y], node[a:m][x])
                    out[0] += [node[q:e][some], u]
                    out[1] += [node[q:e][some], v]
                    out[2] += [n[some], np.zeros(len(u), np.int64)]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=names)

    return run


def near_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row; links are pairs found with cosine of 0.95 or more in doubles.

    Vectors that are null, zero, or hold null or non-finite components link with nothing: no links, own component. So do,
    if ``dims`` is given, vectors of another number of components. Without it every length is an index of its own, as
    vectors of different lengths have no cosine. Equal vectors are one node with a count. ``component_id`` is the smallest
    id reachable, itself included. Only links, never pairs, leave a cell: a count per vector and a forest, so a group of
    any size costs rows in proportion to its members and to the square of its members in matrix products, which are dealt
    out in cells of at most about CELL x CELL.
    """
    ship(vectors.sparkSession)
    src = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"))
    size = F.when(F.col("v").isNotNull(), F.size("v"))
    sizes = [dims]
    if dims is None:
        sizes = [r["d"] for r in src.groupBy(size.alias("d")).count().where("d > 0 AND count > 1").orderBy("d").collect()]  # one row per length
    found = [_near_dedup(src.where(size == d), d) for d in sizes]
    rest = src.where(~F.coalesce(size.isin(sizes), F.lit(False))) if sizes else src
    found.append(rest.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _near_dedup(src: DataFrame, dims: int) -> DataFrame:
    """(vec_id, n_links, component_id) of vectors of ``dims`` components."""
    kind = src.schema["vec_id"].dataType.simpleString()
    rows = stored(src.mapInArrow(_prepare(dims), f"vec_id {kind}, key binary, vec binary"), "units")
    ok = rows.where("key is not null")
    groups = ok.groupBy("key").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    reps = stored(groups.withColumn("node", F.monotonically_increasing_id()), "vectors")
    picked = reps.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).toArrow()  # of distinct vectors
    coder = learn(_matrix(picked.column(0).combine_chunks()) if picked.num_rows else np.zeros((0, dims)))
    codes = stored(reps.select("node", "vec").mapInArrow(_code_rows(coder), "node bigint, code binary"), "codes")

    order = ["bucket", "cell", "role"]
    cells = codes.mapInArrow(_cells(*bucket_sizes(codes, coder.tables, coder.bits)), "bucket bigint, cell bigint, role tinyint, node bigint, code binary")
    cells = cells.repartition("bucket", "cell").sortWithinPartitions(*order)
    live = stored(cells.mapInArrow(_live(coder.tables, coder.radius), "bucket bigint, cell bigint, role tinyint, node bigint"), "live")
    full = live.join(codes, "node").join(reps.select("node", "copies", "vec"), "node")
    full = full.select(*order, "node", "code", "copies", "vec").repartition("bucket", "cell").sortWithinPartitions(*order)
    links = stored(full.mapInArrow(_rerank(coder.tables, coder.radius), "node bigint, other bigint, n bigint"), "links")

    counts = links.where("n > 0").groupBy("node").agg(F.sum("n").alias("n"))
    roots = connected_components(links.where("n = 0"), "node", "other")
    named = reps.select("key", "node", "low", "copies").join(counts, "node", "left").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of_key = named.join(lowest, "root").select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = ok.select("vec_id", "key").join(stored(of_key, "vector-links"), "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone)
