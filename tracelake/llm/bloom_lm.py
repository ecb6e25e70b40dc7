"""LM scoring: a log-frequency Bloom filter of quantised bigram counts, probed level by level.

The corpus is packed into blocks. A block asks for the counts of its own distinct words through sorted hash arrays that
are cut into shards of the hash range, so what moves is one entry per block and distinct word or bigram, not one per
token. Words and bigrams are known by 64-bit hashes: among a billion distinct words a false merger has a chance of 3 %.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import as_bytes, byte_slices, ship, stored
from tracelake.llm.words import mixed, split_words

#: Text bytes of a block (one longer text is a block of its own), and of the corpus for each shard of the hash range.
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20
#: The filter is broadcast up to this size; beyond it, blocks get their bigrams' levels through the shuffle.
BROADCAST_BYTES = 256 << 20
#: Hash functions of the filter: an absent level is taken for present once in 2^HASHES probes.
HASHES = 8
LEVELS = 40
#: Strength of the word distribution in that of a word's followers (Dirichlet smoothing).
MU = 2000.0
END = np.uint64(0x5EED0FE11D0C5001)
START = np.uint64(0xB0155A11D0C50003)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def level_of(count: np.ndarray) -> np.ndarray:
    """Quantised count: 1 for 1, 2 for 2 and 3, 3 for 4 to 7 and so on."""
    return np.frexp(count.astype(float))[1].astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """The smallest count of a level (0 for 0), so that estimates of a word's followers add up to its own count at most."""
    return np.where(level > 0, 2.0 ** (np.maximum(level, 1) - 1), 0.0)


def _probes(h: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(first position, step) of the HASHES positions of (hash, level), as fractions of 2^64."""
    a = mixed(h + np.uint64(level * int(_A) & 0xFFFFFFFFFFFFFFFF))
    return a, mixed(a ^ _B)


def _place(a: np.ndarray, bits: np.ndarray | int) -> np.ndarray:
    """Fractions of 2^64 as bit numbers in filters of ``bits`` bits (under 2^32)."""
    return ((a >> np.uint64(32)) * np.asarray(bits, np.uint64)) >> np.uint64(32)


def build_filter(h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Bits (packed bytes) that hold levels 1 to ``level`` of every distinct hash."""
    bits = int(max(64, np.ceil(level.sum() * HASHES / np.log(2))))
    if bits >= 1 << 32:
        raise ValueError("a shard is too large: lower SHARD_BYTES")
    flags = np.zeros(bits, bool)
    for k in range(1, int(level.max(initial=0)) + 1):
        a, step = _probes(h[level >= k], k)
        for _ in range(HASHES):
            flags[_place(a, bits)] = True
            a = a + step
    return np.concatenate([np.array([bits], "<u8").view(np.uint8), np.packbits(flags, bitorder="little")])


def read_levels(h: np.ndarray, bits: np.ndarray | int, base: np.ndarray | int, data: np.ndarray) -> np.ndarray:
    """Level of each hash: levels are asked for upwards until one is absent. ``base``: first byte of the hash's filter."""
    out = np.zeros(len(h), np.uint8)
    left = np.arange(len(h))
    bits, base = np.broadcast_to(bits, len(h)), np.broadcast_to(base, len(h))
    for k in range(1, LEVELS + 1):
        a, step = _probes(h[left], k)
        for _ in range(HASHES):
            at = _place(a, bits[left])
            has = data[base[left] + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0
            left, a, step = left[has], a[has] + step[has], step[has]
        if not len(left):
            break
        out[left] = k
    return out


@dataclass
class Tokens:
    hash: np.ndarray  #: uint64 per token, an END after each text
    pair: np.ndarray  #: uint64 per token, with the one before (START first)
    first: np.ndarray  #: per text, its first token; one more entry at the end


def tokens_of(texts: list[bytes]) -> Tokens:
    hashes, counts = [], []
    for part in byte_slices(pa.array(texts, pa.large_binary()), 1 << 20):
        w = split_words(part.to_pylist())
        n = np.diff(w.first)
        doc = np.repeat(np.arange(len(n)), n)
        t = np.full(len(w.hash) + len(n), END)
        t[np.arange(len(w.hash)) + doc] = w.hash
        hashes.append(t)
        counts.append(n + 1)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    first = np.concatenate([[0], np.cumsum(np.concatenate(counts) if counts else [])]).astype(np.int64)
    before = np.concatenate([[START], h[:-1]]) if len(h) else h
    before[first[:-1]] = START
    return Tokens(h, mixed(before * _B + h * _C), first)


def _pack(kind_id: pa.DataType):
    """Rows of blocks: number, ids, which are held out, the texts' lengths and their compressed bytes."""

    def row(block, ids, held, texts):
        joined = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
        lens = np.array([len(t) for t in texts], "<i8").tobytes()
        cols = [pa.array([block], pa.int64()), pa.array([ids], pa.list_(kind_id)), pa.array([held], pa.list_(pa.bool_())), pa.array([lens], pa.binary()), pa.array([joined], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["block", "ids", "held", "lens", "data"])

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            for i, out, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if texts and size + len(t) > BLOCK_BYTES:
                    yield row(block, ids, held, texts)
                    block, ids, held, texts, size = block + 1, [], [], [], 0
                ids.append(i)
                held.append(out)
                texts.append(t)
                size += len(t)
        if texts:
            yield row(block, ids, held, texts)

    return run


def _unpack(lens: bytes, data: bytes) -> list[bytes]:
    sizes = np.frombuffer(lens, "<i8")
    joined = zstandard.ZstdDecompressor().decompress(data, max_output_size=int(sizes.sum()) or 1) if sizes.sum() else b""
    ends = np.cumsum(sizes)
    return [joined[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def _by_shard(h: np.ndarray, shards: int) -> np.ndarray:
    """Bounds of the shards in a sorted array of hashes."""
    edges = (np.arange(1, shards, dtype=np.uint64)) << np.uint64(64 - (shards.bit_length() - 1))
    return np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])


def _distinct(h: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes, occurrences in training)."""
    u, inverse = np.unique(h, return_inverse=True)
    return u, np.bincount(inverse[train], minlength=len(u)).astype(np.uint32)


def _requests(shards: int, pairs: bool, all_texts: bool):
    """Rows (shard, block, hashes, counts) of the distinct words or bigrams of each block, or of its training texts.

    Shards in which a block has none get no row, so a block makes at most one row per entry however many shards there are.
    """

    def run(batches):
        for batch in batches:
            for block, held, lens, data in zip(*(batch.column(n).to_pylist() for n in ("block", "held", "lens", "data")), strict=True):
                t = tokens_of(_unpack(lens, data))
                train = np.repeat(~np.array(held, bool), np.diff(t.first))
                h = t.pair if pairs else t.hash
                if not all_texts:
                    h, train = h[train], train[train]
                u, n = _distinct(h, train)
                cut = _by_shard(u, shards)
                some = np.flatnonzero(np.diff(cut))
                spans = list(zip(cut[some].tolist(), cut[some + 1].tolist(), strict=True))
                # most counts are one: a byte each, larger ones in full behind them
                small = np.minimum(n, 255).astype(np.uint8)
                counts = [small[a:b].tobytes() + n[a:b][n[a:b] >= 255].tobytes() for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some.astype(np.int32)),
                        pa.array(np.full(len(some), block, np.int64)),
                        pa.array([u[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array(counts, pa.binary()),
                    ],
                    names=["shard", "block", "h", "n"],
                )

    return run


def _read_counts(raw: bytes, size: int) -> np.ndarray:
    n = np.frombuffer(raw, np.uint8, size).astype(np.int64)
    n[n == 255] = np.frombuffer(raw, np.uint32, offset=size)
    return n


def _shard_groups(batches):
    """(shard, [(block, hashes, counts)]) of batches sorted by shard."""
    cur, rows = None, []
    for batch in batches:
        for shard, block, h, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard != cur:
                if rows:
                    yield cur, rows
                cur, rows = shard, []
            hashes = np.frombuffer(h, np.uint64)
            rows.append((block, hashes, _read_counts(n, len(hashes))))
    if rows:
        yield cur, rows


def _totals(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, total counts, place of every entry of the rows among them)."""
    u, inverse = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
    n = np.concatenate([r[2] for r in rows])
    return u, np.bincount(inverse, weights=n, minlength=len(u)).astype(np.int64), inverse


def _answer(batches):
    """Rows (block, shard, counts of the block's entries); on a shard's first row also its sum and number of trained entries."""
    for shard, rows in _shard_groups(batches):
        u, total, inverse = _totals(rows)
        each = total[inverse]
        ends = np.cumsum([len(r[1]) for r in rows])
        parts = [each[b - len(r[1]) : b].tobytes() for r, b in zip(rows, ends.tolist(), strict=True)]
        blocks, none = [r[0] for r in rows], [None] * (len(rows) - 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(blocks, pa.int64()),
                pa.array(np.full(len(blocks), shard, np.int32)),
                pa.array(parts, pa.binary()),
                pa.array([int(total.sum()), *none], pa.int64()),
                pa.array([int((total > 0).sum()), *none], pa.int64()),
            ],
            names=["block", "shard", "data", "n", "v"],
        )


def _filters(batches):
    """Rows (shard, filter) with the quantised counts of the shard's bigrams."""
    for shard, rows in _shard_groups(batches):
        u, total, _ = _totals(rows)
        bits = build_filter(u[total > 0], level_of(total[total > 0]))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["shard", "data"])


def _probe_shards(batches):
    """Rows sorted by (shard, block), the filter of a shard at block -1 -> rows (block, shard, levels)."""
    bits, data = 0, np.zeros(0, np.uint8)
    for batch in batches:
        for shard, block, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block < 0:
                bits, data = int(np.frombuffer(raw, "<u8", 1)[0]), np.frombuffer(raw, np.uint8, offset=8)
                continue
            levels = read_levels(np.frombuffer(raw, np.uint64), bits, 0, data)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([shard], pa.int32()), pa.array([levels.tobytes()], pa.binary())], names=["block", "shard", "data"]
            )


class Filter:
    """All shards of a filter side by side."""

    def __init__(self, parts: list):
        """parts: the filter of each shard, as bytes or buffers."""
        self.bits = np.array([np.frombuffer(p, "<u8", 1)[0] for p in parts], np.uint64)
        sizes = np.array([memoryview(p).nbytes - 8 for p in parts])
        self.base = (np.cumsum(sizes) - sizes).astype(np.int64)
        self.data = np.concatenate([np.frombuffer(p, np.uint8, offset=8) for p in parts])

    def levels(self, h: np.ndarray) -> np.ndarray:
        shard = (h >> np.uint64(64 - (len(self.bits).bit_length() - 1))).astype(np.int64)
        return read_levels(h, self.bits[shard], self.base[shard], self.data)


def score_block(t: Tokens, counts: np.ndarray, pair_levels: np.ndarray, n: int, v: int, mu: float = MU):
    """Per text: (tokens, known tokens, base log10, model log10). counts, pair_levels: per token.

    The model is p(w | u) = (c'(u w) + mu p(w)) / (c(u) + mu): c' from the filter, at most c(u) and c(w); p(w) is the
    smoothed share of the word and c(u) its count, of START the number of texts.
    """
    p = (counts + 0.5) / (n + 0.5 * (v + 1))
    cut = t.first[:-1]
    ends = counts[t.first[1:] - 1]
    before = np.concatenate([[0], counts[:-1]])
    before[cut] = ends
    both = np.minimum(count_of(pair_levels), np.minimum(before, counts))
    model = (both + mu * p) / (before + mu)
    size = np.diff(t.first)
    known = np.add.reduceat((counts > 0).astype(np.int64), cut)
    return size, known, np.add.reduceat(np.log10(p), cut), np.add.reduceat(np.log10(model), cut)


def _score(kind_id: pa.DataType, n: int, v: int, mu: float, held_filter):
    """Rows of one block together: its word counts, maybe its bigram levels, then its texts."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def run(batches):
        filt = held_filter.value if held_filter is not None else None
        counts, levels = [], []
        for batch in batches:
            for i, role in enumerate(batch.column("role").to_pylist()):
                ids, held, lens, data = (batch.column(c)[i].as_py() for c in ("ids", "held", "lens", "data"))
                if role < 2:
                    (counts if role == 0 else levels).append(data)
                    continue
                t = tokens_of(_unpack(lens, data))
                _, inverse = np.unique(t.hash, return_inverse=True)
                c = np.frombuffer(b"".join(counts), np.int64)[inverse]
                pairs, at = np.unique(t.pair, return_inverse=True)
                level = filt.levels(pairs) if filt is not None else np.frombuffer(b"".join(levels), np.uint8)
                size, known, base, model = score_block(t, c, level[at], n, v, mu)
                counts, levels = [], []
                cols = [pa.array(ids, kind_id), pa.array(held, pa.bool_()), pa.array(size), pa.array(known), pa.array(base), pa.array(model)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, fold: int = 1, mu: float = MU,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; null text counts as empty.

    Learns from rows whose crc32(id as text) mod ``folds`` is not ``fold`` (a null id counts as empty text). Words are
    split at ASCII white space with A-Z lower-cased; a text's end is a token. ``base_score`` uses exact counts;
    ``score`` the filter. The filter is broadcast if it has at most ``broadcast_bytes``; else every block's bigrams
    are looked up in the shards they belong to and the levels come back through a shuffle, with the same result.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    ship(spark)
    out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold
    src = docs.select(F.col(id_col).alias("doc_id"), out.alias("held"), as_bytes(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType
    name = kind.simpleString()
    layout = f"block bigint, ids array<{name}>, held array<boolean>, lens binary, data binary"
    blocks = stored(src.mapInArrow(_pack(to_arrow_type(kind)), layout), "lm-blocks")
    size = blocks.agg(F.count("*"), F.coalesce(F.sum(F.length("data")), F.lit(0))).first()
    shards = 1 << max(2, int(3 * size[1] // SHARD_BYTES).bit_length())
    parts = max(1, -(-size[0] // 2))  # two blocks a task, so that what a task holds stays small

    asked = "shard int, block bigint, h binary, n binary"
    words = blocks.mapInArrow(_requests(shards, False, True), asked).repartition("shard").sortWithinPartitions("shard")
    answers = stored(words.mapInArrow(_answer, "block bigint, shard int, data binary, n bigint, v bigint"), "lm-counts")
    n, v = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v")]).first()

    pairs = blocks.mapInArrow(_requests(shards, True, False), asked).repartition("shard").sortWithinPartitions("shard")
    filters = stored(pairs.mapInArrow(_filters, "shard int, data binary"), "lm-filter")
    total = filters.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]
    none = F.lit(None)
    blank = [none.cast(f"array<{name}>").alias("ids"), none.cast("array<boolean>").alias("held"), none.cast("binary").alias("lens")]
    rows = blocks.select("block", F.lit(2).alias("role"), F.lit(0).alias("shard"), "ids", "held", "lens", "data")
    rows = rows.unionByName(answers.select("block", F.lit(0).alias("role"), "shard", *blank, "data"))
    shared = None
    if total <= broadcast_bytes:
        table = filters.toArrow()  # at most broadcast_bytes; the shards are views of it until they are joined
        got = {s: d.as_buffer() for s, d in zip(table.column("shard").to_pylist(), table.column("data"), strict=True)}
        empty = build_filter(np.zeros(0, np.uint64), np.zeros(0, np.int64)).tobytes()
        whole = Filter([got.get(s, empty) for s in range(shards)])
        del table, got
        shared = spark.sparkContext.broadcast(whole)
    else:
        every = blocks.mapInArrow(_requests(shards, True, True), asked).select("shard", "block", F.col("h").alias("data"))
        both = every.unionByName(filters.select("shard", F.lit(-1).cast("bigint").alias("block"), "data"))
        both = both.repartition("shard").sortWithinPartitions("shard", "block")
        found = both.mapInArrow(_probe_shards, "block bigint, shard int, data binary")
        rows = rows.unionByName(found.select("block", F.lit(1).alias("role"), "shard", *blank, "data"))
    rows = rows.repartition(parts, "block").sortWithinPartitions("block", "role", "shard")
    result = f"doc_id {name}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = rows.mapInArrow(_score(to_arrow_type(kind), n, v, mu, shared), result)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")
