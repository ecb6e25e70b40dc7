"""SimHash near-dedup: Golay-code fuzzy keys on fingerprint segments, joined and verified."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import as_bytes, byte_slices, ship, stored
from tracelake.llm.components import connected_components

#: Generator polynomial of the binary (23,12) Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY = 0b110001110101
#: Segments of a fingerprint from the low end: first bit, width. Each fits a 23-bit code word.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: (exact segment, fuzzy segment) of each family of keys.
FAMILIES = ((0, 1), (1, 2), (2, 0))
#: Largest bucket whose pairs are compared; larger ones meet through one-bit neighbours.
PAIR_BUCKET = 64
MAX_BITS = 2


def _bit_sums(digests: bytes) -> np.ndarray:
    """Per bit (high bit first), in how many of the 8-byte big-endian hashes it is set."""
    h = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for i in range(0, len(h), 65_536):
        total += np.unpackbits(h[i : i + 65_536], axis=1).sum(0, dtype=np.int64)
    return total


def fingerprint(text: bytes, words_each: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= words_each:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_each)), strict=False))
    digest = xxhash.xxh64_digest
    digests = b"".join([digest(s, 42) for s in shingles])
    bits = _bit_sums(digests) * 2 > len(digests) // 8
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(words_each: int = 3):
    """Arrow UDF: UTF-8 bytes -> fingerprint as a signed bigint."""

    @F.arrow_udf("bigint")
    def run(text: pa.Array) -> pa.Array:
        out = []
        for part in byte_slices(text):
            out += [fingerprint(t, words_each) for t in part.to_pylist()]
        return pa.array(np.array(out, np.uint64).view(np.int64))

    return run


def _remainder(x: int) -> int:
    for bit in range(22, 10, -1):
        if x >> bit & 1:
            x ^= GOLAY << bit - 11
    return x


@lru_cache(1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(syndromes of the low 12 and of the high 11 bits, per syndrome the 6 error patterns, 0xFFFFFFFF for none).

    A word's patterns lead to every code word at distance 4 or less: one if its nearest is within 2, else six. Two words
    that differ in at most two bits always have a code word in common among theirs.
    """
    low = np.array([_remainder(x) for x in range(1 << 12)], np.uint32)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], np.uint32)
    single = [_remainder(1 << b) for b in range(23)]
    near: dict[int, list[int]] = {}
    weight: dict[int, int] = {}
    for w in range(5):
        for bits in combinations(range(23), w):
            s, pattern = 0, 0
            for b in bits:
                s ^= single[b]
                pattern |= 1 << b
            if w <= 3:
                weight[s] = w
                near[s] = [pattern]
            elif weight[s] == 3:
                near[s].append(pattern)
    table = np.full((1 << 11, 6), 0xFFFFFFFF, np.uint32)
    for s, patterns in near.items():
        table[s, : len(patterns)] = patterns
    return low, high, table


def golay_indices(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of code word, is there one) for up to six code words near each 23-bit word; shapes (n, 6)."""
    low, high, table = golay_tables()
    x = x.astype(np.uint32)
    flips = table[low[x & 0xFFF] ^ high[x >> 12]]
    return (x[:, None] ^ flips) >> 11, flips != 0xFFFFFFFF


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of the fingerprints (uint64).

    At most two differing bits over three segments leave one segment equal; that segment's bits and a Golay index of
    the next segment, which differs in two bits at most, make a key that both fingerprints have.
    """
    seg = [(fp >> np.uint64(a)) & np.uint64((1 << w) - 1) for a, w in SEGMENTS]
    rows, keys = [], []
    for family, (exact, fuzzy) in enumerate(FAMILIES):
        idx, ok = golay_indices(seg[fuzzy])
        r, c = np.nonzero(ok)
        rows.append(r)
        keys.append((family << 34) | (seg[exact][r].astype(np.int64) << 12) | idx[r, c].astype(np.int64))
    return np.concatenate(rows), np.concatenate(keys)


def _keys(batches):
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        r, k = fuzzy_keys(fp)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(fp.view(np.int64)[r])], names=["key", "fp"])


def _balls(batches):
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        z = (fp[:, None] ^ flips).ravel().view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(z), pa.array(np.repeat(fp.view(np.int64), 65))], names=["z", "fp"])


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of column ``fp``; components equal those of all links.

    Every edge joins two fingerprints with at most two differing bits. Buckets of up to ``PAIR_BUCKET`` members compare
    their pairs. For members of larger ones, two fingerprints differ in at most two bits exactly if some word is
    within one bit of both: each is sent to its 65 such words, and a word links all it meets to the smallest, so a
    group of any size costs rows in proportion to its members.
    """
    ship(fps.sparkSession)
    keys = stored(fps.select("fp").mapInArrow(_keys, "key bigint, fp bigint"), "golay")
    sizes = keys.groupBy("key").count().where("count > 1")
    near = stored(keys.join(sizes, "key"), "buckets")
    few = near.where(F.col("count") <= PAIR_BUCKET)
    x, y = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    pairs = x.join(y, "key").where(F.col("a") < F.col("b")).where(close).select("a", "b")
    hot = near.where(F.col("count") > PAIR_BUCKET).select("fp").distinct()
    met = hot.mapInArrow(_balls, "z bigint, fp bigint")
    least = met.groupBy("z").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = met.join(least, "z").select(F.col("fp").alias("a"), "b").where(F.col("a") != F.col("b")).where(close)
    return pairs.unionByName(stars.distinct())


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 3) -> DataFrame:
    """(doc_id, body, fp, component_id, kept) per row of ``docs``; fp is the fingerprint as a signed bigint.

    Fingerprints of at most ``MAX_BITS`` differing bits link; ``component_id`` is the smallest id reachable, itself
    included (null if no row of the component has an id). ``body`` is the text's 64-bit hash; ``kept`` marks the row that
    stands for the component: the smallest id, then the smallest body (rows equal in both are all marked). Null and
    wordless texts have fingerprint zero. Copies meet in one distinct fingerprint before any key is made. Other
    columns are not read.
    """
    ship(docs.sparkSession)
    src = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(as_bytes(text_col)).alias("body"),
        fingerprints(words_each)(as_bytes(text_col)).alias("fp"),
    )
    marks = stored(src, "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "body")
    fps = marks.groupBy("fp").agg(F.min("doc_id").alias("low"), F.min(first).alias("first"))
    roots = connected_components(fingerprint_links(fps))
    labelled = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "low", "first", F.coalesce("root", "fp").alias("root"))
    lowest = labelled.groupBy("root").agg(F.min("low").alias("component_id"), F.min("first").alias("stays"))
    of_fp = stored(labelled.join(lowest, "root").select("fp", "component_id", "stays"), "components")
    kept = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("body") == F.col("stays.body"))
    return marks.join(of_fp, "fp").select("doc_id", "body", "fp", "component_id", kept.alias("kept"))


def representatives(docs: DataFrame, marks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component of ``near_dedup``, with its columns; of rows equal in id and text one stays."""
    stay = marks.where("kept").select(F.col("doc_id").alias("__id"), F.col("body").alias("__stay"))
    named = docs.withColumn("__body", F.xxhash64(as_bytes(text_col)))
    on = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__body") == F.col("__stay"))
    return named.join(stay, on, "left_semi").dropDuplicates([id_col, "__body"]).select(*docs.columns)
