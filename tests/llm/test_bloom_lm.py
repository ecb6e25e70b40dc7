"""LM scoring: filter properties, exact base scores, the model against plain counts, both ways to reach the filter."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tracelake.llm import bloom_lm as L


def test_levels():
    n = np.arange(1, 5000)
    q = L.level_of(n)
    assert q[:8].tolist() == [1, 2, 2, 3, 3, 3, 3, 4]
    assert (L.count_of(q) <= n).all() and (2 * L.count_of(q) > n).all() and L.count_of(np.array([0]))[0] == 0


def test_filter_never_underestimates_and_rarely_over():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 40_000).astype(np.uint64)
    level = np.minimum(rng.geometric(0.6, len(h)), 20)
    raw = L.build_filter(h, level)
    bits = int(raw[:8].view("<u8")[0])
    got = L.read_levels(h, bits, 0, raw[8:])
    assert (got >= level).all() and (got == level).mean() > 0.99
    absent = L.read_levels(rng.integers(0, 1 << 63, 40_000).astype(np.uint64), bits, 0, raw[8:])
    assert (absent > 0).mean() < 2 / (1 << L.HASHES)
    assert L.read_levels(h[:0], bits, 0, raw[8:]).tolist() == []


def plain(rows):
    """doc -> (held, tokens, known, N, base, model with exact quantised counts)."""
    train = [r for r in rows if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 != 1]
    tok = lambda t: [*(t or "").encode().lower().split(), None]
    c, pair = Counter(), Counter()
    for r in train:
        w = tok(r[1])
        c.update(w)
        pair.update(zip(["start", *w], w, strict=False))
    n, v = sum(c.values()), len(c)
    out = []
    for r in rows:
        w = tok(r[1])
        p = [(c[x] + 0.5) / (n + 0.5 * (v + 1)) for x in w]
        model = 0.0
        for u, x, q in zip(["start", *w], w, p, strict=False):
            k = pair[u, x]
            ctx = c[None] if u == "start" else c[u]
            model += math.log10((min(2.0 ** (k.bit_length() - 1) if k else 0, ctx, c[x]) + L.MU * q) / (ctx + L.MU))
        held = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 1
        out.append((r[0], held, len(w), sum(c[x] > 0 for x in w), n, sum(map(math.log10, p)), model))
    return out


def table():
    rng = np.random.default_rng(5)
    words = [f"W{i}" for i in range(60)] + ["é", "the", "of"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 80))) + ("\n\tThe end" if i % 3 else "")) for i in range(150)]
    return [*rows, (None, "null id"), (200, None), (201, ""), (202, "the " * 30_000), (203, "same"), (203, "same")]


@pytest.mark.parametrize("limit", [L.BROADCAST_BYTES, 0])
def test_against_plain_counts(spark, limit):
    rows = table()
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id bigint, text string, score double").repartition(3)
    got = sorted(L.score(docs, broadcast_bytes=limit).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    want = sorted(plain(rows), key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert tuple(g)[:5] == w[:5]
        assert math.isclose(g.base_score, w[5], rel_tol=1e-9)
        assert abs(g.score - w[6]) <= 0.02 * abs(w[6]) + 0.5


def test_held_out_texts_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = L.score(docs).where("held_out").groupBy().sum("score", "base_score").first()
    assert r[0] > r[1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert L.score(docs).count() == 0


def test_requests_grow_with_the_corpus_not_with_its_square(spark):
    """Blocks and shards both grow with the input; rows are at most the entries, so they grow as the blocks do."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    rows = {}
    for times in (1, 4, 16):
        docs = spark.range(60 * times, numPartitions=2 * times).select(
            F.col("id").alias("doc_id"), (F.col("id") % 5 == 1).alias("held"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.hash(i * 7, "id").cast("string"))).cast("binary").alias("text")
        )
        blocks = docs.mapInArrow(L._pack(pa.int64()), "block bigint, ids array<bigint>, held array<boolean>, lens binary, data binary")
        asked = blocks.mapInArrow(L._requests((1 << 14) * times, False, True), "shard int, block bigint, h binary, n binary")
        got = asked.agg(F.count("*"), F.sum(F.length("h")) / 8, F.min(F.length("h"))).first()
        assert got[0] <= got[1] and got[2] >= 8
        rows[times] = got[0]
    assert rows[4] <= 4.4 * rows[1] and rows[16] <= 4.2 * rows[4]


def test_many_shards_give_the_same_scores(spark, monkeypatch):
    rows = table()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    some = sorted((tuple(r) for r in L.score(docs).collect()), key=str)
    monkeypatch.setattr(L, "SHARD_BYTES", 16)
    for limit in (L.BROADCAST_BYTES, 0):
        many = sorted((tuple(r) for r in L.score(docs, broadcast_bytes=limit).collect()), key=str)
        assert [m[:6] for m in many] == [s[:6] for s in some]
