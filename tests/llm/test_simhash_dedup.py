"""SimHash near-dedup: code properties, fingerprints and components against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tracelake.llm import simhash_dedup as S


def test_golay_words_within_two_bits_share_a_code_word():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 1 << 23, 4000).astype(np.uint32)
    flips = [0] + [1 << a for a in range(23)] + [1 << a | 1 << b for a, b in combinations(range(23), 2)]
    ix, okx = S.golay_indices(x)
    for f in flips:
        iy, oky = S.golay_indices(x ^ np.uint32(f))
        same = (ix[:, :, None] == iy[:, None, :]) & okx[:, :, None] & oky[:, None, :]
        assert same.any((1, 2)).all()
    counts = okx.sum(1)
    assert set(counts.tolist()) == {1, 6}


def test_fuzzy_keys_meet_for_all_links():
    rnd = np.random.default_rng(2)
    x = rnd.integers(0, 1 << 63, 300).astype(np.uint64)
    for a, b in [(0, 0), *combinations(range(64), 2)]:
        y = x ^ np.uint64(0 if a == b else (1 << a) | (1 << b))
        rx, kx = S.fuzzy_keys(x)
        ry, ky = S.fuzzy_keys(y)
        sx = set(zip(rx.tolist(), kx.tolist(), strict=True))
        met = {r for r, k in zip(ry.tolist(), ky.tolist(), strict=True) if (r, k) in sx}
        assert len(met) == 300
        if a > 8:
            break


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_equals_spark_hash(spark):
    for text in ("", "  ", "One", "one two", "A b C", "A b C d", "é ö a\x0bB\x0c c", "w " * 5000):
        assert S.fingerprint(text.encode()) == brute_fp(text)
    assert spark.sql("select xxhash64('a b c')").first()[0] == xxhash.xxh64_intdigest(b"a b c", 42) - (
        1 << 64 if xxhash.xxh64_intdigest(b"a b c", 42) >> 63 else 0
    )


def brute_components(rows):
    fps = [brute_fp(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            label[find(j)] = find(i)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return fps, [low.get(find(i)) for i in range(len(rows))], [find(i) for i in range(len(rows))]


def doc_rows():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(40):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(1, 400))]
        rows += [" ".join(base)] * rnd.randint(1, 4)
        for _ in range(rnd.randint(0, 6)):
            edit = list(base)
            edit[rnd.randrange(len(edit))] = rnd.choice(vocab)
            rows.append(" ".join(edit).upper())
            base = edit
    rows += ["", None, " ", "x " * 20_000]
    rnd.shuffle(rows)
    out = [(i + 1, t, "fp", 0) for i, t in enumerate(rows)]
    return [*out, (None, rows[0], "a", 1), (None, "nowhere else at all", "b", 2), (None, "nowhere else at all", "b", 2), out[3]]


@pytest.mark.parametrize("bucket", [1, 64])
def test_components_against_brute_force(spark, bucket, monkeypatch):
    monkeypatch.setattr(S, "PAIR_BUCKET", bucket)
    rows = doc_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, component_id int")
    marks = S.near_dedup(docs)
    fps, comps, roots = brute_components(rows)
    want = sorted(((r[0], f, c) for r, f, c in zip(rows, fps, comps, strict=True)), key=str)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in marks.collect()), key=str)
    assert got == want
    left = S.representatives(docs, marks).collect()
    assert len(left) == len(set(roots))
    named = {c for c in comps if c is not None}
    assert {r.doc_id for r in left if r.doc_id is not None} == named
    assert left[0].__fields__ == ["doc_id", "text", "fp", "component_id"]


def test_long_chain_and_hub(spark):
    chain, x = [], 0
    for i in range(60):
        x ^= (1 << (i % 32)) | (1 << (32 + i % 31))
        chain.append(x)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in chain], "fp bigint")
    links = S.fingerprint_links(df)
    from tracelake.llm.components import connected_components

    roots = {r.root for r in connected_components(links).collect()}
    assert len(roots) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    marks = S.near_dedup(docs)
    assert marks.count() == 0 and S.representatives(docs, marks).count() == 0
