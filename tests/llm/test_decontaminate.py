"""Benchmark decontamination against brute force over all item-sized windows."""

import random

import pytest

from tracelake.llm import decontaminate as D


def brute(docs, items):
    out = []
    for doc, text in docs:
        words = (text or "").encode().lower().split()
        for item, passage in items:
            want = (passage or "").encode().lower().split()
            if not want:
                continue
            k, best, n = D.shingle_length(len(want)), None, 0
            for a in range(max(0, len(words) - len(want)) + 1):
                s = D.similarity(D.bag(words[a : a + len(want)], k), D.bag(want, k))
                if s >= D.SIMILARITY:
                    n += 1
                    if best is None or s > best[0]:
                        best = (s, a)
            if best:
                out.append((doc, item, round(best[0], 9), best[1], n))
    return sorted(out, key=str)


def tables():
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(n))) for i, n in enumerate([3, 4, 5, 6, 14, 20, 37, 37, 59, 120])]
    items += [(90, None), (91, "  "), (92, items[6][1]), (93, "a a a a a a a a a a a a")]
    docs = []
    for i in range(120):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(0, 150))]
        if i % 2:
            passage = rnd.choice(items)[1] or ""
            part = passage.split()
            if i % 4 == 1 and part:
                part[rnd.choice([0, -1, len(part) // 2])] = "edited"
            cut = rnd.randint(0, len(words))
            words[cut:cut] = [p.upper() for p in part]
        docs.append((i, (" \n\t" if i % 3 else " ").join(words)))
    docs += [(500, None), (501, ""), (502, "a " * 40_000), (503, items[7][1]), (503, items[7][1]), (None, items[8][1]), (504, " ".join(items[8][1].split()[:55]))]
    return docs, items


@pytest.mark.parametrize("each", [4000, 3])
def test_against_brute_force(spark, each, monkeypatch):
    monkeypatch.setattr(D, "ITEMS_EACH_PASS", each)
    docs, items = tables()
    d = spark.createDataFrame([(i, t, "clash", 1.0) for i, t in docs], "doc_id bigint, text string, m string, similarity double")
    b = spark.createDataFrame(items, "item_id int, text string")
    got = sorted(((r.doc_id, r.item_id, round(r.similarity, 9), r.first_word, r.windows) for r in D.contaminated(d, b).collect()), key=str)
    want = brute(docs, items)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert got == want  # every window counts, also beyond the radius
    left = D.decontaminate(d, b)
    assert left.columns == d.columns
    dirty = {w[0] for w in want}
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((i for i, _ in docs if i not in dirty), key=str)


def test_blocks_reach_every_fingerprint_within_the_radius():
    rnd = random.Random(2)
    rows = [(i, " ".join(f"x{rnd.randrange(5000)}" for _ in range(30)).encode()) for i in range(50)]
    g = D.build_index(rows).groups[30]
    import numpy as np

    for i in range(50):
        for _ in range(40):
            bits = np.unpackbits(g.fps[i]).copy()
            bits[rnd.sample(range(64), rnd.randint(0, D.RADIUS))] ^= 1
            fp = np.packbits(bits)
            assert any(g.blocks[b][fp[b], i] for b in range(D.BLOCKS))


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert D.contaminated(d.limit(0), b).count() == 0
    assert D.contaminated(d, b.limit(0)).count() == 0 and D.decontaminate(d, b.limit(0)).count() == 1
    assert D.decontaminate(d, b).count() == 0


@pytest.mark.parametrize("run", ["x", "_"])
def test_long_items_with_a_run_of_one_word(spark, run):
    rnd = random.Random(4)
    items, docs = [], []
    for i, n in enumerate([64, 104, 204, 204, 404, 404]):
        words = [f"w{rnd.randrange(5000)}" for _ in range(n)]
        items.append((i, " ".join(words)))
        m = (n - 4) // 9
        tail = words[: n - m] + [run] * m
        head = [run] * m + words[m:]
        around = [f"o{rnd.randrange(5000)}" for _ in range(60)]
        docs += [(10 * i, " ".join(tail)), (10 * i + 1, " ".join(head)), (10 * i + 2, " ".join(around[:30] + tail + around[30:]))]
    items.append((90, " ".join([run] * 40 + [f"w{rnd.randrange(5000)}" for _ in range(160)])))
    docs += [(900, " ".join(["z"] * 18 + items[-1][1].split()[18:]))]
    want = brute(docs, items)
    assert len(want) == len(docs)
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id int, text string")
    got = sorted(((r.doc_id, r.item_id, round(r.similarity, 9), r.first_word) for r in D.contaminated(d, b).collect()), key=str)
    assert got == sorted((w[:4] for w in want), key=str)
    assert D.decontaminate(d, b).count() == 0


def test_window_fingerprints_number_the_occurrences_in_each_window():
    import numpy as np

    rng = np.random.default_rng(8)
    for n, width, kinds in [(1, 1, 1), (40, 7, 4), (60, 60, 5), (90, 30, 2), (50, 9, 10**6)]:
        h = (rng.integers(0, kinds, n).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        for a, fp in enumerate(D.window_fingerprints(h, width)):
            seen, number = {}, []
            for x in h[a : a + width].tolist():
                number.append(seen.get(x, 0))
                seen[x] = number[-1] + 1
            bits = D.hash_bits(D.numbered(h[a : a + width], np.array(number)))
            assert (fp == np.packbits(2 * bits.sum(0, dtype=np.int64) > width)).all()


def test_many_items_in_one_pass(spark):
    rnd = random.Random(11)
    vocab = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(8, 40)))) for i in range(20_000)]
    docs, want = [], set()
    for i in range(80):
        words = [rnd.choice(vocab) for _ in range(200)]
        for item in rnd.sample(range(20_000), 3):
            part = items[item][1].split()
            if len(part) >= 30:
                part[0] = "edited"
            at = rnd.randint(0, len(words))
            words[at:at] = part
            want.add((i, item))
        docs.append((i, " ".join(words)))
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id int, text string")
    found = D.contaminated(d, b)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    got = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
    near = {k for k in got if k not in want}
    assert want - set(got) <= {(i, j) for i, j in want if " ".join(items[j][1].split()[1:]) not in docs[i][1]}  # a later passage may cut one
    assert len(near) == 0 and len(got) > 200 and all(s >= 0.8 for s in got.values())


def test_radius_loses_nothing(monkeypatch):
    docs, items = tables()
    rows = [(i, t.encode()) for i, t in items if t]
    texts = [(t or "").encode() for _, t in docs]
    every = D.find_matches(D.build_index(rows), texts)
    monkeypatch.setattr(D, "RADIUS", 0)
    assert D.find_matches(D.build_index(rows), texts) == every
