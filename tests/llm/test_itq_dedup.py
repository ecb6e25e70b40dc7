"""Embedding near-dedup against brute force: recall, counts, components, hot groups cut into cells, invalid vectors."""

import numpy as np
import pytest

from tracelake.llm import itq_dedup as I


def brute(ids, vecs, dims):
    unit, ok = I.unit_rows(vecs, dims)
    link = np.zeros((len(ids), len(ids)), bool)
    at = np.flatnonzero(ok)
    link[np.ix_(at, at)] = unit @ unit.T >= I.COSINE
    np.fill_diagonal(link, False)
    label = np.arange(len(ids))
    while True:
        new = np.array([min(label[i], *(label[j] for j in np.flatnonzero(link[i])), label[i]) for i in range(len(ids))])
        if np.array_equal(new, label):
            break
        label = new
    return link, [min(ids[j] for j in np.flatnonzero(label == label[i])) for i in range(len(ids))]


def made(n=600, dims=64, group=150, noise=0.012, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[:group] = rng.normal(size=dims) + rng.normal(size=(group, dims)) * noise * 8
    x[group : group + 40 : 2] = x[group + 1 : group + 41 : 2] * 3
    x[n - 30 :] = x[n - 31]
    return x.astype(np.float32).tolist()


@pytest.mark.parametrize(("cell", "dims"), [(1024, 64), (16, 64), (64, 20)])
def test_against_brute_force(spark, cell, dims, monkeypatch):
    monkeypatch.setattr(I, "CELL", cell)
    vecs = made(dims=dims)
    ids = list(range(100, 100 + len(vecs)))
    df = spark.createDataFrame(list(zip(ids, vecs, strict=True)), "vec_id bigint, embedding array<float>").repartition(3)
    link, comp = brute(ids, vecs, dims)
    got = {r.vec_id: r for r in I.near_dedup(df).collect()}
    assert len(got) == len(ids)
    want = link.sum(1)
    n = np.array([got[i].n_links for i in ids])
    assert (n <= want).all() and n.sum() >= 0.97 * want.sum()
    assert np.mean([got[i].component_id == c for i, c in zip(ids, comp, strict=True)]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_recall_on_the_driver_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    ids, vecs = [r.vec_id for r in rows], [r.embedding for r in rows]
    link, comp = brute(ids, vecs, 64)
    got = {r.vec_id: r for r in I.near_dedup(df).collect()}
    n = np.array([got[i].n_links for i in ids])
    assert n.sum() >= 0.95 * link.sum() and (n <= link.sum(1)).all()
    assert np.mean([got[i].component_id == c for i, c in zip(ids, comp, strict=True)]) > 0.99


def test_edge_rows(spark):
    v, nan = [1.0] * 64, float("nan")
    rows = [(1, v, 0), (2, [2.0] * 64, 0), (3, None, 1), (4, [0.0] * 64, 1), (5, [*v[:-1], nan], 1), (6, [*v[:-1], None], 1), (7, [1.0] * 3, 1), (8, [], 1), (9, v, 0), (9, v, 0), (None, v, 0), (None, None, 0), (10, [float("inf")] * 64, 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n_links int")
    got = sorted((tuple(r) for r in I.near_dedup(df).collect()), key=str)
    one = [(i, 4, 1, i == 1) for i in (1, 2, 9, 9, None)]
    none = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 10, None)]
    assert got == sorted(one + none, key=str)
    assert I.near_dedup(df.limit(0)).count() == 0


def offset_pairs(n, dims, mean_cosine, seed=5):
    """``n`` vectors with a common direction, and of each one a partner at a cosine between 0.95 and 0.97."""
    rng = np.random.default_rng(seed)
    common = rng.normal(size=dims)
    x = np.sqrt(mean_cosine) * common / np.linalg.norm(common) + np.sqrt((1 - mean_cosine) / dims) * rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    c = rng.uniform(0.9501, 0.97, size=(n, 1))
    return np.concatenate([x, c * x + np.sqrt(1 - c * c) * side])


@pytest.mark.parametrize(("mean_cosine", "dims"), [(0.0, 64), (0.7, 64), (0.8, 128), (0.9, 64)])
def test_pairs_with_a_common_direction(spark, mean_cosine, dims):
    vecs = offset_pairs(800, dims, mean_cosine).tolist()
    df = spark.createDataFrame(list(enumerate(vecs)), "vec_id bigint, embedding array<double>").repartition(3)
    unit, _ = I.unit_rows(vecs, dims)
    link = unit @ unit.T >= I.COSINE
    np.fill_diagonal(link, False)
    got = {r.vec_id: r.n_links for r in I.near_dedup(df).collect()}
    n = np.array([got[i] for i in range(len(vecs))])
    assert link.sum() >= 1600 and (n <= link.sum(1)).all() and n.sum() >= 0.97 * link.sum()


@pytest.mark.parametrize(("mean_cosine", "dims", "counted"), [(0.0, 64, {16}), (0.7, 64, {16}), (0.9, 128, {12, 8}), (0.97, 64, {8, 0}), (0.5, 2, {16, 12, 8, 0})])
def test_tables_find_made_pairs(mean_cosine, dims, counted):
    coder = I.learn(offset_pairs(1500, dims, mean_cosine)[:1500])
    assert coder.bits in counted
    for a, b in I.made_pairs(offset_pairs(1500, dims, mean_cosine, seed=5)[:1500], np.random.default_rng(1)):
        d = I._POP16[coder.codes(a) ^ coder.codes(b)]
        assert ((d <= 1).any(1) & (d[:, :4].sum(1) <= coder.radius)).mean() >= 0.96


def test_every_length_links_with_its_own(spark):
    rng = np.random.default_rng(8)
    rows, at = [], 0
    for dims in (3, 2, 16, 64):
        for _ in range(12):
            v = rng.normal(size=dims)
            for w in (v, v * 2, v + 0.01 * rng.normal(size=dims)):
                rows.append((at, w.tolist()))
                at += 1
    rows += [(9000, [1.0] * 5), (9001, []), (9002, None), (9003, [0.0, 0.0]), (9004, [1.0, None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in I.near_dedup(df).collect()}
    for i, v in rows[:-5]:
        same = [j for j, w in rows[:-5] if len(w) == len(v) and j != i and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.95]
        assert got[i][0] == len(same)
    assert all(got[i] == (0, i, True) for i in range(9000, 9005)) and len(got) == len(rows)
    only = {r.vec_id: r.n_links for r in I.near_dedup(df, dims=16).collect()}
    assert sum(n > 0 for n in only.values()) >= 36 and not any(only[i] for i, v in rows if v is None or len(v) != 16)
