"""Randomized model tests: upsert and duplicate detection against plain-Python models, with a hot key."""

import random

from tracelake.operators.quality import DUPLICATE_ID, validate
from tracelake.operators.tableops import upsert


def _data(seed):
    rng = random.Random(seed)
    current = [(i, f"c{i}") for i in range(0, 300, 2)]
    changes = []
    for n in range(1200):
        key = 7 if n % 3 == 0 else rng.randrange(0, 400)  # key 7 holds a third of all changes
        changes.append((key, f"n{n}", rng.randrange(0, 20)))  # version ties are frequent
    return current, changes


def test_upsert_matches_model(spark):
    current, changes = _data(1)
    cur = spark.createDataFrame(current, "id long, name string")
    chg = spark.createDataFrame(changes, "id long, name string, version int").repartition(6)
    got = sorted(tuple(r) for r in upsert(cur, chg, "id", order_by=["version"]).collect())
    model = dict(current)
    best = {}
    for key, name, version in changes:  # greatest (version, name) wins: the row itself breaks version ties
        if key not in best or (version, name) > best[key]:
            best[key] = (version, name)
    model.update({k: v[1] for k, v in best.items()})
    assert got == sorted(model.items())


def test_duplicate_detection_matches_model(spark):
    _, changes = _data(2)
    rows = [(k, n) for k, n, _ in changes]
    df = spark.createDataFrame(rows, "id long, name string").repartition(5)
    got = sorted((r.id, r.name, r.error_code) for r in validate(df).collect())
    counts = {}
    for k, _ in rows:
        counts[k] = counts.get(k, 0) + 1
    model = sorted((k, n, DUPLICATE_ID if counts[k] > 1 else 0) for k, n in rows)
    assert got == model
