"""Connected components of a large edge table: forests inside tasks, then large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import ship, stored

#: Edges contracted at a time inside a task.
FOREST_EDGES = 200_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) for the graph of the given edges; roots give no edge."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            up = new[new]
            if np.array_equal(up, new):
                break
            new = up
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _contract(batches):
    us, vs, held = [], [], 0

    def out():
        a, b = forest(np.concatenate(us), np.concatenate(vs))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["u", "v"])

    for batch in batches:
        us.append(batch.column(0).to_numpy())
        vs.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held >= FOREST_EDGES:
            done = out()
            yield done
            us, vs, held = [], [], 0
    if held:
        yield out()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge table of two bigint columns; root is the smallest node reachable.

    Each round is two aggregations and two joins on edges that are at most one per node and component, so work
    follows the number of nodes. Rounds are written to the shared folder. Null ends and loops are ignored.
    Raises if ``rounds`` rounds do not settle.
    """
    ship(edges.sparkSession)
    src = edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v"))
    src = src.where("u is not null and v is not null and u <> v")
    cur = stored(src.mapInArrow(_contract, "u bigint, v bigint"), "cc")
    seen = None
    for _ in range(rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        cur = stored(small, "cc")
        row = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == tuple(row):
            break
        seen = tuple(row)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    star = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
