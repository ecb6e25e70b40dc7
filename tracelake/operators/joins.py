"""Joins used by the views: a left equi-join that stays balanced when one key holds a large share of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` - duplicates kept, NULL right columns when unmatched.

    Written as inner join UNION ALL (left rows without a partner). Why: in a plain left outer sort-merge join a hot
    key on the right side lands in one task and Spark's adaptive skew handling may only split the preserved (left)
    side; an inner join can be split on either side (``spark.sql.adaptive.skewJoin.enabled``) or broadcast when
    Catalyst/AQE measures one side below ``spark.sql.autoBroadcastJoinThreshold``. The unmatched part is an anti
    join against the *distinct* right keys, whose partial aggregation collapses a hot key before the shuffle.
    """
    right_cols = [c for c in right.columns]
    matched = left.join(right, left[left_key] == right[right_key], "inner")
    keys = right.select(F.col(right_key).alias("_rk")).where(F.col("_rk").isNotNull()).distinct()
    unmatched = left.join(keys, left[left_key] == keys["_rk"], "left_anti")
    unmatched = unmatched.select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols])
    return matched.select(*[left[c] for c in left.columns], *[right[c] for c in right_cols]).unionByName(unmatched)
