"""Equi-joins. No strategy is forced: sides under Spark's size threshold are broadcast, others are merged."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import fold_case

_FOLDED = "_folded_"


def equi_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    ignore_case: bool = False,
    hot: str = "both",
) -> DataFrame:
    """Join on equally named keys; ``how`` is inner, left, right or full.

    A key value holding a large share of the rows is cut into several tasks by adaptive execution, on either
    side of an inner join and on the kept side of a one-sided outer join. It cannot do so for a full join, which is
    therefore put together from joins for which it can. ``hot`` tells which side may have such keys: with one
    side ruled out (``left`` or ``right`` may have them) two joins are enough, otherwise it takes three.

    With ``ignore_case``, text keys match regardless of case and the left spelling is kept where there is one.
    """
    if hot not in ("left", "right", "both"):
        raise ValueError("hot is 'left', 'right' or 'both'")
    if ignore_case:
        return _join_folded(left, right, list(keys), how, hot)
    if how == "full":
        return _full_join(left, right, list(keys), hot)
    return left.join(right, list(keys), how)


def _full_join(left: DataFrame, right: DataFrame, keys: list[str], hot: str) -> DataFrame:
    """Rows without a match are found against the other side's distinct keys, reduced before they are shuffled."""
    columns = [*keys, *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys]]
    left_only = left.join(right.select(*keys).distinct(), keys, "left_anti")
    right_only = right.join(left.select(*keys).distinct(), keys, "left_anti")
    parts = {
        "left": [left.join(right, keys, "left"), right_only],
        "right": [left.join(right, keys, "right"), left_only],
        "both": [left.join(right, keys, "inner"), left_only, right_only],
    }[hot]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*columns)


def _join_folded(left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: str) -> DataFrame:
    kinds = dict(left.dtypes)

    def folded(frame: DataFrame, spelling: str) -> DataFrame:
        tests = {_FOLDED + k: fold_case(k) if kinds[k] == "string" else F.col(k) for k in keys}
        return frame.withColumns(tests).withColumnsRenamed({k: spelling + k for k in keys})

    joined = equi_join(folded(left, "_left_"), folded(right, "_right_"), [_FOLDED + k for k in keys], how, hot=hot)
    spelled = [F.coalesce(F.col("_left_" + k), F.col("_right_" + k)).alias(k) for k in keys]
    others = [c for c in (*left.columns, *right.columns) if c not in keys]
    return joined.select(*spelled, *others)


def join_all(inputs: Sequence[DataFrame], keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Two or more inputs joined on the same keys. Equal keys let the joins share one partitioning."""
    if len(inputs) < 2:
        raise ValueError("a join takes at least two inputs")
    return reduce(lambda a, b: equi_join(a, b, keys, how), inputs)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent row, with their row counts; null keys are no orphans.

    The child is counted per key before it is joined, so a hot key is one row by then.
    """
    counted = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    parents = parent.select(F.col(parent_key).alias("key_value")).filter(F.col("key_value").isNotNull())
    return counted.join(parents, "key_value", "left_anti")
