"""A filter with several outputs: rows go to every output they match, or to the first, or to the rejects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT = "reject"


def _labels(routes: Mapping[str, Column]) -> Column:
    """Labels of the routes whose predicate is true; an unknown predicate is no match."""
    return F.filter(
        F.array(*[F.when(test, F.lit(label)) for label, test in routes.items()]), lambda label: label.isNotNull()
    )


def route(
    df: DataFrame, routes: Mapping[str, Column], first_only: bool = False, rejects: bool = False, label: str = "route"
) -> DataFrame:
    """Rows with the label of the route they take, in one pass over the input.

    By default a row appears once per matching route; ``first_only`` keeps the first match in the order given.
    ``rejects`` keeps rows that match none, labelled ``reject``; otherwise they are dropped.
    """
    if first_only:
        chosen = None
        for name, test in routes.items():
            chosen = F.when(test, F.lit(name)) if chosen is None else chosen.when(test, F.lit(name))
        labelled = df.withColumn(label, chosen.otherwise(F.lit(REJECT)) if rejects else chosen)
        return labelled if rejects else labelled.filter(F.col(label).isNotNull())
    matched = _labels(routes)
    if rejects:
        matched = F.when(F.size(matched) > 0, matched).otherwise(F.array(F.lit(REJECT)))
    return df.withColumn(label, F.explode(matched))


def split(df: DataFrame, routes: Mapping[str, Column], first_only: bool = False) -> dict[str, DataFrame]:
    """The outputs as separate frames, and the rest under ``reject``. Each is a plain filter that can be pushed down."""
    outputs: dict[str, DataFrame] = {}
    taken = F.lit(False)
    for name, test in routes.items():
        hit = F.coalesce(test, F.lit(False))
        outputs[name] = df.filter(hit & ~taken if first_only else hit)
        taken = taken | hit
    outputs[REJECT] = df.filter(~taken)
    return outputs
