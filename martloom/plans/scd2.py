"""Type 2 policy dimension: classify the source against current rows, expire, insert, and form the new image."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.context import RunContext
from martloom.functions import any_of, as_object, day_before, differs
from martloom.operators.bloom import bloom_filter, may_contain, words_for
from martloom.operators.checks import duplicates
from martloom.operators.numbering import next_key, number_by_key
from martloom.schemas import DIM_POLICY, POLICY_SRC, POLICY_VERSIONS
from martloom.workspace import scratch_path

# Tracked attributes, the reject text, flags.
ATTRIBUTES = ("policy_holder_name", "policy_type", "premium_amount", "start_date", "end_date")
NULL_KEY = "POLICY_ID is NULL"
CURRENT, EXPIRED = "Y", "N"

# Kinds of rows a load produces.
KEPT, CLOSED, ADDED = "kept", "closed", "added"

_LOOKUP = "lk_"
_FLAGS = ("matched", "attr_changed", "new_record", "changed", "unchanged", "valid")


def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("current_flag") == CURRENT)


def narrowed(rows: DataFrame, due: DataFrame, keys: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose policy may be due, all others), by a Bloom filter of the `keys` or so policies that are due.

    A false positive is a row more for the join that follows, which finds nothing.
    """
    words = words_for(keys)
    found = may_contain(bloom_filter(due, "policy_id", words), F.col("policy_id"), words)
    return rows.filter(found), rows.filter(~found)


def lookup(due: DataFrame, dimension: DataFrame, keys: int) -> DataFrame:
    """Current rows that the source may refer to, for a source much smaller than the dimension: about as many rows as
    are due enter the join with it, whatever the size of the dimension."""
    return narrowed(current_rows(dimension), due, keys)[0]


def match(due: DataFrame, dimension: DataFrame) -> DataFrame:
    """Every valid source row and every current dimension row, paired by policy.

    Null keys never take part, so they cannot pile up in one task. Callers that need only source rows filter
    on ``in_source``, from which the optimizer turns the full join into a one-sided one.
    """
    source = due.filter(F.col("policy_id").isNotNull()).withColumn("in_source", F.lit(True))
    known = current_rows(dimension).select(
        *[F.col(c).alias(_LOOKUP + c) for c in DIM_POLICY.names], F.lit(True).alias("matched")
    )
    paired = source.join(known, F.col("policy_id") == F.col(_LOOKUP + "policy_id"), "full")
    return paired.withColumns(
        {
            "in_source": F.coalesce("in_source", F.lit(False)),
            "matched": F.coalesce("matched", F.lit(False)),
            "attr_changed": any_of(differs(a, _LOOKUP + a) for a in ATTRIBUTES),
        }
    )


def _flags() -> dict[str, Column]:
    return {
        "new_record": ~F.col("matched"),
        "changed": F.col("matched") & F.col("attr_changed"),
        "unchanged": F.col("matched") & ~F.col("attr_changed"),
        "valid": F.col("policy_id").isNotNull(),
    }


def classify(due: DataFrame, dimension: DataFrame) -> DataFrame:
    """Source rows with their flags and the version they would get; null-key rows are new and not valid."""
    # A row without a key finds nothing, so its attributes are compared with nulls.
    keyless = due.filter(F.col("policy_id").isNull()).withColumns(
        {
            "matched": F.lit(False),
            "attr_changed": any_of(F.col(a).isNotNull() for a in ATTRIBUTES),
            _LOOKUP + "version_no": F.lit(None).cast("int"),
        }
    )
    keyed = match(due, dimension).filter("in_source")
    columns = [*POLICY_SRC.names, "matched", "attr_changed", _LOOKUP + "version_no"]
    rows = keyed.select(*columns).unionByName(keyless.select(*columns))
    version = F.when(F.col("new_record"), F.lit(1)).otherwise(F.col(_LOOKUP + "version_no") + 1)
    return (
        rows.withColumns(_flags())
        .withColumn("out_version_no", version)
        .select(*POLICY_SRC.names, *_FLAGS, "out_version_no")
    )


def _new_version(run: RunContext) -> Column:
    """The row to insert, still without its surrogate key."""
    filled = {
        "policy_key": F.lit(None),
        "effective_from": run.day,
        "effective_to": F.lit(None),
        "current_flag": F.lit(CURRENT),
        "version_no": F.when(F.col("matched"), F.col(_LOOKUP + "version_no") + 1).otherwise(F.lit(1)),
        "batch_id": run.batch,
    }
    return F.struct(*[filled.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in DIM_POLICY])


def _kept_row(run: RunContext, expire: bool) -> Column:
    filled = {"current_flag": F.lit(EXPIRED), "effective_to": day_before(run.day)} if expire else {}
    return F.struct(
        *[filled.get(f.name, F.col(_LOOKUP + f.name)).cast(f.dataType).alias(f.name) for f in DIM_POLICY]
    )


def inserts(due: DataFrame, dimension: DataFrame, run: RunContext) -> DataFrame:
    """New versions, without surrogate keys: policies that are new or changed."""
    rows = match(due, dimension).filter(F.col("in_source") & (~F.col("matched") | F.col("attr_changed")))
    return rows.select(_new_version(run).alias("v")).select("v.*").drop("policy_key")


def expired(due: DataFrame, dimension: DataFrame, run: RunContext) -> DataFrame:
    """Current rows of changed policies, closed the day before the run."""
    rows = match(due, dimension).filter(F.col("in_source") & F.col("matched") & F.col("attr_changed"))
    return rows.select(_kept_row(run, expire=True).alias("v")).select("v.*")


def with_keys(new_rows: DataFrame, dimension: DataFrame) -> DataFrame:
    """Surrogate keys after the dimension's largest, in policy order."""
    return keyed_after(new_rows, next_key(dimension, "policy_key"))


def keyed_after(new_rows: DataFrame, last: Column | int) -> DataFrame:
    """Surrogate keys after ``last``, in policy order."""
    return number_by_key(new_rows, "policy_id", "policy_key", after=last).select(*DIM_POLICY.names)


def load_versions(due: DataFrame, current: DataFrame, run: RunContext, keys: int) -> DataFrame:
    """``versions`` for a load: current rows that a Bloom filter of the due policies rules out are KEPT without a join."""
    maybe, others = narrowed(current, due, keys)
    return versions(due, maybe, run).unionByName(others.select(*DIM_POLICY.names, F.lit(KEPT).alias("kind")))


def versions(due: DataFrame, dimension: DataFrame, run: RunContext) -> DataFrame:
    """Every row that is current before or after the run, with its ``kind``, out of one join.

    A changed policy yields two rows, its CLOSED version and the ADDED one; a new policy one ADDED row; any
    other current row is KEPT. ADDED rows have no surrogate key yet.
    """
    paired = match(due, dimension)
    changed = F.col("in_source") & F.col("matched") & F.col("attr_changed")

    def entry(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), row.alias("row"))

    rows = (
        F.when(changed, F.array(entry(CLOSED, _kept_row(run, expire=True)), entry(ADDED, _new_version(run))))
        .when(F.col("matched"), F.array(entry(KEPT, _kept_row(run, expire=False))))
        .otherwise(F.array(entry(ADDED, _new_version(run))))
    )
    return paired.select(F.explode(rows).alias("v")).select("v.row.*", "v.kind")


def full_image(due: DataFrame, dimension: DataFrame, run: RunContext) -> DataFrame:
    """The whole dimension after the run: closed history, untouched rows, rows closed now, and new versions."""
    history = dimension.filter(F.col("current_flag") != CURRENT).select(*DIM_POLICY.names)
    # Written once, so that standing rows, added rows and their numbering share one join.
    path = scratch_path(due.sparkSession, "policy-versions")
    versions(due, dimension, run).write.parquet(path)
    image = due.sparkSession.read.schema(POLICY_VERSIONS).parquet(path)
    standing = image.filter(F.col("kind") != ADDED).select(*DIM_POLICY.names)
    added = image.filter(F.col("kind") == ADDED).drop("policy_key", "kind")
    return history.unionByName(standing).unionByName(with_keys(added, dimension))


def rejects(due: DataFrame) -> DataFrame:
    """Rows without a key, as the reject file has them."""
    return due.filter(F.col("policy_id").isNull()).select(
        F.col("policy_id").cast("string").alias("policy_id"),
        F.lit(NULL_KEY).alias("error_desc"),
        as_object(POLICY_SRC.names).alias("raw_data"),
    )


def audit_counts(due: DataFrame, dimension: DataFrame) -> DataFrame:
    """One row: source rows, inserts (new and changed), updates (changed), rejects, unchanged."""
    flagged = classify(due, dimension)
    valid = F.col("valid")
    return flagged.agg(
        F.count(F.lit(1)).alias("source_count"),
        F.count_if(valid & (F.col("new_record") | F.col("changed"))).alias("target_inserts"),
        F.count_if(valid & F.col("changed")).alias("target_updates"),
        F.count_if(~valid).alias("reject_count"),
        F.count_if(valid & F.col("unchanged")).alias("unchanged_count"),
    )


class PolicyLoadError(ValueError):
    """The load would break a uniqueness rule of the dimension."""


def conflicts(image: DataFrame, run: RunContext) -> DataFrame:
    """(policy_id, reason) of rows from ``versions`` that would give a policy two current rows, or two versions from
    one day.

    The first comes from a source with a policy twice, the second from another load on the same day. Only the
    policy ids are shuffled, counted map-side first.
    """
    twice = duplicates(image.filter(F.col("kind") != CLOSED), "DIM_POLICY", ["policy_id"])
    same_day = image.filter((F.col("kind") == CLOSED) & (F.col("effective_from") >= run.day))
    return twice.select(F.col("key_value").cast("string").alias("policy_id"), F.lit("given more than once").alias("reason")).union(
        same_day.select(F.col("policy_id").cast("string"), F.lit(f"already versioned on or after {run.run_date}"))
    )


def check_source(due: DataFrame, report: Callable[[DataFrame], str] | None = None) -> None:
    """Refuse a source that has a policy more than once, before the join that would bring its rows together.

    Only ids are shuffled, counted map-side first. The error says how many there are; ``report`` stores all of them.
    """
    twice = duplicates(due, "POLICY_SRC", ["policy_id"]).select(
        F.col("key_value").alias("policy_id"), F.lit("given more than once").alias("reason")
    )
    n = twice.count()
    if n:
        raise PolicyLoadError(f"{n} policies given more than once" + (f"; they are listed in {report(twice)}" if report else ""))


def check_versions(image: DataFrame, run: RunContext, report: Callable[[DataFrame], str] | None = None) -> None:
    """Refuse rows that have ``conflicts``. The error says how many there are, by reason; ``report`` stores all of them
    and returns where."""
    found = conflicts(image, run)
    counts = {r["reason"]: r["count"] for r in found.groupBy("reason").count().collect()}
    if counts:
        said = ", ".join(f"{n} policies {reason}" for reason, n in sorted(counts.items()))
        raise PolicyLoadError(said + (f"; they are listed in {report(found)}" if report else ""))
