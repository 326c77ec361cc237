"""Equality joins with the guarantees an analysis needs.

None of the joins carries a broadcast hint: the sides grow with the data, so
the choice belongs to the optimizer, which knows their sizes. A guard costs one
pre-aggregated pass over the key column and leaves the join itself untouched,
so adaptive execution can still split a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(frame: DataFrame, key: str) -> DataFrame:
    """Values of a key that occur more than once, with their row count."""
    counted = frame.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where(F.col("rows") > 1)


def guard(frame: DataFrame, broken: Column, message: str | Column) -> DataFrame:
    """Stop the query as soon as one row meets ``broken``."""
    text = F.lit(message) if isinstance(message, str) else message
    return frame.where(F.when(broken, F.raise_error(text)).otherwise(F.lit(True)))


def require_unique(frame: DataFrame, key: str, name: str, target: DataFrame) -> DataFrame:
    """``target``, guarded by the uniqueness of a key of ``frame``."""
    repeated = duplicate_keys(frame, key).agg(F.count(F.lit(1)).alias("n"))
    return guard(
        target, repeated.scalar() > 0, f"{name}.{key} is not unique, the join would fan out"
    )


def checked_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    name: str,
    validate: str | None = "m:1",
    unmatched: str = "error",
) -> DataFrame:
    """Look up ``right`` by ``key`` for every row of ``left``.

    ``validate`` is ``"m:1"`` (key unique on the right), ``"1:1"`` (on both
    sides) or ``None``. ``unmatched`` says what happens to a left row without a
    partner: ``"error"`` stops the query and names the key, ``"drop"`` removes
    the row, ``"keep"`` leaves the looked-up columns null.
    """
    if validate not in ("m:1", "1:1", None):
        raise ValueError(f"unknown validation {validate!r}")
    if unmatched not in ("error", "drop", "keep"):
        raise ValueError(f"unknown policy {unmatched!r}")
    probe = left
    if validate == "1:1":
        probe = require_unique(left, key, f"left side of {name}", probe)
    if validate is not None:
        probe = require_unique(right, key, name, probe)
    if unmatched == "drop":
        return probe.join(right, key, "inner")
    if unmatched == "keep":
        return probe.join(right, key, "left")
    marked = right.withColumn("_found", F.lit(True))
    joined = probe.join(marked, key, "left")
    lost = F.concat(
        F.lit(f"no {name} row for {key} = "),
        F.coalesce(F.col(key).cast("string"), F.lit("null")),
    )
    return guard(joined, F.col("_found").isNull(), lost).drop("_found")


def lookup(left: DataFrame, right: DataFrame, key: str, fill: dict[str, object]) -> DataFrame:
    """Left join that replaces absent lookups by a fill value."""
    joined = left.join(right, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def members(frame: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key appears in ``keys``."""
    return frame.join(keys.select(on), on, "left_semi")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent, with the child rows behind each.

    Child rows collapse to one row per key value before the shuffle, so a hot
    foreign key costs a single row per task. The lookup is an outer join with a
    marker: an anti join would be pushed below the aggregation and shuffle
    every child row. A null key counts as an orphan.
    """
    references = child.groupBy(F.col(child_key).alias("reference")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    known = parent.select(F.col(parent_key).alias("reference"), F.lit(True).alias("known"))
    return (
        references.join(known, "reference", "left").where(F.col("known").isNull()).drop("known")
    )
