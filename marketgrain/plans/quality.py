"""Integrity gate and quality reports over several tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketgrain.errors import AnalyticsError
from marketgrain.functions.money import CENT, percent
from marketgrain.plans.profile import duplicates


@dataclass(frozen=True)
class Edge:
    """A reference from a child column to a parent key."""

    name: str
    child: DataFrame
    child_key: str
    parent: DataFrame
    parent_key: str


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _shared_text(column: str, own: T.DataType, other: T.DataType) -> Column:
    """A key as text, in the form of the other side's type where they differ."""
    value = F.col(column).cast("string")
    if own == other or (isinstance(own, T.IntegralType) and isinstance(other, T.IntegralType)):
        return value
    return F.coalesce(F.col(column).try_cast(other).cast("string"), value)


def key_facts(keyed: Mapping[str, tuple[DataFrame, str]], edges: Sequence[Edge]) -> DataFrame:
    """A row per checked key and per edge: (kind, name, null_keys, extra_rows,
    orphan_values, orphan_rows), from a single scan of each table.

    A table gives one entry for each of its keys and references in the row. Entries are
    counted in the tasks, so a hot reference costs one row a task, and meet in a single
    shuffle by (check, key), where an edge's references find the keys of its parent.
    A null reference counts as an orphan. A table without rows gives zeros.
    """
    scans: list[tuple[DataFrame, list[Column]]] = []
    texts: list[Column] = []

    def add(frame: DataFrame, number: int, key: Column, owns: bool) -> None:
        known = next(
            (e for f, e in scans if f.columns == frame.columns and f.sameSemantics(frame)), None
        )
        if known is None:
            known = []
            scans.append((frame, known))
        known.append(
            F.struct(
                F.lit(number).cast("smallint").alias("number"),
                key.alias("key"),
                F.lit(owns).alias("owns"),
            )
        )

    types = [f.schema[k].dataType for f, k in keyed.values()]
    types += [e.child.schema[e.child_key].dataType for e in edges]
    types += [e.parent.schema[e.parent_key].dataType for e in edges]
    whole = all(isinstance(t, T.IntegralType) for t in types)
    checks = [("key", name) for name in keyed] + [("edge", e.name) for e in edges]
    for number, (frame, key) in enumerate(keyed.values()):
        add(frame, number, F.col(key).cast("bigint" if whole else "string"), True)
    for number, e in enumerate(edges, len(keyed)):
        child, parent = (
            e.child.schema[e.child_key].dataType,
            e.parent.schema[e.parent_key].dataType,
        )
        if whole:
            reference = F.col(e.child_key).cast("bigint")
            owned = F.col(e.parent_key).cast("bigint")
        else:
            reference = _shared_text(e.child_key, child, parent)
            owned = F.col(e.parent_key).cast("string")
        add(e.child, number, reference, False)
        add(e.parent, number, owned, True)
    entries = _union([frame.select(F.inline(F.array(*found))) for frame, found in scans])
    by_key = entries.groupBy("number", "key").agg(
        F.count_if("owns").alias("owners"), F.count_if(~F.col("owns")).alias("references")
    )
    absent = F.col("key").isNull()
    dangling = (F.col("references") > 0) & (absent | (F.col("owners") == 0))
    facts = by_key.groupBy("number").agg(
        F.sum(F.when(absent, F.col("owners"))).alias("null_keys"),
        F.sum(F.when(~absent & (F.col("owners") > 0), F.col("owners") - 1)).alias("extra_rows"),
        F.count_if(dangling).alias("orphan_values"),
        F.sum(F.when(dangling, F.col("references"))).alias("orphan_rows"),
    )
    named = entries.sparkSession.createDataFrame(
        [(number, *check) for number, check in enumerate(checks)],
        "number smallint, kind string, name string",
    )
    counts = ("null_keys", "extra_rows", "orphan_values", "orphan_rows")
    return named.join(facts, "number", "left").select(
        "kind", "name", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts]
    )


def key_report(keyed: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Null and repeated keys per table."""
    return key_facts(keyed, []).select(
        F.col("name").alias("table_name"), "null_keys", "extra_rows"
    )


def orphan_report(edges: Sequence[Edge]) -> DataFrame:
    """Dangling references per edge: distinct values and child rows."""
    return key_facts({}, edges).select(
        F.col("name").alias("edge"), "orphan_values", "orphan_rows"
    )


def missing_core(columns: Sequence[str]) -> Column:
    """All nulls in the columns no analysis can do without, as one number."""
    return reduce(Column.__add__, [F.count_if(F.col(c).isNull()) for c in columns])


def total_differences(*, strict: bool = False) -> Column:
    """Orders whose parts differ from the total by a cent or more; ``strict``
    counts only differences above a cent."""
    gap = F.abs(F.col("subtotal") - F.col("discount") - F.col("total"))
    limit = F.lit(CENT).cast("decimal(18,2)")
    return F.count_if(gap > limit if strict else gap >= limit)


def check(name: str, value: Column, failed: str | None) -> tuple[Column, Column, Column]:
    """A check row: its status is ``failed`` when the value is not zero; a
    check that only informs has ``failed=None`` and always passes."""
    status = F.lit("pass") if failed is None else F.when(value == 0, "pass").otherwise(failed)
    return F.lit(name).alias("check"), status.alias("status"), value.cast("bigint").alias("value")


def quality_checks(
    orders: DataFrame,
    keyed: Mapping[str, tuple[DataFrame, str]],
    edges: Sequence[Edge],
    core: Sequence[str],
    inventory: DataFrame,
    required: Sequence[str],
    privacy_findings: DataFrame,
) -> DataFrame:
    """The seven published checks. ``inventory`` is (table_name, rows);
    ``privacy_findings`` has one row per finding."""
    one = F.count(F.lit(1))
    wanted = F.col("table_name").isin(list(required))
    source_checks = inventory.agg(
        one.alias("tables"), (F.lit(len(set(required))) - F.count_if(wanted)).alias("absent")
    ).select(
        F.inline(
            F.array(
                F.struct(*check("inventory", F.col("tables"), None)),
                F.struct(*check("required_sources_missing", F.col("absent"), "fail")),
            )
        )
    )
    # Both order checks come from a single pass over the orders.
    order_checks = orders.agg(
        missing_core(core).alias("missing"), total_differences(strict=True).alias("differing")
    ).select(
        F.inline(
            F.array(
                F.struct(*check("core_completeness", F.col("missing"), "fail")),
                F.struct(*check("order_arithmetic", F.col("differing"), "warning")),
            )
        )
    )
    # Keys and references of all tables meet in one shuffle.
    unkeyed = F.when(F.col("kind") == "key", F.col("null_keys") + F.col("extra_rows"))
    dangling = F.when(F.col("kind") == "edge", F.col("orphan_rows"))
    reference_checks = (
        key_facts(keyed, edges)
        .agg(F.sum(unkeyed).alias("unkeyed"), F.sum(dangling).alias("dangling"))
        .select(
            F.inline(
                F.array(
                    F.struct(*check("primary_keys", F.col("unkeyed"), "fail")),
                    F.struct(*check("foreign_keys", F.col("dangling"), "fail")),
                )
            )
        )
    )
    rows = [
        source_checks,
        reference_checks,
        order_checks,
        privacy_findings.agg(one.alias("value")).select(*check("privacy", F.col("value"), "fail")),
    ]
    return _union(rows)


def gate(checks: DataFrame) -> None:
    """Stop when a check failed; warnings pass. Reads one row per check."""
    failed = checks.where(F.col("status") == "fail").collect()
    if failed:
        raise AnalyticsError(
            "quality gate failed: " + ", ".join(f"{r['check']}={r['value']}" for r in failed)
        )


def source_list(inventory: DataFrame, used: Sequence[str]) -> DataFrame:
    return inventory.withColumn("used_for_metrics", F.col("table_name").isin(list(used)))


def cutoff_report(
    orders: DataFrame, as_of: date, doubtful: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """The second report flavour: completeness, uniqueness, arithmetic, orders
    in a doubtful status and orders after the cut-off date. The date is an
    argument, so the same input always gives the same report."""
    gap = F.abs(F.col("subtotal") - F.col("discount") - F.col("total"))
    facts = orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("total").isNull()).alias("total"),
        F.count_if(F.col("created_at").isNull()).alias("created_at"),
        F.count_if(gap >= F.lit(CENT).cast("decimal(18,2)")).alias("gap"),
        F.count_if(F.col("status").isin(list(doubtful))).alias("doubtful"),
        F.count_if(F.to_date("placed_at") > F.lit(as_of)).alias("late"),
    )
    repeated = _union([duplicates(orders, key).select("extra_rows") for key in keys]).agg(
        F.sum("extra_rows")
    )

    def row(name: str, count: Column, always: bool = False) -> Column:
        status = F.when(F.lit(always) | (count > 0), "attention").otherwise("ok")
        return F.struct(
            F.lit(name).alias("check"),
            status.alias("status"),
            count.cast("bigint").alias("value"),
            percent(count, F.col("orders")).alias("share_pct"),
        )

    return facts.withColumn("repeated", repeated.scalar()).select(
        F.inline(
            F.array(
                row("core_fields", F.col("total") + F.col("created_at")),
                row("uniqueness", F.col("repeated")),
                row("arithmetic", F.col("gap")),
                row("doubtful_status", F.col("doubtful"), always=True),
                row("after_cutoff", F.col("late")),
            )
        )
    )


# Literals that stand in for an absent text.
PLACEHOLDERS = ("N/A", "NA", "NULL", "None", "-")


def text_hygiene(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty, padded and placeholder texts per column, in one wide aggregate."""
    measures: list[Column] = []
    for c in columns:
        text = F.col(c)
        measures += [
            F.count_if(text.isNull() | (text == "")).alias(f"{c}__empty"),
            F.count_if(text.rlike(r"\A[ \t\r\n]|[ \t\r\n]\z")).alias(f"{c}__padded"),
            F.count_if(F.trim(text).isin(list(PLACEHOLDERS))).alias(f"{c}__placeholder"),
        ]
    counted = frame.agg(*measures)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(f"{c}__{kind}").alias(kind) for kind in ("empty", "padded", "placeholder")],
        )
        for c in columns
    ]
    return counted.select(F.inline(F.array(*rows)))
