"""Quality rules, constraint reports and quarantine.

A rule is a named boolean column that is true for a bad row. All rules of a table are counted in
one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.operators.joins import orphan_count
from shelfmark.schemas import required


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """`rule, violations`, one row per rule; a rule that evaluates to NULL does not count."""
    counts = df.agg(*(F.count_if(broken).alias(name) for name, broken in rules.items()))
    rows = F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules))
    return counts.select(F.explode(rows).alias("_row")).select("_row.rule", "_row.violations")


def price_rules() -> dict[str, Column]:
    return {"negative_price": (F.col("cost_price") < 0) | (F.col("selling_price") < 0)}


def quantity_rules() -> dict[str, Column]:
    return {"non_positive_quantity": F.col("quantity") <= 0}


def customer_rules(as_of: Column) -> dict[str, Column]:
    return {
        "malformed_email": ~F.col("email").contains("@"),
        "future_signup": F.col("signup_date") > as_of,
    }


@dataclass(frozen=True)
class Reference:
    """A foreign key of a table."""

    column: str
    parent: DataFrame
    parent_key: str


def referential_violations(checks: Mapping[str, tuple[DataFrame, Reference]]) -> DataFrame:
    """`check, violations`: rows of each child without a parent, a NULL key included."""
    parts = [
        orphan_count(child, ref.column, ref.parent, ref.parent_key)
        .select(F.lit(name).alias("check"), "violations")
        for name, (child, ref) in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Constraints:
    """What the schema of a table promises."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)  # name -> condition that must hold
    references: Sequence[Reference] = ()


def declared(schema: StructType, unique: Sequence[str] = (), checks: Mapping[str, Column] | None = None,
             references: Sequence[Reference] = ()) -> Constraints:
    """The constraints of a table with a declared schema: its NOT NULL columns and those given."""
    return Constraints(unique, required(schema), checks or {}, references)


def constraint_report(tables: Mapping[str, tuple[DataFrame, Constraints]]) -> DataFrame:
    """`table_name, kind, constraint_name, violations` for every declared constraint.

    UNIQUE counts the keys found more than once; CHECK and FOREIGN KEY accept NULL.
    """
    parts: list[DataFrame] = []
    for table, (df, rules) in tables.items():
        def report(counted: DataFrame, kind: str, name: Column, table: str = table) -> DataFrame:
            return counted.select(
                F.lit(table).alias("table_name"), F.lit(kind).alias("kind"),
                name.alias("constraint_name"), "violations",
            )
        for column in rules.unique:
            keys = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_rows"))
            repeated = keys.agg(F.count_if(F.col("_rows") > 1).alias("violations"))
            parts.append(report(repeated, "unique", F.lit(column)))
        by_kind = {
            "not_null": {c: F.col(c).isNull() for c in rules.not_null},
            "check": {n: ~holds for n, holds in rules.checks.items()},
        }
        row_rules = {f"{kind}:{n}": broken for kind, group in by_kind.items() for n, broken in group.items()}
        if row_rules:
            counted = rule_violations(df, row_rules)
            kind, name = (F.split_part("rule", F.lit(":"), F.lit(i)) for i in (1, 2))
            parts.append(counted.select(
                F.lit(table).alias("table_name"), kind.alias("kind"), name.alias("constraint_name"), "violations"))
        for ref in rules.references:
            missing = orphan_count(df, ref.column, ref.parent, ref.parent_key, count_null=False)
            parts.append(report(missing, "foreign_key", F.lit(ref.column)))
    return reduce(DataFrame.unionByName, parts)


def judge_batch(rows: DataFrame, known: DataFrame, key: str, references: Sequence[Reference] = ()) -> DataFrame:
    """The different rows of a batch with `reject_reason`, NULL for those to append, and `copies`, the number of rows of the batch
    each stands for; copies add up to the batch.

    Reasons, the first that holds: `missing_key`; `unknown_<column>` for a value without a parent; `known_key` for a key that `known`
    holds; `repeated_key` for all but one row of a key, copies of that one included. Of rows that nothing else speaks against the
    first by their columns is taken.
    """
    columns = rows.columns
    rest = [c for c in columns if c != key] or [key]
    # Copies merge before anything is joined, so a key with very many of them stays cheap.
    merged = rows.groupBy(*columns).agg(F.count("*").alias("copies"))
    reason = F.when(F.col(key).isNull(), "missing_key")
    for ref in references:
        parents = ref.parent.select(F.col(ref.parent_key).alias(ref.column)).distinct().withColumn(f"_has_{ref.column}", F.lit(True))
        merged = merged.join(parents, ref.column, "left")
        reason = reason.when(F.col(ref.column).isNotNull() & F.col(f"_has_{ref.column}").isNull(), f"unknown_{ref.column}")
    held = known.select(key).join(merged.select(key), key, "left_semi").distinct().withColumn("_known", F.lit(True))
    judged = merged.join(held, key, "left").select(
        *columns, "copies", reason.when(F.col("_known"), "known_key").alias("reject_reason"))
    first = judged.filter(F.col("reject_reason").isNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_first"))
    placed = judged.join(first, key, "left")
    free = F.col("reject_reason").isNull()
    taken = free & F.struct(*rest).eqNullSafe(F.col("_first"))
    spare = F.col("copies") - taken.cast("int")
    verdicts = F.array(
        F.struct(F.lit(None).cast("string").alias("reason"), taken.cast("bigint").alias("copies")),
        F.struct(F.when(free, "repeated_key").otherwise(F.col("reject_reason")).alias("reason"), spare.alias("copies")))
    told = placed.select(*columns, F.explode(F.filter(verdicts, lambda v: v["copies"] > 0)).alias("_verdict"))
    return told.select(*columns, F.col("_verdict.reason").alias("reject_reason"), F.col("_verdict.copies").alias("copies"))
