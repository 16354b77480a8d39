"""Data-quality checks over gold tables. Each check is one pass and returns its findings as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizpulse.schemas import DAILY, MONTHLY



def fact_rules() -> dict[str, Column]:
    """Rule name -> condition that a bad fact row meets. A null value breaks no range rule."""
    return {
        "granularity": ~F.col("granularity").isin(DAILY, MONTHLY),
        "measure": ~F.col("measure").between(1, 9),
    }


def popularity_rules() -> dict[str, Column]:
    """Rule name -> condition that a bad popularity row meets. A null value breaks no range rule."""
    return {
        "granularity": ~F.col("granularity").isin(DAILY, MONTHLY),
        "popularity_score": ~F.col("popularity_score").between(0, 1),
        "city_rank": F.col("city_rank") <= 0,
    }


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.filter(F.col("duplicate_count") > 1)


def missing_fields(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Null count of each checked column; one aggregate per table, however many columns."""

    def counted(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = ", ".join(f"`{c}`, '{c}'" for c in columns)
        return counts.select(
            F.lit(name).alias("table_name"), F.expr(f"stack({len(columns)}, {pairs}) AS (null_count, column_name)")
        )

    return reduce(DataFrame.union, [counted(n, df, columns) for n, (df, columns) in tables.items()])


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in tables.items()]
    return reduce(DataFrame.union, counts)


def slices_to_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of `table_row_counts`, from the row counts of the tables' slices (see `sources.footers.slice_counts`)."""
    counts = [
        df.agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.union, counts)


def constraint_violations(
    name: str, df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Violations per rule, plus `unique_key` = rows beyond the first of their key.

    With `keys`, rows fold to one per key first (combined on the map side) and the rule counts ride along, so rules
    and uniqueness take one pass and one shuffle.
    """
    broken = {rule: F.count_if(bad) for rule, bad in rules.items()}
    if keys:
        folded = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(f"_{r}") for r, c in broken.items()])
        counts = folded.agg(*[F.sum(f"_{r}").alias(r) for r in rules], F.sum(F.col("_n") - 1).alias("unique_key"))
        names = [*rules, "unique_key"]
    else:
        counts = df.agg(*[c.alias(r) for r, c in broken.items()])
        names = list(rules)
    pairs = ", ".join(f"'{r}', coalesce(`{r}`, 0L)" for r in names)
    return counts.select(F.lit(name).alias("table_name"), F.expr(f"stack({len(names)}, {pairs}) AS (rule, violations)"))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the quarantined rest with the names of the rules they break."""
    named = [F.when(bad, F.lit(rule)) for rule, bad in rules.items()]
    marked = df.withColumn("broken_rules", F.array_compact(F.array(*named)))
    clean = F.size("broken_rules") == 0
    return marked.filter(clean).drop("broken_rules"), marked.filter(~clean)
