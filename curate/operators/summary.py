"""Grouped, windowed and top-k summaries (WIN1, SRT1, SRT2, AGG7-AGG9, AGG14).

Each summary aggregates first (partial aggregation per task, so hot groups
are pre-combined before the shuffle); windows and sorts then run over the
small aggregated result only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curate.functions.numeric import pct
from curate.operators.cleaning import q


def share_of_group(df: DataFrame, group: str, by: str) -> DataFrame:
    """``group, by, count, total, percentage``: each group's share split by ``by``."""
    counts = df.groupBy(q(group), q(by)).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(q(group)))
    return (counts.withColumn("total", total)
            .withColumn("percentage", pct(F.col("count"), F.col("total")))
            .orderBy(q(group), q(by)))


def grouped_stats(df: DataFrame, by: Sequence[str], distinct_of: str,
                  count_name: str = "encounter_count",
                  distinct_name: str = "unique_patients") -> DataFrame:
    """Per group ``count(*)`` and ``count(distinct distinct_of)`` (nulls not counted)."""
    return df.groupBy(*[q(b) for b in by]).agg(
        F.count(F.lit(1)).alias(count_name),
        F.count_distinct(q(distinct_of)).alias(distinct_name))


def top_k(df: DataFrame, key: str, distinct_of: str, k: int = 10,
          count_name: str = "encounter_count", distinct_name: str = "unique_patients") -> DataFrame:
    """The ``k`` most frequent non-null ``key`` values (ties: key ascending).

    Planned as a ``TakeOrderedAndProject``: each task keeps its local top k.
    """
    stats = grouped_stats(df.where(q(key).isNotNull()), [key], distinct_of, count_name,
                          distinct_name)
    return stats.orderBy(F.col(count_name).desc(), q(key).asc()).limit(k)


def grouped_mean(df: DataFrame, by: Sequence[str], value: str, distinct_of: str,
                 mean_name: str = "avg_los_days", count_name: str = "encounter_count",
                 distinct_name: str = "unique_patients") -> DataFrame:
    """Per group: mean of ``value`` rounded to 2 places, row count, distinct ``distinct_of``."""
    return (df.groupBy(*[q(b) for b in by]).agg(
        F.round(F.avg(q(value)), 2).alias(mean_name),
        F.count(F.lit(1)).alias(count_name),
        F.count_distinct(q(distinct_of)).alias(distinct_name))
        .orderBy(*[q(b) for b in by]))


def summary_counts(summaries: Mapping[str, DataFrame]) -> DataFrame:
    """``summary, row_count``: row count of each (small, aggregated) summary."""
    parts = [s.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("summary"), "row_count") for name, s in summaries.items()]
    return reduce(DataFrame.unionAll, parts)
