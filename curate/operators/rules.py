"""Business-rule validation (PRD5, AGG6, AGG13).

All rules are evaluated in one aggregation of ``count_if(violated)``.  Rules
never filter: violators are counted and kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.operators.metrics import counts_long
from curate.spec import Rule


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``constraint, violations`` per rule; ``report_zero=False`` rules only when > 0."""
    long = counts_long(df, [(r.name, r.violated()) for r in rules], "constraint", "violations",
                       total_col=None, ordinal_col="ordinal")
    always = [i for i, r in enumerate(rules) if r.report_zero]
    keep = F.col("ordinal").isin(always) | (F.col("violations") > 0)
    return long.where(keep).select("constraint", "violations")


def active_violations(violations: DataFrame) -> DataFrame:
    """Only the constraints that fired."""
    return violations.where(F.col("violations") > 0)
