"""DataFrame -> DataFrame operators: cleaning, dedupe, profiles, integrity, rules,
standardisation, summaries."""

from curate.operators.cleaning import (apply_schema, cast_profile, cols_of, nullify,
                                       schema_matches, with_null)
from curate.operators.dedupe import dedupe, dedupe_grouped, dedupe_stats
from curate.operators.integrity import (fk_check, flag_fks, missing_expected,
                                        orphan_count_preaggregated, orphans)
from curate.operators.profile import ingest_metrics, key_stats, null_profile, top_null_columns
from curate.operators.rules import active_violations, check_rules
from curate.operators.standardise import curate
from curate.operators.summary import (grouped_mean, grouped_stats, share_of_group,
                                      summary_counts, top_k)

__all__ = [
    "active_violations", "apply_schema", "cast_profile", "check_rules", "cols_of", "curate",
    "dedupe", "dedupe_grouped", "dedupe_stats", "fk_check", "flag_fks", "grouped_mean",
    "grouped_stats", "ingest_metrics", "key_stats", "missing_expected", "null_profile",
    "nullify", "orphan_count_preaggregated", "orphans", "schema_matches", "share_of_group",
    "summary_counts", "top_k", "top_null_columns", "with_null",
]
