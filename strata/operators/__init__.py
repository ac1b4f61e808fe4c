"""DataFrame -> DataFrame operators for each layer (bronze, silver, gold, quality, joins, layout)."""

from strata.operators.bronze import (  # noqa: F401
    add_ingest_metadata, from_json_records, normalize_strings, to_bronze,
)
from strata.operators.enrich import enrich_and_aggregate, fits_broadcast  # noqa: F401
from strata.operators.gold import (  # noqa: F401
    count_by, count_non_null_keys, date_part_stats, gold_top_n, point_lookup, stats_by, top_n,
)
from strata.operators.layout import bucket_skew, key_skew, partition_sizes  # noqa: F401
from strata.operators.quality import (  # noqa: F401
    DataQualityError, Rule, assert_row_bounds, check, check_gold, describe_stats,
    distinct_profile, enforce, gold_summary, guard_non_empty, null_profile, null_total,
    reconcile, row_bounds, untrimmed_profile,
)
from strata.operators.silver import (  # noqa: F401
    clean, clean_columns, dedup, dedup_report, dedup_window, distinct_rows,
)
