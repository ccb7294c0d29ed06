"""pairflow: Spark-native operators for paired irregular time series.

Every operator takes and returns DataFrames; nothing runs until an action.
"""

from .functions.numeric import nan_to_null, pct_change, safe_corr
from .functions.time import epoch_ms_to_ts, floor_minute, parse_ts
from .operators.candles import candle_metrics, format_base_series, format_ref_series, to_candles
from .operators.conform import conform, require_columns
from .operators.dedup import dedup
from .operators.pairing import lead_lag_features, pair_join, prior_day_seed
from .operators.quality import expectations
from .operators.reports import (freshness, joint_move, joint_move_daily, last_n, latest,
                                locf_completeness, null_profile, observed, rollup,
                                series_profile)
from .operators.timeseries import locf, whole_history_shift
from .operators.upsert import align_to, insert_new_rows, merge_append, upsert, upsert_table
from .plans.models import (aligned, daily_correlation, enriched, materialize, register_views,
                           staging)

__all__ = [
    "align_to", "aligned", "candle_metrics", "conform", "daily_correlation", "dedup",
    "enriched", "epoch_ms_to_ts", "expectations", "floor_minute", "format_base_series",
    "format_ref_series", "freshness", "insert_new_rows", "joint_move", "joint_move_daily",
    "last_n", "latest", "lead_lag_features", "locf", "locf_completeness",
    "materialize", "merge_append", "nan_to_null", "null_profile", "observed", "pair_join",
    "parse_ts", "pct_change", "prior_day_seed", "register_views", "require_columns", "rollup",
    "safe_corr",
    "series_profile", "staging", "to_candles", "upsert", "upsert_table",
    "whole_history_shift",
]
