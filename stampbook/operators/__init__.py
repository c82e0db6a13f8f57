from stampbook.operators.folds import distinct_by_fold, with_total_by_fold
from stampbook.operators.intervals import merged_intervals, met_in_intervals, reach_in_intervals
from stampbook.operators.keyed import attach_scan, first_per_key, latest_per_key, scan_points
from stampbook.operators.median import exact_median
from stampbook.operators.skew import hot_split_join, salted_join
from stampbook.operators.stocks import first_days, rolling_distinct, running_totals
from stampbook.operators.totals import metric_grid, with_total_row
from stampbook.operators.windows import next_event_day, reach_in_windows, window_sums

__all__ = [
    "distinct_by_fold",
    "hot_split_join",
    "with_total_by_fold",
    "attach_scan",
    "exact_median",
    "first_days",
    "first_per_key",
    "latest_per_key",
    "metric_grid",
    "merged_intervals",
    "met_in_intervals",
    "next_event_day",
    "reach_in_intervals",
    "reach_in_windows",
    "rolling_distinct",
    "running_totals",
    "salted_join",
    "scan_points",
    "window_sums",
    "with_total_row",
]
