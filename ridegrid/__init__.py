"""ridegrid: hourly demand analytics on Spark (clean -> hourly series -> serve -> score)."""
from .operators.clean import (assign_landing_month, bounds_are_inert, clean_stats, clean_trips,
                              exact_quantile, finalize_trips, month_bounds, stats_report,
                              tag_stages, upper_bounds, upper_bounds_exact, with_landing_month)
from .operators.features import fourier_features, lag_features
from .operators.forecast import demand_forecast
from .operators.metrics import actual_vs_predicted, compare, forecast_metrics, with_location_names
from .operators.series import (backfill, distinct_locations, fill_missing_hours, hour_bounds,
                               hour_location_grid, hourly_demand, hourly_rides)
from .plans.monthly_job import run_backfill, run_month
from .plans.served import (column_profile, demand_by_band, demand_range, first_locations,
                           location_series, location_summary, location_week, row_counts,
                           run_query, week_window)
from .session import build_session, reliable_checkpoint, scratch_path
from .sources.lake import (landed_months, missing_months, read_demand, read_predictions,
                           read_trips, write_clean_trips, write_demand, write_partitioned,
                           write_predictions)
from .sources.serve import (conform, insert_if_absent, load_predictions, read_jdbc,
                            register_table, serve, union_frames, write_jdbc)
from .sources.typing import infer_column_types, to_text, typed_result
from .streaming.landing import start_landing_stream

__all__ = [name for name in dir() if not name.startswith("_")]
