"""DataFrame operators on flight tables; columns are parameters with flight defaults."""

from skyledger.operators.airports import (
    arrivals_by_dest,
    busiest_airports,
    combine_departures_arrivals,
    departures_by_origin,
)
from skyledger.operators.boosting import fit_delay_model, load_model, save_model, score_flights
from skyledger.operators.categories import attach_codes, category_codes, number_in_order
from skyledger.operators.delays import mean_delay
from skyledger.operators.features import (
    collapse_rows,
    delay_features,
    offline_features,
    split_counts,
    with_split,
)
from skyledger.operators.metrics import classification_metrics, roc_auc
from skyledger.operators.outcomes import (
    archive_outcomes,
    outcome_counts,
    rows_of_good_archives,
    rows_by_day,
    with_row_counts,
)
from skyledger.operators.ranking import best_at, top_carriers, top_destinations, top_per_group
from skyledger.operators.repair import drop_incomplete, ensure_columns, fill_missing
from skyledger.operators.selection import active_flights, at_airport, departed_flights
from skyledger.operators.totals import (
    busiest_from_totals,
    delay_totals,
    mean_from_totals,
    of_grouping,
)
from skyledger.operators.tree_walk import score_by_walking

__all__ = [
    "active_flights",
    "archive_outcomes",
    "arrivals_by_dest",
    "at_airport",
    "attach_codes",
    "best_at",
    "busiest_airports",
    "busiest_from_totals",
    "category_codes",
    "classification_metrics",
    "collapse_rows",
    "combine_departures_arrivals",
    "delay_features",
    "delay_totals",
    "departed_flights",
    "departures_by_origin",
    "drop_incomplete",
    "ensure_columns",
    "fill_missing",
    "fit_delay_model",
    "load_model",
    "mean_delay",
    "mean_from_totals",
    "number_in_order",
    "of_grouping",
    "offline_features",
    "outcome_counts",
    "roc_auc",
    "rows_of_good_archives",
    "save_model",
    "score_by_walking",
    "score_flights",
    "split_counts",
    "top_carriers",
    "top_destinations",
    "top_per_group",
    "rows_by_day",
    "with_row_counts",
    "with_split",
]
