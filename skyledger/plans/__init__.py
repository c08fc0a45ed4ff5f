"""Composed jobs, from input path to output path."""

from skyledger.plans.analytics import run_analytics
from skyledger.plans.clean import clean_flights, run_clean
from skyledger.plans.ingest import run_ingest, stage_archives
from skyledger.plans.live import run_live
from skyledger.plans.replay import run_publish
from skyledger.plans.report import busiest_chart, punctual_chart, run_report
from skyledger.plans.training import run_training

__all__ = [
    "busiest_chart",
    "clean_flights",
    "punctual_chart",
    "run_analytics",
    "run_clean",
    "run_ingest",
    "run_live",
    "run_publish",
    "run_report",
    "run_training",
    "stage_archives",
]
