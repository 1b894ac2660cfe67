"""Medallion analytics and data-quality checks for incident feeds, on PySpark."""

from marlstone.config import FeedConfig, SourceSpec
from marlstone.operators.quality import CheckResult, run_checks
from marlstone.plans.check import check_dataset
from marlstone.sources.readers import load_dataset

__all__ = [
    "CheckResult", "FeedConfig", "SourceSpec", "check_dataset", "load_dataset", "run_checks",
]
