"""Whole runs composed of the operators."""

from tabwright.plans.analysis import RunResult, refresh, run
from tabwright.plans.processing import (ProcessingModel, distinct_rows, fit_processing,
                                        process)
from tabwright.plans.stored import StoredRun, load, save

__all__ = ["ProcessingModel", "RunResult", "StoredRun", "distinct_rows", "fit_processing", "load",
           "process", "refresh", "run", "save"]
