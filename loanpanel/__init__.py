"""Loan-panel feature and label engine on Spark DataFrames."""

from loanpanel.operators.originations import clean_originations
from loanpanel.operators.performance import clean_performance
from loanpanel.plans.training_set import (
    aggregate_performance,
    build_training_set,
    training_set,
)
from loanpanel.sources.delimited import read_originations, read_performance

__all__ = [
    "aggregate_performance",
    "build_training_set",
    "clean_originations",
    "clean_performance",
    "read_originations",
    "read_performance",
    "training_set",
]
