"""Curve-library engine on Spark: build, query, evaluate and audit sampled response curves."""

from curveloom.operators.evaluate import evaluate, evaluate_strict, evaluate_wide
from curveloom.operators.filters import filter_curves
from curveloom.operators.lookup import get_curve
from curveloom.plans.search import search
from curveloom.sources.catalog import open_library

__all__ = [
    "evaluate",
    "evaluate_strict",
    "evaluate_wide",
    "filter_curves",
    "get_curve",
    "open_library",
    "search",
]
