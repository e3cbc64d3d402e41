"""Evaluation: gold answers derived from the graph by an oracle that shares
no code with retrieval, and P/R/F1 scoring of retrieval against it."""

from .closure import descendants
from .gold import anchor_sets, oracle_answers, resolve_gold, resolved_cases
from .scoring import aggregation_gap, macro, prf, report
from .synthetic import synthetic_gold

__all__ = ["aggregation_gap", "anchor_sets", "descendants", "macro", "oracle_answers", "prf",
           "report", "resolve_gold", "resolved_cases", "synthetic_gold"]
