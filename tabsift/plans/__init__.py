"""Registered queries, grouped by the part of the library they exercise."""

from . import q_aggregates, q_closed_forms, q_models, q_profiler, q_rules_audit, q_scores, q_sources, q_streams, q_text_leakage  # noqa: F401
from .registry import CHECK_SQL, QUERIES  # noqa: F401
