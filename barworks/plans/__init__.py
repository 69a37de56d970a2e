"""Registered queries: importing this package fills ``registry.QUERIES`` / ``ORACLES``."""

from . import q_views, q_checks, q_clean, q_reconcile, q_quality, q_shape, q_ticks, q_sources, q_stream, q_reports, q_more, q_indicators, q_market, q_extra  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
