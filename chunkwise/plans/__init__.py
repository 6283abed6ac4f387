"""Registered queries (import populates the registry)."""

from . import chunk_reports, policy_reports, series_reports, stream_reports  # noqa: F401
from .registry import REGISTRY, Query, register

__all__ = ["REGISTRY", "Query", "register"]
