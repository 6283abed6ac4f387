"""Entry point "compression alignment": compare the compression state of two
nodes, collect the rules of the access node's compressed tables, and apply
them to the data as a physical layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import compression as G


@dataclass
class Alignment:
    drift: DataFrame
    rules: DataFrame
    layout: DataFrame | None


def align_compression(left_states: DataFrame, right_states: DataFrame, settings: DataFrame, schema: str,
                      samples: DataFrame | None = None, layout_path: str | None = None,
                      limit: int | None = None) -> Alignment:
    """G1 on both sides -> G2 drift -> G5 rules for the left side's compressed
    tables -> G6 layout when ``samples`` and ``layout_path`` are given."""
    left = G.compressed_tables(left_states, schema, limit)
    drift = G.policy_drift(left_states, right_states)
    rules = G.compression_rules(left, settings)
    layout = None
    if samples is not None and layout_path is not None:
        layout = G.apply_layout(samples, rules, layout_path)
    return Alignment(drift, rules, layout)
