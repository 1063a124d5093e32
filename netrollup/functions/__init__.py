"""Column expressions shared by every roll-up; all native, no Python UDF."""

from netrollup.functions.metrics import (
    bit_rate,
    delta,
    exact_mean,
    mean_of_parts,
    percent,
    ratio,
    round2,
    span,
    sum_parts,
    to_mega,
    whole,
)
from netrollup.functions.timekeys import (
    bucket_ms,
    doc_key,
    epoch_seconds_ntz,
    slice_ms,
)

__all__ = [
    "bit_rate", "bucket_ms", "delta", "doc_key", "epoch_seconds_ntz",
    "exact_mean", "mean_of_parts", "percent", "ratio", "round2", "slice_ms", "span", "sum_parts",
    "to_mega", "whole",
]
