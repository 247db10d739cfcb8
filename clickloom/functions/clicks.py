"""Expressions over click events and click sequences."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

PAD = "<PAD>"

# Rating weight of each event type.
EVENT_WEIGHTS = {
    "view": 1.0,
    "add_to_cart": 3.0,
    "purchase": 5.0,
    "payment_failed": -2.0,
}


def event_weight(event_type: Column, weights: Mapping[str, float] = EVENT_WEIGHTS) -> Column:
    """Weight of an event type; unknown types give NULL."""
    branches = F.lit(None).cast("double")
    for name, weight in weights.items():
        branches = F.when(event_type == name, F.lit(float(weight))).otherwise(branches)
    return branches


def last_k(seq: Column, k: int) -> Column:
    return F.when(F.size(seq) > k, F.slice(seq, -k, k)).otherwise(seq)


def pad_left(seq: Column, k: int, pad: str | Column = PAD) -> Column:
    missing = F.greatest(F.lit(k) - F.size(seq), F.lit(0))
    return F.concat(F.array_repeat(F.lit(pad), missing), seq)


def fit_sequence(seq: Column, k: int, pad: str | Column = PAD) -> Column:
    """Keep the last ``k`` entries, then pad on the left to exactly ``k``."""
    return pad_left(last_k(seq, k), k, pad)
