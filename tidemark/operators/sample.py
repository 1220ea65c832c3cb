"""Stratified samples of flows for baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.select import baseline_rows, recent_days

DEFAULT_PERCENT, DEFAULT_DAYS = 5, 7
REFUSED_INTERVALS = ("second", "minute")


def check_interval(interval: str) -> None:
    if interval in REFUSED_INTERVALS:
        raise ValueError(f"samples are not taken every {interval}")


def sample_strata(flows: DataFrame, as_of: Column, percent: float = DEFAULT_PERCENT, days: int = DEFAULT_DAYS, number: Column | None = None) -> DataFrame:
    """Recent rows below severe, ``percent`` of them by a hash of the group and the id.

    Each row decides for itself, so every group is sampled at the same rate without a shuffle and a
    replay takes the same rows. ``number`` replaces the hash.
    """
    at = number if number is not None else F.xxhash64("observe", "dvlan", "proto", "id")
    return baseline_rows(recent_days(flows, as_of, days)).where(F.pmod(at, F.lit(10_000)) < int(percent * 100))
