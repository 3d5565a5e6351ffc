"""Lookup joins of an aggregated table back onto the big table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlab.session import staged


def join_lookup(big: DataFrame, lookup: DataFrame, on, how: str = "left", name: str = "lookup") -> DataFrame:
    """Join an aggregated lookup table of any size.

    The table is staged first, so Spark knows its true size: it is broadcast
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffled beyond, where
    skewed partitions of hot keys on the big side are split.
    """
    return big.join(staged(lookup, name), on, how)
