"""Sequence checks and per-group samples."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.operators.scan import ordered_scan, previous


def sequence_gaps(df: DataFrame, *, group, seq: str, block, order) -> DataFrame:
    """Rows whose number is not the previous one of their group plus one."""
    scanned = ordered_scan(
        df, group=group, block=block, order=order, previous_seq=previous(F.col(seq))
    )
    return scanned.filter(F.col(seq) != F.col("previous_seq") + 1)


def sample_per_group(df: DataFrame, group, order, quotas: dict) -> DataFrame:
    """First rows of each group; ``quotas`` maps a class (column ``sample_class``) to its limit.

    The row-number filter becomes a per-task limit before the shuffle, so a large group sends at
    most its quota per task.
    """
    w = Window.partitionBy(*group, "sample_class").orderBy(*order)
    limit = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])[F.col("sample_class")]
    return (
        df.withColumn("_row", F.row_number().over(w))
        .filter(F.col("_row") <= max(quotas.values()))
        .filter(F.col("_row") <= limit)
        .drop("_row")
    )
