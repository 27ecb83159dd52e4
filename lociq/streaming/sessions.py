"""Loci of reads as session windows, on a batch or a stream; and the order of reads restored, on a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_loci(reads: DataFrame, *, at: str = "at", seconds: str = "length", keys: list[str], late: str = "1 hour") -> DataFrame:
    """(keys, start, end, reads): positions as times, a read's length as its session gap; touching reads merge.

    Works on a batch or, behind a watermark, on a stream.
    """
    gap = F.concat(F.col(seconds).cast("string"), F.lit(" seconds"))
    if reads.isStreaming:
        reads = reads.withWatermark(at, late)
    w = reads.groupBy(*keys, F.session_window(at, gap).alias("w")).agg(F.count(F.lit(1)).alias("reads"))
    return w.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "reads")


def restore_order(alignments: DataFrame, names: DataFrame) -> DataFrame:
    """Alignments with the ordinal of their read; reads without one keep a row. In batch this is a join."""
    return names.join(alignments, "qname", "left").orderBy("ordinal")
