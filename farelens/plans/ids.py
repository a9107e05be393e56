"""Consecutive row numbers, as an AUTO_INCREMENT column gives, without one task for all rows."""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.plans.sinks import LoadCheckError, scratch_dir

#: ``monotonically_increasing_id`` has the partition above this many bits.
PLACE_BITS = 33


def consecutive(stored: DataFrame, id_col: str = "id") -> DataFrame:
    """A stored table whose ``id_col`` was made by ``monotonically_increasing_id``
    when it was written, with ids 1 to n in the same order instead.

    A partition's rows are counted; the sums of the counts before it, one number
    for each partition, are what its rows' places are raised by. The ids of a
    stored table are fixed, so every run over it gives the same numbers. A table
    that lacks rows which were numbered is refused, as it would leave gaps.
    """
    part, place = F.shiftright(id_col, PLACE_BITS), F.col(id_col).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"), F.max(place).alias("last"))
    each = sorted(counts.collect(), key=lambda r: (r["_part"] is None, r["_part"]))
    wrong = [r["_part"] for r in each if r["_part"] is None or r["last"] + 1 != r["n"]]
    if wrong:
        raise LoadCheckError(f"{len(wrong)} partition(s) don't have each of their numbered rows once: {wrong[:5]}")
    before = [0, *accumulate(r["n"] for r in each)]
    offsets = stored.sparkSession.createDataFrame([(r["_part"], n) for r, n in zip(each, before, strict=False)], "_part long, _before long")
    numbered = stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # a row for each partition
    return numbered.select(*[(F.col("_before") + place + 1).alias(c) if c == id_col else F.col(f"`{c}`") for c in stored.columns])


def numbered(df: DataFrame, order: tuple[str, ...], id_col: str = "id") -> DataFrame:
    """``df`` with ``id_col`` from 1 to n in the order of some columns: sorted by
    ranges in many tasks, written to the shared folder and numbered there."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/numbered-{uuid.uuid4().hex}"
    in_order = df.repartitionByRange(*order).sortWithinPartitions(*order)
    in_order.select(F.monotonically_increasing_id().alias(id_col), "*").write.parquet(path)
    return consecutive(spark.read.parquet(path), id_col)
