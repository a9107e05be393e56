"""Running sums over a table in a given order, without putting a group in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def group_starts(columns: list[np.ndarray], n: int) -> np.ndarray:
    """Whether each of ``n`` rows differs from the one before it; the first counts as the same."""
    new = np.zeros(n, bool)
    for v in columns:
        new[1:] |= v[1:] != v[:-1]
    return new


def running(df: DataFrame, group: list[str], order: list[str], sums: list[str], name: str) -> DataFrame:
    """``df`` with ``nth``, the place of a row in its group from 1, and for each
    column x of ``sums`` the sums ``pre_x`` before the row and ``sum_x`` with it,
    modulo 2**64. ``group`` and ``sums`` hold longs that aren't NULL; rows that
    are equal in ``order`` come in any order.

    Rows are range-partitioned and sorted by group and order. Each task sums its
    own rows, which are written; what a group has gathered in earlier partitions
    is added from a list with one entry for each partition. So a group may span
    any number of tasks.
    """
    counted = ["nth", *sums]
    places = [f"before_{i}" for i in range(len(counted))]

    def local(batches):
        part, idx, first, last, carry = TaskContext.get().partitionId(), 0, None, None, np.zeros(len(counted), "uint64")
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = [column(b, g) for g in group]
            here = [int(k[0]) for k in keys]
            first = here if first is None else first
            new = group_starts(keys, n)
            new[0] = here != last
            run, begin = np.cumsum(new), np.flatnonzero(new)
            head = run == run[0] if here == first else np.zeros(n, bool)
            before = []
            for k, s in enumerate(counted):
                x = np.ones(n, "uint64") if not k else column(b, s).astype("int64").view("uint64")
                total = np.cumsum(x, dtype="uint64")
                start = np.append(0 - carry[k : k + 1], (total - x)[begin])[run]
                before.append((total - x - start).view("int64"))
                carry[k] = total[-1] - start[-1]
            last = [int(k[-1]) for k in keys]
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, before), pa.array(np.full(n, part)), pa.array(np.arange(idx, idx + n)), pa.array(head)],
                                             [*b.schema.names, *places, "part", "idx", "head"])
            idx += n

    columns, keys = df.columns, [*group, *order]
    long = lambda names: [T.StructField(x, T.LongType()) for x in names]
    schema = T.StructType([*df.schema.fields, *long([*places, "part", "idx"]), T.StructField("head", T.BooleanType())])
    rows = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(local, schema), name)
    ends = rows.groupBy("part").agg(F.min_by(F.struct(*group, "part"), "idx").alias("low"), F.max_by(F.struct(*group, *[F.col(s).alias(f"own_{i}") for i, s in enumerate(sums)], *places), "idx").alias("high"))
    carried, last, gathered = {}, None, np.zeros(len(counted), "uint64")
    for r in sorted(ends.collect(), key=lambda r: r.part):
        low, high = [r.low[g] for g in group], [r.high[g] for g in group]
        before = gathered if low == last else np.zeros(len(counted), "uint64")
        carried[r.part] = before
        own = np.array([1, *(r.high[f"own_{i}"] for i in range(len(sums)))], "int64").view("uint64")
        mine = np.array([r.high[p] for p in places], "int64").view("uint64") + own
        gathered, last = mine + before if low == high else mine, high
    shared = df.sparkSession.sparkContext.broadcast(carried)

    def whole(batches):
        for b in batches:
            parts, head = column(b, "part"), column(b, "head")
            some = np.unique(parts)
            more = np.array([shared.value[int(p)] for p in some]).reshape(-1, len(counted))[np.searchsorted(some, parts)] * head[:, None]
            before = [column(b, p).astype("int64").view("uint64") + more[:, k] for k, p in enumerate(places)]
            sums_ = [before[0] + np.uint64(1)]
            for k, s in enumerate(sums, 1):
                sums_ += [before[k], before[k] + column(b, s).astype("int64").view("uint64")]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(columns)], *[pa.array(x.view("int64")) for x in sums_]], [*columns, *added])

    added = ["nth", *[f"{w}_{s}" for s in sums for w in ("pre", "sum")]]
    return rows.mapInArrow(whole, T.StructType([*df.schema.fields, *long(added)]))
