"""Top N items within every group by secondary sort, without buffering groups.

1. A map-side step keeps, of each Arrow batch, the N best distinct items of each group, so a
   group of millions of rows leaves a task as a few rows.
2. Rows are hash-partitioned by (group, salt), the salt drawn from the item, so even a group
   with a third of all rows is spread; each partition is sorted by group, salt, score
   (descending) and item, and streamed: per group the first N distinct items are emitted.
   The only state is the current group and the items already emitted for it (at most N).
3. The survivors (at most N x salts a group) are partitioned by group and streamed the same way.

Ties go to the smaller item in binary string order.  Of several rows of a group and item the
highest score counts.  Defined results: rows with a null group, null item, null or NaN score are
left out; infinities are ordinary scores; -0.0 equals 0.0; an empty table gives an empty result;
groups with fewer than N items give all they have; extra columns are dropped unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAMES = ["group", "score", "item"]


def _first_n(n: int, salted: bool):
    """Stream sorted batches, emitting the first ``n`` distinct items of each (group, salt)."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = salt = None
        seen: set = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column("group")
            # Positions where the group (or salt) changes: only these and the next few rows are looked at.
            change = np.ones(batch.num_rows, bool)
            if batch.num_rows > 1:
                differs = pc.not_equal(groups.slice(1), groups.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
                if salted:
                    s = batch.column("salt").to_numpy(zero_copy_only=False)
                    differs |= s[1:] != s[:-1]
                change[1:] = differs
            starts = np.append(np.flatnonzero(change), batch.num_rows)
            items = batch.column("item")
            keep: list[int] = []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                g, s = groups[a].as_py(), batch.column("salt")[a].as_py() if salted else 0
                if g != group or s != salt:
                    group, salt = g, s
                    seen = set()
                while a < b and len(seen) < n:
                    item = items[a].as_py()
                    if item not in seen:
                        seen.add(item)
                        keep.append(a)
                    a += 1
            if keep:
                yield batch.take(pa.array(keep, pa.int64())).select(_NAMES)

    return stream


def _shrink(n: int):
    """The ``n`` best distinct items of each group within each batch."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch]).group_by(["group", "item"]).aggregate([("score", "max")]).rename_columns(["group", "item", "score"])
            t = t.take(pc.sort_indices(t, [("group", "ascending"), ("score", "descending"), ("item", "ascending")]))
            k = t.num_rows
            if not k:
                continue
            groups = t.column("group").combine_chunks()
            first = np.ones(k, bool)
            first[1:] = pc.not_equal(groups.slice(1), groups.slice(0, k - 1)).to_numpy(zero_copy_only=False)
            at = np.arange(k)
            rank = at - np.maximum.accumulate(np.where(first, at, 0))
            yield from t.filter(pa.array(rank < n)).select(_NAMES).to_batches()

    return stream


def top_n(df: DataFrame, group: Column, item: Column, score: Column, n: int = 10, salts: int = 16) -> DataFrame:
    """(group, score, item): the ``n`` items with the highest scores of each group."""
    if n < 1 or salts < 1:
        raise ValueError("n and salts must be positive")
    schema = "group string, score double, item string"
    rows = df.select(group.cast("string").alias("group"), (score.cast("double") + F.lit(0.0)).alias("score"), item.cast("string").alias("item"))
    rows = rows.filter(F.col("group").isNotNull() & F.col("item").isNotNull() & F.col("score").isNotNull() & ~F.isnan("score"))
    rows = rows.mapInArrow(_shrink(n), schema)
    order = ["group", F.desc("score"), "item"]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(salts)).cast("int"))
    local = salted.repartition("group", "salt").sortWithinPartitions("group", "salt", *order[1:]).mapInArrow(_first_n(n, True), schema)
    return local.repartition("group").sortWithinPartitions(*order).mapInArrow(_first_n(n, False), schema)
