"""A segmented prefix scan: running values along an order, in groups of which one may hold most rows.

Rows are dealt by ranges of (keys, order), so that a large group is cut into blocks. A block gives its last values and its sums;
these are scanned on a narrow table, a row for each block of a group, and carried into the blocks. No task sees a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.scratch import written


def scanned(rows: DataFrame, keys: list[str | Column], order: list[str | Column], lasts: dict[str, Column] | None = None,
            sums: dict[str, Column] | None = None, previous: dict[str, Column] | None = None) -> DataFrame:
    """rows with more columns: of lasts, the last value that isn't null up to the row; of previous, that before the row; of sums, the sum up to the row.

    Nulls come first in order and are keys like others; a null counts 0 in a sum. Rows of a group with equal order have no order among
    each other: give one that tells them apart. A column of a name given here is replaced; others keep their names, whatever those are.
    Without keys, all rows are one group. An empty table stays empty.
    """
    lasts, sums, previous = lasts or {}, sums or {}, previous or {}
    col = lambda c: F.col(c) if isinstance(c, str) else c
    k, o, v = [f"k{i}" for i in range(len(keys))], [f"o{i}" for i in range(len(order))], {f"v{i}": c for i, c in enumerate({**lasts, **previous}.values())}
    s = {f"s{i}": c for i, c in enumerate(sums.values())}
    packed = rows.select(F.struct("*").alias("row"), *[col(c).alias(n) for c, n in zip([*keys, *order], k + o, strict=True)], *[c.alias(n) for n, c in v.items()], *[F.coalesce(c, F.lit(0)).alias(n) for n, c in s.items()])
    dealt = written(packed.repartitionByRange(*k, *o).withColumn("part", F.spark_partition_id()), "scan")

    at = F.struct(*o)
    blocks = dealt.groupBy("part", *k).agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), at)).alias(n) for n in v], *[F.sum(n).alias(n) for n in s])
    earlier = W.partitionBy(*k).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select(
        F.col("part").alias("p"), *[F.col(n).alias(f"c{n}") for n in k],
        *[F.last(n, ignorenulls=True).over(earlier).alias(f"c{n}") for n in v], *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"c{n}") for n in s],
    )
    same = F.col("part") == F.col("p")
    for n in k:
        same &= F.col(n).eqNullSafe(F.col(f"c{n}"))
    joined = dealt.join(carried, same)

    block = W.partitionBy("part", *k).orderBy(*o)
    upto, before = block.rowsBetween(W.unboundedPreceding, W.currentRow), block.rowsBetween(W.unboundedPreceding, -1)
    frames = [upto] * len(lasts) + [before] * len(previous)
    more = {name: F.coalesce(F.last(n, ignorenulls=True).over(frame), F.col(f"c{n}")) for name, n, frame in zip([*lasts, *previous], v, frames, strict=True)}
    more |= {name: F.sum(n).over(upto) + F.col(f"c{n}") for name, n in zip(sums, s, strict=True)}
    kept = [F.col("row").getField(c).alias(c) for c in rows.columns if c not in more]
    return joined.select(*kept, *[c.alias(name) for name, c in more.items()])
