"""Ordered operations that stay distributed when one key is huge.

A ``Window.partitionBy(key)`` puts every row of a key into one task, and a
window without ``partitionBy`` puts the whole table into one task.  The
operators here instead range-partition on (key, order): a hot key is split
over several consecutive partitions, each partition computes its local
result, and a per-(partition, key) summary - at most P + K rows for P
partitions and K keys - carries the running state across partition borders.
Range partitioning keeps equal sort keys in one partition, so peers (RANGE
frames) never straddle a border.

The range-partitioned rows, tagged with their partition id, are written once
as a table in the shared checkpoint folder before the id is read twice:
range bounds come from sampling, so a recomputation could place rows
differently; reading one materialised copy keeps both branches consistent,
survives executor loss and cuts the lineage.

The same path runs at every size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PID = "_seq_pid"


def _ranged(df: DataFrame, keys, order_cols, n: int | None) -> DataFrame:
    """Range-partition on (keys, order) and tag each row with its partition id.

    Without ``n`` the partition count is left to AQE, which coalesces
    adjacent ranges to its advisory size (ranges stay contiguous), so each
    range partition is executor-sized at any data volume.
    """
    from ..session import materialize

    cols = [*keys, *order_cols]
    r = df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)
    return materialize(r.withColumn(PID, F.spark_partition_id()), "ranged")


def _on(left: DataFrame, right: DataFrame, cols) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_k_{c}"]) for c in cols])


def running_sums(df: DataFrame, keys, order_cols, sums: dict[str, Column],
                 frame: str = "range", totals: bool = False,
                 num_partitions: int | None = None) -> DataFrame:
    """Add cumulative sums per key in ``order_cols`` order.

    ``sums`` maps output column -> value expression.  ``frame='range'``
    includes all peers with the same order value (SQL default frame);
    ``'rows'`` counts strictly row by row (order must then be unique).  With
    ``totals`` the per-key total of each sum is added as ``<name>_total``.
    """
    keys, order_cols = list(keys), list(order_cols)
    base = df.select("*", *[e.alias(f"_v_{o}") for o, e in sums.items()])
    r = _ranged(base, keys, order_cols, num_partitions)
    w = Window.partitionBy(PID, *keys).orderBy(*order_cols)
    w = (w.rangeBetween(Window.unboundedPreceding, Window.currentRow) if frame == "range"
         else w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = r.select("*", *[F.sum(f"_v_{o}").over(w).alias(f"_l_{o}") for o in sums])
    seg = r.groupBy(PID, *keys).agg(*[F.sum(f"_v_{o}").alias(f"_t_{o}") for o in sums])
    # ``seg`` has one row per (partition, key): without keys that is P rows,
    # so an un-partitioned window over it is bounded by the partition count.
    wk = Window.partitionBy(*keys).orderBy(PID) if keys else Window.orderBy(PID)
    wall = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    carry = [F.coalesce(F.sum(f"_t_{o}").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0)).alias(f"_c_{o}") for o in sums]
    tot = [F.sum(f"_t_{o}").over(wall).alias(f"{o}_total") for o in sums] if totals else []
    seg = seg.select(*[F.col(c).alias(f"_k_{c}") for c in [PID, *keys]], *carry, *tot)
    out = local.join(seg, _on(local, seg, [PID, *keys]), "left")
    for o in sums:
        out = out.withColumn(o, F.col(f"_l_{o}") + F.coalesce(F.col(f"_c_{o}"), F.lit(0)))
    drop = [PID, *[f"_k_{c}" for c in [PID, *keys]]]
    drop += [f"_{p}_{o}" for o in sums for p in ("v", "l", "c")]
    return out.drop(*drop)


def previous_values(df: DataFrame, keys, order_cols, value_cols, prefix: str = "prev_",
                    num_partitions: int | None = None) -> DataFrame:
    """``lag(v) over (partition by keys order by order_cols)`` without a per-key task.

    The previous row of the first row in a partition segment is the last row
    of the same key in the nearest earlier partition.  Order should be unique
    within a key (add a tiebreak column) for a deterministic answer.
    """
    keys, order_cols, value_cols = list(keys), list(order_cols), list(value_cols)
    r = _ranged(df, keys, order_cols, num_partitions)
    w = Window.partitionBy(PID, *keys).orderBy(*order_cols)
    local = r.select("*", *[F.lag(v).over(w).alias(f"{prefix}{v}") for v in value_cols],
                     (F.row_number().over(w) == 1).alias("_seq_first"))
    seg = r.groupBy(PID, *keys).agg(
        F.max_by(F.struct(*value_cols), F.struct(*order_cols)).alias("_seq_last"))
    wk = Window.partitionBy(*keys).orderBy(PID) if keys else Window.orderBy(PID)
    seg = seg.select(*[F.col(c).alias(f"_k_{c}") for c in [PID, *keys]],
                     F.lag("_seq_last").over(wk).alias("_seq_carry"))
    out = local.join(seg, _on(local, seg, [PID, *keys]), "left")
    for v in value_cols:
        out = out.withColumn(f"{prefix}{v}", F.when(F.col("_seq_first"), F.col(f"_seq_carry.{v}"))
                             .otherwise(F.col(f"{prefix}{v}")))
    return out.drop(PID, "_seq_first", "_seq_carry", *[f"_k_{c}" for c in [PID, *keys]])


#: Associative functions a running value can carry: (aggregate, merge of two values, nulls ignored).
FOLDS = {"max": (F.max, F.greatest), "min": (F.min, F.least), "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
         "any": (F.bool_or, lambda a, b: F.coalesce(a | b, a, b)), "all": (F.bool_and, lambda a, b: F.coalesce(a & b, a, b))}


def running_values(df: DataFrame, keys, order_cols, values: dict[str, tuple[str, Column]],
                   inclusive: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Running fold of the rows before each row (with it, if ``inclusive``), without a per-key task.

    ``values`` maps output column -> (name in :data:`FOLDS`, expression); null
    where no value stands before.  Rows are taken one by one in ``order_cols``
    order, which should be unique within a key.  A partition's rows fold
    locally; what it inherits is the fold of the key's earlier segments, which
    any associative function allows.
    """
    keys, order_cols = list(keys), list(order_cols)
    base = df.select("*", *[e.alias(f"_v_{o}") for o, (_, e) in values.items()])
    r = _ranged(base, keys, order_cols, num_partitions)
    w = (Window.partitionBy(PID, *keys).orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    local = r.select("*", *[FOLDS[f][0](f"_v_{o}").over(w).alias(f"_l_{o}") for o, (f, _) in values.items()])
    seg = r.groupBy(PID, *keys).agg(*[FOLDS[f][0](f"_v_{o}").alias(f"_t_{o}") for o, (f, _) in values.items()])
    wk = ((Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(PID)
          .rowsBetween(Window.unboundedPreceding, -1))
    seg = seg.select(*[F.col(c).alias(f"_k_{c}") for c in [PID, *keys]],
                     *[FOLDS[f][0](f"_t_{o}").over(wk).alias(f"_c_{o}") for o, (f, _) in values.items()])
    out = local.join(seg, _on(local, seg, [PID, *keys]), "left")
    for o, (f, _) in values.items():
        out = out.withColumn(o, FOLDS[f][1](F.col(f"_l_{o}"), F.col(f"_c_{o}")))
    drop = [PID, *[f"_k_{c}" for c in [PID, *keys]]] + [f"_{p}_{o}" for o in values for p in ("v", "l", "c")]
    return out.drop(*drop)


def global_rank(df: DataFrame, order_cols, out_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by order_cols)``, never in a single task."""
    return running_sums(df, [], order_cols, {out_col: F.lit(1)}, frame="rows",
                        num_partitions=num_partitions)
