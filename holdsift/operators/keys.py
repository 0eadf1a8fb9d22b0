"""Keyed building blocks that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdsift.session import checkpointed


def _struct(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order`` (ascending; make it total for a deterministic result).

    A min-by aggregate: each task reduces its rows to one per key before the shuffle,
    where ``row_number() = 1`` would send every row of a hot key to one task.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(_struct(rest), _struct(order)).alias("_r")).select(
        *keys, *[F.col("_r")[c].alias(c) for c in rest]
    )


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``, same plan as :func:`keep_first`."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(_struct(rest), _struct(order)).alias("_r")).select(
        *keys, *[F.col("_r")[c].alias(c) for c in rest]
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The ``n`` top rows per key.

    Written as a rank filter because Spark turns that into a per-partition group
    limit ahead of the shuffle: at most ``n`` rows per key leave each task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equal in all named columns, nulls included."""
    return reduce(Column.__and__, [left[n].eqNullSafe(right[n]) for n in names])


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column,
                   out: str = "previous") -> DataFrame:
    """``lag(value)`` per key without a whole key in one task.

    ``bucket`` must grow with ``order`` (say, the day of the timestamp).  Inside a
    (key, bucket) a plain window works; the first row of a bucket takes the last
    value of the key's previous bucket from a one-row-per-bucket summary.
    """
    b = df.withColumn("_b", bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    inner = b.withColumns({"_lag": F.lag(F.struct(F.col(value).alias("v"))).over(w)})
    tails = b.groupBy(*keys, "_b").agg(F.max_by(F.struct(F.col(value).alias("v")), _struct(order)).alias("_tail"))
    carried = tails.select(
        *keys, "_b", F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_b")).alias("_carry")
    )
    joined = inner.join(carried, _same(inner, carried, [*keys, "_b"]), "left")
    return joined.select(
        *[inner[c] for c in df.columns], F.coalesce(inner["_lag"], carried["_carry"])["v"].alias(out)
    )


def running_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, bucket: Column,
                   total: str = "sum_before", count: str = "n_before") -> DataFrame:
    """Sum and count of non-null ``value`` over the earlier rows of the same key, bucketed like
    :func:`previous_value`."""
    b = df.withColumns({"_b": bucket, "_v": value})
    w = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = b.withColumns(
        {"_s": F.coalesce(F.sum("_v").over(w), F.lit(0.0)), "_n": F.count("_v").over(w)}
    )
    per = b.groupBy(*keys, "_b").agg(F.sum("_v").alias("_bs"), F.count("_v").alias("_bn"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(
        *keys, "_b",
        F.coalesce(F.sum("_bs").over(wb), F.lit(0.0)).alias("_cs"),
        F.coalesce(F.sum("_bn").over(wb), F.lit(0)).alias("_cn"),
    )
    joined = inner.join(carry, _same(inner, carry, [*keys, "_b"]), "left")
    return joined.select(
        *[inner[c] for c in df.columns],
        (F.col("_s") + F.col("_cs")).alias(total), (F.col("_n") + F.col("_cn")).alias(count)
    )


def in_ranges(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """``df`` with the number of its range of ``order``: a bucket that grows with it, whatever the values look like.

    Checkpointed, so that a lost executor cannot move a row to another range.
    """
    return checkpointed(df.repartitionByRange(*order).withColumn(out, F.spark_partition_id()))


def last_entered(df: DataFrame, keys: Sequence[str], order: Sequence[str], enters: Column, value: Column, n: int,
                 bucket: Column, out: str = "last") -> DataFrame:
    """``df`` with the values of the at most ``n`` rows of the same key that entered just before, oldest first.

    Rows are numbered by how many entered before them (bucketed like :func:`running_before`). Each row that entered
    is sent to the ``n`` numbers that see it, so a number gathers ``n`` values and no key meets in one task.
    Rows with none before them get null.
    """
    counted = checkpointed(running_before(
        df.withColumns({"_enters": F.coalesce(enters, F.lit(False)), "_value": value}), keys, order,
        F.when(F.col("_enters"), 1.0), bucket, total="_sum", count="_at").drop("_sum"))
    seen = counted.filter("_enters").select(
        *keys, F.explode(F.sequence(F.col("_at") + 1, F.col("_at") + n)).alias("_at"), F.struct("_at", "_value").alias("_s"))
    near = seen.groupBy(*keys, "_at").agg(F.sort_array(F.collect_list("_s"))["_value"].alias(out))
    near = near.select(*[F.col(c).alias(f"_of_{c}") for c in [*keys, "_at"]], out)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*keys, "_at"]])
    return counted.join(near, same, "left").select(*df.columns, out)
