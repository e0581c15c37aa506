"""Numbers, running totals, predecessors and exact percentiles of groups of any size.

A window over a group holds the whole group in one task. Here rows are first dealt by range of
(keys, order), so that a large group lies in many partitions, one after the other. A row's
answer is then what its own part of the group says, put together with what the group's
earlier parts add up to: a row a part, not a row a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.operators.shared import materialize


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have (Spark compares them without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def dealt(df: DataFrame, keys: list[str], order: list[str], part: str, name: str) -> DataFrame:
    """``df`` written by range of (keys, order), with the number of each row's range as ``part``.

    It is written, not only exchanged: two plans over one exchange may put its partitions together differently.
    """
    return materialize(df.repartitionByRange(*(F.col(c) for c in [*keys, *order])).withColumn(part, F.spark_partition_id()), name)


def _same(keys: list[str], other: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(other[k])) for k in keys), F.lit(True))


def _carry(df: DataFrame, parts: DataFrame, keys: list[str], part: str, value: str, into: str) -> DataFrame:
    """``df`` with ``value`` of ``parts`` (keys, part, value) as ``into``.

    Only the first group of a range can go on from an earlier one, so ``parts``, once its empty
    values are gone, has at most a row a range: it is broadcast.
    """
    names = dict(zip([*keys, part], unused(df, *(f"of_{c}" for c in [*keys, part])), strict=True))
    small = F.broadcast(parts.where(F.col(value).isNotNull()).select(*(F.col(c).alias(n) for c, n in names.items()), F.col(value).alias(into)))
    return df.join(small, (F.col(part) == F.col(names[part])) & _same(keys, names), "left").drop(*names.values())


def running_total(df: DataFrame, keys: list[str], order: list[str], weight: Column, into: str) -> DataFrame:
    """``df`` with the sum of ``weight`` over its group's rows up to itself, by ``order``, as ``into``.

    ``order`` must be total within a group, but for equal rows. Null keys are a group. Rows that tie on
    (keys, order) lie in one range: end ``order`` with an id where very many tie.
    """
    part, own, before = unused(df, "part", "own", "before")
    rows = dealt(df.withColumn(own, weight), keys, order, part, "dealt")
    totals = rows.groupBy(*keys, part).agg(F.sum(own).alias(own))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn(before, F.sum(own).over(earlier)).drop(own)
    inside = Window.partitionBy(part, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = _carry(rows.withColumn(into, F.sum(own).over(inside)), totals, keys, part, before, before)
    return rows.withColumn(into, F.col(into) + F.coalesce(before, F.lit(0))).drop(part, own, before)


def numbered(df: DataFrame, keys: list[str], order: list[str], into: str) -> DataFrame:
    """``df`` with each row's number (from 1) in its group by ``order`` as ``into``."""
    return running_total(df, keys, order, F.lit(1).cast("long"), into)


def with_previous(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str], exists: str) -> DataFrame:
    """``df`` with columns of the row before in its group (``columns``: name to new name) and, as ``exists``, whether there is one."""
    part, last, before = unused(df, "part", "last", "before")
    kept = F.struct(*columns)
    rows = dealt(df, keys, order, part, "dealt")
    ends = rows.groupBy(*keys, part).agg(F.max_by(kept, F.struct(*order)).alias(last))
    ends = ends.withColumn(before, F.lag(last).over(Window.partitionBy(*keys).orderBy(part))).drop(last)
    rows = rows.withColumn(last, F.lag(kept).over(Window.partitionBy(part, *keys).orderBy(*order)))
    rows = _carry(rows, ends, keys, part, before, before).withColumn(last, F.coalesce(last, before))
    return rows.withColumns({n: F.col(last)[c] for c, n in columns.items()} | {exists: F.col(last).isNotNull()}).drop(part, last, before)


def nearest_rank(df: DataFrame, by: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Exact nearest-rank percentiles of each group, of any size: (by, a column a point).

    The smallest value whose share of the group's values up to it reaches the point. Nulls don't
    count; a group of nulls alone has null percentiles. Values are counted, their counts dealt by range
    and summed a range; each percentile is then looked up in the one range that holds its rank.
    """
    part, n, before, total, name, want, share, point = unused(df, "part", "n", "before", "total", "name", "want", "share", "point")
    counts = dealt(df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias(n)), by, [value], part, "counts")
    parts = counts.groupBy(*by, part).agg(F.sum(n).alias(n))
    group = Window.partitionBy(*by)
    parts = parts.withColumns({before: F.sum(n).over(group.orderBy(part)) - F.col(n), total: F.sum(n).over(group)})
    each = F.explode(F.array(*(F.struct(F.lit(c).alias(name), F.lit(float(p)).alias(share)) for c, p in points.items())))
    wanted = parts.withColumn(point, each).withColumn(want, F.greatest(F.ceil(F.col(point)[share] * F.col(total)), F.lit(1)) - F.col(before))
    wanted = wanted.where((F.col(want) > 0) & (F.col(want) <= F.col(n))).select(*by, part, F.col(point)[name].alias(name), want)
    inside = Window.partitionBy(part, *by).orderBy(value)
    sums = counts.withColumn(total, F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    names = dict(zip([*by, part], unused(sums.join(wanted.select(name, want)), *(f"of_{c}" for c in [*by, part])), strict=True))
    ranges = wanted.select(*(F.col(c).alias(x) for c, x in names.items()), name, want)
    hit = sums.join(ranges, (F.col(part) == F.col(names[part])) & _same(by, names)).where(F.col(total) >= F.col(want))
    found = hit.groupBy(*by, name).agg(F.min(value).alias(value))
    wide = found.groupBy(*by).agg(*(F.min(F.when(F.col(name) == c, F.col(value))).alias(c) for c in points))
    empty = df.groupBy(*by).agg(F.count(value).alias(n)).where(F.col(n) == 0).select(*by, *(F.lit(None).cast(df.schema[value].dataType).alias(c) for c in points))
    return wide.unionByName(empty)
