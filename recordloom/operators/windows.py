"""Windows over ladders, snapshots and peers. Orders are total, so that results do not vary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ladder(key: str, order: Sequence[str]):
    return Window.partitionBy(key).orderBy(*order)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in an order, such as F.col("ts").desc_nulls_last()."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def rank_share(df: DataFrame, key: str, measure: str, tie: str) -> DataFrame:
    """Rank in the group and share of its total."""
    w = Window.partitionBy(key)
    return df.withColumn("rank", F.rank().over(w.orderBy(F.desc(measure), tie))).withColumn("share", F.round(F.col(measure) / F.sum(measure).over(w), 6))


def top_n(df: DataFrame, key: str, order: Sequence[Column], n: int) -> DataFrame:
    """First n rows of each key with their number."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= n)


def ladder_delta(df: DataFrame, key: str, order: Sequence[str], numbers: Sequence[str], days: Sequence[str] = ()) -> DataFrame:
    """Differences from the row before, null at the first."""
    w = ladder(key, order)
    out = df
    for c in numbers:
        out = out.withColumn(f"d_{c}", F.round(F.col(c) - F.lag(c).over(w), 2))
    for c in days:
        out = out.withColumn(f"days_{c}", F.datediff(c, F.lag(c).over(w)))
    return out


def changed_fields(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Names of the columns that differ from the row before, nulls equal; null at the first."""
    w = ladder(key, order)
    moved = F.concat_ws(",", *[F.when(~F.col(c).eqNullSafe(F.lag(c).over(w)), F.lit(c)) for c in cols])
    return df.withColumn("changed", F.when(F.row_number().over(w) > 1, moved))


def succession(df: DataFrame, key: str, order: Sequence[str], entity: str) -> DataFrame:
    """Rows whose entity differs from the one before, with both."""
    out = df.withColumn("predecessor", F.lag(entity).over(ladder(key, order))).withColumnRenamed(entity, "successor")
    return out.filter("predecessor is not null and predecessor <> successor")


def islands(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str], smooth: bool = True) -> DataFrame:
    """Number of the run of equal values each row lies in.

    With smooth, one row that differs from equal neighbours on both sides counts as them.
    """
    w = ladder(key, order)
    value = F.struct(*cols)
    if smooth:
        before, after = F.lag(value).over(w), F.lead(value).over(w)
        df = df.withColumn("_v", F.when(before.isNotNull() & before.eqNullSafe(after), before).otherwise(value))
    else:
        df = df.withColumn("_v", value)
    starts = df.withColumn("_s", (~F.col("_v").eqNullSafe(F.lag("_v").over(w))).cast("int"))
    return starts.withColumn("island", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


def scd2(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str], valid: str) -> DataFrame:
    """Version rows: valid_from, valid_to (null if current), is_current, attributes of the last true row."""
    runs = islands(df, key, order, cols)
    true_row = F.struct(*cols).eqNullSafe(F.col("_v"))
    last = lambda c: F.max_by(F.when(true_row, F.struct(c)), F.when(true_row, F.struct(*order)))[c].alias(c)
    out = runs.groupBy(key, "island").agg(F.min(valid).alias("valid_from"), F.count(F.lit(1)).alias("n_rows"), *[last(c) for c in cols])
    w = Window.partitionBy(key).orderBy("island")
    return out.withColumn("valid_to", F.lead("valid_from").over(w)).withColumn("is_current", F.col("valid_to").isNull()).withColumnRenamed("island", "version")


def last_known(df: DataFrame, key: str, order: Sequence[Column], col: str) -> DataFrame:
    """The key's most recent value that isn't null, on every row."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(f"last_{col}", F.first(col, ignorenulls=True).over(w))


def canonical_id(df: DataFrame, block: str, key: str) -> DataFrame:
    """Least key of the block, its size, whether the row is it."""
    stats = df.groupBy(block).agg(F.min(key).alias("canonical_id"), F.count(F.lit(1)).alias("group_size"))
    return df.join(stats, block).withColumn("is_canonical", F.col(key) == F.col("canonical_id"))


def with_totals(df: DataFrame, key: str, measure: str) -> DataFrame:
    """The group's sum and count beside each row; whether the row is the largest."""
    w = Window.partitionBy(key)
    return df.withColumns({"group_total": F.round(F.sum(measure).over(w), 2), "group_n": F.count(F.lit(1)).over(w), "is_largest": F.col(measure) == F.max(measure).over(w)})


def percentile_in(df: DataFrame, peers: Sequence[str], col: str) -> DataFrame:
    """Percent rank and cumulative share among peers."""
    w = Window.partitionBy(*peers).orderBy(col)
    return df.withColumns({"percent_rank": F.round(F.percent_rank().over(w), 6), "cume_dist": F.round(F.cume_dist().over(w), 6)})


def tenure(df: DataFrame, key: str, label: str, active: Column) -> DataFrame:
    """First and last label, labels seen, ever inactive, active in the key's last label."""
    return df.groupBy(key).agg(
        F.min(label).alias("first_seen"), F.max(label).alias("last_seen"), F.count_distinct(label).alias("n_seen"),
        F.bool_or(~active).alias("ever_inactive"), F.max(F.struct(F.col(label), active.alias("a")))["a"].alias("active_last"),
    )


def any_of(conditions: Mapping[str, Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions.values())
