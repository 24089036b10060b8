"""Relational operators: map, filter, SQL join over named views, sorts,
top-N per group, per-key gathering and counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .materialize import materialize


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def map_double(df: DataFrame, column: str, out: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``column * 2`` next to the ``keep`` columns (a narrow projection)."""
    return df.select(*(keep or []), (F.col(column) * 2).alias(out or f"{column}_x2"))


def filter_even(df: DataFrame, column: str) -> DataFrame:
    """Rows whose integer ``column`` is even."""
    return df.where(F.col(column) % 2 == 0)


def filter_order(df: DataFrame, column: str, max_value, order_by: list[str]) -> DataFrame:
    """Rows with ``column <= max_value`` ordered by ``order_by`` ascending.
    The comparison is pushed into the scan."""
    return df.where(F.col(column) <= F.lit(max_value)).orderBy(*order_by)


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows by ``order`` (which must end in a unique
    tie-break). Planned as ``TakeOrderedAndProject``: every task keeps an
    ``n``-row heap and only those rows meet in one place, no global sort."""
    return df.orderBy(*order).limit(n)


def sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None,
        args: dict | None = None) -> DataFrame:
    """Run SQL over DataFrames named as ``{name}`` in the text, with ``:name``
    parameters bound as values (never spliced into the text). Spark gives each
    DataFrame a view of its own and drops it again, so the caller's views are untouched. Catalyst
    rewrites a comma join with an equality predicate into an equi-join and picks broadcast or
    sort-merge."""
    return spark.sql(text, args=args, **(views or {}))


def secondary_sort(df: DataFrame, keys: list[tuple[str, bool]], tiebreak: list[str] | None = None) -> DataFrame:
    """Sort on several keys, each ``(column, descending)``, whole rows kept.

    Equal keys are ordered by ``tiebreak`` so the output order is repeatable.
    A global sort range-partitions on the keys (sampled bounds), so it scales
    out rather than funnelling through one task.
    """
    order = [F.col(c).desc() if desc else F.col(c).asc() for c, desc in keys]
    return df.orderBy(*order, *[F.col(c) for c in (tiebreak or [])])


def group_top_n(df: DataFrame, group: list[str], order: list[Column], n: int = 3,
                rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows of every group by ``order`` (which must end in a unique
    tie-break), with their 1-based rank. Groups smaller than ``n`` are kept
    whole; equal values are not merged (``row_number``, not ``rank``).

    Catalyst plans ``row_number() <= n`` as a partial ``WindowGroupLimit``
    before the shuffle and a final one after it, so a group holding a third of
    all rows is cut to ``n`` rows per map task before it is shuffled.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def group_collect(df: DataFrame, key: str, value: str) -> DataFrame:
    """All values of every key, duplicates kept, as a multiset
    ``(key, value, n)``: one row per distinct value with its multiplicity.

    This is the scalable form of gathering a key's values: a key that holds a
    third of all rows is not packed into one array in one task, and the
    gathering combines map-side.
    """
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))


def gather_values(df: DataFrame, key: str, value: str, size: int = 1000) -> DataFrame:
    """All values of every key with duplicates, in order, as ``(key, chunk, n, values)`` with ``size`` values a chunk (the last may
    have fewer).

    Rows are ranged by (key, value, row), so a key that holds a third of all rows lies in as many ranges as its
    share asks for. A row's rank is its place in the range plus the key's rows in earlier ranges; only those counts, one for each key and
    range, are summed. No array outgrows ``size``. The ranged rows are written to the shared folder once.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(value).alias("value"), F.monotonically_increasing_id().alias("row"))
    ranged = materialize(rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "key", "value", "row")
                         .sortWithinPartitions("key", "value", "row").drop("row")
                         .withColumn("place", F.monotonically_increasing_id()), "gathered")
    part = F.shiftright("place", 33)  # the id's upper bits are the range's number
    parts = ranged.groupBy("key", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("begin"))
    before = F.sum("n").over(Window.partitionBy("key").orderBy("part")) - F.col("n")  # a row a range
    offsets = parts.select(F.col("key").alias("k"), F.col("part").alias("p"), (before - F.col("begin")).alias("shift"))
    ranks = ranged.join(offsets, F.col("key").eqNullSafe(F.col("k")) & (part == F.col("p"))).select(
        "key", "value", (F.col("place") + F.col("shift")).alias("rank"))
    chunks = ranks.groupBy("key", F.floor(F.col("rank") / size).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("v"))
    return chunks.select(F.col("key").alias(key), "chunk", "n", F.col("v.value").alias("values"))


def count_by_key(df: DataFrame, key) -> DataFrame:
    """Rows per key, as a distributed result (never a driver-side map)."""
    k = _col(key)
    return df.groupBy(k).agg(F.count(F.lit(1)).alias("count"))


def count_by_position(df: DataFrame, position: int, out: str = "key") -> DataFrame:
    """Rows per value of the column at 0-based ``position``, the value shown
    as text and a NULL shown as ``"null"`` (like ``String.valueOf``)."""
    name = df.columns[position]
    key = F.coalesce(F.col(name).cast("string"), F.lit("null")).alias(out)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
