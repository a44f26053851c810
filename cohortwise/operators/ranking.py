"""Ranking within groups that stays parallel when one group is huge.

Groups are split by size: a map-side combined count lists the groups with
more rows than a threshold (at most rows / threshold of them, broadcast behind
the size check). Those go through a two-level computation whose windows only
see one row per distinct date; all other groups take a single window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.plans.sizing import small_side

HOT_ROWS = 50_000  # rows of one group above which it is ranked in two levels


def hot_groups(df: DataFrame, keys: Sequence[str], threshold: int = HOT_ROWS) -> DataFrame:
    """The keys of groups with more than ``threshold`` rows; at most rows / threshold of them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > threshold).select(*keys)


def split_hot(
    df: DataFrame, keys: Sequence[str], threshold: int | None, hot: DataFrame | None = None
) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of ordinary groups, rows of groups with more than ``threshold`` rows), None for none.

    ``hot``: the hot groups by some of the keys, counted beforehand. Where no
    group is hot, ``df`` stays as it lies: an anti join and a union would only
    lose its partitioning.
    """
    if hot is None:
        if not threshold:
            return None, df
        hot = hot_groups(df, keys, threshold)
    if hot.isEmpty():
        return df, None
    hot = small_side(hot)
    return tuple(df.join(hot, hot.columns, how).select(*df.columns) for how in ("left_anti", "left_semi"))


def _both(plain: DataFrame | None, two_level: DataFrame | None) -> DataFrame:
    if plain is None or two_level is None:
        return two_level if plain is None else plain
    return plain.unionByName(two_level)


def _order(cols):
    return [F.col(c).asc_nulls_first() for c in cols]


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, hot_threshold: int | None = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """SQL ``RANK() OVER (PARTITION BY keys ORDER BY order)`` (ascending,
    nulls first): ties share a rank and gaps follow.

    Ordinary groups use the window directly. For hot groups, rank = 1 +
    number of rows of the group with a strictly smaller order value: rows are
    first counted per (keys, order value), combined map-side, so the window
    only sorts distinct order values (for dates: at most one row per day)
    instead of every row of the group, and the join back is an equi join that
    AQE can split when skewed. ``hot_threshold=None`` uses the two-level form
    for every group; ``hot`` names the hot groups, by some of the keys, where
    they have been counted beforehand.
    """
    keys, order = list(keys), list(order)
    normal, hot = split_hot(df, keys, hot_threshold, hot)
    if normal is not None:
        normal = normal.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(*_order(order))).cast("int"))
    return _both(normal, None if hot is None else _rank_two_level(hot, keys, order, name))


def _rank_two_level(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    counts = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    cols = keys + order
    ranks = counts.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)],
        (F.coalesce(F.sum("_n").over(w), F.lit(0)) + 1).cast("int").alias(name),
    )
    cond = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(cols)]
    return df.join(ranks, cond, "inner").select(*df.columns, name)


def row_number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    lead: int = 1,
    hot_threshold: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """SQL ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` (ascending,
    nulls first).

    Ordinary groups use the window directly. Hot groups are numbered in two
    levels: the first ``lead`` order columns (dates) form a bucket; rows are
    counted per (keys, bucket); a window over these counts -- at most one row
    per distinct bucket value, bounded by the calendar -- gives each bucket
    the number of rows before it, and a row_number inside (keys, bucket) over
    the remaining order columns completes the numbering. Rows that tie on
    every order column are interchangeable, so the numbering equals the
    one-level window's.

    By default every group is numbered in two levels: splitting off hot
    groups needs an extra pass over ``df`` to count them, which only pays
    when ``df`` is materialized; pass ``hot_threshold`` to split, or ``hot``
    where the hot groups, by some of the keys, are known.
    """
    keys, order = list(keys), list(order)
    normal, hot = split_hot(df, keys, hot_threshold, hot)
    if normal is not None:
        normal = normal.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(order))).cast("int"))
    return _both(normal, None if hot is None else _row_number_two_level(hot, keys, order, name, lead))


def _row_number_two_level(df: DataFrame, keys: list[str], order: list[str], name: str, lead: int) -> DataFrame:
    lead_cols, rest = order[:lead], order[lead:]
    bucket = keys + lead_cols
    counts = df.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in lead_cols]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        *[F.col(c).alias(f"_b{i}") for i, c in enumerate(bucket)],
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"),
    )
    inner = Window.partitionBy(*bucket).orderBy(*[F.col(c).asc_nulls_first() for c in rest] or [F.lit(1)])
    cond = [F.col(c).eqNullSafe(F.col(f"_b{i}")) for i, c in enumerate(bucket)]
    return (
        df.join(offsets, cond, "inner")
        .withColumn(name, (F.col("_offset") + F.row_number().over(inner)).cast("int"))
        .select(*df.columns, name)
    )


def rank_and_number(
    df: DataFrame, keys: Sequence[str], rank_order: Sequence[str], order: Sequence[str], rank: str, number: str,
    facts: str = "facts", hot: DataFrame | None = None,
) -> DataFrame:
    """``rank_within(df, keys, rank_order)``, then a row for each struct of the
    sorted array ``facts``, then ``row_number_within`` by ``order`` and the
    structs' fields, for rows that differ in ``keys`` and ``order``.

    ``order`` starts with ``rank_order``, so one sort of the rows as they were
    before the arrays were laid out serves both: a row's first number is the sum
    of the array sizes before it. ``hot``: the hot groups by some of the keys;
    their rows take the two-level forms.
    """
    keys, rank_order, order = list(keys), list(rank_order), list(order)
    if order[: len(rank_order)] != rank_order:
        raise ValueError("order has to start with rank_order")
    fields = df.schema[facts].dataType.elementType.names
    columns = [c for c in df.columns if c != facts]
    normal, hot = split_hot(df, keys, HOT_ROWS, hot)
    if normal is not None:
        so_far = Window.partitionBy(*keys).orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        normal = normal.withColumn("_before", F.sum(F.size(facts)).over(so_far) - F.size(facts))
        normal = normal.withColumn(rank, F.rank().over(Window.partitionBy(*keys).orderBy(*_order(rank_order))).cast("int"))
        normal = normal.select(*columns, rank, "_before", F.posexplode(facts).alias("_at", "_fact")).select(
            *columns, rank, *[F.col(f"_fact.{f}").alias(f) for f in fields],
            (F.col("_before") + F.col("_at") + 1).cast("int").alias(number),
        )
    if hot is not None:
        hot = rank_within(hot, keys, rank_order, rank, hot_threshold=None).select(*columns, rank, F.inline(facts))
        hot = row_number_within(hot, keys, [*order, *fields], number)
    return _both(normal, hot)
