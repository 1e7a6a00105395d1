"""Query shapes that take more than one built-in call; the others are plain DataFrame code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from maskmetrics.operators.lookup import lookup_join, measure, spread_of
from maskmetrics.operators.ordering import running, running_dense_rank, running_sum
from maskmetrics.session import settle


def top_n(df: DataFrame, n: int, by: str, key: str, ties: bool = False) -> DataFrame:
    """The ``n`` largest rows; with ``ties`` also those equal to the last of them."""
    top = df.orderBy(F.desc(by), key).limit(n)
    if not ties:
        return top
    return df.where(F.col(by) >= top.agg(F.min(by).alias("edge")).scalar())


def selected_value(column: str) -> Column:
    """The value of a column where a group holds exactly one, else null."""
    return F.when(F.count_distinct(column) == 1, F.max(column))


def with_group_value(df: DataFrame, keys: Sequence[str], value: Column, out: str) -> DataFrame:
    """Every row with an aggregate of its group. Aggregating first keeps a hot group from
    passing through one window task."""
    totals = settle(df.groupBy(*keys).agg(value.alias(out)), "totals")
    joined = lookup_join(df, totals, list(keys), spread_of(df), measure(totals), "inner")
    return joined.select(*df.columns, out)


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, out: str = "share") -> DataFrame:
    total = with_group_value(df, keys, F.sum(value), "_total")
    return total.withColumn(out, F.try_divide(F.col(value).cast("double"), F.col("_total").cast("double"))) \
        .drop("_total")


def scaled_to_largest(df: DataFrame, group: str, value: str, out: str = "width") -> DataFrame:
    """The largest value of a group is 100, the others in proportion."""
    top = with_group_value(df, [group], F.max(value), "_max")
    width = F.try_divide(F.col(value).cast("double") * 100, F.col("_max").cast("double"))
    return top.withColumn(out, width).drop("_max")


def _back_to_rows(df: DataFrame, per_value: DataFrame, keys: Sequence[str], *out: str) -> DataFrame:
    """Give each row what was worked out for its value; nulls meet nulls."""
    same = F.lit(True)
    named = per_value.select(*(F.col(k).alias(f"_{i}_key") for i, k in enumerate(keys)), *out)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(named[f"_{i}_key"])
    return df.join(named, same).select(*df.columns, *out)


def ranked_within(df: DataFrame, within: Sequence[str], by: str, out: str = "rank",
                  dense_out: str = "dense_rank") -> DataFrame:
    """Rank and dense rank by ``by`` descending inside each group.

    Equal values are counted first, so a value that very many rows share is one row of the
    windows.
    """
    per_value = df.groupBy(*within, by).agg(F.count("*").alias("_n"))
    ranked = running(per_value, within, F.desc(by), _upto=running_sum("_n"), **{dense_out: running_dense_rank(by)})
    ranked = ranked.withColumn(out, F.col("_upto") - F.col("_n") + 1)
    return _back_to_rows(df, ranked, [*within, by], out, dense_out)


def running_to_here(df: DataFrame, within: Sequence[str], order: str, value: str,
                    out: str = "so_far") -> DataFrame:
    """Sum over the rows of the group whose ``order`` is not larger than this row's."""
    per_value = df.groupBy(*within, order).agg(F.sum(value).alias("_sum"))
    summed = running(per_value, within, F.asc(order), **{out: running_sum("_sum")})
    return _back_to_rows(df, summed, [*within, order], out)


def year_to_date(df: DataFrame, key: Sequence[str], date: str, value: str,
                 out: str = "ytd") -> DataFrame:
    """Running total per key and year, at one row per date."""
    daily = df.groupBy(*key, date).agg(F.sum(value).alias(value))
    # At most one row per day of the year and key reaches a window.
    w = Window.partitionBy(*key, F.year(date)).orderBy(date) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn(out, F.sum(value).over(w))


def same_period_last_year(df: DataFrame, key: Sequence[str], month: str, value: str,
                          out: str = "last_year") -> DataFrame:
    """The value of the same month one year before; null where there is none."""
    before = df.select(*key, F.add_months(month, 12).alias(month), F.col(value).alias(out))
    return df.join(before, [*key, month], "left")


def joined_values(df: DataFrame, by: Sequence[str], value: str, separator: str = ", ",
                  out: str = "joined") -> DataFrame:
    """The distinct values of a group as one text, in order."""
    return df.select(*by, value).distinct().groupBy(*by).agg(
        F.array_join(F.array_sort(F.collect_list(value)), separator).alias(out))
