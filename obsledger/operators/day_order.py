"""Day before month or month before day: what the numeric dates of a file say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions.timestamps import NUMERIC_DATE, local_timestamp

DAY_FIRST, MONTH_FIRST, MIXED, AMBIGUOUS = "day_first", "month_first", "mixed", "ambiguous"


def day_orders(df: DataFrame, by: str, text: str) -> DataFrame:
    """(by, dates, day_order): one row for each value of ``by`` with dates such as 3/4/2024 in column ``text``.

    Dates that only one order can read decide: all for one order give ``day_first`` or ``month_first``, some for each
    give ``mixed``. Where every date can be read both ways, the order whose dates lie within fewer days is taken, as a
    drop covers a short time; equal spans are ``ambiguous``. Texts of other forms and nulls are no evidence, dates
    that neither order can read are only counted. All of it is one hash aggregate with a partial step: rows of a file
    never meet in one task.
    """
    c = F.col(text)
    year, first, second = (F.regexp_extract(c, NUMERIC_DATE, k).cast("int") for k in (3, 1, 2))

    def date(month: Column, day: Column) -> Column:
        return F.to_date(local_timestamp(year, month, day, F.lit(0), F.lit(0)))

    dates = df.filter(c.rlike(NUMERIC_DATE)).select(
        by, date(second, first).alias("__day_first"), date(first, second).alias("__month_first")
    )
    a, b = F.col("__day_first"), F.col("__month_first")
    found = dates.groupBy(by).agg(
        F.count("*").alias("dates"),
        F.count_if(a.isNotNull() & b.isNull()).alias("__only_day"),
        F.count_if(b.isNotNull() & a.isNull()).alias("__only_month"),
        F.date_diff(F.max(a), F.min(a)).alias("__span_day"),
        F.date_diff(F.max(b), F.min(b)).alias("__span_month"),
    )
    day, month = F.col("__only_day") > 0, F.col("__only_month") > 0
    order = (
        F.when(day & month, MIXED)
        .when(day, DAY_FIRST)
        .when(month, MONTH_FIRST)
        .when(F.col("__span_day") < F.col("__span_month"), DAY_FIRST)
        .when(F.col("__span_day") > F.col("__span_month"), MONTH_FIRST)
        .otherwise(AMBIGUOUS)
    )
    return found.select(by, "dates", order.alias("day_order"))
