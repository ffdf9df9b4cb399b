"""Overlapping account versions made disjoint.

The daily balance needs at most one version of an account per day. Delivered
versions may overlap, nest or start together; a sweep over their starts and
ends cuts time into segments and gives each segment to one version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import lit_date
from ledgerline.operators.fx import FIRST_DAY, LAST_DAY, OPEN_END, day_bucket

#: Days per sweep: versions of one account meet only inside such a stretch of time.
SWEEP_DAYS = 366


def disjoint_versions(accounts: DataFrame, key: str = "account_rk", first: str = "data_actual_date",
                      last: str = "data_actual_end_date", days: int = SWEEP_DAYS) -> DataFrame:
    """The versions with disjoint validity, the columns of ``accounts``.

    Precedence: on a day that several versions cover, the one that started
    last counts; of those the one that ends first (the more specific); of
    those the one with the greatest other columns, in their order. A version
    covered in its middle by another one comes back in two pieces; one that
    is nowhere on top does not come back; rows equal in everything are one.
    An open end (NULL) reaches to 9999-12-31 and is NULL again where the last
    piece ends there. Versions that end before they start, or without key or
    start, cover no day.

    Each version is cut into stretches of ``days`` days, the sweep runs per
    (account, stretch) over the sorted starts and ends, and pieces of one
    version that touch are joined again, so what a task holds of an account
    is bounded by the versions of one stretch.
    """
    rest = [c for c in accounts.columns if c not in (key, first, last)]
    end = F.coalesce(F.col(last), lit_date(OPEN_END))
    # the fields in the order of precedence: the greatest counts
    rank = F.struct(F.unix_date(first).alias("start"), (-F.unix_date(end)).alias("minus_end"),
                    F.struct(*rest).alias("rest"), F.col(last).isNull().alias("open"))
    stretch = F.explode(F.sequence(day_bucket(F.col(first), days), day_bucket(end, days)))
    cut = accounts.where(F.col(key).isNotNull() & (F.col(first) <= end)).select(key, rank.alias("v"), stretch.alias("s"))
    outer = lambda day: day_bucket(lit_date(day), days)
    low = F.when(F.col("s") > outer(FIRST_DAY), F.col("s") * days)
    high = F.when(F.col("s") < outer(LAST_DAY), F.col("s") * days + days - 1)
    piece = F.struct(F.greatest(F.col("v.start"), low).alias("a"), F.least(-F.col("v.minus_end"), high).alias("b"), "v")
    swept = cut.groupBy(key, "s").agg(F.collect_set(piece).alias("p")).withColumn("cuts", F.array_sort(F.array_distinct(
        F.concat(F.transform("p", lambda x: x["a"]), F.transform("p", lambda x: x["b"] + 1)))))

    def segment(i):
        at = F.get("cuts", i)
        on = F.filter("p", lambda x: (x["a"] <= at) & (x["b"] >= at))
        return F.struct(at.alias("a"), (F.get("cuts", i + 1) - 1).alias("b"),
                        F.array_max(F.transform(on, lambda x: x["v"])).alias("v"))

    segments = F.transform(F.sequence(F.lit(0), F.size("cuts") - 2), segment)
    found = swept.select(key, F.inline(F.filter(segments, lambda x: x["v"].isNotNull())))
    by_time = Window.partitionBy(key).orderBy("a")
    goes_on = F.lag("v").over(by_time).eqNullSafe(F.col("v")) & (F.lag("b").over(by_time) + 1 == F.col("a"))
    starts = found.withColumn("goes_on", F.coalesce(goes_on, F.lit(False)))
    number = F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(by_time)
    whole = starts.withColumn("number", number).groupBy(key, "number").agg(
        F.min("a").alias("a"), F.max("b").alias("b"), F.first("v").alias("v"))
    open_end = F.col("v.open") & (F.col("b") == F.unix_date(lit_date(OPEN_END)))
    return whole.select(key, F.date_from_unix_date("a").alias(first),
                        F.when(~open_end, F.date_from_unix_date("b")).alias(last), "v.rest.*").select(*accounts.columns)
