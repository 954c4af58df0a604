"""Key figures of any period from a prefix table.

One row a day and entity: running sums and counts up to the day, and for every power of
two the largest and smallest values of that many days from the day on.  A period's sums
are the difference of two rows, and its extremes come from two overlapping stretches of a
power of two, so a period of any length is answered from at most four rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.functions import scalars as S

DATE, CITY = "date", "city_name"
# Days of the longest stretch kept: 2 ** 15 days are 89 years.
MAX_LEVEL = 15


def daily_measures(rows: DataFrame, key: str = CITY, date: str = DATE) -> DataFrame:
    """One row per entity and date: the measures of all its rows, mergeable."""
    v = S.nan_to_null
    return rows.where(F.col(key).isNotNull() & F.col(date).isNotNull()).groupBy(key, date).agg(
        F.max(v("temperature_max")).alias("hi"), F.min(v("temperature_min")).alias("lo"),
        F.max(v("uv_index_max")).alias("uv"),
        F.coalesce(F.sum(S.tenths("precipitation_sum")), F.lit(0)).cast("long").alias("rain"),
        F.count_if(v("precipitation_sum") > 0).alias("rainy"),
        F.coalesce(F.sum(S.tenths("humidity_mean")), F.lit(0)).cast("long").alias("hum"),
        F.count(S.tenths("humidity_mean")).alias("hums"), F.count(F.lit(1)).alias("n"))


SUMS, HIGH, LOW = ("rain", "rainy", "hum", "hums", "n"), ("hi", "uv"), ("lo",)


def prefix_table(rows: DataFrame, key: str = CITY, date: str = DATE, max_level: int = MAX_LEVEL) -> DataFrame:
    """(key, date, sums up to the date, ``hi``/``uv``/``lo``: arrays whose entry k is the
    extreme of 2**k days from the date on).

    Every day from an entity's first to its last has a row, missing ones without values,
    so stretches are found by date alone.  Rows of one entity and day are aggregated
    first, so an entity's window holds its days however many rows it has; all running
    sums and levels use the one sorting.  Entry k is null where no day has a value, and
    an array ends at the first level that reaches past the entity's last day.
    """
    days = daily_measures(rows, key, date)
    spans = days.groupBy(key).agg(F.min(date).alias("first"), F.max(date).alias("last"))
    calendar = spans.select(key, "first", "last", F.explode(F.sequence("first", "last")).alias(date))
    full = calendar.join(days, [key, date], "left")
    order = Window.partitionBy(key).orderBy(date)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = full.select("*", *[F.sum(F.coalesce(c, F.lit(0))).over(upto).alias(f"sum_{c}") for c in SUMS])
    levels = {c: [c] for c in (*HIGH, *LOW)}
    for k in range(1, max_level + 1):
        step = 1 << (k - 1)
        more = {}
        for c in levels:
            below, best = levels[c][-1], F.least if c in LOW else F.greatest
            more[f"{c}_{k}"] = best(F.col(below), F.lead(below, step).over(order))
            levels[c].append(f"{c}_{k}")
        full = full.withColumns(more)
    # The levels whose stretch ends by the last day.
    inside = F.floor(F.log2(F.datediff("last", date) + 1)).cast("int") + 1
    return full.select(key, date, "first", "last", *[f"sum_{c}" for c in SUMS],
                       *[F.slice(F.array(*cols), F.lit(1), F.least(inside, F.lit(max_level + 1))).alias(c)
                         for c, cols in levels.items()])


def period_kpis_of(prefix: DataFrame, periods: DataFrame, key: str = CITY, start: str = "start", end: str = "end",
                   by: Sequence[str] = ("period_id",), date: str = DATE) -> DataFrame:
    """The key figures of every row of ``periods`` (``by``, key, start, end; both dates
    included): what ``period_kpis`` gives for the entity's rows in the period, one row each.

    A period is cut to the entity's days and looks up its first day, the day its second
    stretch begins and the days before and at its end: an equi-join on (key, date), no
    scan of the period.  A period without a day of the entity, and an unknown entity,
    has no extremes, sum 0 and no mean.
    """
    bounds = prefix.groupBy(key).agg(F.min("first").alias("_first"), F.max("last").alias("_last"))
    asked = periods.join(bounds, key, "left").select(
        *by, key, F.greatest(F.col(start), "_first").alias("_from"), F.least(F.col(end), "_last").alias("_to"),
        (F.col("_first").isNotNull() & (F.greatest(F.col(start), "_first") <= F.least(F.col(end), "_last"))).alias("_any"))
    length = F.datediff("_to", "_from") + 1
    # The longest stretch that fits; longer periods than the table's levels take several.
    level = F.least(F.floor(F.log2(length)).cast("int"), F.lit(MAX_LEVEL))
    asked = asked.withColumn("_k", F.when(F.col("_any"), level))
    size = F.call_function("shiftleft", F.lit(1), F.col("_k"))
    begins = F.concat(F.transform(F.sequence(F.lit(0), F.floor((length - 1) / size).cast("int")),
                                  lambda i: F.least(F.date_add(F.col("_from"), i * size), F.date_sub(F.date_add("_to", 1), size))))
    wanted = F.concat(
        F.transform(F.array_distinct(begins), lambda d: F.struct(d.alias(date), F.lit(0).alias("sign"), F.lit(True).alias("stretch"))),
        F.array(F.struct(F.col("_to").alias(date), F.lit(1).alias("sign"), F.lit(False).alias("stretch")),
                F.struct(F.date_sub("_from", 1).alias(date), F.lit(-1).alias("sign"), F.lit(False).alias("stretch"))))
    probes = asked.select(*by, key, "_k", F.explode(F.when(F.col("_any"), wanted)).alias("p")).select(
        *by, key, "_k", f"p.{date}", "p.sign", "p.stretch")
    got = probes.join(prefix.drop("first", "last"), [key, date])

    def extreme(c, best):
        return best(F.when(F.col("stretch"), F.get(F.col(c), F.col("_k"))))

    found = got.groupBy(*by).agg(
        *[F.sum(F.col(f"sum_{c}") * F.col("sign")).alias(c) for c in SUMS],
        extreme("hi", F.max).alias("hi"), extreme("lo", F.min).alias("lo"), extreme("uv", F.max).alias("uv"))
    return periods.select(*by).join(found, list(by), "left").select(
        *by,
        S.round_half_even("hi", 1).alias("max_temperature"), S.round_half_even("lo", 1).alias("min_temperature"),
        S.ratio_round_half_even(F.coalesce("rain", F.lit(0)), F.lit(10)).cast("double").alias("total_precipitation"),
        F.coalesce("rainy", F.lit(0)).alias("rainy_days"),
        S.ratio_round_half_even(F.when(F.col("hums") > 0, F.col("hum")), F.col("hums") * 10).cast("double").alias("avg_humidity"),
        S.round_half_even("uv", 1).alias("max_uv"))
