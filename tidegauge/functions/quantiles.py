"""Exact discrete quantiles in two scans: a mergeable sketch brackets the ranks, one exact pass counts.

Spark's quantile summaries say within which values a rank must lie. The exact pass counts what is below the bracket and
hands on the few values inside, a share of some BRACKET of the rows; the rank is then found among these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import cut_lineage

#: The summary's relative error is 1 / ACCURACY; the bracket reaches BRACKET to both sides of the rank.
ACCURACY = 2_000
BRACKET = 2 / ACCURACY
#: Distinct values inside a bracket that one task ranks; more are narrowed by histograms first.
RANKED = 500_000
BINS = 65_536
#: Linear levels after the first. A bin of the first level spans a fifteenth of a factor of two, which holds
#: fewer than 2^49 doubles; three times 16 bits then leave one or two neighbouring values.
LINEAR_LEVELS = 3


def _magnitude_bin(value: Column) -> Column:
    """An order-keeping bin by sign and size: 15 for each factor of two, some 65,000 in all; NaN is the largest."""
    size = (F.log2(F.abs(value)) + 1100) * 15
    size = F.when(F.abs(value) == float("inf"), 40_000.0).otherwise(size)
    return F.when(F.isnan(value), 50_000).when(value == 0, 0).otherwise(F.floor(F.signum(value) * size)).cast("int")


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys..., p, value): the smallest value whose cumulative share reaches p.

    Nulls are left out, NaN is the largest value. `df` is read twice: for the summaries, which combine on the map
    side, and for one count of the rows below and of each value inside the brackets. A bracket that missed its rank, which
    the summaries rule out, would be taken again without bounds.
    """
    keys = list(keys)
    values = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_v"))
    size = F.nanvl("_v", F.lit(float("inf")))
    ends = [min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-BRACKET, BRACKET)]
    summary = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"), F.percentile_approx(size, ends, ACCURACY).alias("_ends"))
    brackets = [
        F.struct(
            F.lit(float(p)).alias("p"),
            (F.lit(float("-inf")) if ends[2 * i] == 0 else F.col("_ends")[2 * i]).alias("_from"),
            (F.lit(float("inf")) if ends[2 * i + 1] == 1 else F.col("_ends")[2 * i + 1]).alias("_to"),
        )
        for i, p in enumerate(probabilities)
    ]
    targets = summary.filter("_total > 0").select(*keys, "_total", F.explode(F.array(*brackets)).alias("_b"))
    rank = F.greatest(F.ceil(F.col("_b.p") * F.col("_total")), F.lit(1)).alias("_rank")
    targets = targets.select(*keys, F.col("_b.p").alias("p"), rank, F.col("_b._from").alias("_from"), F.col("_b._to").alias("_to"))

    found = _counted(values, targets, keys)
    check = found.groupBy(*keys, "p", "_rank").agg(
        F.sum(F.when(~F.col("_inside"), F.col("_n")).otherwise(0)).alias("_low"),
        F.sum("_n").alias("_upto"),
        F.count_if("_inside").alias("_distinct"),
    )
    worst = check.agg(F.max("_distinct").alias("most"), F.count_if((F.col("_low") >= F.col("_rank")) | (F.col("_upto") < F.col("_rank"))).alias("missed")).first()
    if worst.missed:
        whole = targets.withColumns({"_from": F.lit(float("-inf")), "_to": F.lit(float("inf"))})
        found = _counted(values, whole, keys)
        worst = found.groupBy(*keys, "p").agg(F.count("*").alias("n")).agg(F.max("n").alias("most")).first()
    below = Window.partitionBy(*keys, "p").orderBy("_inside", "_v").rowsBetween(Window.unboundedPreceding, 0)
    if (worst.most or 0) > RANKED:
        found = _narrowed(found, keys)
    upto = F.sum("_n").over(below)
    ranked = found.select(*keys, "p", "_rank", "_v", "_n", "_inside", upto.alias("_upto"))
    hit = ranked.filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
    return hit.select(*keys, "p", F.col("_v").alias("value"))


def _counted(values: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, p, _rank, _inside, _v, _n): rows below each bracket in one row, and each value inside it with its rows."""
    size = F.nanvl("v._v", F.lit(float("inf")))
    condition = size <= F.col("t._to")
    for key in keys:
        condition = condition & F.col(f"v.{key}").eqNullSafe(F.col(f"t.{key}"))
    # One row per key and probability; without keys that is len(probabilities) rows.
    rows = values.alias("v").join((targets if keys else F.broadcast(targets)).alias("t"), condition)
    inside = size >= F.col("t._from")
    counted = rows.groupBy(
        *[F.col(f"t.{k}").alias(k) for k in keys], "t.p", "t._rank", inside.alias("_inside"), F.when(inside, F.col("v._v")).alias("_v")
    ).agg(F.count(F.lit(1)).alias("_n"))
    return cut_lineage(counted)


def _narrowed(found: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `found` that hold the rank, with what lies below them, for brackets of very many values.

    Each level counts the rows of at most BINS bins and goes on with the bin that holds the rank; only bin counts
    are shuffled, whatever the distribution.
    """
    same = [*keys, "p", "_rank"]
    upto = Window.partitionBy(*keys, "p").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    now = found.filter("_inside")
    below = found.filter(~F.col("_inside")).groupBy(*same).agg(F.sum("_n").alias("_low"))
    zero = F.lit(0).cast("long")

    def matched(left: DataFrame, right: DataFrame) -> DataFrame:
        condition = F.lit(True)
        for k in same:
            condition = condition & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        return left.alias("l").join(right.alias("r"), condition, "left")

    for level in range(LINEAR_LEVELS + 1):
        if level:
            ends = now.groupBy(*same).agg(F.min("_v").alias("_from"), F.max("_v").alias("_to"))
            share = F.try_divide(F.col("l._v") - F.col("r._from"), F.col("r._to") - F.col("r._from"))
            place = F.coalesce(F.least(F.floor(share * BINS), F.lit(BINS - 1)), F.lit(0))
            binned = matched(now, ends).select("l.*", place.alias("_bin"))
        else:
            binned = now.withColumn("_bin", _magnitude_bin(F.col("_v")))
        bins = binned.groupBy(*same, "_bin").agg(F.sum("_n").alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
        bins = matched(bins, below).select("l.*", F.coalesce("r._low", zero).alias("_low"))
        held = bins.filter((F.col("_low") + F.col("_upto") >= F.col("_rank")) & (F.col("_low") + F.col("_upto") - F.col("_n") < F.col("_rank")))
        held = cut_lineage(held.select(*same, F.col("_bin").alias("_held"), (F.col("_low") + F.col("_upto") - F.col("_n")).alias("_low")))
        now = cut_lineage(matched(binned, held).filter("l._bin = r._held").select("l.*").drop("_bin"))
        below = held.select(*same, "_low")
    low = below.select(*same, F.lit(False).alias("_inside"), F.lit(None).cast("double").alias("_v"), F.col("_low").alias("_n"))
    return low.filter("_n > 0").unionByName(now.select(*same, "_inside", "_v", "_n"))
