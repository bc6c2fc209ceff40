"""Per-source features of every request from the requests just before it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import agent_matches, is_client_error, is_error, is_server_error
from tidegauge.functions.skew import HOT_ROWS, ordered_positions, split_hot
from tidegauge.schema import ML_FEATURES

SECOND = 1_000_000
BLOCK_ROWS = 1_000_000
#: Frames of more rows count their distinct values by when each comes again, shorter ones by collecting them.
COLLECTED = 64


class Frames:
    """Window specifications over one partitioning, all served by one sort on (_us, event_id)."""

    def __init__(self, part: list[str], rates: bool = True):
        self.ordered = Window.partitionBy(*part).orderBy("_us", "event_id")
        self.by_time = Window.partitionBy(*part).orderBy("_us")
        self.rates = rates

    def last(self, expr: Column, rows: int) -> Column:
        return expr.over(self.ordered.rowsBetween(1 - rows, 0))

    def distinct(self, column: str, rows: int) -> Column:
        """Distinct values among the last rows.

        By with_turnover, the work per row does not depend on the frame: of the rows so far, those do not count whose value
        came again within the frame, and those that the frame has left without its coming again before.
        """
        if rows <= COLLECTED:
            return F.size(self.last(F.collect_set(column), rows))
        so_far = self.ordered.rowsBetween(Window.unboundedPreceding, 0)
        left = self.ordered.rowsBetween(Window.unboundedPreceding, -rows)
        gone = F.sum(f"{column}_again").over(so_far) + F.coalesce(F.sum(f"{column}_ends").over(left), F.lit(0))
        return (F.row_number().over(self.ordered) - gone).cast("int")

    def recent(self, seconds: int) -> Column:
        """Requests so far that are younger than `seconds`.

        Rank minus the number of expired rows: both frames only grow, so the work per row is
        constant however many requests fall into the interval.
        """
        if not self.rates:
            return F.col(f"_recent_{seconds}")
        expired = F.count(F.lit(1)).over(
            self.by_time.rangeBetween(Window.unboundedPreceding, -seconds * SECOND)
        )
        return F.row_number().over(self.ordered) - expired


def with_turnover(logs: DataFrame, part: list[str], columns: tuple[str, ...], rows: int) -> DataFrame:
    """For long frames, whether each row's value came within `rows` rows before (_again), and does not come within `rows` after (_ends)."""
    if rows <= COLLECTED:
        return logs
    place = F.row_number().over(Window.partitionBy(*part).orderBy("_us", "event_id"))
    marked = logs.withColumn("_place", place)
    for column in columns:
        same = Window.partitionBy(*part, column).orderBy("_place")
        before, after = F.lag("_place").over(same), F.lead("_place").over(same)
        again = F.coalesce(F.col("_place") - before <= rows, F.lit(False))
        ends = F.coalesce(after - F.col("_place") > rows, F.lit(True))
        marked = marked.withColumns({f"{column}_again": again.cast("int"), f"{column}_ends": ends.cast("int")})
    return marked.drop("_place")


def with_recent(rows: DataFrame, seconds: int) -> DataFrame:
    """Add `_recent_<seconds>`, the requests so far that are younger, for sources of any size.

    Time is cut into slots as long as the interval. Within a slot lie the slot's requests and, as expiry
    marks, those of the slot before: what is left of them plus the rank in the slot is the count. So one
    source's requests spread over as many tasks as there are slots.
    """
    slot = F.floor(F.col("_us") / (seconds * SECOND))
    events = rows.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("_gone"))
    events = events.withColumns(
        {
            "_slot": slot + F.col("_gone").cast("int"),
            "_at": F.col("_us") + F.when(F.col("_gone"), seconds * SECOND).otherwise(0),
        }
    )
    part = Window.partitionBy("source_ip", "_slot")
    so_far = part.orderBy("_at", F.desc("_gone"), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    counted = events.withColumn(
        f"_recent_{seconds}",
        F.count_if("_gone").over(part) - F.count_if("_gone").over(so_far) + F.count_if(~F.col("_gone")).over(so_far),
    )
    return counted.filter(~F.col("_gone")).drop("_gone", "_slot", "_at")


def _share(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def _basic(frames: Frames) -> dict[str, Column]:
    return {
        "request_rate": frames.recent(60),
        "error_rate": frames.last(_share(is_error()), 10),
        "avg_response_time": frames.last(F.avg("_rt"), 10),
    }


def _ml(rows: int) -> Callable[[Frames], dict[str, Column]]:
    def features(frames: Frames) -> dict[str, Column]:
        last = lambda expr: frames.last(expr, rows)
        return {
            "request_rate": frames.recent(60),
            "burst_rate": frames.recent(10),
            "error_rate": last(_share(is_error())),
            "error_4xx_rate": last(_share(is_client_error())),
            "error_5xx_rate": last(_share(is_server_error())),
            "avg_response_time": last(F.avg("_rt")),
            "max_response_time": last(F.max("_rt")),
            "std_response_time": last(F.stddev_pop("_rt")),
            "avg_bytes": last(F.avg("_bytes")),
            "total_bytes": last(F.sum("_bytes")),
            "method_diversity": frames.distinct("_method", rows),
            "get_ratio": last(_share(F.col("_method") == "GET")),
            "agent_diversity": frames.distinct("_agent", rows),
            "is_bot": last(F.max(agent_matches(("bot",), "_agent").cast("int"))),
        }

    return features


def _one_task_per_source(logs: DataFrame, features, uniques: tuple[str, ...], lookback: int) -> DataFrame:
    """One shuffle on source_ip serves the (source, URL) window and the frames."""
    frames = Frames(["source_ip"])
    per_url = Window.partitionBy("source_ip", "url").orderBy("_us", "event_id")
    return (
        with_turnover(logs.repartition("source_ip"), ["source_ip"], uniques, lookback)
        .withColumn("_new_url", (F.row_number().over(per_url) == 1).cast("int"))
        .withColumns(
            {
                **features(frames),
                "url_diversity": F.sum("_new_url").over(
                    frames.ordered.rowsBetween(Window.unboundedPreceding, 0)
                ),
            }
        )
        .drop("_new_url")
    )


def _blocks_per_source(logs: DataFrame, features, halo: int, block_rows: int, uniques: tuple[str, ...]) -> DataFrame:
    """Exact features for sources too large for one task.

    Each source is cut into blocks of consecutive requests; the last `halo` rows of a block are
    also copied into the next one, which is all that frames of rows look back; rates are counted
    before, by time. The lifetime URL count
    is the count carried into the block plus the URLs first seen in it, both added as mark rows.
    """
    ranked = ordered_positions(with_recent(with_recent(logs, 60), 10), "source_ip", ["_us", "event_id"])
    block = F.floor((F.col("position") - 1) / block_rows)
    own = block.alias("_own")
    reaches_next = (F.col("position") - 1) % block_rows >= block_rows - halo
    rows = ranked.select("*", own).select(
        "*",
        F.explode(
            F.when(reaches_next, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))
        ).alias("_block"),
    )

    firsts = ranked.groupBy("source_ip", "url").agg(F.min("position").alias("position"))
    firsts = firsts.select("source_ip", block.alias("_block"), "position", F.lit(1).cast("bigint").alias("_mark"))
    last_block = F.floor((F.max("position") - 1) / block_rows)
    empty = (
        ranked.groupBy("source_ip")
        .agg(last_block.alias("_last"))
        .select("source_ip", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")).alias("_block"), F.lit(0).alias("_n"))
    )
    per_block = (
        firsts.select("source_ip", "_block", F.lit(1).alias("_n"))
        .unionByName(empty)
        .groupBy("source_ip", "_block")
        .agg(F.sum("_n").alias("_n"))
    )
    before = Window.partitionBy("source_ip").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(
        "source_ip",
        "_block",
        F.lit(-1).cast("bigint").alias("position"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_mark"),
    )

    seen = Window.partitionBy("source_ip", "_block").orderBy("position", F.desc("_is_mark"))
    marks = firsts.unionByName(carried).withColumn("_is_mark", F.lit(True))
    both = (
        rows.withColumns({"_mark": F.lit(0).cast("bigint"), "_is_mark": F.lit(False)})
        .unionByName(marks, allowMissingColumns=True)
        .repartition("source_ip", "_block")
        .withColumn("url_diversity", F.sum("_mark").over(seen.rowsBetween(Window.unboundedPreceding, 0)))
    )
    part = ["source_ip", "_block", "_is_mark"]
    return (
        with_turnover(both, part, uniques, halo + 1).withColumns(features(Frames(part, rates=False)))
        .filter(~F.col("_is_mark") & (F.col("_block") == F.col("_own")))
        .drop("position", "_own", "_block", "_mark", "_is_mark", "_recent_60", "_recent_10")
    )


def _rolling(
    logs: DataFrame, inputs: list, features, lookback: int, hot_rows: int, block_rows: int, uniques: tuple[str, ...] = ()
) -> DataFrame:
    """Key columns, `inputs` and the features; requests without a time have no place in the order."""
    if block_rows < lookback:
        raise ValueError("a block must hold at least as many rows as a frame looks back")
    needed = logs.filter(F.col("event_timestamp").isNotNull()).select(
        "event_id",
        "event_timestamp",
        "source_ip",
        "url",
        "status_code",
        F.unix_micros("event_timestamp").alias("_us"),
        F.coalesce("response_time", F.lit(0.0)).alias("_rt"),
        *inputs,
    )
    ordinary, hot = split_hot(needed, "source_ip", hot_rows)
    result = _one_task_per_source(ordinary, features, uniques, lookback)
    if hot is not None:
        result = result.unionByName(_blocks_per_source(hot, features, lookback - 1, block_rows, uniques))
    return result


def rolling_basic(
    logs: DataFrame,
    keep_log: bool = False,
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Six features per request for the rule detector; `keep_log` carries the request as `sample_log`."""
    log = F.struct(
        F.col("event_timestamp").alias("timestamp"),
        *["source_ip", "method", "url", "status_code", "bytes_sent", "response_time", "user_agent"],
    ).alias("sample_log")
    frames = _rolling(logs, [log] if keep_log else [], _basic, 10, hot_rows, block_rows)
    return frames.select(
        "event_id",
        "source_ip",
        "event_timestamp",
        "request_rate",
        "error_rate",
        "avg_response_time",
        "url_diversity",
        F.hour("event_timestamp").alias("hour_of_day"),
        F.weekday("event_timestamp").alias("day_of_week"),
        *(["sample_log"] if keep_log else []),
    )


def rolling_ml(
    logs: DataFrame,
    rows: int = 20,
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The 19 model features per request."""
    inputs = [
        F.coalesce("bytes_sent", F.lit(0)).alias("_bytes"),
        F.coalesce("method", F.lit("GET")).alias("_method"),
        F.coalesce("user_agent", F.lit("")).alias("_agent"),
    ]
    frames = _rolling(logs, inputs, _ml(rows), rows, hot_rows, block_rows, ("_method", "_agent"))
    hour = F.hour("event_timestamp")
    return frames.withColumns(
        {
            "url_entropy": F.log2("url_diversity"),
            "hour_of_day": hour,
            "is_business_hours": hour.between(9, 17).cast("int"),
            "is_weekend": (F.weekday("event_timestamp") >= 5).cast("int"),
        }
    ).select("event_id", "source_ip", "event_timestamp", *ML_FEATURES)


def pseudo_labels(
    features: DataFrame, min_rate: float = 50, min_error_rate: float = 0.5, min_burst: float = 30
) -> DataFrame:
    """Rule-made training label per request: fast and failing, or a burst."""
    attack = (
        (F.col("request_rate") > min_rate) & (F.col("error_rate") > min_error_rate)
    ) | (F.col("burst_rate") > min_burst)
    return features.withColumn("is_attack", attack.cast("int"))
