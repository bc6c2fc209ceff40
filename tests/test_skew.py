"""Paths for very frequent keys give the same results as the plain ones and as brute force."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.functions.quantiles import exact_quantiles
from tidegauge.functions.skew import ordered_positions, split_hot
from tidegauge.operators.cooldown import apply_cooldown
from tidegauge.operators.rolling import rolling_basic, rolling_ml


def rounded(df):
    return sorted(
        tuple(round(v, 9) if isinstance(v, float) else v for v in row)
        for row in df.select(sorted(df.columns)).collect()
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """600 requests, half of them from one source, some at equal times, some without a source."""
    rng = random.Random(7)
    rows, clock = [], 0.0
    for i in range(600):
        clock += rng.choice([0.0, 0.5, 3.0, 11.0, 70.0])
        ip = "10.9.9.9" if i % 2 else rng.choice(["10.0.0.1", "10.0.0.2", None])
        rows.append(
            (i, datetime(2024, 1, 5, 8) + timedelta(seconds=clock), ip, rng.choice(["GET", "POST"]),
             rng.choice(["/a", "/b", "/c", None, f"/x{i}"]), rng.choice([200, 404, 503]), rng.choice([0, 10, None]),
             rng.choice([0.1, 4.0, 9.5, None]), rng.choice(["Robot/1", "curl", None]))
        )
    schema = (
        "event_id bigint, event_timestamp timestamp, source_ip string, method string, url string, "
        "status_code int, bytes_sent int, response_time double, user_agent string"
    )
    return spark.createDataFrame(rows, schema).repartition(5).cache()


def brute_rolling(rows):
    state, out = {}, {}
    for r in sorted(rows, key=lambda r: (r.event_timestamp, r.event_id)):
        s = state.setdefault(r.source_ip, {"rows": [], "urls": set()})
        s["rows"].append(r)
        s["urls"].add(r.url)
        kept = s["rows"]
        age = lambda q: (r.event_timestamp - q.event_timestamp).total_seconds()  # noqa: B023, E731
        ten, twenty = s["rows"][-10:], s["rows"][-20:]
        times = [q.response_time or 0.0 for q in twenty]
        out[r.event_id] = {
            "request_rate": sum(age(q) < 60 for q in kept),
            "burst_rate": sum(age(q) < 10 for q in kept),
            "error_10": sum(q.status_code >= 400 for q in ten) / len(ten),
            "rt_10": sum((q.response_time or 0.0) for q in ten) / len(ten),
            "std": float(np.std(times)),
            "total_bytes": sum(q.bytes_sent or 0 for q in twenty),
            "urls": len(s["urls"]),
            "methods": len({q.method for q in twenty}),
            "agents": len({q.user_agent or "" for q in twenty}),
            "bot": int(any("bot" in (q.user_agent or "").lower() for q in twenty)),
        }
    return out


@pytest.mark.parametrize("hot_rows,block_rows", [(10_000, 10_000), (100, 100), (50, 30)])
def test_rolling_matches_brute_force(skewed, hot_rows, block_rows):
    expected = brute_rolling(skewed.collect())
    sizes = {"hot_rows": hot_rows, "block_rows": block_rows}
    basic = {r.event_id: r for r in rolling_basic(skewed, **sizes).collect()}
    ml = {r.event_id: r for r in rolling_ml(skewed, **sizes).collect()}
    assert set(basic) == set(ml) == set(expected)
    for key, e in expected.items():
        b, m = basic[key], ml[key]
        assert (b.request_rate, b.url_diversity) == (e["request_rate"], e["urls"])
        assert math.isclose(b.error_rate, e["error_10"]) and math.isclose(b.avg_response_time, e["rt_10"])
        assert (m.request_rate, m.burst_rate) == (e["request_rate"], e["burst_rate"])
        assert (m.total_bytes, m.method_diversity, m.agent_diversity, m.is_bot) == (
            e["total_bytes"], e["methods"], e["agents"], e["bot"])
        assert math.isclose(m.std_response_time, e["std"], abs_tol=1e-9)
        assert math.isclose(m.url_entropy, math.log2(e["urls"]))


def test_kept_log_travels_with_its_row(skewed):
    for sizes in ({}, {"hot_rows": 100, "block_rows": 100}):
        wrong = rolling_basic(skewed, keep_log=True, **sizes).filter(
            "sample_log.timestamp <> event_timestamp OR NOT (sample_log.source_ip <=> source_ip)"
        )
        assert wrong.count() == 0


def test_block_must_cover_the_frames(skewed):
    with pytest.raises(ValueError):
        rolling_basic(skewed, block_rows=5)


def test_split_hot_keeps_every_row(skewed):
    ordinary, hot = split_hot(skewed, "source_ip", 90)
    assert hot is not None and ordinary.count() + hot.count() == 600
    assert {r.source_ip for r in hot.select("source_ip").distinct().collect()} >= {"10.9.9.9"}
    assert split_hot(skewed, "source_ip", 1000)[1] is None


def test_ordered_positions_are_ranks(spark, skewed):
    ranked = ordered_positions(skewed, "source_ip", ["event_timestamp", "event_id"])
    from pyspark.sql import Window

    order = Window.partitionBy("source_ip").orderBy("event_timestamp", "event_id")
    wrong = ranked.withColumn("rank", F.row_number().over(order)).filter("rank <> position")
    assert ranked.count() == 600 and wrong.count() == 0


def brute_cooldown(rows, gap):
    last, kept = {}, set()
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        if r[2] not in last or (r[1] - last[r[2]]).total_seconds() >= gap:
            last[r[2]] = r[1]
            kept.add(r[0])
    return kept


@pytest.mark.parametrize("hot_rows", [10**6, 40, 0])
@pytest.mark.parametrize("batch", ["10000", "7"])
def test_cooldown_matches_brute_force(spark, hot_rows, batch):
    rng, rows = random.Random(3), []
    for source in range(30):
        clock = datetime(2024, 1, 1) + timedelta(seconds=rng.random() * 1000)
        pace = rng.choice([0.2, 5, 29, 31, 400])
        for _ in range(rng.choice([1, 30, 90])):
            clock += timedelta(seconds=rng.choice([0, pace, pace * rng.random(), 30]))
            rows.append((len(rows), clock, None if source == 3 else f"ip{source}"))
    alerts = spark.createDataFrame(rows, "event_id bigint, event_timestamp timestamp, source_ip string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = [r.event_id for r in apply_cooldown(alerts.repartition(4), 30, hot_rows).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == len(set(found)) and set(found) == brute_cooldown(rows, 30)


def test_cooldown_edges(spark):
    start = datetime(2024, 1, 1)
    at = lambda s: start + timedelta(microseconds=round(s * 1e6))
    rows = [(0, at(0), "a"), (1, at(29.999999), "a"), (2, at(30), "a"), (3, at(59), "a"), (4, at(60), "a")]
    rows += [(10 + i, at(100 + i / 100), "b") for i in range(100)]
    alerts = spark.createDataFrame(rows, "event_id bigint, event_timestamp timestamp, source_ip string")
    for hot_rows in (1000, 0):
        assert {r.event_id for r in apply_cooldown(alerts, 30, hot_rows).collect()} == {0, 2, 4, 10}


def quantile_disc(values, p):
    values = sorted(values)
    return values[max(math.ceil(p * len(values)), 1) - 1]


def test_exact_quantiles(spark):
    """Several scales, neighbouring doubles, signs, repeats and infinities."""
    rng = np.random.default_rng(1)
    close = [1.0]
    for _ in range(40):
        close.append(float(np.nextafter(close[-1], 2)))
    values = [*rng.exponential(2, 500).tolist(), *[3.25] * 300, 1e12, -5.0, *(10.0 ** rng.uniform(-300, 300, 400)).tolist()]
    values += [*(-(10.0 ** rng.uniform(-20, 20, 100))).tolist(), *close, 0.0, -0.0, 5e-324, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)] + [(None, 0)], "v double, g int")
    points = [0.0, 0.01, 0.25, 0.37, 0.4, 0.5, 0.95, 1.0]
    found = {r.p: r.value for r in exact_quantiles(df, "v", points).collect()}
    assert found == {p: quantile_disc(values, p) for p in points}
    grouped = {(r.g, r.p): r.value for r in exact_quantiles(df, "v", [0.5, 0.9], keys=("g",)).collect()}
    assert grouped == {(g, p): quantile_disc(values[g::3], p) for g in range(3) for p in (0.5, 0.9)}


def test_quantiles_of_one_value(spark):
    df = spark.createDataFrame([(2.5,)] * 4, "v double")
    assert [r.value for r in exact_quantiles(df, "v", [0.5]).collect()] == [2.5]


@pytest.mark.parametrize("ranked", [0, 500_000])
def test_exact_quantiles_of_hard_distributions(spark, monkeypatch, ranked):
    import numpy as np

    from tidegauge.functions import quantiles

    monkeypatch.setattr(quantiles, "RANKED", ranked)  # 0: always narrowed by histograms
    rng = np.random.default_rng(3)
    shapes = {
        "flat": rng.uniform(0, 1, 5000),
        "steep": 10.0 ** rng.uniform(-300, 300, 5000) * rng.choice([-1, 1], 5000),
        "close": np.nextafter(1.0, 2) + np.arange(5000) * np.spacing(1.0),
        "ties": np.repeat([1.0, 2.0, 3.0], [4997, 2, 1]),
        "odd": np.concatenate([[np.inf] * 40, [-np.inf] * 40, [np.nan] * 300, rng.normal(size=4620)]),
        "one": np.array([7.0]),
    }
    rows = [(g, float(v)) for g, values in shapes.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    points = [0.0, 0.0001, 0.5, 0.95, 0.9999, 1.0]

    def at(values, p):
        ordered = sorted(values, key=lambda v: (math.isnan(v), v))
        return ordered[max(math.ceil(p * len(ordered)), 1) - 1]

    same = lambda a, b: a == b or (math.isnan(a) and math.isnan(b))
    found = {(r.g, r.p): r.value for r in exact_quantiles(df, "v", points, keys=("g",)).collect()}
    assert len(found) == len(shapes) * len(points)
    for g, values in shapes.items():
        assert all(same(found[g, p], at(values, p)) for p in points), g
    for r in exact_quantiles(df.filter("g = 'steep'"), "v", points).collect():
        assert r.value == at(shapes["steep"], r.p)


def test_exact_quantiles_scan_the_source_twice(spark, tmp_path):
    from tidegauge.functions import quantiles

    spark.range(20_000).selectExpr("cast(id * 37 % 9973 as double) as v").write.parquet(f"{tmp_path}/t")
    counter = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            counter.add(b.num_rows)
            yield b

    df = spark.read.parquet(f"{tmp_path}/t").mapInArrow(count, "v double")
    assert quantiles.exact_quantiles(df, "v", [0.5, 0.99]).count() == 2
    assert counter.value == 2 * 20_000


@pytest.mark.parametrize("rows", [65, 200])
@pytest.mark.parametrize("hot_rows", [10_000, 100])  # one task a source, or blocks
def test_distinct_values_of_long_frames(spark, rows, hot_rows):
    from tidegauge.sources.logs import normalize_logs

    rng = random.Random(rows)
    agents = [f"agent{min(int(rng.expovariate(0.2)), 40)}" for _ in range(900)]
    data = [(i, datetime(2024, 1, 1) + timedelta(seconds=i // 3), f"ip{i % 2}", rng.choice(["GET", "PUT", None]), "/", 200, 1, 1.0, a) for i, a in enumerate(agents)]
    schema = "event_id bigint, event_timestamp timestamp, source_ip string, method string, url string, status_code int, bytes_sent int, response_time double, user_agent string"
    logs = normalize_logs(spark.createDataFrame(data, schema).withColumn("timestamp", F.lit(None).cast("string")))
    found = {r.event_id: (r.method_diversity, r.agent_diversity) for r in rolling_ml(logs, rows, hot_rows, 250).collect()}
    for ip in range(2):
        mine = [d for d in data if d[2] == f"ip{ip}"]
        for k, d in enumerate(mine):
            frame = mine[max(0, k - rows + 1) : k + 1]
            assert found[d[0]] == (len({x[3] or "GET" for x in frame}), len({x[8] for x in frame}))
