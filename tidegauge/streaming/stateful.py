"""Rolling features and alert cooldown over unbounded streams, one keyed state per group of sources.

Rows are held until the watermark has passed them and then worked on in the order of their times, so rows
that come late within the delay get the same results as in a batch. They are held by slots of event time and leave
slot by slot, so a source with very many rows needs no more memory than one. Sources are dealt over `GROUPS` keys by a hash:
what a key costs beside its rows (calls, conversions, timers) does not grow with the number of sources. Needs the RocksDB state
store (see `build_session`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidegauge.operators.cooldown import spaced
from tidegauge.schema import ML_FEATURES, DetectionConfig

FEATURES = (
    "event_id bigint, source_ip string, event_timestamp timestamp, request_rate bigint, error_rate double, "
    "avg_response_time double, url_diversity bigint, hour_of_day int, day_of_week int"
)


def trailing_mean(values: np.ndarray, rows: int, place: np.ndarray) -> np.ndarray:
    """Mean of the last `rows` values of a source up to each position, summed oldest first as Spark's avg does."""
    padded = np.concatenate([np.zeros(rows - 1), values])
    total = np.zeros(len(values))
    for start in range(rows):
        total = total + np.where(place >= rows - 1 - start, padded[start : start + len(values)], 0.0)
    return total / np.minimum(place + 1, rows)


#: Length of a slot of event time, in which a source's rows are held together, and the parts into which a full one is cut.
SLOT_US = 600_000_000
PARTS = 600
#: Rows over which a slot is full: further ones are held by part, here by second.
FULL_ROWS = 50_000
#: Rows handed on in one frame at most.
FRAME_ROWS = 50_000
#: Keys that sources are dealt over; fixed for the life of a checkpoint.
GROUPS = 1024
#: URLs of a source that are kept in one value of the state; those of a source with more are kept one by one.
PACKED_URLS = 1_000


def _arrow(schema: str) -> pa.Schema:
    """Of a schema string; made on the driver, where such strings can be read."""
    return to_arrow_schema(StructType.fromDDL(schema))


def source_group() -> Column:
    """The key that a source's rows go to."""
    return F.pmod(F.xxhash64("source_ip"), F.lit(GROUPS)).cast("int")


def _by_source(rows: pd.DataFrame) -> tuple[np.ndarray, list[str | None]]:
    """A number for each row's source, and the sources by number; no source is one of its own."""
    codes, sources = pd.factorize(rows["source_ip"], use_na_sentinel=False)
    return codes, [None if pd.isna(source) else source for source in sources]


def _state_key(source: str | None) -> str:
    return "" if source is None else f"/{source}"


def _unpacked(data: bytes, schema: pa.Schema) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(bytes(data)), schema)


class InOrder(StatefulProcessor):
    """Holds the rows of a key until the watermark passes them; `emit` gets them in order, once each.

    A key stands for a group of sources. Rows without the column source_ip belong to the source that the key names.

    State: rows by slot of event time, as the chunks that came in; for each slot its rows, chunks and first time; and
    the time that a timer waits for. What is due leaves slot by slot, a full slot part by part, in frames
    of FRAME_ROWS; what is not due is left as it is, but for the slot that the watermark stands in. So memory is
    bounded by FULL_ROWS and the rows of one part, a second of one group, however long its history.
    """

    held_schema: str

    def __init__(self) -> None:
        self.arrow = _arrow(self.held_schema)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "slot bigint, part int, chunk int", "data binary")
        self.slots = handle.getMapState("slots", "slot bigint", "rows bigint, chunks int, first bigint, split int")
        self.parts = handle.getMapState("parts", "slot bigint, part int", "chunks int")
        self.next = handle.getValueState("next", "ms bigint")

    def _wait(self, us: int) -> None:
        ms = -(-us // 1000)
        waiting = self.next.get()[0] if self.next.exists() else None
        if waiting is None or ms < waiting:
            self.handle.registerTimer(ms)
            self.next.update((ms,))

    def _hold(self, slot: int, rows: pa.RecordBatch) -> None:
        us = rows.column("us").to_numpy()
        n, chunks, first, split = self.slots.getValue((slot,)) or (0, 0, int(us[0]), 0)
        if n <= FULL_ROWS:
            self.held.updateValue((slot, -1, chunks), (rows.serialize().to_pybytes(),))
            chunks += 1
        else:
            split, parts = 1, (us - slot * SLOT_US) * PARTS // SLOT_US
            for part in np.unique(parts).tolist():
                before = (self.parts.getValue((slot, part)) or (0,))[0]
                self.held.updateValue((slot, part, before), (rows.filter(pa.array(parts == part)).serialize().to_pybytes(),))
                self.parts.updateValue((slot, part), (before + 1,))
        self.slots.updateValue((slot,), (n + len(rows), chunks, min(first, int(us.min())), split))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for chunk in rows:
            chunk = chunk if "source_ip" in chunk else chunk.assign(source_ip=key[0])
            batch = pa.RecordBatch.from_pandas(chunk[self.arrow.names], self.arrow, preserve_index=False)
            us = batch.column("us").to_numpy()
            slots = us // SLOT_US
            found = np.unique(slots).tolist()
            for slot in found:
                self._hold(slot, batch.filter(pa.array(slots == slot)) if len(found) > 1 else batch)
            first = int(us.min()) if first is None else min(first, int(us.min()))
        if first is not None:
            self._wait(first)
        return iter([])

    def _taken(self, slot: int, part: int, chunks: int) -> list[pa.RecordBatch]:
        """The chunks of a slot or part, which the state gives up."""
        out = []
        for chunk in range(chunks):
            out.append(_unpacked(self.held.getValue((slot, part, chunk))[0], self.arrow))
            self.held.removeKey((slot, part, chunk))
        return out

    def _slot_rows(self, slot: int, chunks: int, split: int) -> Iterator[pa.Table]:
        """The rows of a slot, which leaves the state, in pieces whose times follow one another."""
        whole = pa.Table.from_batches(self._taken(slot, -1, chunks), self.arrow)
        self.slots.removeKey((slot,))
        if not split:
            yield whole
            return
        place = (whole["us"].to_numpy() - slot * SLOT_US) * PARTS // SLOT_US
        order = np.argsort(place, kind="stable")
        edges = np.searchsorted(place[order], np.arange(PARTS + 1))
        for part in range(PARTS):
            count = self.parts.getValue((slot, part))
            early = whole.take(pa.array(order[edges[part] : edges[part + 1]]))
            if count:
                late = pa.Table.from_batches(self._taken(slot, part, count[0]), self.arrow)
                self.parts.removeKey((slot, part))
                early = pa.concat_tables([early, late])
            if len(early):
                yield early

    def _due(self, passed: int) -> Iterator[pa.Table]:
        """All rows up to the time `passed`, in pieces whose times follow one another; what is later in a slot is held anew."""
        for slot, (_, chunks, first, split) in sorted((k[0], tuple(v)) for k, v in self.slots.iterator()):
            if first > passed:
                continue
            later = []
            for rows in self._slot_rows(slot, chunks, split):
                due = rows["us"].to_numpy() <= passed
                if not due.all():
                    later.append(rows.filter(pa.array(~due)))
                    rows = rows.filter(pa.array(due))
                if len(rows):
                    yield rows
            for rows in later:
                self._hold(slot, rows.combine_chunks().to_batches()[0])

    def _frames(self, key, pieces: list[pa.Table]) -> Iterator[pd.DataFrame]:
        rows = pa.concat_tables(pieces).to_pandas(integer_object_nulls=True).sort_values(["us", "event_id"], ignore_index=True)
        for start in range(0, len(rows), FRAME_ROWS):
            yield self.emit(key, rows.iloc[start : start + FRAME_ROWS].reset_index(drop=True) if len(rows) > FRAME_ROWS else rows)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.next.clear()
        ready, size = [], 0
        for rows in self._due(timerValues.getCurrentWatermarkInMs() * 1000):
            if ready and size + len(rows) > FRAME_ROWS:
                yield from self._frames(key, ready)
                ready, size = [], 0
            ready.append(rows)
            size += len(rows)
        if ready:
            yield from self._frames(key, ready)
        waiting = [v[2] for _, v in self.slots.iterator()]
        if waiting:
            self._wait(min(waiting))

    def close(self) -> None:
        pass


class _Past:
    """Rows of a frame put behind the last ones of their sources, source by source.

    `rows` are those rows; `place` is a row's place in its source; `at` says for each row of the frame which one it is. `younger`
    holds for spans of seconds how many requests of the source up to a row are younger, `urls` how many URLs it has had.
    """

    def __init__(self, rows: pd.DataFrame, place: np.ndarray, at: np.ndarray, younger: dict[int, np.ndarray], urls: np.ndarray):
        self.rows, self.place, self.at, self.younger, self.urls = rows, place, at, younger, urls


class _Rolling(InOrder):
    """State besides, for each source: the last requests, the times of the last minute's, the URLs seen and how many they are.

    URLs lie beside the rest until they are more than PACKED_URLS; from then on each is an entry of its own.
    """

    lookback: int
    recent_schema: str

    def __init__(self, url_ttl_ms: int | None):
        super().__init__()
        self.recent_arrow = _arrow(self.recent_schema)
        self.url_arrow = _arrow("url string, us bigint")
        self.no_urls = pa.RecordBatch.from_pylist([], self.url_arrow).serialize().to_pybytes()
        self.url_ttl_us = None if url_ttl_ms is None else url_ttl_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.sources = handle.getMapState("sources", "source string", "rows binary, times binary, urls binary, count bigint, swept bigint")
        self.urls = handle.getMapState("urls", "source string, url string", "us bigint")

    def _urls_so_far(self, source: str, urls: np.ndarray, us: np.ndarray, first: np.ndarray, packed, count: int, swept: int):
        """How many URLs the source has had up to each row; and the packed ones, their number and when old ones were dropped.

        `first` marks the first row of a URL in the frame. URLs last seen longer ago than they are to be remembered are dropped
        once in half that time.
        """
        alone = packed is None
        known = {} if alone else dict(zip(*(c.to_pylist() for c in _unpacked(packed, self.url_arrow).columns), strict=True))
        now = int(us[0])
        if self.url_ttl_us is not None and now - swept >= self.url_ttl_us // 2:
            least, swept = now - self.url_ttl_us, now
            if alone:
                old = [k for k, v in self.urls.iterator() if k[0] == source and v[0] < least]
                for k in old:
                    self.urls.removeKey(k)
                count -= len(old)
            else:
                known = {url: seen for url, seen in known.items() if seen >= least}
                count = len(known)
        new = first.copy()
        if count:
            new[first] = [not self.urls.containsKey((source, url)) if alone else url not in known for url in urls[first]]
        so_far = count + np.cumsum(new)
        # Times ascend: of several the last one counts.
        seen = dict(zip(urls, us.tolist())) if self.url_ttl_us else dict(zip(urls[new], us[new].tolist()))
        known.update(seen)
        count = int(so_far[-1])
        if alone or count > PACKED_URLS:
            for url, when in known.items():
                self.urls.updateValue((source, url), (when,))
            return so_far, None, count, swept
        if seen:
            columns = [pa.array(known.keys(), pa.string()), pa.array(known.values(), pa.int64())]
            packed = pa.RecordBatch.from_arrays(columns, schema=self.url_arrow).serialize().to_pybytes()
        return so_far, packed, count, swept

    def _with_past(self, frame: pd.DataFrame) -> _Past:
        """What the sources of a frame have had so far; remembers anew the last requests, the times of a minute and the URLs."""
        codes, sources = _by_source(frame)
        order = np.argsort(codes, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(sources)))]).tolist()
        us, url = frame["us"].to_numpy(np.int64)[order], frame["url"].to_numpy(object)[order]
        first = ~pd.DataFrame({"source": codes[order], "url": url}).duplicated().to_numpy()
        rows = pa.RecordBatch.from_pandas(frame[self.recent_arrow.names], self.recent_arrow, preserve_index=False).take(pa.array(order))
        urls, younger = np.empty(len(us), np.int64), {60: np.empty(len(us), np.int64), 10: np.empty(len(us), np.int64)}
        pieces, kept = [], []
        for source, start, end in zip(map(_state_key, sources), edges, edges[1:]):
            own, now = rows.slice(start, end - start), us[start:end]
            past = self.sources.getValue((source,))
            if past:
                old, before = _unpacked(past[0], self.recent_arrow), np.frombuffer(bytes(past[1]), np.int64)
                past = past[2:]
            else:
                old, before = own.slice(0, 0), now[:0]
                past = (self.no_urls, 0, int(now[0]))
            times = np.concatenate([before, now])
            for seconds, found in younger.items():
                gone = np.searchsorted(times, now - seconds * 1_000_000, side="right")
                found[start:end] = np.arange(len(before) + 1, len(times) + 1) - gone
            urls[start:end], *seen = self._urls_so_far(source, url[start:end], now, first[start:end], *past)
            last = own.slice(max(0, len(own) - self.lookback))
            if len(last) < self.lookback and len(old):
                both = pa.Table.from_batches([old.slice(max(0, len(old) + len(last) - self.lookback)), last])
                last = both.combine_chunks().to_batches()[0]
            minute = int(np.searchsorted(times, now[-1] - 60_000_000, side="right"))
            self.sources.updateValue((source,), (last.serialize().to_pybytes(), times[minute:].tobytes(), *seen))
            pieces += [old, own]
            kept.append(len(old))
        kept, sizes = np.array(kept), np.diff(edges)
        ends = np.cumsum(kept + sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - kept - sizes, kept + sizes)
        at, back = np.empty(len(us), np.int64), np.empty(len(us), np.int64)
        at[order] = np.flatnonzero(place >= np.repeat(kept, kept + sizes))
        back[order] = np.arange(len(us))
        table = pa.Table.from_batches(pieces, self.recent_arrow).to_pandas()
        return _Past(table, place, at, {seconds: found[back] for seconds, found in younger.items()}, urls[back])


class RollingFeatures(_Rolling):
    """The six features of the rules."""

    held_schema = "event_id bigint, source_ip string, us bigint, url string, error int, rt double, hour_of_day int, day_of_week int"
    lookback = 10
    recent_schema = "error int, rt double"

    def emit(self, key, batch: pd.DataFrame) -> pd.DataFrame:
        past = self._with_past(batch)
        mean = lambda name: trailing_mean(past.rows[name].to_numpy(float), 10, past.place)[past.at]
        return pd.DataFrame(
            {
                "event_id": batch["event_id"],
                "source_ip": batch["source_ip"],
                "event_timestamp": pd.to_datetime(batch["us"], unit="us"),
                "request_rate": past.younger[60],
                "error_rate": mean("error"),
                "avg_response_time": mean("rt"),
                "url_diversity": past.urls,
                "hour_of_day": batch["hour_of_day"],
                "day_of_week": batch["day_of_week"],
            }
        )


def _windows(values: np.ndarray, rows: int, place: np.ndarray) -> np.ndarray:
    """The last `rows` values of a source up to each position, NaN where there are fewer."""
    every = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(rows - 1, np.nan), values.astype(float)]), rows)
    return np.where(place[:, None] >= np.arange(rows - 1, -1, -1), every, np.nan)


def _distinct(values: pd.Series, rows: int, place: np.ndarray) -> np.ndarray:
    codes = np.sort(_windows(pd.factorize(values)[0], rows, place), axis=1)
    return 1 + (np.diff(codes, axis=1) > 0).sum(axis=1)  # NaN sorts last and compares false


class RollingModelFeatures(_Rolling):
    """The 19 features of the models."""

    held_schema = (
        "event_id bigint, source_ip string, us bigint, url string, status int, rt double, size bigint, method string, agent string, "
        "hour_of_day int, day_of_week int"
    )
    recent_schema = "status int, rt double, size bigint, method string, agent string"

    def __init__(self, rows: int, url_ttl_ms: int | None):
        super().__init__(url_ttl_ms)
        self.lookback = rows

    def emit(self, key, batch: pd.DataFrame) -> pd.DataFrame:
        past = self._with_past(batch)
        rows, new, n = past.rows, past.at, self.lookback
        status = rows["status"].to_numpy(float)
        last = lambda values: _windows(np.asarray(values), n, past.place)[new]
        share = lambda flags: np.nanmean(last(flags), axis=1)
        rt, size = last(rows["rt"].to_numpy(float)), last(rows["size"].to_numpy(float))
        hour = batch["hour_of_day"]
        found = {
            "request_rate": past.younger[60],
            "burst_rate": past.younger[10],
            "error_rate": share(status >= 400),
            "error_4xx_rate": share((status >= 400) & (status < 500)),
            "error_5xx_rate": share(status >= 500),
            "avg_response_time": np.nanmean(rt, axis=1),
            "max_response_time": np.nanmax(rt, axis=1),
            "std_response_time": np.nanstd(rt, axis=1),
            "avg_bytes": np.nanmean(size, axis=1),
            "total_bytes": np.nansum(size, axis=1).astype(np.int64),
            "url_diversity": past.urls,
            "url_entropy": np.log2(past.urls),
            "method_diversity": _distinct(rows["method"], n, past.place)[new],
            "get_ratio": share(rows["method"] == "GET"),
            "agent_diversity": _distinct(rows["agent"], n, past.place)[new],
            "is_bot": np.nanmax(last(rows["agent"].str.lower().str.contains("bot", regex=False).to_numpy()), axis=1).astype(int),
            "hour_of_day": hour,
            "is_business_hours": hour.between(9, 17).astype(int),
            "is_weekend": (batch["day_of_week"] >= 5).astype(int),
        }
        head = {"event_id": batch["event_id"], "source_ip": batch["source_ip"], "event_timestamp": pd.to_datetime(batch["us"], unit="us")}
        return pd.DataFrame(head | {name: found[name] for name in ML_FEATURES})


def rolling_stateful(
    logs: DataFrame, url_ttl_ms: int | None = None, delay: str = DetectionConfig.watermark
) -> DataFrame:
    """Streaming twin of `rolling_basic`; requests come out once the watermark, `delay` behind, has passed them.

    `url_ttl_ms` bounds the state in event time: a URL last seen longer ago counts anew.
    """
    rows = (
        logs.filter(F.col("event_timestamp").isNotNull())
        .withWatermark("event_timestamp", delay)
        .select(
            source_group().alias("source_group"),
            "event_id",
            "source_ip",
            "event_timestamp",
            # No URL is one of its own, apart from the empty one.
            F.coalesce(F.concat(F.lit("/"), "url"), F.lit("")).alias("url"),
            F.unix_micros("event_timestamp").alias("us"),
            F.when(F.col("status_code") >= 400, 1).otherwise(0).alias("error"),
            F.coalesce("response_time", F.lit(0.0)).alias("rt"),
            F.hour("event_timestamp").alias("hour_of_day"),
            F.weekday("event_timestamp").alias("day_of_week"),
        )
    )
    return rows.groupBy("source_group").transformWithStateInPandas(
        RollingFeatures(url_ttl_ms), FEATURES, "Append", "EventTime", eventTimeColumnName="event_timestamp"
    )


WHOLE = ("method_diversity", "agent_diversity", "is_bot", "hour_of_day", "is_business_hours", "is_weekend")
COUNTED = ("request_rate", "burst_rate", "total_bytes", "url_diversity")
MODEL_FEATURES = "event_id bigint, source_ip string, event_timestamp timestamp, " + ", ".join(
    f"{name} {'int' if name in WHOLE else 'bigint' if name in COUNTED else 'double'}" for name in ML_FEATURES
)


def rolling_ml_stateful(
    logs: DataFrame, rows: int = 20, url_ttl_ms: int | None = None, delay: str = DetectionConfig.watermark
) -> DataFrame:
    """Streaming twin of `rolling_ml`: the 19 model features of each request, in order of event time."""
    needed = (
        logs.filter(F.col("event_timestamp").isNotNull())
        .withWatermark("event_timestamp", delay)
        .select(
            source_group().alias("source_group"),
            "event_id",
            "source_ip",
            "event_timestamp",
            F.coalesce(F.concat(F.lit("/"), "url"), F.lit("")).alias("url"),
            F.unix_micros("event_timestamp").alias("us"),
            F.coalesce("status_code", F.lit(0)).alias("status"),
            F.coalesce("response_time", F.lit(0.0)).alias("rt"),
            F.coalesce("bytes_sent", F.lit(0)).cast("bigint").alias("size"),
            F.coalesce("method", F.lit("GET")).alias("method"),
            F.coalesce("user_agent", F.lit("")).alias("agent"),
            F.hour("event_timestamp").alias("hour_of_day"),
            F.weekday("event_timestamp").alias("day_of_week"),
        )
    )
    return needed.groupBy("source_group").transformWithStateInPandas(
        RollingModelFeatures(rows, url_ttl_ms), MODEL_FEATURES, "Append", "EventTime", eventTimeColumnName="event_timestamp"
    )


class Cooldown(InOrder):
    """State besides: the time of the last kept alert of each source."""

    def __init__(self, gap: int, held_schema: str):
        self.gap, self.held_schema = gap, held_schema
        super().__init__()

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getMapState("last", "source string", "us bigint")

    def emit(self, key, batch: pd.DataFrame) -> pd.DataFrame:
        codes, sources = _by_source(batch)
        us, keep = batch["us"].to_numpy(), np.zeros(len(batch), dtype=bool)
        order = np.argsort(codes, kind="stable")
        edges = np.cumsum(np.bincount(codes, minlength=len(sources)))[:-1]
        for source, rows in zip(map(_state_key, sources), np.split(order, edges), strict=True):
            before = (self.last.getValue((source,)) or (None,))[0]
            keep[rows], last = spaced(us[rows], before, self.gap)
            if last != before:
                self.last.updateValue((source,), (int(last),))
        kept = batch[keep].drop(columns="us")
        return kept.assign(event_timestamp=pd.to_datetime(batch["us"][keep], unit="us"))


def cooldown_stateful(
    alerts: DataFrame, seconds: float = DetectionConfig.cooldown_seconds, delay: str | None = None
) -> DataFrame:
    """Streaming twin of `apply_cooldown`; alerts need event_id, source_ip and event_timestamp.

    Give `delay` unless the alerts have a watermark already, as those of `rolling_stateful` do. Column names must
    not start with an underscore: rows reach the processor as named tuples.
    """
    if delay is not None:
        alerts = alerts.withWatermark("event_timestamp", delay)
    fields = [f for f in alerts.schema if f.name != "event_timestamp"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in alerts.schema)
    held = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "us bigint"])
    timed = alerts.withColumns({"us": F.unix_micros("event_timestamp"), "source_group": source_group()})
    return timed.groupBy("source_group").transformWithStateInPandas(
        Cooldown(int(seconds * 1_000_000), held),
        schema,
        "Append",
        "EventTime",
        eventTimeColumnName="event_timestamp",
    )
