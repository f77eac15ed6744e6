"""Stateful operators with ring buffers, event-time timers and expiry.

Each is a processor over the rows of one key, or of a hash bucket of keys; its rows in a micro-batch, bounded by the trigger's
caps, come as one frame and are handled as arrays. State lives in the RocksDB store: start such queries inside `state_store`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from motorpool.functions.timefmt import floor_seconds
from motorpool.plans.health import WINDOW_SECONDS, Fusion
from motorpool.plans.models import SEQUENCE_LENGTH
from motorpool.streaming.stateful import gold_of_states

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; a running query keeps the provider it was started with."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _frame(batches, order: list[str]) -> pd.DataFrame:
    parts = list(batches)
    return (parts[0] if len(parts) == 1 else pd.concat(parts)).sort_values(order, ignore_index=True)


#: Hash buckets that share a state; a call into Python and its store is made for each of them, not for each key.
BUCKETS = 1024
#: Window frames averaged at once.
_FRAMES = 1 << 14


def _bucket(key) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


# -- window error -------------------------------------------------------------------------


class _WindowError(StatefulProcessor):
    """Keeps, for all keys of a hash bucket, the last ``length - 1`` row errors (the first one repeated in front of a short
    history) and the last valid value of each feature."""

    def __init__(self, features, means, scales, components, length):
        self.features, self.means, self.scales = features, np.array(means), np.array(scales)
        self.components, self.length = np.array(components), length

    def init(self, handle):
        self.held = handle.getValueState("held", "keys array<string>, fill binary, errors binary")

    def handleInputRows(self, key, rows, timerValues):
        back, width = self.length - 1, len(self.features)
        batch = pd.concat(list(rows), ignore_index=True)
        code, names = pd.factorize(batch["key"])
        order = np.lexsort((batch["event_id"].to_numpy(), batch["micros"].to_numpy(), code))
        batch, code = batch.iloc[order], code[order]
        keys, fill, errors = self.held.get() if self.held.exists() else ([], b"", b"")
        keys, fill, errors = list(keys), np.frombuffer(fill).reshape(-1, width), np.frombuffer(errors).reshape(-1, back)
        place = {k: i for i, k in enumerate(keys)}
        at = np.array([place.get(k, -1) for k in names])
        fresh, known = np.flatnonzero(at < 0), np.flatnonzero(at >= 0)
        n, ends = len(names), np.cumsum(np.bincount(code, minlength=len(names)))
        begins = np.append(0, ends[:-1])
        # the carried values stand in front of each key's rows; each cell then takes its key's last valid row at or above it
        front, mine = begins + np.arange(n), np.arange(len(code)) + code + 1
        x = np.full((len(code) + n, width), np.nan)
        x[front[known]] = fill[at[known]]
        x[mine] = batch[self.features].to_numpy(np.float64)
        owner = np.repeat(front, ends - begins + 1)[:, None]
        valid = np.where(np.isnan(x), owner, np.arange(len(x))[:, None])
        x = np.take_along_axis(x, np.maximum.accumulate(valid, axis=0), axis=0)
        last, x = x[ends + np.arange(n)], x[mine]
        z = (np.where(np.isnan(x), self.means, x) - self.scales[:, 0]) / self.scales[:, 1]
        gap = z - (z @ self.components) @ self.components.T
        own = (gap * gap).sum(axis=1) / width
        carried = np.repeat(own[begins][:, None], back, axis=1)
        carried[known] = errors[at[known]]
        line, mine = np.empty(len(own) + back * n), np.arange(len(own)) + back * (code + 1)
        line[(begins + back * np.arange(n))[:, None] + np.arange(back)] = carried
        line[mine] = own
        means = np.empty(len(own))
        frames = np.lib.stride_tricks.sliding_window_view(line, self.length)
        for some in (slice(i, i + _FRAMES) for i in range(0, len(own), _FRAMES)):
            means[some] = frames[mine[some] - back].mean(axis=1)
        tails = line[(ends + back * np.arange(1, n + 1) - back)[:, None] + np.arange(back)]
        fill, errors = (np.concatenate([old, new[fresh]]) for old, new in ((fill, last), (errors, tails)))
        fill[at[known]], errors[at[known]] = last[known], tails[known]
        self.held.update((keys + [names[i] for i in fresh], fill.tobytes(), errors.tobytes()))
        yield pd.DataFrame({"event_id": batch["event_id"].to_numpy(), "error": means})

    def close(self):
        pass


def window_errors(
    df: DataFrame, features: list[str], means: list[float], scales: list[tuple[float, float]], components: list[list[float]],
    length: int = SEQUENCE_LENGTH,
) -> DataFrame:
    """Reconstruction error of the last ``length`` rows for every row of a stream (``event_id, error``).

    Input ``source_id, module, ts, event_id`` and the features. Missing values take the key's last valid value, then the
    mean; ``scales`` are (mean, standard deviation) per feature and ``components`` one row of weights per feature. The
    window and the fill values go on across micro-batches, as `operators.windows.impute` and `plans.models.window_error`
    do over the whole history; rows of a key must not come in a later micro-batch than rows that follow them.
    """
    # as JSON, which leaves out what is null: a missing vehicle or module is a key of its own
    name = F.to_json(F.struct("source_id", "module"))
    slim = df.select(_bucket(name), name.alias("key"), F.unix_micros("ts").alias("micros"), "event_id", *[F.col(f).cast("double").alias(f) for f in features])
    # dividing by no spread would give no number; batch scaling uses 1 there
    scales = [(m, s if s else 1.0) for m, s in scales]
    step = _WindowError(list(features), means, scales, components, length)
    return slim.groupBy("bucket").transformWithStateInPandas(step, "event_id long, error double", "Append", "None")


# -- health windows with timers -----------------------------------------------------------


class _ClosedWindows(StatefulProcessor):
    """Open windows wait for the watermark; a timer at the next window's end closes it, one after the silence clears all."""

    def __init__(self, seconds: int, silence_seconds: int):
        self.width, self.silence = seconds * 1000, silence_seconds * 1000

    def init(self, handle):
        self.handle = handle
        # open: {window start ms: {module: [ts, event_id, health, features]}}; carried: {module: [health, features, event_id]}
        self.state = handle.getValueState("windows", "open string, carried string, seen long")

    def _load(self):
        if not self.state.exists():
            return {}, {}, 0
        waiting, carried, seen = self.state.get()
        return {int(k): v for k, v in json.loads(waiting).items()}, json.loads(carried), seen

    def _wait(self, waiting, carried, seen):
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.state.update((json.dumps(waiting), json.dumps(carried), seen))
        self.handle.registerTimer(min(waiting) + self.width if waiting else seen + self.silence)

    def handleInputRows(self, key, rows, timerValues):
        batch = _frame(rows, ["micros", "event_id"])
        waiting, carried, seen = self._load()
        newest = batch.drop_duplicates(["start", "module"], keep="last")
        for row in newest[["start", "module", "micros", "event_id", "health", "features"]].to_numpy(object).tolist():
            start, module, *state = row
            states = waiting.setdefault(start, {})
            if module not in states or states[module][:2] <= state[:2]:
                states[module] = state
        seen = max(seen, int(batch["micros"].iloc[-1]) // 1000)
        self._wait(waiting, carried, seen)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs()
        waiting, carried, seen = self._load()
        out = []
        for start in sorted(w for w in waiting if w + self.width <= mark):
            states = waiting.pop(start)
            carried.update({m: [h, f, eid] for m, (_, eid, h, f) in states.items()})
            out.append((key[0], start, max(s[1] for s in states.values()), json.dumps(carried)))
        if not waiting and seen + self.silence <= mark:
            self.state.clear()
        else:
            self._wait(waiting, carried, seen)
        if out:
            yield pd.DataFrame(out, columns=["source_id", "start", "seq", "cache"])

    def close(self):
        pass


def closed_health_windows(df: DataFrame, delay: str = "10 minutes", fusion: Fusion | None = None, seconds: int = WINDOW_SECONDS,
                          silence_seconds: int = 7 * 86_400) -> DataFrame:
    """One final gold row per vehicle and window, once the watermark (``delay`` behind the newest row) has passed its end.

    Input ``source_id, module, ts, event_id, health, features``. Rows later than the watermark are dropped by the
    engine. The state of a vehicle that was silent for ``silence_seconds`` is cleared; it then starts without carried
    module states.
    """
    fusion = fusion or Fusion()
    slim = df.select(
        "source_id", "module", "ts", "event_id", "health", F.to_json("features").alias("features"),
        F.unix_micros("ts").alias("micros"), F.unix_millis(floor_seconds(F.col("ts"), seconds)).alias("start"),
    ).withWatermark("ts", delay)
    out = "source_id string, start long, seq long, cache string"
    rows = slim.groupBy("source_id").transformWithStateInPandas(_ClosedWindows(seconds, silence_seconds), out, "Append", "EventTime")
    return gold_of_states(rows.withColumn("window_ts", F.timestamp_millis("start")), fusion)


# -- observer cards -----------------------------------------------------------------------


class _Card(StatefulProcessor):
    """Running counts of the vehicles of a hash bucket and the newest ``keep`` rows of each of their modules."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle):
        # [vehicle, accepted, rejected, latency sum, latency rows, seen, {module: [[ts, event_id, payload], ...]}], ...
        self.held = handle.getValueState("held", "cards string")

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["micros", "event_id"], ignore_index=True)
        code, names = pd.factorize(batch["source_id"], use_na_sentinel=False)
        names = [None if pd.isna(x) else x for x in names]
        cards = {c[0]: c for c in (json.loads(self.held.get()[0]) if self.held.exists() else [])}
        n, good, late = len(names), batch["accepted"].to_numpy(bool), batch["latency"].to_numpy(np.float64)
        timed = good & ~np.isnan(late)
        number = lambda mask: np.bincount(code[mask], minlength=n).tolist()
        sums = np.bincount(code[timed], late[timed], minlength=n).tolist()
        newest = pd.Series(batch["micros"].to_numpy()[good]).groupby(code[good]).max().to_dict()
        for i, (acc, rej, rows_timed) in enumerate(zip(number(good), number(~good), number(timed))):
            card = cards.setdefault(names[i], [names[i], 0, 0, 0.0, 0, -1, {}])
            seen = newest.get(i)
            card[1:6] = card[1] + acc, card[2] + rej, card[3] + sums[i], card[4] + rows_timed, card[5] if seen is None else max(card[5], int(seen))
        fresh = batch[["module", "micros", "event_id", "payload"]][good].assign(code=code[good])
        fresh = fresh.groupby(["code", "module"], sort=False).tail(self.keep).dropna(subset="module")
        # a missing number turns its whole column into floats
        whole = lambda c: [None if pd.isna(x) else int(x) for x in fresh[c].tolist()]
        for i, module, *row in zip(fresh["code"].tolist(), fresh["module"].tolist(), whole("micros"), whole("event_id"), fresh["payload"].tolist()):
            cards[names[i]][6].setdefault(module, []).append(row)
        for i, module in dict.fromkeys(zip(fresh["code"].tolist(), fresh["module"].tolist())):
            rows_of = cards[names[i]][6]
            rows_of[module] = sorted(rows_of[module], key=lambda r: [(x is None, x) for x in r[:2]])[-self.keep :]
        self.held.update((json.dumps(list(cards.values())),))
        touched = [cards[x] for x in names]
        out = ["source_id", "accepted", "rejected", "latency_sum", "latency_rows", "seen"]
        yield pd.DataFrame({c: [card[i] for card in touched] for i, c in enumerate(out)} | {"history": [json.dumps(card[6]) for card in touched]})

    def close(self):
        pass


def observer_cards(accepted: DataFrame, rejected: DataFrame, keep: int = 300) -> DataFrame:
    """Running picture per vehicle from the streams of accepted and rejected rows, in update mode: the last card counts.

    ``accepted`` has ``source_id, module, ts, event_id, latency, payload`` (text), ``rejected`` needs ``source_id, ts,
    event_id``. ``history`` maps each module to its newest ``keep`` rows, oldest first; the last one is its latest payload.
    A card's ``seq`` grows with what the vehicle has sent.
    """
    good = accepted.select("source_id", "module", F.unix_micros("ts").alias("micros"), "event_id", F.col("latency").cast("double").alias("latency"), "payload", F.lit(True).alias("accepted"))
    none = [F.lit(None).cast(k).alias(c) for c, k in (("latency", "double"), ("payload", "string"))]
    bad = rejected.select("source_id", F.lit("").alias("module"), F.unix_micros("ts").alias("micros"), "event_id", *none, F.lit(False).alias("accepted"))
    out = "source_id string, accepted long, rejected long, latency_sum double, latency_rows long, seen long, history string"
    rows = good.unionByName(bad).withColumn("bucket", _bucket("source_id"))
    cards = rows.groupBy("bucket").transformWithStateInPandas(_Card(keep), out, "Update", "None")
    rows = F.from_json("history", "map<string,array<array<string>>>")
    kept = F.transform_values(rows, lambda _, v: F.transform(v, lambda r: F.struct(F.timestamp_micros(r[0].cast("long")).alias("ts"), r[1].cast("long").alias("event_id"), r[2].alias("payload"))))
    seen = F.when(F.col("seen") >= 0, F.timestamp_micros("seen"))
    return cards.withColumns({"history": kept, "last_seen": seen, "seq": F.col("accepted") + F.col("rejected")}).drop("seen")
