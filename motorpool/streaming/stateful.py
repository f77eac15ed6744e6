"""Stateful streaming forms of smoothing, alerts and vehicle health.

Each keeps per key what its batch form derives from the whole history. Rows of one key
inside a micro-batch are put in order first; the micro-batch is bounded by the trigger caps.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.functions.numeric import round_py
from motorpool.functions.scoring import EMA_ALPHA, SCORE_DELTAS, SCORE_MAX, SCORE_MIN
from motorpool.functions.timefmt import floor_seconds
from motorpool.plans.alerts import TOP_FEATURES, alert_id
from motorpool.plans.health import Fusion, fused, with_top_features
from motorpool.sources.tables import latest_per_key


def _ordered(batches, order):
    import pandas as pd

    return pd.concat(list(batches)).sort_values(order)


def smooth(df: DataFrame, error: str = "error", risk: str = "risk", alpha: float = EMA_ALPHA) -> DataFrame:
    """Exponential smoothing and persistence count carried between micro-batches.

    Input ``source_id, module, ts, event_id`` and the two measures; the persistence rule is
    the one of `scoring.persistence_inputs`.
    """

    def step(_key, batches, state):
        rows = _ordered(batches, ["ts", "event_id"])
        ema, count = state.get if state.exists else (0.0, 0.0)
        emas, counts = [], []
        for x, r in zip(rows[error].to_numpy(), rows[risk].to_numpy()):
            ema = alpha * x + (1 - alpha) * ema
            count = count + 1 if r >= 0.8 else max(0.0, count - 1) if r >= 0.5 else 0.0
            emas.append(ema)
            counts.append(count)
        state.update((float(ema), float(count)))
        yield rows[["event_id"]].assign(ema=emas, persistence=counts)

    slim = df.select("source_id", "module", "ts", "event_id", error, risk)
    return slim.groupBy("source_id", "module").applyInPandasWithState(
        step, "event_id bigint, ema double, persistence double", "ema double, count double", "append", "NoTimeout"
    )


_ALERT_STATE = "score double, active boolean, empties bigint, start timestamp, peak timestamp, top double, feats string"
_ALERT_OUT = (
    "source_id string, module string, excursion bigint, status string, alert_start_ts timestamp, alert_end_ts timestamp, "
    "peak_anomaly_ts timestamp, max_composite_score double, feats string, seq bigint"
)


def alerts(df: DataFrame) -> DataFrame:
    """Leaky-bucket alerts; at most one payload per alert and micro-batch, the last one.

    Input ``source_id, module, ts, event_id, severity, comp, top_features``.
    """

    def step(key, batches, state):
        import pandas as pd

        rows = _ordered(batches, ["ts", "event_id"])
        if state.exists:
            score, active, empties, start, peak, top, feats = state.get
            feats = json.loads(feats)
        else:
            score, active, empties, start, peak, top, feats = 0.0, False, 0, None, None, 0.0, {}
        last = {}
        for ts, eid, sev, comp, text in rows[["ts", "event_id", "severity", "comp", "top_features"]].itertuples(index=False):
            score = min(SCORE_MAX, max(SCORE_MIN, score + SCORE_DELTAS.get(sev, 0.0)))
            if score > SCORE_MIN:
                start = ts if start is None else start
                for name, v in _features(text).items():
                    feats[name] = feats.get(name, 0.0) + v
                if comp > top:
                    top, peak = comp, ts
                active = active or score >= SCORE_MAX
                if active:
                    last[empties] = ("OPEN", start, None, peak, top, json.dumps(feats), eid)
            else:
                if active:
                    last[empties] = ("CLOSED", start, ts, peak, top, json.dumps(feats), eid)
                active, start, peak, top, feats, empties = False, None, None, 0.0, {}, empties + 1
        state.update((float(score), bool(active), int(empties), start, peak, float(top), json.dumps(feats)))
        if last:
            cols = ["status", "alert_start_ts", "alert_end_ts", "peak_anomaly_ts", "max_composite_score", "feats", "seq"]
            out = pd.DataFrame(list(last.values()), columns=cols)
            out.insert(0, "excursion", list(last))
            out.insert(0, "module", key[1])
            out.insert(0, "source_id", key[0])
            for c in ("alert_start_ts", "alert_end_ts", "peak_anomaly_ts"):
                out[c] = pd.to_datetime(out[c])
            yield out

    slim = df.select(F.col("source_id").cast("string"), "module", "ts", "event_id", "severity", "comp", "top_features")
    raw = slim.groupBy("source_id", "module").applyInPandasWithState(step, _ALERT_OUT, _ALERT_STATE, "append", "NoTimeout")
    entries = F.map_entries(F.from_json("feats", "map<string,double>"))
    ranked = F.sort_array(F.transform(entries, lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k"))), asc=False)
    best = F.map_from_entries(F.transform(F.slice(ranked, 1, TOP_FEATURES), lambda e: F.struct(e["k"], round_py(e["v"], 4))))
    return raw.select(
        alert_id(["source_id", "module"], "alert_start_ts").alias("alert_id"), "source_id", "module", "excursion", "status",
        "alert_start_ts", "alert_end_ts", "peak_anomaly_ts", round_py(F.col("max_composite_score"), 4).alias("max_composite_score"),
        best.alias("top_10_features"), "seq",
    )


def _features(text) -> dict:
    try:
        return json.loads(text) if text else {}
    except ValueError:
        return {}


def health_windows(df: DataFrame, fusion: Fusion | None = None, seconds: int = 300) -> DataFrame:
    """Gold rows per vehicle and window, from module states that survive between micro-batches.

    Input ``source_id, module, ts, event_id, health, features``. A window split over two
    micro-batches is written twice; readers keep the row with the highest ``seq``.
    """
    fusion = fusion or Fusion()
    mods = list(fusion.weights)
    state_type = "cache string"
    out = "source_id string, window_ts timestamp, seq bigint, cache string"

    def step(key, batches, state):
        import pandas as pd

        rows = _ordered(batches, ["ts", "event_id"])
        cache = json.loads(state.get[0]) if state.exists else {}
        wins, seqs, caches = [], [], []
        for win, m, h, f, eid in rows[["window_ts", "module", "health", "features", "event_id"]].itertuples(index=False):
            cache[m] = [h, f, eid]
            # Rows come in time order: the last one of a window leaves the window's final states.
            if wins and wins[-1] == win:
                seqs[-1], caches[-1] = max(seqs[-1], eid), json.dumps(cache)
            else:
                wins.append(win)
                seqs.append(eid)
                caches.append(json.dumps(cache))
        state.update((json.dumps(cache),))
        yield pd.DataFrame({"source_id": key[0], "window_ts": wins, "seq": seqs, "cache": caches})

    slim = df.filter(F.col("module").isin(*mods)).select(
        "source_id", floor_seconds(F.col("ts"), seconds).alias("window_ts"), "module", "ts", "event_id", "health", F.to_json("features").alias("features")
    )
    rows = slim.groupBy("source_id").applyInPandasWithState(step, out, state_type, "append", "NoTimeout")
    return gold_of_states(rows, fusion)


def gold_of_states(rows: DataFrame, fusion: Fusion) -> DataFrame:
    """Gold rows from ``source_id, window_ts, seq, cache``, the cache being JSON of module -> [health, features, id]."""
    mods = list(fusion.weights)
    cache = F.from_json("cache", "map<string,array<string>>")
    for m in mods:
        got = F.try_element_at(cache, F.lit(m))
        state = F.struct(got[0].cast("double").alias("health"), F.from_json(got[1], "map<string,double>").alias("features"))
        rows = rows.withColumn(m, F.when(got.isNotNull(), state))
    return with_top_features(fused(rows, fusion), fusion).select(
        "source_id", F.col("window_ts").alias("gold_window_ts"), "vehicle_health_score", *[f"{m}_contrib" for m in mods],
        "top_5_features", "seq",
    )


def latest_payloads(df: DataFrame, keys: list[str]) -> DataFrame:
    """What a reader keeps of re-written rows."""
    return latest_per_key(df, keys, ["seq"])


def restated(new_rows: DataFrame, history: DataFrame, source: str = "source_id", ts: str = "ts", seconds: int = 300) -> DataFrame:
    """Rows to recompute when late rows arrive: everything of the touched vehicles from their first touched window on."""
    since = new_rows.groupBy(source).agg(F.min(floor_seconds(F.col(ts), seconds)).alias("_since"))
    return history.join(since, source).filter(F.col(ts) >= F.col("_since")).drop("_since")
