"""Vehicle health per time window, fused from module health."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorpool.functions.numeric import round_py
from motorpool.functions.timefmt import floor_seconds
from motorpool.operators.series import Series, last_valid

# Fixed defaults of the fusion rules.
WINDOW_SECONDS = 300
SILENT_HEALTH = 100.0
FALLBACK_WEIGHTS = {"engine": 0.35, "transmission": 0.25, "battery": 0.20, "body": 0.10, "tyre": 0.10}
FALLBACK_PENALTIES = {"engine": 30.0, "transmission": 25.0, "battery": 20.0}


@dataclass(frozen=True)
class Fusion:
    raw_weights: dict[str, float] = field(default_factory=lambda: {"engine": 0.80, "transmission": 0.20})
    penalties: dict[str, float] = field(default_factory=lambda: {"engine": 20.0})

    @property
    def weights(self) -> dict[str, float]:
        total = sum(self.raw_weights.values())
        if total <= 0:
            raise ValueError("weights of the enabled modules must add up to more than 0")
        return {m: w / total for m, w in self.raw_weights.items()}


def module_windows(silver: DataFrame, modules, seconds: int = WINDOW_SECONDS, worst: bool = False) -> DataFrame:
    """One row per (vehicle, window) with the module states seen in it as structs.

    The last row of a module wins (or the worst with ``worst=True``). One shuffle, partially
    aggregated before it, so a dominant vehicle arrives as one row per window and task.
    """
    state = F.struct("health", "features")
    rank = F.struct((-F.col("health")).alias("h"), "ts", "event_id") if worst else F.struct("ts", "event_id")
    picks = [F.max_by(F.when(F.col("module") == m, state), F.when(F.col("module") == m, rank)).alias(m) for m in modules]
    rows = silver.filter(F.col("module").isin(*modules))
    return rows.groupBy("source_id", floor_seconds(F.col("ts"), seconds).alias("window_ts")).agg(*picks)


def windows_in(silver: DataFrame, seconds: int = WINDOW_SECONDS) -> int:
    """How many windows the data's time range holds: no vehicle can have more (reads one column)."""
    span = silver.agg((F.max(F.unix_seconds("ts")) - F.min(F.unix_seconds("ts"))).alias("s")).first()["s"]
    return (span or 0) // seconds + 2


def carried_windows(windows: DataFrame, modules, target_rows: int | None = None, max_windows: int | None = None) -> DataFrame:
    """Modules silent in a window keep the state of the vehicle's last window that had one.

    ``max_windows`` is a known bound on the windows of a vehicle; without one they are counted.
    """
    kw = {"target_rows": target_rows} if target_rows else {}
    if max_windows is None:
        s = Series(windows, ["source_id"], ["window_ts"], **kw)
    else:
        s = Series.bounded(windows, ["source_id"], ["window_ts"], max_windows, **kw)
    return s.running(**{m: last_valid(F.col(m)) for m in modules}).result()


def fused(rows: DataFrame, fusion: Fusion) -> DataFrame:
    """Add contributions, total and score to rows with one struct column per module.

    Each stage works on the columns of the one before, so no expression is repeated.
    """
    weights = fusion.weights
    rows = rows.withColumns({f"_h_{m}": F.coalesce(F.col(f"{m}.health"), F.lit(SILENT_HEALTH)) for m in weights})
    total = F.lit(0.0)
    for m, w in weights.items():
        total = total + F.col(f"_h_{m}") * w
    rows = rows.withColumns({"raw_total": total, **{f"{m}_contrib": round_py(F.col(f"_h_{m}"), 2) for m in weights}})
    limits = [
        F.when(F.col(f"{m}_contrib") < limit, F.col(f"{m}_contrib")) for m, limit in fusion.penalties.items() if m in weights
    ]
    rows = rows.withColumn("_clamped", F.least(F.col("raw_total"), *limits) if limits else F.col("raw_total"))
    rows = rows.withColumns({
        "vehicle_health_score": round_py(F.col("_clamped"), 2), "penalised": F.col("_clamped") < F.col("raw_total"),
    })
    return rows.drop("_clamped", *[f"_h_{m}" for m in weights])


def with_top_features(rows: DataFrame, fusion: Fusion, out: str = "top_5_features", k: int = 5) -> DataFrame:
    """Add the ``k`` strongest weighted features over all modules, 4 decimals.

    A name that appears twice among them keeps its later, smaller value.
    """
    pools = []
    for i, (m, w) in enumerate(fusion.weights.items()):
        entries = F.map_entries(F.coalesce(F.col(f"{m}.features"), F.create_map().cast("map<string,double>")))
        pools.append(_pool(entries, w, i))
    # The ranking is a column of its own: inside the lambda below it would be sorted again per entry.
    rows = rows.withColumn("_ranked", F.slice(F.sort_array(F.concat(*pools), asc=False), 1, k))
    later = lambda e, i: F.exists(F.slice("_ranked", i + 2, F.lit(k)), lambda x: x["name"] == e["name"])
    rows = rows.withColumn("_ranked", F.filter("_ranked", lambda e, i: ~later(e, i)))
    best = F.transform("_ranked", lambda e: F.struct(e["name"], round_py(e["impact"], 4)))
    return rows.withColumn(out, F.map_from_entries(best)).drop("_ranked")


def _pool(entries: Column, weight: float, module_pos: int) -> Column:
    def one(e, j):
        return F.struct(
            (e["value"] * weight).alias("impact"), F.lit(-module_pos).alias("m"), (-j).alias("j"), e["key"].alias("name")
        )

    return F.transform(entries, one)


def gold_health(silver: DataFrame, fusion: Fusion | None = None, seconds: int = WINDOW_SECONDS, now: Column | None = None) -> DataFrame:
    """``silver(source_id, module, ts, event_id, health, features)`` to one health row per vehicle and window."""
    fusion = fusion or Fusion()
    windows = module_windows(silver, fusion.weights, seconds)
    rows = carried_windows(windows, fusion.weights, max_windows=windows_in(silver, seconds))
    rows = with_top_features(fused(rows, fusion), fusion)
    return rows.select(
        "source_id", F.col("window_ts").alias("gold_window_ts"), "raw_total", "vehicle_health_score", "penalised",
        *[f"{m}_contrib" for m in fusion.weights], "top_5_features", (now if now is not None else F.current_timestamp()).alias("gold_write_ts"),
    )


def last_per_window(gold: DataFrame) -> DataFrame:
    """Readers keep the last write of each (vehicle, window)."""
    cols = [c for c in gold.columns if c not in ("source_id", "gold_window_ts")]
    best = gold.groupBy("source_id", "gold_window_ts").agg(F.max_by(F.struct(*cols), "gold_write_ts").alias("r"))
    return best.select("source_id", "gold_window_ts", "r.*")


def what_if(gold: DataFrame, weights: dict[str, float], penalties: dict[str, float], defaults: dict[str, float] | None = None,
            contrib_is_weighted: bool = False) -> DataFrame:
    """Fusion again with other weights and penalties.

    Contributions are stored unweighted; ``contrib_is_weighted`` divides by the default weight first.
    """
    raws, sim, worst = {}, F.lit(0.0), None
    for m in weights:
        c = F.col(f"{m}_contrib")
        if contrib_is_weighted:
            w = (defaults or {}).get(m, 0.2)
            c = c / w if w else F.lit(100.0)
        raws[m] = c
        sim = sim + c * weights[m]
    for m, limit in penalties.items():
        if m in raws:
            hit = F.when(raws[m] < limit, raws[m]).otherwise(100.0)
            worst = hit if worst is None else F.least(worst, hit)
    worst = worst if worst is not None else F.lit(100.0)
    staged = gold.withColumns({"_sim": sim, "_worst": worst, **{f"{m}_raw": c for m, c in raws.items()}})
    flag = (F.col("_worst") < 100) & (F.col("_worst") < F.col("_sim"))
    staged = staged.withColumns({"penalty_active": flag, "_sim": F.when(flag, F.col("_worst")).otherwise(F.col("_sim"))})
    return staged.withColumns({
        "simulated_health": round_py(F.col("_sim"), 2), **{f"{m}_raw": round_py(F.col(f"{m}_raw"), 2) for m in raws},
    }).drop("_sim", "_worst")


def fleet_by_time(simulated: DataFrame, modules) -> DataFrame:
    return simulated.groupBy("gold_window_ts").agg(
        F.avg("simulated_health").alias("avg_health"), F.bool_or("penalty_active").alias("any_penalty"),
        *[F.avg(f"{m}_raw").alias(f"{m}_avg") for m in modules],
    )


def normalised_weights(df: DataFrame, weight: str, group: list[str]) -> DataFrame:
    """``share`` of each weight, whether the given weights are out of balance, and shares on 3 decimals."""
    total = df.groupBy(*group).agg(F.sum(weight).alias("_t"))
    out = df.join(total, group) if group else df.withColumn("_t", total.scalar())
    bad = F.raise_error(F.lit("weights must add up to more than 0"))
    share = F.when(F.col("_t") > 0, F.col(weight) / F.col("_t")).otherwise(bad.cast("double"))
    return out.select(
        *df.columns, share.alias("share"), (F.abs(F.col("_t") - 1) > 0.001).alias("unbalanced"), round_py(share, 3).alias("rounded"),
    )
