"""Model fitting, scoring and augmentation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorpool.catalog.registry import Tables, query, r4, r6
from motorpool.operators import windows as W
from motorpool.operators.series import Series
from motorpool.plans import dtc as D
from motorpool.plans import models as M

_FEATS = ["qty", "price", "disc", "tax"]
_BID = ["source_id", "okey", "line", "pkey"]
_BSEL = ", ".join(_BID)


def _series(t: Tables) -> Series:
    return t.bronze_series(*_FEATS)


def _hash(salt: str, keys: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', '{salt}', {keys})), 1, 12))::BIGINT"


def _unit(salt: str, keys: str) -> str:
    return f"(({_hash(salt, keys)} + 0.5::DOUBLE) / {float(16**12)!r}::DOUBLE)"


def _normal(salt: str, keys: str) -> str:
    return f"(sqrt(-2.0::DOUBLE * ln({_unit(salt + 'a', keys)})) * cos(2 * pi() * {_unit(salt + 'b', keys)}))"


@query(
    "m1_fit_scaler", views=["v_bronze"],
    sql=" UNION ALL ".join(f"SELECT module, '{f}' AS feature, round(avg({f}), 6) AS mean, round(stddev_pop({f}), 6) AS std FROM v_bronze GROUP BY module" for f in _FEATS),
)
def _(t: Tables):
    s = M.scaler_stats(t.bronze, "module", _FEATS)
    return s.select("module", "feature", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


@query("m2_window_reconstruction_error")
def _(t: Tables):
    s = _series(t)
    scaler = M.fit_scaler(s.df, _FEATS)
    scaled = scaler.apply(s.df)
    pcs = M.fit_components(scaled, scaler.features, 2)
    s = M.window_error(s.with_df(M.residuals(scaled, scaler.features, pcs)), scaler.features)
    return s.result().select(*_BID, r6(F.col("error")).alias("error"))


@query(
    "m2_masked_window_error", views=["v_bronze"],
    sql=f"""WITH st AS (SELECT avg(qty) AS mq, stddev_pop(qty) AS sq, avg(disc) AS md, stddev_pop(disc) AS sd FROM v_bronze),
        e AS (SELECT *, power((disc - md) / sd, 2) / 2 AS e FROM v_bronze, st),
        n AS (SELECT *, sum(e) OVER f AS s, count(*) OVER f AS c, first_value(e) OVER f AS e0 FROM e
          WINDOW f AS (PARTITION BY source_id ORDER BY ts, okey, line, pkey, price ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
        SELECT {_BSEL}, price, round((s + (30 - c) * e0) / 30, 6) AS error FROM n""",
)
def _(t: Tables):
    """Reconstruction by nothing (zero components): the error of the scaled rows, one feature masked."""
    s = t.bronze_series("qty", "disc")
    scaler = M.fit_scaler(s.df, ["qty", "disc"])
    s = s.with_df(M.residuals(scaler.apply(s.df), scaler.features, [[0.0], [0.0]], masked=("qty",)))
    s = M.window_error(s, scaler.features)
    return s.result().select(*_BID, "price", r6(F.col("error")).alias("error"))


@query("m3_regime_density")
def _(t: Tables):
    b = t.bronze.select(*_BID, *_FEATS)
    scaler = M.fit_scaler(b, _FEATS)
    scaled = scaler.apply(M.even_out(b, scaler.rows))
    mix = M.fit_mixture(scaled, scaler.features)
    return scaled.select(*_BID, r6(M.log_density(mix, scaler.features)).alias("log_density"))


@query("m4_calibration_pass")
def _(t: Tables):
    m = M.fit_module(_series(t), _FEATS)
    vals = {**{f"error_{k}": v for k, v in m.error.items()}, **{f"density_{k}": v for k, v in m.density.items()}}
    return t.spark.createDataFrame([tuple(float(v) for v in vals.values())], ", ".join(f"{k} double" for k in vals))


@query("m5_silver_scoring")
def _(t: Tables):
    s = _series(t)
    out = M.score_silver(s, M.fit_module(s, _FEATS), "fleet")
    return out.result().select(
        "source_id", "okey", "line", "pkey", r6(F.col("raw_error")).alias("raw_error"), r6(F.col("smoothed")).alias("smoothed"),
        r6(F.col("composite_score")).alias("composite_score"), "severity", "severity_code", "top_features",
    )


@query(
    "m5_sensor_policy_error", views=["v_bronze"],
    sql=f"""WITH b AS (SELECT {_BSEL}, ts, price, tax, CASE WHEN source_id % 7 NOT IN (1, 2) THEN qty END AS qty, CASE WHEN source_id % 7 <> 2 THEN disc END AS disc FROM v_bronze),
        g AS (SELECT *, 3 - least(count(qty) OVER k, 1) - least(count(disc) OVER k, 1) - least(count(tax) OVER k, 1) AS gone FROM b WINDOW k AS (PARTITION BY source_id)),
        st AS (SELECT avg(qty) AS mq, stddev_pop(qty) AS sq, avg(disc) AS md, stddev_pop(disc) AS sd, avg(tax) AS mt, stddev_pop(tax) AS s_t FROM g WHERE gone <= 1),
        e AS (SELECT g.*, (coalesce(power((qty - mq) / sq, 2), 0) + coalesce(power((disc - md) / sd, 2), 0) + coalesce(power((tax - mt) / s_t, 2), 0)) / 3 AS e
          FROM g, st WHERE gone <= 1),
        n AS (SELECT *, sum(e) OVER f AS s, count(*) OVER f AS c, first_value(e) OVER f AS e0 FROM e
          WINDOW f AS (PARTITION BY source_id ORDER BY ts, okey, line, pkey, price ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
        SELECT {_BSEL}, price, CASE WHEN gone > 0 THEN 'mask' ELSE 'ok' END AS action, round((s + (30 - c) * e0) / 30, 6) AS error FROM n
        UNION ALL SELECT {_BSEL}, price, 'abort', NULL FROM g WHERE gone > 1""",
)
def _(t: Tables):
    """Some vehicles lack one sensor, which is masked, some two, which sets them apart without an error."""
    feats, kind = ["qty", "disc", "tax"], F.col("source_id") % 7
    rows = t.bronze_series(*feats).df
    rows = rows.withColumns({"qty": F.when(~kind.isin(1, 2), F.col("qty")), "disc": F.when(kind != 2, F.col("disc"))})
    fit, apart = M.by_sensors(rows, ["source_id"], feats, most=1)
    scaler = M.fit_scaler(fit, feats)
    s = W.impute(Series(fit, ["source_id"], t.BRONZE_ORDER), scaler.mean)
    s = s.with_df(M.residuals(scaler.apply(s.df), scaler.features, [[0.0]] * 3, F.col("masked")))
    out = M.window_error(s, scaler.features).result()
    keep = [*_BID, "price", "action"]
    return out.select(*keep, r6(F.col("error")).alias("error")).unionByName(apart.select(*keep, F.lit(None).cast("double").alias("error")))


@query("m6_soft_label_classifiers")
def _(t: Tables):
    """One classifier per code on augmented data; a code with an unknown feature is skipped."""
    rows = t.bronze.select(*_BID, *_FEATS)
    codes = [
        {"dtc_code": "P0217", "features": ["qty", "disc"]}, {"dtc_code": "P0171", "features": ["price", "tax"]},
        {"dtc_code": "P0999", "features": ["absent"]},
    ]
    models, failed = M.fit_codes(lambda c, fs: M.augment(rows, c, fs, _BID), codes)
    out = [(m["code"], True, [round(x, 4) for x in m["coef"]]) for m in models] + [(c, False, []) for c in failed]
    return t.spark.createDataFrame(out, "code string, trained boolean, coef array<double>")


@query(
    "m9_train_validation_split",
    sql=f"SELECT event_id, CASE WHEN {_unit('split', 'event_id')} < 0.8 THEN 'train' ELSE 'validation' END AS part FROM events",
)
def _(t: Tables):
    a, b = M.split_rows(t.events.select("event_id"), ["event_id"])
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("validation")))


def _augment_sql(code: str, change: str) -> str:
    return f"""WITH h AS (SELECT event_id, value, user_id::DOUBLE AS load, {_hash(code, 'event_id')} AS h FROM events),
        s AS (SELECT *, 0.1::DOUBLE + 0.9::DOUBLE * (row_number() OVER (ORDER BY h, event_id) - 1) / (count(*) OVER () - 1) AS target,
          avg(value) OVER () AS mv, avg(load) OVER () AS ml FROM h WHERE h % 2 = 1)
        SELECT event_id, round(value, 6) AS value, round(load, 6) AS load, 0.0::DOUBLE AS target FROM h WHERE h % 2 = 0
        UNION ALL SELECT event_id, {change}, round(target, 6) FROM s"""


_CHANGES = {
    "gain": ("P0217", "round(value * (1 + 0.5::DOUBLE * target), 6), round(load, 6)"),
    "attenuation": ("P0171", "round(value * (1 - 0.6::DOUBLE * target), 6), round(load, 6)"),
    "drift": ("P0420", "round(value + mv * 0.25::DOUBLE * target, 6), round(load, 6)"),
    "noise": ("P0300", f"round(value + {_normal('P0300:value', 'event_id')} * (mv * 0.5::DOUBLE) * target, 6), round(load + {_normal('P0300:load', 'event_id')} * (ml * 0.5::DOUBLE) * target, 6)"),
    "other": ("P0001", "round(value * (1 + 0.3::DOUBLE * target), 6), round(load, 6)"),
}


def _register_augmentation(kind: str, code: str, change: str) -> None:
    @query(f"m10_fault_augmentation_{kind}", sql=_augment_sql(code, change))
    def _(t: Tables):
        df = t.events.select("event_id", "value", F.col("user_id").cast("double").alias("load"))
        out = M.augment(df, code, ["value", "load"], ["event_id"])
        return out.select("event_id", *[r6(F.col(c)).alias(c) for c in ("value", "load", "target")])


for _kind, (_code, _change) in _CHANGES.items():
    _register_augmentation(_kind, _code, _change)


_LEAK = {"maf": "maf", "ltft": "ltft", "stft": "stft", "afr": "afr", "rpm": "rpm", "load": "load"}


@query(
    "m11_vacuum_leak",
    sql=f"""WITH b AS (SELECT event_id, day(ts) + 9 AS d, value AS maf, 0.0::DOUBLE AS ltft, 1.0::DOUBLE AS stft, 14.7::DOUBLE AS afr, 900.0::DOUBLE AS rpm, 60.0::DOUBLE AS load, event_id % 75 AS i FROM events),
        f AS (SELECT *, (d - 9) / 29.0::DOUBLE AS f, d BETWEEN 10 AND 38 AS act FROM b),
        m AS (SELECT *, CASE WHEN f > 0.75 THEN (f - 0.75::DOUBLE) / 0.25::DOUBLE ELSE 0.0 END AS lean, CASE WHEN f > 0.85 THEN (f - 0.85::DOUBLE) / 0.15::DOUBLE ELSE 0.0 END AS miss FROM f)
        SELECT event_id, round(CASE WHEN act THEN maf * (1 - 0.35::DOUBLE * f) ELSE maf END, 6) AS maf, round(CASE WHEN act THEN ltft + 25 * f ELSE ltft END, 6) AS ltft,
        round(CASE WHEN act THEN stft + 8 * f ELSE stft END, 6) AS stft, round(CASE WHEN act THEN afr + 1.8::DOUBLE * lean ELSE afr END, 6) AS afr,
        round(CASE WHEN act THEN rpm + sin(i * 0.8::DOUBLE) * 120 * miss + {_normal('rpm', 'event_id')} * 60 * miss ELSE rpm END, 6) AS rpm,
        round(CASE WHEN act AND f > 0.85 THEN least(load + {_normal('load', 'event_id')} * 8 * miss, 100.0) ELSE load END, 6) AS load FROM m""",
)
def _(t: Tables):
    df = t.events.select(
        "event_id", (F.dayofmonth("ts") + 9).alias("d"), F.col("value").alias("maf"), F.lit(0.0).alias("ltft"), F.lit(1.0).alias("stft"),
        F.lit(14.7).alias("afr"), F.lit(900.0).alias("rpm"), F.lit(60.0).alias("load"),
    )
    out = M.vacuum_leak(df, F.col("d"), F.col("event_id") % 75, ["event_id"], _LEAK)
    return out.select("event_id", *[r6(F.col(c)).alias(c) for c in _LEAK])


@query(
    "f1_pluggable_window_scorer", views=["v_bronze"],
    sql=f"""SELECT {_BSEL}, price, round((list_sum(list_transform(s, lambda x: x * x)) + (30 - len(s)) * s[1] * s[1]) / 30, 4) AS score FROM (
        SELECT *, list(qty) OVER (PARTITION BY source_id ORDER BY ts, okey, line, pkey, price ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS s FROM v_bronze)""",
)
def _(t: Tables):
    s = W.sequences(t.bronze_series("qty"), ["qty"])
    scorer = M.window_scorer(lambda cube: (cube**2).mean(axis=(1, 2)))
    return s.result().select(*_BID, "price", r4(scorer(F.col("sequence"))).alias("score"))


@query("m7_trained_code_scoring")
def _(t: Tables):
    """Train, then score every row with the trained code."""
    rows = t.bronze.select(*_BID, *_FEATS)
    model = M.fit_code(M.augment(rows, "P0217", ["qty", "disc"], _BID), "P0217", ["qty", "disc"])
    return D.score_codes(rows, [model]).select(*_BID, r6(F.col("P0217")).alias("P0217"))
