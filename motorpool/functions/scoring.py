"""Risk, health, severity and status expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scoring rules.
EPS = 1e-6
EMA_ALPHA = 0.2
PERSISTENCE_LIMIT = 5
CRITICAL_FLOOR = 0.85
SCORE_DELTAS = {"CRITICAL": 20.0, "WARNING": 5.0, "NORMAL": -10.0}
SCORE_MIN, SCORE_MAX = 0.0, 100.0
SEVERITY_CODES = {"NORMAL": 0, "WARNING": 1, "CRITICAL": 2}


def familiarity(log_density: Column, p05: Column, lowest: Column) -> Column:
    distance = F.abs(p05 - log_density) / (F.abs(p05 - lowest) + EPS)
    return F.when(log_density >= p05, 1.0).otherwise(F.greatest(1.0 - distance, F.lit(0.0)))


def base_risk(error: Column, p95: Column, p99_5: Column, top: Column) -> Column:
    """Three linear pieces: 0 to .5 up to p95, .5 to .8 up to p99.5, then up to 1 at the maximum."""
    floor = lambda c: F.greatest(c, F.lit(EPS))
    tail = F.least((error - p99_5) / floor(top - p99_5), F.lit(1.0))
    return (
        F.when(error <= p95, 0.5 * (error / floor(p95)))
        .when(error <= p99_5, 0.5 + 0.3 * ((error - p95) / floor(p99_5 - p95)))
        .otherwise(0.8 + 0.2 * tail)
    )


def regime_corrected(risk: Column, fam: Column) -> Column:
    """Familiar regimes are discounted, unknown ones raised."""
    return (
        F.when((fam > 0.8) & (risk < 0.9), risk * 0.6)
        .when(fam < 0.2, F.least(risk + 0.2, F.lit(1.0)))
        .otherwise(risk)
    )


def persistence_inputs(risk: Column) -> dict[str, Column]:
    """The persistence counter as a clamp step: up, down to 0 at least, or reset."""
    inf = float("inf")
    high, mid = risk >= 0.8, risk >= 0.5
    return {
        "d": F.when(high, 1.0).when(mid, -1.0).otherwise(0.0),
        "lo": F.lit(0.0),
        "hi": F.when(mid, inf).otherwise(0.0),
    }


def escalated_severity(risk: Column, count: Column) -> Column:
    return F.when(count >= PERSISTENCE_LIMIT, "CRITICAL").when(risk >= 0.5, "WARNING").otherwise("NORMAL")


def escalated_risk(risk: Column, count: Column) -> Column:
    return F.when(count >= PERSISTENCE_LIMIT, F.greatest(risk, F.lit(CRITICAL_FLOOR))).otherwise(risk)


def health(risk: Column) -> Column:
    return (1.0 - risk) * 100


def severity_code(severity: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for kv in SEVERITY_CODES.items() for v in kv]), severity)


def score_delta(severity: Column) -> Column:
    deltas = F.create_map(*[F.lit(v) for kv in SCORE_DELTAS.items() for v in kv])
    return F.coalesce(F.try_element_at(deltas, severity), F.lit(0.0))


def legacy_risk(error: Column, lo: Column, hi: Column, outlier: Column) -> Column:
    norm = F.least(F.greatest((error - lo) / (hi - lo + EPS), F.lit(0.0)), F.lit(1.0))
    return F.when(outlier, F.least(norm + 0.3, F.lit(1.0))).otherwise(norm)


def legacy_severity(risk: Column, error: Column, threshold: Column) -> Column:
    return F.when((risk > 0.8) | (error > threshold), "CRITICAL").when(risk > 0.5, "WARNING").otherwise("NORMAL")


def stream_status(status: Column, age_seconds: Column) -> Column:
    return F.when((status == "RUNNING") & (age_seconds > 10), "STALLED").otherwise(status)


def lag_band(lag: Column) -> Column:
    return F.when(lag < 100, "healthy").when(lag < 1000, "warning").otherwise("critical")


def system_state(total_lag: Column) -> Column:
    return F.when(total_lag >= 5000, "LAGGING").otherwise("HEALTHY")


def health_band(score: Column) -> Column:
    return F.when(score >= 80, "good").when(score >= 50, "fair").otherwise("poor")


def event_label(braking: Column, accel: Column, cornering: Column) -> Column:
    return (
        F.when(braking, "Harsh Braking").when(accel, "Harsh Accel").when(cornering, "Harsh Cornering").otherwise("Normal")
    )
