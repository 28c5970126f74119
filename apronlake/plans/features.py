"""The feature mart's registry, and what is made from it: plan, guards, search and scorer, with their DuckDB SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apronlake.operators import bundle as B
from apronlake.operators import joins as J
from apronlake.operators import quality as Q
from apronlake.operators import rates as R
from apronlake.operators import search as Se
from apronlake.operators import windows as Wn
from apronlake.operators.scratch import scratch_path, until_end, written

from . import fixtures as X
from . import marts as M
from . import stored as Z
from . import views
from .oracles import _FIVE, _HIST_OF, _LEGS, _ROT, _hist_joins, _holidays, _rates


@dataclass(frozen=True)
class Column:
    """``role``: key, feature, split, label or note (kept to audit the row, never a feature); ``of`` makes it from the joined row."""

    name: str
    type: str
    role: str
    of: str


def _columns(role: str, **of: str) -> list[Column]:
    """Columns from name='type' or name='type: expression'."""
    return [Column(n, t, role, e or n) for n, (t, _, e) in ((n, s.partition(": ")) for n, s in of.items())]


_WEATHER = {c: "double" for c in ("temp_f", "dewpoint_f", "wind_kn", "precip_in")}
_FLAGS = {f"is_{n}": "boolean" for n in ("fog", "rain", "snow", "thunder")}

REGISTRY = [
    *_columns("key", leg_id="bigint", leg_date="date", carrier="string", flight_number="bigint", origin="string", dest="string", route="string", dep_min="bigint"),
    *_columns("feature", distance="bigint", dep_hour="bigint", sched_arr_hour="bigint: cast(floor(pmod(dep_min + elapsed_min, 1440) / 60) AS bigint)", weekday="int", month_no="int"),
    *_columns("feature", **{f"{p}_{v}": t for p in M.FEATURE_RATES for v, t in (("rate", "double"), ("avg_delay", "double"), ("n", "bigint"))}),
    *_columns("feature", position="bigint", legs_today="bigint", density="bigint", has_inbound="boolean", turnaround="bigint", slack="bigint", is_tight="boolean: _is_tight", inbound_distance="bigint", inbound_elapsed="bigint"),
    *_columns("feature", **_WEATHER, **_FLAGS, gust_kn="double: CASE WHEN has_origin_weather THEN coalesce(gust_kn, 0D) END", gust_reported="boolean: CASE WHEN has_origin_weather THEN gust_reported END"),
    *_columns("feature", visibility_mi="double: CASE WHEN visibility_mi IS NOT NULL THEN least(visibility_mi, 10D) END", has_origin_weather="boolean"),
    *_columns("feature", is_holiday="boolean", is_day_before="boolean", is_day_after="boolean"),
    *_columns("note", obs_ts="timestamp_ntz"),
    *_columns("split", is_training_row="boolean"),
    *_columns("label", label_arr_del15="boolean: arr_del15", label_arr_delay_min="bigint: arr_delay_min"),
]


def names(*roles: str) -> list[str]:
    return [c.name for c in REGISTRY if c.role in roles]


def feature_rows(spark, d) -> DataFrame:
    """The whole feature row of each completed leg, in the registry's order and types."""
    obs = views.hourly_observations(spark, d).drop("report")
    calendar = M.holiday_calendar(spark, 2023, 2024).drop("holiday_name")
    rot = Z.rotation(spark, d).withColumn("_is_tight", F.col("is_tight"))
    wide = M.ml_features(rot, obs, X.CUTOFF, calendar, X.request_zones(spark, d), hist=Z.rates(spark, d))
    return wide.select(*(F.expr(c.of).alias(c.name) for c in REGISTRY))


def ml_feature_rows(spark, d):
    """All columns of the registry for all completed legs; rates and delays to six digits."""
    x = feature_rows(spark, d)
    return x.withColumns({c.name: F.round(c.name, 6) for c in REGISTRY if c.name.endswith(("_hist_rate", "_hist_avg_delay"))})


def _drifted(spark, d) -> DataFrame:
    """The mart after two careless edits: an outcome slipped in, a flag was lost, a type moved."""
    x = feature_rows(spark, d)
    return x.drop("is_day_after").withColumn("arr_delay_min", F.col("label_arr_delay_min")).withColumn("distance", F.col("distance").cast("double"))


def feature_guards(spark, d):
    """(frame, column, problem) that guards made from the registry find in the mart (none) and in a drifted one."""
    out = None
    for title, df, features in (("mart", feature_rows(spark, d), names("feature")), ("drifted", _drifted(spark, d), [*names("feature"), "label_arr_del15", "obs_ts"])):
        allowed = Q.q_schema_allowlist(df, [c.name for c in REGISTRY])
        audit = Q.audit_registry(df, features, names("label"), names("note", "split"))
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        moved = spark.createDataFrame([(c.name, f"type {kinds[c.name]}") for c in REGISTRY if kinds.get(c.name, c.type) != c.type], "column string, problem string")
        found = allowed.unionByName(audit).unionByName(moved).select(F.lit(title).alias("frame"), "column", "problem")
        out = found if out is None else out.unionByName(found)
    return out


# Search ---------------------------------------------------------------------------------------

SPACE = Se.Space(["distance", "dep_hour", "density", "turnaround", "slack", "position", "legs_today"], "arr_del15", ["leg_id"], levels=dict(M.FEATURE_RATES))
#: Each validates on the days before the next begins; the last ends at the cutoff of the test rows.
WINDOWS = [Se.Window("2024-01-14", "2024-01-19"), Se.Window("2024-01-19", X.CUTOFF)]


def candidates() -> list[Se.Candidate]:
    """Families that Spark ML has, the incumbents first."""
    return [
        Se.Candidate("logistic", "linear", LogisticRegression, {"maxIter": 30}),
        Se.Candidate("gbt-d3", "boosted", GBTClassifier, {"maxIter": 5, "maxDepth": 3, "seed": 7}),
        Se.Candidate("gbt-d5", "boosted", GBTClassifier, {"maxIter": 5, "maxDepth": 5, "seed": 7}),
        Se.Candidate("forest", "bagged", RandomForestClassifier, {"numTrees": 10, "maxDepth": 5, "seed": 7}),
        Se.Candidate("tree", "single", DecisionTreeClassifier, {"maxDepth": 4}),
    ]


def family_report(spark, d):
    """The search's report on all legs before the cutoff; test rows are never seen."""
    base = R.completed(Z.rotation(spark, d)).where(F.col("leg_date") < F.lit(X.CUTOFF).cast("date"))
    base = written(base.select("leg_id", "leg_date", "cancelled", "diverted", "arr_del15", "arr_delay_min", "route", "carrier", "origin", "dest", "band", "pos_key", *SPACE.numeric), "search-base")
    return Se.family_search(base, SPACE, candidates(), WINDOWS, budget=8 * base.count())


# Bundle ---------------------------------------------------------------------------------------

#: Feature columns that a request has too, as registered; the category first.
SERVED = {c.name: c.type for c in REGISTRY if c.role == "feature" and c.name in {"distance", "dep_hour", "density", "weekday", "month_no", "is_holiday", "is_day_before", "is_day_after", "legs_today", "position", *(f"{p}_rate" for p in M.FEATURE_RATES)}}
SERVED_REGISTRY = {"carrier": "string", **SERVED}
CALIBRATED_FROM = "2024-01-19"
#: Scoring is the work, and a small file of narrow rows would be few tasks: so many requests go to one.
REQUESTS_A_TASK = 100_000


def served_rows(spark, d) -> DataFrame:
    """Day, served columns and labels of the training rows of ``feature_rows``; the weather is not served and not looked up."""
    before = R.completed(Z.rotation(spark, d)).where(F.col("leg_date") < F.lit(X.CUTOFF).cast("date"))
    x = M.with_calendar(before, "leg_date", M.holiday_calendar(spark, 2023, 2024).drop("holiday_name"))
    x = J.join_levels(x, Z.rates(spark, d), M.FEATURE_RATES, ["rate"])
    of = {c.name: F.expr(c.of).alias(c.name) for c in REGISTRY}
    return x.select(*(of[c] for c in ("leg_date", *SERVED_REGISTRY, "label_arr_del15", "label_arr_delay_min")))


def fitted_bundle(spark, d) -> B.Bundle:
    """Fit on days before the calibration window, calibrate on it, save, and load what was saved."""

    def fit(path: str) -> None:
        day = F.lit(CALIBRATED_FROM).cast("date")
        rows = written(served_rows(spark, d), "bundle-rows")
        B.fit_bundle(rows.where(F.col("leg_date") < day), rows.where(F.col("leg_date") >= day), SERVED_REGISTRY, "carrier", "label_arr_del15", "label_arr_delay_min", path, maxIter=5, maxDepth=3)

    key = spark.sparkContext.applicationId, d
    if key not in _BUNDLES:
        path = scratch_path(spark, "bundle")
        fit(path)
        _BUNDLES[key] = until_end(spark, path)
    return B.load_bundle(spark, _BUNDLES[key])


_BUNDLES: dict[tuple[str, str], str] = {}


def request_features(spark, d, requests: DataFrame) -> DataFrame:
    """Requests with the served feature columns under their registered names; types come as the lookups have them."""
    lookups = (of(spark, d) for of in (Z.rates, Z.entity_profile, Z.density_profile, Z.typical_rotation))
    x = M.assemble(requests, *lookups, M.holiday_calendar(spark, 2023, 2024).drop("holiday_name"))
    used = {"distance": "distance_used", "density": "density_used", "position": "pos_used", "legs_today": "legs_used"}
    return x.drop(*used).withColumnsRenamed({v: k for k, v in used.items()})


def bundle_scores(spark, d):
    """All requests through the loaded bundle: gate, three models, calibration."""
    rows = request_features(spark, d, X.requests(spark, d)).select("request_id", *SERVED_REGISTRY)
    tasks = max(spark.sparkContext.defaultParallelism, X.read(spark, d, "events").count() // REQUESTS_A_TASK)
    # Dealt after the lookups: lookups and models in one stage are a generated method that the JVM does not compile.
    out = B.score(rows.repartition(tasks, "request_id"), fitted_bundle(spark, d), ["request_id"])
    return out.select("request_id", *(F.round(c, 6).alias(c) for c in ("raw_score", "delay_probability", "expected_minutes", "baseline_probability")), "category_unseen")


def proxy_day_bundle(spark, d):
    """The board of each origin's last day, four weeks on, scored with the loaded bundle; the rotation of the day is not known yet."""
    board = Wn.latest_per(X.legs(spark, d), ["origin"], "leg_date")
    unknown = {c: F.lit(None).cast("bigint") for c in ("position", "legs_today", "turnaround", "inbound_distance", "inbound_elapsed", "density")}
    board = board.select(F.col("leg_id").alias("request_id"), F.date_add("leg_date", 28).alias("leg_date"), "dep_min", "carrier", "origin", "dest", "distance").withColumns(unknown)
    out = B.score(request_features(spark, d, board), fitted_bundle(spark, d), ["request_id", "origin", "leg_date"])
    return out.select("request_id", "origin", F.col("leg_date").alias("target_day"), F.round("delay_probability", 6).alias("delay_probability"), F.round("expected_minutes", 6).alias("expected_minutes"))


QUERIES = {f.__name__: f for f in (ml_feature_rows, feature_guards, family_report, bundle_scores, proxy_day_bundle)}

_FRESH = ("temp_f", "dewpoint_f", "wind_kn", "precip_in", "is_fog", "is_rain", "is_snow", "is_thunder")
_HIST3 = ", ".join(f"round(h{i}.rate, 6) AS {p}_rate, round(h{i}.avg_delay, 6) AS {p}_avg_delay, h{i}.n AS {p}_n" for i, p in enumerate(_HIST_OF))

ORACLES = {
    "ml_feature_rows": f"WITH {_LEGS}, {_ROT}, {_rates('rot', _FIVE, '2024-01-24')}, {_holidays(2023, 2024)}, ho AS ({views.ORACLES['hourly_observations']}), "
    "w AS (SELECT r.*, o.* EXCLUDE (station, report), o.obs_ts > r.dep_ts - INTERVAL 3 HOURS AS fresh FROM rot r ASOF LEFT JOIN ho o ON r.origin = o.station AND r.dep_ts >= o.obs_ts WHERE NOT r.cancelled AND NOT r.diverted) "
    "SELECT w.leg_id, w.leg_date, w.carrier, w.flight_number, w.origin, w.dest, w.route, w.dep_min, distance, dep_hour, (w.dep_min + elapsed_min) % 1440 // 60 AS sched_arr_hour, isodow(w.leg_date)::INT AS weekday, month(w.leg_date)::INT AS month_no, "
    f"{_HIST3}, position, legs_today, density, has_inbound, turnaround, slack, is_tight, inbound_distance, inbound_elapsed, " + ", ".join(f"CASE WHEN fresh THEN {c} END AS {c}" for c in _FRESH)
    + ", CASE WHEN fresh THEN coalesce(gust_kn, 0.0) END AS gust_kn, CASE WHEN fresh THEN gust_reported END AS gust_reported, CASE WHEN fresh AND visibility_mi IS NOT NULL THEN least(visibility_mi, 10.0::DOUBLE) END AS visibility_mi, "
    "coalesce(fresh, false) AS has_origin_weather, w.leg_date IN (SELECT d FROM hd) AS is_holiday, w.leg_date IN (SELECT d - 1 FROM hd) AS is_day_before, w.leg_date IN (SELECT d + 1 FROM hd) AS is_day_after, "
    "CASE WHEN fresh THEN obs_ts END AS obs_ts, w.leg_date < DATE '2024-01-24' AS is_training_row, arr_del15 AS label_arr_del15, arr_delay_min AS label_arr_delay_min "
    f"FROM w {_hist_joins('w')}",
    "feature_guards": "SELECT * FROM (VALUES ('drifted', 'arr_delay_min', 'not_allowed'), ('drifted', 'is_day_after', 'missing'), ('drifted', 'is_day_after', 'absent'), ('drifted', 'label_arr_del15', 'is_label'), "
    "('drifted', 'label_arr_del15', 'label_like'), ('drifted', 'obs_ts', 'excluded'), ('drifted', 'distance', 'type double')) v(frame, \"column\", problem)",
}
