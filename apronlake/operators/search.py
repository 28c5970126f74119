"""A search over model families under a budget, without a look ahead.

Rows are split by time windows: fit before a window, validation inside it. Whatever a
feature has learned from outcomes (smoothed rates of keys) is derived anew for each
window from the rows before it; rates of the whole training span would hold outcomes of
validation rows, and flatter learners by different amounts.

Candidates run in rounds (successive halving). A round fits each candidate left on a
deterministic fraction of the fit rows, validates it on all rows of each window, and
keeps the better part for the next, larger fraction. Fractions are nested: rows of a
smaller one are in all larger ones. The budget is rows fitted, so that a report is the
same on any machine; a candidate that would exceed it is reported as such, and the
incumbents, which come first, are fitted first. Metrics of candidates are all that
reaches the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import evaluation as E
from . import model as Mo
from . import rates as R
from .joins import join_levels
from .sampling import det_fraction
from .scratch import written

REPORT = (
    "round int, fraction double, candidate string, family string, params string, status string, rates string, "
    "n_fit long, n_val long, average_precision double, roc_auc double, spent long, place int"
)


@dataclass
class Candidate:
    """A learner of a family; ``make`` gives an unfitted estimator on ``features``."""

    name: str
    family: str
    make: Callable[..., object]
    params: dict = field(default_factory=dict)


@dataclass
class Window:
    """Fit on days before ``start``, validate on days from ``start`` to before ``end``."""

    start: str
    end: str


@dataclass
class Space:
    """What rows are made of: ``levels`` as in ``join_levels``, over the grains of ``historical_rates``."""

    numeric: list[str]
    label: str
    keys: list[str]
    day: str = "leg_date"
    grains: dict[str, str] = field(default_factory=lambda: dict(R.GRAINS))
    levels: dict[str, tuple[str, str]] = field(default_factory=dict)
    m: float = 50.0

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *(f"{p}_rate" for p in self.levels)]


def with_rates(base: DataFrame, space: Space, cutoff: str) -> DataFrame:
    """``base`` with rates derived from its completed rows before ``cutoff`` only."""
    return join_levels(base, R.smoothed_rates(base, space.grains, cutoff, space.m), space.levels, ["rate"])


def _parts(base: DataFrame, space: Space, window: Window, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """(fit, validation) rows of a window as vectors, rates as of ``cutoff``; imputation is fitted on fit rows."""
    day = lambda d: F.lit(d).cast("date")
    rows = with_rates(base.where(F.col(space.day) < day(window.end)), space, cutoff)
    rows = Mo.prepare(rows.withColumn("y", F.col(space.label).cast("double")), space.columns).where("y IS NOT NULL")
    rows = written(rows.select(*space.keys, space.day, "y", *space.columns, *(f"{c}_missing" for c in space.columns)), "search-rows")
    fit = rows.where(F.col(space.day) < day(window.start))
    if not fit.limit(1).count():
        raise ValueError(f"no row before {window.start}")
    stages = Pipeline(stages=Mo.feature_stages(fit, space.columns, None, True)).fit(fit)
    # As many files as cores: learners pass over these rows dozens of times, and small rows lie in few files.
    dealt = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, *space.keys).sortWithinPartitions(*space.keys)
    made = written(stages.transform(dealt).select(*space.keys, space.day, "y", "features"), "search-vectors")
    return Mo.with_weight(made.where(F.col(space.day) < day(window.start)), "y"), made.where(F.col(space.day) >= day(window.start))


def _scores(c: Candidate, fit: DataFrame, val: DataFrame) -> DataFrame:
    model = Pipeline(stages=[c.make(featuresCol="features", labelCol="y", weightCol="weight", **c.params)]).fit(fit)
    return Mo.probability(model, val).select("p", "y")


def _measure(scored: dict[tuple[str, int], DataFrame]) -> dict[tuple[str, int], tuple[float, float]]:
    """(average precision, AUC) of validation rows scored by each candidate in each window, by one ranking of them all."""
    if not scored:
        return {}
    named = {json.dumps(k): k for k in scored}
    rows = reduce(DataFrame.unionByName, (scored[k].select(F.lit(n).alias("slice"), F.col("p").alias("s"), F.col("y").cast("int").alias("y")) for n, k in named.items()))
    got = {named[x["slice"]]: x for x in E.metrics_by_slice(rows).collect()}
    auc = lambda x: 0.5 if x["roc_auc"] is None else float(x["roc_auc"])
    return {k: (float(got[k]["average_precision"] or 0.0), auc(got[k])) if k in got else (0.0, 0.5) for k in scored}


def _rows(df: DataFrame) -> int:
    return df.count()


def family_search(base: DataFrame, space: Space, candidates: list[Candidate], windows: list[Window], fractions: tuple[float, ...] = (0.25, 1.0), keep: float = 0.5, budget: int | None = None) -> DataFrame:
    """A report row for each candidate and round, best of the last round first.

    ``status``: ``kept``, ``dropped`` (worse than those kept), ``best`` (of the last round) or
    ``over budget`` (not fitted). Candidates of the last round have a second row with
    ``rates = 'whole window'``: the same fit, with rates that saw the validation rows' outcomes, on
    the last window; its average precision less that of the row before it is what such a leak would add.
    """
    if sorted(fractions) != list(fractions) or not fractions or fractions[-1] > 1:
        raise ValueError("fractions ascend, to 1 at most")
    spark = base.sparkSession
    parts = [_parts(base, space, w, w.start) for w in windows]
    n_val = [_rows(val) for _, val in parts]
    left, spent, report, last = list(candidates), 0, [], {}
    for r, fraction in enumerate(fractions):
        drawn = [(det_fraction(fit, space.keys, fraction) if fraction < 1 else fit, val) for fit, val in parts]
        sizes = [_rows(fit) for fit, _ in drawn]
        scored, at, line = {}, {}, {}
        for c in left:
            cost = sum(sizes)
            if budget is not None and spent + cost > budget:
                line[c.name] = ("over budget", None, None)
                continue
            spent += cost
            at[c.name] = spent
            scored |= {(c.name, i): _scores(c, fit, val) for i, (fit, val) in enumerate(drawn)}
        measured, found, weight = _measure(scored), {}, sum(n_val)
        for name, so_far in at.items():
            got = [measured[name, i] for i in range(len(drawn))]
            ap, auc = (sum(g[i] * n for g, n in zip(got, n_val)) / weight if weight else 0.0 for i in (0, 1))
            found[name] = round(ap, 6), round(auc, 6), got[-1][0], so_far
        order = sorted(found, key=lambda n: (-found[n][0], n))
        n_kept = max(1, -(-len(order) * keep // 1)) if r + 1 < len(fractions) else 1
        kept = set(order[: int(n_kept)])
        for c in left:
            head = (r, float(fraction), c.name, c.family, json.dumps(c.params, sort_keys=True))
            if c.name in line:
                report.append((*head, "over budget", "fit window", sum(sizes), sum(n_val), None, None, spent, None))
                continue
            ap, auc, _, so_far = found[c.name]
            status = ("best" if r + 1 == len(fractions) else "kept") if c.name in kept else "dropped"
            report.append((*head, status, "fit window", sum(sizes), sum(n_val), ap, auc, so_far, order.index(c.name) + 1))
        left = [c for c in left if c.name in (kept if r + 1 < len(fractions) else found)]
        last = found
    if left and windows:
        fit, val = _parts(base, space, windows[-1], windows[-1].end)  # rates that hold outcomes of validation rows
        n, m = _rows(fit), _rows(val)
        clean = {c.name: last[c.name][2] for c in left}
        leaky = _measure({(c.name, 0): _scores(c, fit, val) for c in left})
        for c in left:
            ap, auc = leaky[c.name, 0]
            report.append((len(fractions), 1.0, c.name, c.family, json.dumps(c.params, sort_keys=True), "leak", "whole window", n, m, round(ap, 6), round(auc, 6), spent, None))
            report.append((len(fractions), 1.0, c.name, c.family, json.dumps(c.params, sort_keys=True), "clean", "fit window", n, m, round(clean[c.name], 6), None, spent, None))
    return spark.createDataFrame(report, REPORT)


def inflation(report: DataFrame) -> DataFrame:
    """(candidate, clean, leaky, inflation) of the last round's candidates, on the last window."""
    x = report.where("status IN ('leak', 'clean')").groupBy("candidate").pivot("status", ["clean", "leak"]).agg(F.first("average_precision"))
    return x.select("candidate", "clean", F.col("leak").alias("leaky"), F.round(F.col("leak") - F.col("clean"), 6).alias("inflation"))
