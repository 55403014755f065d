"""Search for gate settings: drawn trials, evaluated together, with a log and patience."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Gate
from ..operators import gating

# What a trial is drawn from; thresholds and margins in percent.
TOP_K = range(20, 50, 5)
TAU_S = range(45, 90, 5)
TAU_M = range(50, 95, 5)
DELTA = range(3, 17, 2)
TRIALS, PATIENCE, GAIN = 20, 5, 1e-4


@dataclass(frozen=True)
class Trial:
    top_k: int
    tau_s: int
    tau_m: int
    delta: int


def draw_trials(n: int = TRIALS, seed: int = 42) -> list[Trial]:
    """n different trials; tau_match is at most 5 below tau_singleton."""
    rng = random.Random(seed)
    found: dict[Trial, None] = {}
    while len(found) < n:
        tau_s = rng.choice(TAU_S)
        found[Trial(rng.choice(TOP_K), tau_s, rng.choice([m for m in TAU_M if m >= tau_s - 5]), rng.choice(DELTA))] = None
    return list(found)


def logged(metrics: DataFrame, patience: int = PATIENCE) -> tuple[DataFrame, Trial, float]:
    """The trials in order up to where `patience` of them in a row gained nothing, the best of these and its macro F0.5.

    metrics: a row for each trial, from gating.trial_metrics(); all were evaluated in one pass, so stopping early saves
    nothing here but gives what a search one by one would have given.
    """
    rows = metrics.orderBy("trial").collect()
    best, at, waited, last = float("-inf"), 0, 0, len(rows) - 1
    for k, row in enumerate(rows):
        if row["macro_f05"] > best + GAIN:
            best, at, waited = row["macro_f05"], k, 0
        else:
            waited += 1
            if waited >= patience:
                last = k
                break
    best_row = max(rows[: last + 1], key=lambda r: (r["macro_f05"], -r["trial"]))
    return metrics.filter(F.col("trial") <= rows[last]["trial"]), Trial(best_row["top_k"], best_row["tau_s"], best_row["tau_m"], best_row["delta"]), best_row["macro_f05"]


def search(scored: DataFrame, truth: DataFrame, entities: DataFrame, n: int = TRIALS, patience: int = PATIENCE, seed: int = 42) -> tuple[DataFrame, Trial, float]:
    """logged() of n drawn trials over scored pairs (predicted_prob, fused_rank)."""
    settings = gating.trials(scored.sparkSession, [(t.top_k, t.tau_s, t.tau_m, t.delta) for t in draw_trials(n, seed)])
    return logged(gating.trial_metrics(gating.trial_counts(scored, truth, entities, settings)), patience)


def export(scored: DataFrame, candidates: DataFrame, s1: DataFrame, trial: Trial) -> tuple[DataFrame, DataFrame]:
    """matching_results by a trial's setting, and candidate_pairs of all candidates."""
    kept = scored.filter(F.col("fused_rank") <= trial.top_k)
    gate = Gate(trial.tau_s / 100, trial.tau_m / 100, trial.delta / 100)
    return gating.matching_results(kept, s1, gate), gating.candidate_lists(candidates, s1)


def trial_log(log: DataFrame, seconds: float | None = None) -> DataFrame:
    """The columns of the trial log, thresholds as shares. seconds: the whole pass's, shared out evenly."""
    share = lambda c, name: F.round(F.col(c) / 100, 3).alias(name)
    each = F.lit(None).cast("double") if seconds is None else F.round(F.lit(seconds) / F.lit(max(1, log.count())), 2)
    return log.select("trial", "top_k", share("tau_s", "tau_singleton"), share("tau_m", "tau_match"), share("delta", "delta_margin"), "macro_f05", "macro_precision", "macro_recall", "singleton_acc", each.alias("runtime_sec"))
