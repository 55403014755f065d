"""The whole plan: records to matches."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Gate, Settings
from ..functions.normalize import normalize
from ..operators import features, gating, model, retrieval
from ..sources import tables
from ..sources.staging import staged


def scored_candidates(s1: DataFrame, targets: DataFrame, truth: DataFrame, conf: Settings) -> tuple[list, DataFrame, DataFrame]:
    """Models, out-of-fold scored pairs (predicted_prob) and candidates. s1 and targets are raw records."""
    clean_s1, clean_targets = staged(normalize(s1)), staged(normalize(targets))
    blocking = replace(conf.blocking, top_k=conf.blocking.train_top_k or conf.blocking.top_k)
    candidates = staged(retrieval.retrieve(clean_s1, clean_targets, blocking))
    pairs = staged(features.pair_features(candidates, clean_s1, clean_targets))
    models, scored = model.train(model.label_pairs(pairs, truth), conf.training)
    ranks = candidates.select("source1_entity_id", "candidate_entity_id", "fused_rank")
    return models, scored.withColumnRenamed("score", "predicted_prob").join(ranks, ["source1_entity_id", "candidate_entity_id"]), candidates


def tuned_gate(scored: DataFrame, truth: DataFrame, s1: DataFrame, delta: float = 0.11) -> tuple[Gate, float]:
    """The gate of greatest macro F0.5 over the grid, and that value."""
    spark = scored.sparkSession
    entities = s1.select(F.col("entity_id").alias("source1_entity_id"))
    settings = gating.grid(spark, round(delta * 100))
    best = gating.best_setting(gating.trial_metrics(gating.trial_counts(scored, truth, entities, settings))).first()
    return Gate(best.tau_s / 100, best.tau_m / 100, delta), best.macro_f05


def match(s1: DataFrame, targets: DataFrame, models: list, gate: Gate, conf: Settings, index: str | None = None) -> tuple[DataFrame, DataFrame]:
    """matching_results and candidate_pairs of raw records, a row for each S1 record. index: a folder that keeps the
    targets' index for later runs."""
    clean_s1, clean_targets = staged(normalize(s1)), staged(normalize(targets))
    found = retrieval.open_index(s1.sparkSession, index, clean_targets, conf.blocking) if index else clean_targets
    candidates = staged(retrieval.retrieve(clean_s1, found, conf.blocking))
    scored = model.predict(models, features.pair_features(candidates, clean_s1, clean_targets))
    return gating.matching_results(scored, s1, gate), gating.candidate_lists(candidates, s1)


def run(train: tuple[DataFrame, DataFrame, DataFrame], test: tuple[DataFrame, DataFrame], out: str, conf: Settings | None = None, index: str | None = None) -> tuple[Gate, float]:
    """Trains and tunes on (s1, targets, truth), matches (s1, targets) and writes matching_results.tsv, candidate_pairs.tsv
    and the models under out; the gate and its macro F0.5 in training."""
    conf = conf or Settings()
    s1, targets, truth = train
    models, scored, _ = scored_candidates(s1, targets, truth, conf)
    gate, value = tuned_gate(scored, truth, s1, conf.gate.delta)
    model.save(models, f"{out}/model")
    matches, candidates = match(*test, models, gate, conf, index)
    order = tables.numbered(test[0]).select(F.col("entity_id").alias("source1_entity_id"), "_at")
    for name, rows in (("matching_results", matches), ("candidate_pairs", candidates)):
        tables.write_single(rows.join(order, "source1_entity_id"), f"{out}/{name}.tsv", "_at")
    return gate, value
