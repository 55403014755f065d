"""A query for each operator over the driver's tables, with DuckDB SQL where SQL can express it.

Business records come from `documents` (sources.tables.documents_as_records), vectors from `embeddings`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Blocking, Gate, Training
from ..functions import normalize as N
from ..operators import features, gating, model, retrieval, sampling, validation, vectors
from ..sources import tables as T
from ..sources.staging import drop, once, staged, tidy, version
from . import pipeline, search
from .oracle import sql, trials

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
CONF = Blocking()
GATE = Gate()
#: Settings of the trial query: top_k, and thresholds in percent.
TRIALS = [(40, 75, 85, 5), (30, 55, 65, 3), (35, 75, 90, 11), (30, 70, 70, 3), (25, 50, 55, 3), (30, 55, 80, 5), (35, 80, 75, 7), (25, 45, 75, 3)]


def query(text: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if text:
            SQL[f.__name__] = text
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    return version(spark, f"{sf_dir}/documents.parquet")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.documents_as_records(_read(spark, sf_dir, "documents"))


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clean S1 records and targets, normalised once for a session. clean_text repeats other columns and isn't stored."""

    def make() -> tuple[DataFrame, ...]:
        return tuple(staged(N.normalize(x).drop("business_name", "business_address", "clean_text")) for x in T.split_sources(_records(spark, sf_dir)))

    return tuple(x.withColumn("clean_text", N.clean_text()) for x in once(spark, ("sources", *_version(spark, sf_dir)), make))


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.documents_truth(_read(spark, sf_dir, "documents"))


def _entities(s1: DataFrame) -> DataFrame:
    return s1.select(F.col("entity_id").alias("source1_entity_id"))


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with their similarity in full, retrieved once for a session; what else the search has written goes."""
    s1, targets = _sources(spark, sf_dir)

    def make() -> DataFrame:
        spent: list[DataFrame] = []
        out = staged(retrieval.fuse(retrieval.best_lexical(s1, targets, CONF, spent=spent), None, CONF, exact=True))
        drop(*spent)
        tidy(spark)
        return out

    return once(spark, ("candidates", *_version(spark, sf_dir)), make)


def _candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return *_sources(spark, sf_dir), _fused(spark, sf_dir).drop("similarity")


def _scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Candidates with their similarity as the score: a stand-in for a model's that SQL can follow."""
    found = _fused(spark, sf_dir).select("source1_entity_id", "candidate_entity_id", F.col("similarity").alias("predicted_prob"), "fused_rank")
    return _sources(spark, sf_dir)[0], found


@query(sql("SELECT entity_id, clean_name, legal_suffix FROM norm"))
def normalize_names(spark, sf_dir):
    return N.normalize(_records(spark, sf_dir)).select("entity_id", "clean_name", "legal_suffix")


@query(sql("SELECT entity_id, clean_address, country, clean_text FROM norm"))
def normalize_addresses(spark, sf_dir):
    return N.normalize(_records(spark, sf_dir)).select("entity_id", "clean_address", "country", "clean_text")


@query(sql("SELECT entity_id, array_to_string(extracted_numbers, ',') AS numbers, array_to_string(list_filter(extracted_numbers, lambda x: length(x) IN (5, 6)), ',') AS pins FROM norm"))
def numeric_tokens(spark, sf_dir):
    numbers = _records(spark, sf_dir).select("entity_id", N.numeric_tokens(F.col("business_address")).alias("n"))
    return numbers.select("entity_id", F.array_join("n", ",").alias("numbers"), F.array_join(F.filter("n", lambda x: F.length(x).isin(5, 6)), ",").alias("pins"))


@query(sql("SELECT country, term, entity_id, round(weight, 4) AS weight FROM wp"))
def word_tfidf_postings(spark, sf_dir):
    _, targets = _sources(spark, sf_dir)
    return retrieval.word_index(targets, CONF)[1].withColumn("weight", F.round("weight", 4))


@query(sql("SELECT country, term, entity_id, round(weight, 4) AS weight FROM cp"))
def char_tfidf_postings(spark, sf_dir):
    _, targets = _sources(spark, sf_dir)
    return retrieval.char_index(targets, CONF)[1].withColumn("weight", F.round("weight", 4))


@query(sql("SELECT s AS source1_entity_id, c AS candidate_entity_id, r::INTEGER AS rank, round(word, 4) AS score FROM pool JOIN s1 ON s1.entity_id = s AND s1.country = pool.country WHERE r <= 10"))
def word_topk_candidates(spark, sf_dir):
    s1, targets = _sources(spark, sf_dir)
    asked = s1.join(targets.select("country").distinct(), "country", "left_semi")
    pool = vectors.word_pairs(asked, targets, CONF).filter("r <= 10")
    return pool.select("source1_entity_id", "candidate_entity_id", F.col("r").alias("rank"), F.round("word", 4).alias("score"))


@query(sql("SELECT s AS source1_entity_id, c AS candidate_entity_id, r::INTEGER AS rank, round(score, 4) AS score FROM lex JOIN s1 ON s1.entity_id = s AND s1.country = lex.country"))
def hybrid_candidates(spark, sf_dir):
    s1, targets = _sources(spark, sf_dir)
    asked = s1.join(targets.select("country").distinct(), "country", "left_semi")
    found = retrieval.lexical_candidates(asked, targets, CONF)
    return found.select("source1_entity_id", "candidate_entity_id", F.col("r").cast("int").alias("rank"), F.round("score", 4).alias("score"))


@query(sql("SELECT source1_entity_id, candidate_entity_id, lexical_rank::INTEGER AS lexical_rank, round(rrf, 6) AS rrf_score FROM fused WHERE source1_entity_id IN (SELECT entity_id FROM s1 WHERE country NOT IN (SELECT country FROM sizes))", without="SPAIN"))
def unseen_country_candidates(spark, sf_dir):
    """Records of Spain against all targets of other countries."""
    s1, targets = _sources(spark, sf_dir)
    targets = targets.filter("country <> 'SPAIN'")
    unseen = s1.join(targets.select("country").distinct(), "country", "left_anti")
    return retrieval.retrieve(unseen, targets, CONF).select("source1_entity_id", "candidate_entity_id", "lexical_rank", F.round(F.col("rrf_score").cast("double"), 6).alias("rrf_score"))


_FUSED = "source1_entity_id, candidate_entity_id, round(rrf, 6) AS rrf_score, lexical_rank::INTEGER AS lexical_rank, 1000 AS dense_rank, round(sim::FLOAT::DOUBLE, 4) AS retrieval_similarity"


@query(sql(f"SELECT {_FUSED} FROM fused"))
def retrieved_candidates(spark, sf_dir):
    _, _, found = _candidates(spark, sf_dir)
    rounded = [F.round(F.col(c).cast("double"), d).alias(c) for c, d in (("rrf_score", 6), ("retrieval_similarity", 4))]
    return found.select("source1_entity_id", "candidate_entity_id", rounded[0], "lexical_rank", "dense_rank", rounded[1])


_VECTORS = """WITH v AS (SELECT vec_id, label % 3 AS country, embedding::DOUBLE[] AS e, vec_id % 5 = 0 AS is_query FROM embeddings),
d AS (SELECT q.vec_id AS q, t.vec_id AS t, round(list_inner_product(q.e, t.e) / (sqrt(list_inner_product(q.e, q.e)) * sqrt(list_inner_product(t.e, t.e))), 9) AS score,
  round(list_inner_product(q.e[1:32], t.e[1:32]) / (sqrt(list_inner_product(q.e[1:32], q.e[1:32])) * sqrt(list_inner_product(t.e[1:32], t.e[1:32]))), 9) AS half
  FROM v q JOIN v t ON q.country = t.country AND q.is_query AND NOT t.is_query),
full_ AS (SELECT q, t, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, 'T-' || t) AS r FROM d WHERE score > 0),
half_ AS (SELECT q, t, half AS score, row_number() OVER (PARTITION BY q ORDER BY half DESC, 'T-' || t) AS r FROM d WHERE half > 0)
"""


def _vectors(spark: SparkSession, sf_dir: str, size: int) -> tuple[DataFrame, DataFrame]:
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") % 3).cast("string").alias("country"), F.slice("embedding", 1, size).alias("embedding"))
    named = lambda p: F.concat(F.lit(p), F.col("vec_id").cast("string")).alias("entity_id")
    return rows.filter("vec_id % 5 = 0").select(named("Q-"), "country", "embedding"), rows.filter("vec_id % 5 <> 0").select(named("T-"), "country", "embedding")


@query(_VECTORS + "SELECT 'Q-' || q AS source1_entity_id, 'T-' || t AS candidate_entity_id, r::INTEGER AS rank, round(score, 4) AS score FROM full_ WHERE r <= 10")
def dense_topk(spark, sf_dir):
    found = retrieval.dense_candidates(*_vectors(spark, sf_dir, 64), 10)
    return found.select("source1_entity_id", "candidate_entity_id", F.col("r").cast("int").alias("rank"), F.round("score", 4).alias("score"))


@query(
    _VECTORS
    + """, f AS (SELECT q, t, round(coalesce(1.0 / (60 + h.r), 0) + coalesce(1.0 / (60 + f.r), 0), 12) AS rrf, coalesce(h.r, 1000) AS lr, coalesce(f.r, 1000) AS dr, CASE WHEN h.score > 0 THEN h.score ELSE coalesce(f.score, 0.0) END AS sim
  FROM (SELECT * FROM half_ WHERE r <= 20) h FULL JOIN (SELECT * FROM full_ WHERE r <= 20) f USING (q, t))
SELECT source1_entity_id, candidate_entity_id, round(rrf, 6) AS rrf_score, lr::INTEGER AS lexical_rank, dr::INTEGER AS dense_rank FROM (
SELECT 'Q-' || q AS source1_entity_id, 'T-' || t AS candidate_entity_id, *, row_number() OVER (PARTITION BY q ORDER BY rrf DESC, sim DESC, 'T-' || t) AS n FROM f) WHERE n <= 40"""
)
def rrf_fusion(spark, sf_dir):
    lexical = retrieval.dense_candidates(*_vectors(spark, sf_dir, 32), 20)
    dense = retrieval.dense_candidates(*_vectors(spark, sf_dir, 64), 20)
    return retrieval.fuse(lexical, dense, CONF).select("source1_entity_id", "candidate_entity_id", F.round(F.col("rrf_score").cast("double"), 6).alias("rrf_score"), "lexical_rank", "dense_rank")


_PAIRS = """
pairs AS (SELECT f.*, a.clean_name AS n1, b.clean_name AS n2, a.legal_suffix AS f1, b.legal_suffix AS f2, a.clean_address AS a1, b.clean_address AS a2, a.extracted_numbers AS x1, b.extracted_numbers AS x2, a.country AS c1, b.country AS c2,
  lower(array_to_string(list_transform(list_filter(string_split(a.clean_name, ' '), lambda v: v <> ''), lambda v: v[1]), '')) AS k1,
  lower(array_to_string(list_transform(list_filter(string_split(b.clean_name, ' '), lambda v: v <> ''), lambda v: v[1]), '')) AS k2,
  list_distinct(list_filter(string_split(a.clean_address, ' '), lambda v: v <> '')) AS w1, list_distinct(list_filter(string_split(b.clean_address, ' '), lambda v: v <> '')) AS w2,
  list_filter(a.extracted_numbers, lambda v: length(v) IN (5, 6)) AS p1, list_filter(b.extracted_numbers, lambda v: length(v) IN (5, 6)) AS p2
  FROM fused f JOIN norm a ON a.entity_id = f.source1_entity_id JOIN norm b ON b.entity_id = f.candidate_entity_id),
counts AS (SELECT *, len(list_intersect(x1, x2)) AS xi, len(list_distinct(list_concat(x1, x2))) AS xu, len(list_intersect(w1, w2)) AS wi, len(list_distinct(list_concat(w1, w2))) AS wu, len(list_intersect(p1, p2)) AS pi FROM pairs),
"""
_EXPRESSIONS = """SELECT source1_entity_id, candidate_entity_id,
  CASE WHEN n1 = n2 AND n1 <> '' THEN 1.0 ELSE 0.0 END::DOUBLE AS name_exact_match, abs(length(n1) - length(n2))::DOUBLE AS name_len_diff,
  round(least(length(n1), length(n2)) / (greatest(length(n1), length(n2)) + 1e-5), 4) AS name_len_ratio,
  CASE WHEN length(n1) >= 3 AND length(n2) >= 3 AND n1[1:3] = n2[1:3] THEN 1.0 ELSE 0.0 END::DOUBLE AS name_prefix3_match,
  CASE WHEN length(n1) >= 5 AND length(n2) >= 5 AND n1[1:5] = n2[1:5] THEN 1.0 ELSE 0.0 END::DOUBLE AS name_prefix5_match,
  CASE WHEN length(k1) >= 3 AND (k1 = k2 OR k1 = n2) OR length(k2) >= 3 AND k2 = n1 THEN 1.0 WHEN length(k1) = 2 AND (k1 = k2 OR k1 = n2) OR length(k2) = 2 AND k2 = n1 THEN 0.5 ELSE 0.0 END::DOUBLE AS name_acronym_match,
  CASE WHEN f1 <> '' AND f1 = f2 THEN 1.0 ELSE 0.0 END::DOUBLE AS suffix_exact_match,
  CASE WHEN least(length(a1), length(a2)) > 5 AND (contains(a1, a2) OR contains(a2, a1)) THEN 1.0 ELSE 0.0 END::DOUBLE AS addr_contains,
  round(CASE WHEN wu = 0 THEN 0.0 ELSE wi / (wu + 1e-5) END, 4) AS addr_word_jaccard, xi::DOUBLE AS num_inter_count,
  round(CASE WHEN xu = 0 THEN 0.0 ELSE xi / (xu + 1e-5) END, 4) AS num_jaccard,
  CASE WHEN len(x1) > 0 AND len(x2) > 0 AND (xi = len(x1) OR xi = len(x2)) THEN 1.0 ELSE 0.0 END::DOUBLE AS num_exact_subset,
  CASE WHEN x1[1] = x2[1] THEN 1.0 ELSE 0.0 END::DOUBLE AS lead_num_match,
  CASE WHEN len(x1) > 0 AND len(x2) > 0 AND x1[1] <> x2[1] THEN 1.0 ELSE 0.0 END::DOUBLE AS lead_num_contradict,
  CASE WHEN len(x1) > 0 AND len(x2) > 0 AND xi = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS num_contradiction,
  CASE WHEN pi > 0 THEN 1.0 WHEN len(p1) > 0 AND len(p2) > 0 THEN -1.0 ELSE 0.0 END::DOUBLE AS pin_code_match,
  round(rrf, 4) AS rrf_score, lexical_rank::DOUBLE AS lexical_rank, 1000.0::DOUBLE AS dense_rank, round(sim::FLOAT::DOUBLE, 4) AS retrieval_similarity, round(sim::FLOAT::DOUBLE, 4) AS embedding_similarity,
  CASE WHEN c1 = c2 AND c1 <> 'UNKNOWN' THEN 1.0 ELSE 0.0 END::DOUBLE AS same_country,
  CASE WHEN candidate_entity_id LIKE 'S2-%' THEN 1.0 ELSE 0.0 END::DOUBLE AS is_source2, CASE WHEN candidate_entity_id LIKE 'S3-%' THEN 1.0 ELSE 0.0 END::DOUBLE AS is_source3
FROM counts"""


@query(sql(_EXPRESSIONS, _PAIRS))
def expr_features(spark, sf_dir):
    s1, targets, found = _candidates(spark, sf_dir)
    compared = ("addr_contains", "addr_word_jaccard")
    pairs = features.with_comparisons(found, s1, targets, set(compared))
    columns = {**features.expression_features(), **features.retrieval_features(found.columns), **{n: F.col(n) for n in compared}}
    return pairs.select("source1_entity_id", "candidate_entity_id", *[F.round(columns[n].cast("double"), 4).alias(n) for n in features.NAMES if n in columns])


def _jw(a: str, b: str) -> str:
    # one character for each that DuckDB would compare by its bytes
    x, y = (rf"regexp_replace({c}, '[^\x00-\x7F]', '~', 'g')" for c in (a, b))
    return f"round(CASE WHEN {a} = '' AND {b} = '' THEN 1.0 ELSE jaro_winkler_similarity({x}, {y}) END, 6)"


@query(sql(f"SELECT source1_entity_id, candidate_entity_id, {_jw('n1', 'n2')} AS name_jaro_winkler, {_jw('a1', 'a2')} AS addr_jaro_winkler FROM counts", _PAIRS))
def jaro_winkler_features(spark, sf_dir):
    s1, targets, found = _candidates(spark, sf_dir)
    pairs = features.with_comparisons(found, s1, targets, {"name_jaro_winkler", "addr_jaro_winkler"})
    return pairs.select("source1_entity_id", "candidate_entity_id", *[F.round(c, 6).alias(c) for c in ("name_jaro_winkler", "addr_jaro_winkler")])


@query()
def ratio_features(spark, sf_dir):
    s1, targets, found = _candidates(spark, sf_dir)
    names = [n for names in features.SIMILARITIES.values() for n in names if "jaro" not in n]
    pairs = features.with_comparisons(found, s1, targets, set(names))
    return pairs.select("source1_entity_id", "candidate_entity_id", *[F.round(c, 4).alias(c) for c in names])


@query()
def all_pair_features(spark, sf_dir):
    s1, targets, found = _candidates(spark, sf_dir)
    return features.pair_features(found, s1, targets)


@query(sql("SELECT source1_entity_id, candidate_entity_id, label::INTEGER AS label FROM labelled"))
def label_pairs(spark, sf_dir):
    _, _, found = _candidates(spark, sf_dir)
    return model.label_pairs(found, _truth(spark, sf_dir)).select("source1_entity_id", "candidate_entity_id", "label")


@query(sql("SELECT source1_entity_id, candidate_entity_id, round(sim, 4) AS predicted_prob FROM gated"))
def two_stage_gate(spark, sf_dir):
    _, scored = _scored(spark, sf_dir)
    return gating.accepted(scored, GATE).withColumn("predicted_prob", F.round("predicted_prob", 4))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, scored = _scored(spark, sf_dir)
    return gating.entity_scores(gating.accepted(scored, GATE), _truth(spark, sf_dir), _entities(s1))


@query(sql("SELECT source1_entity_id, n_true, n_pred, n_hit, round(f05, 4) AS f05 FROM scores"))
def entity_f05(spark, sf_dir):
    return _scores(spark, sf_dir).select("source1_entity_id", "n_true", "n_pred", "n_hit", F.round("f05", 4).alias("f05"))


@query(sql("SELECT round(coalesce(avg(f05), 0.0), 6) AS macro_f05, count(*) AS n_entities FROM scores"))
def macro_f05(spark, sf_dir):
    return gating.macro_f05(_scores(spark, sf_dir)).withColumn("macro_f05", F.round("macro_f05", 6))


def _metrics(spark: SparkSession, sf_dir: str, settings: DataFrame) -> DataFrame:
    s1, scored = _scored(spark, sf_dir)
    return gating.trial_metrics(gating.trial_counts(scored, _truth(spark, sf_dir), _entities(s1), settings))


_GRID = [(1_000_000, s, m, 11) for s, m in gating.threshold_pairs()]


@query(sql("SELECT tau_s, tau_m, macro_f05 FROM metrics", trials(_GRID)))
def threshold_grid(spark, sf_dir):
    return _metrics(spark, sf_dir, gating.grid(spark)).select("tau_s", "tau_m", "macro_f05")


@query(sql("SELECT tau_s, tau_m, macro_f05 FROM metrics ORDER BY macro_f05 DESC, tau_s, tau_m LIMIT 1", trials(_GRID)))
def best_thresholds(spark, sf_dir):
    return gating.best_setting(_metrics(spark, sf_dir, gating.grid(spark))).select("tau_s", "tau_m", "macro_f05")


@query(sql("SELECT * FROM metrics", trials(TRIALS)))
def trial_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, gating.trials(spark, TRIALS))


@query(
    sql(
        """SELECT s1.entity_id AS source1_entity_id, coalesce(string_agg(candidate_entity_id, ',' ORDER BY sim DESC, candidate_entity_id) FILTER (best >= tau_s / 100.0 AND sim >= tau_m / 100.0 AND best - sim <= 0.11), '') AS matched_entity_ids
FROM s1 LEFT JOIN best ON source1_entity_id = s1.entity_id CROSS JOIN (SELECT tau_s, tau_m FROM metrics ORDER BY macro_f05 DESC, tau_s, tau_m LIMIT 1) GROUP BY s1.entity_id""",
        trials(_GRID),
    )
)
def tuned_matching_results(spark, sf_dir):
    """Lists by the gate that the plan tunes on the scores."""
    s1, scored = _scored(spark, sf_dir)
    gate, _ = pipeline.tuned_gate(scored, _truth(spark, sf_dir), s1)
    return gating.matching_results(scored, s1, gate)


_SEARCHED = [(t.top_k, t.tau_s, t.tau_m, t.delta) for t in search.draw_trials(20)]


@query(sql("SELECT * FROM metrics", trials(_SEARCHED)))
def searched_trials(spark, sf_dir):
    """Metrics of all settings that a search of 20 trials draws."""
    return _metrics(spark, sf_dir, gating.trials(spark, _SEARCHED))


_WEIGHTS = """SELECT source1_entity_id, candidate_entity_id, CASE WHEN label = 0 AND sim > (SELECT quantile_cont(sim, 0.9) FROM labelled WHERE label = 0) THEN 2.5 ELSE 1.0 END::DOUBLE AS weight FROM labelled"""


@query(sql(_WEIGHTS))
def hard_negative_weights(spark, sf_dir):
    _, scored = _scored(spark, sf_dir)
    labelled = model.label_pairs(scored, _truth(spark, sf_dir)).withColumn("weight", F.lit(1.0)).withColumn("score", F.col("predicted_prob"))
    # the percentile takes several passes
    labelled = staged(labelled.select("source1_entity_id", "candidate_entity_id", "label", "weight", "score"), "labelled")
    return model.hard_negative_weights(labelled, Training()).select("source1_entity_id", "candidate_entity_id", "weight")


@query(sql("SELECT s1.entity_id AS source1_entity_id, coalesce(string_agg(candidate_entity_id, ',' ORDER BY sim DESC, candidate_entity_id), '') AS matched_entity_ids FROM s1 LEFT JOIN gated ON source1_entity_id = s1.entity_id GROUP BY s1.entity_id"))
def matching_results(spark, sf_dir):
    s1, scored = _scored(spark, sf_dir)
    return gating.matching_results(scored, s1, GATE)


@query(sql("SELECT s1.entity_id AS source1_entity_id, coalesce(string_agg(candidate_entity_id, ',' ORDER BY fused_rank), '') AS candidate_entity_ids FROM s1 LEFT JOIN fused ON source1_entity_id = s1.entity_id GROUP BY s1.entity_id"))
def candidate_pairs(spark, sf_dir):
    s1, _, found = _candidates(spark, sf_dir)
    return gating.candidate_lists(found, s1)


_QUOTAS = sampling.QUOTAS
_STRATA = f"""
strata AS (SELECT s1.entity_id, s1.country, s1.entity_id NOT IN (SELECT source1_entity_id FROM truth) AS singleton, md5('42' || s1.entity_id) AS o FROM s1),
quotas(country, singleton, quota) AS (VALUES {", ".join(f"('{c}', {str(s).lower()}, {n})" for (c, s), n in _QUOTAS.items())}),
drawn AS (SELECT * FROM (SELECT s.*, quota, row_number() OVER (PARTITION BY s.country, s.singleton ORDER BY o, entity_id) AS r FROM strata s JOIN quotas q ON q.country = s.country AND q.singleton = s.singleton) WHERE r <= quota),
sampled AS (SELECT entity_id, country, singleton, CASE WHEN row_number() OVER (PARTITION BY country ORDER BY o, entity_id) - 1 < floor(count(*) OVER (PARTITION BY country) * 0.8) THEN 'train' ELSE 'val' END AS split FROM drawn),
"""


def _md5(prefix: str):
    return F.md5(F.concat(F.lit(prefix), F.col("entity_id")))


def _sample(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    s1, targets = _sources(spark, sf_dir)
    truth = _truth(spark, sf_dir)
    return sampling.stratified_sample(sampling.strata(s1, truth), _QUOTAS, _md5("42")), targets, truth


@query(sql("SELECT * FROM sampled", _STRATA))
def stratified_sample(spark, sf_dir):
    return _sample(spark, sf_dir)[0].select("entity_id", "country", "singleton", "split")


@query(
    sql(
        """SELECT entity_id, is_true FROM (SELECT entity_id, is_true, row_number() OVER (PARTITION BY entity_id[1:2], is_true ORDER BY md5('43' || entity_id), entity_id) AS r FROM (
  SELECT entity_id, entity_id IN (SELECT matched_id FROM truth JOIN sampled ON sampled.entity_id = source1_entity_id) AS is_true FROM tgt) WHERE is_true OR md5('44' || entity_id) < '1') WHERE is_true OR r <= 25000""",
        _STRATA,
    )
)
def distractor_pool(spark, sf_dir):
    sampled, targets, truth = _sample(spark, sf_dir)
    return sampling.target_pool(targets, sampled, truth, draw=_md5("44") < "1", order=_md5("43")).select("entity_id", "is_true")


@query(sql("SELECT * FROM (VALUES ('entity_id'), ('business_name'), ('business_address'), ('country')) v(column_name), LATERAL (SELECT count(*) AS n_rows, count(*) FILTER (CASE column_name WHEN 'entity_id' THEN entity_id WHEN 'business_name' THEN business_name WHEN 'business_address' THEN business_address ELSE raw_country END IS NULL) AS n_null FROM records)"))
def null_profile(spark, sf_dir):
    return sampling.null_profile(_records(spark, sf_dir))


@query(sql("SELECT a.country AS country_s1, b.country AS country_cand, count(*) AS n FROM truth JOIN norm a ON a.entity_id = source1_entity_id JOIN norm b ON b.entity_id = matched_id GROUP BY ALL"))
def truth_countries(spark, sf_dir):
    s1, targets = _sources(spark, sf_dir)
    a = s1.select(F.col("entity_id").alias("source1_entity_id"), F.col("country").alias("country_s1"))
    b = targets.select(F.col("entity_id").alias("matched_id"), F.col("country").alias("country_cand"))
    return _truth(spark, sf_dir).join(a, "source1_entity_id").join(b, "matched_id").groupBy("country_s1", "country_cand").agg(F.count("*").alias("n"))


_CLAIMS = """
claims AS (SELECT * FROM truth UNION ALL SELECT 'S1-' || doc_id, 'S2-' || (doc_id + 1) FROM records WHERE doc_id % 3 = 0),
"""


@query(sql("SELECT source1_entity_id, matched_id FROM claims JOIN norm a ON a.entity_id = source1_entity_id JOIN norm b ON b.entity_id = matched_id WHERE a.country <> b.country", _CLAIMS))
def cross_country_matches(spark, sf_dir):
    """Of the truth, and of claims that each S1 record matches its neighbour, those between countries."""
    s1, targets = _sources(spark, sf_dir)
    number = F.split("entity_id", "-")[1].cast("long")
    neighbours = s1.select(F.col("entity_id").alias("source1_entity_id"), F.concat(F.lit("S2-"), (number + 1).cast("string")).alias("matched_id"))
    return sampling.cross_country(s1, targets, _truth(spark, sf_dir).unionByName(neighbours)).select("source1_entity_id", "matched_id")


_FAULTY = """
given AS (SELECT s1.entity_id AS source1_entity_id, doc_id, CASE doc_id % 10 WHEN 0 THEN 'S2-1,S2-1' WHEN 3 THEN 'S1-' || doc_id WHEN 6 THEN 'X-1,S3-2' ELSE coalesce((SELECT string_agg(matched_id, ',' ORDER BY matched_id) FROM truth WHERE source1_entity_id = s1.entity_id), '') END AS ids FROM s1 WHERE doc_id % 11 <> 0),
lists AS (SELECT source1_entity_id, ids FROM given UNION ALL SELECT source1_entity_id, ids FROM given WHERE doc_id % 13 = 0 UNION ALL SELECT 'S1-x', 'S2-1'),
single AS (SELECT source1_entity_id, unnest(list_filter(string_split(ids, ','), lambda x: x <> '')) AS id FROM lists),
"""


@query(
    sql(
        """SELECT 'duplicate_row' AS rule, source1_entity_id, NULL::VARCHAR AS id FROM lists GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'duplicate_id', source1_entity_id, NULL FROM lists WHERE len(list_filter(string_split(ids, ','), lambda x: x <> '')) <> len(list_distinct(list_filter(string_split(ids, ','), lambda x: x <> '')))
UNION ALL SELECT 'self_match', source1_entity_id, id FROM single WHERE id LIKE 'S1-%'
UNION ALL SELECT 'wrong_prefix', source1_entity_id, id FROM single WHERE NOT regexp_matches(id, '^S[123]-')
UNION ALL SELECT 'missing', entity_id, NULL FROM s1 WHERE entity_id NOT IN (SELECT source1_entity_id FROM lists)
UNION ALL SELECT DISTINCT 'extra', source1_entity_id, NULL FROM lists WHERE source1_entity_id NOT IN (SELECT entity_id FROM s1)
UNION ALL SELECT 'unknown_id', source1_entity_id, id FROM single WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT entity_id FROM tgt)""",
        _FAULTY,
    )
)
def validate_output(spark, sf_dir):
    s1, targets = _sources(spark, sf_dir)
    matched = _truth(spark, sf_dir).groupBy(F.col("source1_entity_id").alias("entity_id")).agg(F.array_join(F.array_sort(F.collect_list("matched_id")), ",").alias("ids"))
    number = F.split("entity_id", "-")[1].cast("long")
    kind = number % 10
    faulty = F.when(kind == 0, "S2-1,S2-1").when(kind == 3, F.concat(F.lit("S1-"), number.cast("string"))).when(kind == 6, "X-1,S3-2").otherwise(F.coalesce("ids", F.lit("")))
    given = s1.join(matched, "entity_id", "left").filter(number % 11 != 0).select(F.col("entity_id").alias("source1_entity_id"), number.alias("n"), faulty.alias("ids"))
    lists = given.drop("n").unionByName(given.filter("n % 13 = 0").drop("n")).unionByName(spark.createDataFrame([("S1-x", "S2-1")], "source1_entity_id string, ids string"))
    return validation.violations(lists, s1.select("entity_id"), targets.select("entity_id"))


@query(sql("SELECT g.source1_entity_id, g.candidate_entity_id FROM gated g WHERE NOT EXISTS (SELECT 1 FROM fused f WHERE f.source1_entity_id = g.source1_entity_id AND f.candidate_entity_id = g.candidate_entity_id AND fused_rank <= 1)"))
def matches_outside_candidates(spark, sf_dir):
    s1, scored = _scored(spark, sf_dir)
    matches = gating.matching_results(scored, s1, GATE).withColumnRenamed("matched_entity_ids", "ids")
    first = gating.candidate_lists(scored.filter("fused_rank <= 1"), s1).withColumnRenamed("candidate_entity_ids", "ids")
    return validation.not_candidates(matches, first).withColumnRenamed("id", "candidate_entity_id")


@query(sql("SELECT source1_entity_id, candidate_entity_id, round(CASE WHEN sim BETWEEN 0.38 AND 0.72 THEN 0.5 * sim + 0.5 / (1 + exp(-(4 * sim - 2 + 0.1 * label))) ELSE sim END, 4) AS predicted_prob FROM labelled"))
def cascade_blend(spark, sf_dir):
    _, scored = _scored(spark, sf_dir)
    labelled = model.label_pairs(scored, _truth(spark, sf_dir))
    second = 4 * F.col("predicted_prob") - 2 + 0.1 * F.col("label")
    return model.cascade(labelled, second).select("source1_entity_id", "candidate_entity_id", F.round("predicted_prob", 4).alias("predicted_prob"))


@query()
def gbdt_oof_scores(spark, sf_dir):
    s1, targets, found = _candidates(spark, sf_dir)
    pairs = model.label_pairs(features.pair_features(found, s1, targets), _truth(spark, sf_dir))
    return model.train(pairs, Training())[1].select("source1_entity_id", "candidate_entity_id", "fold", "label", "weight", "score")


@query(sql("SELECT count(*) AS n_pairs, coalesce(sum(label), 0)::BIGINT AS n_positive, (count(*) - coalesce(sum(label), 0))::BIGINT AS n_negative, count(DISTINCT source1_entity_id) AS n_groups FROM labelled"))
def label_counts(spark, sf_dir):
    _, _, found = _candidates(spark, sf_dir)
    return model.label_counts(model.label_pairs(found, _truth(spark, sf_dir)))


@query(sql("SELECT entity_id FROM norm WHERE trim(clean_name) = '' AND trim(clean_address) = '' UNION ALL SELECT 'planted'"))
def empty_records(spark, sf_dir):
    """Records without words; one is planted."""
    s1, targets = _sources(spark, sf_dir)
    columns = ["entity_id", "clean_name", "clean_address"]
    planted = spark.createDataFrame([("planted", " ", "")], "entity_id string, clean_name string, clean_address string")
    return retrieval.empty_records(s1.select(*columns).unionByName(targets.select(*columns)).unionByName(planted)).select("entity_id")


@query(sql("SELECT g.source1_entity_id, g.candidate_entity_id, sha256(a.clean_text) AS text_s1, sha256(b.clean_text) AS text_cand FROM gated g JOIN norm a ON a.entity_id = g.source1_entity_id JOIN norm b ON b.entity_id = g.candidate_entity_id"))
def texts_of_matches(spark, sf_dir):
    """The texts that a second scorer would compare, as hashes."""
    s1, scored = _scored(spark, sf_dir)
    pairs = model.with_texts(gating.accepted(scored, GATE), s1, _sources(spark, sf_dir)[1])
    return pairs.select("source1_entity_id", "candidate_entity_id", F.sha2("text_s1", 256).alias("text_s1"), F.sha2("text_cand", 256).alias("text_cand"))


@query(sql("SELECT entity_id FROM s1 ORDER BY md5('42' || entity_id), entity_id LIMIT 200"))
def uniform_sample(spark, sf_dir):
    s1, _ = _sources(spark, sf_dir)
    return sampling.uniform_sample(s1, 200, order=_md5("42")).select("entity_id")
