"""TF-IDF postings, and retrieval over them by country.

A postings table has a row for each term of a record: (country, term, entity_id, weight). Similarity is a join on
(country, term) and a sum. Terms that stand in a large share of a country's records would join nearly all pairs; they
only score pairs that rarer terms have found, and a bound says for which queries that can't change the result; the
others take the full join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Blocking
from ..sources.staging import staged, version
from . import vectors

SCORE_DIGITS = 9
#: Pairs that common terms would join for each that rare terms join, from which on pruning pays.
PRUNE_FROM = 20
#: Mean characters of a text from which on records are vectors instead of postings.
LONG = 500
#: Queries and targets of a block.
QUERIES, TARGETS = 2_000, 20_000
#: The same of dense vectors; and what single precision may lack in a product of two of length one.
DENSE_QUERIES, DENSE_TARGETS, NEAR = 64_000, 128_000, np.float32(2e-5)


def word_terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1))


def char_terms(text: Column) -> Column:
    """Runs of three characters within words padded by a space on either side."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    grams = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda k: F.substring(F.concat(F.lit(" "), w, F.lit(" ")), k, F.lit(3)))
    return F.flatten(F.transform(words, grams))


def term_counts(records: DataFrame, terms: Column) -> DataFrame:
    return records.select("entity_id", "country", F.explode(terms).alias("term")).groupBy("entity_id", "country", "term").agg(F.count("*").alias("tf"))


def vocabulary(targets: DataFrame, counts: DataFrame, min_df: int, most: int) -> DataFrame:
    """(country, term, df, idf): terms of at least min_df records, the `most` most frequent of each country. A country
    whose terms are all too rare has none."""
    sizes = targets.groupBy("country").agg(F.count("*").alias("n"))
    df = counts.groupBy("country", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).filter(F.col("df") >= min_df)
    order = Window.partitionBy("country").orderBy(F.desc("total"), "term")
    kept = df.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= most)
    return kept.join(sizes, "country").select("country", "term", "df", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def weigh(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Postings: tf x idf over the vocabulary, each record scaled to length one."""
    raw = counts.join(vocab.select("country", "term", "idf"), ["country", "term"]).withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("country", "entity_id")))
    return raw.select("country", "term", "entity_id", (F.col("w") / norm).alias("weight"))


def word_index(targets: DataFrame, conf: Blocking) -> tuple[DataFrame, DataFrame]:
    counts = staged(term_counts(targets, word_terms(F.col("clean_text"))))
    vocab = staged(vocabulary(targets, counts, conf.word_min_df, conf.word_features))
    return vocab, staged(weigh(counts, vocab))


def char_index(targets: DataFrame, conf: Blocking) -> tuple[DataFrame, DataFrame]:
    counts = staged(term_counts(targets, char_terms(F.col("clean_text"))))
    vocab = staged(vocabulary(targets, counts, 1, conf.char_features))
    return vocab, staged(weigh(counts, vocab))


@dataclass
class Index:
    """What retrieval needs of the targets: sizes of countries, and vocabulary and postings of words and characters."""

    sizes: DataFrame
    words: tuple[DataFrame, DataFrame]
    chars: tuple[DataFrame, DataFrame]

    def save(self, folder: str) -> None:
        """For later runs, parted by country so that queries read their own only."""
        self.sizes.write.mode("overwrite").parquet(f"{folder}/sizes")
        for channel, tables in (("words", self.words), ("chars", self.chars)):
            for name, table in zip(("vocabulary", "postings"), tables, strict=True):
                table.write.mode("overwrite").partitionBy("country").parquet(f"{folder}/{channel}/{name}")
        self.sizes.sparkSession.createDataFrame([("done",)], "state string").coalesce(1).write.mode("overwrite").text(f"{folder}/done")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Index:
        read = lambda path: spark.read.option("partitionColumnTypeInference.enabled", "false").parquet(f"{folder}/{path}")
        kept = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")  # countries are texts
        try:
            return Index(read("sizes"), (read("words/vocabulary"), read("words/postings")), (read("chars/vocabulary"), read("chars/postings")))
        finally:
            spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", kept)


def build_index(targets: DataFrame, conf: Blocking) -> Index:
    return Index(staged(targets.groupBy("country").agg(F.count("*").alias("n"))), word_index(targets, conf), char_index(targets, conf))


def open_index(spark: SparkSession, folder: str, targets: DataFrame | Callable[[], DataFrame], conf: Blocking) -> Index:
    """The index in folder; built and saved if there is none that was finished."""
    if not version(spark, f"{folder}/done/_SUCCESS"):
        build_index(targets() if callable(targets) else targets, conf).save(folder)
    return Index.load(spark, folder)


def query_postings(queries: DataFrame, terms: Column, vocab: DataFrame) -> DataFrame:
    """Postings of queries by the vocabulary of their target country (column `country`)."""
    return staged(weigh(term_counts(queries, terms), vocab))


def similarity(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """(country, source1_entity_id, candidate_entity_id, score): sums of weight products over common terms."""
    q = queries.select("country", "term", F.col("entity_id").alias("source1_entity_id"), F.col("weight").alias("wq"))
    t = targets.select("country", "term", F.col("entity_id").alias("candidate_entity_id"), F.col("weight").alias("wt"))
    return q.join(t, ["country", "term"]).groupBy("country", "source1_entity_id", "candidate_entity_id").agg(F.round(F.sum(F.col("wq") * F.col("wt")), SCORE_DIGITS).alias("score")).filter("score > 0")


def top(pairs: DataFrame, k: int, score: str = "score", by: tuple[str, ...] = ("country", "source1_entity_id"), rank: str = "r") -> DataFrame:
    """The k best of each query by score, then candidate id; ranked from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), "candidate_entity_id")
    return pairs.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def block_pool(queries: DataFrame, targets: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """top() k of similarity(). Queries and targets of a country are dealt over blocks, and each two blocks meet in a task,
    which adds the scores of a query up in an array over its targets and returns the k best."""
    asked = queries.groupBy("country").agg(F.countDistinct("entity_id").alias("asked"))
    dealt = sizes.join(asked, "country").select("country", F.ceil(F.col("asked") / QUERIES).cast("int").alias("qs"), F.ceil(F.col("n") / TARGETS).cast("int").alias("ts"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("entity_id"), F.col(n)).cast("int")
    columns = ["country", "term", "entity_id", "weight"]
    q = queries.select(*columns).join(F.broadcast(dealt), "country").withColumn("q", own("qs")).withColumn("t", every("ts")).select(*columns, "q", "t")
    t = targets.select(*columns).join(F.broadcast(dealt), "country").withColumn("t", own("ts")).withColumn("q", every("qs")).select(*columns, "q", "t")

    def best(asks: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple[str, str, str, float]] = []
        if len(asks) and len(answers):
            country = asks["country"][0].as_py()
            names = sorted(set(answers["entity_id"].to_pylist()))
            number = {name: n for n, name in enumerate(names)}
            codes: dict[str, int] = {}
            term = np.fromiter((codes.setdefault(x, len(codes)) for x in answers["term"].to_pylist()), np.int64, len(answers))
            order = np.argsort(term, kind="stable")
            at = np.searchsorted(term[order], np.arange(len(codes) + 1))
            row = np.fromiter((number[x] for x in answers["entity_id"].to_pylist()), np.int64, len(answers))[order]
            weight = answers["weight"].to_numpy()[order]
            mine: dict[str, list[tuple[int, float]]] = {}
            for s, x, w in zip(asks["entity_id"].to_pylist(), asks["term"].to_pylist(), asks["weight"].to_pylist(), strict=True):
                if x in codes:
                    mine.setdefault(s, []).append((codes[x], w))
            for s, terms in mine.items():
                score = np.zeros(len(names))
                for c, w in terms:
                    part = slice(at[c], at[c + 1])
                    score[row[part]] += w * weight[part]
                score = np.round(score, SCORE_DIGITS)
                found = np.flatnonzero(score > 0)
                if len(found) > k:
                    found = found[score[found] >= np.partition(score[found], len(found) - k)[len(found) - k]]
                found = found[np.lexsort((found, -score[found]))][:k]
                out += [(country, s, names[c], score[c]) for c in found.tolist()]
        kinds = (pa.string(), pa.string(), pa.string(), pa.float64())
        return pa.table([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True) if out else [()] * 4, kinds, strict=True)], names=["country", "source1_entity_id", "candidate_entity_id", "score"])

    found = q.groupBy("country", "q", "t").cogroup(t.groupBy("country", "q", "t")).applyInArrow(best, "country string, source1_entity_id string, candidate_entity_id string, score double")
    return top(found, k)


def word_pool(queries: DataFrame, targets: DataFrame, vocab: DataFrame, sizes: DataFrame, conf: Blocking, mode: str = "auto") -> DataFrame:
    """The pool_k best targets of each query by word similarity.

    All modes give the same rows. "exact" joins all terms. "pruned": rare terms find pairs, common ones add to these
    alone. A pair that shares common terms only scores at most the sum of the query's common weights times the
    greatest target weight; a query whose pool is full of better ones is done, the rest join in full. "blocks" adds scores
    up in arrays, block by block. "auto" prunes where common terms would join far more pairs than rare ones do, as
    in short records, and takes blocks where it would not pay, as in long texts.
    """
    if mode == "exact":
        return top(similarity(queries, targets), conf.pool_k)
    if mode == "auto":
        asked = queries.groupBy("country", "term").agg(F.count("*").alias("asked"))
        pairs = asked.join(vocab, ["country", "term"]).join(sizes, "country").withColumn("pairs", F.col("asked") * F.col("df"))
        often = (F.col("df") > conf.common_share * F.col("n")) & (F.col("df") > conf.pool_k)
        common_pairs, rare_pairs = pairs.agg(F.sum(F.when(often, F.col("pairs")).otherwise(0)), F.sum(F.when(often, 0).otherwise(F.col("pairs")))).first()
        mode = "blocks" if (common_pairs or 0) <= PRUNE_FROM * (rare_pairs or 0) else "pruned"
    if mode == "blocks":
        return block_pool(queries, targets, sizes, conf.pool_k)
    common = staged(vocab.join(sizes, "country").filter((F.col("df") > conf.common_share * F.col("n")) & (F.col("df") > conf.pool_k)).select("country", "term"))
    rare_q, rare_t = (x.join(common, ["country", "term"], "left_anti") for x in (queries, targets))
    common_q, common_t = (x.join(common, ["country", "term"], "left_semi") for x in (queries, targets))
    q = lambda x: x.select("country", "term", F.col("entity_id").alias("source1_entity_id"), F.col("weight").alias("wq"))
    t = lambda x: x.select("country", "term", F.col("entity_id").alias("candidate_entity_id"), F.col("weight").alias("wt"))
    pair = ["country", "source1_entity_id", "candidate_entity_id"]
    rare = q(rare_q).join(t(rare_t), ["country", "term"]).groupBy(*pair).agg(F.sum(F.col("wq") * F.col("wt")).alias("s"))
    # the common terms of a target, as a map next to each pair; a record has few of them
    as_map = lambda x, key: x.groupBy("country", key).agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias(f"m_{key}"))
    map_q = as_map(q(common_q).withColumnRenamed("wq", "w"), "source1_entity_id")
    map_t = as_map(t(common_t).withColumnRenamed("wt", "w"), "candidate_entity_id")
    joined = rare.join(map_q, ["country", "source1_entity_id"], "left").join(map_t, ["country", "candidate_entity_id"], "left")
    more = F.aggregate(
        F.coalesce(F.map_entries("m_source1_entity_id"), F.array().cast("array<struct<key:string,value:double>>")),
        F.lit(0.0),
        lambda acc, e: acc + e["value"] * F.coalesce(F.try_element_at("m_candidate_entity_id", e["key"]), F.lit(0.0)),
    )
    scored = joined.select(*pair, F.round(F.col("s") + F.coalesce(more, F.lit(0.0)), SCORE_DIGITS).alias("score")).filter("score > 0")
    pool = staged(top(scored, conf.pool_k))
    most = common_t.groupBy("country", "term").agg(F.max("weight").alias("most"))
    bound = common_q.join(most, ["country", "term"]).groupBy("country", F.col("entity_id").alias("source1_entity_id")).agg(F.sum(F.col("weight") * F.col("most")).alias("bound"))
    full = pool.groupBy("country", "source1_entity_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    asked = queries.select("country", F.col("entity_id").alias("source1_entity_id")).distinct()
    state = asked.join(bound, ["country", "source1_entity_id"], "left").join(full, ["country", "source1_entity_id"], "left")
    done = F.col("bound").isNull() | ((F.col("n") >= conf.pool_k) & (F.col("least") > F.col("bound") + 10.0**-SCORE_DIGITS))
    open_ = staged(state.filter(~F.coalesce(done, F.lit(False))).select("country", F.col("source1_entity_id").alias("entity_id")))
    again = top(similarity(queries.join(open_, ["country", "entity_id"], "left_semi"), targets), conf.pool_k)
    finished = pool.join(open_.withColumnRenamed("entity_id", "source1_entity_id"), ["country", "source1_entity_id"], "left_anti")
    return finished.select(*pair, "score", "r").unionByName(again.select(*pair, "score", "r"))


def lexical_candidates(queries: DataFrame, targets: DataFrame | Index, conf: Blocking, mode: str = "auto", spent: list[DataFrame] | None = None) -> DataFrame:
    """(country, source1_entity_id, candidate_entity_id, score, r): half word and half character similarity over each
    query's word pool; queries without word overlap go by characters alone. queries' country names the targets'. To
    `spent` go tables that the caller may drop once the result is written."""
    if mode == "vectors" or mode == "auto" and not isinstance(targets, Index) and are_long(targets):
        return _by_vectors(queries, targets, conf, spent)
    index = targets if isinstance(targets, Index) else build_index(targets, conf)
    sizes, (word_vocab, word_targets), (char_vocab, char_targets) = index.sizes, index.words, index.chars
    text = F.col("clean_text")
    word_q, char_q = query_postings(queries, word_terms(text), word_vocab), query_postings(queries, char_terms(text), char_vocab)
    pool = staged(word_pool(word_q, word_targets, word_vocab, sizes, conf, mode))
    # characters, for the pool's pairs only
    q = char_q.select("country", "term", F.col("entity_id").alias("source1_entity_id"), F.col("weight").alias("wq"))
    t = char_targets.select("country", "term", F.col("entity_id").alias("candidate_entity_id"), F.col("weight").alias("wt"))
    pairs = pool.select("country", "source1_entity_id", "candidate_entity_id", F.col("score").alias("word"))
    shared = pairs.join(q, ["country", "source1_entity_id"]).join(t, ["country", "candidate_entity_id", "term"])
    chars = shared.groupBy("country", "source1_entity_id", "candidate_entity_id").agg(F.sum(F.col("wq") * F.col("wt")).alias("char"))
    both = pairs.join(chars, ["country", "source1_entity_id", "candidate_entity_id"], "left")
    both = both.withColumn("score", F.round(0.5 * F.col("word") + 0.5 * F.coalesce("char", F.lit(0.0)), SCORE_DIGITS))
    without = char_q.join(pool.select("country", F.col("source1_entity_id").alias("entity_id")).distinct(), ["country", "entity_id"], "left_anti")
    alone = similarity(without, char_targets)
    keys = ["country", "source1_entity_id", "candidate_entity_id", "score"]
    limits = sizes.select("country", F.least(F.lit(2 * conf.top_k), F.col("n")).alias("most"))
    ranked = top(both.select(*keys).unionByName(alone.select(*keys)).filter("score > 0"), 2 * conf.top_k)
    return ranked.join(F.broadcast(limits), "country").filter("r <= most").drop("most")


def are_long(targets: DataFrame) -> bool:
    """Whether texts are so long that a row for each of their terms would be many times the table; ids come once in it."""
    length, n, ids = targets.agg(F.avg(F.length("clean_text")), F.count("*"), F.countDistinct("country", "entity_id")).first()
    return (length or 0) >= LONG and n == ids


def _by_vectors(queries: DataFrame, targets: DataFrame, conf: Blocking, spent: list[DataFrame] | None = None) -> DataFrame:
    """lexical_candidates() by operators.vectors."""
    both, alone = vectors.hybrid_pairs(queries, targets, conf)
    if spent is not None:
        spent += [both, alone]
    keys = ["country", "source1_entity_id", "candidate_entity_id"]
    both = both.select(*keys, F.round(0.5 * F.col("word") + 0.5 * F.col("char"), SCORE_DIGITS).alias("score"))
    ranked = top(both.unionByName(alone.select(*keys, F.col("word").alias("score"))).filter("score > 0"), 2 * conf.top_k)
    limits = targets.groupBy("country").agg(F.least(F.lit(2 * conf.top_k), F.count("*")).alias("most"))
    return ranked.join(F.broadcast(limits), "country").filter("r <= most").drop("most")


def in_target_countries(queries: DataFrame, targets: DataFrame | Index) -> DataFrame:
    """Queries of countries that have targets as they are; others once for each target country, which their `country`
    then names. `origin` keeps the query's own. The countries are few: one row each."""
    countries = (targets.sizes if isinstance(targets, Index) else targets).select(F.col("country").alias("target")).distinct()
    seen = queries.withColumn("origin", F.col("country")).join(countries, F.col("country") == F.col("target"), "left_semi")
    unseen = queries.withColumn("origin", F.col("country")).join(countries, F.col("country") == F.col("target"), "left_anti")
    every = countries.agg(F.collect_list("target").alias("all"))
    spread = unseen.join(F.broadcast(every)).withColumn("country", F.explode("all")).drop("all")
    return seen.unionByName(spread)


def fuse(lexical: DataFrame, dense: DataFrame | None, conf: Blocking, exact: bool = False) -> DataFrame:
    """Reciprocal ranks summed over channels, the top_k best: source1_entity_id, candidate_entity_id, rrf_score,
    lexical_rank, dense_rank (1000 where absent) and retrieval_similarity; exact: and similarity, the same in double
    precision. Each channel: ids, score and r."""
    key = ["source1_entity_id", "candidate_entity_id"]
    a = lexical.select(*key, F.col("r").alias("lr"), F.col("score").alias("ls"))
    if dense is None:
        joined = a.withColumns({"dr": F.lit(None).cast("int"), "ds": F.lit(None).cast("double")})
    else:
        joined = a.join(dense.select(*key, F.col("r").alias("dr"), F.col("score").alias("ds")), key, "full_outer")
    part = lambda r: F.coalesce(1.0 / (conf.rrf_k + F.col(r)), F.lit(0.0))
    out = joined.withColumn("rrf", F.round(part("lr") + part("dr"), 12)).withColumn("sim", F.when(F.col("ls") > 0, F.col("ls")).otherwise(F.coalesce("ds", F.lit(0.0))))
    order = Window.partitionBy("source1_entity_id").orderBy(F.desc("rrf"), F.desc("sim"), "candidate_entity_id")
    ranked = out.withColumn("fused_rank", F.row_number().over(order)).filter(F.col("fused_rank") <= conf.top_k)
    return ranked.select(
        *key, F.col("rrf").cast("float").alias("rrf_score"), F.coalesce("lr", F.lit(1000)).cast("int").alias("lexical_rank"),
        F.coalesce("dr", F.lit(1000)).cast("int").alias("dense_rank"), F.col("sim").cast("float").alias("retrieval_similarity"), "fused_rank",
        *([F.col("sim").alias("similarity")] if exact else []),
    )


def empty_records(records: DataFrame) -> DataFrame:
    """Clean records without any word in name or address, which only their country could find."""
    return records.filter((F.trim(F.coalesce("clean_name", F.lit(""))) == "") & (F.trim(F.coalesce("clean_address", F.lit(""))) == ""))


def best_lexical(queries: DataFrame, targets: DataFrame | Index, conf: Blocking, mode: str = "auto", spent: list[DataFrame] | None = None) -> DataFrame:
    """lexical_candidates() of every query, its own country's or, where that has no targets, all countries'; ranked anew."""
    found = lexical_candidates(in_target_countries(queries, targets), targets, conf, mode, spent)
    return top(found.drop("r"), 2 * conf.top_k, by=("source1_entity_id",))


def retrieve(queries: DataFrame, targets: DataFrame | Index, conf: Blocking, dense: DataFrame | None = None, mode: str = "auto") -> DataFrame:
    """Candidates of every query: by its own country's targets, or by all countries' where it has none. Ranks of the
    latter count over all countries."""
    return fuse(best_lexical(queries, targets, conf, mode), dense, conf)


def dense_candidates(queries: DataFrame, targets: DataFrame, k: int, most: tuple[int, int] = (DENSE_QUERIES, DENSE_TARGETS)) -> DataFrame:
    """Nearest by cosine within a country: queries and targets have entity_id, country and embedding. Exhaustive
    within a country, as the reference order is; vectors without length take no part, and those of different sizes don't meet.

    Queries and targets are dealt over blocks of about `most` rows, and each two blocks meet in a task. Products in single
    precision say which pairs may be among the k best; these are scored in double precision, component by component."""
    unit = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    ready = lambda df: df.select(*[F.col(c).alias(c) for c in ("country", "entity_id", "embedding")], F.size("embedding").alias("size"), unit.alias("n")).filter("n > 0")
    counted = lambda df, name: ready(df).groupBy("country", "size").agg(F.count("*").alias(name))
    dealt = counted(queries, "qs").join(counted(targets, "ts"), ["country", "size"])
    dealt = dealt.select("country", "size", *[F.ceil(F.col(c) / F.lit(n)).cast("int").alias(c) for c, n in zip(("qs", "ts"), most, strict=True)])
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("entity_id"), F.col(n)).cast("int")
    keys = ["country", "size", "q", "t"]
    columns = [*keys, "entity_id", "embedding", "n"]
    q = ready(queries).join(F.broadcast(dealt), ["country", "size"]).withColumn("q", own("qs")).withColumn("t", every("ts")).select(*columns)
    t = ready(targets).join(F.broadcast(dealt), ["country", "size"]).withColumn("t", own("ts")).withColumn("q", every("qs")).select(*columns)

    def best(asks: pa.Table, answers: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(asks) and len(answers):
            found = list(nearest(_scaled(asks), _scaled(answers), k))
        country = (asks if len(asks) else answers)["country"][0].as_py()
        names = [asks["entity_id"].take(pa.array(found[0])), answers["entity_id"].take(pa.array(found[1]))]
        return pa.table([pa.array([country] * len(found[0]), pa.string()), *(x.cast(pa.string()) for x in names), pa.array(found[2])], names=["country", "source1_entity_id", "candidate_entity_id", "score"])

    found = q.groupBy(*keys).cogroup(t.groupBy(*keys)).applyInArrow(best, "country string, source1_entity_id string, candidate_entity_id string, score double")
    return top(found.withColumn("score", F.round("score", SCORE_DIGITS)).filter("score > 0"), k)


def _scaled(rows: pa.Table) -> np.ndarray:
    """The embeddings in double precision, each divided by its length."""
    values = rows["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(rows), -1) / rows["n"].to_numpy()[:, None]


def nearest(queries: np.ndarray, targets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of queries and of targets, and their products: of each query the k largest and any that come near the k-th."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    single = targets.astype(np.float32)
    finite = bool(np.isfinite(single).all())
    for i in range(0, len(queries), 512):
        mine = queries[i : i + 512]
        low = mine.astype(np.float32)
        # lengths are one, so that other products are numbers
        odd = not (finite and np.isfinite(low).all())
        least = np.full(len(mine), -NEAR, np.float32)
        row, col, value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        for j in range(0, len(targets), 4096):
            s = low @ single[j : j + 4096].T
            if odd:
                s[np.isnan(s)] = np.inf  # stands first, as in an ORDER BY
            if j == 0 and s.shape[1] > k:
                least = np.maximum(least, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] - NEAR)
            at = np.flatnonzero(s >= least[:, None])
            if not len(at):
                continue
            r, c = np.divmod(at, s.shape[1])
            row, col, value = np.concatenate([row, r]), np.concatenate([col, c + j]), np.concatenate([value, s[r, c]])
            order = np.lexsort((-value, row))
            row, col, value = row[order], col[order], value[order]
            first = np.searchsorted(row, np.arange(len(mine)))
            full = np.flatnonzero(np.diff(np.append(first, len(row))) >= k)
            least[full] = np.maximum(least[full], value[first[full] + k - 1] - NEAR)
            kept = value >= least[row]
            row, col, value = row[kept], col[kept], value[kept]
        exact = np.zeros(len(row))
        for d in range(queries.shape[1]):
            exact += mine[row, d] * targets[col, d]
        out.append((row + i, col, exact))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))
