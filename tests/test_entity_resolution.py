import random
import re
import subprocess
import sys
import unicodedata
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinmatch.config import Blocking, Gate, Training
from kinmatch.functions import normalize as N
from kinmatch.functions import strings as S
from kinmatch.operators import boosting, features, gating, model, retrieval, sampling, validation, vectors
from kinmatch.plans import queries
from kinmatch.sources import tables as T

RECORD = "entity_id string, business_name string, business_address string, country string"
ROOT = Path(__file__).resolve().parent.parent


def records(spark, *rows):
    return spark.createDataFrame(list(rows), RECORD)


@pytest.mark.parametrize(
    ("name", "clean", "suffix"),
    [
        ("Apple Inc.", "apple", "inc"), ("Boulangerie de l'Église SARL", "boulangerie de l eglise", "sarl"), ("State Bank of India (SBI) Pvt Ltd", "state bank of india sbi", "pvt ltd"),
        ("Co-Op Market Co", "co op market", "co"), ("Acme Private Limited", "acme", "private limited"), ("Acme Company Limited", "acme company", "limited"),
        ("Private Limited", "private limited", "private limited"), ("ﬁn² & @x", "fin2 and at x", ""), (None, "", ""),
    ],
)
def test_names(spark, name, clean, suffix):
    row = N.normalize(records(spark, ("S1-1", name, "", "US"))).first()
    assert (row.clean_name, row.legal_suffix) == (clean, suffix)


@pytest.mark.parametrize(
    ("address", "country", "clean", "numbers"),
    [
        ("1 Infinite Loop, Ste 100, Cupertino, CA 95014", "US", "1 infinite loop suite 100 cupertino ca 95014", ["1", "100", "95014"]),
        ("14 Rue de la Paix, 75002 Paris", "France", "14 rue de la paix 75002 paris", ["14", "75002"]),
        ("Opp. SBI ATM, M.G. Rd, Bengaluru 560001", "India", "opposite sbi atm m g road bengaluru 560001", ["560001"]),
        ("123 R Street, Building 9, Suite 80", "US", "123 r street building 9 suite 80", ["123", "9", "80"]), ("123 R Paix", "France", "123 rue paix", ["123"]),
        ("12A, 1234567 12-14 99 99", "US", "12a 1234567 12 14 99 99", ["12", "14", "99"]), ("café कि x-y st st", "US", "cafe क x y street street", []),
    ],
)
def test_addresses(spark, address, country, clean, numbers):
    row = N.normalize(records(spark, ("S1-1", "", address, country))).first()
    assert (row.clean_address, row.extracted_numbers) == (clean, numbers)


def test_nulls_and_empty(spark):
    row = N.normalize(records(spark, ("S1-1", None, None, None))).first()
    assert row.clean_text == " |  | UNKNOWN" and row.extracted_numbers == []
    assert N.normalize(records(spark)).count() == 0


def indexed(spark, *texts):
    return spark.createDataFrame([(f"S2-{k}", "US", t) for k, t in enumerate(texts, 1)], "entity_id string, country string, clean_text string")


def test_word_similarity(spark):
    targets = spark.createDataFrame([("S2-1", "US", "red shop us"), ("S2-2", "US", "red cafe us"), ("S3-1", "US", "blue cafe us")], "entity_id string, country string, clean_text string")
    vocab, postings = retrieval.word_index(targets, Blocking())
    assert {r.term: round(r.idf, 6) for r in vocab.collect()} == {"us": 1.0, "red": 1.287682, "cafe": 1.287682}
    query = spark.createDataFrame([("S1-1", "US", "red cafe us")], "entity_id string, country string, clean_text string")
    found = retrieval.top(retrieval.similarity(retrieval.query_postings(query, retrieval.word_terms(F.col("clean_text")), vocab), postings), 5).orderBy("r").collect()
    assert [(r.candidate_entity_id, round(r.score, 6)) for r in found] == [("S2-2", 1.0), ("S2-1", 0.784756), ("S3-1", 0.784756)]


def test_pruned_pool_is_exact(spark, monkeypatch):
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]
    rows = [(f"S{1 + k % 3}-{k}", " ".join(words[(k * p + k // 7) % 10] for p in (1, 2, 3)), f"{k % 17} main street {words[k % 10]}", "US") for k in range(240)]
    s1, targets = T.split_sources(records(spark, *rows))
    s1, targets = N.normalize(s1), N.normalize(targets)
    conf = Blocking(top_k=3)
    key = lambda mode: sorted(map(tuple, retrieval.retrieve(s1, targets, conf, mode=mode).drop("rrf_score", "retrieval_similarity").collect()))
    assert key("exact") == key("pruned")
    monkeypatch.setattr(retrieval, "QUERIES", 30)
    monkeypatch.setattr(retrieval, "TARGETS", 50)
    assert key("exact") == key("blocks") == key("auto")


def test_single_target_unseen_country_and_empty_record(spark):
    s1 = N.normalize(records(spark, ("S1-1", "Apple Inc", "1 Loop", "US"), ("S1-2", "Bank", "9 Road", "France"), ("S1-3", None, None, None)))
    targets = N.normalize(records(spark, ("S2-1", "Apple", "1 Loop", "US"), ("S2-2", "Bank of India", "MG Road", "India"), ("S3-1", "Orange", "2 Loop", "US")))
    found = retrieval.retrieve(s1, targets, Blocking()).collect()
    assert {r.candidate_entity_id for r in found if r.source1_entity_id == "S1-1"} <= {"S2-1", "S3-1"}
    assert "S2-2" in {r.candidate_entity_id for r in found if r.source1_entity_id == "S1-2"}


def test_fusion(spark):
    row = "source1_entity_id string, candidate_entity_id string, score double, r int"
    a, b = spark.createDataFrame([("q", "x", 0.9, 1)], row), spark.createDataFrame([("q", "x", 0.8, 3), ("q", "y", 0.7, 1)], row)
    out = {r.candidate_entity_id: r for r in retrieval.fuse(a, b, Blocking()).collect()}
    assert out["x"].rrf_score == pytest.approx(1 / 61 + 1 / 63, abs=1e-6) and out["y"].rrf_score == pytest.approx(1 / 61, abs=1e-6)
    assert (out["y"].lexical_rank, out["y"].dense_rank, out["x"].dense_rank) == (1000, 1, 3)


def test_pair_features(spark):
    side = "entity_id string, clean_name string, legal_suffix string, clean_address string, extracted_numbers array<string>, country string"
    s1 = spark.createDataFrame([("S1-1", "apple store", "inc", "1 infinite loop cupertino", ["1", "95014"], "US")], side)
    targets = spark.createDataFrame([("S2-1", "apple inc", "inc", "infinite loop cupertino", ["95014"], "US")], side)
    got = features.pair_features(spark.createDataFrame([("S1-1", "S2-1")], "source1_entity_id string, candidate_entity_id string"), s1, targets).first().asDict()
    want = {
        "name_lev_ratio": 0.6, "name_token_sort": 0.6, "name_jaro_winkler": 0.842424, "name_exact_match": 0, "name_len_diff": 2, "name_len_ratio": 0.818181, "name_prefix3_match": 1,
        "name_prefix5_match": 1, "name_acronym_match": 0, "suffix_exact_match": 1, "addr_token_sort": 0.958333, "addr_contains": 1, "addr_jaro_winkler": 0.886377, "addr_word_jaccard": 0.75,
        "num_inter_count": 1, "num_jaccard": 0.5, "num_exact_subset": 1, "lead_num_match": 0, "lead_num_contradict": 1, "num_contradiction": 0, "pin_code_match": 1, "same_country": 1,
        "is_source2": 1, "is_source3": 0, "lexical_rank": 1000, "rrf_score": 0,
    }
    assert {k: pytest.approx(v, abs=2e-5) for k, v in want.items()} == {k: got[k] for k in want}
    assert len(features.NAMES) == 33 and set(got) == {*features.NAMES, "source1_entity_id", "candidate_entity_id"}


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_similarities(a, b):
    assert S.lcs(a, b) == slow_lcs(a, b)
    for f in (S.ratio, S.partial_ratio, S.token_sort_ratio, S.token_set_ratio, S.weighted_ratio, S.jaro_winkler):
        assert -1e-9 <= f(a, b) <= 1 + 1e-9
    for f in (S.ratio, S.token_sort_ratio, S.token_set_ratio):
        assert f(a, b) == pytest.approx(f(b, a))
    if a.split():
        assert S.ratio(a, a) == S.token_set_ratio(a, a) == S.jaro_winkler(a, a) == 1
    short, long_ = sorted((a, b), key=len)
    if short and short in long_:
        assert S.partial_ratio(a, b) == 1


def test_long_texts_are_compared_in_blocks(monkeypatch):
    rnd = random.Random(5)
    word = lambda letters: "".join(rnd.choices(letters, k=rnd.randint(1, 9)))
    for letters in ("ab", "abcdefghijklmnopqrstuvwxyz0123456789", "日本語\U0001f600xyzä"):
        words = [word(letters) for _ in range(300)]
        long_ = [" ".join(rnd.choices(words, k=1500)) for _ in range(2)]
        short = [" ".join([*rnd.choices(words, k=rnd.randint(20, 90)), f"q{k}", word("%&§")]) for k in range(30)]
        a, b = zip(*[(x, y) if k % 2 else (y, x) for k, x in enumerate(short) for y in long_], strict=True)
        expected = [(S.token_sort_ratio(x, y), S.token_set_ratio(x, y)) for x, y in zip(a, b, strict=True)]
        alone = []
        with monkeypatch.context() as m:
            m.setattr(S, "lcs", lambda x, y: alone.append((x, y)) or slow_lcs(x, y))
            common = S._common
            m.setattr(S, "_common", lambda *x: alone.append(x) or common(*x))
            sort, set_, _ = S.token_similarities(list(a), list(b))
        assert list(zip(sort.tolist(), set_.tolist(), strict=True)) == expected
        assert len(alone) < S.FEW  # pair by pair only where few are left


def test_long_texts_of_any_lengths():
    rnd = random.Random(6)
    for letters in ("a", "abc", "abcdefghijklmnopqrstuvwxyz ", "é\U0001f600\ud800x"):
        texts = ["".join(rnd.choices(letters, k=k)) for k in (0, 1, 64, 65, 70, 90, 150, 300, 700, 1500, 2500)] + ["%" * 80, "%" * 70 + "a"]
        pairs = [(x, y) for x in texts for y in texts if len(x) * len(y) < 150_000]
        assert S.lcs_of([x for x, _ in pairs], [y for _, y in pairs]).tolist() == [slow_lcs(x, y) for x, y in pairs]


def slow_jaro(a, b):
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, hits = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    m, other = len(hits), [c for c, u in zip(b, used, strict=True) if u]
    return (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(hits, other, strict=True)) // 2) / m) / 3 if m else 0.0


@given(st.text("abc ", min_size=1, max_size=30), st.text("abc ", min_size=1, max_size=30))
def test_jaro(a, b):
    want = slow_jaro(a, b)
    if want > 0.7:
        prefix = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        want += 0.1 * min(prefix, 4) * (1 - want)
    assert S.jaro_winkler(a, b) == pytest.approx(want)


@given(st.lists(st.tuples(st.text("abcé ", max_size=14), st.text("abcé ", max_size=90)), max_size=8))
def test_batches_of_similarities(rows):
    rows += [("ab c" * 20, "b ca" * 30), ("a" * 64, "a" * 70), ("", ""), ("x", "")]
    a, b = [x for x, _ in rows], [y for _, y in rows]
    plain = {"lev_ratio": S.ratio, "partial_ratio": S.partial_ratio, "token_sort": S.token_sort_ratio, "token_set": S.token_set_ratio, "wratio": S.weighted_ratio, "jaro_winkler": S.jaro_winkler}
    for x, y in ((a, b), (b, a)):
        got = S.similarities(x, y, list(plain))
        for name, f in plain.items():
            assert got[name].tolist() == pytest.approx([f(u, v) for u, v in zip(x, y, strict=True)], abs=1e-12), name


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "source1_entity_id string, candidate_entity_id string, predicted_prob double")


@pytest.mark.parametrize(("gate", "want"), [(Gate(0.75, 0.55, 0.11), "S2-a,S2-b"), (Gate(0.96, 0.55, 0.11), ""), (Gate(0.75, 0.90, 0.11), "S2-a")])
def test_gate(spark, gate, want):
    scored = pairs(spark, ("S1-1", "S2-a", 0.95), ("S1-1", "S2-b", 0.88), ("S1-1", "S2-c", 0.60), ("S1-1", "S2-a", 0.95))
    ids = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    assert dict(map(tuple, gating.matching_results(scored, ids, gate).collect())) == {"S1-1": want, "S1-2": ""}


def test_margin_name():
    assert gating.margin(0.11, 0.3) == 0.3 and gating.margin(0.11, 0.31) == gating.margin(0.11, None) == 0.11


def test_metric(spark):
    truth = spark.createDataFrame([("1", "a"), ("1", "c"), ("4", "a"), ("5", "a")], "source1_entity_id string, matched_id string")
    predicted = pairs(spark, *[("1", x, 1.0) for x in "abc"], ("3", "z", 1.0), ("5", "b", 1.0))
    entities = spark.createDataFrame([(str(k),) for k in range(1, 6)], "source1_entity_id string")
    scores = gating.entity_scores(predicted, truth, entities)
    assert {r.source1_entity_id: round(r.f05, 6) for r in scores.collect()} == {"1": 0.714286, "2": 1.0, "3": 0.0, "4": 0.0, "5": 0.0}
    assert gating.macro_f05(scores).first()[0] == pytest.approx(0.342857, abs=1e-6)


def test_grid():
    assert len(gating.threshold_pairs()) == 65 and (80, 70) not in gating.threshold_pairs()


def test_hard_negatives(spark):
    rows = spark.createDataFrame([(0, float(k), 1.0) for k in range(1, 5)] + [(1, 9.0, 1.0)], "label int, score double, weight double")
    got = {r.score: r.weight for r in model.hard_negative_weights(rows, Training()).collect()}
    assert got == {1.0: 1.0, 2.0: 1.0, 3.0: 1.0, 4.0: 2.5, 9.0: 1.0}
    again = model.hard_negative_weights(rows.withColumn("weight", F.lit(6.25)), Training())
    assert {r.score: r.weight for r in again.collect()}[4.0] == 10.0


def test_hard_negatives_label_pairs_once(spark, monkeypatch):
    """The percentile's passes read labelled pairs that are staged; each once looked up the truth anew."""
    seen = spark.sparkContext.accumulator(0)

    def noted(x):
        seen.add(1)
        return x

    truth = spark.createDataFrame([("S1-1", "S2-1")], "source1_entity_id string, matched_id string").withColumn("matched_id", F.udf(noted, "string").asNondeterministic()("matched_id"))
    scored = spark.createDataFrame([("S1-1", f"S2-{k}", 1 - k / 20) for k in range(1, 20)], "source1_entity_id string, candidate_entity_id string, predicted_prob double")
    monkeypatch.setattr(queries, "_scored", lambda *_: (None, scored))
    monkeypatch.setattr(queries, "_truth", lambda *_: truth)
    got = {r.candidate_entity_id for r in queries.hard_negative_weights(spark, "").collect() if r.weight > 1}
    assert got == {"S2-2", "S2-3"} and seen.value == 1


def test_word_search_leaves_characters_alone(spark, monkeypatch):
    """What is asked by words has no vocabulary and no vectors of characters; its pairs are those of the search by both."""
    rng = random.Random(3)
    side = lambda name, n: spark.createDataFrame([(f"{name}-{k}", "US", " ".join(rng.choice(["oak", "elm", "fir", "ash", "bay", "yew"]) + str(rng.randint(0, 9)) for _ in range(40))) for k in range(n)], "entity_id string, country string, clean_text string")
    asked, targets = side("S1", 12), side("S2", 70)
    kept = []
    monkeypatch.setattr(vectors, "staged", lambda df, name="stage", make=vectors.staged: (kept.append((name, [r.asDict() for r in df.collect()] if name in ("vocabulary", "vectors") else [])), make(df, name))[1])
    columns = ["source1_entity_id", "candidate_entity_id", "word", "r"]
    words = sorted(map(tuple, vectors.word_pairs(asked, targets, Blocking()).select(*columns).collect()))
    assert {r["kind"] for name, rows in kept if name == "vocabulary" for r in rows} == {"words"}
    assert all(r["chars"] is None and r["words"] for name, rows in kept if name == "vectors" for r in rows)
    assert words == sorted(map(tuple, vectors.hybrid_pairs(asked, targets, Blocking())[0].select(*columns).collect())) and words


def test_model_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(f"S1-{k}", f"S2-{j}", int(k % 5 == j), float(k % 5 == j) * 0.8 + 0.01 * j) for k in range(30) for j in range(5)], "source1_entity_id string, candidate_entity_id string, label int, x double")
    models, scored = model.train(rows, Training(trees=30, depth=2, folds=2, least_rows=2, step=0.3), ["x"])
    assert scored.count() == 150 and scored.groupBy("source1_entity_id").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
    model.save(models, str(tmp_path / "m"), ["x"])
    loaded, names = model.load(spark, str(tmp_path / "m"))
    assert names == ["x"]
    a, b = (sorted((r.source1_entity_id, r.candidate_entity_id, round(r.predicted_prob, 9)) for r in model.predict(m, rows, ["x"]).collect()) for m in (models, loaded))
    assert a == b
    good = [p for s, c, p in a if int(s[3:]) % 5 == int(c[3:])]
    assert min(good) > max(p for s, c, p in a if int(s[3:]) % 5 != int(c[3:]))


def test_long_addresses_are_compared_by_blocks(spark, monkeypatch):
    """The same features as from texts in each pair's row, which long addresses leave: copies, parts that begin and end within
    words, empty texts, records that are absent or come twice, pairs that come twice, letters beyond ASCII."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcé日😀", k=rng.randint(1, 5))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 500))) for _ in range(24)]
    texts += [texts[0], texts[1][7:-9], texts[2][3:], texts[3][:-4], "", "abc", texts[4][5:9], " ".join(texts[5].split()[::-1]), None, "a b c d", "xa b c dx"]
    row = "entity_id string, clean_name string, legal_suffix string, clean_address string, extracted_numbers array<string>, country string"
    side = lambda name: spark.createDataFrame([(f"{name}-{k}", f"n{k}", "", x, ["1", str(k % 3)], "US") for k, x in enumerate([*texts, *texts[:2]])] + [(f"{name}-1", "again", "", "other text", [], "US")], row).coalesce(1)
    s1, targets = side("S1"), side("S2")
    pairs = spark.createDataFrame([(f"S1-{i}", f"S2-{j}") for i in range(len(texts) + 1) for j in range(i % 3, len(texts) + 4, 3)] + [("S1-x", "S2-1"), ("S1-x", "S2-x"), ("S1-28", "S2-x"), ("S1-2", "S2-2"), ("S1-2", "S2-2")], "source1_entity_id string, candidate_entity_id string")
    wanted = {*features.ADDRESSES, "name_lev_ratio"}
    key = lambda found: sorted(tuple(r) for r in found.select(*features.addresses.KEYS, *[F.round(c, 9) for c in sorted(wanted)]).collect())
    with monkeypatch.context() as m:
        m.setattr(features, "LONG", 1e9)
        plain = features.with_comparisons(pairs, s1, targets, wanted)
        assert "clean_address_s1" in plain.columns
        expected = key(plain)
    monkeypatch.setattr(features, "LONG", 100)
    for block, chunk, step in ((48_000_000, 1024, 1024), (6_000, 4, 3)):
        for name, value in (("BLOCK", block), ("CHUNK", chunk), ("STEP", step)):
            monkeypatch.setattr(features.addresses, name, value)
        found = features.with_comparisons(pairs, s1, targets, wanted)
        assert key(found) == expected
        alone = features.with_comparisons(pairs, s1, targets, wanted - features.TOKENS)
        assert not [c for c in alone.columns if c.startswith("clean_address")]
    assert len(expected) == pairs.count() and sum(r[2] for r in expected) > 20


def test_models_see_every_pair(spark):
    """More pairs than a task of trees was once given: the rate that a model starts from is that of all the other folds' pairs."""
    rows = spark.range(500_000, numPartitions=4).select(
        F.concat(F.lit("S1-"), (F.col("id") / 40).cast("int").cast("string")).alias("source1_entity_id"), F.concat(F.lit("S2-"), F.col("id").cast("string")).alias("candidate_entity_id"),
        (F.pmod(F.xxhash64("id"), F.lit(37)) == 0).cast("int").alias("label"), (F.col("id") % 7).cast("float").alias("x"),
    )
    models, scored = model.train(rows, Training(trees=1, rounds=1), ["x"])
    counts = {r.fold: (r.n, r.y) for r in scored.groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("y")).collect()}
    assert sum(n for n, _ in counts.values()) == 500_000
    for fold, one in enumerate(models):
        n, y = (sum(c[k] for f, c in counts.items() if f != fold) for k in (0, 1))
        assert one.start == pytest.approx(np.log(y / (n - y)), abs=1e-12)


def test_boosting_learns_and_stops():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 6))
    y = ((x[:, 0] > 0.3) & (x[:, 1] * x[:, 2] > 0) ^ (rng.random(4000) < 0.02)).astype(float)
    entity = np.arange(4000) // 10
    split = 3000
    model = boosting.fit(x[:split], y[:split], np.ones(split), x[split:], y[split:], entity[split:] - entity[split], 300, 20, boosting.Growth(), 7)
    p = model.probabilities(x[split:])
    assert ((p >= 0.5) == (y[split:] == 1)).mean() > 0.94 and 5 < len(model.trees) < 300
    again = boosting.Booster.load(model.dump())
    assert (again.probabilities(x) == model.probabilities(x)).all()
    for tree in model.trees:
        assert (tree.feature < 0).sum() <= 63 and len(tree.value) == 2 * (tree.feature < 0).sum() - 1
    # the prefix that was kept is the best of all tried
    raw = np.full(1000, model.start)
    scores = []
    for tree in model.trees:
        raw += tree.predict(model.codes(x[split:]))
        scores.append(boosting.macro_f05(entity[split:] - entity[split], y[split:], (raw >= 0).astype(float)))
    assert max(scores) == scores[-1]
    one = boosting.fit(x[:50], np.zeros(50), np.ones(50), x[:5], np.zeros(5), np.zeros(5, int), 5, 2, boosting.Growth(), 1)
    assert not one.trees and (one.probabilities(x[:3]) < 0.05).all()


def test_macro_f05_of_arrays():
    entity = np.array([0, 0, 0, 2, 3, 4, 4])
    label, said = np.array([1, 1, 0, 0, 1, 1, 0.0]), np.array([1, 1, 1, 1, 0, 0, 1.0])
    assert boosting.macro_f05(entity, label, said) == pytest.approx((0.714286 + 1 + 0 + 0 + 0) / 5, abs=1e-6)


@pytest.mark.parametrize("few", [10, 100_000])
def test_exact_percentile(spark, few, monkeypatch):
    monkeypatch.setattr(model, "FEW", few)
    rng = np.random.default_rng(2)
    for values in (rng.random(3000), np.round(rng.random(3000), 1), np.array([1.0, 2, 3, 4]), np.array([5.0])):
        rows = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
        assert model.exact_percentile(rows, "v", 0.9) == pytest.approx(np.percentile(values, 90))
    assert model.exact_percentile(rows.limit(0), "v", 0.9) is None


def test_cascade(spark):
    got = [r[0] for r in model.cascade(pairs(spark, ("a", "b", 0.38), ("a", "c", 0.73)), F.lit(0.0)).select("predicted_prob").collect()]
    assert got == pytest.approx([0.44, 0.73])


def test_files(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNone\tx\tUS\nS1-2\tB\t\tnan\n")
    got = T.read_records(spark, str(tmp_path / "r.tsv")).orderBy("entity_id").collect()
    assert [tuple(r) for r in got] == [("S1-1", None, "x", "US"), ("S1-2", "B", None, None)]
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2,\nS1-2\nS1-3\t\n")
    assert {r[0]: r[1] for r in T.read_truth(spark, str(tmp_path / "t.tsv")).collect()} == {"S1-1": ["S2-1", "S3-2"], "S1-2": [], "S1-3": []}
    T.write_id_lists(spark.createDataFrame([("S1-2", "", 1), ("S1-1", "S2-1,S2-2", 0)], "source1_entity_id string, matched_entity_ids string, n int").coalesce(1), str(tmp_path / "o"), "n")
    text = "".join(p.read_text() for p in sorted((tmp_path / "o").glob("part-*")))
    assert text.replace("source1_entity_id\tmatched_entity_ids\n", "") == "S1-1\tS2-1,S2-2\nS1-2\t\n"
    names = T.package({"a.tsv": str(tmp_path / "r.tsv"), "code": str(ROOT / "kinmatch" / "functions")}, str(tmp_path / "z.zip"))
    assert "a.tsv" in names and "code/normalize.py" in names and not any(n.endswith(".pyc") for n in names)


def test_cache(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3)
    for _ in range(2):
        assert T.cached(spark, str(tmp_path), {"k": 1}, make).count() == 3
    assert len(made) == 1


def submission(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


HEAD = "source1_entity_id\tmatched_entity_ids\n"


@pytest.mark.parametrize(
    ("text", "fault"),
    [
        (HEAD + "S1-1\tS2-1,S3-1\nS1-2\t\n", None), (" SOURCE1_ENTITY_ID \tmatched_entity_ids\nS1-1\t\nS1-2\t\n", None), ("source1_entity_id,matched_entity_ids\nS1-1,\n", "commas"),
        (HEAD + "S1-1\nS1-2\t\n", "without a tab"), (HEAD + "S1-1\tS2-1,S2-1\nS1-2\t\n", "duplicate_id"), (HEAD + "S1-1\tS2-1, S3-2\nS1-2\t\n", "wrong_prefix"),
        (HEAD + "S1-1\tS1-9\nS1-2\t\n", "self_match"), (HEAD + "S1-1\t\n", "missing"), (HEAD + "S1-1\t\nS1-2\t\nS1-3\t\n", "extra"), (HEAD + "S1-1\t\nS1-1\t\nS1-2\t\n", "duplicate_row"), ("", "empty"),
        ("a\tb\n", "header"),
    ],
)
def test_validation(spark, tmp_path, text, fault):
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    report = validation.validate(spark, submission(tmp_path, "m.tsv", text), required)
    assert report.ok if fault is None else any(fault in e for e in report.errors), report.errors
    assert report.may_package == report.ok or fault == "missing"


def test_validation_warnings(spark, tmp_path):
    required = spark.createDataFrame([("S1-1",)], "entity_id string")
    valid = spark.createDataFrame([("S2-1",)], "entity_id string")
    m = submission(tmp_path, "m.tsv", HEAD + "S1-1\tS2-1,S2-2\n")
    c = submission(tmp_path, "c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\n")
    report = validation.validate(spark, m, required, c, valid)
    assert any("unknown_id" in e for e in report.errors) and any("aren't among" in w for w in report.warnings)
    assert validation.validate(spark, str(tmp_path / "none.tsv"), required).errors


def test_sampling(spark):
    rows = [(f"S1-{k}", None, None, "US" if k % 2 else "INDIA") for k in range(100)]
    truth = spark.createDataFrame([(f"S1-{k}", f"S2-{k}") for k in range(0, 100, 3)], "source1_entity_id string, matched_id string")
    s1 = sampling.strata(records(spark, *rows), truth)
    quotas = {("US", True): 10, ("US", False): 5, ("INDIA", True): 100}
    drawn = sampling.stratified_sample(s1, quotas)
    counts = {(r.country, r.singleton): r["count"] for r in drawn.groupBy("country", "singleton").count().collect()}
    assert counts == {("US", True): 10, ("US", False): 5, ("INDIA", True): 33}
    assert drawn.filter("country = 'US' and split = 'train'").count() == 12
    targets = records(spark, *[(f"S2-{k}", "a", "b", "US") for k in range(200)])
    pool = sampling.target_pool(targets, drawn, truth, share=1.0, cap=20)
    wanted = {f"S2-{r.entity_id[3:]}" for r in drawn.filter("not singleton").collect()}
    assert {r.entity_id for r in pool.filter("is_true").collect()} == wanted and pool.filter("not is_true").count() == 20
    profile = {r.column_name: r.n_null for r in sampling.null_profile(records(spark, *rows)).collect()}
    assert profile == {"entity_id": 0, "business_name": 100, "business_address": 100, "country": 0}


def business(spark, tmp_path, n=60):
    """Files of S1, S2 and S3 records, two of three with a noisy copy, and their truth."""
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(4, 8)))
    rows, truth = {"S1": [], "S2": [], "S3": []}, []
    for k in range(n):
        name, street, country = f"{word()} {word()}", f"{k} {word()} St", ("US", "India")[k % 2]
        rows["S1"].append((f"S1-{k}", f"{name} Inc", f"{street}, {10000 + k}", country))
        mine = []
        for s in ("S2", "S3")[: k % 3]:
            rows[s].append((f"{s}-{k}", name.upper(), f"{street.replace('St', 'Street')} {10000 + k}", country))
            mine.append(f"{s}-{k}")
        truth.append((f"S1-{k}", ",".join(mine)))
        rows["S2"].append((f"S2-{n + k}", f"{word()} {word()}", f"{900 + k} {word()} Rd", country))
    paths = {}
    for s, records_ in rows.items():
        paths[s] = str(tmp_path / f"{s}.tsv")
        Path(paths[s]).write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(r) + "\n" for r in records_))
    paths["truth"] = str(tmp_path / "truth.tsv")
    Path(paths["truth"]).write_text("source1_entity_id\tmatched_entity_ids\n" + "".join("\t".join(r) + "\n" for r in truth))
    return paths, rows, dict(truth)


def test_whole_plan(spark, tmp_path):
    """Train, tune, match, write and check, from files to files."""
    from dataclasses import replace

    from kinmatch.config import Settings
    from kinmatch.plans import pipeline, search

    paths, rows, truth = business(spark, tmp_path)
    s1, targets = T.read_records(spark, paths["S1"]), T.read_records(spark, paths["S2"]).unionByName(T.read_records(spark, paths["S3"]))
    pairs_ = T.read_truth(spark, paths["truth"]).select("source1_entity_id", F.explode("matched_ids").alias("matched_id"))
    conf = Settings(blocking=Blocking(top_k=10, train_top_k=8), training=Training(trees=40, folds=2, least_rows=3, step=0.2))
    out, index = str(tmp_path / "out"), str(tmp_path / "index")
    gate, value = pipeline.run((s1, targets, pairs_), (s1, targets), out, conf, index)
    assert value > 0.9
    lines = Path(f"{out}/matching_results.tsv").read_text().splitlines()
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and [x.split("\t")[0] for x in lines[1:]] == [r[0] for r in rows["S1"]]
    said = {x.split("\t")[0]: set(filter(None, x.split("\t")[1].split(","))) for x in lines[1:]}
    assert sum(said[k] == set(filter(None, v.split(","))) for k, v in truth.items()) >= 54
    report = validation.validate(spark, f"{out}/matching_results.tsv", s1, f"{out}/candidate_pairs.tsv", targets)
    assert report.ok and not report.warnings, (report.errors, report.warnings)
    # the index that was kept serves another run, and its candidates are the same
    clean = N.normalize(s1)
    again = retrieval.open_index(spark, index, lambda: 1 / 0, conf.blocking)
    key = lambda x: sorted(map(tuple, retrieval.retrieve(clean, x, conf.blocking).collect()))
    assert key(again) == key(N.normalize(targets))
    models, names = model.load(spark, f"{out}/model")
    assert len(models) == 2 and names == features.NAMES
    _, scored, candidates = pipeline.scored_candidates(s1, targets, pairs_, replace(conf, blocking=Blocking(top_k=10)))
    log, trial, best = search.search(scored, pairs_, s1.select(F.col("entity_id").alias("source1_entity_id")))
    assert best > 0.7 and 1 <= log.count() <= search.TRIALS
    matches, lists = search.export(scored, candidates, s1, trial)
    assert matches.count() == lists.count() == 60
    T.write_single(search.trial_log(log, 2.0).withColumn("_at", F.col("trial")), str(tmp_path / "trials.csv"), "_at", sep=",")
    assert Path(tmp_path / "trials.csv").read_text().splitlines()[0] == "trial,top_k,tau_singleton,tau_match,delta_margin,macro_f05,macro_precision,macro_recall,singleton_acc,runtime_sec"


def test_benchmark_files(spark, tmp_path):
    from kinmatch.plans.benchmark import write_benchmark

    paths, rows, truth = business(spark, tmp_path)
    quotas = {("US", True): 4, ("US", False): 10, ("INDIA", True): 4, ("INDIA", False): 7}
    sample = {r.entity_id: r.split for r in write_benchmark(spark, paths, paths["truth"], str(tmp_path / "b"), quotas, share=1.0, cap=5).collect()}
    assert len(sample) == 25
    lines = {s: Path(paths[s]).read_text().splitlines() for s in ("S1", "S2", "S3")}
    for split in ("train", "val"):
        got = (tmp_path / "b" / split / f"{split}_source1.tsv").read_text().splitlines()
        assert got == [lines["S1"][0]] + [x for x in lines["S1"][1:] if sample.get(x.split("\t")[0]) == split]
        lists = dict(x.split("\t") for x in (tmp_path / "b" / split / f"{split}_ground_truth.tsv").read_text().splitlines()[1:])
        assert lists == {k: truth[k] for k, v in sample.items() if v == split}
    needed = {m for k in sample for m in truth[k].split(",") if m}
    for k in (2, 3):
        got = (tmp_path / "b" / f"benchmark_source{k}.tsv").read_text().splitlines()
        assert got[0] == lines[f"S{k}"][0] and [x for x in lines[f"S{k}"] if x in got] == got
        ids = {x.split("\t")[0] for x in got[1:]}
        assert {m for m in needed if m.startswith(f"S{k}-")} <= ids and len(ids - needed) <= 5


def test_patience(spark):
    from kinmatch.plans import search

    rows = [(k, 20, 50, 50, 3, v) for k, v in enumerate([0.5, 0.6, 0.60005, 0.6, 0.1, 0.6, 0.6, 0.9])]
    log, trial, best = search.logged(spark.createDataFrame(rows, "trial int, top_k int, tau_s int, tau_m int, delta int, macro_f05 double"), patience=5)
    assert (log.count(), best) == (7, 0.60005)
    drawn = search.draw_trials(20)
    assert len(set(drawn)) == 20 and drawn == search.draw_trials(20) and all(t.tau_m >= max(50, t.tau_s - 5) for t in drawn)


def test_scans(spark, tmp_path):
    (tmp_path / "ids.tsv").write_text("name of the id\tx\nS1-2\ta\n\n S1-1 \tb\nS1-2\tc\n")
    assert {r[0] for r in T.read_ids(spark, str(tmp_path / "ids.tsv")).collect()} == {"S1-1", "S1-2"}
    (tmp_path / "r.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f"S1-{k}\ta\tb\tUS\n" for k in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert [r.entity_id for r in T.read_records(spark, str(tmp_path / "r.tsv"), rows=2500).collect()] == [f"S1-{k}" for k in range(2500)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "bad.tsv").write_bytes(HEAD.encode() + b"S1-1\tS2-\xff\n")
    assert any("UTF-8" in e for e in validation.validate(spark, str(tmp_path / "bad.tsv"), spark.createDataFrame([("S1-1",)], "entity_id string")).errors)
    (tmp_path / "twice.tsv").write_text(HEAD + HEAD + "S1-1\t\n")
    assert any("extra" in e for e in validation.validate(spark, str(tmp_path / "twice.tsv"), spark.createDataFrame([("S1-1",)], "entity_id string")).errors)


def test_texts_for_a_second_scorer(spark):
    side = "entity_id string, clean_text string"
    got = model.with_texts(pairs(spark, ("S1-1", "S2-1", 0.5), ("S1-1", "S2-9", 0.5)), spark.createDataFrame([("S1-1", "a | b | US")], side), spark.createDataFrame([("S2-1", "c")], side)).collect()
    assert {(r.candidate_entity_id, r.text_s1, r.text_cand) for r in got} == {("S2-1", "a | b | US", "c"), ("S2-9", "a | b | US", "")}


def test_trial_counts_are_those_of_one_setting_at_a_time(spark):
    import random

    rng = random.Random(8)
    rows = [(f"S1-{k}", f"S2-{j}", round(rng.random(), 3), j + 1) for k in range(25) for j in range(rng.randint(0, 6))]
    scored = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, predicted_prob double, fused_rank int")
    truth = spark.createDataFrame([(f"S1-{k}", f"S2-{rng.randrange(6)}") for k in range(0, 25, 2)], "source1_entity_id string, matched_id string")
    entities = spark.createDataFrame([(f"S1-{k}",) for k in range(25)], "source1_entity_id string")
    settings = [(2, 50, 55, 11), (4, 75, 50, 30), (1000, 60, 70, 5)]
    got = {(r.trial, r.source1_entity_id): (r.n_true, r.n_pred, r.n_hit) for r in gating.trial_counts(scored, truth, entities, gating.trials(spark, settings)).collect()}
    for t, (k, s, m, d) in enumerate(settings):
        kept = gating.accepted(scored.filter(F.col("fused_rank") <= k), Gate(s / 100, m / 100, d / 100))
        for r in gating.entity_scores(kept, truth, entities).collect():
            assert got[t, r.source1_entity_id] == (r.n_true, r.n_pred, r.n_hit)


def test_entry_without_llm(tmp_path):
    import shutil

    shutil.copytree(ROOT / "kinmatch", tmp_path / "kinmatch", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 25 and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)}, check=True)


def test_dense_candidates_by_blocks_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(700, 8)).round(1)
    vectors[5:40] = vectors[5]  # ties go to the smaller id
    vectors[50] = 0
    rows = [(f"{k:03d}", "AB"[k % 2], v.tolist()) for k, v in enumerate(vectors)] + [("short", "A", [1.0]), ("none", "A", None), ("hole", "A", [None] * 8)]
    df = spark.createDataFrame(rows, "entity_id string, country string, embedding array<double>")
    queries, targets = df.filter("entity_id < '100' or entity_id > 'a'"), df.filter("entity_id >= '005'")
    wanted = {}
    for q in (r for r in rows[:100] if any(r[2])):
        near = [(-round(float(np.dot(q[2], t[2]) / np.linalg.norm(q[2]) / np.linalg.norm(t[2])), 9), t[0]) for t in rows[5:700] if t[1] == q[1] and any(t[2])]
        wanted[q[0]] = [i for s, i in sorted(near) if s < 0][:6]
    for most in ((64_000, 128_000), (20, 90)):
        found = retrieval.dense_candidates(queries, targets, 6, most).orderBy("source1_entity_id", "r").collect()
        plan = {}
        for r in found:
            plan.setdefault(r.source1_entity_id, []).append(r.candidate_entity_id)
        assert plan.pop("short") == ["short"]
        assert plan == wanted


def test_dense_candidates_make_no_table_of_all_pairs(spark, capsys):
    df = spark.createDataFrame([("a", "A", [1.0, 2.0])], "entity_id string, country string, embedding array<double>")
    retrieval.dense_candidates(df, df, 3).explain()
    shown = capsys.readouterr().out
    assert "FlatMapCoGroupsInArrow" in shown and "zip_with" not in shown


def long_records(spark, n=240):
    words = [f"w{chr(97 + k % 26)}{k}" for k in range(90)]
    rng = np.random.default_rng(5)
    text = lambda k: " ".join(words[int(x)] for x in rng.zipf(1.3, 40 + k % 50) % 90) + " straße ﬁn x " * (k % 3)
    texts = [text(k) for k in range(n)]
    rows = [(f"S{1 + k % 3}-{k}", texts[k // 2 if k % 5 == 0 else k][:12], "pad " * 120 + texts[k // 2 if k % 5 == 0 else k] + " echo" * (300 * (k == 7)), "US" if k % 7 else ["France", "India"][k % 2]) for k in range(n)]
    s1, targets = T.split_sources(records(spark, *rows, ("S1-none", None, None, "Spain"), ("S1-own", "w2", "", "Spain"), ("S1-odd", "zzzq", "zzzq", "Chile")))
    return N.normalize(s1), N.normalize(targets)


def test_vectors_retrieve_what_postings_do(spark, monkeypatch):
    s1, targets = long_records(spark)
    conf = Blocking(top_k=5)
    assert retrieval.are_long(targets)
    key = lambda mode: sorted(map(tuple, retrieval.lexical_candidates(retrieval.in_target_countries(s1, targets), targets, conf, mode).select("country", "source1_entity_id", "candidate_entity_id", F.round("score", 8), "r").collect()))
    wanted = key("exact")
    assert len(wanted) > 500
    assert key("auto") == wanted
    monkeypatch.setattr(vectors, "BLOCK", 40)
    assert key("vectors") == wanted


def test_long_texts_leave_no_row_for_each_term(spark, monkeypatch):
    s1, targets = long_records(spark, 30)
    monkeypatch.setattr(retrieval, "term_counts", lambda *_: 1 / 0)
    assert retrieval.retrieve(s1, targets, Blocking()).count()


def test_vectors_find_the_terms_that_expressions_do(spark):
    texts = ["a bb  c_c\tdd", "", "straße ﬁn x² 12 · ّ يا", " | us", "é" * 5, "bb bb " * 300]
    rows = spark.createDataFrame([(str(k), "US", t) for k, t in enumerate(texts)], "entity_id string, country string, clean_text string")
    for terms, found in ((retrieval.word_terms, vectors.word_counts(texts, (codes := vectors.Codes()).__getitem__)), (retrieval.char_terms, vectors.char_counts(texts))):
        name = list(codes).__getitem__ if terms is retrieval.word_terms else vectors.run_text
        wanted = {(r.entity_id, r.term): r.tf for r in retrieval.term_counts(rows, terms(F.lower("clean_text"))).collect()}
        assert {(str(k), name(x)): n for k, x, n in zip(*(c.tolist() for c in found), strict=True)} == wanted


def test_word_pools_by_vectors_leave_only_their_pairs(spark):
    s1, targets = long_records(spark, 30)
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(folder.iterdir())
    assert vectors.word_pairs(s1, targets, Blocking()).count()
    assert [p.name.split("-")[1] for p in set(folder.iterdir()) - before] == ["pairs"]


@pytest.mark.parametrize("text", ["", " ", "a", "a  b", " \t a\n\nb \r c   d     e f \n", "x" + " \n" * 20 + "y z", "a b c d", "a b c d e\tf", "a b   c"])
def test_white_space_of_records_and_truth(spark, text):
    docs = spark.createDataFrame([(3, text, "en", "x", 7), (4, " ".join(re.split("[ \t\n\r]+", text.strip(" \t\n\r"))), "en", "x", 7)], "doc_id long, text string, lang string, source string, n_chars int")
    words = re.split("[ \t\n\r]+", text.strip(" \t\n\r"))
    row = T.documents_as_records(docs).filter("entity_id = 'S1-3'").first()
    assert row.business_name == " ".join(words[:4]) and row.business_address == f"7 {' '.join(words[4:])} 10007"
    assert T.documents_truth(docs).count() == 1


def test_addresses_in_one_pass(spark):
    """Addresses as rule after rule over the whole text leaves them; a plan has no pattern over every letter of it."""
    rng = random.Random(5)
    parts = ["st", "St.", "opp", "opposite", "to", " ", "\n", "#", "/", "r", "bd", "pl", "12", "1234567", "é", "½", "٣", "_", "ß", "fl", "nr-", "ﬁ", "1a", "’", "É12", "²", "12.5"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(1, 12))) for _ in range(400)] + [None, "", "opposite \t to #5 /x"]

    def rules(text, country):
        plain = "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c))
        t = plain.lower().replace("#", " unit ").replace("/", " ")
        for word, full in N.ENGLISH_RULES + (N.FRENCH_RULES if country == "FRANCE" else []):
            t = re.sub(rf"(?<!\w)(?:{word.replace(r'\s', '[ \t\n\v\f\r]')})(?!\w)", full, t)
        return re.sub(r"\W+", " ", t).strip(" "), list(dict.fromkeys(re.findall(r"(?<!\w)\d{1,6}(?!\w)", text or "")))

    rows = [(str(k), "n", text, "France" if k % 2 else "US") for k, text in enumerate(texts)]
    found = N.normalize(spark.createDataFrame(rows, RECORD))
    for r in found.collect():
        assert (r.clean_address, r.extracted_numbers) == rules(r.business_address, r.country), r.business_address
    assert "street" not in found._jdf.queryExecution().executedPlan().toString()


def test_candidates_leave_no_other_table(spark, monkeypatch, tmp_path):
    """Of a search among long texts its result and the clean records stay, and vectors are written once."""
    written = []
    before = vectors.staged
    monkeypatch.setattr(vectors, "staged", lambda df, name="stage": written.append(name) or before(df, name))
    folder = Path(queries.staged.__globals__["shared_dir"](spark).removeprefix("file://"))
    had = set(folder.glob("kinmatch-*"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    queries.QUERIES["label_pairs"](spark, str(tmp_path)).count()
    queries.QUERIES["cascade_blend"](spark, str(tmp_path)).count()
    left = [p for p in folder.glob("kinmatch-*") if p not in had]
    assert len(left) == 3 and not any("pairs" in p.name for p in left)  # S1, targets, candidates
    assert written.count("vectors") == 2  # targets and queries


def test_jaro_of_long_texts(monkeypatch):
    """As letter by letter, and without going letter by letter where letters stand in reach."""
    rng = random.Random(3)
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    pairs = [(text(rng.randrange(1, 900), x), text(rng.randrange(1, 900), y)) for x in ("ab", "abcdefgh ", "aé日😀z") for y in ("ba", "abcdefgh ", "xyz") for _ in range(20)]
    pairs += [("z" + "a" * 300, "a" * 300 + "z"), ("a" * 100, "b" * 100), ("", "a" * 99), ("ab" * 200, "ab" * 200), ("b" * 90 + "a" * 200, "a" * 200 + "b" * 90)]
    want = [S.jaro_winkler(x, y) for x, y in pairs]
    assert S.jaro_winkler_of(*map(list, zip(*pairs, strict=True))).tolist() == want
    monkeypatch.setattr(S, "KEPT", 2)
    assert S.jaro_winkler_of(*map(list, zip(*pairs, strict=True))).tolist() == want
    monkeypatch.setattr(S, "jaro_winkler", None)
    a, b = text(3000, "abcdefgh "), text(2500, "abcdefgh ")
    assert 0.5 < S.similarities([a], [b], ["jaro_winkler"])["jaro_winkler"][0] < 1


def test_jaro_of_a_short_text_and_a_long_one(monkeypatch):
    """The long one's letters are placed once for all pairs, not anew for each that is with a short text."""
    rng = random.Random(4)
    text = lambda n: "".join(rng.choices("abcdé ", k=n))
    long_ = text(5000)
    pairs = [(text(n), long_) if n % 2 else (long_, text(n)) for n in range(1, 70)]
    want = [S.jaro_winkler(x, y) for x, y in pairs]
    monkeypatch.setattr(S, "jaro_winkler", None)
    made = []
    monkeypatch.setattr(S, "Spelt", lambda text, make=S.Spelt: made.append(len(text)) or make(text))
    assert S.jaro_winkler_of(*map(list, zip(*pairs, strict=True))).tolist() == want
    assert made.count(5000) == 1


def test_products_are_searched_for_nan_only_where_vectors_hold_any(monkeypatch):
    rng = np.random.default_rng(2)
    q, t = rng.normal(size=(600, 8)), rng.normal(size=(5000, 8))
    q, t = q / np.linalg.norm(q, axis=1)[:, None], t / np.linalg.norm(t, axis=1)[:, None]
    with monkeypatch.context() as m:
        m.setattr(np, "isnan", None)
        row, col, _ = retrieval.nearest(q, t, 5)
    best = np.argsort(-(q @ t.T), axis=1)[:, :5]
    found = set(zip(row.tolist(), col.tolist(), strict=True))
    assert all((k, c) in found for k in range(len(q)) for c in best[k].tolist()) and len(found) < 6 * len(q)
    t[7] = np.nan
    row, col, _ = retrieval.nearest(q, t, 5)
    assert sorted(row[col == 7].tolist()) == list(range(len(q)))
