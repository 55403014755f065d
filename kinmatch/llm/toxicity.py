"""Toxicity by a chain of classifiers over hashed words and word beginnings.

Categories are learnt in order; each model also gets the probabilities of the categories before it, which for the
training rows come from models that had not seen them (out of fold). labels have two: toxic itself, and quality,
whose opposite stands first as toxic texts are among the poor ones. Where labels have more, CATEGORIES takes them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .store import materialize, table
from .text import Words, mix, ragged, runs, utf8
from .suffix_dedup import prefix_hash, range_hash

CATEGORIES = ("low_quality", "toxic")
#: Labelled documents that models are fitted on at most, drawn by hash; scoring covers every document.
SAMPLE = 4000
#: Bytes of labelled text at most that reach the driver; past that, fewer documents, and none longer than that alone.
SAMPLE_BYTES = 10 << 20
FOLDS = 4
FEATURES = 4096
PREFIXES = (3, 4, 5, 6, 8)
LEAST_DOCS = 4
SEED = 20240607
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature hash) of each word and each of its beginnings, and the number of words of each text. ASCII
    other than letters and digits separates words."""
    data = _LETTERS[data]
    words = Words(data, at)
    sums = prefix_hash(words.low)
    n = np.diff(words.first)
    text = np.repeat(np.arange(len(n)), n)
    rows, keys = [text], [mix(range_hash(sums, words.starts, words.ends))]
    length = words.ends - words.starts
    for k in PREFIXES:
        long_ = length > k
        rows.append(text[long_])
        keys.append(mix(range_hash(sums, words.starts[long_], words.starts[long_] + k) + np.uint64(k)))
    return np.concatenate(rows), np.concatenate(keys).view(np.int64), n


@dataclass
class Sparse:
    """Rows of (feature, value) pairs in coordinate form."""

    row: np.ndarray
    col: np.ndarray
    val: np.ndarray
    n: int


def distinct(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (text, key) once, with its count."""
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(rows)), bool), (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])]))
    return rows[new], keys[new], np.diff(np.append(new, len(rows)))


def counted(rows: np.ndarray, keys: np.ndarray, counts: np.ndarray, vocabulary: np.ndarray, n_words: np.ndarray) -> Sparse:
    """Values of the vocabulary's (sorted) keys: log of one plus the count, and of one plus the count in 50 words."""
    v = len(vocabulary)
    if not v or not len(keys):
        return Sparse(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), len(n_words))
    k = np.minimum(np.searchsorted(vocabulary, keys), v - 1)
    hit = vocabulary[k] == keys
    code, back = np.unique(rows[hit] * v + k[hit], return_inverse=True)
    count = np.bincount(back, counts[hit], len(code))
    row, col = code // v, code % v
    rate = 50 * count / np.maximum(n_words[row], 20)
    return Sparse(np.concatenate([row, row]), np.concatenate([col, col + v]), np.concatenate([np.log1p(count) * 0.3, np.log1p(rate)]), len(n_words))


@dataclass
class Linear:
    vocabulary: np.ndarray
    weight: np.ndarray
    extra: np.ndarray
    bias: float

    def logits(self, x: Sparse, before: np.ndarray) -> np.ndarray:
        z = np.full(x.n, self.bias)
        if len(x.row):
            z += np.bincount(x.row, self.weight[x.col] * x.val, x.n)
        return z + before @ self.extra if before.shape[1] else z


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p)) / 4


def select(rows: np.ndarray, keys: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The FEATURES keys whose presence tells most about y, by the z score of their log odds; sorted. A text
    has each of its keys once."""
    key, back = np.unique(keys, return_inverse=True)
    docs = np.bincount(back, minlength=len(key))
    a = np.bincount(back, y[rows], len(key))
    b = docs - a
    p, q = y.sum(), len(y) - y.sum()
    odds = np.log((a + 0.5) * (q - b + 0.5) / ((b + 0.5) * (p - a + 0.5)))
    z = np.abs(odds) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5) + 1 / (p - a + 0.5) + 1 / (q - b + 0.5))
    z[docs < LEAST_DOCS] = -1
    best = np.argsort(-z, kind="stable")[:FEATURES]
    return np.sort(key[best[z[best] > 1.5]])


def fit(rows: np.ndarray, keys: np.ndarray, counts: np.ndarray, n_words: np.ndarray, y: np.ndarray, before: np.ndarray, penalty: float = 0.02, steps: int = 150) -> Linear:
    """Logistic regression by Adam over all rows; positives and negatives weigh as they come."""
    if y.min(initial=1) == y.max(initial=0):  # one class or no rows
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(before.shape[1]), float(np.log(rate / (1 - rate))))
    vocabulary = select(rows, keys, y)
    x = counted(rows, keys, counts, vocabulary, n_words)
    m = 2 * len(vocabulary)
    theta = np.zeros(m + before.shape[1] + 1)
    theta[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    rate = 0.05
    for step in range(1, steps + 1):
        model = Linear(vocabulary, theta[:m], theta[m:-1], theta[-1])
        error = sigmoid(model.logits(x, before)) - y
        gradient = np.concatenate([np.bincount(x.col, error[x.row] * x.val, m) if len(x.col) else np.zeros(m), before.T @ error, [error.sum()]])
        gradient[:m] += penalty * theta[:m]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Linear(vocabulary, theta[:m], theta[m:-1], float(theta[-1]))


@dataclass
class Chain:
    models: list[Linear]
    threshold: float
    held_out: np.ndarray

    def probabilities(self, rows: np.ndarray, keys: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        counts = np.ones(len(rows))
        before = np.zeros((len(n_words), 0))
        out = []
        for model in self.models:
            p = sigmoid(model.logits(counted(rows, keys, counts, model.vocabulary, n_words), before))
            before = np.column_stack([before, logit(p)])
            out.append(p)
        return np.column_stack(out)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Between the scores around the first cut of all but the best F1 on out-of-fold probabilities, so that clean
    texts have the benefit of the doubt; 0.5 if there are no positives."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal scores can't be parted
    f1 = np.where(last, f1, -1)
    k = int(np.argmax(f1 >= f1.max() - 0.004))
    low = p[order][k + 1] if k + 1 < len(y) else 0.0
    return float(np.clip((p[order][k] + low) / 2, 0.05, 0.95))


def train(texts: list[bytes], labels: np.ndarray, folds: int = FOLDS) -> Chain:
    """labels: a column of 0 or 1 for each category. Equal texts stay in one fold."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    found = []
    for i, j in runs(at):
        rows, keys, n_words = features(data[at[i] : at[j]], at[i : j + 1] - at[i])
        rows, keys, counts = distinct(rows, keys)
        found.append((rows + i, keys, counts, n_words))
    rows, keys, counts, n_words = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4
    groups = np.unique([hash_bytes(t) for t in texts], return_inverse=True)[1] if texts else np.zeros(0, np.int64)
    fold = (groups * 2654435761 % (1 << 32)) % folds
    before = np.zeros((len(texts), 0))
    models, unseen = [], np.zeros((len(texts), 0))
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        p = np.zeros(len(texts))
        for f in range(folds):
            test = fold == f
            kept = ~test
            number = np.cumsum(kept) - 1
            mine = kept[rows]
            model = fit(number[rows[mine]], keys[mine], counts[mine], n_words[kept], y[kept], before[kept])
            other = np.cumsum(test) - 1
            theirs = test[rows]
            p[test] = sigmoid(model.logits(counted(other[rows[theirs]], keys[theirs], counts[theirs], model.vocabulary, n_words[test]), before[test]))
        models.append(fit(rows, keys, counts, n_words, y, before))
        before = np.column_stack([before, logit(p)])
        unseen = np.column_stack([unseen, p])
    return Chain(models, best_threshold(unseen[:, -1], labels[:, -1]) if len(texts) else 0.5, unseen)


def hash_bytes(text: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text, 42)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> tuple[list[bytes], np.ndarray]:
    """Up to `most` labelled documents of up to `most_bytes` in all, by hash of doc_id. Rows with a null id or label
    are left out; of rows with one doc_id the text that is first by hash counts, and the greatest of each label."""
    kinds = labels.filter("doc_id is not null and quality is not null and toxic is not null").select("doc_id", (1 - F.col("quality")).cast("int").alias("low_quality"), F.col("toxic").cast("int").alias("toxic"))
    kinds = kinds.groupBy("doc_id").agg(F.max("low_quality").alias("low_quality"), F.max("toxic").alias("toxic"))
    drawn = kinds.withColumn("draw", F.xxhash64(F.lit(SEED), "doc_id")).orderBy("draw", "doc_id").limit(most)
    text = docs.filter("doc_id is not null").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(F.octet_length("text") <= most_bytes)
    rows = text.join(F.broadcast(drawn), "doc_id").groupBy("draw", "doc_id", "low_quality", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    rows = materialize(rows.select("draw", "doc_id", "low_quality", "toxic", "first.text"), "labelled")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:  # fewer documents, by the same order
        rows = rows.filter(F.pmod(F.col("draw"), F.lit(1000)) < int(1000 * most_bytes / size))
    found = rows.toPandas().sort_values(["draw", "doc_id"])
    return [t.encode() for t in found["text"]], found[["low_quality", "toxic"]].to_numpy()


def _probabilities(docs: DataFrame, chain: Chain, make: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], pa.RecordBatch], schema: StructType) -> DataFrame:
    """make()'s batches from those of docs, their rows' probabilities of each category, and which are flagged: texts
    with words whose last probability reaches the threshold. Whole texts, null as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    k = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            data, at = utf8(pc.cast(batch.column(k), pa.string()))
            out, words = [np.zeros((0, len(CATEGORIES)))], [np.zeros(0, np.int64)]
            for i, j in runs(at, 1 << 18):
                found = features(data[at[i] : at[j]], at[i : j + 1] - at[i])
                out.append(chain.probabilities(*found))
                words.append(found[2])
            p = np.concatenate(out)
            yield make(batch, p, (p[:, -1] >= chain.threshold) & (np.concatenate(words) > 0))

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """documents with p_low_quality, p_toxic and is_toxic, which replace columns of these names."""
    more = [StructField("p_low_quality", DoubleType()), StructField("p_toxic", DoubleType()), StructField("is_toxic", BooleanType())]
    names = [x.name for x in more]
    docs = docs.select(*[c for c in docs.columns if c.lower() not in names])

    def add(batch: pa.RecordBatch, p: np.ndarray, flagged: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(flagged)], names=[*batch.schema.names, *names])

    return _probabilities(docs, chain, add, StructType([*docs.schema.fields, *more]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """score() by a chain fitted on a bounded sample of labelled documents.

    Without labels, or with one class only, every document gets the class's rate and none is flagged unless most
    are. Rows with null or repeated doc_id are scored like any other, and texts of any length whole; texts over
    SAMPLE_BYTES aren't learnt from. A text without words isn't flagged. An empty table gives an empty one.
    """
    return score(docs, train(*labelled_sample(docs, labels)))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """documents without those that classify() flags; all columns as they are, whatever they are called."""
    chain = train(*labelled_sample(docs, labels))
    return _probabilities(docs, chain, lambda batch, p, flagged: batch.filter(pa.array(~flagged)), docs.schema)


def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, table(spark, sf_dir, "labels")).drop("text")
