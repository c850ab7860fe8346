"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the different character n-grams (3 to 6) of the lower-case text, hashed to `2**BITS`
buckets. Each gets its naive Bayes log-count ratio r; a text's vector is r at the n-grams it has and
0 elsewhere, and logistic regression learns one weight per feature on these vectors. A feature's
final weight is the product of the two, so a text is scored by one sum over its different n-grams.

The model is fitted on a bounded sample: at most `sample_rows` learnable labelled rows of each label,
those with the least hash of their ids. Spark cuts the n-grams and counts them; the `n_features` most
telling ones and the sample's rows restricted to them come to the driver, where the fit runs.
Scoring is one map over all whole texts.

Defined results: null and empty texts are scored by the intercept. Without labelled rows of both
labels every score is the share of toxic rows in the sample (0 without rows). A document with
conflicting labels counts as toxic; null labels, and rows without id or text, are not learned from.
Repeated rows have one result each, ties at 0.5 are predicted toxic, and of the documents only id and
text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm.common import free_name, learnable, sliced, stored, table, texts

SAMPLE_ROWS = 2500
N_FEATURES = 1 << 13
SIZES = (3, 4, 5, 6)
BITS = 20
LEAST_DOCS = 4
SMOOTHING = 1.0
PENALTY = 100.0
STEPS = 150
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
MIX = np.uint64(0x9E3779B97F4A7C15)


def buckets(text: str) -> np.ndarray:
    """The bucket of every character n-gram of a text, repeats included."""
    units = f" {text.lower()} ".encode("utf-32-le", "surrogatepass")
    chars = np.frombuffer(units, np.uint32).astype(np.uint64)
    hashes, out = chars, []
    for n in range(2, max(SIZES) + 1):
        if len(chars) < n:
            break
        hashes = (hashes[:-1] * np.uint64(0x100000001B3)) ^ chars[n - 1 :]
        if n in SIZES:
            mixed = (hashes * MIX + np.uint64(n)) * MIX
            out.append((mixed >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def scorer(self):
        """A function from texts to scores; its tables are made once per task."""
        weight, known = np.zeros(1 << BITS), np.zeros(1 << BITS, bool)
        weight[self.features], known[self.features] = self.weights, True

        def score(text: str) -> float:
            found = buckets(text)
            z = weight[np.unique(found[known[found]])].sum() + self.intercept
            with np.errstate(over="ignore"):
                return float(1 / (1 + np.exp(-z)))

        return score


def sample_of(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(doc_id, text, toxic) of the bounded sample."""
    marks = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter("doc_id is not null and toxic in (0, 1)").filter(learnable(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_hash = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = marks.withColumn("nth", F.row_number().over(by_hash)).filter(F.col("nth") <= sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most 2 * sample_rows ids
    chosen = rows.join(F.broadcast(ids.drop("nth")), "doc_id")
    return chosen.filter(F.col("text").isNotNull()).dropDuplicates(["doc_id"])


def feature_batch(toxic: pa.Array, features: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.cumsum([0, *map(len, features)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *features])
    return pa.RecordBatch.from_pydict(
        {"toxic": toxic, "features": pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))}
    )


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, features) from (toxic, text)."""
    for part in (x for batch in batches for x in sliced(batch)):
        found = [np.unique(buckets(t)) for t in part.column("text").to_pylist()]
        yield feature_batch(part.column("toxic"), found)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    n_features: int = N_FEATURES,
) -> Model:
    sample = sample_of(docs, labels, sample_rows).select("toxic", "text")
    cuts = stored(sample.mapInArrow(cut, "toxic int, features array<int>"))
    toxic = F.sum("toxic").alias("n_toxic")
    size = cuts.agg(F.count("*").alias("n"), toxic).first()
    n, n_toxic = size.n, size.n_toxic or 0
    if n_toxic == 0 or n_toxic == n:
        share = n_toxic / n if n else 0.0
        z = np.inf if share == 1 else -np.inf if share == 0 else np.log(share / (1 - share))
        return Model(np.zeros(0, np.int64), np.zeros(0), float(z))

    counts = cuts.select("toxic", F.explode("features").alias("feature")).groupBy("feature")
    counts = counts.agg(F.count("*").alias("n_docs"), toxic).filter(F.col("n_docs") >= LEAST_DOCS)

    def rate(found, all_docs):
        return F.log((found + SMOOTHING) / (all_docs + 2 * SMOOTHING))

    clean = F.col("n_docs") - F.col("n_toxic")
    ratio = rate(F.col("n_toxic"), n_toxic) - rate(clean, n - n_toxic)
    telling = F.abs("ratio") * F.sqrt("n_docs")
    best = counts.withColumn("ratio", ratio).orderBy(telling.desc(), "feature").limit(n_features)
    best = best.select("feature", "ratio").toPandas()
    features, ratios = best["feature"].to_numpy(np.int64), best["ratio"].to_numpy()

    column = np.full(1 << BITS, -1, np.int32)
    column[features] = np.arange(len(features))

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for batch in batches for x in sliced(batch)):
            own = [column[x.values.to_numpy()] for x in part.column("features")]
            yield feature_batch(part.column("toxic"), [x[x >= 0] for x in own])

    small = cuts.mapInArrow(restrict, "toxic int, features array<int>").toPandas()
    weights, intercept = logistic(
        [np.asarray(x, np.int64) for x in small["features"]], small["toxic"].to_numpy(), ratios
    )
    return Model(features, weights * ratios, intercept)


def logistic(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a penalised logistic regression; both labels weigh the same."""
    at = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    col = np.concatenate(rows) if len(at) else np.zeros(0, np.int64)
    value = ratios[col]
    balance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w = np.zeros(len(ratios) + 1)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.bincount(at, value * w[col], len(y)) + w[-1]
        off = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        slope = np.bincount(col, value * off[at], len(ratios)) + PENALTY * w[:-1] / len(y)
        slope = np.append(slope, off.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        w -= 0.03 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return w[:-1], float(w[-1])


def scored(texts: pa.Array, score: Callable[[str], float]) -> np.ndarray:
    """The score of each text; a null counts as empty."""
    return np.array([score(t or "") for part in sliced(texts) for t in part.to_pylist()], float)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of `docs` (doc_id, text) the columns of SCHEMA."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in batches:
            found = scored(batch.column("text"), score)
            columns = {name: batch.column(name) for name in ("doc_id", "held_out")}
            columns |= {"score": pa.array(found), "predicted": pa.array(found >= 0.5).cast(pa.int32())}
            yield pa.RecordBatch.from_pydict(columns)

    held_out = ~F.coalesce(learnable(F.col("doc_id")), F.lit(True))
    return texts(docs).select("doc_id", held_out.alias("held_out"), "text").mapInArrow(predict, SCHEMA)


def clean_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs`, all columns, without the rows predicted toxic; a map, no join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def is_clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = shared.value.scorer()
        for batch in batches:
            yield pa.array(scored(batch, score) < 0.5)

    mark = free_name(docs.columns, "is_clean")
    return docs.withColumn(mark, is_clean(F.col(f"`{text_col}`"))).filter(F.col(mark)).drop(mark)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(docs, learn(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLE: dict[str, str] = {}
