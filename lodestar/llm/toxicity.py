"""Toxicity: cumulative-link ordinal regression of severity grades on the
words of a text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5)


@dataclass(frozen=True)
class SeverityModel:
    """P(grade >= k) = sigmoid(sum of the weights of the text's words -
    thresholds[k - 1]): one weight per word for all thresholds."""

    words: tuple[str, ...]
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]


def words_of(text: str | None) -> set[str]:
    """The text's sparse features: its words in lower case, and their first
    letters (``STEMS`` lengths, marked ``~``), which stand for the many
    endings that one stem takes."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words.union(*({w[:n] + "~" for w in words if len(w) >= n} for n in STEMS))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str,
                  max_train: int) -> DataFrame:
    """(id, y, words) of a bounded sample: up to ``max_train`` labelled ids,
    half of each class where there are enough, by a hash of the id.  The ids
    are bounded, so they may be broadcast to the documents.  An id that
    repeats counts once."""
    marks = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(id_col).agg((F.max(label_col) > 0).cast("int").alias("y")))
    picked = [marks.filter(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(max_train // 2) for y in (0, 1)]
    ids = picked[0].unionByName(picked[1]).select(F.col(id_col).cast("string").alias("id"), "y")
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(words_of(x.as_py())) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))], ["id", "y", "words"])

    found = rows.select("id", "y", "text").mapInArrow(split, "id string, y int, words array<string>")
    return materialize(found.groupBy("id").agg(F.max("y").alias("y"), F.min("words").alias("words")), "training")


def markers(rows: DataFrame, min_docs: int, min_z: float) -> DataFrame:
    """(word, z) of the words whose log odds between the classes are ``min_z``
    standard errors from zero, among those of ``min_docs`` rows or more.
    Counting is Spark's; only these words reach the driver."""
    size = rows.agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("all")).first()
    counts = rows.select("y", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("all")).filter(F.col("all") >= min_docs)
    a = F.col("toxic") + 0.5
    b = F.lit(size["toxic"] or 0) - F.col("toxic") + 0.5
    c = F.col("all") - F.col("toxic") + 0.5
    d = F.lit((size["all"] or 0) - (size["toxic"] or 0)) - (F.col("all") - F.col("toxic")) + 0.5
    z = F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    return counts.select("word", z.alias("z")).filter(F.abs("z") >= min_z)


def grades_of(y: np.ndarray, evidence: np.ndarray, grades: int) -> np.ndarray:
    """Severity grades.  The labels say toxic or not, so the order among
    toxic rows comes from evidence, the number of distinct words marked as
    toxic that a row holds, cut at equal shares."""
    grade = np.zeros(len(y), np.int64)
    toxic = np.flatnonzero(y == 1)
    cuts = np.quantile(evidence[toxic], np.arange(1, grades - 1) / (grades - 1)) if grades > 2 and len(toxic) else []
    grade[toxic] = 1 + sum((evidence[toxic] > c).astype(np.int64) for c in cuts)
    return grade


def fit_severity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", grades: int = 3, max_train: int = 6000, min_docs: int = 5,
                 min_z: float = 3.5, penalty: float = 0.5, rounds: int = 400) -> SeverityModel:
    """Fit on at most ``max_train`` labelled documents (a documented bound;
    scoring reads them all).  Class weights undo the sampling, so that the
    probabilities hold for the labelled rows.  Null labels and ids are left
    out; with no row of one class the model has no words, and every text gets
    grade 0."""
    rows = training_rows(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, max_train=max_train)
    base = labels.filter(F.col(label_col).isNotNull()).agg(F.avg((F.col(label_col) > 0).cast("double"))).first()[0]
    y = {r["id"]: r["y"] for r in rows.select("id", "y").collect()}
    if len(set(y.values())) < 2:
        return SeverityModel((), (), tuple(35.0 + k for k in range(grades - 1)))
    marked = markers(rows, min_docs, min_z)
    z = {r["word"]: r["z"] for r in marked.collect()}
    held = rows.select("id", F.explode("words").alias("word")).join(marked.select("word"), "word").groupBy("id").agg(
        F.collect_list("word").alias("words")).collect()  # at most max_train rows of marked words
    words = {r["id"]: set(r["words"]) for r in held}
    ids = sorted(y)
    return fit_rows([(y[i], words.get(i, set())) for i in ids], sorted(z), {w for w, v in z.items() if v > 0}, float(base),
                    grades=grades, penalty=penalty, rounds=rounds)


def fit_rows(rows: list[tuple[int, set[str]]], words: list[str], strong: set[str], base: float, *, grades: int,
             penalty: float, rounds: int) -> SeverityModel:
    """Penalized likelihood of the cumulative-link model by Adam steps over
    the sparse cells of (label, marked words) rows; ``base`` is the share of
    toxic rows at large."""
    y = np.array([r[0] for r in rows], np.int64)
    grade = grades_of(y, np.array([len(ws & strong) for _, ws in rows], float), grades)
    place = {w: i for i, w in enumerate(words)}
    cells = [(r, place[w]) for r, (_, ws) in enumerate(rows) for w in sorted(ws)]
    row, col = (np.array([c[i] for c in cells], np.int64) for i in (0, 1))
    share = np.where(y == 1, base / y.mean(), (1 - base) / (1 - y.mean()))
    share = share / share.sum()

    k = grades - 1
    weights, first, gaps = np.zeros(len(words)), 2.0, np.zeros(k - 1)
    state = [np.zeros(len(words) + k), np.zeros(len(words) + k)]
    for t in range(1, rounds + 1):
        theta = np.concatenate([[first], first + np.cumsum(np.exp(gaps))])
        eta = np.bincount(row, weights[col], len(y))
        above = np.concatenate([np.ones((len(y), 1)), _sigmoid(eta[:, None] - theta), np.zeros((len(y), 1))], 1)
        at = np.arange(len(y))
        p = np.maximum(above[at, grade] - above[at, grade + 1], 1e-12)
        slope = above * (1 - above)  # zero at both ends
        d_eta = -(slope[at, grade] - slope[at, grade + 1]) / p * share
        d_theta = np.zeros(k)
        np.add.at(d_theta, grade[grade > 0] - 1, (slope[at, grade] / p * share)[grade > 0])
        np.add.at(d_theta, grade[grade < k], -(slope[at, grade + 1] / p * share)[grade < k])
        tail = np.cumsum(d_theta[::-1])[::-1]  # a gap moves every threshold above it
        grad = np.concatenate([np.bincount(col, d_eta[row], len(words)) + penalty * weights / len(y),
                               [tail[0]], tail[1:] * np.exp(gaps)])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.999 * state[1] + 0.001 * grad * grad
        move = 0.1 * (state[0] / (1 - 0.9 ** t)) / (np.sqrt(state[1] / (1 - 0.999 ** t)) + 1e-10)
        weights = weights - move[:len(words)]
        first -= move[len(words)]
        gaps = np.clip(gaps - move[len(words) + 1:], -6, 6)
    theta = np.concatenate([[first], first + np.cumsum(np.exp(gaps))])
    return SeverityModel(tuple(words), tuple(weights.tolist()), tuple(theta.tolist()))


def score_severity(docs: DataFrame, model: SeverityModel, *, text_col: str = "text") -> DataFrame:
    """Adds ``severity`` (expected grade), ``severity_grade`` (most probable
    one) and ``p_toxic`` (probability of grade 1 or more) to every row; input
    columns of these names are replaced.  Null and empty texts have no words
    and get what the thresholds alone say."""
    own = ["severity", "severity_grade", "p_toxic"]
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in own])
    schema = T.StructType([*base.schema.fields, T.StructField("severity", T.DoubleType()),
                           T.StructField("severity_grade", T.IntegerType()), T.StructField("p_toxic", T.DoubleType())])
    at = base.columns.index(text_col)
    weight = dict(zip(model.words, model.weights))
    theta = np.array(model.thresholds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weight.keys()
        for batch in batches:
            eta = np.array([sum(weight[w] for w in sorted(words_of(x.as_py()) & known)) for x in batch.column(at)],
                           np.float64)
            above = _sigmoid(eta.reshape(-1, 1) - theta)
            mass = np.concatenate([np.ones((len(eta), 1)), above], 1) - np.concatenate(
                [above, np.zeros((len(eta), 1))], 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(above.sum(1), pa.float64()), pa.array(mass.argmax(1), pa.int32()),
                 pa.array(above[:, 0], pa.float64())], names=schema.names)

    return base.mapInArrow(run, schema)
