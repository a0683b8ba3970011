"""Operator 7, toxicity: cumulative-link ordinal regression on sparse text features.

``P(grade <= k) = sigmoid(theta_k - w.x)``: one weight vector shared by all thresholds,
thresholds kept in order.  ``x`` marks which of a bounded list of words a document holds.
The output is the probability of each grade, the expected severity (sum over k of
``P(grade >= k)``) and the verdict ``P(grade >= 1) >= 0.5``.

Fitting takes a bounded sample: at most about ``MAX_LABELLED`` labelled rows, dealt by a hash of the id.
Spark counts the words per class; the ``MAX_TERMS`` words that separate the classes most
(by the likelihood ratio G², at
least twice the logarithm of the number of words, in ``MIN_ROWS`` rows or more) are the features.  The labels give toxic 0 or 1 only; to fit
three ordered grades, toxic rows with more separating words than the median are grade 2.

Prediction reads whole texts.  Defined results: a null or empty text has no features and
gets the base rate's prediction; without labels the model rejects nothing; rows of the
label table with a null label or id teach nothing, repeated ones count once with the highest label; every
document row gives one row; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, give_back, staged

MAX_LABELLED = 20_000
MAX_TERMS = 2_000
MIN_ROWS = 5
WORD = re.compile(r"\w+")


@dataclass
class OrdinalModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=lambda: [20.0])  # nothing learned: grade 0

    def at_least(self, text: str | None) -> np.ndarray:
        """``P(grade >= k)`` for k from 1."""
        eta = sum(self.weights[w] for w in self.weights.keys() & set(WORD.findall(text.lower()))) if text else 0.0
        return 1.0 / (1.0 + np.exp(np.clip(np.array(self.thresholds) - eta, -500, 500)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_terms: int, steps: int = 400, l2: float = 1e-3):
    """Weights and ordered thresholds by gradient descent (Adam) on the mean log-likelihood."""
    k = int(grades.max())
    n = len(rows)
    idx = np.concatenate(rows).astype(np.int64) if n else np.zeros(0, np.int64)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    share = [np.clip((grades < j).mean(), 1e-4, 1 - 1e-4) for j in range(1, k + 1)]
    theta0 = np.log(np.array(share) / (1 - np.array(share)))
    par = np.concatenate([np.zeros(n_terms), theta0[:1], np.log(np.maximum(np.diff(theta0), 1e-3))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    sig = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
    for t in range(1, steps + 1):
        w, gaps = par[:n_terms], np.exp(par[n_terms + 1:])
        theta = par[n_terms] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(row, w[idx], n)
        cdf = np.concatenate([np.zeros((n, 1)), sig(theta[None, :] - eta[:, None]), np.ones((n, 1))], axis=1)
        hi, lo = cdf[np.arange(n), grades + 1], cdf[np.arange(n), grades]
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p  # of log p by its upper and lower bound
        g_theta = np.bincount(np.minimum(grades, k - 1), d_hi * (grades < k), k) - \
            np.bincount(np.maximum(grades - 1, 0), d_lo * (grades > 0), k)
        g_w = -np.bincount(idx, (d_hi - d_lo)[row], n_terms) / n - l2 * w
        tail = np.cumsum(g_theta[::-1])[::-1] / n
        g = np.concatenate([g_w, tail[:1], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par + 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return par[:n_terms], par[n_terms] + np.concatenate([[0.0], np.cumsum(np.exp(par[n_terms + 1:]))])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS) -> OrdinalModel:
    spark = docs.sparkSession
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("i")).agg(
        F.max((F.col(label_col) > 0).cast("int")).alias("y"))
    n = known.count()
    share = min(1.0, max_labelled / max(n, 1))
    some = known.where(F.pmod(F.xxhash64(F.lit("toxicity"), F.col("i")), F.lit(1 << 20)) < share * (1 << 20))
    one = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(some), "i")

    def words(batches):
        for b in batches:
            yield {"y": b.column(0), "words": [sorted(set(WORD.findall((t or "").lower()))) for t in b.column(1).to_pylist()]}

    rows = staged(arrow_map(one.select("y", "t"), words, "y int, words array<string>"), spark)
    totals = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return OrdinalModel()
    counts = staged(rows.select("y", F.explode("words").alias("w")).groupBy("w")
                    .agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good")), spark)
    n_words, share_bad = counts.count(), bad / (bad + good)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    n = F.col("bad") + F.col("good")
    g2 = 2 * (part(F.col("bad"), n * share_bad) + part(F.col("good"), n * (1 - share_bad)))
    terms = (counts.where(n >= MIN_ROWS).withColumn("g2", g2).withColumn("for", F.col("bad") > n * share_bad)
             .where(F.col("g2") >= 2 * float(np.log(max(n_words, 2)))).orderBy(F.desc("g2"), "w").limit(max_terms).collect())
    if not terms:
        return OrdinalModel()
    names = [r["w"] for r in terms]
    telling = {r["w"] for r in terms if r["for"]}
    place = spark.sparkContext.broadcast({w: i for i, w in enumerate(names)})

    def features(batches):
        for b in batches:
            at = place.value
            yield {"y": b.column(0), "x": [[at[w] for w in ws if w in at] for ws in b.column(1).to_pylist()]}

    got = arrow_map(rows, features, "y int, x array<int>").collect()  # bounded: max_labelled rows of max_terms terms
    got.sort(key=lambda r: (r["y"], r["x"]))
    flags = np.array([w in telling for w in names])
    x = [np.array(r["x"], np.int64) for r in got]
    y = np.array([r["y"] for r in got])
    hits = np.array([flags[r].sum() for r in x])
    middle = np.median(hits[y == 1])
    grades = np.where((y == 1) & (hits > middle), 2, y)
    if not (grades == 2).any():
        grades = y
    w, theta = fit_ordinal(x, grades, len(names))
    return OrdinalModel(dict(zip(names, map(float, w))), [float(t) for t in theta])


def predict_toxicity(df: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``grade`` (the likeliest), ``expected_severity``,
    ``p_toxic`` (= P(grade >= 1)) and ``toxic`` (p_toxic >= 0.5)."""
    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, grade int, expected_severity double, p_toxic double, toxic boolean"

    def run(batches):
        for b in batches:
            p = np.array([model.at_least(t) for t in b.column(1).to_pylist()]).reshape(b.num_rows, len(model.thresholds))
            edges = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1)
            yield {id_col: b.column(0), "grade": np.argmax(edges[:, :-1] - edges[:, 1:], axis=1).astype(np.int32),
                   "expected_severity": p.sum(axis=1), "p_toxic": p[:, 0], "toxic": p[:, 0] >= 0.5}

    return arrow_map(df.select(id_col, text_col), run, schema)


def drop_toxic(df: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """All columns of ``df``, without the rows the model rejects."""
    i = df.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array([model.at_least(t)[0] < 0.5 for t in b.column(i).to_pylist()], pa.bool_()))
        give_back()

    return df.mapInArrow(run, df.schema)
