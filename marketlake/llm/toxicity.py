"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

``labels`` says toxic or not. Toxic training documents get a severity grade
from how much of their text is toxic wording: features with a clear excess
among toxic documents are the wording, and one, two or three, and more
occurrences are grades 1, 2 and 3. The model is
P(grade >= k) = sigmoid(w . x - cut_k) with one weight vector for all ordered
cuts; its expected severity is the sum of these over k.

Features are words and their first four to seven letters (value: log(1 +
occurrences)), chosen by the signed root of their log-likelihood ratio, which
holds for small classes too. Weights come from damped gradient steps on a
bounded sample.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ddl, extended, in_sample, stored

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the training rows of a class, ``candidates`` the features that are counted in both
    classes (the most frequent of those in ``min_documents`` toxic rows, or an eighth of them, two at least, where
    that is less), ``features`` those that get a weight."""

    per_class: int = 6000
    candidates: int = 1 << 16
    features: int = 4096
    min_documents: int = 8
    min_z: float = 4.0
    grade_cuts: tuple = (1, 2, 4)
    steps: int = 400
    ridge: float = 1e-4


@dataclass
class Model:
    weights: dict[str, float]
    cuts: np.ndarray


def _sample(docs: DataFrame, labels: DataFrame, s: Settings) -> tuple[DataFrame, dict]:
    """Labelled texts (t, toxic), at most about ``per_class`` of a class, chosen by hash of the id, and the classes' sizes."""
    flag = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic") > 0).alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in flag.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic"), min(1.0, s.per_class / max(1, sizes.get(True, 0)))).otherwise(min(1.0, s.per_class / max(1, sizes.get(False, 0))))
    picked = stored(flag.filter(in_sample(F.col("id"), share)), "picked")  # about 2 per_class rows: bounded, so broadcast
    texts = docs.filter("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("t"))
    return stored(texts.join(F.broadcast(picked), "id").select("t", "toxic"), "labelled"), sizes


def parts(text: str) -> Counter:
    """Occurrences of the words of a text and of their first letters (``four~`` to ``seven-~``)."""
    n = Counter(WORD.findall(text.lower()))
    for w, k in list(n.items()):
        for size in range(4, min(8, len(w))):
            n[w[:size] + "~"] += k
    return n


def _counted(rows: DataFrame, only: set | None = None) -> DataFrame:
    """(part, n): documents that hold each feature, of those in ``only``; the empty part counts documents."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()
        for b in batches:
            for t in b["t"]:
                found = parts(t).keys()
                n.update(found if only is None else found & only)
                n[""] += 1
        yield pd.DataFrame({"part": pd.Series(list(n.keys()), dtype=object), "n": list(n.values())})

    return rows.select("t").mapInPandas(run, "part string, n long").groupBy("part").agg(F.sum("n").alias("n"))


def _wording(sample: DataFrame, s: Settings) -> pd.DataFrame:
    """(word, z) of the features; documents are counted in Spark, candidates first in the toxic class alone."""
    least = max(2, min(s.min_documents, sample.filter("toxic").count() // 8))
    in_toxic = _counted(sample.filter("toxic")).filter(F.col("n") >= F.when(F.col("part") == "", 0).otherwise(least))
    bad = in_toxic.orderBy(F.col("n").desc(), "part").limit(s.candidates).toPandas()
    good = _counted(sample.filter("NOT toxic"), set(bad["part"])).toPandas()
    both = bad.merge(good, on="part", how="left", suffixes=("_bad", "_good")).fillna({"n_good": 0})
    total = both[both["part"] == ""]
    if not len(total) or not total["n_good"].iloc[0]:
        return pd.DataFrame({"word": [], "z": []})
    both = both[both["part"] != ""]
    z = evidence(both["n_bad"].to_numpy(float), both["n_good"].to_numpy(float), float(total["n_bad"].iloc[0]), float(total["n_good"].iloc[0]))
    out = pd.DataFrame({"word": both["part"], "z": z})
    out = out[out["z"].abs() >= s.min_z]
    return out.iloc[np.lexsort((out["word"], -out["z"].abs()))][:s.features].reset_index(drop=True)


def evidence(bad: np.ndarray, good: np.ndarray, n_bad: float, n_good: float) -> np.ndarray:
    """Signed root of the log-likelihood ratio that a feature's share differs between ``n_bad`` and ``n_good`` documents."""
    both = (bad + good) / (n_bad + n_good)
    part = [np.where(k > 0, k * np.log(np.where(k > 0, k, 1) / np.maximum(n * q, 1e-300)), 0.0)
            for k, n, q in ((bad, n_bad, both), (good, n_good, both), (n_bad - bad, n_bad, 1 - both), (n_good - good, n_good, 1 - both))]
    return np.sign(bad / n_bad - good / n_good) * np.sqrt(np.maximum(2 * sum(part), 0.0))


def _features(wording: pd.DataFrame):
    index = {w: i for i, w in enumerate(wording["word"])}
    toxic_word = (wording["z"] > 0).to_numpy()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [{index[w]: k for w, k in parts(t).items() if w in index} for t in b["t"]]
            yield pd.DataFrame({"toxic": b["toxic"], "at": [list(c) for c in found], "n": [list(c.values()) for c in found],
                                "hits": [sum(k for i, k in c.items() if toxic_word[i]) for c in found]})
    return run


def fit_ordinal(x_row: np.ndarray, x_col: np.ndarray, x_val: np.ndarray, grade: np.ndarray, weight: np.ndarray,
                features: int, cuts: int, steps: int, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered cuts of the cumulative-link model, by Adam on the weighted log-likelihood of P(grade >= k)."""
    w = np.zeros(features)
    first, gaps = 1.0, np.zeros(max(cuts - 1, 0))   # cuts are first, first + exp(gap), ...
    target = (grade[:, None] >= np.arange(1, cuts + 1)).astype(float)
    weight = weight / weight.sum()
    size = features + 1 + len(gaps)
    m, v = np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        theta = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        score = np.bincount(x_row, x_val * w[x_col], len(grade))
        p = 1 / (1 + np.exp(np.clip(theta - score[:, None], -40, 40)))
        err = (p - target) * weight[:, None]
        g_w = np.bincount(x_col, x_val * err.sum(axis=1)[x_row], features) + ridge * w
        g_theta = -err.sum(axis=0)
        g = np.concatenate((g_w, [g_theta.sum()], np.exp(gaps) * g_theta[::-1].cumsum()[::-1][1:]))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, first, gaps = w - step[:features], first - step[features], gaps - step[features + 1:]
    return w, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on the labelled documents. Without both classes, every text gets severity 0."""
    s = settings
    sample, sizes = _sample(docs, labels, s)
    wording = _wording(sample, s)
    cuts = len(s.grade_cuts)
    if not len(wording):
        return Model({}, np.full(cuts, 40.0))
    rows = sample.mapInPandas(_features(wording), "toxic boolean, at array<int>, n array<int>, hits int").toPandas()
    hits, toxic = rows["hits"].to_numpy(), rows["toxic"].to_numpy(bool)
    grade = np.where(toxic, np.maximum(1, np.searchsorted(np.array(s.grade_cuts), hits, side="right")), 0)
    lens = rows["at"].map(len).to_numpy()
    x_row = np.repeat(np.arange(len(rows)), lens)
    flat = lambda c, kind: np.concatenate([np.zeros(0, kind), *(np.asarray(a, kind) for a in rows[c])])
    seen = np.array([max(1, (toxic == c).sum()) for c in (False, True)])
    weight = np.where(toxic, sizes.get(True, 0) / seen[1], sizes.get(False, 0) / seen[0])
    w, theta = fit_ordinal(x_row, flat("at", np.int64), np.log1p(flat("n", float)), grade, weight, len(wording), cuts, s.steps, s.ridge)
    return Model(dict(zip(wording["word"], w.tolist())), theta)


def grade(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, severity, grade, toxic, fitted) per row: expected severity, most probable grade, whether a grade above 0 is more likely
    than not, and whether a model could be fitted (false: the labels told no wording apart, and severity 0 says nothing).

    Null and empty texts have no features, so the severity of a text without
    any known wording. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.cuts))   # at most Settings.features weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cuts = shared.value
        for b in batches:
            score = []
            for t in (x.as_py() or "" for x in b.column("t")):
                score.append(sum(weights[w] * math.log1p(k) for w, k in parts(t).items() if w in weights))
            p = 1 / (1 + np.exp(np.clip(cuts - np.array(score, float).reshape(-1, 1), -40, 40)))
            edge = np.hstack([np.ones((len(p), 1)), p, np.zeros((len(p), 1))])
            yield extended(b, ("t",), severity=pa.array(p.sum(axis=1)), grade=pa.array((edge[:, :-1] - edge[:, 1:]).argmax(axis=1).astype(np.int32)), toxic=pa.array(p[:, 0] >= 0.5),
                           fitted=pa.array([bool(weights)] * len(p), pa.bool_()))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"{ddl(rows, ('t',))}severity double, grade int, toxic boolean, fitted boolean")
