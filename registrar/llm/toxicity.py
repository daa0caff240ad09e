"""Toxicity by a counterfactually regularised logistic classifier.

Features of a text are its words and their beginnings (3 to 6 characters), with
the value 1 + log2(count). From a bounded sample of labelled rows (``SAMPLE``
documents, by a hash of the id) the ``FEATURES`` features whose document counts
differ most between the classes are chosen; words of the identity groups are always
among them. For every sampled text that names an identity, counterfactual texts swap
each identity term for the next and the next but one of its group, and for no group
at all; the fit adds ``CF_WEIGHT`` times the squared changes of the linear score, summed
over these and scaled up to the sample, so that naming a group moves the score little. The fitted weights are at most
``FEATURES`` + the identity terms in number, so they travel with the task.

Defined results: null and empty texts score the model's intercept; labels that are
null don't take part, a document labelled twice takes the larger label; without
labels, or with one class only, every text scores the labels' (smoothed) mean;
repeated rows are scored alike; an empty table gives no rows; other columns are
passed through by ``with_score``.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import staged

SAMPLE = 20_000
FEATURES = 512
MIN_DOCS = 3
L2 = 1.0
CF_WEIGHT = 5.0
BEGINNINGS = (3, 4, 5, 6)

#: Terms that name a group of people; a swap stays inside a line.
IDENTITY_GROUPS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes"), ("femmes", "hommes"),
    ("muslime", "christen", "juden", "buddhisten"), ("frauen", "männer"),
    ("musulmanes", "cristianos", "judíos", "budistas"), ("mujeres", "hombres"),
    ("disabled", "blind", "deaf"), ("old", "young"), ("elderly", "teenagers"),
)
#: Term -> the words that take its place, one for each counterfactual text.
SWAPS = {a.encode(): (g[(i + 1) % len(g)].encode(), g[(i + 2) % len(g)].encode(), b"") for g in IDENTITY_GROUPS for i, a in enumerate(g)}

#: ASCII other than letters becomes a blank; other characters are kept.
_BLANK = bytes.maketrans(bytes(range(128)), bytes(b if 97 <= b <= 122 else 32 for b in range(128)))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_BLANK).split()


def features_of(word: bytes) -> list[str]:
    w = word.decode("utf-8", "replace")
    return ["=" + w, *("^" + w[:k] for k in BEGINNINGS if len(w) > k)]


@dataclass(frozen=True)
class Model:
    """``weights``: feature -> weight; the score is the logistic function of
    ``bias`` + sum of weight * (1 + log2(count))."""
    bias: float
    weights: dict[str, float]

    def scorer(self):
        index = {f: i for i, f in enumerate(self.weights)}
        w = np.array([*self.weights.values()], dtype=float)
        known: dict[bytes, tuple[int, ...]] = {}

        def score(text: str | None) -> float:
            if len(known) > 500_000:
                known.clear()
            ids = counts_of(words_of(text), index, known)
            z = self.bias + sum(w[i] * (1 + np.log2(n)) for i, n in ids.items())
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return score


def counts_of(words: list[bytes], index: dict[str, int], known: dict[bytes, tuple[int, ...]]) -> Counter:
    """How often each indexed feature occurs."""
    out: Counter = Counter()
    for w in words:
        ids = known.get(w)
        if ids is None:
            ids = known[w] = tuple(index[f] for f in features_of(w) if f in index)
        if ids:
            out.update(ids)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int = SAMPLE) -> DataFrame:
    """text, y of at most about ``size`` labelled documents, chosen by a hash of the
    id. The chosen ids are few, so the documents aren't shuffled."""
    known = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
                   .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    n = known.count()
    cut = F.lit(10_000_000) if n <= size else F.lit(int(10_000_000 * size / n))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(10_000_000)) < cut)
    return (docs.select(F.col("doc_id").alias("k"), F.col("text").alias("t"))
                .join(F.broadcast(chosen.withColumnRenamed("doc_id", "k")), "k").select("t", "y"))


def chosen_features(sample: DataFrame, n: int, positive: int) -> list[str]:
    """The features whose document counts differ most between the classes."""
    def rows(seen: Counter, toxic: Counter) -> pd.DataFrame:
        return pd.DataFrame({"f": pd.Series([*seen], dtype=object), "n": [*seen.values()], "y": [toxic[f] for f in seen]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, toxic = Counter(), Counter()
        for pdf in batches:
            for t, y in zip(pdf["t"], pdf["y"]):
                found = {f for w in set(words_of(t)) for f in features_of(w)}
                seen.update(found)
                if y:
                    toxic.update(found)
            if len(seen) > 1_000_000:
                yield rows(seen, toxic)
                seen, toxic = Counter(), Counter()
        yield rows(seen, toxic)

    counts = sample.mapInPandas(run, "f string, n long, y long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    expected = F.col("n") * F.lit(positive / n)
    strength = F.abs(F.col("y") - expected) / F.sqrt(expected + 1)
    best = counts.filter(F.col("n") >= MIN_DOCS).orderBy(strength.desc(), "f").limit(FEATURES).collect()
    return [r["f"] for r in best]


def design_rows(sample: DataFrame, features: list[str]) -> pd.DataFrame:
    """Per sampled text: y, its feature counts (own); per counterfactual of it, the same
    and the counterfactual's counts (b, bn)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, known = {f: i for i, f in enumerate(features)}, {}
        for pdf in batches:
            out = []
            for t, y in zip(pdf["t"], pdf["y"]):
                words = words_of(t)
                a = counts_of(words, index, known)
                row = (int(y), [*a], [*a.values()])
                out.append((True, *row, [], []))
                if any(w in SWAPS for w in words):
                    for k in range(3):
                        b = counts_of([v for w in words if (v := SWAPS[w][k] if w in SWAPS else w)], index, known)
                        out.append((False, *row, [*b], [*b.values()]))
            yield pd.DataFrame(out, columns=["own", "y", "a", "an", "b", "bn"])

    return sample.mapInPandas(run, "own boolean, y int, a array<int>, an array<int>, b array<int>, bn array<int>").toPandas()


def _dense(ids: pd.Series, counts: pd.Series, k: int) -> np.ndarray:
    x = np.zeros((len(ids), k + 1), dtype=np.float32)
    x[:, k] = 1
    sizes = [len(i) for i in ids]
    if sum(sizes):
        rows = np.repeat(np.arange(len(ids)), sizes)
        x[rows, np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int64)] = \
            1 + np.log2(np.fromiter(itertools.chain.from_iterable(counts), dtype=np.float64))
    return x


def fit_weights(rows: pd.DataFrame, k: int, l2: float = L2, cf_weight: float = CF_WEIGHT) -> np.ndarray:
    """Newton's method on the penalised logistic loss; the last weight is the bias."""
    own, swapped = rows[rows["own"]], rows[~rows["own"]]
    x, y = _dense(own["a"], own["an"], k), own["y"].to_numpy(dtype=np.float64)
    ridge = np.full(k + 1, l2)
    ridge[k] = 1e-6
    penalty = np.diag(ridge)
    for i in range(0, len(swapped), 2048):
        part = swapped.iloc[i:i + 2048]
        d = (_dense(part["a"], part["an"], k) - _dense(part["b"], part["bn"], k)).astype(np.float64)
        penalty += cf_weight * len(x) / len(swapped) * (d.T @ d)
    w = np.zeros(k + 1)
    rate = (y.sum() + 1) / (len(y) + 2)
    w[k] = np.log(rate / (1 - rate))
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty @ w
        h = np.maximum(p * (1 - p), 1e-5).astype(np.float32)
        step = np.linalg.solve((x.T @ (x * h[:, None])).astype(np.float64) + penalty, grad)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-3:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE) -> Model:
    """``labels``: doc_id and the label, only of the rows to learn from."""
    sample = staged(labelled_sample(docs, labels, label, size), "toxicity-sample")
    n, positive = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < positive < n:
        rate = (positive + 1) / (n + 2)
        return Model(float(np.log(rate / (1 - rate))), {})
    features = chosen_features(sample, n, positive)
    identity = ["=" + w.decode() for w in SWAPS]
    features = [*features, *(f for f in identity if f not in set(features))]
    w = fit_weights(design_rows(sample, features), len(features))
    return Model(float(w[-1]), {f: float(v) for f, v in zip(features, w) if abs(v) > 1e-9})


def score_column(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = model.scorer()
        for t in texts:
            yield t.map(of, na_action=None).astype(float)

    return score(text)


def with_score(docs: DataFrame, model: Model, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the score of each whole text in a column ``out``."""
    return docs.withColumn(out, score_column(model, F.col(text_col)))
