"""Quality by a sparse ensemble of rules, as Spark column expressions.

``STATISTICS`` of a text are column expressions. On a bounded sample of labelled
rows (``SAMPLE`` documents, by a hash of the id) boosted trees of small depth are
grown on them; each path from a root is a rule, a conjunction of thresholds. Lasso
logistic regression over the rules' truth values keeps a few weighted rules, which
are compiled back into one column expression: scoring is one scan without Python.

Defined results: a null text counts as empty; labels that are null don't take part,
a document labelled twice takes the larger label; without labels, or with one
class only, every text scores the labels' (smoothed) mean; repeated rows are
scored alike; an empty table gives no rows; other columns are passed through by
``with_score``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
TREES = 24
DEPTH = 3
BINS = 32
MIN_LEAF = 8
LEARNING_RATE = 0.4
L1 = 2.0


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def _count_of(text: Column, s: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))) / len(s)


def statistics(text: Column) -> dict[str, Column]:
    """Name -> expression over a text (not null)."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda s: s != "")
    n, chars = F.size(words), F.length(text)
    tail = F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0)))
    twins = F.aggregate(F.zip_with(words, tail, lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    return {
        "log_words": F.log(n.cast("double") + 1),
        "word_length": _share(chars, n),
        "capitals": _share(F.regexp_count(text, F.lit(r"\p{Lu}")), chars),
        "digits": _share(F.regexp_count(text, F.lit(r"\d")), chars),
        "marks": _share(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,;:!?'\"()\-]")), chars),
        "exclamations": _share(_count_of(text, "!"), n),
        "bars": _share(_count_of(text, "|"), n),
        "stops": _share(_count_of(text, "."), n),
        "distinct_words": _share(F.size(F.array_distinct(words)), n),
        "twin_words": _share(twins, n),
        "distinct_lines": _share(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_length": _share(n, F.size(lines)),
    }


STATISTICS = ("log_words", "word_length", "capitals", "digits", "marks", "exclamations", "bars", "stops",
              "distinct_words", "twin_words", "distinct_lines", "line_length")

#: A rule: (statistic, True for "at most" and False for "above", threshold), ...
Rule = tuple[tuple[str, bool, float], ...]


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self, stats: dict[str, Column]) -> Column:
        """The score as an expression over columns of the statistics."""
        z = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for name, below, at in rule:
                holds = holds & ((stats[name] <= at) if below else (stats[name] > at))
            z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _bins(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    return np.stack([np.searchsorted(q, c, side="left") for q, c in zip(cuts, x.T)], axis=1), cuts


def _grow(binned, cuts, grad, hess, rows, depth, path, rules, values) -> None:
    """Split ``rows`` where the gain is largest; note each node's rule; set leaves."""
    best = (1e-6, None, None)
    g, h = grad[rows].sum(), hess[rows].sum()
    if depth and len(rows) >= 2 * MIN_LEAF:
        for j, q in enumerate(cuts):
            if not len(q):
                continue
            b = binned[rows, j]
            n = np.cumsum(np.bincount(b, minlength=len(q) + 1))[:-1]
            gl = np.cumsum(np.bincount(b, grad[rows], len(q) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, hess[rows], len(q) + 1))[:-1]
            gain = gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g ** 2 / (h + 1)
            gain[(n < MIN_LEAF) | (len(rows) - n < MIN_LEAF)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], j, k)
    _, j, k = best
    if j is None:
        values[rows] = -g / (h + 1)
        return
    for below in (True, False):
        part = rows[(binned[rows, j] <= k) == below]
        rule = (*path, (STATISTICS[j], below, float(cuts[j][k])))
        rules[rule] = None
        _grow(binned, cuts, grad, hess, part, depth - 1, rule, rules, values)


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The conjunctive rules of the paths of boosted trees."""
    binned, cuts = _bins(x)
    z, rules = np.full(len(y), np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        values = np.zeros(len(y))
        _grow(binned, cuts, p - y, p * (1 - p), np.arange(len(y)), DEPTH, (), rules, values)
        z += LEARNING_RATE * values
    return list(rules)


def truth(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    at = {s: i for i, s in enumerate(STATISTICS)}
    out = np.ones((len(x), len(rules)))
    for r, rule in enumerate(rules):
        for name, below, t in rule:
            c = x[:, at[name]]
            out[:, r] *= (c <= t) if below else (c > t)
    return out


def lasso(m: np.ndarray, y: np.ndarray, l1: float = L1, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient for the l1-penalised logistic loss."""
    w, b = np.zeros(m.shape[1]), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    norm = np.linalg.norm(m.T @ m, 2) + len(y)
    step, vw, vb, t = 4 / norm, w, b, 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-np.clip(m @ vw + vb, -30, 30))) - y
        nw = vw - step * (m.T @ r)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * l1, 0)
        nb = vb - step * r.sum()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return b, w


def fit_rules(x: np.ndarray, y: np.ndarray) -> Model:
    if not 0 < y.sum() < len(y):
        return Model(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), ())
    rules = tree_rules(x, y)
    if not rules:
        return Model(float(np.log(y.sum() / (len(y) - y.sum()))), ())
    bias, w = lasso(truth(x, rules), y)
    return Model(bias, tuple((r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", size: int = SAMPLE) -> Model:
    """``labels``: doc_id and the label, only of the rows to learn from. The chosen
    ids are few, so the documents aren't shuffled."""
    known = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
                   .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    n = known.count()
    cut = F.lit(10_000_000) if n <= size else F.lit(int(10_000_000 * size / n))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(10_000_000)) < cut)
    sample = (docs.select(F.col("doc_id").alias("k"), F.coalesce("text", F.lit("")).alias("t"))
                  .join(F.broadcast(chosen.withColumnRenamed("doc_id", "k")), "k"))
    rows = sample.select("y", *[c.alias(s) for s, c in statistics(F.col("t")).items()]).toPandas()
    return fit_rules(rows[list(STATISTICS)].to_numpy(dtype=float), rows["y"].to_numpy(dtype=float))


def with_score(docs: DataFrame, model: Model, out: str, text_col: str = "text", filtered: bool = False) -> DataFrame:
    """``docs`` with the score of each whole text in a column ``out``. ``filtered``: for a filter on
    the score, which the optimiser would put before the statistics, with a copy of them for
    every rule; they come from a generator then, which no filter on its rows passes."""
    held = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    own = [c.alias(s) for s, c in statistics(F.coalesce(F.col(text_col), F.lit(""))).items()]
    stats = docs.select(held, F.struct(*own).alias("__stats")).select("__row", F.inline(F.array("__stats"))) if filtered else docs.select(held, *own)
    scored = stats.select("__row", model.column({s: F.col(s) for s in STATISTICS}).alias("__score"))
    return scored.select("__row.*", F.col("__score").alias(out))
