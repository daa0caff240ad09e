"""Near-duplicate embeddings by sorted projection passes.

Vectors with the same label are linked by cosine >= ``threshold``. Copies (equal
label and equal numbers) are one class from the start, represented by the smallest
vec_id. In each pass a class gets a string of random-projection signs;
all classes are put in the order (pass, label, signs) by a range shuffle, numbered
without a global window (counts per partition are the only thing that meets), and
cut into runs of ``window`` neighbours. A run is compared with itself and the next
run by one matrix product in double precision. Verified pairs of all passes are
united; links are counted with the sizes of the classes, components by stars.

A label gets as many passes as its size asks for, ``passes`` at least: two vectors at
the threshold agree on one sign with a known probability, and have to agree on about as
many signs as halve the label down to a window; the passes bring the chance that some
pass holds such a pair to ``recall``.

A window only bounds one pass. Where a run and the farthest run compared with it
still share a link for every row (a group larger than the window), the next run is
compared too, until they don't, so large groups lose no neighbours to the bound.

Defined results: a vector that is null or zero or holds a null or a non-finite number,
or has a null label, links with nothing; vectors of unequal length aren't compared;
repeated rows with one vec_id are one vector; an empty table gives no rows; other
columns are ignored; null vec_ids have a null component.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import staged
from registrar.llm.components import components


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.93
    passes: int = 8
    bits: int = 48
    window: int = 512
    seed: int = 11
    recall: float = 0.999


def usable(vector: str = "embedding"):
    """Not null, not empty, without nulls and non-finite numbers, not zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def passes_for(rows: int, s: Settings) -> int:
    """Passes over a label of ``rows`` classes."""
    agree = 1 - math.acos(min(max(s.threshold, -1.0), 1.0)) / math.pi
    meet = agree ** max(0.0, math.log2(max(rows, 1) / s.window))
    return s.passes if meet >= 1 else max(s.passes, math.ceil(math.log(1 - s.recall) / math.log1p(-meet)))


def sign_strings(x: np.ndarray, label: np.ndarray, s: Settings, passes: int | None = None) -> np.ndarray:
    """Per pass and vector, the signs of ``bits`` random projections as one number."""
    rng = np.random.default_rng(s.seed)
    weight = (1 << np.arange(s.bits - 1, -1, -1, dtype=np.int64))
    out = []
    for _ in range(passes or s.passes):
        planes = rng.standard_normal((x.shape[1], s.bits))
        out.append(((x @ planes) > 0) @ weight)
    return np.stack(out)


def _numbered(rows: DataFrame, order: list[str], window: int) -> DataFrame:
    """Adds ``run``: the row's number in ``order``, divided by ``window``."""
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = staged(ranged.withColumn("__at", F.monotonically_increasing_id()), "sorted")
    split = ranged.withColumn("__part", F.shiftright("__at", 33)).withColumn("__row", F.col("__at").bitwiseAND((1 << 33) - 1))
    counts = sorted((r["__part"], r["n"]) for r in split.groupBy("__part").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for part, n in counts:  # one number per partition
        starts.append((part, total))
        total += n
    start = spark.createDataFrame(starts or [(0, 0)], "__part long, __start long")
    return (split.join(F.broadcast(start), "__part")
                 .withColumn("run", F.floor((F.col("__start") + F.col("__row")) / window)).drop("__at", "__part", "__row", "__start"))


def _pairs_of(left: pd.DataFrame, right: pd.DataFrame | None, threshold: float) -> pd.DataFrame:
    x = np.stack(left["x"].to_numpy())
    y = x if right is None else np.stack(right["x"].to_numpy())
    sim = x @ y.T
    ok = sim >= threshold
    r = left if right is None else right
    ok &= left["pass"].to_numpy()[:, None] == r["pass"].to_numpy()[None, :]
    ok &= left["label"].to_numpy()[:, None] == r["label"].to_numpy()[None, :]
    if right is None:
        ok = np.triu(ok, 1)
    i, j = np.nonzero(ok)
    a, b = left["id"].to_numpy()[i], r["id"].to_numpy()[j]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _compare(runs: DataFrame, steps: DataFrame, s: Settings) -> DataFrame:
    """``steps``: run, ahead. Pairs between each run and the run ``ahead`` of it."""
    left = runs.join(steps, "run").withColumn("side", F.lit(0)).withColumn("home", F.col("run"))
    ahead = steps.select((F.col("run") + F.col("ahead")).alias("run"), F.col("run").alias("home"), "ahead").filter("ahead > 0")
    right = runs.join(ahead, "run").withColumn("side", F.lit(1))
    cols = ["home", "ahead", "side", "pass", "label", "id", "v"]

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ahead = int(pdf["ahead"].iloc[0])
        home = int(pdf["home"].iloc[0])
        out = []
        for _, group in pdf.groupby(pdf["v"].map(len)):
            x = np.stack(group["v"].to_numpy()).astype(np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)
            group = group.assign(x=list(x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
            one, two = group[group["side"] == 0], group[group["side"] == 1]
            if ahead == 0:
                out.append(_pairs_of(one, None, s.threshold))
            elif len(one) and len(two):
                out.append(_pairs_of(one, two, s.threshold))
        found = pd.concat(out, ignore_index=True) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")
        return found.drop_duplicates().assign(home=home, ahead=ahead)

    both = left.select(*cols).unionByName(right.select(*cols))
    return both.groupBy("home", "ahead").applyInPandas(compare, "a long, b long, home long, ahead int")


def linked_pairs(classes: DataFrame, s: Settings) -> DataFrame:
    """a, b: distinct pairs of classes (id, label, v) with cosine >= threshold."""
    # only labels large enough for more passes are collected
    least = next(n for n in (s.window << k for k in range(63)) if passes_for(2 * n, s) > s.passes or n >> 50)
    large = classes.groupBy("label").agg(F.count("*").alias("n")).filter(F.col("n") > least).collect()
    more = {r["label"]: passes_for(r["n"], s) for r in large}

    def signs(batches):
        for pdf in batches:
            for _, group in pdf.groupby(pdf["v"].map(len)):
                x = np.stack(group["v"].to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                label = group["label"].to_numpy()
                passes = np.fromiter((more.get(k, s.passes) for k in label.tolist()), dtype=np.int64, count=len(label))
                for p, key in enumerate(sign_strings(x, label, s, int(passes.max()))):
                    own = passes > p
                    yield pd.DataFrame({"pass": p, "label": group["label"][own], "signs": key[own], "id": group["id"][own], "v": group["v"][own]})

    kind = dict(classes.dtypes)
    rows = classes.select("id", "label", "v").mapInPandas(
        signs, f"pass int, label {kind['label']}, signs long, id long, v {kind['v']}")
    runs = staged(_numbered(rows, ["pass", "label", "signs", "id"], s.window), "runs")
    every = runs.select("run").distinct()
    steps = every.select("run", F.explode(F.array(F.lit(0), F.lit(1))).alias("ahead"))
    found = staged(_compare(runs, steps, s), "pairs")
    pairs, ahead = found.select("a", "b"), 1
    while True:
        more = staged(found.filter(F.col("ahead") == ahead).groupBy(F.col("home").alias("run")).count()
                           .filter(F.col("count") >= s.window).select("run", F.lit(ahead + 1).alias("ahead")), "reach")
        if more.isEmpty():
            return pairs.distinct()
        found, ahead = staged(_compare(runs, more, s), "pairs"), ahead + 1
        pairs = pairs.unionByName(found.select("a", "b"))


def near_duplicates(embeddings: DataFrame, s: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = embeddings.select("vec_id", "embedding", "label")
    fit = rows.filter(usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    # -0.0 is written as 0.0, so that equal vectors are equal bytes
    keyed = fit.select("vec_id", "label", F.transform("embedding", lambda x: x + F.lit(0).cast("float")).alias("v")) \
               .withColumn("key", F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256))
    members = staged(keyed.select("vec_id", "label", "key").distinct(), "members")
    classes = staged(keyed.groupBy("label", "key").agg(F.min("vec_id").alias("id"), F.first("v").alias("v"))
                          .join(members.groupBy("label", "key").agg(F.count("*").alias("size")), ["label", "key"]), "classes")
    pairs = staged(linked_pairs(classes, s), "linked")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("id").alias("b"), "size")
    near = both.join(sizes, "b").groupBy(F.col("a").alias("id")).agg(F.sum("size").alias("others"))
    labels = components(pairs.toDF("u", "v"))
    of_class = (classes.select("label", "key", "id", "size").join(near, "id", "left")
                       .join(labels, F.col("id") == F.col("node"), "left")
                       .select("label", "key", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
                               F.coalesce("component", "id").alias("component")))
    of_row = members.join(of_class, ["label", "key"]).groupBy("vec_id").agg(F.max("links").alias("links"), F.min("component").alias("component"))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return rows.select("vec_id").join(of_row, "vec_id", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"))
