"""Nearest neighbours by largest inner product with a permutation index.

Inner products become distances by one more coordinate, sqrt(largest squared norm -
squared norm), with 0 for a query. ``pivots`` are a bounded sample of the vectors
(``FEWEST_PIVOTS``, or the square root of the rows where that is more, ``MOST_PIVOTS``
at most). A vector is represented by its ``prefix`` nearest pivots in order and posted in
the inverted files of the first ``posted`` of them; every vector is indexed. A query reads
the files of its own first ``files`` pivots; a file's entries are ranked by footrule distance
between the two orders (a pivot missing from a prefix has the last place), and the
best ``reranked`` of each file are ranked anew by the inner product in double precision.

A file longer than ``FILE_ROWS`` is dealt into parts by a hash, each read by its own
task, so a common vector's files aren't one group. Copies of a vector are one entry
that carries their ``neighbours`` + 1 smallest ids: ties go to smaller ids, so larger
ids of equal vectors are in no result. Queries left with fewer than ``neighbours``
results are searched over every vector, in blocks.

Defined results: vectors null, zero, or holding null or non-finite numbers take no
part; repeated rows with one vec_id and one vector are one; an empty table gives no
rows; other columns are ignored; vectors must have one length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrar.llm.common import row_frames, staged
from registrar.llm.embed_dedup import usable

FEWEST_PIVOTS = 256
MOST_PIVOTS = 4096
FILE_ROWS = 8192


@dataclass(frozen=True)
class Settings:
    neighbours: int = 20
    prefix: int = 256
    posted: int = 16
    files: int = 16
    reranked: int = 256
    seed: int = 5


def prefixes(x: np.ndarray, pivots: np.ndarray, size: int) -> np.ndarray:
    """Indexes of the nearest pivots of each row, nearest first, ties to the smaller."""
    d = (pivots * pivots).sum(axis=1)[None, :] - 2 * (x @ pivots.T)
    k = min(size, len(pivots))
    near = np.argpartition(d, k - 1, axis=1)[:, :k] if k < len(pivots) else np.broadcast_to(np.arange(k), (len(x), k))
    order = np.lexsort((near, np.take_along_axis(d, near, axis=1)), axis=1)
    return np.take_along_axis(near, order, axis=1).astype(np.int32)


def places(prefix: np.ndarray, n_pivots: int) -> np.ndarray:
    """Each pivot's place in each prefix; the last place where it is missing."""
    n, k = prefix.shape
    out = np.full((n, n_pivots), k - 1, dtype=np.uint8 if k <= 256 else np.uint16)
    np.put_along_axis(out, prefix.astype(np.int64), np.arange(k, dtype=out.dtype)[None, :], axis=1)
    return out


def footrule(query: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Spearman's footrule of one row of places to each of many."""
    return (np.maximum(entries, query) - np.minimum(entries, query)).sum(axis=1, dtype=np.int64)


def farness(prefix: np.ndarray, by_pivot: np.ndarray) -> np.ndarray:
    """A number for each of many orders that ranks them as their footrule to the prefix does;
    ``by_pivot`` has their places, a row a pivot. |a - b| is 2 max(a, b) - a - b, and places add up to
    the same in all orders; a pivot missing from the prefix has the last place there, the larger
    one whatever the other. So the maxima at the prefix's own pivots, of any number of pivots, say all."""
    k = len(prefix)
    if k == len(by_pivot):
        rows, place = by_pivot, np.argsort(prefix)
    else:
        rows, place = by_pivot[prefix], np.arange(k)
    most = np.uint16 if k <= 256 else np.uint32
    return np.maximum(rows, place.astype(rows.dtype)[:, None]).sum(axis=0, dtype=most)


def _augmented(v: pd.Series, largest: float, query: bool) -> np.ndarray:
    x = np.stack(v.to_numpy()).astype(np.float64)
    rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(largest - (x * x).sum(axis=1), 0))
    return np.column_stack((x, rest))


def _coded(rows: DataFrame, pivots: np.ndarray, largest: float, s: Settings, query: bool) -> DataFrame:
    """The rows with their prefix (16-bit pivot numbers as bytes) and the pivots whose
    files they are posted in or read."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in row_frames(batches, 4096):
            if len(pdf):
                code = prefixes(_augmented(pdf["v"], largest, query), pivots, s.prefix).astype(np.uint16)
                yield pdf.assign(code=pd.Series([c.tobytes() for c in code], dtype=object, index=pdf.index),
                                 v=pd.Series([np.asarray(v, dtype=np.float64).tobytes() for v in pdf["v"]], dtype=object, index=pdf.index),
                                 pivots=list(code[:, :s.files if query else s.posted].astype(np.int32)))

    return rows.select("id", "ids", "v").mapInPandas(run, "id long, ids array<long>, v binary, code binary, pivots array<int>")


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors: id (smallest vec_id), ids (the ``keep`` smallest), v. Copies
    are gathered in 64 parts first, so a very common vector isn't one group."""
    keyed = rows.select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x + F.lit(0).cast("float")).alias("v"))
    keyed = keyed.withColumn("key", F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256))
    part = keyed.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")).agg(
        F.slice(F.array_sort(F.collect_set("id")), 1, keep).alias("ids"), F.first("v").alias("v"))
    whole = part.groupBy("key").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"), F.first("v").alias("v"))
    return whole.select(F.col("ids")[0].alias("id"), "ids", "v")


def _read_files(entries: DataFrame, queries: DataFrame, n_pivots: int, s: Settings) -> DataFrame:
    """query, ids, score: the best of every file part that a query reads."""
    posted = entries.select("id", "ids", "v", "code", F.explode("pivots").alias("pivot"))
    parts = posted.groupBy("pivot").agg(F.ceil(F.count("*") / FILE_ROWS).cast("int").alias("parts"))
    posted = (posted.join(F.broadcast(parts), "pivot")  # a row per pivot, MOST_PIVOTS at most
                    .select("pivot", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"),
                            F.lit(1).alias("side"), "id", "ids", "v", "code"))
    asking = (queries.select("id", "ids", "v", "code", F.explode("pivots").alias("pivot"))
                     .join(F.broadcast(parts), "pivot")
                     .select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                             F.lit(0).alias("side"), "id", "ids", "v", "code"))

    def matrix(column: pd.Series, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(column), dtype=kind).reshape(len(column), -1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, e = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1].sort_values("id")
        keys, at, scores = [], [], []
        if len(q) and len(e):
            theirs = np.ascontiguousarray(places(matrix(e["code"], np.uint16), n_pivots).T)
            x, y = matrix(e["v"], np.float64), matrix(q["v"], np.float64)
            for k, prefix, v in zip(q["id"], matrix(q["code"], np.uint16), y):
                near = np.argsort(farness(prefix, theirs), kind="stable")[:s.reranked]
                score = (x[near] * v).sum(axis=1)
                best = np.lexsort((near, -score))[:s.neighbours + 1]  # one more: the query's own entry
                keys.append(np.full(len(best), k)), at.append(near[best]), scores.append(score[best])
        ids = e["ids"].to_numpy()
        return pd.DataFrame({"query": np.concatenate([*keys, np.empty(0, np.int64)]).astype(np.int64),
                             "ids": pd.Series([ids[i] for a in at for i in a], dtype=object),
                             "score": np.concatenate([*scores, np.empty(0)])})

    return posted.unionByName(asking).groupBy("pivot", "part").applyInPandas(run, "query long, ids array<long>, score double")


def _exhaustive(queries: DataFrame, entries: DataFrame, n_queries: int, n_entries: int, keep: int) -> DataFrame:
    """query, ids, score: the best ``keep`` entries of every block, over all blocks."""
    nq, ne = -(-n_queries // 512) or 1, -(-n_entries // 8192) or 1
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select(block(nq).alias("qb"), every(ne).alias("eb"), F.lit(0).alias("side"), "id", "ids", "v")
    e = entries.select(every(nq).alias("qb"), block(ne).alias("eb"), F.lit(1).alias("side"), "id", "ids", "v")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1].sort_values("id")
        if not len(one) or not len(two):
            return pd.DataFrame({"query": [], "ids": [], "score": []}).astype({"query": "int64", "ids": object})
        y, out = np.stack(two["v"].to_numpy()).astype(np.float64), []
        for k, v in zip(one["id"], one["v"]):
            score = (y * np.asarray(v, dtype=np.float64)).sum(axis=1)
            for i in np.argsort(-score, kind="stable")[:keep]:
                out.append((k, two["ids"].iloc[i], score[i]))
        return pd.DataFrame(out, columns=["query", "ids", "score"])

    return q.unionByName(e).groupBy("qb", "eb").applyInPandas(run, "query long, ids array<long>, score double")


def _ranked(scored: DataFrame, n: int) -> DataFrame:
    rows = (scored.select("query", "score", F.explode("ids").alias("vec_id")).filter("vec_id != query")
                  .dropDuplicates(["query", "vec_id"]))
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return (rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
                .select(F.col("query").alias("query_id"), "rank", "vec_id", "score"))


def search(embeddings: DataFrame, is_query, s: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest neighbours of the rows for which the
    condition ``is_query`` (over vec_id) holds, among all other rows."""
    rows = embeddings.filter(usable() & F.col("vec_id").isNotNull()).select("vec_id", "embedding")
    entries = staged(_classes(rows, s.neighbours + 1), "entries")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, largest = entries.agg(F.count("*"), F.coalesce(F.max(norm), F.lit(0.0))).first()
    queries = staged(rows.filter(is_query).dropDuplicates(["vec_id"]).select(
        F.col("vec_id").alias("id"), F.array("vec_id").alias("ids"), F.col("embedding").alias("v")), "queries")
    if not n:
        return _ranked(queries.select(F.col("id").alias("query"), "ids", F.lit(0.0).alias("score")), s.neighbours)
    many = min(MOST_PIVOTS, max(FEWEST_PIVOTS, math.ceil(math.sqrt(n))))
    chosen = entries.orderBy(F.xxhash64("id", F.lit(s.seed)), "id").limit(many).select("v").toPandas()
    pivots = _augmented(chosen["v"], largest, False)
    coded = staged(_coded(entries, pivots, largest, s, False), "codes")
    asking = staged(_coded(queries, pivots, largest, s, True), "query-codes")
    ranked = staged(_ranked(_read_files(coded, asking, len(pivots), s), s.neighbours), "ranked")
    whole = ranked.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= s.neighbours)
    short = staged(queries.join(whole, F.col("id") == F.col("query_id"), "left_anti"), "short")
    n_short = short.count()
    if not n_short:
        return ranked
    rest = _ranked(_exhaustive(short, entries, n_short, n, s.neighbours + 1), s.neighbours)
    return ranked.join(short, F.col("query_id") == F.col("id"), "left_anti").unionByName(rest)
