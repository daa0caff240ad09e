"""Compression of vectors into part codes, with norm-of-sum bounds.

Components become integers (``floor(4096 x)``) and a vector is cut into equal parts. Each
part position has a codebook that is improved in rounds: every part goes to its nearest
entry, then an entry becomes the floored mean of its parts. All of it is exact.

Most parts stay where they are, and bounds say so without looking at the other entries.
A part keeps the squared distance to its own entry and to the nearest other entry, each with
the round in which it was taken, and the history of all codebooks is kept. In a later round
the distance to its own entry is at most the old one and the true displacement of that
entry since the bound's round (the norm of the summed steps, which is at most the sum of
their norms); that to any other entry is at least the old one less the largest such
displacement among the others. If the first stays below the second, the part stays.
Else the distance to its own entry is taken anew and the test is made again; only then are
all entries looked at. Tests leave room for rounding, so the skipped parts are exactly those
that a full search would leave.

On Spark, a round is one pass over the stored vectors with their state, a map
without a shuffle that writes the next state; the state before the last is deleted.
Each frame of rows adds one row with the sums of what came and went per entry, so the
driver gets one number per part, entry and component and never a vector.

Defined results: vectors that are null or hold null or non-finite components are left out,
and so are vectors that aren't as long as the first kept one; a length that the parts don't
divide is an error. With fewer kept vectors than entries the codebooks are so much shorter.
The first entries are those of the smallest ids, of equal ids by their components; a null id
comes after all others. Repeated rows count each. An empty table gives no rows. Other columns
are ignored, a missing label is a null one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import row_frames, staged
from registrar.session import scratch_path

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
FRAME = 4096
LONGEST = 2 ** 63 - 1
#: Share by which a float bound may be off.
SLACK = 1e-12


def distances(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of ``parts`` (n, width) to ``book`` (entries, width)."""
    if max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0)) >= 2 ** 28:  # beyond 64 bits
        parts, book = parts.astype(object), book.astype(object)
    out = np.zeros((len(parts), len(book)), dtype=parts.dtype)
    for i in range(parts.shape[1]):
        step = parts[:, i, None] - book[None, :, i]
        out += step * step
    return out


def nearest_two(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry (lower index on ties), its squared distance, and that of the
    nearest other entry (the largest number without one)."""
    d = distances(parts, book)
    code = d.argmin(axis=1)
    rows = np.arange(len(d))
    own = d[rows, code]
    d[rows, code] = LONGEST
    return code, np.minimum(own, LONGEST).astype(np.int64), np.minimum(d.min(axis=1), LONGEST).astype(np.int64)


def displacement(history: np.ndarray, now: int) -> np.ndarray:
    """For every round up to ``now`` and every entry: how far the entry has come since."""
    gone = (history[:now + 1].astype(np.float64) - history[now].astype(np.float64))
    return np.sqrt((gone * gone).sum(axis=2))


class Bounds:
    """State of the parts at one position: code, squared distances to the own and to the
    nearest other entry, and the rounds these were taken in."""

    def __init__(self, code, own, other, own_at, other_at):
        self.code, self.own, self.other, self.own_at, self.other_at = code, own, other, own_at, other_at
        self.scanned = self.measured = 0

    @classmethod
    def fresh(cls, parts: np.ndarray, book: np.ndarray, now: int) -> Bounds:
        code, own, other = nearest_two(parts, book)
        at = np.full(len(parts), now, dtype=np.int64)
        return cls(code, own, other, at, at.copy())

    def unsure(self, rows: np.ndarray, moved: np.ndarray) -> np.ndarray:
        """Those of ``rows`` whose bounds don't show that the part stays. ``moved``: the
        displacements by round and entry."""
        code, own_at, other_at = self.code[rows], self.own_at[rows], self.other_at[rows]
        high = np.argsort(moved, axis=1)
        top = high[:, -1][other_at]
        second = high[:, -2][other_at] if moved.shape[1] > 1 else top
        away = np.where(top == code, moved[other_at, second], moved[other_at, top])
        own, other, step = np.sqrt(self.own[rows].astype(np.float64)), np.sqrt(self.other[rows].astype(np.float64)), moved[own_at, code]
        stays = own + step + SLACK * (own + other + step + away) < other - away
        return rows[~stays]

    def update(self, parts: np.ndarray, history: np.ndarray, now: int) -> None:
        """The assignment to the codebook of round ``now``."""
        moved = displacement(history, now)
        rows = self.unsure(np.arange(len(parts)), moved)
        self.measured += len(rows)
        if len(rows):
            own = np.zeros(len(rows), dtype=np.int64)
            for entry in np.unique(self.code[rows]):
                mine = self.code[rows] == entry
                own[mine] = np.minimum(distances(parts[rows[mine]], history[now][entry:entry + 1])[:, 0], LONGEST).astype(np.int64)
            self.own[rows], self.own_at[rows] = own, now
            rows = self.unsure(rows, moved)
        self.scanned += len(rows)
        if len(rows):
            self.code[rows], self.own[rows], self.other[rows] = nearest_two(parts[rows], history[now])
            self.own_at[rows] = self.other_at[rows] = now

    def exact(self, parts: np.ndarray, history: np.ndarray, now: int) -> np.ndarray:
        """Squared distances to the own entries of round ``now``."""
        late = np.flatnonzero(self.own_at != now)
        for entry in np.unique(self.code[late]):
            mine = late[self.code[late] == entry]
            self.own[mine] = np.minimum(distances(parts[mine], history[now][entry:entry + 1])[:, 0], LONGEST).astype(np.int64)
        return self.own


def _vectors(cells: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype=np.int64).reshape(len(cells), -1)


def _tally(parts: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """Sums of components and the number of parts per entry."""
    out = np.zeros((entries, parts.shape[1] + 1), dtype=np.int64)
    np.add.at(out, code, np.concatenate([parts, np.ones((len(parts), 1), dtype=np.int64)], axis=1))
    return out


_STATE = "vec_id string, label string, v binary, state binary, tally array<long>"


def _round(history: np.ndarray, now: int, parts: int):
    """A pass: state of every row for the codebooks of round ``now`` (history: part, round,
    entry, component), and per frame one row with the change of the entries' sums."""
    entries, width = history.shape[2:]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in row_frames(batches, FRAME):
            pdf = pdf[pdf["v"].notna()]
            if pdf.empty:
                continue
            v = _vectors(pdf["v"]).reshape(len(pdf), parts, width)
            old = _vectors(pdf["state"]).reshape(len(pdf), 5, parts) if now else None
            new, change = np.empty((len(pdf), 5, parts), dtype=np.int64), []
            for p in range(parts):
                x = np.ascontiguousarray(v[:, p])
                if now:
                    b = Bounds(*(old[:, i, p].copy() for i in range(5)))
                    b.update(x, history[p], now)
                    moved = b.code != old[:, 0, p]
                    change.append(_tally(x[moved], b.code[moved], entries) - _tally(x[moved], old[moved, 0, p], entries))
                else:
                    b = Bounds.fresh(x, history[p][0], 0)
                    change.append(_tally(x, b.code, entries))
                new[:, :, p] = np.stack([b.code, b.own, b.other, b.own_at, b.other_at], axis=1)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "v": pdf["v"], "state": [s.tobytes() for s in new], "tally": None})
            yield pd.DataFrame({"vec_id": [None], "label": None, "v": None, "state": None,
                                "tally": [np.stack(change).ravel().tolist()]})

    return run


def quantise(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """Every kept vector's codes and errors, and the codebooks (part, entry, component).
    The rows: vec_id, label, codes (array of int, one per part), error."""
    spark = vectors.sparkSession
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    label = F.col(label_col).cast("string") if label_col in vectors.columns else F.lit(None).cast("string")
    kept = vectors.filter(x.isNotNull() & ~bad).select(F.col(id_col).alias("vec_id"), label.alias("label"), x.cast("array<double>").alias("x"))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()  # a codebook
    if not first:
        none = spark.createDataFrame([], "vec_id long, label string, codes array<int>, error long")
        return none, np.zeros((parts, 0, 0), dtype=np.int64)
    length = len(first[0]["x"])
    if length % parts:
        raise ValueError(f"{length} components in {parts} equal parts")
    book = np.array([[int(np.floor(c * scale)) for c in r["x"]] for r in first if len(r["x"]) == length], dtype=np.int64)
    width = length // parts
    history = book.reshape(len(book), parts, width).transpose(1, 0, 2)[:, None]

    def integers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in row_frames(batches, FRAME):
            v = np.floor(np.stack(pdf["x"].to_list()) * scale).astype(np.int64)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "v": [r.tobytes() for r in v], "state": None, "tally": None})

    kept = kept.withColumn("vec_id", F.col("vec_id").cast("string"))  # a null makes floats of numbers in pandas
    rows = kept.filter(F.size("x") == length).mapInPandas(integers, _STATE)
    sums, before = np.zeros((parts, len(book), width + 1), dtype=object), None
    for now in range(rounds + 1):
        path = scratch_path(spark, "vector-codes")
        rows.mapInPandas(_round(history, now, parts), _STATE).write.parquet(path)
        rows = spark.read.schema(_STATE).parquet(path)
        if before:
            _drop(spark, before)
        before = path
        if now == rounds:
            break
        change = (rows.filter("tally is not null").select(F.posexplode("tally").alias("i", "n"))
                      .groupBy("i").agg(F.sum("n").alias("n")).collect())  # one number per part, entry and component
        for r in change:
            sums.flat[r["i"]] += r["n"]
        count = sums[:, :, -1:]
        mean = np.where(count > 0, sums[:, :, :-1] // np.where(count > 0, count, 1), history[:, -1].astype(object))
        history = np.concatenate([history, mean.astype(np.int64)[:, None]], axis=1)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in row_frames(batches, FRAME):
            v = _vectors(pdf["v"]).reshape(len(pdf), parts, width)
            state = _vectors(pdf["state"]).reshape(len(pdf), 5, parts)
            error = np.zeros(len(pdf), dtype=np.int64)
            for p in range(parts):
                error += Bounds(*(state[:, i, p].copy() for i in range(5))).exact(np.ascontiguousarray(v[:, p]), history[p], rounds)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "codes": state[:, 0].astype(np.int32).tolist(), "error": error})

    out = rows.filter("v is not null").select("vec_id", "label", "v", "state").mapInPandas(finish, "vec_id string, label string, codes array<int>, error long")
    return staged(out.withColumn("vec_id", F.col("vec_id").cast("long")), "vector-codes"), history[:, -1]


def _drop(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def digest(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256."""
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    totals = rows.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    out = rows.join(totals, F.col("label").eqNullSafe(F.col("same")))
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
