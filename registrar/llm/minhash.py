"""Near-duplicate documents by HyperMinHash sketches.

A document's set: the distinct shingles of ``shingle`` words as 64-bit hashes
(fewer words: the whole sequence as one; none: the empty set). A shingle's hash
picks one of ``bands * rows`` registers; a register keeps the least remaining hash
as its leading-zero count and ``MANTISSA`` bits after the leading one. Empty registers
borrow from a filled one by a fixed random preference (densification).

Equal sets are one class from the start, represented by its smallest doc_id. Bands
of registers are hashed; classes that share a band bucket are candidates. All buckets
with the same smallest class form one group, which holds each class once:

1. sketches of a group are compared; a class stays if its collision-corrected Jaccard
   estimate to another is within ``SIGMAS`` deviations of the threshold;
2. the full sets of the classes left are compared, likeliest pairs first. A pair
   whose ends are already joined needs no check, so a group of copies costs about
   one check per member and gives as many links, not all pairs.

A group of over ``BLOCK`` classes is cut into blocks, and each pair of blocks is a task
of its own: no bucket or group is cut short.

Defined results: null and empty texts have 0 shingles and link with nothing; a null
doc_id forms no link and has a null component; repeated rows share a component;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import row_frames, staged
from registrar.llm.components import components

MANTISSA = 10
SIGMAS = 4.5
BLOCK = 2048
#: Up to so many ids (8 bytes each) are sent to every task; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


@dataclass(frozen=True)
class Settings:
    """``percent``: documents link if 100 * intersection >= percent * union."""
    shingle: int = 5
    percent: int = 80
    bands: int = 56
    rows: int = 5

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    k = min(size, n)
    s = np.full(n - k + 1, k, dtype=np.uint64)
    for j in range(k):
        s = s * np.uint64(0x9E3779B97F4A7C15) + h[j:n - k + 1 + j]
    return np.unique(_mix(s))


def preferences(registers: int) -> np.ndarray:
    """For each register, a fixed random rank of all registers to borrow from."""
    return np.random.default_rng(registers).random((registers, registers), dtype=np.float32)


def sketch_of(hashes: np.ndarray, registers: int, prefer: np.ndarray) -> np.ndarray:
    """Leading-zero count and mantissa of each register, as one 16-bit number."""
    at = ((hashes >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
    low = np.full(registers, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(low, at, _mix(hashes ^ np.uint64(0xD1B54A32D192ED03)))
    filled = np.zeros(registers, dtype=bool)
    filled[at] = True
    part, power = np.frexp(low.astype(np.float64))
    zeros = np.clip(64 - power, 0, 63).astype(np.uint16)
    out = (zeros << np.uint16(MANTISSA)) | ((part * 2 - 1) * (1 << MANTISSA)).astype(np.uint16)
    if not filled.all():
        full, empty = np.flatnonzero(filled), np.flatnonzero(~filled)
        out[empty] = out[full[prefer[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    parts = sketch.astype(np.uint64).reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in parts.T:
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def collision_rate() -> float:
    """Chance that two different minima leave the same register: the sum over cells of
    the squared chance of a cell, for minima of many values."""
    edges = (1 + np.arange((1 << MANTISSA) + 1) / (1 << MANTISSA))[None, :] * 2.0 ** -np.arange(1, 40)[:, None]
    scale = 2.0 ** 12  # values per register; the sum hardly depends on it
    cell = np.exp(-scale * edges[:, :-1]) - np.exp(-scale * edges[:, 1:])
    return float((cell ** 2).sum())


COLLISIONS = collision_rate()


def estimate(equal_share: np.ndarray) -> np.ndarray:
    """Jaccard from the share of equal registers, corrected for collisions."""
    return np.maximum(0.0, (equal_share - COLLISIONS) / (1 - COLLISIONS))


def least_estimate(sizes: np.ndarray, s: Settings) -> np.ndarray:
    """The estimate below which a pair isn't checked: few shingles fill few
    registers, so their estimate is looser."""
    j = s.percent / 100
    used = s.registers * -np.expm1(-sizes / s.registers)
    return j - SIGMAS * np.sqrt(j * (1 - j) / np.maximum(used, 1))


def document_sketches(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, set_key (digest of the set), sketch; null where the set is empty."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prefer = preferences(s.registers)
        for pdf in row_frames(batches, 1000):
            n, keys, sketches = [], [], []
            for t in pdf["t"]:
                hashes = shingle_set(t, s.shingle)
                n.append(len(hashes))
                if not len(hashes):
                    keys.append(None), sketches.append(None)
                    continue
                keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                sketches.append(sketch_of(hashes, s.registers, prefer).tobytes())
            yield pd.DataFrame({"doc_id": pdf["k"].astype("Int64").array, "n": n, "set_key": pd.Series(keys, dtype=object),
                                "sketch": pd.Series(sketches, dtype=object)})

    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "doc_id long, n long, set_key binary, sketch binary")


def _banded(classes: DataFrame, s: Settings) -> DataFrame:
    """rep, key: every band of every class, made from its sketch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in row_frames(batches, 1000):
            keys = [band_keys(np.frombuffer(b, dtype=np.uint16), s.bands) for b in pdf["sketch"]]
            yield pd.DataFrame({"rep": np.repeat(pdf["rep"].to_numpy(), s.bands), "key": np.concatenate(keys)})

    return classes.select("rep", "sketch").mapInPandas(run, "rep long, key long")


def _close(x: int, size: np.ndarray, sketch: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The rows after ``x`` that may reach the threshold with it, and their estimates."""
    y = np.arange(x + 1, len(size))
    y = y[np.minimum(size[y], size[x]) * 100 >= np.maximum(size[y], size[x]) * s.percent]
    guess = estimate((sketch[y] == sketch[x]).mean(axis=1))
    near = guess >= least_estimate(np.maximum(size[y], size[x]).astype(float), s)
    return y[near], guess[near]


def _block_rows(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, bool]:
    pdf = pdf.sort_values("rep", ignore_index=True)
    sketch = np.frombuffer(b"".join(pdf["sketch"]), dtype=np.uint16).reshape(len(pdf), -1)
    return pdf, pdf["block"].to_numpy(), sketch, pdf["i"].iloc[0] == pdf["j"].iloc[0]


def _candidates(rows: DataFrame, s: Settings) -> DataFrame:
    """Of the rows leader, i, j, block, rep, set_key, n, sketch: those with a close other."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, block, sketch, inner = _block_rows(pdf)
        size, keep = pdf["n"].to_numpy(), np.zeros(len(pdf), dtype=bool)
        for x in range(len(pdf) - 1):
            y, _ = _close(x, size, sketch, s)
            y = y if inner else y[block[y] != block[x]]
            if len(y):
                keep[x] = keep[y] = True
        return pdf.loc[keep, ["leader", "i", "j", "block", "rep", "set_key", "n", "sketch"]]

    return rows.groupBy("leader", "i", "j").applyInPandas(
        run, "leader long, i int, j int, block int, rep long, set_key binary, n long, sketch binary")


def _links(rows: DataFrame, s: Settings) -> DataFrame:
    """u, v: links that join all that the full sets join inside each group."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, block, sketch, inner = _block_rows(pdf)
        size, rep = pdf["n"].to_numpy(), pdf["rep"].to_numpy()
        sets = [np.frombuffer(h, dtype=np.uint64) for h in pdf["hashes"]]
        found = []
        for x in range(len(pdf) - 1):
            y, guess = _close(x, size, sketch, s)
            if not inner:
                y, guess = y[block[y] != block[x]], guess[block[y] != block[x]]
            found.append((guess, np.full(len(y), x), y))
        if not found:
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        guess, xs, ys = (np.concatenate(c) for c in zip(*found))
        root, out = list(range(len(pdf))), []
        for k in np.argsort(-guess, kind="stable"):
            x, y = int(xs[k]), int(ys[k])
            a, b = x, y
            while root[a] != a:
                root[a] = a = root[root[a]]
            while root[b] != b:
                root[b] = b = root[root[b]]
            if a == b:
                continue
            both = np.sort(np.concatenate((sets[x], sets[y])), kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            if 100 * shared >= s.percent * (len(both) - shared):
                root[max(a, b)] = min(a, b)
                out.append((rep[x], rep[y]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return rows.groupBy("leader", "i", "j").applyInPandas(run, "u long, v long")


def _full_sets(docs: DataFrame, wanted: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    """rep, hashes of the ``wanted`` classes (rep, set_key; sent to every task where they are few).
    Where a doc_id is on rows of several texts, the class's own set is the one with its
    digest; rows that repeat count once. The sets are shuffled by rep once, for that and for
    the join with what they are compared in."""
    few = wanted.count() <= BROADCAST_IDS  # else the texts of all documents would be shuffled for a few
    sent = F.broadcast if few else (lambda df: df)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in row_frames(batches, 1000):
            sets = [shingle_set(t, s.shingle) for t in pdf["t"]]
            keys = [hashlib.blake2b(h.tobytes(), digest_size=16).digest() for h in sets]
            yield pd.DataFrame({"rep": pdf["k"].array, "set_key": pd.Series(keys, dtype=object),
                                "hashes": pd.Series([h.tobytes() for h in sets], dtype=object)})

    texts = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))
    texts = texts.join(sent(wanted.select(F.col("rep").alias("k"))), "k", "left_semi")
    sets = texts.mapInPandas(run, "rep long, set_key binary, hashes binary").join(sent(wanted), ["rep", "set_key"], "left_semi")
    return sets.dropDuplicates(["rep"]).select("rep", "hashes")


def near_duplicates(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable, itself included)
    and kept (doc_id = component_id) of every row."""
    marked = staged(document_sketches(docs, s, id_col, text_col), "sketches")
    classes = staged(marked.filter("set_key is not null and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    banded = _banded(classes, s)
    shared = banded.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("size")).filter("size > 1").drop("size")
    pairs = banded.join(shared, "key").select("leader", "rep").distinct()
    groups = staged(pairs.join(classes.select("rep", "set_key", "n", "sketch"), "rep"), "groups")
    # blocks of the groups larger than one; few beside the groups' rows, which then needn't be shuffled for them
    large = staged(groups.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("blocks > 1"), "large-groups")
    if large.count() <= BROADCAST_IDS:
        large = F.broadcast(large)
    rows = (groups.join(large, "leader", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
                  .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                  .select("leader", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                          "block", "rep", "set_key", "n", "sketch"))
    # block pairs of one large group go to tasks of their own
    near = staged(_candidates(rows.repartition("leader", "i", "j"), s), "near")
    wanted = staged(near.select("rep", "set_key").distinct(), "wanted")
    sets = _full_sets(docs, wanted, s, id_col, text_col)
    links = staged(_links(near.drop("set_key").join(sets, "rep"), s), "links")
    labels = components(links)
    of_set = (classes.select("set_key", "rep").join(labels, F.col("rep") == F.col("node"), "left")
                     .select("set_key", F.coalesce("component", "rep").alias("component")))
    out = marked.select("doc_id", "n", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      (F.col("doc_id") == component).alias("kept"))
