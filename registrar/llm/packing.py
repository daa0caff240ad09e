"""Best-fit packing of tokenised documents by minimum bin slack.

A document's ids are its text's byte-level BPE ids and an end id. A document
longer than the capacity is cut into pieces of exactly the capacity; only the first
may be shorter. Bins are planned on the number of pieces per length, at most as many
numbers as the capacity whatever the rows: the longest length left opens a bin, a
bitset subset-sum over the lengths left finds the fullest feasible combination, and it
is taken as many times as the lengths last. Every piece is numbered within its length
(its number in its partition and the partitions' counts before it), and the number says
its bin and offset, so no task holds more than a partition's rows of a length.

Defined results: a null text counts as empty and is one piece holding the end id;
repeated rows are packed once each; a null doc_id stays null; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrar.llm.bpe import MARKS, MEMO, PATTERN, Memo, byte_symbols
from registrar.llm.common import staged

CAPACITY = 2048
END_ID = 0
#: Without effect since bins are planned on lengths; kept for callers that set it.
GROUP_ROWS = 8192
#: Runs of white space from this length on are cut by the pattern's rule, not by the pattern,
#: whose look-ahead takes as many steps back as the run is long.
LONG_BLANK = 10_000
_LONG_BLANK = regex.compile(rf"\s{{{LONG_BLANK}}}\s*")


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes. The vocabulary file's merges are
    in the order of their ids, so its ids serve as ranks of ``tiktoken``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], byte_symbols()
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if any(b <= a for a, b in zip(made, made[1:])):
            raise ValueError(f"{path}: the merges aren't in the order of their ids")
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(symbols[c] for c in t): i for t, i in vocab.items() if t not in self.added}
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.added)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.pieces = Memo(self.piece, MEMO // 2)
        self.words = Memo(self.word, MEMO // 2)

    def piece(self, text: str) -> bytes:
        return array("I", self.bpe.encode_ordinary(text)).tobytes()

    def word(self, chunk: str) -> bytes | None:
        """Ids of a blank and a chunk between blanks; None where the pattern may
        look beyond the chunk."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        core = chunk.rstrip(MARKS)
        if core.isalpha() and len(core) < len(chunk):
            return self.words[core] + self.pieces[chunk[len(core):]]  # a word is kept once, with or without marks
        return self.piece(" " + chunk)

    def long_blanks(self, text: str) -> bytes:
        """Ids of a text with long runs of white space: a run is one piece, without its last
        character if something that isn't white space or added follows."""
        out, parts = [], self.cut.split(text) if self.added else [text]
        for part in parts:
            if part in self.added:
                out.append(array("I", [self.added[part]]).tobytes())
                continue
            at = 0
            for run in _LONG_BLANK.finditer(part):
                end = run.end() - (run.end() < len(part))
                out.append(self.encode(part[at:run.start()]))
                out.append(array("I", self.bpe._encode_single_piece(part[run.start():end])).tobytes())
                at = end
            out.append(self.encode(part[at:]) if at < len(part) else b"")
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if len(text) >= LONG_BLANK and _LONG_BLANK.search(text):
            return self.long_blanks(text)
        if any(t in text for t in self.added):
            return array("I", self.bpe.encode(text, allowed_special="all")).tobytes()
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return self.piece(text)
        try:
            return self.piece(first) + b"".join(map(self.words.__getitem__, rest))
        except TypeError:  # a None: blanks beside other white space
            return self.piece(text)


_LOADED: dict[str, Encoder] = {}


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _LOADED:
            _LOADED[path] = Encoder(path)
        encoder, end = _LOADED[path], int(end_id).to_bytes(4, "little")
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["k"], pdf["t"]):
                ids = encoder.encode(t or "") + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((k, p, a, b - a, zlib.crc32(ids[4 * a:4 * b])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan_bins(left: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins of lengths by minimum bin slack from the number of pieces of each length
    (``left[n]``): combinations, longest first, and how many bins each fills. The fullest
    combination stays the fullest while the lengths left allow it. Bit s of ``reach``
    says that some of the lengths looked at add up to s."""
    left = list(left)
    order = [n for n in range(capacity, 0, -1) if left[n]]
    bins = []
    while order:
        longest = order[0]
        left[longest] -= 1
        room = capacity - longest
        mask, reach, steps = (1 << (room + 1)) - 1, 1, []
        for n in order:
            if reach >> room:
                break
            if n > room:
                continue
            for _ in range(min(left[n], room // n)):
                wider = (reach | reach << n) & mask
                if wider == reach:
                    break
                steps.append((n, reach))
                reach = wider
                if reach >> room:
                    break
        left[longest] += 1
        chosen, at = [longest], reach.bit_length() - 1
        for n, before in reversed(steps):
            if not before >> at & 1:
                chosen.append(n)
                at -= n
        uses = Counter(chosen)
        times = min(left[n] // u for n, u in uses.items())
        for n, u in uses.items():
            left[n] -= u * times
        bins.append((sorted(chosen, reverse=True), times))
        order = [n for n in order if left[n]] if any(not left[n] for n in uses) else order
    return bins


def fill_bins(lengths: list[int], capacity: int) -> list[list[int]]:
    """The planned bins one by one."""
    counts = np.bincount(np.asarray(lengths, dtype=np.int64), minlength=capacity + 1).tolist()
    return [list(chosen) for chosen, times in plan_bins(counts, capacity) for _ in range(times)]


def places(bins: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """Per length, rows of: first number of the length, first bin, pieces of the length in
    a bin, offset of the first of them."""
    out: dict[int, list] = {}
    used: Counter = Counter()
    at = 0
    for chosen, times in bins:
        offset = 0
        for n, u in Counter(chosen).items():
            out.setdefault(n, []).append((used[n], at, u, offset))
            used[n] += u * times
            offset += n * u
        at += times
    return {n: np.array(rows, dtype=np.int64) for n, rows in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with sequence_id and offset."""
    spark = pieces.sparkSession

    def number(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """The number among the partition's pieces of the length."""
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for lengths in batches:
            out = seen[lengths.to_numpy()] + lengths.groupby(lengths).cumcount().to_numpy()
            seen += np.bincount(lengths.to_numpy(), minlength=capacity + 1)
            yield pd.Series(out)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    nth = F.pandas_udf(number, "long").asNondeterministic()
    rows = staged(pieces.select(*names, F.spark_partition_id().alias("part"), nth("length").alias("nth")), "pieces")
    per_part = staged(rows.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = [0] * (capacity + 1)
    for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[r["length"]] = r["n"]
    shared = spark.sparkContext.broadcast(places(plan_bins(counts, capacity)))

    def place(length: pd.Series, k: pd.Series) -> pd.DataFrame:
        length, k = length.to_numpy(), k.to_numpy()
        out = np.zeros((2, len(k)), dtype=np.int64)
        order = np.argsort(length, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if len(own):
                n = int(length[own[0]])
                table = shared.value[n]
                first, at, uses, offset = table[np.searchsorted(table[:, 0], k[own], side="right") - 1].T
                out[0, own] = at + (k[own] - first) // uses
                out[1, own] = offset + (k[own] - first) % uses * n
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = F.pandas_udf(place, "sequence_id long, offset long")("length", F.col("first") + F.col("nth"))
    return rows.join(first, ["part", "length"]).select(*names, placed.alias("at")).select(*names, "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack(cut_pieces(docs, path, capacity, end_id, id_col, text_col), capacity)
