"""Divergence of the sources of every language in the use of its kept terms.

A term is a run of letters A-Z (lower-cased) and characters beyond ASCII. Every language
keeps the terms that occur in enough of its documents. The kept terms, sorted by their UTF-8
bytes, become a minimal acyclic transducer: equal continuations share states, and the outputs
on the way of a term add up to its lexicographic ordinal. The texts are streamed through it
byte by byte, all words of a block at once, and counted anew per source by ordinal; ordinals
also break the ties between terms.

On Spark: document frequencies are a partly aggregated ``groupBy``; ordinals are dealt by range;
a transducer holds at most ``SHARD`` consecutive terms and is built by a task of its own.
Transducers are sent to the executors in passes of at most ``PASS_BYTES`` (measured before they
are sent), and each pass reads all texts, so a vocabulary of any size is counted whole. The
sums over pairs of sources are taken in blocks of terms and blocks of sources, with one row of
each source in every block, and added up; no task holds a language's counts.

Shares are exact: p = 1 + floor(10^9 (count + 5) / (N + 5 V)), computed in integers.

Defined results: null texts, languages and sources count as empty strings; each row is a document
of its own, whatever its id; a source without kept terms is a group with N = 0; a language
without kept terms has pairs of value 0 and no terms; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrar.functions.sequence import running_count
from registrar.llm.common import staged

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_DOCS = 30
SMOOTH = 5
ONE = 1_000_000_000
TOP = 50
SHARD = 131_072
PASS_BYTES = 32 << 20
BLOCK_BYTES = 4 << 20
FLUSH = 1_000_000
TERM_BLOCK = 256
SOURCE_BLOCK = 256

#: Bytes of a text as the transducer reads them: 0 between terms, capital letters small.
_READ = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256))


class Transducer:
    """Minimal acyclic transducer from byte strings to their places in sorted order. Arcs are
    found by (state, byte) in an open-addressing table."""

    def __init__(self, arcs: np.ndarray, final: np.ndarray, root: int, base: int = 0):
        """``arcs``: rows of state, byte, next state, output."""
        self.final, self.root, self.base = final, root, base
        bits = max(4, int(4 * len(arcs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.full(1 << bits, -1, dtype=np.int64)
        self.target = np.zeros(1 << bits, dtype=np.int64)
        self.output = np.zeros(1 << bits, dtype=np.int64)
        key = arcs[:, 0] << 8 | arcs[:, 1]
        left, slot = np.arange(len(arcs)), self._slot(key)
        while len(left):
            free = self.key[slot] == -1
            self.key[slot[free]] = key[left[free]]  # of several for one slot, one stays
            placed = self.key[slot] == key[left]
            self.target[slot[placed]], self.output[slot[placed]] = arcs[left[placed], 2], arcs[left[placed], 3]
            left, slot = left[~placed], (slot[~placed] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    @classmethod
    def build(cls, terms: list[bytes], base: int = 0) -> Transducer:
        return cls(*compile_terms(terms), base)

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots of the arcs taken, and which of them there are."""
        key = state << 8 | byte
        slot = self._slot(key)
        there = self.key[slot]
        unsure = np.flatnonzero((there != key) & (there != -1))
        while len(unsure):
            slot[unsure] = (slot[unsure] + 1) & self.mask
            there[unsure] = now = self.key[slot[unsure]]
            unsure = unsure[(now != key[unsure]) & (now != -1)]
        return slot, there == key

    def read(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Streams the words that begin at ``starts`` through the states, one byte of all at
        a time. ``data`` ends with a 0. Gives the places (in ``starts``) of the accepted words
        and their ordinals."""
        word, at = np.arange(len(starts)), starts.copy()
        state, total = np.full(len(starts), self.root, dtype=np.int64), np.full(len(starts), self.base, dtype=np.int64)
        words, ordinals = [], []
        while len(word):
            byte = data[at]
            ended = byte == 0
            if ended.any():
                done = ended & self.final[state]
                words.append(word[done])
                ordinals.append(total[done])
                on = ~ended
                word, at, state, total, byte = word[on], at[on], state[on], total[on], byte[on]
            slot, there = self.step(state, byte.astype(np.int64))
            slot = slot[there]
            word, at = word[there], at[there] + 1
            state, total = self.target[slot], total[there] + self.output[slot]
        if not words:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(words), np.concatenate(ordinals)


def compile_terms(terms: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Arcs, final states and root of the minimal transducer of sorted, different terms. When
    a term leaves the way of the one before, the states behind the fork can't change any more;
    each becomes one with an equal state that is there already, or a new one."""
    known: dict[tuple, int] = {}
    reach: list[int] = []   # accepted continuations per state
    final: list[bool] = []
    arcs: list[tuple[int, int, int, int]] = []

    def freeze(node: list) -> int:
        is_final, out = node
        key = (is_final, *out)
        state = known.get(key)
        if state is None:
            state = known[key] = len(final)
            skipped = int(is_final)
            for byte, target in out:
                arcs.append((state, byte, target, skipped))
                skipped += reach[target]
            reach.append(skipped)
            final.append(is_final)
        return state

    way: list[list] = [[False, []]]
    last = b""
    for term in terms:
        same = 0
        while same < min(len(last), len(term)) and last[same] == term[same]:
            same += 1
        for depth in range(len(last), same, -1):
            way[depth - 1][1].append((last[depth - 1], freeze(way.pop())))
        way.extend([False, []] for _ in range(len(term) - same))
        way[-1][0] = True
        last = term
    for depth in range(len(last), 0, -1):
        way[depth - 1][1].append((last[depth - 1], freeze(way.pop())))
    root = freeze(way[0])
    return np.array(arcs, dtype=np.int64).reshape(-1, 4), np.array(final, dtype=bool), root


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, ord: the terms in at least ``min_docs`` documents of their language, numbered
    from 0 in the order of their UTF-8 bytes. ``docs``: lang, source, text without nulls."""
    words = F.array_distinct(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0)))
    found = docs.select("lang", F.explode(words).alias("term")).groupBy("lang", "term").agg(F.count("*").alias("docs"))
    kept = staged(found.filter(F.col("docs") >= min_docs).select("lang", "term"), "kept-terms")
    return staged(running_count(kept, ["lang"], ["term"], F.lit(True), "ord").select("lang", "term", "ord"), "term-ordinals")


def transducers(terms: DataFrame, shard: int = SHARD) -> DataFrame:
    """lang, shard, base (first ordinal), first and last term, arcs, final, root: transducers of
    at most ``shard`` consecutive terms."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        encoded = [t.encode() for t in pdf["term"]]
        arcs, final, root = compile_terms(encoded)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "shard": [pdf["shard"].iloc[0]], "base": [pdf["ord"].iloc[0]], "first": [encoded[0]],
                             "last": [encoded[-1]], "arcs": [arcs.tobytes()], "final": [final.tobytes()], "root": [root]})

    groups = terms.withColumn("shard", F.floor(F.col("ord") / shard)).groupBy("lang", "shard")
    return groups.applyInPandas(build, "lang string, shard long, base long, first binary, last binary, arcs binary, final binary, root long")


def _lead(term: bytes) -> int:
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")


def _leads(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The first eight bytes of each word as a number that sorts like them."""
    out, live = np.zeros(len(starts), dtype=np.uint64), np.ones(len(starts), dtype=bool)
    for i in range(8):
        byte = data[np.minimum(starts + i, len(data) - 1)]
        live &= byte != 0
        out = out << np.uint64(8) | np.where(live, byte, 0).astype(np.uint64)
    return out


class Counter:
    """Occurrences by (lang, source) and ordinal of the texts that it is given."""

    def __init__(self, shards: list[dict]):
        self.by_lang: dict[str, list] = {}
        for s in shards:
            arcs = np.frombuffer(s["arcs"], dtype=np.int64).reshape(-1, 4)
            t = Transducer(arcs, np.frombuffer(s["final"], dtype=bool), s["root"], s["base"])
            self.by_lang.setdefault(s["lang"], []).append((np.uint64(_lead(s["first"])), np.uint64(_lead(s["last"])), t))
        self.groups: dict[tuple[str, str], int] = {}
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, lang: str, texts: list[tuple[str, bytes]]) -> None:
        """``texts``: source and UTF-8 bytes, all of one language with a transducer."""
        data = np.frombuffer(b"\0".join([t.translate(_READ) for _, t in texts]) + b"\0", dtype=np.uint8)
        ids = np.array([self.groups.setdefault((lang, source), len(self.groups)) for source, _ in texts], dtype=np.int64)
        begins = np.cumsum([0] + [len(t) + 1 for _, t in texts[:-1]])
        starts = np.flatnonzero((data != 0) & (np.concatenate([[0], data[:-1]]) == 0))
        group = ids[np.searchsorted(begins, starts, side="right") - 1]
        shards = self.by_lang[lang]
        leads = _leads(data, starts) if len(shards) > 1 else None
        for first, last, t in shards:
            mine = np.flatnonzero((leads >= first) & (leads <= last)) if leads is not None else np.arange(len(starts))
            word, ordinal = t.read(data, starts[mine])
            keys, counts = np.unique(group[mine[word]] << 40 | ordinal, return_counts=True)
            self.found.append((keys, counts))
            self.size += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in self.found]), return_inverse=True)
        counts = np.zeros(len(keys), dtype=np.int64)
        np.add.at(counts, where, np.concatenate([c for _, c in self.found]))
        return keys, counts

    def flush(self, least: int) -> Iterator[pd.DataFrame]:
        """Rows lang, source, ord, n, where more than ``least`` are left after merging."""
        if not self.found:
            return
        keys, counts = self.merged()
        if len(keys) <= least:
            self.found, self.size = [(keys, counts)], len(keys)
            return
        names = list(self.groups)
        gid = keys >> 40
        for g in np.unique(gid):
            mine = gid == g
            yield pd.DataFrame({"lang": names[g][0], "source": names[g][1], "ord": keys[mine] & (1 << 40) - 1, "n": counts[mine]})
        self.found, self.size, self.groups = [], 0, {}


def _blocks(text: bytes) -> Iterator[bytes]:
    """A text in blocks of some megabytes, cut between words."""
    while len(text) > 2 * BLOCK_BYTES:
        gap = BLOCK_BYTES
        while gap < len(text) and _READ[text[gap]]:
            gap += 1
        yield text[:gap]
        text = text[gap:]
    yield text


def recount(docs: DataFrame, terms: DataFrame, shard: int = SHARD, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """lang, source, ord, n: occurrences of the kept terms, by streaming all texts through the
    transducers, as many of which go in one pass as ``pass_bytes`` allow (one at least)."""
    spark = docs.sparkSession
    built = staged(transducers(terms, shard), "transducers")
    sizes = built.select("lang", "shard", (F.octet_length("arcs") + F.octet_length("final")).alias("size")).orderBy("lang", "shard").collect()  # a row per SHARD terms
    passes: list[list] = []
    room = 0
    for r in sizes:
        if not passes or r["size"] > room:
            passes.append([])
            room = pass_bytes
        passes[-1].append(r)
        room -= r["size"]
    out = None
    for chosen in passes:
        lo, hi = (F.struct(F.lit(r["lang"]).alias("lang"), F.lit(r["shard"]).alias("shard")) for r in (chosen[0], chosen[-1]))
        shards = [r.asDict() for r in built.filter(F.struct("lang", "shard").between(lo, hi)).collect()]  # at most pass_bytes, or one shard
        shared = spark.sparkContext.broadcast([{k: bytes(v) if isinstance(v, bytearray) else v for k, v in s.items()} for s in shards])

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            counter = Counter(shared.value)
            for pdf in batches:
                for lang, own in pdf.groupby("lang", sort=False):
                    if lang not in counter.by_lang:
                        continue
                    todo, size = [], 0
                    for source, text in zip(own["source"], own["text"]):
                        for block in _blocks(text.encode()):
                            todo.append((source, block))
                            size += len(block)
                            if size >= BLOCK_BYTES:
                                counter.add(lang, todo)
                                todo, size = [], 0
                    if todo:
                        counter.add(lang, todo)
                if counter.size > FLUSH:
                    yield from counter.flush(FLUSH // 2)
            yield from counter.flush(0)

        part = docs.select("lang", "source", "text").mapInPandas(run, "lang string, source string, ord long, n long")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "lang string, source string, ord long, n long")
    return staged(out.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n")), "term-counts")


def _share(count: str, total: str, kept: str):
    """1 + floor(10^9 (count + 5) / (total + 5 kept)) in integers."""
    return F.expr(f"cast(1 + (cast({count} + {SMOOTH} as decimal(20,0)) * {ONE}) div cast({total} + {SMOOTH} * {kept} as decimal(20,0)) as long)")


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same, with ``total`` = N + 5 V, by long division, three digits at a time."""
    whole, rest = np.divmod(count + SMOOTH, total)
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // total, rest % total
    return 1 + whole


def pair_sums(counts: DataFrame, groups: DataFrame, term_block: int = TERM_BLOCK, source_block: int = SOURCE_BLOCK) -> DataFrame:
    """lang, a, b, value: the summed differences of the shares of each two sources (numbers a < b).
    ``groups``: lang, source, number, n_sources, total, kept."""
    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        marks = pdf[pdf["place"] < 0].sort_values("number")
        cells = pdf[pdf["place"] >= 0]
        number = marks["number"].to_numpy()
        total = (marks["total"] + SMOOTH * marks["kept"]).to_numpy()
        width = min(term_block, int(marks["kept"].iloc[0]) - int(pdf["block"].iloc[0]) * term_block)
        p = np.repeat(shares(np.zeros(len(number), dtype=np.int64), total)[:, None], width, axis=1)
        row = np.searchsorted(number, cells["number"].to_numpy())
        p[row, cells["place"].to_numpy()] = shares(cells["n"].to_numpy(), total[row])
        low, high = number // source_block == pdf["low"].iloc[0], number // source_block == pdf["high"].iloc[0]
        out = []
        for i in np.flatnonzero(low):
            js = np.flatnonzero(high & (number > number[i]))
            out.append(pd.DataFrame({"lang": pdf["lang"].iloc[0], "a": number[i], "b": number[js], "value": np.abs(p[js] - p[i]).sum(axis=1)}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})

    marks = (groups.filter("kept > 0")
                   .select("lang", F.explode(F.expr(f"sequence(0L, (kept - 1) div {term_block})")).alias("block"), F.lit(-1).cast("long").alias("place"),
                           F.lit(0).cast("long").alias("n"), "number", "total", "kept", "n_sources"))
    cells = (counts.join(groups.select("lang", "source", "number", "n_sources"), ["lang", "source"])
                   .select("lang", F.expr(f"ord div {term_block}").alias("block"), F.expr(f"ord % {term_block}").alias("place"), "n", "number",
                           F.lit(None).cast("long").alias("total"), F.lit(None).cast("long").alias("kept"), "n_sources"))
    other = F.explode(F.expr(f"sequence(0L, (n_sources - 1) div {source_block})"))
    own = F.expr(f"number div {source_block}")
    rows = marks.unionByName(cells).withColumn("other", other).withColumn("low", F.least(own, "other")).withColumn("high", F.greatest(own, "other"))
    parts = rows.drop("other", "n_sources").groupBy("lang", "block", "low", "high").applyInPandas(add_up, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, shard: int = SHARD, pass_bytes: int = PASS_BYTES,
          text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: for each (lang, source) group, ``pair`` rows for every
    other source of the language and ``term`` rows for its most overused terms."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    terms = kept_terms(rows, min_docs)
    counts = recount(rows, terms, shard, pass_bytes)

    by_lang = Window.partitionBy("lang")
    named = rows.groupBy("lang", "source").agg(F.count("*").alias("rows")).drop("rows")
    named = named.select("*", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("number"), F.count("*").over(by_lang).alias("n_sources"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = named.join(sums, ["lang", "source"], "left").join(kept, "lang", "left").na.fill(0, ["total", "kept"])
    groups = staged(groups, "term-groups")

    far = pair_sums(counts, groups)
    pairs = groups.select("lang", "source", "number", F.explode(F.expr("sequence(0L, n_sources - 1)")).alias("other")).filter("number != other")
    pairs = (pairs.withColumn("a", F.least("number", "other")).withColumn("b", F.greatest("number", "other"))
                  .join(far, ["lang", "a", "b"], "left")
                  .join(groups.select("lang", F.col("number").alias("other"), F.col("source").alias("item")), ["lang", "other"])
                  .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    whole = counts.groupBy("lang", "ord").agg(F.sum("n").alias("all"))
    sizes = groups.groupBy("lang").agg(F.sum("total").alias("all_total"))
    used = (counts.join(whole, ["lang", "ord"]).join(groups.select("lang", "source", "total", "kept"), ["lang", "source"]).join(sizes, "lang")
                  .select("lang", "source", "ord", (_share("n", "total", "kept") - _share("`all`", "all_total", "kept")).alias("value")).filter("value > 0"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ord")
    best = used.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    best = best.join(terms, ["lang", "ord"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(best)
