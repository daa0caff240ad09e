"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of at most ``step`` + ``overlap`` code points is encoded as it is. A longer one is
cut into chunks that begin every ``step`` code points and reach ``overlap`` beyond the
next one's beginning; chunks are dealt over the cluster one by one and encoded with the
byte offsets of their tokens. Two neighbours are spliced at a place inside their overlap
where both encodings have a boundary and which is proven not to depend on what either of
them didn't see:

* a boundary between two pieces of the split pattern in both encodings. Pieces are found
  from left to right and look one character ahead, so the left encoding is right up to
  it, and the right encoding, once it begins a piece where the text does, is right from it
  on. Boundaries within reach of a cut added token or of the look-ahead don't count;
* else, where the overlap lies in one run of letters, digits, marks or white space, the
  end of a token that both have at the same bytes, in the left's last and the right's
  first piece. A sequence of tokens is the byte-pair encoding of its text exactly
  if each two neighbours are that of theirs, and each two neighbours of the spliced
  sequence are neighbours in one of the two.

Texts with a junction that finds no such place are cut again with longer chunks and wider
overlaps (``widen`` times), at last into one chunk, so every count ends exact. The
tokenizer is the ``tokenizers`` library with the file's own settings, without truncation
or padding, and with its default for special strings inside a text; short texts of a file whose
merges are in the order of their ids go through the packing operator's encoder, which gives the
library's ids.

Only texts longer than a chunk are shuffled, chunk by chunk; counts of equal texts are
taken by their digest, so neither a huge text nor many copies of it are one task's work.

Defined results: a null text counts as empty and has 0 bytes and tokens; repeated rows give
repeated results; a null doc_id stays null; an empty table gives no rows; other columns are
ignored. Files of ``sentencepiece`` have no pieces: their texts are encoded whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm import packing
from registrar.llm.bpe import byte_symbols
from registrar.llm.common import row_frames, staged

STEP = 16_384
OVERLAP = 256
WIDEN = 8
LIMIT = 1024
#: Characters that the split pattern looks ahead, with the one it looks from.
AHEAD = 2
#: One class of the byte-level split pattern.
RUN = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+")


class Encoder:
    """Encodings of the ``tokenizers`` library with byte offsets."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["pre_tokenizer"] is None or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] is not None:
            raise ValueError(f"{path}: not a byte-level file without a normalizer")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in what is beside them")
        self.tokenizer = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None, "post_processor": None}))
        symbols = byte_symbols()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.margin = AHEAD + max(map(len, added), default=0)
        try:  # the same ids, words that repeat are encoded once
            self.short = packing.Encoder(path)
        except ValueError:
            self.short = None
        self.width = np.zeros(1 + max([*vocab.values(), *added.values()]), dtype=np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token) if all(c in symbols for c in token) else len(token.encode())
        for token, i in added.items():
            self.width[i] = len(token.encode())

    def sizes(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        return [len(self.short.encode(t)) // 4 for t in texts] if self.short else self.sizes(texts)

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, first bytes (one more: the end) and pieces of a chunk's tokens."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(e.ids, dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(self.width[ids])])
        if starts[-1] != len(text.encode()):
            raise ValueError("the tokens' bytes aren't the text's")
        return ids, starts, np.array(e.word_ids, dtype=np.int64)


class Whole:
    """Counts of a ``sentencepiece`` model."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)] if texts else []


_LOADED: dict[str, Encoder | Whole] = {}


def encoder(path: str) -> Encoder | Whole:
    """The file's encoder, made once by each Python process."""
    if path not in _LOADED:
        _LOADED[path] = Whole(path) if path.endswith(".model") else Encoder(path)
    return _LOADED[path]


def window(ids: np.ndarray, starts: np.ndarray, pieces: np.ndarray, lo: int, hi: int) -> dict:
    """The tokens that begin at bytes ``lo`` to ``hi`` of a chunk, for the splice: first byte
    from ``lo`` on, number in the chunk, width, id, and whether a piece begins there. The
    chunk's end counts as a token of no width."""
    at = np.flatnonzero((starts >= lo) & (starts <= hi))
    ends = np.concatenate([starts[1:], starts[-1:]])
    opens = np.concatenate([[True], pieces[1:] != pieces[:-1], [True]]) if len(pieces) else np.array([True])
    return {"at": starts[at] - lo, "nth": at, "width": (ends - starts)[at], "id": np.concatenate([ids, [-1]])[at], "opens": opens[at]}


def splice(left: dict, right: dict, text: str, margin: int) -> tuple[int, int] | None:
    """The numbers of the tokens (left's, right's) that begin at a proven common boundary
    of the overlap ``text``; None without one."""
    if len(text) <= margin:  # an added token may reach over it
        return None
    place = {int(b): i for i, b in enumerate(left["at"])}
    common = [(place[int(b)], j) for j, b in enumerate(right["at"]) if int(b) in place]
    reach = len(text[:-margin].encode())
    for i, j in common:
        if left["at"][i] <= reach and left["opens"][i] and right["opens"][j]:
            return int(left["nth"][i]), int(right["nth"][j])
    if RUN.fullmatch(text) is None:
        return None
    last = max((i for i, o in enumerate(left["opens"]) if o and left["width"][i]), default=0)
    second = min((j for j, o in enumerate(right["opens"]) if o and right["nth"][j]), default=len(right["at"]))
    for i, j in common:
        if i >= last and j < second and left["width"][i] == right["width"][j] > 0 and left["id"][i] == right["id"][j]:
            return int(left["nth"][i]) + 1, int(right["nth"][j]) + 1
    return None


FIELDS = {"at": "array<long>", "nth": "array<long>", "width": "array<long>", "id": "array<long>", "opens": "array<boolean>"}
FRAME = 64


def _chunk_counts(long: DataFrame, path: str, step: int, overlap: int) -> DataFrame:
    """``long``: key, text, one row per text or more. Gives key, n_tokens (null where a
    junction isn't proven)."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for pdf in row_frames(batches, 1):
            key, text = pdf["key"].iloc[0], pdf["text"].iloc[0]
            for k, at in enumerate(range(0, max(1, len(text) - overlap), step)):
                rows.append((key, k, at + step + overlap >= len(text), text[at:at + step + overlap]))
                if len(rows) == FRAME:
                    yield pd.DataFrame(rows, columns=["key", "chunk", "final", "text"])
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["key", "chunk", "final", "text"])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = encoder(path)
        for pdf in row_frames(batches, FRAME):
            rows = []
            for key, chunk, final, text in zip(pdf["key"], pdf["chunk"], pdf["final"], pdf["text"]):
                ids, starts, pieces = v.tokens(text)
                head = window(ids, starts, pieces, 0, len(text[:overlap].encode()) if chunk else -1)
                tail = window(ids, starts, pieces, len(text[:step].encode()), -1 if final else int(starts[-1]))
                rows.append({"key": key, "chunk": chunk, "final": final, "n": len(ids), "shared": "" if final else text[step:]}
                            | {f"h_{k}": a.tolist() for k, a in head.items()} | {f"t_{k}": a.tolist() for k, a in tail.items()})
            yield pd.DataFrame(rows)

    def join_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        margin = encoder(path).margin
        for pdf in row_frames(batches, FRAME):
            found = []
            for row in pdf.to_dict("records"):
                at = splice({k: row[f"t_{k}"] for k in FIELDS}, {k: row[f"h_{k}"] for k in FIELDS}, row["shared"], margin)
                found.append(None if at is None else at[0] - at[1])
            yield pd.DataFrame({"key": pdf["key"], "gain": pd.array(found, dtype="Int64")})

    spark = long.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunks = long.mapInPandas(cut, "key string, chunk long, final boolean, text string").repartition(parts)
    schema = "key string, chunk long, final boolean, n long, shared string, " + ", ".join(f"{p}_{k} {kind}" for p in "ht" for k, kind in FIELDS.items())
    encoded = staged(chunks.mapInPandas(encode, schema), "token-chunks").dropDuplicates(["key", "chunk"])
    tails = encoded.filter("not final").select("key", (F.col("chunk") + 1).alias("chunk"), "shared", *[f"t_{k}" for k in FIELDS])
    heads = encoded.filter("chunk > 0").select("key", "chunk", *[f"h_{k}" for k in FIELDS])
    gains = tails.join(heads, ["key", "chunk"]).mapInPandas(join_up, "key string, gain long")
    ends = encoded.filter("final").select("key", F.col("n").alias("gain"))
    total = gains.unionByName(ends).groupBy("key").agg(F.sum("gain").alias("n"), F.bool_or(F.col("gain").isNull()).alias("open"))
    return total.select("key", F.when(~F.col("open"), F.col("n")).alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, step: int = STEP, overlap: int = OVERLAP, widen: int = WIDEN,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text."""
    if not 0 < overlap < step or widen < 2:
        raise ValueError("an overlap is shorter than a step, and widening makes both longer")
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = encoder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, FRAME):
                part = batch.slice(i, FRAME)
                n = pa.array(v.counts(part.column("t").to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("n"), n], ["k", "n_bytes", "n_tokens"])

    fits = F.lit(path.endswith(".model")) | (F.char_length("t") <= step + overlap)
    sized = rows.select("k", "t", F.octet_length("t").cast("long").alias("n"), fits.alias("fits"))
    out = sized.filter("fits").drop("fits").mapInArrow(whole, "k long, n_bytes long, n_tokens long")
    if not path.endswith(".model"):
        out = out.unionByName(_long_counts(sized.filter("not fits"), path, step, overlap, widen))
    return out.select(F.col("k").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _long_counts(sized: DataFrame, path: str, step: int, overlap: int, widen: int) -> DataFrame:
    """k, n_bytes, n_tokens of the texts that are longer than a chunk."""
    long = sized.select("k", F.sha2(F.col("t").cast("binary"), 256).alias("key"), F.col("t").alias("text"), "n")
    todo = long.select("key", "text")
    done = None
    while True:
        now = staged(_chunk_counts(todo, path, step, overlap), "token-counts")
        ready = now.filter("n_tokens is not null")
        done = ready if done is None else done.unionByName(ready)
        left = now.filter("n_tokens is null").select("key")
        if left.isEmpty():
            break
        step, overlap = step * widen, overlap * widen
        todo = long.select("key", "text").join(left, "key", "left_semi")
    return long.select("k", "key", F.col("n").alias("n_bytes")).join(done, "key").drop("key")
