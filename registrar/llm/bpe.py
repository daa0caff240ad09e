"""Byte-level BPE encoding and decoding from a public tokenizer file.

A text is cut at the file's added tokens, then by the byte-level pattern into
pieces. Each piece is encoded by a priority queue of merge ranks over a doubly
linked list of symbols: the lowest rank is popped, entries whose pair has changed
since are skipped, and a merge pushes the pairs with its new neighbours. Decoding
joins the vocabulary's byte strings and reads them as UTF-8 (bad sequences become
U+FFFD).

Pieces repeat, so each Python worker keeps a bounded memo of encoded pieces
(``Memo``; bounded by its characters and emptied when full; long pieces aren't kept).
Texts are worked on whole, one at a time.

Defined results: a null text counts as empty and has 0 tokens; repeated rows give
repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the split pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: ASCII marks: a word with such marks behind it is two pieces.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters that a memo holds, and of the longest piece that it keeps.
MEMO = 8_000_000
KEPT = 128


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 stands for itself, the others for 256, 257, ... in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memo(dict):
    """Encoded chunks of a text, computed when first asked for. It holds ``limit``
    characters of chunks at most; chunks longer than ``KEPT`` are computed each time."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.held = make, limit, 0

    def __missing__(self, key):
        out = self.make(key)
        if len(key) <= KEPT:
            if self.held > self.limit:
                self.clear()
                self.held = 0
            self[key] = out
            self.held += len(key)
        return out


class Vocabulary:
    """Tokens and merges of a byte-level BPE file (the ``tokenizers`` JSON format)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, symbols = spec["model"], byte_symbols()
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes: dict[int, bytes] = {
            i: bytes(symbols[c] for c in token) for token, i in model["vocab"].items()
            if token not in added and all(c in symbols for c in token)}
        self.bytes |= {i: token.encode() for token, i in added.items()}
        self.byte_id = [model["vocab"][c] for c, _ in sorted(symbols.items(), key=lambda x: x[1])]
        vocab = model["vocab"]
        # a pair of ids as one number -> rank; the rank gives the new id
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(vocab[left] << 32 | vocab[right], rank)
            self.made.append(vocab[left + right])
        self.added = added
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.pattern = regex.compile(PATTERN)
        self.pieces = Memo(self.merge, MEMO)
        self.words = Memo(self.word, MEMO)

    def merge(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece, by merging the lowest rank first, leftmost on ties."""
        byte_id = self.byte_id
        ids: list[int] = [byte_id[b] for b in piece.encode("utf-8", "replace")]
        n, rank_of = len(ids), self.ranks.get
        # a queue entry is rank * n + position; position n is the end of the list
        queue = [r * n + i for i in range(n - 1) if (r := rank_of(ids[i] << 32 | ids[i + 1])) is not None]
        if not queue:
            return tuple(ids)
        after, before, made, pop, push = list(range(1, n + 1)), list(range(-1, n - 1)), self.made, heappop, heappush
        heapify(queue)
        while queue:
            rank, i = divmod(pop(queue), n)
            j = after[i]
            if j == n or (left := ids[i]) < 0 or rank_of(left << 32 | ids[j]) != rank:
                continue  # stale: one of the two was merged since
            ids[i], ids[j] = new, _ = made[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(new << 32 | ids[k])) is not None:
                    push(queue, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank_of(ids[h] << 32 | new)) is not None:
                push(queue, r * n + h)
        return tuple([x for x in ids if x >= 0])

    def word(self, chunk: str) -> tuple[int, ...] | None:
        """Ids of a blank and a chunk between blanks; None if the chunk is empty or
        has white space at an end, so that the pattern may look beyond it."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        core = chunk.rstrip(MARKS)
        if core.isalpha():
            ids = self.pieces[" " + core]
            return ids + self.pieces[chunk[len(core):]] if len(core) < len(chunk) else ids
        return self.plain(" " + chunk)

    def plain(self, text: str) -> tuple[int, ...]:
        out: list[int] = []
        for piece in self.pattern.findall(text):
            out.extend(self.pieces[piece])
        return tuple(out)

    def encode_part(self, text: str) -> list[int]:
        """Ids of a text without added tokens. Between single blanks, the pattern
        never looks past a chunk, so chunks are encoded alone."""
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return list(self.plain(text))
        out = list(self.plain(first))
        words = self.words
        for chunk in rest:
            ids = words[chunk]
            if ids is None:
                return list(self.plain(text))
            out += ids
        return out

    def encode(self, text: str) -> list[int]:
        if self.cut is None or not any(t in text for t in self.added):
            return self.encode_part(text) if text else []
        out: list[int] = []
        for part in self.cut.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out += self.encode_part(part)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The file's vocabulary, read once by each Python process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every whole text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["k"], "ids": [v.encode(t or "") for t in pdf["t"]]})

    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of every row of ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["k"], "text": [v.decode(list(i) if i is not None else []) for i in pdf["i"]]})

    return encoded.select(F.col("doc_id").alias("k"), F.col("ids").alias("i")).mapInPandas(run, "doc_id long, text string")


def round_trip_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes each text, decodes the
    ids, and gives the digests of both in one pass."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path)
        names = {i: str(i) for i in v.bytes}
        for pdf in batches:
            n, ids_hex, text_hex = [], [], []
            for t in pdf["t"]:
                ids = v.encode(t or "")
                n.append(len(ids))
                ids_hex.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                text_hex.append(hashlib.sha256(v.decode(ids).encode()).hexdigest())
            yield pd.DataFrame({"doc_id": pdf["k"], "n_tokens": n, "ids_sha256": ids_hex, "decoded_sha256": text_hex})

    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
