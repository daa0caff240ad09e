"""Divergence audit, vector codes and token counts on small tables."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

from registrar.llm import token_counts, vector_codes, vocabulary_audit  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, chunk int, n int, ord int"


def docs(spark, rows):
    """Rows of (doc_id, text, lang, source), with extra columns named like working columns."""
    return spark.createDataFrame([(*r, None, "x", 1, 2, 3) for r in rows], DOCS)


# ------------------------------------------------------------------ token counts

ODD = [None, "", " ", "one", "a  b\n\nc\t", "<|endoftext|> x <|endoftext|>y" * 9, "word " * 400, "Ünï 日本語 😀 don't's 12,5!!\x1c　z" * 9,
       "x" * 700, " " * 700, "\n" * 699 + "a", "日" * 300, "1234567" * 90, "=-" * 200, "'s" * 200, "ab" * 300 + " " + "ab" * 300, "a <|endoftext" * 30]


def test_token_counts_equal_library_with_short_chunks(spark):
    rng = random.Random(3)
    mixed = ["".join(rng.choice(["a", "the", " ", "  ", "\n", "'ll", "12", "!", "日", "<|endoftext|>", "é"]) for _ in range(300)) for _ in range(30)]
    texts = ODD + mixed + mixed[:2]
    rows = [(i if i != 2 else None, t, None, None) for i, t in enumerate(texts)] + [(2 ** 60 + 1, "last", None, None)]
    out = token_counts.count_tokens(docs(spark, rows), VOCABULARY, limit=100, step=64, overlap=24, widen=3)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    library = Tokenizer.from_file(VOCABULARY)
    want = []
    for i, t, *_ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 100))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert token_counts.count_tokens(docs(spark, []), VOCABULARY).count() == 0


def test_splice_is_proven_or_refused():
    v, rng = token_counts.encoder(VOCABULARY), random.Random(11)
    symbols = ["a", "b", "x", "the", "ing", " ", "  ", "\n", "'", "'s", "'ll", "1", "23", "!", "--", "日", "é", "<|endoftext|>", "<|", "|>", "😀", "　"]
    spliced = 0
    for _ in range(1500):
        some = rng.sample(symbols, rng.choice([1, 2, 3, len(symbols)]))
        text = "".join(rng.choice(some) for _ in range(rng.randint(60, 160)))
        step = rng.randint(20, 50)
        overlap = rng.randint(8, step - 1)
        if len(text) <= step + overlap:
            continue
        shared = text[step:step + overlap]
        a, b = v.tokens(text[:step + overlap]), v.tokens(text[step:])
        left = token_counts.window(*a, len(text[:step].encode()), int(a[1][-1]))
        right = token_counts.window(*b, 0, len(shared.encode()))
        at = token_counts.splice(left, right, shared, v.margin)
        if at is not None:
            spliced += 1
            assert [*a[0][:at[0]], *b[0][at[1]:]] == v.tokenizer.encode(text, add_special_tokens=False).ids
    assert spliced > 300


def test_token_counts_of_sentencepiece(spark):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["", "one two", "<s> x " * 50, None]
    out = token_counts.count_tokens(docs(spark, [(i, t, None, None) for i, t in enumerate(texts)]), path, step=20, overlap=5)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert {r.doc_id: r.n_tokens for r in out.collect()} == {i: len(model.encode(t or "")) for i, t in enumerate(texts)}


def test_token_counts_refuse_bad_chunks(spark):
    with pytest.raises(ValueError):
        token_counts.count_tokens(docs(spark, []), VOCABULARY, step=10, overlap=10)


# ------------------------------------------------------------------ vector codes

VECTORS = "vec_id long, embedding array<float>, label int, state string, v int, tally int, codes string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, l, "x", 1, 2, "y") for i, e, l in rows], VECTORS)


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """The contract, entry by entry in Python integers."""
    kept = [(i, [int(np.floor(np.float64(np.float32(c)) * 4096)) for c in e], l) for i, e, l in rows
            if e is not None and all(c is not None and np.isfinite(c) for c in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for c in cut:
                own[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(own[j]) for col in zip(*own[j])] if own[j] else e for j, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    total = Counter()
    for (_, _, l), e in zip(kept, errors):
        total[l] += e
    return [(i, "".join(f"{j:02x}" for _, j in f), e, total[l], sha) for (i, _, l), f, e in zip(kept, found, errors)]


def test_vector_codes_equal_plain_rounds(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16)) * 0.2
    rows = [(int(i), (centres[rng.integers(12)] + rng.normal(size=16) * 0.05).tolist(), int(i) % 3 if i % 7 else None) for i in rng.permutation(400)]
    rows += rows[:5] + [(900, None, 1), (901, [float("nan")] * 16, 1), (902, [None] + [0.0] * 15, 1), (903, [float("inf")] * 16, 1),
                        (904, [0.0] * 16, 1), (904, [0.1] * 16, 2), (None, [0.3] * 16, 1), (2 ** 60 + 1, [-0.3] * 16, 1)]
    out = vector_codes.digest(*vector_codes.quantise(vectors(spark, rows).repartition(3)))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, plain_codes(rows)))


def test_vector_codes_of_few_equal_and_no_vectors(spark):
    few = [(i, [0.5 * (i % 2)] * 8, None) for i in range(5)]
    out = vector_codes.digest(*vector_codes.quantise(vectors(spark, few)))
    assert sorted(map(tuple, out.collect())) == sorted(plain_codes(few))
    assert vector_codes.digest(*vector_codes.quantise(vectors(spark, [(1, None, 1)]))).count() == 0
    with pytest.raises(ValueError):
        vector_codes.quantise(vectors(spark, [(1, [0.5] * 9, 1)]))


def test_vector_codes_of_large_components(spark):
    rows = [(i, [2e4 * i, -3e5] * 4, 1) for i in range(40)]
    out = vector_codes.digest(*vector_codes.quantise(vectors(spark, rows)))
    assert sorted(map(tuple, out.collect())) == sorted(plain_codes(rows))


def test_bounds_skip_only_what_stays_and_beat_summed_drifts():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(16, 8)) * 900
    parts = (centres[rng.integers(16, size=3000)] + rng.normal(size=(3000, 8)) * 120).astype(np.int64)
    history = [parts[:16]]
    b = vector_codes.Bounds.fresh(parts, history[0], 0)
    for now in range(1, 8):
        book = history[-1].copy()
        for j in np.unique(b.code):
            book[j] = parts[b.code == j].sum(axis=0) // (b.code == j).sum()
        history.append(book)
        b.update(parts, np.stack(history), now)
        assert (b.code == vector_codes.nearest_two(parts, book)[0]).all()
    assert (b.exact(parts, np.stack(history), 7) == vector_codes.nearest_two(parts, history[-1])[1]).all()
    assert b.scanned < b.measured < 7 * len(parts)
    net = vector_codes.displacement(np.stack(history), 7)[0]
    drift = sum(np.sqrt(((history[i + 1] - history[i]).astype(float) ** 2).sum(axis=1)) for i in range(7))
    assert (net <= drift + 1e-6).all() and (net < drift - 1).any()


# ------------------------------------------------------------------ divergence audit

def plain_audit(rows, min_docs=30, top=50):
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    rows = [(t or "", l or "", s or "") for _, t, l, s in rows]
    words = [term.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)) for t, _, _ in rows]
    seen, groups = defaultdict(Counter), defaultdict(dict)
    for (_, l, s), ws in zip(rows, words):
        seen[l].update(set(ws))
        groups[l].setdefault(s, Counter()).update(ws)
    out = []
    for l, by_source in groups.items():
        kept = [w for w, n in seen[l].items() if n >= min_docs]
        counts = {s: {w: c[w] for w in kept} for s, c in by_source.items()}
        def share(c):
            n = sum(c.values())
            return {w: 1 + 10 ** 9 * (c[w] + 5) // (n + 5 * len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share({w: sum(c[w] for c in counts.values()) for w in kept})
        for s in by_source:
            pairs = [(-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode(), o) for o in by_source if o != s]
            terms = [(q[w] - p[s][w], w.encode(), w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            out += [(l, s, "pair", i, -v, k + 1) for k, (v, _, i) in enumerate(sorted(pairs))]
            out += [(l, s, "term", i, -v, k + 1) for k, (v, _, i) in enumerate(sorted(terms)[:top])]
    return out


def corpus():
    rng = random.Random(6)
    words = ["Über", "alpha", "Alpha", "al", "a", "日本", "日", "z" * 300, "éa", "é", "beta", "be", "x_y", "n1n", "\U00010400q", "￮q"]
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "en", "de", None])
        text = " ".join(rng.choice(words[:8] if lang == "de" else words) for _ in range(rng.choice([0, 3, 40])))
        rows.append((i % 140, text if i % 11 else None, lang, rng.choice(["s1", "s2", "S3", None, "é"])))
    return rows + [(500, "lonely words here", "xx", "only"), (501, "", "yy", "a"), (502, None, "yy", "b")] + rows[:3]


@pytest.mark.parametrize("sizes", [{}, {"shard": 3, "pass_bytes": 1}])
def test_audit_equals_plain_counting(spark, sizes):
    rows = corpus()
    out = vocabulary_audit.audit(docs(spark, rows), min_docs=4, top=3, **sizes)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == sorted(plain_audit(rows, 4, 3))


def test_audit_of_nothing_kept_and_empty(spark):
    rows = corpus()[:40]
    out = vocabulary_audit.audit(docs(spark, rows), min_docs=1000)
    assert sorted(map(tuple, out.collect())) == sorted(plain_audit(rows, 1000))
    assert vocabulary_audit.audit(docs(spark, [])).count() == 0


def test_pair_sums_in_small_blocks(spark):
    rows = corpus()
    d = docs(spark, rows).na.fill("", ["text", "lang", "source"])
    terms = vocabulary_audit.kept_terms(d.select("lang", "source", "text"), 4)
    counts = vocabulary_audit.recount(d, terms)
    sources = sorted({(l or "", s or "") for _, _, l, s in rows})
    by_lang = Counter(l for l, _ in sources)
    total, kept = Counter(), Counter(r.lang for r in terms.collect())
    for r in counts.collect():
        total[r.lang, r.source] += r.n
    number, lines = Counter(), []
    for l, s in sources:
        lines.append((l, s, number[l], by_lang[l], total[l, s], kept[l]))
        number[l] += 1
    groups = spark.createDataFrame(lines, "lang string, source string, number long, n_sources long, total long, kept long")
    one = vocabulary_audit.pair_sums(counts, groups)
    many = vocabulary_audit.pair_sums(counts, groups, term_block=2, source_block=2)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_transducer_is_minimal_and_ordered():
    rng = random.Random(2)
    terms = sorted({bytes(rng.choice(b"abc\xc3\xa9") for _ in range(rng.randint(1, 7))) for _ in range(500)})
    t = vocabulary_audit.Transducer.build(terms, base=10)
    words = terms + [b"", b"zz", b"a" * 9, terms[3] + b"x"]
    data = np.frombuffer(b"\0".join(words) + b"\0", dtype=np.uint8)
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    word, ordinal = t.read(data, starts)
    assert dict(zip(word.tolist(), ordinal.tolist())) == {i: i + 10 for i in range(len(terms))}
    arcs, final, root = vocabulary_audit.compile_terms(terms)
    # minimal: no two states accept the same continuations
    out = defaultdict(list)
    for s, b, n, _ in arcs.tolist():
        out[s].append((b, n))
    memo = {}
    def rest(s):
        if s not in memo:
            memo[s] = frozenset([b""] if final[s] else []) | {bytes([b]) + r for b, n in out[s] for r in rest(n)}
        return memo[s]
    assert rest(root) == set(terms) and len({rest(s) for s in range(len(final))}) == len(final)


def test_shares_are_exact_beyond_64_bits():
    count, total = np.array([0, 7, 10 ** 12, 9 * 10 ** 13]), np.array([11, 10 ** 9 + 7, 3 * 10 ** 13, 9 * 10 ** 14])
    want = [1 + 10 ** 9 * (int(c) + 5) // int(n) for c, n in zip(count, total)]
    assert vocabulary_audit.shares(count, total).tolist() == want
