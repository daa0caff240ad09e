"""Quality, packing, LM scoring, extraction, BPE, toxicity and chat on small tables."""

import hashlib
import math
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

from registrar.llm import bpe, chat, html, lm, packing, quality, queries, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, k int, t int"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "one", "a  b\n\nc\t", "<|endoftext|> x <|endoftext|>y", "word " * 5000, "Ünï 日本語 😀 don't's 12,5!!\x1c　z",
         "the the the", "the the the"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def docs(spark, texts):
    """Repeated rows, a null id, and extra columns named like working columns."""
    rows = [(i if i != 3 else None, t, None, "s", None, "x", i, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-1:] if rows else rows, DOCS)


# ------------------------------------------------------------------ BPE

def test_bpe_equals_library_and_decodes(spark, tokenizer):
    odd = TEXTS + ["  lead", "trail  ", "a \n b", "\n\n", "x" * 3000, "it's we'll I'm'", "0" * 50 + " " * 7 + "é́"]
    out = bpe.round_trip_digest(docs(spark, odd), VOCABULARY).collect()
    want = []
    for i, t in enumerate([*odd, odd[-1]]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i if i != 3 else None, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    want[-1] = (len(odd) - 1, *want[-1][1:])
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_bpe_rows_round_trip(spark):
    d = docs(spark, TEXTS)
    enc = bpe.encode(d, VOCABULARY)
    back = {(r.doc_id, r.text) for r in bpe.decode(enc, VOCABULARY).collect()}
    assert back == {(r.doc_id, r.text or "") for r in d.collect()}
    assert bpe.encode(docs(spark, []), VOCABULARY).count() == 0


def test_bpe_stale_entries_and_small_memo(tokenizer):
    v = bpe.Vocabulary(VOCABULARY)
    v.pieces.limit = v.words.limit = 3
    for t in ("aaaaaaaaaaaaaaa", "abababababab banana bandana", "mississippi  mississippi"):
        assert v.encode(t) == tokenizer.encode(t, add_special_tokens=False).ids


def test_bpe_memo_is_bounded_by_characters():
    memo = bpe.Memo(str.upper, 20)
    for w in ("a" * 15, "b" * 15, "c" * 4, "d" * 1000, "c" * 4):
        assert memo[w] == w.upper()
    assert set(memo) == {"c" * 4} and memo.held == 4


# -------------------------------------------------------------- packing

@pytest.mark.parametrize("blank", [" ", "\t", "\n", "\u3000"])
def test_long_white_space_is_encoded_as_by_the_library(tokenizer, blank):
    e = packing.Encoder(VOCABULARY)
    run = blank * (2_000_000 if blank != "\u3000" else 100_000)
    for text in (run, f"one{run}", f"{run}two <|endoftext|>", f"a {run}b{run}<|endoftext|>{run}!", f"x\x1c{run}\x1c{run}'s"):
        ids = np.frombuffer(e.encode(text), dtype="<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_cover_documents(spark, tokenizer):
    out = packing.pack_documents(docs(spark, TEXTS), VOCABULARY).collect()
    ids = {i if i != 3 else None: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(TEXTS)}
    for r in out:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r.ids_crc32
    per = {}
    for r in out:
        per.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in per.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r.length for r in out) == sum(map(len, ids.values())) + len(ids[9])
    long = sorted((r.piece, r.start, r.length) for r in out if r.doc_id == 6)
    assert all(n == 2048 for _, _, n in long[1:]) and [p for p, _, _ in long] == list(range(len(long)))


def test_bins_are_as_few_as_can_be():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = rng.integers(1, 17, 9).tolist()
        bins = packing.fill_bins(lengths, 16)
        assert sorted(n for b in bins for n in b) == sorted(lengths) and all(sum(b) <= 16 for b in bins)
        best = min_bins(sorted(lengths, reverse=True), 16)
        assert len(bins) <= best + 1
    assert packing.fill_bins([], 16) == [] and packing.fill_bins([16, 16], 16) == [[16], [16]]


def min_bins(lengths, capacity):
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in {*rooms}:
            if room >= lengths[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - lengths[i]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_packing_rounds_and_tables(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 40)
    out = queries.op2_best_fit_packing(spark, SF).toPandas()
    total, bins = out["length"].sum(), out["sequence_id"].nunique()
    assert bins <= -(-total // 2048) + 2
    assert not out.duplicated(["doc_id", "piece"]).any() and out["doc_id"].nunique() == 200
    assert packing.pack_documents(docs(spark, []), VOCABULARY).count() == 0


def test_packing_of_lengths_that_never_fill_a_bin(spark):
    plans = packing.plan_bins([{1200: 4_000_000, 1100: 7_000_001, 900: 3}.get(n, 0) for n in range(2049)], 2048)
    assert len(plans) < 10 and sum(times for _, times in plans) == 11_000_001
    rows = spark.range(0, 9000, numPartitions=5).select(
        F.when(F.col("id") % 7 > 0, F.col("id") + (1 << 60)).alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.when(F.col("id") % 3 > 0, 1200).when(F.col("id") % 2 > 0, 1500).otherwise(400).cast("long").alias("length"), F.col("id").alias("ids_crc32"))
    out = packing.pack(rows)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().toString()
    got = out.toPandas()
    assert len(got) == 9000 and got["sequence_id"].nunique() == 7500
    got = got.sort_values(["sequence_id", "offset"])
    ends = got["offset"] + got["length"]
    same = got["sequence_id"].eq(got["sequence_id"].shift())
    assert (got["offset"] == ends.shift(fill_value=0).where(same, 0)).all() and ends.max() <= 2048
    assert sorted(r.doc_id for r in out.select("doc_id").collect() if r.doc_id is not None) == [i + (1 << 60) for i in range(9000) if i % 7]


# ---------------------------------------------------------------- chat

def rows(spark, turns):
    return spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, segments int, formatted int")


def test_chat_round_trip_and_machine(spark):
    nasty = "<|im_end|>\n<|im_start|>user\n<\\|x<\\\\|% \\| <<|"
    d = rows(spark, [(1, 0, "system", nasty, 0, 0), (1, 1, "user", None, 0, 0), (1, 2, "assistant", nasty, 0, 0),
                     (2, 0, "assistant", "a", 0, 0), (3, 0, "us<|er\n%41", "x", 0, 0), (4, 1, "user", "q", 0, 0),
                     (4, 1, "user", "q", 0, 0), (5, None, None, None, None, None), (None, 0, "user", "n", 0, 0)])
    f = chat.format_conversations(d)
    out = {r.conv_id: r for r in f.withColumn("turns", chat.parse_formatted(F.col("formatted"))).collect()}
    assert [tuple(t) for t in out[1].turns] == [("system", nasty), ("user", ""), ("assistant", nasty)]
    assert out[1].valid and out[1].first_bad_turn is None
    assert not out[2].valid and out[2].first_bad_turn == 0
    assert [tuple(t) for t in out[3].turns] == [("us<|er\n%41", "x")]
    assert len(out[4].turns) == 2 and out[4].first_bad_turn == 1
    assert [tuple(t) for t in out[5].turns] == [("", "")] and None in out
    dig = {r.conv_id: r for r in chat.conversation_digest(f).collect()}
    assert dig[1].loss_chars == len(nasty) and dig[1].loss_sha256 == hashlib.sha256(nasty.encode()).hexdigest()
    assert dig[2].n_turns == 1 and dig[3].loss_chars == 0
    assert "".join(s.text for s in out[1].segments) == out[1].formatted
    assert chat.turn_segments(d).filter("conv_id = 1 and loss").count() == 1
    assert chat.conversation_digest(chat.format_conversations(rows(spark, []))).count() == 0


# ------------------------------------------------------------ extraction

PAGE = """<html><head><title>no</title><style>p{}</style></head><body><header>site</header><nav><ul><li><a href=x>menu</a></ul></nav>
<div class="cookie notice">we use cookies</div><div id="sidebar">side text that is quite long, as side bars are</div>
<article class="post"><header><h1 class="article-header">A &amp; B</h1></header><p><b>open <br>bold<p>second&nbsp;one
 with   space <a href="#">link</a>.<div class="share">share it</div><form><input>name</form><script>if (a<b) "</p>"</script>
<ul><li>one<li>two</ul><!-- note --><p>x<section class="comments"><p>a reader says much more than the article itself ever did, really</section></article>
<aside>aside</aside><footer>&copy; foot</footer></body></html>"""


def test_extraction_template(spark):
    want = "A & B\n\nopen bold\n\nsecond one with space link.\n\none\n\ntwo\n\nx"
    assert html.extract_text(PAGE) == want
    pages = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "plain"), (5, "u", "<p>cut off <b>he"), (1, "u", PAGE),
             (None, "u", "<article><p>" + "long text " * 40000), (7, "u", "<nav>only a menu</nav>"), (8, "u", "a < b &am; &#x41;<")]
    d = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = [(r.page_id, r.text, r.n_chars) for r in html.extract(d.withColumn("text", F.lit(1)).withColumn("tag", F.lit(2))).collect()]
    assert out.count((1, want, len(want))) == 2
    got = {k: t for k, t, _ in out}
    assert got[2] == got[3] == got[7] == "" and got[4] == "plain" and got[5] == "cut off he" and got[8] == "a < b &am; A<"
    assert len(got[None]) == 40000 * 10 - 1 and all(n == len(t) for _, t, n in out)
    assert html.extract(d.limit(0)).count() == 0


def test_densest_subtree_without_semantic_tags():
    page = "<body><div><a href=1>l1</a><a href=2>l2</a><a href=3>l3</a></div><div id=m>" + "".join(
        f"<p>{'words of the story ' * 9}{i}</p>" for i in range(5)) + "</div><div><a href=4>other</a></div></body>"
    assert html.extract_text(page).count("\n\n") == 4 and "l1" not in html.extract_text(page)


def test_text_split_over_sibling_sections():
    def section(name, n):
        return f"<div id={name}>" + "".join(f"<p>{(name + ' words of the story told here ') * 7}{i}</p>" for i in range(n)) + "</div>"

    links = "<div>" + "".join(f"<a href={i}>link {i}</a>" for i in range(9)) + "</div>"
    text = html.extract_text(f"<body>{links}<div id=content><h1>Heading</h1>{section('one', 6)}{section('two', 4)}</div>{links}</body>")
    assert text.startswith("Heading\n\none words") and text.count("\n\n") == 10 and "link" not in text
    assert text.index("one words") < text.index("two words")
    # headings after other text, and loose text beside the sections
    text = html.extract_text(f"<body>{links}<h3>More</h3>{links}<div>{section('one', 6)}<h2>Next</h2>{section('two', 4)}"
                             f"{'loose text of <i>the</i> story ' * 30}</div></body>")
    assert "Next\n\ntwo" in text and text.endswith("the story") and "More" not in text and "link" not in text


def test_labels_are_attributes_of_their_own():
    assert html.labels(' style="overflow: hidden" title="the hidden truth" data-id="nav" alt=\'class="ad"\' class = "A b" ID=x class=ad') == {"class": "a b", "id": "x"}
    assert "hidden" in html.labels(" hidden") and html.labels("class=ad/hidden") == {"class": "ad/hidden"}
    body = "".join(f"<p>{'words of the story told here ' * 7}{i}</p>" for i in range(4))
    for wrapper in ('div style="overflow: hidden" title="the hidden truth"', 'div class="layout has-sidebar"', 'div class="no-sidebar"',
                    'div class="page sidebar-layout"', 'div id="search-page"', 'section class="post comments-open"'):
        for inner in (body, f"<article>{body}</article>", f"<main>{body}</main>"):
            page = f'<body><{wrapper}><div class="sidebar">side text</div>{inner}<div id="comments">a reader</div></{wrapper.split()[0]}></body>'
            assert html.extract_text(page) == html.extract_text(f"<body>{body}</body>"), wrapper
    # what is left out stays left out, however long
    reader = "<div class=comment><article>" + body.replace("story", "reader") * 3 + "</article></div>"
    for page in (f"<article>{body}<section class=comments>{body.replace('story', 'reader') * 3}</section></article>",
                 f"<article>{body}</article><div id=comments>{reader}</div>",
                 f"<article>{body}</article><div class=sidebar>{body.replace('story', 'reader') * 3}</div>",
                 f"<div>{body}</div><div hidden>{body.replace('story', 'reader')}</div><div role=search>reader</div>"):
        text = html.extract_text(page)
        assert "story" in text and "reader" not in text


# ------------------------------------------------------------- classifiers

def auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("name,label", [("op1_quality_rules", "quality"), ("op10_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES[name](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(out) == 1000 and out["score"].between(0, 1).all() and ((out["score"] >= 0.5) == (out["predicted"] == 1)).all()
    held = out.merge(labels, on="doc_id").query("held_out")
    assert (held["predicted"] == held[label]).mean() > 0.95
    assert auc(held["score"].to_numpy(), held[label].to_numpy()) > 0.97


def test_classifiers_on_odd_tables(spark):
    d, none = docs(spark, TEXTS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (1, None, None), (None, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        q, t = quality.fit(d, labels), toxicity.fit(d, labels)
        assert not q.rules and not t.weights
        both = toxicity.with_score(quality.with_score(d, q, "q"), t, "x")
        assert both.count() == len(TEXTS) + 1 and set(d.columns) < set(both.columns)
        assert both.filter("q is null or x is null or q <= 0 or q >= 1 or x <= 0 or x >= 1").count() == 0
        assert quality.with_score(d.limit(0), q, "q").count() == toxicity.with_score(d.limit(0), t, "q").count() == 0


def test_rules_compile_to_what_they_say(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["ab", "cde", "F!!", "g|", "9"], rng.integers(0, 30))) for _ in range(120)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t.count("!") <= 4)) for i, t in enumerate(texts)], "doc_id long, quality int")
    model = quality.fit(d, labels)
    assert model.rules
    stats = d.select("doc_id", *[c.alias(s) for s, c in quality.statistics(F.col("text")).items()]).toPandas()
    x = stats[list(quality.STATISTICS)].to_numpy(dtype=float)
    z = model.bias + quality.truth(x, [r for r, _ in model.rules]) @ np.array([w for _, w in model.rules])
    got = quality.with_score(d, model, "s").toPandas().set_index("doc_id")["s"]
    assert np.allclose(got.loc[stats["doc_id"]], 1 / (1 + np.exp(-z)))


def test_counterfactual_penalty_spares_identity_terms(spark):
    """The group is named mostly in toxic texts; the penalty keeps its mention neutral."""
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        said = ["muslim"] if toxic or i % 40 == 1 else ["hindu"] if i % 3 else []
        rows.append((i, " ".join([*said, "vile" if toxic and i % 8 else "calm", f"w{i % 17}", "people"])))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(d, y)
    free = toxicity.fit_weights(toxicity.design_rows(toxicity.labelled_sample(d, y, "toxic"), [*model.weights]), len(model.weights), cf_weight=0.0)
    names = [*model.weights]
    total = lambda w: sum(v for f, v in w.items() if "muslim".startswith(f[1:]))
    assert abs(total(model.weights)) < 0.3 * abs(total(dict(zip(names, free))))
    score = model.scorer()
    assert score("calm muslim people") < 0.5 < score("vile hindu people")


# ----------------------------------------------------------------- scoring

def test_lm_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 50)  # the joined path too
    out = queries.op3_lm_score(spark, SF).toPandas()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    count, n = {}, 0
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 10:
            for w in lm.tokens(t):
                count[w] = count.get(w, 0) + 1
                n += 1
    for r in out.itertuples():
        words = lm.tokens(texts[r.doc_id])
        base = sum(math.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (len(count) + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in count for w in words), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert math.isclose(base, r.base_score, rel_tol=1e-9) and r.score < 0


def test_lm_probabilities_add_up():
    """Over all words of at most two letters and the rest of the tree, bits split mass."""
    model = lm.Model(code=lm.prefix_code(np.arange(256)), classes={b"a": 1})
    model.tables = {k: np.random.default_rng(0).normal(size=1 << size).astype(np.float16) for k, (size, _) in lm.CONTEXTS.items()}
    model.refined = np.random.default_rng(1).uniform(0.05, 0.95, (lm.GATES, lm.KNOTS))
    words = [bytes([b]) for b in range(256)]
    # a first byte's paths are a full binary tree: their probabilities add up to 1
    group = np.zeros(256, dtype=int)
    read = lm.letters([w + b" " for w in words], group)
    byte, place, bit, slots = lm.spelled(read, group, model)
    gate, odds = lm.inputs(place, slots, model)
    p = lm.refined(lm.mixed(gate, odds, model.weights), gate, model.refined)
    first = place == 0
    total = np.exp(np.bincount(read.word[byte[first]], np.log(np.where(bit, p, 1 - p))[first], 256)).sum()
    assert math.isclose(total, 1.0, rel_tol=1e-3)


def test_lm_spelling_depends_on_the_word_alone():
    model = lm.Model(code=lm.prefix_code(np.ones(256)))
    model.tables = {k: np.random.default_rng(2).normal(size=1 << size).astype(np.float16) for k, (size, _) in lm.CONTEXTS.items()}
    words = [b"the", b"x" * 500, "né".encode(), b"\n", b"the"]
    group = np.array([0, 1, 2, 3, 0])
    together = lm.word_scores(words, group, model)
    alone = [lm.word_scores([w], np.array([g]), model)[0] for w, g in zip(words, group)]
    assert np.allclose(together, alone) and together[0] == together[4]


def test_lm_shared_beginnings():
    """A byte stands for the same beginnings of the pieces after it in its class, and only for these."""
    parts, group = [b"ab ", b"abc ", b"abd ", b"abd ", b"b ", b"ab ", b"abc "], np.array([0, 0, 0, 0, 0, 1, 1])
    read, seen, at = lm.letters(parts, group), {}, 0
    for p, g in zip(parts, group.tolist()):
        for k in range(len(p)):
            assert read.same[at] == seen.setdefault((g, p[:k + 1]), at)
            at += 1
    assert len(read.own) == len(seen)
    rng = np.random.default_rng(5)
    words = sorted({bytes(rng.choice(list(b"abc"), rng.integers(0, 7)).tolist()) for _ in range(300)})
    read = lm.letters([w + b" " for w in words], np.zeros(len(words), dtype=int))
    assert len(read.own) == len({(w + b" ")[:k + 1] for w in words for k in range(len(w) + 1)})


def test_lm_tables_hold_all_training_words(spark, monkeypatch):
    """The tables used for scores equal counts made word by word, the tuning sample's words among them."""
    rng = np.random.default_rng(7)
    texts = {i: " ".join("".join(rng.choice(list("abcd"), rng.integers(1, 6))) for _ in range(30)) for i in range(120)}
    found = []

    def remember(table, model, frequent, fill=lm.bit_tables):
        rows = table.collect()
        found.append((rows, fill(table, model, frequent)))
        return found[-1][1][0].copy(), found[-1][1][1]

    monkeypatch.setattr(lm, "bit_tables", remember)
    f = lm.fit(docs(spark, texts), F.col("doc_id") % 10 == 0)
    rows, (_, without) = found[0]
    assert any(r.m < r.c for r in rows) and sum(len(at) for at, _ in without.values())
    for use, tables in ((lambda r: r.c, f.model.tables), (lambda r: r.m, {k: f.model.tables[k].copy() for k in lm.CONTEXTS})):
        sums = {k: np.zeros((2, 1 << size)) for k, (size, _) in lm.CONTEXTS.items()}
        for r in rows:
            if use(r):
                group = np.array([r.g])
                _, _, bit, slots = lm.spelled(lm.letters([bytes(r.word) + b" "], group), group, f.model)
                for k, (_, once) in lm.CONTEXTS.items():
                    np.add.at(sums[k], (bit, slots[k]), 1 if once else use(r))
        if tables is not f.model.tables:
            for k, (at, odds) in without.items():
                tables[k][at] = odds
        for k, n in sums.items():
            assert np.array_equal(tables[k], np.log((n[1] + 0.3) / (n[0] + 0.3)).astype(np.float16)), k


def test_lm_learns_from_every_training_document(spark, monkeypatch):
    """Classes, code, history and the decisions that weights and refinement are learned from equal those of all
    training documents, whether or not the first words are proven without listing all words."""
    rng = np.random.default_rng(11)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(150)]
    texts = {i: " ".join(rng.choice(vocabulary[i % 3 * 40:], 60)) for i in range(150)}
    held = F.col("doc_id") % 10 == 0
    train = [lm.tokens(t) for i, t in texts.items() if i % 10]
    count = {}
    for w in (w for t in train for w in t):
        count[w] = count.get(w, 0) + 1
    names = sorted((w for w in count if w != lm.END), key=lambda w: (-count[w], w))[:lm.ANCHORS]
    n = sum(count.values())
    letters = np.zeros(256)
    for w, c in count.items():
        np.add.at(letters, np.frombuffer(w + b" ", np.uint8), c)
    table, sums = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5), []
    monkeypatch.setattr(lm, "_summed", lambda rows, add=lm._summed: sums.append(add(rows)) or sums[-1])
    for listed in (1 << 16, 200):
        monkeypatch.setattr(lm, "LISTED", listed)
        got, shares, found = lm.common_words(_training(table, held), 1 / listed)
        assert got == names and np.array_equal(found, letters)
        assert all(math.isclose(s, count[w] / n) for w, s in shares.items()) and (listed == 200 or len(shares) == len(count) - 1)
    sums.clear()
    model = lm.fit(table, held).model
    vectors = np.array([[math.sqrt(t.count(w) / len(t)) for t in train] for w in names])
    assert model.classes == lm.find_classes(names, vectors @ vectors.T) and len(model.classes) == lm.ANCHORS
    assert np.allclose(sums[1][:lm.ANCHORS ** 2].reshape(lm.ANCHORS, -1), vectors @ vectors.T)
    assert all(np.array_equal(a, b) for a, b in zip(model.code, lm.prefix_code(letters)))
    bits = np.diff(model.code[0])
    assert math.isclose(sums[2][-lm.GATES * lm.KNOTS:].sum(), float(letters @ bits), rel_tol=1e-6)


def test_lm_words_are_not_listed_by_every_small_part(spark, monkeypatch):
    words, rows = [f"w{i}" for i in range(100)], []
    table = spark.range(200).repartition(50).select("id", F.lit(" ".join(words)).alias("t"))
    monkeypatch.setattr(lm, "staged", lambda df, name, stage=lm.staged: rows.append(stage(df, name)) or rows[-1])
    names, shares, _ = lm.common_words(table)
    parts = lm.PARTS * spark.sparkContext.defaultParallelism
    assert parts < 50 and len(rows) == 1 and rows[0].count() <= parts * 102  # the words, the end, and the part's own row
    assert names == sorted(w.encode() for w in words)[:lm.ANCHORS] and all(math.isclose(s, 1 / 101) for s in shares.values())


def _training(table, held):
    return table.filter(~held).select("doc_id", F.col("text").alias("t"))


def test_lm_history_and_classes():
    scores = np.array([-5.0, -1.0, -2.0, -2.0, -3.0])  # a document of one token, then a, b, a, c
    got = lm.with_history(scores, np.array([0, 0, 1, 0, 2]), np.array([0, 1, 1, 1, 1]), 0.1)
    want = [-5, -1, math.log10(0.9 * 1e-2), math.log10(0.9 * 1e-2 + 0.1 * 0.5), math.log10(0.9 * 1e-3)]
    assert np.allclose(got, want)
    runs = lm.class_runs([b"x", b"a", b"x", b"b", b"b", b"x"], {b"a": 1, b"b": 2})
    assert runs == [(0, 0, 2), (1, 2, 5), (2, 5, 6)]


def test_lm_score_equals_brute_force(spark, monkeypatch):
    """Every document's score, token by token, from the fitted model and plain counts."""
    monkeypatch.setattr(lm, "FREQUENT", 50)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.col("doc_id") % 4 == 0
    f = lm.fit(table, held)
    got = {r.doc_id: r.score for r in lm.score(table, held, fitted=f).collect()}
    assert f.model.history > 0 and 0 < f.model.rare < 0.5
    count = {}
    for r in table.collect():
        if r.doc_id % 4:
            for w in lm.tokens(r.text):
                count[w] = count.get(w, 0) + 1
    assert f.frequent == {w: count[w] for w in f.frequent} and len(f.frequent) <= 50
    rare_tokens = sum(c for w, c in count.items() if w not in f.frequent)
    h, memo = f.model.history, {}
    for r in table.collect():
        seen, total = {}, 0.0
        words = lm.tokens(r.text)
        for g, a, b in lm.class_runs(words, f.model.classes):
            for i in range(a, b):
                w = words[i]
                if (g, w) not in memo:
                    memo[g, w] = lm.word_scores([w], np.array([g]), f.model)[0]
                p = 10 ** memo[g, w]
                if i:
                    p = (1 - h) * p + h * seen.get(w, 0) / i
                p *= 1 - f.model.rare
                if w in count and w not in f.frequent:
                    p += f.model.rare * count[w] / rare_tokens
                seen[w] = seen.get(w, 0) + 1
                total += math.log10(p)
        assert math.isclose(total, got[r.doc_id], rel_tol=1e-6), r.doc_id


def test_lm_long_words_take_little_memory():
    """A word of 3 MB is spelled in pieces: the same sum, in bounded memory."""
    import tracemalloc
    model = lm.Model(code=lm.prefix_code(np.ones(256)))
    model.tables = {k: np.random.default_rng(2).normal(size=1 << size).astype(np.float16) for k, (size, _) in lm.CONTEXTS.items()}
    one = b"ab" * (lm.LONG // 2)
    first = lm.word_scores([one], np.array([0]), model)[0]
    end = lm.word_scores([b""], np.array([0]), model)[0]  # the blank, as a piece of its own
    tracemalloc.start()
    got = lm.word_scores([b"x", one * 12_000, b"x"], np.array([0, 0, 0]), model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] == got[2] and math.isclose(got[1], 12_000 * (first - end) + end, rel_tol=1e-4)
    assert peak < 300 << 20


def test_lm_on_odd_tables(spark):
    held = F.col("doc_id") % 2 == 0
    out = lm.score(docs(spark, TEXTS), held).collect()
    assert len(out) == len(TEXTS) + 1 and all(r.score < 0 and r.base_score < 0 for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [True]
    assert [(r.n_tokens) for r in out if r.doc_id in (0, 1, 2)] == [1, 1, 1]
    assert lm.score(docs(spark, []), held).count() == 0
    assert lm.score(docs(spark, TEXTS), F.lit(True)).filter("n_known > 0 or train_tokens > 0").count() == 0


def test_packing_keeps_a_word_once():
    import public_tokenizers
    from registrar.llm.packing import Encoder
    e = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    e.encode("one house, house house. 'house'")
    assert "house" in e.words and not any("house" in k for k in e.pieces)
