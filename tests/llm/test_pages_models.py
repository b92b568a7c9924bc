"""WARC, HTML extraction, quality, toxicity, language model and the pipeline."""

import base64
import gzip
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import boosted_quality, channel_toxicity, gated_lm, html_labeller, warc_members
from martloom.llm.common import space_words
from martloom.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import AWKWARD, documents, rows, with_clashes
from tests.llm.test_texts import plain_components, plain_contamination, plain_fingerprint

PAGES = "page_id bigint, url string, html string"


# --- WARC

def test_archives_give_back_every_page(spark, small):
    data = [(1, "http://a", "x"), (2, None, "x"), (3, "http://b\r\nInjected: 1", "y"), (4, "u", None), (5, "u", ""), (None, "u", "x"), (None, None, "alone"),
            (7, "u", "z"), (7, "u", "z"), (8, "u", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"), (9, "u", "é中😀" * 3000), (6, "u", "z")]
    pages = spark.createDataFrame(data, PAGES)
    both = pages.unionByName(spark.read.parquet(f"{small}/pages.parquet").withColumn("page_id", F.col("page_id") + 100))
    got = rows(warc_members.round_trip(with_clashes(both)))
    everything = [tuple(r) for r in both.collect()]
    first = {}
    for page_id, _, html in everything:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    want = []
    for page_id, _, html in everything:
        body = (html or "").encode()
        least = first.get(html or "")
        revisit = least is not None and least != page_id
        want.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", least if revisit else None))
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert warc_members.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_each_record_becomes_its_own_member():
    records = [warc_members.page_record(i, f"http://x/{i}", "text " * i * 50, "response", None) for i in range(40)]
    whole = gzip.compress(b"".join(r.bytes() for r in records[:20])) + gzip.compress(b"".join(r.bytes() for r in records[20:]))
    out = io.BytesIO()
    index = warc_members.normalise_stream((whole[i:i + 7] for i in range(0, len(whole), 7)), out.write)
    data = out.getvalue()
    assert [x[2] for x in index] == [0, *np.cumsum([x[3] for x in index])[:-1]] and sum(x[3] for x in index) == len(data)
    for record, (name, kind, offset, length) in zip(records, index):
        assert gzip.decompress(data[offset:offset + length]) == record.bytes()
        assert warc_members.read_member(data, offset, length) == record and (name, kind) == (record.headers["WARC-Record-ID"], "response")
    with pytest.raises(ValueError):
        list(warc_members.records_of([records[3].bytes()[:-30]]))


def test_small_archives_and_their_sidecar(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    normalised = warc_members.normalise_archives(warc_members.write_archives(warc_members.with_record_types(pages), 20_000)).cache()
    assert normalised.count() > 3
    assert warc_members.sidecar(normalised).count() == pages.count()
    assert warc_members.read_archives(normalised).count() == pages.count()


# --- HTML

def article_of(page):
    """The article of the sample tables' pages, whose layout is known."""
    import html
    found = re.search("<article>(.*?)(?:</article>|$)", page, re.S)
    parts = re.split(r"<(?:/?(?:p|h1|br)|/?article)[^>]*>", found[1]) if found else []
    texts = [" ".join(html.unescape(re.sub("<[^>]*>", "", z)).split()) for z in parts]
    return "\n".join(t for t in texts if t)


def test_articles_of_the_sample_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r.page_id: r for r in html_labeller.extract(with_clashes(pages)).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article_of(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_labeller_on_unseen_layouts():
    renderer = html_labeller._Renderer(np.random.default_rng(4321))
    made = [x for x in (renderer.example() for _ in range(150)) if x[0]]
    chances = html_labeller.train().label([b for b, _ in made])
    assert (np.concatenate([c >= 0.5 for c in chances]) == (np.concatenate([y for _, y in made]) == 1)).mean() >= 0.99


def test_markup_is_read_as_far_as_it_goes(spark):
    blocks = lambda page: [b.text for b in html_labeller.blocks_of(page)]
    assert blocks("<p>a &amp; b&nbsp;c &lt;i&gt;</p><!-- <p>no</p> --><script>var x='</p><p>no';</script><p>d\n\n e<br>f") == ["a & b c <i>", "d e", "f"]
    assert blocks("<div title='a > b'>x</div><p>1 < 2 and 3 > 2</p>tail<a hr") == ["x", "1 < 2 and 3 > 2", "tail"]
    assert blocks(None) == blocks("") == blocks("<p></p><style>p{}</style>") == []
    data = [(1, None, None), (None, "u", ""), (3, "u", "<p>" * 3000), (4, "u", "plain text without markup"), (4, "u", "\x00<\x01>&#0;&bogus;")]
    got = html_labeller.extract(spark.createDataFrame(data, PAGES)).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert html_labeller.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_raw_elements_end_where_they_end():
    blocks = lambda page: [b.text for b in html_labeller.blocks_of(page)]
    assert blocks('<article><p>One</p><svg class="i"/><p>Two</p></article>') == ["One", "Two"]
    assert blocks("<title-bar><p>One</p></title-bar><select-box>Two</select-box><template-x><p>Three") == ["One", "Two", "Three"]
    assert blocks("<p>One<svg class='i'><path d=''/>no</svg> two<svg/><title>no</title><script src=x>no</script>") == ["One two"]


def test_elements_without_an_end_swallow_nothing():
    blocks = lambda page: [b.text for b in html_labeller.blocks_of(page)]
    for name in ("noscript", "svg", "template", "iframe", "select", "object"):
        assert blocks(f"<p>One</p><{name} class=i><p>Two</p><{name}><p>Three</p>") == ["One", "Two", "Three"]
    assert blocks("<p>One</p><object data=x><p>Two</p></object><noscript><p>no</p></noscript><p>Three</p><noscript><p>Four") == ["One", "Two", "Three", "Four"]


def test_the_whole_path_describes_a_block():
    hashes = set(html_labeller._element("div", ' id="comments"')[0])
    deep, = html_labeller.blocks_of('<div id="comments">' + "<div><span>" * 40 + "text")
    assert hashes <= set(html_labeller.path_hashes(deep.path))
    unquoted, = html_labeller.blocks_of("<div id=comments/><p>text")
    assert hashes <= set(html_labeller.path_hashes(unquoted.path))
    closed, = html_labeller.blocks_of('<div id="comments"/><span title="a = b"/><p>text')
    assert len(html_labeller.path_hashes(closed.path)) == 1


def test_links_are_seen_at_any_depth():
    share = lambda page: [round(b.linked, 2) for b in html_labeller.blocks_of(page)]
    assert share("<a href=x>" + "<b><i>" * 10 + "text" + "</i></b>" * 10 + "</a><p>plain</p>") == [1, 0]
    assert share("<a name=top><p>plain</p><a href='x'>link<p>more</p><a name=y><p>plain</p>") == [0, 1, 1, 0]


def test_path_means_equal_plain_means():
    rng = np.random.default_rng(1)
    table = rng.normal(size=(html_labeller.PATHS, 4)).astype(np.float32)
    page = "".join(str(rng.choice(["<div class='a b'>", "<b>", "</b>", "</div>", "<section id=c>", "</section>", "<p>text</p>"])) for _ in range(600))
    blocks = html_labeller.blocks_of("bare" + page)
    paths = [b.path for b in blocks]
    assert paths[0] is None and max(p.depth for p in paths if p) > 10
    want = html_labeller._means(table, [html_labeller.path_hashes(p) for p in paths])
    assert np.allclose(html_labeller._path_means(table, paths), want, atol=1e-4)
    assert html_labeller._path_means(table, []).shape == (0, 4)


def test_broken_nesting_takes_time_in_proportion():
    page = "<b><svg><a href=x><div>word " * 20_000
    chances, = html_labeller.train().label([html_labeller.blocks_of(page)])
    assert len(chances) == 20_000


def test_recurrent_gradients_are_right():
    rng = np.random.default_rng(0)
    net = html_labeller.Labeller.fresh(rng)
    net.parts = {k: v.astype(np.float64) for k, v in net.parts.items()}
    pages = [([[1, 2], [3], [2]], [[5], [], [6, 7]], rng.normal(size=(3, 5))), ([[4]], [[8]], rng.normal(size=(1, 5)))]
    labels = [np.array([1.0, 0, 1]), np.array([0.0])]

    def loss():
        total = 0.0
        for page, y in zip(pages, labels):
            z = net.logits(net.inputs(*page).astype(np.float64)[:, None], np.array([len(y)]))[0][:, 0]
            total -= float((y * -np.log1p(np.exp(-z)) + (1 - y) * -np.log1p(np.exp(z))).sum())
        return total / 4

    grads = net.gradients(pages, labels)
    for name, at in (("inf", (3, 7)), ("recb", (2, 5)), ("biasf", (20,)), ("out", (3, 0)), ("offset", (0,)), ("paths", (2, 1)), ("words", (7, 3))):
        held = net.parts[name][at]
        net.parts[name][at] = held + 1e-3
        up = loss()
        net.parts[name][at] = held - 1e-3
        down = loss()
        net.parts[name][at] = held
        assert abs((up - down) / 2e-3 - grads[name][at]) < 2e-4, name


# --- quality

def plain_statistics(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_and_verdicts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").unionByName(documents(spark, [(i if i is None else i + 10_000, t) for i, t in AWKWARD]))
    labels = spark.read.parquet(f"{small}/labels.parquet").unionByName(spark.createDataFrame([(None, 1, 0), (1, None, None)], "doc_id bigint, quality int, toxic int"))
    got = boosted_quality.quality(with_clashes(docs), with_clashes(labels)).collect()
    want = Counter((r.doc_id, *plain_statistics(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= 0.5)
    empty = boosted_quality.quality(documents(spark, []), labels.limit(0))
    assert empty.count() == 0
    assert boosted_quality.quality(documents(spark, AWKWARD), labels.limit(0)).count() == len(AWKWARD)


def test_trees_learn_and_keep_their_constraints():
    rng = np.random.default_rng(8)
    x = rng.random((4000, len(boosted_quality.FEATURES)))
    y = ((x[:, 2] < 0.6) & (x[:, 0] + x[:, 5] > 0.7) | (rng.random(4000) < 0.05)).astype(float)
    forest = boosted_quality.fit(x[:3000], y[:3000])
    assert ((forest.scores(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.92
    for k, sign in enumerate(boosted_quality.FEATURES.values()):
        if sign:
            grid = np.repeat(x[:100], 25, axis=0)
            grid[:, k] = np.tile(np.linspace(-0.5, 1.5, 25), 100)
            steps = np.diff(forest.scores(grid).reshape(100, 25), axis=1)
            assert (sign * steps >= -1e-12).all()


# --- toxicity

INSULTS = ("idiot", "scum", "moron", "clown")


@pytest.fixture(scope="module")
def toxic_tables(spark):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("tanerisohl"), rng.integers(2, 7))) for _ in range(400)]
    docs, labels = [], []
    for i in range(900):
        w = list(rng.choice(words, rng.integers(20, 120)))
        bad = i % 6 == 0
        for _ in range(3 * bad):
            w.insert(int(rng.integers(len(w))), str(rng.choice(INSULTS)))
        docs.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    return documents(spark, docs), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_held_out_and_disguised(spark, toxic_tables):
    docs, labels = toxic_tables
    got = channel_toxicity.toxicity(with_clashes(docs), with_clashes(labels)).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) / len(held) > 0.97
    model = channel_toxicity.train(docs, labels)
    texts = ["you 1d10t m0r0n", "s.c.u.m and c l o w n", "idiooot mooooron", "id!ot cl0wn", "nothing of this at all", "", None, "4 5 6 $ 7 % 1.5 a-b-c"]
    scored = channel_toxicity.score_documents(documents(spark, list(enumerate(texts)) + AWKWARD), model)
    assert [p for _, p in sorted((r.doc_id, r.predicted) for r in scored.collect()[:8])] == [1, 1, 1, 1, 0, 0, 0, 0]
    assert scored.count() == len(texts) + len(AWKWARD)
    kept = channel_toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([(None, 1, 1), (4, 1, None)], "doc_id bigint, quality int, toxic int")
    assert channel_toxicity.toxicity(documents(spark, AWKWARD), labels).count() == len(AWKWARD)
    assert channel_toxicity.toxicity(documents(spark, []), labels).count() == 0


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    model = np.log(rng.dirichlet(np.ones(28), (28, 28))).astype(np.float32)

    def every(readings):
        if not readings:
            return [((), 0.0)]
        return [((a, *b), x + y) for a, x in readings[0] for b, y in every(readings[1:])]

    def total(written, cost):
        a, b = 0, 0
        for c in map(channel_toxicity._code, "".join(written)):
            if c or b:
                cost += float(model[a, b, c])
                a, b = b, c
        return cost + float(model[a, b, 0])

    for token in ("1d10t", "st*p", "aab0", "s.c.u", "$$x", "i d i"):
        scored = [(total(*x), "".join(x[0]).strip()) for x in every(list(channel_toxicity.lattice(token)))]
        best = max(s for s, _ in scored)
        assert channel_toxicity.restore(token, model) in {t for s, t in scored if s > best - 1e-3}


def test_every_feature_that_tells_enters_the_lexicon(spark):
    names = ["".join(chr(97 + i // 26 ** k % 26) for k in (2, 1, 0)) for i in range(400)]
    bad = [" ".join(names[(i * 20 + k) % 400] for k in range(60)) for i in range(200)]
    texts = [f"{t} so{i}" for i, t in enumerate(bad)] + [f"plain words go here {i}" for i in range(2000)]
    labels = spark.createDataFrame([(i, 1, int(i < 200)) for i in range(len(texts))], "doc_id bigint, quality int, toxic int")
    model = channel_toxicity.train(documents(spark, list(enumerate(texts))), labels)
    common = {w for w, n in Counter(w for i, t in enumerate(bad) if zlib.crc32(str(i).encode()) % 5 for w in t.split()).items() if n >= 18}
    assert len(common) > 256 and common <= model.lexicon.keys()


def test_tokens_that_are_not_decoded_could_give_no_feature():
    """Features of the lexicon are the same with every disguised token decoded and with those left out that cannot reach it."""
    rng = random.Random(5)
    words = ["stupid", "idiot", "clown", "loser", "moron", "essen", "add", "boo"]
    counts = channel_toxicity.trigram_counts([" ".join(words)] * 50).reshape(28, 28, 28)
    model = np.log((counts + 0.01) / (counts + 0.01).sum(axis=2, keepdims=True)).astype(np.float32)
    lexicon = {f: (1.0, 1.0) for w in words for f in (w, w[:4] + "*")}
    every, some = channel_toxicity.Reader(model), channel_toxicity.Reader(model, lexicon)
    back = {r: k for k, rs in channel_toxicity.LEET.items() for r in rs}
    reached = 0
    for _ in range(4000):
        word = rng.choice([*words, "hello", "better", "x" * 9])
        token = "".join(rng.choice([c, c, c * 2, c * 3, back.get(c, c), rng.choice("._-* 7é!")]) for c in word) + rng.choice(["", "!", "s", "."])
        found = {f for f in every.features(token) if f in lexicon}
        assert {f for f in some.features(token) if f in lexicon} == found, token
        reached += bool(found)
        text = f"{token} so {token}"
        bias = channel_toxicity.Model(model, lexicon, -1.0)
        n, tokens = 0, every.tokens(text)
        here = Counter()
        for t, k in tokens.items():
            for f in every.features(t):
                if f in lexicon:
                    here[f] += k
        n = sum(tokens.values())
        total = bias.bias + sum(sum(w * x for w, x in zip(lexicon[f], channel_toxicity.presence_and_density(k, n))) for f, k in here.items())
        assert abs(channel_toxicity._scorer(bias)(text) - 1 / (1 + math.exp(-total))) < 1e-12, token
    assert 500 < reached < 4000


def test_sparse_newton_steps_reach_the_least_loss():
    rng = np.random.default_rng(2)
    rows = [(int(rng.random() < 0.3), 40, [int(j) for j in rng.choice(30, 4, replace=False)], [int(k) for k in rng.integers(1, 20, 4)]) for _ in range(300)]
    weights, bias = channel_toxicity._fit(rows, 30)
    x = np.zeros((300, 61))
    for i, (_, n, on, counts) in enumerate(rows):
        for j, k in zip(on, counts):
            x[i, 2 * j:2 * j + 2] = channel_toxicity.presence_and_density(k, n)
    x[:, -1] = 1
    w = np.append(weights.reshape(-1), bias)
    gradient = x.T @ (1 / (1 + np.exp(-x @ w)) - [r[0] for r in rows]) + np.append(np.full(60, 0.01), 1e-3) * w
    assert np.abs(gradient).max() < 1e-3
    assert channel_toxicity._fit([(1, 3, [], []), (0, 3, [], [])], 0)[0].shape == (0, 2)


def test_signs_at_the_ends_of_words_are_decoded():
    words = ["asshole", "dumbass", "ass", "hate", "idiot", "clown", "stupid"]
    counts = channel_toxicity.trigram_counts([" ".join(words)] * 50).reshape(28, 28, 28)
    reader = channel_toxicity.Reader(np.log((counts + 0.01) / (counts + 0.01).sum(axis=2, keepdims=True)).astype(np.float32))
    for text, word in (("@$$hole", "asshole"), ("@55hole", "asshole"), ("dumba$$", "dumbass"), ("a$$", "ass"), ("a55", "ass"), ("h473", "hate"),
                       ("!diot", "idiot"), ("(!diot!)", "idiot"), ("(lown", "clown"), ("(1d10t)", "idiot"), ("$ t u p i d", "stupid"), ("$ s t u p i d", "stupid")):
        assert word in {w for t in reader.tokens(text) for w in reader.words_of(t)}, text


@pytest.mark.parametrize("text", ["x" + "1" * 60_000, "_" * 60_000 + "a", "*" * 60_000 + "a", "a " * 30_000 + "ab", "a*" * 20_000 + "b"])
def test_long_runs_take_one_pass(text):
    """Patterns that tried every split of a run would never end here."""
    reader = channel_toxicity.Reader(np.zeros((28, 28, 28), np.float32))
    assert all(reader.features(t) is not None for t in reader.tokens(text))


@pytest.mark.parametrize("page", ["<div>" * 30_000 + "</x>" * 30_000, "<p" * 60_000, "<a \"" * 30_000, "<ul>" * 20_000 + "<li>" * 20_000, "<script>" * 20_000])
def test_broken_pages_take_one_pass(page):
    assert len(html_labeller.blocks_of(page)) <= 1


# --- language model

def test_language_model_counts_and_learns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").unionByName(documents(spark, [(i if i is None else i + 10_000, t) for i, t in AWKWARD]))
    got = gated_lm.score_documents(with_clashes(docs)).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    training = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 != 0
    count = Counter(w for i, t in texts if training(i) for w in [*space_words(t), b""])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in texts:
        words = [*space_words(t), b""]
        base = sum(np.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        want[i, not training(i), len(words), sum(count[w] > 0 for w in words), n, round(base, 3)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert gated_lm.score_documents(documents(spark, [])).count() == 0


def test_every_training_document_is_learned_once(spark, small, monkeypatch):
    docs, learned, averaged = spark.read.parquet(f"{small}/documents.parquet"), [], gated_lm._averaged

    def noted(part, fallback):
        learned.append(part.agg(F.sum("tokens")).first()[0] or 0)
        return averaged(part, fallback)

    monkeypatch.setattr(gated_lm, "_averaged", noted)
    _, known = gated_lm.count_words(docs)
    gated_lm.train(docs, known)
    assert sum(learned) == known.tokens and all(learned)


def test_language_model_learns_what_counts_cannot(spark):
    """Two invented languages share no word: the first words of a text tell which one goes on."""
    rng = np.random.default_rng(9)
    texts = [(i, " ".join(f"{'ab'[i % 2]}{k}" for k in rng.zipf(1.5, 150) % 40)) for i in range(1200)]
    got = gated_lm.score_documents(documents(spark, texts), ((1, 0.02), (1, 0.01), (1, 0.01))).collect()
    held = [r for r in got if r.held_out]
    assert (sum(r.score for r in held) - sum(r.base_score for r in held)) / sum(r.n_tokens for r in held) > 0.1


def test_language_model_is_a_distribution():
    """The next token's probabilities, one unknown word included, add up to one after any history."""
    known = gated_lm.Words([("", 30), *[("w%d" % i, 50 - i) for i in range(40)]], 1500, 60, 30)
    model = gated_lm.Model.fresh(known)
    history = [b"w3", b"w9", b"other"]
    total = 0.0
    for word in [b"", *[b"w%d" % i for i in range(40)]]:
        text = gated_lm.as_text(history + [word], known) if word else gated_lm.as_text(history, known)
        cut = gated_lm.Text(text.ranks[:4], text.inputs[:4])
        before = gated_lm.Text(text.ranks[:3], text.inputs[:3])
        total += np.exp(model.score([cut])[0] - model.score([before])[0])
    rare = gated_lm.as_text(history + [b"zzz"], known)
    total += np.exp(model.score([gated_lm.Text(rare.ranks[:4], rare.inputs[:4])])[0] - model.score([gated_lm.Text(rare.ranks[:3], rare.inputs[:3])])[0])
    assert abs(total - 1) < 1e-4


def test_truncated_backpropagation_is_exact_inside_a_window():
    rng = np.random.default_rng(0)
    known = gated_lm.Words([("w%d" % i, 100 - i) for i in range(50)], 5000, 60, 30)
    model = gated_lm.Model.fresh(known)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    texts = [gated_lm.as_text([b"w%d" % rng.integers(60) for _ in range(rng.integers(0, 9))], known) for _ in range(5)]
    lanes = gated_lm.Lanes(texts, 3)
    window, state = next(lanes.windows(100)), np.zeros((lanes.running[0], gated_lm.HIDDEN))
    _, grads, _, n = model.gradients(lanes, window, state)
    for name in model.NAMES:
        w, full = model.w[name], np.zeros_like(model.w[name])
        if name == "rows":
            full[grads["rows"][0]] = grads["rows"][1] / n
        else:
            full = grads[name]
        for i in np.argsort(-np.abs(full).ravel())[:3]:
            held = w.flat[i]
            w.flat[i] = held + 1e-5
            up = model.gradients(lanes, window, state)[0].sum()
            w.flat[i] = held - 1e-5
            down = model.gradients(lanes, window, state)[0].sum()
            w.flat[i] = held
            assert abs(-(up - down) / 2e-5 / n - full.flat[i]) < 1e-5 * max(1, abs(full.flat[i])) + 2e-6, name


def test_texts_split_together_are_split_as_alone():
    known = gated_lm.Words([("", 30), *[("w%d" % i, 50 - i) for i in range(40)]], 1500, 60, 30)
    texts = ["", None, "  w1 zzz\x0bw39\x0cd\tW3\nf\rg ", "A\x1cb\x1dc \u00c9 \u00e9 x\xa0y  Z", " ", "\u0130 \u00df  q", "a\x00b \x85 c", "\U0001f600w w2"]
    for some in ([None], ["", ""], ["w1"], texts, texts * 3):
        got = list(gated_lm.as_texts(some, known))
        want = [gated_lm.as_text(space_words(t), known) for t in some]
        assert [(x.ranks.tolist(), x.inputs.tolist()) for x in got] == [(x.ranks.tolist(), x.inputs.tolist()) for x in want]


def test_long_texts_alone_take_few_updates():
    """Where one long text runs on, a window takes more steps, so its cost is shared by more tokens; each is learned once."""
    known = gated_lm.Words([("", 30), *[("w%d" % i, 50 - i) for i in range(40)]], 1500, 60, 30)
    text = gated_lm.as_text([b"w%d" % (i % 40) for i in range(4_999)], known)
    learner = gated_lm.Learner(gated_lm.Model.fresh(known), 0.01)
    learner.learn([text])
    assert learner.tokens == 5_000 and learner.steps <= 5_000 // 100


def test_scores_do_not_depend_on_the_company():
    known = gated_lm.Words([("", 30), *[("w%d" % i, 50 - i) for i in range(40)]], 1500, 60, 30)
    model, rng = gated_lm.Model.fresh(known), np.random.default_rng(1)
    texts = [gated_lm.as_text([b"w%d" % rng.integers(50) for _ in range(rng.integers(0, 300))], known) for _ in range(30)]
    together = model.score(texts)
    assert np.allclose(together, [model.score([t])[0] for t in texts], rtol=1e-4)


# --- the pipeline

def test_pipeline_stages_against_plain_versions(spark, small, toxic_tables):
    folder = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "encoding"]
    kept = stages["toxicity"](spark, docs, folder).cache()
    assert kept.schema.names == docs.schema.names and 0.5 * docs.count() < kept.count() <= docs.count()
    once = stages["near_dedup"](spark, kept, folder).cache()
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    least = plain_components([(i, plain_fingerprint(t)) for i, t in texts])
    assert rows(once, "doc_id") == [(i,) for i in sorted(set(least.values()))]
    clean = stages["decontamination"](spark, once, folder).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = [x[0] for x in plain_contamination([(r.doc_id, r.text) for r in once.collect()], items) if not x[5]]
    assert rows(clean, "doc_id") == [(i,) for i in sorted(want)]
    hidden = stages["secrets"](spark, clean, folder).cache()
    assert rows(hidden, "doc_id") == rows(clean, "doc_id") and hidden.where("text rlike '[0-9a-f]{32}'").count() == 0
    encoded = stages["encoding"](spark, hidden, folder)
    assert encoded.count() == hidden.count()
    assert rows(corpus_pipeline.run(spark, folder), "doc_id", "ids_sha256") == rows(encoded, "doc_id", "ids_sha256")


def test_pipeline_hands_over_small_batches(spark, monkeypatch):
    """40 MB of text in one partition reach the encoder a few MB at a time, whatever the number of rows."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(docs, *_, **__):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [sum(map(len, batch.column(0).to_pylist()))]})

        return docs.select("text").mapInArrow(run, "rows long, bytes long")

    monkeypatch.setattr(corpus_pipeline.prefix_bpe, "encode_documents", sizes)
    before = spark.conf.get(limit)
    try:
        docs = spark.range(4000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"))
        got = dict(corpus_pipeline.STAGES)["encoding"](spark, docs, "").collect()
    finally:
        spark.conf.set(limit, before)
    assert sum(r.rows for r in got) == 4000
    assert max(r.bytes for r in got) <= 6_000_000


def test_all_ten_are_registered():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_check_sql(spark, small, name):
    from tools.check import compare, open_duckdb
    assert compare(spark, open_duckdb(small), small, name) == []
