import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairscope.llm import gbt, html_blocks, html_extract, langid, quality, token_counts
from pairscope.llm.common import held_out

from .data import documents, messy, messy_rows
from .layouts import LAYOUTS

SF001 = "/root/testdata/sf0.01"


# ----------------------------------------------------------------- quality
def test_trees_walk_like_a_plain_tree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.5)).astype(float)
    model = gbt.fit(x, y, trees=20)

    def walk(row):
        total = model.bias
        for t in range(len(model.feature)):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + 1 + int(row[model.feature[t, node]] > model.cut[t, node])
            total += model.value[t, node - (2 ** model.depth - 1)]
        return total
    assert np.allclose(model.margin(x), [walk(r) for r in x])
    assert ((model.score(x) > 0.5) == y).mean() > 0.98


@pytest.mark.parametrize("seed", range(4))
def test_histogram_fit_against_exact_splits(seed):
    """Few distinct values, so no bin hides a cut: every split gains as much as the best of an exhaustive search."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 6, (120, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3) ^ (rng.random(120) < 0.1)).astype(float)
    model = gbt.fit(x, y, trees=4, depth=3, rate=0.3, bins=200, penalty=1.0, least=4)
    p = (y.sum() + 1) / (len(y) + 2)
    margin = np.full(len(y), np.log(p / (1 - p)))
    assert model.bias == pytest.approx(margin[0])
    splits = 0
    for t in range(4):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)

        def gain(rows, f, cut):
            sides = [[r for r in rows if x[r, f] <= cut], [r for r in rows if x[r, f] > cut]]
            if min(map(len, sides)) < 4:
                return 0.0
            return sum(g[s].sum() ** 2 / (h[s].sum() + 1.0) for s in sides) - g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        todo = [(0, list(range(len(y))))]
        while todo:
            node, rows = todo.pop()
            if node >= 7:
                assert model.value[t, node - 7] == pytest.approx(-0.3 * g[rows].sum() / (h[rows].sum() + 1.0))
                margin[rows] += model.value[t, node - 7]
                continue
            f, cut = model.feature[t, node], model.cut[t, node]
            best = max((gain(rows, i, c) for i in range(3) for c in range(6)), default=0.0) if rows else 0.0
            if best > 1e-8:
                assert gain(rows, f, cut) == pytest.approx(best, abs=1e-9)
                splits += 1
            todo += [(2 * node + 1, [r for r in rows if x[r, f] <= cut]), (2 * node + 2, [r for r in rows if x[r, f] > cut])]
    assert np.allclose(model.margin(x), margin) and splits > 10


def test_trees_without_rows_or_with_one_class():
    assert gbt.fit(np.zeros((0, 3)), np.zeros(0)).score(np.ones((2, 3))).tolist() == [0.5, 0.5]
    assert (gbt.fit(np.ones((50, 3)), np.ones(50)).score(np.zeros((2, 3))) > 0.9).all()


@pytest.mark.parametrize("text", [None, "", " ", "a", "a b", "é\n\n", "x" * 10 ** 6])
def test_statistics_are_finite(text):
    v = quality.statistics(text)
    assert v.shape == (len(quality.NAMES),) and np.isfinite(v).all()


def test_quality_on_held_out_rows(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.1"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.score_quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 500 and (got.predicted == got.quality).mean() > 0.99
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_quality_of_messy_rows(spark):
    rows = messy(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, None), (4, 7, 0), (5, 0, 1), (5, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = quality.score_quality(rows, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows.collect())
    assert all(0 <= r.score <= 1 for r in got) and all(r.held_out for r in got if r.doc_id is None)
    assert {r.score for r in quality.score_quality(rows, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(rows.limit(0), labels).count() == 0
    bounded = quality.score_quality(documents(spark), spark.read.parquet("/root/testdata/sf0.001/labels.parquet"), max_rows=30)
    assert bounded.count() == 200


def test_quality_ignores_everything_but_the_text(spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    docs = documents(spark)
    twice = docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")).withColumn("lang", F.lit("zz")))
    got = quality.score_quality(twice, labels).toPandas()
    assert np.allclose(np.sort(got[got.doc_id.notna()].score), np.sort(got[got.doc_id.isna()].score))


# -------------------------------------------------------------- language ID
def plain_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    padded = " " + " ".join(words) + " "
    return Counter(padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)) if words else None


@pytest.mark.parametrize("text", ["", None, "12 !", "a", "Ab, c", "  xé--y\n\nz ", "Ωmega 3ß", "word " * 500])
@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_grams_against_plain_counting(text, chunk, monkeypatch):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    got, want = langid.gram_counts(text), plain_grams(text or "")
    if want is None:
        assert got is None
        return
    assert got.sum() == sum(want.values())
    assert (got > 0).sum() <= len(want) and (got > 0).sum() >= 0.97 * len(want) - 1    # some share a bucket


def test_languages_of_held_out_rows(spark):
    docs = documents(spark, SF001)
    got = langid.identify(docs).withColumn("out", held_out()).toPandas()
    assert (got.lang_pred == got.lang)[got.out].mean() > 0.99 and got.score.between(0, 1).all()


def test_held_out_languages_are_not_learned(spark):
    docs = documents(spark, SF001)
    changed = docs.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang")))
    model, other = langid.fit(docs), langid.fit(changed)
    assert model.classes == other.classes and np.array_equal(model.weights, other.weights) and model.temperature == other.temperature


def test_unknown_script_scores_low_and_sparse_weights(spark):
    model = langid.fit(documents(spark, SF001))
    for text in ("Привет мир как дела", "日本語のテキスト", "ελληνικά κείμενο"):
        assert model.probabilities(langid.gram_counts(text)).max() < 0.3
    assert 0.2 < (model.weights == 0).mean() and 0.3 < model.temperature < 3


def invented(spark, languages, texts, seed=3):
    """Texts in invented languages, each of some letter pairs of its own."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(languages):
        own = ["".join(rng.sample(letters, 2)) for _ in range(14)]
        for i in range(texts):
            words = ["".join(rng.choice(own) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 60))]
            rows.append((1000 * k + i, " ".join(words), f"l{k}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


STRANGE = ["Привет мир как дела сегодня у вас дома", "日本語のテキストをここに書いてください", "ελληνικά κείμενο για τον κόσμο"]


@pytest.mark.parametrize("languages, texts", [(1, 40), (2, 40), (4, 40), (40, 30)])
def test_identified_languages_however_many_there_are(spark, languages, texts):
    docs, rows = invented(spark, languages, texts)
    strange = spark.createDataFrame([(10 ** 6 + i, t, None) for i, t in enumerate(STRANGE)], docs.schema)
    kept = {r.doc_id for r in langid.keep_identified(docs.unionByName(strange)).collect()}
    assert kept == {r[0] for r in rows}                                  # no clear text goes, no strange script stays


def test_only_the_most_frequent_of_too_many_languages_are_learned(spark):
    docs, rows = invented(spark, 6, 20)
    dirty = docs.unionByName(spark.range(40).selectExpr("id + 50000", "'some odd text'", "concat('junk', id)").toDF(*docs.columns))
    model = langid.fit(dirty, max_rows=100, max_languages=6)
    assert model.classes == [f"l{k}" for k in range(6)]


def test_ftrl_against_a_scalar_update():
    rng = np.random.default_rng(4)
    rows = [(np.sort(rng.choice(9, 3, replace=False)), rng.random(3), int(rng.integers(3))) for _ in range(12)]
    weights, bias = langid.ftrl(rows, 3, epochs=2, alpha=0.4, beta=1.0, l1=0.05, l2=0.3, seed=9)
    z, n = {}, {}

    def w(key):
        zs, ns, l1 = z.get(key, 0.0), n.get(key, 0.0), 0.0 if key[0] == "bias" else 0.05
        return 0.0 if abs(zs) <= l1 else -(zs - (1 if zs > 0 else -1) * l1) / ((1.0 + ns ** 0.5) / 0.4 + 0.3)
    order = np.random.default_rng(9)
    for _ in range(2):
        for i in order.permutation(len(rows)):
            slots, x, y = rows[i]
            held = [(int(s), float(v)) for s, v in zip(slots, x)] + [("bias", 1.0)]
            logit = [sum(v * w((s, c)) for s, v in held) for c in range(3)]
            e = [np.exp(l - max(logit)) for l in logit]
            old = {(s, c): w((s, c)) for s, _ in held for c in range(3)}
            for c in range(3):
                error = e[c] / sum(e) - (c == y)
                for s, v in held:
                    g, ns = v * error, n.get((s, c), 0.0)
                    z[s, c] = z.get((s, c), 0.0) + g - ((ns + g * g) ** 0.5 - ns ** 0.5) / 0.4 * old[s, c]
                    n[s, c] = ns + g * g
    assert np.allclose(bias, [w(("bias", c)) for c in range(3)])
    assert np.allclose(weights[:9], [[w((s, c)) for c in range(3)] for s in range(9)]) and not weights[9:].any()


def test_temperature_against_a_grid():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 60)
    logits = rng.normal(size=(60, 3)) * 4
    logits[np.arange(60), y] += 3
    target = np.full((60, 3), 1 / 62 / 2)
    target[np.arange(60), y] = 1 - 1 / 62

    def loss(t):
        v = logits / t
        return float(np.mean(np.log(np.exp(v).sum(axis=1)) - (target * v).sum(axis=1)))
    got = langid.calibrate(logits, y)
    assert loss(got) <= min(loss(t) for t in np.exp(np.linspace(-4, 4, 2000))) + 1e-9


def test_language_of_messy_rows(spark):
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(messy(spark)).where("doc_id >= 9000").collect()}
    assert all(got[i] == ("und", 0.0) for i in (9001, 9002, 9003, 9004))
    rows = messy(spark)
    kept = langid.keep_identified(rows)
    assert kept.columns == rows.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {9001, 9002, 9003, 9004} & set(ids) and ids.count(messy_rows(spark)[3][0]) == 3
    unlabelled = langid.identify(rows.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert langid.identify(rows.limit(0)).count() == 0


# -------------------------------------------------------------- token counts
@pytest.fixture(scope="module")
def encoder():
    with open(token_counts.VOCABULARY, "rb") as f:
        return token_counts.Encoder(f.read(), token_counts.PATTERN)


TEXTS = ["", "a", "\n", "Hello world\n\n\n  indented é 日本 🙂🙂\nlast", "x\n" * 50, "tab\t\n \n  \nend ", "<|endoftext|> as text"]


@pytest.mark.parametrize("text", TEXTS)
def test_spans_cover_the_text(encoder, text):
    start, end = encoder.spans(text)
    assert len(start) == len(encoder.encoding.encode_ordinary(text))
    assert (start < end).all() and (not text or (start[0], end[-1]) == (0, len(text)))
    assert (start[1:] <= end[:-1]).all() and (start[1:] >= end[:-1] - 1).all()    # a character is shared at most


def test_long_white_space_is_cut_where_the_pattern_cuts(encoder, monkeypatch):
    monkeypatch.setattr(token_counts, "LONG", 3)
    monkeypatch.setattr(token_counts, "RUNS", re.compile(f"[{token_counts.WHITE}]{{2,}}"))
    rng = random.Random(6)
    pieces = [" ", "  ", "\n", "\n\n\n", "\t \t", "\xa0", "\u2003\u2003", "\u3000", "\r\n" * 3, " " * 9, "word", "it's", "12", "!?", "é", "日本", "\x1c\x1c\x1c\x1c"]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 30)))
        assert encoder.ids(text).tolist() == encoder.encoding.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("unit", [" ", "\n", "x", " \n"])
@pytest.mark.parametrize("n", [10 ** 6, 5 * 10 ** 6])
@pytest.mark.parametrize("around", [("", ""), ("head", "tail of it")])
def test_very_long_runs(encoder, unit, n, around):
    if unit == "x" and n > 10 ** 6:
        n = 2 * 10 ** 6
    text = around[0] + unit * (n // len(unit)) + around[1]
    ids = encoder.ids(text)
    assert encoder.lengths[ids].sum() == len(text)
    start, end = encoder.spans(text)
    assert (start[0], end[-1]) == (0, len(text)) and (start[1:] == end[:-1]).all()
    if unit != "x":                                                     # the same tokens as of a run that the pattern can bear
        short = around[0] + unit * (200_000 // len(unit)) + around[1]
        want = encoder.encoding.encode_ordinary(short)
        assert encoder.ids(short).tolist() == want
        assert ids[:50].tolist() == want[:50] and ids[-20:].tolist() == want[-20:]


def test_very_long_runs_in_a_job(spark):
    rows = [(1, " " * 3_000_000 + "a"), (2, "a\n" + "\t" * 2_000_000 + "b"), (3, "plain text")]
    got = token_counts.section_tokens(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("doc_id").sum("tokens").collect()
    assert {r[0] for r in got} == {1, 2, 3} and all(r[1] > 0 for r in got)


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("rule", token_counts.RULES)
def test_allocation_against_every_pair(encoder, text, rule):
    rng = random.Random(len(text))
    for trial in range(20):
        cuts = sorted(rng.choices(range(len(text) + 1), k=6))
        lo, hi = np.array(cuts[::2]), np.array(cuts[1::2])
        if trial == 0:
            lo, hi = token_counts.line_sections(text)
        start, end = encoder.spans(text)
        want, cross = np.zeros(len(lo)), np.zeros(len(lo), int)
        for s, e in zip(start, end):
            held = [(min(e, h) - max(s, l), i) for i, (l, h) in enumerate(zip(lo, hi)) if min(e, h) > max(s, l)]
            whole = len(held) == 1 and held[0][0] == e - s
            if not whole:
                for _, i in held:
                    cross[i] += 1
            if held and rule == "split":
                for n, i in held:
                    want[i] += n / (e - s)
            elif held:
                want[held[0][1] if rule == "first" else max(held, key=lambda x: (x[0], -x[1]))[1]] += 1
        tokens, crossing = token_counts.allocate(start, end, lo, hi, rule)
        assert np.allclose(tokens, want) and crossing.tolist() == cross.tolist()


def test_section_tokens_add_up(spark, encoder):
    got = token_counts.section_tokens(messy(spark)).toPandas()
    rows = messy_rows(spark)
    assert got.tokens.sum() == sum(len(encoder.encoding.encode_ordinary(r[1] or "")) for r in rows)
    assert len(got) == sum((r[1] or "").count("\n") + 1 for r in rows)
    assert got.doc_id.isna().sum() == sum((r[1] or "").count("\n") + 1 for r in rows if r[0] is None)
    assert token_counts.section_tokens(messy(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        token_counts.section_tokens(messy(spark), rule="other")


def test_field_tokens(spark, encoder):
    df = spark.createDataFrame([(1, "Title", "Some body text"), (2, None, "x"), (3, "", None)], "id long, a string, b string")
    got = {(r.id, r.section): r.tokens for r in token_counts.field_tokens(df, "id", ["a", "b"]).collect()}
    whole = len(encoder.encoding.encode_ordinary("Title\nSome body text"))
    assert got[(1, 0)] + got[(1, 1)] == whole - 1 and got[(2, 0)] == 0 and got[(2, 1)] == 1 and got[(3, 1)] == 0
    assert len(got) == 6


# ----------------------------------------------------------- HTML extraction
@pytest.mark.parametrize("page,want", [
    ("", []), (None, []), ("plain", ["plain"]), ("<p>a<b>b</b> c &amp; d &lt;x", ["ab c & d <x"]),
    ("<div>1 < 2 <!-- x --> y</div>", ["1 < 2 y"]), ("<script>if(a</b)</script>z", ["z"]), ("<script>never closed <p>x", []),
    ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("&nbsp;&copy;&#8364;&#x41;&amp", ["©€A&"]),
    ("<style>p{}</style><title>t</title><svg><text>s</text></svg><p>\n a \t b<br>c</p>", ["a b c"]),
    ("<a title='x>y'>t</a>", ["t"]), ("<P>One<P>Two</DIV>three", ["One", "Twothree"]), ("<p class=\"a", []), ("<", ["<"]), ("<<p>x", ["<", "x"]),
])
def test_blocks(page, want):
    assert [b.text for b in html_blocks.blocks_of(page)] == want


@pytest.mark.parametrize("page,want", [
    ("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='application/x-tex'>x=1</annotation></math> holds.</p>", ["So x=1 holds."]),
    ("<p>See <svg><title>icon</title><style>t{}</style><desc>d</desc><text>Left</text><text>Right</text></svg> there.</p>", ["See Left Right there."]),
    ("<svg><text>s</text></svg><p>a</p>", ["a"]), ("<svg><path><p>a</p>", ["a"]), ("<p>a<xmp><b>x</b> &amp;</xmp>b", ["a", "<b>x</b> &amp;", "b"]),
    *[(f"<div><div>a<{tag} data=x>fallback</div><p>b</p></div><p>c</p>", ["a", "b", "c"]) for tag in ("object", "video", "audio", "canvas", "select")],
    ("<p>a<video src=x>fallback<p>b<p>c", ["a", "b", "c"]), ("<p>a<object><p>fallback</p></object>b</p><p>c", ["a", "b", "c"]),
    ("<div>a<video><div>fallback</video>b</div>c", ["a", "b", "c"]), ("<p>a<video>x<object>y</video>b</p>", ["ab"]),
    ("<p>a<template><p>x</p></template>b</p>", ["a", "b"]), ("</video><p>a</object>b</p>", ["ab"]),
])
def test_hidden_elements_end_and_shown_ones_stay(page, want):
    assert [b.text for b in html_blocks.blocks_of(page)] == want


@pytest.mark.parametrize("depth", [3, 511, 512, 513, 700])
def test_ends_beyond_the_depth_close_what_they_opened(depth):
    page = "<article>" + "<div>" * depth + "<p>inner</p>" + "</div>" * depth + "<p>after</p></article><footer><p>end</p></footer>"
    blocks = html_blocks.blocks_of(page)
    assert [b.text for b in blocks] == ["inner", "after", "end"]
    assert blocks[1].path == ("article", "p") and blocks[2].path == ("footer", "p")
    odd = html_blocks.blocks_of("<div>" * depth + "<ul><li>a<li>b</ul><p>c" + "</div>" * depth + "d")
    assert [b.text for b in odd] == ["a", "b", "c", "d"] and odd[-1].path == ()


def test_deep_and_broken_pages_take_bounded_time():
    assert len(html_blocks.blocks_of("<div>x" * 20_000)) == 20_000
    assert html_blocks.blocks_of("<div class='" * 100_000) == []


def test_gradients_by_differences():
    data = html_extract.training_pages(2, 5)
    model = html_extract.Labeller({k: v.astype(np.float64) for k, v in html_extract.initial(1).items()})
    pages = [d[0] for d in data]
    label, weight = np.concatenate([d[1] for d in data]), np.concatenate([d[2] for d in data])

    def loss():
        p = html_extract.sigmoid(model.run(pages)[0])
        return float(-(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum() / weight.sum())
    grad = model.gradients(pages, label, weight)
    rng = np.random.default_rng(0)
    for name in ("fx", "fh", "f0", "bx", "bh", "out", "path"):
        flat = model.p[name].reshape(-1)
        used = np.flatnonzero(np.abs(grad[name].reshape(-1)) > 1e-3)
        for i in rng.choice(used, 3):
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert grad[name].reshape(-1)[i] == pytest.approx((up - down) / 2e-2, rel=0.08, abs=3e-4)


def test_labels_of_unseen_generated_pages():
    model = html_extract.train()
    right = [(model.run([p])[0] > 0) == (l > 0) for p, l, _ in html_extract.training_pages(150, 77)]
    assert np.concatenate(right).mean() > 0.98


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    got = html_extract.extract(pages).toPandas()
    html = {r.page_id: r.html for r in pages.collect()}
    for r in got.itertuples():
        article = re.search(r"<article>(.*)</article>", html[r.page_id], re.S)[1]
        import html as H
        plain = H.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", article)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)


@pytest.fixture(scope="module")
def labeller():
    return html_extract.train()


@pytest.mark.parametrize("name, page, want", LAYOUTS, ids=[x[0] for x in LAYOUTS])
def test_layouts_that_the_generator_does_not_make(labeller, name, page, want):
    blocks = html_blocks.blocks_of(page)
    keep = html_extract.label_pages(labeller, [blocks], (html_blocks.Slots(html_blocks.PATH_SLOTS), html_blocks.Slots(html_blocks.WORD_SLOTS)))[0]
    assert " ".join(b.text for b, k in zip(blocks, keep) if k) == want


def test_pages_with_other_layouts(spark):
    page = ("<html><body><header class=site-header><a href=/>Logo</a><nav><ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul></nav></header>"
            "<div class=cookie-notice>We use cookies. <button>Accept</button></div><main><article class=post><h1>Title of it</h1>"
            "<p>First paragraph of the story, with words.</p><p>Second one &amp; more.</p><div class=advert>Buy now</div><p>Short.</p></article></main>"
            "<aside class=sidebar><h3>Related</h3><ul><li><a href=/x>Other story</a></ul></aside>"
            "<section id=comments><div class=comment><p>Nice text, I liked it a lot.</p></div></section>"
            "<form class=search-form><label>Search</label><input></form><footer><p>&copy; 2024 All rights reserved</p></footer></body></html>")
    rows = [(1, "u", page, "old"), (1, "u", page, "old"), (2, None, None, None), (None, "v", "", None), (3, "w", "<p></p>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract(df).collect()
    assert [r.page_id for r in got] == [1, 1, 2, None, 3]
    assert got[0].text == got[1].text == "Title of it First paragraph of the story, with words. Second one & more. Short."
    assert [(r.text, r.n_chars) for r in got[2:]] == [("", 0)] * 3
    assert html_extract.extract(df.limit(0)).count() == 0
