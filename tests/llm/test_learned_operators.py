import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import html_extract, language_id, pii, toxicity
from tests.llm.conftest import ODD

# --- personal data ------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def _keeps(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def _base(text):
    found = [
        (m.start(), m.end(), kind)
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if _keeps(kind, m.group())
    ]
    return sorted(found, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    alphabet = list("aZ0123456789.@+-() _%é\n") + ["@x.de", "+49 30 ", "4111111111111111", "1.2.3.4"]
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(30)))
        assert pii.base_spans(text) == _base(text), text
    assert pii.base_spans("1" * 50_000 + "a" * 50_000 + "." * 9) == []


@pytest.fixture(scope="module")
def field():
    return pii.trained_field()


def test_viterbi_finds_the_best_path(field):
    rng = np.random.default_rng(1)
    small = pii.ChainField(3, field.known)
    small.pairs, small.first = rng.normal(size=(3, 3)), rng.normal(size=3)
    begins = np.array([0, 4, 5])
    scores = rng.normal(size=(8, 3))
    got = small.decode(scores, begins)
    for low, high in ((0, 4), (4, 5), (5, 8)):

        def value(path):
            steps = sum(small.pairs[a, b] for a, b in zip(path, path[1:]))
            return small.first[path[0]] + steps + sum(scores[low + i, y] for i, y in enumerate(path))

        best = max(itertools.product(range(3), repeat=high - low), key=value)
        assert got[low:high].tolist() == list(best)


def test_held_out_sentences(field):
    features, begins, labels = pii._flat(pii.training_sentences(600, seed=123))
    got = field.decode(field.scores(field.buckets(features, begins)), begins)
    assert (got == labels).mean() > 0.99
    assert ((got == labels) & (labels > 0)).sum() / (labels > 0).sum() > 0.95


def test_spans_add_to_the_base(documents, field):
    secret = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    rows = [(1, f"é Write to ana.b@mail.example.com now. token = \"{secret}\" and more"), (2, "Clean words only, version 2.0.")]
    got = {r.doc_id: r for r in pii.with_spans(documents(rows, extra=True), field).collect()}
    cut = {(rows[0][1][s.start : s.end], s.kind) for s in got[1].spans}
    assert cut == {("ana.b@mail.example.com", "email"), (secret, "secret")}
    assert [s.kind for s in got[1].base] == ["email"] and got[2].spans == []


def test_spans_do_not_depend_on_the_chunk(documents, field, monkeypatch):
    rows = [(i, f"call +1 (678) 555-52{i:02d} or mail x{i}@b.org. " * 3) for i in range(40)]
    whole = sorted(map(str, pii.with_spans(documents(rows), field).collect()))
    assert all(s.count("phone") == 6 for s in whole)


def test_redaction(documents, field):
    df = documents([*ODD, (9, "é mail a.b@c.de, ip 10.0.0.1 end")], extra=True).withColumn("n_chars", F.length("text").cast("long"))
    done = pii.redact(df, field)
    assert done.columns == df.columns and done.count() == len(ODD) + 1
    row = done.where("doc_id = 9").first()
    assert (row.text, row.n_chars) == ("é mail <EMAIL>, ip <IP> end", 27)
    assert done.where("doc_id = 1").first().text is None
    assert pii.redact(documents([]), field).count() == 0


# --- toxicity -----------------------------------------------------------------------------------


def _maximal(values):
    """All maximal-scoring segments by their definition: the best one, then the same left and right of it."""
    found = []

    def split(low, high):
        best, where = 0, None
        for a in range(low, high):
            for b in range(a + 1, high + 1):
                total = sum(values[a:b])
                if total > best + 1e-12:
                    best, where = total, (a, b)
        if where:
            split(low, where[0])
            found.append((where[0], where[1] - 1, best))
            split(where[1], high)

    split(0, len(values))
    return found


def test_segments_equal_their_definition():
    rng = random.Random(7)
    for _ in range(300):
        size, rest = rng.randint(1, 25), -rng.choice([0.3, 0.7, 1.1])
        places = sorted(rng.sample(range(size), rng.randint(0, size)))
        scores = [rng.choice([0.45, 1.3, 2.9]) + rng.random() / 100 for _ in places]
        values = [rest] * size
        for p, s in zip(places, scores):
            values[p] = s
        got = toxicity.maximal_segments(places, scores, rest)
        want = _maximal(values)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{c}{d}".replace("0", "o") for c in "abcdefghij" for d in "klmnopqrst"]
    rows = []
    for i in range(900):
        text = rng.choices(words, k=rng.randint(20, 120))
        toxic = i % 6 == 0
        if toxic:
            at = rng.randrange(len(text))
            text[at:at] = rng.choices(["vile", "nasty", "rotten"], k=rng.randint(1, 4))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_toxic_documents_are_told_apart(documents, spark, corpus):
    docs = documents([(i, t) for i, t, _ in corpus], extra=True)
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.where("doc_id % 3 <> 1"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(i, y) for i, _, y in corpus if i % 3 == 1]
    assert sum(got[i].predicted == y for i, y in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    for i, text, y in corpus[:60]:
        marked = [text[p.start : p.end] for p in got[i].passages]
        assert bool(y) == any(re.search("vile|nasty|rotten", m) for m in marked)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if not r.predicted}


def test_an_id_has_one_label(documents, spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, 0), (2, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    docs = documents([(1, "first"), (1, "again"), (2, "second"), (3, "third"), (None, "fourth")])
    sample = toxicity._sample(docs, labels, 1000)
    assert sorted(map(tuple, sample.collect())) == [(0, "second"), (1, "again"), (1, "first")]


def test_toxicity_of_odd_rows_and_without_labels(documents, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(documents(ODD), none)
    got = toxicity.score(documents(ODD, extra=True), model).collect()
    assert len(got) == len(ODD) and all(r.predicted == 0 and 0 <= r.score <= 1 for r in got)
    assert toxicity.score(documents([]), model).count() == 0
    one_class = spark.createDataFrame([(4, 1)], "doc_id long, toxic int")
    assert toxicity.score(documents(ODD), toxicity.train(documents(ODD), one_class)).count() == len(ODD)


# --- language -----------------------------------------------------------------------------------

SAMPLES = {
    "en": "the of and to in that was for with which from have this were are been other their",
    "de": "der die und das nicht für über können müssen werden größer schön ist auch einer",
    "fr": "les des être où après très même français leçon déjà avec dans une qui pour",
}


def _language_rows(count, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        lang = rng.choice(sorted(SAMPLES))
        rows.append((i, " ".join(rng.choices(SAMPLES[lang].split(), k=rng.randint(2, 30))), lang))
    return rows


def test_languages_are_told_apart(spark):
    schema = "doc_id long, text string, lang string"
    rows = _language_rows(400, 3)
    model = language_id.train(spark.createDataFrame([*rows, (None, "x", "xx"), (9, None, "yy"), (8, "z", None)], schema))
    assert model.languages == ["de", "en", "fr"]
    test = spark.createDataFrame(_language_rows(300, 4), schema)
    got = language_id.predict(test, model).join(test, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(0 < r.score <= 1 for r in got)


def test_scores_are_posteriors(spark):
    rows = _language_rows(60, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(df)
    got = {r.doc_id: r for r in language_id.predict(df, model).collect()}
    for i, text, _ in rows[:20]:
        data = np.frombuffer(text.encode(), np.uint8)
        buckets, _, _ = language_id.gram_buckets(data, np.array([0, len(data)]), language_id.BUCKETS)
        total = model.log_prior.astype(float).copy()
        for bucket in np.concatenate(buckets):
            total += model.log_probability[bucket]
        want = np.exp(total - total.max())
        want /= want.sum()
        assert got[i].lang_pred == model.languages[int(want.argmax())]
        assert got[i].score == pytest.approx(want.max(), abs=1e-4)


def test_language_of_odd_rows(documents, spark):
    model = language_id.train(spark.createDataFrame(_language_rows(50, 2), "doc_id long, text string, lang string"))
    rows = [*ODD, (20, "12 34 - !?"), (21, "漢字")]
    got = language_id.predict(documents(rows, extra=True), model).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 20)} == {"und"}
    assert next(r for r in got if r.doc_id == 21).lang_pred in model.languages
    nothing = language_id.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {(r.lang_pred, r.score) for r in language_id.predict(documents(ODD), nothing).collect()} == {("und", 0.0)}


# --- pages --------------------------------------------------------------------------------------


def _page(*body):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body>{''.join(body)}</body></html>"


ARTICLE = "<h1>Head &amp; line</h1><p>First  text\n of it, which is <b>bold</b>.<p>Second &eacute;&#33; one.</p><ul><li>a point made</li></ul>"
EXPECTED = "Head & line\nFirst text of it, which is bold.\nSecond é! one.\na point made"


@pytest.mark.parametrize(
    "before, after",
    [
        ("<nav><ul><li><a href=/>Home</a></li></ul></nav>", "<footer>&copy; Some site</footer>"),
        ('<header class="site-header"><a href="/">Site</a></header>', '<aside><h3>More</h3><a href="/">Other story</a></aside>'),
        ('<div class="cookie-banner"><div>We use cookies here.</div></div>', '<div class="ad">Buy now, it is cheap.</div>'),
        ("<!-- note -->", '<section id="comments"><h3>Comments</h3><div class="comment"><p>I liked it very much indeed.</p></div></section>'),
        ('<form action="/s"><label>Search</label><input><button>Go</button></form>', "<style>p{}</style>"),
    ],
)
@pytest.mark.parametrize("frame", ["<article>{}</article>", '<div class="post-content">{}</div>', "<main><div>{}</div></main>"])
def test_main_text(before, after, frame):
    page = _page(before, frame.format(ARTICLE), after)
    assert html_extract.main_texts([page], html_extract.trained_model()) == [EXPECTED]


def test_sum_product_gives_exact_marginals():
    rng = np.random.default_rng(0)
    trees = [html_extract.parse(p) for p in ("<div><p>a</p>b<p>c</p></div>", "x", "<ul><li>q<li>r</ul>")]
    names = {}
    for tree in trees:
        for features in tree.features:
            for name in features:
                names.setdefault(name, len(names))
    model = html_extract.TreeModel(names, rng.normal(size=len(names)), rng.normal(size=(2, 2, 2)))
    got = model.content(html_extract.grow(trees, names))
    base = 0
    for tree in trees:
        forest = html_extract.grow([tree], names)
        unary, size = model.unary(forest), len(tree.parents)
        total, content = 0.0, np.zeros(size)
        for labels in itertools.product((0, 1), repeat=size):
            score = sum(unary[i, y] for i, y in enumerate(labels))
            score += sum(model.edges[forest.kind[i], labels[p], labels[i]] for i, p in enumerate(tree.parents) if p >= 0)
            total += np.exp(score)
            content += np.exp(score) * np.array(labels)
        assert np.allclose(got[base : base + size], content / total)
        base += size


@pytest.mark.parametrize("kind", ["button", "svg", "noscript", "video", "select", "canvas", "template"])
def test_elements_that_are_never_closed_hide_nothing_after_them(kind):
    texts = lambda page: list(html_extract.parse(page).texts.values())
    rest = "<p>second</p></article><p>third</p>"
    assert texts(f"<article><p>first <{kind}></p>{rest}") == ["first", "second", "third"]
    assert texts(f"<{kind}><p>first</p>") == ["first"]
    # the end tag belongs to a later one: the open one ends with its parent
    closed = f"<div><{kind}>y</{kind}>fourth</div>"
    assert texts(f"<article><p>first <{kind}>x</p>{rest}{closed}") == ["first", "second", "third", "fourth"]
    assert texts(f"<div>a<{kind}>x</{kind.upper()}>b</div>") == ["ab"]


def test_what_is_skipped_may_hold_blocks_and_its_own_kind():
    texts = lambda page: list(html_extract.parse(page).texts.values())
    assert texts("<div>a<noscript><div>x<p>y</div>z</noscript>b</div>c") == ["ab", "c"]
    assert texts("<div>a<svg><g><svg>x</svg>y</g><foreignObject><div>z</div></foreignObject>w</svg>b</div>") == ["ab"]
    assert texts("<div>a<svg>x<p>b</p>c</svg></div>") == ["a", "b", "c"]
    assert texts("<p>It is <output>42</output> <meter>7 of 9</meter> <math><mi>x</mi></math>.</p>") == ["It is 42 7 of 9 x."]
    many = "<div><button>x" * 3000 + "</div>" * 3000 + "<p>end</p>"
    assert texts(many)[-1] == "end" and len(texts(many)) == 3001


def test_held_out_pages():
    model = html_extract.trained_model()
    trees = [html_extract.parse(p) for p in html_extract.labelled_pages(120, seed=99)]
    labels = np.concatenate([html_extract.labels_of(t) for t in trees])
    forest = html_extract.grow(trees, model.names)
    text = forest.kind == 1
    assert ((model.content(forest) > 0.5) == labels)[text].mean() > 0.97


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep down there is a text" + "</div>" * 3000
    pages = [None, "", "   ", "no markup at all, just a line.", "<p>open <b>tags", "</div></p>stray", "<script>never closed", "<!-- open", deep, "<p>a" * 2000, "<<>&&;<p <p>&bogus; x"]
    rows = [(i, f"u{i}", p) for i, p in enumerate(pages)] + [(0, None, None), (None, "u", "<p>text of a page.</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = html_extract.extract(df).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got if r.url}
    assert by_id[0] == by_id[1] == by_id[2] == "" and by_id[3] == pages[3]
    assert html_extract.extract(df.limit(0)).count() == 0


def test_personal_data_over_a_long_stretch_without_stops(documents):
    filler = ["word"] * 126
    texts = {k: " ".join([*filler, *["word"] * k, "call", "(212)", "555-0199", *filler * 3]) for k in range(6)}
    whole = {r.doc_id: r.spans for r in pii.with_spans(documents([(9, "word word call (212) 555-0199 word word word")])).collect()}
    length = sum(s["end"] - s["start"] for s in whole[9])
    for r in pii.with_spans(documents(texts.items())).collect():
        assert sum(s["end"] - s["start"] for s in r.spans) == length > 0
