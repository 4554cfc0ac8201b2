"""HTML extraction: messages against enumeration, held-out pages and layouts, edge cases."""

import html as entities
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from ledgerlake.llm import common, html_extract as h


def marked(page):
    inside = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S).group(1)
    return " ".join(entities.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inside))).split())


@pytest.fixture(scope="module")
def model(spark):
    return h.train(h.labelled(h.sample(common.table(spark, SF0001, "pages"), "page_id", "html")))


def main_text(page, model):
    return h.texts_of([h.parse(page)], model)[0]


def test_messages_equal_enumeration():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 9):
        tree = h.Tree()
        for i in range(n):
            tree.add(-1 if i == 0 else int(rng.integers(0, i)), int(rng.integers(0, len(h.TAGS))))
        f = h.forest([tree])
        model = h.Model(rng.normal(size=h.FEATURES), rng.normal(size=(len(h.TAGS), 2, 2)))
        own = model.weights[f.columns].sum(axis=1)
        total, one = 0.0, np.zeros(n)
        for states in itertools.product((0, 1), repeat=n):
            score = sum(own[i] * s for i, s in enumerate(states))
            score += sum(model.edges[tree.kind[i], states[tree.parent[i]], states[i]] for i in range(1, n))
            total += np.exp(score)
            one += np.exp(score) * np.array(states)
        assert np.allclose(h.marginals(f, model)[0], one / total)


def test_gradient_of_likelihood_vanishes_after_training():
    """Expected counts of the trained field approach those of the labels."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    trees = [h.parse(h.layout(words, rng), True) for _ in range(60)]
    model = h.train(trees)
    p = h.marginals(h.forest(trees), model)[0]
    y = np.concatenate([t.label for t in trees])
    assert np.mean((p >= 0.5) == y) > 0.99 and abs(p.sum() - y.sum()) < 0.01 * y.sum()


def test_query_on_given_pages(spark):
    """Trained on a sample, right on all pages of the table."""
    rows = {r.page_id: r for r in h.op12_html_extract(spark, SF001).collect()}
    pages = common.table(spark, SF001, "pages").collect()
    assert len(rows) == len(pages)
    assert all(rows[p.page_id].text == marked(p.html) for p in pages)
    assert all(r.n_chars == len(r.text) for r in rows.values())


def test_held_out_layouts(spark, model):
    rng, whole, got, want, both = random.Random(77), 0, 0, 0, 0
    pages = [h.layout(marked(r.html).split() or ["none"], rng) for r in common.table(spark, SF001, "pages").collect()]
    for page in pages:
        tree = h.parse(page, True)
        p = h.marginals(h.forest([tree]), model)[0]
        runs = [i for i, k in enumerate(tree.kind) if k == 0]
        whole += all((p[i] >= 0.5) == tree.label[i] for i in runs)
        got += sum(tree.chars[i] for i in runs if p[i] >= 0.5)
        want += sum(tree.chars[i] for i in runs if tree.label[i])
        both += sum(tree.chars[i] for i in runs if tree.label[i] and p[i] >= 0.5)
    assert whole / len(pages) > 0.88 and both / got > 0.98 and both / want > 0.98


BODY = ("<h1>Rivers of the north</h1><p>The long river runs&nbsp;through <b>three</b> old towns, and its banks are green.</p>"
        "<p>Boats carry timber &amp; salt\n to the\tsea every spring, as they did before.</p>")
TEXT = ("Rivers of the north The long river runs through three old towns, and its banks are green. "
        "Boats carry timber & salt to the sea every spring, as they did before.")


@pytest.mark.parametrize("page", [
    f"<body><nav><a href=/>Home</a> <a href=/a>All</a></nav><main>{BODY}</main><footer>&copy; 2020 Us</footer></body>",
    f"<div id=header><h2>Our site</h2></div><div class='post-content'>{BODY}</div><div class=sidebar><h3>More</h3><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></div>",
    f"<div class='cookie-notice'><p>We use cookies to make this site work for you.</p><button>Fine</button></div><article>{BODY}</article>",
    f"<article>{BODY}</article><section id=comments><h3>2 comments</h3><ol><li><p>I like this river very much, it is fine.</p></li></ol></section>",
    f"<article>{BODY}<form><label>Your mail</label><input name=m><textarea>Say it</textarea></form></article>",
    f"<article>{BODY}<div class=advert>Buy our boats now, they are cheap.</div></article><script>var a='<p>no</p>';</script>",
    f"<style>p {{}}</style><article><!-- <p>hidden</p> -->{BODY}<script>if (1 < 2) x('</p>')</script></article><aside>See also this page.</aside>",
    f"<article>{BODY}",
])
def test_roles(model, page):
    assert main_text(page, model) == TEXT


def test_parser():
    text = lambda page: " ".join("".join(x for _, x in h.parse(page).pieces).split())
    assert text("a<b>b</b>c<p>d<br>e<li>f<td>g") == "abc d e f g"
    assert text("1 < 2 & 3 &lt; 4 &#65; &bogus; <p title='a > b'>x") == "1 < 2 & 3 < 4 A &bogus; x"
    assert text("<p>a<!-- never ends <p>b") == "a" and text("<script>never ends <p>b") == ""
    assert text("<p class=\"x>y<p>z") == "y z" and text("</p></div>a</div>b") == "ab"
    assert text("") == "" and h.parse("").parent == [-1]
    tree = h.parse("<ul><li>a<li>b</ul><p>c<p>d")
    assert [h.TAGS[k] for k in tree.kind] == ["body", "ul", "li", "#text", "li", "#text", "p", "#text", "p", "#text"]
    assert tree.parent == [-1, 0, 1, 2, 1, 4, 0, 6, 0, 8]


def test_long_and_deep_pages_take_linear_time(model):
    for page in ("<div>" * 20_000 + "x", "<p>word word.</p>" * 40_000, "<a \"" * 20_000, "<!--" * 50_000, "&amp" * 100_000,
                 "<" * 200_000, "<script>" * 20_000, "<article><p>" + "word " * 400_000):
        start = time.time()
        main_text(page, model)
        assert time.time() - start < 20, page[:20]


def test_edge_rows(spark):
    """Null and empty pages, null keys, equal rows, clashing and dotted names."""
    page = f"<html><body><article>{BODY}</article><footer>&copy; all rights</footer></body></html>"
    rows = [(None, None, None), (1, "u", ""), (2, None, page), (2, None, page), (3, "v", "   "), (None, "w", page), (4, "z", "plain words only.")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("main_text"), F.lit(2).alias("a.b"))
    got = h.extract(df, ["page_id", "url", "main_text", "a.b"]).collect()
    texts = sorted((r.doc.page_id or -1, r.doc.url or "", r.main_text) for r in got if (r.doc.page_id, r.doc.url) != (4, "z"))
    assert texts == [(-1, "", ""), (-1, "w", TEXT), (1, "u", ""), (2, "", TEXT), (2, "", TEXT), (3, "v", "")]
    assert len(got) == len(rows)
    assert h.extract(df.where("false"), ["page_id"]).collect() == []
