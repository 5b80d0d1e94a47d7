import html
import itertools
import re

import numpy as np
import pytest

from daytally.llm.html_extract import Field, blocks, features, labelled_page, main_text, main_texts, train
from daytally.llm.page_templates import Maker

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def model():
    return train()


def test_unseen_labelled_pages(model):
    right = total = 0
    for number in range(200):
        page, labels = labelled_page(Maker(700_000_000 + number).page())
        right += sum(a == b for a, b in zip(labels, model.decode(features(page)), strict=True))
        total += len(labels)
    assert right / total >= 0.97


def test_articles_of_the_table_come_out_whole(spark, medium, model):
    pages = spark.read.parquet(f"{medium}/pages.parquet")
    got = {r.page_id: r for r in main_texts(pages, model).collect()}
    for page in pages.collect():
        article = page.html.split("<article>")[1].split("</article>")[0] if "<article>" in page.html else ""
        texts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?p>|</?h1>", article)]
        assert got[page.page_id].text == "\n".join(x for x in texts if x)
        assert got[page.page_id].n_chars == len(got[page.page_id].text)


def test_parts_of_a_page_are_told_apart(model):
    prose = "This is a sentence of the article, long enough to be one. And here is another, which ends it."
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><div class='cookie-notice'><p>We use cookies here.</p></div>"
        "<header><h1>Site</h1><nav><ul><li><a href='/'>Home</a><li><a href='/b'>News</a></ul></nav></header>"
        f"<article><h1>Head &amp; line</h1><p>{prose}<p>Second&nbsp;one.<br>{prose}<div class='ad'>Buy this now, it is cheap.</div>"
        f"<ul><li>{prose}</li></ul><script>var a = '<p>no</p>';</script></article>"
        f"<section class='comments'><h3>Comments</h3><div class='comment'><p>{prose}</p></div></section>"
        "<aside><h3>Related</h3><a href='/x'>Other story</a></aside>"
        "<form><label>Mail</label><input><button>Go</button></form><footer>&copy; 2020 Site</footer></body></html>"
    )
    want = ["Head & line", prose, f"Second one. {prose}", prose]
    assert main_text(page, model) == "\n".join(want)


def test_odd_pages(spark, model):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>"), (3, "u", "<!-- <p>x</p> --><![CDATA[y]]><"), (3, "u", "&am"), (4, "u", "<p>" * 5000 + "&#x110000;&bogus;</div></p>")]
    rows.append((5, "u", "<article>" + "<p>A long paragraph, with words enough. It has two sentences.</p>" * 20_000 + "</article>"))
    got = main_texts(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert [r.page_id for r in got] == [1, 2, None, 3, 3, 4, 5]
    assert [r.text for r in got[:3]] == [""] * 3 and got[-1].text.count("\n") == 19_999
    assert main_texts(spark.createDataFrame([], SCHEMA), model).collect() == []
    more = spark.createDataFrame([(1, "u", "", "x")], SCHEMA + ", text string")
    assert main_texts(more, model).columns == ["page_id", "url", "text", "n_chars"]


def test_blocks_of_unclosed_markup():
    got = blocks("<body>a<p>b <i>c</i><p>d<ul><li>e<li>f</ul><table><tr><td>g<td>h<tr><td>i</table><div>j</p>k")
    assert [b.text for b in got] == ["a", "b c", "d", "e", "f", "g", "h", "i", "j", "k"]
    assert got[4].path == ("body", "ul", "li") and got[7].path == ("body", "table", "tr", "td")


def test_viterbi_finds_the_best_of_all_labellings():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 7))
        model = Field({f"f{i}": float(rng.normal()) for i in range(n)}, rng.normal(size=(2, 2)), rng.normal(size=2))
        found = [[f"f{i}"] for i in range(n)]

        def score(labels, model=model):
            emit = sum(model.weights[f"f{i}"] * y for i, y in enumerate(labels))
            return emit + model.first[labels[0]] + sum(model.steps[a, b] for a, b in itertools.pairwise(labels))

        assert score(model.decode(found)) == pytest.approx(max(score(y) for y in itertools.product((0, 1), repeat=n)))


def test_learning_follows_the_gradient_of_the_likelihood():
    rng = np.random.default_rng(2)
    found, right = [["a"], ["a", "b"], ["b"], ["c"]], [1, 0, 1, 1]
    weights, steps, first = {x: float(rng.normal()) for x in "abc"}, rng.normal(size=(2, 2)), rng.normal(size=2)

    def likelihood(weights, steps, first):
        def score(y):
            emit = sum(weights[f] * y[i] for i, one in enumerate(found) for f in one)
            return emit + first[y[0]] + sum(steps[a, b] for a, b in itertools.pairwise(y))

        return score(right) - np.log(sum(np.exp(score(y)) for y in itertools.product((0, 1), repeat=4)))

    model = Field(dict(weights), steps.copy(), first.copy())
    model.learn(found, right, 1.0, 0.0)
    eps = 1e-6
    for x in "abc":
        slope = (likelihood(weights | {x: weights[x] + eps}, steps, first) - likelihood(weights, steps, first)) / eps
        assert model.weights[x] - weights[x] == pytest.approx(slope, abs=1e-4)
    for at in itertools.product((0, 1), repeat=2):
        moved = steps.copy()
        moved[at] += eps
        slope = (likelihood(weights, moved, first) - likelihood(weights, steps, first)) / eps
        assert model.steps[at] - steps[at] == pytest.approx(slope, abs=1e-4)
