import itertools
import math
import time

import pytest

from jobloom.llm import extraction, html_tree


@pytest.fixture(scope="module")
def model():
    return extraction.trained()


def test_held_out_pages(model):
    wrong = total = 0
    for source in extraction.labelled_pages(seed=77, n=150):
        page = html_tree.read(source)
        labels = [0] * len(page.tags)
        for k in range(1, len(labels)):
            labels[k] = int(page.answers[k]) if page.answers[k] else labels[page.parents[k]]
        odds = model.marginals(page.parents, extraction.features(page))
        for element, text in page.pieces:
            if element >= 0 and text.strip():
                total += 1
                wrong += (odds[element] > 0) != (labels[element] == 1)
    assert wrong / total < 0.03


def test_messages_give_the_marginals_of_all_labellings(model):
    page = html_tree.read("<div class=ad><p>one</p><a href=x>two</a></div><article><p>long text of a story<b>x</b></article>")
    evidence = extraction.features(page)
    odds = model.marginals(page.parents, evidence)
    n = len(page.tags)
    weight = [[0.0, 0.0] for _ in range(n)]
    for labels in itertools.product((0, 1), repeat=n):
        score = labels[0] * (model.root + model.own(evidence[0]))
        for k in range(1, n):
            chance = model.potential(page.tags[page.parents[k]], page.tags[k])[0 if labels[page.parents[k]] else 1]
            score += math.log(chance if labels[k] else 1 - chance) + labels[k] * model.own(evidence[k])
        for k in range(n):
            weight[k][labels[k]] += math.exp(score)
    assert odds == pytest.approx([math.log(yes / no) for no, yes in weight], abs=1e-6)


def test_main_text(model):
    page = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">A</a></li></ul></nav>
    <!-- ad --><div class="ad">Buy now</div><article><h1>Head &amp; line</h1><p><b>First&nbsp;one <br> two<p>Sec<i>on</i>d  &copy;
    x</article><div class="comments"><p>A reader thinks that this is a rather long comment on it.</p></div><footer>&copy; host</footer></body></html>"""
    assert extraction.main_text(page, model) == "Head & line\nFirst one two\nSecond © x"


def test_tree():
    page = html_tree.read("<ul><li>a<li>b<ul><li>c</ul></ul><p>d<div>e</div><table><tr><td>f<td>g<tr><td>h</table><a title='>' class=x>i</a>")
    path = {text.strip(): page.tags[element] for element, text in page.pieces if element >= 0}
    assert path == {"a": "li", "b": "li", "c": "li", "d": "p", "e": "div", "f": "td", "g": "td", "h": "td", "i": "a"}
    assert page.tags.count("li") == 3 and page.attributes[-1] == "x"


@pytest.mark.parametrize("source", [
    "<p><div>" * 20000, "<b>" * 60000 + "x", '<a href="' * 30000, "<table>" * 20000 + "<td>" * 20000, "<li>" * 40000 + "</ul>" * 40000,
    "<script>" * 20000, "<" * 60000, "<a b='>" * 40000, "<title>" * 20000, "</p>" * 40000,
])
def test_hostile_pages_take_linear_time(model, source):
    start = time.perf_counter()
    extraction.main_text(source, model)
    assert time.perf_counter() - start < 5


def test_result_of_the_query(spark):
    page = "<body><article><h1>Hé</h1><p>a b</article></body>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page), (4, "u", "plain")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = extraction.extract_pages(frame).collect()
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in found)[:4] == [(1, "", 0), (2, "", 0), (3, "Hé\na b", 6), (3, "Hé\na b", 6)]
    assert extraction.extract_pages(frame.where("false")).count() == 0


def test_self_closed_and_unclosed_raw_elements_do_not_take_the_page():
    def words(source):
        return "".join(t for _, t in html_tree.read(source).pieces).split()

    for tag in ['<svg class="icon"/>', "<svg>", "<noscript>", "<template>"]:
        assert " ".join(words(f"<p>one {tag} two</p> <p>three</p>")) == "one two three"
    assert words('<p>a <svg class="i"/> b <svg><path d="x"/></svg> c</p>') == ["a", "b", "c"]
    assert words("<p>one</p><script>two") == ["one"]
