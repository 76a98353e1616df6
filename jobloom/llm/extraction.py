"""Main text of web pages by a tree-structured graphical model.

Every element of a page is a node that is content or not. A node's own evidence (tag, words of its class and id, amount of
text, share of linked text) and the potentials between a parent and a child of some tag are estimated from labelled pages,
which ``labelled_pages`` writes by rule. Messages pass up from the leaves and down from the root, and their products give
each node's marginal. The text of the nodes that are content by more than a half is the result.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import modest_batches
from jobloom.llm.html_tree import BLOCK, Page, read

# Words in classes, ids and roles, by what they tell.
CUES = {
    "advert": "ad ads advert adverts advertisement advertising banner promo promotion promoted sponsor sponsored outbrain taboola dfp".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs tabs toolbar pagination pager skip toc".split(),
    "frame": "header head masthead top topbar footer foot bottom copyright legal logo branding colophon credits".split(),
    "side": "side sidebar aside rail widget widgets related recommended recommendations popular trending more teaser teasers tags".split(),
    "notice": "cookie cookies consent gdpr notice alert alerts popup modal overlay newsletter subscribe subscription signup paywall dialog".split(),
    "form": "form search login register contact input field button".split(),
    "talk": "comment comments comentarios commentaires kommentare reply replies respond disqus discussion reviews feedback".split(),
    "share": "share sharing social follow like likes tweet print".split(),
    "meta": "meta byline author date time published posted info caption credit".split(),
    "content": "content article post entry main story text body hentry page prose".split(),
}
LEAST_SEEN = 5
_CUE = {word: cue for cue, words in CUES.items() for word in words}
_words = re.compile(r"[a-z]+").findall
_Features = tuple[str, tuple[str, ...], int, int]


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def features(page: Page) -> list[_Features]:
    """For each element: tag, cues, amount of own text, share of linked text below."""
    n = len(page.tags)
    own, linked = [0] * n, [0] * n
    for element, text in page.pieces:
        if element >= 0:
            own[element] += len(text.strip())
    below = own[:]
    for k in range(n - 1, 0, -1):
        if page.tags[k] == "a":
            linked[k] = below[k]
        below[page.parents[k]] += below[k]
        linked[page.parents[k]] += linked[k]
    found = []
    for k in range(n):
        cues = sorted({_CUE[w] for w in _words(page.attributes[k].lower()) if w in _CUE}) if page.attributes[k] else ()
        amount = own[k]
        size = 0 if not amount else 1 if amount < 25 else 2 if amount < 80 else 3
        share = linked[k] / below[k] if below[k] else 0.0
        found.append((page.tags[k], tuple(cues), size, 0 if share < 0.2 else 1 if share < 0.6 else 2))
    return found


@dataclass
class Model:
    """Log-odds of evidence by feature, and a child's chance of content by the parent's tag, its own and the parent's label."""

    evidence: dict[tuple, float]
    child: dict[tuple[str, str, int], float]  # tag "" for any
    root: float

    def own(self, f: _Features) -> float:
        e = self.evidence
        tag, cues, size, share = f
        return sum(e.get(("cue", c), 0.0) for c in cues) + e.get(("size", size), 0.0) + e.get(("share", share), 0.0)

    def potential(self, parent: str, tag: str) -> tuple[float, float]:
        """Chance of content under a parent that is content, and under one that is not."""
        known = self.child
        inside, outside = (next(known[k] for k in ((parent, tag, y), ("", tag, y), ("", "", y)) if k in known) for y in (1, 0))
        return inside, outside

    def marginals(self, parents: list[int], evidence: list[_Features]) -> list[float]:
        """Log-odds that each node is content, by sum-product up and down the tree; children follow their parents."""
        n = len(parents)
        cache: dict[_Features, float] = {}
        up = [0.0] * n
        for k, f in enumerate(evidence):
            if f not in cache:
                cache[f] = self.own(f)
            up[k] = cache[f]
        up[0] += self.root
        sent = [0.0] * n
        chances = [self.potential(evidence[max(p, 0)][0], f[0]) for p, f in zip(parents, evidence, strict=True)]
        exp, log = math.exp, math.log
        for k in range(n - 1, 0, -1):
            inside, outside = chances[k]
            odds = exp(max(-40.0, min(40.0, up[k])))
            sent[k] = log((inside * odds + 1 - inside) / (outside * odds + 1 - outside))
            up[parents[k]] += sent[k]
        full = up
        for k in range(1, n):
            inside, outside = chances[k]
            odds = exp(max(-40.0, min(40.0, full[parents[k]] - sent[k])))
            full[k] += log((inside * odds + outside) / ((1 - inside) * odds + 1 - outside))
        return full


def train(pages: Iterable[str]) -> Model:
    """Estimate the model from pages whose elements carry ``data-y`` (1 content, 0 not); others take their parent's label."""
    seen: Counter = Counter()
    total: Counter = Counter()
    child: Counter = Counter()
    for source in pages:
        page = read(source)
        labels = [0] * len(page.tags)
        for k in range(1, len(labels)):
            labels[k] = int(page.answers[k]) if page.answers[k] else labels[page.parents[k]]
        for k, (tag, cues, size, share) in enumerate(features(page)):
            y = labels[k]
            total[y] += 1
            for key in [("size", size), ("share", share), *[("cue", c) for c in cues]]:
                seen[key, y] += 1
            if k:
                above = page.parents[k]
                for kind in ((page.tags[above], tag), ("", tag), ("", "")):
                    child[*kind, labels[above], y] += 1
    keys = {key for key, _ in seen}
    evidence = {k: math.log((seen[k, 1] + 0.5) / (total[1] + 1)) - math.log((seen[k, 0] + 0.5) / (total[0] + 1)) for k in keys}
    chance = {}
    for above, tag, label, _ in list(child):
        yes, no = child[above, tag, label, 1], child[above, tag, label, 0]
        if not above or yes + no >= LEAST_SEEN:  # rarer pairs of tags fall back on the child's tag
            chance[above, tag, label] = (yes + 0.2) / (yes + no + 0.4)
    return Model(evidence, chance, _logit(0.02))


def labelled_pages(seed: int = 5, n: int = 240) -> list[str]:
    """Labelled pages, written by rule: common layouts of a main text among what surrounds it."""
    r = random.Random(seed)
    vocabulary = "time people way water words house world point work place light hand part small large find give under last".split()

    def words(a: int, b: int) -> str:
        return " ".join(r.choice(vocabulary) for _ in range(r.randint(a, b))).capitalize() + r.choice([".", ".", "!", "?", ""])

    def links(a: int, b: int) -> str:
        return "".join(f"<li><a href='/{k}'>{words(1, 3)}</a></li>" for k in range(r.randint(a, b)))

    def named(cue: str) -> str:
        word = r.choice(CUES[cue])
        return r.choice([f'class="{word}"', f'id="{word}"', f'class="{r.choice(["left", "box", "c1"])} {word}-{r.choice(["box", "wrap", "list"])}"'])

    def paragraph() -> str:
        inside = words(1, 60)
        kind = r.random()
        if kind < 0.15:
            inside = f"<b>{words(1, 8)}</b> " + inside
        elif kind < 0.3:
            inside += f" <a href='/x'>{words(1, 4)}</a> <em>{words(1, 5)}</em>"
        elif kind < 0.4:
            inside = f"<span>{inside}</span>"
        return f"<p>{inside}" + r.choice(["</p>", "</p>", "<br>", ""])

    def story() -> str:
        parts = [paragraph() for _ in range(r.randint(1, 14))]
        extra = [
            lambda: f"<h2>{words(1, 8)}</h2>", lambda: f"<h3>{words(1, 5)}</h3>", lambda: f"<blockquote>{paragraph()}</blockquote>",
            lambda: f"<ul><li>{words(2, 20)}</li><li>{words(2, 20)}</li></ul>", lambda: f"<ol><li>{words(2, 9)}<li>{words(1, 9)}</ol>",
            lambda: f"<pre><code>{words(3, 9)}</code></pre>", lambda: f"<table><tr><th>{words(1, 2)}<td>{words(1, 6)}</table>",
            lambda: f"<figure><img src=x><figcaption>{words(2, 9)}</figcaption></figure>", lambda: f"<div>{words(8, 40)}</div>",
            lambda: f"<section><h2>{words(1, 5)}</h2>{paragraph()}{paragraph()}</section>", lambda: f"<dl><dt>{words(1, 2)}<dd>{words(2, 9)}</dl>",
        ]
        inner = [
            lambda: f"<div data-y=0 {named('advert')}>{words(1, 25)}</div>", lambda: f"<aside data-y=0>{words(2, 20)}<p>{words(2, 9)}</p></aside>",
            lambda: f"<div data-y=0 {named('share')}><a href=x>{words(1, 1)}</a><a href=y>{words(1, 1)}</a></div>",
            lambda: f"<div data-y=0 {named('side')}><h3>{words(1, 3)}</h3><ul>{links(2, 5)}</ul></div>",
            lambda: f"<nav data-y=0><ul>{links(2, 5)}</ul></nav>", lambda: f"<footer data-y=0>{words(1, 9)}</footer>",
            lambda: f"<form data-y=0><label>{words(1, 4)}</label><input><button>{words(1, 1)}</button></form>",
            lambda: f"<div data-y=0 {named('notice')}><p>{words(3, 25)}</p><button>{words(1, 2)}</button></div>",
            lambda: f"<section data-y=0 {named('talk')}><h3>{words(1, 2)}</h3>{paragraph()}{paragraph()}</section>",
        ]
        for _ in range(r.randint(0, 3)):
            parts.insert(r.randint(0, len(parts)), r.choice(extra)())
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            parts.insert(r.randint(0, len(parts)), r.choice(inner)())
        heading = f"<h1>{words(2, 10)}</h1>" if r.random() < 0.8 else ""
        if heading and r.random() < 0.2:
            heading = f"<header>{heading}</header>"
        return heading + "".join(parts)

    def around() -> str:
        return r.choice([
            lambda: f"<nav><ul>{links(3, 9)}</ul></nav>", lambda: f"<nav><a href=a>{words(1, 2)}</a> <a href=b>{words(1, 2)}</a></nav>",
            lambda: f"<header><a href=/>{words(1, 3)}</a><p>{words(2, 6)}</p></header>", lambda: f"<header><h1>{words(1, 3)}</h1><nav><ul>{links(2, 6)}</ul></nav></header>",
            lambda: f"<div {named('frame')}><h2>{words(1, 4)}</h2><p>{words(1, 9)}</p></div>",
            lambda: f"<div {named('menu')}><ul>{links(3, 9)}</ul></div>", lambda: f"<ul {named('menu')}>{links(3, 9)}</ul>",
            lambda: f"<div {named('advert')}>{words(1, 40)}</div>", lambda: f"<div {named('advert')}><p>{words(3, 40)}</p></div>",
            lambda: f"<aside><h3>{words(1, 3)}</h3>{paragraph()}<ul>{links(1, 5)}</ul></aside>",
            lambda: f"<div {named('side')}><h3>{words(1, 3)}</h3><p>{words(4, 30)}</p><ul>{links(2, 6)}</ul></div>",
            lambda: f"<div {named('notice')}><p>{words(5, 40)}</p><button>{words(1, 2)}</button></div>", lambda: f"<div {named('notice')}>{words(5, 40)}</div>",
            lambda: f"<form {named('form')}><label>{words(1, 3)}</label><input><p>{words(1, 12)}</p><button>{words(1, 2)}</button></form>",
            lambda: f"<section {named('talk')}><h2>{words(1, 2)}</h2>" + "".join(f"<div class='comment'><b>{words(1, 2)}</b>{paragraph()}</div>" for _ in range(r.randint(1, 5))) + "</section>",
            lambda: f"<div {named('talk')}><ol><li>{paragraph()}<li>{paragraph()}</ol></div>", lambda: f"<div {named('share')}>{words(1, 3)}</div>",
            lambda: f"<footer>{words(3, 20)}</footer>", lambda: f"<footer><p>{words(3, 25)}</p><ul>{links(1, 6)}</ul></footer>",
            lambda: f"<div {named('frame')}>{words(3, 30)} <a href=x>{words(1, 2)}</a></div>",
        ])()

    pages = []
    for _ in range(n):
        before, after = ("".join(around() for _ in range(r.randint(0, 4))) for _ in range(2))
        body = r.choice([
            lambda: f"<article data-y=1>{story()}</article>", lambda: f"<article data-y=1>{story()}</article>",
            lambda: f"<main data-y=1>{story()}</main>", lambda: f"<main><article data-y=1>{story()}</article></main>",
            lambda: f"<div data-y=1 {named('content')}>{story()}</div>", lambda: f"<div class='wrap'><div data-y=1 {named('content')}>{story()}</div>{around()}</div>",
            lambda: f"<article data-y=1><div {named('content')}>{story()}</div></article>", lambda: f"<div data-y=1>{story()}{paragraph()}{paragraph()}</div>",
            lambda: "".join(re.sub(r"^<(\w+)", r"<\1 data-y=1", paragraph()) for _ in range(r.randint(2, 9))),
        ])()
        pages.append(f"<html><head><title>{words(2, 6)}</title></head><body>{before}{body}{after}</body></html>")
    return pages


@lru_cache(maxsize=1)
def trained() -> Model:
    return train(labelled_pages())


def main_text(source: str, model: Model) -> str:
    """Blocks of content in page order, one a line; white space inside a block is one blank."""
    page = read(source)
    odds = model.marginals(page.parents, features(page))
    blocks, current = [], []
    for element, text in page.pieces:
        if element < 0:
            if current:
                blocks.append(" ".join("".join(current).split()))
                current = []
        elif odds[element] > 0:
            current.append(text)
    blocks.append(" ".join("".join(current).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the column ``text`` (replaced if there) that holds the main text of ``html``, read whole.

    A null or empty page, and one without content, has an empty text. Repeated rows are read each; other columns stay. Deep
    nesting and unclosed tags cost time in proportion to the page only.
    """
    modest_batches(pages.sparkSession)
    model = trained()
    schema = pages.withColumn(text, F.lit("")).schema

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(**{text: [main_text(h, model) if isinstance(h, str) else "" for h in frame[html]]})

    return pages.mapInPandas(run, schema)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Result of the query: the main text of every page and its code points."""
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


__all__ = ["BLOCK", "Model", "extract", "extract_pages", "labelled_pages", "main_text", "train", "trained"]
