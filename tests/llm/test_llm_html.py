"""Blocks of pages against a plain reader, slopes against differences, held-out layouts, whole tables."""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import pytest

from riskframe.llm import html_extraction as X
from riskframe.llm import queries
from riskframe.llm.page_blocks import page_blocks

BLOCKS = "p h1 h2 h3 li ul div article nav footer body html br"


class Plain(HTMLParser):
    """The blocks inside ``article``, read the long way."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.skip, self.blocks, self.now = False, None, [], ""

    def flush(self):
        if self.inside and self.now.split():
            self.blocks.append(" ".join(self.now.split()))
        self.now = ""

    def handle_starttag(self, tag, attrs):
        self.skip = tag if tag in ("script", "style", "title") else self.skip
        if tag == "br":
            self.now += " "
        elif tag in BLOCKS.split():
            self.flush()
        self.inside = self.inside or tag == "article"

    def handle_endtag(self, tag):
        self.skip = None if tag == self.skip else self.skip
        if tag in BLOCKS.split():
            self.flush()
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        if not self.skip:
            self.now += data


def plain_text(html) -> str:
    reader = Plain()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return "\n".join(reader.blocks)


@pytest.fixture(scope="module")
def sources(spark):
    return [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]


@pytest.fixture(scope="module")
def labeller(sources):
    return X.train(X.training_pages(sorted(sources)))


def test_blocks():
    def texts(html):
        return page_blocks(html).texts

    assert texts("") == texts("<p> \n</p><!-- a --><script>x</script>") == []
    assert texts("a\n b<b>c</b>d<p>e<p>f</div>g") == ["a bcd", "e", "f", "g"]
    assert texts("<div>one<br>two&nbsp;&amp;&#233; <i>x</i></div>three") == ["one two &é x", "three"]
    assert texts("<style>p{}</style ><title>t</title>x < y <3 <a title='a>b'>l</a>") == ["x < y <3 l"]
    assert texts("<p>whole<script>cut") == ["whole"]
    assert texts("<p>whole <a href='cut") == ["whole"]
    assert texts("a<!-- cut") == ["a"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    blocks = page_blocks("<nav id=topMenu><ul><li><a>x</a> y<li>z</ul></nav><article><b><p>t</b>u<p>v</article>w")
    assert blocks.texts == ["x y", "z", "tu", "v", "w"]
    assert blocks.linked == [1, 0, 0, 0, 0]
    assert blocks.paths[0] == ("nav", "i.top", "i.menu", ".top", ".menu", "ul", "li") and blocks.paths[4] == ()


def test_deep_and_long_pages():
    n = 30_000
    deep = page_blocks("<div>" * n + "x" + "</div>" * n + "<p>y")
    assert deep.texts == ["x", "y"] and len(deep.paths[0]) == 64
    assert page_blocks("<b>" * n + "x" + "<p>" * n + "z").texts == ["x", "z"]
    assert len(page_blocks("<li><a href=x>word</a>" * n).texts) == n
    assert len(page_blocks("<a \"'" * n + "text").texts) <= 1
    assert page_blocks("<" * n).texts == ["<" * n]


def test_made_layouts_have_a_label_a_block(sources):
    made = X.training_pages(sources[:40], seed=5, made=4)
    assert len(made) == 40 + 300
    assert all(len(b.texts) == len(y) for b, y in made)


def test_slopes_equal_differences(sources):
    batch = [p for p in X.training_pages(sources[:4], seed=2) if len(p[0].texts) < 15][:5]
    labels = np.concatenate([y for _, y in batch]).astype(np.float64)
    described = X.Features().of([b for b, _ in batch])
    keep = np.ones(len(labels))
    model = X.Labeller({k: v.astype(np.float64) for k, v in X.Labeller.fresh(3).w.items()})
    _, slopes = model.gradients(described, labels, keep)
    rng = np.random.default_rng(1)
    for name, w in model.w.items():
        held = np.flatnonzero(slopes[name]) if name in ("path", "word") else np.arange(w.size)
        for at in rng.choice(held, 4):
            old, losses = w.flat[at], []
            for step in (1e-4, -1e-4):
                w.flat[at] = old + step
                losses.append(model.gradients(described, labels, keep)[0])
            w.flat[at] = old
            assert slopes[name].flat[at] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=2e-2, abs=2e-5), name


def test_pages_are_labelled_alike_alone_and_together(sources, labeller):
    pages = [page_blocks(s) for s in sources[:30]] + [page_blocks("")]
    together = labeller.main_blocks(pages, X.Features())
    for page, kept in zip(pages, together):
        assert np.array_equal(labeller.main_blocks([page], X.Features())[0], kept)


def test_held_out_layouts(spark, labeller):
    others = [r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("page_id % 10 = 7").collect()]
    made = X.training_pages(others, seed=99, made=2)[len(others) :]
    kept = labeller.main_blocks([b for b, _ in made], X.Features())
    right = np.concatenate([k == y for k, (_, y) in zip(kept, made)])
    assert len(right) > 10_000 and right.mean() > 0.99


def test_query_over_whole_tables(spark):
    for folder in ("/root/testdata/sf0.01",):
        found = queries.all_queries()["op11_html_extraction"](spark, folder)
        assert found.columns == ["page_id", "url", "text", "n_chars"]
        rows = spark.read.parquet(f"{folder}/pages.parquet").collect()
        want = sorted((r.page_id, r.url, plain_text(r.html), len(plain_text(r.html))) for r in rows)
        assert sorted(tuple(r) for r in found.collect()) == want


def test_cases(spark, labeller, sources):
    schema = "page_id long, url string, html string, text string, N_CHARS int"
    rows = [(1, "u", None, "x", 1), (2, None, "", "x", 1), (None, "u", sources[0], "x", 1), (3, "u", sources[1], "x", 1)]
    rows += [rows[3], (4, "u", "<article>" + "<p>long words here.</p>" * 20_000 + "</article>", "x", 1)]
    out = X.extract(spark.createDataFrame(rows, schema), labeller).collect()
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in out)
    assert got == sorted((r[0] or 0, r[1] or "", plain_text(r[2]), len(plain_text(r[2]))) for r in rows)
    none = spark.createDataFrame([], schema)
    assert X.extract(none, labeller).count() == 0


def test_labeller_of_an_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert X.extract(none, X.fit(none)).count() == 0
