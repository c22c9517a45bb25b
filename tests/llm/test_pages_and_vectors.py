import numpy as np
import pytest

from tarmac.llm import pages, vectors
from tarmac.llm.components import components
from tarmac.llm.queries import queries


def test_article_without_its_surroundings(spark):
    inner = '<h1>T &amp; t</h1><p>a\n b<p>c <b>d</b> e<div class="ad">no</div><ul><li>one<li>two</ul>'
    page = (
        '<html><head><title>x</title><script>var t="</p>";</script></head><body class="has-sidebar"><nav>menu</nav>'
        f'<div class="post-12 content">{inner}<form>f</form></div><div id="comments"><p>bad</p></div>'
        '<aside>side</aside><footer>foot</footer>'
    )
    rows = [(1, "http://A.org/x", page), (2, "http://a.org/y", page + "</body></html>"), (3, None, None), (4, "", ""),
            (5, "http://b.org", "<p>only &lt;text&gt;"), (6, "http://b.org", "<p" * 1000), (6, "http://b.org", "<p" * 1000)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = "T & t\na b\nc d e\none\ntwo"
    found = {r.row.page_id: r.text for r in pages.extracted(docs).collect()}
    assert found == {1: text, 2: text, 3: "", 4: "", 5: "only <text>", 6: ""}
    assert pages.extracted(docs.limit(0)).count() == 0


def test_a_host_decides_for_a_page(spark):
    good = lambda k: f'<body><div class="a-{k}"><p>{"main text of the page " * 9}</p></div><div class="z"><p>few</p></div></body>'
    odd = f'<body><div class="a-9"><p>main</p></div><div class="z"><p>{"long remarks on other things " * 30}</p></div></body>'
    rows = [(i, "https://h.org", good(i)) for i in range(5)] + [(9, "https://h.org", odd)]
    found = pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).where("row.page_id = 9")
    assert found.first().text == "main"


def test_vectors_against_brute_force(spark):
    draw = np.random.default_rng(5)
    base = draw.normal(size=(60, 16))
    x = np.vstack([base + draw.normal(scale=s, size=base.shape) for s in (0, 0, 0.03, 0.08, 0.1, 0.12)])
    labels = [int(i) for i in draw.integers(0, 3, size=60)] * 6
    rows = [(i, [float(v) for v in v], label) for i, (v, label) in enumerate(zip(x, labels))]
    odd = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [1.0, None] + [0.0] * 14, 1),
           (1004, [1.0] * 3, 1), (1005, rows[0][1], None), (1006, [float("inf")] + [0.0] * 15, 1)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = (unit @ unit.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels))
    np.fill_diagonal(close, False)
    group = np.arange(len(x))
    for _ in x:
        group = np.minimum(group, np.where(close, group, len(x)).min(axis=1))
    found = {r.id: (r.n_links, r.component_id) for r in vectors.linked(table, 0.93).collect()}
    assert len(found) == len(rows) + len(odd)
    assert all(found[i] == (0, i) for i in range(1000, 1007))
    got = np.array([found[i][0] for i in range(len(x))])
    assert got.sum() >= 0.99 * close.sum() and (got <= close.sum(axis=1)).all()
    if (got == close.sum(axis=1)).all():
        assert [found[i][1] for i in range(len(x))] == group.tolist()
    assert vectors.linked(table.limit(0), 0.93).count() == 0


def test_blocks_of_a_list(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MEMBERS", 9)
    monkeypatch.setattr(vectors, "QUERIES", 13)
    rows = [(i, [1.0, i / 1000.0, 0.5], 1) for i in range(50)]
    found = vectors.linked(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), 0.93).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(49, 0)}


@pytest.mark.parametrize("n", [2, 50])
def test_components_of_a_path(spark, n):
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(n + 10, n + 20)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {i: 0 for i in range(n + 1)} | {n + 10: n + 10, n + 20: n + 10}


def test_queries_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    found = queries()["op2_embedding_near_dedup"](spark, folder)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"] and found.count() == 500
    found = queries()["op1_html_extraction"](spark, folder)
    assert found.where("n_chars <> length(text)").count() == 0 and found.count() == 50
