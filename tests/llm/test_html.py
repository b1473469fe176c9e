import html
import itertools
import re

import numpy as np
import pytest
from fareweave.llm import dom
from fareweave.llm import html_extract as H
from fareweave.llm.labelled_pages import labelled_pages


def article(source):
    """What the given pages' article holds, by its marks."""
    body = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    blocks = [html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(" ".join(b.split()) for b in blocks if b.split())


def test_given_pages(spark):
    from fareweave.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    sources = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op4_html"](spark, folder).collect()
    assert len(rows) == len(sources)
    wrong = [r.page_id for r in rows if r.text != article(sources[r.page_id].html)]
    assert wrong == []
    assert all(r.n_chars == len(r.text) and r.url == sources[r.page_id].url for r in rows)


def test_pages_held_out_of_training():
    """Labelled pages the model has not seen: it is trained on the first two thirds."""
    model = H.train.__wrapped__(320)
    wrong = total = 0
    for source in itertools.islice(labelled_pages(480), 320, 480):
        label, page = H._labels(dom.parse(source))
        parent, kind = np.array(page.parent), np.array([0 if t is None else 1 for t in page.text])
        main = H.marginals(H.propagate(parent, kind, np.array(model.evidence(page)), model.potentials)[0]) > 0.5
        wrong += int((main != (label == 1))[kind == 1].sum())
        total += int(kind.sum())
    assert wrong / total < 0.05


def test_messages_give_the_marginals():
    rng = np.random.default_rng(0)
    for _ in range(20):
        n = 8
        parent = np.array([-1, *(rng.integers(-1 if i % 3 == 0 else 0, i) for i in range(1, n))])
        kind, evidence = rng.integers(0, 2, n), rng.normal(size=n)
        potentials = rng.normal(size=(2, 2, 2))
        weight = {}
        for states in itertools.product((0, 1), repeat=n):
            log = sum(evidence[i] * states[i] for i in range(n))
            log += sum(potentials[kind[i], states[parent[i]], states[i]] for i in range(n) if parent[i] >= 0)
            weight[states] = np.exp(log)
        total = sum(weight.values())
        exact = [sum(w for s, w in weight.items() if s[i]) / total for i in range(n)]
        assert H.marginals(H.propagate(parent, kind, evidence, potentials)[0]) == pytest.approx(exact)


PAGE = """<!DOCTYPE html><HTML><head><title>No &amp; text</title><script>var a="</p>";</script><style>p{}</style></head>
<body><div class="cookie-notice"><p>We use cookies to make this site better for everyone, please accept them.</p></div>
<nav><ul><li><a href=/1>Home</a><li><a href="/2">News</a></ul></nav><!-- <p>not this</p> -->
<main><article><h1>A   title&nbsp;here</h1><p>First &lt;b&gt; paragraph of the story<br>has <b>bold</b>
and <i>slanted</i> words &eacute;&#233;&#x4e2d;.<p>Second one, left open &copy; by its writer, but long enough to read.
<div class="ad">Buy this thing today!</div><ul><li>One point that is made<li>And another one</ul></article></main>
<aside class="sidebar"><p>Popular posts of this week and other things to read.</p></aside>
<section id="comments"><div class="comment"><p>I liked this article, thanks for writing it.</p></div></section>
<form><label>Mail</label><input><button>Subscribe</button></form><footer>&copy; 2020 Somebody</footer>"""


def test_a_page_of_many_kinds():
    assert H.main_texts([PAGE], H.train())[0].split("\n\n") == [
        "A title here",
        "First <b> paragraph of the story has bold and slanted words éé中.",
        "Second one, left open © by its writer, but long enough to read.",
        "One point that is made",
        "And another one",
    ]


@pytest.mark.parametrize(
    "source, blocks",
    [
        ("", []),
        ("<", ["<"]),
        ("a < b", ["a < b"]),
        ("<p>a<p>b</p></p>c", ["a", "b", "c"]),
        ("<div>a<span>b</span>c<div>d</div>e", ["abc", "d", "e"]),
        ("x<script>y</script>z<style>q", ["xz"]),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("a<!-- b --c --> d<!-- open", ["a d"]),
        ("<p title='a>b'>c</p><p title=\"d'>\">e", ["c", "e"]),
        ("<a href='x\">y", ["y"]),
        ("a<br>b<hr>c&nbsp;&amp;lt;", ["a b", "c &lt;"]),
        ("<head><title>t</title><p>a", ["a"]),
        ("</div></p>a</body></html>b", ["ab"]),
        ("<h1>a<h2>b", ["a", "b"]),
    ],
)
def test_blocks(source, blocks):
    assert [t for t in dom.parse(source).text if t is not None] == blocks


def test_edges(spark):
    long = "<article><h1>T</h1>" + "<p>" + "many words, " * 30_000 + "end.</p></article>"
    deep = "<div>" * 3000 + "deep text that stands far below the top of its page" + "</div>" * 3000
    rows = [(1, None), (2, ""), (3, long), (3, long), (4, deep), (None, "<article><p>One sentence in a page.</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'t' as text", "0 as c0", "1 as c1")
    out = H.extract(pages)
    assert out.columns == ["page_id", "c0", "c1", "text"]
    got = {}
    for r in out.collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[1] == got[2] == [""] and got[None] == ["One sentence in a page."]
    assert len(got[3]) == 2 and got[3][0] == got[3][1] and got[3][0].endswith("many words, end.") and len(got[3][0]) > 350_000
    assert H.extract(pages.limit(0)).count() == 0
