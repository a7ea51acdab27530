import itertools

import numpy as np
import pytest

from platewatch.llm import extraction as e
from platewatch.llm.html_blocks import blocks


@pytest.fixture(scope="module")
def field():
    return e.train(e.labelled())


def test_blocks_of_broken_markup():
    page = "<P>a &amp b&#233;<br>c<p>d<b>e</p>f<!-- x --><ul><li>g<li><a href='>'>h</a> i</ul><script>if (1 < 2) '</p>'</script>j<div"
    assert [b.text for b in blocks(page)] == ["a & bé c", "de", "f", "g", "h i", "j<div"]
    assert [b.text for b in blocks("<!-- never closed <p>x")] == []
    assert blocks(None) == blocks("") == blocks(" \n ") == []
    assert [b.text for b in blocks("<title>t</title>x\xa0 \ty")] == ["t", "x y"]


def test_elements_that_close_themselves_take_nothing_with_them():
    page = '<nav>n</nav><main><svg class="i"/><p>a<object data="x" /> b</p><iframe src=y/><svg a="/>"><text>z</text></svg><p>c</main>'
    assert [b.text for b in blocks(page)] == ["n", "a b", "c"]


# Written by hand in the manner of common page kinds; none comes from the generator of training pages.
BY_HAND = [
    ("""<!doctype html><html><head><title>T</title><style>p{}</style></head><body><div id="page"><div class="masthead"><svg class="logo"/>
     <a href=/>Daily Post</a><ul class="menu"><li><a href=/w>World</a><li><a href=/s>Sport</a></ul></div><div class="post"><h2>Bridge reopens after repairs</h2>
     <p>The old bridge over the river was opened again on Monday, two years after the flood damaged its northern pillar.</p>
     <p>Engineers replaced most of the stone work. The town paid for half of it, and the rest came from donations.</p>
     <blockquote>It is good to walk across it again, said the mayor, who cut the ribbon together with two school children.</blockquote></div>
     <div class="sidebar"><h4>Most read</h4><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul></div>
     <div class="footer">&copy; Daily Post <a href=/t>Terms</a></div></div></body></html>""", 4),
    ("""<body><header><nav><a href=/>Home</a> <a href=/docs>Docs</a></nav></header><article><h1>Reading large tables</h1>
     <p>A table that does not fit into memory is read in parts, and every part is worked on by itself before the next one comes.</p>
     <ul><li>Choose only the columns that are needed for the question.</li><li>Filter rows as early as possible, before any join takes place.</li></ul>
     <p>What remains is usually small enough to be sorted, and the sorted parts can then be merged.</p></article>
     <section class="comments"><p>Great!</p><p>Thanks for this.</p></section><footer><p>All rights reserved.</p></footer></body>""", 5),
]


@pytest.mark.parametrize("page, size", BY_HAND)
def test_pages_written_by_hand(field, page, size):
    kept = e.main_text(field, page).split("\n\n")
    assert len(kept) == size and kept[0] in ("Bridge reopens after repairs", "Reading large tables")


def test_viterbi_and_sums_against_all_labellings():
    random = np.random.default_rng(3)
    for size in (1, 2, 5):
        score, moves = random.normal(size=(1, size)), random.normal(size=(2, 2))

        def total(labels):
            return sum(s for s, l in zip(score[0], labels) if l) + sum(moves[a, b] for a, b in zip(labels, labels[1:]))

        ways = list(itertools.product((0, 1), repeat=size))
        mass = np.exp([total(w) for w in ways])
        chance, moved = e._marginals(score, moves, np.ones((1, size), bool))
        assert np.allclose(chance[0], (mass[:, None] * np.array(ways)).sum(0) / mass.sum())
        pair = sum(m * sum(a == 0 and b == 1 for a, b in zip(w, w[1:])) for m, w in zip(mass, ways)) / mass.sum()
        assert np.isclose(moved[0, 1], pair)
        page = blocks("".join(f"<p>{i}</p>" for i in range(size)))
        own = e.Field(np.zeros(e.BUCKETS), moves)
        paths = {}
        # The text features have no weight, so a score per block is put in by its path.
        for b, s in zip(page, score[0]):
            b.path = (("p", (str(s),)),)
            paths[b.path] = s
        assert tuple(map(int, own.keep(page, paths))) == max(ways, key=total)


def test_layouts_it_was_not_trained_on(field):
    pages = e.labelled(300, first=50_000)
    right = [int(k) == l for own, labels in pages for k, l in zip(field.keep(own, {}), labels)]
    assert np.mean(right) > 0.98


def test_given_pages(spark, field):
    rows = e.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), field=field).collect()
    for r in rows:
        inside = blocks(r["html"][r["html"].index("<article>") : r["html"].index("</article>")])
        assert r["text"] == "\n\n".join(b.text for b in inside) and r["n_chars"] == len(r["text"])


def test_comments_and_boxes_go(field):
    story = "".join(f"<p>Sentence one of part {i}, which goes on. And then another sentence follows it.</p>" for i in range(4))
    page = (f'<body><header><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav><main><h1>Head line of it</h1>{story}'
            '<div class="advertisement">Buy now</div></main><aside class="sidebar"><p>Other things</p></aside><div class="cookie-notice"><p>We use cookies.</p>'
            '</div><section id="comments"><h3>Comments</h3><div class="comment"><p>I do not agree with this, at all. Really.</p></div></section>'
            '<form class="newsletter"><p>Sign up</p><button>Go</button></form><footer>&copy; Somebody</footer></body>')
    kept = e.main_text(field, page).split("\n\n")
    assert kept[0] == "Head line of it" and len(kept) == 5


def test_awkward_rows(spark, field):
    long = "<article><p>" + "word and more. " * 50_000 + "</p></article>"
    rows = [(1, None), (2, ""), (3, "no markup at all"), (4, long), (4, long), (5, "<p>" * 3000 + "deep"), (None, "<nav><a>x</a></nav>")]
    table = spark.createDataFrame([(*r, "t", "n") for r in rows], "page_id bigint, html string, text string, N_CHARS string")
    got = e.extract(table, field=field)
    assert got.columns == ["page_id", "html", "text", "N_CHARS", "text_", "n_chars_"]
    found = [(r["page_id"], r["text_"]) for r in got.collect()]
    assert found.count((1, "")) == found.count((2, "")) == found.count((None, "")) == 1
    assert found.count((4, " ".join(("word and more. " * 50_000).split()))) == 2
    assert e.extract(table.where("false"), field=field).count() == 0
