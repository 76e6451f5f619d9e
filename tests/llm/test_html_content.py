"""Main-text extraction: what counts as main text, broken markup, odd rows."""

import pytest

from latewatch.llm import html_content as H
from latewatch.llm.labelled_pages import PAGES

THETA, TIES = H.train()


def text(page):
    return H.main_texts([page], THETA, TIES)[0]


def wrap(article, after=""):
    return (
        '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head>'
        f'<body><nav><ul><li><a href="/a">menu one</a></li><li><a href="/b">menu two</a></li></ul></nav><div class="ad">Buy it now, it is cheap.</div>{article}'
        f'{after}<footer>&copy; site &middot; Words of the owner.</footer></body></html>'
    )


@pytest.mark.parametrize("article, want", [
    ("<article><h1>Title</h1><p>One &amp; two.</p><p>Three\n  four</p></article>", "Title\nOne & two.\nThree four"),
    ("<article><h1>Title</h1><p><b>Open.<br><p>Next one.</p></article>", "Title\nOpen.\nNext one."),
    ("<article><h1>Cut &am</h1><p>A&nbsp;b &#65;&#x42; &lt;c&gt; &copy 1</p></article>", "Cut &am\nA b AB <c> © 1"),
    ("<article><h1>Title</h1><p>Body text goes here, with a <a href=x>link</a> in it.</p><section class='comments'><p>I liked it very much, thank you.</p></section></article>",
     "Title\nBody text goes here, with a link in it."),
    ("<article><h1>T</h1><p>Text of the page, long enough.</p><form><p>Send us your mail address.</p><input></form></article>", "T\nText of the page, long enough."),
    ("<article><p>Only one paragraph</p></article>", "Only one paragraph"),
    ("", ""),
])
def test_article(article, want):
    assert text(wrap(article)) == want


@pytest.mark.parametrize("after", [
    '<aside class="sidebar"><h3>Popular</h3><p>Ten roses for the shade.</p></aside>', '<div id="cookie-notice"><p>We use cookies on this site.</p></div>',
    '<section id="comments"><div class="comment"><p>First reader writes something here.</p></div></section>',
    '<form><label>Name</label><p>Write to us about this.</p><textarea>x</textarea></form>', '<div hidden><p>Nobody sees this text at all.</p></div>',
    '<noscript><p>Turn on scripts.</p></noscript><style>b{}</style><!-- <p>no</p> -->',
])
def test_other_parts_stay_out(after):
    assert text(wrap("<article><h1>Head</h1><p>The text of the page is this.</p><p>And this.</p></article>", after)) == "Head\nThe text of the page is this.\nAnd this."


def test_marginals_match_enumeration():
    """Sum-product on a small tree against all 2^n assignments."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    parent, depth, run = np.array([-1, 0, 0, 1, 1, -1]), np.array([0, 1, 1, 2, 2, 0]), np.array([0, 0, 1, 1, 1, 0])
    score, ties = rng.normal(size=6), rng.normal(size=(2, 2, 2))
    p, inner, joint = H.messages(parent, depth, run, score, ties)
    total, on = 0.0, np.zeros(6)
    for y in itertools.product((0, 1), repeat=6):
        w = np.exp(sum(score[k] * y[k] for k in range(6)) + sum(ties[run[k]][y[parent[k]], y[k]] for k in range(6) if parent[k] >= 0))
        total, on = total + w, on + w * np.array(y)
    assert np.allclose(p, on / total) and np.allclose(joint.sum((1, 2)), 1) and len(inner) == 4


PLAIN = "<article><h1>Head</h1><p>A plain first paragraph of the article.</p>%s<p>And the last one, which is plain, too.</p></article>"


@pytest.mark.parametrize("middle, want", [
    *[(f"<p>First half {x} second half.</p>", f"First half {y}second half.") for x, y in [
        ("<script>x</script>", ""), ("<style>x</style>", ""), ("<iframe src=x>n</iframe>", ""), ("<select><option>a<option>b</select>", ""), ("<button>Go</button>", ""),
        ("<textarea>x</textarea>", ""), ("<label>Name</label>", ""), ("<!-- x -->", ""), ("<img src=x>", ""), ("<video src=v>told</video>", "told "),
        ("<object><b>shown</b></object>", "shown "), ("<canvas>drawn</canvas>", "drawn "), ("<noscript>said</noscript>", "said "),
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>\\x</annotation></math>", "x=2 "),
    ]],
    ("<p><a href=x>Read the full report of the harbour authority here.</a></p>", "Read the full report of the harbour authority here."),
    ("<ul><li><a href=1>First source of it</a></li><li><a href=2>The second source</a></li></ul>", "First source of it\nThe second source"),
    ("<h2><a href=x>A linked heading</a></h2>", "A linked heading"), ("<object><p>A paragraph that stands in for something else.</p></object>", "A paragraph that stands in for something else."),
    ("<details><summary>How it was done</summary><p>By hand.</p></details>", "How it was done\nBy hand."),
    ("<table><tr><th>Year</th><td>1993</td></tr></table>", "Year\n1993"), ("<p>Open <object>never closed</p>", "Open never closed"),
])
def test_blocks_of_the_article(middle, want):
    assert text(wrap(PLAIN % middle)) == f"Head\nA plain first paragraph of the article.\n{want}\nAnd the last one, which is plain, too."


def test_held_out_pages():
    """Each fourth of the labelled pages by a model of the others: the runs that it takes for main text, by their length."""
    hit = wrong = missed = 0
    for fold in range(4):
        theta, ties = H.train(tuple(p for k, p in enumerate(PAGES) if k % 4 != fold))
        for page in PAGES[fold::4]:
            forest = H.Forest()
            forest.read(0, page)
            want = {t for k, t in forest.text.items() if forest.marked[k]}
            got = set(H.main_texts([page], theta, ties)[0].split("\n")) - {""}
            hit += sum(len(t) for t in got & want)
            wrong += sum(len(t) for t in got - want)
            missed += sum(len(t) for t in want - got)
    assert hit / (hit + wrong) > 0.9 and hit / (hit + missed) > 0.9


def plain_text(page):
    """The whole operator on a small page, by adding up all assignments of states."""
    import itertools

    import numpy as np

    forest = H.Forest()
    forest.read(0, page)
    n = len(forest.parent)
    score = np.zeros(n)
    for k, f in forest.cells:
        score[k] += THETA[f]
    total, on = 0.0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(score[k] for k in range(n) if y[k]) + sum(TIES[int(forest.run[k])][y[forest.parent[k]], y[k]] for k in range(1, n)))
        total, on = total + w, on + w * np.array(y)
    return "\n".join(t for k, t in forest.text.items() if on[k] / total >= 0.5)


@pytest.mark.parametrize("page", [
    "<nav><a href=1>Home</a></nav><article><p>A text of some length stands here, as it should.</p></article>", "<p>x", "<div class=ad>Buy it</div><p>Plain words of a page.</p>",
    "<ul><li><a href=1>One</a><li>Two</ul>", "<footer><p>A long sentence that an owner of a page wrote.</p></footer><main><h1>T</h1></main>", "<aside><p>a</aside><div class=content>b<div>c</div></div>",
])
def test_whole_operator_by_enumeration(page):
    assert text(page) == plain_text(page)


@pytest.mark.parametrize("page", [
    "<div>" * 20_000 + "x" + "</section></b>" * 20_000, "<b>" * 20_000 + "<div></div></p></li>" * 5_000, "<p>a<button>b" * 5_000, "<li><b>" * 3_000 + "</ul>" * 10_000,
    "<p>x <video>" * 3_000,
])
def test_stray_ends_take_linear_time(page):
    import time

    start = time.process_time()
    text(page)
    assert time.process_time() - start < 20


def test_training_pages_are_fitted():
    marked = [H.main_texts([p.replace(" data-content", "")], THETA, TIES)[0] for p in PAGES]
    assert all(marked) and all("©" not in t for t in marked)


@pytest.mark.parametrize("page", [
    "", " ", "no markup at all", "<", "<p", "<p a='", "</", "<!--", "<script>", "<!", "<a <b <c>", "<p>" * 3000, "<div>" * 3000 + "x" + "</div>" * 10, "&" * 50,
    '<p a="' * 2000, "<li>" * 500 + "</ul>" * 500,
])
def test_broken_pages_do_not_fail(page):
    assert isinstance(text(page), str)


def test_frame(spark):
    page = wrap("<article><h1>A</h1><p>B c d.</p></article>")
    df = spark.createDataFrame([(1, page, "u"), (1, page, "u"), (2, None, None), (None, "", "text")], "page_id long, html string, text string")
    got = [(r.page_id, r.text) for r in H.extract(df).collect()]
    assert sorted(got, key=str) == sorted([(1, "A\nB c d."), (1, "A\nB c d."), (2, ""), (None, "")], key=str)
    assert H.extract(df.limit(0)).count() == 0
