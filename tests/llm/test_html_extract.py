import re
from html import unescape

from pitlane.llm import html_extract as H
from pitlane.llm.common import table

FLAT = {H.WORD: 1.0, "": -1.0}


def best_by_brute_force(parts, weights):
    value = [weights[H.WORD] * len(v.split()) if k == "text" else weights.get(v, weights[""]) for k, v in parts]
    return max((sum(value[a:b]) for a in range(len(parts) + 1) for b in range(a, len(parts) + 1)), default=0.0), value


def test_region_is_the_maximum_subsequence():
    pages = [
        "<p>a b</p><div><i>x</i></div><p>one two three four</p><p>five six</p><hr><hr><hr><p>z</p>",
        "<b></b><b></b>",
        "words only here",
        "",
        "<p>a</p>" * 20,
    ]
    for weights in (FLAT, {H.WORD: 0.4, "p": -0.1, "": -2.0}):
        for page in pages:
            parts = H.pieces(page)
            a, b = H.region(parts, weights)
            best, value = best_by_brute_force(parts, weights)
            assert abs(sum(value[a:b]) - best) < 1e-9


def test_boilerplate_is_left_out_and_the_rest_kept():
    page = """<html><head><title>T</title><style>p{}</style></head><body class="page has-sidebar"><header><h1>Site</h1></header>
    <nav><ul><li>menu one</li></ul></nav><script>var t="</p>";</script><!-- <p>hidden</p> -->
    <article class="post"><header><h1>The &amp; title</h1></header><p>First   block <b>bo</b>ld&nbsp;text<br>goes on.
    <p>Second block with enough words to matter &lt;here&gt;.</p><div class="ad-box">buy now</div><aside>side words</aside>
    <form><p>your mail</p></form><ul><li>item one of the list</li><li>item two of the list</li></ul></article>
    <div id="comments"><p>a reader says a lot of things here</p></div><footer>&copy; us</footer></body>"""
    want = "The & title\nFirst block bold text goes on.\nSecond block with enough words to matter <here>.\nitem one of the list\nitem two of the list"
    for weights in (FLAT, {H.WORD: 0.9, "": -1.0, "p": -0.05}):
        assert H.extract(page, weights) == want


def test_unmarked_pages_are_found_by_the_scan():
    words = " ".join(f"w{i}" for i in range(40))
    page = f"<div><a>one</a><a>two</a><a>three</a></div><div><p>{words}</p><p>{words}</p></div><div><a>x</a><a>y</a></div>"
    assert H.extract(page, FLAT) == f"{words}\n{words}"


def test_malformed_pages():
    assert H.extract("<p>one <b>two<p>three four", FLAT) == "one two\nthree four"
    assert H.extract("a < b and c > d", FLAT) == "a < b and c > d"
    assert H.extract("<!-- never closed <p>x</p>", FLAT) == ""
    assert H.extract("<script>if (a<b) x()", FLAT) == ""
    assert H.extract('<p title="a>b">text here</p>', FLAT) == "text here"
    assert H.extract("<nav>menu <article><p>one two three four five six</p></article>", FLAT) == "one two three four five six"
    assert H.extract(None, FLAT) == ""


def marked_text(page):
    """The marked article by a plain rule, on pages like the given ones."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1].replace("<br>", " ")
    parts = (re.sub("<[^>]+>", "", x) for x in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)


def test_given_pages(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    want = {r.page_id: (r.url, marked_text(r.html)) for r in pages.collect()}
    got = {r.page_id: r for r in H.main_text(pages).collect()}
    assert {k: (r.url, r.text) for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_awkward_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", "", "x"), (None, None, "<p>some words</p>", "x"), (2, "u", "plain " * 100_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.main_text(pages).collect()
    assert sorted((str(r.page_id), r.text[:10], r.n_chars) for r in got) == [("1", "", 0), ("1", "", 0), ("2", "plain plai", 599_999), ("None", "some words", 10)]
    assert H.main_text(pages.limit(0)).collect() == []


def test_weights_follow_the_labels(spark):
    weights = H.learn_weights(table(spark, "/root/testdata/sf0.01", "pages"))
    assert weights[H.WORD] > 0 > weights["p"] > weights["a"] and all(v < 0 for k, v in weights.items() if k != H.WORD)


def test_nothing_else_of_an_article_is_dropped():
    def of(inner):
        return H.extract(f"<nav>menu</nav><article>{inner}</article>", {H.WORD: 2.0, "": -0.1})

    assert of('<p>one</p><svg class="i"/><p>two</p><p>three</p>') == "one\ntwo\nthree"
    assert of('<p>one</p><svg viewBox="0 0 1 1"><path d="x"/><text>drawn</text></svg><p>two</p>') == "one\ntwo"
    assert of("<p>so <math><mi>x</mi></math> holds</p><math/><p>two</p>") == "so x holds\ntwo"
    assert of("<object><p>plain form</p></object><noscript><p>no script</p></noscript>") == "plain form\nno script"
    assert of('<h2 id="related-work">Related work</h2><p class="notice">text</p><h2 class="section-header">Next</h2>') == "Related work\ntext\nNext"
    assert of('<p>one</p><div class="related"><p>other pages</p></div>') == "one"
    assert H.extract('<div><h2 class="section-header">Title</h2><p>one two three</p></div>', {H.WORD: 2.0, "": -0.1}) == "Title\none two three"


def test_unmarked_pages_do_not_thin_out_the_labelled_ones(spark):
    marked = [(None, None, f"<div><a>m{i}</a></div><article><p>one two</p>{'<b>x</b>' * i}</article>") for i in range(40)]
    pages = spark.createDataFrame(marked + [(i, "u", "<p>words</p>") for i in range(400)], "page_id long, url string, html string")
    every = H.learn_weights(pages, 10_000)
    assert H.learn_weights(pages, 40) == every
    some = H.learn_weights(pages, 20)
    assert some != every and "b" in some


def paragraph(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


LEARNED = {H.WORD: 0.88, "p": -0.05, "h1": -0.05, "b": -0.05, "br": -0.05, **dict.fromkeys("li ul a div nav footer".split(), -H.MOST * 0.88), "": H.UNSEEN}
FIRST, LAST = paragraph(30, "first"), paragraph(30, "last")
INNER = {
    "list": ("<ul>" + "".join(f"<li>item {i}</li>" for i in range(6)) + "</ul>", "\n".join(f"item {i}" for i in range(6))),
    "table": ("<table>" + "".join(f"<tr><td>{i}</td><td>x{i}</td></tr>" for i in range(10)) + "</table>", "\n".join(f"{i}\nx{i}" for i in range(10))),
    "div": ("<div><div>nested text</div></div>", "nested text"),
    "figure": ("<figure><img src=a.png><figcaption>a caption</figcaption></figure>", "a caption"),
    "references": ("<ol>" + "".join(f'<li><a href="/{i}">reference number {i}</a></li>' for i in range(10)) + "</ol>", "\n".join(f"reference number {i}" for i in range(10))),
    "section": ('<section id="related-work"><h2>Related work</h2><p>others did</p></section>', "Related work\nothers did"),
    "button": ("<p>press <button>Save</button> twice</p>", "press Save twice"),
    "header": ('<header class="entry-header"><h1>Title</h1></header>', "Title"),
}


def test_marked_articles_stay_whole():
    for name, (inner, text) in INNER.items():
        page = f"<nav><a>menu</a></nav><article><p>{FIRST}</p>{inner}<p>{LAST}</p></article><footer>foot</footer>"
        assert H.extract(page, LEARNED) == f"{FIRST}\n{text}\n{LAST}", name
    title = "<main><article><header><h1>Title</h1></header><p>one two three</p><ul><li>last</li></ul></article></main>"
    assert H.extract(title, LEARNED) == "Title\none two three\nlast"
    teasers = f"<article><p>{FIRST}</p></article><article><p>short</p></article>"
    assert H.extract(teasers, LEARNED) == FIRST
    assert H.extract("<main><article>a b</article><article>c d</article></main>", LEARNED) == "a b\nc d"


def test_unmarked_pages_keep_nearly_all_of_their_text():
    """Share of the article's words kept on pages that mark nothing, and none of the rest."""
    kept = every = 0
    for inner, text in INNER.values():
        for around in ("<div>{}</div>", '<div class="content no-sidebar">{}</div>', '<div class="site has-header"><div id="page">{}</div></div>', "<form>{}</form>"):
            body = f"<p>{FIRST}</p>{inner}<p>{LAST}</p>"
            page = (
                '<div class="site-header"><a>home</a></div><ul><li><a>menu</a></li><li><a>two</a></li></ul><p class="cookie-notice">we use cookies here</p>'
                + around.format(body)
                + '<div id="disqus_thread"><p>' + paragraph(200, "reader") + '</p></div><div class="ad-box">buy</div><footer>foot</footer>'
            )
            got, want = H.extract(page, LEARNED).split(), f"{FIRST} {text} {LAST}".split()
            assert not set(got) - set(want)
            kept, every = kept + len(got), every + len(want)
    assert kept / every > 0.99, kept / every


def test_boilerplate_names():
    for yes in ('class="ad"', "id=comments", "class='comment-list x'", 'class="x site-footer"', 'role="navigation"', 'class="share_buttons2"'):
        assert H._boilerplate_name(yes), yes
    for no in ('class="content no-sidebar"', 'class="has-header"', 'id="related-work"', 'class="entry-header"', 'class="adder"', 'href="ad"', ""):
        assert not H._boilerplate_name(no), no


def test_hostile_pages_take_linear_time():
    import time

    for k, unit in enumerate(("<svg ", '<a b="', "<a b='\"", "<", "<!--", "<script>", "<article>", "</p>", "<p", '<a "<a>" ', "<form>", "<div class=ad>", "<button>x", "<svg>", 'class="', "<a ' > ", "&")):
        n = (5 if k < 2 else 1) << 20
        page = unit * (n // len(unit))
        began = time.process_time()
        H.extract(page[: n // 4], LEARNED)
        quarter = time.process_time() - began
        began = time.process_time()
        H.extract(page, LEARNED)
        took = time.process_time() - began
        assert took < 5 or took < 6 * quarter, (unit, quarter, took)


def test_tags_with_quotes():
    assert H.pieces('<p title="a>b" class=x>t</p >') == [("open", "p"), ("text", "t"), ("close", "p")]
    assert H.pieces("<p title='never>t") == [("open", "p"), ("text", "t")]
    assert H.pieces("<br/><P>x<3 & <!DOCTYPE html><?php x?>y") == [("open", "br"), ("open", "p"), ("text", "x"), ("text", "<"), ("text", "3 & "), ("text", "y")]
    assert H.blocks(H.pieces("a<b c<d")) == "a<b c<d"
    assert H.pieces('<svg/>a<svg x=">">b<SVG>c</svg >d') == [("text", "a"), ("text", "d")]
    assert H.pieces("a<script>1</SCRIPT >b<textarea>c") == [("text", "a"), ("text", "b")]
