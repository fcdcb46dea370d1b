import math
import re
from html import unescape

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierlake.llm.html_text import Lines, extract, main_text, ratios, smoothed

LONG = "A sentence that is long enough to look like the text of an article, more or less."


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<p>a", "a"),
        ("<article></article>", ""),
        ("<script>var t='</p>'</script><style>p{}</style>", ""),
        ("<article><p>One <!-- no --> two</p>tail</article>", "One two\ntail"),
        ("<article><p>a<br>b &amp; &lt;c&gt;\n\t d&nbsp;e</p></article>", "a b & <c> d e"),
        ("<article><ul><li>one<li>two</ul><p>x<p>y</article>", "one\ntwo\nx\ny"),
        ("<article><table><tr><td>a</td><td>b</td></tr></table></article>", "a b"),
        ("<article><header><h1>T</h1></header><p>x</p></article>", "T\nx"),
        ("<header><h1>Site</h1></header><article><h1>T</h1></article><footer>f</footer>", "T"),
        ("<article><p>x</p><form>no <input></form><aside>no</aside><p>y</p></article>", "x\ny"),
        ("<article><p>x</p><div class='ad-box'>no</div><div id='cookie_notice'>no</div></article>", "x"),
        ("<article><p>x</p><section class='comments'><p>no</p></section></article>", "x"),
        ("<article><p>x</p></article><article class='comment'><p>no</p></article>", "x"),
        ("<body class='has-sidebar'><div class='with-sidebar'><main><p>x</p></main></div>", "x"),
        ("<article><p>x</p><p hidden>no</p><p style='display: none'>no</p></article>", "x"),
        ("<nav><a>no</a></nav><article><p>x", "x"),
        ("<article><b>x<p>y</article><footer>no", "x\ny"),
        ("<article><p>x</p><!-- <p>no</p> --><![CDATA[no]]></article>", "x"),
    ],
)
def test_blocks(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("broken", ["<![foo[x]]>", "<![ x", "<![", "<!", "<!>", "<!x y>", "<![if IE]>", "<!-", "<?", "</", "<![x", "<!ELEMENT a"])
def test_unknown_declarations_end_at_their_bracket(broken):
    text = main_text(f"<article><p>{LONG}</p>{broken}<p>{LONG} after</p></article>")
    assert text.startswith(LONG)
    assert main_text(broken) is not None and main_text(f"<p>x</p>{broken}").startswith("x")
    if broken.endswith(">"):
        assert text == f"{LONG}\n{LONG} after"


PIECES = st.sampled_from(
    ["<", ">", "!", "[", "]", "--", "<![", "<!", "<!--", "-->", "<?", "]]>", "<![CDATA[", "/", "=", "'", '"',
     "<p>", "</p>", "<article>", "</article>", "<script>", "</script>", "<a href='x'>", "&amp;", "&#", "&#x110000;",
     "<!DOCTYPE", "<div class=ad>", "<form>", "</form>", "<td", "<textarea>", "text ", "\0", "\ud7ff", " "]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES | st.text(max_size=5), max_size=30))
def test_no_markup_crashes(pieces):
    assert isinstance(main_text("".join(pieces)), str)


def test_broken_markup_in_a_job(spark):
    rows = [(k, "u", html) for k, html in enumerate(["<![foo[x]]><p>a</p>", "<p>a</p><![ x", "<p>a</p>"])]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.text for r in found.where("page_id <> 1").collect()} == {"a"} and found.count() == 3


@pytest.mark.parametrize(
    "part", ["section id='discussion'", "p class='skip'", "div id='related-work'", "blockquote class='share-quote'"]
)
def test_names_alone_take_nothing_from_an_article(part):
    tag = part.split()[0]
    page = f"<article><h1>T</h1><p>{LONG}</p><{part}>{LONG} The rest.</{tag}><p>{LONG}</p></article>"
    assert main_text(page) == f"T\n{LONG}\n{LONG} The rest.\n{LONG}"


@pytest.mark.parametrize(
    "part",
    ["<div class='share'><a href='/'>Share this</a> <a href='/x'>Print</a></div>",
     "<div class='related'><ul><li><a href='/'>More of it</a><li><a href='/y'>And more</a></ul></div>",
     "<div class='social'><b>Follow</b> <i>us</i></div>",
     "<section class='comments'><p>" + LONG + "</p></section>",
     "<div class='ad'><p>" + LONG + "</p></div>"],
)
def test_boxes_inside_an_article_go(part):
    assert main_text(f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>") == f"{LONG}\n{LONG}"


def test_pages_in_one_form():
    inner = f"<nav><a href='/'>no</a></nav><article><p>{LONG}</p><form>no <input></form></article>"
    assert main_text(f"<body><form id='aspnet'>{inner}</form></body>") == LONG
    body = f"<div><ul><li><a href='/'>Home</a></ul></div><div><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(f"<body><form>{body}</form></body>") == main_text(f"<body>{body}</body>")
    login = f"<div><form>Name <input> Password <input></form></div><div><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(f"<body>{login}</body>") == f"{LONG}\n{LONG}"


def test_unmarked_page():
    links = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(20))
    page = (
        f"<div><ul>{links}</ul></div><div><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
        f"<div><ul>{links}</ul></div>"
    )
    assert main_text(page) == f"Title\n{LONG}\nShort.\n{LONG}"


@pytest.mark.parametrize("tag", ["div", "section", "td"])
@pytest.mark.parametrize("around", ["", "<div>"])
def test_unmarked_page_with_each_paragraph_in_its_own_element(tag, around):
    texts = [("word " * 200)[:size].strip() for size in (400, 40, 400, 300, 40, 500)]
    body = "".join(f"<{tag}><p>{t}</p></{tag}>" for t in texts)
    menu = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(10))
    page = f"<body><ul>{menu}</ul>{around}{body}{around.replace('<', '</')}<div><ul>{menu}</ul></div>"
    assert main_text(page) == "\n".join(texts)


def test_unmarked_page_with_wrapped_heading_and_list():
    menu = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(10))
    page = (
        f"<div><ul>{menu}</ul></div><div><h1><a href='/'>Title</a></h1></div><div><p>{LONG * 5}</p></div>"
        f"<div><ul><li>one<li>two</ul></div><div><p>{LONG * 5}</p></div><div><p>Last.</p></div>"
        f"<div><ul>{menu}</ul></div>"
    )
    assert main_text(page) == f"Title\n{LONG * 5}\none\ntwo\n{LONG * 5}\nLast."
    page = f"<div><ul>{menu}</ul></div><div><p>{LONG * 5}</p></div><div><p>Last.</p></div>"
    assert main_text(page) == f"{LONG * 5}\nLast."
    inline = "<div><a href='/'>Home</a> | <a href='/x'>About</a> | <a href='/y'>Contact</a></div>"
    assert main_text(inline + page) == f"{LONG * 5}\nLast."
    assert main_text(page.replace(f"<div><ul>{menu}</ul></div>", inline)) == f"{LONG * 5}\nLast."


def test_smoothing_keeps_a_constant():
    assert smoothed(np.full(7, 3.0)) == pytest.approx(np.full(7, 3.0))
    bump = smoothed(np.array([0, 0, 0, 9.0, 0, 0, 0]))
    assert bump.argmax() == 3 and bump[2] == pytest.approx(bump[4])


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in extract(pages).collect():
        body = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        blocks = [re.sub(r"<[^>]*>", "", b) for b in re.split(r"</?(?:p|h1)>", body)]
        blocks = [" ".join(unescape(b).split()) for b in blocks]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_nulls_repeats_clashes_and_empty(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(None, None, None, "x", 1), (1, "u", "<p>a</p>", None, 2), (1, "u", "<p>a</p>", None, 2)]
    table = spark.createDataFrame(rows, schema)
    assert sorted(map(tuple, extract(table).collect()), key=repr) == [
        (1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)
    ]
    assert extract(table.limit(0)).collect() == []


def test_very_long_page():
    page = f"<article>{f'<p>{LONG}</p>' * 20_000}</article>"
    assert main_text(page).count("\n") == 19_999
    assert main_text("<div>" * 3_000 + LONG) == LONG


def plain_blocks(html):
    """``text, tags, linked`` of the blocks of simple pages: tags cut out by a pattern."""
    blocks, text, tags, linked, link = [], "", 0, 0, False
    for token in re.findall(r"<[^>]*>|[^<]+", html):
        if not token.startswith("<"):
            text += token
            linked += len(token.strip()) if link else 0
            continue
        name = re.match(r"</?(\w+)", token)[1]
        if name != "a" and name != "b":
            if text.strip():
                blocks.append((" ".join(unescape(text).split()), tags, linked))
            text, tags, linked = "", 0, 0
        else:
            link = link if name == "b" else not token.startswith("</")
        tags += 1
    if text.strip():
        blocks.append((" ".join(unescape(text).split()), tags, linked))
    return blocks


def plain_main_text(html):
    """The dealt method on flat pages without marks, number by number."""
    blocks = plain_blocks(html)
    if not blocks:
        return ""
    own = [max(0, len(text) - linked) / max(1, tags) for text, tags, linked in blocks]
    score = []
    for k in range(len(own)):
        near = [(math.exp(-0.5 * (j - k) ** 2), own[j]) for j in range(max(0, k - 3), min(len(own), k + 4))]
        score.append(sum(w * x for w, x in near) / sum(w for w, _ in near))
    mean = sum(score) / len(score)
    threshold = math.sqrt(sum((x - mean) ** 2 for x in score) / len(score))
    cluster = [x >= threshold for x in score]
    strong = [c and x >= threshold for c, x in zip(cluster, own, strict=True)]
    if not any(strong):
        strong = cluster
    # All blocks lie in one region: it is chosen, and of a chosen region every block stays.
    return "\n".join(text for text, _, _ in blocks) if any(strong) else ""


def plain_ratios(html):
    return [max(0, len(t) - linked) / max(1, tags) for t, tags, linked in plain_blocks(html)]


FLAT = st.lists(
    st.tuples(st.sampled_from(["p", "h2", "li"]), st.sampled_from(["", "a", "b"]), st.integers(1, 60)),
    min_size=1, max_size=12,
)


@settings(max_examples=200, deadline=None)
@given(FLAT)
def test_flat_pages_equal_a_plain_version(parts):
    html = "".join(
        f"<{block}>{f'<{inline}>' if inline else ''}{('word ' * n).strip()}{f'</{inline}>' if inline else ''}</{block}>"
        for block, inline, n in parts
    )
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    assert [(x.text, x.tags, x.linked) for x in parser.lines] == plain_blocks(html)
    own = ratios(parser.lines)
    assert own == pytest.approx(plain_ratios(html))
    score = smoothed(own)
    for k in range(len(own)):
        weights = [math.exp(-0.5 * (j - k) ** 2) if abs(j - k) <= 3 else 0 for j in range(len(own))]
        assert score[k] == pytest.approx(np.dot(weights, own) / sum(weights))
    # On a flat page the region is the page: only menus at its ends go.
    text = main_text(html).split("\n")
    whole = plain_main_text(html).split("\n")
    assert "\n".join(text) in "\n".join(whole)
    first = max(range(len(own)), key=lambda k: own[k])
    assert plain_blocks(html)[first][0] in text or own[first] == 0
