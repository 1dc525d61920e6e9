from __future__ import annotations

import pytest

from quitanda.llm.extraction import body_span, extract_text, main_text


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<nav>menu</nav>", ""),
        ("<p>just a  text\n here </p>", "just a text here"),
        ("<title>t</title><article><h1>A &amp; B</h1><p>one<p>two<br></article><p>foot", "A & B\none\ntwo"),
        ("<nav><ul><li>a</li></ul></nav><p>x</p><footer>f</footer>", "x"),
        ("<div class='ad'>buy</div><article><p>x</p><aside>s</aside><p>y</p></article>", "x\ny"),
        ("<article><p>x</p><div class='comments'><div>c</div><p>d</p></div><p>z</p></article>", "x\nz"),
        ("<article><script>var t='</p>';</script><p>a<b>b</b>c</p></article>", "abc"),
        ("<article><p>&lt;b&gt; stays</p></article>", "<b> stays"),
        ("<!-- <p>no</p> --><main><p>yes</p></main>", "yes"),
        ("<nav>never closed <article><p>body</p></article>", "body"),
        ("<article><p>un<b>closed", "unclosed"),
        ("<form><p>q</p><input></form><p>r</p>", "r"),
        ("<p>a > b</p><p title='x>y'>c</p>", "a > b\nc"),
        ("<article><style>p{}</style>", ""),
        ("<header>h</header><div id=\"sidebar\"><p>s</p></div><div><p>t</p></div>", "t"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


def test_span_from_surge_to_dive():
    assert body_span([]) == (0, 0)
    assert body_span([0, 0]) == (0, 0)
    assert body_span([0, 5, 0, 0, 0, 0, 7, 0]) == (1, 7)


def test_pages(spark):
    schema = "page_id bigint, url string, html string, text string"
    rows = [(1, None, "<p>x</p>" * 20_000, "own"), (1, "u", None, None), (1, "u", None, None)]
    pages = spark.createDataFrame(rows, schema)
    found = sorted(extract_text(pages, ["page_id"]).collect(), key=lambda r: len(r.text))
    assert [len(r.text) for r in found] == [0, 0, 39_999]
    assert extract_text(pages.limit(0)).count() == 0


def test_a_page_with_many_open_tags_takes_linear_time():
    page = "<div class=a><p>" * 30_000 + "x"
    assert main_text(page) == "x"
    assert main_text("<" * 50_000) == "<" * 50_000


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article><p class="notice">N<p>Real one<p>Real two</article>', "Real one\nReal two"),
        ("<article><ul><li class=share>S<li>Real</ul></article>", "Real"),
        ("<main><div><p class=notice>N</div><p>Real</p></main>", "Real"),
        ("<main><div><nav>N<p>n</div><p>Real</p></main>", "Real"),
        ("<table><tr><td class=ad>A<td>B<tr><td>C</table>", "B\nC"),
    ],
)
def test_a_skipped_element_ends_with_its_parent(page, text):
    assert main_text(page) == text


def test_surge_and_dive_decide_on_plain_pages():
    links = "<div><ul>" + "".join(f"<li><a href=/{i}>Section {i}</a>" for i in range(30)) + "</ul></div>"
    words = "<div>Home</div><div>About</div><div>Contact</div><div>Shop</div>"
    body = [f"Paragraph {i} of the text, " + "with many more words " * 6 + "end." for i in range(4)]
    article = "<div>" + "".join(f"<p>{p}</p>" for p in body) + "</div>"
    foot = "<div>Imprint</div><div>Privacy</div><div>2024</div>"
    assert main_text(links + words + article + links + foot) == "\n".join(body)
    wrong = f"<div class='content has-sidebar'>{article}<div class=sidebar>{body[0]}</div></div>"
    assert main_text(links + words + wrong + foot) == "\n".join(body)
