import html
import re

import pytest

from cohortgram.llm import html_extract as extract

PAGES = "page_id long, url string, html string"


def page(number, body, notice="We use cookies on this site"):
    return (
        f"<!DOCTYPE html><html><head><title>Page {number}</title><style>p{{}}</style></head><body>"
        f"<header><h2>The Site</h2></header><div class='top'>{notice}</div>"
        f"<div class='text'>{body}</div><div class='end'>Made by the site</div>"
        f"<footer>&copy; {number}</footer></body></html>"
    )


def test_what_is_the_same_on_all_pages_is_template():
    pages = [page(i, f"<p>Story {i} begins.</p><p>It &amp; ends&nbsp;there, {i}.</p>") for i in range(12)]
    assert extract.extract(pages) == [f"Story {i} begins. It & ends there, {i}." for i in range(12)]


def test_a_text_that_some_pages_share_is_content():
    pages = [page(i, f"<p>{'A saying.' if i % 3 else f'Other {i}.'}</p><p>Story {i}.</p>") for i in range(12)]
    assert extract.extract(pages)[1] == "A saying. Story 1."


def test_one_page_is_read_by_its_own_structure():
    body = (
        "<nav><ul><li>Home<li>News</ul></nav><aside>Side</aside><div class='ad'>Buy</div>"
        "<article><h1>Head &lt;1&gt;</h1><p>One <b>bold</b> word<p>Two<br>lines"
        "<form><input value=x>Send</form><script>var t='</p>';</script>"
        "<section id='comments'><p>First!</p></section><div class='share-links'>Share</div></article>"
        "<div class='cookie-notice'>Cookies</div>"
    )
    assert extract.extract([f"<html><body>{body}</body></html>"]) == ["Head <1> One bold word Two lines"]


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        ("<p>a<p>b", "a b"),
        ("<p>a  \n b</p >c", "a b c"),
        ("<article>x<b>y</article>z", "xy"),
        ("<article><p>a<!-- no --><p>b <i>c", "a b c"),
        ("<article>1 < 2 &notanentity; &#233;</article>", "1 < 2 ¬anentity; é"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a b c d e"),
        ("<article></p></div>a</b></article>", "a"),
        ("<article><!-- open", ""),
        ("<article>a<script>never closed", "a"),
        ("<div style='display: none'>no</div><div hidden>no</div>yes", "yes"),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
        ("<article>" + "<h2>h</h2><p>t</p>" * 300 + "</article>", " ".join(["h t"] * 300)),
    ],
)
def test_odd_markup(source, text):
    assert extract.extract([source]) == [text]


def test_simple_tree_matching():
    def tree(source):
        return extract.shape(extract.parse(source))

    a = tree("<div><h1>x</h1><p>1</p><p>2</p><ul><li>1</li></ul></div>")
    b = tree("<div><p>1</p><table></table><ul><li>1</li><li>2</li></ul></div>")
    # Root, div, the run of p, ul and the run of li.
    assert extract.match(a, b, {}) == 5 == extract.match(b, a, {})
    assert extract.match(a, a, {}) == a.size == 6
    pairs = {(x.kind, y.kind) for x, y in extract.aligned(a, b, {})}
    assert {k[0][0] for k in pairs} == {"#root", "div", "p", "ul", "li"} and all(x == y for x, y in pairs)


def test_given_pages_against_a_plain_reading(spark, scratch):
    """The test pages are regular enough to cut the article out with a pattern."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in extract.main_text(pages, scratch).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for row in rows:
        inside = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        parts = (re.sub("<[^>]+>", "", b) for b in re.split("</?(?:p|h1|br)>", inside))
        assert found[row.page_id] == " ".join(filter(None, (" ".join(html.unescape(p).split()) for p in parts)))


def test_hosts_nulls_and_repeated_rows(docs, scratch):
    rows = [(1, None, "<p>a"), (1, None, "<p>a"), (None, "not a url", None), (2, "http://user@h.example:80/x", "<p>b"), (3, "", "")]
    frame = docs([(*r, "x", 1) for r in rows], f"{PAGES}, host string, place int")
    found = sorted(((r.page_id, r.url, r.text) for r in extract.main_text(frame, scratch).collect()), key=repr)
    assert found == sorted(
        [(1, None, "a"), (1, None, "a"), (None, "not a url", ""), (2, "http://user@h.example:80/x", "b"), (3, "", "")], key=repr
    )


def test_no_rows(docs, scratch):
    assert extract.main_text(docs([], PAGES), scratch).count() == 0


def test_a_notice_beside_siblings_of_its_kind_is_template():
    def body(i):
        more = "".join(f"<h2>Part {k} of {i}</h2><p>Text {k} of {i}.</p>" for k in range(100))
        return f"<article><p>Story {i}.</p>{f'<p>More {i}.</p>' * (i % 3 + 1)}{more}<p>Sent by the desk.</p></article>"

    for i, text in enumerate(extract.extract([f"<body>{body(i)}</body>" for i in range(9)])):
        assert "Sent by the desk" not in text
        assert text.startswith(f"Story {i}. More {i}.") and text.endswith(f"Part 99 of {i} Text 99 of {i}.")


def test_a_constant_inside_later_members_and_beside_blocks():
    def body(i):
        cards = "".join(f"<div class='card'><p>Card {k} of {i}</p><h3>Read on</h3></div>" for k in range(i + 2))
        return f"<article><div class='x'>Today we bring <ul><li>Item {i}</li></ul></div>{cards}</article>"

    texts = extract.extract([f"<body>{body(i)}</body>" for i in range(9)])
    assert texts == [" ".join([f"Item {i}", *(f"Card {k} of {i}" for k in range(i + 2))]) for i in range(9)]


def test_template_of_a_second_layout_is_found():
    first = [f"<body><div class='a'><p>Long {i}</p><ul><li>{i}</li></ul><table><tr><td>{i}</td></tr></table></div></body>" for i in range(9)]
    second = [f"<body><section class='b'><h5>Our story</h5><p>Short tale {i}</p></section></body>" for i in range(9)]
    assert extract.extract([*first, *second])[9:] == [f"Short tale {i}" for i in range(9)]


def test_two_pages_are_enough_unless_one_is_a_copy():
    pages = [page(i, f"<p>Story {i} begins.</p><p>It ends there, {i}.</p>") for i in range(2)]
    assert extract.extract(pages) == [f"Story {i} begins. It ends there, {i}." for i in range(2)]
    same = "".join(f"<p>Paragraph {k} of a text that two pages hold.</p>" for k in range(9))
    copies = [f"<body><article>{same}<p>Edit {i}</p></article></body>" for i in range(2)]
    assert all(t.startswith("Paragraph 0") and t.endswith(f"Edit {i}") for i, t in enumerate(extract.extract(copies)))
    many = [f"<body><article>{same}<p>Edit {i}</p></article></body>" for i in range(40)]
    others = [f"<body><article><p>Other {i}</p><p>Story {i}</p></article></body>" for i in range(3)]
    assert all(t.startswith("Paragraph 0") for t in extract.extract([*many, *others])[:40])


@pytest.mark.parametrize("count", [2, 7, 8, 12, 100])
def test_mirrored_articles_keep_their_text(count):
    same = "".join(f"<p>Paragraph {k} of an article that all mirrors of the host hold.</p>" for k in range(6))
    pages = [f"<body><nav>Home</nav><article><h1>Mirror {i}</h1>{same}</article></body>" for i in range(count)]
    for i, text in enumerate(extract.extract(pages)):
        assert text.startswith(f"Mirror {i} Paragraph 0") and text.endswith("Paragraph 5 of an article that all mirrors of the host hold.")


@pytest.mark.parametrize("part", ["<div class='legal-analysis'>In court.</div>", "<section class='related-work'>In court.</section>"])
def test_one_word_of_a_class_does_not_cut_content(part):
    assert extract.extract([f"<body><article><p>Start.</p>{part}<p>End.</p></article></body>"]) == ["Start. In court. End."]


@pytest.mark.parametrize("name", ["share-links", "cookie_notice", "ad-slot-2", "comments", "comment-list", "post newsletter-box", "sidebar-left"])
def test_names_of_furniture_alone_cut(name):
    assert extract.extract([f"<body><article><p>Start.</p><div class='{name}'>No.</div><p>End.</p></article></body>"]) == ["Start. End."]


def test_the_wrapper_decides_where_no_name_tells():
    """Without the alignment, furniture without a telling tag or class stays."""
    pages = [f"<body><div class='x'>The daily page</div><div class='y'><p>Story {i} goes on for a while, {i}.</p></div></body>" for i in range(9)]
    assert extract.extract(pages) == [f"Story {i} goes on for a while, {i}." for i in range(9)]
    assert [extract.extract([p])[0] for p in pages] == [f"The daily page Story {i} goes on for a while, {i}." for i in range(9)]


def test_groups_do_not_depend_on_how_the_table_is_stored(docs, spark):
    from cohortgram.plans.storage import Scratch

    rows = [(i, f"http://h.example/{i}", f"<body><div>Note {i % 70}</div><p>Text {i} of {i * 7}</p></body>") for i in range(200)]
    rows += [(7, "http://h.example/7", rows[7][2])] * 150
    frame = docs(rows, PAGES)
    first, second = (
        sorted((r.page_id, r.text) for r in extract.main_text(frame.repartition(n), Scratch(spark)).collect()) for n in (1, 7)
    )
    alone = [x for x in first if x[0] != 7]
    assert alone == [x for x in second if x[0] != 7] and len(first) == len(second) == 350
