from amperline.llm import html_consensus as h

ARTICLE = "<p>First paragraph with enough text to count, &amp; more &#233;</p><h2>Part</h2><p>Second <b>paragraph</b> with\n  enough text<br>to count as well."
WANT = "First paragraph with enough text to count, & more é\nPart\nSecond paragraph with enough text to count as well."
CLUTTER = (
    '<header class="site"><h1>Site</h1></header><nav><a href="/x">Some menu point with a long name</a></nav>'
    '<div class="cookie-notice"><p>We use cookies, a lot of them, please accept them all</p></div>'
)
AFTER = (
    '<div class="ad-box"><p>Buy this now, it is cheap, buy this now, it is cheap</p></div><aside><p>Side text which is long enough to count</p></aside>'
    '<form><p>Write to us here, we read every single letter of yours</p></form><div id="comments"><p>I like this text very much and so on and on</p></div>'
    "<script>var t = '</p><p>not text at all, but long enough to count';</script><!-- <p>hidden text that is long enough</p> --><footer>&copy; all of it</footer>"
)


def page(body, before=CLUTTER, after=AFTER):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class='has-sidebar'>{before}{body}{after}</body></html>"


def test_own_winner():
    for wrap in ("<article>{}</article>", "<main><div class='c'>{}</div></main>", "<div id='wrap'><div class='content p-12'>{}</div></div>", "{}"):
        assert h.main_text(page(wrap.format(ARTICLE)), []) == WANT
    assert h.main_text(page("<div class='post with-ad'><h1>Title</h1>" + ARTICLE + "</div>"), []) == "Title\n" + WANT


def test_unclosed_and_broken_pages():
    assert h.main_text("<article><h1>T</h1><p>One <b>two<p>three", []) == "T\nOne two\nthree"
    assert h.main_text("plain text", []) == "plain text"
    for broken in ("", "<", "<p", "<!--", "<script>", "</div></div>", "<div class='", "a < b > c"):
        assert isinstance(h.main_text(broken, [">html>body>div"]), str)


def test_consensus_beats_a_page_with_little_text(spark):
    long = page(f"<div class='box-1'>{ARTICLE}</div><div class='more'><p>Short but longer than the article of this page</p></div>", after="")
    odd = page("<div class='box-7'><p>Tiny article.</p></div><div class='more'><p>Much more text stands here than in the small article of this page, far more</p></div>", after="")
    rows = [(i, "https://A.example/x?y", long, "c") for i in range(6)] + [(7, "http://a.example:80/z", odd, "c"), (8, None, None, "c"), (9, "no url", "", "c"), (7, "http://a.example:80/z", odd, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, paths string")
    found = h.extracted(pages).collect()
    assert sorted(r.page_id for r in found) == sorted(r[0] for r in rows)
    texts = {r.page_id: r.text for r in found}
    assert texts[0] == WANT and texts[7] == "Tiny article." and texts[8] == texts[9] == ""
    assert all(r.n_chars == len(r.text) for r in found)
    assert h.extracted(pages.limit(0)).count() == 0


def test_void_elements_hold_nothing():
    for tag in ("area", "base", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"):
        for mark in ('class="banner"', "id=share-1", 'role="banner"', "hidden", 'aria-hidden="true"', 'style="display: none"'):
            got = h.main_text(f"<article><p>The first text, long enough to count here</p><{tag} {mark} src=x><p>The rest, which is long enough as well</p></article>", [])
            assert got == "The first text, long enough to count here\nThe rest, which is long enough as well", (tag, mark)
    assert h.main_text('<article><p>One text <img class="social" src=x> in one block, and long enough</p></article>', []) == "One text in one block, and long enough"


def test_hidden_is_an_attribute_name():
    for own in ('href="/hidden-falls"', "href=/hidden", 'title="the hidden lake"', "title='hidden'", 'data-hidden="1"', 'alt = "a hidden=b class=banner"', 'data-class="banner"', 'href="/x?class=ad"'):
        assert h.main_text(f"<article><p>Text with <a {own}>a link</a> in it, long enough to count</p></article>", []) == "Text with a link in it, long enough to count", own
    for own in ("hidden", 'hidden=""', "class=x hidden", "HIDDEN id=y", "hidden='until-found'", 'title="a" hidden data-x'):
        assert h.main_text(f"<article><p>Text which is long enough to count</p><div {own}><p>Not text, but long enough to count</p></div></article>", []) == "Text which is long enough to count", own
