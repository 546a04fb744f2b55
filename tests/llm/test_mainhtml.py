import re
import time

import pytest

from callweave.llm import mainhtml

NAV = "<nav><ul><li><a href='/a'>Alpha</a></li><li><a href='/b'>Beta</a></li></ul></nav>"
LONG = "This is a sentence of some length that belongs to the article and to nothing else. "


def test_marked_article_keeps_short_blocks_and_leaves_the_rest():
    html = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style><script>var a="</p>";</script></head><body>{NAV}
    <div class="ad">Buy now</div><header><h2>Site</h2></header><article><h1>Head &amp; line&quot;</h1><p><b>{LONG}<br>
    more\t text<p>Be.</p><div class="newsletter">sign</div><aside>side</aside><form><input value="x">send</form><p>End&nbsp;here</p>
    <section id="comments"><p>{LONG * 5}</p></section></article><footer>&copy; me</footer>"""
    assert mainhtml.main_text(html) == f'Head & line"\n{LONG.strip()} more text\nBe.\nEnd here'


def test_unmarked_page_uses_surge_and_dive():
    menu = "".join(f"<div><a href='/{k}'>Item {k}</a></div>" for k in range(9))
    html = f"<body><div>{menu}</div><div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div>{menu}</div><div>Imprint</div></body>"
    assert mainhtml.main_text(html) == f"{LONG.strip()}\nShort.\n{LONG.strip()}"


def test_regions_by_windows():
    assert mainhtml.regions([0, 0, 5, 0, 0, 7, 0, 0, 0, 4], 0, 3) == [(2, 6), (9, 10)]
    assert mainhtml.regions([], 0, 3) == [] and mainhtml.regions([0, 0], 0, 3) == []
    assert mainhtml.regions([4, 0, 5, 0, 0, 0, 30, 0, 0, 0, 2], 9, 3) == [(0, 3), (6, 7)]


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain < text & more"), (4, "u", "<p>a</p><!-- open"), (5, "u", "<nav>x"), (6, "u", "<article><p>" + "word " * 100_000)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = [tuple(r) for r in mainhtml.extract(pages).collect()]
    assert got[:5] == [(1, "u", "", 0), (2, None, "", 0), (None, "u", "plain < text & more", 19), (4, "u", "a", 1), (5, "u", "", 0)]
    assert got[5][3] == 499_999
    assert mainhtml.extract(pages.limit(0)).count() == 0


def test_names_of_wrappers_do_not_empty_the_page():
    article = f"<h1>Head</h1><p>{LONG}</p><p>{LONG * 2}</p>"
    want = f"Head\n{LONG.strip()}\n{(LONG * 2).strip()}"
    for tag in ('div class="layout no-sidebar"', 'div class="has-sidebar"', 'div class="with-nav"', 'div class="comments-open"', 'div class="share-enabled"', 'div class="post hentry tag-foo"', 'div id="search-result"', "form", 'div class="widget"'):
        name = tag.split()[0]
        assert mainhtml.main_text(f"<body>{NAV}<{tag}>{article}</{name}></body>") == want, tag
        assert mainhtml.main_text(f"<body>{NAV}<{tag}><article>{article}</article></{name}></body>") == want, tag
    for name in ("site-footer", "ad-leaderboard", "cookie-consent-banner", "comments-area", "sidebar left", "post_tags", "social-share-buttons"):
        assert mainhtml.main_text(f'<body><div><h1>Head</h1><p>{LONG}</p><p>{LONG * 2}</p></div><div class="{name}"><p>{LONG}</p></div></body>') == want, name


S = LONG.strip()
MENU = "".join(f"<div><a href='/{k}'>Item {k}</a></div>" for k in range(9))
#: (name, page, main text): written and labelled by hand.
PAGES = [
    ("names that only look like notices", f"<article><p>{S}</p><div class='share-price'><p>Shares fell.</p></div><p class='search-theory'>Theory.</p><p id='social-history'>Past.</p></article>", f"{S}\nShares fell.\nTheory.\nPast."),
    ("rights at the end of an unmarked page", f"<body><div><p>{S}</p><p>{S}</p></div><div>Copyright 2020 Foo Inc</div></body>", f"{S}\n{S}"),
    ("rights inside the container", f"<body><div><p>{S}</p><p>&copy; 2020 Foo Inc. All rights reserved.</p></div></body>", S),
    ("a sentence about copyright stays", f"<body><div><p>{S}</p><p>Copyright is a right that authors hold.</p></div></body>", f"{S}\nCopyright is a right that authors hold."),
    ("a quote inside a value", f"<body><p title='it's'>{S}</p></body>", S),
    ("a short part after an aside", f"<body><div><p>{S} {S} {S} {S}</p></div><aside>side</aside><div><p>{S}</p></div></body>", f"{S} {S} {S} {S}\n{S}"),
    ("a paragraph that is one link", f"<body><div><p>{S}</p><p><a href=x>{S}</a></p><p>{S}</p></div></body>", f"{S}\n{S}\n{S}"),
    ("an advert after the intro", f"<body><div><h1>Head</h1><p>intro</p><div class=ad>buy</div><p>{S}</p><p>{S}</p></div></body>", f"Head\nintro\n{S}\n{S}"),
    ("an advert before the last line", f"<body><div><p>{S}</p><p>{S}</p><div class='ad-box'>buy</div><p>The end.</p></div></body>", f"{S}\n{S}\nThe end."),
    ("a teaser in an article element", f"<body><div><article><h3>Teaser</h3><p>short card</p></article></div><div><p>{S}</p><p>{S}</p><p>{S}</p></div></body>", f"{S}\n{S}\n{S}"),
    ("a headline apart from its text", f"<body><div><h1>A headline of five words</h1></div><div class=share>Share</div><div><p>{S}</p></div></body>", f"A headline of five words\n{S}"),
    ("menus of plain blocks round the text", f"<body><div>{MENU}</div><div><p>{S}</p><ul><li>one point</li><li>another</li></ul><p>{S}</p></div><div>{MENU}</div><div>Imprint</div></body>", f"{S}\none point\nanother\n{S}"),
    ("text without paragraphs", f"<body><nav><a href=x>Home</a></nav><div>{S}<br>{S}<div class=advert>buy</div>{S}</div></body>", f"{S} {S}\n{S}"),
    ("reader comments", f"<body><div><p>{S}</p></div><div id=comments><p>{S}</p><p>{S}</p></div></body>", S),
    ("a table", f"<body><div><p>{S}</p><table><tr><td>a<td>b<tr><td>c</table></div></body>", f"{S}\na\nb\nc"),
    ("hidden and blank parts", f"<body><div><p>{S}</p><p hidden>no</p><p style='display:none'>no</p><p>&nbsp;</p></div></body>", S),
    ("paragraphs named for their subject", f"<article><p>{S}</p><p class='social'>On social policy much was said.</p><p class='share'>The share price rose again.</p><div class='recipe-menu'><p>Soup, then fish and cake.</p></div></article>", f"{S}\nOn social policy much was said.\nThe share price rose again.\nSoup, then fish and cake."),
    ("the same names on links and labels", f"<article><p>{S}</p><p class='social'><a href=x>Post it on this site.</a></p><p class='share'>Share</p><div class='recipe-menu'><a href=x>Soups</a> <a href=y>Cakes</a></div><div class='site-menu'>Go to the other pages.</div></article>", S),
    ("a short last part after a menu", f"<body><div><p>{S}</p><p>{S}</p></div><nav>x</nav><div><p>The end.</p></div></body>", f"{S}\n{S}\nThe end."),
    ("a paragraph on the law", f"<body><div><p>{S}</p><p>Copyright 2020 law is discussed here at length.</p><p>{S}</p></div></body>", f"{S}\nCopyright 2020 law is discussed here at length.\n{S}"),
    ("rights inside an article", f"<article><p>{S}</p><p>Copyright 2020-2023 Foo. All rights reserved</p></article>", f"{S}\nCopyright 2020-2023 Foo. All rights reserved"),
    ("a list of links between paragraphs", f"<body><div><p>{S}</p><ul><li><a href=x>First source</a></li><li><a href=y>Second source</a></li></ul><p>{S}</p></div><ul><li><a href=z>Elsewhere</a></li></ul></body>", f"{S}\nFirst source\nSecond source\n{S}"),
    ("deep inline elements", f"<body><div><p>{'<span class=x><em>' * 30}{S}{'</em></span>' * 30}</p><p><a href=x>{S}</a></p><p>{S}</p></div></body>", f"{S}\n{S}\n{S}"),
    ("repeated rows and ties", f"<body><div><p>{S}</p><p>{S}</p></div><nav>x</nav><div><p>{S}</p><p>{S}</p></div></body>", f"{S}\n{S}\n{S}\n{S}"),
]


@pytest.mark.parametrize("name,html,want", PAGES, ids=[p[0] for p in PAGES])
def test_pages_labelled_by_hand(name, html, want):
    assert mainhtml.main_text(html) == want


@pytest.mark.parametrize("html", ["<a " * 40_000, "<a href='x" * 20_000, "<a>" * 20_000 + "<p>x", "<b>x" * 40_000, "</x>" * 40_000, "<div>" * 20_000 + "</x>" * 20_000, "<div class=ad>" * 3_000 + "x", "<form>" + "<div>x" * 20_000, "<p class=share>x. " * 20_000, "<div class=recipe-menu>" * 3_000 + "a b c.", '<a b="' * 20_001, "<p>" * 40_000, "<p>" + "a b " * 200_000 + "."])
def test_broken_markup_takes_linear_time(html):
    began = time.perf_counter()
    mainhtml.main_text(html)
    assert time.perf_counter() - began < 2


def test_pages_without_their_article_tags_read_alike(spark):
    """The distribution alone finds what the mark shows, rights apart, on every given page."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    bare = re.compile(r"</?(?:article|main)\b[^>]*>")
    for (html,) in pages:
        marked, found = (mainhtml.main_text(h).split("\n") for h in (html, bare.sub("", html or "")))
        assert found == [x for x in marked if not mainhtml._rights(x)]
