"""Main text of small pages."""

import pytest

from snapledger.llm.html_extract import blocks, extract, main_text

P = "A sentence of some length, with a comma, to be read. "


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script>{head}</head><body>{body}</body></html>"


NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News, more</a></li></ul></nav>"
FOOT = "<footer>&copy; x &middot; All rights, reserved.</footer>"


@pytest.mark.parametrize("name,html,want", [
    ("article", page(NAV + f"<div class=\"ad\">Buy, now.</div><article><h1>Head &amp; x</h1><p><b>{P}<br><p>{P * 3}</p></article>" + FOOT),
     ["Head & x", P, P * 3]),
    ("divs", page(f"<div id='menu'><a href=x>One</a> <a href=y>Two</a></div><div id=content><h2>Title here</h2><p>{P * 4}</p><p>Short.</p>"
                  f"<ul><li>Item, one.</li><li>Item two.</li></ul><blockquote><p>{P}</p></blockquote></div>"
                  f"<div class='sidebar'><p>{P}</p></div><div class=comments><p>{P * 2}</p></div>"),
     ["Title here", P * 4, "Short.", "Item, one.", "Item two.", P]),
    ("main", page(f"<header><h1>Site</h1></header><main><header><h1>Real head</h1></header><p>{P}</p><aside><p>{P}</p></aside>"
                  f"<form><p>Your name, please.</p></form><section id=comments><p>{P}</p></section></main><div class='cookie-notice'><p>{P * 9}</p></div>"),
     ["Real head", P]),
    ("wrappers", page(f"<div class='container has-sidebar'><div class='post ad-free'><div class='post-header'><h1>Title</h1></div><p>{P * 3}</p>"
                      f"<div class='post-footer'><p>{P}</p></div></div><div class='right-sidebar'><p>{P * 2}</p></div></div>"
                      f"<article class='comment'><p>{P}</p></article><div id='ad-12'><p>{P}</p></div><div class=cookiebar><p>{P}</p></div>"),
     ["Title", P * 3]),
    ("table", page(f"<article><p>{P * 2}</p><table><tr><td>Cell, a<td>Cell b</table></article>"), [P * 2, "Cell, a", "Cell b"]),
    ("cut off", "<body><article><h1>H</h1><p>" + P + "</p><p>End &amp; not clos<b", ["H", P, "End & not clos"]),
    ("no markup", P, [P]),
    ("white space", page("<article><p>a\n\t b&nbsp;c   <i>d</i>e</p></article>"), ["a b c de"]),
    ("spacer", page(f"<article><p>{P}</p><!-- <p>no, no</p> --><p></p><p> </p><noscript>x</noscript></article>"), [P]),
])
def test_pages(name, html, want):
    assert main_text(html) == "\n".join(" ".join(w.split()) for w in want)


LONG = "".join(f"<p>{i} {P * 8}</p>" for i in range(60))


@pytest.mark.parametrize("around", ["article", "main", "div class=post-content", "div"])
def test_sections_of_unequal_length(around):
    """Named sections all stay, however long the others are, with headings."""
    got = main_text(page(NAV + f"<{around}><section id=one><h2>First</h2>{LONG}</section><section id=two><h2>Second</h2><p>{P * 8}</p></section>"
                         f"<div class=three><h2>Third</h2><p>{P * 8}</p></div></{around.split()[0]}>" + FOOT)).split("\n")
    assert len(got) == 65
    assert got[0] == "First" and got[61:] == ["Second", (P * 8).strip(), "Third", (P * 8).strip()]


@pytest.mark.parametrize("around", ["article", "main", "div class=post-content"])
def test_lists_of_links(around):
    """References and cells that are links are part of the body; lists of links outside are not."""
    got = main_text(page(f"<ul><li><a href=/x>Elsewhere</a></ul><{around}><p>{P * 8}</p><section id=refs><h2>References</h2><ul><li><a href=/a>A paper</a>"
                         f"<li><a href=/b>A book</a></ul></section><table><tr><td><a href=/c>Cell</a></table></{around.split()[0]}>"))
    assert got.split("\n") == [(P * 8).strip(), "References", "A paper", "A book", "Cell"]


@pytest.mark.parametrize("name", ["social-science", "legal-history", "side-effects", "comment", "social", "menu-history"])
@pytest.mark.parametrize("tag", ["div", "section"])
def test_names_do_not_decide_alone(name, tag):
    """A container that holds the whole text is main text, whatever its name begins with."""
    got = main_text(page(NAV + f"<{tag} class='{name}'><h1>Head</h1><p>{P * 3}</p><p>{P}</p></{tag}>" + FOOT)).split("\n")
    assert got == ["Head", (P * 3).strip(), P.strip()]


def test_named_sections_of_an_article():
    """Sections of an article stay by their ratios; those that are boilerplate by name go."""
    got = main_text(page(f"<article><h1>Drug</h1><p>{P * 3}</p><section class='side-effects'><h2>Effects</h2><p>{P * 2}</p></section>"
                         f"<section class=legal-history><p>{P * 2}</p></section><section id=comments><p>{P * 9}</p></section>"
                         f"<div class='share-buttons'>Share, please do it now.</div></article>")).split("\n")
    assert got == ["Drug", (P * 3).strip(), "Effects", (P * 2).strip(), (P * 2).strip()]


def test_forms():
    """A form round the whole page is a plain container, one beside the text is not."""
    inner = f"<div><p>{P * 3}</p><p>{P}</p><label>Name, please:</label><input name=a><select><option>One<option>Two</select><button>Send it.</button></div>"
    assert main_text(page(f"<form action=/x>{NAV}{inner}{FOOT}</form>")).split("\n")[:2] == [(P * 3).strip(), P.strip()]
    assert main_text(page(f"<form><p>Search for anything, here.</p></form><div><p>{P * 3}</p></div>")) == (P * 3).strip()
    assert main_text(page(f"<main><form><article><h1>A</h1><p>{P * 3}</p></article></form></main>")) == "A\n" + (P * 3).strip()


def test_unclosed_quotes():
    """A tag whose quote is not closed ends at its >; no markup gets into the text."""
    got = main_text(page(f"<article><p>{P}</p><p>before <a title=\"x y\" href=\"u>broken</a> after, it.</p><p class='z>{P}</p></article>"))
    assert "<" not in got and ">" not in got and "href" not in got
    assert got.split("\n")[0] == P.strip() and "broken" in got


def test_articles_that_hold_little():
    """Teasers marked up as articles do not push out the text beside them."""
    got = main_text(page(f"<article><p>{P}</p></article><div class=x><p>{P * 4}</p><p>{P * 4}</p></div>"))
    assert (P * 4).strip() in got


def test_empty_and_null(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<html></html>"), (None, "u", page(f"<article><p>{P * 20000}</p></article>")),
            (4, "u", page(f"<article><p>{P}</p></article>")), (4, "u", page(f"<article><p>{P}</p></article>")), (5, "u", "<" * 2000 + "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, n_chars int").repartition(2)
    got = extract(df).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    texts = {r["page_id"]: r["text"] for r in got}
    assert texts[1] == texts[2] == texts[3] == "" and texts[4] == P.strip() and len(texts[None]) == 20000 * len(P) - 1
    assert extract(df.where("false")).count() == 0


def test_paths():
    got = blocks("<body><div class='a b'><p>x<p>y</div><ul><li>1<li>2</ul>")
    assert [(b[0].split("/")[2:], b[4]) for b in got] == [(["div.a.b", "p"], "x"), (["div.a.b", "p"], "y"), (["ul", "li"], "1"), (["ul", "li"], "2")]


def test_given_pages(spark):
    """The templates of the given pages: article in, menu, advert and footer out."""
    import re

    from snapledger.plans.tables import table
    for r in table(spark, "/root/testdata/sf0.01", "pages").where("html like '%</article>%'").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        want = [re.sub(r"\s+", " ", __import__("html").unescape(re.sub(r"<(b|br)>", " " if False else "", x))).strip()
                for x in re.split(r"</?(?:p|h1)>", inner)]
        assert main_text(r["html"]) == "\n".join(x for x in want if x)
