import pytest

from daymark.llm.tag_paths import extract, main_text, path_scores


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>A title</title>{head}</head><body>{body}</body></html>"


P1 = "The first paragraph is long enough, and it has punctuation; so it tells a story."
P2 = "The second one, too, goes on for a while. It ends here."
MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"


@pytest.mark.parametrize("body,expected", [
    (f"{MENU}<article><h1>Head</h1><p>{P1}</p><p>{P2}</p></article><footer>Imprint of us, all rights. Kept.</footer>", ["Head", P1, P2]),
    (f"{MENU}<div class='ad'>{P2} {P2} {P1}</div><article><h1>Head</h1><p>Short.</p></article>", ["Head", "Short."]),
    (f"<div id='content'><h2>Head</h2><p>{P1}</p><ul><li>one</li><li>two</li></ul><p>{P2}</p></div><div class='sidebar'><p>{P1}</p></div>",
     ["Head", P1, "one", "two", P2]),
    (f"<main><p><b>{P1}<br><p>{P2}</main><aside><p>{P1}</p></aside>", [P1, P2]),
    (f"<article><p>{P1}</p><section class='comments'><p>{P2} {P2}</p></section></article>", [P1]),
    (f"<header><p>{P2}</p></header><article><header><h1>Head</h1></header><p>{P1}</p><form><p>{P2}</p></form></article>", ["Head", P1]),
    (f"<p>{P1}</p><div class='cookie-notice'>{P2}</div><p>{P2}</p>", [P1, P2]),
    (f"<article><p>A &amp; B&nbsp;&#8212; {P1}\n\n   {P2}</p></article>", [f"A & B — {P1} {P2}"]),
    (f"<article><p>{P1}</p><script>var t='</p><p>no</p>';</script><!-- <p>no</p> --><style>p{{}}</style></article>", [P1]),
    (f"<table><tr><td><p>{P1}<td>{P2}</table>", [P1, P2]),
    (f"<article><p>{P1} <a href='x'>a link</a> goes <i>on</i></p></article>", [f"{P1} a link goes on"]),
    ("plain text only", ["plain text only"]),
    (MENU, []),
    ("", []),
])
def test_pages(body, expected):
    assert extract(page(body)) == "\n\n".join(expected)


LONG = " ".join(f"Sentence {k} of the story goes on, and on." for k in range(13))
REST = " ".join(f"Sentence {k} of the rest goes on, and on." for k in range(7))


@pytest.mark.parametrize("outer", ["article", "main", "div", "div class='post'"])
@pytest.mark.parametrize("inner", ["div", "section", "section class='part'", "article"])
@pytest.mark.parametrize("first,second", [(LONG, REST), (LONG, LONG), (REST, LONG)])
def test_articles_in_nested_sections_stay_whole(outer, inner, first, second):
    end, close = inner.split()[0], outer.split()[0]
    parts = f"<{inner}><h2>One</h2><p>{first}</p></{end}><{inner}><h2>Two</h2><div><p>{second}</p></div></{end}>"
    body = f"{MENU}<{outer}><h1>Head</h1><p>{P1}</p>{parts}</{close}><footer>{P2}</footer>"
    assert extract(page(body)) == "\n\n".join(["Head", P1, "One", first, "Two", second])


@pytest.mark.parametrize("body", [
    f"<article><h1>Head</h1><div><p>{LONG}</p><p>{LONG}</p></div><div><ul><li>one</li><li>two</li></ul></div></article>",
    f"<div><section class='part'><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></section><section class='part'><ul><li>one</li><li>two</li></ul></section></div>",
])
def test_parts_with_short_blocks_only_belong_to_the_article(body):
    assert extract(page(MENU + body)) == "\n\n".join(["Head", LONG, LONG, "one", "two"])


def test_text_beside_the_only_article_is_no_part_of_it():
    body = f"<article><section><p>{LONG}</p></section><section><p>{REST}</p></section></article><div><p>{P1}</p></div>"
    assert extract(page(body)) == f"{LONG}\n\n{REST}"


LINK = "<a href='/r'>See the whole report</a>"


@pytest.mark.parametrize("opened,closed", [
    ("<div class='content has-sidebar'>", "</div>"), ("<article class='post comments-open'>", "</article>"),
    ("<article class='tags'>", "</article>"), ("<main class='with-header'>", "</main>"),
    ("<form id='aspnetForm'><div>", "</div></form>"), ("<form><article>", "</article></form>"),
    ("<div id='search'><fieldset>", "</fieldset></div>"), ("<article><div class='widget'>", "</div></article>"),
    ("<form class='page-header'><div class='widget-area'>", "</div></form>"),
])
def test_names_and_forms_around_the_article_do_not_cut_it(opened, closed):
    body = f"{MENU}{opened}<h1>Head</h1><p>{P1}</p><p>{P2}</p><div class='related'><p>{P2}</p></div>{closed}<div class='sidebar'><p>{P2}</p></div>"
    assert extract(page(body)) == "\n\n".join(["Head", P1, P2])


def test_an_article_beside_named_teasers_and_comments_is_taken():
    teasers = f"<div class='related'><article><p>{P1}</p></article><article><p>{P2}</p></article></div>"
    assert extract(page(f"<div id='story'><p>{LONG}</p></div>{teasers}")) == LONG
    talk = f"<div class='comments'><form><p>{P1}</p></form><p>{LONG}</p></div>"
    assert extract(page(f"<form id='f'><article class='post comments-open'><p>{P1}</p>{talk}</article></form>")) == P1
    assert extract(page(f"<section class='has-ads'><p>{P1}</p></section><section class='has-ads'><p>{P2}</p></section>")) == f"{P1}\n\n{P2}"


@pytest.mark.parametrize("header", ["<header class='entry-header'>", "<div class='entry-header'>"])
def test_the_header_in_an_article_keeps_the_headline(header):
    body = f"{MENU}<article>{header}<h1>Head</h1></{header[1:].split()[0]}><p>{P1}</p></article>"
    assert extract(page(body)) == f"Head\n\n{P1}"


@pytest.mark.parametrize("opened,closed", [("<article>", "</article>"), ("<div>", "</div>"), ("", "")])
def test_blocks_of_links_in_the_article_stay(opened, closed):
    body = f"{MENU}{opened}<h1>Head</h1><p>{P1}</p><ul><li>{LINK}</li></ul><p>{P2}</p><p>{LINK}</p>{closed}<div><div>{LINK}</div></div>"
    text = "See the whole report"
    assert extract(page(body)) == "\n\n".join(["Head", P1, text, P2, text])


def test_broken_and_empty_pages():
    assert extract(None) == extract("") == extract("   ") == extract("<html>") == ""
    assert extract("</p></div>text") == "text"
    assert extract("<p>one<p>two") == "one\n\ntwo"
    assert extract("<div>" * 3000 + P1) == P1


def test_ratios_are_means_of_a_path():
    blocks = [("a/p", (1,), "x" * 50 + ".", 0), ("a/p", (2,), "x" * 70 + "..", 0), ("a/li", (3,), "x", 0)]
    scores = path_scores(blocks)
    assert scores["a/p"] > scores["a/li"] > 0


def test_rows_are_independent(spark):
    schema = "page_id long, url string, html string, text string"
    rows = [(1, "u", page(f"<article><p>{P1}</p></article>"), "clash"), (1, "u", page(f"<article><p>{P1}</p></article>"), "clash"),
            (None, None, None, None), (2, "v", "", None), (3, "w", page(f"<article><p>{(P1 + ' ') * 5000}é😀</p></article>"), None)]
    got = [tuple(r) for r in main_text(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "u", P1, len(P1))] * 2 + [(None, None, "", 0), (2, "v", "", 0), (3, "w", (P1 + " ") * 5000 + "é😀", 5000 * len(P1) + 5002)], key=str
    )
    assert main_text(spark.createDataFrame([], schema)).collect() == []


def test_given_pages(spark, sf_dir):
    """Every page of the given table has one article; its text is all there, and nothing else."""
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in main_text(pages).collect():
        article = re.split(r"</article>|<footer", source[r["page_id"]].split("<article>")[1])[0]
        parts = re.split(r"</?(?:p|h1|h2|ul|li)\b[^>]*>", article)
        texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " ")))).strip() for p in parts]
        assert r["text"] == "\n\n".join(t for t in texts if t)
