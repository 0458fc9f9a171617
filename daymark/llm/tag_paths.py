"""Main text of web pages by tag-path ratios.

A page is read into text blocks, each with its path of element names from the root. Per path
the mean text length and the mean punctuation of its blocks are taken; blocks get their path's
ratios, smoothed over their neighbours in the page, and both are fused into one score. Paths
whose mean score reaches a threshold, set by the spread of the scores, hold content, and so
does a block that reaches it alone. The
least element that holds all of it, or the article or main element around most of it, is the
article, and its other blocks (headings, short paragraphs, lists) belong to the text as well. Elements that are no content by their meaning
are cut before the ratios are taken. Names and forms are evidence only: an element that is or
holds the article, or holds most of the page's text, stays in spite of them.
"""

from __future__ import annotations

import re
from functools import partial
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without content, and those that do not start a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
SAME_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": set(), "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = {"ul", "ol", "dl", "table", "body", "html", "article", "section", "div"}
#: Elements that are never part of an article's text.
CUT = set(
    "script style noscript template head title iframe object svg math canvas audio video map nav footer aside button "
    "select textarea input dialog menu datalist".split()
)
#: Elements that are cut unless they hold most of the text.
FORMS = {"form", "fieldset"}
#: Words in class, id or role that name such parts; in other company they say less.
CUT_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs captcha comment comments "
    "commentlist consent cookie cookies copyright disqus footer gdpr header hidden login masthead menu menus modal nav "
    "navbar navigation newsletter notice notices outbrain overlay pager pagination paywall popup promo promos promotion "
    "recommended related replies respond rss share sharing sidebar sidebars signup skyscraper social sponsor sponsored "
    "subscribe subscription taboola tags toolbar widget widgets complementary contentinfo search alert alertdialog".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
NAME = re.compile(r"[A-Za-z]+")
SPACE = re.compile(r"\s+")


HIDDEN, PLAIN, VAGUE = 3, 2, 1


def _doubt(tag: str, attrs, inside: bool) -> int:
    """How far an element's attributes tell that it is no content; ``inside``: in an article."""
    found = VAGUE if tag in FORMS else 0
    for key, value in attrs:
        if key in ("hidden",) or (key == "aria-hidden" and value == "true"):
            return HIDDEN
        if key == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return HIDDEN
        if key in ("class", "id", "role") and value:
            for name in value.split():
                words = {w.lower() for w in NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))}
                # An article's header holds its headings.
                cut = words & (CUT_NAMES - {"header"} if inside else CUT_NAMES)
                if cut:
                    found = max(found, PLAIN if cut == words else VAGUE)
    return found


class Blocks(HTMLParser):
    """Text blocks of a page: (path, elements, text, letters inside links, doubtful elements).

    ``doubts`` has how doubtful these elements are, ``alike`` their tag and class; ``around`` those that are or hold the
    outermost article or main of a block, by the block's place.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = []  # (tag, step of the path or "", element number, cut or doubtful)
        self.count = 0
        self.doubts, self.alike, self.around = {}, {}, {}
        self.blocks = []
        self.text, self.linked = [], 0

    def _flush(self):
        text = SPACE.sub(" ", "".join(self.text)).strip()
        self.text = []
        linked, self.linked = self.linked, 0
        if text and not any(x[3] == HIDDEN for x in self.open):
            steps = [x for x in self.open if x[1]]
            doubtful = tuple(x[2] for x in self.open if x[3])
            article = next((x[2] for x in steps if x[0] in ("article", "main")), None)
            if article is not None:
                self.around[len(self.blocks)] = tuple(e for e in doubtful if e <= article)
            self.blocks.append(("/".join(x[1] for x in steps), tuple(x[2] for x in steps), text, linked, doubtful))

    def _close(self, tags, scope):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                self._flush()
                del self.open[k:]
                return
            if self.open[k][0] in scope:
                return

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            elif tag not in INLINE:
                self._flush()
            return
        if tag in CLOSES_P:
            self._close({"p"}, SCOPES - {"div"} | {"td", "th", "li", "div", "blockquote"})
        if tag in SAME_CLOSES:
            self._close(SAME_CLOSES[tag], {"ul", "ol", "dl"} if tag in ("li", "dt", "dd") else {"table"})
        if tag in HEADINGS:
            self._close(HEADINGS, SCOPES)
        block = tag not in INLINE
        inside = any(x[0] in ("article", "main") for x in self.open)
        cut = HIDDEN if tag in CUT else 0 if tag in ("html", "body") else _doubt(tag, attrs, inside)
        if tag == "header" and not inside:
            # A page's header is cut; an article's holds its headings.
            cut = HIDDEN
        if block or cut:
            self._flush()
        self.count += 1
        names = "." + ".".join(sorted((dict(attrs).get("class") or "").split())) if block and dict(attrs).get("class") else ""
        if cut in (PLAIN, VAGUE):
            self.doubts[self.count] = cut
            self.alike[self.count] = tag + names if names else self.count
        self.open.append((tag, tag + names if block else "", self.count, cut))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "iframe"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.text.append(" ")
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                if any(x[1] or x[3] for x in self.open[k:]):
                    self._flush()
                del self.open[k:]
                return
            # An inline end tag does not reach over the block that it stands in.
            if tag in INLINE and self.open[k][1]:
                return

    def handle_data(self, data):
        self.text.append(data)
        if any(x[0] == "a" for x in self.open):
            self.linked += len(data.strip())

    def close(self):
        super().close()
        self._flush()


def _few_links(block) -> bool:
    return block[3] <= 0.6 * len(block[2])


def certain(parser: Blocks) -> list:
    """The blocks outside the doubtful elements that are no content.

    A doubtful element stays if it is or holds the elements ``article`` and ``main`` with most
    of the text of those, and no less than what stands outside all doubt. Where no article
    outside all doubt tells it wrong, or in an article, vague names stay if the elements of one
    tag and class hold more than half of the text without plain names, and plain names if they
    hold more than half of all text and ten times what else is left. Vague names stay where
    nothing else is left. Blocks of links do not count.
    """
    blocks, doubts, alike = parser.blocks, parser.doubts, parser.alike
    if not doubts:
        return blocks
    told = [k for k, b in enumerate(blocks) if _few_links(b)]
    size = {k: len(blocks[k][2]) for k in told}
    vague = {k for k in told if all(doubts[e] == VAGUE for e in blocks[k][4])}

    def held(which, elements):
        out = dict.fromkeys([*doubts, *alike.values()], 0)
        for k in which:
            for e in elements(k):
                out[e] += size[k]
        return out

    def total(which):
        return sum(size[k] for k in which)

    articles = [k for k in told if k in parser.around]
    own = held(articles, lambda k: parser.around[k])
    inside = held(articles, lambda k: set(blocks[k][4]) - set(parser.around[k]))
    whole = held(told, lambda k: blocks[k][4])
    group = held(vague, lambda k: {alike[e] for e in blocks[k][4]})
    sure = [k for k in told if not blocks[k][4]]
    certain_article = any(k in parser.around for k in sure)
    stays = {e for e in doubts if own[e] > 0.5 * total(articles) and own[e] >= total(sure)}
    stays |= {
        e for e, doubt in doubts.items()
        if doubt == VAGUE and (inside[e] or not certain_article) and group[alike[e]] > 0.5 * total(vague)
    }
    left = [k for k in told if stays.issuperset(blocks[k][4])]
    certain_article = any(k in parser.around for k in left)
    stays |= {
        e for e, doubt in doubts.items()
        if doubt == PLAIN and (inside[e] or not certain_article) and whole[e] > 0.5 * total(told) and whole[e] > 10 * total(left)
    }
    if not any(stays.issuperset(blocks[k][4]) for k in told):
        stays |= {e for e, doubt in doubts.items() if doubt == VAGUE}
    return [b for b in blocks if stays.issuperset(b[4])]


def _smooth(values: np.ndarray, radius: int = 2) -> np.ndarray:
    """Gaussian means over neighbours; the ends use the neighbours that exist."""
    weights = np.exp(-(np.arange(-radius, radius + 1) ** 2) / 2)
    top = np.convolve(values, weights)[radius : radius + len(values)]
    return top / np.convolve(np.ones(len(values)), weights)[radius : radius + len(values)]


def _score(text_ratio, mark_ratio):
    return np.log1p(max(text_ratio, 0)) * (1 + np.log1p(mark_ratio))


def path_scores(blocks) -> dict[str, float]:
    """The fused, smoothed score of each path, the mean over its blocks."""
    paths = [b[0] for b in blocks]
    which = {p: i for i, p in enumerate(dict.fromkeys(paths))}
    index = np.array([which[p] for p in paths])
    count = np.bincount(index)
    own = np.array([max(len(b[2]) - b[3], 0) for b in blocks], float)
    marks = np.array([len(PUNCTUATION.findall(b[2])) for b in blocks], float)
    text_ratio = np.bincount(index, own) / count
    mark_ratio = np.bincount(index, marks) / count
    fused = _smooth(np.log1p(text_ratio)[index]) * (1 + _smooth(np.log1p(mark_ratio)[index]))
    means = np.bincount(index, fused) / count
    return {p: float(means[i]) for p, i in which.items()}


def article_of(chosen, blocks) -> int | None:
    """The element that holds the text of the ``chosen`` content blocks, or None for the whole page.

    From the deepest element with most of the chosen text it is climbed to the outermost main
    around it, or article if no other article holds chosen blocks; without these to the least
    element that holds all chosen blocks, and on while a section, or an element with the same
    classes, stands beside it.
    """
    weight: dict = {}
    for b in chosen:
        for depth, element in enumerate(b[1][:-1] or b[1]):
            held = weight.setdefault(element, [depth, 0, b])
            held[1] += len(b[2])
    total = sum(len(b[2]) for b in chosen)
    deepest = max((e for e, (_, w, _) in weight.items() if w > 0.6 * total), key=lambda e: weight[e][0], default=None)
    if deepest is None:
        return None
    depth, _, holder = weight[deepest]
    line, steps = holder[1], holder[0].split("/")
    tags = [x.split(".")[0] for x in steps[: depth + 1]]
    if "main" in tags:
        return line[tags.index("main")]
    at = depth
    if "article" in tags:
        at = tags.index("article")
        others = [b for b in chosen if line[at] not in b[1] and "article" in (x.split(".")[0] for x in b[0].split("/"))]
        if not others:
            return line[at]
        chosen = [b for b in chosen if line[at] in b[1]] + others
    while at and not all(line[at] in b[1] for b in chosen):
        at -= 1
    while at and (tags[at] == "section" or "." in steps[at]):
        beside = (b for b in blocks if len(b[1]) > at and b[1][at - 1] == line[at - 1] and b[1][at] != line[at])
        if not any(b[0].split("/")[at] == steps[at] for b in beside):
            break
        at -= 1
    return line[at] if all(line[at] in b[1] for b in chosen) else None


def main_blocks(html: str, spread: float = 1.0) -> list[str]:
    """The texts of a page's content blocks in page order."""
    parser = Blocks()
    parser.feed(html)
    parser.close()
    every = certain(parser)
    blocks = [b for b in every if _few_links(b)]
    if not blocks:
        return []
    scores = path_scores(blocks)
    each = np.array([scores[b[0]] for b in blocks])
    limit = each.max() - spread * max(each.std(), 0.25 * each.max())
    # A long block is content by its own ratios, too, whatever short ones smooth its path's.
    chosen = [b for b, s in zip(blocks, each, strict=True) if max(s, _score(len(b[2]) - b[3], len(PUNCTUATION.findall(b[2])))) >= limit]
    article = article_of(chosen, blocks)
    held = [b for b in every if article is None or article in b[1]]
    if article is not None and held[0][0].split("/")[held[0][1].index(article)].split(".")[0] not in ("html", "body"):
        return [b[2] for b in held]
    # On a page without an element for the article, blocks of links belong to it that stand
    # between its blocks or right beside one.
    known = {id(b) for b in chosen}
    places = [k for k, b in enumerate(held) if id(b) in known]
    parents = {b[1][:-1] for b in chosen}
    return [b[2] for k, b in enumerate(held) if _few_links(b) or places[0] < k < places[-1] or b[1][:-1] in parents]


def extract(html: str | None) -> str:
    """The main text: blocks joined by an empty line; empty for a page without any."""
    return "\n\n".join(main_blocks(html or ""))


def _extracted(batches):
    for batch in batches:
        texts = [extract(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined in page order by two line feeds. Null and empty pages, and pages without content,
    give an empty text. Markup may be broken: open elements end with the page, end tags that
    fit nothing are passed over. Rows are independent, so repeated rows and null or equal ids
    are returned as they come. Equal scores are equal paths or are both above or below the
    threshold. Pages are read whole, at any length. An empty table gives an empty result. Other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(partial(_extracted), "page_id long, url string, text string, n_chars long")
