"""Main text of web pages by tag-path ratios.

A page is read once into blocks of text, each with the tag path from the root to it. Blocks inside
menus, headers, footers, asides, forms, notices, adverts, comments and the like are out from the start.
For each tag path the text length and the punctuation marks of its blocks are summed and divided by
the number of blocks; text in links does not count. The two ratios are fused into one score, the score
is smoothed over the paths next to it in the page and over paths below the same parent, and paths
under a share of the best score are dropped. Where a page marks its article, that part alone is judged,
and only paths that are mostly links can fall, so short paragraphs and headings stay.

Text nodes get their character references decoded; white space inside a block becomes one space; blocks
are joined by line feeds in page order. Each page is independent and read whole.

Defined cases: null, empty or text-free pages give an empty text. Tags that are never closed, closed in
the wrong order or cut off, and scripts or comments that never end, are read as browsers do, roughly.
Repeated rows are extracted as often as they occur. Extra columns play no part.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmetrics.llm.common import col, ship_code, table

# HTML's element kinds, and words in class and id that mark what is not the article.
RAW = {"script", "style", "noscript", "template", "iframe", "object", "svg", "math", "textarea", "select", "title", "head", "button"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main",
    "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"hr"}
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
SCOPES = {"ul", "ol", "dl", "table"}
OUT_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog"}
ARTICLE_TAGS = {"article", "main"}
OUT_WORDS = {
    "ad", "ads", "advert", "advertisement", "adverts", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "pagination", "popup", "promo", "promotion", "related", "replies", "respond", "share", "sharing", "sidebar", "social", "sponsor",
    "sponsored", "subscribe", "subscription", "toolbar", "widget",
}
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
MARKS = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[a-z0-9]+")
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")
#: Paths below this share of the best smoothed score are dropped.
LEAST_SHARE = 0.2
#: Paths with more of their text in links are dropped.
MOST_LINKED = 0.5


def blocks_of(page: str) -> list[tuple[str, str, str, int, bool]]:
    """(path, parent path, text, characters in links, inside an article) of the blocks, in page order."""
    out: list[tuple[str, str, str, int, bool]] = []
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # tag, path, out, article
    words: list[str] = []
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        if words:
            text = " ".join("".join(words).split())
            if text:
                _, path, _, article = stack[-1]
                out.append((path, path.rpartition("/")[0], text, min(linked, len(text)), article))
            words.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal in_link
        flush()
        in_link = 0
        del stack[depth:]

    at, n = 0, len(page)
    while at < n:
        token = TOKEN.search(page, at)
        to = token.start() if token else n
        if to > at and not stack[-1][2]:
            text = html.unescape(page[at:to])
            words.append(text)
            if in_link:
                linked += len(text.strip())
        if not token:
            break
        at = token.end()
        tag = (token[2] or token[5] or "").lower()
        if not tag:
            continue
        closing = bool(token[1] or token[4])
        if tag in RAW:
            if not closing:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style", "title", "textarea"):
                    at = n
            continue
        if tag not in BLOCKS:
            if tag == "br":
                words.append(" ")
            elif tag == "a":
                in_link = 0 if closing else 1
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if depth:
                pop_to(depth)
            continue
        flush()
        closes = CLOSES.get(tag, {"p"})
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in SCOPES or stack[i][0] not in BLOCKS:
                break
            if stack[i][0] in closes:
                pop_to(i)
                if tag not in CLOSES:
                    break
            elif stack[i][0] not in ("p", "td", "th", "li", "dt", "dd"):
                break
        if tag in VOID:
            continue
        _, path, outside, article = stack[-1]
        marks = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in MARKS.finditer(token[3] or token[6] or "")}
        names = WORD.findall(f"{marks.get('class', '')} {marks.get('id', '')}")
        if tag not in ("html", "body"):
            is_article = tag in ARTICLE_TAGS or marks.get("role") == "main" or marks.get("itemprop") == "articlebody"
            if not is_article and (tag in OUT_TAGS or (tag == "header" and not article) or not OUT_WORDS.isdisjoint(names)):
                outside = True
            article = article or is_article
        label = tag + ("." + names[0] if names else "")
        stack.append((tag, f"{path}/{label}", outside, article))
    flush()
    return out


def content_paths(blocks: list[tuple[str, str, str, int, bool]]) -> set[str]:
    """Paths whose smoothed, fused ratio of text and punctuation makes them content."""
    sums: dict[str, list[float]] = {}
    for path, _, text, linked, _ in blocks:
        entry = sums.setdefault(path, [0, 0, 0, 0])
        entry[0] += 1
        entry[1] += len(text) - linked
        entry[2] += len(PUNCTUATION.findall(text))
        entry[3] += len(text)
    order = list(sums)
    fused = [c / n * (0.5 + q / n) for n, c, q, _ in (sums[p] for p in order)]
    families: dict[str, list[float]] = {}
    for path, score in zip(order, fused, strict=True):
        families.setdefault(path.rpartition("/")[0], []).append(score)
    smooth = {}
    for i, path in enumerate(order):
        near = fused[max(0, i - 1) : i + 2]
        family = families[path.rpartition("/")[0]]
        smooth[path] = max(0.5 * fused[i] + 0.5 * sum(near) / len(near), max(family) * 0.5)
    best = max(smooth.values(), default=0)
    return {p for p in order if smooth[p] >= LEAST_SHARE * best and sums[p][1] >= (1 - MOST_LINKED) * sums[p][3]}


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    marked = [b for b in blocks if b[4]]
    if marked:
        sums: dict[str, list[int]] = {}
        for path, _, text, linked, _ in marked:
            entry = sums.setdefault(path, [0, 0])
            entry[0] += linked
            entry[1] += len(text)
        kept = {p for p, (linked, size) in sums.items() if linked <= MOST_LINKED * size}
        blocks = marked
        kept = kept & content_paths(marked) or kept
        families = {p.rpartition("/")[0] for p in kept}
        # Inside a marked article only links fall: what stands beside content is content.
        kept |= {p for p, (linked, size) in sums.items() if linked <= MOST_LINKED * size and (p.rpartition("/")[0] in families or p in families)}
    else:
        kept = content_paths(blocks)
    return "\n".join(text for path, _, text, _, _ in blocks if path in kept)


def extract(pages: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns of each page with its text and n_chars."""
    ship_code(pages.sparkSession)
    frame = pages.select(F.coalesce(col(pages, "html").cast("string"), F.lit("")).alias("page"), *(col(pages, c) for c in carried))
    plain = frame.toDF("page", *(f"c{i}" for i in range(len(carried))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*batch.schema.names[1:], "text", "n_chars"])

    kept = ", ".join(f"c{i} {kind}" for i, (_, kind) in enumerate(frame.drop("page").dtypes))
    return plain.mapInArrow(run, f"{kept}, text string, n_chars long").toDF(*carried, "text", "n_chars")


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
