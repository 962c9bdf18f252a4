"""HTML extraction: flat text blocks, described by themselves and their neighbours, classified by a decision tree."""

from __future__ import annotations

import html as entities
import random
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.common import text_of, without

FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "heading",
    "in_article", "in_page_part", "in_comments",
)

#: Elements whose content is never text of the page.
SILENT = frozenset(
    "script style noscript template svg math iframe object canvas video audio title head textarea select button".split())
#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li legend main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
    .split())
NESTED = BLOCKS - {"p", "hr", "html", "body", "h1", "h2", "h3", "h4", "h5", "h6"}
SECTIONS = frozenset("article aside main nav header footer form section body".split())
#: Elements that a new article or main element ends, since a page part never holds the article.
ENDED_BY_ARTICLE = frozenset(["nav", "header", "footer", "form", "ul", "ol", "li"])

#: Parts of class names, ids and roles that tell what an element is for.
SIGNS = {
    "article": "article post entry story content main body text prose",
    "page_part": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs topbar banner logo "
    "footer colophon copyright contentinfo sidebar aside complementary related recommended recommendations trending popular "
    "share sharing social newsletter subscribe subscription widget promo promotion teaser ad ads advert advertisement "
    "advertising adsense sponsor sponsored cookie cookies consent gdpr notice notification alert popup modal overlay dialog "
    "disclaimer paywall search login signup signin form toolbar",
    "heading_part": "header masthead",
    "comments": "comment comments reply replies respond discussion disqus reviews feedback commentlist",
}
SIGN_OF = {word: kind for kind, words in SIGNS.items() for word in words.split()}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>(?:[^'\">]|\"[^\"]*\"|'[^']*')*)|[^>]*)>", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)


def purpose(tag: str, attributes: str) -> str:
    """What an element is for: 'article', 'page_part', 'comments', 'heading_part' or ''.

    A name such as ``has-sidebar`` describes what is inside and does not count.
    """
    kinds = set()
    if attributes:
        if HIDDEN.search(attributes):
            return "page_part"
        if tag not in ("body", "html"):
            for m in NAMES.finditer(attributes):
                for name in (m[1] or m[2] or m[3] or "").split():
                    parts = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())
                    if parts and parts[0] not in ("has", "with", "no", "without"):
                        kinds |= {SIGN_OF[p] for p in parts if p in SIGN_OF}
    if "comments" in kinds:
        return "comments"
    if tag in ("nav", "footer", "aside", "form", "dialog", "menu"):
        return "page_part"
    if tag == "header":
        return "heading_part"
    if tag in ("article", "main"):
        return "page_part" if kinds == {"page_part"} else "article"
    if "heading_part" in kinds:
        return "" if "article" in kinds else "heading_part"
    return "page_part" if "page_part" in kinds else "article" if kinds else ""


def blocks(page: str) -> list[tuple[str, list[float]]]:
    """The page's text blocks in order, each with its ``FEATURES``."""
    found: list[list] = []  # text, words, linked words, heading, article, page part, comments
    text: list[str] = []
    linked, links, heading = [], 0, 0
    stack: list[tuple[str, str]] = []
    place = {"article": 0, "page_part": 0, "comments": 0, "heading_part": 0, "": 0}

    def end() -> None:
        nonlocal heading
        if text:
            words = "".join(text).split()
            if words:
                in_links = len("".join(linked).split())
                part = place["page_part"] > 0 or (place["heading_part"] > 0 and not place["article"])
                found.append([
                    " ".join(words), len(words), min(in_links, len(words)), heading, place["article"] > 0, part,
                    place["comments"] > 0])
            text.clear()
            linked.clear()

    def leave(depth: int) -> None:
        while len(stack) > depth:
            place[stack.pop()[1]] -= 1

    at, n = 0, len(page)
    while at < n:
        token = TOKEN.search(page, at)
        said = page[at : token.start()] if token else page[at:]
        if said:
            said = entities.unescape(said) if "&" in said else said
            text.append(said)
            if links:
                linked.append(said)
        if not token:
            break
        at, tag = token.end(), (token[2] or "").lower()
        if not tag:
            continue
        closing, attributes = token[1], token[3]
        if tag in SILENT and tag != "head":
            text.append(" ")
            if not closing and not attributes.endswith("/"):
                close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = close.end() if close else (n if tag in ("script", "style") else at)
        elif tag == "a":
            links = 0 if closing else 1
            if not closing:
                linked.append(" ")
        elif tag == "br":
            text.append(" ")
            linked.append(" ")
        elif tag in BLOCKS:
            end()
            links = 0
            if tag[0] == "h" and tag[1:].isdigit():
                heading = 0 if closing else 1
            elif tag in NESTED:
                heading = 0
                if not closing:
                    if tag in ("article", "main"):
                        depth = len(stack)
                        while depth and stack[depth - 1][0] in ENDED_BY_ARTICLE and stack[depth - 1][1] != "comments":
                            depth -= 1
                        leave(depth)
                    if not attributes.endswith("/"):
                        stack.append((tag, purpose(tag, attributes)))
                        place[stack[-1][1]] += 1
                else:
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == tag:
                            leave(i)
                            break
                        if stack[i][0] in SECTIONS and tag not in SECTIONS:
                            break
            else:
                heading = 0
    end()
    density = [b[2] / b[1] for b in found]
    none = (0.0, 0.0)
    around = [none, *((float(b[1]), d) for b, d in zip(found, density, strict=True)), none]
    return [
        (b[0], [*around[i + 1], *around[i], *around[i + 2], float(b[3]), float(b[4]), float(b[5]), float(b[6])])
        for i, b in enumerate(found)
    ]


MARK = ""


def labelled_pages(n: int = 300, seed: int = 7) -> list[str]:
    """Pages made from a rule, for training; paragraphs of the article begin with ``MARK``.

    They vary in whether and how the article and the page's other parts are marked up, and in how long texts are: where
    parts are marked up, those that are not the article are as long as its paragraphs often enough, and a menu may be one
    word before a long paragraph, so length alone does not settle it.
    """
    rng = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join("w" * rng.randint(2, 9) for _ in range(rng.randint(low, high)))

    def paragraphs(mark: str, low: int = 1, high: int = 90) -> str:
        out = [f"<h1>{mark}{words(3, 10)}</h1>"]
        for i in range(rng.randint(2, 9)):
            if i and rng.random() < 0.15:
                out.append(f"<h2>{mark}{words(1, 6)}</h2>")
            short = rng.random() < 0.25
            link = f' <a href="/x">{words(1, 4)}</a> {words(3, 9)}' if rng.random() < 0.2 else ""
            out.append(f"<p>{mark}{words(low, 4) if short else words(12, high)}{link}</p>")
        return "".join(out)

    def aside(low: int, high: int) -> str:
        """Words of a marked part beside the article, in one case of three as many as a paragraph has."""
        return words(30, 120) if rng.random() < 0.35 else words(low, high)

    def title(level: int) -> str:
        return f"<h{level}>{words(1, 5)}</h{level}>" if rng.random() < 0.5 else ""

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{words(1, 4)}</a></li>' for i in range(k)) + "</ul>"

    pages = []
    for _ in range(n):
        named = rng.random() < 0.75
        part = (lambda tag, name, inner: f"<{tag}>{inner}</{tag}>" if rng.random() < 0.5 else f'<div class="{name}">{inner}</div>'
                ) if named else (lambda tag, name, inner: f"<div>{inner}</div>")
        article = rng.choice([
            lambda x: f"<article>{x}</article>", lambda x: f"<main>{x}</main>", lambda x: f"<main><article>{x}</article></main>",
            lambda x: f'<div class="post-content">{x}</div>',
        ]) if named else (lambda x: f"<div>{x}</div>")
        body = paragraphs(MARK)
        if named and rng.random() < 0.4:
            body += part("aside", "related", title(3) + links(3) + f"<p>{aside(5, 40)}</p>")
        if named and rng.random() < 0.2:
            body += '<div class="comments">' + "".join(f"<p>{words(3, 120)}</p>" for _ in range(3)) + "</div>"
        pieces = [
            part("header", "site-header", title(1) + f"<p>{aside(1, 8) if named else words(1, 8)}</p>"),
            part("nav", "menu", links(rng.randint(1, 9))) if rng.random() < 0.9 or not named else part("nav", "menu", words(1, 3)),
            f'<div class="ad">{aside(4, 30)}</div>' if named else f"<div><a href='/ad'>{words(4, 20)}</a></div>", article(body),
        ]
        if named and rng.random() < 0.6:
            pieces.append('<section class="comments">' + title(2) + "".join(
                f"<p>{words(3, 120)}</p>" for _ in range(rng.randint(1, 5))) + "</section>")
        if named and rng.random() < 0.4:
            pieces.append(f'<form>{title(3)}<p>{aside(2, 12)}</p></form><div class="cookie-notice"><p>{aside(8, 40)}</p></div>')
        if rng.random() < 0.5:
            pieces.append(part("aside", "sidebar", title(3) + links(4) + (f"<p>{aside(2, 25)}</p>" if named else "")))
        pieces.append(part("footer", "footer", title(4) + links(3) + f"<p>{aside(2, 10) if named else words(2, 10)}</p>"))
        pages.append("<html><body>" + "".join(pieces) + "</body></html>")
    return pages


def labelled(spark: SparkSession) -> DataFrame:
    """The training table: ``FEATURES`` of the blocks of ``labelled_pages``, and ``label``."""
    rows = []
    for page in labelled_pages():
        for text, features in blocks(page):
            rows.append((*features, 1.0 if MARK in text else 0.0))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in (*FEATURES, "label")))


def train(table: DataFrame, depth: int = 6, least: int = 3):
    """A decision tree over ``FEATURES`` as nested tuples (feature, threshold, at most, above); a leaf is a bool."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=least, maxBins=64, seed=1).fit(rows)

    def node(x):
        if x.subtreeDepth() == 0:
            return x.prediction() > 0.5
        return x.split().featureIndex(), x.split().threshold(), node(x.leftChild()), node(x.rightChild())

    return node(model._java_obj.rootNode())


def is_main(tree, features: list[float]) -> bool:
    while not isinstance(tree, bool):
        feature, threshold, low, high = tree
        tree = low if features[feature] <= threshold else high
    return tree


def main_text(page: str, tree) -> str:
    return "\n\n".join(text for text, features in blocks(page) if is_main(tree, features))


def extract(pages: DataFrame, html: str = "html", training: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text of each page, and ``n_chars``, its code points.

    A page is cut into blocks at block elements; a block has its words, its link density, both of the block before and
    after, whether it is a heading, and whether it lies in an article, in another part of the page or in comments, as
    told by elements, class names, ids and roles. A decision tree, trained on ``training`` (default: ``labelled``, a
    few thousand blocks made by rule; the tree has at most 64 leaves), keeps or drops it. Kept blocks are joined by an
    empty line, with character references decoded and white space as one blank.

    NULL or empty html, or html without a kept block, gives the empty text. Each row is extracted on its own, so
    repeated rows give repeated results. Input columns called ``text`` or ``n_chars`` are replaced (``text`` may be
    the html column itself). An empty table gives an empty table.
    """
    tree = train(labelled(pages.sparkSession) if training is None else training)

    @F.arrow_udf("string")
    def extracted(texts: pa.Array) -> pa.Array:
        return pa.array([main_text(t, tree) for t in texts.to_pylist()], pa.string())

    made = pages.withColumn("__main", extracted(text_of(pages, html)))
    rest = without(pages, "text", "n_chars").columns
    return made.select(*[F.col(f"`{c}`") for c in rest], F.col("__main").alias("text"),
                       F.char_length("__main").cast("bigint").alias("n_chars"))
