"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its elements' paths and its text blocks in their place; containers of one name under
one parent are told apart by their order. Tokens of a site with the same occurrence vector (so many times
in each page) form a class; classes that occur in enough of the site's pages and hold an element path are
its template, nested by their paths. Text in a class with element paths is template text; everything else
fills slots. The site's content slot is the deepest template element that holds most of the running text;
an article element among them ends the search. The blocks in the slot, save template text and marked
regions, are the main text. Pages of sites too small for that are judged alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.tables import prepared
from marquee.session import materialise

#: A class counts from so many pages on, and from this share of its site's pages.
MIN_PAGES, MIN_SHARE = 8, 0.5
#: The content slot holds this share of a site's running text.
CONTENT_SHARE = 0.6
#: A page of whose slot so much of the text stands on most pages is a near copy, not mostly template.
COPY_SHARE = 0.5
#: Bytes of slots and template text of all sites up to which they are broadcast.
SMALL_BYTES = 32 << 20

#: Elements of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary "
    "table tbody td tfoot th thead tr ul br".split()
)
CLOSES_P = BLOCK - frozenset("body br dd dt head html legend li option select summary tbody td tfoot th thead tr".split())
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
FENCE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
TABLE = frozenset({"table"})
#: Elements, roles and words of class or id names that mark what is not the article.
NOT_TEXT = frozenset("head script style noscript template iframe object svg canvas button select textarea dialog menu nav footer aside form search".split())
NOT_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar status toolbar".split())
NOT_ARTICLE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising announcement aside banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies copyright crumbs disclaimer disqus foot footer gdpr legal login menu modal nav navbar "
    "navigation newsletter notice notices alert overlay pager pagination popup promo promoted promotion recommendations recommended "
    "related replies reply respond responses search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toast toolbar widget widgets".split()
)
#: Words that mark a page's header, outside its article and not together with a word for an article.
HEADER_WORDS = frozenset("header masthead topbar".split())
ARTICLE_WORDS = frozenset("article content entry main post story text".split())
#: A word after one of these says what a page has, not what the element is.
HAVING_WORDS = frozenset("has no with without".split())
#: Elements whose names say nothing about their content being the article or not.
WHOLE = frozenset("html body article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE_ROLES = frozenset({"main", "article"})
ARTICLES = ("article", "main")
#: Stands before the number of a container; class names, split at blanks, hold none.
ORDINAL = " "
NUMBERED = re.compile(rf"{ORDINAL}\d+$")
#: Elements that can be a content slot; the others are single blocks or parts of one.
CONTAINERS = (*ARTICLES, "body", "center", "div", "section", "td")

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)""", re.I)
SPACE = re.compile(r"\s+")
NUMBER = re.compile(r"\d{2,}")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SITE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"


class Node:
    """An open element: its path, and whether the path lies in a region that is not the article."""

    __slots__ = ("tag", "path", "out", "main", "link", "block", "held")

    def __init__(self, tag: str, path: str, out: bool, main: bool, link: bool, block: bool):
        self.tag, self.path, self.out, self.main, self.link, self.block = tag, path, out, main, link, block
        self.held: dict[str, int] = {}

    def named(self, name: str, tag: str) -> str:
        """The path of a child; containers of one name are numbered from the second on."""
        if tag not in CONTAINERS:
            return f"{self.path}/{name}"
        self.held[name] = self.held.get(name, 0) + 1
        return f"{self.path}/{name}" if self.held[name] == 1 else f"{self.path}/{name}{ORDINAL}{self.held[name]}"


def marked(label: str, main: bool) -> bool:
    """Whether class and id names say that an element is no part of the article."""
    parts = [p.lower() for p in NAME_PART.findall(label)]
    own = [p for k, p in enumerate(parts) if not (k and parts[k - 1] in HAVING_WORDS)]
    if any(p in NOT_ARTICLE_WORDS for p in own):
        return True
    return not main and any(p in HEADER_WORDS for p in own) and not any(p in ARTICLE_WORDS for p in own)


def opened(tag: str, attributes: str, above: Node) -> Node:
    names = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    role = names.get("role", "").lower().strip()
    label = f"{names.get('class', '')} {names.get('id', '')}"
    main = above.main or tag in ARTICLES or role in ARTICLE_ROLES
    out = above.out or tag in NOT_TEXT or role in NOT_ARTICLE_ROLES or (tag == "header" and not main)
    if not out and attributes:
        out = HIDDEN.search(attributes) is not None or (tag not in WHOLE and marked(label, main))
    if tag not in BLOCK:
        return Node(tag, above.path, out, main, above.link or tag == "a", False)
    mark = "." + ".".join(sorted(NUMBER.sub("0", label.lower()).split())) if label.strip() else ""
    return Node(tag, above.named(f"{tag}{mark}", tag), out, main, above.link, True)


def parsed(html: str) -> tuple[list[str], list[tuple[str, str, bool, bool, int]]]:
    """Paths of all block elements, and all text blocks (path, text, out, main, characters in links)."""
    stack = [Node("", "", False, False, False, True)]
    paths: list[str] = []
    blocks: list[tuple[str, str, bool, bool, int]] = []
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                node = next(n for n in reversed(stack) if n.block)
                blocks.append((node.path, text, node.out, node.main, linked))
            parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        node = stack[-1]
        if node.out and not next(n for n in reversed(stack) if n.block).out:
            return  # an inline element that is marked as no part of the article
        parts.append(text)
        if node.link:
            linked += len(text)

    def close_to(index: int) -> None:
        if any(n.block for n in stack[index:]):
            flush()
        del stack[index:]

    at = 0
    while True:
        found = MARKUP.search(html, at)
        if not found:
            say(html[at:])
            break
        if found.start() > at:
            say(html[at : found.start()])
        at = found.end()
        tag = (found.group(2) or found.group(5) or "").lower()
        if not tag:
            continue
        if found.group(1) or found.group(4):
            for index in range(len(stack) - 1, 0, -1):
                if stack[index].tag == tag:
                    close_to(index)
                    break
                if tag not in BLOCK and stack[index].block:
                    break
            continue
        attributes = found.group(3) or found.group(6) or ""
        if tag in CLOSES_P:
            for index in range(len(stack) - 1, 0, -1):
                if stack[index].tag == "p":
                    close_to(index)
                    break
                if stack[index].block:
                    break
        if tag in SIBLINGS:
            fence = FENCE.get(tag, TABLE)
            index = len(stack) - 1
            last = 0
            while index > 0 and stack[index].tag not in fence:
                if stack[index].tag in SIBLINGS[tag]:
                    last = index
                index -= 1
            if last:
                close_to(last)
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        node = opened(tag, attributes, stack[-1])
        if node.block:
            paths.append(node.path)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
            at = end.start() if end else len(html)
            if tag == "xmp":
                stack.append(node)
                say(html[found.end() : at])
                continue
        stack.append(node)
    flush()
    return paths, blocks


def ancestors(path: str) -> list[str]:
    """The containers among the paths from the root to ``path``."""
    parts = path.split("/")[1:]
    return ["/" + "/".join(parts[: k + 1]) for k in range(len(parts)) if _tag(parts[k]) in CONTAINERS]


def text_token(path: str, text: str) -> str:
    """A text in its place, by 128 bits of a hash: texts of any length are tokens of one size."""
    return blake2b(f"{path}\t{text}".encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def best_container(chars: dict[str, int], total: int, main: set[str]) -> str:
    """The content slot out of containers and the running text they hold: the article element with most
    text; else the deepest element with CONTENT_SHARE of all."""
    articles = [p for p in chars if p in main]
    if articles:
        return max(articles, key=lambda p: (chars[p], -p.count("/"), p))
    large = [p for p in chars if chars[p] >= CONTENT_SHARE * total]
    return max(large, key=lambda p: (p.count("/"), chars[p], p), default="")


def _tag(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".")[0].split(ORDINAL)[0]


def _is_main(path: str) -> bool:
    return _tag(path) in ARTICLES


def page_containers(blocks) -> tuple[dict[str, int], int]:
    """Characters of running text (not in links, not in marked regions) under every path of a page."""
    held: dict[str, int] = {}
    total = 0
    for path, text, out, _, linked in blocks:
        if not out:
            size = max(0, len(text) - linked)
            total += size
            for above in ancestors(path):
                held[above] = held.get(above, 0) + size
    return held, total


def main_text(blocks, root: str, template: frozenset[str] | set[str] = frozenset()) -> str:
    """Blocks of the content slot in page order, one to a line.

    Blocks of an article or main element stay, however many pages share them, and so do all blocks where
    COPY_SHARE of the slot would go: near copies of an article share most of it.
    """
    above = root.rsplit("/", 1)[0]
    title = "" if _is_main(root) or _tag(above) in WHOLE else above  # headings beside the slot belong to it

    def held(path: str) -> bool:
        return path == root or path.startswith(root + "/") or bool(title) and _tag(path) in HEADINGS and path.rsplit("/", 1)[0] == title

    inside = [b for b in blocks if not b[2] and held(b[0])]
    own = [b for b in inside if b[3] or text_token(b[0], b[1]) not in template] if template else inside
    copied = sum(len(b[1]) for b in own) <= (1 - COPY_SHARE) * sum(len(b[1]) for b in inside)
    return "\n".join(b[1] for b in (inside if copied else own))


def slot_of(root: str, usual: int, held: dict[str, int]) -> str | None:
    """A site's slot on one page: the template's own place, or, where the page has more or fewer containers
    of the slot's name beside it than ``usual``, the one that holds most running text; None without any."""
    family = NUMBERED.sub("", root)
    alike = [p for p in held if NUMBERED.sub("", p) == family]
    if root in held and len(alike) == usual:
        return root
    return max(alike, key=lambda p: (held[p], p == root, p), default=None)


def page_root(blocks) -> str:
    chars, total = page_containers(blocks)
    return best_container(chars, total, {p for p in chars if _is_main(p)})


def site(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), SITE, 1))


TOKENS = "site string, page bigint, token string, path string, n bigint, chars bigint, is_path boolean"


def _tokens(batches) -> Iterator[pa.RecordBatch]:
    """For each page its distinct tokens, how often each occurs, and the running text under each path."""
    for batch in batches:
        sites, numbers, pages = (batch.column(k).to_pylist() for k in range(3))
        for first in range(0, len(pages), 64):
            rows: list[tuple] = []
            for name, number, html in zip(sites[first : first + 64], numbers[first : first + 64], pages[first : first + 64]):
                paths, blocks = parsed(html or "")
                chars, _ = page_containers(blocks)
                counts: dict[str, int] = {}
                for path in paths:
                    counts[path] = counts.get(path, 0) + 1
                rows += ((name, number, p, p, n, chars.get(p, 0), True) for p, n in counts.items())
                texts: dict[tuple[str, str], int] = {}
                for path, text, out, _, _ in blocks:
                    if not out:
                        texts[path, text] = texts.get((path, text), 0) + 1
                rows += ((name, number, text_token(p, t), p, n, 0, False) for (p, t), n in texts.items())
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["site", "page", "token", "path", "n", "chars", "is_path"])


def classes(pages: DataFrame) -> DataFrame:
    """Tokens of the valid classes: site, vector (the class), token, path, is_path, n_pages, chars.

    The occurrence vector of a token is known by the exclusive or of the hashes of its (page, count)
    pairs, which Spark merges before and after its shuffle.
    """
    numbered = pages.select(site(F.col("url")).alias("site"), F.xxhash64("url", "html").alias("page"), F.coalesce("html", F.lit("")).alias("html"))
    tokens = numbered.where(F.col("site") != "").mapInArrow(_tokens, TOKENS)
    found = tokens.groupBy("site", "token", "path", "is_path").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count(F.lit(1)).alias("n_pages"), F.sum("chars").alias("chars")
    )
    found = materialise(found.where(F.col("n_pages") >= MIN_PAGES), "page-tokens")  # used more than once; pages are parsed once
    sizes = numbered.groupBy("site").agg(F.count(F.lit(1)).alias("site_pages"))
    found = found.join(sizes, "site").where(F.col("n_pages") >= MIN_SHARE * F.col("site_pages"))
    held = found.where("is_path").select("site", "vector", "n_pages").distinct()
    return found.join(held, ["site", "vector", "n_pages"], "left_semi")


def templates(pages: DataFrame) -> DataFrame:
    """One row for each site with a template: its content slot and its template text inside that slot."""
    found = classes(pages)
    containers = found.where("is_path").groupBy("site").agg(
        F.collect_list(F.struct("path", "chars")).alias("containers")  # element paths on most pages of a site
    )
    top = F.aggregate("containers", F.lit(0).cast("bigint"), lambda most, x: F.greatest(most, x["chars"]))
    last = lambda x: F.element_at(F.split(x["path"], "/"), -1)
    articles = F.filter("containers", lambda x: last(x).rlike(rf"^({'|'.join(ARTICLES)})([.{ORDINAL}]|$)"))
    deep = F.filter("containers", lambda x: (x["chars"] >= CONTENT_SHARE * F.col("_top")) & last(x).rlike(rf"^({'|'.join(CONTAINERS)})([.{ORDINAL}]|$)"))
    best_article = F.array_max(F.transform(articles, lambda x: F.struct(x["chars"].alias("a"), (-F.size(F.split(x["path"], "/"))).alias("b"), x["path"].alias("path"))))
    best_deep = F.array_max(F.transform(deep, lambda x: F.struct(F.size(F.split(x["path"], "/")).alias("a"), x["chars"].alias("b"), x["path"].alias("path"))))
    roots = containers.withColumn("_top", top).select("site", "containers", F.coalesce(best_article["path"], best_deep["path"]).alias("root"))
    family = lambda path: F.regexp_replace(path, NUMBERED.pattern, "")
    alike = F.filter("containers", lambda x: family(x["path"]) == family(F.col("root")))
    roots = roots.select("site", "root", F.size(alike).alias("usual"))
    fixed = found.where(~F.col("is_path")).join(roots, "site").where(
        (F.col("path") == F.col("root")) | F.col("path").startswith(F.concat("root", F.lit("/")))
    )
    texts = fixed.groupBy("site").agg(F.collect_list("token").alias("fixed"))  # text blocks that most pages share
    return roots.join(texts, "site", "left")


def _extract(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        html, roots, sizes, fixed = (batch.column(k).to_pylist() for k in range(2, 6))
        out = []
        for page, root, usual, tokens in zip(html, roots, sizes, fixed):
            _, blocks = parsed(page or "")
            here = slot_of(root, usual, page_containers(blocks)[0]) if root is not None else None
            if here is None:
                here, tokens = page_root(blocks), None
            root = here
            out.append(main_text(blocks, root, frozenset(tokens or ())))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url and main text of every row of ``pages``.

    A null html is empty and gives an empty text, and so does a page without running text. Pages whose
    url is null or names no site, and pages of small sites, are judged alone. Repeated rows count as one
    page of their site's vectors and get a row each; of containers that hold equally much the first by
    name is the slot. Pages of any length are read whole; an empty table has no result. Other columns are
    not read.
    """
    prepared(pages.sparkSession)
    found = materialise(templates(pages), "templates")
    size = F.octet_length("root") + 48 * F.coalesce(F.size("fixed"), F.lit(0)) + 64
    proven = (found.agg(F.sum(size)).first()[0] or 0) <= SMALL_BYTES
    held = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), site(F.col("url")).alias("site"))
    joined = held.join(F.broadcast(found) if proven else found, "site", "left").select("page_id", "url", "html", "root", "usual", "fixed")
    return joined.mapInArrow(_extract, "page_id bigint, url string, text string")
