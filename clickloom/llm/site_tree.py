"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree from their roots: a node is a path of tags with their classes, and holds how
often each layout (the tags of its children) and each content was seen there. A node's importance is the entropy of both,
nearer to 1 the fewer pages speak against it; a branch that looks and reads alike on many pages is furniture. Each page then
loses its branches of low importance and those whose role says so (menus, forms, adverts, reader comments, which may differ
on every page), and the blocks that are left are its text.

Defined cases: a null or empty page has an empty text; a page without host is a host of its own kind; markup that is broken,
unclosed or nested wrongly is closed where its parent ends; a tag that the page's end cuts off is dropped; pages of a host with
one main text count once, so copies of an article don't make it furniture; a page that would lose all its text to the tree keeps it;
repeated rows give repeated results; an empty table gives an empty table; other columns are not read, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.shipping import ship_package
from clickloom.llm.tables import stored

#: A branch below this importance goes.
LEAST_IMPORTANCE = 0.2
LAYOUT_SHARE = 0.1

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template iframe object svg canvas audio video math select textarea button title".split())
RAW = frozenset("script style textarea title iframe noscript xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul".split()
)
ROLES_OUT = frozenset("nav footer aside form menu dialog search".split())
ARIA_OUT = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES_OUT = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"nav|navbar|navigation|menu|menubar|breadcrumbs?|sidebar|side|aside|footer|header|masthead|topbar|toolbar|"
    r"comments?|commentlist|respond|reply|replies|disqus|discussion|share|sharing|social|related|recommend\w*|"
    r"newsletter|subscribe|subscription|signup|login|search|widget|pagination|pager|skip|legal|copyright)(?:$|[-_\s])",
    re.IGNORECASE,
)
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol dl table body article section div main td th".split())
CONTAINERS = frozenset("div section ul ol dl table header figure details fieldset center blockquote hgroup".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
# One attribute; a quote that never closes is part of a plain value.
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+)?+""")
_COUNTER = re.compile(r"[-_:]\d+$")
ATTRIBUTES = frozenset("class id role hidden aria-hidden style".split())



class Node:
    """An element with its children in order: nodes, and texts as strings."""

    __slots__ = ("tag", "attributes", "children", "_label", "size", "linked", "links")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []
        self._label: str | None = None
        # Characters of text, those of them in links, and the number of links below.
        self.size = self.linked = self.links = 0

    @property
    def label(self) -> str:
        """The tag with its classes and id, numbers at their ends aside, which are often counters."""
        if self._label is None:
            names = sorted(self.attributes.get("class", "").split()) + ["#" + self.attributes.get("id", "")]
            self._label = self.tag + "." + ".".join(_COUNTER.sub("", n) for n in names)
        return self._label

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() if c.tag not in HIDDEN else "" for c in self.children)


MAX_DEPTH = 200


def read_tag(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Attributes, whether the tag closes itself, and its end; ``at`` is after the tag's name."""
    found: dict[str, str] = {}
    while at < len(page) and page[at] != ">":
        hit = _ATTRIBUTE.match(page, at)
        if hit[1] and (name := hit[1].lower()) in ATTRIBUTES and name not in found:
            found[name] = entities.unescape(hit[2] or hit[3] or hit[4] or "")
        at = hit.end()
    return found, page[at - 1 : at] == "/", at + 1


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str], bool]]:
    """(kind, name or text, attributes, closed) of texts, starts and ends, in one pass over the page."""
    begin = at = 0
    while (at := page.find("<", at)) >= 0:
        end = page[at + 1 : at + 2] == "/"
        name = _NAME.match(page, at + 1 + end)
        if name:
            if begin < at:
                yield "text", page[begin:at], {}, False
            tag = name[0].lower()
            attributes, closed, begin = read_tag(page, name.end())
            if begin <= len(page):
                yield "end" if end else "start", tag, attributes, closed
            if tag in RAW and not end:
                close = re.compile(rf"</{tag}(?![^\s/>])", re.IGNORECASE).search(page, begin)
                begin = page.find(">", close.end()) + 1 if close else 0
                begin = begin or len(page)
            at = begin
        elif page.startswith("<!--", at):
            if begin < at:
                yield "text", page[begin:at], {}, False
            stop = page.find("-->", at + 4)
            at = begin = stop + 3 if stop >= 0 else len(page)
        elif end or page[at + 1 : at + 2] in ("!", "?"):
            if begin < at:
                yield "text", page[begin:at], {}, False
            stop = page.find(">", at)
            at = begin = stop + 1 if stop >= 0 else len(page)
        else:
            at += 1
    if begin < len(page):
        yield "text", page[begin:], {}, False


def parse(page: str) -> Node:
    """The element tree of a page; what is nested deeper than ``MAX_DEPTH`` becomes a sibling at that depth."""
    root = Node("html", {})
    stack = [root]
    for kind, name, attributes, closed in tokens(page):
        if kind == "text":
            stack[-1].children.append(entities.unescape(name))
            continue
        if kind == "end":
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    del stack[i:]
                    break
            continue
        if name in ("html", "body") and any(n.tag == name for n in stack):
            continue
        closes = CLOSED_BY.get(name, frozenset())
        if name in BLOCKS:
            closes = closes | {"p"}
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in closes:
                del stack[i:]
            elif stack[i].tag in SCOPES and not (closes and stack[i].tag in closes):
                break
        node = Node(name, attributes)
        stack[-1].children.append(node)
        if name not in RAW and name not in VOID and not closed and len(stack) < MAX_DEPTH:
            stack.append(node)
    made = [root]
    for node in made:
        made.extend(c for c in node.children if not isinstance(c, str))
    for node in reversed(made):
        for c in node.children:
            if isinstance(c, str):
                node.size += len(c.strip())
            else:
                node.size += c.size
                node.linked += c.size if c.tag == "a" else c.linked
                node.links += c.links + (c.tag == "a")
    return root


def has_noise_role(node: Node, inside: bool) -> bool:
    """Whether a node's tag, role or names say that it is not the article; ``inside`` the article a header is part of it."""
    if node.tag in HIDDEN or node.tag in ROLES_OUT or (node.tag == "header" and not inside):
        return True
    a = node.attributes
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    if a.get("role", "").lower() in ARIA_OUT:
        return True
    if node.tag in ("html", "body", "main") or (node.tag == "article" and not re.search("comment|reply|ad\\b", a.get("class", ""))):
        return False
    names = f"{a.get('class', '')} {a.get('id', '')}"
    if node.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "p") or (inside and node.tag == "header"):
        return bool(re.search(r"\b(?:ad|ads|advert\w*|cookie|comment)\b", names))
    return bool(NAMES_OUT.search(names))


def _main(node: Node) -> list[tuple[Node, str]]:
    """The outermost main or article elements that are not furniture themselves, or else the whole page, with their parents' paths."""
    for wanted in ("main", "article"):
        found: list[tuple[Node, str]] = []
        waiting = [(node, "")]
        while waiting:
            here, path = waiting.pop()
            if here.tag == wanted or (wanted == "main" and here.attributes.get("role", "").lower() == "main"):
                found.append((here, path))
                continue
            path = f"{path}>{here.label}"
            waiting.extend(
                (c, path) for c in reversed(here.children) if not isinstance(c, str) and not has_noise_role(c, False)
            )
        if found and any(n.text().strip() for n, _ in found):
            return found
    return [(node, "")]


def _is_menu(node: Node) -> bool:
    """Whether a list or division is mostly links."""
    return node.links >= 3 and node.linked >= 0.8 * node.size


def branches(page: str) -> Iterator[tuple[str, str, str, str]]:
    """(main text, path, layout, content) of all containers of a page, from its root."""
    root = parse(page)
    main = " ".join(" ".join(top.text() for top, _ in _main(root)).split())
    waiting = [(root, "")]
    while waiting:
        node, path = waiting.pop()
        path = f"{path}>{node.label}"
        inner = [c for c in node.children if not isinstance(c, str) and c.tag not in HIDDEN]
        waiting.extend((c, path) for c in inner)
        if node.tag in CONTAINERS:
            yield main, path, " ".join(c.label for c in inner), " ".join(node.text().split())


def main_text(page: str, low: frozenset[str]) -> str:
    """The text blocks of a page without the branches whose paths are in ``low``, or with them if nothing else is left."""
    root = parse(page)
    return _blocks(root, low) or (_blocks(root, frozenset()) if low else "")


def _blocks(root: Node, low: frozenset[str]) -> str:
    blocks: list[str] = []
    part: list[str] = []

    def close() -> None:
        line = " ".join("".join(part).split())
        part.clear()
        if line:
            blocks.append(line)

    def walk(node: Node, path: str, inside: bool) -> None:
        path = f"{path}>{node.label}"
        for c in node.children:
            if isinstance(c, str):
                part.append(c)
            elif c.tag == "br":
                part.append(" ")
            elif c.tag in VOID:
                if c.tag == "hr":
                    close()
            elif has_noise_role(c, inside):
                if c.tag in BLOCKS:
                    close()
            elif c.tag in CONTAINERS and (f"{path}>{c.label}" in low or (not inside and _is_menu(c))):
                close()
            elif c.tag in BLOCKS:
                close()
                walk(c, path, inside)
                close()
            else:
                walk(c, path, inside)

    for top, path in _main(root):
        walk(top, path, top.tag != "html")
        close()
    return "\n".join(blocks)


def _entropy(counts: DataFrame, name: str) -> DataFrame:
    """(host, path, pages, ``name``): entropy of how pages share the values, 0 if all agree and 1 if all differ."""
    sums = counts.groupBy("host", "path").agg(
        F.sum("count").alias("pages"), F.sum(F.col("count") * F.log("count")).alias("weighted")
    )
    entropy = (F.log("pages") - F.col("weighted") / F.col("pages")) / F.log("pages")
    return sums.select("host", "path", "pages", F.when(F.col("pages") > 1, entropy).otherwise(1.0).alias(name))


def low_branches(pages: DataFrame) -> DataFrame:
    """(host, low): paths of a host's branches that look and read alike on its pages; from rows (host, html)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
                for main, path, layout, content in branches(page):
                    out[0].append(host)
                    out[1].append(path)
                    for column, value in zip(out[2:], (main, layout, content), strict=True):
                        column.append(digest(value.encode("utf-8", "replace")))
            numbers = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in out[2:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), *numbers],
                names=["host", "path", "main", "layout", "content"],
            )

    nodes = pages.mapInArrow(cut, "host string, path string, main long, layout long, content long")
    # Pages with one main text speak once.
    nodes = stored(nodes.distinct().drop("main"), "branches")
    layouts = _entropy(nodes.groupBy("host", "path", "layout").count(), "by_layout")
    contents = _entropy(nodes.groupBy("host", "path", "content").count(), "by_content")
    importance = LAYOUT_SHARE * F.col("by_layout") + (1 - LAYOUT_SHARE) * F.col("by_content")
    # What one page shows proves nothing; every further one counts against a branch that does not change.
    importance = 1 - (1 - importance) * (1 - 1 / F.col("pages"))
    low = layouts.join(contents.drop("pages"), ["host", "path"]).where(importance < LEAST_IMPORTANCE)
    # A host has as many of these as its templates have branches. Written, so that its size tells how to join it.
    return stored(low.groupBy("host").agg(F.collect_set("path").alias("low")), "low-branches")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    ship_package(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"), host.alias("host")
    )
    low = low_branches(rows.select("host", "html"))
    joined = rows.join(low, "host", "left").select("page_id", "url", "html", "low")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["low"].to_pylist()
            texts = [
                main_text(page, frozenset(paths or ()))
                for page, paths in zip(batch["html"].to_pylist(), lists, strict=True)
            ]
            counts = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), counts]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kinds = dict(joined.dtypes)
    return joined.mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
