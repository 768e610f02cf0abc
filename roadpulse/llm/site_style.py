"""Main text of web pages with a site style tree.

The pages of a host are merged into one tree: a node is a path of elements with
their classes, and under it stand the different contents that the host's pages
have there, and the different layouts (sequences of elements) of the element
that holds it. Both have an entropy over the pages that have the node, copies of
a page counted once, relative to the most it could be; the node is as important
as the greater says, so text that is the same everywhere still belongs to an
element that is laid out anew on each page. What looks the same everywhere is
not what a page is about, and is removed from each page.

Before that, elements that by tag or role are no main text go. Names in classes
and ids are evidence only: a class has to say nothing but what is no main text
("related-posts", not "related-work" or "with-sidebar"), an element that holds
the only article stays whatever its name, and inside an article ids of headings,
paragraphs and sections are slugs of what they say.

The tree is counted by a map-side combined aggregation, so a host with a third
of all pages is spread over the tasks; only the removed nodes of each host
come back to its pages.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import map_batches, stored

#: A branch is removed below this importance, once so many pages of the host have it.
LEAST_IMPORTANCE, LEAST_PAGES = 0.2, 5

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Fixed values of HTML: elements without content, with raw text, that start a block, and that a new block ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p "
                  "pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("td th tr tbody thead tfoot caption body html option optgroup legend".split())
ENDS_SAME = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
             "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
             "option": ("option", ("select",))}
#: Elements, roles and words in class or id that mark what is not main text.
NOT_TEXT = frozenset("head nav footer button select input textarea label script style noscript template iframe "
                     "object svg canvas audio video dialog menu title".split())
#: Elements that are no main text unless they hold the only article.
NOT_ALONE = frozenset("aside form".split())
NOT_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar "
                     "tablist status".split())
NOT_CLASS = frozenset("ad ads advert adverts advertisement advertisements advertising adsense adsbygoogle sponsor sponsored "
                      "promo promoted promotion banner cookie cookies consent gdpr notice notices notification notifications "
                      "alert popup modal overlay newsletter subscribe subscription signup login menu menus nav navbar navigation "
                      "breadcrumb breadcrumbs sidebar aside widget widgets related recommended recommendations share sharing "
                      "social comment comments reply replies respond disqus discussion footer masthead toolbar pagination pager "
                      "skip copyright legal".split())
HEADER_CLASS = frozenset("header topbar".split())
#: Words beside them that say nothing of what a text is about.
NEUTRAL = frozenset("area articles bar block body bottom box btn button buttons card cards col column container content count feed "
                    "footer form group header heading icon icons inline inner item items js large latest left link links list "
                    "main menu message mobile more most news outer page pages panel popular post posts primary reader readers "
                    "recent region right row rows secondary section sections site slot small stories story tag tags text thread "
                    "title top unit user users wrap wrapper".split())
#: Ids that mark reader comments on any element.
COMMENTS = frozenset("comment comments respond replies disqus".split())
#: Elements of running text; without a class such a node inside the article is never removed for its entropy.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tfoot tr td th figure figcaption "
                    "caption article main section div body html".split())


@dataclass
class Element:
    name: str
    label: str
    removed: bool
    noise: bool  # by name or class no main text, from the article around it down
    main: int  # of the article or main element around it, 0 outside
    path: str
    bare: bool  # nothing but running text without class from the article down
    holder: str  # path of the nearest element that is more than running text


@dataclass
class Block:
    path: str
    main: int
    noise: bool
    bare: bool
    holder: str
    parts: list[str] = field(default_factory=list)

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@dataclass
class Main:
    """An article or main element: its kind, the number of the main element around it, and whether its place speaks against it."""
    kind: str
    around: int
    doubtful: bool


def blocks(page: str) -> tuple[list[Block], list[Main], dict[str, list[str]]]:
    """Blocks of text in page order, the article and main elements (numbered from 1), and the layout of each element."""
    root = Element("", "", False, False, 0, "", True, "")
    stack, out, mains, layouts = [root], [], [], {}
    block = Block("", 0, False, True, "")

    def turn() -> None:
        nonlocal block
        if block.parts:
            out.append(block)
        top = stack[-1]
        block = Block(top.path, top.main, top.noise, top.bare, top.holder)

    def close(names: str | set[str], stop: tuple[str, ...] = ()) -> bool:
        names = set(names.split()) if isinstance(names, str) else names
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                del stack[i:]
                return True
            if stack[i].name in stop:
                return False
        return False

    def say(text: str) -> None:
        top = stack[-1]
        if text and not top.removed:
            if top.noise != block.noise or top.main != block.main:
                turn()
            block.parts.append(entities.unescape(text))

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at, name = m.end(), (m["name"] or "").lower()
        if not name:
            continue
        if m["close"]:
            if name == "p" and not any(e.name == "p" for e in stack):
                turn()
            elif close({name}, () if name in BLOCK else ("td", "th", "table", "li", "article", "div", "section")) and name in BLOCK:
                turn()
            continue
        if name in ("br", "wbr", "img", "hr", "input"):
            if name == "hr":
                close("p", ("table", "article", "div"))
                turn()
            elif name in ("br", "input"):
                say(" ")
            continue
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in ENDS_P:
            close("p", ("table", "td", "th", "button", "object", "caption"))
        if name in ENDS_SAME:
            while close(ENDS_SAME[name][0], ENDS_SAME[name][1]):
                pass
        stack.append(_element(name, m["rest"] or "", stack[-1], mains))
        if name in BLOCK:
            layouts.setdefault(stack[-2].path, []).append(stack[-1].label)
            turn()
    if block.parts:
        out.append(block)
    return out, mains, layouts


def _names(text: str) -> set[str]:
    return {w.lower() for w in _TOKEN.findall(text)}


def _is_noise(name: str, kinds: frozenset[str] = NOT_CLASS) -> bool:
    """Whether a class or id says that its element is no main text, and nothing else."""
    words = _names(name)
    return bool(words & kinds) and words <= kinds | NOT_CLASS | NEUTRAL


def _element(name: str, rest: str, parent: Element, mains: list[Main]) -> Element:
    attributes = {a.lower(): entities.unescape(b or c or d) for a, b, c, d in _ATTRIBUTE.findall(rest)} if rest.strip() else {}
    classes = sorted(attributes.get("class", "").split())
    role, own_id = attributes.get("role", "").lower(), attributes.get("id", "")
    main, holder = parent.main, parent.holder
    removed = parent.removed or name in NOT_TEXT or role in NOT_ROLE or "hidden" in attributes or not main and name == "header" \
        or attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")) is not None
    named = False
    if name not in ("html", "body", "main"):
        slug = main and name not in ("div", "aside", "ul", "ol")
        named = name in NOT_ALONE or any(map(_is_noise, classes)) or _is_noise(own_id, COMMENTS if slug else NOT_CLASS) \
            or not main and name != "article" and any(_is_noise(c, HEADER_CLASS) for c in (*classes, own_id))
    noise = parent.noise or named
    kind = "article" if name == "article" or role == "article" else "main" if name == "main" or role == "main" else ""
    if kind and not removed and (not main or mains[main - 1].kind == "main" and kind == "article"):
        mains.append(Main(kind, main, noise or bool(main) and mains[main - 1].doubtful))
        main, noise = len(mains), False
    label = ".".join([name, *classes])
    plain = name in RUNNING and not classes and not own_id
    bare = parent.bare and plain or name in ("html", "body") or main != parent.main
    path = f"{parent.path}/{label}" if name in BLOCK else parent.path
    if name in BLOCK and not plain:
        holder = path
    return Element(name, label, removed, noise, main, path, bare if name in BLOCK else parent.bare, holder)


def candidates(page: str) -> tuple[list[tuple[Block, bool]], dict[str, list[str]]]:
    """Blocks that may be main text, and whether they are running text of an article; the layouts.

    They are those of all articles and of the main elements around them; else of
    the main elements; else of the whole page. Articles and main elements in a
    doubtful place count only if there are no others, and then the longest.
    """
    found, mains, layouts = blocks(page)
    found = [b for b in found if not b.noise and b.text]
    for kind in ("article", "main"):
        size: dict[int, int] = {}
        for b in found:
            if b.main and mains[b.main - 1].kind == kind:
                size[b.main] = size.get(b.main, 0) + len(b.text)
        sure = {k for k in size if not mains[k - 1].doubtful}
        if not sure and kind == "article" and any(b.main and not mains[b.main - 1].doubtful for b in found):
            continue  # a main element in its own right, with nothing but doubtful articles
        if size:
            inside = sure or {max(size, key=lambda k: (size[k], -k))}
            around = {mains[k - 1].around for k in inside} - {0}
            return [(b, b.bare and b.main in inside) for b in found if b.main in inside | around], layouts
    return [(b, False) for b in found], layouts


def main_text(page: str, unimportant: frozenset[str] = frozenset()) -> str:
    """Text of a page without the nodes ``unimportant``."""
    return " ".join(b.text for b, kept in candidates(page)[0] if kept or b.path not in unimportant)


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()


def _nodes(page: str) -> tuple[str, list[tuple[str, str, str]]]:
    """Digest of a page's whole text by places; (path, digest of the content, digest of its holder's layout) of the nodes that may be removed."""
    content: dict[str, list[str]] = {}
    holder: dict[str, str] = {}
    found, layouts = candidates(page)
    for b, kept in found:
        if not kept:
            content.setdefault(b.path, []).append(b.text)
            holder[b.path] = b.holder
    # the whole page is no holder: its layout says nothing of one node
    laid = {path: " ".join(layouts.get(h, ())) if h else "" for path, h in holder.items()}
    return _digest("\n".join(f"{b.path}\t{b.text}" for b, _ in found)), [
        (path, _digest(" ".join(texts)), _digest(laid[path])) for path, texts in content.items()]


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, pages, content, presentation, importance of every node; ``pages`` has host and html.

    Copies of a page on its host count once.
    """
    def run(batch: pa.RecordBatch):
        rows = [(h, *_nodes(page)) for h, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist())]
        yield {"host": [r[0] for r in rows], "page": [r[1] for r in rows],
               "nodes": [[{"path": p, "content": c, "layout": x} for p, c, x in r[2]] for r in rows]}
    whole = map_batches(pages.select("host", "html"), run, "host string, page string, nodes array<struct<path:string,content:string,layout:string>>")
    node = whole.dropDuplicates(["host", "page"]).select("host", F.explode("nodes").alias("x"))
    looks = node.select("host", "x.path", F.explode(F.create_map(
        F.lit("content"), F.col("x.content"), F.lit("presentation"), F.col("x.layout"))).alias("kind", "look"))
    counts = looks.groupBy("host", "path", "kind", "look").agg(F.count("*").alias("n"))
    sums = counts.groupBy("host", "path", "kind").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    entropy = F.log("pages") - F.col("nlogn") / F.col("pages")
    entropies = sums.withColumn("e", F.when(F.col("pages") == 1, 1.0).otherwise(entropy / F.log("pages")))
    by_kind = entropies.groupBy("host", "path").agg(F.max("pages").alias("pages"), *[
        F.max(F.when(F.col("kind") == k, F.col("e"))).alias(k) for k in ("content", "presentation")])
    return by_kind.withColumn("importance", F.greatest("content", "presentation"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (the main text), one row per row of ``pages``.

    Null html counts as empty and has empty text; a null url, or one without a
    host, belongs to the host of no name. Broken markup is read as far as it
    goes. Repeated rows get a row each; an empty table gives no rows; other
    columns are not looked at.
    """
    ids = pages.schema["page_id"].dataType.simpleString()
    pages = pages.select(
        "page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit(""))).alias("host"))
    low = style_tree(pages).where((F.col("importance") < LEAST_IMPORTANCE) & (F.col("pages") >= LEAST_PAGES))
    of_host = stored(low.groupBy("host").agg(F.collect_list("path").alias("unimportant")), "unimportant")
    both = pages.join(of_host, "host", "left").select("page_id", "url", "html", "unimportant")

    def run(batch: pa.RecordBatch):
        sets: dict[tuple, frozenset] = {}
        texts = []
        for page, paths in zip(batch.column("html").to_pylist(), batch.column("unimportant").to_pylist()):
            key = tuple(paths or ())
            texts.append(main_text(page, sets.setdefault(key, frozenset(key))))
        yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts}
    return map_batches(both, run, f"page_id {ids}, url string, text string")


def page_texts(pages: DataFrame) -> DataFrame:
    return extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))
