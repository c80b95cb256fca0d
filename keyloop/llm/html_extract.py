"""HTML extraction: template deduction by equivalence classes of tokens over a host's pages.

A token is an element told apart by its path (tags with first class or id), or, outside marked regions
and article elements, a text node with its path.  Tokens with the same occurrence vector over the pages of a host
(how often each page has them) form an equivalence class.  A class is valid on a page with enough tokens and pages
and its once-a-page elements in the same order there; elements of all valid classes nest by their
paths.  They delimit slots; the texts of valid classes are boilerplate.  Of the slots the deepest with most of the
text is the article, article and main elements coming first; its blocks are the result.  Only where
that is the whole page, or a host gives no class, do tags and class words choose a part of it.

Occurrence vectors are never collected: a vector is the two sums of the halves of a hash of (page, count) over
its pages, summed up map-side and shuffled by (host, token), so a host with a third of all pages is
spread by token.  A class counts whatever its share of the pages, and the template of a page are the classes it
holds: a host with several layouts has one for each.  A host's classes hold at most ``1 / LEAST_PAGES`` of the
tokens that its pages have in all.

Definitions: null html is empty and gives an empty text.  Blocks are the runs of text between
block-level tags; their white space becomes one space, empty ones go, the rest is joined by a
blank line.  Inside an article nothing is dropped but marked boilerplate (menus, asides, adverts, forms,
comments, ...), however often it repeats.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.text import ddl, slices, without

#: Pages and tokens of a valid class at least (a host of fewer pages: all its pages).
LEAST_PAGES = 3
LEAST_TOKENS = 2
#: Rows that a task gathers before it hands them on.
GATHER = 100_000

# HTML element names by their role, and words in class, id or role that mark what is
# not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset(
    "aside button canvas datalist dialog embed fieldset footer form frame frameset head header iframe "
    "input menu nav noscript object option script select style svg template textarea title audio video".split())
# Marks hold for a whole class name, with a usual first or last part; "no-sidebar" or "comments-open" tell
# about the layout and mark nothing.
MARKS = re.compile(
    r"(?:(?:site|page|main|top|bottom|left|right|primary|secondary|global|mobile|sticky|cookie|post|entry|blog|"
    r"social|skip)[_-])?"
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav|navbar|navigation|menu\w*|"
    r"side-?bar\w*|widget\w*|footer\w*|header|masthead|topbar|breadcrumbs?|cookies?|consent|gdpr|notices?|"
    r"popup|modal|overlay|newsletter|subscribe\w*|subscription|share|sharing|social|comments?|disqus|"
    r"replies|respond|related|recommend\w*|pagination|pager|toolbar|login|signup|search\w*|skip-?link|"
    r"copyright|legal|disclaimer|contentinfo|complementary|alert\w*|dialog)"
    r"(?:[_-](?:area|bar|box|button|buttons|container|content|form|inner|item|items|links?|list|menu|notice|posts|"
    r"section|thread|text|unit|wrap|wrapper|\d+))?", re.I)
#: What no mark drops, and tags that may wrap a page: they go unless they hold most of its text.
KEPT = frozenset("html body main article".split())
WRAPPERS = frozenset("form header fieldset dialog".split())
ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|articlebody|post|entry|story|main|content)(?=$|[\s_-])", re.I)
TEXT_BLOCKS = frozenset(
    "blockquote dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 li ol p pre table tbody td th tr ul".split())
#: Which open elements a start tag ends.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What ends the search for them.
SCOPE = frozenset("article aside body div footer header main nav ol section table td th ul".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)[^<>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split())


class Node:
    """An open element: its path, whether it or an ancestor is not part of an article, and whether one is an
    article by its tag (2) or by a word in its names (1)."""

    __slots__ = ("tag", "path", "up", "marked", "article", "chars", "out")

    def __init__(self, tag, path, up, marked, article):
        self.tag, self.path, self.up, self.marked, self.article = tag, path, up, marked, article
        self.chars, self.out = 0, False


def walk(html: str) -> list[tuple]:
    """(node, None) for each element opened, (node, text) for each text, (None, None) for
    each block boundary."""
    root = Node("", "", None, False, 0)
    stack, events, nodes = [root], [], []
    for m in _TOKEN.finditer(html):
        if (text := m["text"]) is not None:
            events.append((stack[-1], text))
            continue
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            events.append((None, None))
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        closes = ENDS.get(tag, set()) | ({"p"} if tag in _CLOSES_P else set())
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in VOID:
            if tag == "br":
                events.append((stack[-1], " "))
            continue
        names = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(m["attrs"] or "")}
        said = " ".join(names.values())
        up = stack[-1]
        article = 2 if tag in ("article", "main") else int(bool(said and ARTICLE.search(said)))
        # the header of an article is part of it
        marked = (tag in DROPPED and not (tag == "header" and up.article)
                  or any(MARKS.fullmatch(name) for name in said.split()))
        own = tag
        if tag not in INLINE and (names.get("class") or names.get("id")):
            own += "." + (names.get("class") or names["id"]).split(" ")[0].strip()
        # an article within an article may be a comment, others are not dropped by a mark
        node = Node(tag, up.path if tag in INLINE else f"{up.path}/{own}", up,
                    marked and (tag not in KEPT or tag == "article" and any(n.tag == tag for n in stack)),
                    max(up.article, article))
        stack.append(node)
        nodes.append(node)
        events.append((node, None))
    _drop(nodes, events)
    return events


def _drop(nodes: list[Node], events: list[tuple]):
    """Decides what the marks take out: no element that holds most of the page's text, where the page
    has articles most of theirs, unless its tag says what it is."""
    if not any(node.marked for node in nodes):
        return
    focus = any(node.tag in ("article", "main") for node in nodes)
    total = 0
    for node, text in events:
        if text is not None and (n := len("".join(text.split()))):
            inside, at = not focus, node
            while at is not None and not (at.marked and at.tag in DROPPED - WRAPPERS):
                inside = inside or at.tag in ("article", "main")
                at = at.up
            if at is None and inside:
                total += n
                while node is not None:
                    node.chars += n
                    node = node.up
    for node in nodes:
        hard = node.tag in DROPPED and node.tag not in WRAPPERS
        node.out = node.up.out or node.marked and (hard or 2 * node.chars <= total)
        node.article = 0 if node.out else node.article


def _key(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts)) - (1 << 63)


def page_tokens(html: str, events: list | None = None) -> dict[tuple[str, bool], list]:
    """(path or path and text, is a text) -> [count, characters of text under the element, whether it is an
    article by its tag, place on the page], in the order of the page."""
    found: dict = {}
    for node, text in walk(html) if events is None else events:
        if node is None or node.out:
            continue
        if text is None:
            if node.tag not in INLINE:
                entry = found.setdefault((node.path, False), [0, 0, False, len(found)])
                entry[0] += 1
                entry[2] = entry[2] or node.tag in ("article", "main")
        elif text := " ".join(text.split()):
            # what an article element holds is never a template's text
            if node.article < 2:
                found.setdefault((f"{node.path}\0{text}", True), [0, 0, False, len(found)])[0] += 1
            at = node.path
            while at:
                if (at, False) in found:
                    found[at, False][1] += len(text)
                at = at.rpartition("/")[0]
    return found


_TOKENS = ("host string, token long, is_text boolean, path string, pages long, n long, chars long, total long, "
           "article boolean, place long, low long, high long")


def _tokens(html: str):
    def run(batches):
        table: dict = {}

        def out():
            rows = [(h, _key(t), x, None if x else t, *v) for (h, t, x), v in table.items()]
            names = [c.split()[0] for c in _TOKENS.split(", ")]
            types = [pa.string(), pa.int64(), pa.bool_(), pa.string(), *[pa.int64()] * 4, pa.bool_(),
                     *[pa.int64()] * 3]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for part in slices(batches, html):
            for host, text, page in zip(*(part.column(c).to_pylist() for c in ("__host", html, "__page"))):
                tokens = page_tokens(text or "")
                total = max((v[1] for v in tokens.values()), default=0)
                for (token, is_text), (n, chars, article, place) in tokens.items():
                    vector = xxhash.xxh3_64_intdigest(f"{page} {n}")
                    row = table.setdefault((host, token, is_text), [0, 0, 0, 0, False, 0, 0, 0])
                    row[0] += 1
                    row[1] += n
                    row[2] += chars
                    row[3] += total
                    row[4] = row[4] or article
                    row[5] += place
                    row[6] += vector & 0xFFFFFFFF
                    row[7] += vector >> 32
                if len(table) >= GATHER:
                    yield out()
                    table.clear()
        if table:
            yield out()
    return run


def templates(pages: DataFrame, html: str = "html") -> DataFrame:
    """(host, classes) of each host: its valid classes, each with its once-a-page elements in the order of the
    pages (path, share of the pages' text, article by its tag) and the keys of its texts.

    ``pages`` has __host, __page (a number for each page) and the html."""
    sums = ("pages", "n", "chars", "total", "place", "low", "high")
    tokens = (pages.select("__host", "__page", html).mapInArrow(_tokens(html), _TOKENS)
              .groupBy("host", "token", "is_text")
              .agg(F.max("path").alias("path"), F.max("article").alias("article"),
                   *[F.sum(c).alias(c) for c in sums]))
    size = pages.groupBy(F.col("__host").alias("host")).agg(F.count("*").alias("size"))
    # whatever the share of the host's pages, so that each layout has its classes; a host of fewer pages has no
    # repeated texts, but elements
    wide = tokens.join(size, "host").where(F.col("pages") >= F.least(F.lit(LEAST_PAGES), F.col("size")))
    element = ~F.col("is_text") & (F.col("n") == F.col("pages"))
    classes = wide.groupBy("host", "low", "high", "pages").agg(
        F.count("*").alias("tokens"),
        F.sort_array(F.collect_list(F.when(element, F.struct(
            "place", "path", (F.col("chars") / F.greatest("total", F.lit(1))).alias("chars"), "article"))))
        .alias("once"),
        F.collect_list(F.when(F.col("is_text") & (F.col("pages") >= LEAST_PAGES), F.col("token"))).alias("texts"))
    valid = classes.where((F.col("tokens") >= LEAST_TOKENS) & (F.size("once") + F.size("texts") > 0))
    return valid.groupBy("host").agg(F.collect_list(F.struct("once", "texts")).alias("classes"))


def main_slot(once: list[dict]) -> str | None:
    """Of the elements that are once on a page: the deepest that holds most of the text, of the articles by
    their tag if there are some."""
    full = [e for e in once if e["chars"] > 0]
    if not full:
        return None
    full = [e for e in full if e["article"]] or full
    most = max(e["chars"] for e in full)
    return max((e for e in full if e["chars"] >= 0.6 * most),
               key=lambda e: (e["path"].count("/"), e["chars"], e["path"]))["path"]


class Template:
    """The valid classes of a host, found by one of their tokens: a page with one has them all."""

    def __init__(self, classes: list[dict]):
        self.by_element, self.by_text = {}, {}
        for c in classes:
            if c["once"]:
                self.by_element[c["once"][0]["path"]] = c
            else:
                self.by_text[c["texts"][0]] = c

    def of(self, tokens: dict) -> tuple[str | None, list[tuple], list[frozenset]]:
        """(path of the article's slot, (elements, texts) of each class with elements, texts of classes
        without) by the classes that a page holds: all tokens there, elements once and in order."""
        at = {t: v[3] for (t, is_text), v in tokens.items() if not is_text and v[0] == 1}
        texts = {_key(t) for t, is_text in tokens if is_text}
        slots, groups, alone = [], [], []
        for path in at:
            if c := self.by_element.get(path):
                places = [at.get(e["path"], -1) for e in c["once"]]
                if places[0] >= 0 and all(a < b for a, b in zip(places, places[1:])) and texts.issuperset(c["texts"]):
                    slots += c["once"]
                    groups.append(([e["path"] for e in c["once"]], frozenset(c["texts"])))
        for key in texts:
            if (c := self.by_text.get(key)) and texts.issuperset(c["texts"]):
                alone.append(frozenset(c["texts"]))
        return main_slot(slots), groups, alone


def _under(path: str, top: str) -> bool:
    return not top or path == top or path.startswith(top + "/")


def _tag(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def _text_key(node: Node, text: str) -> int:
    return _key(f"{node.path}\0{' '.join(text.split())}")


def _linked(node: Node) -> bool:
    while node.tag in INLINE and node.tag != "a":
        node = node.up
    return node.tag == "a"


def widen(slot: str, events: list, tokens: dict, known: frozenset) -> str:
    """The slot, or the element around it whose other text belongs to the article too: text that is no
    class's (``known``), not taken out and no link.  Never beyond what is an article by its tag or a word;
    beyond the page's body's children only from a single block such as a paragraph."""
    level = {node.path: node.article for node, text in events if node and text is None and node.tag not in INLINE}
    own = [node.path for node, text in events if text is not None and not node.out and text.strip()
           and not _linked(node) and _text_key(node, text) not in known]
    block, top, around = _tag(slot) in TEXT_BLOCKS, level.get(slot, 0), slot
    while around:
        around = around.rpartition("/")[0]
        whole = _tag(around) in ("", "html", "body")
        if whole and not block or level.get(around, 0) < top:
            break
        if (whole or tokens.get((around, False), [0])[0] == 1) and any(
                _under(path, around) and not _under(path, slot) for path in own):
            slot = around
    return slot


def extract(html: str, template: Template | None = None) -> str:
    """The article's text of one page, given its host's template.  Template text leaves the slot if its
    class holds the slot, or lies in an element of its class within the slot; texts that repeat together
    without an element leave only what lies outside a slot (they may be shared paragraphs)."""
    events = walk(html)
    main, groups, alone = None, [], []
    if template:
        tokens = page_tokens(html, events)
        main, groups, alone = template.of(tokens)
        if main is not None:
            main = widen(main, events, tokens, frozenset().union(*(texts for _, texts in groups)))
    whole = main is None or _tag(main) in ("", "html", "body")
    plain, nested = set(), []
    for paths, texts in groups:
        if whole or any(_under(main, path) for path in paths):
            plain |= texts
        elif texts:
            nested.append((paths, texts))
    # texts under the slot: (key, is marked, text), None at the end of a block
    kept: list = []
    for node, text in events:
        if node is None:
            kept.append(None)
        elif text is not None and not node.out and (main is None or _under(node.path, main)):
            key = _text_key(node, text) if (plain or nested or alone) and node.article < 2 else None
            if any(key in texts and any(_under(node.path, path) for path in paths) for paths, texts in nested):
                continue
            kept.append((key, node.article, text))
    # tags and words only choose where the template leaves the whole page
    if whole:
        size = [sum(len(k[2].strip()) for k in kept if k and k[1] >= least) for least in (0, 1, 2)]
        if size[2]:
            kept = [k for k in kept if not k or k[1] == 2]
        elif 2 * size[1] >= size[0]:
            kept = [k for k in kept if not k or k[1]]
        # texts repeated together, without an element of their own, may be a copied article: not if they are most
        length = sum(len(k[2].strip()) for k in kept if k and k[0] not in plain)
        for texts in alone:
            if 2 * sum(len(k[2].strip()) for k in kept if k and k[0] in texts) < length:
                plain |= texts
    return _blocks([k for k in kept if not k or k[0] not in plain]) or _blocks(kept)


def _blocks(kept: list) -> str:
    blocks, own = [], []
    for k in [*kept, None]:
        if k:
            own.append(k[2])
        elif own:
            if block := " ".join(entities.unescape("".join(own)).split()):
                blocks.append(block)
            own.clear()
    return "\n\n".join(blocks)


def extract_pages(pages: DataFrame, url: str = "url", html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` plus the article's text.  Rows without a url, or one without a host, are one host's;
    a column of the new name is replaced, others pass through."""
    pages = without(pages, into, "__host", "__page", "__classes")
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    keyed = pages.withColumn("__host", host).withColumn("__page", F.xxhash64(url, html))
    own = templates(keyed, html).toDF("__of", "__classes")
    # few and small rows are broadcast, else joined by host, a hot one in pieces (adaptive execution)
    joined = keyed.drop("__page").join(own, keyed["__host"] == own["__of"], "left").drop("__of")
    kept = [c for c in pages.columns]

    def run(batches):
        known: dict = {}
        for part in slices(batches, html):
            hosts = part.column("__host").to_pylist()
            texts = []
            for i, (h, page) in enumerate(zip(hosts, part.column(html).to_pylist())):
                if h not in known:
                    if len(known) > 256:
                        known.clear()
                    known[h] = Template(part.column("__classes")[i].as_py() or [])
                texts.append(extract(page or "", known[h]))
            yield part.select(kept).append_column(into, pa.array(texts, pa.string()))

    return joined.mapInArrow(run, f"{ddl(pages)}, `{into}` string")


def pages_digest(pages: DataFrame) -> DataFrame:
    """What op3 returns."""
    done = extract_pages(pages.select("page_id", "url", "html"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
