"""Main text of web pages by composite text density (after Sun, Song and Liao, SIGIR 2011).

A page is parsed into a tree of all its elements.  The density of a node with C characters and T tags below
it, LC and LT of them in links (the page has LB of CB characters in links), is that of the paper:

    C / T * log((C / LC) * (T / LT), base ln((C / (C - LC)) * LC + (LB / CB) * C + e))

where a count of 0 below a fraction line counts as 1 (also LC in the base).  The sum of its children's
densities ranks a node (a leaf: its own).  The subtree with the maximum sum is chosen; the least density on its
path to the body is the threshold, and every other subtree off that path that reaches it is kept as well, and
so is every run of text that stands directly in an element of the path.  If the chosen node lies in an
``article`` or ``main``, that element is kept whole in its place (the page says what belongs together), and the
threshold decides what is around it.

Parts that are never main text are cut before: scripts and the like; menus, headers and footers of the page,
sidebars, forms; and elements whose class, id or role says advert, notice, comments and so on.  Such a word must be a
whole class name, or make up a compound one together with words of ``PLACES`` (``comment-list``, but neither
``has-sidebar`` nor ``search-result``).  Words of ``STRONG`` (comments, adverts, cookies) also say so at the start or end of any
compound (``reader-comments``, ``ad-300x250``), unless it starts with a word of ``STATES`` (``has-comments``).  Hidden elements
(an attribute ``hidden``, ``aria-hidden="true"``, ``display:none``) are treated alike; attributes are read by name and value.
An element that holds the page's ``main`` or only ``h1`` is not cut for its name, class or state, nor is one besides which less
than ``REST`` of the plain text of a page without ``article`` and ``main`` would be left, or in one of those less than
``REST`` of its own and fewer than ``FEW`` characters.

Tags and attributes are read in one pass, and the innermost open element of each name is known, so time is linear
in the page's length, also for deeply nested, unclosed and misnested elements.

A null or empty page, or one without text, gives the empty string; so does one all of whose text is in parts
that are cut (scripts, menus made of links).  Truncated pages and unclosed or misnested elements are parsed as
far as they go.  Of subtrees with equal sums the first is chosen.  Pages of any length are read whole.
Repeated rows give the same text.  An empty table gives an empty result.  Added columns replace their namesakes.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = RAW | frozenset("head template svg math canvas button select option object audio video".split())
CUT = frozenset("nav footer aside form dialog menu".split())
BLOCK = CUT | frozenset(
    "html body address article blockquote center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr li main ol p pre section summary table tbody td tfoot th thead tr ul caption legend".split()
)
#: Words of class, id and role names of parts that are not main text, and words that only say what or where such a part is.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment comments commentlist disqus respond replies reply contentinfo cookie cookies consent gdpr footer masthead menu navbar nav navigation newsletter notice notices alert outbrain pager pagination popup modal promo promos promoted recommended recommendations related share sharing sidebar social sponsor sponsored subscribe subscription taboola toolbar widget widgets complementary search skip login signup discussion discussions thread threads".split()
)
PLACES = frozenset(
    "area bar block bottom box btn button buttons center column container content cta fixed footer form global group header holder icon icons inline inner item items label left link links list main message middle overlay page panel placeholder post posts primary right row secondary section show site slot sticky strip the thread to top unit wrap wrapper".split()
)
STRONG = frozenset("ad ads advert adverts advertisement advertising adsbygoogle comment comments commentlist disqus respond replies cookie cookies gdpr".split())
STATES = frozenset("has have no not with without show hide is allow open close closed single can".split())
REST, FEW = 0.1, 200
#: A start of one closes an open other, unless one of the bounds is open inside that.
BOUNDS = ("div", "section", "article", "main", "td", "th")
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", *BOUNDS)),
    "dt": (("dt", "dd"), ("dl", *BOUNDS)),
    "dd": (("dt", "dd"), ("dl", *BOUNDS)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tr": (("tr",), ("table",)),
    "option": (("option",), ("select",)),
}
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTES = re.compile(r"[^>\"']*")
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>\"']+)))?")
WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
INVISIBLE = re.compile(r"(?:^|[;\s])display\s*:\s*none\b", re.I)


class Node:
    __slots__ = ("block", "chars", "children", "cut", "density", "has_block", "link_chars", "link_tags", "parent", "parts", "suspect", "tag", "tags", "total")

    def __init__(self, tag, parent, cut=False, suspect=False):
        self.tag, self.parent, self.cut, self.suspect = tag, parent, cut, suspect
        self.block = self.has_block = tag in BLOCK
        self.children: list[Node] = []
        self.parts: list = []  # texts, with whether they are linked, and children in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def attributes_of(raw: str) -> dict[str, str]:
    """Values by name in lower case; of a name that is repeated the first counts."""
    out: dict[str, str] = {}
    for name, quoted, single, bare in ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), quoted or single or bare)
    return out


def hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true" or bool(INVISIBLE.search(attributes.get("style", "")))


def noisy(attributes: dict[str, str]) -> bool:
    for label in ("class", "id", "role"):
        for name in attributes.get(label, "").split():
            words = [w.lower() for w in WORDS.findall(name)]
            if words and any(w in NOISE for w in words) and all(w in NOISE or w in PLACES for w in words):
                return True
            if words and words[0] not in STATES and (words[0] in STRONG or words[-1] in STRONG):
                return True
    return False


class Parser:
    """Open elements as a stack, with the places of each name in it."""

    def __init__(self):
        self.root = Node("html", None)
        self.open = [self.root]
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks = [0]  # places of open block elements

    def close(self, place: int) -> None:
        """Close the element at this place of the stack and all in it."""
        while len(self.open) > place:
            node = self.open.pop()
            self.at[node.tag].pop()
            if node.block:
                self.blocks.pop()

    def innermost(self, *tags: str) -> int:
        return max((self.at[t][-1] for t in tags if self.at[t]), default=0)

    def text(self, piece: str) -> None:
        if piece:
            piece = entities.unescape(piece) if "&" in piece else piece
            linked = bool(self.at["a"])
            node = self.open[-1]
            node.parts.append((piece, linked))
            n = len("".join(piece.split()))
            node.chars += n
            node.link_chars += n * linked

    def start(self, name: str, attributes: str) -> None:
        if name in ("html", "body"):
            return
        if name in BLOCK and self.innermost("p") > self.innermost(*BOUNDS):
            self.close(self.at["p"][-1])
        if name in CLOSES:
            closed, bounds = CLOSES[name]
            place = self.innermost(*closed)
            if place > self.innermost(*bounds):
                self.close(place)
        if name == "a" and self.at["a"]:
            self.end("a")
        parent = self.open[-1]
        suspect = name in CUT or (name == "header" and not self.at["article"] and not self.at["main"])
        if not suspect and attributes:
            named = attributes_of(attributes)
            suspect = hidden(named) or (name not in ("article", "main") and noisy(named))
        node = Node(name, parent, name in NEVER, suspect)
        parent.children.append(node)
        parent.parts.append(node)
        if name not in VOID and not (attributes.endswith("/") and name not in BLOCK):
            self.at[name].append(len(self.open))
            if node.block:
                self.blocks.append(len(self.open))
            self.open.append(node)

    def end(self, name: str) -> None:
        place = self.innermost(name)
        # The end of an inline element does not close a block element in it.
        if place and (name in BLOCK or place > self.blocks[-1]):
            self.close(place)


def parse(page: str) -> Node:
    parser = Parser()
    at, end = 0, len(page)
    none_left = set()  # quotes that do not occur any more

    def tag_end(at: int) -> int:
        """Place of the ``>`` that ends a tag whose attributes begin here, or the page's end."""
        while True:
            at = ATTRIBUTES.match(page, at).end()
            if at >= end or page[at] == ">":
                return at
            to = -1 if page[at] in none_left else page.find(page[at], at + 1)
            if to < 0:
                none_left.add(page[at])
            at = to + 1 if to >= 0 else at + 1

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            parser.text(page[at:])
            break
        parser.text(page[at:lt])
        if page.startswith("<!--", lt):
            to = page.find("-->", lt + 4)
            at = to + 3 if to >= 0 else end
            continue
        if page.startswith(("<!", "<?"), lt):
            to = page.find(">", lt)
            at = to + 1 if to >= 0 else end
            continue
        m = NAME.match(page, lt)
        if m is None:
            parser.text("<")
            at = lt + 1
            continue
        name = m[1].lower()
        to = tag_end(m.end())
        at = min(to + 1, end)
        if page[lt + 1] == "/":
            parser.end(name)
            continue
        parser.start(name, page[m.end() : to].strip())
        if name in RAW:
            close = _end_of(name).search(page, at)
            at = close.end() if close else end
            parser.end(name)
    return parser.root


def _end_of(name: str, made: dict = {}) -> re.Pattern:  # noqa: B006
    if name not in made:
        made[name] = re.compile(rf"</{name}\s*>", re.I)
    return made[name]


def density(c: int, t: int, lc: int, lt: int, share: float) -> float:
    """Composite density of characters, tags and those of links; ``share`` is that of the page's links."""
    if not c:
        return 0.0
    t, plain = max(t, 1), max(c - lc, 1)
    lc, lt = max(lc, 1), max(lt, 1)
    base = math.log(c / plain * lc + share * c + math.e)
    return c / t * math.log(c / lc * t / lt) / math.log(base)


def _order(root: Node) -> list[Node]:
    """Nodes that are not cut, in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(reversed([c for c in node.children if not c.cut]))
    return order


def cut_suspects(root: Node) -> None:
    """Cut the outermost suspects, but for those that are, or hold, the main part of the page."""
    order = _order(root)
    plain, head = {}, {}
    headings = sum(n.tag == "h1" for n in order)
    for node in reversed(order):
        kept = [c for c in node.children if not c.cut]
        plain[id(node)] = node.chars - node.link_chars + sum(plain[id(c)] for c in kept)
        head[id(node)] = node.tag == "main" or (node.tag == "h1" and headings == 1) or any(head[id(c)] for c in kept)
    suspects, stack, marked = [], [(root, None)], False
    left = {id(root): plain[id(root)]}  # of the page, and of each part that is marked as the main one
    while stack:
        node, inside = stack.pop()
        if node.suspect and not head[id(node)]:
            suspects.append((node, inside))
        else:
            if node.tag in ("article", "main") and plain[id(node)] > 0:
                marked, inside = True, inside or node
                left.setdefault(id(inside), plain[id(inside)])
            stack.extend((c, inside) for c in node.children if not c.cut)
    for node, inside in sorted(suspects, key=lambda x: plain[id(x[0])]):  # the smallest first
        of = inside or root
        rest = left[id(of)] - plain[id(node)]
        # Outside of what is marked, anything may go.
        if (marked and inside is None) or rest >= REST * plain[id(of)] or (inside is not None and rest >= FEW):
            node.cut = True
            left[id(of)] = rest


def measure(root: Node) -> list[Node]:
    """Counts of whole subtrees, composite densities and their sums; returns the nodes in page order."""
    order = _order(root)
    for node in order[1:]:
        node.parent.tags += 1
        node.parent.link_tags += node.tag == "a"
    for node in reversed(order[1:]):
        p = node.parent
        p.chars += node.chars
        p.tags += node.tags
        p.link_chars += node.link_chars
        p.link_tags += node.link_tags
        p.has_block |= node.has_block
    share = root.link_chars / root.chars if root.chars else 0.0
    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, share)
    for node in order:
        kept = [c.density for c in node.children if not c.cut]
        node.total = sum(kept) if kept else node.density
    return order


def blocks(parts: list) -> list[str]:
    """Texts of the blocks of some parts in page order, white space folded."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        joined = " ".join("".join(run).split())
        run.clear()
        if joined:
            out.append(joined)

    stack: list = list(reversed(parts))
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, tuple):
            run.append(x[0])
        else:
            if x.block:
                flush()
                stack.append(None)
            if not x.cut:
                stack.extend(reversed(x.parts))
    flush()
    return out


def units(node: Node, path: set[int]) -> list[list]:
    """Parts of a node that are not cut: block elements and elements of the path, each alone, and the runs of
    text and inline elements between them."""
    out: list[list] = []
    run: list = []
    for part in (*node.parts, None):
        if isinstance(part, tuple) or (part is not None and not part.has_block and id(part) not in path):
            if isinstance(part, tuple) or not part.cut:
                run.append(part)
        else:
            if run:
                out.append(run)
                run = []
            if part is not None and not part.cut:
                out.append([part])
    return out


def run_density(run: list, share: float) -> float:
    if len(run) == 1 and isinstance(run[0], Node):
        return run[0].density
    c = t = lc = lt = 0
    for x in run:
        if isinstance(x, tuple):
            n = len("".join(x[0].split()))
            c, lc = c + n, lc + n * x[1]
        else:
            c, t, lc, lt = c + x.chars, t + x.tags + 1, lc + x.link_chars, lt + x.link_tags + (x.tag == "a")
    return density(c, t, lc, lt, share)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(BREAK.sub(" ", page))
    cut_suspects(root)
    order = measure(root)
    if not root.chars:
        return ""
    best = max(order, key=lambda n: n.total)
    path, up, unit = [], best, best
    while up is not None:
        path.append(up)
        if up.tag in ("article", "main") and unit.tag != "article":
            unit = up
        up = up.parent
    threshold = min(n.density for n in path)
    share = root.link_chars / root.chars
    inner = {id(n) for n in path[path.index(unit) + 1 :]}
    on_path = inner | {id(unit)}
    out, stack = [], [[root]]
    while stack:
        run = stack.pop()
        node = run[0]
        if len(run) == 1 and not isinstance(node, tuple) and id(node) in inner:
            stack.extend(reversed(units(node, on_path)))
        elif node is unit or run_density(run, share) >= threshold:
            out += blocks(run)
    return "\n".join(out)


BREAK = re.compile(r"<br\s*/?>", re.I)


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``text`` and ``n_chars``."""
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            step = 256
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                texts = [main_text(p.as_py()) for p in part.column(len(keep))]
                columns = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*keep, "text", "n_chars"])

    return pages.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{html_col}`").alias("__html")).mapInArrow(run, schema)


def op2(spark, sf_dir):
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), keep=["page_id", "url"])
