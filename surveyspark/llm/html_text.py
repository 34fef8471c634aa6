"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, less with each
level; a container's points are discounted by its share of link text. The best container
is kept, or the article or main element around it, with siblings that score well enough
or are articles, too.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts and reader comments
are cut from the tree before.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from surveyspark.llm import words as W

#: Elements of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
CUT = frozenset(
    "head title script style noscript template iframe object svg canvas audio video nav footer aside "
    "button select textarea input option menu dialog search".split())
CUT_ROLES = frozenset("navigation contentinfo complementary search alert alertdialog dialog menu "
                      "menubar toolbar".split())
#: elements and roles that are cut unless the page's text is inside them
FORMS, HEADERS = frozenset("form fieldset".split()), frozenset("header banner".split())
CUT_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer ad ads adbox adslot advert adverts "
    "advertisement advertising sponsor sponsored cookie cookies consent gdpr comment comments commentlist "
    "replies respond disqus newsletter subscribe signup login pagination pager".split())
DOUBTFUL_NAMES = frozenset(
    "header banner notice alert promo related recommended share sharing social popup modal overlay widget "
    "toolbar masthead teaser outbrain aside skip".split())
#: words that a name of such a part may hold besides; any other word makes it a name of the text's own
BESIDES = frozenset(
    "box bar block container wrapper wrap inner outer area section list links link buttons button icons icon "
    "item items content main site page post posts article articles entry top bottom left right primary "
    "secondary global mobile desktop law info warning form user users title body text col column row group "
    "panel media wp my the".split())
KEEP = frozenset("html body main".split())
#: whole class names and ids that a wrapper around the page's text does not have
READERS = frozenset("comment comments commentlist replies respond disqus".split())
#: an open element that a start tag ends, and how far up it is looked for
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"})}
_WORDS, _CAMEL, _DIGIT = re.compile(r"[^a-z0-9]+"), re.compile(r"(?<=[a-z])(?=[A-Z])"), re.compile(r"[0-9]")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("tag", "parent", "inside", "names", "readers", "role", "hidden", "points", "chars", "linked")

    def __init__(self, tag: str, parent: "Node | None", attrs: dict):
        self.tag, self.parent, self.inside = tag, parent, []
        text = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        self.names = [frozenset(_WORDS.split(_CAMEL.sub(" ", name).lower())) for name in text.split()]
        self.readers = not READERS.isdisjoint(text.lower().split())
        self.role = (attrs.get("role") or "").lower()
        style = (attrs.get("style") or "").replace(" ", "").lower()
        self.hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style
        self.points, self.chars, self.linked = 0.0, 0, 0


class Tree(HTMLParser):
    """A tree of elements from any markup, with the end tags that HTML lets one leave out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None, {})

    def _close(self, tags, stop) -> None:
        node = self.at
        while node is not self.root and node.tag not in stop:
            if node.tag in tags:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self.at is self.root:
            return
        if tag in BLOCK:
            self._close({"p"}, {"table", "td", "th", "button", "object", "caption"})
        if tag in HEADINGS and self.at.tag in HEADINGS:
            self.at = self.at.parent
        if tag in _ENDS:
            self._close(*_ENDS[tag])
        node = Node(tag, self.at, dict(attrs))
        self.at.inside.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("p", "br", "script", "style"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        node = self.at
        while node is not self.root and node.tag != tag:
            if tag not in BLOCK and node.tag in BLOCK:
                return  # an inline end tag ends nothing outside its block
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_data(self, data):
        self.at.inside.append(data)


def _walk(root: Node):
    """Nodes and texts in page order, with (node, False) when a node ends."""
    stack: list = [iter([root])]
    path: list[Node] = []
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
            if path:
                yield path.pop(), False
            continue
        if isinstance(item, str):
            yield item, True
        else:
            yield item, True
            path.append(item)
            stack.append(iter(item.inside))


def _measure(root: Node) -> None:
    """chars and linked (text in links) of every node."""
    links = 0
    for item, opening in _walk(root):
        if isinstance(item, str):
            continue
        if opening:
            links += item.tag == "a"
            item.chars = item.linked = 0
        else:
            own = sum(len(x.strip()) for x in item.inside if isinstance(x, str))
            item.chars += own
            item.linked += own if links else 0
            links -= item.tag == "a"
            if item.parent is not None:
                item.parent.chars += item.chars
                item.parent.linked += item.linked


def _named(node: Node, words: frozenset, whole: bool = True) -> bool:
    """Whether a class name or the id is made of such words; not `whole`: holds one of them."""
    for name in node.names:
        if not words.isdisjoint(name) and (not whole or all(
                w in CUT_NAMES or w in DOUBTFUL_NAMES or w in BESIDES or not w or _DIGIT.search(w) for w in name)):
            return True
    return False


def _holders(root: Node) -> tuple[set[int], set[int]]:
    """Nodes around the largest article and main element by unlinked text, and those inside."""
    around, inside = set(), set()
    found = [x for x, opening in _walk(root) if opening and not isinstance(x, str)
             and x.tag in ("article", "main") and x.chars > x.linked and not _named(x, CUT_NAMES)]
    for tag in ("article", "main"):
        best = max((x for x in found if x.tag == tag), key=lambda x: x.chars - x.linked, default=None)
        if best is not None:
            inside.update(id(x) for x, opening in _walk(best) if opening and not isinstance(x, str))
            while best is not None:
                around.add(id(best))
                best = best.parent
    return around, inside


def _filter(root: Node, cut) -> None:
    """Takes every element that `cut` names out of the tree."""
    stack = [root]
    while stack:
        node = stack.pop()
        node.inside = [x for x in node.inside if isinstance(x, str) or not cut(x)]
        stack += [x for x in node.inside if not isinstance(x, str)]


def _prune(root: Node) -> None:
    """Cuts everything that is not part of a page's text.

    Some elements go at once. Forms, headers and elements with the names of such parts
    stay if they are around the page's article or main element; forms and names also if
    they have half of the page's unlinked text, unless the article is elsewhere or the
    name is that of comments. Inside the article, and on pages without one, a name has to
    consist of such words; elsewhere it is enough that it holds one.
    """
    _filter(root, lambda x: x.tag in CUT or x.hidden or x.role in CUT_ROLES)
    _measure(root)
    around, inside = _holders(root)
    half = (root.chars - root.linked) / 2

    def cut(x: Node) -> bool:
        if id(x) in around:
            return False
        if x.tag in HEADERS or x.role in HEADERS:
            return True
        small = x.chars - x.linked < half or not half
        beside = bool(inside) and id(x) not in inside
        if (x.tag in FORMS or x.role in FORMS) and (small or beside):
            return True
        if x.tag in KEEP or not x.names:
            return False
        return (_named(x, CUT_NAMES, not beside) and (x.readers or small or beside)
                or _named(x, DOUBTFUL_NAMES, not beside) and small)

    _filter(root, cut)


def _paragraphs(root: Node):
    """Blocks with text of their own: the block's node, its text."""
    texts: dict[int, list] = {}
    blocks: list[Node] = [root]
    for item, opening in _walk(root):
        if isinstance(item, str):
            texts.setdefault(id(blocks[-1]), [blocks[-1]]).append(item)
        elif item.tag in BLOCK:
            if opening:
                blocks.append(item)
            else:
                blocks.pop()
    for node, *parts in texts.values():
        text = " ".join("".join(parts).split())
        if text:
            yield node, text


def _score(root: Node) -> list[Node]:
    """Gives containers their points; returns those that have any."""
    found: dict[int, Node] = {}
    for node, text in _paragraphs(root):
        if node.tag in HEADINGS or (node.chars and node.linked > 0.5 * node.chars):
            continue
        points = 1 + text.count(",") + len(text) / 100
        holder = node.parent if node.tag in ("p", "pre", "blockquote", "li", "td", "dd") and node.parent else node
        level = 0
        while holder is not None and level < 5:
            holder.points += points / (1, 2, 4, 8, 16)[level]
            found[id(holder)] = holder
            holder, level = holder.parent, level + 1
    for node in found.values():
        node.points *= 1 - (node.linked / node.chars if node.chars else 0)
    return list(found.values())


def _keep(best: Node) -> list[Node]:
    """The best container, as wide as its article, and the siblings that belong to it.

    Beside an article these are the other articles, and the headings before the first
    one if it has no heading of its own.
    """
    around, node = {}, best
    while node is not None:
        around[node.tag] = node  # the outermost of each tag
        node = node.parent
    best = around.get("article") or around.get("main") or best
    if best.parent is None or best.tag == "main":
        return [best]
    out = []
    for x in best.parent.inside:
        if isinstance(x, str):
            continue
        dense = x.chars > 0 and x.linked > 0.3 * x.chars
        if best.tag == "article":
            if x is best or (x.tag == "article" and not dense) or (x.tag in HEADINGS and not any(
                    n.tag == "article" for n in out)):
                out.append(x)
        elif x is best or (not dense and (x.points >= max(0.2 * best.points, 3) or x.tag in HEADINGS
                                          or (x.tag in ("p", "pre", "blockquote") and x.chars > 0))):
            out.append(x)
    first = next((n for n in out if n.tag == "article"), None)
    if first is not None and any(not isinstance(x, str) and x.tag in HEADINGS for x, _ in _walk(first)):
        out = [n for n in out if n.tag not in HEADINGS]
    return out


def _blocks(node: Node) -> list[str]:
    """Texts of a subtree's blocks in page order; lists and tables of links are left out."""
    out, now, skip = [], [], None
    for item, opening in _walk(node):
        if skip is not None:
            skip = None if item is skip and not opening else skip
            continue
        if isinstance(item, str):
            now.append(item)
            continue
        if opening and item.tag in ("ul", "ol", "dl", "div", "table") and item.chars and item.linked > 0.6 * item.chars:
            skip = item
            continue
        if item.tag == "br" and opening:
            now.append(" ")
        elif item.tag in BLOCK:
            out.append(" ".join("".join(now).split()))
            now = []
    out.append(" ".join("".join(now).split()))
    return [x for x in out if x]


def main_text(html: str | None) -> str:
    """The main text of a page, blocks joined by one space; empty where there is none."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    root = tree.root
    _prune(root)
    _measure(root)
    scored = _score(root)
    if not scored:
        return " ".join(_blocks(root))
    best = max(scored, key=lambda n: n.points)
    return " ".join(block for node in _keep(best) for block in _blocks(node))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page.

    A null or empty html gives an empty text; markup that is cut off or badly nested is
    read as far as it goes. Each page is handled by itself, whole.
    """
    def rows(batches):
        for batch in W.slices(batches, 64):
            text = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInArrow(
        rows, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
