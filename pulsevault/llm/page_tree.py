"""A small tolerant HTML reader: pages to trees of blocks (used inside tasks)."""

from __future__ import annotations

import html
import re
from collections import Counter

#: A quote opens a value only behind an equals sign; elsewhere it is a character like others.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z)", re.S)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=]|$)|aria-hidden\s*=\s*[\"']?true)", re.I)
_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split())
#: An open element of the value ends where the key starts.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
_SCOPE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
          "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}
#: Elements that are never main text.
OUTSIDE = frozenset(
    "script style noscript template nav header footer aside form button select option textarea iframe object svg canvas math "
    "audio video map dialog menu head title noembed noframes xmp input label datalist".split())
#: Words of class, id and role that mark a part as not being main text.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent cookie "
    "cookies disqus discussion feedback footer form gdpr login masthead menu modal nav navbar navigation navigationbar newsletter notice notification "
    "overlay pager pagination paywall popup promo promoted promotion recommended related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets contentinfo".split())
#: Words that mark the main text.
MAIN_WORDS = frozenset("article articlebody main".split())


class Node:
    """A block element (``text`` None) or a run of text inside one."""

    __slots__ = ("label", "children", "text", "outside", "main", "link")

    def __init__(self, label: str, text: str | None = None, outside: bool = False, main: bool = False, link: bool = False):
        self.label, self.children, self.text, self.outside, self.main, self.link = label, [], text, outside, main, link


def _says(attributes: str) -> tuple[bool, bool, bool, str]:
    """What class, id and role say: not main text, main text, a header; and the first word (for the label).
    A name like 'article-footer' means its last word, one like 'comment-list' any of its words."""
    outside = main = header = False
    first = ""
    for found in _MARKS.findall(attributes):
        for name in (found[0] or found[1] or found[2]).split():
            words = [w.lower() for w in _PART.findall(name)]
            if words:
                first = first or words[0]
                is_main = words[-1] in MAIN_WORDS
                outside |= not is_main and not OUTSIDE_WORDS.isdisjoint(words)
                main |= is_main
                header |= words[-1] == "header"
    return outside, main, header, first


def parse(page: str) -> Node:
    """The tree of the page's blocks. Inline elements vanish, except that a text remembers whether all of it
    is link text. Unclosed elements end with their parent, a block start ends an open paragraph. An inline element
    that is never main text (noscript, button ...) counts as a block once a block starts inside it."""
    root = Node("#root")
    stack: list[tuple[str, Node]] = [("#root", root)]
    depth = Counter(["#root"])  # open elements by name
    text: list[str] = []
    plain = False  # whether the current run has text outside links
    links = skipped = 0  # open links; depth of inline elements that are not main text
    inline: list[str] = []

    def flush():
        nonlocal text, plain
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                top = stack[-1][1]
                top.children.append(Node("#text", words, top.outside, top.main, not plain))
        text, plain = [], False

    def opened(name: str, node: Node):
        stack[-1][1].children.append(node)
        stack.append((name, node))
        depth[name] += 1

    def closed(until: int):
        """Close elements until so many are open."""
        while len(stack) > until:
            depth[stack.pop()[0]] -= 1

    def closed_with(name: str):
        while stack[-1][0] != name:
            closed(len(stack) - 1)
        closed(len(stack) - 1)

    def add(data: str):
        nonlocal plain
        if data and not skipped:
            text.append(data)
            if not links and not data.isspace():
                plain = True

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name in BLOCK:
                if depth[name]:
                    flush()
                    closed_with(name)
                    links, skipped, inline = 0, 0, []
                elif name == "p":
                    flush()
            elif name == "br":
                add(" ")
            elif name not in inline and depth[name]:
                flush()
                closed_with(name)
                links, skipped, inline = 0, 0, []
            elif name in inline:
                while inline:
                    e = inline.pop()
                    links -= e == "a" and links > 0
                    skipped -= e in OUTSIDE and skipped > 0
                    if e == name:
                        break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name == "br" or name == "wbr":
            if name == "br":
                add(" ")
            continue
        if name not in BLOCK:
            if name not in VOID and not m[3].rstrip().endswith("/"):
                inline.append(name)
                links += name == "a"
                skipped += name in OUTSIDE
            continue
        flush()
        around = [e for e in inline if e in OUTSIDE]
        links, skipped, inline = 0, 0, []
        if name != "option" and depth["p"]:
            closed_with("p")
        if around:
            opened(around[0], Node(around[0], None, True, stack[-1][1].main))
        if name in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in _SCOPE[name]:
                    break
                if stack[i][0] in CLOSES[name]:
                    closed(i)
                    break
        if name == "hr":
            continue
        says_outside, says_main, says_header, first = _says(m[3]) if m[3] else (False, False, False, "")
        parent = stack[-1][1]
        main = parent.main or name in ("article", "main") or says_main
        own = name in OUTSIDE or says_outside and name not in ("html", "body", "main") or says_header
        if (name == "header" or says_header) and parent.main and not says_outside:
            own = False  # an article's own header holds its headline
        if m[3] and _HIDDEN.search(m[3]):
            own = True
        opened(name, Node(f"{name}.{first}" if first else name, None, parent.outside or own, main))
    flush()
    return root


def texts(root: Node) -> list[Node]:
    """The text runs in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.text is not None:
            out.append(node)
        else:
            todo.extend(reversed(node.children))
    return out
