"""Elements, text runs and node features of an HTML page."""

import re
from bisect import bisect_right
from html import unescape

import numpy as np

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_SPECIAL = re.compile(r"""[>"']""")
_COMMENT_END = re.compile(r"--!?>")
_NAMES = re.compile(
    r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I
)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_MARKS = re.compile(r"[.,;:!?]")

# Fixed values of HTML: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre section select summary svg table tbody td tfoot th thead tr ul "
    "video audio object canvas".split()
)
#: Elements whose start ends an open one of the listed, up to the given container.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
#: Never article text.
DROPPED = frozenset("button select option svg video audio object canvas head".split())

#: Words of class, id and role names of boilerplate and of article containers.
AGAINST = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising alert aside banner breadcrumb "
    "breadcrumbs comment commentlist comments complementary consent contentinfo cookie cookies "
    "copyright dialog discussion disqus dropdown foot footer form gdpr header legal login masthead "
    "menu modal nav navbar navigation newsletter notice notification outbrain overlay pager "
    "pagination popular popup promo promoted promotion rail recommended register related replies "
    "reply respond search share sharing side sidebar signin signup similar skip social sponsor "
    "sponsored subscribe taboola teaser toolbar topbar trending widget".split()
)
FOR = frozenset(
    "article articlebody blogpost body content entry hentry main maincontent maintext post prose "
    "story text".split()
)
KINDS = (
    {"article", "main"}, {"nav", "menu"}, {"footer"}, {"header"}, {"aside"},
    {"form", "fieldset", "legend", "dialog"}, {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"},
    {"li", "dt", "dd"}, {"ul", "ol", "dl", "dir"}, {"table", "tbody", "tr", "td", "th", "thead"},
    {"div", "section", "center"}, {"pre", "blockquote", "figure", "figcaption"}, {"html", "body"},
)
_KIND = {tag: k for k, tags in enumerate(KINDS) for tag in tags}
INLINE = len(KINDS)
#: Kinds for which it counts whether a node stands inside one.
INSIDE = (0, 1, 2, 3, 4, 5, 9, 11)
WIDTH = 21 + len(KINDS) + 1 + len(INSIDE)


class _Tags:
    """Tags and comments of a page, in one pass: however broken the page is, no part of
    it is looked at more than a few times."""

    def __init__(self, html):
        self.html, self.last = html, html.rfind(">")
        # From where the next special character was found, and quotes that open a value
        # without an end to the tag after them.
        self.known, self.dead = (0, -1), set()

    def next(self, at):
        """(start, end, closing, name, attributes) of the first tag from a position; the
        name is empty for comments and the like; None if there is no further one."""
        html = self.html
        start = html.find("<", at)
        while start >= 0:
            if html.startswith("<!--", start):
                end = _COMMENT_END.search(html, start + 4)
                return start, end.end() if end else len(html), "", "", ""
            if start > self.last:  # only a comment without an end can follow
                start = html.find("<!--", start)
                continue
            found = _NAME.match(html, start + 1)
            if found:
                end = self._end(found.end())
                if end < 0:  # quotes that do not match: up to the next end of any tag
                    end = html.find(">", found.end()) + 1
                if end > 0:
                    return start, end, found[1], found[2].lower(), html[found.end() : end - 1]
            elif html[start + 1 : start + 2] in ("!", "?", "/"):
                return start, html.find(">", start + 2) + 1 or len(html), "", "", ""
            start = html.find("<", start + 1)
        return None

    def _special(self, at):
        found = _SPECIAL.search(self.html, at)
        return found.start() if found else len(self.html)

    def _end(self, at):
        """Behind the > that ends a tag, quoted values left out; -1 if there is none."""
        html, opened = self.html, []
        if not self.known[0] <= at <= self.known[1]:
            self.known = (at, self._special(at))
        place = self.known[1]
        while place < len(html) and place not in self.dead:
            if html[place] == ">":
                return place + 1
            opened.append(place)
            close = html.find(html[place], place + 1)
            if close < 0:
                break
            place = self._special(close + 1)
        self.dead.update(opened)
        return -1


class _Open:
    """The open elements (name, node, inside a link), with their depths by name."""

    def __init__(self):
        self.elements = [("#page", 0, False)]
        self.depths, self.blocks = {}, []

    def push(self, name, node, linked):
        self.depths.setdefault(name, []).append(len(self.elements))
        if name in BLOCK and name != "p":
            self.blocks.append(len(self.elements))
        self.elements.append((name, node, linked))

    def cut(self, depth):
        while len(self.elements) > depth:
            self.depths[self.elements.pop()[0]].pop()
            if self.blocks and self.blocks[-1] == len(self.elements):
                self.blocks.pop()

    def _last(self, name):
        return (self.depths.get(name) or [0])[-1]

    def _block(self):
        return self.blocks[-1] if self.blocks else 0

    def closed_by(self, name):
        """Depth of the open element that an end tag closes, 0 if none. Inline
        elements and paragraphs do not reach out of the block around them."""
        depth = self._last(name)
        inner = name == "p" or name not in BLOCK
        return 0 if inner and depth < self._block() else depth

    def end_implied(self, name):
        """End what the start of a block ends: an open paragraph, and its like."""
        paragraph = self._last("p")
        if paragraph > self._block():
            self.cut(paragraph)
        if name in IMPLIED_END:
            ended, limit = IMPLIED_END[name]
            outer = max(self._last(other) for other in limit)
            found = []
            for other in ended:
                depths = self.depths.get(other, ())
                found += depths[bisect_right(depths, outer) :][:1]
            if found:
                self.cut(min(found))


class Page:
    """Nodes (block elements, and inline ones with a class, id or role) by number in
    page order; node 0 stands for the page. Runs are (node, block, text, in a link)."""

    def __init__(self, html):
        self.parent, self.tag, self.names, self.runs = [0], ["html"], [()], []
        tags, still_open = _Tags(html), _Open()
        block = at = 0
        lower = None
        while (found := tags.next(at)) is not None:
            start, end, closing, name, attributes = found
            if start > at:
                self._text(html[at:start], still_open.elements[-1], block)
            at = end
            if not name:
                continue
            if closing:
                depth = still_open.closed_by(name)
                if depth:
                    still_open.cut(depth)
                    block += name in BLOCK
                continue
            if name == "br":
                self._text(" ", still_open.elements[-1], block)
                continue
            if name in RAW:
                if lower is None:
                    lower = html.lower() if len(html.lower()) == len(html) else html
                end = lower.find(f"</{name}", at)
                close = html.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else len(html)
                continue
            if name in BLOCK:
                block += 1
                still_open.end_implied(name)
            if name in VOID:
                continue
            _, node, linked = still_open.elements[-1]
            names = ()
            if "=" in attributes:
                names = tuple(
                    part.lower()
                    for m in _NAMES.finditer(attributes)
                    for part in _PART.findall(m[1] or m[2] or m[3] or "")
                )
            if name in BLOCK or names:
                self.parent.append(node)
                node = len(self.tag)
                self.tag.append(name)
                self.names.append(names)
            still_open.push(name, node, linked or name == "a")
        if at < len(html):
            self._text(html[at:], still_open.elements[-1], block)

    def _text(self, text, top, block):
        if "&" in text:
            text = unescape(text)
        self.runs.append((top[1], block, text, top[2]))

    def features(self):
        """One row per node; see the names below."""
        n = len(self.tag)
        parent = np.array(self.parent)
        own, linked, marks, first = (np.zeros(n) for _ in range(4))
        seen = 0.0
        first[:] = -1
        for node, _, text, in_link in self.runs:
            size = len(text) if not text.isspace() else 0
            if size:
                if first[node] < 0:
                    first[node] = seen
                own[node] += size
                if in_link:
                    linked[node] += size
                marks[node] += len(_MARKS.findall(text))
                seen += size
        kind = np.array([_KIND.get(t, INLINE) for t in self.tag])
        against = np.array([sum(p in AGAINST for p in names) for names in self.names], float)
        in_favour = np.array([sum(p in FOR for p in names) for names in self.names], float)
        paragraphs = ((kind == 6) & (own > 0)).astype(float)
        total, total_links, total_marks = own.copy(), linked.copy(), marks.copy()
        nodes, children, order = np.ones(n), np.zeros(n), np.zeros(n)
        depth, above_against, above_for = np.zeros(n), np.zeros(n), np.zeros(n)
        inside = np.zeros((n, len(KINDS) + 1))
        for i in range(1, n):  # parents come before their children
            p = parent[i]
            depth[i] = depth[p] + 1
            order[i] = children[p]
            children[p] += 1
            above_against[i] = above_against[p] + against[p]
            above_for[i] = above_for[p] + in_favour[p]
            inside[i] = inside[p]
            inside[i, kind[p]] += p > 0
        for i in range(n - 1, 0, -1):
            p = parent[i]
            for sums in (total, total_links, total_marks, nodes, paragraphs):
                sums[p] += sums[i]
            if first[i] >= 0 and (first[p] < 0 or first[i] < first[p]):
                first[p] = first[i]
        page = max(1.0, total[0])
        chars = np.maximum(total, 1)
        siblings = np.maximum(children[parent], 1)
        of_parent = np.maximum(total[parent], 1)
        out = np.zeros((n, WIDTH), np.float32)
        columns = (
            depth,
            np.log1p(total),
            total / page,
            total_links / chars,
            np.log1p(nodes),
            np.log1p(total / nodes),  # subtree text density
            np.log1p(paragraphs),
            100 * total_marks / chars,
            order / siblings,
            np.log1p(siblings),
            total / of_parent,
            np.log1p((of_parent - total) / siblings),  # mean text of the siblings
            np.maximum(first, 0) / page,
            against,
            in_favour,
            above_against,
            above_for,
            np.log1p(own),
            own / chars,
            (total < 25).astype(float),
            (above_against + against > 0).astype(float),
        )
        for k, column in enumerate(columns):
            out[:, k] = column
        base = len(columns)
        out[np.arange(n), base + kind] = 1
        out[:, base + len(KINDS) + 1 :] = inside[:, INSIDE] > 0
        return out

    def text(self, kept):
        """Text of the kept nodes: white space in a block as one space, blocks joined
        by an empty line."""
        blocks, held, last = [], [], None
        for node, block, text, _ in self.runs:
            if not kept[node]:
                continue
            if block != last:
                blocks.append("".join(held))
                held, last = [], block
            held.append(text)
        blocks.append("".join(held))
        clean = (" ".join(b.split()) for b in blocks)
        return "\n\n".join(b for b in clean if b)

    def decode(self, score):
        """Which nodes are kept: of all choices in which a kept node's ancestors are
        kept, the one with the largest sum of scores."""
        n = len(self.tag)
        gain = np.array(score, float)
        for i, tag in enumerate(self.tag):
            if tag in DROPPED:
                gain[i] = -np.inf
        gain[0] = 0
        for i in range(n - 1, 0, -1):
            if gain[i] > 0:
                gain[self.parent[i]] += gain[i]
        kept = np.zeros(n, bool)
        kept[0] = True
        for i in range(1, n):
            kept[i] = kept[self.parent[i]] and gain[i] > 0
        return kept
