"""A forgiving reader of HTML: elements and texts as flat lists, in page order."""

from __future__ import annotations

import re
from html import unescape

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header"
    " hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: what a start tag ends if it is open, and the elements that such an end never reaches across
_CELLS = frozenset("td th".split())
_ROWS = frozenset("tr td th".split())
_GROUPS = frozenset("thead tbody tfoot tr td th caption colgroup".split())
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
    "td": (_CELLS, frozenset("tr table".split())),
    "th": (_CELLS, frozenset("tr table".split())),
    "tr": (_ROWS, frozenset("thead tbody tfoot table".split())),
    "thead": (_GROUPS, frozenset(["table"])),
    "tbody": (_GROUPS, frozenset(["table"])),
    "tfoot": (_GROUPS, frozenset(["table"])),
}
CLOSES_P = BLOCK - frozenset("body br caption head html legend optgroup option tbody td tfoot th thead title tr".split())
P_SCOPE = frozenset("table td th caption button object template html".split())
SCOPE = frozenset("table td th caption object template html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)>|[!?/][^>]*+>)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")


def attributes(source: str) -> dict[str, str]:
    """Names, in lower case, and decoded values; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        name = (m[1] or m[5]).lower()
        if name not in found:
            found[name] = unescape(m[2] or m[3] or m[4] or "")
    return found


class Page:
    """Element ``i`` has a name, the source of its attributes and a parent of a smaller number; 0 is the page.

    ``texts`` are (element, decoded text) and (-1, "") at each border of a block, in page order.
    """

    def __init__(self, html: str):
        self.names, self.sources, self.parents = ["html"], [""], [-1]
        self.texts: list[tuple[int, str]] = []
        self._open, self._counts = [0], {"html": 1}
        self._read(html)

    def _push(self, name: str, source: str) -> int:
        self.names.append(name)
        self.sources.append(source)
        self.parents.append(self._open[-1])
        return len(self.names) - 1

    def _pop_to(self, depth: int) -> None:
        for i in self._open[depth:]:
            self._counts[self.names[i]] -= 1
        del self._open[depth:]

    def _close(self, names: frozenset[str], barrier: frozenset[str]) -> None:
        """End the outermost open element of ``names`` above the innermost of ``barrier``."""
        if not any(self._counts.get(n) for n in names):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            name = self.names[self._open[depth]]
            if name in names:
                self._pop_to(depth)
                if len(names) == 1 or not any(self._counts.get(n) for n in names):
                    return
            elif name in barrier:
                return

    def _start(self, name: str, source: str) -> None:
        if name in ("html", "body") and self._counts.get(name):
            return
        if self._counts.get("head") and name not in IN_HEAD:
            self._close(frozenset(["head"]), frozenset())
        if name in CLOSES_P:
            self._close(frozenset(["p"]), P_SCOPE)
        if name in ENDS:
            self._close(*ENDS[name])
        elif name in HEADINGS and self.names[self._open[-1]] in HEADINGS:
            self._pop_to(len(self._open) - 1)
        i = self._push(name, source)
        if name not in VOID:
            self._open.append(i)
            self._counts[name] = self._counts.get(name, 0) + 1

    def _end(self, name: str) -> None:
        if name in ("html", "body") or not self._counts.get(name):
            return
        wanted = HEADINGS if name in HEADINGS else (name,)
        inline = name not in BLOCK
        for depth in range(len(self._open) - 1, 0, -1):
            own = self.names[self._open[depth]]
            if own in wanted:
                return self._pop_to(depth)
            if own in SCOPE and name not in _GROUPS and name != "table" or inline and own in BLOCK:
                return

    def _text(self, text: str) -> None:
        if text:
            if self._counts.get("head") and self.names[self._open[-1]] == "head" and not text.isspace():
                self._close(frozenset(["head"]), frozenset())
            self.texts.append((self._open[-1], unescape(text) if "&" in text else text))

    def _read(self, html: str) -> None:
        at, size, last = 0, len(html), html.rfind(">")
        while at < size:
            mark = html.find("<", at)
            m = _TAG.match(html, mark) if 0 <= mark else None
            while m is None and 0 <= mark and (mark < last or not html[mark + 1 : mark + 2].isalpha()):
                mark = html.find("<", mark + 1)  # no tag begins here: text
                m = _TAG.match(html, mark) if 0 <= mark else None
            self._text(html[at : mark if mark >= 0 else size])
            if m is None:
                return  # the end, or a tag that never ends
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if name in BLOCK:
                self.texts.append((-1, ""))
            if m[1]:
                self._end(name)
                continue
            self._start(name, m[3])
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                self._text(html[at : end.start() if end else size])
                at = end.start() if end else size
