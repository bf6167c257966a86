"""A small HTML reader for tasks: tags with implied ends to blocks of text in page order."""

from __future__ import annotations

import html as entities
import re

START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
NAME = r"<(/?)([a-zA-Z][^\s/>]*+)"
#: A tag whose quoted values may hold ">", and one that ends at its first ">".
QUOTED = re.compile(NAME + r"((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)>")
PLAIN = re.compile(NAME + "([^>]*+)>")
NUMBER = re.compile(r"&#0*+(\d*+)")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
CLOSES = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table tbody thead tfoot"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}


def attributes(text: str) -> dict[str, str]:
    """First value of each attribute, names in lower case, character references decoded."""
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), decode(a or b or c))
    return found


def decode(text: str) -> str:
    """Character references resolved; numbers of any length."""
    if "&#" in text:  # int() refuses very long ones; eight digits are beyond all code points already
        text = NUMBER.sub(lambda m: f"&#{m[1][:8] or '0'}", text)
    return entities.unescape(text) if "&" in text else text


class Reader:
    """Walks a page and calls start(tag, attrs), end(tag), text(chunk) with implied ends filled in.

    Comments, declarations and the content of scripts and the like are skipped; a tag
    that the page breaks off in is no text. ``path`` holds the open tags. The page is
    scanned forward once, however malformed: where a tag has no end if its quotes count,
    quotes count no more from there on, and tags end at their first ">".
    """

    def __init__(self):
        self.path: list[str] = []
        self.open: dict[str, list[int]] = {}  # places in the path of each tag

    def start(self, tag, attrs):
        pass

    def end(self, tag):
        pass

    def text(self, chunk):
        pass

    def _innermost(self, names) -> int:
        return max((self.open[n][-1] for n in names if self.open.get(n)), default=-1)

    def _pop(self):
        tag = self.path.pop()
        self.open[tag].pop()
        self.end(tag)

    def _pop_to(self, names, until=frozenset()):
        """Closes the innermost of names and all within it, unless an ``until`` tag lies between."""
        i = self._innermost(names)
        if i > self._innermost(until):
            while len(self.path) > i:
                self._pop()

    def read(self, html: str) -> None:
        at, size, tag_at = 0, len(html), QUOTED
        is_open = lambda tag: bool(self.open.get(tag))
        while at < size:
            begin = START.search(html, at)
            if begin is None:
                self.text(html[at:])
                break
            if begin.start() > at:
                self.text(html[at : begin.start()])
            if begin[0] in ("<!--", "<!", "<?"):
                end = "-->" if begin[0] == "<!--" else ">"
                at = html.find(end, begin.end())
                at = size if at < 0 else at + len(end)
                continue
            m = tag_at.match(html, begin.start())
            if m is None and tag_at is QUOTED:
                tag_at = PLAIN
                m = PLAIN.match(html, begin.start())
            if m is None:
                break
            at = m.end()
            tag = m[2].lower()
            if m[1]:
                self._pop_to({tag})
                continue
            if is_open("head") and tag not in HEAD_ONLY and tag != "head":
                self._pop_to({"head"})
            if tag in BLOCK and is_open("p"):
                self._pop_to({"p"}, frozenset({"button", "object"}))
            if tag in CLOSES:
                self._pop_to(*CLOSES[tag])
            self.start(tag, m[3])
            if tag in VOID:
                self.end(tag)
                continue
            if tag in RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                at = stop.start() if stop else size
                at = html.find(">", at) + 1 or size
                self.end(tag)
                continue
            self.open.setdefault(tag, []).append(len(self.path))
            self.path.append(tag)
        while self.path:
            self._pop()
