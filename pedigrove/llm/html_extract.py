"""HTML extraction by tree scoring.

Paragraphs pass points to the elements around them; what is marked as being beside an
article (by its tag, role or names) passes none, unless it is or holds the article. The best container
and its siblings are kept, less the lists of links in them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import in_batches
from ._html import BLOCK, Reader, attributes, decode

#: Elements without text of the page.
DROPPED = frozenset("script style noscript template head title button input select textarea iframe object embed svg canvas dialog audio video math".split())
#: Elements, roles and words of class and id names that mark what is beside an article.
MARKED = frozenset("nav header footer aside form menu".split())
#: Of these, what holds no article unless an article or main element in it says so.
FIRM_TAGS = frozenset("nav footer aside menu".split())
MARKED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
COMMENTS = frozenset("comment comments disqus remark replies responses".split())
NAMES = COMMENTS | frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs consent cookie cookies donate footer gdpr header hidden login masthead menu modal nav "
    "navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar tooltip topbar widget widgets".split()
)
#: Words that names of an article's own parts have too (related-work, widget-container): as a part of a name they mark no prose.
UNSURE = frozenset("banner header hidden promotion related remark replies responses social widget widgets".split())
#: A name that begins or ends so tells a state (has-sidebar, comments-open), not what the element is.
STATE_FIRST, STATE_LAST = frozenset("has no not with without".split()), frozenset("closed disabled enabled open".split())
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
LEAVES = frozenset("p pre h1 h2 h3 h4 h5 h6 li dt dd figcaption td th blockquote caption summary address".split())
HEADINGS = frozenset(("h1", "h2", "h3"))
#: Of a table's parts and headings, "header" and "footer" tell their place, not that they are around the article.
PLACED = frozenset("th td tr thead tbody tfoot caption h1 h2 h3 h4 h5 h6".split())
#: Headings of reader comments.
COMMENTED = re.compile(r"(\d+ |reader |user )*(comments?|replies|responses)( \(?\d+\)?)?|leave a (comment|reply).*", re.I)

#: Headings of lists that belong to an article, though all of their text may be linked.
SOURCES = re.compile(r"((works|literature) cited|references|sources|bibliography|citations|literature|foot ?notes|notes|notes and references|further reading)\W*", re.I)
#: A notice of cookies or rights, as it stands in elements that no name tells of.
NOTICE = re.compile(r"(?=.*\bcookies?\b)(?=.*\b(accept|agree|consent|continu\w+|decline|experience|preferences|privacy|uses?|using)\b).*|(©|\(c\)|copyright\b).*|.*\ball rights reserved\W*", re.I | re.S)
#: The end of a sentence, before quotes and brackets that close.
SENTENCE = re.compile(r"[.!?…。:;][\"'”’»)\]]*\Z")

#: Marks, weakest first: a word within a name that may be an article's; a word within a name; tag, role or whole name; firm tag; comments.
MAYBE, PART, WHOLE, FIRM, COMMENT = 1, 2, 3, 4, 5


def hidden(a: dict[str, str]) -> bool:
    if "hidden" in a or a.get("aria-hidden") == "true":
        return True
    return "style" in a and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a["style"], re.I) is not None


def mark(tag: str, a: dict[str, str]) -> int:
    """How an element is marked as being beside the article; 0: not."""
    found = FIRM if tag in FIRM_TAGS else WHOLE if tag in MARKED or a.get("role", "").lower() in MARKED_ROLES else 0
    if tag in ("html", "body", "main"):
        return found
    words = NAMES - {"header", "footer"} if tag in PLACED else NAMES
    for name in f"{a.get('class', '')} {a.get('id', '')}".split():
        parts = [x.lower() for x in NAME.findall(name)]
        hit = words.intersection(parts)
        if not hit or parts[0] in STATE_FIRST or parts[-1] in STATE_LAST:
            continue
        if hit & COMMENTS and (len(parts) == 1 or not hit <= UNSURE):
            found = COMMENT
        elif len(parts) == 1:
            found = max(found, WHOLE)
        else:
            found = max(found, MAYBE if hit <= UNSURE else PART)
    return found


class Tree(Reader):
    """nodes: parent, tag, mark, links; blocks: (node, text, characters in links), in page order."""

    def __init__(self):
        super().__init__()
        self.parent, self.tag, self.mark, self.count = [-1], ["#root"], [0], [0]
        self.blocks: list[tuple[int, str, int]] = []
        self.chunks: list[str] = []
        self.linked = self.links = self.off = 0
        self.at = 0  # innermost open block element

    def flush(self):
        if self.chunks:
            if text := " ".join("".join(self.chunks).split()):
                self.blocks.append((self.at, text, self.linked))
            self.chunks, self.linked = [], 0

    def start(self, tag, attrs):
        block = tag in BLOCK
        if block and not self.off:
            self.flush()
        a = attributes(attrs) if attrs and not self.off else {}
        if self.off or tag in DROPPED or a and hidden(a):
            self.off += 1
            return
        how = mark(tag, a) if a or tag in MARKED else 0
        if block:
            self.parent.append(self.at)
            self.tag.append(tag)
            self.mark.append(how)
            self.count.append(0)
            self.at = len(self.tag) - 1
        elif how >= WHOLE:  # within a line: no container of anything
            self.off += 1
        elif tag == "br":
            self.chunks.append(" ")
        elif tag == "a":
            self.links += 1
            self.count[self.at] += 1

    def end(self, tag):
        if self.off:
            self.off -= 1
            return
        if tag in BLOCK:
            self.flush()
            self.at = self.parent[self.at]
        elif tag == "a":
            self.links -= 1

    def text(self, chunk):
        if not self.off:
            chunk = decode(chunk)
            self.chunks.append(chunk)
            if self.links:
                self.linked += len(chunk.strip())


def main_text(html: str | None) -> str:
    """The article of a page, one line a block."""
    if not html:
        return ""
    tree = Tree()
    tree.read(html)
    tree.flush()
    parent, tag, marks, blocks = tree.parent, tree.tag, tree.mark, tree.blocks
    if not blocks:
        return ""
    n = len(parent)
    size, linked, links = [0] * n, [0] * n, list(tree.count)
    prose = [0] * n  # characters in blocks that end a sentence and are not links throughout
    first = [""] * n  # text of an element's first block, if that is a heading
    for node, text, inside in reversed(blocks):
        size[node] += len(text)
        linked[node] += min(inside, len(text))
        prose[node] += len(text) if inside < len(text) and SENTENCE.search(text[-9:]) else 0
        first[node] = text if tag[node] in HEADINGS or tag[node] == "h4" else ""
    for i in range(n - 1, 0, -1):  # a node comes after its parent
        size[parent[i]] += size[i]
        linked[parent[i]] += linked[i]
        prose[parent[i]] += prose[i]
        links[parent[i]] += links[i]
    began = set()
    for node, _, _ in blocks:  # the heading that an element's text begins with
        up = parent[node]
        while up > 0 and up not in began:
            began.add(up)
            first[up] = first[node]
            up = parent[up]
    plain = [a - b for a, b in zip(size, linked)]
    for i in range(1, n):
        if marks[i] == MAYBE and plain[i] >= 50 and linked[i] * 3 < size[i]:
            marks[i] = 0
        if tag[i] in ("section", "div") and first[i] and len(first[i]) < 60 and COMMENTED.fullmatch(first[i].strip(" :")):
            marks[i] = COMMENT

    def covered() -> list[int]:
        """The strongest mark of a node and of what is around it."""
        out = [0] * n
        for i in range(1, n):
            out[i] = max(out[parent[i]], marks[i])
        return out

    # The page's article, if an element says so: not one among comments, and rather one that nothing around marks.
    around = covered()
    free = sum(len(t) - min(k, len(t)) for i, t, k in blocks if not around[i])
    stated = [i for i in range(n) if tag[i] in ("article", "main") and plain[i] and (around[i] < COMMENT or not free)]
    chosen = max(stated, key=lambda i: (around[parent[i]] == 0, tag[i] == "article", plain[i], -i), default=0)
    up = chosen
    while up > 0:
        marks[up] = 0
        up = parent[up]
    # What holds most of the article (or of a page without one) is not beside it.
    inner = [False] * n
    for i in range(n):
        inner[i] = i == chosen or parent[i] >= 0 and inner[parent[i]]
    for i in range(1, n):
        if marks[i] and inner[i] and chosen:
            most = 0.5 if marks[i] <= PART else 0.9 if marks[i] == WHOLE else 1.0
            if plain[i] > most * plain[chosen]:
                marks[i] = 0
        elif marks[i] and not chosen and plain[i] * 2 > plain[0]:
            # By a word within a name it never is; else only where nearly all text is marked.
            if marks[i] <= PART or marks[i] == WHOLE and free * 10 < plain[0] or marks[i] == COMMENT and not free:
                marks[i] = 0
    opened = set()
    for i in range(1, n):  # an article's own header: its headings stay
        if marks[i] == WHOLE and tag[i] == "header" and inner[i] and tag[chosen] == "article" and linked[i] * 2 < size[i]:
            marks[i] = 0
            opened.add(i)
        elif parent[i] in opened and tag[i] not in HEADINGS and tag[i] not in ("hgroup", "div"):
            marks[i] = WHOLE
    around = covered()

    points = [0.0] * n
    for node, text, _ in blocks:
        if around[node]:
            continue
        given = 1 + text.count(",") + min(len(text) / 100, 3)
        up = parent[node] if tag[node] in LEAVES else node
        for level in range(5):
            if up < 0:
                break
            points[up] += given / (1, 2, 6, 9, 12)[level]
            up = parent[up]
    for i in range(n):
        points[i] *= 1 - linked[i] / size[i] if size[i] else 0
    if chosen and points[chosen]:
        points[chosen] += 25 if tag[chosen] == "article" else 15
    best = max(range(n), key=lambda i: (points[i], -i))
    if around[best]:  # nothing but menus and the like
        return ""
    up = best
    while up > 0 and tag[up] != "article" and not (tag[up] == "main" and plain[best] * 2 >= plain[up]):
        up = parent[up]
    best = up if up > 0 else best
    keep = {best}
    stated = tag[best] in ("article", "main")
    notices = {node for node, text, _ in blocks if len(text) < 400 and NOTICE.fullmatch(text)} if best else set()
    noticed = [i in notices for i in range(n)]
    for i in range(n - 1, 0, -1):
        noticed[parent[i]] |= noticed[i] and size[parent[i]] <= size[i] + 60
    titled = any(tag[i] in HEADINGS and inner[i] for i in range(n)) if best == chosen and chosen else False
    for i in range(1, n):
        if i != best and parent[i] == parent[best] and best and size[i] and not around[i] and not noticed[i]:
            density = linked[i] / size[i]
            alike = tag[i] == tag[best] == "article" and density < 0.25 and plain[i] * 5 >= plain[best]
            if alike or points[i] >= max(10, 0.2 * points[best]) or density < 0.25 and not stated or tag[i] in HEADINGS and density < 0.5 and not titled:
                keep.add(i)
    inside = [False] * n
    for i in range(n):
        inside[i] = i in keep or parent[i] >= 0 and inside[parent[i]]
    # What follows a heading of sources.
    cited = [False] * n
    heading = ""
    for node, text, _ in blocks:
        if tag[node] in HEADINGS or tag[node] in ("h4", "h5", "h6"):
            heading = text
        elif heading and SOURCES.fullmatch(heading):
            cited[node] = True
    for i in range(n - 1, 0, -1):
        cited[parent[i]] |= cited[i]
    # Lists of links, wherever they stand in what is kept; paragraphs of sentences are none.
    for i in range(1, n):
        if i not in keep and inside[i] and links[i] >= 3 and linked[i] * 5 > size[i] * 3 and prose[i] * 3 < size[i] and not cited[i] or around[i]:
            inside[i] = False
        elif i not in keep and parent[i] >= 0 and not inside[parent[i]]:
            inside[i] = False
    # Text that stands in no element of its own beside the container, as its siblings above.
    loose = parent[best] if best and not stated and not around[parent[best]] else -1
    return "\n".join(text for node, text, k in blocks if inside[node] or node == loose and k * 4 < len(text))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: main text of every page, whole html.

    Blocks give 1 point, one more for each comma and up to 3 for their length to the
    element around them, less to those further up; an element's points are discounted
    by the share of its text that stands in links. The best container (the article
    element around it, if there is one) and its well-scored siblings are kept, without
    an article or main element all siblings of little linked text, bare text among them,
    but notices of cookies and rights; sibling articles of a fifth of the text stay. Lists
    of three or more links that hold most of their text in links go, unless a third of it
    is sentences or a heading of sources is above. Tags, roles and names mark
    what is beside an article; a mark counts for nothing on what is or holds the article,
    or nearly all of the text. Malformed pages are read in one forward scan.
    Null or empty html, or a page without text: empty text, 0. Repeated rows and null
    ids are rows like others; an empty table gives no rows; other columns are ignored.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches):
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return pages.select("page_id", "url", "html").mapInArrow(task, "page_id long, url string, text string, n_chars long")


def op2_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
