"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is read into text blocks, the runs of text between block-level tags.  A classifier says what it costs to
call a block content or boilerplate: naive Bayes over its length, links, tag, ending and neighbours, plus
fixed evidence of the elements around it (article, nav, class names and the like).  These costs are the
capacities from and to two terminals.  Blocks that follow each other, and blocks next to each other in one parent, are
tied by capacities that fall with their distance in the tree.  The minimum cut, found by
maximum flow, labels all blocks of the page at once: a short line inside an article stays with it, whatever it says by
itself.

The naive Bayes counts come from the pages themselves: blocks that the elements around them decide are its examples,
of about `FIT_PAGES` pages (a bounded sample), on top of fixed prior counts.  Only the counts reach the driver, two a
feature value.

Defined cases: null, empty and text-free pages have the empty text; broken, unclosed or cut off markup is
read as browsers do in the main (an open tag at the end is no text, an unclosed comment or script reaches to the end);
character references are decoded once, unknown ones stay; white space includes no-break spaces; `br` is white space; rows of
one page_id are pages each; pages may have any length or depth; an empty table gives no row; other columns are ignored.
"""

import html as H
import re
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closepass.llm.store import mapped

FIT_PAGES = 4000

# Elements and names of HTML, and usual class names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = RAW | set("noscript template svg canvas object audio video select option optgroup datalist button head".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead"
    " tr ul".split()
)
ENDS_P = BLOCK - set("body caption dd dt head html legend li summary tbody td tfoot th thead tr".split())
#: A start tag closes an open element of these, looked for up to one of the others.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "a": ({"a"}, BLOCK),
}
SCOPE = {"table", "td", "th", "caption"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BOILERPLATE_TAGS = set("nav footer aside form menu dialog fieldset".split())
BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
BOILERPLATE_WORDS = set(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar footer header masthead topbar cookie cookies consent notice gdpr popup modal overlay"
    " newsletter subscribe subscription signup signin login share sharing social related recommended recommendations comment"
    " comments commentlist disqus respond reply replies discussion widget widgets toolbar pagination pager search copyright".split()
)
IN_HEAD = set("base link meta noscript script style template title".split())
CONTENT_WORDS = set("article articlebody content entry post story maincontent".split())
TURNED = {"has", "with", "no", "without", "hide", "show"}  # before a word: the class speaks of another element

MARK = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/(?![a-zA-Z])[^>]*(?:>|\Z)"
    r"""|(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(>|\Z))""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

OUTSIDE, IN_MAIN, IN_ARTICLE = range(3)


class Element:
    __slots__ = ("tag", "parent", "depth", "zone", "marked", "unseen", "link")

    def __init__(self, tag, parent):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.zone = parent.zone if parent else OUTSIDE
        self.marked = parent.marked if parent else False
        self.unseen = parent.unseen if parent else False
        self.link = parent.link if parent else False


class Block:
    __slots__ = ("element", "text", "words", "linked")

    def __init__(self, element, text, linked):
        self.element, self.text = element, text
        self.words = text.count(" ") + 1
        self.linked = linked / max(len(text), 1)


def _names(text: str) -> set[str]:
    """Lower-case words of class names, without those that speak of another element."""
    found = set()
    for name in text.split():
        words = [w.lower() for w in NAME.findall(name)]
        if not TURNED & set(words):
            found.update(words, ["".join(words)])
    return found


def _placed(element: Element, attributes: str) -> None:
    """Sets what the tag, role and class names of an element say about the text in it."""
    tag = element.tag
    given = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
        given.setdefault(name.lower(), a or b or c)
    role = given.get("role", "").lower()
    names = _names(f"{given.get('class', '')} {given.get('id', '')}") if given else set()
    content = names & CONTENT_WORDS
    against = names & BOILERPLATE_WORDS
    if content or element.zone == IN_ARTICLE:
        against = against - {"header", "banner"}  # of the article
    if tag in ("html", "body", "main"):
        against = set()
    elif tag == "article":
        against = against & {"ad", "ads", "advert", "sponsored", "promo", "related", "comment", "comments", "reply", "widget"}
    page_header = tag == "header" and element.zone == OUTSIDE
    if tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES or against or page_header or "hidden" in given:
        element.marked = True
    elif tag == "article" or role == "article" or given.get("itemprop", "").lower() == "articlebody":
        element.zone = IN_ARTICLE
    elif tag == "main" or role == "main" or (content and tag in ("div", "section", "td")):
        element.zone = max(element.zone, IN_MAIN)
    if tag in UNSEEN:
        element.unseen = True
    if tag == "a":
        element.link = True


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in their order."""
    stack = [Element("", None)]
    open_tags: dict[str, int] = defaultdict(int)
    out: list[Block] = []
    run: list[str] = []
    linked = 0

    def flush(element):
        nonlocal linked
        text = " ".join("".join(run).split())
        if text:
            while element.parent is not None and element.tag not in BLOCK:
                element = element.parent
            out.append(Block(element, text, linked))
        run.clear()
        linked = 0

    def close(tags, until=frozenset()):
        """Pops up to an open element of `tags`, unless one of `until` comes first."""
        if not any(open_tags[t] for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            tag = stack[k].tag
            if tag in tags:
                if any(e.tag in BLOCK for e in stack[k:]):
                    flush(stack[-1])
                for e in stack[k:]:
                    open_tags[e.tag] -= 1
                del stack[k:]
                return
            if tag in until:
                return

    def say(text):
        nonlocal linked
        here = stack[-1]
        if text and not here.unseen:
            text = H.unescape(text) if "&" in text else text
            run.append(text)
            if here.link:
                linked += len(text.strip())

    at, end = 0, len(page)
    while at < end:
        m = MARK.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if m[2] is None or not m[4]:  # a comment or declaration, or cut off
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in ("body", "html") or tag not in open_tags:
                continue
            if tag in BLOCK:
                close({tag}, SCOPE - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else frozenset())
            else:
                close({tag}, BLOCK)
            continue
        if tag == "br":
            run.append(" ")
            continue
        if open_tags["head"] and tag not in IN_HEAD:
            close({"head"})
        if tag in ENDS_P:
            close({"p"}, SCOPE)
        if tag in CLOSES:
            close(*CLOSES[tag])
        elif tag in HEADINGS and stack[-1].tag in HEADINGS:
            close({stack[-1].tag})
        if tag in BLOCK:
            flush(stack[-1])
        if tag in VOID:
            continue
        element = Element(tag, stack[-1])
        _placed(element, m[3])
        if tag in RAW:
            m = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = m.end() if m else end
            continue
        if m[3].endswith("/") and tag not in BLOCK:
            continue  # as in XHTML
        stack.append(element)
        open_tags[tag] += 1
    flush(stack[-1])
    return out


# --- the classifier ---

TAG_GROUPS = {"p": 0, **dict.fromkeys(HEADINGS, 1), "li": 2, "dd": 2, "dt": 2, "td": 3, "th": 3, "pre": 4, "blockquote": 4, "figcaption": 4}
#: Prior counts (content, boilerplate) of each value of each feature.
PRIOR = [
    [(1, 3), (2, 30), (6, 30), (8, 20), (15, 15), (40, 10), (40, 4), (30, 2), (20, 1)],  # bits of the number of words
    [(50, 20), (8, 8), (4, 50)],  # links: none, below half of the text, more
    [(20, 60), (60, 20)],  # ends like a sentence
    [(60, 10), (15, 8), (20, 40), (8, 10), (10, 3), (10, 40)],  # tag: paragraph, heading, item, cell, quoted, other
    [(8, 12), (15, 40), (25, 20), (40, 8)],  # words before: no block, few, some, many
    [(8, 12), (12, 40), (25, 20), (40, 8)],  # words after
]
STARTS = np.cumsum([0, *map(len, PRIOR)])
CELLS = int(STARTS[-1])
SENTENCE_ENDS = tuple(".!?:;…。！？\"'”’»)")
MOST_A_FEATURE, MOST_IN_ALL = 1.5, 4.0
#: What the elements around a block add: inside an article, inside the main part, outside both where a page has them, and in marked ones.
ARTICLE, MAIN, APART, MARKED = 6.0, 3.0, -4.5, -14.0
RIGHTS = -5.0  # a block outside an article that opens with a copyright mark
TIE = 2.0  # smoothness of two blocks at no distance
UNITS = 100  # capacities are whole hundredths


def _near(words: int) -> int:
    return 1 if words < 4 else 2 if words < 16 else 3


def features(found: list[Block]) -> list[tuple[int, ...]]:
    """The cell of each feature, for every block."""
    out = []
    for k, b in enumerate(found):
        values = (
            min(b.words.bit_length(), 8),
            0 if not b.linked else 1 if b.linked < 0.5 else 2,
            int(b.text.endswith(SENTENCE_ENDS)),
            TAG_GROUPS.get(b.element.tag, 5),
            _near(found[k - 1].words) if k else 0,
            _near(found[k + 1].words) if k + 1 < len(found) else 0,
        )
        out.append(tuple(int(STARTS[f]) + v for f, v in enumerate(values)))
    return out


def counted(found: list[Block], counts: np.ndarray) -> None:
    """Adds the blocks that the elements around them decide to counts (cell, content or boilerplate)."""
    for b, cells in zip(found, features(found)):
        if b.element.marked or b.element.zone == IN_ARTICLE:
            for c in cells:
                counts[c, int(b.element.marked)] += 1


def weights(counts: np.ndarray) -> np.ndarray:
    """The log odds of content of each cell, from counts on top of the prior ones."""
    total = np.array([pair for feature in PRIOR for pair in feature], dtype=np.float64) + counts
    out = np.zeros(CELLS)
    for a, b in zip(STARTS[:-1], STARTS[1:]):
        share = total[a:b] / total[a:b].sum(axis=0)
        out[a:b] = np.log(share[:, 0] / share[:, 1])
    return np.clip(out, -MOST_A_FEATURE, MOST_A_FEATURE)


def odds(found: list[Block], of_cell: np.ndarray) -> list[float]:
    """The log odds of content of each block, by itself and by the elements around it."""
    zones = [b.element.zone for b in found if not b.element.marked]
    best = max(zones, default=OUTSIDE)
    out = []
    for b, cells in zip(found, features(found)):
        own = max(-MOST_IN_ALL, min(MOST_IN_ALL, float(sum(of_cell[c] for c in cells))))
        zone = b.element.zone
        own += ARTICLE if zone == IN_ARTICLE else MAIN if zone == IN_MAIN else APART if best else 0.0
        if zone != IN_ARTICLE and b.text[:9].lower().startswith(("©", "(c)", "copyright")):
            own += RIGHTS
        out.append(own + (MARKED if b.element.marked else 0.0))
    return out


# --- the cut ---


def distance(a: Element, b: Element) -> int:
    """Steps between two elements in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def ties(found: list[Block]) -> list[tuple[int, int, int]]:
    """(block, block, capacity) of blocks that follow each other, on the page or in one parent."""
    out = []
    last: dict[int, int] = {}
    for k, b in enumerate(found):
        if k:
            out.append((k - 1, k, int(UNITS * TIE / (1 + distance(found[k - 1].element, b.element)))))
        parent = id(b.element.parent or b.element)
        if parent in last and last[parent] != k - 1:
            out.append((last[parent], k, int(UNITS * TIE / 3)))
        last[parent] = k
    return [t for t in out if t[2]]


def source_side(net: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The nodes on the source side of a minimum cut: net[k] > 0 is the capacity from the source to k, net[k] < 0 that
    from k to the sink, edges (a, b, capacity) hold both ways.  Of all minimum cuts, the one with the fewest such nodes."""
    n = len(net)
    source, sink = n, n + 1
    to: list[int] = []
    left: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a, b, there, back):
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        left.extend((there, back))

    for k, c in enumerate(net):
        if c > 0:
            edge(source, k, c, 0)
        elif c < 0:
            edge(k, sink, -c, 0)
    for a, b, c in edges:
        edge(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if left[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(left[e] for e in path)
                for k in range(len(path) - 1, -1, -1):
                    left[path[k]] -= flow
                    left[path[k] ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if not left[e])
                at = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while following[at] < len(out[at]):
                e = out[at][following[at]]
                if left[e] and level[to[e]] == level[at] + 1:
                    path.append(e)
                    at = to[e]
                    break
                following[at] += 1
            else:
                if at == source:
                    break
                at = to[path.pop() ^ 1]
                following[at] += 1


def main_blocks(page: str | None, of_cell: np.ndarray) -> list[str]:
    """The content blocks of a page."""
    found = blocks(page or "")
    if not found:
        return []
    net = [round(UNITS * x) for x in odds(found, of_cell)]
    return [b.text for b, kept in zip(found, source_side(net, ties(found))) if kept]


# --- on Spark ---


def fit(pages: DataFrame, key: str = "page_id", most: int = FIT_PAGES) -> np.ndarray:
    """The classifier's weights from about `most` of `pages`, taken by a hash of `key` and `url`."""
    n = max(pages.count(), 1)
    share = min(1_000_000, -(-most * 1_000_000 // n))
    sample = pages.where(F.pmod(F.xxhash64(key, "url"), F.lit(1_000_000)) < share).select("html")

    def run(batches):
        counts = np.zeros((CELLS, 2), dtype=np.int64)
        for batch in batches:
            for page in batch.column("html"):
                counted(blocks(page.as_py() or ""), counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CELLS)), pa.array(counts[:, 0]), pa.array(counts[:, 1])], ["cell", "yes", "no"])

    rows = sample.transform(mapped, run, "cell long, yes long, no long").groupBy("cell").agg(F.sum("yes"), F.sum("no")).collect()
    counts = np.zeros((CELLS, 2))
    for cell, yes, no in rows:  # CELLS of them
        counts[cell] = yes, no
    return weights(counts)


def extracted(pages: DataFrame, of_cell: np.ndarray) -> DataFrame:
    """`pages` with `text` in place of `html`; the other columns stay."""
    kept = [c for c in pages.columns if c not in ("html", "text")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in kept)

    def run(batches):
        for batch in batches:
            texts = ["\n".join(main_blocks(page.as_py(), of_cell)) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, "text"])

    return pages.select(*kept, "html").transform(mapped, run, f"{kinds}, text string")


def op13_minimum_cut_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extracted(pages, fit(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
