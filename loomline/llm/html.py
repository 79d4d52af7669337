"""Main text of web pages by minimum-cut labelling of text blocks.

A page is cut into blocks of text at block-level tags. A logistic classifier scores each
block; its log odds become a capacity from the source (evidence for content) or to the sink
(evidence for boilerplate). Blocks next to each other on the page, and blocks that follow
each other in one element, are joined by smoothness capacities. The blocks on the source's
side of a minimum cut are the main text: a short paragraph inside an article stays with its
neighbours, a strong advert inside it does not.

The classifier is fitted on a bounded sample of pages that mark their article with an
``article`` or ``main`` element: blocks inside are content, those outside are not. What
elements, names and repeated items tell are features like all others. Its prior
are the weights below, which stand for themselves where no page marks anything.

Reader comments are told by elements that are named as such and no more (``comments``,
``comment-list``, but not ``has-comments``), wherever they stand and however much they hold, and, outside
of a marked article, by repeated items that most have a byline, after some prose.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names by their role.
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup and runs to their end tag.
RAW = set("script style noscript iframe textarea".split())
#: Elements whose content is no text of the page, if they have an end tag; the head ends by itself.
NEVER_TEXT = set("template svg object canvas select button datalist audio video".split())
FOREIGN = {"svg", "math"}
IN_HEAD = set("title base basefont bgsound link meta script style noscript template".split())
BOILER_TAGS = set("nav footer aside form menu dialog".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in class, id or role that tell boilerplate, whole or as a part set off by - _ or case.
BOILER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner bottom breadcrumb breadcrumbs colophon comment comments comentarios consent contentinfo cookie cookies copyright disqus foot footer gdpr impressum imprint legal login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination popup print promo promoted promotion recommend recommended related reply replies respond rail search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription tags teaser toolbar topbar widget".split()
)
#: Words that name reader comments; and those that may stand beside them, or beside ``header`` for a site's header, in one name.
COMMENT_NAMES = set("comment comments commentaires comentarios kommentar kommentare disqus reply replies respond".split())
BESIDE = set("all area article author blog block body box children container content count entry facebook fb form group holder inner item items list main meta news outer page panel post reader readers section site story text thread threads title user users view widget wrap wrapper".split())
HEADER_BESIDE = set("app blog global main page site sticky top".split())
#: The classifier's features and their prior weights. Lengths count up to LONG words; ``named`` is the part to which a wrapper's name is believed.
PRIORS = {"constant": -0.4, "words": 3.2, "linked": -4.0, "sentence": 0.5, "heading": 1.0, "notice": -2.0, "list item": 1.0, "boiler element": -9.0, "named": -9.0, "comment item": -9.0, "call": -9.0}
FEATURES, PRIOR = {n: i for i, n in enumerate(PRIORS)}, tuple(PRIORS.values())
#: What standing in an article or main element tells; these elements are the labels, so it is not fitted.
ARTICLE = 3.0
#: Pages of up to so many characters that it is fitted on; all their blocks count as so many cases against the prior.
FIT_PAGES, FIT_CHARS, FIT_CASES = 1000, 100_000, 60.0
NEXT, SAME_PARENT, SIBLING = 0.3, 0.7, 0.5
#: Capacities fall to a half where two scores differ by so much.
CONTRAST = 3.0
LONG = 40
#: Words from which an unlinked block counts as prose, when a wrapper's name is weighed.
PROSE = 10
#: Siblings of one element name and class that make them items, the part of them with a byline that makes them comments, and the longest byline and call in words.
ITEMS, BYLINED, BYLINE_WORDS, CALL_WORDS = 3, 0.6, 12, 25
ITEM_TAGS = set("li div article section dd tr blockquote".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S
)
#: What follows a start tag: to the end tag, or, where there is none, to the end of the head or page.
RAW_END = {n: re.compile(rf".*?</{n}\b[^>]*(?:>|\Z)|.*?(?=</head\b)|.*", re.S | re.I) for n in RAW}
#: A title without an end tag in the head is taken up to the next tag.
TITLE_END = re.compile(r"(?:(?!</head\b|<title\b).)*?</title\s*>|[^<]*", re.S | re.I)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: What alike siblings may differ in: numbers, and words of odd and even rows.
PLAIN = re.compile(r"\d+|\b(?:odd|even|first|last|alt)\b")
NOTICE = re.compile(r"©|\(c\)|all rights reserved|cookies?\b|privacy policy|terms of (?:use|service)|subscribe|sign up", re.I)
#: What parts the links of a bar, twice or more.
PARTED = re.compile(r"\s[|·•]\s")
#: How calls to the reader begin, also inside an article, and what bylines hold.
CALL = re.compile(r"\W*(?:(?:please )?(?:subscribe|sign up|register now|follow us|like us|share this|join our|get our|advertisement|sponsored|read (?:more|also|next)\s*:)|abonn(?:ez|ieren)|newsletter|jetzt anmelden|folgen sie uns|anzeige\b|suivez-nous|publicité|inscrivez|suscr[ií]b|síguenos|publicidad|(?:this|our) (?:web)?site uses cookies|we use cookies|diese (?:web)?seite verwendet cookies|ce site utilise des cookies|este sitio (?:web )?utiliza cookies)", re.I)
BYLINE = re.compile(r"\b(?:ago|says|said|wrote|writes|repl(?:y|ied)|antworten|schrieb|schreibt|sagt|répondre|a écrit|responder|respondió|permalink|upvotes?|likes?)\b|\bvor \d|\bil y a \d|\bhace \d|\d{1,2}:\d{2}|\b\d{4}-\d{2}-\d{2}|\b\d{1,2}[./]\d{1,2}[./]\d{2,4}", re.I)
JOINED = re.compile(rf"({'|'.join(sorted(COMMENT_NAMES, key=len, reverse=True))})({'|'.join(sorted(BESIDE, key=len, reverse=True))})?")


def names_of(attributes: str) -> list[list[str]]:
    """The words of each name in class, id and role."""
    return [[p.lower() for p in PARTS.findall(name)] for m in NAMES.findall(attributes) for name in " ".join(m).split()]


def told_boiler(names: list[list[str]]) -> frozenset[str]:
    """The words that tell boilerplate."""
    return frozenset(w for name in names for w in name if w in BOILER_NAMES)


def only(names: list[list[str]], told: set[str], beside: set[str]) -> bool:
    """Whether a name holds one of some words, and else only words that may stand beside it."""
    return any(told.intersection(name) and all(w in told or w in beside for w in name) for name in names)


def of_comments(names: list[list[str]]) -> bool:
    """Whether an element is named as one of reader comments and no more."""

    def parted(word: str) -> list[str]:
        joined = JOINED.fullmatch(word)
        return [w for w in joined.groups() if w] if joined else [word]

    return only([[w for word in name for w in parted(word)] for name in names], COMMENT_NAMES, BESIDE)


class Wrappers:
    """Elements whose names tell boilerplate, and how much to believe each from where the page's prose stands.

    Wrappers of the same words under one wrapper are one. A name is believed in full unless
    its wrapper holds a long run of prose, of more words than stand before it or, later, under
    none but the names around it; the less there is outside, the less the name says. Number 0
    is the page.
    """

    def __init__(self):
        self.of: dict[tuple[int, frozenset[str]], int] = {}
        self.parents, self.own, self.prose, self.begun, self.around = [0], [0], [0], [0], [0]
        self.total, self.path = 0, 0  # words so far, and those of the open wrappers themselves

    def enter(self, parent: int, words: frozenset[str]) -> int:
        k = self.of.get((parent, words))
        if k is None:
            k = self.of[parent, words] = len(self.own)
            self.parents.append(parent)
            self.own.append(0)
            self.prose.append(0)
            self.begun.append(self.total)
            self.around.append(self.path)
        self.path += self.own[k]
        return k

    def leave(self, wrapper: int) -> None:
        self.path -= self.own[wrapper]

    def add(self, wrapper: int, words: int) -> None:
        self.own[wrapper] += words
        self.prose[wrapper] += words * (words >= PROSE)
        self.total += words
        self.path += words

    def beliefs(self) -> list[float]:
        """To what part each wrapper's name, or one around it, is believed."""
        inside, around, out = self.prose[:], [0], [0.0]
        for k in range(len(inside) - 1, 0, -1):
            inside[self.parents[k]] += inside[k]
        for k in range(1, len(inside)):
            p = self.parents[k]
            around.append(around[p] + self.own[p])
            outside = self.begun[k] + around[k] - self.around[k]
            share = 2 * outside / (outside + inside[k]) if inside[k] >= LONG else 1.0
            out.append(max(out[p], min(1.0, share)))
        return out


def tokens_of(page: str) -> tuple[list[tuple[int, int, bool, str, str]], set[int]]:
    """((start, end, closing, name, attributes) of each tag, places of those NEVER_TEXT start tags that have an end tag).

    Comments, declarations and raw elements are tokens without a name.
    """
    out: list[tuple[int, int, bool, str, str]] = []
    opened: dict[str, list[int]] = {n: [] for n in NEVER_TEXT}
    closed: set[int] = set()
    head, at, last_svg = False, 0, page.rfind("</svg")
    while m := TAG.search(page, at):
        shut, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        at, name = m.end(), (name or "").lower()
        alone = bool(name) and not shut and attributes.endswith("/")
        foreign = bool(opened["svg"])
        if name and head and (name == "head" if shut else name not in IN_HEAD):
            head = False
        if name == "head" and not shut:
            head = True
        elif not shut and (name in RAW and not (foreign and alone) or name == "title" and head):
            at = (RAW_END[name] if name in RAW else TITLE_END).match(page, at).end()
            name = ""
        elif name in NEVER_TEXT and shut:
            if opened[name]:
                closed.add(opened[name].pop())
        elif alone and (name in FOREIGN or foreign and name in RAW):
            name = ""
        elif name in NEVER_TEXT:
            opened[name].append(len(out))
        elif name in BLOCKS and not shut and foreign and at > last_svg:
            opened["svg"].clear()
        out.append((m.start(), at, bool(shut), name, attributes or ""))
    return out, closed


class Block:
    """A text block: its text, the classifier's features, where it stands, and the wrapper it is in."""

    __slots__ = ("text", "features", "article", "own", "group", "wrapper", "element", "words", "linked")

    def __init__(self, text: str, linked: int, name: str, article: bool, boiler: bool, own: int, group: int, wrapper: int, element: int):
        self.text, self.article, self.own, self.group, self.wrapper, self.element = text, article, own, group, wrapper, element
        self.words, self.linked = text.count(" ") + 1, min(1.0, linked / len(text))
        notice = not article and self.words < LONG and (bool(NOTICE.search(text)) or len(PARTED.findall(text)) > 1)
        call = self.words <= CALL_WORDS and name not in ("h1", "h2") and bool(CALL.match(text))
        listed = name in ("li", "dd", "dt") and self.linked < 0.2
        sentence = text[-1] in ".!?:;\"'”»"
        self.features = [1.0, min(self.words, LONG) / LONG, self.linked, float(sentence), float(name in ("h1", "h2", "h3")), float(notice), float(listed), float(boiler), 0.0, 0.0, float(call)]

    def set(self, feature: str, value: float) -> None:
        self.features[FEATURES[feature]] = value


class Elements:
    """The page's elements by number: of which each is a child, and which are alike siblings."""

    def __init__(self):
        self.parents, self.alike = [0], [0]
        self.of: dict[tuple[int, str, str], int] = {}
        self.sizes = [0]

    def add(self, parent: int, name: str, attributes: str) -> int:
        group = 0
        if name in ITEM_TAGS:
            told = NAMES.search(attributes) if attributes else None
            key = (parent, name, PLAIN.sub("", " ".join(filter(None, told.groups()))) if told else "")
            group = self.of.setdefault(key, len(self.sizes))
            if group == len(self.sizes):
                self.sizes.append(0)
            self.sizes[group] += 1
        self.parents.append(parent)
        self.alike.append(group)
        return len(self.parents) - 1

    def items(self) -> list[int]:
        """The innermost element of ITEMS alike siblings or more that each element is in, itself included; 0 is none."""
        out = [0]
        for k in range(1, len(self.parents)):
            out.append(k if self.sizes[self.alike[k]] >= ITEMS and self.alike[k] else out[self.parents[k]])
        return out


def mark_comment_items(blocks: list[Block], elements: Elements) -> None:
    """Set the feature of blocks in items like which most have a byline, outside of a marked article and after LONG words of prose."""
    inside = elements.items()
    bylined: dict[int, set[int]] = {}
    begins: dict[int, int] = {}
    prose = 0
    for b in blocks:
        item = inside[b.element]
        if item and not b.article:
            begins.setdefault(elements.alike[item], prose)
            if b.words <= BYLINE_WORDS and BYLINE.search(b.text):
                bylined.setdefault(elements.alike[item], set()).add(item)
        prose += b.words * (b.words >= PROSE and b.linked < 0.5)
    comments = {g for g, items in bylined.items() if len(items) >= BYLINED * elements.sizes[g] and begins[g] >= LONG}
    for b in blocks:
        if not b.article and elements.alike[inside[b.element]] in comments:
            b.set("comment item", 1.0)


def blocks_of(page: str) -> list[Block]:
    """The text blocks in page order. Takes time in proportion to the page, however many elements stay open."""
    out: list[Block] = []
    wrappers, elements = Wrappers(), Elements()
    # Open elements: name, inside an article, inside a boilerplate element, number of the element, in a link, no text of the page, wrapper.
    stack: list[tuple[str, bool, bool, int, bool, bool, int]] = [("", False, False, 0, False, False, 0)]
    # Where in the stack elements of each name, and block elements, stand.
    places: dict[str, list[int]] = {}
    open_blocks: list[int] = []
    text: list[str] = []
    linked, at = 0, 0

    def flush() -> None:
        nonlocal linked
        whole = " ".join(html.unescape("".join(text)).split()) if text else ""
        if whole:
            own, around = stack[open_blocks[-1]] if open_blocks else stack[0], stack[open_blocks[-2]] if len(open_blocks) > 1 else stack[0]
            _, article, boiler, element, *_, wrapper = stack[-1]
            if not boiler and 2 * linked < len(whole):
                wrappers.add(wrapper, whole.count(" ") + 1)
            out.append(Block(whole, linked, own[0], article, boiler, own[3], around[3], 0 if boiler else wrapper, element))
        text.clear()
        linked = 0

    def drop(place: int) -> None:
        """Close the element at a place of the stack and all in it."""
        while len(stack) > place:
            name, *_, wrapper = stack.pop()
            places[name].pop()
            if open_blocks and open_blocks[-1] == len(stack):
                open_blocks.pop()
            if wrapper != stack[-1][6]:
                wrappers.leave(wrapper)

    def add(part: str) -> None:
        nonlocal linked
        if stack[-1][0] == "head" and not part.isspace():
            drop(len(stack) - 1)
        if not stack[-1][5]:
            text.append(part)
            linked += len(part) * stack[-1][4]

    tokens, closed = tokens_of(page)
    for k, (start, end, closing, name, attributes) in enumerate(tokens):
        if start > at:
            add(page[at:start])
        at = end
        if not closing and name and stack[-1][0] == "head" and name not in IN_HEAD:
            drop(len(stack) - 1)
        # What is dropped neither parts the text around it nor ends a paragraph.
        block = name in BLOCKS and not stack[-1][5] and k not in closed
        if block:
            flush()
        elif name in ("br", "wbr", "img", "", "head") or name in NEVER_TEXT:
            text.append(" ")
        if closing:
            if places.get(name):
                drop(places[name][-1])
        elif name and name not in VOID:
            if open_blocks and not stack[-1][5]:
                inner = stack[open_blocks[-1]][0]
                if inner in CLOSES.get(name, ()) or (block and inner == "p"):
                    drop(open_blocks[-1])
            _, article, boiler, parent, link, hidden, wrapper = stack[-1]
            named = names_of(attributes) if attributes else []
            bad = name in BOILER_TAGS or (name == "header" and not article) or (named and name not in ("body", "html", "main") and of_comments(named))
            bad = bad or (named and not article and name not in ("body", "html", "main", "article") and only(named, {"header"}, HEADER_BESIDE))
            if named and name not in ("body", "html", "article", "main") and (told := told_boiler(named)):
                wrapper = wrappers.enter(wrapper, told)
            if name in BLOCKS:
                open_blocks.append(len(stack))
            places.setdefault(name, []).append(len(stack))
            stack.append((name, article or name in ("article", "main"), boiler or bool(bad), elements.add(parent, name, attributes), link or name == "a", hidden or name == "head" or k in closed, wrapper))
    if page[at:]:
        add(page[at:])
    flush()
    beliefs = wrappers.beliefs()
    for b in out:
        b.set("named", beliefs[b.wrapper])
    mark_comment_items(out, elements)
    return out


def scores_of(blocks: list[Block], weights: tuple[float, ...] = PRIOR) -> list[float]:
    """Evidence that each block is content, in log odds."""
    return [sum(w * x for w, x in zip(weights, b.features, strict=True)) + ARTICLE * b.article for b in blocks]


def fit(pages: list[str]) -> tuple[float, ...]:
    """The classifier's weights, by Newton steps on the log-likelihood of the pages' blocks and a normal prior.

    Only pages with blocks in an article count; blocks of an article that an element, a name or their
    own words tell against belong to neither side. However many blocks there are, they count as FIT_CASES.
    """
    rows, labels = [], []
    against = [FEATURES[n] for n in ("boiler element", "named", "comment item", "call")]
    for page in pages:
        blocks = blocks_of(page)
        if any(b.article for b in blocks):
            for b in blocks:
                if not b.article or not any(b.features[i] for i in against):
                    rows.append(b.features)
                    labels.append(b.article)
    w = prior = np.array(PRIOR)
    if rows:
        x, y = np.array(rows), np.array(labels, float)
        # Both sides have the same weight, as pages differ in how much boilerplate they carry.
        share = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, len(y) - y.sum())) * FIT_CASES
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), x.T @ (share * (y - p)) - (w - prior))
            w = w + step
            if np.abs(step).max() < 1e-9:
                break
    return tuple(float(round(v, 6)) for v in w)


def groups_of(blocks: list[Block]) -> list[int]:
    """The element that each block is a child of; text beside child blocks is such a child itself."""
    parents = {b.group for b in blocks}
    return [b.own if b.own in parents else b.group for b in blocks]


def smoothness(scores: list[float], groups: list[int]) -> list[tuple[int, int, float]]:
    """(i, j, capacity) between neighbours on the page and between blocks that follow each other in one element, by j.

    Elements lie inside or beside each other, so no two of these edges cross.
    """
    edges, last = [], {}
    soft = lambda i, j: CONTRAST / (CONTRAST + abs(scores[i] - scores[j]))
    for j, group in enumerate(groups):
        if j:
            edges.append((j - 1, j, (NEXT + SAME_PARENT * (groups[j - 1] == group)) * soft(j - 1, j)))
        if group in last and last[group] != j - 1:
            edges.append((last[group], j, SIBLING * soft(last[group], j)))
        last[group] = j
    return edges


def maximum_flow(scores: list[float], edges: list[tuple[int, int, float]]) -> tuple[float, list[bool]]:
    """(value of a maximum flow, which nodes stand on the source's side of a minimum cut), in linear time.

    A score is a node's capacity from the source, or to the sink if it is negative. Edges
    (i, j, capacity), i < j, in the order of j, run between neighbours or over the nodes
    between their ends, and do not cross. So there is always a node with two neighbours at
    most: the flow through it is settled at once, and what the node leaves behind are
    terminal capacities of the two and an arc from one to the other. The last node's side
    decides, in reverse order, those of all before. Ties go to the sink.
    """
    left = [-s for s in scores]  # the cost of the source's side over the sink's
    flow = sum(s for s in scores if s > 0)
    ahead, back = [0.0] * len(scores), [0.0] * len(scores)  # arc capacities from and to the node before on the stack
    settled: list[tuple[int, int, int, tuple[bool, ...]]] = []
    stack: list[int] = []

    def settle(a: int, p: int, b: int) -> None:
        """Take out p, whose neighbours are a and b; b is -1 if there is none."""
        nonlocal flow
        ahead_b, back_b = (ahead[b], back[b]) if b >= 0 else (0.0, 0.0)
        cost, side = [], []
        for at_a in (0, 1):
            for at_b in (0, 1):
                sink = at_a * ahead[p] + at_b * back_b
                source = left[p] + (1 - at_a) * back[p] + (1 - at_b) * ahead_b
                side.append(source < sink - 1e-12)
                cost.append(min(sink, source))
        c00, c01, c10, c11 = cost
        flow += c00
        left[a] += c11 - c01 if b >= 0 else c10 - c00
        if b >= 0:
            left[b] += c01 - c00
            ahead[b], back[b] = max(0.0, c01 + c10 - c00 - c11), 0.0
        settled.append((p, a, b, tuple(side)))

    k = 0
    for j in range(len(scores)):
        stack.append(j)
        while k < len(edges) and edges[k][1] == j:
            i, _, c = edges[k]
            while stack[-2] != i:
                settle(stack[-3], stack[-2], j)
                del stack[-2]
            ahead[j] += c
            back[j] += c
            k += 1
    while len(stack) > 1:
        settle(stack[-2], stack[-1], -1)
        stack.pop()
    kept = [False] * len(scores)
    if stack:
        kept[stack[0]] = left[stack[0]] < -1e-12
        flow += min(0.0, left[stack[0]])
    for p, a, b, side in reversed(settled):
        kept[p] = side[2 * kept[a] + (b >= 0 and kept[b])]
    return flow, kept


def main_text(page: str | None, weights: tuple[float, ...] = PRIOR) -> str:
    """The content blocks of a page, one line each; empty for null, empty or all-boilerplate pages."""
    blocks = blocks_of(page or "")
    scores = scores_of(blocks, weights)
    _, kept = maximum_flow(scores, smoothness(scores, groups_of(blocks)))
    return "\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)


def sample(pages: DataFrame) -> list[str]:
    """Up to FIT_PAGES different pages of up to FIT_CHARS characters, those of the least hashes."""
    some = pages.select("html").where(F.length("html").between(1, FIT_CHARS)).withColumn("_h", F.xxhash64("html"))
    # Only hashes are ordered; then each of the FIT_PAGES pages comes to the driver once.
    least = some.select("_h").distinct().orderBy("_h").limit(FIT_PAGES)
    found = some.join(F.broadcast(least), "_h").groupBy("_h").agg(F.min("html").alias("html"))
    return [r["html"] for r in sorted(found.collect())]


def extract(pages: DataFrame, fitted: bool = True) -> DataFrame:
    """The pages with ``text`` (string) in place of ``html``; other columns but ``text`` are kept, repeated rows too.

    Unless told otherwise, the classifier is first fitted on a sample of the pages.
    """
    weights = fit(sample(pages)) if fitted else PRIOR
    rest = pages.drop("text")
    names = [n for n in rest.columns if n != "html"]

    def scan(batches):
        for batch in batches:
            texts = pa.array([main_text(p.as_py(), weights) for p in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], texts], [*names, "text"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest.schema if f.name != "html")
    return rest.mapInArrow(scan, f"{fields}text string")
