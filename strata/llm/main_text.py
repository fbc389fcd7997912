"""Main text of web pages: boosted trees over DOM nodes and a hierarchical decoding.

*Nodes.* A tolerant tokenizer builds the tree of block elements; runs of text between block
boundaries are leaf nodes (``#text``). A node has its tag, tokens of class, id and role, depth,
subtree density (text, links, markup, sentence ends) and statistics among its siblings.

*Classifier.* Boosted trees (``trees.py``) say whether a node holds main text. No table labels page
parts, so the trees learn from pages put together from a bounded sample of the given pages'
text blocks: templates with known main containers, navigation, notices, adverts, forms, comments
and footers (``training_page``). ``SAMPLE_PAGES`` pages at most are sampled, the first by hash.

*Decoding.* A part of a rejected element is rejected, and an element that holds accepted text is
accepted: among all labellings that obey this the one with the largest sum of log-odds is
found bottom-up (a subtree is worth the larger of nothing and its own score plus its parts')
and read off top-down. No ancestor and descendant contradict each other.

Every page is judged alone from its whole html, in one scan without shuffle. Null or empty html
gives the empty string; truncated pages close what is open; repeated rows repeat their result; an empty
table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.trees import BoostedTrees

SAMPLE_PAGES, SAMPLE_CHARS, VARIANTS, SEED = 240, 16_384, 2, 5

MARKUP = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*)|(/))")
VALUE = re.compile(r"=\s*([\"'])|>")
#: Elements whose content is no markup, and elements that go with all they hold once they are closed.
RAW = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)", re.I) for n in ("script", "style", "textarea", "title")}
DROPPED = frozenset("noscript template iframe svg select object math".split())
PAIRED = re.compile(rf"<(/?)({'|'.join(sorted(DROPPED))})(?=[\s/>])([^<>]*)", re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr input button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the right side ends an open element of the left side.
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                   "main nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div aside nav main body html".split())

KINDS = ("#text p h1 h2 h3 li ul ol div section article main nav header footer aside form table td blockquote pre "
         "figure figcaption body").split()
KIND = {k: i + 1 for i, k in enumerate(KINDS)}
KIND |= {"h4": KIND["h3"], "h5": KIND["h3"], "h6": KIND["h3"], "th": KIND["td"], "dd": KIND["li"], "dt": KIND["li"]}
GOOD = frozenset("article content main post body entry text story page hentry blog prose markdown".split())
BAD = frozenset("nav menu header footer side sidebar ad ads advert advertisement advertising banner promo sponsor "
                "sponsored cookie cookies consent notice alert gdpr popup modal overlay comment comments reply replies "
                "disqus respond share sharing social related recommended widget form login signup subscribe newsletter "
                "breadcrumb breadcrumbs pagination pager tags masthead toolbar copyright legal disclaimer "
                "navigation complementary contentinfo search skip topbar rail".split())


@dataclass
class Page:
    """Parallel lists, one entry a node in page order; node 0 is the document."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#root"])
    good: list[int] = field(default_factory=lambda: [0])
    bad: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    text: list[str] = field(default_factory=lambda: [""])
    linked: list[int] = field(default_factory=lambda: [0])
    marks: list[int] = field(default_factory=lambda: [0])

    def add(self, parent: int, tag: str, good: int = 0, bad: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.good.append(good)
        self.bad.append(bad)
        self.depth.append(self.depth[parent] + 1)
        self.text.append("")
        self.linked.append(0)
        self.marks.append(0)
        return len(self.parent) - 1


def closing(source: str) -> dict[int, int]:
    """Where each dropped element that is closed ends, by the place of its start tag; a self-closed one holds nothing."""
    opened: dict[str, list[int]] = {}
    ends = {}
    for m in PAIRED.finditer(source):
        places = opened.setdefault(m[2].lower(), [])
        if not m[1]:
            if not m[3].endswith("/"):
                places.append(m.start())
        elif places:
            at = source.find(">", m.end())
            ends[places.pop()] = len(source) if at < 0 else at + 1
            if at < 0:
                break
    return ends


def markup(source: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """Begin and end of each piece of markup, whether it is an end tag, its name (None: nothing to show) and attributes.

    Every step goes on behind what it has looked at, so the time is linear whatever is left open: a comment, a tag, or
    raw text that is not closed runs to the end; a quoted value that is not closed ends with its tag, at the next ``>``.
    """
    at, size = 0, len(source)
    unclosed: set[str] = set()
    ends: dict[int, int] | None = None
    while m := MARKUP.search(source, at):
        begin, name = m.start(), m[4]
        if name is None:
            mark = "-->" if m[1] else ">"
            found = source.find(mark, m.end())
            at = size if found < 0 else found + len(mark)
            yield begin, at, False, None, ""
            continue
        name, last, end = name.lower(), m.end(), bool(m[3])
        at = last
        while v := VALUE.search(source, at):
            at = v.end()
            quote = v[1]
            if quote is None:
                break
            if quote not in unclosed:
                found = source.find(quote, at)
                if found < 0:
                    unclosed.add(quote)
                else:
                    at = found + 1
        else:
            at = size
        attributes = source[last: at]
        if not end and name in RAW:
            close = RAW[name].search(source, at)
            found = source.find(">", close.end()) if close else -1
            at = size if found < 0 else found + 1
            name = None
        elif name in DROPPED:
            if not end:
                ends = closing(source) if ends is None else ends
                at = max(at, ends.get(begin, at))
            name = None
        yield begin, at, end, name, attributes


def parse(source: str) -> Page:
    page = Page()
    stack = [(0, "#root")]
    held: list[str] = []
    links = linked = marks = 0
    opened: Counter[str] = Counter()

    def cut(k: int) -> None:
        """Close the open elements from place ``k`` on."""
        opened.subtract(name for _, name in stack[k:])
        del stack[k:]

    def close_run() -> None:
        nonlocal linked, marks
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                node = page.add(stack[-1][0], "#text")
                page.text[node], page.linked[node], page.marks[node] = text, min(linked, len(text)), marks
        linked = marks = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            held.append(piece)
            if links:
                linked += len(piece)

    at = 0
    for begin, stop, end, name, attributes in markup(source):
        text(source[at: begin])
        at = stop
        if name is None:
            continue
        if name in INLINE:
            marks += 1
            if name == "a":
                links = max(0, links - 1) if end else links + 1
            elif name == "br":
                held.append(" ")
            continue
        close_run()
        if end:
            if opened[name] > 0:
                k = len(stack) - 1
                while stack[k][1] != name:
                    k -= 1
                cut(k)
                links = 0
            continue
        if name in VOID:
            continue
        ends = {"p"} if name in ENDS_P else SAME.get(name, ())
        if any(opened[e] > 0 for e in ends):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] in ends:
                    cut(k)
                    break
                if stack[k][1] in SCOPE:
                    break
        good = bad = 0
        if attributes:
            for _, a, b, c in ATTRIBUTE.findall(attributes):
                words = set(WORD.findall((a or b or c).lower()))
                good += len(words & GOOD)
                bad += len(words & BAD)
        stack.append((page.add(stack[-1][0], name, good, bad), name))
        opened[name] += 1
    rest = source[at:]
    if rest:
        text(rest)
    close_run()
    return page


SENTENCE = re.compile(r"[.!?…](?=\s|$)")


def features(pages: list[Page]) -> np.ndarray:
    """A row a node of all pages, in order."""
    size = [len(p.parent) for p in pages]
    n = sum(size)
    base = np.repeat(np.cumsum([0, *size[:-1]]), size) if n else np.zeros(0, np.int64)
    flat = lambda name: [x for p in pages for x in getattr(p, name)]
    parent = np.array(flat("parent"), np.int64) + base
    root = parent < base
    parent[root] = np.flatnonzero(root)
    depth = np.array(flat("depth"), np.int64)
    kind = np.array([KIND.get(t, 0) for t in flat("tag")], np.int64)
    texts = flat("text")
    chars = np.array([len(t) for t in texts], float)
    sums = np.stack([
        chars, np.array([t.count(" ") + 1 if t else 0 for t in texts], float), np.array(flat("linked"), float),
        np.array(flat("marks"), float), np.array([len(SENTENCE.findall(t)) if t else 0 for t in texts], float),
        (kind == KIND["p"]).astype(float), (kind == KIND["li"]).astype(float), np.ones(n), (chars > 0).astype(float)], 1)
    good, bad = np.array(flat("good"), float), np.array(flat("bad"), float)
    bad_tag = np.isin(kind, [KIND[k] for k in ("nav", "header", "footer", "aside", "form")]).astype(float)
    good_tag = np.isin(kind, [KIND["article"], KIND["main"]]).astype(float)
    up = np.stack([good, bad, bad_tag, good_tag], 1)
    # Depth by depth: subtree sums from the leaves up, what stands above from the root down.
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.searchsorted(depth[by_depth], np.arange(1, int(depth.max(initial=0)) + 1)))
    for at in levels[:0:-1]:
        np.add.at(sums, parent[at], sums[at])
    above = np.zeros_like(up)
    for at in levels[1:]:
        above[at] = above[parent[at]] + up[parent[at]]
    children = np.bincount(parent[~root], minlength=n).astype(float)
    siblings = children[parent]
    order = np.zeros(n)
    by_parent = np.argsort(parent, kind="stable")
    first = np.r_[True, parent[by_parent][1:] != parent[by_parent][:-1]] if n else np.zeros(0, bool)
    order[by_parent] = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else 0
    whole = sums[base, 0]
    per = lambda a, b: a / np.maximum(b, 1.0)
    text, word, link, mark, end, p, li, nodes, runs = sums.T
    sibling_text = sums[parent, 0] - text
    plain = np.stack([
        np.log1p(text), np.log1p(word), per(link, text), per(mark, word), per(end, word), per(text, nodes),
        per(text, runs), per(p, nodes), per(li, nodes), per(text, whole), np.minimum(depth, 30), children,
        siblings, per(order, siblings), per(sibling_text, np.maximum(siblings - 1, 1)), per(text, sums[parent, 0]),
        good, bad, above[:, 0], above[:, 1], above[:, 2], above[:, 3], bad_tag], 1)
    tags = (kind[:, None] == np.arange(1, len(KINDS) + 1)[None, :]).astype(float)
    return np.concatenate([plain, tags], 1)


def decode(page: Page, score: np.ndarray) -> list[str]:
    """Accepted text runs in page order, under the labelling of the largest total score that has no contradiction.

    ``forced`` is what a subtree gives if its top is accepted: an accepted element takes every part that gives more
    than nothing, and where there is none the least bad one, as it must hold accepted text.
    """
    n = len(page.parent)
    own = score.tolist()
    gain, least = [0.0] * n, [-math.inf] * n
    only = [0] * n
    forced = [-math.inf] * n
    for v in range(n - 1, 0, -1):
        up = page.parent[v]
        below = 0.0 if page.tag[v] == "#text" else gain[v] if gain[v] > 0 else least[v]
        forced[v] = own[v] + below
        if forced[v] > 0:
            gain[up] += forced[v]
        if forced[v] >= least[up]:
            least[up], only[up] = forced[v], v
    kept = [True] + [False] * (n - 1)
    out = []
    for v in range(1, n):
        up = page.parent[v]
        if kept[up] and (forced[v] > 0 or (up > 0 and gain[up] <= 0 and only[up] == v)):
            kept[v] = True
            if page.tag[v] == "#text":
                out.append(page.text[v])
    return out


# ---- training -------------------------------------------------------------------------

MAIN = ('<article{0}>', '<main{0}>', '<div class="content"{0}>', '<div id="main-content"{0}>',
        '<div class="post-body entry"{0}>', '<section class="story"{0}>', '<div{0}>', '<article class="post"{0}>',
        '<div role="main"{0}>', '<td class="text"{0}>')
CLUTTER = (
    ('<nav><ul>{links}</ul></nav>', 3), ('<div class="menu"><ul>{links}</ul></div>', 1),
    ('<header><div>{short}</div></header>', 1), ('<div class="ad">{line}</div>', 3),
    ('<div class="advert-box"><p>{line}</p><a href="#">{short}</a></div>', 1),
    ('<aside>{lines}</aside>', 1), ('<div class="sidebar"><h3>{short}</h3><ul>{links}</ul></div>', 1),
    ('<div id="cookie-notice"><p>{line}</p></div>', 1), ('<div role="alert" class="notice">{line}</div>', 1),
    ('<form action="/s"><label>{short}</label><p>{line}</p></form>', 1),
    ('<section id="comments"><h2>{short}</h2>{comments}</section>', 2),
    ('<div class="comments">{comments}</div>', 2), ('<div class="related"><ul>{links}</ul></div>', 1),
    ('<div class="newsletter"><p>{line}</p></div>', 1), ('<div class="breadcrumbs">{inline}</div>', 1),
    ('<div class="share">{inline}</div>', 1))
FOOT = ('<footer>&copy; {short} &middot; {line}</footer>', '<footer><p>{line}</p><ul>{links}</ul></footer>',
        '<div id="footer">{line}</div>', '')


def training_page(blocks: list[str], rng: random.Random) -> str:
    """A page from text blocks; its main parts carry the attribute ``data-main`` (no feature)."""
    words = " ".join(blocks).split() or ["word"]
    piece = lambda a, b: entities.escape(" ".join(words[(i := rng.randrange(len(words))): i + rng.randint(a, b)]))

    def fill(template: str) -> str:
        link = lambda: f'<a href="/{rng.randrange(99)}">{piece(1, 4)}</a>'
        return template.format(
            short=piece(1, 4), line=piece(4, 24), lines="".join(f"<p>{piece(4, 20)}</p>" for _ in range(rng.randint(1, 4))),
            links="".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 9))),
            inline=" ".join(link() for _ in range(rng.randint(2, 5))),
            comments="".join(f'<div class="{rng.choice(["comment", "reply", "item"])}"><b>{piece(1, 2)}</b><p>{piece(5, 60)}</p></div>'
                             for _ in range(rng.randint(1, 6))))

    clutter = lambda n: "".join(fill(t) for t in rng.choices([c for c, _ in CLUTTER], [w for _, w in CLUTTER], k=n))
    body = []
    if rng.random() < 0.8:
        title = f"<h1>{piece(1, 12)}</h1>"
        body.append(f"<header>{title}</header>" if rng.random() < 0.15 else title)
    for b in blocks or [""]:
        b = entities.escape(b)
        roll = rng.random()
        body.append(f"<p>{b}</p>" if roll < 0.7 else f"<p><b>{b}<br>" if roll < 0.8 else f"<blockquote><p>{b}</p></blockquote>"
                    if roll < 0.85 else f"<h2>{piece(1, 6)}</h2><p>{b}</p>" if roll < 0.9 else
                    f"<ul>{''.join(f'<li>{piece(2, 20)}</li>' for _ in range(rng.randint(2, 5)))}</ul>" if roll < 0.95
                    else f"<div>{b}</div>" if roll < 0.98 else b)
        if rng.random() < 0.04:
            body.append(f'<div class="ad" data-not>{piece(4, 20)}</div>')
    main = rng.choice(MAIN).format(" data-main")
    close = "</" + re.match(r"<(\w+)", main)[1] + ">"
    wrap = ("<table><tr>", "</tr></table>") if close == "</td>" else rng.choice((("", ""), ("", ""), ('<div class="wrapper">', "</div>"), ('<div id="page">', "</div>")))
    page = (f"<body>{clutter(rng.randint(1, 4))}{wrap[0]}{main}{''.join(body)}{close}{wrap[1]}"
            f"{clutter(rng.randint(0, 3))}{fill(rng.choice(FOOT))}</body></html>")
    return page[: rng.randint(len(page) // 2, len(page))] if rng.random() < 0.1 else page


def _truth(source: str) -> tuple[Page, np.ndarray]:
    """The page and, for each node, whether main text lies in it."""
    attributes = [words for _, _, end, name, words in markup(source) if name and not end and name not in INLINE
                  and name not in VOID]
    page = parse(source)
    inside = np.zeros(len(page.parent), bool)
    holds = np.zeros(len(page.parent), bool)
    elements = iter(attributes)
    for v in range(1, len(page.parent)):
        own = next(elements) if page.tag[v] != "#text" else ""
        inside[v] = ("data-main" in own or inside[page.parent[v]]) and "data-not" not in own
        holds[v] = inside[v] and page.tag[v] == "#text"
    for v in range(len(page.parent) - 1, 0, -1):
        holds[page.parent[v]] |= holds[v]
    return page, holds


def train(sources: list[str], variants: int = VARIANTS, seed: int = SEED) -> BoostedTrees | None:
    """Trees from the text blocks of sampled pages; None without pages."""
    rng = random.Random(seed)
    pages, truth = [], []
    for source in sources:
        blocks = [t for t in parse(source).text if len(t) >= 3]
        for _ in range(variants):
            some = rng.sample(blocks, min(len(blocks), rng.randint(1, 24))) if blocks else []
            page, holds = _truth(training_page(some, rng))
            pages.append(page)
            truth.append(holds)
    if not pages:
        return None
    return BoostedTrees().fit(features(pages), np.concatenate(truth).astype(float))


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> BoostedTrees | None:
    """Trains on the ``sample`` pages that come first by hash; the driver holds at most that many excerpts."""
    keyed = pages.filter("html is not null").select(F.xxhash64("html", "url").alias("h"), "html")
    # Hashes alone choose the pages, so that tasks send the driver a few numbers, not each its own pages.
    chosen = [r["h"] for r in keyed.select("h").distinct().orderBy("h").limit(sample).collect()]
    if not chosen:
        return None
    rows = (keyed.filter(F.col("h") <= chosen[-1]).select("h", F.substring("html", 1, SAMPLE_CHARS).alias("html"))
            .dropDuplicates(["h"]).collect())
    rows = sorted(rows, key=lambda r: (r["h"], r["html"]))
    return train([r["html"] for r in rows])


def extract(pages: DataFrame, model: BoostedTrees | None) -> DataFrame:
    """page_id, url, text: one row a page."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                parsed = [parse(h or "") for h in part.column("html").to_pylist()]
                score = trees.log_odds(features(parsed)) if trees else np.zeros(sum(len(p.parent) for p in parsed))
                score = np.clip(score, -6.0, 6.0)
                cut = np.cumsum([0, *(len(p.parent) for p in parsed)])
                texts = ["\n".join(decode(p, score[i:j])) for p, i, j in zip(parsed, cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                                                 names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string")


def digest(extracted: DataFrame) -> DataFrame:
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
