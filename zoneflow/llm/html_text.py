"""Main text of web pages by a tree-structured graphical model.

Every block element of a page and every run of text inside one is a node with two states, content or not. A node's features
(tag, words of class, id and role, length, links, punctuation) give its own potential, a parent and a child share a potential
by kind of parent. Sum-product messages go up the tree and down again; runs whose content marginal is above one half are the
text. Weights are learned from labelled pages by the exact gradient, which the same messages give.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import hashed_sample

#: Elements whose text no reader sees as text.
SKIPPED = {"script", "style", "template", "noscript", "iframe", "svg", "select", "button", "textarea", "title", "object", "canvas"}
#: Those of them that hold text alone: they end at their first end tag, or with the page. The others hold elements.
RAW = {"script", "style", "noscript", "iframe", "textarea", "title"}
#: Elements that stand in a line of text; all others are blocks.
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "dfn", "del", "em", "font", "i", "img", "ins", "input",
    "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr", "meta", "link", "source", "area", "base", "col", "embed", "param", "track",
}
VOID_BLOCKS = {"hr"}
#: An element that opens ends an open one of these, up to the container.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
#: Words of class, id and role, by what they hint at; a word counts with the first group that has it.
HINTS = {
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs toc tabs pagination pager skip toolbar",
    "head": "header masthead topbar banner hero branding logo",
    "foot": "footer colophon copyright legal bottom credits",
    "side": "sidebar aside side rail widget widgets related recommended trending more secondary complementary",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted dfp outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall message dialog",
    "talk": "comment comments commentlist discussion disqus replies reply respond reviews feedback",
    "form": "form login signup search searchbox contact register input",
    "share": "share sharing social follow tags meta byline author",
    "text": "article content post entry story main body text page prose blog hentry",
}
HINT_OF = {word: group for group, words in reversed(HINTS.items()) for word in words.split()}
MARKED = {"article", "main", "nav", "header", "footer", "aside", "form", "menu", "dialog", "figure", "ul", "ol", "table"}

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|data-y)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HINT_WORD = re.compile(r"[a-z]+")
_SENTENCE_END = (".", "!", "?", "…", "。", ".\"", ".”")


@dataclass
class Page:
    """Nodes in page order: parent (always earlier), kind of parent link, features; of runs also the text."""

    parent: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)
    features: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    label: list[str | None] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)

    def add(self, parent: int, kind: int, features: tuple[str, ...], text: str | None, label: str | None) -> int:
        for values, value in zip((self.parent, self.kind, self.features, self.text, self.label),
                                 (parent, kind, features, text, label), strict=True):
            values.append(value)
        return len(self.parent) - 1


def _skipped_to(source: str, name: str, at: int) -> int:
    """Where an unread element ends whose start tag ends at ``at``: behind its own end tag, not that of an equal one inside.

    Without an end tag one that holds text alone takes the rest of the page, and of another one only the start tag is skipped."""
    depth = 1
    for tag in re.compile(rf"<(/?){re.escape(name)}\b([^>]*)>", re.I).finditer(source, at):
        if tag[1]:
            depth = 0 if name in RAW else depth - 1
        elif not tag[2].endswith("/"):
            depth += 1
        if not depth:
            return tag.end()
    return len(source) if name in RAW else at


def parse(source: str) -> Page:
    """The page's tree. Broken markup is read as far as it goes: open elements end with their parent or the page."""
    page = Page()
    page.add(-1, 0, ("tag=root",), None, None)
    stack: list[tuple[str, int, int, str | None]] = [("root", 0, 0, None)]  # name, node, kind of its links, label
    run: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                name, node, kind, label = stack[-1]
                page.add(node, kind, _run_features(name, text, linked), text, label)
            run.clear()
        linked = 0

    at, end = 0, len(source)
    while at < end:
        start = source.find("<", at)
        if start < 0:
            start = end
        if start > at:
            run.append(source[at:start])
            linked += (start - at) * (in_link > 0)
        if start == end:
            break
        if source.startswith("<!--", start):
            close = source.find("-->", start + 4)
            at = end if close < 0 else close + 3
            continue
        following = source[start + 1:start + 2]
        if following in ("!", "?"):
            close = source.find(">", start)
            at = end if close < 0 else close + 1
            continue
        if not (following.isalpha() or following == "/"):
            run.append("<")
            at = start + 1
            continue
        match = _TAG.match(source, start)
        if not match:  # a tag that never ends, or one that is no tag
            close = source.find(">", start)
            at = end if close < 0 else close + 1
            continue
        at, closing, name, attributes = match.end(), match[1] == "/", match[2].lower(), match[3]
        if name in SKIPPED:
            if not closing and not attributes.endswith("/"):
                at = _skipped_to(source, name, at)
            continue
        if name in INLINE:
            if name == "a":
                in_link = max(0, in_link + (-1 if closing else 1))
            elif name in ("br", "wbr", "img", "input"):
                run.append(" ")
            continue
        flush()
        in_link = 0
        if name in VOID_BLOCKS:
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                del stack[depth:]
            continue
        if stack[-1][0] == "p":
            stack.pop()
        if name in ENDS:
            ended, holders = ENDS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in holders:
                    break
                if stack[i][0] in ended:
                    del stack[i:]
                    break
        given = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
        hints = sorted({
            HINT_OF[w] for k in ("class", "id", "role") if k in given for w in _HINT_WORD.findall(given[k].lower()) if w in HINT_OF})
        _, parent, kind, label = stack[-1]
        label = given.get("data-y", label)
        if name in FURNITURE or any(h != "text" for h in hints):
            kind = 4  # furniture says little about what holds it
        node = page.add(parent, kind, (f"tag={name if name in KNOWN else 'other'}", *(f"hint={h}" for h in hints)), None, label)
        if not attributes.endswith("/"):
            stack.append((name, node, _link_kind(name, hints), label))
    flush()
    page.weight = _weights(page)
    return page


def _weights(page: Page) -> list[float]:
    """How much each node's features count: the runs of one container look alike, so many of them tell no more than a few.

    Runs and text elements are counted by the nearest element that holds them and is none itself.
    """
    holder = list(range(len(page.parent)))
    text = [own is not None or tag[0].removeprefix("tag=") in TEXT_BLOCKS for own, tag in zip(page.text, page.features, strict=True)]
    for i, is_text in enumerate(text):
        if is_text:
            holder[i] = holder[page.parent[i]]
    runs, elements = Counter(), Counter()
    for i, is_text in enumerate(text):
        if is_text:
            (elements if page.text[i] is None else runs)[holder[i]] += 1
    return [
        1.0 if not is_text else min(1.0, ALIKE / (elements if page.text[i] is None else runs)[holder[i]])
        for i, is_text in enumerate(text)]


#: Runs of one container whose features count in full.
ALIKE = 4


def _link_kind(name: str, hints: list[str]) -> int:
    """Kind of the links from an element to what it holds: the page itself, plain containers, telling ones, text elements."""
    if name in ("html", "body"):
        return 0
    if name in TEXT_BLOCKS:
        return 3
    return 2 if hints or name in MARKED else 1


FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "dt", "dd", "td", "th", "figcaption"}
#: Block tags with a weight of their own.
KNOWN = MARKED | TEXT_BLOCKS | {"html", "body", "head", "div", "section", "tr", "dl"}


def _run_features(parent: str, text: str, linked: int) -> tuple[str, ...]:
    size, links = len(text), linked / max(1, len(text))
    return (
        f"in={parent if parent in KNOWN else 'other'}",
        f"size={'short' if size < 30 else 'middle' if size < 120 else 'long'}",
        f"links={'none' if not linked else 'some' if links < 0.5 else 'most'}",
        "end" if text.endswith(_SENTENCE_END) else "no-end",
    )


@dataclass
class TreeModel:
    """Log-odds weight of each feature, and the coupling of each kind of parent link: its log potential is that for equal
    states and minus that for unequal ones, so a parent's many children only ever lend it what they are themselves."""

    weights: dict[str, float] = field(default_factory=dict)
    links: list[float] = field(default_factory=lambda: [0.0] * 5)

    def tables(self) -> list[list[float]]:
        """Potentials of (0,0), (0,1), (1,0), (1,1), parent first."""
        return [[math.exp(c), math.exp(-c), math.exp(-c), math.exp(c)] for c in self.links]

    def own(self, page: Page) -> list[float]:
        get = self.weights.get
        return [w * sum(get(f, 0.0) for f in features) for features, w in zip(page.features, page.weight, strict=True)]

    def messages(self, page: Page) -> tuple[list[float], list[float], list[float]]:
        """Sum-product, exact on a tree. Log-odds of each node (its marginal), of its subtree alone, and of its parent without it."""
        tables = self.tables()
        n, parent, kind = len(page.parent), page.parent, page.kind
        below = self.own(page)  # collects messages from children, which have higher numbers
        up = [0.0] * n
        for i in range(n - 1, 0, -1):
            odds = math.exp(max(-30.0, min(30.0, below[i])))
            t = tables[kind[i]]
            up[i] = math.log((t[2] + t[3] * odds) / (t[0] + t[1] * odds))
            below[parent[i]] += up[i]
        total, outside = below[:], [0.0] * n
        for i in range(1, n):
            outside[i] = total[parent[i]] - up[i]
            odds = math.exp(max(-30.0, min(30.0, outside[i])))
            t = tables[kind[i]]
            total[i] += math.log((t[1] + t[3] * odds) / (t[0] + t[2] * odds))
        return total, below, outside

    def extract(self, source: str | None) -> str:
        """Content runs of a page in page order, one per line; empty for a null page."""
        if not source:
            return ""
        page = parse(source)
        total, _, _ = self.messages(page)
        return "\n".join(t for t, odds in zip(page.text, total, strict=True) if t is not None and odds > 0)


def labels_of(page: Page) -> list[int]:
    """States of a labelled page: of a run its nearest label, of an element whether any run below is content."""
    states = [int(label == "1" and text is not None) for label, text in zip(page.label, page.text, strict=True)]
    for i in range(len(states) - 1, 0, -1):
        states[page.parent[i]] |= states[i]
    return states


def train(pages: list[str], rounds: int = 80, rate: float = 0.6) -> TreeModel:
    """Weights that maximise the likelihood of labelled pages (``data-y`` on containers), by full gradient steps."""
    parsed = [(page, labels_of(page)) for page in map(parse, pages)]
    model, scale = TreeModel(), max(1, len(parsed))
    seen: dict[str, float] = defaultdict(float)
    for _ in range(rounds):
        slopes: dict[str, float] = defaultdict(float)
        link_slopes = [0.0] * len(model.links)
        tables = model.tables()
        for page, states in parsed:
            total, below, outside = model.messages(page)
            for i, features in enumerate(page.features):
                miss = states[i] - 1 / (1 + math.exp(-max(-30.0, min(30.0, total[i]))))
                for name in features:
                    slopes[name] += miss * page.weight[i]
                if i:
                    a, b = (math.exp(max(-30.0, min(30.0, x))) for x in (outside[i], below[i]))
                    t = tables[page.kind[i]]
                    joint = [t[0], t[1] * b, t[2] * a, t[3] * a * b]
                    equal = (joint[0] + joint[3]) / sum(joint)
                    link_slopes[page.kind[i]] += 2 * ((states[page.parent[i]] == states[i]) - equal)
        # Steps shrink with a weight's past slopes; a slight pull keeps weights finite.
        for name, slope in slopes.items():
            slope = slope / scale - 0.002 * model.weights.get(name, 0.0)
            seen[name] += slope**2
            model.weights[name] = model.weights.get(name, 0.0) + rate * slope / math.sqrt(seen[name] + 1e-9)
        for k, slope in enumerate(link_slopes):
            slope = slope / scale - 0.002 * model.links[k]
            seen[f"link {k}"] += slope**2
            model.links[k] += rate * slope / math.sqrt(seen[f"link {k}"] + 1e-9)
    return model


def labelled_variants(sources: list[str], seed: int = 4) -> list[str]:
    """Labelled pages from pages with an ``article``: its runs are content, all others are not.

    The same runs are laid out in many ways (other containers, other words in class and id, more kinds of furniture), so that
    the model learns what all these mark and not one site's layout. Without such pages, made-up runs are laid out.
    """
    rng = random.Random(seed)
    pages = []
    for source in sources or ["<article><p>Some plain words make one sentence here.</p></article><footer>Other words</footer>"] * 40:
        page = parse(source)
        inside = [False] * len(page.parent)
        for i in range(1, len(inside)):
            inside[i] = inside[page.parent[i]] or page.features[i][0] == "tag=article"
        content = [t for t, x in zip(page.text, inside, strict=True) if x and t]
        other = [t for t, x in zip(page.text, inside, strict=True) if not x and t] or ["Other words"]
        if content:
            pages.append(_lay_out(content[:12], other, rng))
    return pages


def _lay_out(content: list[str], other: list[str], rng: random.Random) -> str:
    def group(*names: str) -> str:
        return rng.choice(" ".join(HINTS[n] for n in names).split())

    def element(tag: str, attributes: str, inner: str, y: int | None = None) -> str:
        mark = "" if y is None else f' data-y="{y}"'
        return f"<{tag}{attributes}{mark}>{inner}</{tag}>"

    def some_text() -> str:
        return html.escape(rng.choice(other if rng.random() < 0.6 else content))

    def links() -> str:
        items = "".join(f'<li><a href="/x">{html.escape(w)}</a></li>' for w in some_text().split()[:6])
        return f"<ul>{items}</ul>" if rng.random() < 0.8 else items.replace("li>", "span>")

    def named(tags: str, *hints: str) -> tuple[str, str]:
        tag = rng.choice(tags.split())
        return tag, f' {rng.choice(("class", "id"))}="{group(*hints)}"' if tag in ("div", "section") or rng.random() < 0.4 else ""

    def furniture(kind: str) -> str:
        tags = {"menu": "nav div", "head": "header div", "foot": "footer div", "side": "aside div section", "ad": "div aside",
                "notice": "div dialog section", "talk": "section div", "form": "form", "share": "div"}[kind]
        tag, attributes = named(tags, kind)
        inner = links() if kind in ("menu", "share") or rng.random() < 0.3 else "".join(
            element(rng.choice(("p", "div", "li")), "", some_text()) if rng.random() < 0.7 else some_text()
            for _ in range(rng.randint(1, 3)))
        return element(tag, attributes, inner, 0)

    # Some runs are cut short: where a run stands says more than how long it is.
    cut = rng.choice((0.1, 0.4, 1.0))
    content = [" ".join(t.split()[: rng.randint(1, 6)]) + rng.choice(("", ".")) if rng.random() < cut else t for t in content]
    paragraphs = [element("h1" if i == 0 and rng.random() < 0.5 else rng.choice(("p", "p", "p", "p", "li", "blockquote", "h2", "div")), "",
                          f"<b>{html.escape(t)}</b>" if rng.random() < 0.2 else html.escape(t)) for i, t in enumerate(content)]
    if rng.random() < 0.2:
        paragraphs = [element("section", "", "".join(paragraphs[k::2])) for k in range(min(2, len(paragraphs)))]
    if rng.random() < 0.5:  # furniture inside the article
        paragraphs.insert(rng.randrange(len(paragraphs) + 1), furniture(rng.choice(("ad", "share", "notice", "side", "form"))))
    if rng.random() < 0.4:
        paragraphs.append(furniture("talk"))
    tag, attributes = named("article article article main div div section", "text")
    body = element(tag, attributes, "".join(paragraphs), 1)
    if rng.random() < 0.3:
        body = element("div", rng.choice(("", ' id="wrapper"', ' class="row"')), body)
    kinds = [k for k in ("head", "menu", "notice", "ad") if rng.random() < 0.6]
    after = [k for k in ("side", "talk", "ad", "form", "share", "foot") if rng.random() < 0.6]
    return "<html><body>" + "".join(map(furniture, kinds)) + body + "".join(map(furniture, after)) + "</body></html>"


def fit(pages: DataFrame, sample: int = 300, max_chars: int = 20_000) -> TreeModel:
    """Trains on at most ``sample`` pages with an ``article`` of at most ``max_chars`` characters, by smallest hash of the id."""
    usable = (F.length("html") <= max_chars) & F.lower("html").contains("<article")
    rows = hashed_sample(pages.select("page_id", "html"), F.xxhash64("page_id"), sample, usable).collect()
    return train(labelled_variants([r.html for r in rows]))


def extract_text(pages: DataFrame, model: TreeModel) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per input row; the text of a null, empty or contentless page is empty.

    Character references are decoded, white space inside a run is one space, runs are joined by line feeds, and nothing else
    is dropped or cut. Other columns are ignored, repeated rows get equal rows, an empty table gives an empty result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sources in batches:
            yield pd.Series([shared.value.extract(source) for source in sources], dtype=object)

    return pages.select("page_id", "url", text("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
