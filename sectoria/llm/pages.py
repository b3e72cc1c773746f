"""Main text of web pages by paths on which the pages of a host agree.

Each page is read once into containers and text blocks. Every container is scored by the text below it, and the page votes
for its best containers by their path: tags with their classes, digits generalised. Spark sums the votes per host; the path
with most votes is read from all pages of the host. Pages that lack it, and pages without a host, fall back to their own
best container.

Names of classes and forms only make a container suspect. It is left out if it holds less than half of the page's text or if
enough sentences stand outside; a wrapper of the article is not, nor is an article or what the host's pages agree on.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .languages import host_of

VOTES = 3
# HTML's tags by their role.
RAW = ("script", "style", "template", "textarea", "iframe", "noscript", "svg", "select", "title")
CONTAINERS = frozenset(
    "html head body div article section main nav aside header footer form ul ol dl table blockquote figure details dialog "
    "fieldset menu".split()
)
BREAKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption figcaption pre hr address summary legend".split())
NEVER = frozenset("head nav footer aside dialog menu fieldset".split())
CONTROLS = frozenset("button label output meter progress".split())
# Words of classes, ids and roles that name what is not the article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side aside menu nav navbar "
    "navigation breadcrumb breadcrumbs footer contentinfo cookie cookies consent notice notices notification gdpr popup modal "
    "overlay comment comments reply replies disqus discussion respond share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login search complementary alert dialog toolbar pagination pager skip masthead "
    "widget trending popular".split()
)
# A suspect with most of the text is left out if sentences of this share of it stand outside.
OUTSIDE = 0.1
WEAK, STRONG = 1, 2
LIKELY = frozenset("article content entry main post story text".split())

# A tag that lacks its end stops before the next one, so that no search for an end goes on to the end of the page each time.
QUOTED = r"""\"[^\"]*+\"|'[^']*+'"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(RAW)})\b(?:(?:{QUOTED}|[^<>\"'])*+>|[^<>]*+>).*?(?:</(?P=raw)\s*+>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:{QUOTED}|[^<>\"'])*+)(?:>|(?=<))|<[!?][^<>]*+(?:>|(?=<))",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[a-z]+|[0-9]+")
CAMEL = re.compile(r"([a-z])([A-Z])")


@dataclass(slots=True)
class Container:
    label: str
    # Length of this container's path if the path asked for starts with it, else -1.
    matched: int
    tag: str
    parent: int
    beside: bool
    likely: float
    depth: int
    hidden: bool
    suspect: int
    in_article: bool


@dataclass(slots=True)
class Page:
    containers: list[Container] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def path(self, place: int) -> str:
        """Labels from the root down to a container."""
        labels = []
        while place > 0:
            labels.append(self.containers[place].label)
            place = self.containers[place].parent
        return "".join(f">{label}" for label in reversed(labels))

    def summed(self, own: list) -> list:
        """Sum of ``own`` over each container and all below it; containers come before those below them."""
        total = list(own)
        for i in range(len(total) - 1, 0, -1):
            total[self.containers[i].parent] += total[i]
        return total


def _described(tag: str, rest: str, in_article: bool) -> tuple[str, bool, int, float]:
    """Generalised name of an element, whether it is never read, whether it is suspect, and a factor for likely names."""
    names: list[str] = []
    label = tag
    suspect = WEAK if tag == "form" else 0
    beside = tag in NEVER or (tag == "header" and not in_article)
    if rest:
        for kind, *values in ATTRIBUTE.findall(rest):
            value, kind = next((v for v in values if v), ""), kind.lower()
            if kind == "hidden" or (kind == "aria-hidden" and value == "true"):
                beside = True
            elif kind == "style":
                beside |= "display:none" in value.replace(" ", "").lower()
            else:
                words = NAME.findall(CAMEL.sub(r"\1 \2", value).lower())
                names += words
                for name in CAMEL.sub(r"\1 \2", value).lower().split() if tag not in ("article", "main", "body", "html") else ():
                    parts = NAME.findall(name)
                    if not BESIDE.isdisjoint(parts):
                        # "comment-list" names a box beside, "has-comments" may name a layout.
                        suspect = max(suspect, STRONG if parts[0] in BESIDE else WEAK)
                if kind == "class":
                    label += "".join("." + re.sub(r"\d+", "#", c) for c in sorted(set(value.lower().split())))
    factor = 1.6 if tag in ("article", "main") or "main" in names else 1.3 if not LIKELY.isdisjoint(names) else 1.0
    if suspect or (tag == "article" and not BESIDE.isdisjoint(names)):
        factor = 1.0
    return label, beside, suspect, factor


def _is_sentence(words: str) -> bool:
    return len(words) >= 60 or words[-1] in ".!?…:;\"'»”"


def _below(page: Page, tops: set[int]) -> list[bool]:
    within = [False] * len(page.containers)
    for i, c in enumerate(page.containers):
        within[i] = i in tops or (c.parent >= 0 and within[c.parent])
    return within


def settle(page: Page, path: str | None) -> None:
    """Decides which suspect containers stand beside the article; those around ``path`` and on it do not."""
    containers = page.containers

    def around(c: Container) -> bool:
        return path is not None and c.matched >= 0 and (c.matched == len(path) or path[c.matched] == ">")

    suspects = [i for i, c in enumerate(containers) if c.suspect and not c.hidden and not around(c)]
    blocks = [b for b in page.blocks if not containers[b[0]].hidden]
    out: set[int] = set()
    if suspects:
        own, own_links = [0] * len(containers), [0] * len(containers)
        for place, words, linked in blocks:
            own[place] += len(words)
            own_links[place] += linked
        text, links = page.summed(own), page.summed(own_links)
        out = {i for i in suspects if 2 * text[i] < text[0]}
        gone = _below(page, out)
        main = _below(page, {i for i, c in enumerate(containers) if c.tag in ("article", "main")})
        anywhere, in_main = [0] * len(containers), [0] * len(containers)
        for place, words, _ in blocks:
            if not gone[place] and _is_sentence(words):
                anywhere[place] += len(words)
                in_main[place] += len(words) if main[place] else 0
        anywhere, in_main = page.summed(anywhere), page.summed(in_main)
        last = page.summed([1] * len(containers))
        left, left_main, covered = anywhere[0], in_main[0], 0
        # Outer ones first: what stands outside a wrapper says nothing about the boxes in it.
        for i in suspects:
            if i in out or not text[i]:
                continue
            inner = i < covered or gone[i]
            if containers[i].suspect == WEAK:
                outside = left_main - (0 if inner else in_main[i])
            else:
                outside = left - (0 if inner else anywhere[i])
            if outside and (outside >= OUTSIDE * text[i] or 2 * links[i] > text[i]):
                out.add(i)
                if not inner:
                    left, left_main, covered = left - anywhere[i], left_main - in_main[i], i + last[i]
        if out and left < OUTSIDE * text[0]:
            # Names of layouts on all parts of the text.
            out = {i for i in out if containers[i].suspect == STRONG}
            beside = _below(page, out)
            if all(beside[place] for place, _, _ in blocks):
                out = set()
    below = _below(page, out)
    for i, c in enumerate(containers):
        c.beside = c.hidden or below[i]


def read_page(html: str, path: str | None = None) -> Page:
    """Containers and text blocks of a page in one pass; what is left open is closed by what contains it."""
    page = Page([Container("", 0, "", -1, False, 1.0, 0, False, 0, False)])
    stack = [0]
    # How many containers of a tag are open, and which tags came up at all.
    opened: Counter[str] = Counter()
    seen: set[str] = set()
    text: list[str] = []
    linked = 0
    in_link = in_control = False
    end = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join(references.unescape("".join(text)).split())
            if words:
                page.blocks.append((stack[-1], words, min(linked, len(words))))
            text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not in_control:
            text.append(piece)
            if in_link:
                linked += len(piece)

    for token in TOKEN.finditer(html):
        add(html[end : token.start()])
        end = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = not token["close"]
        elif tag in CONTROLS:
            in_control = not token["close"]
        elif tag == "br":
            text.append(" ")
        elif tag in BREAKS:
            flush()
            in_link = in_control = False
            if tag not in CONTAINERS:
                continue
            if token["close"]:
                closing = opened[tag] > 0
                while closing:
                    last = page.containers[stack.pop()].tag
                    opened[last] -= 1
                    closing = last != tag
                continue
            if tag in ("html", "body"):
                if tag in seen:
                    continue
                while len(stack) > 1 and page.containers[stack[-1]].tag != "html":
                    opened[page.containers[stack.pop()].tag] -= 1
            seen.add(tag)
            above = page.containers[stack[-1]]
            inside = above.in_article or above.tag == "article"
            label, beside, suspect, likely = _described(tag, token["rest"] or "", inside)
            matched = -1
            if path is not None and above.matched >= 0 and path.startswith(f">{label}", above.matched):
                matched = above.matched + 1 + len(label)
            hidden = above.hidden or beside
            page.containers.append(
                Container(label, matched, tag, stack[-1], False, likely, above.depth + 1, hidden, suspect, inside)
            )
            if not token["rest"].endswith("/"):
                stack.append(len(page.containers) - 1)
                opened[tag] += 1
    add(html[end:])
    flush()
    settle(page, path)
    return page


def container_scores(page: Page) -> list[float]:
    """Text below each container; text of links and of short blocks that end like no sentence counts against it."""
    own = [0.0] * len(page.containers)
    for place, words, linked in page.blocks:
        if not page.containers[place].beside:
            own[place] += len(words) - 3.0 * linked if _is_sentence(words) or not linked else -2.0 * linked
    return [s * c.likely for s, c in zip(page.summed(own), page.containers, strict=True)]


def ranked_containers(page: Page) -> list[tuple[float, int]]:
    """Containers with text, best first; of equal ones the deepest, then the first of the page."""
    scored = [(s, i) for i, s in enumerate(container_scores(page)) if s > 0 and not page.containers[i].beside]
    return sorted(scored, key=lambda x: (-x[0], -page.containers[x[1]].depth, x[1]))


def page_votes(html: str) -> dict[str, float]:
    """Paths of the page's best containers, each with the square of its share of the best score.

    A container that holds no text besides that of a container within votes for nothing.
    """
    page = read_page(html)
    votes: dict[str, float] = {}
    ranked = ranked_containers(page)
    seen: set[float] = set()
    for score, i in ranked:
        text = score / page.containers[i].likely
        if text in seen and page.containers[i].likely == 1.0:
            continue
        seen.add(text)
        votes.setdefault(page.path(i), (score / ranked[0][0]) ** 2)
        if len(votes) == VOTES:
            break
    return votes


def main_text(html: str, path: str | None) -> str:
    """Blocks below all containers on ``path``, or else below the page's best container; what stands beside is left out."""
    page = read_page(html, path)
    chosen = {i for i, c in enumerate(page.containers) if path is not None and c.matched == len(path) and not c.beside}
    if not chosen:
        chosen = {i for _, i in ranked_containers(page)[:1]}
    within = _below(page, chosen)
    return "\n\n".join(words for place, words, _ in page.blocks if within[place] and not page.containers[place].beside)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # Votes of one host are summed here before they are shuffled.
        votes: dict[tuple[str, str], float] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
            for path, share in page_votes(html.as_py() or "").items():
                votes[host, path] = votes.get((host, path), 0.0) + share
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([h for h, _ in votes], type=pa.string()),
                pa.array([p for _, p in votes], type=pa.string()),
                pa.array(list(votes.values()), type=pa.float64()),
            ],
            names=["host", "path", "votes"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            pairs = zip(part.column("html"), part.column("path").to_pylist(), strict=True)
            texts = [main_text(html.as_py() or "", path) for html, path in pairs]
            columns = {n: part.column(n) for n in part.schema.names if n not in ("html", "path")}
            yield pa.RecordBatch.from_pydict(columns | {"text": pa.array(texts, type=pa.string())})


def consensus_paths(pages: DataFrame) -> DataFrame:
    """Winning path of every host: most votes, then the longest, then the last in alphabetical order."""
    known = pages.select(host_of(F.col("url")).alias("host"), "html").where(F.col("host").isNotNull())
    votes = known.mapInArrow(_vote, "host string, path string, votes double").groupBy("host", "path").agg(
        F.round(F.sum("votes"), 6).alias("votes")
    )
    best = F.max_by("path", F.struct("votes", F.length("path"), "path")).alias("path")
    return cut_lineage(votes.groupBy("host").agg(best))


def extracted(pages: DataFrame) -> DataFrame:
    """Main text of every page: ``page_id``, ``url``, ``text`` and ``n_chars`` (its code points).

    Character references are decoded, white space inside a block becomes one space, blocks are joined by two line breaks in
    page order. Null, empty and text-free html give an empty text. Repeated rows get a row each, null ids and addresses
    stay null, further columns are not looked at.
    """
    located = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    chosen = located.join(consensus_paths(pages), "host", "left").select("page_id", "url", "html", "path")
    texts = chosen.mapInArrow(_extract, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
