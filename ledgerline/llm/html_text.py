"""Operator 6: main text of web pages by tag-path ratios.

A page is cut into leaf blocks, each with its path of tags from the root; containers carry their class and id in
the path. For each path the page's text length, punctuation and link text are summed over its leaves. A path's
ratio is characters per leaf, weighed by punctuation and by the share of text outside links; paths through a container
that names itself navigation, header, footer, advert, comments and the like get 0. Names on html, body, main and
article do not count, nor does a name like has-sidebar on a container with over half of the page's text outside aside
tags, nor a plain one like comments, which may outweigh a short article, if hardly any text is left beside it. Ratios are smoothed over
neighbouring leaves in page order, so a heading between paragraphs is not lost, and fused per container.

Where a page has articles or mains, the one of the highest fused ratio is content, whole but for asides: other
articles beside it are readers' or other stories. Within a main the same choice goes on as long as one article holds ``MOST`` of
its ratio; headings right before that article are its own. An article inside an article is a reader's comment.
Elsewhere the containers whose fused ratio reaches ``THRESHOLD`` of the page's highest select the
content: every block under their lowest common container, except asides. That container is widened
to its parent as long as the parent adds neither asides nor blocks that are all links, and in it such blocks are
content only as headings or beside chosen text. Blocks that are not shown (hidden, display:none) are asides.

Character references are decoded, white space in a block becomes one space, blocks are joined by one line
feed in page order; nothing else is dropped. Each page is worked on alone and whole.

NULL or empty pages give an empty text, as do pages without any block. Unclosed tags end with the page;
a tag cut off by the page's end is markup. Repeated rows are worked on each; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm.arrow import append_columns
from ledgerline.llm.tables import long_field

THRESHOLD = 0.15
MOST = 0.6
SPREAD = 1.0

# Names from HTML, and words that sites use for what is not the article.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "img", "ins", "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
SILENT = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object"}
ASIDE_TAGS = {
    "nav", "aside", "header", "footer", "form", "menu", "dialog", "button", "select", "head",
}
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disqus", "footer", "header", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup",
    "promo", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
CONTENT_TAGS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
FRAME_TAGS = {"html", "body", *CONTENT_TAGS}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
}
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<silent>script|style|noscript|template|textarea|title|iframe|svg|object)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|</?[a-z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.I | re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(
    r"(?:^|\s)(?:hidden(?=[\s=/]|$)(?!\s*=\s*[\"']?until)|aria-hidden\s*=\s*[\"']?true)"
    r"|\bstyle\s*=\s*(?:\"[^\"]*?|'[^']*?)(?:display\s*:\s*none|visibility\s*:\s*hidden)",
    re.I,
)
#: Stands among a step's names if its container is not shown.
NOT_SHOWN = "!"
_WORD = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")
_MARKS = re.compile(r"[.,;:!?…。，、]")


class Leaf:
    """A block of text: its path, its text, how much of that is in links, and the articles and mains that hold
    it, by their number on the page, outermost first."""

    __slots__ = ("path", "text", "linked", "frames")

    def __init__(self, path: tuple[str, ...], text: str, linked: int, frames: tuple[int, ...] = ()):
        self.path, self.text, self.linked, self.frames = path, text, linked, frames


def _step(tag: str, rest: str) -> str:
    names = [w for m in _NAMES.findall(rest) for w in "".join(m).lower().split()]
    return ".".join([tag, *names, NOT_SHOWN] if _HIDDEN.search(rest) else [tag, *names])


@lru_cache(maxsize=1 << 14)
def _aside_share(step: str) -> float:
    """Up to which share of the page's text a container of these names is an aside."""
    tag, *names = step.split(".")
    if tag in FRAME_TAGS:
        return 0.0
    if any(name in ASIDE_WORDS for name in names):
        return 1 - THRESHOLD
    return 0.5 if any(w in ASIDE_WORDS for name in names for w in _WORD.split(name)) else 0.0


def _in_aside_tag(path: tuple[str, ...]) -> bool:
    """Whether a tag of the path is something else than article. A header within an article is the
    article's own."""
    inside = False
    for step in path:
        tag = step.split(".", 1)[0]
        if tag in ASIDE_TAGS and not (tag == "header" and inside):
            return True
        if step.endswith(f".{NOT_SHOWN}"):
            return True
        inside = inside or tag in CONTENT_TAGS
    return False


def _asides(lengths: dict[tuple[str, ...], int]) -> set[tuple[str, ...]]:
    """The paths, given with the length of their text, of which a step names itself something else
    than article."""
    out = {path for path in lengths if _in_aside_tag(path)}
    total = sum(length for path, length in lengths.items() if path not in out)
    containers: dict[tuple[int, str], int] = {}
    held: dict[int, int] = defaultdict(int)
    for path, length in lengths.items():
        at = 0
        for step in path:
            at = containers.setdefault((at, step), len(containers) + 1)
            held[at] += 0 if path in out else length
    for path in lengths:
        at = 0
        for step in path:
            at = containers[at, step]
            if (share := _aside_share(step)) and held[at] <= share * total:
                out.add(path)
                break
    return out


def leaves(page: str) -> list[Leaf]:
    """The blocks of a page in page order."""
    out: list[Leaf] = []
    stack: list[str] = []
    tags: list[str] = []
    parts: list[str] = []
    frames: list[int] = []  # of each open tag, 0 if it is neither article nor main
    links = linked = opened = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if links:
            linked += len(text.strip())

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            held = tuple(f for f in frames if f)
            out.append(Leaf(tuple(stack), text, min(linked, len(text)), held))
        parts.clear()
        linked = 0

    def shut(last: int) -> None:
        flush()
        del stack[last:], tags[last:], frames[last:]

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if m["close"] else 1
            if tag == "br":
                parts.append(" ")
            continue
        flush()
        links = 0
        if m["close"]:
            if tag in tags:
                shut(len(tags) - 1 - tags[::-1].index(tag))
            continue
        if tag in CLOSES_P and "p" in tags:
            shut(len(tags) - 1 - tags[::-1].index("p"))
        while tags and tags[-1] in SIBLINGS.get(tag, ()):
            shut(len(tags) - 1)
        if tag not in VOID and not m["rest"].endswith("/"):
            stack.append(_step(tag, m["rest"]))
            tags.append(tag)
            opened += tag in CONTENT_TAGS
            frames.append(opened if tag in CONTENT_TAGS else 0)
    if at < len(page):
        add(page[at:])
    flush()
    return out


def path_ratios(blocks: list[Leaf]) -> tuple[dict[tuple[str, ...], float], set[tuple[str, ...]]]:
    """Characters per leaf of each path, by punctuation and by text outside links, 0 for asides;
    and the asides."""
    sums: dict[tuple[str, ...], list[int]] = defaultdict(lambda: [0, 0, 0, 0])
    for leaf in blocks:
        s = sums[leaf.path]
        s[0] += 1
        s[1] += len(leaf.text)
        s[2] += len(_MARKS.findall(leaf.text))
        s[3] += leaf.linked
    asides = _asides({path: length for path, (_, length, _, _) in sums.items()})
    ratio = {
        path: 0.0 if path in asides else length / n * (1 + marks / n) * (1 - linked / length)
        for path, (n, length, marks, linked) in sums.items()
    }
    return ratio, asides


def _is_heading(path: tuple[str, ...]) -> bool:
    return bool(path) and path[-1].split(".", 1)[0] in HEADINGS


def _widened(
    root: tuple[str, ...], ratio: dict[tuple[str, ...], float], asides: set[tuple[str, ...]]
) -> tuple[str, ...]:
    """The root's outermost container of which the leaves outside the root are neither asides nor,
    but for headings, all links."""
    shared = []  # of each path that ends it: how many steps it has in common with the root
    for path, value in ratio.items():
        k = 0
        while k < min(len(root), len(path)) and root[k] == path[k]:
            k += 1
        if path in asides or not (value or _is_heading(path)):
            shared.append(k)
    ends = [k for k in shared if k < len(root)]
    return root[: max(ends) + 1] if ends else ()


def content(blocks: list[Leaf]) -> list[Leaf]:
    """The blocks of the main text."""
    ratio, asides = path_ratios(blocks)
    if not any(ratio.values()):
        return []
    raw = [math.log1p(ratio[leaf.path]) for leaf in blocks]
    weight = [math.exp(-((k / SPREAD) ** 2) / 2) for k in range(-2, 3)]
    smooth = []
    for i in range(len(raw)):
        near = [
            (w, raw[j]) for w, j in zip(weight, range(i - 2, i + 3), strict=True) if 0 <= j < len(raw)
        ]
        smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    weight_of: dict[int, float] = defaultdict(float)
    fused: dict[tuple[str, ...], float] = defaultdict(float)
    for leaf, value in zip(blocks, smooth, strict=True):
        if ratio[leaf.path]:
            fused[leaf.path[:-1]] += value * len(leaf.text)
            for frame in leaf.frames:
                weight_of[frame] += value * len(leaf.text)
    if weight_of:
        return _framed(blocks, weight_of, asides)
    top = max(fused.values())
    chosen = [path for path, value in fused.items() if value >= THRESHOLD * top]
    root = chosen[0]
    for path in chosen:
        k = 0
        while k < min(len(root), len(path)) and root[k] == path[k]:
            k += 1
        root = root[:k]
    held = set(chosen)
    root = _widened(root, ratio, asides)
    return [
        leaf
        for leaf in blocks
        if leaf.path not in asides
        and leaf.path[: len(root)] == root
        and (ratio[leaf.path] or leaf.path[:-1] in held or _is_heading(leaf.path))
    ]


def _framed(
    blocks: list[Leaf], weight_of: dict[int, float], asides: set[tuple[str, ...]]
) -> list[Leaf]:
    """The blocks of the page's heaviest article or main."""
    tag_of: dict[int, str] = {}
    below: dict[int, set[int]] = defaultdict(set)
    for leaf in blocks:
        tags = [t for t in (step.split(".", 1)[0] for step in leaf.path) if t in CONTENT_TAGS]
        tag_of.update(zip(leaf.frames, tags, strict=True))
        for outer, inner in zip((0, *leaf.frames), leaf.frames, strict=False):
            below[outer].add(inner)

    def heaviest(outer: int) -> int:
        return max(below[outer], key=lambda f: (weight_of.get(f, 0.0), -f))

    frame, parent = heaviest(0), 0
    while tag_of[frame] == "main" and below[frame]:
        inner = heaviest(frame)
        if weight_of.get(inner, 0.0) < MOST * weight_of[frame]:
            break
        frame, parent = inner, frame
    whole_article = tag_of[frame] == "article"
    out: list[Leaf] = []
    before: list[Leaf] = []  # headings right before the article
    for leaf in blocks:
        if leaf.path in asides:
            continue
        if frame in leaf.frames:
            inside = leaf.frames[leaf.frames.index(frame) + 1 :]
            if not (whole_article and any(tag_of[f] == "article" for f in inside)):
                out.append(leaf)
        elif not out and parent in leaf.frames and _is_heading(leaf.path):
            before.append(leaf)
        elif not out:
            before.clear()
    return before + out


def main_text(page: str | None) -> str:
    return "\n".join(leaf.text for leaf in content(leaves(page))) if page else ""


_TEXT = T.StructType([T.StructField("text", T.StringType()), *long_field("n_chars")])


def extract(pages: DataFrame) -> DataFrame:
    """The table (with ``html``) and its ``text`` and ``n_chars``."""

    def work(part: pa.RecordBatch) -> dict:
        texts = [main_text(page) for page in part.column("html").to_pylist()]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return append_columns(pages, "html", _TEXT, work)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``."""
    made = extract(pages.select("page_id", "url", F.col("html")))
    return made.select("page_id", "url", "text", "n_chars")
