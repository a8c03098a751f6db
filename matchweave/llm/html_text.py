"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm.words import by_bytes

#: Width of the smoothing over neighbouring blocks, in blocks.
SMOOTHING = 1.0
#: A path is content if its ratio reaches this share of the standard deviation of the ratios of a page.
STRICTNESS = 0.5
#: Share of the content's text that an element has to hold for its other lines to count as content too.
COVERAGE = 0.8
#: Share of link text from which a block below the threshold counts as a menu.
LINKED = 0.8
#: What the ratio of a path counts for whose elements say by a word that they are no content, and by their kind.
MARK_WEIGHT, KIND_WEIGHT = 0.2, 0.05
#: Share of a page's text from which a marked element is graded by itself.
MOST = 0.5
#: The ratio of a sentence, which kinds of elements have to beat where nothing is beside them.
SENTENCE = math.log1p(80) * math.log(4)
#: What the text of an article or main element counts for at least, beside marked elements.
ARTICLE = math.log1p(2_000) * math.log(100)
#: Open elements whose path is told apart; deeper ones count to the path of the last.
DEPTH = 128

# HTML elements by kind.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search"
    " section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are not shown as text, and kinds that stand beside the content.
UNSEEN = set("head button select datalist svg math canvas object audio video".split())
OUTSIDE = set("nav footer aside dialog menu search".split())
#: An element whose start ends an open one of these kinds, up to the next of the second kinds.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
}
#: Words in class, id or role that mark what is no content.
MARKS = set(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentary"
    " commentlist consent cookie cookies disclaimer discussion disqus footer gdpr masthead menu menubar modal nav navbar"
    " navigation newsletter notice notices notification overlay pagination popup promo promoted promotion recommended"
    " related remark replies reply respond responses share sharing sidebar signup skip social sponsor sponsored subscribe"
    " subscription tags toolbar toc widget widgets".split()
)
#: Marks that only count outside the content's own element.
OUTER_MARKS = {"header"}
#: Marks of an article element that is a reader's comment.
COMMENT_MARKS = {"comment", "reply"}
PUNCTUATION = frozenset(".,;:!?…。，、；：！？؟،")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$|["'])""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Block:
    __slots__ = ("path", "chain", "parts", "linked", "text")

    def __init__(self, path: tuple[str, ...], chain: tuple[int, ...]):
        self.path, self.chain, self.linked, self.text = path, chain, 0, ""
        # text, inside a link, numbers of the open elements with marks
        self.parts: list[tuple[str, bool, tuple[int, ...]]] = []

    def settle(self, dropped: set[int]) -> bool:
        """Put the text together without what is in a dropped element; is there any?"""
        parts = [(text, link) for text, link, marks in self.parts if not dropped.intersection(marks)]
        self.linked = sum(len(text) for text, link in parts if link)
        self.text = " ".join(html.unescape("".join(text for text, _ in parts)).split())
        return bool(self.text)


def _marked(name: str, attributes: str, inside_article: bool) -> bool | frozenset[str]:
    """True if the element is not shown, else the words (and, in angle brackets, the kind) by which it says that it is no content."""
    if name in UNSEEN:
        return True
    marks = {f"<{name}>"} if name in OUTSIDE or (name == "header" and not inside_article) else set()
    if name == "form":
        marks.add("form")
    if not attributes or name in ("html", "body"):
        return frozenset(marks)
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key in ("class", "id", "role"):
            words = set(_WORD.findall(value.lower())) | set(_WORD.findall(_CAMEL.sub(" ", value).lower()))
            marks |= words & (COMMENT_MARKS if name in ("article", "main") else MARKS)
            if not inside_article:
                marks |= words & OUTER_MARKS
            if key == "role":
                marks |= words & {"complementary", "contentinfo", "search", "alert", "dialog"}
    return frozenset(marks)


def blocks_of(source: str, strictness: float = STRICTNESS) -> list[_Block]:
    """Text blocks in page order, each with the path of block elements from the root; what is no content left out."""
    blocks, marks = _all_blocks(source)
    dropped = _no_content(blocks, marks, strictness) if marks else set()
    return [block for block in blocks if block.settle(dropped)]


def _all_blocks(source: str) -> tuple[list[_Block], dict[int, frozenset[str]]]:
    """All blocks outside elements that are never content, and the marks of elements by number."""
    blocks: list[_Block] = []
    marks: dict[int, frozenset[str]] = {}
    # open elements: name, number, never content
    stack: list[tuple[str, int, bool]] = []
    open_marks: list[int] = []
    number, skipped, links, articles, current, at = 0, 0, 0, 0, None, 0
    deeper: dict[str, int] = {}

    def pop_to(index: int) -> None:
        nonlocal skipped, links, articles, current
        while len(stack) > index:
            name, closed, never = stack.pop()
            skipped -= never
            if open_marks and open_marks[-1] == closed:
                open_marks.pop()
            links -= name == "a"
            articles -= name in ("article", "main")
            if name in BLOCK:
                current = None

    def add(text: str) -> None:
        nonlocal current
        if skipped or not text:
            return
        if current is None:
            if text.isspace():
                return
            inside = [e for e in stack if e[0] in BLOCK]
            current = _Block(tuple(e[0] for e in inside), tuple(e[1] for e in inside))
            blocks.append(current)
        current.parts.append((text, links > 0, tuple(open_marks)))

    end = len(source)
    while at < end:
        token = _TOKEN.search(source, at)
        if token is None:
            add(source[at:])
            break
        add(source[at : token.start()])
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            if token[0].startswith("<![CDATA["):
                add(token[0][9:].removesuffix("]]>"))
            continue
        if token[1] or token[4]:  # an end tag
            if name == "br":
                add(" ")
            if deeper.get(name):
                deeper[name] -= 1
                current = None if name in BLOCK else current
                continue
            for index in range(len(stack) - 1, -1, -1):
                if stack[index][0] == name:
                    pop_to(index)
                    break
                if stack[index][0] in BLOCK and name not in BLOCK:  # an inline end tag closes no block
                    break
            if name in BLOCK:
                current = None
            continue
        attributes = token[3] or token[6] or ""
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
            at = close.end() if close else end
            continue
        if name in BLOCK:
            current = None
            if stack and name not in ("html", "body", "head"):
                last = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCK), None)
                if last is not None and stack[last][0] == "p":
                    pop_to(last)
            if name == "body":
                for index, (open_name, _, _) in enumerate(stack):
                    if open_name == "head":
                        pop_to(index)
                        break
        if name in CLOSES:
            kinds, border = CLOSES[name]
            first = None
            for index in range(len(stack) - 1, -1, -1):
                if stack[index][0] in border:
                    break
                if stack[index][0] in kinds:
                    first = index
            if first is not None:
                pop_to(first)
        if name in VOID:
            if name in ("br", "wbr", "hr"):
                add("" if name == "wbr" else " ")
            continue
        if attributes.rstrip().endswith("/") and name not in BLOCK:
            continue
        if len(stack) >= DEPTH:
            deeper[name] = deeper.get(name, 0) + 1
            continue
        number += 1
        marked = _marked(name, attributes, articles > 0)
        stack.append((name, number, marked is True))
        skipped += marked is True
        if marked and marked is not True:
            marks[number] = marked
            open_marks.append(number)
        links += name == "a"
        articles += name in ("article", "main")

    return blocks, marks


def _no_content(blocks: list[_Block], marks: dict[int, frozenset[str]], strictness: float) -> set[int]:
    """The marked elements to drop, decided by the path ratios of the whole page.

    Elements with the same marks, as deep among their like, are graded together, one with most of the page's text by itself. Marks only lower the ratio of what is in them; the
    elements go if that is less than ``strictness`` times the ratio beside them: the best of the blocks that are in no marked
    element, in one that stays, or in one around them. So a mark in a layout's name drops nothing, and
    comments longer than the text go. The most text is graded first. An element stays that holds an article or main
    element (no comment) of at least half the text of any beside it.
    """
    blocks = [block for block in blocks if block.settle(set())]
    ratios = path_ratios(blocks, marks) if blocks else []
    # text of each article outside the marked elements in it, and the marked elements around it
    sizes: dict[int, int] = {}
    around: dict[int, tuple[int, ...]] = {}
    # groups of elements, and for each distinct chain of marked elements its text and best ratio
    kinds: dict[int, tuple[frozenset[str], int]] = {}
    chains: dict[tuple[int, ...], list[float]] = {}
    for block, ratio in zip(blocks, ratios):
        articles = [e for name, e in zip(block.path, block.chain) if name in ("article", "main") and not marks.get(e, frozenset()) & COMMENT_MARKS]
        share = 1 - min(block.linked / max(len(block.text), 1), 1)
        for text, _, inside in block.parts:
            chars = len(text.strip())
            if not chars:
                continue
            for n, e in enumerate(inside):
                if e not in kinds:
                    kinds[e] = marks[e], sum(marks[outer] == marks[e] for outer in inside[:n])
            seen = chains.setdefault(inside, [0, 0.0])
            seen[0] += chars
            seen[1] = max(seen[1], ratio)
            for article in articles if share else ():
                if not inside or inside[-1] < article:
                    sizes[article] = sizes.get(article, 0) + chars
                    around[article] = inside
    stays = {None}  # and the groups that hold an article
    for element in marks:
        inner = max((n for a, n in sizes.items() if element in around[a]), default=0)
        outer = max((n for a, n in sizes.items() if element not in around[a]), default=0)
        if inner and 2 * inner >= outer:
            stays.add(element)
    whole = sum(chars for chars, _ in chains.values())
    size: dict[int, float] = {}
    for inside, (chars, _) in chains.items():
        for element in inside:
            size[element] = size.get(element, 0) + chars
    groups: dict[tuple, set[int]] = {}
    for element, kind in kinds.items():
        if element not in stays:
            groups.setdefault((*kind, element if size[element] >= MOST * whole else 0), set()).add(element)
    held = {kind: sum(chars for inside, (chars, _) in chains.items() if own.intersection(inside)) for kind, own in groups.items()}
    dropped: set[int] = set()
    for kind in sorted(groups, key=lambda k: (-held[k], k[1], sorted(k[0]), k[2])):
        own = groups[kind]
        inner = [(inside, best) for inside, (_, best) in chains.items() if own.intersection(inside)]
        above = {e for inside, _ in inner for e in inside[: min(inside.index(e) for e in own.intersection(inside))]}
        beside = [best for inside, (_, best) in chains.items() if not own.intersection(inside) and all(e in stays or e in above for e in inside)]
        weight, least = (KIND_WEIGHT, SENTENCE) if any(m[0] == "<" for m in kind[0]) else (MARK_WEIGHT, 0)
        if any(size > 0 and not own.intersection(around[a]) and all(e in stays or e in above for e in around[a]) for a, size in sizes.items()):
            beside.append(ARTICLE)
        if weight * max(best for _, best in inner) < strictness * max(beside, default=least):
            dropped |= own
        else:
            stays |= own
    return dropped


def path_ratios(blocks: list[_Block], marks: dict[int, frozenset[str]] | None = None) -> list[float]:
    """The fused, smoothed ratio of each block's path; with ``marks`` paths through differently marked elements are apart.

    A path's ratio is its mean text length times its mean punctuation count (both plus one, in logarithms, so that
    one long node does not drown the others), lowered by its share of link text.
    """
    sums: dict[tuple, list[float]] = {}
    paths = [(block.path, tuple(marks[e] for e in block.parts[0][2]) if marks and block.parts else ()) for block in blocks]
    for block, path in zip(blocks, paths):
        seen = sums.setdefault(path, [0, 0, 0, 0])
        seen[0] += 1
        seen[1] += len(block.text)
        seen[2] += sum(c in PUNCTUATION for c in block.text)
        seen[3] += min(block.linked, len(block.text))
    fused = {
        path: math.log1p(chars / n) * math.log(2 + marks / n) * (1 - linked / chars) for path, (n, chars, marks, linked) in sums.items()
    }
    raw = [fused[path] for path in paths]
    if marks is not None:
        return raw
    reach = max(1, math.ceil(3 * SMOOTHING))
    weights = [math.exp(-(d * d) / (2 * SMOOTHING * SMOOTHING)) for d in range(reach + 1)]
    out = []
    for i in range(len(raw)):
        total = mass = 0.0
        for j in range(max(0, i - reach), min(len(raw), i + reach + 1)):
            weight = weights[abs(i - j)]
            total += weight * raw[j]
            mass += weight
        out.append(total / mass)
    return out


def _is_content(blocks: list[_Block], ratios: list[float], strictness: float = STRICTNESS) -> list[bool]:
    """Which blocks are above the threshold and no menu; all, if none is."""
    mean = sum(ratios) / len(ratios)
    limit = strictness * math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    content = [r >= limit and b.linked < LINKED * len(b.text) for b, r in zip(blocks, ratios)]
    return content if any(content) else [True] * len(blocks)


def main_text(source: str | None, strictness: float = STRICTNESS) -> str:
    """The content blocks of a page, one per line; empty if there are none. ``strictness`` scales both thresholds."""
    blocks = blocks_of(source or "", strictness)
    if not blocks:
        return ""
    ratios = path_ratios(blocks)
    content = _is_content(blocks, ratios, strictness)
    return "\n".join(block.text for block, keep in zip(blocks, _chosen(blocks, content)) if keep)


def _chosen(blocks: list[_Block], content: list[bool]) -> list[bool]:
    """All content blocks, and what stands with them: lines of the content's elements and between content blocks.

    The content's elements are each article or main element with content, and the deepest element with most of the
    content. Of the other blocks there, only menus are left out: elements of several lines that are nearly all links,
    above the content of an element that is no article, or beside content right in the body. Outside these elements,
    blocks between content blocks are kept, without menus.
    """
    held: dict[int, int] = {}
    first: dict[int, int] = {}
    named: dict[int, tuple[str, int]] = {}
    for i, (block, good) in enumerate(zip(blocks, content)):
        if good:
            for depth, (name, element) in enumerate(zip(block.path, block.chain)):
                held[element] = held.get(element, 0) + len(block.text)
                first.setdefault(element, i)
                named[element] = (name, depth)
    whole = sum(len(b.text) for b, good in zip(blocks, content) if good)
    wide = [e for e, chars in held.items() if chars >= COVERAGE * whole and named[e][0] not in ("p", "li", "td", "tr", "h1", "h2", "h3")]
    root = max(wide, key=lambda e: named[e][1], default=None)
    articles = {e for e, (name, _) in named.items() if name in ("article", "main")}
    begin, end = content.index(True), len(content) - content[::-1].index(True)

    # other blocks by the deepest element with content around them and the branch of it that they are in
    places: list[tuple[int, object] | None] = []
    branches: dict[object, list[int]] = {}
    for i, (block, good) in enumerate(zip(blocks, content)):
        if good:
            places.append(None)
            continue
        depth = next((d for d in range(len(block.chain) - 1, -1, -1) if block.chain[d] in held), -1)
        branch = block.chain[depth + 1] if depth + 1 < len(block.chain) else ("line", i)
        places.append((depth, branch))
        seen = branches.setdefault(branch, [0, 0, 0])
        seen[0] += 1
        seen[1] += len(block.text)
        seen[2] += min(block.linked, len(block.text))

    chosen = []
    for i, (block, place) in enumerate(zip(blocks, places)):
        if place is None:
            chosen.append(True)
            continue
        depth, branch = place
        lines, chars, linked = branches[branch]
        menu = lines > 1 and linked >= LINKED * chars
        between = begin < i < end
        around = block.chain[: depth + 1]
        if articles.intersection(around):
            chosen.append(True)
        elif root is None or root in around:
            nearest = named[around[-1]][0] if around else "body"
            above = i < first[around[-1]] if around else i < begin
            chosen.append(not menu or not above and (between or nearest not in ("html", "body")))
        else:
            chosen.append(between and not menu)
    return chosen


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "_html"):
        texts = [main_text(source) for source in batch.column("_html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_page"),
                batch.column("_url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``: the main text of the whole HTML.

    Text nodes are put together into blocks (a block element ends one; line breaks and runs of white space become one
    space). Each root-to-leaf path of block elements gets a ratio of text length, punctuation and link text; ratios
    are smoothed over neighbouring blocks and fused, and paths above a threshold are content. All content gives the
    text, with the short blocks of its elements and between them (titles, single lines). Menus, notices, adverts, forms and reader
    comments go by their ratios: kind, class, id and role of an element only weigh what its paths' ratio counts for against that of
    the text beside it, so they drop no element without better text beside it. Elements nested more than ``DEPTH`` deep count to the path of the last.

    Null or empty HTML and pages without text give an empty text. Broken HTML (missing end tags, stray brackets) is
    read as far as it goes. Every row is answered by itself, repeated ids too; an empty table gives no rows; other columns are
    not read.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("_page"), F.col("url").cast("string").alias("_url"), F.col("html").alias("_html")
    )
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
