"""Main text of web pages by wrapper induction.

Every page is reduced to the tree of its block elements with a hash of each
one's text.  Per host one page of the commonest structure serves as the frame;
the trees of all other pages of the host are aligned with it by simple tree
matching.  Pages that hardly match (other layouts) and the parts of pages that
have no counterpart in the frame (optional blocks) are grouped and aligned with
further frames.  Nodes whose text is the same on nearly all aligned pages are
the host's template, the others are slots.  A page's text is then read from the
slots of its article.  Only trees and hashes are compared and shuffled by host;
the pages themselves are joined once, by page, with what to leave out.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, text_slices

#: A node is template if on this share of the aligned pages it has the frame's text; one different
#: page besides the frame is enough.
SAME = 0.9
#: Rounds of frames: pages of a host, what those leave over, and what that leaves over.
ROUNDS = 3
#: A page tells template from slots only if this share of its texts is not on the frame page;
#: otherwise it is a near copy of that page, and what they share may be the article.
DIFFERENT = 0.25
_DEEPEST = 60
#: Cells of an alignment table held at once; longer lists are halved, with the same sum.
_MOST_CELLS = 4_000_000

# fixed values: element names by role
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noframes noembed iframe".split())
_BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption blockquote pre figure figcaption address header footer nav aside form "
    "fieldset details summary hr center dialog menu hgroup noscript template legend search".split()
)
_OUTSIDE = frozenset(
    "head script style title textarea noframes noembed iframe nav footer aside menu dialog "
    "template noscript button select option input svg canvas object video audio search".split()
)
_P_ENDS = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar tablist".split()
)
#: Whole class names or ids of comments, of other areas outside the article, and of those that
#: may as well hold content: the last are heeded only on pages without a template.
_COMMENTS = frozenset("comment comments commentlist comment-list comments-area disqus disqus_thread replies".split())
_AREAS = frozenset(
    "nav navbar navigation menu main-menu nav-menu main-nav site-nav breadcrumb breadcrumbs masthead "
    "site-header site-footer footer sidebar widget widgets widget-area ad ads advert adverts "
    "advertisement advertisements advertising adsense ad-slot ad-unit ad-banner ad-container ad-wrapper "
    "sponsored cookie cookies consent gdpr cookie-notice cookie-banner cookie-consent popup modal "
    "overlay newsletter newsletter-signup subscribe signup share sharing share-buttons social "
    "social-share social-links related related-posts related-articles recommended recommendations "
    "comment-respond login pager pagination skip-link".split()
)
_MAYBE = frozenset(
    "header side banner promo promoted promotion sponsor subscription notice notices alert reply "
    "respond search skip copyright legal disclaimer".split()
)
_COMMENT = re.compile(r"(?:div-)?comment(?:-(?:\d+|body|content|item))?")
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def _hidden(tag: str, own: dict[str, str]) -> bool:
    """Is an element's text no part of the page's prose at all?"""
    return tag in _OUTSIDE or bool(own) and (
        "hidden" in own or own.get("aria-hidden") == "true" or bool(_HIDDEN.search(own.get("style", "")))
    )


def _marked(tag: str, own: dict[str, str]) -> str:
    """What an element's role or whole class names say of it: comment, area, maybe, or nothing."""
    if tag == "form":
        return "area"
    if not own or tag in ("html", "body", "main"):
        return ""
    raw = f"{own.get('class', '')} {own.get('id', '')}".split()
    names = {n.lower() for n in raw} | {_CAMEL.sub(r"\1-\2", n).lower() for n in raw}
    if tag == "article":
        # an article's own class may name what it has, not what it is
        return "comment" if any(_COMMENT.fullmatch(n) for n in names) else ""
    if names & _COMMENTS:
        return "comment"
    if own.get("role", "").lower() in _ROLES or names & _AREAS:
        return "area"
    return "maybe" if names & _MAYBE else ""


_MARKS = frozenset(("hidden", "comment", "area", "maybe"))


class Page:
    """Block elements of a page in order: ``tag``, ``label``, ``parent``, ``mark``, and text.

    ``blocks`` lists ``(element, text)`` in page order, white space collapsed
    and empty ones left out, those of marked elements too.  ``mark`` is that of
    the outermost marked element around.  A mark does not count on an element
    that holds the article, the main element, a first heading or (but for
    comments) most of the page's text.
    """

    def __init__(self, source: str | None) -> None:
        # read again without the marks that hold too much
        self._read(source or "", frozenset())
        wrong = self._too_large()
        if wrong:
            self._read(source or "", wrong)

    def _too_large(self) -> frozenset[int]:
        size = self._sizes()
        wrong = {k for e, within in self.areas.items() if self.tag[e] == "h1" for k in within} - self.comments
        wrong.update(k for e, within in self.areas.items() if self.tag[e] == "main" for k in within)
        articles = [e for e in self.areas if self.tag[e] == "article" and size[e] and self.mark[e] not in ("comment", "hidden")]
        if articles:
            wrong.update(self.areas[max(articles, key=lambda e: (size[e], -e))])
        total = sum(len(t) for _, t in self.blocks) + sum(self.inline.values())
        held = [0] * self.n_marks
        for k, n in self.inline.items():
            held[k] += n
        for e, text in self.blocks:
            for k in self.areas[e]:
                held[k] += len(text)
        wrong.update(k for k, n in enumerate(held) if 2 * n > total and k not in self.comments)
        # an article that is a comment stays one
        return frozenset(wrong - self.comment_articles)

    def _read(self, source: str, unmarked: frozenset[int]) -> None:
        self.tag, self.label, self.parent, self.mark = ["#root"], ["#root"], [-1], [""]
        self.blocks: list[tuple[int, str]] = []
        #: numbers of the marks around each element, and characters in marks that are not blocks
        self.areas: dict[int, tuple[int, ...]] = {0: ()}
        self.inline: dict[int, int] = {}
        self.comments: set[int] = set()
        self.comment_articles: set[int] = set()
        self.n_marks = 0
        # the open elements: name, index of the block element, hidden, depth of blocks, marks, inline mark
        stack: list[tuple] = [("#root", 0, False, 0, (), -1, "")]
        held: list[str] = []

        def hold(text: str) -> None:
            if stack[-1][5] >= 0:
                self.inline[stack[-1][5]] = self.inline.get(stack[-1][5], 0) + len(text.strip())
            else:
                held.append(text)

        def close_block() -> None:
            if held:
                text = " ".join("".join(held).split())
                if text:
                    self.blocks.append((stack[-1][1], text))
                held.clear()

        def leave(depth: int) -> None:
            while len(stack) > depth:
                if stack[-1][0] in _BLOCK:
                    close_block()
                stack.pop()

        at = 0
        while at < len(source):
            m = _TAG.search(source, at)
            if not stack[-1][2]:
                hold(entities.unescape(source[at : m.start() if m else len(source)]))
            if not m:
                break
            at = m.end()
            if m[0].startswith("<![CDATA[") and not stack[-1][2]:
                hold(m[0][9:].removesuffix("]]>"))
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                if depth:
                    leave(depth)
                continue
            own = _attributes(m[3]) if m[3] else {}
            if tag in _P_ENDS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        leave(i)
                    if stack[i if i < len(stack) else -1][0] in _BLOCK:
                        break
            elif tag in _SIBLINGS:
                ends, within = _SIBLINGS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in within:
                        break
                    if stack[i][0] in ends:
                        leave(i)
                        break
            _, block, outside, depth, marks, inline, mark = stack[-1]
            # the header of a page is outside, that of an article is its title
            gone = outside or _hidden(tag, own)
            said = "" if gone else _marked(tag, own)
            if tag == "header" and not gone and not any(s[0] in ("article", "main") for s in stack):
                said = said or "area"
            if tag in _VOID:
                if tag in ("br", "hr") and not outside:
                    hold(" ")
                continue
            if said:
                number = self.n_marks
                self.n_marks += 1
                if said == "comment":
                    (self.comment_articles if tag == "article" else self.comments).add(number)
                if number not in unmarked:
                    marks, mark = (*marks, number), mark or said
                    if tag not in _BLOCK and inline < 0:
                        held.append(" ")
                        inline = number
            elif gone and not outside and tag not in _BLOCK:
                held.append(" ")
            if tag in _BLOCK:
                close_block()
                if depth < _DEEPEST:
                    name = (own.get("id") or own.get("class") or "").split()
                    self.tag.append(tag)
                    self.label.append(f"{tag}.{name[0]}" if name else tag)
                    self.parent.append(block)
                    self.mark.append("hidden" if gone else mark)
                    block, depth = len(self.tag) - 1, depth + 1
                    self.areas[block] = marks
            stack.append((tag, block, gone, depth, marks, inline, mark))
            if tag in _RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = end.start() if end else len(source)
        leave(1)
        close_block()

    def _sizes(self) -> list[int]:
        size = [0] * len(self.tag)
        for e, text in self.blocks:
            size[e] += len(text)
        for e in range(len(self.tag) - 1, 0, -1):
            size[self.parent[e]] += size[e]
        return size

    def article(self, heeded: frozenset[str] = _MARKS) -> set[int]:
        """Elements that may hold the article: all article and main elements, or all of the page."""
        size = self._sizes()
        inside: set[int] = set()
        for e, t in enumerate(self.tag):
            root = t in ("article", "main") and self.mark[e] not in heeded and size[e]
            if root or self.parent[e] in inside:
                inside.add(e)
        return inside or set(range(len(self.tag)))

    def tree(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(parent, label, text)`` per element: label hashes and text hashes, 0 without text."""
        texts: list[list[str]] = [[] for _ in self.tag]
        for e, text in self.blocks:
            texts[e].append(text)
        return (
            np.array(self.parent, dtype=np.int32),
            np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in self.label], np.uint32),
            np.array([_hash("\n".join(t)) if t else 0 for t in texts], dtype=np.int64),
        )

    def text(self, leave_out: frozenset[int] | None = None) -> str:
        """The article's blocks but marked ones and those of the elements in ``leave_out``.

        ``leave_out`` is None where no template is known; where one is, it
        decides on elements whose names are doubtful.
        """
        heeded = _MARKS if leave_out is None else _MARKS - {"maybe"}
        inside = self.article(heeded)
        own = [(e, t) for e, t in self.blocks if e in inside and self.mark[e] not in heeded]
        return "\n".join(t for e, t in own if e not in (leave_out or ()))


def _hash(text: str) -> int:
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True) or 1


def _children(parent: np.ndarray) -> list[list[int]]:
    kids: list[list[int]] = [[] for _ in parent]
    for c in range(1, len(parent)):
        kids[parent[c]].append(c)
    return kids


def _items(children: list[list[int]], label: np.ndarray, node: int) -> list[list[int]]:
    """A node's children, with runs of equal leaves taken together."""
    out: list[list[int]] = []
    for c in children[node]:
        last = out[-1] if out else None
        if last and not children[c] and not children[last[0]] and label[c] == label[last[0]]:
            last.append(c)
        else:
            out.append([c])
    return out


def _classes(kids: list[list[int]], tree: tuple) -> tuple[list[int], list[int]]:
    """Hashes of each node's subtree: of the labels alone, and with the texts."""
    bare, full = [0] * len(kids), [0] * len(kids)
    for e in range(len(kids) - 1, -1, -1):
        bare[e] = hash((int(tree[1][e]), *(bare[c] for c in kids[e])))
        full[e] = hash((int(tree[1][e]), int(tree[2][e]), *(full[c] for c in kids[e])))
    return bare, full


def _last_row(values, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """The last row of the table of best sums: all of ``xs`` with each head of ``ys``."""
    row = np.zeros(len(ys) + 1, dtype=np.int64)
    for x in xs:
        row[1:] = np.maximum(row[1:], row[:-1] + values(x, ys))
        np.maximum.accumulate(row, out=row)
    return row


def align_lists(values, xs: np.ndarray, ys: np.ndarray) -> list[tuple[int, int]]:
    """The order-preserving pairs of ``xs`` and ``ys`` with the largest sum of ``values(x, ys)``.

    A table of more than :data:`_MOST_CELLS` cells is halved by Hirschberg's
    method, so memory stays bounded and the result is exact at any length.
    """
    found: list[tuple[int, int]] = []
    todo = [(xs, ys)]
    while todo:
        xs, ys = todo.pop()
        if not len(xs) or not len(ys):
            continue
        if len(xs) > 1 and (len(xs) + 1) * (len(ys) + 1) > _MOST_CELLS:
            half = len(xs) // 2
            sums = _last_row(values, xs[:half], ys) + _last_row(values, xs[:half - 1:-1], ys[::-1])[::-1]
            cut = int(np.argmax(sums))
            todo += [(xs[:half], ys[:cut]), (xs[half:], ys[cut:])]
            continue
        best = np.zeros((len(xs) + 1, len(ys) + 1), dtype=np.int64)
        for i, x in enumerate(xs):
            best[i + 1, 1:] = np.maximum(best[i, 1:], best[i, :-1] + values(x, ys))
            np.maximum.accumulate(best[i + 1], out=best[i + 1])
        i, j = len(xs), len(ys)
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((int(xs[i]), int(ys[j])))
    return found


def match_trees(one: tuple, two: tuple) -> list[tuple[int, int]]:
    """Simple tree matching: the largest order-preserving matching of equal labels from the root.

    A run of equal leaves is matched as a whole, which changes nothing as any
    of them count one.  Among equally large matchings of a child list one with
    most equal texts is taken.
    """
    label_a, label_b = one[1], two[1]
    kids_a, kids_b = _children(one[0]), _children(two[0])
    bare_a, full_a = _classes(kids_a, one)
    bare_b, full_b = _classes(kids_b, two)
    sizes: dict[tuple[int, int], int] = {}

    def alike(x: list[int], y: list[int]) -> bool:
        return label_a[x[0]] == label_b[y[0]] and bool(kids_a[x[0]]) == bool(kids_b[y[0]])

    def pairs_of(x: list[int], y: list[int]) -> list[tuple[int, int]]:
        if kids_a[x[0]] and kids_b[y[0]]:
            return match(x[0], y[0])
        return list(zip(x, y, strict=False))

    def size_of(x: list[int], y: list[int]) -> int:
        if not alike(x, y):
            return 0
        if not kids_a[x[0]]:
            return min(len(x), len(y))
        key = bare_a[x[0]], bare_b[y[0]]
        if key not in sizes:
            sizes[key] = len(match(x[0], y[0]))
        return sizes[key]

    def match(a: int, b: int) -> list[tuple[int, int]]:
        xs, ys = _items(kids_a, label_a, a), _items(kids_b, label_b, b)
        found = [(a, b)]
        # nothing is larger than head on where all rows are of one class or no label comes twice
        if len(xs) == len(ys) and all(alike(x, y) for x, y in zip(xs, ys, strict=True)) and (
            len({label_a[x[0]] for x in xs}) == len(xs)
            or all(len(x) == len(y) and bare_a[x[0]] == bare_b[y[0]] for x, y in zip(xs, ys, strict=True))
        ):
            for x, y in zip(xs, ys, strict=True):
                found += pairs_of(x, y)
            return found
        # so are equal rows at both ends
        for end in (0, -1):
            same = 0
            for x, y in zip(xs[:: 2 * end + 1], ys[:: 2 * end + 1], strict=False):
                if [full_a[e] for e in x] != [full_b[e] for e in y]:
                    break
                found += pairs_of(x, y)
                same += 1
            if same:
                xs, ys = (xs[same:], ys[same:]) if end == 0 else (xs[:-same], ys[:-same])
        if not xs or not ys:
            return found
        # rows of one class have the same sizes
        kinds_a = {(bare_a[x[0]], len(x)): x for x in xs}
        kinds_b = {(bare_b[y[0]], len(y)): y for y in ys}
        number_a, number_b = ({k: i for i, k in enumerate(kinds)} for kinds in (kinds_a, kinds_b))
        class_a = np.array([number_a[bare_a[x[0]], len(x)] for x in xs])
        class_b = np.array([number_b[bare_b[y[0]], len(y)] for y in ys])
        text_a = np.array([hash(tuple(full_a[e] for e in x)) for x in xs])
        text_b = np.array([hash(tuple(full_b[e] for e in y)) for y in ys])
        # equal rows break ties: all of them together weigh less than one node
        weight = min(len(xs), len(ys)) + 1
        by_class: dict[int, np.ndarray] = {}

        def values(i: int, js: np.ndarray) -> np.ndarray:
            kind = class_a[i]
            if kind not in by_class:
                by_class[kind] = np.array([size_of(xs[i], y) for y in kinds_b.values()], dtype=np.int64) * weight
            size = by_class[kind][class_b[js]]
            return size + ((text_b[js] == text_a[i]) & (size > 0))

        for i, j in align_lists(values, np.arange(len(xs)), np.arange(len(ys))):
            found += pairs_of(xs[i], ys[j])
        return found

    return match(0, 0)


def _differs(texts: np.ndarray, frame: np.ndarray) -> bool:
    """Are enough of a page's texts (hashes, 0 for none) missing on the frame page?"""
    own = np.unique(texts[texts != 0])
    new = len(own) - np.isin(own, frame).sum()
    return new > 0 and new >= DIFFERENT * len(own)


def _packed(tree: tuple) -> bytes:
    return b"".join(x.tobytes() for x in tree)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) // 16
    return (
        np.frombuffer(data, np.int32, n), np.frombuffer(data, np.uint32, n, 4 * n),
        np.frombuffer(data, np.int64, n, 8 * n),
    )


def _host(url) -> F.Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def _shape(tree: tuple) -> int:
    kids = _children(tree[0])
    return _hash(str([[int(tree[1][r[0]]) for r in _items(kids, tree[1], e)] for e in range(len(kids)) if kids[e]]))


def _part(tree: tuple, kids: list[list[int]], root: int, below: list[int]) -> tuple[tuple, list[int]]:
    """The tree of ``root``, without its text, and the subtrees of its children ``below``; their nodes."""
    nodes = sorted(below)
    for e in nodes:
        nodes.extend(kids[e])
    nodes = [root, *sorted(nodes)]
    place = {e: i for i, e in enumerate(nodes)}
    parent = np.array([-1, *(place[tree[0][e]] for e in nodes[1:])], dtype=np.int32)
    text = tree[2][nodes]
    text[0] = 0
    return (parent, tree[1][nodes], text), nodes


def align_with(frame: tuple, tree: tuple) -> tuple[list[tuple[int, int]] | None, list[tuple[int, tuple, list[int]]]]:
    """The pairs of a page with the frame, None if it hardly matches, and what is left over.

    Runs of equal leaves count one.  Left over are, by node of the frame, the
    children without a counterpart that hold text; further rows of a list that
    has one are not.
    """
    pairs = match_trees(frame, tree)
    kids = _children(tree[0])
    runs = [_items(kids, tree[1], e) for e in range(len(kids))]
    found = {b: a for a, b in pairs}
    heads = [r[0] for own in runs for r in own]
    other = _children(frame[0])
    least = min(len(heads), sum(len(_items(other, frame[1], e)) for e in range(len(other))))
    if 2 * sum(h in found for h in heads) < least:
        return None, []
    rest = []
    for b, a in found.items():
        below = [c for r in runs[b] if r[0] not in found for c in r]
        if below:
            part, nodes = _part(tree, kids, b, below)
            if part[2].any():
                rest.append((a, part, nodes))
    return pairs, rest


def trees(pages: DataFrame) -> DataFrame:
    """``(row, grp, shape, content, tree, nodes, texts)`` of pages with ``row, host, html``.

    ``grp`` is the host; ``nodes`` and ``texts``, the numbers of the tree's
    nodes in the page and the hashes of the page's texts, are null where the
    tree is that of the whole page.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "html"):
                shape, content, packed = [], [], []
                for source in part.column("html").to_pylist():
                    tree = Page(source).tree()
                    shape.append(_shape(tree))
                    content.append(_hash(str(tree[2].tolist())))
                    packed.append(_packed(tree))
                none = pa.nulls(len(packed), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("grp"), pa.array(shape, pa.int64()),
                     pa.array(content, pa.int64()), pa.array(packed, pa.binary()), none, none],
                    names=["row", "grp", "shape", "content", "tree", "nodes", "texts"],
                )

    return pages.select("row", F.xxhash64("host").alias("grp"), "html").mapInArrow(
        read, "row long, grp long, shape long, content long, tree binary, nodes binary, texts binary"
    )


_REST = pa.struct(
    [("grp", pa.int64()), ("shape", pa.int64()), ("tree", pa.binary()), ("nodes", pa.binary())]
)


def aligned(found: DataFrame) -> DataFrame:
    """``(row, grp, content, fits, votes, frame_nodes, same, nodes, texts, rest)`` of each tree.

    Every group with two different pages has a frame, a tree of its commonest
    shape.  ``frame_nodes`` are the frame's nodes with text that the tree has,
    ``same`` whether the texts are equal, ``nodes`` the page's.  A tree that
    hardly matches is in ``rest`` as it is, grouped by shape.
    """
    frames = (
        found.groupBy("grp", "shape", "content").agg(F.min("row").alias("row"))
        .groupBy("grp", "shape").agg(F.count("*").alias("n"), F.min("row").alias("row"), F.min("content").alias("lo"), F.max("content").alias("hi"))
        .groupBy("grp").agg(
            F.max_by("row", F.struct("n", F.col("row"))).alias("row"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        )
        .where("lo <> hi")
        .select("grp", "row")
    )
    frames = saved(
        found.join(frames, ["grp", "row"]).select("grp", F.col("tree").alias("frame"), F.col("texts").alias("frame_texts"))
        .dropDuplicates(["grp"]),
        "frames",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("fits", "votes", "frame_nodes", "same", "nodes", "texts", "rest")}
            columns = (batch.column(c).to_pylist() for c in ("grp", "shape", "tree", "nodes", "texts", "frame", "frame_texts"))
            for grp, shape, tree, nodes, texts, frame, frame_texts in zip(*columns, strict=True):
                one, two = _unpacked(frame), _unpacked(tree)
                place = np.arange(len(two[0]), dtype=np.int32) if nodes is None else np.frombuffer(nodes, np.int32)
                known = two[2] if texts is None else np.frombuffer(texts, np.int64)
                pairs, left = align_with(one, two)
                rest = [
                    (_hash(f"{grp} node {a}"), _shape(part), _packed(part), place[own].tobytes()) for a, part, own in left
                ]
                if pairs is None:
                    rest = [(_hash(f"{grp} shape {shape}"), shape, tree, place.tobytes())]
                texted = [(a, b) for a, b in pairs or () if one[2][a] and two[2][b]]
                out["fits"].append(pairs is not None)
                out["votes"].append(
                    _differs(known, one[2] if frame_texts is None else np.frombuffer(frame_texts, np.int64))
                )
                out["frame_nodes"].append([a for a, _ in texted])
                out["same"].append([bool(one[2][a] == two[2][b]) for a, b in texted])
                out["nodes"].append([int(place[b]) for _, b in texted])
                out["texts"].append(np.unique(known[known != 0]).tobytes() if rest else None)
                out["rest"].append([dict(zip(("grp", "shape", "tree", "nodes"), r, strict=True)) for r in rest])
            kinds = {
                "fits": pa.bool_(), "votes": pa.bool_(), "frame_nodes": pa.list_(pa.int32()), "same": pa.list_(pa.bool_()),
                "nodes": pa.list_(pa.int32()), "texts": pa.binary(), "rest": pa.list_(_REST),
            }
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "grp", "content")), *(pa.array(out[c], k) for c, k in kinds.items())],
                names=["row", "grp", "content", *kinds],
            )

    return saved(
        found.join(frames, "grp").mapInArrow(
            compare,
            "row long, grp long, content long, fits boolean, votes boolean, frame_nodes array<int>, same array<boolean>, "
            "nodes array<int>, texts binary, rest array<struct<grp: long, shape: long, tree: binary, nodes: binary>>",
        ),
        "aligned",
    )


def template_nodes(found: DataFrame) -> DataFrame:
    """``(row, leave_out)``: the elements of each page that are template.

    Pages without a known template are not listed.  Of ``found`` (see
    :func:`trees`) equal rows count once, as do pages with the same texts.
    """
    found = saved(found.dropDuplicates(["row"]), "distinct-trees")
    parts = []
    for _ in range(ROUNDS):
        now = aligned(found)
        constant = (
            now.where("fits AND votes").select("grp", "content", "frame_nodes", "same").dropDuplicates(["grp", "content"])
            .select("grp", F.inline(F.arrays_zip("frame_nodes", "same")))
            .groupBy("grp", "frame_nodes").agg(F.count("*").alias("n"), F.count_if("same").alias("n_same"))
            .where(F.col("n_same") >= SAME * F.col("n"))
            .groupBy("grp").agg(F.collect_list("frame_nodes").alias("constant"))  # nodes of one page
        )
        pairs = F.filter(
            F.arrays_zip("frame_nodes", "same", "nodes"),
            lambda x: x["same"] & F.array_contains("constant", x["frame_nodes"]),
        )
        parts.append(
            now.where("fits").select("row", "grp", "frame_nodes", "same", "nodes")
            .join(saved(constant, "templates"), "grp").select("row", pairs["nodes"].alias("leave_out"))
        )
        found = now.select("row", "content", "texts", F.inline("rest")).select(
            "row", "grp", "shape", "content", "tree", "nodes", "texts"
        )
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # at most a few parts of one page
    return every.groupBy("row").agg(F.flatten(F.collect_list("leave_out")).alias("leave_out"))


def main_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of each row of ``pages (page_id, url, html)``.

    A null or empty html gives an empty text.  Pages without a host are one
    host.  A host with one page, or only near copies of one, has no template,
    so its pages are read by their elements alone.
    """
    rows = pages.select(
        F.xxhash64("page_id", "url", "html").alias("row"), F.col("page_id").cast("long"),
        F.col("url").cast("string"), _host(F.col("url").cast("string")).alias("host"),
        F.col("html").cast("string"),
    )
    found = saved(trees(rows.select("row", "host", "html")), "trees")
    left_out = saved(template_nodes(found), "template-nodes")

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "html"):
                small = [
                    zlib.compress((x or "").encode("utf-8", "surrogatepass"), 1)
                    for x in part.column("html").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("row", "page_id", "url")), pa.array(small, pa.binary())],
                    names=["row", "page_id", "url", "html"],
                )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, nodes in zip(batch.column("html"), batch.column("leave_out"), strict=True):
                page = Page(zlib.decompress(source.as_py()).decode("utf-8", "surrogatepass"))
                texts.append(page.text(frozenset(nodes.as_py()) if nodes.is_valid else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    packed = rows.select("row", "page_id", "url", "html").mapInArrow(
        squeeze, "row long, page_id long, url string, html binary"
    )
    return packed.join(left_out, "row", "left").select("page_id", "url", "html", "leave_out").mapInArrow(
        extract, "page_id long, url string, text string, n_chars long"
    )
