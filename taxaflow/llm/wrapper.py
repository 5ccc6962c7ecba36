"""Main text of web pages by wrapper induction over pages of one host."""

from __future__ import annotations

import pickle
import re
import sys
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import input_bytes, materialise
from taxaflow.llm.dom import BLOCK, HIDDEN, Node, parse

#: Elements and the words of class, id or role that mark what is not the article.
OUTSIDE = HIDDEN | frozenset("nav header footer aside form menu button select textarea input label dialog search".split())
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|sponsor(?:ed)?|promo(?:tion)?s?|banner|sidebars?|menus?|nav(?:bar|igation)?|breadcrumbs?|"
    r"header|footer|masthead|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|"
    r"share|sharing|social|related|recommended|trending|comments?|replies|disqus|pagination|pager|toolbar|widgets?|copyright|"
    r"search|complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
CONTAINERS = frozenset("div section ul ol dl table ins details".split())
MAIN = re.compile(r"(?:^|[\s_-])(?:article(?:body)?|content|entry(?:-content)?|post(?:-(?:body|content))?|story|main(?:-content)?|text)(?:$|[\s_-])", re.I)
#: A template node is constant if its text is the same on all of so many different pages at least.
CONSTANT_PAGES = 8
#: Partial templates of a host that one task merges.
FANS = 32
#: Share of the varying text below a node that its main child must hold.
DOMINANT = 0.6


def deep() -> None:
    """Trees are walked by plain calls, whose frames are on the heap: their depth needs no bound."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 10_000_000))


def label_of(node: Node) -> str:
    """What two nodes must share to be aligned: tag, classes and role."""
    mark = " ".join(node.attrs.get(k, "") for k in ("class", "role")).strip()
    return f"{node.tag}.{mark}" if mark else node.tag


def is_outside(node: Node, in_article: bool = False) -> bool:
    """Menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments by tag or name.

    In the article, names say so only of CONTAINERS, and ids not of sections, whose ids are anchors: a paragraph
    of the class "social" is text.
    """
    if node.tag in OUTSIDE or "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true":
        return True
    if not node.attrs or node.tag in ("html", "body", "article", "main"):
        return False
    if in_article and node.tag not in CONTAINERS:
        return False
    names = ("class", "role") if in_article and node.tag == "section" else ("class", "id", "role")
    return any(MARKS.search(node.attrs[k]) for k in names if k in node.attrs)


@dataclass
class Slot:
    """A template node: what was aligned to it on the pages of a host so far."""

    label: str
    pages: int = 0
    letters: int = 0
    text: int | None = None  # CRC of the text if it was the same on all pages, else -1
    outside: bool = False
    met: tuple[int, ...] = ()  # marks of different pages, CONSTANT_PAGES at most
    children: list[Slot] = field(default_factory=list)


def _own_letters(node: Node) -> int:
    return sum(len(c) for c in node.children if isinstance(c, str) and not c.isspace())


def _inner_crc(node: Node, crc: int = 0) -> int:
    for child in node.children:
        crc = zlib.crc32(child.encode("utf-8", "surrogatepass"), crc) if isinstance(child, str) else _inner_crc(child, crc)
    return crc


def page_slots(node: Node, mark: int | None = None) -> Slot:
    """The template of one page. Runs of equal siblings are one slot, as lists of any length are."""
    text = _inner_crc(node)
    mark = text if mark is None else mark
    slot = Slot(label_of(node), 1, _own_letters(node), text, is_outside(node), (mark,))
    if slot.outside:
        return slot
    for child in node.children:
        if isinstance(child, str) or child.tag in HIDDEN:
            continue
        below = page_slots(child, mark)
        if slot.children and slot.children[-1].label == below.label:
            merge_into(slot.children[-1], below, same_page=True)
        else:
            slot.children.append(below)
    return slot


def packed(slot: Slot) -> bytes:
    """A template as a flat list of its slots, parents first."""
    rows, stack = [], [slot]
    while stack:
        now = stack.pop()
        rows.append((now.label, now.pages, now.letters, now.text, now.outside, now.met, len(now.children)))
        stack += now.children[::-1]
    return pickle.dumps(rows)


def unpacked(blob: bytes) -> Slot:
    top = Slot("")
    open_slots = [(top, 1)]
    for *fields, n in pickle.loads(blob):  # noqa: S301  written by this module
        parent, left = open_slots.pop()
        if left > 1:
            open_slots.append((parent, left - 1))
        slot = Slot(*fields)
        parent.children.append(slot)
        if n:
            open_slots.append((slot, n))
    return top.children[0]


def tree_matching(a: list[Slot], b: list[Slot], memo: dict) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: most nodes of two ordered forests that can be paired, parents with parents, in order."""
    if len(a) == len(b) and all(x.label == y.label for x, y in zip(a, b, strict=True)):
        pairs = [(i, i) for i in range(len(a))]
        total = len(a)
        for x, y in zip(a, b, strict=True):
            total += _inner_match(x, y, memo)
        return total, pairs
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            pair = best[i][j] + 1 + _inner_match(x, y, memo) if x.label == y.label else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], pair)
    i, j, pairs = len(a), len(b), []
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return best[-1][-1], pairs[::-1]


def _inner_match(x: Slot, y: Slot, memo: dict) -> int:
    if not x.children or not y.children:
        return 0
    key = (id(x), id(y))
    if key not in memo:
        memo[key] = tree_matching(x.children, y.children, memo)[0]
    return memo[key]


def merge_into(template: Slot, page: Slot, same_page: bool = False) -> None:
    """Align page, or another template, to template; what has no partner becomes a slot of its own, in order."""
    template.letters += page.letters
    template.outside |= page.outside
    if template.met != page.met:
        template.met = tuple(sorted({*template.met, *page.met})[:CONSTANT_PAGES])
    if same_page:
        template.text = zlib.crc32(f"{template.text} {page.text}".encode())
    else:
        template.pages += page.pages
        template.text = template.text if template.text == page.text else -1
    pairs = tree_matching(template.children, page.children, {})[1]
    merged, i, j = [], 0, 0
    for p, q in [*pairs, (len(template.children), len(page.children))]:
        merged += template.children[i:p] + page.children[j:q]
        if p < len(template.children):
            merge_into(template.children[p], page.children[q], same_page)
            merged.append(template.children[p])
        i, j = p + 1, q + 1
    template.children = merged


def _is_constant(slot: Slot) -> bool:
    return slot.text != -1 and len(slot.met) >= CONSTANT_PAGES


def _masses(slot: Slot, found: dict[int, int]) -> int:
    """Letters of the text below each slot that varies over pages and is not outside the article by name."""
    total = 0
    if not slot.outside and not _is_constant(slot):
        total = slot.letters
        for child in slot.children:
            total += _masses(child, found)
    found[id(slot)] = total
    return total


def main_path(template: Slot) -> list[str]:
    """Labels from the root to the slot that holds the article: the last one that holds most of what varies."""
    path, now, mass = [], template, {}
    _masses(template, mass)
    while True:
        masses = [(mass.get(id(c), 0), -i, c) for i, c in enumerate(now.children)]
        total = now.letters + sum(m for m, _, _ in masses)
        named = [x for x in masses if x[0] and (x[2].label.split(".")[0] in ("article", "main") or MAIN.search(x[2].label.partition(".")[2]))]
        best = max(named or masses, default=(0, 0, None), key=lambda x: x[:2])
        tag = best[2].label.split(".")[0] if best[2] else ""
        if not best[0] or not named and (best[0] < DOMINANT * total or tag in ("p", "li", "td", "tr", "pre", "h1", "h2", "blockquote") or tag not in BLOCK):
            return path
        now = best[2]
        path.append(now.label)
        if tag == "article":
            return path


def path_key(above: int, label: str) -> int:
    """A number for a path of labels, from that of the path above."""
    return xxhash.xxh64_intdigest(label, above)


def constant_paths(template: Slot) -> set[int]:
    """Paths of slots with one text on all of CONSTANT_PAGES different pages or more: they belong to the template.

    A path that a slot of varying text has too is not among them, as its nodes can be the article's.
    """
    constant: set[int] = set()
    varying: set[int] = set()
    stack = [(template, 0, False)]
    while stack:
        slot, at, inside = stack.pop()
        for child in slot.children:
            path = path_key(at, child.label)
            same = inside or (_is_constant(child) and child.pages == slot.pages)
            (constant if same else varying).add(path)
            stack.append((child, path, same))
    return constant - varying


def _targets(node: Node, path: list[str]) -> list[Node]:
    """The nodes of a page that a path of labels leads to, in page order."""
    now = [node]
    for label in path:
        now = [c for n in now for c in n.children if not isinstance(c, str) and label_of(c) == label and not is_outside(c)]
    return now


def _blocks(node: Node, at: int, constant: set[int], out: list[list[str]]) -> None:
    for child in node.children:
        if isinstance(child, str):
            out[-1].append(child)
            continue
        path = path_key(at, label_of(child))
        if is_outside(child, in_article=True) or path in constant:
            continue
        if child.tag == "br":
            out[-1].append("\n")
            continue
        block = child.tag in BLOCK
        if block:
            out.append([])
        _blocks(child, path, constant, out)
        if block:
            out.append([])


def main_text(source: str | None, rules: tuple[list[str], set[int]] | None = None) -> str:
    """The article of a page. rules: main_path and constant_paths of its host; without them the page's own."""
    if not source:
        return ""
    deep()
    root = parse(source)
    path, constant = rules or (None, set())
    nodes = _targets(root, path) if path else []
    if not nodes:
        path = main_path(page_slots(root))
        nodes = _targets(root, path)
    out: list[list[str]] = [[]]
    at = 0
    for label in path:
        at = path_key(at, label)
    for node in nodes:
        _blocks(node, at, constant, out)
        out.append([])
    texts = (" ".join("".join(b).split()) for b in out)
    return "\n\n".join(t for t in texts if t)


def host_of(url: F.Column) -> F.Column:
    """Host of a URL in lower case; the empty string for others."""
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _fold(held: dict, host: str, slot: Slot) -> None:
    if host in held:
        merge_into(held[host], slot)
    else:
        held[host] = slot


def _merger() -> Callable:
    def merged(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        deep()
        held: dict[str, Slot] = {}
        for blob in sorted(rows["template"].to_pylist()):
            _fold(held, "", unpacked(blob))
        return pa.table([pa.array([k.as_py()]) for k in key] + [pa.array([packed(held[""])])], names=["host", "fan", "template"])

    return merged


def induce(pages: DataFrame, most_hosts: int = 2000) -> DataFrame:
    """(host, rules binary) of every host of pages (host, html), from all its pages.

    A task folds its pages into one partial template a host, by aligning their DOM trees with simple tree
    matching; partial templates of a host are then aligned to each other, those of FANS tasks at a time, until one is
    left. A task holds most_hosts partial templates and hands over those it has when another host comes. A slot knows
    whether its pages differ, so that copies do not make an article constant.
    """

    def folded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Slot] = {}
        deep()
        task = TaskContext.get().partitionId()

        def handed() -> pa.RecordBatch:
            columns = [pa.array(held.keys(), pa.string()), pa.array([task] * len(held), pa.int64()), pa.array(map(packed, held.values()), pa.binary())]
            return pa.record_batch(columns, names=["host", "fan", "template"])

        for batch in batches:
            for host, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slot = page_slots(parse(source or ""))
                if host not in held and len(held) >= most_hosts:
                    yield handed()
                    held.clear()
                _fold(held, host, slot)
        yield handed()

    def finished(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deep()
            slots = [unpacked(b) for b in batch.column(1).to_pylist()]
            rules = [pickle.dumps((main_path(s), constant_paths(s))) for s in slots]
            yield pa.record_batch([batch.column(0), pa.array(rules, pa.binary())], names=["host", "rules"])

    ddl, tasks = "host string, fan long, template binary", pages.rdd.getNumPartitions()
    now = pages.select("host", "html").mapInArrow(folded, ddl)
    while True:
        tasks = -(-tasks // FANS)
        now = now.withColumn("fan", F.floor(F.col("fan") / FANS)).groupBy("host", "fan").applyInArrow(_merger(), ddl)
        if tasks <= 1:
            return now.select("host", "template").mapInArrow(finished, "host string, rules binary")


def extract(pages: DataFrame, most_broadcast: int = 16 << 20) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html), repeated rows included.

    A null html is an empty page; pages without a host are a host of their own kind. The text of a page without
    an article is empty. n_chars counts code points. Other columns of pages are not read. Hosts' rules go to all
    tasks if their files have most_broadcast bytes at most; beyond, pages are joined to them by a shuffle.
    """
    given = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    rules = materialise(induce(given), "wrappers")

    def extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes | None, object] = {None: None}
        for batch in batches:
            texts = []
            for source, blob in zip(batch.column(1), batch.column(2), strict=True):
                blob = blob.as_py()
                if blob not in known:
                    known.clear()
                    known[None] = None
                    known[blob] = pickle.loads(blob)  # noqa: S301  written by this module
                texts.append(main_text(source.as_py(), known[blob]))
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["kept", "text", "n_chars"])

    small = input_bytes(rules) <= most_broadcast
    joined = given.join(F.broadcast(rules) if small else rules, "host", "left").select(F.struct("page_id", "url").alias("kept"), "html", "rules")
    ddl = f"kept {joined.schema['kept'].dataType.simpleString()}, text string, n_chars long"
    return joined.mapInArrow(extracted, ddl).select("kept.page_id", "kept.url", "text", "n_chars")
