"""HTML extraction with wrappers: a union-free expression for each host, aligned from its pages' token streams.

A page's stream has its block tags and one slot for each run of text between them. Repeats
in a stream become repeated groups of whole elements; where two streams differ, what only
one has becomes an optional group. Streams are counted before they meet, and a host's distinct streams are
aligned in several tasks first, so a host's size doesn't matter. The wrapper doesn't decide
what is article yet: marks of the elements do, and where no part of a page is marked as its
main one, slots whose texts the host's pages share are the template's.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampbook.llm import arrays as A
from stampbook.llm.columns import spread

SALTS = 16  # tasks that align a host's streams before their wrappers meet
LONGEST_REPEAT = 32  # neighbours in a repeated group
DEEPEST = 256  # elements named in a path; of those further in a path has the marks
CONSTANT_PAGES = 5  # a slot is the template's if at least so many pages have it,
CONSTANT_SHARE = 0.5  # and one text is in more than this share of them
LARGE_SHARE = 0.8  # of a page's characters; a container with more isn't aside for words of its class alone
LARGE_CHARS = 250  # if it has at least so many
MOST_LINKED = 0.5  # of a slot's characters; slots with more are menus

# Elements by what they are, and words in class, id and role that mark what is no article.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark meter output picture q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe noframes noembed xmp svg math canvas object audio video select button title".split())
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "thead": "tr td th", "tbody": "thead tr td th", "tfoot": "tbody tr td th"}
SCOPES = frozenset("ul ol dl table div section article main body html form td th".split())
ASIDE_TAGS = frozenset("nav header footer aside form dialog menu head fieldset".split())
ASIDE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent contentinfo complementary"
    " cookie cookies copyright dialog discussion disqus footer footnav form gdpr header login masthead menu modal nav navbar navigation newsletter notice"
    " notices notification overlay pager pagination popup promo promoted promotion related recommended replies reply respond search share sharing sidebar"
    " signup skip social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
MAIN_TAGS = frozenset("article main".split())
HEAD_TAGS = frozenset("html head base link meta".split()) | RAW  # what doesn't end a head
MAIN_WORDS = frozenset("main articlebody".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)|[^<]+|<""", re.S)
_SPECIAL = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?=\s|/|\Z)""", re.I)
_WORDS = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")
_SPACES = re.compile(r"\s+")


@dataclass
class Block:
    path: str  # elements around it, outermost first; "!" marks what is no article, "~" what may be none, "*" the main part
    text: str
    linked: int  # characters of links
    slot: str = ""  # the path's named elements, which the wrapper has too


@dataclass
class Page:
    tokens: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def _name(tag: str, attributes: str) -> str:
    """The element with its marks and the words of its class and id."""
    if tag in ("html", "body"):  # they hold all of the page, whatever their class
        return tag
    words, hidden, main = [], False, tag in MAIN_TAGS
    for key, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        value = value.strip("\"'")
        if key.lower() in ("hidden", "aria-hidden"):
            hidden |= value.lower() != "false"
        else:
            found = [w.lower() for w in _WORDS.findall(value)]
            main |= key.lower() in ("role", "itemprop") and not MAIN_WORDS.isdisjoint([value.lower()])
            words += found
    mark = "!" if tag in ASIDE_TAGS or hidden else "*" if main else "~" if not ASIDE_WORDS.isdisjoint(words) else ""
    return tag + "".join("." + w for w in words[:4] if not w.isdigit()) + mark


class _TagEnds:
    """Where tags end: at the first ">" outside quotes, found once for every place that a search goes on from."""

    def __init__(self, source: str):
        self.source, self.known = source, {}
        self.last = {c: source.rfind(c) for c in ">\"'"}

    def after(self, at: int) -> int:
        """The place of that ">", or -1."""
        passed, end = [], -1
        while at not in self.known:
            passed.append(at)
            if at > max(self.last.values()):
                break
            found = _SPECIAL.search(self.source, at)
            if found[0] == ">":
                end = found.start()
                break
            if self.last[found[0]] < found.end():  # a quote that nothing closes
                break
            at = self.source.index(found[0], found.end()) + 1
        else:
            end = self.known[at]
        self.known.update(dict.fromkeys(passed, end))
        return end


def _marks(name: str) -> set[str]:
    return {name[-1]} & set("!*~")


def parse(source: str) -> Page:
    """The block tokens and text blocks of a page. Inline elements and line breaks belong to the text around them.

    The work is in proportion to the page's length, however broken or deep it is.
    """
    page, stack, text, linked, links = Page(), [], [], 0, 0
    paths: list[str] = []  # of the open elements
    opened: Counter[str] = Counter()
    ends = _TagEnds(source)

    def flush() -> None:
        nonlocal linked
        whole = _SPACES.sub(" ", html.unescape("".join(text))).strip()
        if whole:
            end_head()
            page.tokens.append("#")
            page.blocks.append(Block(paths[-1] if paths else "", whole, linked, paths[min(len(paths), DEEPEST) - 1] if paths else ""))
        text.clear()
        linked = 0

    def start(tag: str, name: str) -> None:
        if len(stack) < DEEPEST:
            page.tokens.append(name)
            paths.append(f"{paths[-1]}/{name}" if paths else name)
        else:
            named = paths[DEEPEST - 1]
            marks = "".join(sorted(set(paths[-1][len(named) + 1 :]) | _marks(name)))
            paths.append(f"{named}/{marks}" if marks else named)
        stack.append(tag)
        opened[tag] += 1

    def close(upto: int) -> None:
        while len(stack) > upto:
            tag = stack.pop()
            paths.pop()
            opened[tag] -= 1
            if len(stack) < DEEPEST:
                page.tokens.append("/" + tag)

    def end_head() -> None:
        place = next((i for i, tag in enumerate(stack[:2]) if tag == "head"), None)
        if place is not None:
            close(place)

    at, end = 0, len(source)
    while at < end:
        found = _TOKEN.match(source, at)
        tag = found[2]
        if tag is None:
            after = found.end()
            if found[0] == "<" and source[after : after + 1] == "/" and _rest_is_text(source, after):
                break
            if found[0][0] != "<" or found[0] == "<":
                text.append(found[0])
                linked += len(found[0]) if links else 0
            elif found[0].startswith("<![CDATA["):
                text.append(html.escape(found[0][9:].removesuffix("]]>")))
            at = after
            continue
        stop = ends.after(found.end())
        if stop < 0:  # a tag without an end: the end of the page, or a plain "<"
            if _rest_is_text(source, at + 1):
                break
            text.append("<")
            linked += 1 if links else 0
            at += 1
            continue
        attributes, at = source[found.end() : stop], stop + 1
        tag = tag.lower()
        if tag in INLINE:
            links = max(0, links + (-1 if found[1] else 1)) if tag == "a" else links
            if tag == "br":
                text.append(" ")
            continue
        flush()
        links = 0
        if found[1]:
            if opened[tag]:
                close(len(stack) - 1 - stack[::-1].index(tag) if stack[-1] != tag else len(stack) - 1)
            continue
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}(?![\w-])", re.I).search(source, at)
            close_at = source.find(">", over.end()) if over else -1
            at = close_at + 1 if close_at >= 0 else end
            continue
        if tag not in HEAD_TAGS:
            end_head()
        if stack and stack[-1] == "p":
            close(len(stack) - 1)
        closed = CLOSES.get(tag, "").split()
        i = len(stack) - 1
        while i >= 0 and any(opened[c] for c in closed) and stack[i] not in SCOPES.difference(closed):
            if stack[i] in closed:
                close(i)
            i -= 1
        name = _name(tag, attributes)
        if tag not in VOID:
            start(tag, name)
        elif len(stack) < DEEPEST:
            page.tokens += [name, "/" + tag]
    flush()
    close(0)
    return page


def _rest_is_text(source: str, at: int) -> bool:
    return source.find("<", at) < 0 and source.find(">", at) < 0


# A wrapper is a tuple of tokens, ("+", body) for a repeated and ("?", body) for an optional group. To be folded
# and aligned it is a tree: "#", or (element, inside), or a group of whole neighbours. So a group never opens an
# element without closing it, and each slot keeps the path it has in its pages.


def _tree(items: tuple) -> tuple:
    names, inside = [], [[]]
    for item in items:
        if isinstance(item, tuple):
            inside[-1].append((item[0], _tree(item[1])))
        elif item == "#":
            inside[-1].append(item)
        elif item.startswith("/"):
            nodes = tuple(inside.pop())
            inside[-1].append((names.pop(), nodes))
        else:
            names.append(item)
            inside.append([])
    return tuple(inside[0])


def _flat(nodes: tuple) -> tuple:
    out: list = []

    def walk(nodes: tuple) -> None:
        for node in nodes:
            if node == "#":
                out.append(node)
            elif node[0] in ("+", "?"):
                out.append((node[0], _flat(node[1])))
            else:
                out.append(node[0])
                walk(node[1])
                out.append("/" + re.match(r"[^.!~*]+", node[0])[0])

    walk(nodes)
    return tuple(out)


def _fold_neighbours(nodes: tuple) -> tuple:
    size = 1
    while size <= min(LONGEST_REPEAT, len(nodes) // 2):
        out, i = [], 0
        while i < len(nodes):
            body, n = nodes[i : i + size], 1
            while len(body) == size and nodes[i + n * size : i + (n + 1) * size] == body:
                n += 1
            if n > 1:
                out.append(body[0] if size == 1 and body[0][0] == "+" else ("+", body))
                i += n * size
            else:
                out.append(nodes[i])
                i += 1
        nodes = tuple(out)
        size += 1
    return nodes


def _fold(nodes: tuple) -> tuple:
    return _fold_neighbours(tuple([n if n == "#" else (n[0], _fold(n[1])) for n in nodes]))


def fold_repeats(items: tuple) -> tuple:
    """Neighbouring repeats become repeated groups, inner and short ones first."""
    return _flat(_fold(_tree(items)))


def _core(node: tuple | str) -> tuple:
    """The groups around a single node, and the node."""
    kinds = set()
    while node[0] in ("+", "?") and len(node[1]) == 1:
        kinds.add(node[0])
        node = node[1][0]
    return kinds, node


def _key(node: tuple | str):
    """Nodes with the same key are merged: elements by their name, longer groups by those of their nodes."""
    core = _core(node)[1]
    return core if core == "#" else (core[0], *[_key(n) for n in core[1]]) if core[0] in ("+", "?") else core[0]


def _merged(a: tuple | str, b: tuple | str) -> tuple | str:
    if a == b:
        return a
    (kinds, x), (others, y) = _core(a), _core(b)
    if x != "#":
        x = (x[0], tuple([_merged(m, n) for m, n in zip(x[1], y[1], strict=True)]) if x[0] in ("+", "?") else _align(x[1], y[1]))
    for kind in sorted(kinds | others):
        x = (kind, (x,))
    return x


def _with_groups_of(nodes: tuple, other: tuple) -> tuple:
    """nodes, where they hold the body of a longer group of other (one pass is enough for the group), as that group."""
    for group in [x for x in other if x[0] in ("+", "?") and len(x[1]) > 1]:
        out, i, body = [], 0, group[1]
        while i < len(nodes):
            if nodes[i : i + len(body)] == body:
                out.append(group)
                i += len(body)
            else:
                out.append(nodes[i])
                i += 1
        nodes = tuple(out)
    return nodes


def _align(a: tuple, b: tuple) -> tuple:
    if a == b:
        return a
    a, b = _with_groups_of(a, b), _with_groups_of(b, a)
    out: list = []
    for kind, a0, a1, b0, b1 in SequenceMatcher(None, [_key(n) for n in a], [_key(n) for n in b], autojunk=False).get_opcodes():
        if kind == "equal":
            out += [_merged(m, n) for m, n in zip(a[a0:a1], b[b0:b1], strict=True)]
        else:
            out += [n if n[0] == "?" else ("?", (n,)) for n in (*a[a0:a1], *b[b0:b1])]
    return _fold_neighbours(tuple(out))


def align(a: tuple, b: tuple) -> tuple:
    """The expression of both: elements with one name are merged, others become optional groups."""
    return _flat(_align(_tree(a), _tree(b)))


def _load(text: str) -> tuple:
    def freeze(x):
        return tuple(freeze(i) for i in x) if isinstance(x, list) else x

    return freeze(json.loads(text))


def slots(wrapper: tuple) -> set[str]:
    """The paths of the wrapper's text slots."""
    found: set[str] = set()

    def walk(items: tuple, stack: list[str]) -> None:
        for item in items:
            if isinstance(item, tuple):
                walk(item[1], stack)
            elif item == "#":
                found.add("/".join(stack))
            elif item.startswith("/"):
                if stack:
                    stack.pop()
            else:
                stack.append(item)

    walk(wrapper, [])
    return found


def _containers(path: str) -> list[str]:
    """The path of each element in path that is aside by words of its class alone."""
    return [path[: m.end()] for m in re.finditer(r"~(?=/|\Z)", path)] if "~" in path else []


def _believed(blocks: list[Block]) -> list[str]:
    """The path of each block, without the marks "~" that aren't believed; the others become "!".

    A mark inside a main part is not believed whose element has nearly all text of that part: it is the article
    itself. Marks around or beside main parts are all believed where one main part is free of them; elsewhere those are not whose
    element has nearly all text of the page that is not aside by tag: that is the page's frame, or the article.
    """
    clean = any("*" in b.path and "!" not in b.path and "~" not in b.path.split("*")[0] for b in blocks)
    inside: Counter[str] = Counter()
    for b in blocks:
        if "!" not in b.path:
            inside[""] += len(b.text)
            mains = [b.path[: m.end()] for m in re.finditer(r"\*(?=/|\Z)", b.path)]
            inside.update(dict.fromkeys({*_containers(b.path), *mains}, len(b.text)))

    def frame(container: str) -> bool:
        main = container.rfind("*/")
        if main < 0 and clean:
            return False
        return inside[container] >= LARGE_CHARS and inside[container] > LARGE_SHARE * inside[container[: main + 1]]

    frames = {c for c in inside if c.endswith("~") and frame(c)}
    return [b.path + "!" if any(c not in frames for c in _containers(b.path)) else b.path for b in blocks]


def _is_aside(path: str) -> bool:
    return "!" in path


def _is_main(path: str) -> bool:
    return "*" in path and "!" not in path


def host_of(column: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(column), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _column(batch, name: str) -> list[str]:
    return [x or "" for x in batch[name].to_pylist()]


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        folded = [json.dumps(fold_repeats(tuple(parse(x).tokens))) for x in _column(batch, "html")]
        yield pa.RecordBatch.from_pydict({"host": batch["host"], "stream": folded})


def _aligned(table: pa.Table) -> pa.Table:
    """One wrapper for the streams or wrappers of a group: the most frequent first."""
    rows = sorted(zip(table["stream"].to_pylist(), table["pages"].to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
    wrapper = _tree(_load(rows[0][0]))
    for stream, _ in rows[1:]:
        wrapper = _align(wrapper, _tree(_load(stream)))
    return pa.table({"host": table["host"][:1], "stream": [json.dumps(_flat(wrapper))], "pages": [sum(r[1] for r in rows)]})


def infer_wrappers(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """host, stream (the wrapper as JSON) and pages for each host of pages (host, html)."""
    streams = pages.select("host", F.col(html_column).alias("html")).mapInArrow(_streams, "host string, stream string")
    counted = streams.groupBy("host", "stream").agg(F.count("*").alias("pages"))
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("stream"), F.lit(SALTS)))
    kind = "host string, stream string, pages long"
    return salted.groupBy("host", "salt").applyInArrow(lambda t: _aligned(t), kind).groupBy("host").applyInArrow(lambda t: _aligned(t), kind)


def _open_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of slots in pages without a main part, and a hash of all such texts of the page, which its copies share."""
    for batch in batches:
        hosts, paths, texts, pages = [], [], [], []
        for host, source in zip(_column(batch, "host"), _column(batch, "html"), strict=True):
            blocks = parse(source).blocks
            marked = _believed(blocks)
            if not any(_is_main(m) for m in marked):
                found = {(b.path, b.text) for b, m in zip(blocks, marked, strict=True) if not _is_aside(m)}
                page = int.from_bytes(hashlib.blake2b(json.dumps(sorted(found)).encode(), digest_size=8).digest(), "little", signed=True)
                for path, text in found:
                    hosts.append(host)
                    paths.append(path)
                    texts.append(text)
                    pages.append(page)
        yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "path": pa.array(paths, pa.string()), "text": pa.array(texts, pa.string()), "page": pa.array(pages, pa.int64())})


def template_slots(pages: DataFrame) -> DataFrame:
    """host and its slots (path) with a text that most different pages share, among pages without a main part."""
    texts = pages.mapInArrow(_open_texts, "host string, path string, text string, page long").select("host", "path", F.xxhash64("text").alias("text"), "page").distinct()
    counts = texts.groupBy("host", "path", "text").agg(F.count("*").alias("n"))
    slot = counts.groupBy("host", "path").agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    return slot.where((F.col("n") >= CONSTANT_PAGES) & (F.col("most") > F.col("n") * CONSTANT_SHARE)).select("host", "path")


def article(page: Page, wrapper_slots: set[str], template: set[str]) -> str:
    """The text of the slots that hold the article, by their marks and the template of the page's host."""
    own = [(b, m) for b, m in zip(page.blocks, _believed(page.blocks), strict=True) if b.slot in wrapper_slots or not wrapper_slots]
    main = [b for b, m in own if _is_main(m)]
    if not main:
        main = [b for b, m in own if not _is_aside(m) and b.path not in template and b.linked <= MOST_LINKED * len(b.text)]
    return "\n".join(b.text for b in main)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, set[str]] = {}
    for batch in batches:
        out = []
        for source, stream, template in zip(_column(batch, "_html"), _column(batch, "stream"), batch["template"].to_pylist(), strict=True):
            if stream not in known:
                known.clear() if len(known) > 1000 else None
                known[stream] = slots(_load(stream)) if stream else set()
            out.append(article(parse(source), known[stream], set(template or ())))
        yield pa.RecordBatch.from_pydict({"_row": A.loose(batch["_row"]), "text": pa.array(out, pa.string())})


def extract_text(pages: DataFrame) -> DataFrame:
    """All columns of pages but html, and text: the article of each page, its blocks joined by line ends.

    A wrapper is inferred for each host (of url; pages without one share the empty host) from all its pages.
    Slots inside a part marked as the main one (article, main, or such a role) hold the article, less those
    inside menus, headers, footers, sidebars, notices, adverts, forms and comments. In pages without such a
    part, all other slots do whose text the host's pages don't share and that aren't mostly links. Character
    references are decoded, white space inside a block becomes one space. Null, empty and textless pages give
    an empty text; broken markup is read on to the end; repeated rows give repeated rows; extra columns pass through.
    """
    rest = [F.col(f"`{c}`") for c in pages.columns if c != "html"]
    rows = pages.select(F.struct(*rest).alias("_row"), host_of().alias("_host"), F.coalesce("html", F.lit("")).alias("_html"))
    named = rows.select(F.col("_host").alias("host"), F.col("_html").alias("html"))
    wrappers = infer_wrappers(named).select("host", "stream")
    template = template_slots(named).groupBy("host").agg(F.collect_list("path").alias("template"))
    known = wrappers.join(template, "host", "left").select(F.col("host").alias("_host"), "stream", "template")
    joined = rows.join(known, "_host", "left").select("_row", "_html", "stream", "template")
    out = joined.mapInArrow(_extracted, f"_row {rows.schema['_row'].dataType.simpleString()}, text string")
    return spread(out, "_row", "text")


def op8(pages: DataFrame) -> DataFrame:
    found = extract_text(pages.select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
