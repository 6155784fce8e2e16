"""Main text of web pages by wrapper induction over the pages of a host.

A page becomes a skeleton: the tree of its block elements, labelled by tag and
class, in which repeated siblings share a node. The text of a page lies in the
skeleton's nodes, its slots. Per host, the most frequent skeleton is the
reference; every other skeleton of the host is aligned with it by simple tree
matching. Each block of text in a slot, counted over the host's pages that have the
slot, in whatever skeleton, tells template from content: the same block on nearly all,
or not. Pages without text teach nothing, and pages with the same text in all slots
teach as one.

The content root is the article or main element of the skeleton; without one,
the lowest node above all slots that vary. Kept is what lies under the root, except

* menus, headers, footers, sidebars, notices, adverts, reader comments, scripts and
  styles, told by element,
* the same and forms, told by role, id and whole class names, unless they hold the
  page's only article or main or all that varies in it, and
* a block that a slot holds on ``SHARE`` or more of the pages that have the slot, if
  it is on at least ``MIN_PAGES`` different pages; other blocks of that slot stay.
  An article or main in which nothing varies stays whole.

Work is grouped by host, skeleton, slot and block and then by host, slot and block,
never by host alone: a host with a third of all pages arrives as counts. Skeletons
with more than a thousandth of all pages, of which there are fewer than a thousand,
are split by block where blocks meet the alignment.

Defined results: a null or empty page has no text; a null or odd url belongs to the
host named by the empty string. Repeated rows have their text each. A tag that is
never closed is text. Parsing is linear in the page.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import column, free_name, two_hashes, whole
from martline.sources.staging import stage

MIN_PAGES = 2
SHARE = 0.8

#: Element names by their part in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
CHROME = frozenset(
    "head script style noscript template nav footer aside button select textarea input menu dialog iframe svg"
    " canvas object embed title".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs"
    " sidebar widget footer masthead cookie cookies consent notice popup modal overlay newsletter subscribe signup"
    " share sharing social related comment comments disqus pagination pager toolbar".split()
)
#: Compounds of a word above: these may stand before it or after it.
BEFORE_CHROME = frozenset("site main page top bottom primary secondary global".split())
AFTER_CHROME = frozenset("list area box bar block container wrapper section links link buttons button item items".split())
ROOTS = frozenset(("article", "main"))
#: An open element of the first kind ends where one of the second begins.
ENDS = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr"
        " main menu nav ol p pre section table ul li".split()
    ),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "head": frozenset(["body"]),
}

#: A tag without a further "<" in it; others are read by hand, see Tags.
_PLAIN = re.compile(r"""<(/?)([a-zA-Z][^\s/><]*+)((?:"[^"<]*+"|'[^'<]*+'|[^'"<>])*+)>""")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_STOP = re.compile("""["'>]""")
_ATTRIBUTE = re.compile(r"""\b(?<![\w-])(class|role|id)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)


class Tags:
    """The tags of a page, in order, in time linear in its length.

    Whether a tag is closed depends only on where its attributes are left, so
    places from which no end was found are never walked from again.
    """

    def __init__(self, page: str):
        self.page, self.last, self.dead, self.alone = page, page.rfind(">"), set(), {}

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether it closes, name and attributes of the next tag; a comment or declaration has no name."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), False, "", ""
            if start > self.last:
                at = start + 1
                continue
            if page.startswith(("<!", "<?"), start):
                return start, page.index(">", start) + 1, False, "", ""
            if tag := _PLAIN.match(page, start):
                return start, tag.end(), bool(tag[1]), tag[2].lower(), tag[3]
            if (tag := _NAME.match(page, start)) and (end := self._end(tag.end())):
                return start, end, bool(tag[1]), tag[2].lower(), page[tag.end() : end - 1]
            at = start + 1
        return None

    def _end(self, at: int) -> int:
        """The place behind the first ">" outside quotes, 0 if there is none."""
        walked = []
        while stop := _STOP.search(self.page, at):
            place, sign = stop.start(), stop[0]
            if sign == ">":
                return place + 1
            if place in self.dead or place >= self.alone.get(sign, len(self.page)):
                break
            walked.append(place)
            close = self.page.find(sign, place + 1)
            if close < 0:
                self.alone[sign] = place
                break
            at = close + 1
        self.dead.update(walked)
        return 0


class Node:
    """A block element of a skeleton; ``at`` is its number in order of creation."""

    __slots__ = ("label", "children", "at", "cursor")

    def __init__(self, label: str, at: int):
        self.label, self.children, self.at, self.cursor = label, [], at, 0


def _label(tag: str, attributes: str) -> str:
    if "=" not in attributes:
        return tag
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    ids = [x for x in found.get("id", "").split() if _chrome_class(x)]  # others differ from page to page
    classes = " ".join(sorted({*found.get("class", "").split(), *ids}))
    return tag + (f".{classes}" if classes else "") + (f"@{found['role']}" if found.get("role") else "")


def _tag(label: str) -> str:
    return re.split(r"[.@]", label, maxsplit=1)[0]


def is_chrome(label: str) -> bool:
    """Whether an element is no content wherever it stands, by its name."""
    return _tag(label) in CHROME


def _chrome_class(name: str) -> bool:
    """A word for chrome as a whole class name, or a compound of such words: site-nav, comment_list, cookie-notice."""
    parts = re.split(r"[-_]+", name.strip("-_"))
    while len(parts) > 1 and parts[0] in BEFORE_CHROME:
        del parts[0]
    while len(parts) > 1 and parts[-1] in AFTER_CHROME:
        del parts[-1]
    return bool(name.strip("-_")) and all(p in CHROME_WORDS for p in parts)


@lru_cache(maxsize=4096)
def maybe_chrome(label: str) -> bool:
    """Whether role, class or being a form tell an element to be no content, if the page has other content."""
    tag = _tag(label)
    classes, _, role = label[len(tag) :].partition("@")
    if tag in ("html", "body") or not tag:
        return False
    return tag == "form" or role in ROLES or (tag != "main" and any(map(_chrome_class, classes.lstrip(".").split())))


def parse(page: str | None) -> tuple[Node, list[tuple[int, str]]]:
    """The skeleton and the page's blocks of text in order, each with its slot. Chrome by name has no blocks."""
    root = Node("", 0)
    blocks: list[tuple[int, str]] = []
    if not page:
        return root, blocks
    count, here, text = 1, root, []
    stack: list[tuple[str, Node, bool, int]] = [("", root, False, 0)]  # element, its block, inside chrome, place of that block
    open_: Counter[str] = Counter()

    def flush() -> None:
        if text:
            joined = "".join(text)
            block = " ".join((html.unescape(joined) if "&" in joined else joined).split())
            if block and not stack[-1][2]:
                blocks.append((here.at, block))
            text.clear()

    def shut(down_to: int) -> None:
        nonlocal here
        while len(stack) > down_to:
            if stack[-1][0] not in INLINE:
                flush()
            open_[stack.pop()[0]] -= 1
            here = stack[-1][1]

    at, tags = 0, Tags(page)
    while tag := tags.after(at):
        start, end, closes, name, attributes = tag
        if start > at:
            text.append(page[at:start])
        at = end
        if not name:
            continue
        if closes:
            if open_[name]:
                place = len(stack) - 1
                while stack[place][0] != name:
                    place -= 1
                shut(place)
            continue
        if name in INLINE:
            if name == "br":
                text.append(" ")
            elif name not in VOID and not attributes.endswith("/"):
                stack.append((name, here, *stack[-1][2:]))
                open_[name] += 1
            continue
        # Elements that end here, with the inline ones left open in them.
        while (top := stack[-1][3]) and name in ENDS.get(stack[top][0], ()):
            shut(top)
        flush()
        label = _label(name, attributes)
        child = _slot(here, label, count)
        count += child.at == count
        chrome = stack[-1][2] or is_chrome(label) or (name == "header" and not any(open_[r] for r in ROOTS))
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            if not chrome and name == "xmp":
                text.append(page[at : end.start() if end else len(page)])
            at = end.start() if end else len(page)
        stack.append((name, child, chrome, len(stack)))
        open_[name] += 1
        here = child
        child.cursor = 0
    if at < len(page):
        text.append(page[at:])
    shut(1)
    flush()
    return root, blocks


def _slot(parent: Node, label: str, number: int) -> Node:
    """The node for the next child: the one at the cursor or after it with this label, else a new last one."""
    for i in range(parent.cursor, len(parent.children)):
        if parent.children[i].label == label:
            parent.cursor = i
            return parent.children[i]
    parent.children.append(Node(label, number))
    parent.cursor = len(parent.children) - 1
    return parent.children[-1]


def written(root: Node) -> str:
    """One line per node: depth, slot and label, parents first."""
    lines: list[str] = []
    todo = [(root, 0)]
    while todo:
        node, depth = todo.pop()
        lines.append(f"{depth} {node.at} {node.label}")
        todo.extend((c, depth + 1) for c in reversed(node.children))
    return "\n".join(lines)


@lru_cache(maxsize=1024)
def read(skeleton: str) -> Node:
    above: list[Node] = []
    for line in skeleton.split("\n"):
        depth, at, label = line.split(" ", 2)
        node = Node(label, int(at))
        del above[int(depth) :]
        if above:
            above[-1].children.append(node)
        above.append(node)
    return above[0]


def _match(a: Node, b: Node, known: dict) -> tuple[int, tuple]:
    """Simple tree matching: the largest number of node pairs, roots paired, order and depth kept."""
    if (a.at, b.at) in known:
        return known[a.at, b.at]
    rows, columns = len(a.children), len(b.children)
    best = [[0] * (columns + 1) for _ in range(rows + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            paired = best[i][j] + _match(x, y, known)[0] if x.label == y.label else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], paired)
    pairs, i, j = [], rows, columns
    while i and j:
        x, y = a.children[i - 1], b.children[j - 1]
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs.append((x, y))
            i, j = i - 1, j - 1
    known[a.at, b.at] = 1 + best[rows][columns], tuple(pairs)
    return known[a.at, b.at]


def align(skeleton: str, reference: str) -> dict[int, int]:
    """Slots of ``skeleton`` that have a partner in ``reference``."""
    if skeleton == reference:
        return {n.at: n.at for n in _all(read(skeleton))}
    a, b, known = read(skeleton), read(reference), {}
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 2 * skeleton.count("\n") + 2000))  # pages may be deep
    _match(a, b, known)
    out, todo = {}, [(a, b)]
    while todo:
        x, y = todo.pop()
        out[x.at] = y.at
        todo.extend(known[x.at, y.at][1])
    return out


def _all(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        out.append(node := todo.pop())
        todo.extend(node.children)
    return out


def kept_slots(skeleton: str, varying: set[int]) -> tuple[list[int], bool]:
    """The slots that may be content, given those that vary, and whether template texts go from them."""
    root = read(skeleton)
    outer, dropped, freed = _content(root, varying)
    varying = varying - dropped
    if freed and varying - _slots(outer):
        outer = []  # an article in what may be chrome is not the whole content
    marked = bool(outer)
    if not outer:
        while not (root.at in varying) and len(below := [c for c in root.children if _holds(c, varying)]) == 1:
            root = below[0]
        outer = [root]
    inside = _slots(outer) - dropped
    return sorted(inside), not marked or bool(inside & varying)


def _content(top: Node, varying: set[int]) -> tuple[list[Node], set[int], bool]:
    """Below ``top``: the articles and mains, the slots in chrome, and whether an element that may be chrome is none.

    That is one that holds the only article or main, or with others all that varies.
    """
    aside = _outermost(top, maybe_chrome)
    roots = [n for n in _outermost(top, lambda x: _tag(x) in ROOTS or maybe_chrome(x)) if n not in aside]
    if roots:
        dropped = _slots(aside)
        for r in roots:
            within = _slots(_outermost(r, maybe_chrome))
            dropped |= within if varying & _slots([r]) - within else set()
        return roots, dropped, False
    free = [a for a in aside if _tag(a.label) in ROOTS or _outermost(a, lambda x: _tag(x) in ROOTS)]
    here = varying & _slots([top])
    if not free and here <= _slots(aside):
        free = [a for a in aside if _holds(a, here)]
    dropped = _slots(a for a in aside if a not in free)
    for a in free:
        below = _content(a, varying)
        roots, dropped = roots + below[0], dropped | below[1]
    return roots, dropped, bool(free)


def _outermost(top: Node, wanted) -> list[Node]:
    """The outermost elements below ``top`` with such a label, outside chrome."""
    out, todo = [], list(top.children)
    while todo:
        node = todo.pop()
        if wanted(node.label):
            out.append(node)
        elif not is_chrome(node.label):
            todo.extend(node.children)
    return out


def _slots(nodes: Iterable[Node]) -> set[int]:
    return {x.at for n in nodes for x in _all(n)}


def _holds(node: Node, slots: set[int]) -> bool:
    return any(n.at in slots for n in _all(node))


def _listing(name: str, **fields: T.DataType) -> T.StructType:
    """A skeleton and an array of structs."""
    listed = T.ArrayType(T.StructType([T.StructField(n, kind) for n, kind in fields.items()]))
    return T.StructType([T.StructField("skeleton", T.StringType()), T.StructField(name, listed)])


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


_PARSED = _listing("blocks", slot=T.IntegerType(), hash=T.LongType(), text=T.StringType())


@F.arrow_udf(_PARSED)
def _parsed(pages: pa.Array) -> pa.Array:
    out = []
    for page in pages:
        root, blocks = parse(page.as_py())
        out.append({"skeleton": written(root), "blocks": [{"slot": s, "hash": _hash(t), "text": t} for s, t in blocks]})
    block = pa.struct([("slot", pa.int32()), ("hash", pa.int64()), ("text", pa.string())])
    return pa.array(out, pa.struct([("skeleton", pa.string()), ("blocks", pa.list_(block))]))


_SLOTS = _listing("slots", slot=T.IntegerType(), hash=T.LongType())
_HELD = _SLOTS["slots"].dataType


@F.arrow_udf(_SLOTS)
def _hashed(pages: pa.Array) -> pa.Array:
    """Per page its slots, each once without a hash, and the different blocks in them."""
    out = []
    for page in pages:
        root, blocks = parse(page.as_py())
        held = dict.fromkeys((s, _hash(t)) for s, t in blocks)
        slots = dict.fromkeys(s for s, _ in held)
        out.append({"skeleton": written(root), "slots": [{"slot": s, "hash": h} for s, h in (*((s, None) for s in slots), *held)]})
    return pa.array(out, pa.struct([("skeleton", pa.string()), ("slots", pa.list_(pa.struct([("slot", pa.int32()), ("hash", pa.int64())])))]))


@F.arrow_udf(_listing("pairs", slot=T.IntegerType(), partner=T.IntegerType())["pairs"].dataType)
def _aligned(skeletons: pa.Array, references: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("partner", pa.int32())]))
    done: dict[tuple, list] = {}
    out = []
    for pair in zip(skeletons.to_pylist(), references.to_pylist()):
        if pair not in done:
            done[pair] = [{"slot": s, "partner": p} for s, p in align(*pair).items()]
        out.append(done[pair])
    return pa.array(out, kind)


_KEPT = T.StructType([T.StructField("kept", T.ArrayType(T.IntegerType())), T.StructField("taught", T.BooleanType())])


@F.arrow_udf(_KEPT)
def _kept(skeletons: pa.Array, varyings: pa.Array) -> pa.Array:
    found = (kept_slots(s, set(v or ())) for s, v in zip(skeletons.to_pylist(), varyings.to_pylist()))
    return pa.array([{"kept": k, "taught": t} for k, t in found], pa.struct([("kept", pa.list_(pa.int32())), ("taught", pa.bool_())]))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(whole(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _skeleton_key() -> list[Column]:
    a, b = two_hashes(F.col("skeleton"))
    return [a.alias("ka"), b.alias("kb")]


_PAGE = -1  # the slot that stands for a page as a whole
_PARTS = 64  # of a skeleton with more than a thousandth of all pages


def wrappers(pages: DataFrame, url: str = "url", page: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, ka, kb`` (128 bits of a skeleton), ``kept``, the slots that may be content, and ``template``, texts to drop in them.

    Pages are parsed once, for one row per host, skeleton, slot and block; that table
    and the result are written, all else starts from it.
    """
    seen = pages.select(host_of(column(url)).alias("host"), _hashed(whole(column(page))).alias("p"))
    seen = seen.select("host", F.col("p.skeleton").alias("skeleton"), F.col("p.slots").alias("slots"))
    seen = seen.where(F.size("slots") > 0).distinct()
    whole_page = F.struct(F.lit(_PAGE).alias("slot"), F.lit(None).cast("long").alias("hash"))
    each = seen.select("host", *_skeleton_key(), "skeleton", F.inline(F.concat(F.array(whole_page), "slots")))
    facts = each.groupBy("host", "ka", "kb", "slot", "hash").agg(
        F.count("*").alias("pages"), F.min(F.when(F.col("slot") == _PAGE, F.col("skeleton"))).alias("skeleton"))
    facts = stage(facts, "wrapper-facts")
    kinds = facts.where(F.col("slot") == _PAGE).select("host", "ka", "kb", "pages", "skeleton")
    facts = facts.where(F.col("slot") != _PAGE).drop("skeleton")
    hosts = kinds.groupBy("host").agg(F.max(F.struct("pages", "skeleton"))["skeleton"].alias("reference"))
    met = kinds.join(hosts, "host").select("host", "ka", "kb", "skeleton", _aligned("skeleton", "reference").alias("pairs"))
    met = stage(met, "wrapper-skeletons")
    # Blocks meet the alignment; slots without a partner keep to their own skeleton.
    every = kinds.agg(F.sum("pages").alias("n")).scalar()
    common = kinds.where(F.col("pages") * 1000 > every).select("host", "ka", "kb", F.lit(_PARTS).alias("parts"))
    common, keys = F.broadcast(common), ["host", "ka", "kb"]  # fewer than 1,000 rows
    partner = met.select(*keys, F.inline("pairs")).join(common, keys, "left")
    partner = partner.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    salt = F.pmod(F.coalesce("hash", F.lit(0)), F.coalesce("parts", F.lit(1))).cast("int")
    placed = facts.join(common, keys, "left").withColumn("salt", salt).drop("parts")
    own = F.when(F.col("partner").isNull(), F.struct(F.col("ka").alias("ka"), F.col("kb").alias("kb"), F.col("slot").alias("slot")))
    placed = placed.join(partner, [*keys, "slot", "salt"], "left").select(
        *keys, "slot", "hash", "pages", F.struct(F.col("partner").alias("partner"), own.alias("own")).alias("shared"))
    placed = stage(placed, "wrapper-slots")
    totals = placed.where("hash IS NULL").groupBy("host", "shared").agg(F.sum("pages").alias("total"))
    voted = placed.where("hash IS NOT NULL").groupBy("host", "shared", "hash").agg(F.sum("pages").alias("votes")).where(F.col("votes") >= min_pages)
    template = voted.join(totals, ["host", "shared"]).where(F.col("votes") >= SHARE * F.col("total"))
    template = template.select("host", "shared", "hash", F.lit(True).alias("template"))
    taught = placed.where("hash IS NOT NULL").join(template, ["host", "shared", "hash"], "left")
    # A slot has at most 1 / SHARE times as many templates as a page of it has blocks.
    slots = taught.groupBy(*keys, "slot").agg(
        F.collect_list(F.when(F.col("template"), F.col("hash"))).alias("hashes"), F.max(F.col("template").isNull()).alias("varies")
    )
    flags = slots.groupBy(*keys).agg(
        F.flatten(F.collect_list(F.transform("hashes", lambda h: F.struct(F.col("slot").alias("slot"), h.alias("hash"))))).alias("template"),
        F.collect_list(F.when(F.col("varies"), F.col("slot"))).alias("varying"),
    )
    learned = met.select("host", "ka", "kb", "skeleton").join(flags, ["host", "ka", "kb"], "left")
    learned = learned.withColumn("kept", _kept("skeleton", "varying"))
    return stage(learned.select("host", "ka", "kb", "kept.kept", F.when(F.col("kept.taught"), F.col("template")).alias("template")), "wrappers")


def extract(pages: DataFrame, url: str = "url", page: str = "html", into: str = "text", min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with ``into``: the blocks of the main text, one a line."""
    learned = wrappers(pages, url, page, min_pages)
    names = {c: free_name(pages, f"wrapper_{c}") for c in learned.columns}
    at = {c: free_name(pages, f"page_{c}") for c in ("parsed", "host", "ka", "kb")}
    own = [c for c in pages.columns if c.lower() != into.lower()]
    parsed = pages.withColumn(at["parsed"], _parsed(whole(column(page)))).withColumn(at["host"], host_of(column(url)))
    skeleton = F.col(at["parsed"])["skeleton"]
    a, b = two_hashes(skeleton)
    parsed = parsed.select(*[column(c) for c in own if c != page], *([column(page)] if page in own else []),
                           F.col(at["host"]), a.alias(at["ka"]), b.alias(at["kb"]), F.col(at["parsed"])["blocks"].alias(at["parsed"]))
    same = [F.col(at[c]) == F.col(names[c]) for c in ("host", "ka", "kb")]
    met = parsed.join(learned.withColumnsRenamed(names), same, "left")
    template = F.coalesce(F.col(names["template"]), F.expr("array()").cast(_HELD))
    content = F.filter(F.col(at["parsed"]), lambda x: F.array_contains(F.col(names["kept"]), x["slot"])
                       & ~F.array_contains(template, F.struct(x["slot"].alias("slot"), x["hash"].alias("hash"))))
    text = F.coalesce(F.array_join(F.transform(content, lambda x: x["text"]), "\n"), F.lit(""))
    return met.select(*[column(c) for c in own], text.alias(into))
