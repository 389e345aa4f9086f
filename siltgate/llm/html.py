"""HTML extraction by wrappers: union-free regular expressions inferred from the pages of one host.

A page's tokens become a tree of tags in document order. Pages of a host are aligned one after another with the host's
wrapper: a tag that comes again beside itself is a repeated group; groups of one tag that other tags part are matched
first with first, second with second, as long as all pages have the same number of them, and become one repeated group
where the numbers differ; a tag that some pages lack is optional, and text that differs is a slot. Each of these steps
gives the same wrapper in any order, so tasks infer partial ones and few rows meet per host. The finished wrapper tells
which slots are the article: an article or main element is one signal, which the slots outside of it can outweigh.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltgate.llm.common import stored
from siltgate.llm.urls import host_and_path

# Element groups of the HTML standard. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i ins kbd mark q s samp small span strong sub sup "
                   "time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                     "main nav ol p pre section table ul".split())
#: A start tag that ends an open element of its own list or row: (ended, not beyond).
ENDS = {
    "li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "tr": (("tr",), ("table",)),
    "option": (("option",), ("select",)),
}
TAGS = VOID | RAW | INLINE | CLOSES_P | frozenset(
    "html head body li dt dd tr td th thead tbody tfoot caption colgroup figcaption hgroup search details summary dialog menu "
    "option optgroup select button label legend datalist output progress meter map picture video audio canvas svg math "
    "object center font frameset frame noframes ruby rt rp slot".split())
#: Never part of an article.
DROPPED = frozenset("head nav header footer aside form script style title textarea noscript template iframe button "
                    "select svg canvas object menu dialog".split())
_NAME = (
    r"(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|notice\w*|alert\w*|popup|modal|"
    r"newsletter|subscri\w*|nav\w*|menu\w*|breadcrumb\w*|sidebar\w*|footer|header|masthead|comment\w*|disqus\w*|repl(?:y|ies)|"
    r"share|sharing|social|related|widget\w*|toolbar|pagination|pager|login|search)")
#: A class or id that is such a name; one that has it as a part, which alone means nothing.
_WHOLE_NAME, _PART_NAME = re.compile(_NAME + "[0-9]*"), re.compile(f"(?:^|[-_]){_NAME}(?:$|[-_0-9])")
_DROPPED_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
MAIN = frozenset(("article", "main"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?=[a-zA-Z/])[^>]*>?|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DIGITS = re.compile("[0-9]+")
#: Pages of a host, different in their text, that must agree on a text outside of articles before it counts as part of the
#: template. Shared text of LARGE characters a page or more is not, where it is more than what differs.
AGREEING, LARGE = 5, 100
MAX_LINKS = 0.5
#: Main elements are the article unless the slots outside of them on the same pages hold more than 1 / MAIN_SHARE of theirs.
MAIN_SHARE = 0.25
#: Elements nested deeper count as part of the last one; a tag with more groups in one element is one repeated group.
MAX_DEPTH, MAX_GROUPS = 100, 16
#: A host's wrapper tells at most so many marked tags apart, each of this share of its pages or more; it has so many nodes.
MAX_KEYS, KEY_SHARE, MAX_NODES, MAX_MARKS = 256, 0.01, 2_000, 200
#: A task hands its wrappers on beyond this many nodes.
TASK_NODES = 200_000
#: A host's partial wrappers are first aligned in so many groups.
SALTS = 32


@lru_cache(maxsize=4096)
def _key(name: str, attributes: str) -> str:
    """The tag as the wrapper sees it: name, classes, id and role, digits alike."""
    found = {m[1].lower(): next(x for x in m.groups()[1:] if x is not None).lower().replace("@", "_")
             for m in _ATTRIBUTE.finditer(attributes)}
    classes, own, role = sorted(found.get("class", "").split()), found.get("id", ""), found.get("role", "")
    marks = "".join(f"{sign}{value}" for sign, value in ((".", " ".join(classes)), ("#", own)) if value)
    role = f"@{role}" if role and len(role) < MAX_MARKS else ""
    if len(marks) + len(role) > MAX_MARKS:
        # What the names say is judged on all of them; the wrapper's key holds the verdict and those that fit.
        marks = ("", ".x-ad", ".ad")[_names_kind([*classes, *re.split("[.# ]", own)])]
        for mark in (*(f".{c}" for c in classes), f"#{own}"):
            if len(marks) + len(mark) + len(role) <= MAX_MARKS and not _names_kind(re.split("[.# ]", mark)):
                marks += mark
    return name + _DIGITS.sub("0", marks + role)


def _names_kind(names: list[str]) -> int:
    """2: one is a name of things around articles; 1: one has such a name as a part; 0."""
    return 2 if any(map(_WHOLE_NAME.fullmatch, names)) else 1 if any(map(_PART_NAME.search, names)) else 0


@lru_cache(maxsize=4096)
def _unwanted(key: str) -> int:
    """3: dropped by tag or role; 2: a class or id is a name of things around articles; 1: it has one as a part; 0."""
    name, marks = re.match(r"([^.#@]*)(.*)", key, re.S).groups()
    if name in DROPPED or marks.partition("@")[2] in _DROPPED_ROLE:
        return 3
    if name in ("html", "body") or _is_main(key):
        return 0
    return _names_kind(re.split(r"[.# ]", marks.partition("@")[0]))


def _is_main(key: str) -> bool:
    return re.match(r"[^.#@]*", key)[0] in MAIN or key.endswith("@main")


@lru_cache(maxsize=4096)
def _bare(key: str) -> str:
    """The tag without marks of its own: only what they say about articles stays."""
    name = re.match(r"[^.#@]*", key)[0]
    name = name if name in TAGS else "other"
    kind = _unwanted(key)
    if _is_main(key):
        return name if name in MAIN else name + "@main"
    return name if kind == _unwanted(name) else name + ("", ".x-ad", ".ad", "@navigation")[kind]


def _folded(key: str, known: frozenset | None) -> str:
    return key if known is None or key in known or key in TAGS else _bare(key)


def walk(page: str) -> Iterator[tuple[str, str | None, bool]]:
    """The page's events: ("open", key, is inline), ("close", None, is inline), ("text", text, in a link), ("break", ...).

    Ends that HTML leaves out are put in; comments and the content of scripts and styles are left out.
    """
    stack: list[str] = []
    inside: Counter[str] = Counter()
    at = 0

    def pop() -> tuple[str, None, bool]:
        name = stack.pop()
        inside[name] -= 1
        return "close", None, name in INLINE

    while match := _TOKEN.match(page, at):
        at = match.end()
        name = match[2]
        if name is None:
            token = match[0]
            if token[0] != "<" or token == "<":
                yield "text", token, inside["a"] > 0
            continue
        name = name.lower()
        if match[1]:
            if inside[name]:
                while stack[-1] != name:
                    yield pop()
                yield pop()
            continue
        if name in CLOSES_P and inside["p"]:
            ended, barrier = ("p",), ("button", "table", "li", "div", "article", "section", "td")
        else:
            ended, barrier = ENDS.get(name, ((), ()))
        for i in range(len(stack) - 1, -1, -1) if ended else ():
            if stack[i] in ended:
                while len(stack) > i:
                    yield pop()
                break
            if stack[i] in barrier:
                break
        if name in VOID:
            yield "break", name, name in ("br", "wbr", "img", "input")
            continue
        if match[3].rstrip().endswith("/") and name not in INLINE and name not in CLOSES_P and name not in RAW:
            continue
        stack.append(name)
        inside[name] += 1
        yield "open", _key(name, match[3]), name in INLINE
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
    while stack:
        yield pop()


class Node:
    """One tag of a wrapper. text is None (no text), a checksum (always the same text) or True (a slot).

    It is optional where it has fewer pages than its parent. `main_chars` are those of pages that have an article or main
    element. `texts` are the least AGREEING checksums of the whole text of its pages: copies of a page count once.
    `kids` holds, per key, the groups of that tag in their order, or one if `folded` has the key.
    """

    __slots__ = ("pages", "repeated", "text", "chars", "links", "main_chars", "texts", "kids", "folded")

    def __init__(self):
        self.pages, self.repeated, self.text, self.chars, self.links, self.main_chars = 0, False, None, 0, 0, 0
        self.texts: list[int] = []
        self.kids: dict[str, list[Node]] = {}
        self.folded: set[str] = set()

    def fold(self, key: str) -> None:
        """All groups of the key become one repeated group."""
        first, *others = self.kids[key]
        self.folded.add(key)
        for other in others:
            first.take(other, beside=True)
        self.kids[key] = [first]

    def take(self, other: Node, beside: bool = False) -> None:
        """Resolve the mismatches with the same tag of other pages, or with one that stands beside it on the same ones."""
        if beside:
            self.repeated = True
            self.text = None if self.text is other.text is None else True
            self.pages = max(self.pages, other.pages)
        else:
            if not self.pages:
                self.text = other.text
            elif self.text != other.text:
                self.text = True
            self.repeated |= other.repeated
            self.pages += other.pages
        self.chars += other.chars
        self.links += other.links
        self.main_chars += other.main_chars
        if len(self.texts) < AGREEING or other.texts and other.texts[0] < self.texts[-1]:
            self.texts = sorted({*self.texts, *other.texts})[:AGREEING]
        for key, theirs in other.kids.items():
            mine = self.kids.get(key)
            if mine is None:
                self.kids[key] = theirs
                if key in other.folded:
                    self.folded.add(key)
                continue
            if key in self.folded or key in other.folded or len(mine) != len(theirs):
                for node in (self, other):
                    if key not in node.folded:
                        node.fold(key)
                mine, theirs = self.kids[key], other.kids[key]
                mine[0].repeated = True
            for x, y in zip(mine, theirs, strict=True):
                x.take(y, beside)

    def packed(self) -> list:
        return [self.pages, self.repeated, self.text, self.chars, self.links, self.main_chars, self.texts, sorted(self.folded),
                {key: [kid.packed() for kid in kids] for key, kids in self.kids.items()}]

    @classmethod
    def unpacked(cls, row: list) -> Node:
        self = cls()
        self.pages, self.repeated, self.text, self.chars, self.links, self.main_chars, self.texts, folded, kids = row
        self.folded = set(folded)
        self.kids = {key: [cls.unpacked(x) for x in rows] for key, rows in kids.items()}
        return self

    def cut(self) -> None:
        """Beyond MAX_NODES, the tags of the fewest pages become text of the elements that hold them."""
        if self.size() <= MAX_NODES:
            return
        units, todo = [], [(self, 0)]
        for node, depth in todo:
            for key, kids in node.kids.items():
                units.append((-max(k.pages for k in kids), depth, len(units), node, key))
                todo += [(kid, depth + 1) for kid in kids]
        room, kept = MAX_NODES // 2, {id(self)}
        for *_, node, key in sorted(units, key=lambda u: u[:3]):
            kids = node.kids[key]
            if id(node) in kept and len(kids) <= room:
                room -= len(kids)
                kept.update(map(id, kids))
        for *_, node, key in reversed(units):
            if id(node.kids[key][0]) not in kept:
                for kid in node.kids.pop(key):
                    node.text = True if kid.text is not None else node.text
                    node.chars, node.links = node.chars + kid.chars, node.links + kid.links
                    node.main_chars += kid.main_chars
                node.folded.discard(key)

    def template(self) -> bool:
        """One text on enough different pages."""
        return self.text is not None and self.text is not True and len(self.texts) >= AGREEING

    def size(self) -> int:
        return 1 + sum(kid.size() for kids in self.kids.values() for kid in kids)


class Held:
    """What an element and those in it hold: characters, a main element, slot text inside and outside of main elements."""

    __slots__ = ("chars", "links", "main", "agreed", "inside", "outside")

    def __init__(self, chars: int, links: int, main: bool):
        self.chars, self.links, self.main, self.agreed, self.inside, self.outside = chars, links, main, True, 0, 0

    def add(self, part: Held) -> None:
        self.chars += part.chars
        self.links += part.links
        self.main |= part.main
        self.agreed &= part.agreed
        self.inside += part.inside
        self.outside += part.outside


class Frame:
    """An open element of a page: its node, the groups of each tag seen in it so far, and in those before it."""

    __slots__ = ("node", "last", "groups", "before")

    def __init__(self, node, before: dict[str, int] | None = None):
        self.node, self.last, self.groups, self.before = node, None, {}, before or {}

    def group(self, key: str) -> int:
        """The number of the group that a tag with this key belongs to."""
        if key != self.last:
            self.last = key
            self.groups[key] = self.groups.get(key, -1) + 1
        return self.groups[key]

    def uneven(self) -> list[tuple[Node, str]]:
        """Tags with another number of groups here than in the elements before that share the node, or with too many."""
        return [(self.node, key) for key, last in self.groups.items()
                if last >= MAX_GROUPS or self.before.get(key, last + 1) != last + 1]


class Wrapper:
    """A host's tags, aligned; size follows the host's tags, not its pages."""

    def __init__(self, root: Node | None = None):
        self.root = root or Node()

    @property
    def nodes(self) -> list[list]:
        """[parent, key, pages, repeated, text] of every node."""
        out: list[list] = []

        def add(parent: int, key: str, node: Node) -> None:
            at = len(out)
            out.append([parent, key, node.pages, node.repeated, node.text])
            for name, kids in node.kids.items():
                for kid in kids:
                    add(at, name, kid)

        add(-1, "", self.root)
        return out

    @classmethod
    def of_page(cls, page: str, known: frozenset | None = None) -> Wrapper:
        self = cls()
        self.root.pages = 1
        inline: list[bool] = []
        texts: dict[int, int] = {}
        frames = [Frame(self.root)]
        touched: list[Node] = []
        uneven: list[tuple[Node, str]] = []
        main, whole = False, hashlib.blake2b(digest_size=6)
        for kind, value, flag in walk(page):
            if kind == "open":
                plain = flag and value in INLINE
                inline.append(plain)
                if not plain:
                    value = _folded(value, known)
                    main = main or _is_main(value)
                    frames.append(frames[-1] if len(frames) > MAX_DEPTH else self._open(frames[-1], value))
            elif kind == "close":
                if not inline.pop() and (frame := frames.pop()) is not frames[-1]:
                    uneven += frame.uneven()
            elif kind == "text" and not value.isspace():
                node = frames[-1].node
                node.chars += len(value)
                node.links += len(value) if flag else 0
                if id(node) not in texts:
                    touched.append(node)
                token = value.strip().encode("utf-8", "surrogatepass")
                texts[id(node)] = zlib.crc32(token, texts.get(id(node), 0))
                whole.update(token + b"\n")
        own = [int.from_bytes(whole.digest())]
        for node in touched:
            node.texts = own
            node.text = True if node.repeated else texts[id(node)]
            node.main_chars = node.chars if main else 0
        # Inner elements come first, so what is folded is still part of the page.
        for node, key in uneven + frames[0].uneven():
            if key not in node.folded:
                node.fold(key)
                node.kids[key][0].repeated = True
        return self

    @staticmethod
    def _open(frame: Frame, key: str) -> Frame:
        again = frame.last == key
        at, groups = frame.group(key), frame.node.kids.setdefault(key, [])
        if at == len(groups):
            groups.append(Node())
        node = groups[at]
        before = {name: len(kids) for name, kids in node.kids.items()} if node.pages else {}
        node.repeated = node.repeated or again or node.pages > 0
        node.pages = 1
        return Frame(node, before)

    def align(self, other: Wrapper) -> None:
        """Resolve the mismatches with another page or wrapper of the host, whose nodes are used up."""
        other.root.cut()
        self.root.take(other.root)
        self.root.cut()

    def copies(self) -> bool:
        """Whether pages share more than differs, and enough to be an article: variants of one page, not of one template."""
        sums = [0, 0]

        def add(node: Node) -> None:
            if node.links <= MAX_LINKS * node.chars:
                sums[node.template()] += node.chars
            for key, kids in node.kids.items():
                for kid in kids if _unwanted(key) < 3 else ():
                    add(kid)

        add(self.root)
        return sums[True] > sums[False] and sums[True] >= LARGE * self.root.pages

    def article(self) -> list:
        """Whether main elements are the article, and per node [taken in it, outside, outside with shared text, folded keys, kids]."""
        totals = [0, 0]
        held: dict[int, Held] = {}

        def measure(key: str, node: Node, main: bool) -> Held:
            main = main or _is_main(key)
            own = held[id(node)] = Held(node.chars, node.links, main)
            template = node.template() and not copies
            own.agreed = node.text is None or template
            own.inside, own.outside = (0, 0) if template else (node.chars, 0) if main else (0, node.chars - node.main_chars)
            for name, kids in node.kids.items():
                for kid in kids:
                    part = measure(name, kid, main)
                    if _unwanted(name) < 3:
                        own.add(part)
            return own

        copies = self.copies()
        whole = measure("", self.root, False)

        def leaves(key: str, node: Node, main: bool) -> bool:
            """A name drops nothing that holds a main element or most slots; a part of a name needs links or one text."""
            kind, own = _unwanted(key), held[id(node)]
            if kind in (0, 3):
                return kind == 3
            if (own.main and not main) or 2 * own.inside > whole.inside > 0 or 2 * own.outside > whole.outside > 0:
                return False
            return kind == 2 or own.agreed or own.links > MAX_LINKS * own.chars

        def rules(key: str, node: Node, dropped: bool, main: bool) -> list:
            dropped = dropped or leaves(key, node, main)
            main = main or _is_main(key)
            template = node.template() and not copies
            menu = node.chars > 0 and node.links / node.chars > MAX_LINKS
            outside = not (dropped or template or menu)
            if main and not dropped:
                totals[0] += node.main_chars
            elif outside and not main and not node.template():
                totals[1] += node.main_chars
            return [main and not dropped, outside, not (dropped or menu), sorted(node.folded),
                    {name: [rules(name, kid, dropped, main) for kid in kids] for name, kids in node.kids.items()}]

        out = rules("", self.root, False, False)
        return [totals[0] >= MAIN_SHARE * totals[1], out]


class Rules:
    """A host's wrapper, ready for its pages."""

    def __init__(self, found: list):
        self.use_main, self.root, *known = found
        self.known = frozenset(known[0]) if known else None

    def text(self, page: str) -> str:
        """The article's blocks, one a line."""
        blocks: tuple[list[str], ...] = ([], [], [])
        current: tuple[list[str], ...] = ([], [], [])
        frames, inline, has_main = [Frame(self.root)], [], False

        def flush() -> None:
            for done, parts in zip(blocks, current, strict=True):
                if parts and (block := " ".join(html.unescape("".join(parts)).split())):
                    done.append(block)
                parts.clear()

        for kind, value, flag in walk(page):
            if kind == "text":
                row = frames[-1].node
                for parts, taken in zip(current, row[:3], strict=True):
                    if taken:
                        parts.append(value)
                has_main = has_main or (row[0] and not value.isspace())
            elif kind == "break":
                for parts in current if flag else ():
                    parts.append(" ")
                if not flag:
                    flush()
            else:
                if not flag:
                    flush()
                if kind == "open":
                    inline.append(flag and value in INLINE)
                    if not inline[-1]:
                        frames.append(frames[-1] if len(frames) > MAX_DEPTH else
                                      Frame(self._kid(frames[-1], _folded(value, self.known))))
                elif not inline.pop():
                    frames.pop()
        flush()
        # Nothing but shared text is the page's own.
        return "\n".join(blocks[0] if has_main and self.use_main else blocks[1] or blocks[2])

    @staticmethod
    def _kid(frame: Frame, key: str) -> list:
        at, groups = frame.group(key), frame.node[4].get(key)
        if groups:
            return groups[0 if key in frame.node[3] else min(at, len(groups) - 1)]
        # Cut from the wrapper: as the element around it, but for its own tag and names.
        taken = frame.node[:3] if _unwanted(key) < 2 else [False] * 3
        return [taken[0] or _is_main(key) and taken[2], *taken[1:], [], {}]


@lru_cache(maxsize=256)
def _rules(text: str) -> Rules:
    return Rules(json.loads(text))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Wrapper] = {}
    size = 0

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array([json.dumps(w.root.packed()) for w in found.values()], pa.string())],
            ["host", "wrapper"])

    for batch in batches:
        for host, page, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = found.setdefault(host, Wrapper())
            size -= own.root.size()
            own.align(Wrapper.of_page(page, frozenset(keys or ())))
            size += own.root.size()
            if size > TASK_NODES:
                yield rows()
                found, size = {}, 0
    yield rows()


def _align_all(group: pa.Table) -> pa.Table:
    whole = Wrapper()
    for text in sorted(group["wrapper"].to_pylist()):
        whole.align(Wrapper(Node.unpacked(json.loads(text))))
    return pa.table({"host": [group["host"][0].as_py()], "wrapper": [json.dumps(whole.root.packed())]})


def _count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[tuple[str, str]] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in found], pa.string()), pa.array([k for _, k in found], pa.string()),
             pa.array(found.values(), pa.int64())], ["host", "key", "n"])

    for batch in batches:
        for host, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            marked = {_key(m[2].lower(), m[3]) for m in _TOKEN.finditer(page) if m[2] and not m[1] and "=" in m[3]}
            found.update((host, key) for key in {"", *marked})
            if len(found) > TASK_NODES:
                yield rows()
                found.clear()
    yield rows()


def common_keys(pages: DataFrame) -> DataFrame:
    """pages: host, html -> one row per host: host, and the at most MAX_KEYS marked tags that enough of its pages share."""
    counts = pages.mapInArrow(_count_keys, "host string, key string, n long").groupBy("host", "key").agg(F.sum("n").alias("n"))
    # The empty key counts all pages, so it is the first.
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "key")))
    kept = ranked.where(F.col("rank") <= MAX_KEYS + 1).groupBy("host").agg(
        F.max("n").alias("pages"), F.array_sort(F.collect_list(F.struct("key", "n"))).alias("keys"))
    keys = F.transform(F.filter("keys", lambda k: (k["key"] != "") & (k["n"] >= KEY_SHARE * F.col("pages"))), lambda k: k["key"])
    return kept.select(F.col("host").alias("key_host"), keys.alias("keys"))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """pages: host, html, keys -> one row per host: host, wrapper of at most MAX_NODES nodes."""
    schema = "host string, wrapper string"
    parts = pages.mapInArrow(_partial, schema).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    parts = parts.groupBy("host", "salt").applyInArrow(_align_all, schema)
    return parts.groupBy("host").applyInArrow(_align_all, schema)


def _to_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rules = [json.dumps([*Wrapper(Node.unpacked(json.loads(w))).article(), keys or []])
                 for w, keys in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rules, pa.string())], ["rule_host", "rules"])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: key, url, text, n_chars.

    Wrappers come from all pages of a host. A page's text is that of its article or main element where it has one and
    the host's slots outside of it don't outweigh it, otherwise all slots outside of menus, notices and the like. References are decoded, white space within a block is
    one space, blocks are lines. Null or empty html gives an empty text, a null url the empty host; repeated rows and
    null keys stay; other columns are ignored.
    """
    given = pages.select(F.col(key).alias(key), F.col(url).alias("url"), host_and_path(F.col(url))[0].alias("host"),
                         F.coalesce(page, F.lit("")).alias("html"))
    keys = stored(common_keys(given.select("host", "html")), "keys")
    wrappers = infer_wrappers(given.join(keys, F.col("host") == F.col("key_host")).select("host", "html", "keys"))
    wrappers = wrappers.join(keys, F.col("host") == F.col("key_host")).select("host", "wrapper", "keys")
    rules = stored(wrappers.mapInArrow(_to_rules, "rule_host string, rules string"), "wrappers")
    joined = given.join(rules, F.col("host") == F.col("rule_host")).select(key, "url", "html", "rules")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_rules(r).text(p) for p, r in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], [key, "url", "text", "n_chars"])

    kind = pages.schema[key].dataType.simpleString()
    return joined.mapInArrow(run, f"`{key}` {kind}, url string, text string, n_chars long")
