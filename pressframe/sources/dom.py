"""HTML to rows: every page becomes one row per element or string, in document order.

``pos`` counts all nodes of the page from 1, and ``[pos, end_pos]`` is the interval of the
subtree.  With that numbering "is inside" is a comparison, so all later work is filters,
windows, aggregates and joins on DataFrames.  Reading tag soup needs a stack, hence this one
Arrow stage; nothing else in the package walks a tree.

Time and output grow in proportion to the page, whatever it holds: the reader passes over it once, a path is its parent's
path and one name more, a text is a stretch of the page's text, and what a row repeats of them has a bounded length.
"""

from __future__ import annotations

import codecs
import gc
import re
import sys
from bisect import bisect_left
from collections.abc import Callable, Iterator
from hashlib import blake2b
from html.entities import html5
from html.parser import HTMLParser
from operator import attrgetter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from pressframe.functions.text import WS

# Ship the code of this module inside the task, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds of rows: E element, T page text, S script, Y style, X other contained strings, C comment, D doctype,
# N declaration, M marked section, P processing instruction, R reason why a page could not be read.
# Tags that never have content, and tags whose strings are not page text.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split())
STRING_KINDS = {"script": "S", "style": "Y", "template": "X", "rt": "X", "rp": "X"}
PREFORMATTED = frozenset(["pre", "textarea"])

# Elements whose stripped subtree text travels with the element row, by tag or by span class.
TEXT_TAGS = frozenset(["a", "h1"])
TEXT_CLASSES = ("author", "byline")

# ``page_id`` keeps the type it has in the pages.
DOM_SCHEMA = (
    "page_id {key}, pos int, end_pos int, parent int, depth int, node_idx int, seq int, own_no int, "
    "kind string, tag string, attrs map<string,string>, text string, text_len int, "
    "owner struct<tag:string,class:string,style:string,type:string,end_pos:int>, "
    "anc_flex string, anc_strict string"
)
_BATCH_ROWS = 8192
_BATCH_CHARS = 8_000_000
# New objects between two searches for cycles.
_GC_AFTER = 100_000

# A path of more characters is its beginning and a digest of the whole: still equal only for equal paths.
PATH_LIMIT, PATH_SHOWN = 1000, 200
# An element's text of more characters is cut at the end of a word, or amid one of over WORD_LIMIT more, and
# MORE_WORDS words that follow are added, likewise cut: its length and its number of words still tell it from short ones.
TEXT_LIMIT, WORD_LIMIT, MORE_WORDS = 1000, 100, 5
# Strings repeat the class, style and type of their element up to this length.
OWNER_LIMIT = 2000
_WORD = re.compile(f"[^{WS}-]+")

# Text and the plain tag after it, as most pages write them; everything else goes by the standard parser.
# The last group is a character of such a thing.
_PLAIN = re.compile(r'(?s)([^<&]*+)<(?:/([a-z][a-z0-9]*+)>|([a-z][a-z0-9]*+)((?: [a-z][a-z-]*+="[^"&<>]*+")*+) ?(/?)>)|(.)')
_PLAIN_ATTRIBUTE = re.compile(r' ([a-z-]+)="([^"]*)"')
_REFERENCE = re.compile(r"&([a-zA-Z][a-zA-Z0-9]*);")
_RAW_TAGS = ("script", "style")
_NOT_PLAIN = frozenset([*VOID_TAGS, *STRING_KINDS])


class _Node:
    __slots__ = ("pos", "end", "up", "depth", "idx", "seq", "own_no", "kind", "tag", "attrs", "text",
                 "length", "strings", "text_at", "path", "size", "in_option", "asked")

    def __init__(self, pos, up, kind, tag=None, attrs=None, text=None):
        self.pos = self.end = pos
        self.up = up
        self.depth = up.depth + 1 if up else 0
        self.kind = kind
        self.tag = tag
        self.attrs = attrs
        self.text = text
        self.idx = self.seq = self.own_no = self.path = None
        self.length = self.strings = 0
        self.in_option = False
        self.asked = None


class _Path:
    """Paths by tag names and by tag, id and classes down to an element, as rows show them, and those of the elements in it."""
    __slots__ = ("flex", "strict", "shown", "below")

    def __init__(self, above, tag, name):
        self.flex, self.strict = _longer(above and above.flex, tag), _longer(above and above.strict, name)
        self.shown = tuple(text if digest is None else f"{text} … {digest}" for text, digest in (self.flex, self.strict))
        self.below = {}


class _PageReader(HTMLParser):
    """Stack of open elements: an end tag closes up to the nearest open tag of its name."""

    def __init__(self):
        super().__init__(convert_charrefs=False)

    def read(self, html: str) -> list[_Node]:
        self.reset()
        self.nodes, self.pieces, self.buffer = [], [], []
        self.stack = [_Node(0, None, "E", "[document]", {})]
        self.open_names: dict[str, int] = {}
        self.special: list[_Node] = []
        self.shown: list[_Node] = []
        self.next_idx = self.chars = 0
        self.next_seq = 1
        self._walk(html)
        self._flush()
        while len(self.stack) > 1:
            self._pop()
        self.stack[0].end = len(self.nodes)
        self._fill_texts()
        return self.nodes

    def _walk(self, html: str) -> None:
        """Hand the page's tokens to the handlers, in one pass.

        Like the standard parser's loop, which is run twice over a page: a construct without an end stops the first
        run, and in the second (``last_run``) it is text; a half reference stops either, and what is left then is text.
        What has no end after one place has none after a later one, so no search is made twice.
        """
        self.rawdata = html
        at, size, last_run = 0, len(html), False
        last_close, unended = html.rfind(">"), set()
        while at < size:
            if self.cdata_elem is None:
                at = self._plain_tags(html, at)
            found = self.interesting.search(html, at)
            if found is None and self.cdata_elem is not None:
                stopped = at
            else:
                start = found.start() if found else size
                if start > at:
                    self.handle_data(html[at:start])
                at, stopped = start, None
                if at == size:
                    break
                if html[at] == "<":
                    at, stopped = self._markup(html, at, last_run, last_close, unended)
                else:
                    at, stopped = self._reference(html, at, last_run)
            if stopped is not None:
                if last_run:
                    if stopped < size and self.cdata_elem is None:
                        self.handle_data(html[stopped:])
                    return
                at, last_run = stopped, True

    def _plain_tags(self, html: str, at: int) -> int:
        nodes, stack, open_names = self.nodes, self.stack, self.open_names
        for found in _PLAIN.finditer(html, at):
            text, closed, opened, attributes, void, other = found.groups()
            if other:
                return found.start()
            if text:
                if self.buffer:
                    self.buffer.append(text)
                else:
                    self._string_node(text)
            if closed:
                if stack[-1].tag == closed and not self.buffer:
                    self._pop()
                else:
                    self.handle_endtag(closed)
            elif void or opened in _NOT_PLAIN or self.buffer:
                attributes = _PLAIN_ATTRIBUTE.findall(attributes)
                if void:
                    self.handle_startendtag(opened, attributes)
                    continue
                self.handle_starttag(opened, attributes)
                if opened in _RAW_TAGS:
                    self.set_cdata_mode(opened)
                    return found.end()
            else:  # what handle_starttag does
                if attributes:
                    attributes = dict(_PLAIN_ATTRIBUTE.findall(attributes))
                    if "class" in attributes:
                        attributes["class"] = " ".join(attributes["class"].split())
                node = _Node(len(nodes) + 1, stack[-1], "E", opened, attributes or {})
                nodes.append(node)
                node.idx = self.next_idx
                self.next_idx += 1
                node.length = self.chars
                stack.append(node)
                open_names[opened] = open_names.get(opened, 0) + 1
        return len(html)

    def _markup(self, html: str, at: int, last_run: bool, last_close: int, unended: set[str]) -> tuple[int, int | None]:
        """Next place after what starts with ``<``, and where the run stops, if it does."""
        letter = html[at + 1:at + 2]
        if letter.isascii() and letter.isalpha():
            kind, parse = "tag", self.parse_starttag
        elif letter == "/":
            kind, parse = "end", self.parse_endtag
        elif letter == "?":
            kind, parse = "pi", self.parse_pi
        elif letter == "!":
            kind = "comment" if html.startswith("<!--", at) else html[at:at + 9].lower() if html.startswith("<![", at) else "declaration"
            parse = self.parse_html_declaration
        elif letter:
            self.handle_data("<")
            return at + 1, None
        else:
            return at, at
        after = -1
        if at < last_close and kind not in unended:
            after = parse(at)
            if after < 0 and kind not in ("tag", "end"):
                unended.add(kind)
        if after >= 0:
            return after, None
        if not last_run:
            return at, at
        after = html.find(">", at + 1) + 1 if at < last_close else html.find("<", at + 1)
        after = at + 1 if after < 0 else after
        self.handle_data(html[at:after])
        return after, None

    def _reference(self, html: str, at: int, last_run: bool) -> tuple[int, int | None]:
        found = _REFERENCE.match(html, at)
        if found:
            self.handle_entityref(found[1])
            return found.end(), None
        numeric = html.startswith("&#", at)
        found = (_CHARACTER if numeric else _ENTITY).match(html, at)
        if found:
            (self.handle_charref if numeric else self.handle_entityref)(found[1])
            return found.end() + html.startswith(";", found.end()), None
        if numeric:
            if html.find(";", at) >= 0:
                self.handle_data("&#")
                at += 2
            return at, at
        letter = html[at + 1:at + 2]
        if letter.isascii() and letter.isalpha():
            # Nothing follows the name, so the page ends in it.
            return at, at + 1 if last_run and len(html) - at == 2 else at
        if not letter:
            return at, at
        self.handle_data("&")
        return at + 1, None

    def _flush(self, kind=None):
        if self.buffer:
            text, self.buffer = "".join(self.buffer), []
            self._string_node(text, kind)

    def _string_node(self, text, kind=None):
        bare = text.strip()
        if not bare and not text.strip("\t\n\x0c\r ") and not any(map(self.open_names.get, PREFORMATTED)):
            text = "\n" if "\n" in text else " "
        if kind is None:
            kind = STRING_KINDS[self.special[-1].tag] if self.special else "T"
        nodes, parent = self.nodes, self.stack[-1]
        node = _Node(len(nodes) + 1, parent, kind, None, None, text)
        nodes.append(node)
        if kind == "T":
            node.own_no, parent.strings = parent.strings, parent.strings + 1
            node.in_option = bool(self.open_names.get("option"))
        if bare:
            node.idx, node.seq = self.next_idx, self.next_seq
            self.next_idx, self.next_seq = self.next_idx + 1, self.next_seq + 1
            if kind == "T":
                self.pieces.append(bare)
                node.length = len(bare)
                self.chars += len(bare)

    def _pop(self):
        node = self.stack.pop()
        tag = node.tag
        node.end = len(self.nodes)
        node.text_at, node.length = node.length, self.chars - node.length
        self.open_names[tag] -= 1
        if self.special and self.special[-1] is node:
            self.special.pop()
        if tag in TEXT_TAGS or (
                tag == "span" and any(c in node.attrs.get("class", "").lower() for c in TEXT_CLASSES)):
            self.shown.append(node)

    def _fill_texts(self):
        """The texts of elements that show theirs, as stretches of the page's text."""
        if not self.shown:
            return
        text, starts, ends = "".join(self.pieces), None, None
        for node in self.shown:
            a, b = node.text_at, node.text_at + node.length
            if node.length <= TEXT_LIMIT:
                node.text = text[a:b]
                continue
            if starts is None:
                spans = [found.span() for found in _WORD.finditer(text)]
                starts, ends = [s for s, _ in spans], [e for _, e in spans]
            word = bisect_left(ends, a + TEXT_LIMIT)
            cut = a + TEXT_LIMIT if word == len(ends) or starts[word] >= a + TEXT_LIMIT else min(ends[word], a + TEXT_LIMIT + WORD_LIMIT)
            cut = min(cut, b)
            word = bisect_left(starts, cut)
            more = [text[s:min(e, b, s + WORD_LIMIT)] for s, e in zip(starts[word:word + MORE_WORDS], ends[word:word + MORE_WORDS]) if s < b]
            node.text = " ".join([text[a:cut], *more])

    def handle_starttag(self, tag, attrs):
        if self.buffer:
            self._flush()
        values = {k: v or "" for k, v in attrs} if attrs else {}
        if "class" in values:
            values["class"] = " ".join(values["class"].split())
        nodes = self.nodes
        node = _Node(len(nodes) + 1, self.stack[-1], "E", tag, values)
        nodes.append(node)
        node.idx, self.next_idx = self.next_idx, self.next_idx + 1
        node.length = self.chars
        self.stack.append(node)
        if tag in STRING_KINDS:
            self.special.append(node)
        self.open_names[tag] = self.open_names.get(tag, 0) + 1
        if tag in VOID_TAGS:
            self._pop()

    def handle_endtag(self, tag):
        if self.buffer:
            self._flush()
        if self.open_names.get(tag):
            while self.stack[-1].tag != tag:
                self._pop()
            self._pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._pop()

    def updatepos(self, i, j):
        return j  # no line numbers needed

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_entityref(self, name):
        self.buffer.append(html5.get(name + ";") or "&" + name)

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[0] in "xX" else int(name)
            text = bytes([code]).decode("windows-1252") if code < 256 else chr(code)
        except UnicodeDecodeError:
            text = chr(code)
        except (ValueError, OverflowError):  # also a number of thousands of digits
            text = "�"
        # Half of a surrogate pair is no character, as in the HTML standard.
        self.buffer.append("�" if "\ud800" <= text <= "\udfff" else text)

    def _string(self, kind, data):
        self._flush()
        self.buffer.append(data)
        self._flush(kind)

    def handle_comment(self, data):
        self._string("C", data)

    def handle_decl(self, data):
        is_doctype = data[:7].lower() == "doctype"
        self._string("D" if is_doctype else "N", data[8:] if is_doctype else data)

    def unknown_decl(self, data):
        is_cdata = data.upper().startswith("CDATA[")
        self._string("T" if is_cdata else "M", data[6:] if is_cdata else data)

    def handle_pi(self, data):
        self._string("P", data)


#: A number or a name, and that something follows which is no part of it.
_CHARACTER = re.compile(r"&#([0-9]++|[xX][0-9a-fA-F]++)(?=[^0-9a-fA-F])")
_ENTITY = re.compile(r"&([a-zA-Z][-.a-zA-Z0-9]*)(?=[^a-zA-Z0-9])")

#: Bytes 80 to 9F as a browser reads them: windows-1252, and control characters where that has none.
_HIGH = {c: bytes([c]).decode("windows-1252", "ignore") or chr(c) for c in range(0x80, 0xA0)}
_MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
_COMMENT = re.compile(rb"<!--.*?(?:-->|\Z)", re.S)
_DECLARED = re.compile(rb"""(?i)<meta\b[^>]*?\bcharset\s*=\s*["']?\s*([a-z0-9_:.-]+)|<\?xml\b[^>]*?\bencoding\s*=\s*["']([a-z0-9_:.-]+)""")
#: How far into a page a declared character set is looked for, as browsers do.
_DECLARED_WITHIN = 1024
#: Text codecs that no page may ask for.
_NO_CHARSETS = ("idna", "punycode", "unicode", "raw", "undefined", "utf-7", "mbcs", "oem")


def _charset(label: str | None) -> str | None:
    """The codec of a label; null for unknown ones.  ASCII and Latin-1 mean windows-1252."""
    try:
        found = codecs.lookup((label or "").strip())
    except (LookupError, ValueError):
        return None
    if not found._is_text_encoding or found.name.startswith(_NO_CHARSETS):
        return None
    return "windows-1252" if found.name in ("ascii", "iso8859-1", "cp1252") else found.name


def decode_page(data: bytes, sent: str | None = None) -> str:
    """Text of a page's bytes: by byte order mark, else the charset ``sent`` with it, else the one it declares, else UTF-8 if it is
    that, else windows-1252.  Bytes that do not fit become U+FFFD."""
    for mark, name in _MARKS:
        if data.startswith(mark):
            return data[len(mark):].decode(name, "replace")
    name = _charset(sent)
    if name is None:
        declared = _DECLARED.search(_COMMENT.sub(b"", data[:_DECLARED_WITHIN]))
        name = _charset((declared[1] or declared[2]).decode("ascii")) if declared else None
        if name and name.startswith(("utf-16", "utf-32")):  # what could be read so far was not written in that
            name = "utf-8"
    if name is None:
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            name = "windows-1252"
    if name == "windows-1252":
        return data.decode("latin-1").translate(_HIGH)
    return data.decode(name, "replace")


def _strict_name(node: _Node) -> str:
    if not node.attrs:
        return node.tag
    ident, classes = node.attrs.get("id"), node.attrs.get("class")
    return (node.tag + (f"#{ident}" if ident else "")
            + ("." + classes.replace(" ", ".") if classes else ""))


def _longer(path: tuple[str, str | None] | None, name: str) -> tuple[str, str | None]:
    """A path and one name more: its text, or the beginning of that and a digest."""
    text, digest = path or ("", None)
    if digest is None:
        whole = f"{text} > {name}" if path else name
        if len(whole) <= PATH_LIMIT:
            return whole, None
        text, digest = whole[:PATH_SHOWN], text
    return text, blake2b(f"{digest} > {name}".encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _paths(node: _Node) -> tuple[str, str]:
    """Paths by tag names and by tag, id and classes, from the root to the parent of a node."""
    above = node.up
    if above.path is not None:
        return above.path.shown
    chain = []
    while above is not None and above.path is None:
        chain.append(above)
        above = above.up
    for n in reversed(chain):
        name, up = _strict_name(n), n.up and n.up.path
        if up is None:
            n.path = _Path(None, n.tag, name)
            continue
        # Elements of a list have the same name, and so one path.
        n.path = up.below.get((n.tag, name))
        if n.path is None:
            n.path = up.below[n.tag, name] = _Path(up, n.tag, name)
    return node.up.path.shown


_NO_PATHS = (None, None)
_FIELDS = attrgetter("pos", "end", "up", "depth", "idx", "seq", "own_no", "kind", "tag", "attrs", "text", "length")


def _to_batch(rows: list[tuple[int, _Node]], pages: pa.Array, mark: bool = False) -> pa.RecordBatch:
    numbers, nodes = zip(*rows)
    pos, end, ups, depth, idx, seq, own_no, kind, tag, attrs, text, length = zip(*map(_FIELDS, nodes))
    paths = [_paths(n) if n.tag == "a" and "href" in n.attrs else _NO_PATHS for n in nodes]
    offsets, keys, values = [0], [], []
    for of_node in attrs:
        if of_node:
            keys.extend(of_node)
            values.extend(of_node.values())
        offsets.append(len(keys))

    def ints(found):
        return pa.array(found, pa.int32())

    def texts(found):
        return pa.array(found, pa.string())

    # Only strings have an owner; most batches of a listing hold few.
    at = [i for i, k in enumerate(kind) if k not in "ER"]
    owners = [ups[i] for i in at]
    place = [None] * len(nodes)
    for number, i in enumerate(at):
        place[i] = number
    owner = pa.StructArray.from_arrays(
        [texts([o.tag for o in owners]),
         *[texts([(o.attrs.get(name) or "")[:OWNER_LIMIT] if name in o.attrs else None for o in owners]) for name in ("class", "style", "type")],
         ints([o.end for o in owners])],
        names=["tag", "class", "style", "type", "end_pos"]).take(ints(place))
    columns = {
        "page_id": pages.take(ints(numbers)),
        "pos": ints(pos), "end_pos": ints(end), "parent": ints([up and up.pos for up in ups]), "depth": ints(depth),
        "node_idx": ints(idx), "seq": ints(seq), "own_no": ints(own_no), "kind": texts(kind), "tag": texts(tag),
        "attrs": pa.MapArray.from_arrays(ints(offsets), texts(keys), texts(values)),
        "text": texts(text), "text_len": ints(length), "owner": owner,
        "anc_flex": texts([flex for flex, _ in paths]), "anc_strict": texts([strict for _, strict in paths]),
    }
    if mark:
        columns["asked"] = ints([n.asked for n in nodes])
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def link_rows(node: _Node) -> bool:
    """Row filter for link discovery: links, and elements that may hide one."""
    if node.kind != "E":
        return node.kind == "R"
    attrs = node.attrs
    return bool(attrs) and ((node.tag == "a" and "href" in attrs) or "style" in attrs and "none" in attrs["style"]
                            or "class" in attrs and "hidden" in attrs["class"].lower())


# Elements that are asked for wherever they stand, those whose first own string may name a control, and the words one then holds.
OPTION_TAGS = frozenset("button select option".split())
SPEAKING_TAGS = frozenset("a button div li span".split())
SPOKEN = ("More", "Next")
_SPOKEN, _MORE = re.compile("|".join(SPOKEN)), re.compile("more|More")
# Elements around and in the links of a pager, and classes that mark a step to the next page, by tag.
PAGER_TAGS = frozenset("a i li span".split())
PAGER_CLASSES = {"span": ("glyphicon-menu-right", "arrow-right", "next-arrow", "sr-only"), "i": ("fa-chevron-right", "fa-arrow-right")}


def _names_more(node: _Node) -> bool:
    attrs = node.attrs
    return "class" in attrs and _MORE.search(attrs["class"]) is not None or "id" in attrs and _MORE.search(attrs["id"]) is not None


def _names_next(node: _Node) -> bool:
    """Could the element be one that a rule for the next page names?"""
    attrs = node.attrs
    if node.tag == "a":
        return "page=" in attrs.get("href", "")
    css = attrs.get("class", "")
    if node.tag == "li":
        css = css.lower()
        return "page" in css and "next" in css
    return any(c in css for c in PAGER_CLASSES.get(node.tag, ())) or node.tag == "span" and attrs.get("aria-label") == "Next"


#: What a row of a listing is kept for, see ``listing_rows``.
LINK, CONTROL, PAGER = range(3)


def listing_rows(nodes: list[_Node]) -> list[_Node]:
    """What listings are asked for, of the nodes of one page: links, what hides them, paging controls with two elements around icons,
    and options with all their text.  Elements of a pager are kept on pages only that have something like a step to the next page;
    on the others, what is a link or hides one and nothing else is marked ``LINK``, the rest ``CONTROL``, for no question about controls needs
    the former and none about the next page either.  All rows of a page with a pager are marked ``PAGER``."""
    kept, pager = [], False
    for n in nodes:
        if n.kind == "E":
            attrs = n.attrs
            if n.tag in OPTION_TAGS or attrs and ("aria-label" in attrs or _names_more(n)):
                n.asked = CONTROL
                kept.append(n)
            elif attrs and link_rows(n):
                n.asked = LINK
                kept.append(n)
            pager = pager or bool(attrs) and _names_next(n)
        elif n.kind == "R" or n.kind == "T" and (n.in_option or n.own_no == 0 and n.up.tag in SPEAKING_TAGS and _SPOKEN.search(n.text) is not None):
            n.asked = CONTROL
            kept.append(n)
    if not pager:
        return kept
    kept = {n.pos for n in kept}
    for n in nodes:
        n.asked = PAGER
        if n.kind == "E":
            css = n.attrs.get("class", "")
            if n.tag in PAGER_TAGS or "next" in css or "right" in css:
                kept.add(n.pos)
                if n.tag in ("span", "i"):
                    kept.update(up.pos for up in (n.up, n.up.up) if up is not None)
    return [n for n in nodes if n.pos in kept]


def flatten_dom(pages: DataFrame, keep: Callable[[_Node], bool] | None = None,
                keep_of_page: Callable[[list[_Node]], list[_Node]] | None = None, mark: bool = False) -> DataFrame:
    """``pages(page_id, html[, charset])`` to ``dom_nodes``.

    ``html`` is text or bytes.  Bytes are read in the character set :func:`decode_page` finds, ``charset`` being the one sent
    with the page; a text's bytes are UTF-8.  What does not fit becomes U+FFFD.
    ``keep`` is a row filter pushed into the stage: rows it rejects are never built, while
    positions stay those of the whole page; ``keep_of_page`` is one that sees all nodes of a page at once, and with ``mark`` the column ``asked`` says what each
    is kept for.  A page that cannot be read, from its first byte on, gives one row of kind
    ``R`` with the reason in ``text``.
    """
    binary = pages.schema["html"].dataType.simpleString() == "binary"
    sent = F.col("charset").cast("string").cast("binary") if binary and "charset" in pages.columns else F.lit(None).cast("binary")

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Nodes know their parents only, so they go when the last row of their page has: looking for cycles among them finds none.
        usual = gc.get_threshold()
        gc.set_threshold(_GC_AFTER, *usual[1:])
        try:
            reader = _PageReader()
            for batch in batches:
                rows, chars = [], 0
                ids, htmls, charsets = batch.columns
                for number in range(batch.num_rows):
                    try:
                        html = htmls[number].as_py()
                        if html is None:
                            raise ValueError("page has no html")
                        if binary:
                            html = decode_page(html, (charsets[number].as_py() or b"").decode("ascii", "ignore"))
                        else:
                            html = html.decode("utf-8", "replace")
                        nodes = reader.read(html)
                        if keep is not None:
                            nodes = [n for n in nodes if keep(n)]
                        if keep_of_page is not None:
                            nodes = keep_of_page(nodes)
                        for n in nodes:
                            n.size = _emitted(n)
                    except Exception as problem:  # noqa: BLE001 - a page never ends the job
                        nodes, reader = [_failed(problem)], _PageReader()
                    for n in nodes:
                        rows.append((number, n))
                        chars += n.size
                    if len(rows) >= _BATCH_ROWS or chars >= _BATCH_CHARS:
                        yield from _in_batches(rows, ids, mark)
                        rows, chars = [], 0
                yield from _in_batches(rows, ids, mark)
        finally:
            gc.set_threshold(*usual)

    key = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("html").cast("binary"), sent).mapInArrow(stage, DOM_SCHEMA.format(key=key) + (", asked int" if mark else ""))


def _failed(problem: Exception) -> _Node:
    node = _Node(0, None, "R", text=str(problem) or type(problem).__name__)
    node.size = len(node.text)
    return node


def _emitted(node: _Node) -> int:
    """Characters a row brings along: its text, attributes, and for links two paths."""
    size = len(node.text) if node.text else 0
    if node.attrs:
        size += sum(map(len, node.attrs.values()))
    return size + 2 * min(20 * node.depth, PATH_LIMIT) if node.tag == "a" else size


def _in_batches(rows: list[tuple[int, _Node]], pages: pa.Array, mark: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches bounded by rows and by emitted characters.

    Rows that cannot be turned into a batch are tried page by page, so that only the page
    at fault becomes an error row.
    """
    start, size = 0, 0
    for end, (_, node) in enumerate(rows, 1):
        size += node.size
        if end - start >= _BATCH_ROWS or size >= _BATCH_CHARS or end == len(rows):
            part, start, size = rows[start:end], end, 0
            try:
                yield _to_batch(part, pages, mark)
            except Exception:  # noqa: BLE001
                for page in dict.fromkeys(p for p, _ in part):
                    try:
                        yield _to_batch([r for r in part if r[0] == page], pages, mark)
                    except Exception as problem:  # noqa: BLE001
                        yield _to_batch([(page, _failed(problem))], pages, mark)
