"""HTML as tag sequences: attributes, anchors, dropdowns, structure fingerprint.

A page is one row, so everything here is work on that row: no shuffle. Anchors and structure are read in Arrow batches,
each page once from front to back: time and memory follow the page's length, however many links or levels it has.
Depth is the depth of the tag sequence, not of a repaired document tree.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from holdsift import rules as R

_NOISE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Entities decoded in attribute values and text, ampersand last
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
#: Signs of the longest entity, less one: so many at the end of a piece may belong to a cut one.
_CUT = 5

_STRING = pa.string()
_PAIRS = pa.list_(pa.struct([("k", _STRING), ("v", _STRING)]))
_LINKS = pa.list_(pa.struct([
    ("link_idx", pa.int32()), ("href", _STRING), ("download", pa.bool_()), ("link_text", _STRING), ("parent_text", _STRING),
    ("grandparent_text", _STRING), ("title", _STRING), ("aria_label", _STRING), ("data_attrs", _PAIRS)]))
_LINKS_SQL = (
    "array<struct<link_idx:int,href:string,download:boolean,link_text:string,parent_text:string,grandparent_text:string,"
    "title:string,aria_label:string,data_attrs:array<struct<k:string,v:string>>>>"
)

# Blanks in tags are ASCII ones, word borders and trimmed blanks are those of all scripts.
_FLAGS = re.I | re.S | re.A
_BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANKS = re.compile(f"(?:[{_BLANK}]|&nbsp;){{64,}}")
_NOISE_START = re.compile(r"<!--|<(?:script|style)(?u:\b)", _FLAGS)
_NOISE_END = {"<!--": re.compile("-->"), "<script": re.compile(r"</script\s*>", _FLAGS), "<style": re.compile(r"</style\s*>", _FLAGS)}
_TOKEN = re.compile(r"<[^>]*>|[^<]+")
_TAG = re.compile(r"</?[A-Za-z][^>]*>")
_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9\-]*)")
_BODY = re.compile(r"<body(?u:\b)", _FLAGS)
_BODY_END = re.compile(r"</body\s*>", _FLAGS)
_DOWNLOAD = re.compile(r"\sdownload(?u:\b)", _FLAGS)
_DATA = re.compile(r"""\s(data-[^\s=/>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+))?)""", _FLAGS)
_DATA_NAME = re.compile(r"[^\s=]+", _FLAGS)
_DATA_VALUE = re.compile(r"=\s*(.*)\Z", _FLAGS)
_ATTRIBUTES = {
    name: re.compile(rf"""\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", _FLAGS)
    for name in ("href", "title", "aria-label", "class", "id")
}


def strip_noise(html: Column) -> Column:
    return F.regexp_replace(html, _NOISE, "")


def decode_entities(text: Column) -> Column:
    out = text
    for name, sign in _ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(sign))
    return F.when(text.contains("&"), out).otherwise(text)


def attribute(tag: Column, name: str) -> Column:
    """Attribute value of a start tag, '' when absent."""
    pat = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    raw = F.concat(*[F.regexp_extract(tag, pat, g) for g in (1, 2, 3)])
    return F.when(tag.rlike(rf"(?i)\s{name}\s*="), decode_entities(raw)).otherwise(F.lit(""))


def blank_trim(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _clean(html: str) -> str:
    """Without comments, scripts and styles that end; one without an end stays as it is."""
    out, kept, at, endless = [], 0, 0, set()
    while start := _NOISE_START.search(html, at):
        kind = start[0].lower()
        end = None if kind in endless else _NOISE_END[kind].search(html, start.end())
        if end is None:
            endless.add(kind)
            at = start.end()
        else:
            out.append(html[kept: start.start()])
            kept = at = end.end()
    return "".join([*out, html[kept:]]) if out else html


def _decoded(text: str) -> str:
    if "&" in text:
        for name, sign in _ENTITIES:
            text = text.replace(name, sign)
    return text


def _value(tag: str, name: str) -> str:
    found = _ATTRIBUTES[name].search(tag)
    return _decoded(found[1] or found[2] or found[3] or "") if found else ""


def _data(tag: str) -> list[dict]:
    pairs = []
    for part in _DATA.findall(tag):
        value = _DATA_VALUE.search(part)
        text = value[1] if value else ""
        text = text[1:] if text[:1] in ("'", '"') else text
        text = text[:-1] if text[-1:] in ("'", '"') else text
        pairs.append({"k": _DATA_NAME.match(part)[0].lower(), "v": _decoded(text)})
    return pairs


def _pieces(html: str) -> list[str]:
    """Tags and the texts between them. Behind the last ``>`` no tag can end, so none is looked for there."""
    stop = html.find("<", html.rfind(">") + 1)
    return _TOKEN.findall(html) if stop < 0 else _TOKEN.findall(html[:stop]) + [x for x in html[stop:].split("<") if x]


def _clipped(text: str, lo: int, hi: int, chars: int, blanks: list[tuple[int, int]]) -> str:
    """First ``chars`` signs of the trimmed, decoded text from ``lo`` to ``hi``; looks no further than it must.

    ``blanks``: start and end of the long blank runs of ``text``; one that it starts in is left out at once.
    """
    run = bisect.bisect_right(blanks, (lo, len(text))) - 1
    if run >= 0 and lo < blanks[run][1] and (text[lo] in _BLANK or text.startswith("&nbsp;", lo)):
        if blanks[run][1] > hi:  # blank, but for an entity that its end cuts
            cut = text.rfind("&", max(lo, hi - _CUT), hi)
            return text[cut:hi] if cut >= 0 else ""
        lo = blanks[run][1]
    wide = 2 * chars
    while True:
        end = min(lo + wide, hi)
        if end < hi and (amp := text.rfind("&", max(lo, end - _CUT), end)) >= 0:
            end = amp
        got = _decoded(text[lo:end]).strip(_BLANK)
        if len(got) >= chars or lo + wide >= hi:
            return got[:chars]
        wide *= 4


def _read_links(html: str) -> list[dict]:
    """Links in page order, from two walks over the tags: forwards for what is open, backwards for where it ends.

    An element ends at the first closing tag of its level behind it. Only positions of links and of the elements around
    them are kept, as offsets into the page's joined text.
    """
    texts, size = [], 0
    events: list[tuple[int, int, int]] = []  # (opens or closes, level, text offset)
    links: list[tuple[str, list[int]]] = []  # (tag, events of the link, its parent and its grandparent; -1: none)
    depth, opened = 0, {}
    for piece in _pieces(html):
        if piece[0] != "<":
            texts.append(piece)
            size += len(piece)
            continue
        found = _NAME.match(piece)
        if not found or (name := found[1].lower()) in R.VOID_TAGS:
            continue
        if piece[1] == "/":
            depth -= 1
            events.append((-1, depth, size))
            continue
        if name == "a" and _value(piece, "href"):
            links.append((piece, [len(events), opened.get(depth - 1, -1), opened.get(depth - 2, -1)]))
        opened[depth] = len(events)
        events.append((1, depth, size))
        depth += 1
    around = {at for _, places in links for at in places}
    ends, closing = {-1: (0, 0)}, {}
    for at in range(len(events) - 1, -1, -1):
        kind, level, offset = events[at]
        if kind < 0:
            closing[level] = offset
        elif at in around:
            ends[at] = (offset, closing.get(level, size))
    text = "".join(texts)
    blanks = [run.span() for run in _BLANKS.finditer(text)]
    clips = (R.LINK_TEXT_CHARS, R.CONTEXT_TEXT_CHARS, R.CONTEXT_TEXT_CHARS)
    clipped: dict[tuple[int, int], str] = {}
    out = []
    for i, (tag, places) in enumerate(links):
        for at, chars in zip(places, clips):
            if (at, chars) not in clipped:
                clipped[at, chars] = _clipped(text, *ends[at], chars, blanks)
        link, parent, grandparent = (clipped[key] for key in zip(places, clips))
        out.append({
            "link_idx": i, "href": _value(tag, "href"), "download": bool(_DOWNLOAD.search(tag)), "link_text": link,
            "parent_text": parent, "grandparent_text": grandparent, "title": _value(tag, "title"),
            "aria_label": _value(tag, "aria-label"), "data_attrs": _data(tag)})
    return out


def _read_structure(html: str, max_depth: int) -> str:
    start = _BODY.search(html)
    end = start and _BODY_END.search(html, start.end())
    body = html[start.start(): end.start() if end else len(html)] if start else ""
    out, depth = [], 0
    for tag in _TAG.findall(body[: body.rfind(">") + 1]):
        name = _NAME.match(tag)[1].lower()
        close = tag[1] == "/"
        if not close and depth <= max_depth:
            out.append(f"{name}.{_value(tag, 'class').strip(' ')[:50]}#{_value(tag, 'id')}")
        elif not close and depth == max_depth + 1:
            out.append("")
        depth += 0 if name in R.VOID_TAGS else -1 if close else 1
    return ">".join(out)


def anchors(html: Column) -> Column:
    """Ordered array of links with the text around them.

    The parent is the innermost element open around the link, the grandparent the next one out.
    """

    @F.arrow_udf(_LINKS_SQL)
    def read(pages: pa.Array) -> pa.Array:
        return pa.array([None if (h := x.as_py()) is None else _read_links(_clean(h)) for x in pages], _LINKS)

    return read(html)


def structure_sequence(html: Column, max_depth: int = R.STRUCTURE_DEPTH) -> Column:
    """Body start tags in order as ``tag.class#id`` joined by ``>``.

    The level right below ``max_depth`` leaves empty entries, deeper levels nothing.
    """

    @F.arrow_udf("string")
    def read(pages: pa.Array) -> pa.Array:
        return pa.array([None if (h := x.as_py()) is None else _read_structure(_clean(h), max_depth) for x in pages], _STRING)

    return read(html)


def structure_hash(html: Column, max_depth: int = R.STRUCTURE_DEPTH) -> Column:
    return F.substring(F.sha2(structure_sequence(html, max_depth), 256), 1, 16)


def page_parts(html: Column, max_depth: int = R.STRUCTURE_DEPTH) -> Column:
    """``structure_hash`` and ``links`` (as of ``anchors``) of a page, read in one go."""

    @F.arrow_udf(f"struct<structure_hash:string,links:{_LINKS_SQL}>")
    def read(pages: pa.Array) -> pa.Array:
        out = []
        for x in pages:
            if (html := x.as_py()) is not None:
                html = _clean(html)
                digest = hashlib.sha256(_read_structure(html, max_depth).encode("utf-8")).hexdigest()[:16]
                out.append({"structure_hash": digest, "links": _read_links(html)})
            else:
                out.append({"structure_hash": None, "links": None})
        return pa.array(out, pa.struct([("structure_hash", _STRING), ("links", _LINKS)]))

    return read(html)


def dropdowns(html: Column) -> Column:
    """Ordered array of (k, v): select name, else id, else ``select_i``; selected option, else the first."""
    blocks = F.regexp_extract_all(strip_noise(html), F.lit(r"(?is)<select\b.*?</select\s*>"), F.lit(0))

    def one(b, i):
        head = F.regexp_extract(b, r"(?is)^(<select\b[^>]*>)", 1)
        options = F.regexp_extract_all(b, F.lit(r"(?is)<option\b[^>]*>[^<]*"), F.lit(0))
        chosen = F.try_element_at(F.filter(options, lambda o: o.rlike(r"(?is)^<option\b[^>]*\sselected\b")), F.lit(-1))
        text = F.coalesce(chosen, F.get(options, F.lit(0)), F.lit(""))
        name, id_ = attribute(head, "name"), attribute(head, "id")
        return F.struct(
            F.when(name != "", name).when(id_ != "", id_).otherwise(
                F.concat(F.lit("select_"), i.cast("string"))
            ).alias("k"),
            blank_trim(decode_entities(F.regexp_replace(text, r"(?s)^<[^>]*>", ""))).alias("v"),
        )

    return F.transform(blocks, one)
