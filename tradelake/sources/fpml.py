"""FpML files: every ``trade`` element of well-formed files, found without reading a file as a whole.

Text is cut before ``<``, where a file is in plain text, a comment, a CDATA section or a processing
instruction, and nowhere else.  The summary of a chunk says, for each of the four, what it is in at the
end, which elements it closes that it did not open and opens that it does not close, and how the number
of open ``trade`` elements moves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree.ElementTree import Element, TreeBuilder
from xml.parsers import expat

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.arrays import non_null
from tradelake.schemas import FPML_DEFAULTS, FPML_HREF, FPML_PATHS, FPML_TRADE, MONEY
from tradelake.session import stage
from tradelake.sources import chunks as ch

TEXT, COMMENT, CDATA, INSTRUCTION = "TCDP"
STATES = TEXT + COMMENT + CDATA + INSTRUCTION
CLOSERS = {COMMENT: b"-->", CDATA: b"]]>", INSTRUCTION: b"?>"}
OPENERS = {b"!--": COMMENT, b"![CDATA[": CDATA, b"?": INSTRUCTION}
_NAME = rb"(?:[A-Za-z_]|[^\x00-\x7F])(?:[-.:\w]|[^\x00-\x7F])*"
_VALUE = rb"""(?:"[^"<]*"|'[^'<]*')"""
MARKUP = re.compile(rb"<(?:(!--|!\[CDATA\[|\?)|(!DOCTYPE[^\[<>]*>)|(/?)(%s)((?:\s+%s\s*=\s*%s)*)\s*(/?)>)?" % (_NAME, _NAME, _VALUE))
TRADE_START = re.compile(rb"<(?:%s:)?%s(?![-.:\w]|[^\x00-\x7F])" % (_NAME, FPML_TRADE.encode()))
COLON_FIRST = [before + b":" for before in (b"<", b"</", b" ", b"\t", b"\r", b"\n")]
ENCODING = re.compile(rb"""^\s*<\?xml\s[^>]*?encoding\s*=\s*["']([-.\w]+)["']""")
BOM = b"\xef\xbb\xbf"
DEEP = 1 << 30  # somewhere within the root

SUMMARY = ("struct<encoding: string, ends: array<struct<state: string, closes: array<string>, opens: array<string>, net: int, "
           "dip: int, root: string, broken: boolean>>>")
START = f"state string, level int, depth int, owner {ch.OWNER}, encoding string, rooted boolean, ends boolean, sound boolean"
ROWS = f"{ch.PLACE}, broken boolean, owner {ch.OWNER}, encoding string, data binary, fields array<string>"


def local(name: bytes | str) -> str:
    """A name without its prefix."""
    text = name.decode("utf-8", "replace") if isinstance(name, bytes) else name
    return text.rpartition(":")[2]


def tags(data: bytes, state: str) -> Iterator[tuple[str, bytes, int, int]]:
    """(kind, name, start, end) of the tags of a chunk, kind being ``open``, ``close`` or ``empty``; then one ``end``
    with the state at the end in place of a name, or ``broken`` at markup that is none."""
    at = 0
    while True:
        if state != TEXT:
            closer = CLOSERS[state]
            end = data.find(closer, at)
            if end < 0:
                yield "end", state.encode(), len(data), len(data)
                return
            at, state = end + len(closer), TEXT
        start = data.find(b"<", at)
        if start < 0:
            yield "end", TEXT.encode(), len(data), len(data)
            return
        m = MARKUP.match(data, start)
        at = m.end()
        if m[1]:
            state = OPENERS[m[1]]
        elif m[4]:
            if m[3] and (m[5] or m[6]):
                yield "broken", b"", start, at
                return
            yield "close" if m[3] else "empty" if m[6] else "open", m[4], start, at
        elif not m[2]:
            yield "broken", b"", start, at
            return


def colon_first(data: bytes) -> bool:
    """Whether there may be a name that begins with a colon."""
    return any(found in data for found in COLON_FIRST)


def balanced(data: bytes) -> bool:
    """Whether a stretch of a file is text and whole elements, well-formed as UTF-8.

    Expat is as strict with tags as ``tags`` or stricter, but for names that begin with a colon.  It decides most
    chunks, which end where they began; others are followed tag by tag.
    """
    if colon_first(data):
        return False
    parser = expat.ParserCreate("utf-8")
    try:
        parser.Parse(b"<r>", False)
        parser.Parse(data, False)
        parser.Parse(b"</r>", True)
    except expat.ExpatError:
        return False
    return True


def passed(data: bytes, state: str) -> dict:
    """What a chunk does to a file that is in ``state`` where it begins."""
    closes, opens, net, dip, root, broken, tried = [], [], 0, 0, None, False, False
    for kind, name, begin, _ in tags(data, state):
        if kind == "end":
            state = name.decode()
        elif kind == "broken":
            broken = True
        else:
            root = root or name
            if kind == "open":
                is_trade = local(name) == FPML_TRADE
                if is_trade and not tried:
                    tried = True
                    if balanced(data[begin:]):  # no tag after this one changes what is open
                        state = TEXT
                        break
                opens.append(name)
                net += is_trade
            elif kind == "close":
                if not opens:
                    closes.append(name)
                elif opens.pop() != name:
                    broken = True
                if local(name) == FPML_TRADE:
                    net -= 1
                    dip = min(dip, net)
    text = [n.decode("utf-8", "replace") for n in closes], [n.decode("utf-8", "replace") for n in opens]
    return {"state": state, "closes": text[0], "opens": text[1], "net": net, "dip": dip,
            "root": root and local(root), "broken": broken}


def summary(data: bytes) -> dict:
    found = ENCODING.match(data.removeprefix(BOM))
    named = found[1].decode().lower() if found else "utf-8"
    return {"encoding": None if named == "utf-8" else named, "ends": [passed(data, s) for s in STATES]}


def next_trade(text: bytes, at: int) -> int:
    """The place of the first tag at or after another that looks like the start of a trade, or -1."""
    found = TRADE_START.search(text, at)
    return found.start() if found else -1


def follow(summaries: list[dict]) -> list[dict]:
    """Per chunk of a file: what it starts in, how many elements are open there (``level``) and how many of
    them are trades (``depth``), the chunk in which an open trade began, and whether the file is sound.  A trade that is the
    root of its file is none of its trades."""
    out, state, stack, depth, owner, root, sound = [], TEXT, [], 0, None, None, True
    encoding = summaries[0]["encoding"]
    for i, s in enumerate(summaries):
        end, rooted = s["ends"][STATES.index(state)], root is not None
        if root is None and end["root"] is not None:
            root = end["root"]
            depth -= root == FPML_TRADE
        out.append({"state": state, "level": len(stack), "depth": depth, "owner": owner if depth > 0 else None,
                    "encoding": encoding, "rooted": rooted})
        sound = sound and not end["broken"] and len(end["closes"]) <= len(stack)
        for name in end["closes"] if sound else ():
            sound = sound and stack.pop() == name
        out[-1]["ends"] = not stack
        stack += end["opens"]
        if depth + end["dip"] <= 0 < depth + end["net"]:
            owner = i
        state, depth = end["state"], depth + end["net"]
    sound = sound and not stack and root is not None and state == TEXT
    return [{**o, "sound": sound} for o in out]


def element(data: bytes, encoding: str | None) -> Element | None:
    """The element that a stretch of a file holds, prefixes taken off; null if it is not well-formed."""
    tree, parser = TreeBuilder(), expat.ParserCreate(encoding or "utf-8")
    parser.buffer_text = True
    parser.StartElementHandler = tree.start
    parser.EndElementHandler = tree.end
    parser.CharacterDataHandler = tree.data
    try:
        parser.Parse(data, True)
    except (expat.ExpatError, LookupError, ValueError):
        return None
    whole = tree.close()
    if b":" in data:
        for e in whole.iter():
            if ":" in e.tag:
                e.tag = e.tag.rpartition(":")[2]
    return whole


def _steps(path: str) -> list[tuple]:
    """(anywhere below?, name, attribute, its value) of the steps of a path of ``FPML_PATHS``."""
    found = re.findall(r"(\.//|/|^)(\w+)(?:\[@(\w+)='([^']*)'\])?", path)
    return [(at == ".//", name, key, value) for at, name, key, value in found]


FPML_STEPS = {name: _steps(path) for name, path in FPML_PATHS.items()}


def _found(trade: Element, steps: list[tuple]) -> list[Element]:
    """What ``trade.findall`` finds for a path; for few elements, its own steps cost less than its general ones."""
    out = [trade]
    for below, name, key, value in steps:
        out = [e for o in out for e in (o.iter(name) if below else o.findall(name)) if e is not o]
        if key:
            out = [e for e in out if e.get(key) == value]
    return out


def fields_of(trade: Element) -> list[str]:
    """The texts of a trade's fields; one that is absent has its default, one that is empty an empty text."""
    out = []
    for name, steps in FPML_STEPS.items():
        texts = [e.get("href") if name == FPML_HREF else e.text or "" for e in _found(trade, steps)]
        out.append(next((text for text in texts if text is not None), FPML_DEFAULTS.get(name, "")))
    return out


def trades_in(data: bytes, encoding: str | None) -> list[list[str]] | None:
    """The fields of an element and of the trades within it."""
    whole = element(data, encoding)
    return None if whole is None else [fields_of(t) for t in whole.iter(FPML_TRADE)]


def parse(chunk: dict) -> list[dict]:
    """The trades that begin and end in a chunk, and what it has of others.  Most chunks begin in the text within
    the root and outside a trade; ``follow`` speaks of the others, and says where a root may begin or end."""
    data, usual = chunk["data"], not chunk["unusual"]
    if not usual and not chunk["sound"]:
        return []
    place = {**{k: chunk[k] for k in ch.PLACE_COLUMNS}, "encoding": chunk["encoding"]}
    if usual and not colon_first(data):  # most often whole trades and what lies between them: all in one tree
        found = trades_in(b"<r>%s</r>" % data, None)
        if found is not None:
            return [{**place, "fields": f} for f in found]
    state, level, depth = (TEXT, DEEP, 0) if usual else (chunk["state"], chunk["level"], chunk["depth"])
    rooted, out = usual or chunk["rooted"], []
    own = {"block": chunk["block"], "seq": chunk["seq"]}
    start, owner = (0, chunk["owner"]) if depth > 0 else (None, own)
    at = 0 if state == TEXT else _after(data, CLOSERS[state])
    for kind, name, begin, end in tags(data, state):
        if level == 0 and (_stray(data[at:begin]) or (rooted and kind in ("open", "empty"))):
            return [{**place, "broken": True}]
        at, rooted = end, True
        is_trade = kind != "end" and local(name) == FPML_TRADE
        if kind == "open":
            if is_trade:
                depth += 1
                if depth == 1:
                    start, owner = begin, own
            level += 1
        elif kind == "close":
            level -= 1
            if is_trade:
                depth -= 1
                if depth == 0:
                    out += _rows(place, data[start:end]) if owner is own else [{**place, "owner": owner, "data": data[:end]}]
                    start = None
        elif kind == "empty" and is_trade and depth == 0 and level > 0:
            out += _rows(place, data[begin:end])
    if start is not None:
        out.append({**place, "owner": owner, "data": data[start:]})
    return out


def _after(data: bytes, closer: bytes) -> int:
    at = data.find(closer)
    return len(data) if at < 0 else at + len(closer)


def _stray(text: bytes) -> bool:
    """Whether text outside the root is anything but white space, comments and instructions."""
    return bool(re.sub(rb"(?s)<!--.*?(?:-->|\Z)|<\?.*?(?:\?>|\Z)|<!DOCTYPE[^\[<>]*>", b"", text.removeprefix(BOM)).strip())


def _rows(place: dict, data: bytes) -> list[dict]:
    found = trades_in(data, place["encoding"])
    return [{**place, "broken": True}] if found is None else [{**place, "fields": f} for f in found]


def parse_whole(record: dict) -> list[dict]:
    return _rows({"path": record["path"], "encoding": record["encoding"]}, record["data"])


def read_fpml(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed files): one row per ``trade`` element, prefixed or not, nested ones too.

    A file that is not well-formed is returned as malformed and gives no rows.  An element written as
    ``<trade/>`` has no content and all its defaults.  Tags in comments and CDATA sections are text.
    Files with declarations inside a DOCTYPE count as malformed: their entities are not known here.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    kept = ch.cut(spark, paths, "<", True, next_trade, summary, SUMMARY, "fpml-chunks")
    starts = stage(ch.followed(kept, follow, START), "fpml-starts")
    usual = ((F.col("state") == TEXT) & (F.col("depth") == 0) & (F.col("level") > 0) & ~F.col("ends")
             & F.col("sound") & F.col("encoding").isNull())
    given = ["state", "level", "depth", "owner", "encoding", "rooted", "ends", "sound"]
    found = stage(ch.read(kept, starts.filter(~usual), parse, ROWS, *given), "fpml-trades")
    parts = ch.assembled(found.filter("data is not null"), encoding=F.max("encoding"))
    across = stage(ch.parsed(parts, parse_whole, ROWS), "fpml-across")
    trades = found.filter("data is null").unionByName(across)
    named = spark.createDataFrame([(p,) for p in paths], "path string").select(ch.plain_path(F.col("path")).alias("path")).distinct()
    sound = starts.filter("sound").select("path").distinct().join(trades.filter("broken").select("path").distinct(), "path", "left_anti")
    malformed = stage(named.join(sound, "path", "left_anti"), "malformed")

    texts = {name: F.get("fields", F.lit(i)) for i, name in enumerate(FPML_PATHS)}
    numbers = ("notional", "price")
    rows = trades.filter("fields is not null").join(malformed, "path", "left_anti").select("path", *[
        (text.try_cast(MONEY) if name in numbers else text).alias(name) for name, text in texts.items()])
    broken = non_null([F.when(F.col(c).isNull(), F.lit(c)) for c in numbers])
    return rows.withColumn("error", F.when(
        F.size(broken) > 0, F.concat(F.lit("Bad number: "), F.array_join(broken, ", ")))), malformed

