"""Secret scans by assignment-aware lexing.

Besides three base patterns, source and configuration syntax is lexed, and
(name, literal) pairs are read from it:

* ``name = "x"``, ``name: x``, ``"name": "x"``, ``name => 'x'``, ``name := "x"``,
  ``export NAME=x``, ``a = b = "x"``, ``put("name", "x")``, ``<name>x</name>``;
* names have dots and quoted subscripts (``config["db"].name = "x"``), and a type
  may stand before the value (``name: str = "x"``);
* strings have prefixes, escapes, three quotes over many lines, or are YAML
  blocks; their contents are lexed too (``"Server=a;Password=x"``), and so are
  comments: a secret in a comment is one.

Names that hold a constant pass it on (``k = "abc"`` then ``password = k``, or
``"a" + k``) until their scope, a block by braces or indentation, ends.  A
literal is reported when its target's name and its own look make it likely.
An unquoted word counts as a literal if it has a digit or 16 characters: shorter
ones without digits are mostly words of a sentence.

The lexer goes forward once; no part of a text is read again at each start.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: The base patterns and the least lengths of what they match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # the run after AKIA is taken whole, so shorter ones can't begin another match
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE = 6
#: Order of kinds at one start.
KINDS = ("assign", "access", "hex", "literal")

#: Parts of names, and how much each says that the value is a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "apikey": 1.0, "token": 0.9, "credential": 0.9,
    "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "authorization": 0.8, "auth": 0.6, "bearer": 0.8, "signature": 0.5, "key": 0.5, "salt": 0.5,
}
#: Names with these parts hold settings about secrets, not secrets.
HARMLESS = {"length", "len", "count", "limit", "max", "min", "name", "type", "url", "path", "file", "field", "policy", "expiry", "ttl", "label", "id"}
PLACEHOLDERS = {"changeme", "password", "secret", "example", "placeholder", "none", "null", "true", "false", "undefined", "xxxxxx", "todo", "string"}
THRESHOLD = 1.1
#: Unquoted words without a digit count from so many characters.
PLAIN_WORD = 16

_PREFIX = r"(?:(?<!\w)[bBfFrRuUL@$]{1,2})"
_STRING = (
    _PREFIX + r'''?+(?:"""(?:[^"\\]|\\.|"(?!""))*+"""|"(?:[^"\\\n]|\\.)*+"|`[^`]*+`)'''
    r"""|(?:""" + _PREFIX + r"""|(?<!\w))(?:'{3}(?:[^'\\]|\\.|'(?!''))*+'{3}|'(?:[^'\\\n]|\\.)*+')"""
)
_NAME = r"[^\W\d][\w$]*+(?:-[^\W\d]\w*+)*+"
_LEX = re.compile(
    r"(?P<prose>(?:\w++[ ,]++)+(?=\w))"  # words of a sentence, but its last
    r"|(?P<xml><(?P<tag>[A-Za-z_][\w.\-:]*+)(?:[ \t][^<>\n]*+)?>(?P<body>[^<>\n]++)</(?P=tag)[ ]*+>)"
    r"|(?P<str>" + _STRING + r")"
    r"|(?P<name>" + _NAME + r")"
    r"|(?P<join>\?\.|\.|::|->)"
    r"|(?P<other>[=!<>]=++|=~)"
    r"|(?P<op>:=|=>|[+?]=|=|:)"
    r"|(?P<line>\n[ \t]*+)"
    r"|(?P<space>[^\S\n]++)"
    r"|(?P<sign>\w++|.)",
    re.S,
)
_OPENS = re.compile(r"""(?P<mark>\"{3}|'{3}|["'`])""")
_STR = re.compile(_STRING, re.S)
_SUB = re.compile(r"""\[[ \t]*+(?:"([^"\n]*+)"|'([^'\n]*+)')[ \t]*+\]|\[[^\[\]\n"']*+\]""")
_CHAIN = re.compile(_NAME + r"""(?:(?:\?\.|\.|::|->)""" + _NAME + r"""|\[[ \t]*+(?:"[^"\n]*+"|'[^'\n]*+')[ \t]*+\])*+""")
_LINKS = re.compile(_NAME + r"""|"[^"\n]*+"|'[^'\n]*+'""")
_WORD = re.compile(r"[A-Za-z0-9_./+=\-!@#$%^&*~]++")
_PLUS = re.compile(r"[ \t]*+(?:\+|\.\.|&)(?![=&.])[ \t]*+")
_BLANK = re.compile(r"[ \t]*+")
_BLOCK = re.compile(r"[|>][+\-]?+\d*+[ \t]*+\n(?P<lead>[ \t]++)(?=\S)")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_ESCAPE = re.compile(r"\\(?:x([0-9a-fA-F]{2})|u([0-9a-fA-F]{4})|(.))", re.S)
_PAIRED = re.compile(r"[=:<(]")


def sensitivity(name: str) -> float:
    """0 to 1: how likely a name holds a secret."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts or parts[-1] in HARMLESS:
        return 0.0
    both = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in both), default=0.0)


def randomness(counts: dict[str, float]) -> float:
    """0 to 1: bits per character and kinds of characters of a literal, from how often it has each character."""
    n = sum(counts.values())
    if n < ASSIGN_VALUE:
        return 0.0
    bits = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = len({0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 for c in counts})
    return min(1.0, bits / 4.5) * 0.6 + kinds / 4 * 0.4


class Value:
    """What a name was given: a literal, or several values one after the other, such as constants that were passed on.

    The text is never put together: ``a = a + a`` would double it on each line.
    Only character counts are, and the text while it is short; both when first asked for.
    """

    __slots__ = ("parts", "place", "counts", "short", "told")
    #: Characters up to which the text is kept, as no placeholder has more; and counts from which all are halved many times over.
    SHORT, MANY = max(map(len, PLACEHOLDERS)), 2.0**50

    def __init__(self, parts: list[Value], text: str = "", place: tuple[int, int] | None = None):
        self.parts, self.place, self.short, self.told = parts, place, text, False
        self.counts: dict[str, float] | None = None

    def measure(self) -> Value:
        """Fills counts and short (None for a longer text), parts first."""
        stack = [self]
        while stack:
            v = stack[-1]
            if v.counts is None and (open_parts := [p for p in v.parts if p.counts is None]):
                stack += open_parts
                continue
            stack.pop()
            if v.counts is not None:
                continue
            if not v.parts:
                v.counts = Counter(v.short)
                v.short = v.short if len(v.short) <= self.SHORT else None
                continue
            sums: Counter = Counter()
            for p in v.parts:
                for c, k in p.counts.items():
                    sums[c] += k
            v.counts = sums
            if sum(sums.values()) > self.MANY:
                v.counts = {c: k / self.MANY**0.5 for c, k in sums.items()}
            texts = [p.short for p in v.parts]
            v.short = "".join(texts) if None not in texts else None
            v.short = v.short if v.short is None or len(v.short) <= self.SHORT else None
        return self

    def places(self) -> list[tuple[int, int]]:
        """Where the literals stand; those of values that were told before are left out."""
        out, stack = [], [self]
        while stack:
            v = stack.pop()
            if not v.told:
                v.told = True
                stack += v.parts
                if v.place:
                    out.append(v.place)
        return out


def unescaped(literal: str) -> str:
    """A string's contents with its escapes read."""
    if "\\" not in literal:
        return literal
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else {"n": "\n", "t": "\t", "r": "\r", "\n": ""}.get(m[3], m[3]), literal)


def _inside(text: str, start: int, end: int) -> tuple[int, int]:
    """Where a string's contents stand."""
    mark = _OPENS.search(text, start)
    n = len(mark["mark"])
    return mark.end(), max(mark.end(), end - n)


class _Scopes:
    """Constants by name, in blocks by braces and indentation; a block that ends takes its constants with it."""

    def __init__(self) -> None:
        self.of: dict[str, list[Value]] = {}
        self.blocks: list[tuple[int, int, list[str]]] = [(0, 0, [])]

    def bind(self, name: str, found: Value, depth: int, indent: int) -> None:
        if self.blocks[-1][:2] != (depth, indent):
            self.blocks.append((depth, indent, []))
        self.blocks[-1][2].append(name)
        self.of.setdefault(name, []).append(found)

    def leave(self, depth: int, indent: int) -> None:
        while len(self.blocks) > 1 and (self.blocks[-1][0] > depth or self.blocks[-1][1] > indent):
            for name in self.blocks.pop()[2]:
                self.of[name].pop()

    def get(self, name: str) -> Value | None:
        held = self.of.get(name)
        return held[-1] if held else None


def pairs(text: str, base: int = 0, nested: bool = False):
    """(names, value) for the literals that names are given, with constants passed on.

    A value that was passed on has the places of the literals where they were
    written.  ``base`` is added to places; the contents of strings are lexed
    once more, but not the strings in them.
    """
    scopes, strings = _Scopes(), []
    depth = indent = 0
    chain: list[str] = []  # the name that was just read
    waiting: list[str] = []  # names on this line whose value has not come yet
    joined, call, first, angle = False, 0, "", 0

    def written(value: str, a: int, b: int) -> Value:
        return Value([], value, (base + a, base + b))

    def literal(start: int, end: int) -> tuple[str, int, int]:
        a, b = _inside(text, start, end)
        strings.append((a, b))
        return unescaped(text[a:b]), a, b

    def values(at: int) -> tuple[list[Value], int]:
        """The literals of the value at a place, and where it ends; none if it is no literal."""
        found = []
        if block := _BLOCK.match(text, at):
            at, lead = block.end() - len(block["lead"]), block["lead"]
            while text.startswith(lead, at):
                end = text.find("\n", at)
                end = len(text) if end < 0 else end
                if text[at:end].strip():
                    found.append(written(text[at + len(lead) : end].rstrip(), at + len(lead), at + len(text[at:end].rstrip())))
                at = end + 1
            return found, min(at - 1, len(text))
        while True:
            if s := _STR.match(text, at):
                found.append(written(*literal(s.start(), s.end())))
                at = s.end()
                after = _BLANK.match(text, at).end()
                if _STR.match(text, after):  # strings side by side are one
                    at = after
                    continue
            else:
                name = _CHAIN.match(text, at)
                known = scopes.get(".".join(x.strip("\"'") for x in _LINKS.findall(name[0]))) if name else None
                if known is not None:
                    found.append(known)
                    at = name.end()
                elif name and text.startswith(("(", "["), name.end()):  # a call, or an element of something
                    return [], at
                elif word := _WORD.match(text, at):
                    plain = word[0].rstrip(".!")
                    if plain and (any(c.isdigit() for c in plain) or len(plain) >= PLAIN_WORD):
                        found.append(written(plain, at, at + len(plain)))
                    at = word.end()
                else:
                    return [], at
            if not (plus := _PLUS.match(text, at)):
                return found, at
            at = plus.end()

    at, n = 0, len(text)
    while at < n:
        m = _LEX.match(text, at)
        kind, at = m.lastgroup, m.end()
        if kind == "space":
            continue
        if kind == "name":
            if not joined:
                chain = []
            chain.append(m[0])
            joined = False
            continue
        if kind == "join":
            joined = bool(chain)
            continue
        joined = False
        if kind == "op":
            at = _BLANK.match(text, at).end()
            if chain:
                waiting.append(".".join(chain))
            found, end = values(at) if waiting else ([], at)
            if found:
                at = max(at, end)
                value = found[0] if len(found) == 1 else Value(found)
                for name in waiting:
                    scopes.bind(name, value, depth, indent)
                yield waiting, value
            if found or m[0] not in (":", "="):
                waiting = []
            chain, call, angle = [], 0, 0
            continue
        if kind == "str":
            value, a, b = literal(m.start(), m.end())
            if call == 3:
                yield [first], written(value, a, b)
            call = 2 if call == 1 else 0
            first = value
            chain = [value] if re.fullmatch(_NAME + r"(?:[.\-]\w++)*+", value) else []
            continue
        if kind == "xml":
            a, b = m.span("body")
            yield [m["tag"]], written(m["body"].strip(), a + len(m["body"]) - len(m["body"].lstrip()), b - len(m["body"]) + len(m["body"].rstrip()))
        elif kind == "line":
            indent = len(m[0]) - 1
            if text[at : at + 1] not in ("\n", ""):
                scopes.leave(depth, indent)
            waiting, chain = [], []
            continue
        elif kind == "sign":
            if m[0] == "[" and chain and (sub := _SUB.match(text, m.start())):
                at = sub.end()
                if (key := sub[1] if sub[1] is not None else sub[2]) is not None:
                    chain.append(key)
                continue
            if m[0] in "[<":
                angle += 1
            elif m[0] in "]>":
                angle = max(0, angle - 1)
            elif m[0] == "{":
                depth += 1
            elif m[0] == "}":
                depth = max(0, depth - 1)
                scopes.leave(depth, indent)
            if m[0] in ";({" or (m[0] == "," and not angle):
                waiting = []
            call = 1 if m[0] == "(" else 3 if m[0] == "," and call == 2 else 0
        else:  # a sentence, or a comparison; a type may have a word or two before its last
            if kind != "prose" or not (angle or (m[0].count(" ") <= 2 and "," not in m[0])):
                waiting = []
            call = 0
        chain = []
    if not nested:
        for a, b in strings:
            if _PAIRED.search(text, a, b):
                yield from pairs(text[a:b], base + a, True)


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and kind; the base patterns' spans are all among them."""
    paired = "=" in text or ":" in text
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE] if paired else []
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if paired or "</" in text or "(" in text and ("\"" in text or "'" in text):
        literal = set()
        for names, value in pairs(text):
            s = max(map(sensitivity, names))
            if s and ((value.measure().short or "").lower() not in PLACEHOLDERS) and s + randomness(value.counts) >= THRESHOLD:
                literal.update(("literal", a, b) for a, b in value.places())
        out += literal
    return sorted(set(out), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col and findings, an array of (kind, start, end, value).

    Kinds: assign, access and hex are the base patterns, leftmost and
    non-overlapping per kind; literal is a scored literal of an assignment.
    Offsets count code points, end is exclusive.  value is what stands there,
    the secret itself: ``digest`` gives counts and places only.  Null or empty
    texts have no findings; whole texts are read, each by itself; repeated rows
    and null ids are returned as they are; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches):
        for batch in batches:
            for first in range(0, len(batch), 1024):
                some = batch.slice(first, 1024)
                rows = []
                for text in some.column(1).to_pylist():
                    rows.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in scan(text)] if text else [])
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(rows, found)], names=[id_col, "findings"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, findings array<struct<kind:string,start:long,end:long,value:string>>")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of findings: no secret leaves this."""
    of = lambda k: F.size(F.filter("findings", lambda x: x["kind"] == k)).cast("long")
    told = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("findings", lambda x: x["kind"] != "literal")
    return found.select(
        id_col, of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("findings")).alias("spans"), of("literal").alias("n_literal"),
    )
