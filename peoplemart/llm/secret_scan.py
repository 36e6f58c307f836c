"""Secrets in texts: three plain patterns, and names that are given literals.

The lexer looks at every assignment sign (=, :, :=, =>) of source code, JSON, YAML and INI files, at elements of XML and
at armoured private keys, and takes the name before and the expression after: literals in quotes of any form and on any
number of lines, indented blocks, bare values, names and ${names}, added up by + or standing side by side, in brackets,
as arguments of calls, or after an `or`. Names given literals are constants of the whole text, also before they are
defined; an expression is scored under its target's name with the constants put in, so a literal that reaches a
password by way of other names is found where it stands. Code isn't a literal: the name of a call, a subscript.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from peoplemart.llm.common import mapped

KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_SIGN = re.compile(r":=|=>|[:=](?![=:/])")
_WORD = r"[A-Za-z_][A-Za-z0-9_.-]{0,99}"
_WORD_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_FIRST_SIGN = re.compile(r"[A-Za-z_]")
_TYPE = r"(?:&(?:'\w+ )?)?[A-Za-z_][A-Za-z0-9_.]*(?:\[[^\]\n=]{0,60}\]{1,3}|<[^>\n=]{0,60}>{1,3})?(?:\[\])*\??"
_ANNOTATED = re.compile(
    rf"""(?:(["']?)({_WORD})\1\??[ \t]*:[ \t]*|(?:var|const)[ \t]+({_WORD})[ \t]+){_TYPE}(?:[ \t]*\|[ \t]*{_TYPE}){{0,5}}[ \t]*\Z""", re.ASCII)
#: Of <add key="name" value=...>: what stands before the sign.
_KEYED = re.compile(rf"""\b(?:key|name|id)[ \t]*=[ \t]*(["'])({_WORD})\1[ \t]+value[ \t]*\Z""", re.IGNORECASE | re.ASCII)
_QUOTED = (r"""(?:[bBuUrRfF]{1,2}|[$@]{1,2})?(?:\"{3}((?:[^"\\]|\\[\s\S]|"(?!""))*+)\"{3}|'{3}((?:[^'\\]|\\[\s\S]|'(?!''))*+)'{3}"""
           r"""|"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`((?:[^`\\]|\\[\s\S])*+)`)""")
_TERM = re.compile(
    rf"""(?:[ \t]|\\\n)*(?:\s*\+\s*)?(?:(?:new|await)[ \t]+)?(?:{_QUOTED}|\$\{{({_WORD})\}}|([A-Za-z0-9+/_.=~!@%^*-]++))""")
_BARE, _GIVEN = 7, 6  # groups of _TERM
_OPENED = re.compile(r"[ \t]*([(\[])")
_OTHERWISE = re.compile(r"[ \t]*(?:\bor\b|\|\||\?\?)\s*")
_BLOCK = re.compile(r"[ \t]*[|>][+-]?[0-9]?[+-]?[ \t]*\n")
_GOES_ON = re.compile(r"[ \t]+[a-z]")
#: What stands between brackets.
_INNER = re.compile(rf"""(?P<skip>\s+|(?:\#|//)[^\n]*)|(?P<quoted>{_QUOTED})|(?P<otherwise>\bor\b|\|\||\?\?)|(?P<name>[A-Za-z_][A-Za-z0-9_.]*)"""
                    r"""|(?P<open>[(\[{])|(?P<close>[)\]}])|(?P<end>[,;])|(?P<sign>:=|=>|[:=](?![=:/]))|(?P<other>[\s\S])""")
#: The value of a plain span that may name a call: letters, _ and . only.
_CALL_NAME = re.compile(r"[:=]\x20*[A-Za-z_.]+\Z")
_CLOSES = {"(": ")", "[": "]", "{": "}"}
#: Calls that look up their first argument, and calls that show theirs to somebody: fixed values.
_LOOKS_UP = re.compile(r"get|get_?env|get_?property|get_?string|get_?or_?default|setdefault|env|environ|config|setting|lookup|fetch|pop", re.IGNORECASE)
_SHOWS = re.compile(r"input|raw_?input|get_?pass|prompt|ask|read_?line|print|log|debug|info|warn|error|format|translate|gettext|_", re.IGNORECASE)
_ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.-]*)(?:[ \t][^<>]*)?>\s*([^<>\s]+)\s*</\1[ \t]*>", re.ASCII)
_ARMOUR = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----(?:(?:[^-]|-(?!-))*+-----END \1-----|(?:\s*[A-Za-z0-9+/=]{16,})*+)")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*\Z")
_SENSITIVE = re.compile(
    r"pass(?:wor|phras|w)?d?e?s?\Z|pwd|secret|token|api[_.-]?key|access[_.-]?key|private[_.-]?key|credential|auth[_.-]?key|encryption[_.-]?key",
    re.IGNORECASE | re.ASCII)
_PLACEHOLDER = re.compile(r"<.*>|\$.*|\{.*\}|x+|\*+|\.+|none|null|true|false|example|changeme|your[_-].*", re.IGNORECASE | re.DOTALL)
#: Least score of a literal, and its least length.
LEAST_SCORE = 0.5
LEAST_LENGTH = 6
#: Of a value, enough of its beginning to tell placeholders.
_HEAD = 12

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """begin, end (code points) and kind of what the three patterns find, each from left to right."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


@dataclass(eq=False)
class Value:
    """What an expression or a part of it comes to: how often each sign occurs, and where its literals stand."""
    counts: Counter
    length: int
    head: str
    last: str
    parts: list[tuple[int, int] | Value]
    #: By way of another name.
    by_name: bool = False
    gathered: bool = False

    @staticmethod
    def of(value: str, begin: int = 0, counts: Counter | None = None, end: int | None = None) -> Value:
        """Of a literal; with counts and end, value is its beginning only, or more."""
        whole = counts is None
        counts, end = (Counter(value), begin + len(value)) if whole else (counts, end)
        return Value(counts, end - begin, value[:_HEAD], value[-1:], [(begin, end)])

    @staticmethod
    def joined(first: Value, rest: Value | None) -> Value:
        if rest is None:
            return first
        return Value(first.counts + rest.counts, first.length + rest.length, (first.head + rest.head)[:_HEAD],
                     rest.last or first.last, [first, rest], first.by_name or rest.by_name)

    def score(self, name: str) -> float:
        if self.length < LEAST_LENGTH or not _SENSITIVE.search(name):
            return 0.0
        folded = {c.lower() for c in self.counts}
        short = self.head if self.length <= _HEAD else folded.pop() * _HEAD if len(folded) == 1 else f"{self.head}\0{self.last}"
        if _PLACEHOLDER.fullmatch(short):
            return 0.0
        if self.by_name and self.counts[" "] == 1 and all(c == " " or c.isalpha() for c in self.counts):
            return 0.0  # two plain words that a name stands for are a label
        bits = -sum(n / self.length * math.log2(n / self.length) for n in self.counts.values())
        kinds = (any("a" <= c <= "z" for c in self.counts) + any("A" <= c <= "Z" for c in self.counts)
                 + any("0" <= c <= "9" for c in self.counts)
                 + any(not (c.isascii() and c.isalnum()) for c in self.counts))
        return min(1.0, 0.2 + 0.1 * kinds + 0.1 * bits)

    def gather(self, found: set[Span]) -> None:
        """Adds where the literals stand, once for each value."""
        left = [self]
        while left:
            value = left.pop()
            if not value.gathered:
                value.gathered = True
                for part in value.parts:
                    if isinstance(part, Value):
                        left.append(part)
                    elif part[1] > part[0]:
                        found.add((*part, "literal"))


@dataclass(eq=False)
class _Node:
    """A part of an expression: a literal, or what its parts or its name's definition come to."""
    value: Value | None = None
    parts: list[_Node] = field(default_factory=list)
    name: str = ""
    at: int = 0
    #: Of a name without a definition.
    literal: Value | None = None
    #: Of an argument of a call, which counts without blanks only.
    argument: bool = False
    opened: bool = False


@dataclass(eq=False)
class _Group:
    """A bracket that isn't closed yet: its arguments so far, and the terms of the one that is read."""
    begin: int
    bracket: str
    called: str
    arguments: list[list[_Node]] = field(default_factory=list)
    choices: list[_Node] = field(default_factory=list)
    terms: list[_Node] = field(default_factory=list)
    named: bool = False

    def ends_choice(self) -> None:
        if self.terms:
            self.choices.append(self.terms[0] if len(self.terms) == 1 else _Node(parts=self.terms))
        self.terms = []

    def ends_argument(self) -> None:
        self.ends_choice()
        self.arguments.append([] if self.named else self.choices)  # a named one is that name's
        self.choices, self.named = [], False

    def found(self) -> list[_Node]:
        """The values it may come to."""
        if self.bracket == "{" or self.bracket == "[" and self.called:
            return []
        if not self.called:
            return [c for choices in self.arguments for c in choices]
        if _SHOWS.fullmatch(self.called):
            return []
        skipped = 1 if _LOOKS_UP.fullmatch(self.called) else 0
        return [_Node(parts=[c], argument=True) for choices in self.arguments[skipped:] for c in choices]


class _Lexer:
    """Expressions of one text. What follows a term is read once, however many expressions it ends, and so
    is a bracket, and a bare value in which further signs stand."""

    def __init__(self, text: str):
        self.text = text
        self.definitions: dict[str, list[tuple[int, int, list[_Node]]]] = {}
        self.rests: dict[int, tuple[_Node | None, int]] = {}
        self.groups: dict[int, tuple[list[_Node], int] | None] = {}
        self.run = (0, 0)
        self.ends: dict[int, Counter] = {}

    def _called(self, bracket: int) -> str:
        """The last part of the name that a bracket stands directly after."""
        begin = bracket
        while begin and (self.text[begin - 1].isalnum() or self.text[begin - 1] == "_"):
            begin -= 1
        return self.text[begin: bracket]

    def _group(self, begin: int) -> tuple[list[_Node], int] | None:
        """The values of a bracket and where it ends; None if it doesn't."""
        if begin in self.groups:
            return self.groups[begin]
        new = lambda at: _Group(at, self.text[at], self._called(at))
        left, at = [new(begin)], begin + 1
        while left:
            m = _INNER.match(self.text, at)
            now = left[-1]
            if m is None or m.lastgroup == "close" and m["close"] != _CLOSES[now.bracket]:
                for group in left:
                    self.groups[group.begin] = None
                return None
            kind, at = m.lastgroup, m.end()
            if kind == "close" or kind == "open" and self.groups.get(m.start()):
                if kind == "close":
                    now.ends_argument()
                    self.groups[now.begin] = now.found(), at
                    left.pop()
                    group = now
                else:
                    group = new(m.start())
                values, at = self.groups[group.begin]
                if not left:
                    break
                now = left[-1]
                if len(values) == 1:
                    now.terms.append(values[0])
                else:
                    now.choices += values
            elif kind == "open":
                left.append(new(m.start()))
            elif kind == "quoted":
                inner = next(i for i in range(m.re.groupindex["quoted"] + 1, m.re.groupindex["quoted"] + 6) if m.start(i) >= 0)
                now.terms.append(_Node(Value.of(m[inner], m.start(inner))))
            elif kind == "name" and self.text[at: at + 1] not in ("(", "["):
                now.terms.append(_Node(name=m["name"], at=m.start()))
            elif kind == "otherwise":
                now.ends_choice()
            elif kind == "end":
                now.ends_argument()
            elif kind == "sign":
                now.named = True
        return self.groups[begin]

    def _bracketed(self, begin: int, end: int) -> tuple[_Node | None, list[_Node], int]:
        """What a bracket comes to: a term, or values to choose from; and where it ends."""
        values, end = self._group(begin) or ([], end)
        return (values[0], [], end) if len(values) == 1 else (None, values, end)

    def _term(self, at: int, first: bool) -> tuple[_Node | None, list[_Node], int] | None:
        begin = at + (self.text[at: at + 1] == "+")
        if first and self.run[0] < at and begin < self.run[1]:
            return self._bare(begin)
        m = _TERM.match(self.text, at)
        if not m:
            opened = _OPENED.match(self.text, at) if first else None
            return self._bracketed(opened.start(1), opened.end()) if opened else None
        begin, kind = m.start(m.lastindex), m.lastindex
        if kind == _BARE and not first and "+" not in self.text[at: begin]:
            return None  # a bare word goes on the sentence, not the value
        if kind == _BARE and first:
            self.run, self.ends = m.span(kind), {}
            return self._bare(begin)
        if kind in (_BARE, _GIVEN):
            if kind == _BARE and self.text[m.end(): m.end() + 1] in ("(", "["):
                return self._bracketed(m.end(), m.end())
            return self._named(m[kind], begin, Value.of(m[kind], begin)), [], m.end()
        return _Node(Value.of(m[kind], begin)), [], m.end()

    @staticmethod
    def _named(word: str, at: int, literal: Value) -> _Node:
        return _Node(name=word, at=at, literal=literal) if _NAME.match(word) else _Node(literal)

    def _bare(self, begin: int) -> tuple[_Node | None, list[_Node], int]:
        """From begin to the end of the run: the counts after each sign in the run are made at once, from its end."""
        end = self.run[1]
        if self.text[end: end + 1] in ("(", "[") and self._called(end)[:1].isidentifier():
            return self._bracketed(end, end)
        if begin not in self.ends:
            stops = sorted({begin, *(s.end() + (self.text[s.end(): s.end() + 1] == "+")
                                     for s in _SIGN.finditer(self.text, begin, end))})
            counts, right = Counter(), end
            for stop in reversed([s for s in stops if s <= end]):
                counts = counts + Counter(self.text[stop: right])
                self.ends[stop], right = counts, stop
        value = Value.of(self.text[begin: begin + _HEAD], begin, self.ends[begin], end)
        value.last = self.text[end - 1: end]
        # the rest of a run with further signs is no name
        word = self.text[begin: end] if len(self.ends) == 1 else ""
        if word.isalpha() and self.text[:begin].rstrip(" \t")[-1:] == ":" and _GOES_ON.match(self.text, end):
            return None, [], end  # a sentence
        return self._named(word, begin, value), [], end

    def _block(self, at: int) -> tuple[_Node, int] | None:
        """The lines after a block mark that are indented deeper than the mark's line."""
        m = _BLOCK.match(self.text, at)
        if not m:
            return None
        line = self.text[self.text.rfind("\n", 0, at) + 1: at]
        depth, begin, end = len(line) - len(line.lstrip(" \t-")), m.end(), m.end()
        while end < len(self.text):
            stop = self.text.find("\n", end)
            stop = len(self.text) if stop < 0 else stop
            line = self.text[end: stop]
            if line.strip() and len(line) - len(line.lstrip(" \t")) <= depth:
                break
            end = stop + 1
        inner = self.text[begin: end]
        begin += len(inner) - len(inner.lstrip())
        return _Node(Value.of(inner.strip(), begin)), end

    def expression(self, at: int) -> tuple[list[_Node], int]:
        """What the terms from at on may come to, and where they end."""
        if block := self._block(at):
            return [block[0]], block[1]
        first = self._term(at, True)
        if first is None:
            return [], at
        node, values, at = first
        if node is None:
            rest = None
        else:
            found = []
            while at not in self.rests and (term := self._term(at, False)):
                found.append((at, term[0]))
                at = term[2]
            rest, at = self.rests.setdefault(at, (None, at))
            for begin, term in reversed(found):
                parts = [n for n in (term, rest) if n is not None]
                rest = _Node(parts=parts)
                self.rests[begin] = rest, at
            values = [node if rest is None else _Node(parts=[node, rest])]
        while other := _OTHERWISE.match(self.text, at):
            term = None if (m := _TERM.match(self.text, other.end())) and m.lastindex == _BARE and self.text[m.end(): m.end() + 1] != "(" \
                else self._term(other.end(), True)
            if term is None:
                break
            for name in values:
                name.literal = None  # a name that may be missing is code
            values = values + [n for n in (term[0], *term[1]) if n is not None]
            at = term[2]
        return values, at

    def define(self, name: str, values: list[_Node], end: int) -> None:
        self.definitions.setdefault(name, []).append((end, len(self.definitions[name]) if name in self.definitions else 0, values))

    def _meaning(self, name: str, at: int) -> list[_Node]:
        """Of the last definition that ends before, or else the first."""
        known = self.definitions.get(name)
        return known[max(0, bisect.bisect_right(known, (at,)) - 1)][2] if known else []

    def solved(self, node: _Node) -> Value:
        """What a node comes to. A name that is met on the way to its own value adds nothing."""
        left = [node]
        while left:
            now = left[-1]
            if now.value is not None:
                left.pop()
            elif not now.opened:
                now.opened = True
                if now.name:
                    now.parts = self._meaning(now.name, now.at)
                left += [p for p in now.parts if p.value is None and not p.opened]
            else:
                left.pop()
                if now.name and now.name not in self.definitions and now.literal is not None:
                    now.value = now.literal
                    continue
                value = Value.of("")
                for part in now.parts:
                    if part.value is not None and not (now.argument and part.value.counts[" "]):
                        value = Value.joined(value, part.value)
                value.by_name = value.by_name or bool(now.name)
                now.value = value
        return node.value


def _word_before(text: str, end: int, least: int) -> tuple[str, int]:
    """The name, in quotes or not, that ends before end but for blanks, and where it begins; empty if none does."""
    while end > least and text[end - 1] in " \t":
        end -= 1
    quote = text[end - 1] if end > least and text[end - 1] in "\"'" else ""
    stop = begin = end - len(quote)
    while begin > least and text[begin - 1] in _WORD_SIGNS:
        begin -= 1
    first = _FIRST_SIGN.search(text, begin, stop)
    if not first or quote and (first.start() <= least or text[first.start() - 1] != quote):
        return "", end
    return text[first.start(): stop], first.start() - len(quote)


def names_before(text: str, sign: int, least: int = 0) -> list[str]:
    """What a sign gives something to: the name or the subscript before it, and the name before a type or in
    a key beside a value. Types and keys are looked for in the 400 signs before."""
    name, begin = _word_before(text, sign, least)
    if not name:
        end = len(text[least: sign].rstrip(" \t")) + least
        if end > least and text[end - 1] == "]":
            name, begin = _word_before(text, end - 1, least)
            name = name if text[least: begin].rstrip(" \t")[-1:] == "[" else ""
    found = [name] if name else []
    near = max(0, sign - 400)
    line = text[max(near, text.rfind("\n", near, sign) + 1): sign]
    if (":" in line or "var" in line or "const" in line) and (typed := _ANNOTATED.search(line)):
        found.append(typed[2] or typed[3])
    if name.lower() == "value" and (keyed := _KEYED.search(line)):
        found.append(keyed[2])
    return found


def score(name: str, value: str) -> float:
    """0 to 1: how sure a value is a secret, of a name that says so. Other names' values score 0."""
    return Value.of(value).score(name)


def literal_spans(text: str, least_score: float = LEAST_SCORE) -> list[Span]:
    """begin, end and kind of the literals that reach a sensitive name, directly or as constants."""
    if "=" not in text and ":" not in text and "</" not in text and "PRIVATE KEY-----" not in text:
        return []
    lexer = _Lexer(text)
    targets: list[tuple[str, list[_Node]]] = []
    before = 0

    def give(names: list[str], values: list[_Node], end: int) -> None:
        for name in names:
            lexer.define(name, values, end)
            if _SENSITIVE.search(name):
                targets.append((name, values))

    for sign in _SIGN.finditer(text):
        names = names_before(text, sign.start(), before)
        before = sign.end()
        if names:
            values, end = lexer.expression(sign.end())
            if values:
                give(names, values, end)
    for element in _ELEMENT.finditer(text):
        give([element[1]], [_Node(Value.of(element[2], element.start(2)))], element.end())
    found: set[Span] = set()
    if targets:
        for known in lexer.definitions.values():
            known.sort(key=lambda d: d[:2])
        for name, values in targets:
            for node in values:
                value = lexer.solved(node)
                if value.score(name) >= least_score:
                    value.gather(found)
    return _with_keys(sorted(found), [m.span() for m in _ARMOUR.finditer(text)])


def _with_keys(spans: list[Span], keys: list[tuple[int, int]]) -> list[Span]:
    """spans (sorted) and the armoured keys outside of them; a span inside such a key goes."""
    reach = list(accumulate((e for _, e, _ in spans), max))
    new = [(b, e) for b, e in keys if not ((i := bisect.bisect(spans, (b, math.inf)) - 1) >= 0 and reach[i] >= e)]
    inside = lambda b, e: (i := bisect.bisect(new, (b, math.inf)) - 1) >= 0 and e <= new[i][1]
    return sorted([*(s for s in spans if not inside(s[0], s[1])), *((b, e, "literal") for b, e in new)])


def spans_of(text: str) -> tuple[list[Span], list[Span]]:
    """The plain patterns' spans, and all spans, by begin and then kind."""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(base_spans(text), key=order)
    return base, sorted([*base, *literal_spans(text)], key=order)


def told_apart(text: str, spans: list[Span]) -> list[Span]:
    """spans without those of the plain pattern whose value is the name of a call."""
    called = lambda b, e: text[e: e + 1] == "(" and _CALL_NAME.search(text, b, e)
    return [s for s in spans if s[2] != "assign" or not called(s[0], s[1])]


def redacted(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """text with every stretch that spans cover replaced by a mark."""
    out, at = [], 0
    begin = end = -1
    for b, e, _ in [*spans, (len(text) + 1, 0, "")]:
        if b <= end:
            end = max(end, e)
            continue
        if end >= 0:
            out += [text[at:begin], mark]
            at = end
        begin, end = b, e
    return "".join([*out, text[at:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{b}:{e}" for b, e, kind in spans)


RESULTS = {"n_assign": T.LongType(), "n_access": T.LongType(), "n_hex": T.LongType(), "n_literal": T.LongType(),
           "base_sha256": T.StringType(), "spans": T.StringType(), "redacted_text": T.StringType()}


def _scan(texts: list[str | None]) -> list[list]:
    rows = []
    for text in texts:
        base, every = spans_of(text or "")
        counts = Counter(kind for *_, kind in every)
        rows.append((*(counts[k] for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every),
                     redacted(text or "", told_apart(text or "", every)) if every else text))
    return [list(x) for x in zip(*rows, strict=True)]


def secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_assign, n_access, n_hex, n_literal, base_sha256 (of the plain patterns' spans), spans
    (kind:begin:end in code points, comma-joined, by begin and then kind) and redacted_text, in which
    the names of calls that the plain pattern takes are left (password = ask(...)).

    A NULL text has no spans and stays NULL; so does an empty one stay empty. Long texts are read
    whole. Rows stand alone: repeats, ties and missing ids don't matter."""
    return mapped(docs, text_col, RESULTS, _scan)
