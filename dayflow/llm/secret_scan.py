"""Secret scan: fixed patterns plus assignment-aware lexing.

Fixed patterns find spans of three kinds (``assign``, ``access``, ``hex``).
The lexer adds ``literal`` spans: it reads source and configuration syntax
(``name = "x"``, ``name: x``, ``"name": "x"``, ``name := x``, ``name => x``,
``export NAME=x``, annotated and concatenated values) as name-literal pairs in
text order, propagates constants through names (``a = "x"; password = a + "y"``,
``"${A}"``), and scores each value by its target name and its own form.  The
literals that make up a high-scoring value are reported where they stand, even
if the sensitive name appears only later.

Offsets are code points, ends exclusive.  Texts are scanned whole.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter, deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate, count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayflow.llm.common import stretches

# The three base patterns; matches that fail their length are dropped.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_CHARS = 12
# A match is a maximal run, so the length can be asked for in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "literal")
BASE_KINDS = KINDS[:3]
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

OPERATOR = re.compile(r"[:=]")
NAME_CHARS = re.compile(r"[\w.$-]")
TYPE = re.compile(r"[\w\[\]., ]+")
TYPED_NAME = re.compile(r"[A-Za-z_$][\w$]*")
TERM = re.compile(r"""[rbuf]?"((?:[^"\\\n]|\\.)*)"|[rbuf]?'((?:[^'\\\n]|\\.)*)'"""
                  r"""|`([^`\n]*)`|([^\s"'`,;(){}\[\]<>]+)""")
JOIN = re.compile(r"[ \t]*\+[ \t]*")
PLAIN_NAME = re.compile(r"\$?\{?([A-Za-z_][\w.]*)\}?")
INSIDE = re.compile(r"\$\{([A-Za-z_]\w*)\}")
NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
COUNTS_KEPT = 64           # character counts of scored values that later ones may start from

# Target-name words, and the qualifiers that make "key" sensitive.
SENSITIVE = {"password", "passwd", "pwd", "passphrase", "secret", "token", "apikey",
             "credential", "credentials", "bearer"}
KEY_QUALIFIERS = {"api", "access", "private", "secret", "auth", "encryption", "signing",
                  "master", "account", "storage"}
# Words that say the value describes a secret rather than being one.
DESCRIBES = {"count", "length", "limit", "max", "min", "num", "type", "name", "url", "path",
             "file", "field", "expiry", "ttl", "size", "label"}
PLACEHOLDERS = ("example", "changeme", "change_me", "your", "xxxx", "placeholder", "dummy",
                "redacted", "****", "todo", "<", "none", "null", "true", "false")
PLACEHOLDER = re.compile("(?=(" + "|".join(map(re.escape, PLACEHOLDERS)) + "))",
                         re.IGNORECASE | re.ASCII)
EDGE = max(map(len, PLACEHOLDERS)) - 1
SCORED_LENGTH = 8
THRESHOLD = 0.75


class Source:
    """A text and what is asked about its stretches, each found once for the whole text."""

    def __init__(self, text: str):
        self.text = text
        self._starts: list[int] | None = None
        self._ends: list[int] = []
        self._run, self._at = (-1, -1), -1
        self._counts: Counter[str] = Counter()
        self._alike: Counter[int] = Counter()       # how many characters occur so often
        self._kinds = [0] * 6

    def has_placeholder(self, start: int, end: int) -> bool:
        """Whether a placeholder lies inside the stretch."""
        if self._starts is None:
            found = [m.span(1) for m in PLACEHOLDER.finditer(self.text)]
            self._starts = [s for s, _ in found]
            ends = [e for _, e in found]
            for i in range(len(ends) - 2, -1, -1):  # the earliest end from here on
                ends[i] = min(ends[i], ends[i + 1])
            self._ends = ends
        k = bisect_left(self._starts, start)
        return k < len(self._ends) and self._ends[k] <= end

    def _add(self, start: int, end: int, sign: int) -> None:
        for c, k in Counter(self.text[start:end]).items():
            old = self._counts[c]
            new = old + sign * k
            self._counts[c] = new
            for n, by in ((old, -1), (new, 1)):
                if n:
                    self._alike[n] += by
                    if not self._alike[n]:
                        del self._alike[n]
            if not old or not new:
                for i, held in enumerate(_kinds_of(c)):
                    self._kinds[i] += sign * held

    def look(self, start: int, end: int) -> Look:
        """Form of a stretch.  Stretches asked for in turn that share their end, such as the
        values of ``a=b&a=b&...``, only take away what lies between their starts."""
        if end != self._run[1] or start < self._at:
            self._counts, self._alike, self._kinds = Counter(), Counter(), [0] * 6
            self._add(start, end, 1)
        else:
            self._add(self._at, start, -1)
        self._run, self._at = (start, end), start
        return Look(end - start, dict(self._alike), [k > 0 for k in self._kinds])


def _kinds_of(c: str) -> tuple[bool, ...]:
    """Digit, letter, not lower, not upper, sign, blank."""
    return (c.isdigit(), c.isalpha(), c != c.lower(), c != c.upper(),
            not c.isalnum() and not c.isspace(), c == " ")


@dataclass
class Look:
    """What a value's score reads: length, how many characters occur how often, kinds."""

    length: int
    alike: dict[int, int]
    kinds: list[bool]


class Value:
    """A value as its parts in text order: stretches of the text and earlier values.

    The text itself is never joined: a value made of others links to them, so all
    values of a text together take memory in proportion to their number.
    """

    __slots__ = ("number", "source", "parts", "spans", "length", "head", "tail", "placeholder",
                 "counts", "reported")

    def __init__(self, number: int, source: Source, parts: list[tuple[int, int] | Value],
                 spans: list[tuple[int, int]]):
        self.number, self.source = number, source
        self.parts, self.spans = parts, spans        # parts have lower numbers
        self.counts: dict[str, int] | None = None
        self.reported = False
        self.length, self.head, self.tail, self.placeholder = 0, "", "", False
        text = source.text
        for part in parts:
            if isinstance(part, tuple):
                s, e = part
                length, head = e - s, text[s:min(e, s + EDGE)].lower()[:EDGE]
                tail, has = text[max(s, e - EDGE):e].lower()[-EDGE:], source.has_placeholder(s, e)
            else:
                length, head, tail, has = part.length, part.head, part.tail, part.placeholder
            seam = self.tail + head
            self.placeholder = self.placeholder or has or any(p in seam for p in PLACEHOLDERS)
            self.length = min(SCORED_LENGTH, self.length + length)      # no more is asked for
            self.head = (self.head + head)[:EDGE] if len(self.head) < EDGE else self.head
            self.tail = (self.tail + tail)[-EDGE:]

    @property
    def may_score(self) -> bool:
        return self.length >= SCORED_LENGTH and not self.placeholder

    def characters(self) -> dict[str, int]:
        """How often each character occurs."""
        if self.counts is not None:
            return self.counts
        out: Counter[str] = Counter()
        times, heap = {self.number: 1}, [(-self.number, self)]
        while heap:                          # each value once, after all that hold it
            _, v = heapq.heappop(heap)
            n = times.pop(v.number)
            if v.counts is not None:
                for c, k in v.counts.items():
                    out[c] += n * k
                continue
            for part in v.parts:
                if isinstance(part, tuple):
                    for c, k in Counter(v.source.text[part[0]:part[1]]).items():
                        out[c] += n * k
                elif part.number in times:
                    times[part.number] += n
                else:
                    times[part.number] = n
                    heapq.heappush(heap, (-part.number, part))
        return out

    def look(self) -> Look:
        if len(self.parts) == 1 and isinstance(self.parts[0], tuple):
            return self.source.look(*self.parts[0])
        counts = self.characters()
        kinds = [_kinds_of(c) for c in counts]
        return Look(sum(counts.values()), dict(Counter(counts.values())),
                    [any(k) for k in zip(*kinds)])

    def report(self, found: set[tuple[int, int]]) -> None:
        """Add the spans of all literals to ``found``, each value's once a text."""
        todo = [self]
        while todo:
            v = todo.pop()
            if not v.reported:
                v.reported = True
                found.update(v.spans)
                todo += [part for part in v.parts if not isinstance(part, tuple)]


def name_score(name: str) -> float:
    """0 to 1: how surely a target of this name holds a secret."""
    words = {w.lower() for w in NAME_WORDS.findall(name.split(".")[-1])}
    if words & DESCRIBES:
        return 0.0
    if words & SENSITIVE or ("key" in words and words & KEY_QUALIFIERS):
        return 1.0
    return 0.5 if words & {"auth", "cred", "creds", "key", "pass"} else 0.0


def literal_score(value: Value) -> float:
    """0 to 1: how much a literal looks like a secret by length, mix and entropy."""
    if not value.may_score:
        return 0.0
    look = value.look()
    n = look.length
    entropy = -sum(m * (c / n) * math.log2(c / n) for c, m in look.alike.items())
    digit, alpha, upper, lower, sign, blank = look.kinds
    mixed = upper and lower
    score = (0.3 + 0.25 * (entropy >= 3.0) + 0.3 * (digit and alpha) + 0.1 * mixed
             + 0.1 * sign)
    return max(0.0, min(1.0, score - 0.3 * blank))


def _annotated(text: str, op: int, before: int) -> str:
    """The name of ``name: type`` in front of ``op`` ('' if none).

    A type holds no operator, so its colon can only be the operator at ``before``,
    and the stretches read for all operators of a text do not overlap.
    """
    if before < 0 or text[before] != ":":
        return ""
    between = text[before + 1:op]
    if "\n" in between or not TYPE.fullmatch(between.rstrip().lstrip(" \t")):
        return ""
    end = before
    while end and text[end - 1] in " \t":
        end -= 1
    i = end
    while i and (text[i - 1] == "$" or text[i - 1] == "_" or text[i - 1].isalnum()):
        i -= 1
    m = TYPED_NAME.search(text, i, end)
    return m[0] if m else ""


def _target(text: str, op: int, before: int) -> str:
    """The name that an operator at ``op`` assigns to ('' if none).

    ``before`` is where the operator in front of it is (-1 if none).
    """
    i = op
    while i and text[i - 1] in " \t":
        i -= 1
    quote = text[i - 1] if i and text[i - 1] in "\"'" else ""
    i -= len(quote)
    end = i
    while i and NAME_CHARS.match(text[i - 1]):
        i -= 1
    name = text[i:end]
    if quote and (not i or text[i - 1] != quote):
        return ""
    if text[op] == "=" and not quote:
        if typed := _annotated(text, op, before):
            return typed
    return name if name and (name[0].isalpha() or name[0] in "_$") else ""


def _value_start(text: str, op: int) -> int:
    """Where the value begins, or -1 if this is no assignment."""
    prev, after = text[op - 1] if op else "", text[op + 1:op + 2]
    if text[op] == ":":
        if after in (":", "/") or prev == ":":
            return -1
        i = op + 2 if after == "=" else op + 1
    else:
        if prev in "!<>=:" and prev or after == "=":
            return -1
        i = op + 2 if after == ">" else op + 1
    while i < len(text) and text[i] in " \t":
        i += 1
    return i


class Terms:
    """Terms of a text by where they start; a bare run is read once for all starts in it."""

    def __init__(self, text: str):
        self.text = text
        self.low = self.high = -1
        self._after: dict[int, int] = {}
        self._later: dict[int, tuple | None] = {}

    def first(self, start: int) -> tuple[int, int, int, int] | None:
        """Group, span and end of the term at ``start``."""
        # inside a bare run, and not at its last character (which may begin ``b"..."``)
        if self.low <= start < self.high - 1:
            return 4, start, self.high, self.high
        found = self._read(start)
        if found and found[0] == 4:
            self.low, self.high = start, found[3]
        return found

    def _read(self, start: int) -> tuple[int, int, int, int] | None:
        m = TERM.match(self.text, start)
        return (m.lastindex, *m.span(m.lastindex), m.end()) if m else None

    def later(self, start: int) -> tuple[int, int, int, int] | None:
        """The same of a term behind a plus."""
        if start not in self._later:
            self._later[start] = self._read(start)
        return self._later[start]

    def after(self, end: int) -> int:
        """Where the term joined by a plus behind ``end`` starts, -1 if there is none."""
        if end not in self._after:
            m = JOIN.match(self.text, end)
            self._after[end] = m.end() if m else -1
        return self._after[end]


def literals(text: str) -> Iterator[tuple[str, Callable[[], Value]]]:
    """Name and propagated value, which holds the spans of the literals that make it up.

    A value of one stretch alone is made when it is asked for; until then it is the stretch.
    """
    source, terms = Source(text), Terms(text)
    known: dict[str, Value | tuple[int, int]] = {}
    numbers = count()                       # a value is made after its parts

    def made(value: Value | tuple[int, int]) -> Value:
        if isinstance(value, Value):
            return value
        return Value(next(numbers), source, [value], [value])

    def held(name: str) -> Value:
        known[name] = made(known[name])
        return known[name]

    tails: dict[int, Value | None] = {}

    def tail(start: int) -> Value | None:
        """The value of a term behind a plus and all behind it, shared by the values that end
        in it; None if one of them is or holds a name, which may mean different values."""
        walk = []
        while start not in tails:
            found = terms.later(start)
            if not found:                   # a plus with nothing behind it ends the value
                start = -1
                break
            group, s, e, end = found
            if PLAIN_NAME.fullmatch(text, s, e) if group == 4 else INSIDE.search(text, s, e):
                tails[start] = None
                break
            walk.append((start, s, e))
            then = terms.after(end)
            if then < 0:
                start = -1
                break
            start = then
        rest = tails[start] if start >= 0 else None
        for at, s, e in reversed(walk):
            if start >= 0 and rest is None:
                tails[at] = None
            else:
                rest = Value(next(numbers), source, [(s, e), *([rest] if rest else ())], [(s, e)])
                tails[at] = rest
        return tails[walk[0][0]] if walk else rest

    op = -1
    for m in OPERATOR.finditer(text):
        before, op = op, m.start()
        i = _value_start(text, op)
        if i < 0 or not (name := _target(text, op, before)):
            continue
        parts, spans, sure = [], [], True
        term = terms.first(i)
        while term:
            group, s, e, end = term
            then = terms.after(end)
            ref = PLAIN_NAME.fullmatch(text, s, e) if group == 4 else None
            if ref and ref[1] in known:
                parts.append(held(ref[1]))
            elif ref and (text[s] == "$" or then >= 0):
                sure = False                # a name of unknown value
            else:
                spans.append((s, e))
                at = s
                for inner in INSIDE.finditer(text, s, e) if group != 4 else ():
                    if inner[1] in known:
                        parts += [(at, inner.start()), held(inner[1])]
                        at = inner.end()
                parts.append((at, e))
            if then < 0:
                break
            if shared := tail(then):
                parts.append(shared)
                break
            term = terms.later(then)
        if not parts:
            known.pop(name, None)
            continue
        if len(parts) == 1 and not spans:
            value = parts[0]
        elif len(parts) == 1 and spans == parts:
            value = spans[0]
        else:
            value = Value(next(numbers), source, parts, spans)
        if sure:
            known[name] = value
            yield name, lambda name=name: held(name)
        else:
            known.pop(name, None)
            yield name, lambda value=value: made(value)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind index, end)`` of the fixed patterns."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def scan_text(text: str) -> list[tuple[int, int, int]]:
    """All spans of one text, by start and then kind."""
    out = base_spans(text)
    added: set[tuple[int, int]] = set()
    kept: deque[Value] = deque()
    for name, get in literals(text):
        weight = name_score(name)
        if not weight:
            continue
        value = get()
        if value.may_score and value.counts is None and len(value.parts) > 1:
            value.counts = value.characters()
            kept.append(value)
            if len(kept) > COUNTS_KEPT:
                kept.popleft().counts = None        # counted again if asked for
        if (weight + literal_score(value)) / 2 >= THRESHOLD:
            value.report(added)
    if added:
        base = sorted((s, e) for s, _, e in out)
        starts = [s for s, _ in base]
        furthest = list(accumulate((e for _, e in base), max))
        covered = lambda s, e: (k := bisect_right(starts, s)) and furthest[k - 1] >= e
        out += [(s, 3, e) for s, e in added if e > s and not covered(s, e)]
    return sorted(out)


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def _structs(rows: list[list[tuple[int, int, int]]]) -> list[list[dict]]:
    return [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in row] for row in rows]


_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64())]))


def spans(text: Column) -> Column:
    """Array of ``(kind, start, end)`` by start, then kind; null texts have none."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in stretches(batches):
            yield pa.array(_structs([scan_text(t or "") for t in texts]), _ARROW_SPANS)
    return F.arrow_udf(run, SPANS)(text)


def spans_text(found: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the given kinds, comma-joined."""
    return F.array_join(F.transform(
        F.filter(found, lambda s: s["kind"].isin(*kinds)),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                              s["end"].cast("string"))), ",")


def redact_text(text: str, mark: str = "[secret]") -> str:
    """``text`` with each stretch covered by spans replaced by ``mark``."""
    out, at = [], 0
    stretches: list[list[int]] = []
    for s, _, e in scan_text(text):
        if stretches and s < stretches[-1][1]:
            stretches[-1][1] = max(e, stretches[-1][1])
        else:
            stretches.append([s, e])
    for s, e in stretches:
        out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with secrets in ``text_col`` replaced by ``mark``; null texts stay null."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in stretches(batches):
            yield pa.array([None if t is None else redact_text(t, mark) for t in texts],
                           pa.string())
    return df.withColumn(text_col, F.arrow_udf(run, "string")(F.col(text_col)))
