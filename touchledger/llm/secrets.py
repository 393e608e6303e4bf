"""Secret scans by assignment-aware lexing.

A text is searched for assignments in source and configuration syntax: a name, dotted, hyphenated or quoted, an operator
(``=``, ``:=``, ``=>``, ``:``) and a value of string literals, bare words and names joined by ``+``. Names that are
assigned a literal are constants of the text; where a constant's name or ``${NAME}`` is assigned on, its literal goes
with it. A literal is a secret if the sensitivity of a name it reaches times the strength of the literal is high enough.
So are all literals of an expression, constants put in, whose joined value is as strong as that for the name it is
assigned to; a constant has the value assigned last before its use, or else first after it.
Three fixed patterns (assignments to known names, access keys, hexadecimal runs) are applied beside it.

Defined results: spans count code points, ends are exclusive, and for quoted literals they leave out the quotes; a span
of the method that lies inside one of a fixed pattern is not reported again; null and empty texts have no spans;
repeated rows each get their own; input columns with a result's name give way.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

# The base patterns, their shortest matches and the order of their kinds.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # Runs shorter than the bound cannot match, so it stands in the pattern.
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
KINDS = ("assign", "access", "hex", "lexed")
#: How much a part of a name says that its value is secret, and parts that say it is about one instead.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "cred": 0.8, "creds": 0.8, "bearer": 0.9, "jwt": 0.9,
    "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authkey": 1.0, "signingkey": 1.0, "encryptionkey": 1.0,
    "auth": 0.6, "authorization": 0.7, "pin": 0.5, "salt": 0.5,
}
ABOUT = {"name", "id", "path", "file", "url", "uri", "count", "length", "len", "size", "type", "hint", "label", "field",
         "prompt", "expires", "expiry", "ttl", "timeout", "policy", "public", "max", "min", "regex", "pattern"}
THRESHOLD = 0.45
SHORTEST = 6
#: Characters up to which a value is compared with placeholders; a longer one is a placeholder only if all are the same.
PLACEHOLDER = 1 << 10

_OPERATOR = re.compile(r":=|=>|==|!=|<=|>=|::|[:=]")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_BLANK = re.compile(r"[ \t]*")
_VALUE = re.compile(r"""
    "(?P<double>(?:[^"\\\n]|\\.)*+)" | '(?P<single>(?:[^'\\\n]|\\.)*+)'
    | \$\{(?P<braced>[A-Za-z_][\w.]*)\} | (?P<bare>[^\s"'`#;,(){}\[\]<>&|+]+)""", re.VERBOSE)
_PLUS = re.compile(r"[ \t]*\+[ \t]*")
_PLACEHOLDER = re.compile(r"(?i)^(x+|\*+|\.+|-+|<.*>|\{\{.*\}\}|%\w+%|none|null|true|false|undefined|change_?me|"
                          r"placeholder|example\w*|your\w*|insert\w*|todo|redacted|dummy|test)$")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), kind) for kind, pattern, group, least in BASE for m in pattern.finditer(text)
            if len(m.group(group)) >= least]


def sensitivity(name: str) -> float:
    """Of a target name: the most sensitive of its parts or neighbouring parts, unless its last part is about one."""
    parts = [p.lower() for p in _PART.findall(name)]
    if not parts or parts[-1] in ABOUT:
        return 0.0
    pairs = [a + b for a, b in zip(parts, parts[1:])]
    return max(SENSITIVE.get(p, 0.0) for p in [*parts, *pairs])


def strength(literal: str) -> float:
    """Of a literal as a secret, from its length, its characters' entropy and their kinds."""
    return Value.of(literal).strength()


def assignments(text: str):
    """(name, parts) of every assignment; a part is ("literal", start, end) or ("name", name, start, end)."""
    for op in _OPERATOR.finditer(text):
        if op.group() in ("==", "!=", "<=", ">=", "::"):
            continue
        end = op.start()
        while end and text[end - 1] in " \t":
            end -= 1
        if end and text[end - 1] in "\"']":
            end -= 1
            if end and text[end - 1] in "\"'":
                end -= 1
        start = end
        while start and text[start - 1] in _NAME:
            start -= 1
        name = text[start:end].strip("-.")
        if not name or name[0].isdigit():
            continue
        parts, at = [], _BLANK.match(text, op.end()).end()
        while m := _VALUE.match(text, at):
            kind = m.lastgroup
            if kind in ("double", "single"):
                parts.append(("literal", *m.span(kind)))
            elif kind == "braced":
                parts.append(("name", m.group(kind), *m.span(kind)))
            else:
                parts.append(("name", m.group(kind).lstrip("$"), *m.span(kind)))
            plus = _PLUS.match(text, m.end())
            if not plus:
                break
            at = plus.end()
        if parts:
            yield name, parts


class Value:
    """What ``strength`` needs of a text that is put together, without the text: parts may be many, or grow by doubling."""

    __slots__ = ("length", "counts", "short")

    def __init__(self, length: int = 0, counts: Counter | None = None, short: str | None = ""):
        self.length, self.counts, self.short = length, counts or Counter(), short

    @classmethod
    def of(cls, text: str) -> Value:
        return cls(len(text), Counter(text), text if len(text) <= PLACEHOLDER else None)

    def add(self, other: Value) -> None:
        self.length += other.length
        self.counts.update(other.counts)
        both = None if self.short is None or other.short is None else self.short + other.short
        self.short = both if both is not None and len(both) <= PLACEHOLDER else None

    def strength(self) -> float:
        if self.length < SHORTEST or any(c.isspace() for c in self.counts):
            return 0.0
        if self._placeholder():
            return 0.0
        n = self.length
        entropy = -sum(k / n * math.log2(k / n) for k in self.counts.values())
        kinds = sum((any(c.isdigit() for c in self.counts), any(c.isupper() for c in self.counts),
                     any(c.islower() for c in self.counts), any(not c.isalnum() for c in self.counts)))
        return min(1.0, 0.1 * min(n, 16) / 4 + 0.12 * entropy + 0.1 * (kinds - 1))

    def _placeholder(self) -> bool:
        if self.short is not None:
            return bool(_PLACEHOLDER.match(self.short))
        return len(self.counts) == 1 and bool(_PLACEHOLDER.match(next(iter(self.counts))))  # of one character only


def _circles(edges: list[list[int]]) -> list[int]:
    """Of each node a number that it shares with those that it reaches and that reach it."""
    order, low, group, stack, count = [0] * len(edges), [0] * len(edges), [-1] * len(edges), [], 0
    for root in range(len(edges)):
        if order[root]:
            continue
        count += 1
        order[root] = low[root] = count
        stack.append(root)
        path = [(root, iter(edges[root]))]
        while path:
            node, rest = path[-1]
            target = next((t for t in rest if not order[t] or group[t] < 0), None)
            if target is None:
                path.pop()
                if path:
                    low[path[-1][0]] = min(low[path[-1][0]], low[node])
                if low[node] == order[node]:
                    while group[node] < 0:
                        group[stack.pop()] = node
            elif order[target]:
                low[node] = min(low[node], order[target])
            else:
                count += 1
                order[target] = low[target] = count
                stack.append(target)
                path.append((target, iter(edges[target])))
    return group


def strong_values(found: list, text: str) -> set[tuple[int, int]]:
    """Spans of the literals that make up strong values of sensitive names, with constants put in.

    A name means its last assignment before, or else its first one. What leads back to where it is used is left out. Each
    assignment is put together once, whatever uses it.
    """
    places: dict[str, list[int]] = {}
    for i, (name, _) in enumerate(found):
        places.setdefault(name, []).append(i)

    def meant(name: str, i: int) -> int:
        at = places[name]
        before = bisect.bisect_left(at, i)
        return at[before - 1] if before else at[0] if at[0] != i else at[1] if len(at) > 1 else i

    sources = [[meant(p[1], i) if p[0] == "name" and p[1] in places else -1 for p in parts]
               for i, (_, parts) in enumerate(found)]
    edges = [[s for s in own if s >= 0] for own in sources]
    group = _circles(edges)
    used = [[s if s >= 0 and group[s] != group[i] else -1 if s < 0 else None for s in own] for i, own in enumerate(sources)]

    def ordered(roots):
        """What the roots are made of, and they themselves, sources first."""
        done, out = set(), []
        for root in roots:
            path = [] if root in done else [(root, iter(used[root]))]
            done.add(root)
            while path:
                node, rest = path[-1]
                source = next((s for s in rest if s is not None and s >= 0 and s not in done), None)
                if source is None:
                    out.append(path.pop()[0])
                else:
                    done.add(source)
                    path.append((source, iter(used[source])))
        return out

    wanted = [i for i, (name, _) in enumerate(found) if edges[i] and sensitivity(name) > 0]
    value: dict[int, Value] = {}
    for i in ordered(wanted):
        value[i] = Value()
        for part, source in zip(found[i][1], used[i]):
            if source is not None:
                value[i].add(value[source] if source >= 0 else Value.of(text[part[-2]:part[-1]]))
    strong = [i for i in wanted if sensitivity(found[i][0]) * value[i].strength() >= THRESHOLD]
    return {part[-2:] for i in ordered(strong) for part, source in zip(found[i][1], used[i]) if source == -1}


def lexed_spans(text: str) -> list[tuple[int, int]]:
    """Literals that reach a sensitive name, in it or through constants."""
    found = list(assignments(text))
    if not found:
        return []
    reach: dict[str, float] = {}
    known = {name for name, _ in found}
    uses: dict[str, set[str]] = {}
    for name, parts in found:
        for part in parts:
            if part[0] == "name" and part[1] in known and part[1] != name:
                uses.setdefault(part[1], set()).add(name)
    # A constant is as sensitive as the most sensitive name that it is assigned on to.
    for name in known:
        reach[name] = max(reach.get(name, 0.0), sensitivity(name))
    todo = [n for n in known if reach[n] > 0]
    sources: dict[str, set[str]] = {}
    for source, targets in uses.items():
        for target in targets:
            sources.setdefault(target, set()).add(source)
    while todo:
        target = todo.pop()
        for source in sources.get(target, ()):
            if reach[source] < reach[target]:
                reach[source] = reach[target]
                todo.append(source)
    out = set()
    for name, parts in found:
        if reach[name] <= 0:
            continue
        spans = [p[-2:] for p in parts if p[0] == "literal" or p[1] not in known]
        whole = "".join(text[a:b] for a, b in spans)
        if reach[name] * strength(whole) >= THRESHOLD:
            out |= {(a, b) for a, b in spans if b > a}
    return sorted(out | {(a, b) for a, b in strong_values(found, text) if b > a})


def _ordered(spans) -> str:
    rank = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], rank[s[2]], s[1])))


def scan(text: str | None) -> tuple[int, int, int, str, str]:
    """Counts of the base kinds, the hash of the base spans, and all spans."""
    text = text or ""
    base = base_spans(text)
    count = Counter(k for _, _, k in base)
    # spans of one kind do not overlap, so the one that may hold another is the last that begins at or before it
    kinds = {kind: ([a for a, _, k in base if k == kind], [b for _, b, k in base if k == kind]) for kind in count}
    more = [(a, b, "lexed") for a, b in lexed_spans(text) if not any(
        (at := bisect.bisect_right(starts, a)) and b <= ends[at - 1] for starts, ends in kinds.values())]
    return (count["assign"], count["access"], count["hex"], hashlib.sha256(_ordered(base).encode()).hexdigest(),
            _ordered(base + more))


def find_secrets(docs):
    """The documents with n_assign, n_access, n_hex, base_sha256 and spans (``kind:start:end``, comma-joined)."""
    @F.pandas_udf("n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
    def find(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scan(t) for t in texts], columns=names)

    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    out = docs.drop("_found").withColumn("_found", find.asNondeterministic()(F.col("text")))
    return out.withColumns({n: F.col(f"_found.{n}") for n in names}).drop("_found")
