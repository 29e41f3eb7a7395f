"""Secrets in source and configuration text: fixed patterns, and literals assigned to sensitive names.

Wherever a name meets a value, the value is lexed into literals and references. All bindings are collected
first; references are resolved over them, backwards and forwards, and a value is scored with the name it reaches.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auriga.llm.common import map_frames, sliced, text_of

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# Where a name meets a value. Names end possessively, so that no run of letters is read twice.
ASSIGNED = re.compile(
    r"""(?:(?<![\w.$-])|(?<=\s--))(?P<name>[A-Za-z_$][\w.$-]*+)(?:\\?["'](?:[\t\x20]*\])?)?"""
    r"""[\t\x20]*(?P<op>:=|=>|=(?![=~])|:(?![:=/]))[\t\x20]*"""
)
ANNOTATED = re.compile(
    r"""(?<![\w.$-])(?P<name>[A-Za-z_$][\w.$]*+)[\t\x20]*(?::[\t\x20]*[A-Za-z_][\w.<>\[\]|?]*+|[\t\x20]string)[\t\x20]*=(?![=~>])[\t\x20]*"""
)
CALLED = re.compile(r"""(?<![\w$])(?P<name>[A-Za-z_$][\w$]*+)\([\t\x20]*(?=[\w"'`$(])""")
KEYED = re.compile(r"""[(\[][\t\x20]*["'](?P<name>[A-Za-z_$][\w.$-]*+)["'][\t\x20]*,\s*+(?=[\w"'`$(])""")
LISTED = re.compile(
    r"""\b(?:name|key)["']?[\t\x20]*[:=][\t\x20]*["']?(?P<name>[A-Za-z_$][\w.$-]*+)["']?[\s,;]*+["']?value["']?[\t\x20]*[:=][\t\x20]*"""
)
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.-]*)>(?P<value>[^<>\n]+)</(?P=name)>")

# Tokens of a value.
LITERAL = re.compile(
    r"""(?:[rbfuRBFU@]{1,2}(?=["']))?(?:"{3}(?P<a>.*?)"{3}|'{3}(?P<b>.*?)'{3}|"(?P<c>(?:[^"\\\n]++|\\[^\n])*+)"|"""
    r"""'(?P<d>(?:[^'\\\n]++|\\[^\n])*+)'|`(?P<e>[^`\n]*+)`|\\"(?P<f>[^"\\\n]*+)\\")""",
    re.DOTALL,
)
REFERENCE = re.compile(r"\$\{([A-Za-z_][\w.]*)\}|\$?([A-Za-z_][\w.]*+)(?![(\[])")
INSERTED = re.compile(r"\$(?:\{([A-Za-z_][\w.]*)\}|([A-Za-z_]\w*))")
JOIN = re.compile(
    r"""[\t\x20]*+(?:\+|&|\|\||\.\.?(?![A-Za-z_]\w*\())[\t\x20]*+(?:\\?\r?\n[\t\x20]*+)?(?=["'`$A-Za-z_(])|[\t\x20]++(?:\\\r?\n[\t\x20]*+)?(?=["'`])"""
)
# Between brackets a line end is a blank.
WIDE_JOIN = re.compile(r"""\s*+(?:\+|&|\|\||\.\.?(?![A-Za-z_]\w*\())\s*+(?=["'`$A-Za-z_(])|\s++(?=["'`])""")
OPEN, CLOSE = re.compile(r"\(\s*+"), re.compile(r"\s*+\)")
BLOCK = re.compile(r"[|>][+-]?[1-9]?[+-]?[\t\x20]*(?:#[^\n]*)?\r?\n")
LINE = re.compile(r"([\t\x20]*)([^\n]*)(\n|\Z)")
HEREDOC = re.compile(r"""<<[-~]?["']?([A-Za-z_]\w*)["']?[^\n]*(?=\n)""")
# An unquoted value is a literal only where the binding is all its line holds, as in configuration files.
LINE_START = re.compile(r"[\t\x20]*(?:-[\t\x20]+)?(?:(?:export|set|env|const|let|var)[\t\x20]+)?[\"']?")
BARE = re.compile(r"(?!#)([^\s,;\"'`(){}\[\]<>]++)[\t\x20]*+(?=[,;]?[\t\x20]*+(?:#.*|//.*)?(?:\n|\Z|\r))")
AFTER_CALL, AFTER_KEY = re.compile(r"\s*+\)"), re.compile(r"\s*+[),\]]")

# How telling a part of a name is; the strongest part counts, and "key" needs a companion.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "pass": 0.8, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "auth": 0.7, "authorization": 0.8,
    "pin": 0.5, "salt": 0.6, "signature": 0.6, "cert": 0.4, "key": 0.4,
}
KEY_COMPANIONS = {"api", "private", "access", "secret", "signing", "encryption", "master", "auth", "service", "client"}
PLACEHOLDER = re.compile(
    r"(?i)^(?:x+|\*+|\.+|-+|change_?me|your[_-].*|example.*|sample.*|dummy.*|test|none|null|true|false|todo|password|secret|token|<.*>|\{\{.*\}\}|\$\{.*\}|%\(.*\)s)$"
)
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
THRESHOLD = 0.5
# A call binds its argument to its name if it starts with one of these, or if all of the name is telling.
SETTERS = {"set", "with", "add", "use", "put", "assign", "update"}
# Secrets with one of these names are often several words.
PHRASES = {"passphrase", "mnemonic"}
# Placeholders are short: a longer value is none.
LONGEST_PLACEHOLDER = 256


class Part(NamedTuple):
    """A token of a value: the literal between two places, or a reference to a name."""

    start: int
    end: int
    name: str | None = None


class Binding(NamedTuple):
    """A name and the parts of its value; `bare`, if given, is its value where a part refers to nothing."""

    at: int
    name: str
    parts: list[Part]
    bare: Part | None = None


class Profile(NamedTuple):
    """What the score of a value needs: its length, the share of each character, and how it starts."""

    length: float
    shares: dict[str, float]
    head: str


def name_score(name: str) -> float:
    """0 to 1: how likely a name holds a secret, from its parts in snake, kebab, dotted or camel case."""
    parts = [p.lower() for p in PARTS.findall(name)]
    best = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    joined = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    if joined & SENSITIVE.keys() or ("key" in parts and KEY_COMPANIONS & set(parts)):
        best = 1.0
    return best


def literal_score(value: str, phrase: bool = False) -> float:
    """0 to 1: length, entropy and kinds of characters; placeholders and very short values score 0.

    Blanks halve the score unless a phrase is expected.
    """
    return profile_score(profile(value), phrase)


def profile(value: str) -> Profile:
    counts = Counter(value)
    return Profile(len(value), {c: n / len(value) for c, n in counts.items()}, value[: LONGEST_PLACEHOLDER + 1])


def join_profiles(profiles: list[Profile]) -> Profile:
    """Profile of a concatenation; lengths stop at 1e300, so that a constant may double itself at will."""
    if len(profiles) == 1:
        return profiles[0]
    length = sum(p.length for p in profiles)
    shares: dict[str, float] = defaultdict(float)
    head = ""
    for p in profiles:
        for c, share in p.shares.items():
            shares[c] += share * (p.length / length)
        if len(head) <= LONGEST_PLACEHOLDER:
            head += p.head
    return Profile(min(length, 1e300), dict(shares), head[: LONGEST_PLACEHOLDER + 1])


def profile_score(p: Profile, phrase: bool = False) -> float:
    if p.length < 6 or (p.length <= LONGEST_PLACEHOLDER and PLACEHOLDER.match(p.head)):
        return 0.0
    entropy = -sum(share * math.log2(share) for share in p.shares.values() if share > 0)
    kinds = len({"a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "" for c in p.shares})
    spread = min(1.0, entropy / 3.0)
    halved = not phrase and any(c.isspace() for c in p.shares)
    return min(1.0, 0.35 + 0.5 * spread + 0.1 * (kinds - 1)) * (0.5 if halved else 1.0)


def pair_score(name: str, value: Profile) -> float:
    """How likely a value of this profile, bound to this name, is a secret."""
    named = name_score(name)
    if named and value.head.startswith("-----BEGIN") and "PRIVATE KEY" in value.head:
        return 1.0
    parts = {p.lower() for p in PARTS.findall(name)}
    return named and named * profile_score(value, bool(PHRASES & parts) or {"private", "key"} <= parts)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the three fixed patterns, leftmost and not overlapping within a kind."""
    found = [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    if ":" in text or "=" in text:
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return found


def bindings(text: str) -> list[Binding]:
    """Every name that meets a value, by place: assignments, pairs of configuration files, quoted keys and
    arguments, calls that set, and elements. Names inside literals count too, as in JSON in a string."""
    found = []
    if "=" in text or ":" in text:
        found += _assigned(text)
    if "=" in text:
        found += _closed(text, ANNOTATED)
    if "value" in text:
        found += _closed(text, LISTED, bare=True)
    if "(" in text:
        found += [b for b in _closed(text, CALLED, AFTER_CALL) if _sets(b.name)]
    if "," in text:
        found += _closed(text, KEYED, AFTER_KEY)
    if "</" in text:
        found += [Binding(m.start(), m["name"], [Part(*m.span("value"))]) for m in ELEMENT.finditer(text)]
    return sorted(found, key=lambda b: b.at)


def resolve(found: list[Binding]) -> list[list[Part | int] | None]:
    """Per binding its parts, references replaced by the number of the binding they mean: the last of that name
    before, else the first after. None where a part refers to nothing and there is no bare value."""
    places: dict[str, list[int]] = defaultdict(list)
    for number, b in enumerate(found):
        places[b.name].append(number)

    def target(name: str, number: int) -> int | None:
        same = places.get(name)
        if not same:
            return None
        before = bisect_left(same, number)
        after = same[before + 1 : before + 2] if same[before : before + 1] == [number] else same[before : before + 1]
        return same[before - 1] if before else (after[0] if after else None)

    resolved = []
    for number, b in enumerate(found):
        parts = [target(p.name, number) if p.name else p for p in b.parts]
        if None not in parts:
            resolved.append(parts)
        else:
            resolved.append([b.bare] if b.bare else None)
    return resolved


def profiles(text: str, parts: list[list[Part | int] | None], wanted: list[int]) -> dict[int, Profile | None]:
    """Profile of every binding that the wanted ones need; None where it has none or refers to itself.

    Walks references with a stack of its own; a binding met again while it is open closes a cycle.
    """
    known: dict[int, Profile | None] = {}
    opened: set[int] = set()
    stack = list(wanted)
    while stack:
        number = stack[-1]
        if number in known:
            stack.pop()
            continue
        needed = [p for p in parts[number] or () if isinstance(p, int)]
        if number not in opened:
            opened.add(number)
            for other in needed:
                if other in opened and other not in known:
                    known[other] = None
            stack += [n for n in needed if n not in known]
            continue
        stack.pop()
        if parts[number] is None or any(known[n] is None for n in needed):
            known[number] = None
        else:
            known[number] = join_profiles(
                [known[p] if isinstance(p, int) else profile(text[p.start : p.end]) for p in parts[number]]
            )
    return known


def literal_spans(text: str) -> list[tuple[int, str, int]]:
    """Literals that reach a sensitive name, directly or through constants, and look like a secret."""
    found = bindings(text)
    wanted = [n for n, b in enumerate(found) if name_score(b.name)]
    if not wanted:
        return []
    parts = resolve(found)
    known = profiles(text, parts, wanted)
    reached = [n for n in wanted if known[n] and pair_score(found[n].name, known[n]) >= THRESHOLD]
    seen, spans = set(reached), set()
    while reached:
        for part in parts[reached.pop()]:
            if isinstance(part, Part):
                if part.end > part.start:
                    spans.add((part.start, "literal", part.end))
            elif part not in seen:
                seen.add(part)
                reached.append(part)
    return sorted(spans)


def all_spans(text: str) -> list[tuple[int, str, int]]:
    """Base spans, and the literals that none of them covers, by start, then kind, then end."""
    base = base_spans(text)
    extra, ends = [], sorted((start, end) for start, _, end in base)
    at, furthest = 0, -1
    for span in literal_spans(text):
        while at < len(ends) and ends[at][0] <= span[0]:
            furthest = max(furthest, ends[at][1])
            at += 1
        if furthest < span[2]:
            extra.append(span)
    return sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def secrets(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document row: doc_id, spans (array of kind, start, end; code points, end exclusive).

    Whole texts; a null text is empty and has no spans. Repeated rows repeat. Other columns are ignored.
    An empty table gives no rows. Rows are independent: no shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sliced(batches):
            spans = [
                [{"kind": kind, "start": start, "end": end} for start, kind, end in all_spans(text)]
                for text in batch["text"]
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": pd.Series(spans, dtype=object)})

    rows = documents.select(F.col(id_column).cast("bigint").alias("doc_id"), text_of(text_column).alias("text"))
    return map_frames(rows, run, "doc_id bigint, spans array<struct<kind:string,start:int,end:int>>")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _assigned(text: str) -> Iterator[Binding]:
    """Names before an operator, with quoted, bare, block or here-document values."""
    line, lead, newline = 0, LINE_START.match(text, 0).end(), text.find("\n")
    unclosed: set[str] = set()
    for match in ASSIGNED.finditer(text):
        start = match.start("name")
        while 0 <= newline < start:
            line, newline = newline + 1, text.find("\n", newline + 1)
            lead = LINE_START.match(text, line).end()
        at = match.end()
        if match["op"] == ":" and (block := BLOCK.match(text, at)):
            value = _block(text, line, block.end())
        elif heredoc := HEREDOC.match(text, at):
            value = _heredoc(text, heredoc, unclosed)
        else:
            bare = BARE.match(text, at) if lead == start else None
            parts, bare = _expression(text, at, bare)[1:]
            if parts:
                yield Binding(start, match["name"], parts, bare)
            continue
        if value:
            yield Binding(start, match["name"], [value])


def _closed(text: str, form: re.Pattern, after: re.Pattern | None = None, bare: bool = False) -> Iterator[Binding]:
    """Names of one form, whose value is followed by what closes it."""
    for match in form.finditer(text):
        end, parts, literal = _expression(text, match.end(), BARE.match(text, match.end()) if bare else None)
        if parts and (after is None or after.match(text, end)):
            yield Binding(match.start("name"), match["name"], parts, literal)


def _expression(text: str, at: int, bare: re.Match | None) -> tuple[int, list[Part], Part | None]:
    """Where the value that starts here ends, its parts (none if it is no literal, name or concatenation of them),
    and its bare reading, if it has one."""
    literal = Part(*bare.span(1)) if bare else None
    parts, depth = [], 0
    while True:
        while opened := OPEN.match(text, at):
            depth, at = depth + 1, opened.end()
        if quoted := LITERAL.match(text, at):
            start, end = quoted.span(quoted.lastgroup)
            inserted = INSERTED.fullmatch(text, start, end)
            parts.append(Part(start, end, inserted and (inserted[1] or inserted[2])))
            at = quoted.end()
        elif named := REFERENCE.match(text, at):
            parts.append(Part(*named.span(), named[1] or named[2]))
            at = named.end()
        else:
            return (at, [], None) if literal is None else (literal.end, [literal], None)
        while depth and (closed := CLOSE.match(text, at)):
            depth, at = depth - 1, closed.end()
        joined = (WIDE_JOIN if depth else JOIN).match(text, at)
        if not joined:
            break
        at = joined.end()
    if literal and at < literal.end:
        return literal.end, [literal], None
    return at, parts, literal


def _block(text: str, line: int, at: int) -> Part | None:
    """The indented lines from here on that lie deeper than the line that announces them."""
    depth, first, last = len(LINE.match(text, line)[1]), None, None
    while at < len(text):
        found = LINE.match(text, at)
        if found[2].strip():
            if len(found[1]) <= depth:
                break
            first = found.start(2) if first is None else first
            last = found.start(2) + len(found[2].rstrip())
        at = found.end()
    return None if first is None else Part(first, last)


def _heredoc(text: str, opened: re.Match, unclosed: set[str]) -> Part | None:
    """The lines up to the tag; a tag that is not found once is not sought again."""
    tag = opened[1]
    closed = None if tag in unclosed else re.compile(rf"\n[\t\x20]*{tag}[\t\x20]*(?=\r?\n|\Z)").search(text, opened.end())
    if closed is None:
        unclosed.add(tag)
        return None
    return Part(min(opened.end() + 1, closed.start()), closed.start())


def _sets(name: str) -> bool:
    """Does a call of this name take a secret, instead of looking one up?"""
    parts = [p.lower() for p in PARTS.findall(name)]
    return bool(parts) and (parts[0] in SETTERS or all(p in SENSITIVE or p in KEY_COMPANIONS for p in parts))
