"""Secret scans with multipart credential linking.

Base kinds (assign, access, hex) are reported wherever they stand.  Weaker candidates are
reported only when complementary parts of a credential co-occur: parts take the roles
*identifier*, *secret* and *endpoint*, a scope is a block of text between blank lines,
and an interval join within the scope links an identifier or an endpoint to every secret that lies at
most ``reach`` characters away (to an endpoint only secrets outside of all endpoints: a path is
no second part).  From there a link goes on through all parts of the scope, each within reach of the one before, so
that a key of many lines is taken whole, however long.

The join is a semi-join of sorted spans inside the document (which parts have a partner, not which pairs
there are), so its work follows the number of parts; it runs in one map over the text without a shuffle.

Defined cases: null and empty texts have no findings; every row is scanned by itself, so
repeated rows, repeated or null ids are fine; whole texts are scanned, however long;
equal starts are ordered by kind; an empty table gives an empty result; other columns are kept,
but one named like the output is replaced by it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from brook.llm.slices import map_text

#: Kinds in report order, and their patterns (the least length is checked on the match).
KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
IDENTIFIER = re.compile(
    r"""(?ai:user(?:name|_?id)?|login|account|client_?id|access_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)|(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"""
)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(r"(?a:\b[a-z][a-z0-9+]*://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+)|(?<![A-Za-z0-9.-])[a-z0-9-]+(?:\.[a-z0-9-]+)+:[0-9]{2,5}(?![0-9])")
#: A line of a key after one of at least ``KEY_LINE`` characters (line ends may be escaped, as in JSON).
KEY_LINE = 60
NEXT_LINE = re.compile(r"""(?:\r?\n[\x20\x09]*|\\n)([A-Za-z0-9+/_]+={0,2})(?=[\r\n\\"']|\Z)""")
BLANK_LINE = re.compile(r"\n[\x20\x09\x0D]*\n")

FINDINGS = "array<struct<kind:string,start:int,end:int>>"
ROLE = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "identifier", "identifier": "identifier", "endpoint": "endpoint"}
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def _is_opaque(token: str) -> bool:
    """Digits and letters of both cases, as in generated keys and hardly in words."""
    return any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)


def _opaque_spans(text: str) -> list[Span]:
    """Generated tokens, and the lines that carry on a key of full lines: short ones or without a digit."""
    found = {m.span() for m in OPAQUE.finditer(text) if _is_opaque(m.group())}
    ends = {e for _, e in found}
    for start, end in sorted(found):
        while end - start >= KEY_LINE and (m := NEXT_LINE.match(text, end)) and m.end(1) not in ends:
            start, end = m.span(1)
            found.add((start, end))
            ends.add(end)
    return [("opaque", *x) for x in sorted(found)]


def weak_spans(text: str) -> list[Span]:
    found = [("identifier", *m.span()) for m in IDENTIFIER.finditer(text)]
    found += _opaque_spans(text)
    return found + [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]


def interval_join(left: list[Span], right: list[Span], scopes: list[int], reach: int) -> set[Span]:
    """The spans of either side that have one of the other in their scope, at most ``reach`` characters away.

    No span holds a scope's border.  A scope's spans are sorted by start, with the greatest end so far: those that
    start early enough are a prefix, and one of them reaches far enough where its greatest end does.
    """
    return _met(left, right, scopes, reach) | _met(right, left, scopes, reach)


def _met(spans: list[Span], others: list[Span], scopes: list[int], reach: int) -> set[Span]:
    by_scope: dict[int, tuple[list[int], list[int]]] = {}
    for _, start, end in sorted(others, key=lambda x: x[1]):
        starts, ends = by_scope.setdefault(bisect_left(scopes, start), ([], []))
        starts.append(start)
        ends.append(max(end, ends[-1]) if ends else end)
    found = set()
    for span in spans:
        starts, ends = by_scope.get(bisect_left(scopes, span[1]), ((), ()))
        before = bisect_right(starts, span[2] + reach)
        if before and ends[before - 1] >= span[1] - reach:
            found.add(span)
    return found


def _between(scopes: list[int], lo: int, hi: int) -> list[int]:
    return scopes[bisect_left(scopes, lo) : bisect_left(scopes, hi)]


def scan(text: str | None, reach: int = 200) -> list[Span]:
    """All findings of a text, ordered by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    weak = weak_spans(text)
    if weak:
        weak = _outside(weak, base)  # a base finding says it already
    if weak:
        weak = _linked(text, base, weak, reach)
    return sorted(base + weak, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _outside(spans: list[Span], taken: list[Span]) -> list[Span]:
    """The spans that overlap none of ``taken``."""
    starts, ends = [], []
    for _, s, e in sorted(taken, key=lambda x: x[1]):  # their union, as disjoint stretches
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    first = lambda x: bisect_left(starts, x[2]) - 1  # noqa: E731 - the last stretch that begins before the span ends
    return [x for x in spans if first(x) < 0 or ends[first(x)] <= x[1]]


def _linked(text: str, base: list[Span], weak: list[Span], reach: int) -> list[Span]:
    roles: dict[str, list[Span]] = {"identifier": [], "secret": [], "endpoint": []}
    for span in sorted(base + weak, key=lambda x: (x[1], x[2])):
        roles[ROLE[span[0]]].append(span)
    if not (roles["secret"] and (roles["identifier"] or roles["endpoint"])):
        return []
    scopes = [m.start() for m in BLANK_LINE.finditer(text)]
    apart = _outside(roles["secret"], roles["endpoint"])
    linked = interval_join(roles["identifier"], roles["secret"], scopes, reach) | interval_join(roles["endpoint"], apart, scopes, reach)
    taken = {x for run in _runs(base + weak, scopes, reach) if not linked.isdisjoint(run) for x in run}
    return [w for w in weak if w in taken]


def _runs(parts: list[Span], scopes: list[int], reach: int) -> Iterator[list[Span]]:
    """Parts of one scope, each at most ``reach`` characters behind those before."""
    run, end = [], 0
    for part in sorted(parts, key=lambda x: (x[1], x[2])):
        if run and (part[1] - end > reach or _between(scopes, end, part[1])):
            yield run
            run = []
        end = max(end, part[2]) if run else part[2]
        run.append(part)
    if run:
        yield run


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """``text`` with the union of the spans replaced by ``mark``."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, text: str = "text", reach: int = 200, findings: str = "findings") -> DataFrame:
    """``docs`` plus ``findings``: kind, start and end (code points, end exclusive) of every span."""

    as_rows = lambda texts: [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t, reach)] for t in texts]
    return map_text(docs, text, as_rows, findings, StructType.fromDDL(f"x {FINDINGS}")["x"].dataType)


def redact_documents(docs: DataFrame, text: str = "text", reach: int = 200) -> DataFrame:
    """``docs`` with every finding replaced in the text; null texts stay null."""

    return map_text(docs, text, lambda texts: [redact(t, scan(t, reach)) if t else t for t in texts], text, StringType())


def spans_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(found: DataFrame, findings: str = "findings") -> list[Column]:
    """Counts of the base kinds, their hash, and all spans as text."""
    count = lambda k: F.size(F.filter(found[findings], lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter(found[findings], lambda x: x["kind"].isin(*KINDS[:3]))
    return [*map(count, KINDS[:3]), F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(found[findings]).alias("spans")]
