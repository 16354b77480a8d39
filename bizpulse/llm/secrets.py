"""Secrets in texts: single patterns, and credentials that come in several parts.

Access identifiers, secret values and endpoints are joined as intervals: two parts of different roles are linked when the
gap between them is at most `reach` code points and they lie in one scope. Scopes are sections (a header line in brackets, a
YAML document, an object of a list) and, for identifiers and secrets, blocks: a new one begins where the role that opened
the block comes again after the other role, so a list of pairs links each with its own. The join is a sweep over one text's
parts in order of place that keeps the parts still in reach, so it is linear in the parts. Parts that are weak alone (a bare value of high entropy, an endpoint)
are reported only when a part of another role is in reach of themselves.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizpulse.llm.common import free_name, text_batches

#: Base kinds in their order: pattern, length of the match (of group 2 for assign) from which it counts.
BASE = {
    "assign": (re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 20),
    "hex": (re.compile("[0-9a-f]{24,}"), 24),  # runs of [0-9a-f]+ that are long enough
}
#: Weak parts, then the kind of a whole credential.
#: A value may begin after '=', ':' or a quote and end before '.', ',' or ';'.
VALUE = re.compile(r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/]{20,}+={0,2}+(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"(?a:\bhttps?://[A-Za-z0-9.-]+|(?<![a-z0-9.-])[a-z0-9.-]+\.amazonaws\.com\b|\b(?:jdbc|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9.:/@_-]+)")
#: Addresses of any scheme with a password: group 1 is user:password. It ends at the last '@' before a slash, else at the first
#: '@' after one, unless what looks like a password is a port. No length has a bound; a search ends at a blank, a quote or "://".
LOGIN = re.compile(
    r"""(?a:(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://([^\s/@:"'<>]*+:(?:[^\s/"'<>]+|(?![0-9]{1,5}/)(?:(?!://)[^\s"'<>])+?))@[A-Za-z0-9.:/@_-]*)"""
)
#: Where one section ends and another begins: a header line in brackets, a line of dashes, the next object of a list.
SECTION = re.compile(r"^[\x20\t]*+(?:\[[^\[\]\n]++\][\x20\t\r]*+$|---)|\}\s*+(?:,\s*+)?\{", re.M)
KINDS = ("assign", "access", "hex", "value", "endpoint", "credential")
_RANK = {kind: i for i, kind in enumerate(KINDS)}
MARK = "[SECRET]"
REACH = 200
ENTROPY = 4.0

#: Kind, start, end, score, starts of what it is linked with.
Span = tuple[str, int, int, float, list[int]]
#: Role, kind, start, end.
Part = tuple[str, str, int, int]


def _entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def _is_value(match: str) -> bool:
    """Whether a match of VALUE looks random: entropy, whole base64 where it is padded, and, unless it has the 40 characters of
    a secret access key, capitals, small letters and digits, which joined words and paths seldom have all."""
    plain = match.rstrip("=")
    if len(plain) < len(match) and len(match) % 4:
        return False
    mixed = len(plain) == 40 or all(re.search(c, plain) for c in ("[A-Z]", "[a-z]", "[0-9]"))
    return mixed and _entropy(plain) >= ENTROPY


def base_spans(text: str) -> list[Span]:
    spans = []
    for kind, (pattern, least) in BASE.items():
        for m in pattern.finditer(text):
            if len(m.group(2) if kind == "assign" else m.group()) >= least:
                spans.append((kind, m.start(), m.end(), 1.0, []))
    return spans


def _apart(spans: list[Span]):
    """Whether an interval is apart from all spans: among merged spans in order, only the last that starts before its end counts."""
    merged: list[list[int]] = []
    for start, end in sorted((s[1], s[2]) for s in spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    starts = [start for start, _ in merged]

    def apart(start: int, end: int) -> bool:
        last = bisect_left(starts, end) - 1
        return last < 0 or merged[last][1] <= start

    return apart


def _logins(text: str) -> list[re.Match]:
    return list(LOGIN.finditer(text)) if "://" in text and "@" in text else []


def _parts(text: str, base: list[Span], logins: list[re.Match]) -> list[Part]:
    """Base spans, addresses with a password, and weak parts apart from them, in order of place; weak endpoints only if another
    role is there."""
    parts: list[Part] = [("id" if s[0] == "access" else "secret", *s[:3]) for s in base]
    apart = _apart(base)
    for m in VALUE.finditer(text):
        if apart(*m.span()) and _is_value(m.group()):
            parts.append(("secret", "value", *m.span()))
    if parts and ("://" in text or ".amazonaws.com" in text):
        apart = _apart(base + [("endpoint", *m.span(), 1.0, []) for m in logins])
        parts += (("endpoint", "endpoint", *m.span()) for m in ENDPOINT.finditer(text) if apart(*m.span()))
    parts += (("endpoint", "endpoint", *m.span()) for m in logins)
    return sorted(parts, key=lambda p: (p[2], p[3], p[1]))


def _scopes(text: str, parts: list[Part]) -> list[tuple[int, int]]:
    """For each part its section and its block: see the module. Endpoints belong to their section only and have block -1."""
    starts = [m.start() for m in SECTION.finditer(text)] if len(parts) > 1 else []
    out, block, at = [], 0, 0
    leads, seen = "", False  # the role that opened the block, and whether the other one has come
    for role, _, start, _ in parts:
        section = bisect_left(starts, start + 1)
        if section != at:
            at, block, leads, seen = section, block + 1, "", False
        if role == "endpoint":
            out.append((section, -1))
            continue
        if role == leads and seen:
            block, leads, seen = block + 1, "", False
        leads, seen = leads or role, seen or (leads != "" and role != leads)
        out.append((section, block))
    return out


def _linkable(a: tuple[int, int], b: tuple[int, int]) -> bool:
    return a[0] == b[0] and (a[1] == b[1] or a[1] < 0 or b[1] < 0)


def _links(parts: list[Part], scopes: list[tuple[int, int]], reach: int) -> list[list[int]]:
    """For each part the numbers of the parts of other roles in reach and scope, in order of place."""
    links: list[list[int]] = [[] for _ in parts]
    near: list[int] = []
    for i, (role, _, start, _) in enumerate(parts):
        near = [k for k in near if parts[k][3] + reach >= start]
        for k in near:
            if parts[k][0] != role and _linkable(scopes[k], scopes[i]):
                links[k].append(i)
                links[i].append(k)
        near.append(i)
    return links


def linked_spans(text: str, base: list[Span], reach: int = REACH) -> list[Span]:
    """Weak parts with a complement in reach and addresses with a password, then a whole credential for each linked pair of an
    identifier and a secret, both in order of place. The base spans' own links are filled in."""
    logins = _logins(text)
    alone = {m.span() for m in logins}
    parts = _parts(text, base, logins)
    links = _links(parts, _scopes(text, parts), reach)
    near = [[parts[e][2] for e in own if parts[e][0] == "endpoint"] for own in links]
    own = {(s[0], s[1], s[2]): s for s in base}
    weak: list[Span] = []
    whole: list[Span] = []
    for i, (role, kind, start, end) in enumerate(parts):
        starts = [parts[k][2] for k in links[i]]
        if kind in BASE:
            own[kind, start, end][4][:] = starts
        elif starts or (kind == "endpoint" and (start, end) in alone):
            roles = {role} | {parts[k][0] for k in links[i]} | ({"secret"} if (start, end) in alone else set())
            weak.append((kind, start, end, 0.6 + 0.2 * (len(roles) - 1), starts))
        for k in links[i] if role == "id" else ():
            other, _, from_, to = parts[k]
            if other == "secret":
                ends = sorted({*near[i], *near[k]})
                whole.append(("credential", min(start, from_), max(end, to), 1.0 if ends else 0.8, [start, from_, *ends]))
    return weak + sorted(whole, key=lambda s: s[1:3])


_SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double, links: array<bigint>>>"


def _spans(text: str | None, reach: int) -> list[Span]:
    """All spans of a text, by start, then kind."""
    if not text:
        return []
    spans = base_spans(text)
    spans += linked_spans(text, spans, reach)
    return sorted(spans, key=lambda s: (s[1], _RANK[s[0]], s[2]))


def _arrays(found: list[list[Span]]) -> pa.Array:
    counts = [0, *accumulate(map(len, found))]
    kinds, starts, ends, scores, links = zip(*(s for own in found for s in own)) if counts[-1] else ((), (), (), (), ())
    values = pa.StructArray.from_arrays(
        [
            pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(scores, pa.float64()),
            pa.array(links, pa.list_(pa.int64())),
        ],
        ["kind", "start", "end", "score", "links"],
    )
    return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)


def _found(reach: int):
    @F.arrow_udf(_SPANS)
    def found(texts: pa.Array) -> pa.Array:
        return _arrays([_spans(text, reach) for text in texts.to_pylist()])

    return found


def _found_and_redacted(reach: int, mark: str):
    @F.arrow_udf(f"struct<secrets: {_SPANS}, redacted: string>")
    def both(texts: pa.Array) -> pa.Array:
        told = texts.to_pylist()
        found = [_spans(text, reach) for text in told]
        clean = [_covered(text, [s[:3] for s in own], mark) for text, own in zip(told, found)]
        return pa.StructArray.from_arrays([_arrays(found), pa.array(clean, pa.string())], ["secrets", "redacted"])

    return both


def find_secrets(docs: DataFrame, text_col: str = "text", reach: int = REACH, redacted: str | None = None, mark: str = MARK) -> DataFrame:
    """Add `secrets`, an array of (kind, start, end, score, links) in code points, end exclusive, by start, then kind.

    Kinds assign, access and hex are base spans: all matches of their patterns that are long enough; a shorter match is
    dropped and its characters are not tried again. Kinds value and endpoint are weak parts with a part of another role
    (identifier, secret, endpoint) in their scope at a gap of at most `reach`; an endpoint that carries a password stands alone. A
    credential is a linked pair of identifier and secret.
    `links` has the starts of a part's complements in reach, for a credential those of its identifier, its secret and the
    endpoints of either. Null or empty text: an empty array. Repeated rows are reported each. A column named `secrets` is
    replaced.

    With `redacted`, a column of that name (`text_col` itself may be named) has the text as `redact` gives it. Both come from one
    pass: `redact` on the result is a second one, and every task of such a plan holds two Python workers.
    """
    text_batches(docs.sparkSession)
    if redacted is None:
        return docs.drop("secrets").withColumn("secrets", _found(reach)(F.col(text_col)))
    both = free_name(docs, "_both")
    docs = docs.withColumn(both, _found_and_redacted(reach, mark)(F.col(text_col)))
    return docs.withColumns({"secrets": F.col(both)["secrets"], redacted: F.col(both)["redacted"]}).drop(both)


def redact(text: Column, spans: Column, mark: str = MARK) -> Column:
    """`text` with every stretch that base spans, bare values or an endpoint's user and password cover replaced by `mark`; other
    text stays."""
    return _redacted(mark)(text, spans)


def _covered(text: str | None, spans: list[tuple[str, int, int]], mark: str) -> str | None:
    """`text` with the marks; spans are (kind, start, end)."""
    if not text or not spans:
        return text
    parts, at = [], 0
    covered = [(start, end) for kind, start, end in spans if kind not in ("endpoint", "credential")]
    ends = {(start, end) for kind, start, end in spans if kind == "endpoint"}
    covered += (m.span(1) for m in (_logins(text) if ends else ()) if m.span() in ends)
    for start, end in sorted(covered):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _redacted(mark: str):
    @F.arrow_udf("string")
    def redacted(texts: pa.Array, spans: pa.Array) -> pa.Array:
        own = ([(s["kind"], s["start"], s["end"]) for s in found or ()] for found in spans.to_pylist())
        return pa.array([_covered(text, found, mark) for text, found in zip(texts.to_pylist(), own)], pa.string())

    return redacted
