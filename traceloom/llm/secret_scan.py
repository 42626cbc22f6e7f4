"""Secret scan: fixed patterns, and assignments found by lexing source and configuration syntax.

The lexer reads ``name <op> expression`` pairs as they occur in source code, shell, INI, YAML, JSON and call arguments.
An expression is a chain of string literals, bare words and names joined by ``+`` or ``.``; names that an earlier
assignment of the same text bound to a literal are replaced by that literal's place (constant propagation, in text order,
last binding wins). A literal is scored by how sensitive the target name is, times how much the value looks like a secret.
A value with a blank inside isn't reported, since messages and labels bear the same names (``password = "enter your password"``); so a passphrase
of several words is found only where a fixed pattern finds it.
Work and memory are linear in a text's length: places are kept instead of values, and a bare word in which assignments nest
is read once.

Rows: a null text counts as empty and has no spans. Repeated rows give repeated results. Only the id and text columns are
read, so other columns of any name do no harm. Very long texts are scanned whole.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from traceloom.llm.registry import query
from traceloom.llm.store import small_batches
from traceloom.sources.tables import read_table

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
TRIGGERS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Name parts and how sensitive each makes a target, 0 to 1.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "auth": 0.7, "bearer": 0.9, "private": 0.6, "key": 0.6, "access": 0.4, "api": 0.4, "client": 0.2, "signing": 0.6,
    "encryption": 0.6, "salt": 0.6, "dsn": 0.6, "conn": 0.3, "session": 0.5, "cookie": 0.5, "pin": 0.4, "license": 0.3,
}
PLACEHOLDERS = re.compile(r"(?i)(?:x+|\*+|none|null|true|false|changeme|example|\.+|-+)\Z|your[-_]")
# how values that stand for others begin and end
STANDINS = [("<", ">"), ("${", "}"), ("%(", ")s")]
# a name starts where no longer one could have: a long run of letters is tried once
TARGET = r"""(?<![A-Za-z0-9_$.>:-])([A-Za-z_$][A-Za-z0-9_$]*+(?:(?:\.|->|::|-)[A-Za-z_$][A-Za-z0-9_$]*+|\[["'][A-Za-z0-9_.-]++["']\])*+)["'`]?"""
#: An assignment ends at its operator; what follows is read as an expression.
ASSIGNMENT = re.compile(TARGET + r"[\x20\t]*+(?::=|=>|=(?!=)|:(?![/:]))[\x20\t]*+")
ATOM = re.compile(
    r""""((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`|([A-Za-z_$][A-Za-z0-9_$]*+(?:(?:\.|->|::)[A-Za-z_$][A-Za-z0-9_$]*+)*+)(?![A-Za-z0-9+/=_.~@#-])"""
)
#: A bare word; many assignments may lie in one, so its end is looked up once.
BARE = re.compile(r"[A-Za-z0-9+/_.=~@#-]++")
CALL = re.compile(r"[\x20\t]*+\(")
JOIN = re.compile(r"[\x20\t]*+[+][\x20\t]*+")
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
LETTER_OR = re.compile(r"[:=]")
#: Least score of a literal that is reported.
THRESHOLD = 0.5


@lru_cache(10_000)
def sensitivity(name: str) -> float:
    """How sensitive a target name is: one minus the product of one minus its parts' weights."""
    parts = [p.lower() for p in CAMEL.findall(name)]
    pairs = ["".join(p) for p in zip(parts, parts[1:], strict=False)]
    rest = 1.0
    for p in parts + pairs:
        rest *= 1 - SENSITIVE.get(p, 0.0)
    return 1 - rest


def likeness(counts: Counter, size: int) -> float:
    """How much a value of ``size`` characters, counted, looks like a secret: by length, character classes and entropy."""
    if size < 6:
        return 0.0
    entropy = math.log2(size) - sum(c * math.log2(c) for c in counts.values()) / size
    kinds = {"a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "." for c in counts}
    return min(1.0, entropy / 3.5) * (0.5 + 0.5 * min(1.0, (len(kinds) - 1) / 2)) if kinds else 0.0


def placeholder(text: str, s: int, e: int) -> bool:
    """Whether a value only stands for another. The whole value counts, without a copy of it."""
    return PLACEHOLDERS.match(text, s, e) is not None or any(text.startswith(a, s, e) and text.endswith(b, s, e) for a, b in STANDINS)


def scored(text: str, places: list[tuple[float, int, int]]) -> list[tuple[int, int]]:
    """The places whose weight times likeness reaches THRESHOLD. Places that end together, as values within one bare word,
    are counted from the shortest on, so each character is counted once."""
    out, by_end = [], {}
    for w, s, e in places:
        if w >= THRESHOLD and e - s >= 6:
            by_end.setdefault(e, {}).setdefault(s, 0.0)
            by_end[e][s] = max(by_end[e][s], w)
    for e, starts in by_end.items():
        counts, done = Counter(), e
        for s in sorted(starts, reverse=True):
            counts.update(text[s:done])
            done = s
            if counts[" "] and " " in text[s:e].strip():
                continue
            if starts[s] * likeness(counts, e - s) >= THRESHOLD and not placeholder(text, s, e):
                out.append((s, e))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    found = []
    lower = text.lower()
    if any(t in lower for t in TRIGGERS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # a run that is long enough is the whole run: nothing before it matches
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def literals(text: str) -> list[tuple[float, int, int]]:
    """(sensitivity, start, end) of every literal that an assignment gives its target: the largest sensitivity of all
    targets that it reaches, constants propagated. Only places are kept: assignments hold the numbers of those they use."""
    bound: dict[str, int] = {}
    found: list[tuple[str, list[tuple[int, int]], list[int]]] = []
    at = bare_end = 0
    while m := ASSIGNMENT.search(text, at):
        at = m.end()
        parts, used, pos = [], [], at
        again = at  # where to look for the next assignment, which an unquoted first value may itself hold
        while True:
            first = not parts and not used
            a = ATOM.match(text, pos)
            kind = a.lastindex if a else 5
            if a:
                pos = a.end()
            else:
                if bare_end <= pos:
                    b = BARE.match(text, pos)
                    if not b:
                        break
                    bare_end = b.end()
                start, pos = pos, bare_end
            if kind <= 3:
                parts.append((a.start(kind), a.end(kind)))
            elif kind == 5:
                parts.append((start, pos))
            elif a[4] in bound:
                used.append(bound[a[4]])
            elif CALL.match(text, pos):
                break  # a call's result isn't a constant
            else:
                parts.append((a.start(4), pos))
            if first and (kind <= 3 or used):
                again = pos
            if not (j := JOIN.match(text, pos)):
                break
            pos = j.end()
        if parts or used:
            bound[m[1]] = len(found)
            found.append((m[1], parts, used))
            at = max(again, at) if again == at or len(parts) + len(used) == 1 else max(again, pos)
    # later assignments first: what they use gets their sensitivity
    weight = [sensitivity(name) for name, _, _ in found]
    for k in range(len(found) - 1, -1, -1):
        for u in found[k][2]:
            weight[u] = max(weight[u], weight[k])
    return [(w, s, e) for w, (_, parts, _) in zip(weight, found, strict=True) for s, e in parts]


def spans(text: str) -> list[tuple[int, int, int]]:
    """Base spans, and literals of sensitive targets that no base span overlaps; by start, then kind."""
    base = base_spans(text)
    if not LETTER_OR.search(text):
        return base
    starts, ends = [], []  # the base spans' union, in order
    for s, _, e in base:
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    extra = set()
    for s, e in scored(text, literals(text)):
        k = bisect_right(ends, s)  # the first that ends after s
        if k == len(starts) or starts[k] >= e:
            extra.add((s, 3, e))
    return sorted(base + list(extra))


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


SPAN = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``found``, the spans by start and kind. Runs in the scan's tasks, no shuffle."""
    small_batches(df.sparkSession)

    def scan(batches):
        for b in batches:
            out = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans(t or "")] for t in b.column(1).to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(out, kind)], ["doc_id", "found"])

    return df.select(df[id_col].cast("long"), df[text_col].cast("string")).mapInArrow(scan, f"doc_id long, found {SPAN}")


def redact_secrets(df: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``df`` with every secret of its text replaced by ``mask``: an assignment's value, and other spans whole; those that
    touch become one mask. All rows and columns stay; a null text stays null."""
    small_batches(df.sparkSession)
    at = df.columns.index(text_col)

    def clean(text):
        if not text:
            return text
        out, done = [], 0
        for s, e in sorted((ASSIGN.match(text, s).start(2) if k == 0 else s, e) for s, k, e in spans(text)):
            if s >= done and (s > done or not out):
                out += [text[done:s], mask]
            done = max(done, e)
        return "".join([*out, text[done:]]) if out else text

    def scan(batches):
        for b in batches:
            new = pa.array([clean(t) for t in b.column(at).to_pylist()], pa.string())
            yield b.set_column(at, b.schema.field(at).name, new.cast(b.schema.field(at).type))

    return df.mapInArrow(scan, df.schema)


@query("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    """Counts and digests of the spans that :func:`find_secrets` gives for every document."""
    from pyspark.sql import functions as F

    found = find_secrets(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(text(F.filter("found", lambda x: x["kind"] != "literal")), 256).alias("base_sha256"),
        text("found").alias("spans"),
    )
