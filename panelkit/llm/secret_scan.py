"""Secret scans by assignment-aware lexing.

Three base patterns (fixed below) give the spans that are always reported.
On top of them, assignments of source code and configuration files are lexed
into name-literal pairs: ``name = "literal"``, ``"name": 'literal'``,
``name=>literal``, ``export NAME=value``, ``NAME := value``.  A right-hand
side that is itself a name is an edge along which constants propagate, so
``A = "..."`` followed by ``password = A`` makes the literal of A a password;
literals joined by ``+`` belong to the same target.  A literal is reported
(kind ``literal``) when the sensitivity of the best name that reaches it,
times how much it looks like a credential, is at least THRESHOLD, unless a
base assignment already covers it.  A literal of which a base assignment
covers only the head is always reported whole.

Literals with white space count by their longest run without it, if the name
is strongly sensitive (pass phrases); values after an authorization scheme
(``Bearer eyJ...``) count without the scheme; private keys in PEM form count
in full, quoted or not, over all their lines.  An unquoted word without
digits is a name, and also a literal where it ends a configuration line, is
no type and is used nowhere else in the text but as such a value.

Offsets are code points, end exclusive.  Null text counts as empty and has no
spans.  Repeated rows are each reported; whole texts are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import narrow, row_slices, ship_package, slices, worker_state

# The base patterns, their minimum lengths and their order.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "literal")

# Parts of names that make a literal sensitive, and by how much.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "auth": 0.7, "authorization": 0.8, "signature": 0.6, "salt": 0.6,
    "accesskey": 1.0, "privatekey": 1.0, "secretkey": 1.0, "signingkey": 1.0, "encryptionkey": 1.0,
}
PLACEHOLDER = re.compile(r"(?i)^(?:none|null|nil|true|false|undefined|changeme|change_me|example|placeholder|redacted|dummy|test|xxx+|\*+|\.+|<.*>|\[[a-z_]+\]|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|your[_-].*)$")
THRESHOLD = 0.45
# Fixed value: from this weight on a name is strongly sensitive.
STRONG = 0.9

_OPERATOR = re.compile(r"(?<![=:!<>+*/%-])(?:=>|:=|[:=])(?![=:/])")
_SPACE = " \t"
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-$")
_STRING = re.compile(r'"""(.*?)"""|\'\'\'(.*?)\'\'\'|"((?:[^"\\\n]|\\.)*)"|\'((?:[^\'\\\n]|\\.)*)\'|`([^`]*)`', re.DOTALL)
_BARE = re.compile(r"[^\s,;\"'(){}\[\]<>`]+")
_WORD = re.compile(r"[A-Za-z_$][\w.$]*\Z")
_SCHEME = re.compile(r"\s*(?i:bearer|basic|digest|token|negotiate|apikey)(?:\s+|\Z)")
_TEMPLATE = re.compile(r"\{\w*\}\Z")
_PEM_MARK = re.compile(r"-----(?:BEGIN|END) [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
_PEM = re.compile(r"(?:[|>][+-]?\s*|[\"'`]\s*)?(-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----[^-]*(?:-(?!----)[^-]*)*-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----)")
_LINE_START = re.compile(r"(?:export[ \t]+|-[ \t]+)?[\"']?\Z")
_LINE_END = re.compile(r"[ \t\r]*(?:#.*)?$", re.MULTILINE)
_TYPE = re.compile(r"(?i)(?:string|unicode|binary|object|boolean|integer|number|optional|varchar|inherit|required)\Z")
_IDENTIFIER = re.compile(r"[A-Za-z_]\w*")
_PLUS = re.compile(r"[ \t]*\+[ \t]*\n?[ \t]*")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each base pattern that are long enough."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if HEX_LONG.search(text):
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return out


def _name_before(text: str, at: int) -> str | None:
    """The (quoted) name that ends right before the operator at ``at``."""
    while at and text[at - 1] in _SPACE:
        at -= 1
    quoted = at and text[at - 1] in "\"'"
    end = at - 1 if quoted else at
    start = end
    while start and text[start - 1] in _NAME:
        start -= 1
    return text[start:end] if start < end else None


def _alone(text: str, line: int, at: int, name: str, end: int) -> bool:
    """Whether nothing but ``name``, the line's first operator at ``at`` and a value up to ``end`` is on the line that begins at ``line``."""
    before = text[line:at].rstrip(" \t\"'")
    return _LINE_START.match(before[: len(before) - len(name)].lstrip()) is not None and _LINE_END.match(text, end) is not None


def lex(text: str) -> Iterator[tuple[str, list[tuple[int, int]], list[str], list[tuple[int, int]]]]:
    """(name, spans of its literals, names it refers to, spans of words that may be either) of every assignment.

    An unquoted value runs to the next delimiter, over any operator inside
    (``url=http://h/?token=x``).  Of the assignments inside, the first one to a
    sensitive name has a literal of its own, which holds all later ones; so
    every character is read a bounded number of times.
    """
    line, seen, run_end, inner = 0, -1, 0, False
    for op in _OPERATOR.finditer(text):
        newline = text.rfind("\n", max(seen, 0), op.start())
        first_on_line = newline >= 0 or seen < 0
        line = newline + 1 if newline >= 0 else line
        seen = op.start()
        if not (name := _name_before(text, op.start())):
            continue
        if op.start() < run_end:
            if inner or not name_weight(name):
                continue
            inner = True
        at, literals, names, words = op.end(), [], [], []
        while at < len(text) and text[at] in _SPACE:
            at += 1
        while at < len(text):
            if m := _PEM.match(text, at):
                literals.append(m.span(1))
            elif m := _STRING.match(text, at):
                literals.append(m.span(m.lastindex))
            elif m := _BARE.match(text, at):
                if (scheme := _SCHEME.match(text, at)) and "\n" not in scheme.group() and (value := _BARE.match(text, scheme.end())):
                    names.append(m.group())
                    m = value  # Authorization: Bearer eyJ...
                if m.end() > run_end:
                    run_end, inner = m.end(), False
                word = _WORD.match(m.group())
                if word:
                    names.append(m.group())
                    if first_on_line and _IDENTIFIER.fullmatch(m.group()) and _alone(text, line, op.start(), name, m.end()):
                        words.append(m.span())
                if not word or any(map(str.isdigit, m.group())):  # configuration files do not quote
                    literals.append(m.span())
            else:
                break
            if not (plus := _PLUS.match(text, m.end())):
                break
            at = plus.end()
        if literals or names:
            yield name, literals, names, words


class Scope:
    """Assigned names, by their full dotted form; a reference that none has means the only one with its last part."""

    def __init__(self, names: Iterable[str]):
        self.full = set(names)
        self.last: dict[str, str | None] = {}
        for name in sorted(self.full):
            part = name.rsplit(".", 1)[-1]
            self.last[part] = None if part in self.last else name

    def find(self, name: str) -> str | None:
        name = name.lower()
        return name if name in self.full else self.last.get(name.rsplit(".", 1)[-1])


def name_weight(name: str) -> float:
    """How sensitive a target name is: its best part, or two parts read as one."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)


def value_weight(value: str, name: float = 0.0) -> float:
    """How much a literal under a name of weight ``name`` looks like a credential: length, mix of classes, entropy; 0 for placeholders.

    A PEM private key counts 1; a scheme in front is left out; of a literal
    with white space the longest run without it counts, 0 if the name is not
    strongly sensitive.
    """
    if _PEM_MARK.search(value):
        return 1.0
    if scheme := _SCHEME.match(value):
        value = value[scheme.end() :]
    value = value.strip()
    if PLACEHOLDER.match(value) or _TEMPLATE.match(value):
        return 0.0
    if len(runs := value.split()) > 1:
        value = max(runs, key=len) if name >= STRONG else ""
    n = len(value)
    if n < 6 or PLACEHOLDER.match(value) or _TEMPLATE.match(value):
        return 0.0
    classes = any(map(str.isdigit, value)) + any(map(str.islower, value)) + any(map(str.isupper, value)) + any(not c.isalnum() for c in value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    return min(1.0, 0.25 * classes + 0.1 * entropy)


def literal_spans(text: str, heads: Iterable[int] = ()) -> list[Span]:
    """Literals that a sensitive name reaches, directly or through other names, and those that start at one of ``heads``."""
    if not _OPERATOR.search(text):
        return []
    heads = set(heads)
    own: dict[tuple[int, int], float] = {}
    defined: dict[str, list[tuple[int, int]]] = {}
    sources: dict[str, set[str]] = {}
    maybe: dict[tuple[int, int], str] = {}
    weight: dict[str, float] = {}
    for name, literals, names, words in lex(text):
        own_weight = name_weight(name)
        for span in literals:
            own[span] = max(own.get(span, 0.0), own_weight)
        maybe.update(dict.fromkeys(words, name.lower()))
        defined.setdefault(name.lower(), []).extend(literals)
        sources.setdefault(name.lower(), set()).update(names)
        weight[name.lower()] = max(weight.get(name.lower(), 0.0), own_weight)
    # Names take the weight of the names they are assigned to, until nothing changes.
    scope = Scope(sources)
    todo = [name for name, w in weight.items() if w]
    while todo:
        target = todo.pop()
        for source in map(scope.find, sources[target]):
            if source and weight[source] < weight[target]:
                weight[source] = weight[target]
                todo.append(source)
    for name, spans in defined.items():
        for span in spans:
            own[span] = max(own[span], weight[name])
    maybe = {span: name for span, name in maybe.items() if weight[name] >= STRONG and span not in own}
    if maybe:
        used = Counter(m.group() for m in _IDENTIFIER.finditer(text))
        used.subtract(text[a:b] for a, b in maybe)
        for (a, b), name in maybe.items():
            word = text[a:b]
            if not used[word] and not scope.find(word) and not name_weight(word) and not _TYPE.match(word):
                own[a, b] = weight[name]
    return [("literal", a, b) for (a, b), w in own.items() if a in heads or w and w * value_weight(text[a:b], w) >= THRESHOLD]


def scan_text(text: str | None) -> list[Span]:
    """All spans by start, then kind as listed."""
    text = text or ""
    base = base_spans(text)
    covered = [(a, b) for kind, a, b in base if kind == "assign"]
    heads = [ASSIGN.match(text, a).start(2) for a, _ in covered]
    more, i = [], 0
    for span in sorted(literal_spans(text, heads), key=lambda s: s[1:]):
        while i < len(covered) and covered[i][1] <= span[1]:
            i += 1
        if not (i < len(covered) and covered[i][0] <= span[1] and span[2] <= covered[i][1]):
            more.append(span)
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the array ``spans`` of (kind, start, end), one row per row of ``docs``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scan_text(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, kind)], ["doc_id", "spans"])

    return narrow(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        scan, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )


def redact_text(text: str | None, mask: str = "[SECRET]") -> str | None:
    """The text with every secret replaced; of a base assignment only the value goes."""
    if not text or not (spans := scan_text(text)):
        return text
    cuts = sorted((ASSIGN.match(text, a).start(2) if kind == "assign" else a, b) for kind, a, b in spans)
    out, at = [], 0
    for a, b in cuts:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with secrets masked in ``text_col``; ``length_col``, if named, gets the new length where the text changed."""
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        for batch in batches:
            for part in row_slices(batch, at):  # whole rows, a bounded number of bytes at a time
                old = part.column(at).to_pylist()
                new = [redact_text(t) for t in old]
                if new != old:
                    columns = part.columns
                    columns[at] = pa.array(new, columns[at].type)
                    if length_at is not None:
                        lengths = columns[length_at].to_pylist()
                        columns[length_at] = pa.array([k if a == b else len(b) for k, a, b in zip(lengths, old, new, strict=True)], columns[length_at].type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return docs.mapInArrow(run, docs.schema)
