"""Secret scans: base patterns, and weak parts linked where complementary parts meet.

A credential often comes in parts: an identifier (access key id, user, client id), a secret
(a password, a random string) and an endpoint (a URL or host with port). Base patterns report
what is a secret by its form alone. Weak parts - a random-looking string, a user name, a host -
say little alone and are common in clean text, so they are only reported when parts that
complete them lie in the same scope: within ``scope`` characters, in the same document. The base
reads a value up to the first character outside its class; a named value that goes on behind
it, as in a quoted phrase, is reported whole, as its first part is a secret by its name already.

The parts of a document are sorted intervals, and the join is two binary searches in the
running counts of each other role, so its cost is n log n however many parts share a scope,
and no pairs are made. A document's parts come from its own text, so nothing is shuffled.
"""

import hashlib
import math
import re
import string
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from farelens.llm.common import batch_of, documents, map_arrow

ASSIGN = re.compile(
    r"((?:(?i:password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs are taken whole, so shorter ones just fail
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")

#: What follows a scheme - user, password, hosts, path - or the port of a bare host. Both begin
#: with the colon, which is quick to search for; scheme and bare host are read backwards from it.
HOST = r"(?:\[[0-9A-Fa-f:.]+\]|[A-Za-z0-9._-]+)(?::[0-9]{1,5})?"
ENDPOINT = re.compile(
    r"://(?:([^\s:/@\"'<>]*)(?::([^\s/\"'<>]*))?@)?"  # a password may hold the sign: the last one counts
    + rf"{HOST}(?:,{HOST})*[A-Za-z0-9/_.-]*"
    + r"|:[0-9]{2,5}(?![A-Za-z0-9_])"
)
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
#: Longer schemes are not registered, and longer host names are not valid in DNS.
SCHEME_LENGTH, HOST_LENGTH = 32, 255
HOST_CHARS = string.ascii_letters + string.digits + ".-"
BARE_HOST = re.compile(
    r"localhost|(?:[0-9]{1,3}\.){3}[0-9]{1,3}|(?:[A-Za-z0-9-]+\.)+[A-Za-z][A-Za-z0-9-]*"
)
#: A name of two parts with a number behind it may be a line of a source file.
SOURCE_FILE = re.compile(
    r"[A-Za-z0-9-]+\.(?:py|js|ts|java|go|rb|c|cc|cpp|h|cs|php|scala|kt|html|css|json|ya?ml|xml|sh|sql|md|txt|log)"
)
#: Between a name and its value: a closing quote, a sign, an opening quote; any may be escaped.
SIGN = r"\\?[\"']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*\\?[\"']?"
NAMED_HOST = re.compile(
    r"(?i:(?<![A-Za-z0-9])(?:host(?:_?name)?|endpoint))" + SIGN
    + r"([A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?(?::[0-9]{1,5})?)(?!:?//)",
    re.ASCII,
)
#: The name may end a longer one, as in DB_USER and aws_access_key_id.
IDENTIFIER = re.compile(
    r"(?i:(?<![A-Za-z0-9])(?<!secret[_-])(?:user(?:[_-]?(?:name|id))?|login|account(?:[_-]?(?:name|id))?"
    r"|client[_-]?id|access[_-]?key(?:[_-]?id)?))" + SIGN + r"([A-Za-z0-9@_.-]{3,})",
    re.ASCII,
)
#: Runs are taken whole, from the first character after a name's sign; signs are padding at the end.
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
#: A value of any characters behind a name of a secret, in quotes or up to white space. What stands
#: for a value (a variable, a call, a URL, a path) is none.
NAMED = re.compile(
    r"((?i:passw(?:or)?d|passphrase|pwd|secret(?:[_-]?(?:access[_-]?)?key)?|token|api[_-]?key"
    r"|(?:account|private|auth|signing|encryption)[_-]?key))"
    r"\\?[\"']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*"
    r"(?:\\?\"(?P<double>[^\"\r\n]{6,}?)\\?\"|\\?'(?P<single>[^'\r\n]{6,}?)\\?'"
    r"|(?![/(\[{<*#]|\$[({]|%[({]|[A-Za-z_.]+[(\[]|[A-Za-z+]+://)"
    r"(?P<plain>(?:(?!&[A-Za-z0-9_.-]+=)[^\s\"'`<>,;]){6,}))",
    re.ASCII,
)
#: Names of which a value may be several words.
PHRASES = ("passw", "passphrase", "pwd")
WEAK = ("identifier", "random", "endpoint", "password", "named")
KINDS = {kind: n for n, kind in enumerate(BASE + WEAK)}

#: What a weak part needs in its scope: any one of these sets of roles, whole.
NEEDS = {
    "identifier": ({"secret"},),
    "random": ({"identifier"}, {"endpoint"}),
    "endpoint": ({"identifier", "secret"},),
    "password": ({"identifier"}, {"endpoint"}),
    "named": ({"identifier"}, {"endpoint"}),
}
ROLES = {
    "assign": "secret",
    "hex": "secret",
    "random": "secret",
    "access": "identifier",
    "identifier": "identifier",
    "endpoint": "endpoint",
    "password": "secret",
    "named": "secret",
}

Span = tuple[int, int, str]
SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{kind}", pa.int64()) for kind in BASE]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
)


def entropy(text: str) -> float:
    """Bits per character."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def looks_random(text: str) -> bool:
    kinds = (str.isupper, str.islower, str.isdigit)
    return all(any(map(kind, text)) for kind in kinds) and entropy(text) >= 3.5


def base_spans(text: str) -> list[Span]:
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def endpoint_parts(text: str) -> list[Span]:
    """URLs of any scheme, with user and password if they hold them; hosts with a port; named hosts."""
    found, ends = [], {}
    for m in ENDPOINT.finditer(text):
        colon = m.start()
        if m[0].startswith("://"):
            scheme = SCHEME.search(text[max(0, colon - SCHEME_LENGTH) : colon])
            if not scheme:
                continue
            ends[colon - len(scheme[0])] = m.end()
            found += [(*m.span(n), k) for n, k in ((1, "identifier"), (2, "password")) if m[n]]
        else:
            before = text[max(0, colon - HOST_LENGTH) : colon]
            host = before[len(before.rstrip(HOST_CHARS)) :]
            if BARE_HOST.fullmatch(host) and not SOURCE_FILE.fullmatch(host):
                ends[colon - len(host)] = m.end()
    for m in NAMED_HOST.finditer(text):
        ends.setdefault(m.start(1), m.end(1))
    return found + [(start, end, "endpoint") for start, end in ends.items()]


def _reach(base: list[Span]) -> tuple[list[int], list[int]]:
    """Starts of sorted spans, and how far the first n of them reach."""
    return [s for s, _, _ in base], [0, *accumulate((e for _, e, _ in base), max)]


def named_values(text: str, base: list[Span]) -> tuple[list[Span], list[Span]]:
    """Values that go on behind a base span, from the start of the value; and values that no base
    span touches, which are weak parts if they look like a secret."""
    longer, free = [], []
    starts, reach = _reach(base)
    for m in NAMED.finditer(text):
        kind = m.lastgroup
        start, end = m.span(kind)
        if kind == "plain":
            end = start + len(m[kind].rstrip(")]}.:"))
        value = text[start:end]
        covered = reach[bisect_left(starts, end)]
        if covered > start:
            if any(map(str.isalnum, text[covered:end])):
                longer.append((start, end, "named"))
            continue
        signs = sum(not c.isalnum() and c not in "._-/ " for c in value)
        phrase = " " not in value or m[1].lower().startswith(PHRASES)
        if end - start >= 6 and phrase and (signs > 1 or any(map(str.isdigit, value)) or " " in value):
            free.append((start, end, "named"))
    return longer, free


def weak_parts(text: str) -> list[Span]:
    found = endpoint_parts(text)
    found += [(*m.span(1), "identifier") for m in IDENTIFIER.finditer(text)]
    found += [(*m.span(), "random") for m in RANDOM.finditer(text) if looks_random(m[0])]
    return found


def _order(span: Span) -> tuple:
    return span[0], KINDS[span[2]], span[1]


def linked_parts(base: list[Span], weak: list[Span], scope: int) -> list[Span]:
    """The weak parts that meet, within the scope, a part of each role that they need.

    A weak part that overlaps a base span is that span and is left out.
    """
    starts, reach = _reach(base)
    weak = [p for p in weak if reach[bisect_left(starts, p[1])] <= p[0]]
    parts = base + weak
    by_role: dict[str, tuple[list[int], list[int]]] = {}
    for role in {ROLES[k] for _, _, k in parts}:
        own = [p for p in parts if ROLES[p[2]] == role]
        by_role[role] = (sorted(s for s, _, _ in own), sorted(e for _, e, _ in own))

    def near(part: Span, role: str) -> bool:
        if role not in by_role:
            return False
        begins, ends = by_role[role]
        others = bisect_right(begins, part[1] + scope) - bisect_left(ends, part[0] - scope)
        return others - (ROLES[part[2]] == role) > 0

    return [p for p in weak if any(all(near(p, r) for r in need) for need in NEEDS[p[2]])]


def scan(text: str | None, scope: int = 200) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: base and linked, by start and then by kind."""
    text = text or ""
    base = base_spans(text)
    longer, free = named_values(text, base)
    weak = weak_parts(text) + free
    more = longer + (linked_parts(base, weak, scope) if weak else [])
    return base, sorted(base + more, key=_order) if more else base


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans. No shuffle.

    ``spans`` lists kind:start:end in code points, end exclusive. Null and empty texts have no
    spans; texts are scanned whole; repeated rows give a row each; an empty table gives none.
    """

    def run(batches):
        for batch in batches:
            rows = {name: [] for name in SCHEMA.names}
            rows["doc_id"] = batch.column("doc_id")
            for text in batch.column("text"):
                base, every = scan(text.as_py(), scope)
                counts = Counter(kind for _, _, kind in base)
                for kind in BASE:
                    rows[f"n_{kind}"].append(counts[kind])
                rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                rows["spans"].append(joined(every))
            yield batch_of(rows, SCHEMA)

    types = ", ".join(f"n_{kind} long" for kind in BASE)
    return map_arrow(
        documents(docs), run, f"doc_id long, {types}, base_sha256 string, spans string"
    )


def mask(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every run of overlapping or touching spans replaced by the mark."""
    out, at, covered = [], 0, -1
    for start, end, _ in sorted(spans):
        if start > covered:
            out += [text[at:start], mark]
        covered = max(covered, end)
        at = covered
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """The same rows and columns; in ``text`` secrets are masked and ``n_chars``, if there is
    one, follows. Texts without secrets, null ones included, stay as they are."""
    schema = docs.schema
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [scan(t, scope)[1] for t in texts]
            new = [mask(t, s) if s else t for t, s in zip(texts, found)]
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.column(at).type))
            at = batch.schema.get_field_index("n_chars")
            if at >= 0:
                old = batch.column(at).to_pylist()
                sizes = [len(t) if s else n for t, s, n in zip(new, found, old)]
                batch = batch.set_column(
                    at, batch.schema.field(at), pa.array(sizes, batch.column(at).type)
                )
            yield batch

    return map_arrow(docs, run, types)
