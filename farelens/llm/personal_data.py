"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base patterns (email, ip, card, phone) are always reported. Further candidates - national
numbers, phone numbers without a country code, account numbers, names after a title, written-out
addresses - are only shapes, common in clean text as well. Every candidate, base ones included,
gets the votes of a few labelers: its form, gazetteers, the words around it, what it touches.
Each says yes, no or nothing. Expectation-maximisation estimates how reliable each labeler is,
without labels, and gives every pattern of votes a probability. A logistic classifier over the
votes, the kind and the surroundings of a span is trained on these and decides.

Both are fitted on how often each pattern of votes and features occurs in all documents. There
is a fixed number of patterns (``PATTERNS``), so what comes to the driver does not grow with the
corpus. Counting is one pass over the texts, deciding a second; nothing is shuffled but counts.
"""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import batch_of, documents, map_arrow

BASE = ("email", "ip", "card", "phone")
EXTRA = ("written_email", "national_id", "local_phone", "account", "name")
KINDS = {kind: n for n, kind in enumerate(BASE + EXTRA)}
Span = tuple[int, int, str]

# --- base patterns --------------------------------------------------------------------------

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[Span]:
    """From each @ outwards: starting from every letter would be quadratic in long words."""
    found, low, at = [], 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        local = len(before) - len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if local else None
        low = domain.end() if domain else at + 1
        if domain:
            found.append((at - local, low, "email"))
        at = text.find("@", low)
    return found


def passes_luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """By kind, then by start. Matches that fail their test are dropped and not tried again."""
    found = emails(text)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((*m.span(), "card"))
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m[0])) <= 15:
            found.append((*m.span(), "phone"))
    return found


# --- further candidates and labelers ----------------------------------------------------------

TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora")
CANDIDATES = {
    "written_email": re.compile(
        r"\b[A-Za-z0-9._-]{2,40} ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]{2,40} ?[(\[] ?dot ?[)\]] ?[A-Za-z]{2,10}\b"
    ),
    "national_id": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "local_phone": re.compile(
        r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9.-])"
    ),
    "account": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "name": re.compile(rf"\b(?:{'|'.join(TITLES)})\.? [A-ZÀ-Þ][a-zß-ÿ]+(?: [A-ZÀ-Þ][a-zß-ÿ]+)?"),
}
#: Words that speak for personal data near a span, and words that speak against it.
FOR = {
    "email": ("email", "e-mail", "mail", "contact", "write"),
    "written_email": ("email", "e-mail", "mail", "contact", "write"),
    "ip": ("ip", "address", "host", "login", "client"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "national_id": ("ssn", "social", "security", "id", "identity"),
    "account": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "name": ("name", "contact", "dear", "patient", "signed"),
}
AGAINST = ("isbn", "version", "order", "invoice", "serial", "part", "sku", "example", "page", "ref")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
NEAR = 40
LABELERS = 5


def _form(kind: str, span: str) -> int:
    if kind == "account":
        plain = span.replace(" ", "")
        value = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        return 1 if 15 <= len(plain) <= 34 and int(value) % 97 == 1 else -1
    if kind == "national_id":
        area, group, serial = span.split("-")
        return -1 if area in ("000", "666") or area >= "900" or group == "00" or serial == "0000" else 1
    if kind == "local_phone":
        digits = digits_of(span)
        return 1 if digits[0] in "23456789" and digits[3] in "23456789" else -1
    return 1 if kind != "name" else 0


def _gazetteer(kind: str, span: str) -> int:
    if kind in ("email", "written_email"):
        top = span.rstrip(")] ").rpartition(".")[2] if kind == "email" else span.split()[-1]
        return 1 if top.lower() in ("com", "org", "net", "edu", "de", "fr", "es", "io", "uk") else 0
    if kind == "card":
        return 1 if span[0] in "3456" else 0
    if kind == "name":
        return 1 if span.count(" ") == 2 else 0
    return 0


def votes(text: str, span: Span) -> tuple[int, ...]:
    start, end, kind = span
    own = text[start:end]
    left = [w.lower() for w in WORD.findall(text[max(0, start - NEAR) : start])][-4:]
    right = [w.lower() for w in WORD.findall(text[end : end + NEAR])][:3]
    touches = text[max(0, start - 1) : start] + text[end : end + 1]
    return (
        _form(kind, own),
        _gazetteer(kind, own),
        int(any(w in FOR[kind] for w in left + right)),
        -int(any(w in AGAINST for w in left)),
        -1 if any(c.isalnum() or c in "-_/" for c in touches) else 1 if touches.isspace() else 0,
    )


def pattern(text: str, span: Span) -> int:
    """One number for kind, votes and two features: length and place in the line."""
    start, end, kind = span
    number = KINDS[kind]
    for vote in votes(text, span):
        number = number * 3 + vote + 1
    size = min(3, (end - start) // 8)
    opens = start == 0 or text[start - 1] == "\n"
    return (number * 4 + size) * 2 + opens


PATTERNS = len(KINDS) * 3**LABELERS * 8


def read_pattern(number: int) -> tuple[int, list[int], int, int]:
    number, opens = divmod(number, 2)
    number, size = divmod(number, 4)
    cast = []
    for _ in range(LABELERS):
        number, vote = divmod(number, 3)
        cast.append(vote - 1)
    return number, cast[::-1], size, opens


def extra_candidates(text: str, base: list[Span]) -> list[Span]:
    """Shapes that do not overlap a base span or an earlier candidate."""
    found = [(*m.span(), kind) for kind, shape in CANDIDATES.items() for m in shape.finditer(text)]
    if not found:
        return []
    taken = sorted(base + found, key=lambda s: (s[0], KINDS[s[2]]))
    out, reach = [], -1
    ends = sorted(base)
    at, base_reach = 0, -1
    for start, end, kind in taken:
        while at < len(ends) and ends[at][0] < end:
            base_reach = max(base_reach, ends[at][1])
            at += 1
        if kind in EXTRA and start >= reach and start >= base_reach:
            out.append((start, end, kind))
            reach = end
    return out


# --- the model, on counts of patterns ------------------------------------------------------------


def weigh_labelers(numbers: np.ndarray, n: np.ndarray, rounds: int = 100) -> np.ndarray:
    """The probability of each pattern by expectation-maximisation (Dawid and Skene).

    Starts from the majority of votes. Each labeler has a table of how it votes on true and on
    false spans; each kind has its own share of true ones."""
    read = [read_pattern(int(p)) for p in numbers]
    kinds = np.array([r[0] for r in read])
    cast = np.array([r[1] for r in read]).reshape(len(read), LABELERS) + 1
    true = 1 / (1 + np.exp(-(cast - 1).sum(axis=1).astype(float)))
    for _ in range(rounds):
        weight = np.stack([n * (1 - true), n * true])
        log = np.zeros((2, len(n)))
        for labeler in range(LABELERS):
            table = np.stack([np.bincount(cast[:, labeler], w, 3) for w in weight]) + 0.5
            log += np.log(table / table.sum(axis=1, keepdims=True))[:, cast[:, labeler]]
        share = np.stack([np.bincount(kinds, w, len(KINDS)) for w in weight]) + 0.5
        log += np.log(share / share.sum(axis=0))[:, kinds]
        now = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(now - true).max(initial=0) < 1e-9:
            break
        true = now
    return true


def features(numbers: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(numbers), 1 + len(KINDS) + 3 * LABELERS + 4 + 1))
    for row, number in enumerate(numbers):
        kind, cast, size, opens = read_pattern(int(number))
        rows[row, [0, 1 + kind]] = 1
        rows[row, [1 + len(KINDS) + 3 * i + v + 1 for i, v in enumerate(cast)]] = 1
        rows[row, 1 + len(KINDS) + 3 * LABELERS + size] = 1
        rows[row, -1] = opens
    return rows


def train_classifier(numbers: np.ndarray, n: np.ndarray, true: np.ndarray) -> np.ndarray:
    """Logistic regression on weighted patterns with soft labels, by Newton's method."""
    rows, weights = features(numbers), np.zeros(features(numbers[:0]).shape[1])
    n = np.log1p(n)  # a frequent pattern counts more, but does not drown the rare ones
    for _ in range(30):
        guess = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (n * (guess - true)) + 0.1 * weights
        curve = (rows * (n * guess * (1 - guess))[:, None]).T @ rows + 0.1 * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def fit(docs: DataFrame) -> np.ndarray:
    """For every pattern number whether the classifier accepts it."""
    schema = pa.schema([("pattern", pa.int32()), ("n", pa.int64())])

    def run(batches):
        counts = Counter()
        for batch in batches:
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = base_spans(text)
                counts.update(pattern(text, s) for s in base + extra_candidates(text, base))
        yield batch_of({"pattern": list(counts), "n": list(counts.values())}, schema)

    counts = map_arrow(documents(docs), run, "pattern int, n long")
    rows = counts.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    numbers = np.array([r.pattern for r in rows], np.int64)
    n = np.array([r.n for r in rows], float)
    accepts = np.zeros(PATTERNS, bool)
    if len(numbers):
        weights = train_classifier(numbers, n, weigh_labelers(numbers, n))
        accepts[numbers] = features(numbers) @ weights > 0
    return accepts


# --- results ---------------------------------------------------------------------------------------

SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{kind}", pa.int64()) for kind in BASE]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    ``spans`` lists kind:start:end by kind, then start, in code points, end exclusive: all base
    spans and the accepted further ones. Null and empty texts have none; texts are read whole;
    repeated rows give a row each; an empty table gives none.
    """
    accepts = fit(docs)

    def run(batches):
        for batch in batches:
            rows = {name: [] for name in SCHEMA.names}
            rows["doc_id"] = batch.column("doc_id")
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = base_spans(text)
                extra = [s for s in extra_candidates(text, base) if accepts[pattern(text, s)]]
                counts = Counter(kind for _, _, kind in base)
                for kind in BASE:
                    rows[f"n_{kind}"].append(counts[kind])
                rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                extra.sort(key=lambda s: (KINDS[s[2]], s[0]))
                rows["spans"].append(joined(base + extra))
            yield batch_of(rows, SCHEMA)

    types = ", ".join(f"n_{kind} long" for kind in BASE)
    return map_arrow(documents(docs), run, f"doc_id long, {types}, base_sha256 string, spans string")
