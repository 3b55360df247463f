import hashlib
import random
import re

import numpy as np

from farelens.llm import personal_data as pii
from tests.llm.samples import ODD_TEXTS, odd_documents


def plain_base(text):
    text, out = text or "", []

    def digits(s):
        return [int(c) for c in s if c in "0123456789"]

    def luhn(d):
        return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0

    tests = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    for kind, regex, good in tests:
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(regex, text) if good(m[0])]
    return ",".join(out)


PRIVATE = [
    (30, "mail a.b+c@x-y.example.com, é d@e.f@g.h.i @ x@y z@.com a@b..c 1.2.3.4 300.1.1.1"),
    (31, "cards 4532015112830366 4532-0151-1283-0366 4532 0151 1283 0367 +1 (921) 555-8394 +49 30"),
    (32, "0.0.0.0 1.2.3.4.5.6.7.8 0001.002.3.4 +123456789012345678 ++4915112345678."),
    (33, "9" * 3000 + "." + "a" * 3000 + "@"),
]


def test_base_on_random_texts():
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choices("@.+- 019aZ_%()é\n", k=rng.randrange(40)))
        assert pii.joined(pii.base_spans(text)) == plain_base(text)
    for _, text in PRIVATE + [t for t in ODD_TEXTS if t[0] != 9]:
        assert pii.joined(pii.base_spans(text or "")) == plain_base(text)


def check(docs):
    texts = {}
    for d in docs.select("doc_id", "text").collect():
        texts.setdefault(d.doc_id, []).append(d.text)
    found = pii.find_personal_data(docs).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, t in texts.items() for _ in t)
    for r in found:
        bases = {hashlib.sha256(plain_base(t).encode()).hexdigest(): plain_base(t) for t in texts[r.doc_id]}
        assert r.base_sha256 in bases and r.spans.startswith(bases[r.base_sha256])
        kinds = [s.split(":")[0] for s in bases[r.base_sha256].split(",")]
        assert [kinds.count(k) for k in pii.BASE] == [r.n_email, r.n_ip, r.n_card, r.n_phone]
    return found


def test_odd_texts(spark):
    check(odd_documents(spark, [t for t in ODD_TEXTS if t[0] != 9] + PRIVATE[:3]))
    assert pii.find_personal_data(odd_documents(spark).limit(0)).count() == 0


def test_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_context_decides_over_shapes(spark):
    """Numbers of the same shape: kept where the words around them speak for it."""
    rng, rows = random.Random(8), []
    for i in range(200):
        number = f"{rng.randrange(200, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}"
        good = i % 2
        rows.append((i, f"of the {'ssn is' if good else 'part serial order'} {number} and more"))
        rows.append((1000 + i, f"write an email to user{i}@mail.example.com soon"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find_personal_data(docs).collect()}
    assert all(("national_id" in found[i]) == bool(i % 2) for i in range(200))


def test_labelers_recover_reliabilities():
    rng = np.random.default_rng(3)
    truth = rng.random(20000) < 0.4
    right = (0.95, 0.9, 0.85, 0.8, 0.6)
    cast = np.stack([np.where(rng.random(20000) < p, truth, ~truth) for p in right])
    number = np.zeros(20000, np.int64)
    for votes in cast:
        number = number * 3 + votes * 2
    numbers, at, n = np.unique(number * 8, return_inverse=True, return_counts=True)
    guess = pii.weigh_labelers(numbers, n.astype(float))[at] > 0.5
    assert (guess == truth).mean() > 0.96
    weights = pii.train_classifier(numbers, n.astype(float), pii.weigh_labelers(numbers, n.astype(float)))
    assert ((pii.features(numbers) @ weights > 0)[at] == truth).mean() > 0.95
