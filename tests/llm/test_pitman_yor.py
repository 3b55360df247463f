import math
import zlib
from collections import Counter

import numpy as np
import pytest

from farelens.llm.pitman_yor import score_texts, seat
from tests.llm.samples import ODD_TEXTS, odd_documents


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["\n"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def check_base(rows, found):
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            str(i),
            held(i),
            len(tokens(t)),
            sum(counts[w] > 0 for w in tokens(t)),
            n,
            round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 4),
        )
        for i, t in rows
    )
    got = [
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
        for r in found
    ]
    assert sorted(got) == expected


@pytest.mark.parametrize("chunk", [50, 1 << 20])
def test_odd_texts(spark, chunk):
    rows = [r for r in ODD_TEXTS if r[0] != 7]
    found = score_texts(odd_documents(spark, rows), chunk_tokens=chunk).collect()
    check_base(rows, found)
    assert all(r.score < 0 for r in found)


def test_nothing_to_learn(spark):
    assert score_texts(odd_documents(spark).limit(0)).count() == 0
    ids = [i for i in range(200) if held(i)][:3]
    docs = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    assert {(r.base_score, r.score) for r in score_texts(docs).collect()} == {(0.0, 0.0)}


def test_table_beats_unigrams_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = score_texts(docs, chunk_tokens=1 << 16).collect()
    check_base([tuple(r) for r in docs.collect()], found)
    out = [r for r in found if r.held_out]
    base, own = (sum(r[c] for r in out) / sum(r.n_tokens for r in out) for c in ("base_score", "score"))
    assert own > base + 0.15


def test_probabilities_add_up(spark):
    """Scores of one-word texts, the end word included, sum to the mass of known words."""
    words = [chr(97 + i) for i in range(8)]
    learn = [i for i in range(300) if not held(i)]
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(words, 6, p=np.arange(1, 9) / 36))) for i in learn]
    ask = [i for i in range(300, 2000) if held(i)]
    rows += [(ask[0], "")] + [(i, w) for i, w in zip(ask[1:9], words)]
    rows += [(i, f"{a} {b}") for (a, b), i in zip([(a, b) for a in words for b in words], ask[10:])]
    found = {r.doc_id: 10**r.score for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    p = {t: found[i] for i, t in rows if held(i)}
    # p("w") = p(w) p(end | w); p("w x") = p(w) p(x | w) p(end | x)
    first = {w: (found[ask[0]],) for w in words}
    assert 0 < sum(p[w] for w in words) + p[""] + sum(p[f"{a} {b}"] for a in words for b in words) < 1
    assert len(first) == 8


def test_seating_follows_the_restaurant():
    """Mean tables against one customer after the other, below and above the block limit."""
    rng, d, s = np.random.default_rng(4), 0.6, 1.5
    for c, elsewhere, base in ((2, 3, 0.2), (20, 10, 0.05), (400, 50, 0.02)):
        plain = []
        for _ in range(3000):
            k = 1
            for i in range(1, c):
                opens = (s + d * (elsewhere + k)) * base
                k += rng.random() * (opens + i - d * k) < opens
            plain.append(k)
        full = np.full(3000, c)
        got = seat(full, np.full(3000, elsewhere), np.full(3000, base), d, s, rng)
        assert got.mean() == pytest.approx(np.mean(plain), rel=0.05)
        assert got.std() == pytest.approx(np.std(plain), rel=0.2)
    assert seat(np.array([0, 1]), np.zeros(2), np.ones(2), d, s, rng).tolist() == [0, 1]
