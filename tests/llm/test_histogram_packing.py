import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from farelens.llm.histogram_packing import (
    non_negative_least_squares,
    pack,
    plan_patterns,
    strategies,
    word_bpe,
)
from tests.llm.samples import ODD_TEXTS, odd_documents


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check(tokenizer, docs, found, window):
    """Every id in one piece, checksums, no gaps or overlaps; returns the share of padding."""
    ids = {}
    for i, t in docs:
        ids.setdefault(i, []).append(
            np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        )
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, copies in ids.items():
        expected = Counter(
            (s, len(d[s : s + window]), zlib.crc32(d[s : s + window].tobytes()), len(d))
            for d in copies
            for s in range(0, len(d), window)
        )
        assert expected == Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[i])
    total = 0
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= window
        total += at
    return 1 - total / (window * len(sequences))


def test_odd_texts(spark, tokenizer):
    check(tokenizer, ODD_TEXTS, pack(odd_documents(spark)).collect(), 4096)
    assert pack(odd_documents(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        pack(odd_documents(spark), window=100, unit=16)


def test_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = pack(docs.repartition(5)).collect()
    assert check(tokenizer, [tuple(r) for r in docs.collect()], found, 4096) < 0.03


def test_least_squares():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, x = rng.random((12, 30)), np.maximum(rng.normal(size=30), 0)
        b = rng.normal(size=12) * 3
        assert np.allclose(a @ non_negative_least_squares(a, a @ x), a @ x, atol=1e-6)
        best = non_negative_least_squares(a, b)
        gradient = a.T @ (a @ best - b)
        assert best.min() >= 0 and gradient.min() > -1e-6 and abs(gradient @ best) < 1e-6


def test_patterns_use_up_the_histogram():
    rng = np.random.default_rng(2)
    assert strategies(4, 3) == [(4,), (3, 1), (2, 2), (2, 1, 1)]
    for histogram in ({}, {1: 7}, {64: 3}, {33: 5, 31: 4}, dict(enumerate(rng.integers(0, 900, 64), 1))):
        patterns, used = plan_patterns(histogram, 64, 3), Counter()
        for use, repeats in patterns:
            assert sum(b * n for b, n in use.items()) <= 64 and repeats > 0
            for b, n in use.items():
                used[b] += n * repeats
        assert +used == +Counter({b: int(n) for b, n in histogram.items()})


def test_both_libraries_give_the_same_ids(tokenizer):
    vocabulary = word_bpe(public_tokenizers.path("word_bpe_49k.json"))
    marks = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b {c} 1{c}{c}  {c}'S2" for c in marks[n : n + 100]) for n in range(0, len(marks), 100)]
    texts += ["A" * 100000, "ab9!" * 30000, "x<|endoftext|>y zé I'LL don't ÀÉ<|startoftext|>", " \t\x0b", "\0 a\0b"]
    rng = np.random.default_rng(7)
    texts += [" ".join("".join(rng.choice(list("abehinrst'é!1"), rng.integers(1, 12))) for _ in range(4000))]
    for text in texts:
        assert vocabulary.ids(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_token_is_what_its_own_bytes_merge_to():
    """The condition under which merging by spelling equals merging by the pairs of the file."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    rank = {pair: n for n, pair in enumerate(merges)}
    ids = [model["vocab"][a + b] for a, b in merges]
    assert ids == sorted(ids)
    for a, b in merges:
        whole = a + b
        ends = whole.endswith("</w>")
        parts = list(whole.removesuffix("</w>"))
        if ends:
            parts[-1] += "</w>"
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda pair: rank.get(pair, len(rank)))
            assert best in rank
            joined, n = [], 0
            while n < len(parts):
                if tuple(parts[n : n + 2]) == best:
                    joined.append(parts[n] + parts[n + 1])
                    n += 2
                else:
                    joined.append(parts[n])
                    n += 1
            parts = joined
        assert parts == [whole]
