import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from farelens.llm.phrase_mining import (
    OVERLAP,
    Block,
    Parser,
    block_row,
    chunk_batch,
    mine_phrases,
)
from tests.llm.samples import ODD_TEXTS, odd_documents

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def word_lists(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def brute(rows, least=100, top=2000):
    """The contract, phrase by phrase."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for words in word_lists(text):
            n[lang or "und"] += len(words)
            for size in range(1, 6):
                f[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= 100 * count[p[i : i + size]]:
                        dropped.add(p[i : i + size])
        kept = []
        for p, a in candidates.items():
            if p not in dropped:
                cuts = [(count[p[:k]], count[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(
                    (1000 * a * n[lang] // (x * y), k, x, y) for k, (x, y) in enumerate(cuts)
                )
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def check(docs, rows, **options):
    found = mine_phrases(docs, **options)
    assert found.columns == NAMES
    named = {k: options[k] for k in ("least", "top") if k in options}
    result = sorted(map(tuple, found.collect()))
    assert result == brute(rows, **named)
    return result


@pytest.mark.parametrize("options", [{"least": 100}, {"least": 20, "divisor": 3, "most_bytes": 20000}])
def test_table(spark, options):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert check(docs.repartition(3), rows, **options)


def test_odd_texts(spark):
    docs = odd_documents(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert check(docs, rows, least=2)
    assert {r[2] for r in check(docs, rows)} >= {"lorem ipsum dolor lorem ipsum"}
    assert mine_phrases(docs.limit(0)).columns == NAMES and mine_phrases(docs.limit(0)).count() == 0


def test_ties_overlaps_and_top(spark):
    rows = [
        ("en", "a a a a a a a a. b c, b c; b c"),
        ("en", "New York! new york\x0bnew york\x0cNEW YORK \t new  york"),
        (None, "x y z x y z x y z x y z x y"),
        ("und", "x y z"),
        ("en", "Ä ä Ä ä é\x1cf é\x1cf"),
    ] * 30
    docs = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "doc_id long, lang string, text string, n int")
    for options in ({"least": 30}, {"least": 30, "top": 3}, {"least": 30, "divisor": 1}):
        check(docs, rows, **options)


def test_a_passage_in_every_text_and_pieces_without_end(spark):
    rng = np.random.default_rng(5)
    passage = " ".join(f"w{n}" for n in range(60))
    rows = [
        ("en", " ".join(map(str, rng.integers(0, 9, 40))) + " " + passage + " " + "k" * int(rng.integers(0, 4)))
        for _ in range(300)
    ]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    check(docs, rows, divisor=4, most_bytes=4000)


def test_chunks_overlap_by_a_window_and_begin_each_word_once():
    rng = np.random.default_rng(6)
    for divisor in (1, 2, 7, 50):
        words = [b"%d" % n for n in rng.integers(0, 20, 400)]
        whole, cut = Parser(divisor).parse(b" ".join(words))
        chunks = [(n, c.split()) for n, c in cut]
        assert not whole
        begun = [w for n, c in chunks for w in c[:n]]
        assert begun == words
        for (n, chunk), (_, after) in zip(chunks, chunks[1:]):
            assert chunk[n:] == after[:OVERLAP] and len(chunk) == n + OVERLAP
    shifted = [c for _, c in Parser(7).parse(b"other words " * 9 + b" ".join(words))[1]]
    same = [c for _, c in Parser(7).parse(b" ".join(words))[1]]
    assert len(set(shifted) & set(same)) >= len(same) - 2


def test_weights_past_double_precision():
    big = (1 << 60) + 1
    chunks = chunk_batch("en", [2, 2], [b"a b c d e f", b"a b"], [big, 1])
    row = block_row(7, "en", [chunks]).to_pylist()[0]
    words = {r["phrase"]: r["n"] for r in Block(row).count_words().to_pylist()}
    assert words == {"a": big + 1, "b": big + 1, "c": 0, "d": 0, "e": 0, "f": 0}
    pairs = {r["phrase"]: r["n"] for r in Block(row).count_pairs(list("abcde")).to_pylist()}
    assert pairs == {"a b": big + 1, "b c": big, "c d": 0, "d e": 0}
    longer = Block(row).count_longer(["a b", "b c", "c d"]).to_pylist()
    assert {r["phrase"]: r["n"] for r in longer} == {"a b c": big, "b c d": big, "a b c d": big}
