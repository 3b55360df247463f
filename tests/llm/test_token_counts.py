import json

import public_tokenizers
import pytest

from farelens.llm.token_counts import END, Automaton, count_tokens, load, read_pieces, symbols
from tests.llm.samples import ODD_TEXTS, odd_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def greedy(word, pieces):
    rest, n = symbols(word) if word else [], 0
    while rest:
        size = next(k for k in range(min(len(rest), 80), 0, -1) if tuple(rest[:k]) in pieces or k == 1)
        rest, n = rest[size:], n + 1
    return n


@pytest.fixture(scope="module")
def pieces():
    return {tuple(p) for p in read_pieces(PATH)}


def brute(text, pieces):
    return sum(greedy(w, pieces) for w in (text or "").encode().lower().split())


def test_vocabulary_is_read_whole(pieces):
    with open(PATH) as file:
        vocabulary = json.load(file)["model"]["vocab"]
    assert len(pieces) == len(vocabulary)
    assert END not in vocabulary


def test_automaton_with_backtracking():
    a = Automaton([list(b"abcdx"), list(b"ab"), list(b"cd"), symbols(b"dz")])
    whole = {(*b"abcdx",), (*b"ab",), (*b"cd",), tuple(symbols(b"dz"))}
    for word in (b"", b"a", b"abcd", b"abcdx", b"abcdy", b"abcdz", b"abcdabcdabcd", b"xxcdz"):
        assert a.count(word) == greedy(word, whole)


def test_odd_texts(spark, pieces):
    found = count_tokens(odd_documents(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in found) == sorted(
        (i is None, i or 0, brute(t, pieces)) for i, t in ODD_TEXTS
    )


def test_table(spark, pieces):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: r.n_tokens for r in count_tokens(docs).collect()}
    assert found == {r.doc_id: brute(r.text, pieces) for r in docs.collect()}


def test_empty_table(spark):
    assert count_tokens(odd_documents(spark).limit(0)).count() == 0
    assert load(PATH) is load(PATH)
