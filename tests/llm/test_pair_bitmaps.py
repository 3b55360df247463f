import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from farelens.llm.pair_bitmaps import (
    MOST_IN_ARRAY,
    Alignment,
    Block,
    align_tokens,
    container,
    places_in,
)
from farelens.llm.token_counts import byte_letters
from tests.llm.samples import ODD_TEXTS, odd_documents

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
MARKED = [
    (20, "a ▁ b"),
    (21, "<s>x</s> <unk> <0x0A> <|endoftext|> <|startoftext|>"),
    (22, "tab\there\r\nnul\x00 end  two   spaces "),
    (23, "ﬁ ０ ½ é é 한국어"),
    (24, " "),
    (25, "the the the the the the the the the"),
]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    letters = {letter: b for b, letter in byte_letters().items()}
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def tokens_a(text):
        encoded = a.encode(" " + text, add_special_tokens=False)
        return [(i, bytes(letters[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]

    def tokens_b(text):
        ids = b.encode(text)
        spelled = [
            bytes([int(b.id_to_piece(i)[3:5], 16)])
            if b.is_byte(i)
            else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids
        ]
        return list(zip(ids, spelled))

    return tokens_a, tokens_b


def brute(rows, sides):
    """The contract, token by token."""
    texts, found = [], []
    for doc_id, text in rows:
        a, b = (side(text or "") for side in sides) if text else ([], [])
        whole = b" " + (text or "").encode()
        if text and any(b"".join(x for _, x in side) != whole for side in (a, b)):
            a = b = []
        texts.append((doc_id, a, b))
    links, per_doc = Counter(), []
    for doc_id, a, b in texts:
        ends_a, ends_b, at = {}, {}, 0
        for n, (_, raw) in enumerate(a):
            at += len(raw)
            ends_a[at] = n
        at = 0
        for n, (_, raw) in enumerate(b):
            at += len(raw)
            ends_b[at] = n
        groups, mine, last = [], [], (-1, -1)
        for end in sorted(ends_a.keys() & ends_b.keys()):
            here = ends_a[end], ends_b[end]
            mine.append((a[here[0]][0], b[here[1]][0]))
            left = ",".join(str(i) for i, _ in a[last[0] + 1 : here[0] + 1])
            right = ",".join(str(i) for i, _ in b[last[1] + 1 : here[1] + 1])
            groups.append(f"{left}|{right}")
            last = here
        links.update(mine)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        per_doc.append((doc_id, len(a), len(b), len(groups), mine, digest))
    best = Counter()
    for (_, b), n in links.items():
        best[b] = max(best[b], n)
    for doc_id, n_a, n_b, n_groups, mine, digest in per_doc:
        n_best = sum(links[p] == best[p[1]] for p in mine)
        found.append((doc_id, n_a, n_b, n_groups, len(mine), n_best, sum(links[p] for p in mine), digest))
    return found, links


def check(spark, docs, rows, sides, **options):
    found = align_tokens(docs, **options)
    assert found.columns == NAMES
    expected, links = brute(rows, sides)
    assert Counter(map(tuple, found.collect())) == Counter(expected)
    return links


def test_odd_texts(spark, sides):
    rows = [r for r in ODD_TEXTS if r[0] != 7] + MARKED + [(26, "Lorem ipsum " * 4000)]
    check(spark, odd_documents(spark, rows), rows, sides)
    assert align_tokens(odd_documents(spark).limit(0)).count() == 0
    nothing = odd_documents(spark, [(1, None), (2, "")])
    assert sorted(map(tuple, align_tokens(nothing).collect())) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")
    ]


def test_table_with_small_blocks_and_salts(spark, sides):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.filter("length(text) < 6000").repartition(4)
    rows = [tuple(r) for r in docs.collect()]
    links = check(spark, docs, rows, sides, most_links=5000, most_postings=2)
    index = Alignment(docs, most_links=20000)
    pairs = {(r.a_id, r.b_id): r for r in index.pairs().collect()}
    assert {p: r.links for p, r in pairs.items()} == links
    a, b = links.most_common(1)[0][0]
    assert pairs[a, b].best and 0 < pairs[a, b].docs <= len(rows)


def test_one_text_copied_often(spark, sides):
    rows = [(n, "the same text, over and over; the same") for n in range(5000)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows, sides)


def test_containers_hold_what_was_put_in():
    rng = np.random.default_rng(3)
    for n in (0, 1, MOST_IN_ARRAY, MOST_IN_ARRAY + 1, 60000):
        places = np.sort(rng.choice(1 << 16, n, replace=False)).astype("<u2")
        packed = container(places)
        assert len(packed) <= 8192 and (places_in(packed, n) == places).all()


def test_planes_give_links_and_documents():
    rng = np.random.default_rng(4)
    block, links, docs = Block(1 << 30), Counter(), Counter()
    for _ in range(6000):
        pair = rng.integers(0, 4, rng.integers(0, 12)) * 70001
        assert block.add(pair) == block.documents - 1
        links.update(pair.tolist())
        docs.update(set(pair.tolist()))
    found, seen = Counter(), Counter()
    for plane in block.postings():
        for pair, p, ones, n, bitmap in zip(*(plane[c] for c in ("pair", "plane", "ones", "docs", "bitmap"))):
            assert len(places_in(bitmap.as_py(), int(ones))) == ones
            found[int(pair)] += int(ones) << int(p)
            seen[int(pair)] += int(n)
    assert found == links and seen == docs
