import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from farelens.llm.byte_bpe import byte_bpe
from farelens.llm.pattern_packing import pack_best_fit, patterns, piece_starts, places, plan
from tests.llm.samples import ODD_TEXTS, odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
WINDOW = 2048


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(tokenizer, docs, found, window=WINDOW):
    """Pieces, checksums and places as the contract has them; sequences, and the least possible."""
    expected = Counter()
    for i, t in docs:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = [0, len(ids)]
        if len(ids) > window:
            cuts = [0, *range(len(ids) % window or window, len(ids) + 1, window)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[(i, n, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert expected == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences), -(-sum(r.length for r in found) // window)


def test_odd_texts(spark, tokenizer):
    docs = odd_documents(spark)
    assert pack_best_fit(docs).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ]
    check(tokenizer, ODD_TEXTS, pack_best_fit(docs).collect())
    assert pack_best_fit(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pack_best_fit(docs, window=100, unit=16)


def test_whole_table_needs_few_sequences(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    used, least = check(
        tokenizer, [tuple(r) for r in docs.collect()], pack_best_fit(docs.repartition(5)).collect()
    )
    assert used <= 1.002 * least + 1


def test_equal_texts_of_one_hot_length(spark, tokenizer):
    rows = [(n, "a b c d") for n in range(3000)] + [(n, "word " * 1500) for n in range(3000, 3100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    used, least = check(tokenizer, rows, pack_best_fit(docs).collect())
    assert used <= least + 1 or used == 100


def test_piece_starts():
    assert piece_starts(1, 8) == [0] and piece_starts(8, 8) == [0] and piece_starts(16, 8) == [0, 8]
    assert piece_starts(9, 8) == [0, 1] and piece_starts(23, 8) == [0, 7, 15]


def test_patterns_are_all_fillings():
    assert set(patterns(4, 3, {1, 2, 3, 4})) == {(4,), (3, 1), (2, 2), (2, 1, 1)}
    assert set(patterns(6, 3, {2, 3})) == {(3, 3), (2, 2, 2)}


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_once_and_is_close_to_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 257, 40 * (seed + 1))
    histogram = {int(length): int(n) for length, n in zip(lengths, rng.integers(1, 900, 400))}
    classes, used = plan(histogram, 256, 16, 3), Counter()
    for parts, repeats in classes:
        assert repeats > 0 and 0 < sum(parts) <= 256
        for length in parts:
            used[length] += repeats
    assert used == Counter(histogram)
    assert sum(repeats for _, repeats in classes) <= 1.02 * best_fit(histogram, 256)


def best_fit(histogram, window):
    """Sequences that best fit needs, longest first, one piece at a time."""
    rooms = np.zeros(window + 1, int)
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fitting = np.flatnonzero(rooms[length:])
            room = window
            if len(fitting):
                room = length + fitting[0]
                rooms[room] -= 1
            rooms[room - length] += 1
    return rooms.sum()


def test_thirds_are_packed_by_patterns():
    """Best fit alone pairs 100 with 100 and ends at 350; patterns fill every window."""
    classes = plan({100: 300, 90: 300, 66: 300}, 256, 2, 3)
    assert sum(repeats for _, repeats in classes) == 300


def test_places_give_each_rank_its_own_room():
    classes = plan({5: 70, 3: 41, 8: 9, 1: 13}, 16, 1, 3)
    lookup, taken = places(classes), set()
    for length, n in {5: 70, 3: 41, 8: 9, 1: 13}.items():
        start, first, each, base = lookup[length]
        for rank in range(n):
            at = np.searchsorted(start, rank, "right") - 1
            turn = rank - start[at]
            begin = base[at] + turn % each[at] * length
            cells = {(first[at] + turn // each[at], begin + c) for c in range(length)}
            assert not cells & taken and begin + length <= 16
            taken |= cells
    assert plan({}, 16, 1, 3) == [] and places([]) == {}


def test_both_libraries_give_the_same_ids(tokenizer):
    vocabulary = byte_bpe(PATH)
    marks = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b {c} 1{c}{c}  {c}2" for c in marks[n : n + 500]) for n in range(0, len(marks), 500)]
    texts += ["a" * 100000, " " * 100000, "\n" * 99999, "ab9!" * 30000, "x<|endoftext|> y", ""]
    for text in texts:
        assert vocabulary.ids(text) == tokenizer.encode(text, add_special_tokens=False).ids
    assert sum(vocabulary.sizes[vocabulary.plain("naïve 北京 <|endoftext|>")]) == len("naïve 北京 <|endoftext|>".encode())
