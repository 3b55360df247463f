"""Token counts: greedy longest-match word pieces, counted by one pass of an automaton.

A word is a run of characters other than the six ASCII white-space characters, with A-Z in
lower case, as UTF-8 bytes; its last byte carries the end-of-word mark. Pieces are taken from
the left, each the longest in the vocabulary. The trie of the vocabulary has a failure link
per node and the number of pieces popped when that link is taken, so a word of n bytes takes
at most 2n steps and no piece is ever built.
"""

import json
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from farelens.llm.common import WordCache, batch_of, documents, lower_words, map_arrow

END = "</w>"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the letters from 256 on, in order.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def symbols(word: bytes) -> list[int]:
    """Bytes, the last one plus 256."""
    return [*word[:-1], word[-1] + 256]


def read_pieces(path: str) -> list[list[int]]:
    """The vocabulary as symbol sequences."""
    byte = {letter: b for b, letter in byte_letters().items()}
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    pieces = []
    for piece in vocabulary:
        ends = piece.endswith(END) and piece != END
        raw = bytes(byte[c] for c in (piece[: -len(END)] if ends else piece))
        pieces.append(symbols(raw) if ends else list(raw))
    return pieces


class Automaton:
    """Trie with failure links. Every single symbol counts as a piece, so matching never fails."""

    def __init__(self, pieces: list[list[int]]) -> None:
        self.next: dict[int, int] = {}
        parents, edges, depth, whole = [0], [0], [0], [False]
        for piece in [*([s] for s in range(512)), *pieces]:
            node = 0
            for symbol in piece:
                child = self.next.get(node << 9 | symbol)
                if child is None:
                    child = self.next[node << 9 | symbol] = len(parents)
                    parents.append(node)
                    edges.append(symbol)
                    depth.append(depth[node] + 1)
                    whole.append(False)
                node = child
            whole[node] = True
        self.fail, self.popped = [0] * len(parents), [0] * len(parents)
        for node in sorted(range(1, len(parents)), key=depth.__getitem__):
            if whole[node]:
                self.popped[node] = 1
                continue
            at, popped = self.fail[parents[node]], self.popped[parents[node]]
            while (child := self.next.get(at << 9 | edges[node])) is None:
                popped += self.popped[at]
                at = self.fail[at]
            self.fail[node], self.popped[node] = child, popped

    def count(self, word: bytes) -> int:
        """The number of pieces of one word; 0 for the empty word."""
        node = pieces = 0
        for symbol in symbols(word) if word else ():
            while (child := self.next.get(node << 9 | symbol)) is None:
                pieces += self.popped[node]
                node = self.fail[node]
            node = child
        while node:
            pieces += self.popped[node]
            node = self.fail[node]
        return pieces


@lru_cache(maxsize=2)
def load(path: str) -> Automaton:
    return Automaton(read_pieces(path))


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens. No shuffle.

    ``path`` names the vocabulary file, at the same place on every machine; by default that
    of the installed tokenizer package. A null or empty text has 0 words and 0 tokens; a text
    of any length is counted whole; repeated rows are counted each; an empty table gives none.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches):
        cache = WordCache(load(path).count)
        for batch in batches:
            words, tokens = [], []
            for text in batch.column("text"):
                numbers, values = cache.of(lower_words(text.as_py()))
                words.append(len(numbers))
                tokens.append(sum(map(values.__getitem__, numbers.tolist())))
            yield batch_of(
                {"doc_id": batch.column("doc_id"), "n_words": words, "n_tokens": tokens}, SCHEMA
            )

    return map_arrow(documents(docs), run, "doc_id long, n_words long, n_tokens long")
