"""Packing by non-negative least squares over a histogram of lengths.

Documents become token ids and one end id. A document longer than the window is cut into full
windows and a rest, so every piece has 1 to ``window`` ids. Only the histogram of piece lengths
comes to the driver, in bins of ``unit`` ids, rounded up: at most window / unit numbers.

There, every combination of up to ``depth`` bins that exactly fills a window is a strategy;
non-negative least squares finds how often to use each so that together they use up the
histogram, and the counts are rounded down. What is left is packed greedily on the histogram:
the longest bin first, filled up with the longest bins that still fit, repeated as often as the
counts allow, so each step empties a bin. Both give patterns with a number of repeats.

Pieces then find their sequence without meeting each other: the n-th piece of a bin belongs to
the pattern whose range covers n. Ranks come from per-task counters and a table of counts per
task and bin, so a bin that holds a third of all pieces is never sorted or gathered.
"""

import json
import os
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import batch_of, documents, map_arrow, stored_table
from farelens.llm.token_counts import END, byte_letters

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("bin", pa.int32()),
        ("task", pa.int32()),
        ("nth", pa.int64()),
    ]
)
PIECE_TYPE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "bin int, task int, nth long"
)

# --- token ids ------------------------------------------------------------------------

#: Characters whose words are split by the vocabulary's own rule here: they are in composed form
#: and their lower case does not depend on what stands beside them.
PLAIN = re.compile("[ \t\n\x0b\x0c\r!-~À-ÖØ-öø-ÿ]*").fullmatch
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\x0b\x0c\ra-zß-öø-ÿ0-9]+").findall
SPACES = re.compile("[ \t\n\x0b\x0c\r]+").split
#: The character that stands for the end of a part; it is not among the plain ones.
MARK = "\0"


class WordBpe:
    """Ids of a ``tokenizers`` file with marked word ends, merged by ``tiktoken``.

    The mark is a byte of its own, and a byte with it the first merge, so what is left are the
    vocabulary's merges in their order. ``tiktoken`` merges whatever neighbours spell a token, where
    the file names the two parts of each. Both are the same as long as each token is what its own
    bytes merge to: before a merge of rank r all lower ones within its bytes are done, as they would
    be for these bytes alone (a test checks every token). No rule reaches over white space; words
    with other characters or a special token's string go to ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)").search
        byte = {letter: b for b, letter in byte_letters().items()}
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        ranks = {}
        for piece, i in vocabulary.items():
            if piece not in special:
                ends = piece.endswith(END) and piece != END
                raw = bytes(byte[c] for c in (piece[: -len(END)] if ends else piece))
                ranks[raw + MARK.encode() if ends else raw] = i
        self.merges = tiktoken.Encoding(
            "words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str) -> list[int]:
        if PLAIN(text) and not self.special(text):
            return self.plain(text)
        found, run = [], []
        for word in SPACES(text):
            if PLAIN(word) and not self.special(word):
                run.append(word)
            else:
                found += self.plain(" ".join(run))
                found += self.tokenizer.encode(word, add_special_tokens=False).ids
                run = []
        return found + self.plain(" ".join(run))

    def plain(self, text: str) -> list[int]:
        parts = PARTS(text.lower())
        return self.merges.encode_ordinary(MARK.join(parts) + MARK) if parts else []


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def cut_pieces(
    docs: DataFrame, window: int, unit: int, path: str, end: int
) -> DataFrame:
    def run(batches):
        task, vocabulary, seen = TaskContext.get().partitionId(), word_bpe(path), Counter()
        for batch in batches:
            rows = {name: [] for name in PIECE.names}
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = np.array([*vocabulary.ids(text.as_py() or ""), end], "<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    bin = -(-len(piece) // unit)
                    values = (doc_id.as_py(), start, len(piece), zlib.crc32(piece.tobytes()))
                    for name, value in zip(PIECE.names, (*values, len(ids), bin, task, seen[bin])):
                        rows[name].append(value)
                    seen[bin] += 1
            yield batch_of(rows, PIECE)

    return map_arrow(documents(docs), run, PIECE_TYPE)


# --- the plan, on the histogram ---------------------------------------------------------


def strategies(bins: int, depth: int) -> list[tuple[int, ...]]:
    """All ways to fill ``bins`` with up to ``depth`` parts, each in falling order."""

    def fill(left: int, most: int, parts: int):
        if left == 0:
            yield ()
        elif parts:
            for part in range(min(left, most), 0, -1):
                if part * parts < left:
                    break
                for rest in fill(left - part, part, parts - 1):
                    yield (part, *rest)

    return list(fill(bins, bins, depth))


def non_negative_least_squares(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """x >= 0 with the smallest |matrix x - target|, by an active set."""
    x = np.zeros(matrix.shape[1])
    active = np.zeros(matrix.shape[1], bool)
    scale = max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(3 * matrix.shape[0]):
        gain = matrix.T @ (target - matrix @ x)
        gain[active] = -np.inf
        if gain.max(initial=-np.inf) <= 1e-9 * scale:
            break
        active[gain.argmax()] = True
        while True:
            trial = np.zeros_like(x)
            trial[active] = np.linalg.lstsq(matrix[:, active], target, rcond=None)[0]
            if trial[active].min(initial=0) >= 0:
                break
            falling = active & (trial < 0)
            step = (x[falling] / (x[falling] - trial[falling])).min()
            x += step * (trial - x)
            active &= x > 1e-12 * scale
            x[~active] = 0
        x = trial
    return x


def plan_patterns(
    histogram: dict[int, int], bins: int, depth: int
) -> list[tuple[dict[int, int], int]]:
    """Patterns (how often each bin is used) with repeats that use up the whole histogram."""
    left = np.zeros(bins + 1, np.int64)
    for bin, n in histogram.items():
        left[bin] = n
    patterns = []
    usable = [Counter(s) for s in strategies(bins, depth) if left[list(s)].all()]
    if usable:
        matrix = np.zeros((bins + 1, len(usable)))
        for column, use in enumerate(usable):
            for bin, n in use.items():
                matrix[bin, column] = n
        wanted = non_negative_least_squares(matrix, left.astype(float))
        for column in np.argsort(-wanted, kind="stable"):
            use = usable[column]
            repeats = min(int(wanted[column]), *(int(left[b]) // n for b, n in use.items()))
            if repeats > 0:
                patterns.append((dict(use), repeats))
                for bin, n in use.items():
                    left[bin] -= n * repeats
    for longest in range(bins, 0, -1):
        while left[longest]:
            use, room = Counter(), bins
            for bin in range(longest, 0, -1):
                fits = min(room // bin, int(left[bin]))
                if fits:
                    use[bin], room = fits, room - fits * bin
            repeats = min(int(left[b]) // n for b, n in use.items())
            patterns.append((dict(use), repeats))
            for bin, n in use.items():
                left[bin] -= n * repeats
    return patterns


def places(patterns: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each bin: the rank at which each use of it begins, its first sequence, its count."""
    found: dict[int, list] = {}
    taken, sequence = Counter(), 0
    for use, repeats in patterns:
        for bin, n in use.items():
            found.setdefault(bin, []).append((taken[bin], sequence, n))
            taken[bin] += n * repeats
        sequence += repeats
    return {bin: tuple(np.array(rows, np.int64).T) for bin, rows in found.items()}


def pack(
    docs: DataFrame,
    window: int = 4096,
    unit: int = 16,
    depth: int = 3,
    path: str | None = None,
    end: int = 2,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, its end id included, is in exactly one piece. A null or empty
    text is its end id alone; null ids and repeated rows are packed as they come; an empty
    table gives no rows. Pieces of a sequence lie side by side from offset 0.
    """
    if window % unit:
        raise ValueError("the window must be a multiple of the unit")
    path = path or public_tokenizers.path("word_bpe_49k.json")
    pieces = stored_table(cut_pieces(docs, window, unit, path, end), "pieces")
    counts = stored_table(pieces.groupBy("task", "bin").count(), "piece_counts")
    histogram = {r.bin: r.n for r in counts.groupBy("bin").agg(F.sum("count").alias("n")).collect()}
    lookup = places(plan_patterns(histogram, window // unit, depth))
    before = Window.partitionBy("bin").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "bin", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))

    def place(batches):
        for batch in batches:
            bins = batch.column("bin").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence = np.empty(len(bins), np.int64)
            for bin in np.unique(bins):
                rows = bins == bin
                starts, first, n = lookup[int(bin)]
                at = np.searchsorted(starts, ranks[rows], "right") - 1
                sequence[rows] = first[at] + (ranks[rows] - starts[at]) // n[at]
            yield batch.append_column("sequence_id", pa.array(sequence))

    ranked = pieces.join(offsets, ["task", "bin"]).withColumn("rank", F.col("nth") + F.col("before"))
    ranked = ranked.select(*PIECE.names[:6], "rank")
    placed = map_arrow(
        ranked, place, PIECE_TYPE.replace("task int, nth long", "rank long, sequence_id long")
    )
    earlier = (
        Window.partitionBy("sequence_id")
        .orderBy(F.col("bin").desc(), "rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        *PIECE.names[:5],
        "sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"),
    )
