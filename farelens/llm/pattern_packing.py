"""Best-fit packing of whole documents by patterns of a few lengths.

A document is its token ids and one end id. Only documents longer than a window are cut, into
full windows after a first piece that holds the rest. The histogram of piece lengths, at most
``window`` numbers, comes to the driver, and the plan is made there:

1. Every combination of a few lengths, in bins of ``unit`` ids, that fills a window is a pattern. Non-negative least squares finds how often to repeat each so that together they use up
   the histogram; repeats are rounded down.
2. A pattern becomes sequences of real lengths: the longest of each bin, and in the last two places
   those that leave the least room, which takes back what the bins rounded up.
3. The rest is packed best fit, longest first, into the room that is left and into new sequences.

Equal sequences are kept as one class with a number of repeats, so the plan's size follows the
number of lengths and not the number of documents. The n-th piece of a length belongs to the class
whose range covers n, which gives its sequence and its offset without a sort or a meeting of the
pieces; n comes from counters per task and a table of counts per task and length. The plan is made
for patterns of up to two, up to three, ... ``depth`` lengths, and the one with the fewest sequences
is used.
"""

import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.byte_bpe import byte_bpe
from farelens.llm.common import batch_of, documents, map_arrow, stored_table
from farelens.llm.histogram_packing import non_negative_least_squares

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("task", pa.int32()),
        ("nth", pa.int64()),
    ]
)
PIECE_TYPE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
RESULT = PIECE.names[:5]


def piece_starts(n_ids: int, window: int) -> list[int]:
    """Where the pieces of a document begin: the first may be shorter, the others are full."""
    return [0, *range(n_ids % window or window, n_ids, window)]


def cut_pieces(docs: DataFrame, window: int, path: str, end: int) -> DataFrame:
    def run(batches):
        task, vocabulary, seen = TaskContext.get().partitionId(), byte_bpe(path), Counter()
        for batch in batches:
            rows = {name: [] for name in PIECE.names}
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = np.array([*vocabulary.ids(text.as_py() or ""), end], "<u4")
                starts = piece_starts(len(ids), window)
                for number, (start, stop) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    length, checksum = stop - start, zlib.crc32(ids[start:stop].tobytes())
                    values = (doc_id.as_py(), number, start, length, checksum, task, seen[length])
                    for name, value in zip(PIECE.names, values):
                        rows[name].append(value)
                    seen[length] += 1
            yield batch_of(rows, PIECE)

    return map_arrow(documents(docs), run, PIECE_TYPE)


# --- the plan, on the histogram ---------------------------------------------------------


def patterns(bins: int, depth: int, present: set[int]) -> list[tuple[int, ...]]:
    """Combinations of up to ``depth`` bins that occur and add up to ``bins``, longest first."""
    whole = [((b,), b) for b in sorted(present) if b <= bins]
    found, open_ends = [], whole
    for _ in range(depth):
        found += [parts for parts, total in open_ends if total == bins]
        open_ends = [
            ((*parts, b), total + b)
            for parts, total in open_ends
            for b in range(1, min(parts[-1], bins - total) + 1)
            if b in present
        ]
    return found


class Plan:
    """Classes of equal sequences: lengths in the order they lie there, repeats, room left."""

    def __init__(self, histogram: dict[int, int], window: int) -> None:
        self.window, self.left = window, +Counter(histogram)
        self.lengths = sorted(self.left)
        self.classes: list[tuple[tuple[int, ...], int]] = []
        self.rooms: dict[int, list[int]] = {}
        self.open: list[int] = []  # rooms that some class has, ascending

    def add(self, parts: tuple[int, ...], repeats: int) -> None:
        room = self.window - sum(parts)
        if room and room not in self.rooms:
            self.rooms[room] = []
            insort(self.open, room)
        if room:
            self.rooms[room].append(len(self.classes))
        self.classes.append((parts, repeats))

    def take(self, parts: tuple[int, ...], repeats: int) -> None:
        """Use up pieces; lengths of which none is left are forgotten."""
        for length, n in Counter(parts).items():
            self.left[length] -= n * repeats
            if not self.left[length]:
                del self.left[length]
                self.lengths.pop(bisect_left(self.lengths, length))

    def longest(self, low: int, high: int, used: Counter) -> int | None:
        """The longest length in [low, high] of which more pieces are left than ``used``."""
        at = bisect_left(self.lengths, high + 1) - 1
        while at >= 0 and self.lengths[at] >= low:
            if self.left[self.lengths[at]] > used[self.lengths[at]]:
                return self.lengths[at]
            at -= 1
        return None

    def closing(self, room: int, used: Counter, before: tuple[int, int] | None) -> tuple | None:
        """The last one or two lengths of a pattern, those that leave the least room. Of two, the
        first lies within the bounds ``before``; a pair that leaves nothing ends the search."""
        if before is None:
            last = self.longest(1, room, used)
            return None if last is None else (last,)
        best, (low, high) = None, before
        while (first := self.longest(low, min(high, room), used)) is not None:
            last = self.longest(1, room - first, used + Counter([first]))
            if last is not None and (best is None or first + last > sum(best)):
                best = (first, last)
                if first + last == room:
                    break
            high = first - 1
        return best

    def repeat(self, bins: tuple[int, ...], unit: int, repeats: int) -> None:
        """Sequences of a pattern of bins, as long as its lengths last."""
        bounds = [((bin - 1) * unit + 1, bin * unit) for bin in bins]
        while repeats:
            used, room = Counter(), self.window
            for low, high in bounds[:-2]:
                length = self.longest(low, min(high, room), used)
                if length is None:
                    return
                used[length] += 1
                room -= length
            ends = self.closing(room, used, bounds[-2] if len(bounds) > 1 else None)
            if ends is None:
                return
            used.update(ends)
            times = min(repeats, *(self.left[length] // n for length, n in used.items()))
            parts = tuple(sorted(used.elements(), reverse=True))
            self.add(parts, times)
            self.take(parts, times)
            repeats -= times

    def fill(self) -> None:
        """Best fit, longest first: the rest into the smallest room that holds it."""
        for length in reversed(list(self.lengths)):
            count = self.left.pop(length)
            while count:
                at = bisect_left(self.open, length)
                if at == len(self.open):
                    each = self.window // length
                    whole, rest = divmod(count, each)
                    if whole:
                        self.add((length,) * each, whole)
                    if rest:
                        self.add((length,) * rest, 1)
                    count = 0
                    continue
                room = self.open[at]
                number = self.rooms[room].pop()
                if not self.rooms[room]:
                    del self.rooms[room]
                    self.open.pop(at)
                parts, repeats = self.classes[number]
                each = room // length
                full = min(repeats, count // each)
                rest = count - full * each if full < repeats else 0
                # The class is split: some get all that fits, one the rest, others stay.
                self.classes[number] = ((), 0)
                for n, times in ((each, full), (rest, 1 if rest else 0)):
                    if times:
                        self.add(parts + (length,) * n, times)
                if kept := repeats - full - (1 if rest else 0):
                    self.add(parts, kept)
                count -= full * each + rest
        self.lengths = []


def plan(histogram: dict[int, int], window: int, unit: int, depth: int) -> list:
    """Classes (lengths, repeats) that hold every piece of the histogram once, in the fewest
    sequences over all depths. Deeper patterns serve tables without long documents, but use up
    short ones that would close small rooms."""
    plans = [fit_patterns(histogram, window, unit, d) for d in range(2, depth + 1)]
    return min(plans, key=lambda classes: sum(repeats for _, repeats in classes))


def fit_patterns(histogram: dict[int, int], window: int, unit: int, depth: int) -> list:
    made = Plan(histogram, window)
    if whole := made.left[window]:
        made.take((window,), whole)
        made.add((window,), whole)
    binned = Counter()
    for length, n in made.left.items():
        binned[-(-length // unit)] += n
    usable = patterns(window // unit, depth, set(binned))
    if usable:
        matrix = np.zeros((window // unit + 1, len(usable)))
        for column, bins in enumerate(usable):
            for bin in bins:
                matrix[bin, column] += 1
        target = np.zeros(window // unit + 1)
        target[list(binned)] = list(binned.values())
        wanted = non_negative_least_squares(matrix, target)
        for column in np.argsort(-wanted, kind="stable"):
            if int(wanted[column]):
                made.repeat(usable[column], unit, int(wanted[column]))
    made.fill()
    return [(parts, repeats) for parts, repeats in made.classes if repeats]


def places(classes: list) -> dict[int, np.ndarray]:
    """For each length, by row: the rank at which a use of it begins, the first sequence of that
    use, how many pieces of the length a sequence takes, and the offset of the first."""
    found: dict[int, list] = {}
    taken, sequence = Counter(), 0
    for parts, repeats in classes:
        offset = 0
        for length, n in Counter(parts).items():
            found.setdefault(length, []).append((taken[length], sequence, n, offset))
            taken[length] += n * repeats
            offset += n * length
        sequence += repeats
    return {length: np.array(rows, np.int64).T for length, rows in found.items()}


def pack_best_fit(
    docs: DataFrame,
    window: int = 2048,
    unit: int = 16,
    depth: int = 3,
    path: str | None = None,
    end: int = 0,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every id of every document, its end id included, is in exactly one piece, and pieces of a
    sequence lie side by side from offset 0. A null or empty text is its end id alone; null ids
    and repeated rows are packed as they come; ties of equal lengths are taken in the order of
    tasks; an empty table gives no rows; other columns of the caller are not read.
    """
    if window % unit:
        raise ValueError("the window must be a multiple of the unit")
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    pieces = stored_table(cut_pieces(docs, window, path, end), "best_fit_pieces")
    counts = stored_table(pieces.groupBy("task", "length").count(), "best_fit_counts")
    histogram = {
        r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()
    }
    lookup = places(plan(histogram, window, unit, depth))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )

    def place(batches):
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                rows = lengths == length
                start, first, n, base = lookup[int(length)]
                at = np.searchsorted(start, ranks[rows], "right") - 1
                turn = ranks[rows] - start[at]
                sequence[rows] = first[at] + turn // n[at]
                offset[rows] = base[at] + turn % n[at] * length
            columns = [batch.column(c) for c in RESULT] + [pa.array(sequence), pa.array(offset)]
            yield pa.record_batch(columns, names=[*RESULT, "sequence_id", "offset"])

    ranked = pieces.join(offsets, ["task", "length"])
    ranked = ranked.select(*RESULT, (F.col("nth") + F.col("before")).alias("rank"))
    return map_arrow(
        ranked,
        place,
        PIECE_TYPE.replace("task int, nth long", "sequence_id long, offset long"),
    )
