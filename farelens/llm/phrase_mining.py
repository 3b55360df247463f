"""Collocations by prefix-free parsing.

Texts are lower-cased and split into pieces at punctuation and line ends, pieces into words. A long
piece is parsed into overlapping chunks: a chunk ends where a window of ``OVERLAP`` words has a
checksum divisible by ``divisor``, and the next one begins with that window; a piece of up to
``SHORT`` words is one chunk. Cuts depend on words alone, so repeated passages give the same chunks
wherever they stand. Distinct chunks with their parse frequencies are the dictionary; everything
after works on them, weighted.

No phrase is longer than ``OVERLAP`` + 1 words, so each occurrence begins in exactly one chunk before
that chunk's last window (or anywhere in the last chunk of a piece). There it is counted; an
occurrence within an overlap belongs to the chunk that follows. Each chunk says how many of its words
may begin a phrase.

Only phrases of frequency ``least`` or more matter, as candidates, parts and containers. They are
counted in three rounds over blocks of the dictionary: words; pairs of frequent words; longer phrases
all of whose pairs are frequent. A round sums equal phrases of a block in the block's task, then over
blocks, and tells each block which of *its own* phrases are frequent. No list of the corpus is
collected or broadcast. A block gives one row per phrase, so the hottest phrase has as many rows as
there are blocks, a share of one in the number of phrases of a block.
"""

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from re import compile as pattern

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import Words, cogroup_arrow, dump, load, map_arrow, stored_table

MOST_WORDS = 5
OVERLAP = MOST_WORDS - 1
#: Words of a piece that is not parsed.
SHORT = 16
PIECES = pattern(rb"[.,;:!?\x0A-\x0D]+").split
BLANKS = pattern(rb"[\x20\x09]+").sub

CHUNK = pa.schema(
    [("lang", pa.string()), ("begins", pa.int32()), ("chunk", pa.binary()), ("times", pa.int64())]
)
CHUNK_TYPE = "lang string, begins int, chunk binary, times long"
BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("lang", pa.string()),
        ("words", pa.binary()),
        ("ids", pa.binary()),
        ("sizes", pa.binary()),
        ("begins", pa.binary()),
        ("times", pa.binary()),
    ]
)
BLOCK_TYPE = (
    "block long, lang string, words binary, ids binary, sizes binary, begins binary, times binary"
)
COUNT = pa.schema(
    [("block", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())]
)
COUNT_TYPE = "block long, lang string, phrase string, n long"

# --- the parse --------------------------------------------------------------------------


class Parser:
    """Chunks of texts. Checksums of words are kept while a task meets them again."""

    def __init__(self, divisor: int, most_words: int = 1 << 18) -> None:
        self.divisor, self.most_words = divisor, most_words
        self.sums: dict[bytes, int] = {}

    def checksum(self, word: bytes) -> int:
        found = self.sums.get(word)
        if found is None:
            if len(self.sums) > self.most_words:
                self.sums.clear()
            found = self.sums[word] = zlib.crc32(word)
        return found

    def cuts(self, words: list[bytes]) -> list[int]:
        """Where the windows begin that end a chunk, in a piece."""
        sums = np.fromiter(map(self.checksum, words), np.uint64, len(words))
        last = len(sums) - OVERLAP  # the window there ends the piece
        window = np.zeros(last, np.uint64)
        for n in range(OVERLAP):
            window = window * np.uint64(0x9E3779B97F4A7C15) + sums[n : last + n]
        marked = (window >> np.uint64(32)) % np.uint64(self.divisor) == 0
        return (np.flatnonzero(marked[1:]) + 1).tolist()  # the first window begins the first chunk

    def parse(self, text: bytes) -> tuple[list[bytes], list[tuple[int, bytes]]]:
        """The pieces that are chunks as they are, and the chunks of longer ones, each with the
        number of its words that may begin a phrase."""
        text = text.lower()
        if b"\t" in text or b"  " in text:
            text = BLANKS(b" ", text)
        pieces = [p.strip(b" ") for p in PIECES(text)]
        whole = [p for p in pieces if p and p.count(b" ") < SHORT]
        cut = []
        for piece in (p for p in pieces if p.count(b" ") >= SHORT):
            words, start = piece.split(b" "), 0
            for end in self.cuts(words):
                cut.append((end - start, b" ".join(words[start : end + OVERLAP])))
                start = end
            cut.append((len(words) - start, b" ".join(words[start:])))
        return whole, cut


def dictionary(docs: DataFrame, divisor: int, most_bytes: int = 32 << 20) -> DataFrame:
    """Distinct chunks per language, with how often the parse has them. A task holds chunks of
    about ``most_bytes`` before it hands them on."""

    def run(batches):
        parser, size = Parser(divisor), 0
        whole, cut = defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if not text.is_valid:
                    continue
                pieces, chunks = parser.parse(text.as_buffer().to_pybytes())
                whole[lang].update(pieces)
                cut[lang].update(chunks)
                size += sum(map(len, pieces)) + sum(len(chunk) for _, chunk in chunks)
                if size > most_bytes:  # of all chunks: distinct ones are fewer
                    yield from chunk_rows(whole, cut)
                    whole, cut, size = defaultdict(Counter), defaultdict(Counter), 0
        yield from chunk_rows(whole, cut)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    texts = docs.select(lang, F.col("text").cast("string").alias("text"))
    chunks = map_arrow(texts, run, CHUNK_TYPE)
    return chunks.groupBy("lang", "begins", "chunk").agg(F.sum("times").alias("times"))


def chunk_rows(whole: dict[str, Counter], cut: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, counted in whole.items():
        begins = [chunk.count(b" ") + 1 for chunk in counted]
        yield chunk_batch(lang, begins, list(counted), list(counted.values()))
    for lang, counted in cut.items():
        begins, chunks = zip(*counted) if counted else ((), ())
        yield chunk_batch(lang, begins, chunks, list(counted.values()))


def chunk_batch(lang: str, begins, chunks, times) -> pa.RecordBatch:
    columns = ([lang] * len(times), begins, chunks, times)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, CHUNK)], schema=CHUNK)


# --- blocks of the dictionary -----------------------------------------------------------


def in_blocks(chunks: DataFrame, most_bytes: int) -> DataFrame:
    """The dictionary as numbered blocks of one language and about so many bytes: the distinct
    words, all chunks as numbers of words, and per chunk its size, beginnings and times."""

    def run(batches):
        task, number, held, sizes = TaskContext.get().partitionId(), 0, defaultdict(list), Counter()
        for batch in batches:
            for lang in batch.column("lang").unique().to_pylist():
                rows = batch.filter(pc.equal(batch.column("lang"), lang))
                held[lang].append(rows)
                sizes[lang] += rows.column("chunk").nbytes + 8 * len(rows)
                if sizes[lang] > most_bytes:
                    yield block_row(task << 32 | number, lang, held.pop(lang))
                    number, sizes[lang] = number + 1, 0
        for lang in list(held):
            yield block_row(task << 32 | number, lang, held.pop(lang))
            number += 1

    return map_arrow(chunks, run, BLOCK_TYPE)


def block_row(block: int, lang: str, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts)
    chunks = rows.column("chunk").to_pylist()
    words = Words()
    ids = words.numbers(b" ".join(chunks).split(b" ")).astype(np.int32)
    sizes = np.fromiter((c.count(b" ") + 1 for c in chunks), np.int32, len(chunks))
    spelled = np.frombuffer(b" ".join(words.order), np.uint8)
    arrays = (spelled, ids, sizes, rows.column("begins").to_numpy(), rows.column("times").to_numpy())
    values = (block, lang, *map(dump, arrays))
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, BLOCK)], schema=BLOCK)


class Block:
    """A block taken apart: per word its number, its weight as the beginning of a phrase (zero in
    an overlap), and how many words its chunk has from there on."""

    def __init__(self, row: dict) -> None:
        self.block, self.lang = row["block"], row["lang"]
        self.words = load(row["words"], "u1").tobytes().split(b" ")
        self.ids = load(row["ids"], "i4").astype(np.int64)
        sizes, begins = load(row["sizes"], "i4").astype(np.int64), load(row["begins"], "i4")
        ends = np.repeat(np.cumsum(sizes), sizes)
        position = np.arange(len(self.ids))
        self.rest = ends - position
        begun = np.repeat(sizes, sizes) - self.rest < np.repeat(begins, sizes)
        self.weights = np.where(begun, np.repeat(load(row["times"], "i8"), sizes), 0)

    def numbered(self, phrases: list[str], length: int) -> np.ndarray:
        """Phrases of this block as rows of word numbers."""
        number = {word: n for n, word in enumerate(self.words)}
        words = " ".join(phrases).encode().split(b" ") if phrases else []
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words)).reshape(-1, length)

    def sums(self, at: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of phrases at the places ``at``: one place of each, its weight, and each one's number."""
        _, first, number = np.unique(codes, return_index=True, return_inverse=True)
        weights = np.zeros(len(first), np.int64)
        np.add.at(weights, number, self.weights[at])
        return at[first], weights, number

    def rows(self, at: np.ndarray, length: int, weights: np.ndarray) -> pa.Table:
        """Counts of the phrases of ``length`` words at these places."""
        spelled = np.array(self.words, object)[self.ids[at[:, None] + np.arange(length)]]
        phrases = spelled[:, 0].tolist() if length == 1 else [b" ".join(p) for p in spelled.tolist()]
        columns = ([self.block] * len(at), [self.lang] * len(at), phrases, weights)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, COUNT)], schema=COUNT)

    def count_words(self) -> pa.Table:
        at, weights, _ = self.sums(np.arange(len(self.ids)), self.ids)
        return self.rows(at, 1, weights)

    def count_pairs(self, frequent: list[str]) -> pa.Table:
        """Pairs of frequent words; those in an overlap too, with weight zero, so that the block
        learns whether they are frequent."""
        known = np.zeros(len(self.words), bool)
        known[self.numbered(frequent, 1)[:, 0]] = True
        at = np.flatnonzero((self.rest[:-1] >= 2) & known[self.ids[:-1]] & known[self.ids[1:]])
        at, weights, _ = self.sums(at, self.pair_codes(at))
        return self.rows(at, 2, weights)

    def pair_codes(self, at: np.ndarray) -> np.ndarray:
        return self.ids[at] * len(self.words) + self.ids[at + 1]

    def count_longer(self, frequent: list[str]) -> pa.Table:
        """Phrases of three words and more all of whose pairs are frequent."""
        pairs = self.numbered(frequent, 2)
        at = np.flatnonzero(self.rest >= 2)
        whole = np.zeros(len(self.ids) + MOST_WORDS, bool)
        known = np.isin(self.pair_codes(at), pairs[:, 0] * len(self.words) + pairs[:, 1])
        whole[at[known]] = True
        at = at[known & (self.weights[at] > 0)]
        codes, found = self.pair_codes(at), []
        for length in range(3, MOST_WORDS + 1):
            # A pair never reaches over the end of a chunk, so neither do pairs in a row.
            on = whole[at + length - 2]
            at, codes = at[on], np.unique(codes[on], return_inverse=True)[1]
            codes = codes * len(self.words) + self.ids[at + length - 1]
            first, weights, _ = self.sums(at, codes)
            found.append(self.rows(first, length, weights))
        return pa.concat_tables(found)


# --- rounds -----------------------------------------------------------------------------


def frequent_in_blocks(counts: DataFrame, least: int, label: str) -> DataFrame:
    """Per block its phrases that are frequent in the corpus, with their frequency ``f``."""
    # The window sorts its rows; by a hash first, as most phrases of a language begin alike.
    counts = counts.repartition("lang", "phrase").withColumn("hash", F.xxhash64("phrase"))
    f = F.sum("n").over(Window.partitionBy("hash", "phrase", "lang"))
    frequent = counts.select("block", "lang", "phrase", f.alias("f")).filter(F.col("f") >= least)
    return stored_table(frequent, label)


def count_round(blocks: DataFrame, told: DataFrame, method: str) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [Block(row) for row in left.to_pylist()]
        phrases = right.column("phrase").to_pylist()
        return pa.concat_tables([getattr(b, method)(phrases) for b in parts] or [COUNT.empty_table()])

    return cogroup_arrow(blocks, told.select("block", "phrase"), "block", run, COUNT_TYPE)


def count_words(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from Block(row).count_words().to_batches(max_chunksize=1 << 16)

    return map_arrow(blocks, run, COUNT_TYPE)


def phrase_counts(
    docs: DataFrame, least: int, divisor: int, most_bytes: int
) -> tuple[DataFrame, DataFrame]:
    """All phrases of frequency ``least`` or more (lang, phrase, f), and the words of each lang."""
    blocks = stored_table(in_blocks(dictionary(docs, divisor), most_bytes), "phrase_blocks")
    counts = stored_table(count_words(blocks), "phrase_words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = frequent_in_blocks(counts, least, "frequent_words")
    pairs = count_round(blocks, words, "count_pairs")
    pairs = frequent_in_blocks(pairs, least, "frequent_pairs")
    longer = count_round(blocks, pairs, "count_longer").groupBy("lang", "phrase")
    longer = longer.agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    short = [t.select("lang", "phrase", "f").distinct() for t in (words, pairs)]
    return stored_table(short[0].union(short[1]).union(longer), "frequent_phrases"), totals


# --- scores -----------------------------------------------------------------------------


def collocations(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates that no longer one makes superfluous, with their lowest cut."""
    words = F.split("phrase", " ")
    candidates = frequent.withColumn("words", words).filter(F.size("words") > 1)
    candidates = candidates.select("lang", "phrase", "words", F.col("f").alias("a"))

    def part(start, size):
        return F.array_join(F.slice("words", start, size), " ")

    k, size = F.col("k"), F.size("words")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", part(F.lit(1), k).alias("first"), part(k + 1, size - k).alias("rest")
    )
    for side, name in (("first", "l"), ("rest", "r")):
        known = frequent.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = cuts.join(known, ["lang", side])
    exact = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")}
    above, below = exact["a"] * exact["n"] * 1000, exact["l"] * exact["r"]
    cuts = cuts.join(totals, "lang").withColumns({"above": above, "below": below})
    cuts = cuts.withColumn("score", F.expr("above div below"))
    lowest = F.min(F.struct("score", "k", "l", "r", "n")).alias("lowest")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest)

    begin, length = F.col("part.begin"), F.col("part.length")
    parts = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), length -> transform("
        "sequence(1, size(words) - length + 1), begin -> struct(begin, length))))"
    )
    inside = candidates.filter(F.size("words") > 2).withColumn("part", F.explode(parts))
    inside = inside.select("lang", part(begin, length).alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(
        "longer IS NULL OR longer * 100 < a * 100"
    )
    return kept.select("lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.n", "lowest.score")


def mine_phrases(
    docs: DataFrame,
    least: int = 100,
    top: int = 2000,
    divisor: int = 16,
    most_bytes: int = 16 << 20,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A null language counts as ``und``; a null or empty text has no words; repeated rows count each;
    ties go by frequency, then by the phrase's bytes; a table without a frequent phrase gives no rows;
    other columns of the caller are not read. Frequencies and scores are exact: scores are whole
    quotients of decimals of 38 digits.
    """
    frequent, totals = phrase_counts(docs, least, divisor, most_bytes)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(frequent, totals).withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
