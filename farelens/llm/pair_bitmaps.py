"""Alignment of two tokenizers' tokens by an inverted index of pair bitmaps.

Two tokens are linked where they end at the same byte of a text. The index has, for each pair of
ids and each block of at most 65,536 documents, compressed bitmaps of the documents:

- *Planes.* Plane p holds the documents in which bit p of the pair's number of links is set, so
  links = sum over planes of 2^p * popcount. Most pairs have the one plane 0.
- *Documents.* The planes of a pair, OR-merged and popcounted, are its documents.
- *Containers.* A bitmap of up to 4,096 documents is an ascending array of 16-bit places in the
  block, a fuller one 65,536 bits.

Blocks hold different documents, so totals of a pair are sums of popcounts; no bitmap of a whole
corpus is ever built. Pair totals go back to the postings and each block's postings spread them over
its documents. A pair that every block holds has as many postings as there are blocks; they are cut
into salted groups of about ``most_postings``, so neither sums nor scores of a pair meet in one task.
"""

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.byte_bpe import byte_bpe
from farelens.llm.common import (
    batch_of,
    cogroup_arrow,
    documents,
    map_arrow,
    stored_table,
    text_slices,
)

PLACES = 1 << 16
#: Documents of a fuller container are bits.
MOST_IN_ARRAY = 4096
B_BITS = 15

ENTRY = pa.schema(
    [
        ("block", pa.int64()),
        ("place", pa.int32()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("pair", pa.int64()),
        ("plane", pa.int32()),
        ("ones", pa.int64()),
        ("docs", pa.int64()),
        ("bitmap", pa.binary()),
    ]
)
ENTRY_TYPE = (
    "block long, place int, doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, "
    "pair long, plane int, ones long, docs long, bitmap binary"
)
DOCUMENT = ENTRY.names[:7]
POSTING = ["block", *ENTRY.names[7:]]

# --- one text ---------------------------------------------------------------------------


class Pieces:
    """Ids of the second vocabulary, with the bytes that each stands for."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        if len(self.processor) > 1 << B_BITS:
            raise ValueError(f"more than {1 << B_BITS} pieces")
        self.bytes = [self.bytes_of(i) for i in range(len(self.processor))]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def bytes_of(self, i: int) -> bytes:
        piece = self.processor.id_to_piece(i)
        if self.processor.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Spelling:
    """Decimal ids with what follows them: tokens of a group are joined by commas, its sides by a
    bar, groups by semicolons."""

    def __init__(self, n_a: int, n_b: int) -> None:
        numbers = [str(i) for i in range(max(n_a, n_b))]
        self.ends = [",", "|", ",", ";"]
        self.starts = np.cumsum([0, n_a, n_a, n_b])
        self.words = [
            number + end for end, n in zip(self.ends, (n_a, n_a, n_b, n_b)) for number in numbers[:n]
        ]

    def sha256(self, a, b, last_a, last_b) -> str:
        """``last_a`` and ``last_b`` are the positions of the last token of each group."""
        codes = np.empty(len(a) + len(b), np.int64)
        ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        ends_a[last_a], ends_b[last_b] = True, True
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        before = np.concatenate(([0], last_b + 1))  # tokens of B in earlier groups
        codes[np.arange(len(a)) + before[group_a]] = a + self.starts[ends_a.astype(int)]
        codes[np.arange(len(b)) + last_a[group_b] + 1] = b + self.starts[2 + ends_b]
        text = "".join(map(self.words.__getitem__, codes.tolist()))
        return hashlib.sha256(text[:-1].encode()).hexdigest()


@lru_cache(maxsize=2)
def spelling(n_a: int, n_b: int) -> Spelling:
    return Spelling(n_a, n_b)


# --- postings of a block ----------------------------------------------------------------


def containers(keys: np.ndarray, plane: int) -> dict:
    """Postings of ascending pair << 16 | place: one per pair, with its bitmap."""
    pair, place = keys >> 16, (keys & (PLACES - 1)).astype("<u2")
    starts = np.flatnonzero(np.diff(pair, prepend=-1))
    ends = np.append(starts[1:], len(pair))
    sizes = ends - starts
    if sizes.max(initial=0) <= MOST_IN_ARRAY:
        offsets = np.append(starts, len(pair)).astype(np.int32) * 2
        bitmap = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(place)]
        )
    else:
        bitmap = pa.array([container(place[i:j]) for i, j in zip(starts, ends)], pa.binary())
    return {"pair": pair[starts], "plane": np.full(len(starts), plane), "ones": sizes, "bitmap": bitmap}


def container(places: np.ndarray) -> bytes:
    if len(places) <= MOST_IN_ARRAY:
        return places.tobytes()
    bits = np.zeros(PLACES, bool)
    bits[places] = True
    return np.packbits(bits, bitorder="little").tobytes()


def places_in(bitmap: bytes, ones: int) -> np.ndarray:
    if ones <= MOST_IN_ARRAY:
        return np.frombuffer(bitmap, "<u2")
    bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")
    return np.flatnonzero(bits).astype("<u2")


def merged(bitmaps: list[tuple[bytes, int]]) -> int:
    """Documents in the OR of the planes of a pair."""
    places = [places_in(bitmap, ones) for bitmap, ones in bitmaps]
    if sum(map(len, places)) <= MOST_IN_ARRAY:
        return len(set().union(*(p.tolist() for p in places)))
    bits = np.zeros(PLACES, bool)
    for ones in places:
        bits[ones] = True
    return int(bits.sum())


class Block:
    """Links of up to 65,536 documents, and the postings made of them."""

    def __init__(self, most_links: int) -> None:
        self.most_links = most_links
        self.clear()

    def clear(self) -> None:
        self.documents, self.n_links, self.links = 0, 0, []

    def add(self, pair: np.ndarray) -> int:
        """Count the links of one more document; its place in the block."""
        self.links.append(pair << 16 | self.documents)
        self.n_links += len(pair)
        self.documents += 1
        return self.documents - 1

    def is_full(self) -> bool:
        return self.documents == PLACES or self.n_links > self.most_links

    def postings(self) -> list[dict]:
        if not self.n_links:
            return []
        keys, links = np.unique(np.concatenate(self.links), return_counts=True)
        found = [containers(keys[links >> p & 1 == 1], p) for p in range(int(links.max()).bit_length())]
        found = [plane for plane in found if len(plane["pair"])]
        self.count_documents(found)
        return found

    @staticmethod
    def count_documents(planes: list[dict]) -> None:
        """``docs`` of a pair stand on the first of its planes, the others have zero."""
        for plane in planes:
            plane["docs"] = plane["ones"].copy()
        at = {}
        for n, plane in enumerate(planes):
            for row, pair in enumerate(plane["pair"].tolist() if n else []):
                at.setdefault(pair, []).append((n, row))
        if not at:
            return
        several = np.array(sorted(at), np.int64)
        base = planes[0]["pair"]
        where = np.searchsorted(base, several)
        for pair, row in zip(several.tolist(), where.tolist()):
            rows = at[pair]
            if row < len(base) and base[row] == pair:
                rows = [(0, row), *rows]
            parts = [(planes[n]["bitmap"][r].as_py(), int(planes[n]["ones"][r])) for n, r in rows]
            first, *others = rows
            planes[first[0]]["docs"][first[1]] = merged(parts) if others else parts[0][1]
            for n, r in others:
                planes[n]["docs"][r] = 0


def index_documents(docs: DataFrame, path_a: str, path_b: str, most_links: int) -> DataFrame:
    """One row per document and one per posting, told apart by ``pair``."""

    def run(batches):
        a_side, b_side = byte_bpe(path_a), pieces(path_b)
        spell = spelling(len(a_side.sizes), len(b_side.sizes))
        task, number, block = TaskContext.get().partitionId(), 0, Block(most_links)

        def flush():
            for plane in block.postings():
                n = len(plane["pair"])
                yield entries(plane | {"block": np.full(n, task << 32 | number)}, n)
            block.clear()

        for batch in text_slices(batches, 2 << 20):
            rows = {name: [] for name in DOCUMENT}
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, text, ids_b in zip(batch.column("doc_id"), texts, b_side.ids(texts)):
                # Ids of A always spell the text; those of B may not.
                whole = text != "" and b_side.spell(ids_b) == b" " + text.encode()
                a = np.array(a_side.plain(" " + text) if whole else [], np.int64)
                b = np.array(ids_b if whole else [], np.int64)
                ends_a, ends_b = np.cumsum(a_side.sizes[a]), np.cumsum(b_side.sizes[b])
                shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
                last_a, last_b = np.searchsorted(ends_a, shared), np.searchsorted(ends_b, shared)
                place = block.add(a[last_a] << B_BITS | b[last_b])
                sha256 = spell.sha256(a, b, last_a, last_b) if whole else ""
                values = (task << 32 | number, place, doc_id.as_py(), len(a), len(b), len(shared), sha256)
                for name, value in zip(DOCUMENT, values):
                    rows[name].append(value)
                if block.is_full():
                    yield from flush()
                    number += 1
            yield entries(rows, len(rows["place"]))
        yield from flush()

    return map_arrow(documents(docs), run, ENTRY_TYPE)


def entries(columns: dict, n: int) -> pa.RecordBatch:
    """Rows of the index; columns that are not given are null."""
    return batch_of({f.name: columns.get(f.name, pa.nulls(n, f.type)) for f in ENTRY}, ENTRY)


# --- totals, and back to documents ------------------------------------------------------


def pair_totals(postings: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Totals per pair, and which salted groups of postings each pair has."""
    per_salt = stored_table(
        postings.groupBy("pair", salt_of(salts).alias("salt")).agg(
            F.sum(F.col("ones") * F.expr("shiftleft(1L, plane)")).alias("links"),
            F.sum("docs").alias("docs"),
        ),
        "pair_groups",
    )
    totals = per_salt.groupBy("pair").agg(F.sum("links").alias("links"), F.sum("docs").alias("docs"))
    # An id of B has at most as many pairs as A has ids.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << B_BITS) - 1))
    best = F.col("links") == F.max("links").over(of_b)
    return stored_table(totals.withColumn("best", best), "pair_totals"), per_salt


def salt_of(salts: int):
    return F.pmod(F.xxhash64("block"), F.lit(salts))


class Alignment:
    """The index of a table of documents and the totals of its pairs."""

    def __init__(
        self,
        docs: DataFrame,
        path_a: str | None = None,
        path_b: str | None = None,
        most_links: int = 1 << 21,
        most_postings: int = 1000,
    ) -> None:
        path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
        index = stored_table(index_documents(docs, path_a, path_b, most_links), "pair_index")
        self.documents = index.filter("pair IS NULL").select(*DOCUMENT)
        self.postings = index.filter("pair IS NOT NULL").select(*POSTING)
        blocks = self.documents.select("block").distinct().count()
        self.salts = -(-blocks // most_postings) or 1
        self.totals, self.per_salt = pair_totals(self.postings, self.salts)

    def pairs(self) -> DataFrame:
        """One row per pair: a_id, b_id, links, docs, best (none of its b_id has more links)."""
        return self.totals.select(
            F.shiftright("pair", B_BITS).alias("a_id"),
            F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b_id"),
            "links",
            "docs",
            "best",
        )

    def scores(self) -> DataFrame:
        """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
        scored = self.per_salt.select("pair", "salt").join(
            self.totals.select("pair", "links", "best"), "pair"
        )
        back = self.postings.withColumn("salt", salt_of(self.salts)).join(scored, ["pair", "salt"])
        # An alias, as both sides of the cogroup come from one table.
        back = back.select(
            F.col("block").alias("block"), "plane", "ones", "bitmap", "links", "best"
        )
        return cogroup_arrow(self.documents, back, "block", spread, SCORE_TYPE)


SCORE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("n_best", pa.int64()),
        ("count_sum", pa.int64()),
        ("groups_sha256", pa.string()),
    ]
)
SCORE_TYPE = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def spread(documents: pa.Table, postings: pa.Table) -> pa.Table:
    """Sums over each document of a block, from the postings that name it."""
    count_sum, n_best = np.zeros(PLACES, np.int64), np.zeros(PLACES, np.int64)
    for batch in postings.to_batches(max_chunksize=4096):
        ones = batch.column("ones").to_numpy()
        bitmaps = batch.column("bitmap").to_pylist()
        places = np.concatenate([places_in(b, n) for b, n in zip(bitmaps, ones.tolist())])
        times = np.left_shift(1, batch.column("plane").to_numpy().astype(np.int64))
        best = batch.column("best").to_numpy(zero_copy_only=False)
        np.add.at(count_sum, places, np.repeat(batch.column("links").to_numpy() * times, ones))
        np.add.at(n_best, places, np.repeat(best * times, ones))
    place = documents.column("place").to_numpy()
    sums = {"n_best": pa.array(n_best[place]), "count_sum": pa.array(count_sum[place])}
    # A group has one link: its last token on either side.
    columns = sums | {"n_groups": documents.column("n_links")}
    return pa.table(
        [columns[n] if n in columns else documents.column(n) for n in SCORE.names], schema=SCORE
    )


def align_tokens(docs: DataFrame, **options) -> DataFrame:
    """Per document its tokens, groups and links, and how its links stand in the corpus.

    A text that is null, empty, or not spelled by both tokenizers has no tokens: zeros and an empty
    ``groups_sha256``. Null ids and repeated rows count as documents of their own; ties for the best
    pair of an id of B all count; an empty table gives no rows; other columns of the caller are not
    read. Special tokens' strings in a text are plain text.
    """
    return Alignment(docs, **options).scores()
