"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

Two fingerprints of 64 bits that differ in at most d bits agree in at least n - d of n blocks.
With n = 2d blocks every choice of d blocks is a join key of 32 bits, so a key is shared by
few unrelated fingerprints even among billions. Copies are one fingerprint before the join.

Fingerprints that crowd one key are not paired with each other: there, one side walks d - d//2
flips and the other d//2 over the free bits, and all that meet at one point are tied to the
smallest. A point counts only if something is within the smaller number of flips of it, which
makes every tie a chain of links of at most d bits. Work is then linear in the crowd.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import batch_of, documents, lower_words, map_arrow, stored_table
from farelens.llm.components import connected_components

BITS = 64
SCHEMA = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64())])


def fingerprint(text: str | None, shingle: int) -> int:
    """Bit i is set if more than half of the shingles have it in their XXH64 with seed 42."""
    words = lower_words(text)
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : at + (1 << 16)].tolist(), last[at : at + (1 << 16)].tolist())
        hashes = np.array([digest(joined[s:e], 42) for s, e in spans], np.uint64)
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and the fingerprint as a signed long in ``bits``. No shuffle.

    Null, empty and blank texts have fingerprint 0; texts with fewer words than a shingle have
    one shingle of all their words; texts of any length are read whole; repeated rows stay.
    """

    def run(batches):
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            bits = np.array(values, np.uint64).view(np.int64)
            yield batch_of({"doc_id": batch.column("doc_id"), "bits": bits}, SCHEMA)

    return map_arrow(documents(docs), run, "doc_id long, bits long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _block_masks(distance: int) -> list[int]:
    """For each choice of blocks the bits in it: ``distance`` of twice as many blocks."""
    n = 2 * distance
    edges = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [((1 << hi) - (1 << lo)) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, distance)]


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _crowd_links(crowded: DataFrame, masks: list[int], distance: int) -> DataFrame:
    near, far = distance // 2, distance - distance // 2
    spark = crowded.sparkSession
    flips = [
        (table, _signed(sum(1 << i for i in bits)), size <= near)
        for table, mask in enumerate(masks)
        for size in range(far + 1)
        for bits in combinations([i for i in range(BITS) if not mask >> i & 1], size)
    ]
    walk = spark.createDataFrame(flips, "choice int, flip long, close boolean")
    points = crowded.join(F.broadcast(walk), "choice")  # its size depends on distance alone
    points = points.select("choice", "bits", "close", F.col("bits").bitwiseXOR(F.col("flip")).alias("point"))
    hubs = points.groupBy("choice", "point").agg(
        F.min("bits").alias("hub"), F.max("close").alias("met"), F.count("bits").alias("n")
    )
    hubs = hubs.filter("met and n > 1").drop("met", "n")
    tied = points.join(hubs, ["choice", "point"]).filter("bits <> hub")
    return tied.select(F.col("bits").alias("a"), F.col("hub").alias("b")).distinct()


def close_links(distinct: DataFrame, distance: int = 3, crowd: int = 1000) -> DataFrame:
    """Links (a, b) with the same components as all pairs of ``bits`` that differ in at most
    ``distance`` bits. ``distinct`` holds each fingerprint once. All pairs are links unless more
    than ``crowd`` fingerprints share a key; those are tied as the module says."""
    if distance < 1:
        return distinct.select(F.col("bits").alias("a"), F.col("bits").alias("b")).limit(0)
    masks = _block_masks(distance)
    keys = F.array(*(F.col("bits").bitwiseAND(F.lit(_signed(m))) for m in masks))
    keyed = stored_table(distinct.select("bits", F.posexplode(keys).alias("choice", "key")), "blocks")
    sizes = keyed.groupBy("choice", "key").count()
    some = sizes.filter(F.col("count").between(2, crowd)).drop("count")
    left = keyed.join(some, ["choice", "key"])
    left, right = (left.withColumnRenamed("bits", name) for name in "ab")
    pairs = left.join(right, ["choice", "key"]).filter("a < b")
    pairs = pairs.filter(_differing("a", "b") <= distance).select("a", "b")
    if sizes.filter(F.col("count") > crowd).isEmpty():
        return pairs
    many = keyed.join(sizes.filter(F.col("count") > crowd).drop("count"), ["choice", "key"])
    return pairs.union(_crowd_links(many, masks, distance))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 3, crowd: int = 1000
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, kept.

    component_id is the smallest doc_id that can be reached over fingerprints at most
    ``distance`` bits apart, the document's own included. Null ids count as larger than any;
    a component without an id has a null component_id. ``kept`` marks one row per component:
    that with its smallest id (a null id is kept only in a component without any; of repeated
    rows with that id all are marked). An empty table gives no rows.
    """
    prints = stored_table(fingerprints(docs, shingle), "fingerprints")
    distinct = stored_table(
        prints.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "distinct"
    )
    groups = connected_components(close_links(distinct.select("bits"), distance, crowd))
    named = distinct.join(groups.withColumnRenamed("node", "bits"), "bits", "left")
    named = named.withColumn("component", F.coalesce("component", "bits"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stored_table(named.join(least, "component").select("bits", "component_id"), "named")
    return prints.join(named, "bits").select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _with_row_keys(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows with a key of their own that every read gives again, under names ``docs`` does not
    have: the file and the row's number in it. What has no files is numbered and stored first."""
    prefix = "_row"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    keys = [f"{prefix}file", f"{prefix}number"]
    try:
        place = ("_metadata.file_path", "_metadata.row_index")
        return docs.select("*", *(F.col(c).alias(k) for c, k in zip(place, keys))), keys
    except AnalysisException:
        number = F.monotonically_increasing_id()
        return stored_table(docs.withColumns(dict(zip(keys, (F.lit(""), number)))), "numbered"), keys


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each component, all columns as they are: that with the smallest doc_id, and of
    several such rows, or where no row has an id, the first by file and place.

    ``docs`` is a table of files as read, or a filter of one. Rows are told apart by file and place
    in it, so it does not matter how each of the two reads is split over tasks. Any other table is
    stored first. Columns of any name are kept.
    """
    marked, keys = _with_row_keys(docs)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("bits", pa.int64()), (keys[0], pa.string()), (keys[1], pa.int64())]
    )

    def run(batches):
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            bits = np.array(values, np.uint64).view(np.int64)
            columns = {c: batch.column(c) for c in ("doc_id", *keys)} | {"bits": bits}
            yield batch_of(columns, schema)

    rows = marked.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keys)
    prints = map_arrow(rows, run, f"doc_id long, bits long, {keys[0]} string, {keys[1]} long")
    prints = stored_table(prints, "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *keys)).alias("first")
    distinct = stored_table(prints.groupBy("bits").agg(first), "distinct")
    groups = connected_components(close_links(distinct.select("bits"), distance))
    named = distinct.join(groups.withColumnRenamed("node", "bits"), "bits", "left")
    kept = named.groupBy(F.coalesce("component", "bits")).agg(F.min("first").alias("first"))
    kept = stored_table(kept.select(*(F.col(f"first.{k}").alias(k) for k in keys)), "kept_rows")
    # the same plan at every size: a list of kept rows that is small here is not small elsewhere
    return marked.join(kept.hint("merge"), keys, "left_semi").select(*(f"`{c}`" for c in docs.columns))
