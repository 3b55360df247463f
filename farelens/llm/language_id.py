"""Language ID by interpolated Kneser-Ney character models.

Texts are read as lower-case letters with single spaces for everything else. Each language
has a trigram model with absolute discounting and continuation counts at the lower orders,
counted over every training document and built with DataFrame operations. Its values lie in
arrays sorted by a number of 64 bits that is different for every entry, so entries never merge and
what was not seen is never found. The arrays are broadcast whole: 16 bytes an entry, which grows
with the distinct trigrams of the corpus. A text gets the language
with the lowest cross-entropy per character.

Texts without letters are rejected, and those whose entropy lies too far above what is usual in their
language: letters without any pattern of it, as in encoded data. What is usual is measured on
training documents that the measuring model has not counted, an eighth of all, with an allowance for
short texts, whose entropy varies by the root of their length. The limit is the mean and
``deviations`` standard deviations, which whatever its distribution at most 1 / (1 + deviations^2)
of a language's texts exceed. The model that predicts counts that eighth as well.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import (
    batch_of,
    documents,
    held_out,
    map_arrow,
    stored_table,
    text_slices,
)

SPACE = 32
UNKNOWN = "und"
MODULUS = 4
#: One training document of so many is set apart to measure limits.
APART = 8
#: Bytes of text that are worked on at once.
SLICE = 1 << 20
#: Entries of the hash arrays: full trigrams, contexts of two and one, and lower orders.
TRIGRAM, PAIR_CONTEXT, BIGRAM, CONTEXT, UNIGRAM, FLOOR = range(6)
COUNTS = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or the space."""
    table = np.full(0x110000, SPACE, np.uint32)
    for point in range(0x110000):
        if (letter := chr(point)).isalpha():
            table[point] = ord(letter.lower()[0])
    return table


def letters(text: str | None) -> np.ndarray:
    """Two spaces, then letters with single spaces between and one at the end."""
    raw = np.frombuffer(f" {text or ''} ".encode("utf-32-le", "surrogatepass"), "<u4")
    known = letter_table()[raw]
    keep = np.ones(len(known), bool)
    keep[1:] = (known[1:] != SPACE) | (known[:-1] != SPACE)
    return np.concatenate([np.array([SPACE], np.uint32), known[keep]])


class Grams:
    """The trigrams of some texts: distinct ones, and which one stands at each place."""

    def __init__(self, texts: list[str | None]) -> None:
        rows = [letters(t) for t in texts]
        sizes = np.array([len(r) for r in rows])
        points = np.concatenate(rows)
        seen = np.zeros(0x110000, bool)
        seen[points] = True
        alphabet = np.flatnonzero(seen)
        n = len(alphabet)
        number = np.zeros(0x110000, np.int64)
        number[alphabet] = np.arange(n)
        local = number[points]
        codes = (local[:-2] * n + local[1:-1]) * n + local[2:]
        ends = np.cumsum(sizes)
        inside = np.ones(len(codes), bool)
        inside[ends[:-1] - 1] = inside[ends[:-1] - 2] = False
        codes = codes[inside]
        if n**3 <= 1 << 24:
            distinct = np.flatnonzero(np.bincount(codes, minlength=1))
            place = np.zeros(n**3, np.int64)
            place[distinct] = np.arange(len(distinct))
            self.at = place[codes]
        else:
            distinct, self.at = np.unique(codes, return_inverse=True)
        self.sizes = sizes - 2
        self.starts = np.cumsum(self.sizes) - self.sizes
        a, b, c = distinct // (n * n), distinct // n % n, distinct % n
        self.codes = alphabet[a] << 42 | alphabet[b] << 21 | alphabet[c]

    def counts(self, rows: np.ndarray) -> np.ndarray:
        return np.bincount(self.at[np.repeat(rows, self.sizes)], minlength=len(self.codes))


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, code, n) over all training documents; each task adds up its own first."""

    def merged(parts):
        codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return codes, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def rows(lang, parts):
        codes, n = merged(parts)
        return batch_of({"lang": [lang] * len(codes), "code": codes, "n": n}, COUNTS)

    def run(batches):
        held: dict[str, list] = {}
        for batch in text_slices(batches, SLICE):
            grams = Grams(batch.column("text").to_pylist())
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                n = grams.counts(langs == lang)
                parts = held.setdefault(lang, [])
                parts.append((grams.codes[n > 0], n[n > 0]))
                if sum(len(p[0]) for p in parts) > 1 << 20:
                    parts[:] = [merged(parts)]
                    if len(parts[0][0]) > 1 << 19:
                        yield rows(lang, held.pop(lang))
        for lang, parts in held.items():
            yield rows(lang, parts)

    counts = map_arrow(docs, run, "lang string, code long, n long")
    return counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


# --- the model ----------------------------------------------------------------------------


def entry_hash(code, kind, bits: int = 64):
    """A mix of code and kind to so many bits; with 64, no two entries have the same.

    Trigrams have 63 bits. All other codes have 42 at most, which leaves room for the kind.
    """
    x, kind = np.asarray(code, np.uint64), np.asarray(kind, np.uint64)
    x = np.where(kind == TRIGRAM, x, x | np.uint64(1 << 63) | kind << np.uint64(60))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - bits)


def _discount(counts: DataFrame, value: str, name: str) -> DataFrame:
    """n1 / (n1 + 2 n2) for each language, kept inside (0, 1)."""
    n1, n2 = (F.sum((F.col(value) == k).cast("double")) for k in (1, 2))
    share = F.coalesce(n1 / F.nullif(n1 + 2 * n2, F.lit(0.0)), F.lit(0.5))
    return counts.groupBy("lang").agg(F.least(F.greatest(share, F.lit(0.1)), F.lit(0.9)).alias(name))


def _entries(kind: int, df: DataFrame, code: Column, value: Column) -> DataFrame:
    return df.select("lang", F.lit(kind).alias("kind"), code.alias("code"), F.ln(value).alias("value"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """Entries (lang, kind, code, value) of the interpolated models, values as logarithms."""
    tri = counts.withColumn("pair", F.expr("code div 2097152"))
    tri = tri.withColumn("suffix", F.expr("code % 4398046511104"))
    pairs = tri.groupBy("lang", "pair").agg(F.sum("n").alias("all"), F.count("n").alias("kinds"))
    bi = tri.groupBy("lang", "suffix").agg(F.count("n").alias("m"))
    bi = bi.withColumn("b", F.expr("suffix div 2097152")).withColumn("c", F.expr("suffix % 2097152"))
    bi = stored_table(bi, "bigrams")
    contexts = bi.groupBy("lang", "b").agg(F.sum("m").alias("all2"), F.count("m").alias("kinds2"))
    uni = bi.groupBy("lang", "c").agg(F.count("m").alias("k"))
    total = uni.groupBy("lang").agg(F.sum("k").alias("all1"), F.count("k").alias("kinds1"))
    size = uni.agg((F.count_distinct("c") + 1).alias("letters"))
    base = total.join(_discount(uni, "k", "d1"), "lang").join(_discount(bi, "m", "d2"), "lang")
    base = stored_table(base.join(_discount(tri, "n", "d3"), "lang").join(F.broadcast(size)), "bases")
    floor = F.col("d1") * F.col("kinds1") / F.col("all1") / F.col("letters")

    uni = uni.join(base, "lang").withColumn("p1", (F.col("k") - F.col("d1")) / F.col("all1") + floor)
    contexts = contexts.join(base.select("lang", "d2"), "lang")
    contexts = contexts.withColumn("back2", F.col("d2") * F.col("kinds2") / F.col("all2"))
    pairs = pairs.join(base.select("lang", "d3"), "lang")
    pairs = pairs.withColumn("back3", F.col("d3") * F.col("kinds") / F.col("all"))
    bi = bi.join(contexts, ["lang", "b"]).join(uni.select("lang", "c", "p1"), ["lang", "c"])
    bi = bi.withColumn("p2", (F.col("m") - F.col("d2")) / F.col("all2") + F.col("back2") * F.col("p1"))
    bi = stored_table(bi.select("lang", "suffix", "p2"), "bigrams")
    tri = tri.join(pairs, ["lang", "pair"]).join(bi.select("lang", "suffix", "p2"), ["lang", "suffix"])
    p3 = (F.col("n") - F.col("d3")) / F.col("all") + F.col("back3") * F.col("p2")
    return (
        _entries(TRIGRAM, tri, F.col("code"), p3)
        .union(_entries(PAIR_CONTEXT, pairs, F.col("pair"), F.col("back3")))
        .union(_entries(BIGRAM, bi, F.col("suffix"), F.col("p2")))
        .union(_entries(CONTEXT, contexts, F.col("b"), F.col("back2")))
        .union(_entries(UNIGRAM, uni, F.col("c"), F.col("p1")))
        .union(_entries(FLOOR, base, F.lit(0).cast("long"), floor))
    )


class Model:
    """Sorted hash arrays of every language."""

    def __init__(self, entries: pa.Table, bits: int) -> None:
        self.bits, self.arrays = bits, {}
        langs = entries.column("lang").combine_chunks().dictionary_encode()
        names, numbers = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        hashes, values = (entries.column(c).to_numpy() for c in ("hash", "value"))
        for lang in sorted(names):
            own = np.flatnonzero(numbers == names.index(lang))
            own = own[np.argsort(hashes[own], kind="stable")]
            self.arrays[lang] = hashes[own], values[own]
        self.langs = list(self.arrays)

    def find(self, lang: str, kind: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, values = self.arrays[lang]
        wanted = entry_hash(codes, kind, self.bits).astype(np.int64)
        at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        return hashes[at] == wanted, values[at]

    def log_probabilities(self, lang: str, codes: np.ndarray) -> np.ndarray:
        pair, suffix = codes >> 21, codes & (1 << 42) - 1
        known, value = self.find(lang, UNIGRAM, codes & (1 << 21) - 1)
        value = np.where(known, value, self.find(lang, FLOOR, np.zeros(1, np.int64))[1])
        for context, weight, gram, kind in (
            (codes >> 21 & (1 << 21) - 1, CONTEXT, suffix, BIGRAM),
            (pair, PAIR_CONTEXT, codes, TRIGRAM),
        ):
            known, back = self.find(lang, weight, context)
            lower = value + np.where(known, back, 0.0)
            known, own = self.find(lang, kind, gram)
            value = np.where(known, own, lower)
        return value

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character by text and language, and the number of characters."""
        grams = Grams(texts)
        out, some = np.zeros((len(texts), len(self.langs))), grams.sizes > 0
        for column, lang in enumerate(self.langs):
            each = self.log_probabilities(lang, grams.codes)[grams.at]
            if some.any():
                sums = np.add.reduceat(each, grams.starts[some])
                out[some, column] = -sums / grams.sizes[some]
        return out, grams.sizes


def training_rows(docs: DataFrame) -> DataFrame:
    """What may be learnt from, and whether it is set apart to measure limits. Copies of a text are
    set apart together."""
    rows = documents(docs, "doc_id", "text", "lang").filter("lang is not null and text is not null")
    rows = rows.filter(~held_out(F.col("doc_id"), MODULUS))
    return rows.withColumn("apart", F.pmod(F.xxhash64(F.lit("apart"), "text"), F.lit(APART)) == 0)


def training_counts(docs: DataFrame) -> DataFrame:
    """(lang, apart, code, n), stored, from one pass over the texts."""
    part = F.when(F.col("apart"), "1").otherwise("0")
    counts = count_grams(training_rows(docs).withColumn("lang", F.concat(part, "lang")))
    return stored_table(
        counts.select(
            F.expr("substring(lang, 2)").alias("lang"), F.expr("lang like '1%'").alias("apart"), "code", "n"
        ),
        "grams",
    )


def fit(counts: DataFrame, hash_bits: int = 64) -> Model:
    """A model for each language of the counts."""
    counts = stored_table(counts.groupBy("lang", "code").agg(F.sum("n").alias("n")), "grams")

    def hashed(batches):
        for batch in batches:
            codes, kinds = (batch.column(c).to_numpy() for c in ("code", "kind"))
            hashes = entry_hash(codes, kinds.astype(np.uint64), hash_bits).astype(np.int64)
            yield batch.select(["lang", "value"]).append_column("hash", pa.array(hashes))

    entries = map_arrow(kneser_ney(counts), hashed, "lang string, value double, hash long")
    return Model(entries.groupBy("lang", "hash").agg(F.max("value").alias("value")).toArrow(), hash_bits)


def train(docs: DataFrame, hash_bits: int = 64) -> Model:
    """A model for each non-null ``lang`` among the documents that are not held out."""
    return fit(training_counts(docs), hash_bits)


#: Nats allowed to a text of one character above the limit of its language.
SHORT_TEXT = 5.0


def _best(model: Model, texts: list[str | None]):
    """Language number (-1: no letters or nothing learned), its entropy less the allowance for
    short texts, and the confidence.

    The confidence is the share of the best language among all when a text counts as at most
    ``50`` characters; equal languages go to the first by name."""
    n = len(texts)
    if not model.langs:
        return np.full(n, -1), np.zeros(n), np.zeros(n)
    entropy, sizes = model.entropies(texts)
    best = entropy.argmin(axis=1)
    least = entropy[np.arange(n), best]
    share = 1 / np.exp(-np.minimum(sizes, 50)[:, None] * (entropy - least[:, None])).sum(axis=1)
    least = np.where(sizes, least - SHORT_TEXT / np.sqrt(np.maximum(sizes, 1)), 0)
    return np.where(sizes, best, -1), least, np.where(sizes, share, 0)


def calibrate(rows: DataFrame, model: Model, deviations: float = 12.0) -> dict[str, float]:
    """For each language the highest entropy that is still accepted, from texts that the model has not
    counted; none for languages that none of them is in."""
    schema = pa.schema([("language", pa.int32()), ("entropy", pa.float64())])

    def run(batches):
        for batch in text_slices(batches, SLICE):
            best, least, _ = _best(model, batch.column("text").to_pylist())
            yield batch_of({"language": best[best >= 0], "entropy": least[best >= 0]}, schema)

    stats = map_arrow(rows.select("text"), run, "language int, entropy double").groupBy("language")
    stats = stats.agg(F.avg("entropy").alias("m"), F.stddev_pop("entropy").alias("s"))
    return {model.langs[r.language]: r.m + deviations * max(r.s, 0.1) for r in stats.collect()}


def learn(docs: DataFrame, hash_bits: int, deviations: float) -> tuple[Model, np.ndarray]:
    """The model of all training documents, and the limit of each of its languages."""
    counts = training_counts(docs)
    limits = calibrate(
        training_rows(docs).filter("apart"), fit(counts.filter("not apart"), hash_bits), deviations
    )
    model = fit(counts, hash_bits)
    return model, np.array([limits.get(lang, np.inf) for lang in model.langs] or [np.inf])


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("rejected", pa.bool_()),
    ]
)


def identify_languages(
    docs: DataFrame, hash_bits: int = 64, deviations: float = 12.0
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score in [0, 1], rejected.

    Null, empty and letterless texts get ``und``, score 0, rejected; so does every text where no
    row has a language to learn. A language without a text set apart has no limit. Texts are read whole, repeated rows answered each; a null id
    is not held out; an empty table gives no rows.
    """
    model, limits = learn(docs, hash_bits, deviations)

    def run(batches):
        for batch in text_slices(batches, SLICE):
            best, least, share = _best(model, batch.column("text").to_pylist())
            yield batch_of(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "lang_pred": [model.langs[b] if b >= 0 else UNKNOWN for b in best],
                    "score": share,
                    "rejected": (best < 0) | (least > limits[best]),
                },
                RESULT,
            )

    rows = documents(docs).withColumn("held_out", held_out(F.col("doc_id"), MODULUS))
    return map_arrow(
        rows, run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )


def keep_identified(docs: DataFrame, hash_bits: int = 64, deviations: float = 12.0) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is not rejected."""
    model, limits = learn(docs, hash_bits, deviations)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        for batch in text_slices(batches, SLICE):
            best, least, _ = _best(model, batch.column("text").to_pylist())
            yield batch.filter(pa.array((best >= 0) & (least <= limits[best])))

    return map_arrow(docs, run, types)
