"""A hierarchical Pitman-Yor model of word pairs, its seating sampled by Gibbs.

Every context, the word before, is a restaurant. Its customers are the words that follow it, its
tables send one customer each to the parent that all contexts share, and that one's tables draw
from the uniform base. A sweep seats the customers of every dish anew given all others: first
in the contexts, then in the parent. Predictive probabilities are averaged over the sweeps that
are kept. A dish with one customer has one table, so only pairs seen twice or more are sampled.

All of it is arrays that Spark deals out. Documents are cut into chunks of about a million
tokens. Words belong to shards, pairs to buckets, both by hash, so no restaurant is ever in one
place: a context that holds a third of all tokens is spread over all buckets, which send sums to
the shards and get back what they need for their own words. What travels between chunks, shards
and buckets are distinct words and pairs with counts, as compressed arrays; their number follows
the number of chunks. Only totals over all shards come to the driver.

Words are 64-bit hashes up to their shard and numbered from there on, exactly.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import (
    Words,
    batch_of,
    bucketed_table,
    cogroup_arrow,
    documents,
    dump,
    group_arrow,
    held_out,
    load,
    lower_words,
    map_arrow,
    stored_table,
    table_of,
)

MODULUS = 7
#: Stands for the end of a text. No word holds a line break.
END = b"\n"
#: Bits of a pair's number that name the word; the others name the context.
WORD_BITS = 32
#: Words fall into so many slots by hash, and slots into shards.
SLOTS = np.uint64(1 << 16)

LONG, BYTES = pa.int64(), pa.binary()


def _struct(**fields) -> pa.DataType:
    return pa.list_(pa.struct(list(fields.items())))


CHUNK = pa.schema(
    [("chunk", LONG), ("words", BYTES), ("train", BYTES), ("slots", BYTES), ("tokens", BYTES)]
    + [("ids", pa.list_(LONG)), ("sizes", pa.list_(LONG)), ("held", pa.list_(pa.bool_()))]
)
CHUNK_TYPE = (
    "chunk long, words binary, train binary, slots binary, tokens binary, "
    "ids array<long>, sizes array<long>, held array<boolean>"
)


# --- chunks of documents ------------------------------------------------------------------


def _chunks(docs: DataFrame, size: int) -> DataFrame:
    """Rows of about ``size`` tokens: its distinct words, and its tokens as places among them in
    the order of their frequency, which compresses best."""
    def run(batches):
        task, made, parts, words, total = TaskContext.get().partitionId(), 0, [], Words(), 0

        def chunk():
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.order), np.uint64, len(words))
            distinct, at = np.unique(hashes, return_inverse=True)
            tokens = at[np.concatenate([p[2] for p in parts])]
            order = np.argsort(-np.bincount(tokens, minlength=len(distinct)), kind="stable")
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            distinct, tokens = distinct[order], place[tokens].astype(np.uint32)
            sizes = [len(p[2]) for p in parts]
            train = np.repeat([not p[1] for p in parts], sizes)
            counts = np.bincount(tokens[train], minlength=len(distinct)).astype(np.uint64)
            return batch_of(
                {
                    "chunk": [task << 32 | made],
                    "words": [dump(distinct)],
                    "train": [dump(counts)],
                    "slots": [dump((distinct % SLOTS).astype(np.uint16))],
                    "tokens": [dump(tokens)],
                    "ids": [[p[0] for p in parts]],
                    "sizes": [sizes],
                    "held": [[p[1] for p in parts]],
                },
                CHUNK,
            )

        for batch in batches:
            for doc_id, text, held in zip(*(batch.column(c) for c in ("doc_id", "text", "held"))):
                tokens = words.numbers([*lower_words(text.as_py()), END])
                parts.append((doc_id.as_py(), held.as_py(), tokens))
                total += len(tokens)
                if total >= size:
                    yield chunk()
                    made, parts, words, total = made + 1, [], Words(), 0
        if parts:
            yield chunk()

    rows = documents(docs).withColumn("held", held_out(F.col("doc_id"), MODULUS))
    return map_arrow(rows, run, CHUNK_TYPE)


# --- words: counts and numbers ------------------------------------------------------------


def _word_requests(shards: int):
    schema = pa.schema([("shard", LONG), ("chunk", LONG), ("hashes", BYTES), ("counts", BYTES)])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = load(row["words"], "u8"), load(row["train"], "u8")
                shard = hashes % SLOTS % np.uint64(shards)
                own = [np.flatnonzero(shard == s) for s in range(shards)]
                yield batch_of(
                    {
                        "shard": list(range(shards)),
                        "chunk": [row["chunk"]] * shards,
                        "hashes": [dump(hashes[o]) for o in own],
                        "counts": [dump(counts[o]) for o in own],
                    },
                    schema,
                )

    return run


VOCABULARY = pa.schema(
    [("shard", LONG), ("size", LONG), ("n", LONG)]
    + [("replies", _struct(chunk=LONG, ranks=BYTES, counts=BYTES))]
)


def _vocabulary(table: pa.Table) -> pa.Table:
    """Adds up the counts of a shard's words; replies with their ranks, -1 for untrained ones."""
    rows = table.to_pylist()
    hashes = [load(r["hashes"], "u8") for r in rows]
    distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = np.zeros(len(distinct), np.int64)
    np.add.at(counts, at, np.concatenate([load(r["counts"], "u8") for r in rows]).astype(np.int64))
    ranks = np.where(counts > 0, np.cumsum(counts > 0) - 1, -1)
    cuts = np.cumsum([len(h) for h in hashes])[:-1]
    replies = [
        {"chunk": r["chunk"], "ranks": dump(ranks[a]), "counts": dump(counts[a])}
        for r, a in zip(rows, np.split(at, cuts))
    ]
    sums = {"shard": [rows[0]["shard"]], "size": [int((counts > 0).sum())], "n": [int(counts.sum())]}
    return table_of({**sums, "replies": [replies]}, VOCABULARY)


def _of_chunk(shard: np.ndarray, replies: list[dict], *names: str) -> list[np.ndarray]:
    """Arrays over a chunk's words from the replies of the shards."""
    out = [np.zeros(len(shard), np.int64) for _ in names]
    for reply in replies:
        own = shard == reply["shard"]
        for array, name in zip(out, names):
            array[own] = load(reply[name], "i8")
    return out


def _pairs(tokens: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, start: int) -> np.ndarray:
    """Number of the pair at each token: context and word; -1 where one of them is untrained."""
    word = numbers[tokens]
    context = np.concatenate([[start], word[:-1]])
    context[np.cumsum(sizes)[:-1]] = start
    return np.where((word < 0) | (context < 0), -1, context << WORD_BITS | word)


def _bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(33)) % np.uint64(buckets)


def _numbers(shard: np.ndarray, ranks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.where(ranks < 0, -1, offsets[shard] + ranks)


def _pair_requests(offsets: np.ndarray, buckets: int):
    schema = pa.schema([("bucket", LONG), ("chunk", LONG), ("pairs", BYTES), ("counts", BYTES)])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        shard = load(row["slots"], "u2").astype(np.int64) % (len(offsets) - 1)
        tokens = load(row["tokens"], "u4")
        (ranks,) = _of_chunk(shard, right.to_pylist(), "ranks")
        sizes = np.array(row["sizes"])
        pairs = _pairs(tokens, sizes, _numbers(shard, ranks, offsets), int(offsets[-1]))
        train = np.repeat(~np.array(row["held"]), sizes)
        distinct, at = np.unique(pairs, return_inverse=True)
        counts = np.bincount(at, train, len(distinct)).astype(np.int64)
        known = distinct >= 0
        distinct, counts = distinct[known], counts[known]
        bucket = _bucket_of(distinct, buckets)
        own = [bucket == b for b in range(buckets)]
        return table_of(
            {
                "bucket": list(range(buckets)),
                "chunk": [row["chunk"]] * buckets,
                "pairs": [dump(distinct[o], True) for o in own],
                "counts": [dump(counts[o]) for o in own],
            },
            schema,
        )

    return run


# --- seating ------------------------------------------------------------------------------

MESSAGE = {"shard": LONG, "ids": BYTES, "as_word": BYTES, "as_context": BYTES, "customers": BYTES}
MESSAGES = "array<struct<shard long, ids binary, as_word binary, as_context binary, customers binary>>"


def _messages(pairs: np.ndarray, counts: np.ndarray, tables: np.ndarray, offsets: np.ndarray):
    """Sums per word for each shard: tables it is served at, tables and customers it holds."""
    context, word = pairs >> WORD_BITS, pairs & (1 << WORD_BITS) - 1
    ids = np.unique(np.concatenate([context, word]))
    at, of = np.searchsorted(ids, word), np.searchsorted(ids, context)
    sums = [np.bincount(a, w, len(ids)).astype(np.int64) for a, w in ((at, tables), (of, tables), (of, counts))]
    shard = np.minimum(np.searchsorted(offsets, ids, "right") - 1, len(offsets) - 2)
    out = []
    for s in np.unique(shard):
        own = shard == s
        arrays = [dump(ids[own] - offsets[s], True), *(dump(x[own]) for x in sums)]
        out.append(dict(zip(MESSAGE, [int(s), *arrays])))
    return out


BUCKET = pa.schema(
    [("bucket", LONG), ("pairs", BYTES), ("counts", BYTES), ("tables", BYTES)]
    + [("once", LONG), ("twice", LONG), ("found", _struct(chunk=LONG, at=BYTES))]
    + [("single", _struct(**MESSAGE)), ("messages", _struct(**MESSAGE))]
)
BUCKET_TYPE = (
    "bucket long, pairs binary, counts binary, tables binary, once long, twice long, "
    f"found array<struct<chunk long, at binary>>, single {MESSAGES}, messages {MESSAGES}"
)


def _bucket(offsets: np.ndarray):
    """Adds up a bucket's pairs. ``at`` tells a chunk for each of its pairs: -1 not trained, 0
    seen once, else 1 + the place among those that are seated."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        asked = [load(r["pairs"], "i8", True) for r in rows]
        distinct, at = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.zeros(len(distinct), np.int64)
        np.add.at(counts, at, np.concatenate([load(r["counts"], "i8") for r in rows]))
        many = counts > 1
        place = np.where(many, np.cumsum(many), np.where(counts == 1, 0, -1)).astype(np.int32)
        cuts = np.cumsum([len(a) for a in asked])[:-1]
        found = [
            {"chunk": r["chunk"], "at": dump(place[a])} for r, a in zip(rows, np.split(at, cuts))
        ]
        one, pairs, seated = distinct[counts == 1], distinct[many], counts[many]
        tables = np.ones(len(pairs), np.int64)
        single = _messages(one, np.ones(len(one)), np.ones(len(one)), offsets)
        return table_of(
            {
                "bucket": [rows[0]["bucket"]],
                "pairs": [dump(pairs, True)],
                "counts": [dump(seated)],
                "tables": [dump(tables)],
                "once": [len(one)],
                "twice": [int((counts == 2).sum())],
                "found": [found],
                "single": [single],
                "messages": [_messages(pairs, seated, tables, offsets)],
            },
            BUCKET,
        )

    return run


def seat(
    customers: np.ndarray, elsewhere: np.ndarray, base: np.ndarray, discount: float,
    strength: float, rng: np.random.Generator,
) -> np.ndarray:
    """Tables of each dish after all its customers have come in one after the other.

    ``elsewhere``: tables of other dishes in the restaurant; ``base``: the dish's probability
    at the parent. After i customers at k tables the next one opens a table with the odds
    (strength + discount (elsewhere + k)) base to i - discount k. The first 32 come singly; then
    a quarter more at a time, with the sum of these chances as the mean of their new tables.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    for i in range(1, 32):
        rows = np.flatnonzero(customers > i)
        if not len(rows):
            return tables
        k = tables[rows]
        opens = (strength + discount * (elsewhere[rows] + k)) * base[rows]
        tables[rows] += rng.random(len(rows)) * (opens + i - discount * k) < opens
    begin = 32
    while len(rows := np.flatnonzero(customers > begin)):
        end = np.minimum(customers[rows], begin + begin // 4)
        k = tables[rows]
        opens = (strength + discount * (elsewhere[rows] + k)) * base[rows]
        mean = opens * np.log((end - discount * k + opens) / (begin - discount * k + opens))
        tables[rows] += np.minimum(rng.poisson(mean), end - begin)
        begin += begin // 4
    return tables


STATE = pa.schema(
    [("shard", LONG), ("as_word", BYTES), ("root_tables", BYTES), ("as_context", BYTES)]
    + [("customers", BYTES), ("n", LONG), ("t", LONG)]
    + [("replies", _struct(bucket=LONG, as_word=BYTES, root_tables=BYTES, as_context=BYTES))]
)
STATE_TYPE = (
    "shard long, as_word binary, root_tables binary, as_context binary, customers binary, n long, "
    "t long, replies array<struct<bucket long, as_word binary, root_tables binary, "
    "as_context binary>>"
)


def _state(
    offsets: np.ndarray, root: tuple[float, float], seed: int, before: tuple[int, int] | None,
    answer: bool,
):
    """Sums of a shard's words from all buckets; then the parent's own seating. Left: the sums of
    pairs seen once, which never change."""
    last = len(offsets) - 2

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        singles, rows = left.to_pylist(), right.to_pylist()
        shard = (singles or rows)[0]["shard"]
        size = int(offsets[shard + 1] - offsets[shard]) + (shard == last)
        as_word, as_context, customers = (np.zeros(size, np.int64) for _ in range(3))
        asked = []
        for row in singles + rows:
            ids = load(row["ids"], "i8", True)
            for array, name in ((as_word, "as_word"), (as_context, "as_context"), (customers, "customers")):
                array[ids] += load(row[name], "i8")
            asked.append(ids)
        rng = np.random.default_rng([seed, shard])
        tables_elsewhere = before[1] if before else size
        uniform = np.full(size, 1 / (offsets[-1] + 1))
        tables = seat(as_word, np.full(size, tables_elsewhere), uniform, *root, rng)
        replies = [
            {
                "bucket": row["bucket"],
                "as_word": dump(as_word[ids]),
                "root_tables": dump(tables[ids]),
                "as_context": dump(as_context[ids]),
            }
            for row, ids in zip(rows if answer else [], asked[len(singles) :])
        ]
        return table_of(
            {
                "shard": [shard],
                "as_word": [dump(as_word)],
                "root_tables": [dump(tables)],
                "as_context": [dump(as_context)],
                "customers": [dump(customers)],
                "n": [int(as_word.sum())],
                "t": [int(tables.sum())],
                "replies": [replies],
            },
            STATE,
        )

    return run


def _sum_messages(table: pa.Table) -> pa.Table:
    """One message for all that a shard gets."""
    rows = table.to_pylist()
    ids = [load(r["ids"], "i8", True) for r in rows]
    distinct, at = np.unique(np.concatenate(ids), return_inverse=True)
    out = {"shard": [rows[0]["shard"]], "ids": [dump(distinct, True)]}
    for name in ("as_word", "as_context", "customers"):
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, at, np.concatenate([load(r[name], "i8") for r in rows]))
        out[name] = [dump(sums)]
    return table_of(out, pa.schema(list(MESSAGE.items())))


def parent(as_word, tables, totals: tuple[int, int], root: tuple[float, float], vocabulary: int):
    """Probability of words at the parent."""
    discount, strength = root
    n, t = totals
    return (as_word - discount * tables + (strength + discount * t) / (vocabulary + 1)) / (strength + n)


SEATS = pa.schema(
    [("bucket", LONG), ("pairs", BYTES), ("counts", BYTES), ("tables", BYTES), ("messages", _struct(**MESSAGE))]
)
SEATS_TYPE = f"bucket long, pairs binary, counts binary, tables binary, messages {MESSAGES}"


def _sweep(offsets, leaf, root, totals, seed: int):
    vocabulary = int(offsets[-1])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, replies = left.to_pylist()[0], sorted(right.to_pylist(), key=lambda r: r["shard"])
        pairs, counts = load(row["pairs"], "i8", True), load(row["counts"], "i8")
        tables = load(row["tables"], "i8")
        context, word = pairs >> WORD_BITS, pairs & (1 << WORD_BITS) - 1
        ids = np.unique(np.concatenate([context, word]))  # in the order of the messages
        got = {
            name: np.concatenate([load(r[name], "i8") for r in replies] or [np.empty(0, np.int64)])
            for name in ("as_word", "root_tables", "as_context")
        }
        at, of = np.searchsorted(ids, word), np.searchsorted(ids, context)
        base = parent(got["as_word"][at], got["root_tables"][at], totals, root, vocabulary)
        elsewhere = got["as_context"][of] - tables
        rng = np.random.default_rng([seed, row["bucket"]])
        tables = seat(counts, elsewhere, base, *leaf, rng)
        return table_of(
            {
                "bucket": [row["bucket"]],
                "pairs": [row["pairs"]],
                "counts": [row["counts"]],
                "tables": [dump(tables)],
                "messages": [_messages(pairs, counts, tables, offsets)],
            },
            SEATS,
        )

    return run


# --- scores -------------------------------------------------------------------------------


WORD_REPLY = pa.schema(
    [("shard", LONG), ("chunk", LONG), ("ranks", BYTES), ("counts", BYTES), ("customers", BYTES)]
    + [(name, pa.list_(BYTES)) for name in ("as_word", "root_tables", "as_context")]
    + [("start", pa.list_(LONG))]
)
WORD_REPLY_TYPE = (
    "shard long, chunk long, ranks binary, counts binary, customers binary, "
    "as_word array<binary>, root_tables array<binary>, as_context array<binary>, start array<long>"
)


def _word_replies(offsets, samples: int):
    """For a chunk's words of one shard: ranks, counts, and the state of each sample. ``start``
    has customers and tables of the context that opens every text."""
    last = len(offsets) - 2

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        shard = left.column("shard")[0].as_py()
        states = {r["sample"]: r for r in right.to_pylist()}
        size = int(offsets[shard + 1] - offsets[shard]) + (shard == last)

        def values(sample, name):  # the place after the last is for words that were not trained
            row = states.get(sample)
            return np.append(load(row[name], "i8") if row else np.zeros(size, np.int64), 0)

        customers = values(0, "customers")
        each = {
            name: [values(s, name) for s in range(samples)]
            for name in ("as_word", "root_tables", "as_context")
        }
        start = [int(customers[-2]), *(int(x[-2]) for x in each["as_context"])] if shard == last else None
        rows = {name: [] for name in WORD_REPLY.names}
        for reply in left.column("replies")[0].as_py():
            ranks = load(reply["ranks"], "i8")
            plain = {"shard": shard, "start": start, "customers": dump(customers[ranks])}
            arrays = {name: [dump(x[ranks]) for x in xs] for name, xs in each.items()}
            for name, value in (reply | plain | arrays).items():
                rows[name].append(value)
        return table_of(rows, WORD_REPLY)

    return run


def _pair_replies(table_left: pa.Table, table_right: pa.Table) -> pa.Table:
    """For a chunk's pairs of one bucket: customers, and tables added up over the samples."""
    rows = table_right.to_pylist()
    tables = np.sum([load(r["tables"], "i8") for r in rows], axis=0)
    customers = np.concatenate([[1], load(rows[0]["counts"], "i8"), [0]]).astype(np.uint32)
    tables = np.concatenate([[len(rows)], tables, [0]]).astype(np.uint32)
    found = table_left.column("found")[0].as_py()
    places = [load(f["at"], "i4") for f in found]
    return table_of(
        {
            "bucket": [rows[0]["bucket"]] * len(found),
            "chunk": [f["chunk"] for f in found],
            "seated": [dump(customers[p]) for p in places],
            "tables": [dump(tables[p]) for p in places],
        },
        pa.schema([("bucket", LONG), ("chunk", LONG), ("seated", BYTES), ("tables", BYTES)]),
    )


RESULT = pa.schema(
    [("doc_id", LONG), ("held_out", pa.bool_()), ("n_tokens", LONG), ("n_known", LONG)]
    + [("train_tokens", LONG), ("base_score", pa.float64()), ("score", pa.float64())]
)


def _scores(offsets, buckets: int, n: int, totals: list, leaf, root):
    vocabulary, (discount, strength) = int(offsets[-1]), leaf

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, replies = left.to_pylist()[0], right.to_pylist()
        shard = load(row["slots"], "u2").astype(np.int64) % (len(offsets) - 1)
        tokens = load(row["tokens"], "u4")
        sizes = np.array(row["sizes"])
        begin = np.cumsum(sizes) - sizes
        of_words = [r for r in replies if r["bucket"] is None]
        ranks, counts, customers = _of_chunk(shard, of_words, "ranks", "counts", "customers")
        pairs = _pairs(tokens, sizes, _numbers(shard, ranks, offsets), vocabulary)
        distinct, at = np.unique(pairs, return_inverse=True)
        own, known = np.zeros(len(distinct)), np.flatnonzero(distinct >= 0)
        bucket = _bucket_of(distinct[known], buckets)
        for reply in replies:
            if reply["bucket"] is not None:
                tables = load(reply["tables"], "u4") / len(totals)
                own[known[bucket == reply["bucket"]]] = load(reply["seated"], "u4") - discount * tables
        first = np.zeros(len(tokens), bool)
        first[begin] = True
        before = np.concatenate([tokens[:1], tokens[:-1]])
        start = next(r["start"] for r in of_words if r["start"])
        held = np.where(first, start[0], customers[before])
        lower = np.zeros(len(tokens))
        for sample, total in enumerate(totals):
            names = ("as_word", "root_tables", "as_context")
            part = [{"shard": r["shard"], **{c: r[c][sample] for c in names}} for r in of_words]
            as_word, tables, as_context = _of_chunk(shard, part, *names)
            given = parent(as_word, tables, total, root, vocabulary)
            opened = np.where(first, start[sample + 1], as_context[before])
            lower += given[tokens] * (strength + discount * opened) / len(totals)
        score = np.log10((own[at] + lower) / (strength + held))
        base = np.log10((counts[tokens] + 1) / (n + vocabulary + 1))
        return table_of(
            {
                "doc_id": row["ids"],
                "held_out": row["held"],
                "n_tokens": sizes,
                "n_known": np.add.reduceat((counts[tokens] > 0).astype(np.int64), begin),
                "train_tokens": [n] * len(sizes),
                "base_score": np.add.reduceat(base, begin),
                "score": np.add.reduceat(score, begin),
            },
            RESULT,
        )

    return run


def score_texts(
    docs: DataFrame,
    sweeps: int = 3,
    burn_in: int = 1,
    strength: float = 1.0,
    root: tuple[float, float] = (0.5, 1.0),
    chunk_tokens: int = 1 << 20,
    seed: int = 11,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents that are not held out (those with a null id are not). Tokens are
    the words and one end; a null or empty text has the end alone. ``base_score`` is the add-one
    unigram score, ``score`` that of this model, both log10. Texts are read whole; repeated rows
    are learnt and scored each; an empty table gives no rows. The discount of contexts is
    n1 / (n1 + 2 n2) of the pair counts; ``root`` has discount and strength of the parent.
    """
    chunks = bucketed_table(_chunks(docs, chunk_tokens), "chunk", "chunks")
    many = chunks.count()
    shards, buckets = max(4, min(int(SLOTS), -(-many // 8))), max(8, many)
    asked = map_arrow(
        chunks.select("chunk", "words", "train"), _word_requests(shards),
        "shard long, chunk long, hashes binary, counts binary",
    )
    vocabulary = stored_table(
        group_arrow(
            asked, "shard", _vocabulary,
            "shard long, size long, n long, replies array<struct<chunk long, ranks binary, counts binary>>",
        ),
        "vocabulary",
    )
    sizes = {r.shard: (r.size, r.n) for r in vocabulary.select("shard", "size", "n").collect()}
    offsets = np.cumsum([0, *(sizes.get(s, (0, 0))[0] for s in range(shards))])
    n = sum(x[1] for x in sizes.values())
    if offsets[-1] + 1 >= 1 << WORD_BITS - 1:
        raise ValueError("more words than the numbers of pairs can name")

    replies = vocabulary.select("shard", F.inline("replies"))
    parts = chunks.select("chunk", "slots", "tokens", "sizes", "held")
    asked = cogroup_arrow(
        parts, replies.select("shard", "chunk", "ranks"), "chunk", _pair_requests(offsets, buckets),
        "bucket long, chunk long, pairs binary, counts binary",
    )
    pairs = stored_table(group_arrow(asked, "bucket", _bucket(offsets), BUCKET_TYPE), "pairs")
    once, twice = pairs.agg(F.sum("once"), F.sum("twice")).first()
    discount = min(max((once or 0) / max(1, (once or 0) + 2 * (twice or 0)), 0.1), 0.9)
    leaf = (discount, strength)

    single = group_arrow(
        pairs.select(F.inline("single")), "shard", _sum_messages,
        "shard long, ids binary, as_word binary, as_context binary, customers binary",
    )
    single = stored_table(single, "single")
    seats, totals, samples = pairs.select(*SEATS.names), None, []
    for sweep in range(sweeps):
        sent = seats.select("bucket", F.inline("messages"))
        state = cogroup_arrow(single, sent, "shard", _state(offsets, root, seed + sweep, totals, sweep < sweeps - 1), STATE_TYPE)
        state = stored_table(state, "state")
        totals = tuple(x or 0 for x in state.agg(F.sum("n"), F.sum("t")).first())
        if sweep >= burn_in:
            samples.append((state, seats, totals))
        if sweep < sweeps - 1:
            back = state.select("shard", F.inline("replies"))
            seats = cogroup_arrow(
                seats.select("bucket", "pairs", "counts", "tables"), back, "bucket",
                _sweep(offsets, leaf, root, totals, seed + sweep), SEATS_TYPE,
            )
            seats = stored_table(seats, "seats")

    states = reduce(
        DataFrame.union,
        [
            s.select(F.lit(i).alias("sample"), *(c for c in STATE.names if c not in ("n", "t", "replies")))
            for i, (s, _, _) in enumerate(samples)
        ],
    )
    of_words = cogroup_arrow(
        vocabulary.select("shard", "replies"), states, "shard",
        _word_replies(offsets, len(samples)), WORD_REPLY_TYPE,
    )
    tables = reduce(DataFrame.union, [s.select("bucket", "counts", "tables") for _, s, _ in samples])
    of_pairs = cogroup_arrow(
        pairs.select("bucket", "found"), tables, "bucket", _pair_replies,
        "bucket long, chunk long, seated binary, tables binary",
    )
    return cogroup_arrow(
        chunks.drop("words", "train"), of_words.unionByName(of_pairs, allowMissingColumns=True), "chunk",
        _scores(offsets, buckets, n, [t for _, _, t in samples], leaf, root),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
