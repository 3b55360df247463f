import random

import pytest
import xxhash

from farelens.llm.components import connected_components
from farelens.llm import simhash
from farelens.llm.simhash import close_links, fingerprint, near_duplicates
from tests.llm.samples import ODD_TEXTS, odd_documents


def plain_fingerprint(text, shingle=3):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            words, word = words + [word] * bool(word), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest member by plain search over all pairs."""
    name = {n: n for n in nodes}

    def root(n):
        while name[n] != n:
            n = name[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                name[y] = x
    return {n: root(n) for n in nodes}


def test_fingerprint():
    for _, text in ODD_TEXTS:
        if len(text or "") < 10000:
            assert fingerprint(text, 3) == plain_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("crowd", [2, 1000])
def test_links_have_the_components_of_all_pairs(spark, crowd):
    rng = random.Random(3)
    prints = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(12):
            x = centre
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            prints.add(signed(x))
    df = spark.createDataFrame([(p,) for p in prints], "bits long")
    links = close_links(df, 3, crowd)
    found = {r.node: r.component for r in connected_components(links).distinct().collect()}
    found = {p: found.get(p, p) for p in prints}
    mask = (1 << 64) - 1
    assert found == components(prints, lambda a, b: ((a ^ b) & mask).bit_count() <= 3)


def check(docs, found):
    rows = docs.select("doc_id", "text").collect()
    prints = {}
    for r in rows:
        prints.setdefault(plain_fingerprint(r.text), []).append(r.doc_id)
    root = components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for p, ids in prints.items():
        least.setdefault(root[p], []).extend(i for i in ids if i is not None)
    expected = [
        (i, f"{p:016x}", min(least[root[p]], default=None)) for p, ids in prints.items() for i in ids
    ]
    assert sorted(map(str, expected)) == sorted(
        str((r.doc_id, r.fingerprint, r.component_id)) for r in found.collect()
    )


def test_odd_texts(spark):
    docs = odd_documents(spark).filter("doc_id is null or doc_id <> 7")
    check(docs, near_duplicates(docs))
    assert near_duplicates(odd_documents(spark).limit(0)).count() == 0
    kept = [r.doc_id for r in near_duplicates(docs).filter("kept").collect()]
    assert 1 in kept and 8 not in kept


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, near_duplicates(docs))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        **{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}
    }


def test_rows_keep_their_keys_when_the_second_read_is_split_otherwise(spark, tmp_path, monkeypatch):
    rows = [(1200 - n, f"text number {n % 300} of a group {n % 300}", n) for n in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long").coalesce(3)
    docs.write.option("parquet.block.size", 4096).parquet(str(tmp_path / "docs"))
    original, setting = simhash.connected_components, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)

    def split_otherwise(links):
        found = original(links)
        spark.conf.set(setting, "1k")
        return found

    monkeypatch.setattr(simhash, "connected_components", split_otherwise)
    try:
        table = spark.read.parquet(str(tmp_path / "docs"))
        kept = simhash.drop_near_duplicates(table)
        assert kept.columns == ["doc_id", "text", "_row"]
        named = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
        found = [r.doc_id for r in kept.collect()]
    finally:
        spark.conf.set(setting, before)
    assert sorted(found) == sorted(set(named.values()))


def test_tables_without_files_are_numbered_once(spark):
    docs = odd_documents(spark).filter("doc_id is null or doc_id <> 7")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    expected = near_duplicates(docs).filter("kept").select("doc_id").distinct()
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in expected.collect())
