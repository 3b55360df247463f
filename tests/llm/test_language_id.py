import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelens.llm import language_id as lid
from tests.llm.samples import odd_documents

SF = "/root/testdata/sf0.01/documents.parquet"


def plain(text):
    out = "  "
    for c in text or "":
        c = c.lower()[0] if c.isalpha() else " "
        if c != " " or out[-1] != " ":
            out += c
    return out if out[-1] == " " and len(out) > 2 else out + " " if len(out) > 2 else out


def brute(rows):
    """Kneser-Ney by dictionaries: language -> probability of a trigram."""
    models, alphabet = {}, set()
    tris = defaultdict(Counter)
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            t = plain(r.text)
            tris[r.lang].update(t[i : i + 3] for i in range(len(t) - 2))
    for tri in tris.values():
        alphabet |= {g[2] for g in tri}
    for lang, tri in tris.items():
        bi = Counter(g[1:] for g in tri)
        uni = Counter(g[1] for g in bi)

        def discount(counts):
            n1, n2 = (sum(v == k for v in counts.values()) for k in (1, 2))
            return min(max(n1 / (n1 + 2 * n2) if n1 + n2 else 0.5, 0.1), 0.9)

        d3, d2, d1 = discount(tri), discount(bi), discount(uni)
        n3, k3, n2, k2 = Counter(), Counter(), Counter(), Counter()
        for g, n in tri.items():
            n3[g[:2]] += n
            k3[g[:2]] += 1
        for g, n in bi.items():
            n2[g[0]] += n
            k2[g[0]] += 1
        n1 = sum(uni.values())

        def p(g, tri=tri, bi=bi, uni=uni, d=(d1, d2, d3), n3=n3, k3=k3, n2=n2, k2=k2, n1=n1):
            q = max(uni[g[2]] - d[0], 0) / n1 + d[0] * len(uni) / n1 / (len(alphabet) + 1)
            if n2[g[1]]:
                q = max(bi[g[1:]] - d[1], 0) / n2[g[1]] + d[1] * k2[g[1]] / n2[g[1]] * q
            if n3[g[:2]]:
                q = max(tri[g] - d[2], 0) / n3[g[:2]] + d[2] * k3[g[:2]] / n3[g[:2]] * q
            return q

        models[lang] = p
    return models


def test_letters():
    for text in ("", None, "Abc, dEF!", "  x\n\ny ", "ÀÉ 北 ß1", "123"):
        assert "".join(map(chr, lid.letters(text))) == plain(text)


def test_model_equals_dictionaries(spark):
    docs = spark.read.parquet(SF).filter("doc_id < 200")
    rows = docs.collect()
    model, expected = lid.train(docs, hash_bits=40), brute(rows)
    assert model.langs == sorted(expected)
    texts = [r.text for r in rows[:40]] + ["zzz qqq xkcd", "北京"]
    entropy, sizes = model.entropies(texts)
    for row, text in enumerate(texts):
        t = plain(text)
        grams = [t[i : i + 3] for i in range(len(t) - 2)]
        assert sizes[row] == len(grams)
        for column, lang in enumerate(model.langs):
            want = -sum(math.log(expected[lang](g)) for g in grams) / len(grams)
            assert entropy[row, column] == pytest.approx(want, rel=1e-9)


def test_held_out_accuracy_and_few_rejections(spark):
    docs = spark.read.parquet(SF)
    found = lid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    out = [r for r in found if r.held_out]
    assert out and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.98
    assert not any(r.rejected for r in found)
    assert all(0 <= r.score <= 1 for r in found)


def test_letters_without_pattern_are_rejected(spark):
    rng = random.Random(4)
    noise = ["".join(rng.choices("bcdfghjklmnpqrtvwxz", k=600)) for _ in range(5)]
    extra = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    docs = spark.read.parquet(SF).unionByName(extra, allowMissingColumns=True)
    found = lid.identify_languages(docs).filter("rejected").collect()
    assert sorted(r.doc_id for r in found) == list(range(5000, 5005))


def test_limits_come_from_texts_that_were_not_counted(spark):
    """Random letters, the same in number everywhere: a counted text would look far more usual."""
    rng = random.Random(8)
    rows = [(4 * i + 1, "".join(rng.choices("abcdefghijklmnopqrst", k=300)), "xx") for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rest = lid.training_rows(docs)
    assert 0 < rest.filter("apart").count() < rest.count() / 4
    counts = lid.training_counts(docs)
    part = lid.fit(counts.filter("not apart"))
    seen = [r.text for r in rest.filter("apart").collect()]
    _, least, _ = lid._best(part, seen)
    model, limits = lid.learn(docs, 64, 3.0)
    assert limits[0] == pytest.approx(least.mean() + 3 * max(least.std(), 0.1), rel=1e-9)
    assert lid._best(model, seen)[1].mean() < least.mean() - 0.05
    ids = [r.doc_id for r in lid.identify_languages(docs).filter("rejected").collect()]
    assert ids == []


def test_a_language_of_one_text_has_no_limit(spark):
    docs = spark.createDataFrame([(1, "one text only", "xx")], "doc_id long, text string, lang string")
    assert not any(r.rejected for r in lid.identify_languages(docs).collect())


def test_odd_texts(spark):
    docs = odd_documents(spark)
    found = {r.doc_id: r for r in lid.identify_languages(docs).collect()}
    assert {i for i, r in found.items() if r.lang_pred == "und"} == {2, 3, 4}
    assert {r.lang_pred for i, r in found.items() if i not in (2, 3, 4)} == {"en"}
    kept = lid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.rejected}


def test_nothing_to_learn(spark):
    docs = odd_documents(spark)
    assert lid.identify_languages(docs.limit(0)).count() == 0
    blank = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lid.identify_languages(blank).collect()} == {"und"}


def test_entries_never_merge(spark):
    """A wide alphabet, with the parameters of the query."""
    rng = random.Random(6)
    text = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(150000))
    docs = spark.createDataFrame([(1, text, "zh"), (3, "the cat sat", "en")], "doc_id long, text string, lang string")
    rows = docs.collect()
    assert not any(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    model, expected, t = lid.train(docs), brute(rows), plain(text)
    grams = {t[i : i + 3] for i in range(len(t) - 2)}
    entries = [grams, {g[:2] for g in grams}, {g[1:] for g in grams}, {g[1] for g in grams}, {g[2] for g in grams}]
    assert len(model.arrays["zh"][0]) == sum(map(len, entries)) + 1
    unseen = np.array([0x9100 << 42 | 0x9101 << 21 | 0x9102 + i for i in range(20000)])
    assert not model.find("zh", lid.TRIGRAM, unseen)[0].any()
    probe = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(300))
    got = model.entropies([probe])[0][0, model.langs.index("zh")]
    t = plain(probe)
    each = [math.log(expected["zh"](t[i : i + 3])) for i in range(len(t) - 2)]
    assert got == pytest.approx(-sum(each) / len(each), rel=1e-9)
