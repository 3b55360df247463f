import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from farelens.llm.mixing import mixing_probabilities, sample_mixture
from tests.llm.samples import ODD_TEXTS, odd_documents

DIMS = ("source", "lang", "topic")


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def brute(rows, power, rounds=400):
    """Factors by plain raking over dictionaries, as shares of the largest."""
    tokens = Counter()
    for cell, n in rows:
        tokens[cell] += n
    factor = dict.fromkeys(tokens, 1.0)
    for _ in range(rounds):
        for d in range(3):
            have, share = Counter(), Counter()
            for cell, n in tokens.items():
                have[cell[d]] += n * factor[cell]
                share[cell[d]] += n
            raised = {v: n**power for v, n in share.items() if n}
            scale = sum(have.values()) / sum(raised.values())
            for cell in tokens:
                if have[cell[d]]:
                    factor[cell] *= raised[cell[d]] * scale / have[cell[d]]
    most = max(f for c, f in factor.items() if tokens[c])
    return {c: min(1.0, f / most) for c, f in factor.items()}


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = mixing_probabilities(docs, power=0.5).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(found) == len(texts) and all(r.n_tokens == words(texts[r.doc_id]) for r in found)
    expected = brute([((r.source, r.lang, r.topic), r.n_tokens) for r in found], 0.5)
    for r in found:
        assert r.probability == pytest.approx(expected[r.source, r.lang, r.topic], rel=0.01)


def test_kept_tokens_meet_given_targets(spark):
    docs = spark.range(30000).select(
        F.col("id").alias("doc_id"),
        F.lit("a b c d").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.when(F.col("id") % 7 < 5, "en").otherwise("de").alias("lang"),
        F.when(F.col("id") % 11 < 8, "x").otherwise("y").alias("kind"),
    )
    want = {
        "source": {"hot": 0.2, **{f"s{i}": 0.16 for i in range(5)}, "unseen": 0.5},
        "lang": {"en": 0.5, "de": 0.5},
        "topic": {"x": 0.4, "y": 0.6},
    }
    targets = {d: spark.createDataFrame(list(t.items()), "value string, target double") for d, t in want.items()}
    kept = mixing_probabilities(docs, F.col("text").substr(9, 1), targets).filter("kept")
    assert kept.count() > 0
    with_kind = docs.withColumn("text", F.concat("kind", F.lit(" b c d")))
    kept = mixing_probabilities(with_kind, F.col("text").substr(1, 1), targets).filter("kept").collect()
    for d in DIMS:
        share = Counter()
        for r in kept:
            share[r[d]] += r.n_tokens / sum(k.n_tokens for k in kept[:1]) / len(kept)
        total = sum(v for k, v in want[d].items() if k != "unseen")
        for value, got in share.items():
            assert got == pytest.approx(want[d][value] / total, abs=0.02)


def test_odd_texts(spark):
    docs = odd_documents(spark)
    found = mixing_probabilities(docs).collect()
    assert len(found) == len(ODD_TEXTS)
    assert all(0 < r.probability <= 1 for r in found)
    kept = sample_mixture(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in found if r.kept)
    assert mixing_probabilities(docs.limit(0)).count() == sample_mixture(docs.limit(0)).count() == 0


def test_rare_cells_do_not_set_the_scale(spark):
    """One more source of one word takes next to nothing from the others; weights meet the targets."""
    docs = spark.range(20000).select(
        F.col("id").alias("doc_id"),
        F.lit("a b c d e f g h").alias("text"),
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 10)).alias("source"),
        F.when(F.col("id") % 7 < 5, "en").otherwise("de").alias("lang"),
    )
    rare = spark.createDataFrame([(20000, "a", "rare", "en")], docs.schema)
    share = []
    for table in (docs, docs.union(rare)):
        found = mixing_probabilities(table).collect()
        share.append(sum(r.n_tokens for r in found if r.kept) / sum(r.n_tokens for r in found))
    assert share[0] > 0.9 and share[0] - share[1] < 0.01
    assert sample_mixture(docs.union(rare)).count() == sum(r.kept for r in found)
    for d in DIMS:
        have, want = Counter(), Counter()
        for r in found:
            have[r[d]] += r.n_tokens * r.probability * r.weight
            want[r[d]] += r.n_tokens
        raised = {v: n**0.85 for v, n in want.items()}
        for value, n in raised.items():
            target = n / sum(raised.values())
            assert have[value] / sum(have.values()) == pytest.approx(target, rel=0.01)
    assert all(r.probability == 1 and r.weight > 1 for r in found if r.source == "rare")


def test_columns_of_any_name_stay(spark):
    docs = odd_documents(spark)
    names = ["row", "_mix_source", "_mix_p", "_mix_draw", "_cell_lang", "_cell_topic", "tokens", "a.b"]
    more = docs.withColumns({c: F.lit(i) for i, c in enumerate(names)})
    found = sample_mixture(more, power=1.0)
    assert found.columns == more.columns and found.count() == docs.count()
    assert {tuple(r[-len(names):]) for r in found.collect()} == {tuple(range(len(names)))}
