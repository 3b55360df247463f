"""The registered queries of this subpackage."""

from pyspark.sql import DataFrame, SparkSession

from farelens.llm.collision_search import nearest_neighbours
from farelens.llm.histogram_packing import pack
from farelens.llm.language_id import identify_languages
from farelens.llm.mixing import mixing_probabilities
from farelens.llm.pair_bitmaps import align_tokens
from farelens.llm.pattern_packing import pack_best_fit
from farelens.llm.personal_data import find_personal_data
from farelens.llm.phrase_mining import mine_phrases
from farelens.llm.pitman_yor import score_texts
from farelens.llm.pivots import near_duplicate_vectors
from farelens.llm.secrets import find_secrets
from farelens.llm.simhash import near_duplicates
from farelens.llm.token_counts import count_tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op2_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_probabilities(_table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"), scope=200)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), window=4096)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), every=100, k=10)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(_table(spark, sf_dir, "documents"), window=2048)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(_table(spark, sf_dir, "documents"), least=100, top=2000)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_pivots": op2_pivots,
    "op3_pitman_yor": op3_pitman_yor,
    "op4_mixing": op4_mixing,
    "op5_secrets": op5_secrets,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_neighbours": op8_neighbours,
    "op9_personal_data": op9_personal_data,
    "op10_language_id": op10_language_id,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_token_alignment": op12_token_alignment,
    "op13_phrases": op13_phrases,
}
#: DuckDB has no XXH64 with a seed, positions of matches, tokenizer or sampling; links of vectors
#: and phrases are the results that SQL gives.
ORACLES = {
    "op2_pivots": """
        WITH RECURSIVE v AS (
          SELECT vec_id, label, CAST(embedding AS double[]) AS e FROM embeddings
          WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x <> 0]) > 0
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
          ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93
        ),
        reach AS (
          SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION
          SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, CAST(coalesce(n, 0) AS bigint) AS n_links, component_id,
               vec_id = component_id AS kept
        FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
        LEFT JOIN counts ON a = vec_id""",
    "op13_phrases": r"""
        WITH pieces AS MATERIALIZED (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents WHERE text IS NOT NULL
        ),
        lists AS MATERIALIZED (
          SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[\x20\x09]+') IF w <> ''] AS words
          FROM pieces
        ),
        begun AS (
          SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM lists WHERE len(words) > 0
        ),
        f AS MATERIALIZED (
          SELECT lang, words[i : i + k - 1] AS phrase, count(*) AS f
          FROM (SELECT *, unnest(range(1, 6)) AS k FROM begun)
          WHERE i + k - 1 <= len(words) GROUP BY ALL
        ),
        totals AS (SELECT lang, sum(f) AS n FROM f WHERE len(phrase) = 1 GROUP BY lang),
        candidates AS MATERIALIZED (
          SELECT lang, phrase, f AS a FROM f WHERE len(phrase) > 1 AND f >= 100
        ),
        parts AS MATERIALIZED (
          SELECT *, phrase[1 : k] AS first, phrase[k + 1 :] AS rest
          FROM (SELECT *, unnest(range(1, len(phrase))) AS k FROM candidates)
        ),
        cuts AS (
          SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n,
                 1000::hugeint * a * n // (x.f::hugeint * y.f) AS score
          FROM parts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first
          JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
          JOIN totals ON totals.lang = c.lang
        ),
        lowest AS (
          SELECT * FROM cuts
          QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ),
        inside AS (
          SELECT lang, phrase[i : i + k - 1] AS phrase, max(a) AS longer
          FROM (SELECT *, unnest(range(2, len(phrase))) AS k
                FROM (SELECT *, unnest(range(1, len(phrase))) AS i FROM candidates))
          WHERE i + k - 1 <= len(phrase) GROUP BY ALL
        ),
        ranked AS (
          SELECT lowest.*, array_to_string(lowest.phrase, ' ') AS text
          FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.phrase = lowest.phrase
          WHERE longer IS NULL OR 100 * longer < 100 * a
        )
        SELECT lang, rank, text AS phrase, a, l, r, CAST(n AS bigint) AS n,
               CAST(score AS bigint) AS score
        FROM (SELECT *, row_number() OVER (
                PARTITION BY lang ORDER BY score DESC, a DESC, text) AS rank FROM ranked)
        WHERE rank <= 2000""",
}
