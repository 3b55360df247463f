"""Mixing sources to target weights by iterative proportional fitting.

Tokens are added up per cell: source, language and topic. Each round rakes the cells to the
targets of one dimension after the other: a cell's factor is multiplied by target over present
weight of its source, then of its language, then of its topic, until all three fit. Raking leaves
the sum of tokens as it is, so a factor says how often the tokens of a cell are to be seen.

By default a cell's documents are kept with its factor as probability, all of them from a factor of
1; beyond 1 the factor is their weight, and weighted tokens meet the targets. So only what cells
have above their target goes, and a rare cell changes no more than its own share. A caller who
names targets or a power gets them met by the kept documents alone, without weights. That takes
the largest factor as 1, and so the rarest cell says how much of the others is kept.

Cells stay a table: sources may be as many as web sites. Raking one dimension is an aggregate
and a join with one row per value, written to the shared folder; only the largest misfit of a
round comes to the driver. The texts are read once to count tokens and never shuffled for it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import stored_table

DIMENSIONS = ("source", "lang", "topic")
#: Present shares are raised to it where neither targets nor a power are given.
POWER = 0.85


def surface_topic(text: Column) -> Column:
    """A topic that can be read off the text alone: none, table, marked or prose."""
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "none")
        .when(text.contains(" | "), "table")
        .when(text.rlike(r"[#*$%&]{3}"), "marked")
        .otherwise("prose")
    )


def tempered_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(value, target): present shares raised to a power below 1, so that rare values gain."""
    shares = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("n"))
    shares = shares.filter("n > 0").select("value", F.pow(F.col("n").cast("double"), power).alias("raised"))
    total = shares.agg(F.sum("raised").alias("total"))
    return shares.join(F.broadcast(total)).select("value", (F.col("raised") / F.col("total")).alias("target"))


def _fit_one(cells: DataFrame, dimension: str, target: DataFrame) -> DataFrame:
    weights = cells.groupBy(F.col(dimension).alias("own")).agg(
        F.sum(F.col("tokens") * F.col("factor")).alias("weight")
    )
    known = weights.join(target, F.col("own").eqNullSafe(F.col("value"))).filter("weight > 0")
    total = known.agg(F.sum("weight").alias("all"))
    change = F.col("target") * F.col("all") / F.col("weight")
    known = known.join(F.broadcast(total)).select("own", change.alias("change"))
    return cells.join(known, F.col(dimension).eqNullSafe(F.col("own")), "left").select(
        *DIMENSIONS,
        "tokens",
        (F.col("factor") * F.coalesce("change", F.lit(1.0))).alias("factor"),
        F.greatest("misfit", F.abs(F.coalesce("change", F.lit(1.0)) - 1)).alias("misfit"),
    )


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], rounds: int = 30, tolerance: float = 1e-3
) -> DataFrame:
    """The cells with their ``factor``. Values without a target keep their weight; targets of
    values without tokens are left out, and the rest of that dimension fills up to 1."""
    cells = stored_table(cells.withColumn("factor", F.lit(1.0)), "cells")
    usable = {}
    for dimension, target in targets.items():
        present = cells.filter("tokens > 0").select(F.col(dimension).alias("value")).distinct()
        kept = target.join(present, target["value"].eqNullSafe(present["value"]), "left_semi")
        total = kept.agg(F.sum("target").alias("total"))
        usable[dimension] = stored_table(
            kept.join(F.broadcast(total)).select("value", (F.col("target") / F.col("total")).alias("target")),
            "targets",
        )
    for _ in range(rounds):
        cells = cells.withColumn("misfit", F.lit(0.0))
        for dimension, target in usable.items():
            cells = stored_table(_fit_one(cells, dimension, target), "cells")
        worst = cells.agg(F.max("misfit")).first()[0]
        if worst is None or worst < tolerance:
            break
    return cells.select(*DIMENSIONS, "tokens", "factor")


def _marked(docs: DataFrame, topic: Column) -> DataFrame:
    """All columns of ``docs`` in one, so that none clashes; beside it the cell's and the tokens."""
    text = F.col("text")
    draw = F.xxhash64(F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), text))
    tokens = F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0))
    return docs.select(
        F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"),
        F.col("source").cast("string").alias("_mix_source"),
        F.col("lang").cast("string").alias("_mix_lang"),
        topic.alias("_mix_topic"),
        tokens.cast("long").alias("_mix_tokens"),
        (F.shiftrightunsigned(draw, 11) / F.lit(float(1 << 53))).alias("_mix_draw"),
    )


def _with_probability(
    docs: DataFrame,
    topic: Column | None,
    targets: dict[str, DataFrame] | None,
    power: float | None,
) -> DataFrame:
    unweighted = targets is not None or power is not None
    marked = _marked(docs, surface_topic(F.col("text")) if topic is None else topic)
    own = [f"_mix_{d}" for d in DIMENSIONS]
    cells = marked.groupBy(*(F.col(c).alias(d) for c, d in zip(own, DIMENSIONS)))
    cells = stored_table(cells.agg(F.sum("_mix_tokens").alias("tokens")), "token_cells")
    if targets is None:
        targets = {d: tempered_targets(cells, d, POWER if power is None else power) for d in DIMENSIONS}
    raked = rake(cells, targets)
    if unweighted:
        most = raked.agg(F.max(F.when(F.col("tokens") > 0, F.col("factor"))).alias("most"))
        raked = raked.join(F.broadcast(most)).withColumn(
            "factor", F.least(F.coalesce(F.col("factor") / F.col("most"), F.lit(1.0)), F.lit(1.0))
        )
    raked = raked.select(
        *(F.col(d).alias(f"_cell_{d}") for d in DIMENSIONS),
        F.least("factor", F.lit(1.0)).alias("_mix_p"),
        F.greatest("factor", F.lit(1.0)).alias("_mix_weight"),
    )
    same = [F.col(f"_mix_{d}").eqNullSafe(F.col(f"_cell_{d}")) for d in DIMENSIONS]
    return marked.join(stored_table(raked, "probabilities"), same)


def mixing_probabilities(
    docs: DataFrame,
    topic: Column | None = None,
    targets: dict[str, DataFrame] | None = None,
    power: float | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, probability, kept, weight.

    ``targets`` maps source, lang and topic to tables (value, target share of tokens); without
    it the present shares are raised to ``power``. Weights are 1 where either is given. Null values are a value of their own; null
    and empty texts have 0 tokens, and cells without any tokens follow their other values.
    Whether a document is kept depends on its id alone (on its text if the id is null), so
    repeated rows stay or go together. An empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", "source", "lang")
    found = _with_probability(rows, topic, targets, power)
    return found.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        F.col("_mix_source").alias("source"),
        F.col("_mix_lang").alias("lang"),
        F.col("_mix_topic").alias("topic"),
        F.col("_mix_tokens").alias("n_tokens"),
        F.col("_mix_p").alias("probability"),
        (F.col("_mix_draw") < F.col("_mix_p")).alias("kept"),
        F.col("_mix_weight").alias("weight"),
    )


def sample_mixture(docs: DataFrame, power: float | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are.

    By default cells beyond their target are cut to it and the others are kept whole, without
    repeats: the shares delivered lie between the present ones and the targets, which are reached only
    with the weights of :func:`mixing_probabilities`. With ``power`` the targets are met as they are.
    """
    found = _with_probability(docs, None, None, power)
    return found.filter("_mix_draw < _mix_p").select("row.*")
