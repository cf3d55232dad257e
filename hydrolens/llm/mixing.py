"""Mixing of sources to target weights.

The leaves of a tree (domain, language, source) hold documents. A token budget is handed down from
the root: the children of a node share its budget by their weights, and none gets more than its
subtree can give. What a child cannot take goes to its siblings by their weights; only what a
whole subtree cannot take has already gone to the siblings of its root. So shortages are met as
near to the leaf as possible.

A leaf gives the prefix of a stream of tokens: all its documents in a seeded order, then all again
in another order, up to the allowed number of epochs. The cut within the last epoch is found by
running sums over ranges of the order, so no leaf has to fit in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrolens.llm.common import WORD, own, small, table, words
from hydrolens.sources.folders import RunFolder

LEVELS = ["domain", "lang", "source"]
SEED = "mix-1"
MAX_EPOCHS = 2
# Part of all tokens that the mixture has.
BUDGET_PART = 0.9

# The hot source is a domain of its own; the others form four by their numbers.
DOMAIN = """case when source = 'src0' then 'crawl'
  else concat('collection', coalesce(try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') as int) % 4, 0)) end"""
WEIGHTS = {
    "domain": "if(domain = 'crawl', 3, 2)",
    "lang": "if(lang = 'en', 4, 1)",
    "source": "1",
}


def supplies(docs: DataFrame, domain: str, run: RunFolder) -> DataFrame:
    """Stored units (domain, lang, source, doc_id, n_tokens). Rows of one leaf with the same doc_id are
    one unit; null names count as the name `none`. Texts without words are no supply."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    counted = docs.select(
        "doc_id", name("lang").alias("lang"), name("source").alias("source"),
        F.size(words(F.col("text").cast("string"), WORD)).cast("long").alias("n"),
    ).where("n > 0")
    return run.keep(
        counted.withColumn("domain", F.coalesce(F.expr(domain), F.lit("none")))
        .groupBy(*LEVELS, "doc_id").agg(F.sum("n").alias("n_tokens")),
        "units",
    )


def budgets(units: DataFrame, weights: dict[str, str], max_epochs: int, budget_part: float, run: RunFolder) -> DataFrame:
    """Per leaf: n_tokens (in one epoch) and target (whole tokens). `domain` and the weights are SQL
    expressions over the level names; weights are whole numbers. A
    node of weight 0 gives nothing."""
    leaves = units.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n_tokens"))
    leaves = run.keep(leaves, "leaves")
    for level, weight in weights.items():
        leaves = leaves.withColumn(f"w_{level}", F.expr(weight).cast("long"))
    usable = F.when(F.least(*[f"w_{level}" for level in LEVELS]) > 0, F.col("n_tokens") * max_epochs).otherwise(F.lit(0))
    leaves = leaves.withColumn("capacity", usable.cast("long"))
    total = Window.partitionBy()
    # One row per leaf: the tree is a table of names, not of documents.
    shared = leaves.withColumn(
        "given", F.least(F.floor(F.sum("n_tokens").over(total) * budget_part), F.sum("capacity").over(total)).cast("double")
    )
    for depth, level in enumerate(LEVELS):
        path = LEVELS[: depth + 1]
        nodes = shared.groupBy(*path).agg(
            F.sum("capacity").alias("can"), F.max(f"w_{level}").alias("weight"), F.max("given").alias("of")
        ).where("can > 0")
        siblings = Window.partitionBy(*LEVELS[:depth]).orderBy(F.col("can") / F.col("weight"), level)
        earlier = siblings.rowsBetween(Window.unboundedPreceding, -1)
        later = siblings.rowsBetween(0, Window.unboundedFollowing)
        # The rate if all siblings that saturate earlier are full; the first that does not sets it.
        rate = (F.col("of") - F.coalesce(F.sum("can").over(earlier), F.lit(0))) / F.sum("weight").over(later)
        rated = nodes.withColumn("rate", rate).withColumn("full", F.col("can") <= F.col("rate") * F.col("weight"))
        common = F.max(F.when(~F.col("full"), F.col("rate"))).over(Window.partitionBy(*LEVELS[:depth]))
        settled = rated.withColumn("common", common).select(
            *path, F.when(F.col("full"), F.col("can").cast("double")).otherwise(F.col("common") * F.col("weight")).alias("got")
        )
        shared = shared.drop("given").join(settled, path).withColumnRenamed("got", "given")
        shared = run.keep(shared, f"given_{level}")
    return shared.select(*LEVELS, "n_tokens", F.least(F.floor("given").cast("long"), "capacity").alias("target"))


def _running(units: DataFrame, run: RunFolder) -> DataFrame:
    """Adds `before`: tokens of the leaf's units that stand earlier in the order `turn`, doc_id."""
    order = [*LEVELS, "turn", "doc_id"]
    dealt = units.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = run.keep(dealt.withColumn("_place", F.monotonically_increasing_id()), "turns")
    stored = stored.withColumn("_range", F.shiftright("_place", 33))
    sums = stored.groupBy(*LEVELS, "_range").agg(F.sum("n_tokens").alias("_n"))
    ranges = Window.partitionBy(*LEVELS).orderBy("_range")
    offsets = run.keep(
        sums.withColumn("_offset", F.sum("_n").over(ranges) - F.col("_n")).drop("_n"), "turn_offsets"
    )
    within = Window.partitionBy(*LEVELS, "_range").orderBy("_place")
    return (
        stored.withColumn("_upto", F.sum("n_tokens").over(within))
        .join(small(offsets), [*LEVELS, "_range"])
        .withColumn("before", F.col("_offset") + F.col("_upto") - F.col("n_tokens"))
    )


def mixture(
    docs: DataFrame, run: RunFolder, domain: str = DOMAIN, weights: dict[str, str] | None = None,
    max_epochs: int = MAX_EPOCHS, budget_part: float = BUDGET_PART, seed: str = SEED,
) -> DataFrame:
    """domain, lang, source, doc_id, epoch (from 0), n_tokens and taken (tokens within the leaf's prefix;
    fewer than n_tokens only for the last document of a leaf). A document is in the result once
    per epoch that it has a part in.

    Rows of one leaf that share a doc_id (a missing one too) are taken together. Null languages
    and sources are leaves named `none`. Texts without words are never taken. An empty table gives
    an empty result; columns other than doc_id, text, lang and source are not read."""
    units = supplies(docs, domain, run)
    targets = budgets(units, weights or WEIGHTS, max_epochs, budget_part, run)
    plan = run.keep(
        targets.where("target > 0").select(
            *LEVELS, F.floor(F.col("target") / F.col("n_tokens")).cast("int").alias("whole"),
            (F.col("target") % F.col("n_tokens")).alias("rest"),
        ),
        "plan",
    )
    planned = units.join(small(plan), LEVELS)
    again = planned.where("whole > 0").select(
        *LEVELS, "doc_id", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"), "n_tokens", F.col("n_tokens").alias("taken")
    )
    turn = F.md5(F.concat_ws(":", F.lit(seed), "whole", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    partial = planned.where("rest > 0").withColumn("turn", turn)
    cut = _running(partial, run).where("before < rest").select(
        *LEVELS, "doc_id", F.col("whole").alias("epoch"), "n_tokens", F.least("n_tokens", F.col("rest") - F.col("before")).alias("taken")
    )
    return again.unionByName(cut)


def mixed_documents(docs: DataFrame, run: RunFolder, domain: str = DOMAIN, **options) -> DataFrame:
    """The rows of the documents that the mixture takes, all columns, once per epoch. The document at the
    end of a leaf's prefix comes whole. Columns may have any name."""
    with RunFolder(run.spark) as work:
        chosen = mixture(docs, work, domain, **options).groupBy(*LEVELS, "doc_id").agg(F.count("*").cast("int").alias("times"))
        chosen = run.keep(chosen.drop("domain"), "chosen")
    named = lambda c: F.coalesce(docs[c].cast("string"), F.lit("none"))
    rows = docs.where(docs["text"].cast("string").rlike(WORD)).select(
        F.struct(*own(docs)).alias("row"), docs["doc_id"].alias("id"), named("lang").alias("in_lang"), named("source").alias("in_source")
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("in_lang") == F.col("lang")) & (F.col("in_source") == F.col("source"))
    met = rows.join(small(chosen), same)
    return met.withColumn("turn", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def document_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"), RunFolder(spark))


def _shares_sql(depth: int, source: str) -> str:
    """One level of the tree: every node's part of its parent's budget."""
    level, path = LEVELS[depth], ", ".join(LEVELS[: depth + 1])
    parent = f"partition by {', '.join(LEVELS[:depth])}" if depth else ""
    return f"""
node_{level} as (
  select {path}, cast(sum(capacity) as bigint) as can, max(w_{level}) as weight, max(given) as parent_given
  from {source} group by {path} having sum(capacity) > 0
), rate_{level} as (
  select *, (parent_given - coalesce(sum(can) over (
      {parent} order by can / weight, {level} rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over ({parent} order by can / weight, {level} rows between current row and unbounded following) as rate
  from node_{level}
), got_{level} as (
  select {path}, case when can <= rate * weight then cast(can as double)
    else max(case when can > rate * weight then rate end) over ({parent}) * weight end as got
  from rate_{level}
), given_{level} as (
  select s.* exclude (given), got as given from {source} s join got_{level} using ({path})
)"""


MIXTURE_SQL = rf"""
with units as (
  select case when source = 'src0' then 'crawl'
      else 'collection' || coalesce(try_cast(nullif(regexp_extract(source, '(\d+)$', 1), '') as int) % 4, 0) end as domain,
    coalesce(lang, 'none') as lang, coalesce(source, 'none') as source, doc_id,
    cast(sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))) as bigint) as n_tokens
  from documents group by all having n_tokens > 0
), leaves as (
  select domain, lang, source, cast(sum(n_tokens) as bigint) as n_tokens, cast({MAX_EPOCHS} * sum(n_tokens) as bigint) as capacity,
    case when domain = 'crawl' then 3 else 2 end as w_domain, case when lang = 'en' then 4 else 1 end as w_lang, 1 as w_source
  from units group by all
), root as (
  select *, cast(least(floor(sum(n_tokens) over () * cast({BUDGET_PART} as double)), sum(capacity) over ()) as double) as given from leaves
), {_shares_sql(0, "root")}, {_shares_sql(1, "given_domain")}, {_shares_sql(2, "given_lang")},
plan as (
  select domain, lang, source, least(cast(floor(given) as bigint), capacity) // n_tokens as whole,
    least(cast(floor(given) as bigint), capacity) % n_tokens as rest
  from given_source where floor(given) > 0
), planned as (
  select * from units join plan using (domain, lang, source)
), cut as (
  select *, sum(n_tokens) over (partition by domain, lang, source
    order by md5('{SEED}:' || whole || ':' || doc_id), doc_id rows between unbounded preceding and current row) - n_tokens as before
  from planned where rest > 0
)
select domain, lang, source, doc_id, cast(epoch as int) as epoch, n_tokens, n_tokens as taken
from (select *, unnest(range(0, whole)) as epoch from planned where whole > 0)
union all
select domain, lang, source, doc_id, cast(whole as int), n_tokens, cast(least(n_tokens, rest - before) as bigint) from cut where before < rest
"""
