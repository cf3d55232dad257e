"""Benchmark decontamination over a positional inverted index.

The index has a posting (term, doc, pos) for every word of the training texts, sorted by term in
each file; a posting with the empty term closes each document and carries its id and length.
Test passages are looked up from their rarest terms: the two rarest places of each window give
posting lists whose positions are moved by the place in the passage. Where two such lists agree
on a document and an offset, the lists of all other terms of the passage are intersected at that
offset. Frequent terms are only read for documents that rare terms have already chosen.

Everything is DataFrame work; no task holds a posting list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrolens.llm.common import lower_ascii, small, table, unused, words
from hydrolens.sources.folders import RunFolder

# Lower-cased texts: digits, a-z and all characters outside ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
ANCHORS = 2


def terms(text: Column) -> Column:
    return words(lower_ascii(text), TERM)


def index(docs: DataFrame, run: RunFolder) -> DataFrame:
    """Stored postings of all words of all rows. `doc` numbers the rows, so that rows with the same
    or no doc_id stay apart."""
    closed = F.concat(terms(F.col("text")), F.array(F.lit("")))
    postings = (
        docs.select(F.monotonically_increasing_id().alias("doc"), "doc_id", F.col("text").cast("string").alias("text"))
        .select("doc", "doc_id", F.posexplode(closed).alias("pos", "term"))
        .select("term", "doc", "pos", F.when(F.col("term") == "", F.col("doc_id")).alias("doc_id"))
        # One long as the only sort key: Spark sorts it by radix, without comparing strings.
        .sortWithinPartitions(F.xxhash64("term"))
    )
    return run.keep(postings, "postings")


def documents_of(postings: DataFrame) -> DataFrame:
    """doc, doc_id and n_words of every indexed row."""
    return postings.where("term = ''").select("doc", "doc_id", F.col("pos").cast("long").alias("n_words"))


def passages(items: DataFrame, run: RunFolder) -> DataFrame:
    """The places (item, item_id, size, place, term) of the items that have words."""
    return run.keep(
        items.select("item_id", terms(F.col("text").cast("string")).alias("terms"))
        .distinct()
        .select("item_id", "terms", F.monotonically_increasing_id().alias("item"))
        .select("item", "item_id", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term")),
        "passages",
    )


def anchors(places: DataFrame, postings: DataFrame, run: RunFolder, window: int) -> DataFrame:
    """The places that are among the rarest of some window whose terms all occur."""
    vocabulary = run.keep(places.select("term").distinct(), "vocabulary")
    frequency = postings.join(small(vocabulary), "term").groupBy("term").agg(F.count("*").alias("frequency"))
    rated = places.join(frequency, "term", "left")
    length = F.least("size", F.lit(window))
    covered = rated.withColumn(
        "start",
        F.explode(F.sequence(F.greatest(F.lit(0), F.col("place") - length + 1), F.least("place", F.col("size") - length))),
    )
    order = Window.partitionBy("item", "start").orderBy("frequency", "place")
    lengths = Window.partitionBy("item", "start")
    chosen = (
        covered.withColumn("rank", F.row_number().over(order))
        .withColumn("known", F.count("frequency").over(lengths))
        .where((F.col("known") == length) & (F.col("rank") <= ANCHORS))
    )
    return run.keep(chosen.select("item", "size", "place", "term").distinct(), "anchors")


def phrases(postings: DataFrame, places: DataFrame, run: RunFolder, window: int = WINDOW) -> DataFrame:
    """Exact matches: item, item_id, doc, first and last (positions in the document) of every longest run
    of consecutive passage words that holds a window."""
    rare = anchors(places, postings, run, window)
    seeds = (
        postings.select("term", "doc", "pos")
        .join(small(rare), "term")
        .groupBy("item", "doc", (F.col("pos") - F.col("place")).alias("shift"))
        .agg(F.min("place").alias("x"), F.max("place").alias("y"), F.max("size").alias("size"))
        # One anchor is enough only where the window is a single word.
        .where((F.col("x") < F.col("y")) | (F.least("size", F.lit(window)) < ANCHORS))
    )
    found = run.keep(seeds.select("item", "doc", "shift"), "offsets")
    asked = found.join(places, "item").select(
        "item", "item_id", "size", "doc", "shift", "place", "term", (F.col("shift") + F.col("place")).alias("pos")
    )
    chosen = run.keep(found.select("doc").distinct(), "chosen_documents")
    lists = postings.select("term", "doc", "pos").where("term <> ''").join(small(chosen), "doc", "left_semi")
    met = lists.join(asked, ["doc", "pos", "term"])
    along = Window.partitionBy("item", "doc", "shift").orderBy("place")
    return (
        met.withColumn("island", F.col("place") - F.row_number().over(along))
        .groupBy("item", "item_id", "doc", "shift", "island")
        .agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.max("size").alias("size"))
        .where(F.col("last") - F.col("first") + 1 >= F.least("size", F.lit(window)))
        .select("item", "item_id", "doc", "first", "last")
    )


def proximity(postings: DataFrame, places: DataFrame, run: RunFolder, span: int) -> DataFrame:
    """item, item_id, doc and first: where a span of so many words that begins with a passage term holds
    every distinct term of the passage, in any order."""
    asked = run.keep(places.select("item", "item_id", "term").distinct(), "asked_terms")
    wanted = asked.groupBy("item").agg(F.count("*").alias("wanted"))
    lists = postings.select("term", "doc", "pos").join(small(asked), "term")
    # Spans reach into at most one more bucket of the same size.
    left = lists.select("item", "item_id", "doc", F.col("pos").alias("first"), F.explode(F.array((F.col("pos") / span).cast("int"), (F.col("pos") / span).cast("int") + 1)).alias("bucket"))
    right = lists.select("item", "doc", "term", "pos", (F.col("pos") / span).cast("int").alias("bucket"))
    return (
        left.join(right, ["item", "doc", "bucket"])
        .where((F.col("pos") >= F.col("first")) & (F.col("pos") < F.col("first") + span))
        .select("item", "item_id", "doc", "first", "term")
        .distinct()
        .groupBy("item", "item_id", "doc", "first")
        .agg(F.count("*").alias("met"))
        .join(wanted, "item")
        .where("met = wanted")
        .select("item", "item_id", "doc", "first")
    )


def contamination(docs: DataFrame, items: DataFrame, run: RunFolder, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit (words inside an occurrence of a window), n_items, items_sha256 and
    contaminated, one row per row of the documents.

    A window is `window` consecutive words of an item, or all words of a shorter one. Null and
    empty texts have no words and are clean; items without words have no window. Items without id make
    words hit and documents contaminated, but are neither counted nor named. Items that repeat an id
    count once. With no items, or none that occurs, every document is
    clean. Other columns of either table are not read."""
    postings = index(docs, run)
    matches = run.keep(phrases(postings, passages(items, run), run, window), "matches")
    hit = (
        matches.select("doc", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
        .groupBy("doc").agg(F.count("*").alias("n_hit"))
    )
    names = (
        matches.select("doc", F.col("item_id").cast("string").alias("name")).distinct()
        .groupBy("doc").agg(F.array_sort(F.collect_list("name")).alias("names"))
    )
    none = F.array().cast("array<string>")
    return (
        documents_of(postings).join(hit, "doc", "left").join(names, "doc", "left")
        .withColumn("names", F.coalesce("names", none))
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.size("names").cast("long").alias("n_items"),
            F.sha2(F.array_join("names", ","), 256).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def clean(docs: DataFrame, items: DataFrame, run: RunFolder, window: int = WINDOW) -> DataFrame:
    """The rows of the documents, all columns, in which no window occurs. Rows that share a doc_id
    go together; rows without one are judged by their texts."""
    with RunFolder(run.spark) as work:
        found = contamination(docs, items, work, window).where("contaminated and doc_id is not null")
        ids = run.keep(found.select("doc_id").distinct(), "contaminated")
    nameless = docs.where(docs["doc_id"].isNull())
    kept = docs.join(small(ids), docs["doc_id"] == ids["doc_id"], "left_anti")
    if nameless.isEmpty():
        return kept
    row = unused(nameless, "_row")
    nameless = run.keep(nameless.withColumn(row, F.monotonically_increasing_id()), "nameless")
    with RunFolder(run.spark) as work:
        judged = contamination(nameless.select(nameless[row].alias("doc_id"), "text"), items, work, window)
        bad = run.keep(judged.where("contaminated").select("doc_id"), "contaminated_nameless")
    clean_rows = nameless.join(small(bad), nameless[row] == bad["doc_id"], "left_anti").drop(row)
    return kept.where(docs["doc_id"].isNotNull()).unionByName(clean_rows)


def contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), RunFolder(spark))


CONTAMINATED_SQL = r"""
with doc_words as (
  select doc_id, row_number() over () as doc,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item_words as (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), item_windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from item_words where len(w) > 0)
), sizes as (
  select distinct n from item_windows
), doc_windows as (
  select doc, s, n, array_to_string(w[s : s + n - 1], ' ') as win
  from (select doc, w, n, unnest(range(1, len(w) - n + 2)) as s from doc_words, sizes where len(w) >= n)
), met as (
  select doc, s, n, item_id from doc_windows join item_windows using (n, win)
), hit as (
  select doc, count(distinct p) as n_hit from (select doc, unnest(range(s, s + n)) as p from met) group by doc
), items as (
  select doc, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct doc, cast(item_id as varchar) as name from met where item_id is not null) group by doc
)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, n_hit is not null as contaminated
from doc_words d left join hit using (doc) left join items using (doc)
"""
