"""Merkle manifest of a table: content-addressed records and proofs by descent.

Rows are leaves. Per group (source) leaves stand in the order of their key; every `FANOUT` consecutive
nodes become their digest until one remains, the group's subroot. Subroots, ordered by group, become
the root in the same way. The manifest stores one record per inner node, its digest and its children's
digests, and nothing else about the tree's shape: whoever trusts the root can follow a path of
digits from it, because each record is found by the digest its parent names.

A leaf is asked for by its rank. The digits of the rank (base `FANOUT`), after those of its group's rank,
lead from the root to the leaf; at each record the child under the digit is taken and the other
children are collected. The collected parts come root first, so they are reversed into a proof.

Leaves below the same node share the way to it. So requests are grouped by the nodes on their ways, a
node is visited once however many leaves below it are asked for, and digests collected above the last
record are not copied for each leaf until the row is finished. One group with a third of all rows
is cut into records of `FANOUT` like any other, so no task holds a group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolens.llm.common import in_order, lower_ascii, small, table
from hydrolens.sources.folders import RunFolder

BITS = 4
FANOUT = 1 << BITS
# Rows whose id has a crc32 that this divides are tampered with by the registered query.
TAMPERED_EVERY = 5
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """`-` if null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


@dataclass
class Tree:
    """Stored parts of one forest: groups (`tree`) over numbered leaves.

    records  per level from 1: digest, children    tops  tree, n (leaves), depth, digest of the top
    """

    records: list[DataFrame]
    tops: DataFrame


def build(leaves: DataFrame, run: RunFolder, name: str) -> Tree:
    """The records above `leaves` (tree, place, n, digest); n is the number of leaves of the tree."""
    nodes, records, tops = leaves, [], leaves.where("n <= 1").select("tree", "n", F.lit(0).alias("depth"), "digest")
    most = leaves.agg(F.max("n")).first()[0] or 0
    level = 0
    while most > 1:
        level += 1
        most = -(-most // FANOUT)
        run_of = F.shiftright("place", BITS)
        grouped = (
            nodes.where("n > 1")
            .groupBy("tree", run_of.alias("place"))
            .agg(
                F.array_sort(F.collect_list(F.struct(F.col("place").alias("at"), "digest"))).alias("members"),
                F.first("n").alias("below"),
            )
            .select(
                "tree",
                "place",
                F.expr(f"(below + {FANOUT - 1}) div {FANOUT}").alias("n"),
                F.col("members.digest").alias("children"),
            )
            .withColumn("digest", F.sha2(F.array_join("children", ""), 256))
        )
        stored = run.keep(grouped, f"{name}_{level}")
        records.append(stored.select("digest", "children"))
        nodes = stored.drop("children")
        tops = tops.unionByName(nodes.where("n <= 1").select("tree", F.lit(None).cast("bigint").alias("n"), F.lit(level).alias("depth"), "digest"))
    return Tree(records, run.keep(tops.select("tree", "depth", "digest"), f"{name}_tops"))


def others(children: Column, digit: Column) -> Column:
    """What stands before and after the chosen child, joined."""
    return F.struct(
        F.array_join(F.slice(children, F.lit(1), digit), "").alias("before"),
        F.array_join(F.slice(children, digit + 2, F.lit(FANOUT)), "").alias("after"),
    )


def descend(tree: Tree, starts: DataFrame, requests: DataFrame | None) -> DataFrame:
    """The last records of the ways from the starts to the requested leaves: tree, place, digest, path and
    children. The path has a part per record passed, root first; a start that is a leaf itself has
    no children.

    starts: tree, depth, digest, path of the tops. requests: tree, place (ranks of leaves); None asks for
    every leaf.
    """
    # The nodes on the ways, level by level: a rank without its last digit names the node above.
    asked = [requests]
    for _ in tree.records if requests is not None else []:
        asked.append(asked[-1].select("tree", F.shiftright("place", BITS).alias("place")).distinct())
    here = None
    for level in range(len(tree.records), 0, -1):
        own = starts.where(F.col("depth") == level).select("tree", F.lit(0).cast("bigint").alias("place"), "digest", "path")
        here = own if here is None else here.unionByName(own)
        if requests is not None:
            here = here.join(asked[level], ["tree", "place"], "left_semi")
        # Equal nodes have one record: repeated rows may give several.
        records = tree.records[level - 1].dropDuplicates(["digest"])
        found = here.join(records, "digest").select("tree", "place", "digest", "path", "children")
        if level == 1:
            lone = starts.where("depth = 0").select("tree", F.lit(0).cast("bigint").alias("place"), "digest", "path")
            return found.unionByName(lone.withColumn("children", F.lit(None).cast("array<string>")))
        here = found.select("tree", "place", "path", "children", F.posexplode("children").alias("digit", "digest")).select(
            "tree",
            F.expr(f"place * {FANOUT} + digit").alias("place"),
            "digest",
            F.concat("path", F.array(others(F.col("children"), F.col("digit")))).alias("path"),
        )
    return starts.select("tree", F.lit(0).cast("bigint").alias("place"), "digest", "path", F.lit(None).cast("array<string>").alias("children"))


def arrived(last: DataFrame, requests: DataFrame) -> DataFrame:
    """Each request with the leaf that stands at its rank and the whole path, leaf first."""
    digit = F.col("place").bitwiseAND(F.lit(FANOUT - 1)).cast("int")
    met = requests.withColumn("record", F.shiftright("place", BITS)).join(
        last.withColumnRenamed("place", "record").withColumnRenamed("digest", "above"), ["tree", "record"]
    )
    inner = F.col("children").isNotNull()
    return met.select(
        *requests.columns,
        F.when(inner, F.get("children", digit)).otherwise(F.col("above")).alias("leaf"),
        F.reverse(F.when(inner, F.concat("path", F.array(others(F.col("children"), digit)))).otherwise(F.col("path"))).alias("path"),
    )


@dataclass
class Manifest:
    """Stored digests of a table.

    leaves  key, tree, place and what else the leaves carried    groups  group, tree (its rank), n
    inner   the groups' trees    upper  the tree over their subroots    root  null for an empty table
    """

    leaves: DataFrame
    groups: DataFrame
    inner: Tree
    upper: Tree
    root: str | None

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """Requests (tree, place and any other columns; default every leaf) with leaf, subroot and path, an
        array of what stands before and after the node on each level, leaf first."""
        nowhere = F.array().cast("array<struct<before:string,after:string>>")
        top = self.upper.tops.select("tree", "depth", "digest", nowhere.alias("path"))
        whole = requests is None
        requests = self.leaves if whole else requests
        ranks = self.groups.select("tree") if whole else requests.select("tree").distinct()
        groups = ranks.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"))
        # arrived() turns the path round, leaf first; here it goes on downwards.
        subroots = arrived(descend(self.upper, top, None if whole else groups), groups).select(
            F.col("place").alias("tree"), F.col("leaf").alias("digest"), F.reverse("path").alias("path")
        )
        starts = subroots.join(small(self.inner.tops.select("tree", "depth")), "tree")
        last = descend(self.inner, starts, None if whole else requests.select("tree", "place"))
        return arrived(last, requests).join(small(self.inner.tops.select("tree", F.col("digest").alias("subroot"))), "tree")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def proof(path: Column) -> Column:
    """Digest of the siblings, level by level from the leaf."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def write(leaves: DataFrame, key: str, group: str, run: RunFolder) -> Manifest:
    """The manifest of rows with a `digest`. Leaves ascend by key and then by digest (a null key comes
    first), groups by their UTF-8 bytes (null first). Rows that are equal in group, key and digest may stand in
    either order, which changes no digest."""
    placed = in_order(leaves, [key, "digest"], run, "leaves", [group])
    counted = run.keep(placed.groupBy(group).agg(F.count("*").alias("n")), "group_sizes")
    groups = run.keep(in_order(counted, [group], run, "group_order").withColumnRenamed("slot", "tree"), "groups")
    ranks = groups.select(F.col(group).alias("ranked"), "tree", "n")
    joined = placed.join(small(ranks), F.col(group).eqNullSafe(F.col("ranked"))).drop("ranked")
    stored = run.keep(joined.withColumnRenamed("slot", "place"), "numbered")
    inner = build(stored.select("tree", "place", "n", "digest"), run, "inner")
    n = groups.count()
    tops = inner.tops.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.lit(n).cast("bigint").alias("n"), "digest")
    upper = build(tops, run, "upper")
    top = upper.tops.first()
    return Manifest(stored.drop("digest", "n", group), groups, inner, upper, top.digest if top else None)


def leaf_digest(text: Column) -> Column:
    """Of the documents' fixed columns, with another text if asked for."""
    return digest(*[encoded(text if c == "text" else F.col(c)) for c in LEAF_COLUMNS])


def verified_documents(docs: DataFrame, run: RunFolder) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Rows whose id has a crc32 that `TAMPERED_EVERY` divides are presented with A-Z of the text lower-cased,
    so the root folded from them differs unless the text has no such letter. A null id is never
    tampered with. Nulls in any column, empty and very long texts and repeated rows are leaves like
    others; an empty table gives an empty table. Other columns are not read."""
    text, key = F.col("text").cast("string"), F.col("doc_id")
    chosen = F.coalesce(F.crc32(key.cast("string").cast("binary")) % TAMPERED_EVERY == 0, F.lit(False))
    leaves = docs.select(
        "doc_id",
        "source",
        leaf_digest(text).alias("digest"),
        F.when(chosen, leaf_digest(lower_ascii(text))).alias("presented"),
    )
    manifest = write(leaves, "doc_id", "source", run)
    root = F.lit(manifest.root).cast("string")
    return (
        manifest.proofs()
        .withColumn("folded_root", folded(F.coalesce("presented", "leaf"), F.col("path")))
        .select(
            "doc_id",
            "leaf",
            "subroot",
            root.alias("root"),
            proof(F.col("path")).alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == root).alias("verified"),
        )
    )


def document_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_documents(table(spark, sf_dir, "documents"), RunFolder(spark))


# crc32 bit by bit: a byte is added, then eight steps of the reversed polynomial follow.
PROOFS_SQL = r"""
with recursive marked as (
  select *, xor(list_reduce([4294967295::bigint] || flatten(list_transform(string_split(doc_id::varchar, ''),
      lambda b: [ord(b)::bigint, 0, 0, 0, 0, 0, 0, 0])),
    lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384::bigint)), 4294967295::bigint) % 5 = 0 as chosen
  from documents
), encoded as (
  select doc_id, source,
    coalesce(length(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(length(n_chars::varchar) || ':' || n_chars, '-') as head,
    coalesce(strlen(text) || ':' || text, '-') as body,
    case when chosen then coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') end as shown
  from marked
), leaves as (
  select doc_id, source, sha256(head || body) as digest, sha256(head || coalesce(shown, body)) as shown from encoded
), ranked as (
  select *, row_number() over (partition by source order by doc_id nulls first, digest) - 1 as place,
    count(*) over (partition by source) as n, dense_rank() over (order by source nulls first) - 1 as tree
  from leaves
), inner_nodes as (
  select tree, 0 as level, place, n, digest from ranked
  union all
  select tree, level + 1, place // 16, any_value(n + 15) // 16, sha256(string_agg(digest, '' order by place))
  from inner_nodes where n > 1 group by tree, level, place // 16
), subroots as (
  select tree, digest, count(*) over () as n from inner_nodes where n = 1
), upper_nodes as (
  select 0 as level, tree as place, n, digest from subroots
  union all
  select level + 1, place // 16, any_value(n + 15) // 16, sha256(string_agg(digest, '' order by place))
  from upper_nodes where n > 1 group by level, place // 16
), nodes as (
  select false as is_upper, tree, level, place, n, digest from inner_nodes
  union all select true, 0, level, place, n, digest from upper_nodes
), steps as (
  select a.is_upper, a.tree, a.level, a.place,
    coalesce(string_agg(b.digest, '' order by b.place) filter (b.place < a.place), '') as before,
    coalesce(string_agg(b.digest, '' order by b.place) filter (b.place > a.place), '') as after
  from nodes a join nodes b
    on a.is_upper = b.is_upper and a.tree = b.tree and a.level = b.level and a.place // 16 = b.place // 16
  where a.n > 1 group by all
), walk as (
  select row_number() over () as request, doc_id, digest as leaf, tree as own, false as is_upper, tree, 0 as level, place,
    '' as proof, shown as node, false as done
  from ranked
  union all
  select request, doc_id, leaf, own,
    w.is_upper or s.level is null,
    case when w.is_upper or s.level is null then 0 else w.tree end,
    case when s.level is null then 0 else w.level + 1 end,
    case when s.level is not null then w.place // 16 when w.is_upper then 0 else w.tree end,
    case when s.level is null then proof else proof || before || after end,
    case when s.level is null then node else sha256(before || node || after) end,
    w.is_upper and s.level is null
  from walk w left join steps s
    on w.is_upper = s.is_upper and w.tree = s.tree and w.level = s.level and w.place = s.place
  where not done
)
select doc_id, leaf, s.digest as subroot, r.digest as root, sha256(proof) as proof_sha256, node as folded_root,
  node = r.digest as verified
from walk w join subroots s on w.own = s.tree, (select digest from upper_nodes where n = 1) r
where done
"""
