"""URL rules by hashed expressions.

A rule names a host and a path; it fits urls of that host and its subdomains whose path starts with
its path. Each url is expanded into expressions: a suffix of its host (whole labels) and a prefix of
its path (up to a slash). Each rule has one such expression, its host and its path through the last
slash. Both sides meet by an equi-join on the first digits of the expression's SHA-256; what met is
confirmed by the full digest and by the rest of the rule's path. Of the rules that fit, one wins.

A url is expanded only into the shapes (labels of the host, slashes of the path) that some rule has,
so a url of thousands of labels and slashes gives no more expressions than there are shapes, and
none that a rule could meet is left out.

Everything is DataFrame work. Urls with the same host and path are judged once, so one host that has
a third of all pages is collapsed in the map tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolens.llm.common import lower_ascii, small, table
from hydrolens.sources.folders import RunFolder

# Hexadecimal digits of the digest that both sides are joined on.
PREFIX = 8
# Shapes of rules are sent with the plan; so many are allowed.
SHAPES = 4096
BLOCK, ALLOW = "block", "allow"

# The rules of the registered query (host, path, verdict).
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)
RULE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ("host", "path", "verdict")])


def host_of(url: Column) -> Column:
    """From the first `://` up to a slash, question mark, hash or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the end of the host up to a question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def prepared(rules: DataFrame) -> DataFrame:
    """rule, host, path, verdict, depth and the digest of the rule's expression, one row per host and
    path. Hosts are lower-cased; rules without host, path or a known verdict are left out."""
    known = (
        rules.select(
            lower_ascii(F.col("host").cast("string")).alias("host"),
            F.col("path").cast("string").alias("path"),
            F.col("verdict").cast("string").alias("verdict"),
        )
        .where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin(BLOCK, ALLOW))
        # "block" sorts after "allow": of two equal rules with both verdicts it stands.
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("depth", slashes(F.col("path")))
    )
    expression = F.concat("host", F.expr("if(depth = 0, '', concat(substring_index(path, '/', depth), '/'))"))
    return known.withColumn("rule", F.concat("host", "path")).withColumn("digest", F.sha2(expression, 256))


def shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The distinct (labels, slashes) of prepared rules, at most SHAPES of them."""
    found = rules.select(labels(F.col("host")).alias("n"), "depth").distinct().limit(SHAPES + 1).collect()
    if len(found) > SHAPES:
        raise ValueError(f"the rules have more than {SHAPES} shapes of host and path")
    return sorted((r.n, r.depth) for r in found)


def expanded(places: DataFrame, asked: list[tuple[int, int]]) -> DataFrame:
    """Each (host, path) with the digests of its expressions."""
    shape = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(d).alias("depth")) for n, d in asked])
    fitting = F.filter(shape, lambda s: (s["n"] <= labels(F.col("host"))) & (s["depth"] <= slashes(F.col("path"))))
    return places.withColumn("shape", F.explode(fitting)).select(
        "host",
        "path",
        F.expr(
            "sha2(concat(substring_index(host, '.', -shape.n), "
            "if(shape.depth = 0, '', concat(substring_index(path, '/', shape.depth), '/'))), 256)"
        ).alias("digest"),
    )


def winners(places: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule and verdict of the distinct places that some prepared rule fits. The longest rule
    wins; of equally long ones, the one with the longer host."""
    asked = shapes(rules)
    if not asked:
        return places.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    listed = rules.select(
        F.substring("digest", 1, PREFIX).alias("prefix"),
        F.col("digest").alias("rule_digest"),
        F.col("path").alias("rule_path"),
        F.length("host").alias("host_length"),
        "rule",
        "verdict",
    )
    met = expanded(places, asked).withColumn("prefix", F.substring("digest", 1, PREFIX)).join(small(listed), "prefix")
    fits = met.where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path")))
    best = F.max(F.struct(F.length("rule").alias("length"), "host_length", "rule", "verdict")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def judged(pages: DataFrame, url: str, rules: DataFrame, run: RunFolder, default: str = ALLOW) -> DataFrame:
    """The rows of the pages, their columns and then host, path, rule and verdict.

    Without a fitting rule the rule is null and the verdict is `default`: what no list names may pass.
    A url that is null or has no `://` has an empty host and path, and no rule fits it unless one has
    an empty host. Repeated rows and rows without id are judged each. No rules, or no pages, are
    fine. Columns of the pages with the four names, however spelled, are replaced."""
    taken = {"host", "path", "rule", "verdict"}
    own = [c for c in pages.columns if c.lower() not in taken]
    urls = pages.select(
        host_of(F.col(f"`{url}`").cast("string")).alias("host"),
        path_of(F.col(f"`{url}`").cast("string")).alias("path"),
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"),
    )
    listed = run.keep(prepared(rules), "rules")
    found = winners(urls.select("host", "path").distinct(), listed)
    return urls.join(found, ["host", "path"], "left").select(
        "row.*", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def page_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by the fixed rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(list(RULES), RULE_SCHEMA)
    return judged(pages, "url", rules, RunFolder(spark)).select("page_id", "host", "path", "rule", "verdict")


VERDICTS_SQL = r"""
with rules(host, path, verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), cut as (
  select row_number() over () as n, page_id,
    case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as tail
  from pages
), ends as (
  select *, length(regexp_extract(tail, '^[^/?#]*')) as h from cut
), urls as (
  select n, page_id,
    translate(left(tail, h), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(tail, h + 1), '^[^?#]*') as path
  from ends
), best as (
  select n, arg_max(r.host || r.path, length(r.host || r.path)) as rule,
    arg_max(r.verdict, length(r.host || r.path)) as verdict
  from urls u join rules r
    on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path)
  group by n
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from urls left join best using (n)
"""
