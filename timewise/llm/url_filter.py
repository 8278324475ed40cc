"""URL filtering with redirect equivalence.

Rules (host, path, verdict) fit their host and all its subdomains where the
path starts with the rule's; the longest rule wins.  Redirects (meta refresh)
and canonical links make two addresses aliases; aliases form classes by
distributed connected components.  The verdict of a page is

1. that of its own rule, if one fits;
2. else allow, if a rule explicitly allows an alias (allow has precedence);
3. else block, if a rule blocks an alias;
4. else allow.

Rules are matched per distinct host: its domain suffixes (one per label) are
equi-joined with the rules' hosts, so the work follows the number of hosts,
however many rules there are, and a hot host is one row before it is joined
back to its pages.

Edge cases: a null url, or one without ``://``, has an empty host and path,
fits no rule and has no aliases; empty hosts fit no rule; an unclosed or
relative link is resolved only if it is absolute or starts with ``/``, else
ignored; repeated rows are judged each; an empty table gives an empty result;
extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed
from .components import components

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UP, _LOW), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """The name of an address: host, path and query, without scheme and
    fragment; null where there is no ``://``."""
    return F.when(url.contains("://"), F.concat(host_of(url), path_of(url), F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)?", 1)))


def alias_links(pages: DataFrame) -> DataFrame:
    """(a, b): addresses that a page's html says are the same."""
    tag = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
    refresh = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh)[^>]*\bcontent\s*=\s*[\"']?[^\"'>]*?url\s*=\s*([^\"'\s>]+)"
    low = F.lower("html")
    t = pages.where("url is not null and html is not null").select(
        "url", F.when(low.contains("canonical"), F.regexp_extract("html", tag, 1)).alias("canonical"),
        F.when(low.contains("refresh"), F.regexp_extract("html", refresh, 1)).alias("refresh"))
    t = t.select("url", F.explode(F.array("canonical", "refresh")).alias("to")).where("to <> ''")
    to = F.when(F.col("to").startswith("/") & ~F.col("to").startswith("//"),
                F.concat(F.lit("http://"), host_of(F.col("url")), F.col("to"))).when(
        F.col("to").startswith("//"), F.concat(F.lit("http:"), F.col("to"))).otherwise(F.col("to"))
    return t.select(address(F.col("url")).alias("a"), address(to).alias("b")).where("a is not null and b is not null and a <> b").distinct()


def ruled(addresses: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path) rows with the longest fitting rule and its verdict added
    (null where none fits).  ``rules`` is the stated list of rules."""
    spark = addresses.sparkSession
    r = spark.createDataFrame([(h, p, v) for h, p, v in rules], "r_host string, r_path string, r_verdict string")
    hosts = addresses.select("host").where("host <> ''").distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    fits = (hosts.select("host", F.explode(suffixes).alias("r_host")).join(r, "r_host")
            .groupBy("host").agg(F.collect_list(F.struct((F.length("r_host") + F.length("r_path")).alias("n"),
                                                         F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"),
                                                         F.col("r_path").alias("path"))).alias("fits")))
    best = F.array_max(F.filter("fits", lambda x: F.col("path").startswith(x["path"])))
    return (addresses.join(fits, "host", "left").withColumn("best", best)
            .withColumn("rule", F.col("best.rule")).withColumn("rule_verdict", F.col("best.verdict")).drop("fits", "best"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, alias_class) for every page."""
    p = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                     F.col(f"`{html_col}`").cast("string").alias("html"))
    url = F.col("url")
    links = checkpointed(alias_links(p))
    out = ruled(p.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), address(url).alias("address")), rules)
    if not links.take(1):
        return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"),
                          F.lit(None).cast("string").alias("alias_class"))
    comp = checkpointed(components(links, "a", "b"))
    # every alias, seen as a page or only named by a link, brings its rule
    named = comp.select("node", "component", host_of(F.concat(F.lit("x://"), "node")).alias("host"),
                        path_of(F.concat(F.lit("x://"), "node")).alias("path"))
    says = (ruled(named, rules).groupBy("component")
            .agg(F.max(F.col("rule_verdict") == "allow").alias("allowed"), F.max(F.col("rule_verdict") == "block").alias("blocked")))
    classes = (comp.join(says, "component")
               .select(F.col("node").alias("address"), F.col("component").alias("alias_class"),
                       F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("alias_verdict")))
    return (out.join(classes, "address", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "alias_verdict", F.lit("allow")).alias("verdict"), "alias_class"))
