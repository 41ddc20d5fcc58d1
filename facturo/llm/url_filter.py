"""URL rules with redirect equivalence (dealt operator 8; DataFrame operations only).

Each URL takes the longest rule that fits it. URLs that pages declare to be
the same, by a canonical link or a redirect (meta refresh), form connected
components; a URL without a rule of its own takes the decision of its
component: allow if any alias has an allow rule, else block if any has a block
rule, else allow. Rules also count for link targets that were not crawled.
Links are resolved against the page's ``<base href>`` or its URL, with dot
segments; those in comments, scripts and styles don't count.

Rules are found per distinct host: a host's label suffixes are joined with the
rules' hosts, so the list may be long, and pages are joined with what was
found for their host. Cases: a null url or one without ``://`` has an empty
host and path, no rule and no aliases; null html has no links; repeated rows
are judged alike; with no rules all is allowed; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, sized_join
from .graph import connected_components

#: Rules are rows of (verdict, host, path).
RULES = "verdict string, host string, path string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``, or null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url: Column) -> Column:
    """Identity of a URL in the alias graph: scheme and host in lower case, the rest up to the fragment; 16 bytes."""
    scheme = F.translate(F.regexp_extract(url, "^.*?://", 0), _UPPER, _LOWER)
    rest = F.regexp_extract(_rest(url), "^[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.unhex(F.md5(F.concat(scheme, url_host(url), rest))))


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute, quoted or bare, with ``&amp;`` resolved; empty if absent. The first of equal names counts."""
    inside = lambda i: F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", i)
    return F.replace(F.trim(F.concat(inside(1), inside(2), inside(3))), F.lit("&amp;"), F.lit("&"))


def _tags(html: Column) -> Column:
    """base, link and meta tags outside comments, scripts and styles; a comment, script or style without an end runs to the end."""
    shown = F.regexp_replace(html, r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)", " ")
    return F.regexp_extract_all(shown, F.lit(r"(?is)<(?:base|link|meta)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>"), F.lit(0))


def _targets(tags: Column) -> Column:
    """href of canonical links and target of meta refreshes, as written."""
    canonical = F.filter(tags, lambda t: t.rlike("(?i)^<link") & F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical"))
    refresh = F.filter(tags, lambda t: t.rlike("(?i)^<meta") & (F.lower(_attribute(t, "http-equiv")) == "refresh"))
    found = F.concat(
        F.transform(canonical, lambda t: _attribute(t, "href")),
        F.transform(refresh, lambda t: F.regexp_extract(_attribute(t, "content"), r"(?is)^[\d.\s]*[;,\s]\s*url\s*=\s*[\"']?([^\"'\s]+)", 1)),
    )
    return F.filter(found, lambda u: u != "")


def _plain_path(path: Column) -> Column:
    """A path from its first slash on without ``.`` and ``..`` segments."""
    parts = F.split(path, "/", -1)
    folded = F.aggregate(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.array_append(done, x)),
    )
    folder = path.rlike(r"/\.\.?$")  # a last dot segment names a folder
    return F.concat(F.lit("/"), F.array_join(folded, "/"), F.when(folder & (F.size(folded) > 0), F.lit("/")).otherwise(F.lit("")))


def absolute_url(target: Column, url: Column) -> Column:
    """``target`` as resolved against the absolute ``url``: scheme, host, query or path alone, and dot segments."""
    scheme = F.regexp_extract(url, "^.*?://", 0)
    root = F.concat(scheme, F.regexp_extract(_rest(url), "^[^/?#]*", 0))
    path = F.when(url_path(url) == "", F.lit("/")).otherwise(url_path(url))
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1)
    whole = F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target).when(target.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), target))
    # schemes without an authority, such as mailto, name no page
    other = target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    ends = F.regexp_extract(target, r"^[^?#]*(.*)$", 1)
    named = F.regexp_extract(target, r"^[^?#]*", 0)
    merged = F.when(named.startswith("/"), named).otherwise(F.concat(F.regexp_extract(path, "^.*/", 0), named))
    relative = F.when(target.startswith("?"), F.concat(root, path, target)).when((target == "") | target.startswith("#"), F.concat(root, path, query, target)).otherwise(F.concat(root, _plain_path(merged), ends))
    full = F.concat(F.regexp_extract(whole, "^.*?://", 0), F.regexp_extract(_rest(whole), "^[^/?#]*", 0), F.when(url_path(whole) != "", _plain_path(url_path(whole))).otherwise(F.lit("")), F.regexp_extract(_rest(whole), "^[^?#]*(.*)$", 1))
    return F.when(whole.isNotNull(), full).when(~other, relative)


def _first_base(tags: Column) -> Column:
    """href of the first base tag that has one, as written; null if there is none."""
    return F.get(F.filter(F.transform(F.filter(tags, lambda t: t.rlike("(?i)^<base")), lambda t: _attribute(t, "href")), lambda h: h != ""), F.lit(0))


def _with_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``found``: struct of the longest fitting rule (size, rule, allows, verdict), or null; of equal rules allow wins."""
    by_host = rules.groupBy("host").agg(F.collect_list(F.struct("path", "verdict")).alias("paths")).withColumnRenamed("host", "suffix")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = urls.select("host").where("host <> ''").distinct().select("host", F.explode(suffixes).alias("suffix"))
    fitting = sized_join(hosts, by_host, ["suffix"], "inner")
    fitting = fitting.groupBy("host").agg(F.flatten(F.collect_list(F.expr("transform(paths, p -> struct(suffix, p.path, p.verdict))"))).alias("rules"))
    named = "transform(filter(rules, r -> startswith(path, r.path)), r -> struct(length(concat(r.suffix, r.path)) as size, concat(r.suffix, r.path) as rule, r.verdict = 'allow' as allows, r.verdict as verdict))"
    return sized_join(urls, fitting, ["host"]).withColumn("found", F.expr(f"array_max({named})")).drop("rules")


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and by (rule, alias or default) for every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    tagged = base.select("page_id", "url", F.when(F.instr("url", "://") > 0, _tags(F.col("html"))).alias("tags"))
    read = tagged.select("page_id", "url", _targets(F.col("tags")).alias("targets"), _first_base(F.col("tags")).alias("base"))
    read = read.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), url_node(F.col("url")).alias("node"), "targets", F.expr("if(size(targets) > 0, url, null)").alias("url"), "base")
    read = materialize(read, spark, "urls")
    judged = _with_rule(read.select("page_id", "host", "path", "node"), rules)

    # each step is a column of its own: within one expression every use would repeat what it is made of
    linked = read.where("size(targets) > 0").select("node", "targets", F.coalesce(absolute_url(F.col("base"), F.col("url")), "url").alias("base"))
    linked = linked.select("node", "base", F.explode("targets").alias("target")).select("node", absolute_url(F.col("target"), F.col("base")).alias("target"))
    linked = materialize(linked, spark, "links")
    linked = linked.select("node", url_node(F.col("target")).alias("other"), url_host(F.col("target")).alias("host"), url_path(F.col("target")).alias("path")).where("other is not null")
    if linked.isEmpty():
        aliased = judged.withColumn("alias", F.lit(None).cast("string"))
    else:
        components = materialize(connected_components(linked.select(F.col("node").alias("a"), F.col("other").alias("b"))), spark, "aliases")
        known = judged.select("node", "found").unionAll(_with_rule(linked.select(F.col("other").alias("node"), "host", "path"), rules).select("node", "found"))
        ruled = known.where("found is not null").groupBy("node").agg(F.expr("bool_or(found.verdict = 'allow')").alias("allow"))
        sides = sized_join(components, ruled, ["node"], "inner").groupBy("component").agg(F.expr("if(bool_or(allow), 'allow', 'block')").alias("alias"))
        decided = sized_join(components, sides, ["component"], "inner").select("node", "alias")
        aliased = sized_join(judged, decided, ["node"])
    return aliased.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.expr("coalesce(found.verdict, alias, 'allow')").alias("verdict"),
        F.expr("case when found is not null then 'rule' when alias is not null then 'alias' else 'default' end").alias("by"),
    )
