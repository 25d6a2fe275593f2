"""URL filters whose block decisions reach every alias of a page.

Rules name a host, with its subdomains, and the beginning of a path. A URL's own rule,
the longest that fits, decides it. URLs without a rule are decided by equivalence:
redirects and canonical links say which URLs are names of one resource, and a URL that
shares a connected component with a blocked URL is blocked too. An explicit allow has
precedence: a URL that its own rule allows stays allowed, whatever its aliases are. It
unblocks nobody else, so a page can't free itself by naming an allowed URL as its own.
All other URLs are allowed.

Edges come from the pages (`<link rel="canonical">` and `<meta http-equiv="refresh">`,
outside comments, scripts and styles) and from a table of redirects, if given. URLs that
no page has count as well: a page that redirects to a blocked host is blocked.

Only DataFrame functions: parsing, rules and components stay in the JVM.

Null URLs and URLs without `://` have an empty host and path, fit no rule and have no
aliases. Null and empty html has no links. Repeated rows are judged alike. Long html is
searched whole. Of rules of one length that fit, an allowing one wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from archivekit.operators.lookup import attach
from archivekit.operators.workspace import stage
from archivekit.params import Params

#: (host, path, verdict). Rules are configuration: each is part of one expression.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Where links don't count, the tags that may hold one, and what such a tag says.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
TAG = r"(?is)<(?:link|meta)\s[^>]*>"
CANONICAL = r"(?is)^<link\s.*?\brel\s*=\s*[\"']?\s*canonical\s*(?:[\"']|\s|/?>)"
REFRESH = r"(?is)^<meta\s.*?\bhttp-equiv\s*=\s*[\"']?\s*refresh\s*(?:[\"']|\s|/?>)"
HREF = r"(?is)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
TARGET = r"(?is)\scontent\s*=\s*(?:\"\s*[0-9.]+\s*[;,]\s*url\s*=\s*'?([^\"']*)|'\s*[0-9.]+\s*[;,]\s*url\s*=\s*\"?([^\"']*))"

HOST = r"^.*?://([^/?#]*)"
PATH = r"^.*?://[^/?#]*([^?#]*)"
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_EDGES = "src string, dst string"


def host_of(url: Column) -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end; only A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)" + HOST, 1), F.lit("")), *_LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)" + PATH, 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """`rule` (host and path) and `verdict` of the longest rule that fits, else NULL."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "allow", r))
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for h, p, verdict in reversed(ordered):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def vertex(url: Column) -> Column:
    """The URL without its fragment, which never reaches a server; NULL without `://`."""
    return F.when(F.contains(url, F.lit("://")), F.split_part(url, F.lit("#"), F.lit(1)))


def resolve(base: Column, link: Column) -> Column:
    """The absolute form of a link; dot segments stay as they are."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*/)", 1)
    return (
        F.when(F.rlike(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .when(F.startswith(link, F.lit("?")), F.concat(F.regexp_extract(base, r"(?s)^([^?#]*)", 1), link))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst): the redirects and canonical links that the pages themselves state."""
    html = F.col("html").cast("string")
    hinted = F.rlike(html, F.lit(r"(?i)canonical|http-equiv"))
    tags = pages.select(F.col("url").cast("string").alias("base"), html.alias("html")).filter(
        hinted & F.contains("base", F.lit("://"))
    ).select("base", F.explode(F.regexp_extract_all(F.regexp_replace("html", HIDDEN, " "), F.lit(TAG), F.lit(0))).alias("tag"))
    first = lambda pattern, n: F.concat(*[F.regexp_extract("tag", pattern, i) for i in range(1, n + 1)])
    link = F.when(F.rlike("tag", F.lit(CANONICAL)), first(HREF, 3)).when(F.rlike("tag", F.lit(REFRESH)), first(TARGET, 2))
    links = tags.select("base", F.trim(F.replace(link, F.lit("&amp;"), F.lit("&"))).alias("link"))
    return links.filter("link IS NOT NULL AND link <> ''").select(
        vertex(F.col("base")).alias("src"), vertex(resolve(F.col("base"), F.col("link"))).alias("dst")
    )


def classes(edges: DataFrame, params: Params = Params()) -> DataFrame:
    """(url, class) of every URL in `edges`, by alternating large and small stars.

    URLs get numbers once, in a stored table. Each round first stores the least
    neighbour of every vertex, one row each, so both sides of the join back are plain
    shuffles of which Spark splits the parts that a hub makes large. Rounds end when
    the edges stay the same; every round is written, so a lost executor costs one.
    """
    edges = stage(edges.filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select("src", "dst").distinct(), "links")
    urls = edges.select(F.col("src").alias("url")).union(edges.select("dst")).distinct()
    urls = stage(urls.select("url", F.monotonically_increasing_id().alias("vertex")), "vertices")
    numbered = attach(edges, urls.select(F.col("url").alias("src"), F.col("vertex").alias("u")), ["src"], ["dst"], params)
    numbered = attach(numbered, urls.select(F.col("url").alias("dst"), F.col("vertex").alias("v")), ["dst"], ["src"], params)
    now = stage(numbered.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = stage(small.distinct(), "stars")
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if new == mark:
            break
        mark = new
    # Every vertex but a root now has one edge, to the root.
    roots = now.select(F.col("u").alias("vertex"), F.col("v").alias("class"))
    return urls.join(roots, "vertex", "left").select("url", F.coalesce("class", "vertex").alias("class"))


def judge(
    pages: DataFrame,
    redirects: DataFrame | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    params: Params = Params(),
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of `pages` (page_id, url, html).

    `redirects` (src, dst) adds edges that are known from elsewhere. Rule as host and
    path, NULL where none fits; verdict `allow` or `block`.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select(vertex(F.col("src")), vertex(F.col("dst"))))
    url = F.col("url")
    found = stage(classes(links, params), "classes")
    # Classes of which some URL is blocked by a rule, and their members.
    own = rule_of(host_of(url), path_of(url), rules)
    blocked = found.filter(own["verdict"] == "block").select("class").distinct()
    caught = attach(found, blocked, ["class"], ["url"], params).select(F.col("url").alias("_vertex")).withColumn("_blocked", F.lit(True))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), vertex(url).alias("_vertex"))
    rows = attach(rows, caught, ["_vertex"], ["page_id"], params, "left")
    rows = rows.withColumn("_own", rule_of(F.col("host"), F.col("path"), rules))
    spread = F.when(F.col("_blocked"), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("_own.rule").alias("rule"), F.coalesce(F.col("_own.verdict"), spread).alias("verdict"))
