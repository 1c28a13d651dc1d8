"""URL rules with redirect equivalence.

A rule names a host (with its subdomains) and the beginning of a path; the longest rule
that fits a url decides it. A url that no rule fits takes the decision of its aliases:
urls linked by redirects (meta refresh) or canonical links, over any number of steps.
It is blocked if a rule blocks any url of its component, else allowed. A rule that
allows a url always stands, whatever its aliases are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.components import connected_components
from barlake.runtime import stage

#: Fixed values of the contract: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# ``canonical`` may be one of several rel words.
_REL = r"""(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|canonical(?=[\s/>]))"""
_CANONICAL = rf"""(?is)<link\b[^>]*\brel\s*=\s*{_REL}[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_REFRESH_URL = r"""(?is)\bcontent\s*=\s*["']?\s*[\d.]*\s*[;,]?\s*url\s*=\s*["']?\s*([^"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Behind the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; else empty."""
    return F.translate(_rest(url, r"^([^/?#]*)"), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Behind the host up to ``? #`` or the end."""
    return _rest(url, r"^[^/?#]*([^?#]*)")


def _rest(url: Column, pattern: str) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, pattern, 1)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    found = None
    for verdict, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        value = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def normal_url(url: Column) -> Column:
    """Identity of a url as a node: scheme and host in lower case, no fragment."""
    plain = F.regexp_replace(url, "#.*$", "")
    at = F.instr(plain, "://")
    scheme = F.translate(F.substring(plain, F.lit(1), at - 1), _UPPER, _LOWER)
    tail = F.regexp_extract(F.substring(plain, at + 3, F.length(plain)), r"(?s)^[^/?#]*(.*)$", 1)
    return F.when(at > 0, F.concat(scheme, F.lit("://"), host_of(plain), F.when(tail == "", "/").otherwise(tail)))


def without_dots(url: Column) -> Column:
    """The url with ``.`` and ``..`` segments of its path carried out."""
    site = F.regexp_extract(url, r"(?s)^([^:]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^[^:]*://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^[^?#]*(.*)$", 1)
    # The first segment is empty and stays; a last one of dots leaves its folder.
    segments = F.split(F.concat(path, F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")), "/")
    kept = F.aggregate(
        segments,
        F.lit(None).cast("array<string>"),
        lambda done, s: F.when(done.isNull(), F.array(s))
        .when(s == ".", done)
        .when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.array_append(done, s)),
    )
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(site, F.array_join(kept, "/"), rest)).otherwise(url)


def resolve(base: Column, link: Column) -> Column:
    """A link of the page ``base`` as an absolute url, dot segments not yet carried out."""
    scheme = F.regexp_extract(base, r"^([^:]*):", 1)
    site = F.regexp_extract(base, r"^([^:]*://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), r"^([^:]*://[^/]*(?:/.*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(F.regexp_replace(base, r"(?s)[?#].*$", ""), link))
        .otherwise(F.concat(folder, link))
    )


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Undirected (a, b) between a page's url and the urls that its canonical and refresh tags name."""
    html, url = F.col(html_col), F.col(url_col)

    def named(tag: str, address: str) -> Column:
        tags = F.regexp_extract_all(html, F.lit(tag), F.lit(0))
        return F.transform(tags, lambda t: F.regexp_extract(t, address, 1))

    links = F.concat(named(_CANONICAL, _HREF), named(_REFRESH, _REFRESH_URL))
    found = pages.where(url.contains("://")).select(url.alias("_u"), F.explode(links).alias("_l"))
    # Staged twice: a long expression over another one would be repeated by the optimizer.
    found = stage(found.where("_l <> ''"), "url-links")
    target = resolve(F.col("_u"), F.replace(F.col("_l"), F.lit("&amp;"), F.lit("&")))
    edges = stage(found.select(normal_url(F.col("_u")).alias("a"), target.alias("_t")), "url-targets")
    edges = stage(edges.select("a", without_dots(F.col("_t")).alias("_t")), "url-paths")
    edges = stage(edges.select("a", normal_url(F.col("_t")).alias("b")), "url-edges")
    return edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    A null url, or one without ``://``, has empty host and path, fits no rule and has no
    aliases: it is allowed. Null html has no links. Html of any length is searched whole. Repeated rows are judged alike. Other
    columns are ignored, an empty table gives an empty result.
    """
    roots = connected_components(alias_edges(pages, url_col, html_col), "url-components")
    own = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"] == "block"
    blocked = roots.groupBy("root").agg(F.max(F.coalesce(own, F.lit(False))).alias("_blocked"))
    aliases = stage(
        roots.join(blocked.where("_blocked"), "root").select(F.col("node").alias("_node")), "url-blocked"
    )
    url = F.col(url_col)
    judged = pages.select(
        F.col(id_col),
        F.coalesce(host_of(url), F.lit("")).alias("host"),
        F.coalesce(path_of(url), F.lit("")).alias("path"),
        normal_url(url).alias("_url"),
    ).withColumn("_own", rule_of(F.col("host"), F.col("path"), rules))
    joined = judged.join(aliases, F.col("_url") == F.col("_node"), "left")
    by_alias = F.when(F.col("_node").isNotNull(), "block").otherwise("allow")
    return joined.select(
        id_col,
        "host",
        "path",
        F.col("_own.rule").alias("rule"),
        F.coalesce(F.col("_own.verdict"), by_alias).alias("verdict"),
    )
