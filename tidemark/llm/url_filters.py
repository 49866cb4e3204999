"""URL filters with redirect equivalence, in DataFrame operations only.

A rule has a verdict, a host and the beginning of a path; it fits its host and all subdomains, and the longest fitting rule judges a URL.
Redirects and canonical links join URLs into classes of aliases (connected components). URLs that no rule fits take the
class's verdict: block if a rule blocks a member and none explicitly allows one, else allow. An explicit allow so takes precedence.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._components import components
from ._shared import written
from ._skew import lookup, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INLINE = 256


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' for null or without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.regexp_replace(_rest(url), "^[^/?#]*", ""), "^[^?#]*", 0)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def node_of(url: Column) -> Column:
    """A URL as a member of a class: scheme and host lower-cased, ``/`` for an empty path, without its fragment; null without ``://``."""
    at = F.instr(url, "://")
    plain = F.regexp_replace(url, "(?s)#.*$", "")
    behind = F.regexp_replace(_rest(plain), "^[^/?#]*", "")
    return F.when(at > 0, F.concat(F.translate(F.substr(plain, F.lit(1), at + 2), UPPER, LOWER), host_of(plain), F.when(F.startswith(behind, F.lit("/")), "").otherwise("/"), behind))


def judged(df: DataFrame, rules: list[Rule] | DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """``df`` with ``rule`` and ``rule_verdict`` of the longest rule that fits, else null.

    Few rules become one expression. A table of rules (verdict, host, path), or more than ``INLINE``, is hash-joined with the host's
    suffixes of every distinct (host, path). Of equally long rules the alphabetically first is taken.
    """
    if not isinstance(rules, DataFrame) and len(rules) <= INLINE:
        rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
        for r in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
            fits = ((F.col(host) == r.host) | F.endswith(F.col(host), F.lit("." + r.host))) & F.startswith(F.col(path), F.lit(r.path))
            rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
        return df.withColumns({"rule": rule, "rule_verdict": verdict})
    if not isinstance(rules, DataFrame):
        rules = df.sparkSession.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    listed = rules.select(F.col("verdict").alias("rule_verdict"), F.col("host").alias("suffix"), F.col("path").alias("begin"), F.concat("host", "path").alias("rule"))
    seen = written(df.groupBy(F.col(host).alias("h"), F.col(path).alias("p")).agg(F.count("*").alias("n")), "urls")
    labels = F.split("h", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    fit = seen.select("h", "p", "n", suffix.alias("suffix")).join(small(listed), "suffix").filter(F.startswith(F.col("p"), F.col("begin")))
    best = fit.groupBy("h", "p", "n").agg(F.min_by(F.struct("rule", "rule_verdict"), F.struct(-F.length("rule"), F.col("rule"))).alias("b"))
    best = written(best.select(F.struct("h", "p").alias("key"), "n", "b.rule", "b.rule_verdict"), "urls")
    total = seen.agg(F.sum("n")).first()[0] or 0
    return lookup(df.withColumn("key", F.struct(F.col(host).alias("h"), F.col(path).alias("p"))), best, "key", "n", max(1, total)).drop("key", "n")


def without_dots(path: Column) -> Column:
    """A path that begins with ``/``, its ``.`` and ``..`` steps taken; ``..`` at the top stays there."""

    def taken(parts: Column) -> Column:
        last = F.element_at(parts, -1)

        def step(done: Column, x: Column) -> Column:
            return F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.array_append(done, x))

        # A last dot step leaves a folder.
        steps = F.when(last == "..", parts).otherwise(F.slice(parts, F.lit(1), F.size(parts) - 1))
        return F.array_append(F.aggregate(steps, F.array().cast("array<string>"), step), F.when(last.isin(".", ".."), F.lit("")).otherwise(last))

    return F.concat(F.lit("/"), F.array_join(_let(F.split(F.substr(path, F.lit(2)), "/", -1), taken), "/"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _joined(base: Column, link: Column) -> Column:
    scheme = F.regexp_extract(base, "^([^:]*://)", 1)
    authority = F.regexp_extract(base, "^([^:]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, "^([^:]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    slash = F.when(folder.rlike("[^/]/$"), "").otherwise("/")
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when((F.length(link) == 0) | link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | F.startswith(link, F.lit("#")), None)
        .when(F.startswith(link, F.lit("//")), F.concat(F.replace(scheme, F.lit("//"), F.lit("")), link))
        .when(F.startswith(link, F.lit("/")), F.concat(authority, link))
        .when(F.startswith(link, F.lit("?")), F.concat(F.regexp_extract(base, "^([^?#]*)", 1), link))
        .otherwise(F.concat(folder, slash, link))
    )


def _dotless(whole: Column) -> Column:
    parts = [F.regexp_extract(whole, "^([^:]*://[^/?#]*)([^?#]*)((?s).*)$", k) for k in (1, 2, 3)]
    dotted = whole.rlike(r"^[^:]*://[^/?#]*(/[^?#]*)?/\.\.?(/|\?|#|$)")
    return F.when(dotted, F.concat(parts[0], _let(parts[1], without_dots), parts[2])).otherwise(whole)


def resolved(base: Column, link: Column) -> Column:
    """A link on the page ``base`` as a whole URL: absolute, //host, /path, ?query or relative to the page's folder, with dot steps taken. Null for other schemes."""
    both = F.struct(base.alias("base"), F.trim(F.replace(link, F.lit("&amp;"), F.lit("&"))).alias("link"))
    return _let(_let(both, lambda x: _joined(x["base"], x["link"])), _dotless)


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (a, b) from a page to its canonical link and to the target of its refresh redirect; both may be relative to the page's first ``base``."""
    tags = F.regexp_extract_all(F.col(html_col), F.lit(r"(?is)(<(?:link|meta|base)\b[^>]*>)"), F.lit(1))
    bases = F.filter(tags, lambda t: t.rlike(r"(?is)^<base\b.*\bhref\s*="))
    canonical = F.filter(tags, lambda t: t.rlike(r"""(?is)^<link\b.*\brel\s*=\s*["']?\s*canonical\b"""))
    refresh = F.filter(tags, lambda t: t.rlike(r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?\s*refresh\b"""))
    value = r"""(?is)\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""
    to = r"""(?is)\burl\s*=\s*['"]?([^"'>]+)"""

    def unquoted(tag: Column) -> Column:
        return F.regexp_replace(F.regexp_extract(tag, value, 1), "^[\"']|[\"']$", "")

    links = F.concat(F.transform(canonical, unquoted), F.transform(refresh, lambda t: F.regexp_extract(t, to, 1)))
    marked = F.col(html_col).rlike("(?i)canonical|http-equiv")
    found = pages.filter(marked & F.col(url_col).isNotNull()).select(F.col(url_col).alias("url"), unquoted(F.get(bases, F.lit(0))).alias("base"), F.explode(links).alias("link"))
    base = F.coalesce(F.when(F.col("base").isNotNull(), resolved(F.col("url"), F.col("base"))), F.col("url"))
    found = found.withColumn("target", _let(base, lambda x: resolved(x, F.col("link"))))
    return found.select(node_of(F.col("url")).alias("a"), _let(F.col("target"), node_of).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")


def blocked_aliases(edges: DataFrame, rules: list[Rule] | DataFrame) -> DataFrame:
    """``node`` of every member of a class in which a rule blocks some member and explicitly allows none."""
    nodes = written(components(edges), "urls")
    nodes = judged(nodes.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))}), rules)
    nodes = written(nodes.select("node", "root", "rule_verdict"), "urls")
    blocks, allows = (F.max((F.coalesce("rule_verdict", F.lit("")) == v).cast("int")) for v in ("block", "allow"))
    classes = written(nodes.groupBy("root").agg(F.count("*").alias("members"), blocks.alias("blocks"), allows.alias("allows")), "urls")
    return lookup(nodes.select("node", "root"), classes, "root", "members", max(1, nodes.count())).filter("blocks = 1 AND allows = 0").select("node")


def url_filter(pages: DataFrame, rules: list[Rule] | DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """id, host, path, rule and verdict of every row.

    ``redirects`` (a, b) are URLs that lead from one to the other, besides those that pages state. Null URLs and those without ``://`` have
    an empty host and path, no class, and are allowed unless a rule with an empty host fits. Repeated rows each have a result. Null or very long html is fine: it
    only may state edges. Equally long rules tie by name. Extra columns are ignored; an empty table gives an empty result.
    """
    light = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("url"))
    out = judged(light.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}), rules)
    edges = page_edges(pages, url_col, html_col) if html_col else None
    if redirects is not None:
        given = redirects.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b"))
        edges = given if edges is None else edges.unionByName(given)
    edges = None if edges is None else written(edges.distinct(), "urls")
    if edges is None or edges.isEmpty():
        out = out.withColumn("alias_blocked", F.lit(False))
    else:
        blocked = written(blocked_aliases(edges, rules), "urls")
        # Rows that a rule judges need no class; nodes with many rows are split off by count.
        asked = out.withColumn("node", F.when(F.col("rule_verdict").isNull(), node_of(F.col("url"))))
        free = asked.filter("node IS NOT NULL")
        counts = free.join(small(blocked.select("node")), "node", "left_semi").groupBy("node").agg(F.count("*").alias("n_rows"))
        counts = written(counts.withColumn("alias_blocked", F.lit(True)), "urls")
        free = lookup(free, counts, "node", "n_rows", max(1, light.count())).drop("n_rows")
        out = free.unionByName(asked.filter("node IS NULL").withColumn("alias_blocked", F.lit(False)), allowMissingColumns=True)
    verdict = F.coalesce("rule_verdict", F.when(F.coalesce("alias_blocked", F.lit(False)), "block").otherwise("allow"))
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"))


def rules_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
