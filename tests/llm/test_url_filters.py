import itertools

import numpy as np
import pytest
from tidemark.llm import url_filters as U
from tidemark.llm._components import components

RULES = [U.Rule("block", "com", "/en/"), U.Rule("allow", "example.com", "/en/7"), U.Rule("allow", "net", "/de/"), U.Rule("block", "example.net", "/de/8"), U.Rule("block", "org", "/es/")]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.partition("://")[2]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut].translate(LOWER), rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def rule_of(url, rules):
    host, path = split(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fit, key=lambda r: (-len(r.name), r.name), default=None)


def with_path(url):
    """A URL of a class has a path."""
    head, mark, rest = url.partition("://")
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    return url if not mark or rest[cut : cut + 1] == "/" else f"{head}://{rest[:cut]}/{rest[cut:]}"


def expected(rows, edges, rules):
    """rows: (id, url); edges: pairs of URLs without fragments, in lower-case hosts."""
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = []
    for i, url in rows:
        host, path = split(url)
        rule = rule_of(url, rules)
        seen, todo = set(), [with_path(url.partition("#")[0])] if url else []
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += near.get(x, ())
        verdicts = {r.verdict for r in (rule_of(x, rules) for x in seen) if r}
        verdict = rule.verdict if rule else "block" if "block" in verdicts and "allow" not in verdicts else "allow"
        out.append((i, host, path, rule.name if rule else None, verdict))
    return sorted(out, key=str)


def run(df, rules=RULES, **options):
    return sorted((tuple(r) for r in U.url_filter(df, rules, **options).collect()), key=str)


def test_odd_urls(spark):
    urls = [None, "", "x", "http://", "http://A.Example.COM", "http://a.example.com?x=/en/", "http://example.com/en/7#f", "https://notexample.com/en/1", "http://com/en/", "//x.com/en/", "http://x.net/de/8", "http://example.net/de/8/9", "http://u:p@x.org:80/es/1", "http://x.org#/es/", "http://ÄB.com/en/é", "http://a.com/en\n/x", "http://x.com/" + "en/" * 20_000]
    rows = list(enumerate(urls)) + [(3, "http://x.com/en/"), (None, "http://x.com/en/")]
    df = spark.createDataFrame([(i, u, None, "c") for i, u in rows], "page_id long, url string, html string, host string")
    assert run(df) == expected(rows, [], RULES)
    assert run(df.limit(0)) == []


@pytest.mark.parametrize("as_table", [False, True])
def test_many_rules_are_joined(spark, as_table):
    random = np.random.default_rng(3)
    rules = [U.Rule(str(random.choice(["block", "allow"])), ".".join(random.choice(list("abcd"), random.integers(1, 4))), "/" + "".join(random.choice(list("xy/"), random.integers(0, 4)))) for _ in range(400)]
    rules = list({r.name: r for r in rules}.values())
    rows = [(k, f"http://{'.'.join(random.choice(list('abcd'), random.integers(1, 5)))}/{''.join(random.choice(list('xy/'), random.integers(0, 6)))}") for k in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    assert run(df, U.rules_table(spark, rules) if as_table else rules + [U.Rule("block", f"no{k}", "/") for k in range(300)], html_col=None) == expected(rows, [], rules)


def test_aliases_by_redirects_and_canonical_links(spark):
    rows = [
        (1, "http://x.com/en/1", None),  # blocked by a rule
        (2, "http://a.fr/p", '<head><LINK href="http://X.com/en/1" REL=canonical></head>'),
        (3, "http://b.fr/q#top", "<meta http-equiv='refresh' content='0; url=http://a.fr/p'>"),
        (4, "http://c.fr/dir/page?z", '<link rel="stylesheet" href="http://x.com/en/1"><link rel="canonical" href="../q">'),
        (5, "http://d.fr/1", '<link rel="canonical" href="/2">'),
        (6, "http://d.fr/2", None),
        (7, "http://e.fr/1", '<link rel="canonical" href="http://x.org/es/5">'),
        (8, "http://e.fr/2", '<link rel="canonical" href="http://e.fr/1">'),
        (9, "http://example.com/en/7", '<link rel="canonical" href="http://e.fr/2">'),  # explicitly allowed: spares the class
        (10, "http://x.com/en/9", '<link rel="canonical" href="http://e.fr/2">'),
        (11, None, '<link rel="canonical" href="http://x.com/en/1">'),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    given = spark.createDataFrame([("http://f.fr/", "http://g.fr/"), ("http://g.fr/", "http://b.fr/q"), (None, "http://g.fr/")], "a string, b string")
    more = df.union(spark.createDataFrame([(12, "http://f.fr/", None)], df.schema))
    edges = [("http://a.fr/p", "http://x.com/en/1"), ("http://b.fr/q", "http://a.fr/p"), ("http://d.fr/1", "http://d.fr/2"), ("http://e.fr/1", "http://x.org/es/5"), ("http://e.fr/2", "http://e.fr/1"), ("http://example.com/en/7", "http://e.fr/2"), ("http://x.com/en/9", "http://e.fr/2"), ("http://f.fr/", "http://g.fr/"), ("http://g.fr/", "http://b.fr/q")]
    got = run(more, redirects=given)
    assert got == expected([r[:2] for r in rows] + [(12, "http://f.fr/")], edges, RULES)
    verdict = {r[0]: r[4] for r in got}
    assert verdict[2] == verdict[3] == verdict[12] == "block" and verdict[7] == verdict[8] == "allow" and verdict[10] == "block"


def test_components_of_random_graphs(spark):
    random = np.random.default_rng(4)
    chain = [(k, k + 1) for k in range(1000, 1040)]
    hub = [(5000, 5000 + k) for k in range(1, 300)]
    some = [tuple(int(x) for x in random.integers(0, 400, 2)) for _ in range(260)]
    edges = chain + hub + some
    root = {x: x for x in itertools.chain(*edges)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()
    assert {(r.node, r.root) for r in got} == {(x, find(x)) for x in root} and len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_are_resolved_as_browsers_do(spark):
    from urllib.parse import urljoin

    bases = ["http://a.com/b/c/d?q#f", "http://a.com", "http://a.com/", "http://a.com/b/", "https://A.com:80/x/y"]
    links = ["g", "./g", "g/", "/g", "//g.com/x", "?y", "g?y", "../", "..", "../g", "../..", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "http://z.org/a/../../bad/", "http://z.org/a/./b/..", "x?y=/../z", "a/b/../c"]
    rows = [(k, b, x) for k, (b, x) in enumerate((b, x) for b in bases for x in links)]
    df = spark.createDataFrame(rows, "k long, base string, link string")
    got = {r.k: r.u for r in df.select("k", U.node_of(U.resolved(U.F.col("base"), U.F.col("link"))).alias("u")).collect()}

    def want(base, link):
        whole = urljoin(base, link)
        if "://" in link:  # dot steps of absolute links are taken too
            whole = urljoin(link, link.partition("://")[2][link.partition("://")[2].find("/") :])
        host = whole.partition("://")[2].partition("/")[0]
        return with_path(whole.partition("#")[0].replace(host, host.translate(LOWER), 1))

    assert {k: got[k] for k, _, _ in rows} == {k: want(b, x) for k, b, x in rows}


def test_base_dots_and_empty_paths_in_classes(spark):
    rows = [
        (1, "http://q.com/a/page", '<link rel="canonical" href="../../en/1">'),  # q.com/en/1 is blocked
        (2, "http://w.fr/x", '<base href="http://q.com/en/"><link rel="canonical" href="1">'),
        (3, "http://w.fr/x", None),
        (4, "http://v.fr", '<link rel="canonical" href="http://w.fr/x">'),
        (5, "http://v.fr/", None),
        (6, "HTTP://V.fr/#top", None),
        (7, "http://u.fr/", '<base href="/en/"><meta http-equiv="refresh" content="0;url=../y">'),
    ]
    got = {r.page_id: r.verdict for r in U.url_filter(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "block", 7: "allow"}


def test_hot_hubs_and_repeated_pages(spark):
    """A third of the rows have one URL, and a third lead to one hub."""
    rows = [(k, "http://hot.fr/p", None) for k in range(400)] + [(1000 + k, f"http://s{k}.fr/", '<link rel="canonical" href="http://hot.fr/p">') for k in range(400)]
    rows += [(2000, "http://hot.fr/p", '<link rel="canonical" href="http://x.com/en/1">')] + [(3000 + k, None, None) for k in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    got = run(df)
    assert len(got) == len(rows)
    assert all(r[4] == ("block" if r[0] < 3000 else "allow") for r in got)
