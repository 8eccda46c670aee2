"""URL filter against plain string handling and a dense PageRank in numpy."""

import numpy as np
import pytest

from conftest import SF001
from parcelkit.llm import urls

SCHEMA = "page_id long, url string, html string"


def plain(url):
    """(host, path, rule, verdict of the rule) by splitting strings."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]
    best = (None, None)
    for verdict, rule in sorted(urls.RULES, key=lambda r: len(r[1])):
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = (rule, verdict)
    return host, path, *best


def dense(edges, seeds, damping=urls.DAMPING):
    """score = mass + damping * inflow, solved as linear equations."""
    hosts = sorted({h for e in edges for h in e[:2]} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for s, d, w in edges:
        m[at[d], at[s]] += w
    m /= np.maximum(m.sum(axis=0), 1e-300)
    x = np.linalg.solve(np.eye(len(hosts)) - damping * m, [seeds.get(h, 0.0) for h in hosts])
    return dict(zip(hosts, x))


URLS = ["http://Sub.Example.NET/en/a?q", "https://example.net/de/x#f", "http://example.net", "http://a.example.com/de/",
        "http://a.example.com/en/1", "https://x.org/fr/2", "https://x.org/de/2", "http://notexample.net/en/", "no scheme",
        None, "", "http://", "x://h?/de/", "http://ÄB.example.com/de/\n1", "a://b://c/d", "http://example.comx/de/"]


def test_rules_and_parts(spark):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], SCHEMA)
    for r in urls.judge(df).collect():
        host, path, rule, verdict = plain(r.url)
        assert (r.filter.host, r.filter.path, r.filter.rule) == (host, path, rule), r.url
        assert verdict in (None, r.filter.verdict)


@pytest.fixture(scope="module")
def graph(spark):
    rng = np.random.default_rng(5)
    hosts = [f"h{i}.example.{'com' if i % 3 else 'org'}" for i in range(30)] + ["bad.net", "hub.io"]
    rows = []
    for i in range(400):
        h = hosts[int(rng.integers(len(hosts)))]
        lang = ("en", "de", "fr")[int(rng.integers(3))]
        to = [hosts[int(rng.integers(len(hosts)))] for _ in range(int(rng.integers(4)))] + ["hub.io"] * (i % 3 == 0)
        html = "".join(f"<a class=x HREF='https://{t.upper()}/p?x'>t</a><img src=//{t}>" for t in to) + "<a href='/own'>"
        rows.append((i, f"http://{h}/{lang}/{i}", html))
    return rows


def test_spread_matches_linear_equations(spark, graph):
    df = spark.createDataFrame(graph, SCHEMA)
    edges = [tuple(r) for r in urls.host_edges(df).collect()]
    assert edges and all(s != d for s, d, _ in edges)
    allow, block, open_ = {}, {}, {}
    for _, u, _ in graph:
        host, _, _, v = plain(u)
        for name, table in (("allow", allow), ("block", block), (None, open_)):
            table[host] = table.get(host, 0) + (v == name)
    trust, distrust = dense(edges, allow), dense([(d, s, w) for s, d, w in edges], block)
    for r in urls.judge(df).collect():
        t, b = trust.get(r.filter.host, 0), distrust.get(r.filter.host, 0)
        assert r.filter.trust == pytest.approx(t, abs=0.05) and r.filter.distrust == pytest.approx(b, abs=0.05)
        if r.filter.rule is None:
            limit = urls.THRESHOLD * (t + b + urls.UNJUDGED * open_[r.filter.host])
            if abs(b - limit) > 0.2:
                assert r.filter.verdict == ("block" if b > limit else "allow")


def test_edge_cases(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://a.net/x", ""), (2, "http://b.org/x", "<a href=//a.net/x>")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA + ", url_host string, bad int")
    got = urls.judge(df)
    assert got.count() == 4 and got.columns == [*df.columns, "filter"]
    assert urls.judge(df.limit(0)).count() == 0


def test_query(spark, queries):
    got = queries["op2_url_filter"](spark, SF001)
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(pages) and {r.verdict for r in rows} <= {"allow", "block"}
    for r in rows:
        assert (r.host, r.path, r.rule) == plain(pages[r.page_id])[:3]
