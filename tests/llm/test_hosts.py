import re

import pytest

from pulsefeed.llm import hosts
from pulsefeed.llm.hosts import Rule

RULES = (Rule("allow", "good.net", "/"), Rule("block", "bad.net", "/"), Rule("block", "good.net", "/x"), Rule("allow", "bad.net", "/ok/"))


def link(*targets):
    return "".join(f"<p><a class=b href=\"{t}\">t</a>" for t in targets)


PAGES = [
    (1, "http://good.net/1", link("https://Friend.org/a", "/own", "//friend.org/b?c")),
    (2, "http://www.good.net/x1", link("http://friend.org")),
    (3, "https://friend.org/?q", link("http://friend2.org/z#y")),
    (4, "http://friend2.org", None),
    (5, "http://bad.net/", link("http://good.net/")),
    (6, "HTTP://LinksBad.ORG/p/q?r", link("http://bad.net/a", "http://bad.net/b")),
    (7, "http://alone.org#f", ""),
    (8, None, link("http://bad.net/")),
    (9, "no scheme", None),
    (10, "http://bad.net/ok/1", None),
    (11, "http://notgood.net/x", link("http://linksbad.org/")),
    (11, "http://notgood.net/x", link("http://linksbad.org/")),
    (None, "http:///empty", None),
]


def brute(pages):
    """Plain dictionaries: seeds, edges, rounds."""
    def parse(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")

    def rule(host, path):
        fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: len(r.name), default=None)

    edges, seen = {}, {}
    for _, url, html in pages:
        host, path = parse(url)
        r = rule(host, path)
        n, a, b = seen.get(host, (0, 0, 0))
        seen[host] = n + 1, a + (r is not None and r.verdict == "allow"), b + (r is not None and r.verdict == "block")
        for href in re.findall(hosts.HREF, html or ""):
            target = parse("x:" + href if href.startswith("//") else href)[0]
            if target and host and target != host:
                edges[host, target] = edges.get((host, target), 0) + 1
    nodes = set(seen) | {x for e in edges for x in e}

    def rank(seed, way):
        score = {h: 0.15 * seed(h) for h in nodes}
        for _ in range(hosts.ROUNDS):
            new = {h: 0.15 * seed(h) for h in nodes}
            for e, n in edges.items():
                f, t = e if way else e[::-1]
                total = sum(m for k, m in edges.items() if (k if way else k[::-1])[0] == f)
                new[t] += 0.85 * score[f] * n / total
            score = new
        return score

    share = lambda i: lambda h: seen[h][i] / seen[h][0] if h in seen else 0.0
    trust, distrust = rank(share(1), True), rank(share(2), False)
    out = []
    for page, url, _ in pages:
        host, path = parse(url)
        r = rule(host, path)
        bad = host and distrust[host] > 0.5 * (trust[host] + distrust[host])
        out.append((page, host, path, r.name if r else None, r.verdict if r else "block" if bad else "allow"))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in hosts.judge(pages, RULES).collect()), key=str)
    assert got == brute(PAGES)
    verdicts = {r[0]: r[4] for r in got}
    assert verdicts[6] == "block" and verdicts[11] == "block" and verdicts[3] == "allow" and verdicts[7] == "allow" and verdicts[8] == "allow"


def test_trust_flows_forward(spark):
    seeds = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", 0.0)], "host string, seed double")
    edges = spark.createDataFrame([("a", "b", 3), ("a", "c", 1)], "src string, dst string, n long")
    got = dict(hosts.propagate(seeds, edges, "src", "dst").collect())
    assert got["b"] == pytest.approx(0.15 * 0.85 * 0.75) and got["c"] == pytest.approx(0.15 * 0.85 * 0.25)


def test_native_and_empty(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert not re.search("Python|Arrow|Pandas", hosts.judge(pages, RULES)._jdf.queryExecution().toString())
    assert hosts.judge(pages.limit(0), RULES).collect() == []
