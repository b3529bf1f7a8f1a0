import random
import re

from perennia.llm.url_filter import Rule, judge_urls

RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "bad.org", "/"), Rule("allow", "good.org", "/")]


def host_and_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def fitting(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


def brute(pages, damping=0.85, rounds=400):
    named = [(i, *host_and_path(u), h) for i, u, h in pages]
    links, seeds, count = {}, {"allow": {}, "block": {}}, {}
    for _, host, path, html in named:
        if host:
            count[host] = count.get(host, 0) + 1
            rule = fitting(host, path)
            if rule:
                seeds[rule.verdict][host] = seeds[rule.verdict].get(host, 0) + 1
        for url in re.findall(r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)""", html or ""):
            dst = host_and_path("http:" + url if url.startswith("//") else url)[0]
            if host and dst and host != dst:
                links[host, dst] = links.get((host, dst), 0) + 1

    def walk(kind, edges):
        start = {h: n / count[h] for h, n in seeds[kind].items()}
        out = {}
        for (a, _), n in edges.items():
            out[a] = out.get(a, 0) + n
        score = dict(start)
        for _ in range(rounds):
            new = dict(start)
            for (a, b), n in edges.items():
                new[b] = new.get(b, 0.0) + damping * score.get(a, 0.0) * n / out[a]
            score = new
        return score

    trust, distrust = walk("allow", links), walk("block", {(b, a): n for (a, b), n in links.items()})
    result = []
    for i, host, path, _ in named:
        rule, bad = fitting(host, path), round(distrust.get(host, 0.0), 9)
        by_host = "block" if bad >= 0.5 and bad > round(trust.get(host, 0.0), 9) else "allow"
        result.append((i, host, path, rule and rule.host + rule.path, rule.verdict if rule else by_host))
    return sorted(result, key=str)


def test_equal_to_brute_force(spark):
    rng = random.Random(7)
    hosts = ["a.net", "b.example.net", "bad.org", "x.bad.org", "good.org", *[f"h{i}.com" for i in range(12)]]
    urls = [None, "", "no scheme", "http://", "HTTP://H1.COM", "http://h2.com?x=/en/", "http://a.net#/", "http://A.net/x", "://h3.com/é?ü", "http://xbad.org/"]
    pages = []
    for i in range(300):
        links = "".join(f"""<a HREF = {rng.choice('"' + "'")}{rng.choice(["http://", "//"])}{rng.choice(hosts)}/p">x</a> <a href="/in">""" for _ in range(rng.randint(0, 4)))
        url = rng.choice(urls) if rng.random() < 0.2 else f"https://{rng.choice(hosts)}/{rng.choice(['en', 'de'])}/{i}?q#f"
        pages.append((i, url, rng.choice([links, links, links, None])))
    rows = spark.createDataFrame([(*p, "x", 0.0) for p in pages], "page_id long, url string, html string, host string, trust double")
    out = judge_urls(rows, RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    want = brute(pages)
    assert sorted(map(tuple, out), key=str) == want
    assert {w[4] for w in want if w[3] is None} == {"allow", "block"}


def test_empty_and_repeated_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", None)] * 3 + [(None, None, None)], "page_id long, url string, html string")
    out = judge_urls(pages, RULES).select("page_id", "verdict").collect()
    assert sorted(map(tuple, out), key=str) == [(1, "block")] * 3 + [(None, "allow")]
    assert judge_urls(pages.where("false"), RULES).count() == 0


def test_scores_are_those_of_the_fixed_point(spark):
    """One of five equal linkers of a blocked host, which exchanges links with a host of no other links."""
    bad = '<a href="http://bad.org/">'
    pages = [(0, "http://a.com/", bad + '<a href="//b.com/">'), (1, "http://b.com/", "<a href='http://a.com/'>"), (2, "http://bad.org/", None)]
    pages += [(3 + i, f"http://l{i}.com/", bad + '<a href="//a.com/">') for i in range(4)]
    out = judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES)
    got = {r["page_id"]: r for r in out.collect()}
    assert [(i, got[i]["verdict"]) for i in range(7)] == [(p[0], p[4]) for p in sorted(brute(pages))]
    for i, r in got.items():
        assert abs(r["distrust"] - fixed_point(pages)[r["host"]]) < 1e-8


def fixed_point(pages):
    import numpy as np

    hosts = sorted({host_and_path(u)[0] for _, u, _ in pages})
    at = {h: i for i, h in enumerate(hosts)}
    links = np.zeros((len(hosts), len(hosts)))
    for _, url, html in pages:
        for _, dst in re.findall(r"href=([\"'])(?:http:)?//([^/]+)/", html or ""):
            links[at[dst], at[host_and_path(url)[0]]] += 1  # distrust goes back along links
    shares = links / np.maximum(links.sum(axis=1, keepdims=True), 1)
    seed = np.array([float(h == "bad.org") for h in hosts])
    return dict(zip(hosts, np.linalg.solve(np.eye(len(hosts)) - 0.85 * shares.T, seed)))
