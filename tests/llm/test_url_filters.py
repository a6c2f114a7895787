import random
from urllib.parse import urljoin

from podium.llm import url_filters as u
from podium.llm.components import components


def test_components_against_union_find(spark):
    random.seed(4)
    for n, m in ((30, 25), (200, 150), (50, 400)):
        edges = [(random.randrange(n), random.randrange(n)) for _ in range(m)] + [(None, 1), (5, None), (7, 7)]
        edges += [(1000, 1000 + i) for i in range(1, 60)] + [(2000 + i, 2001 + i) for i in range(40)]  # a star and a chain
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in edges:
            if a is not None and b is not None and a != b:
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: find(x) for x in root}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []


CANON = '<LINK data-x="1" rel="canonical" href="{}">'
REFRESH = "<meta http-equiv='refresh' content='0; url={}'>"
PAGES = [
    (1, "https://Shop.NET/a", ""),  # blocked by net/
    (2, "http://plain.xyz/p", CANON.format("http://shop.net/a#f")),  # alias of a blocked url
    (3, "http://other.xyz/q", REFRESH.format("//plain.xyz/p")),  # alias of an alias
    (4, "http://www.example.net/en/x", CANON.format("http://shop.net/a")),  # own allow stands
    (5, "http://rel.xyz/d/e", CANON.format("../not/handled")),
    (6, "http://rel.xyz/d/f?q", CANON.format("/root")),
    (7, "http://rel.xyz/root", REFRESH.format("x.html")),
    (8, "http://rel.xyz/x.html", REFRESH.format("http://bad.example.com/de/1")),
    (9, None, CANON.format("http://shop.net/a")),
    (10, "no scheme", None),
    (11, "http://notnet/", None), (12, "http://net", None), (13, "http://NET/?x", None), (14, "http://x.org/fr/a", ""), (15, "ftp://x.org/frx", ""),
    (16, "http://a.example.net/en/", None), (17, "http://example.netx/", None), (18, "http://h.xyz?a://b/c", None),
    (2, "http://plain.xyz/p", ""),
]


def brute(pages):
    def host(url):
        rest = (url or "").split("://", 1)
        if len(rest) < 2:
            return "", "", None
        import re

        h = re.match(r"[^/?#]*", rest[1])[0]
        p = re.match(r"[^?#]*", rest[1][len(h) :])[0]
        low = "".join(c.lower() if c < "\x80" else c for c in h)
        return low, p, low + rest[1][len(h) :].split("#")[0]

    def rule(h, p):
        fits = [(len(a) + len(b), v == "allow", a + b, v) for a, b, v in u.RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
        return max(fits)[2:] if fits else (None, None)

    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    import re

    for _, url, html in pages:
        h, p, node = host(url)
        for found in re.findall(r"(?:canonical\" href=\"|url=)([^\"'>]+)", html or ""):
            if node is not None:
                full = found if "://" in found else "http:" + found if found.startswith("//") else None
                if full is None:
                    full = f"http://{h}{found}" if found.startswith("/") else f"http://{h}" + p[: p.rfind("/") + 1] + found
                root[find(host(full)[2])] = find(node)
    blocked = {find(x) for x in list(root) if rule(*host("x://" + x)[:2])[1] == "block"}
    out = []
    for i, url, _ in pages:
        h, p, node = host(url)
        r, v = rule(h, p)
        out.append((i, h, p, r or "", v or ("block" if node in root and find(node) in blocked else "allow")))
    return sorted(out)


def test_verdicts(spark):
    pages = spark.createDataFrame([(*p, "z", "y") for p in PAGES], "page_id long, url string, html string, verdict string, node string")
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in u.judge(pages).collect())
    assert got == brute(PAGES)
    by_id = {r[0]: r[4] for r in got}
    assert [by_id[i] for i in (1, 2, 3, 4, 6, 7, 8, 9, 12, 13, 14)] == ["block", "block", "block", "allow", "block", "block", "block", "allow", "allow", "block", "allow"]


def test_redirect_table_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.xyz/1", None)], "page_id long, url string, html string")
    moves = spark.createDataFrame([("http://a.xyz/1", "http://b.net/"), (None, "http://c.net/")], "from_url string, to_url string")
    assert [r.verdict for r in u.judge(pages, redirects=moves).collect()] == ["block"]
    assert u.judge(pages.limit(0)).collect() == []
