import random
import re

from valuora.llm import url_filter as U
from valuora.llm.queries import URL_RULES

URLS = ["http://example.com", "http://EXAMPLE.com/", "https://www.example.com/en/1", "https://a.www.example.com/en/", "x://example.com/en/?a#b",
        "https://notexample.com/en/1", "https://a.net/es/x", "https://net/fr/", "https://a.net/frx/", "https://x.org/es/", "no scheme",
        "", None, "://", "http://", "a://b://c.com/en/", "http://com/", "http://com", "http://m.x.org/a.html", "http://m.x.org/a.htmlx",
        "http://ads-track.x.org/1", "http://x.org/?utm_source=feed", "http://x.org/?utm_source=feeds", "http://x.org/p?page=12&ref=z",
        "http://blog.x.org/en/77", "http://X.com?/en/", "http://example.com\n/en/", "http://é.com/en/", "http://user@a.com:80/en/" + "z" * 9000]


def ref_parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host):])[0]
    low = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    return low, path, low + after[len(host):]


def brute(url, rules, otherwise="allow"):
    """Every rule against every URL."""
    host, path, whole = ref_parts(url)
    fits = [r for r in rules if whole and re.search(r.pattern, whole)]
    fits.sort(key=lambda r: (not r.site, -len(r.name), rules.index(r)))
    best = fits[0] if fits else None
    return (host, path, best.name if best and best.site else None, best.action if best else otherwise, best.name if best else None)


def rows_of(df):
    return sorted(((r.id, r.host, r.path, r.rule, r.verdict, r.matched) for r in df.collect()), key=repr)


def test_query_rules(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[2]), (2, URLS[2]), (2, URLS[2])]
    df = spark.createDataFrame([(i, u, "h", "r", 1) for i, u in rows], "page_id long, url string, host string, normal string, place long").repartition(3)
    assert rows_of(U.judge(df, URL_RULES)) == sorted(((i, *brute(u, URL_RULES)) for i, u in rows), key=repr)


def test_site_rules_mean_hosts_and_subdomains():
    """The expression of a site rule against the rule's own words."""
    for url in URLS:
        host, path, whole = ref_parts(url)
        for h, p in [("com", "/"), ("example.com", "/en/"), ("www.example.com", "/en/"), ("net", "/es/"), ("com", ""), ("", "")]:
            rule = U.site_rule("block", h, p)
            fits = (host == h or host.endswith("." + h)) and path.startswith(p)
            if whole and h:
                assert bool(re.search(rule.pattern, whole)) == fits, (url, h, p)
                assert not fits or set(rule.literals) <= set(re.findall(U.TOKEN, whole))


def test_many_rules_in_parts(spark, monkeypatch):
    rng = random.Random(1)
    words = ["ads", "shop", "news", "cdn", "img", "track", "login", "feed"]
    urls = [(i, f"http://{rng.choice(words)}.{rng.choice(words)}.org/{rng.choice(words)}/{rng.choice(words)}?{rng.choice(words)}=1") for i in range(300)]
    rules = []
    for _ in range(60):
        a, b = rng.sample(words, 2)
        rules.append(rng.choice([
            U.pattern_rule(rng.choice(["allow", "block"]), rf"\b{a}\b.*\b{b}\b", a, b), U.pattern_rule("block", f"{a}=[0-9]"),
            U.site_rule(rng.choice(["allow", "block"]), f"{a}.org", f"/{b}")]))
    monkeypatch.setattr(U, "RULE_BYTES", 300)
    df = spark.createDataFrame(urls, "page_id long, url string")
    assert rows_of(U.judge(df, rules)) == sorted(((i, *brute(u, rules)) for i, u in urls), key=repr)


def test_rules_are_filed_under_the_rarest_literal():
    rules = [U.pattern_rule("block", "x", "common", "rare"), U.pattern_rule("block", "y"), U.pattern_rule("block", "z", "b", "a")]
    assert U.filed(rules, {"common": 9, "rare": 2, "a": 1, "b": 1}) == ({"rare": [0], "a": [2]}, [1])


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(none, URL_RULES).collect() == []
    some = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert rows_of(U.judge(some, [], otherwise="block")) == [(1, "a.com", "/", None, "block", None)]
