import re

from postlake.llm import url_rules
from postlake.llm.url_rules import HOST_RULES, PATTERN_RULES, Rule
from tests.llm.helpers import empty, post_id, posts, rows_of

URLS = [
    "https://www.Example.COM/en/a?x=1", "http://example.com/en/", "http://example.com/EN/", "https://notexample.com/en/x", "http://example.com", "http://example.com?q=/en/",
    "https://a.b.net/es/1#top", "https://net/fr/", "http://net/de/", "//example.com/en/", "", None, "ftp://x.org/login/now", "http://x.org/blogin/", "http://x.org/a.exe", "http://x.org/a.exe.txt",
    "http://x.org/ads/policy/de.html", "http://x.org/ads/1", "http://com/", "http://org.com:80/x", "mail://", "http://x.org/p?sessionid=3", "http://ÄX.org/é\n/login/", "http://a://b.com/en/",
]


def literal(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(r.pattern), r.pattern[2:], r.verdict) for r in HOST_RULES
        for h, p in [r.pattern[2:].split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)
    ]
    return host, path, *((max(fits)[1:]) if fits else (None, None))


def test_host_rules_read_literally(spark):
    rows = [(post_id(k), "c", "t", u) for k, u in enumerate(URLS)]
    found = {r[0]: r[1:] for r in rows_of(url_rules.judge_links(posts(spark, rows)), "id", "host", "path", "rule", "verdict", "pattern")}
    for i, _, _, url in rows:
        host, path, rule, verdict = literal(url)
        assert found[i][:3] == (host, path, rule)
        if rule:
            assert found[i][3] == verdict
    by_url = {u: found[post_id(k)][3:] for k, u in enumerate(URLS)}
    assert by_url["ftp://x.org/login/now"] == ("block", "/login/")
    assert by_url["http://x.org/blogin/"] == ("allow", None)
    assert by_url["http://x.org/a.exe"] == ("block", ".exe|") and by_url["http://x.org/a.exe.txt"][0] == "allow"
    assert by_url["http://x.org/ads/policy/de.html"][0] == "allow" and by_url["http://x.org/ads/1"][0] == "block"


def test_hosts_in_a_query_fit_no_host_rule(spark):
    urls = ["https://foo.org?next=www.com/x", "https://foo.org?u=x.net/es/", "https://foo.org?u=.example.com/en/", "https://foo.org/?u=x.net/fr/", "https://x.net/es/?u=y.com/", "https://foo.com?u=x.net/es/"]
    found = {r[0]: r[1:] for r in rows_of(url_rules.judge_links(posts(spark, [(post_id(k), "c", "t", u) for k, u in enumerate(urls)])), "permalink", "host", "path", "rule", "verdict")}
    for url in urls:
        host, path, rule, verdict = literal(url)
        assert found[url] == (host, path, rule, verdict or "allow")
    assert [found[u][2] for u in urls] == [None, None, None, None, "net/es/", None]


def test_index_misses_no_rule(spark):
    rules = [*HOST_RULES, *PATTERN_RULES, Rule("block", "gin"), Rule("block", "*en*x")]
    found = rows_of(url_rules.judge_links(posts(spark, [(post_id(k), None, None, u) for k, u in enumerate(URLS)]), rules), "permalink", "host", "path", "verdict", "n_checked")
    for url, host, path, verdict, checked in found:
        rest = url.split("://", 1)[1].split("#")[0] if url and "://" in url else ""
        target = host + rest[len(host) :]
        fits = [r for r in rules if url_rules._regex(r.pattern).search(target)]
        hosts = [r for r in fits if r.is_host_rule]
        best = max(hosts or fits, key=lambda r: (len(r.pattern), r.verdict == "block"), default=None)
        assert verdict == (best.verdict if best else "allow")
        assert checked < len(rules) / 2


def test_tokens_are_whole():
    assert url_rules.tokens_of("||example.com/en/") == ["example", "com", "en"]
    assert url_rules.tokens_of("/login/") == ["login"] and url_rules.tokens_of("gin") == [] and url_rules.tokens_of(".exe|") == ["exe"]
    assert url_rules.tokens_of("/ads/policy/*.html") == ["ads", "policy"]


def test_repeated_rows_and_empty_table(spark):
    table = posts(spark, [(None, None, None, URLS[0])] * 2)
    assert len(rows_of(url_rules.judge_links(table), "id", "verdict")) == 2
    assert rows_of(url_rules.judge_links(empty(table)), "id") == []
