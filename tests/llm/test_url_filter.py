import random

import pytest

from spriteloom.llm.url_filter import RULES, HostTrie, split_url, url_filter

URLS = [
    None, "", "no mark", "http://", "http://com", "http://com/", "https://A.Example.COM/en/x?y#z", "http://www.example.com/en/",
    "http://x.www.example.com/en/1", "http://www.example.com/en", "http://net/es/1", "http://a.net/fr/?q", "http://a.net?/fr/", "http://a.net#/fr/",
    "ftp://notexample.com/en/", "http://a..com/", "http://.com/", "x://y://z.com/", "http://exa\nmple.com/en/", "http://com./",
]


def brute(url, rules):
    host, path = split_url(url)
    fits = [(len(h.split(".")), len(p), a == "block", h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[3:]) if fits else (host, path, None, "allow")


def frame(spark):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")


def test_split():
    assert split_url("http://U@Ex.com:8/a/b?c#d") == ("u@ex.com:8", "/a/b")
    assert split_url("a://b?c/d") == ("b", "")


def test_trie_against_brute_force():
    random.seed(5)
    for _ in range(300):
        label = lambda: random.choice(["a", "b", "c"])
        rules = [(random.choice(["allow", "block"]), ".".join(label() for _ in range(random.randint(1, 3))), "/" + "".join(random.choices("xy/", k=random.randint(0, 4)))) for _ in range(8)]
        trie = HostTrie(rules)
        for _ in range(20):
            url = "h://" + ".".join(label() for _ in range(random.randint(1, 4))) + "/" + "".join(random.choices("xy/", k=random.randint(0, 6)))
            host, path = split_url(url)
            found = trie.find(host, path)
            assert (host, path, found and found[1], found[0] if found else "allow") == brute(url, rules), (url, rules)


@pytest.mark.parametrize("by", ["trie", "join"])
def test_both_ways(spark, by):
    rules = RULES if by == "trie" else spark.createDataFrame(RULES, "action string, host string, path string")
    got = url_filter(frame(spark), rules, max_broadcast_rules=1000 if by == "trie" else 1).collect()
    want = [(i, *brute(u, RULES)) for i, u in enumerate(URLS)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_empty(spark):
    assert url_filter(frame(spark).limit(0)).collect() == []
