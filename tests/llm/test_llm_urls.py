from itertools import combinations

from pyspark.sql import functions as F

from tallywell.llm import url_rules as u

URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.net/en/1?x=1#y", "http://example.net/en", "http://a.example.net/en/", "http://example.net/EN/",
    "http://b.net", "http://b.net?x=/", "http://b.net/#/", "http://xnet/", "http://example.com/de/2.html", "http://m.example.com/de", "x://q.org/fr/z://y",
    "ftp://org/fr/", "://h/p?q", "http://a b/c d", "http://a..net//", "//nothing", "http://myexample.com/de/",
]


def listed(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [r for r in u.LISTED if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_listed_rules(spark):
    df = spark.createDataFrame([(i, x, "k", "v") for i, x in enumerate(URLS)] + [(None, URLS[4], "k", "v")],
                               "page_id long, url string, tokens string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in u.judge(df).collect()}
    assert len(got) == len(URLS) + 1
    for i, x in enumerate(URLS):
        host, path, rule, verdict = listed(x)
        assert got[i][:3] == (host, path, rule) and (verdict is None or got[i][3] == verdict), x
        assert got[i][3] in ("allow", "block")
    assert got[None] == got[4] and got[0] == ("", "", None, "allow")


def mined(rows, s):
    n, out = len(rows), {}
    for size in range(1, 5):
        for part in {c for t, _ in rows for c in combinations(sorted(t), size)}:
            with_part = [label for t, label in rows if set(part) <= set(t)]
            for label in set(with_part):
                both = with_part.count(label)
                if both / n >= s.support and both / len(with_part) >= s.confidence:
                    out[part, label] = both / len(with_part)
    return {k for k, c in out.items() if not any(set(p) < set(k[0]) and v == k[1] and out[p, v] >= c for p, v in out)}


def test_mining_against_brute_force(spark):
    rows = [(["a", "b"], "block")] * 12 + [(["a", "c"], "allow")] * 10 + [(["b", "c", "d"], "block")] * 6 + [(["d"], "allow")] * 5 + [
        (["c", "e"], "allow")] * 1 + [(["b"], "allow")]
    s = u.Settings(support=0.05, confidence=0.9)
    df = spark.createDataFrame([*rows, ([], "block"), (["a"], None)], "tokens array<string>, label string")
    got = {(tuple(r.tokens), r.verdict) for r in u.mine(df, s).collect()}
    assert got == mined(rows, s) and got
    assert all(r.key in r.tokens for r in u.mine(df, s).collect())
    assert u.mine(df.limit(0), s).count() == 0


def test_surest_rule_wins(spark):
    rules = spark.createDataFrame([("a", ["a"], "block", 0.9, 0.5), ("b", ["a", "b"], "allow", 1.0, 0.1), ("c", ["c"], "block", 1.0, 0.1),
                                   ("d", ["d"], "allow", 1.0, 0.1)], "key string, tokens array<string>, verdict string, confidence double, support double")
    urls = spark.createDataFrame([("1", ["a"]), ("2", ["a", "b"]), ("3", ["b"]), ("4", ["c", "d"])], "url string, tokens array<string>")
    assert dict(map(tuple, u.fitting(urls, rules).collect())) == {"1": "block", "2": "allow", "4": "block"}


def test_learnt_from_listed_pages(spark):
    urls = [f"http://spam.site{i % 7}.net/de/{i}" for i in range(60)] + [f"http://w{i % 5}.example.net/en/{i}" for i in range(60)]
    urls += ["http://other.com/de/1", "http://other.com/en/1"]
    got = {r.page_id: r.verdict for r in u.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert got[120] == "block" and got[121] == "allow"
    assert u.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_deep_segments_and_single_labels_are_learnt(spark):
    """Labels follow from the fifth segment or from the fourth label of the host; hosts and paths are long and much alike."""
    deep = "/".join("abcdefghijklmnopqrst")
    urls = [f"http://w{i % 3}.{deep.replace('/', '.')}.net/x{i}" for i in range(40)]  # blocked by net/
    urls += [f"http://m{i % 6}.bad.w{i % 5}.site{i % 11}.net/a/{i}" for i in range(40)]
    urls += [f"http://s{i % 4}.org/fr/{deep}/good/{i}" for i in range(40)]
    asked = ["http://q.bad.w9.other.com/z", "http://other.com/uu/vv/ww/good/zz", "http://other.com/z", "http://k.bad.org/q/good"]
    got = {r.page_id: r.verdict for r in u.judge(spark.createDataFrame(list(enumerate(urls + asked)), "page_id long, url string")).collect()}
    assert [got[i] for i in range(120)] == ["block"] * 80 + ["allow"] * 40
    assert got[120] == "block" and got[121] == got[122] == "allow"


def test_tokens_of_equal_rows_are_one(spark):
    rows = [["a", "b", "c"]] * 5 + [["a", "b", "d"]] * 5 + [["c", "e"]] + [["d", "d"]]
    df = spark.createDataFrame([(r,) for r in rows], "tokens array<string>")
    known = u.frequent_tokens(df, u.Settings(support=0.2))
    assert dict(map(tuple, known.collect())) == {"a": "a", "b": "a", "c": "c", "d": "d"}
    asked = spark.createDataFrame([(["b", "x"],), (["a", "b", "d"],), ([],)], "tokens array<string>")
    assert [r[0] for r in asked.coalesce(1).select(u.condensed(F.col("tokens"), known)).collect()] == [["a"], ["a", "d"], []]
    assert u.frequent_tokens(df.limit(0)).count() == 0
