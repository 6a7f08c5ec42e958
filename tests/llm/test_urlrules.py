import re

from gridtables.llm import urlrules
from gridtables.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "://", "http://", "http://Example.COM", "http://example.com/", "http://example.com/en/1", "http://www.example.com/en/1",
    "http://a.www.example.com/en/", "http://notexample.com/en/1", "https://x.net/es/2?x=/fr/", "https://x.net/es", "http://net/fr/", "http://x.net?/es/",
    "http://x.net#/es/", "ftp://ÄB.com/é", "http://example.com:80/en/1", "http://a://b.com/", "http://x.org/a?b=1&c=2&&b=3", "http://example.com/EN/1",
    "http://example.com\n/en/", "http://x.com/" + "a/" * 3000,
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def given(host, path):
    best = (None, None)
    for rule, verdict in sorted(URL_RULES, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            best = (rule, verdict)
    return best


def test_stated_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[6], "y"), (0, None, "z")], "page_id long, url string, host string")
    got = urlrules.judge(df, URL_RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = URLS[6] if r.page_id is None else URLS[r.page_id]
        host, path = split(url)
        rule, verdict = given(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def brute_rules(labelled, min_support, min_confidence, max_tokens):
    from itertools import combinations

    sets = [(frozenset(t), v) for t, v in labelled]
    every = {x for t, _ in sets for x in t if sum(x in s for s, _ in sets) < len(sets)}
    found = {}
    for size in range(1, max_tokens + 1):
        for own in combinations(sorted(every), size):
            held = [v for t, v in sets if set(own) <= t]
            for verdict in set(held):
                n = held.count(verdict)
                if n / len(sets) >= min_support and n / len(held) >= min_confidence:
                    found[own, verdict] = n / len(held)
    return {
        k: c for k, c in found.items()
        if not any((tuple(x for x in k[0] if x != t), k[1]) in found and found[tuple(x for x in k[0] if x != t), k[1]] >= c for t in k[0] if len(k[0]) > 1)}


def test_mined_rules_and_their_use(spark):
    labelled = [(["a", "s"], "block")] * 6 + [(["a", "b", "s"], "allow")] * 3 + [(["c", "s"], "allow")] * 8 + [(["c", "d", "s"], "block")] * 4
    df = spark.createDataFrame(labelled, "tokens array<string>, verdict string")
    rules = urlrules.mine(df, 0.1, 0.7, 3)
    got = {(tuple(r.tokens), r.verdict): r.confidence for r in rules.collect()}
    want = brute_rules(labelled, 0.1, 0.7, 3)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    asked = spark.createDataFrame([(1, ["a", "b", "z"]), (2, ["c", "d"]), (3, ["z"]), (4, [])], "shape long, tokens array<string>")
    best = {r.shape: (r.mined, round(r.confidence, 6)) for r in urlrules.match(asked, "shape", rules).collect()}
    assert best.keys() <= {1, 2}
    for shape, tokens in ((1, {"a", "b"}), (2, {"c", "d"})):
        fitting = [c for (own, _), c in want.items() if set(own) <= tokens]
        assert best[shape][1] == round(max(fitting), 6)


def test_deep_tokens_are_mined_and_matched(spark):
    """What stands in a far segment, a late query name or an inner label judges urls that no stated rule does."""
    blocked = [f"http://h{i}.net/es/" + "/".join("pqrstuvw") + f"/spam/{'z' * (i % 2)}" for i in range(20)]
    blocked += [f"http://h{i}.net/es/?" + "&".join(f"n{k}={i}" for k in range(25)) + "&spam=1" for i in range(20)]
    blocked += [f"http://h{i}.spam.b{i}.c{i}.d{i}.e{i}.net/es/x{'y' * i}" for i in range(20)]
    allowed = [f"http://h{i}.com/es/" + "/".join("pqrstuvw") + "/ham" for i in range(20)]
    allowed += [f"http://h{i}.com/es/?" + "&".join(f"n{k}={i}" for k in range(25)) + "&ham=1" for i in range(40)]
    asked = ["http://x.org/es/" + "/".join("pqrstuvw") + "/spam", "http://x.org/es/?" + "&".join(f"n{k}=1" for k in range(25)) + "&spam=1",
             "http://q.spam.k.l.m.org/es/k", "http://x.org/es/" + "/".join("pqrstuvw") + "/ham"]
    df = spark.createDataFrame(list(enumerate(asked + blocked + allowed)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urlrules.judge(df, URL_RULES, min_support=0.1).collect()}
    assert [got[i] for i in range(4)] == ["block", "block", "block", "allow"]


def test_tokens_of_the_same_urls_have_the_same_rules(spark):
    labelled = [(["a", "b", "c"], "block")] * 6 + [(["c", "d", "e"], "allow")] * 3 + [(["a", "b", "d", "e"], "allow")] * 3 + [(["f", "d", "e"], "block")] * 3 + [([], "allow")]
    rules = urlrules.mine(spark.createDataFrame(labelled, "tokens array<string>, verdict string"), 0.1, 0.7, 3).collect()
    got = {(tuple(r.tokens), r.verdict): r.confidence for r in rules}
    want = brute_rules(labelled, 0.1, 0.7, 3)
    assert len(rules) == len(got) and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_no_labels_and_empty(spark):
    df = spark.createDataFrame([(1, "http://x.org/a")], "page_id long, url string")
    row = urlrules.judge(df, URL_RULES).first()
    assert (row.rule, row.verdict, row.mined_rule) == (None, "allow", None)
    assert urlrules.judge(df.limit(0), URL_RULES).count() == 0


def test_many_names_that_mostly_stand_together(spark):
    """Names of one verdict only are rules of their own and are not combined; without that, 25 of them give millions of combinations."""
    pick = __import__("random").Random(3)
    names = [f"n{k}" for k in range(25)]
    urls = [f"http://h{i}.com/a?" + "&".join(f"{n}={i}" for n in names if pick.random() < 0.8) for i in range(120)]
    urls += [f"http://h{i}.net/es/spam{'x' * (i % 3)}/k?z=1" for i in range(80)]
    df = spark.createDataFrame(list(enumerate(["http://h.org/?n3=1&n4=2", "http://h.org/?z=1"] + urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urlrules.judge(df, URL_RULES, min_support=0.05).collect()}
    assert (got[0], got[1]) == ("allow", "block")
