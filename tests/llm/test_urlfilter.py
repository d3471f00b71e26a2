"""URL filter: lexical features and suffix statistics against Python, trees against held-out rules."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from curate.llm import urlfilter


def features(url):
    url = url or ""
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    q = re.search(r"\?([^#]*)", url)
    n = len(url)
    return {"url_length": n, "host_length": len(host), "path_length": len(path), "depth": path.count("/"),
            "labels": len(re.findall(r"[^.]+", host)), "hyphens": host.count("-"),
            "digit_ratio": sum(c in "0123456789" for c in url) / n if n else 0,
            "entropy": -sum(c / n * math.log2(c / n) for c in Counter(url).values()) if n else 0,
            "parameters": len(re.findall(r"[^&]+", q[1])) if q else 0, "fragment": float("#" in url)}


def test_lexical_features(spark):
    urls = ["http://A-b.Example.net/en/x.html?q=1&r=22#top", "no scheme", "", None, "x://h", "https://é.org/ü/ß?a&&b", "ftp://a.b.c.d/e//f.tar.gz", "h://x/" + "9a" * 20_000]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id int, url string")
    df = df.withColumns({"host": F.coalesce(urlfilter.url_host(F.col("url")), F.lit("")), "path": F.coalesce(urlfilter.url_path(F.col("url")), F.lit(""))})
    for r in urlfilter.lexical(df).collect():
        for name, want in features(r.url).items():
            assert math.isclose(r[name], want, abs_tol=1e-9), (r.url and r.url[:50], name)


def test_every_suffix_has_its_share(spark, monkeypatch):
    rng = random.Random(2)
    own = [rng.choice(["com"] * 30 + [f"s{k}" for k in range(40)] + ["x" * 400]) for _ in range(600)] + [None]
    df = spark.createDataFrame([(k, f"u{k}", s) for k, s in enumerate(own)], "page_id int, url string, suffix string")
    counts = Counter(own)
    first = None
    for bound in (1_000, 3, 0):
        monkeypatch.setattr(urlfilter, "SUFFIXES", bound)
        got = sorted((r.page_id, r.out) for r in urlfilter.suffix_share(df, "suffix", "out").collect())
        assert len(got) == len(own)
        for k, share in got:
            assert share == 0 if own[k] is None else math.isclose(share, math.log1p(counts[own[k]] * 1e6 / len(own)))
        assert first in (None, got)
        first = got


def test_trees_learn_what_rules_say(spark):
    """A tenth of the ruled hosts lose their rule; the trees must judge them as the rule would."""
    rng = random.Random(3)
    rows = []
    for k in range(1_500):
        bad = k % 2
        host = f"{'x-9-' * 3 if bad else ''}site{rng.randrange(999)}.{'known' if k % 10 > 1 else 'other'}{'bad' if bad else 'good'}"
        rows.append((k, f"http://{host}/{'p' * rng.randrange(9)}"))
    pages = spark.createDataFrame(rows, "page_id int, url string")
    got = urlfilter.judge(pages, (("knownbad", "/", "block"), ("knowngood", "/", "allow"))).filter("rule is null").collect()
    assert len(got) == 300
    assert sum((r.verdict == "block") == (r.page_id % 2 == 1) for r in got) > 290


def test_repeated_and_null_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://b.org/fr/"), (2, None)], "page_id int, url string")
    got = urlfilter.judge(pages).collect()
    assert sorted((r.page_id or 0, r.host, r.rule or "") for r in got) == [(0, "b.org", "org/fr/"), (1, "a.net", "net/"), (1, "a.net", "net/"), (2, "", "")]
