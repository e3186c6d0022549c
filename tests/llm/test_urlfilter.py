"""URL rules against a plain loop over all rules."""

import os
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from quotemill.llm import urlfilter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut].translate(LOWER), rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [(len((h + p).encode()), len(h.encode()), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


def rules():
    rnd = random.Random(7)
    out = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("a.b", ""): "allow", ("b", "/cd"): "block", ("a.b", "/c"): "block", ("é.x", "/ü"): "block"}
    for _ in range(400):
        host = ".".join("".join(rnd.choices("abx", k=rnd.randint(1, 2))) for _ in range(rnd.randint(1, 3)))
        out[host, "/" * rnd.randint(0, 1) + "".join(rnd.choices("ab/", k=rnd.randint(0, 4)))] = rnd.choice(["allow", "block"])
    return [(h, p, v) for (h, p), v in out.items()]


def urls():
    rnd = random.Random(9)
    odd = [None, "", "net", "://", "http://", "x://NET/", "http://net", "http://net?/", "http://.net/", "http://a.net./", "http://É.x/üb", "a://b://c/d"]
    odd += ["http://sub.EXAMPLE.net/en/?q#f", "http://example.net/EN/", "http://notnet/", "h://a.b#x/y", "h://a.b/c\n/d?e", "h://" + "a." * 3000 + "net/" + "b" * 9000]
    for _ in range(1500):
        host = ".".join("".join(rnd.choices("abxAB", k=rnd.randint(0, 2))) for _ in range(rnd.randint(1, 5)))
        odd.append("http://" + host + rnd.choice(["", "/", "?", "#"]) + "".join(rnd.choices("ab/?#", k=rnd.randint(0, 9))))
    return odd


@pytest.mark.parametrize(("bits", "rows"), [(64, 1 << 20), (3, 1 << 20), (64, 50)])
def test_equal_to_a_loop_over_all_rules(spark, monkeypatch, bits, rows):
    """Also with digests of three bits, where nearly all collide, and with many files."""
    monkeypatch.setattr(urlfilter, "FILE_ROWS", rows)
    some = urls()
    index = urlfilter.build_index(spark.createDataFrame(rules(), "host string, path string, verdict string"), bits=bits)
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(some)], "page_id long, url string, judged string").repartition(3)
    got = {r.page_id: r for r in urlfilter.judge_urls(pages, index, bits=bits).collect()}
    assert len(got) == len(some)
    for i, u in enumerate(some):
        assert tuple(got[i].judged_) == brute(u, rules()), u
        assert (got[i].url, got[i].judged) == (u, "own")
    files = [x for x in os.listdir(urlfilter._local(index[0])) if x.endswith(".digests")]
    assert len(files) > 5 if rows == 50 else len(files) == 1


def test_digests_of_the_index_are_xxhash(spark):
    rows = urlfilter.entries(spark.createDataFrame(rules(), "host string, path string, verdict string")).collect()
    assert all(r["range"] - urlfilter.SIGN == xxhash.xxh64_intdigest(bytes(r.key), urlfilter.SEED) for r in rows)


def test_odd_rules_and_empty_tables(spark):
    odd = [(None, "/", "block"), ("a", None, "block"), ("b", "/", None), ("", "/", "block"), ("C", "/", "allow"), ("c", "/", "block"), ("c", "/", "block")]
    index = urlfilter.build_index(spark.createDataFrame(odd, "host string, path string, verdict string"))
    pages = spark.createDataFrame([("x://a/",), ("x://b/",), ("x://c/",), ("x://c/",)], "url string")
    assert sorted(r.judged.verdict for r in urlfilter.judge_urls(pages, index).collect()) == ["allow", "allow", "block", "block"]
    none = urlfilter.build_index(spark.createDataFrame([], "host string, path string, verdict string"))
    assert {r.judged.verdict for r in urlfilter.judge_urls(pages, none, default="block").collect()} == {"block"}
    assert urlfilter.judge_urls(pages.limit(0), index).count() == 0
    with pytest.raises(ValueError, match="seen as files"):
        urlfilter.build_index(spark.createDataFrame(odd, "host string, path string, verdict string"), "hdfs://x/y")


def test_url_column_is_cut_like_the_text_says(spark):
    host, path = urlfilter.split_url(F.col("u"))
    frame = spark.createDataFrame([(u,) for u in urls()], "u string").select("u", host.alias("h"), path.alias("p"))
    assert all((r.h, r.p) == brute(r.u, [])[:2] for r in frame.collect())
