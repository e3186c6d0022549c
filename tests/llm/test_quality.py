import random
from collections import Counter

from quotemill.llm import quality as q


def brute(text):
    t = text or ""
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", t) if w]
    grams = Counter(zip(words, words[1:], words[2:]))
    cover = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            cover.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in t.split("\n"):
        if [w for w in __import__("re").split("[\x20\x09-\x0d]+", line) if w]:
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def test_counts():
    rnd = random.Random(2)
    some = ["", None, "a b c a b c", "ä b\x85c d", "x\n\n x\nx\n \nx", "漢字 😀 <|#"]
    some += ["".join(rnd.choices("abé \n\t#|x", k=rnd.randint(0, 200))) for _ in range(200)]
    for t in some:
        assert q.measure((t or "").encode())[:5] == brute(t), t


def rows(n=300):
    rnd = random.Random(4)
    prose = lambda k: " ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(k))
    good = [(i, prose(rnd.randint(60, 200)), "en", "s%d" % (i % 3)) for i in range(n)]
    bad = [(1000 + i, " ".join(w + "$$$" for w in prose(80).split()), "en", "s0") for i in range(20)]
    odd = [(2000, None, "en", "s0"), (2001, "", None, None), (2002, "short", "en", "s1"), (None, prose(70), None, "s9"), (2003, "x y z " * 60, "en", "s2")]
    return good + bad + odd


def test_judge(spark):
    frame = spark.createDataFrame([(*r, "z") for r in rows()], "doc_id long, text string, lang string, source string, kept string").repartition(5)
    got = {r.doc_id: r for r in q.judge(frame.drop("kept")).collect()}
    assert len(got) == len(rows())
    assert all(got[i].kept for i in range(300))
    assert not any(got[1000 + i].kept for i in range(20)) and "symbol_rate" in got[1000]["failed"]
    assert got[2000].base_failed and got[2001].base_failed and got[2002].base_failed and got[2003].base_failed and got[None].kept
    again = {r.doc_id: r.kept for r in q.judge(frame.drop("kept").repartition(2)).collect()}
    assert again == {k: r.kept for k, r in got.items()}
    assert q.keep_good(frame).columns == frame.columns and q.keep_good(frame).count() == 301
    assert q.judge(frame.limit(0)).count() == 0


def test_sketch_quantiles_and_merge(spark):
    values = [0, 1, 5, 31, 32, 63, 64, 65, 100, 1000, 10**6]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    from pyspark.sql import functions as F

    got = frame.select("v", q.bucket(F.col("v")).alias("b"), q.bucket_low(q.bucket(F.col("v"))).alias("low")).orderBy("v").collect()
    assert [r.b for r in got] == sorted(r.b for r in got)
    assert all(r.low <= r.v < r.low + max(1, r.v / 16) for r in got)


def test_columns_of_the_caller_stay(spark):
    from pyspark.sql import functions as F

    own = {"kept": "mine", "m": "orig", "failed": "f", "base_failed": "b", "_judged": "j", "_lang": "l", "_source": "s", "max_word_len": "w", "_over": "o", "_limits": "x", "_group": "g"}
    frame = spark.createDataFrame(rows(60), "doc_id long, text string, lang string, source string").withColumns({k: F.lit(v) for k, v in own.items()})
    plain = {r.doc_id: r.kept for r in q.judge(frame.drop(*own)).collect()}
    judged = q.judge(frame)
    assert judged.columns[: len(frame.columns)] == frame.columns
    for r in judged.collect():
        assert all(r[k] == v for k, v in own.items()) and r.kept_ == plain[r.doc_id]
    kept = q.keep_good(frame).collect()
    assert {r.doc_id for r in kept} == {k for k, v in plain.items() if v}
    assert all(r[k] == v for r in kept for k, v in own.items())


def test_groups_of_other_norms_have_other_thresholds(spark):
    """Long words are normal in one language and junk in the other; no cutoff holds for both."""
    rnd = random.Random(9)
    text = lambda low, high: " ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(low, high))) for _ in range(80))
    short = [(i, text(2, 8), "aa", "s") for i in range(120)]
    long = [(1000 + i, text(16, 24), "bb", "s") for i in range(120)]
    odd = [(2000, text(16, 24), "aa", "s"), (2001, text(30, 60), "bb", "s"), (2002, text(11, 13), "aa", "s")]
    frame = spark.createDataFrame(short + long + odd, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.kept, r.failed) for r in q.judge(frame).collect()}
    assert all(got[r[0]][0] for r in short + long)
    assert [got[i] for i in (2000, 2001, 2002)] == [(False, ["word_len"])] * 3
    limits = {r["_lang"]: r.max_word_len for r in q.adaptive_limits(q.document_counts(frame), "lang", "source").collect()}
    assert limits["bb"] > 2 * limits["aa"]
