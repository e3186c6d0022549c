"""Runs against a brute-force search over all lags."""

import random
import zlib

import numpy as np

from quotemill.llm import periodic


def brute(words):
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                best.setdefault((i, j + q), q)  # lags rise, so the smallest period comes first
            i = j
    runs = sorted((s, e - s, q) for (s, e), q in best.items())
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rnd = random.Random(12)
    out = ["", " \t\n", "a", "a " * 11, "a " * 12, "a b " * 6, "a b " * 5 + "a", "x " * 700, "a\x85b\xa0c " * 9, "漢 字 😀 " * 5]
    for _ in range(400):
        words = rnd.choices("ab" if rnd.random() < 0.5 else "abcde", k=rnd.randint(0, 90))
        for _ in range(rnd.randint(0, 3)):
            at, q = rnd.randint(0, len(words)), rnd.randint(1, 40)
            part = (words[at : at + q] or ["z"]) * rnd.randint(2, 5)
            words[at:at] = part[: rnd.randint(1, len(part))]
        out.append(rnd.choice([" ", "\n", " \t"]).join(words))
    for q in range(1, 60):  # exactly as long as needed, and one word less
        base = [f"w{i}" for i in range(q)]
        for size in (max(12, 2 * q), max(12, 2 * q) - 1):
            out.append(" ".join(rnd.choices("xyz", k=rnd.randint(0, 7)) + (base * 13)[:size] + ["end"]))
    fib = ["a", "a b"]
    while len(fib) < 13:
        fib.append(fib[-1] + " " + fib[-2])
    return out + [fib[-1], " ".join("a" * 40 + "b" + "a" * 37 + "c" + "a" * 40)]


def test_runs_equal_brute_force(spark):
    some = texts()
    frame = spark.createDataFrame([(i, t, "mine", 7) for i, t in enumerate(some)], "doc_id long, text string, runs string, RUNS_ int").repartition(3)
    got = {r.doc_id: r for r in periodic.find_runs(frame).collect()}
    assert len(got) == len(some)
    for i, t in enumerate(some):
        runs, kept = brute([w.decode() for w in t.encode().split()])
        assert [tuple(x) for x in got[i].runs__] == runs, t
        assert got[i].collapsed == kept and got[i]["runs"] == "mine" and got[i]["RUNS_"] == 7


def test_slices_do_not_matter(monkeypatch):
    some = [t.encode() for t in texts()]
    plain = [(s.tolist(), e.tolist(), q.tolist(), c) for s, e, q, c in periodic._found(some)]
    monkeypatch.setattr(periodic, "SLICE_WORDS", 100)
    monkeypatch.setattr(periodic, "PAIRS_AT_ONCE", 3)
    assert plain == [(s.tolist(), e.tolist(), q.tolist(), c) for s, e, q, c in periodic._found(some)]


def test_long_documents_of_few_words():
    """Two hundred thousand equal words, with and without breaks, and a long text said twice."""
    for step in (0, 977):
        words = np.zeros(200_000, np.int64)
        if step:
            words[::step] = np.arange(len(words[::step])) + 1
        start, end, period = periodic.find(words.astype(np.int32), np.zeros(len(words), np.int64))
        assert set(period) == {1}
        assert len(start) == (len(words[::step]) if step else 1)
    half = np.arange(50_000) % 49_999
    start, end, period = periodic.find(np.concatenate([half, half]).astype(np.int32), np.zeros(100_000, np.int64))
    assert [(0, 100_000, 50_000)] == list(zip(start.tolist(), end.tolist(), period.tolist(), strict=True))


def test_nulls_repeats_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, None), (None, "a " * 20), (1, None), (None, "a " * 20)], "doc_id long, text string")
    rows = periodic.find_runs(frame).collect()
    assert sorted(len(r.runs) for r in rows) == [0, 0, 1, 1] and {r.collapsed for r in rows} == {"", "a"}
    assert periodic.find_runs(frame.limit(0)).count() == 0


def test_planted_loops(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(0, 60)))) for i in range(200)] + [(None, "x y"), (3, None)]
    got = periodic.repeat_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = []
    for i, t in rows:
        h = zlib.crc32(str(i).encode())
        words = (t or "").split()
        if i is not None and words and h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            t = " ".join(words[a + (k - a) % p] if k >= a else words[k] for k in range(n))
        want.append((i, t))
    assert len(got) == len(want) and {tuple(r) for r in got} == set(want)
