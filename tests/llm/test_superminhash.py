import random

import numpy as np
import pytest

from quotemill.llm import components as c
from quotemill.llm import superminhash as s


def prose(rnd, k):
    return " ".join(rnd.choice("alpha beta gamma delta eps zeta eta theta iota kappa la mu nu xi".split()) + str(rnd.randrange(30)) for _ in range(k))


def corpus(seed):
    rnd = random.Random(seed)
    rows = [(i, prose(rnd, rnd.randint(1, 120))) for i in range(60)]
    base = prose(rnd, 150).split()
    for i in range(60):  # near copies of which many are linked only through others
        words = list(base)
        for _ in range(rnd.randint(0, 14)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        rows.append((100 + i, " ".join(words)))
    rows += [(200 + i, rows[1][1].upper()) for i in range(30)]
    return rows + [(300, None), (301, ""), (302, " \n"), (303, "one"), (304, "One"), (305, "one two"), (306, "É a"), (307, "é a")]


def brute(rows, width):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(max(len(w) - width + 1, 1))} if w else set()
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("width", [2, 5])
def test_same_as_brute_force(spark, width):
    rows = corpus(width)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, id string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in s.near_duplicates(frame, width=width).collect()}
    assert got == brute(rows, width)


def test_large_buckets_are_closed(spark, monkeypatch):
    monkeypatch.setattr(c, "SMALL_BUCKET", 2)
    monkeypatch.setattr(s, "BLOCK_HASHES", 500)
    rows = corpus(9)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in s.near_duplicates(frame, width=2).collect()}
    assert got == brute(rows, 2)


def test_odd_rows(spark):
    text = "a b c d e f g"
    frame = spark.createDataFrame([(None, text), (5, text), (5, text), (3, text), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id, r.kept) for r in s.near_duplicates(frame).collect())
    assert got == [(False, 3, 3, True), (False, 5, 3, False), (False, 5, 3, False), (True, 0, None, True), (True, 0, None, True)]
    assert s.keep_one(frame).count() == 3 and s.keep_one(frame).columns == frame.columns
    assert s.near_duplicates(frame.limit(0)).count() == 0


def test_signature_estimates_similarity():
    r = np.random.default_rng(1)
    for n in (5, 60, 900):
        both = r.integers(0, 2**63, int(n * 4 / 5) or 1).astype(np.uint64)
        a, b = (np.unique(np.append(both, r.integers(0, 2**63, n // 10).astype(np.uint64))) for _ in range(2))
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = s.signatures([a, b])
        assert abs((x == y).mean() - want) < 0.15
        assert (x != s._EMPTY).all()
    alone = s.signatures([a])[0]
    assert (alone == x).all()


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 700), (700, 600), (900, 900)]
    got = {r.id: r.component for r in c.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 600: 500, 700: 500}
