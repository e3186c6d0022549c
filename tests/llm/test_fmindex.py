import random

import numpy as np
import pytest

from quotemill.llm import fmindex as fm


def brute(docs, items, width=10):
    out = []
    for d in docs:
        w = fm.words((d or "").encode())
        hit, found = set(), set()
        for i, t in items:
            for p in set(fm.windows((t or "").encode(), width)):
                for at in range(len(w) - len(p) + 1):
                    if tuple(w[at : at + len(p)]) == p:
                        hit.update(range(at, at + len(p)))
                        found.add(str(i) if i is not None else "")
        out.append((len(w), len(hit), sorted(found)))
    return out


def texts(n, seed):
    rnd = random.Random(seed)
    out = [" ".join(rnd.choices(["a", "B", "ça", "d9", "the", "x-y"], k=rnd.randint(0, 60))) for _ in range(n)]
    return out + [out[0]] * 5 + ["a " * 300, "", None, "a", "-- .,"]


def test_suffix_order():
    rnd = np.random.default_rng(1)
    for n, k in ((1, 1), (50, 2), (400, 3), (300, 1)):
        s = rnd.integers(0, k, n)
        want = sorted(range(n), key=lambda i: s[i:].tolist())
        assert fm.suffix_order(s).tolist() == want


def test_locate_all_positions():
    docs = [fm.words((t or "").encode()) for t in texts(30, 2)]
    index = fm.FMIndex.open(fm.FMIndex.build(docs))
    assert sorted(index.locate(np.arange(index.matrix.size)).tolist()) == list(range(index.matrix.size))
    found, place = index.search([(b"a",), (b"the", b"a"), (b"nowhere",)])
    flat = [w for d in docs for w in (*d, None)]
    for k, p in enumerate([(b"a",), (b"the", b"a"), (b"nowhere",)]):
        want = [i for i in range(len(flat)) if tuple(flat[i : i + len(p)]) == p]
        assert sorted(place[found == k].tolist()) == want


def test_cut_words():
    assert fm.cut_words("Ab, çd! ef.".encode(), [{"first": 0, "last": 2}]) == b"! ef."
    assert fm.cut_words(b"ab cd ef", [{"first": 0, "last": 1}, {"first": 2, "last": 3}]) == b" cd "


@pytest.mark.parametrize("block", [1 << 16, 3])
def test_contamination(spark, block):
    docs = texts(40, 3)
    items = [(1, docs[3]), (1, docs[4]), (2, "a b"), (None, docs[5]), (3, None), (4, "The a ÇA"), (5, " ".join(docs[8:11]))]
    frame = spark.createDataFrame([(i, t, "z") for i, t in enumerate(docs)], "doc_id long, text string, spans string").repartition(3)
    got = fm.contamination(frame, spark.createDataFrame(items, "item_id long, text string"), ["doc_id"], block_windows=block).collect()
    rows = {r.doc_id: (r.n_words, sum(s["last"] - s["first"] for s in r.spans), r["items"]) for r in got}
    assert [rows[i] for i in range(len(docs))] == brute(docs, items)
    assert fm.contamination(frame.limit(0), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"]).count() == 0
    none = fm.contamination(frame, spark.createDataFrame([], "item_id long, text string"), ["doc_id"]).collect()
    assert len(none) == len(docs) and not any(r.spans for r in none)
    clean = fm.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == frame.columns and clean.count() == len(docs)
    left = {r.doc_id: r.text for r in clean.collect()}
    want = {i: n - h for i, (n, h, _) in enumerate(brute(docs, items))}
    assert all(len(fm.words((left[i] or "").encode())) == want[i] for i in want)
