import random
from collections import Counter

import numpy as np
import pytest

from quotemill.llm import bwt_dedup as b


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def texts(seed, n=40):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdeé ", k=rnd.randint(1, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(60) for _ in range(4)]
    out = [prose(rnd.randint(0, 30)) + rnd.choice(["", *shared])[rnd.randint(0, 40) :] + prose(rnd.randint(0, 30)) for _ in range(n)]
    near = [list(out[0]) for _ in range(6)]
    for x in near:
        x[rnd.randrange(len(x)) if x else 0 :][:1] = "#"
    return out + [out[1]] * 4 + ["".join(x) for x in near] + ["a" * 900, "ab" * 400, "a" * 199, "a" * 200, "b" * 201, "", None]


@pytest.mark.parametrize(("length", "gram"), [(200, 32), (40, 8)])
def test_same_as_brute_force(spark, length, gram):
    for seed in range(2):
        rows = texts(seed)
        frame = spark.createDataFrame([(None if i == 3 else i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, kept string").repartition(4)
        got = b.remove_repeats(frame, length=length, gram=gram).collect()
        want = brute(rows, length)
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(
            (-1 if i == 3 else i, *w) for i, w in enumerate(want)
        )
    assert b.remove_repeats(frame.limit(0)).count() == 0


def test_columns_find_repeats_in_one_batch():
    text = b"ab" * 30
    key = int(b.gram_hashes(b"ab" * 4, 8).view(np.int64)[0])
    masks = b.repeated_windows([text], [key], length=20, gram=8)
    assert masks[0].all()


def test_small_batches(spark, monkeypatch):
    monkeypatch.setattr(b, "BATCH_BYTES", 300)
    monkeypatch.setattr(b, "SPOOL_BYTES", 100)
    rows = texts(5)
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in b.remove_repeats(frame).collect()}
    assert [got[i] for i in range(len(rows))] == brute(rows, 200)
