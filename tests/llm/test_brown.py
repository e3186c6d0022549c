import math
import os
import zlib
from collections import Counter

import numpy as np

from quotemill.llm import brown

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def docs(spark, extra=()):
    nouns, verbs = ["cat", "dog", "bird", "fish"], ["runs", "eats", "sees", "hears"]
    rows = [(i, f"the {nouns[i % 4]} {verbs[(i // 4) % 4]} the {nouns[(i // 16) % 4]}") for i in range(400)]
    return spark.createDataFrame([(*r, "x") for r in rows + list(extra)], "doc_id long, text string, score string")


def base(rows):
    tok = {i: [*[w for w in (t or "").encode().lower().split()], b"\n"] for i, t in rows}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows}
    c = Counter(w for i in tok if not held[i] for w in tok[i])
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(t), sum(w in c for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)) for i, t in tok.items()}


def test_base_and_classes(spark):
    extra = [(1000, None), (1001, ""), (1002, "Unseen words ÉÉ here"), (None, "the cat")]
    frame = docs(spark, extra)
    got = brown.score_documents(frame, classes=4, table_words=6, clustered=5, rounds=4).collect()
    want = base([(r.doc_id, r.text) for r in frame.collect()])
    assert len(got) == len(want)
    for r in got:
        held, n, known, total, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - score) < 1e-9 and r.score < 0


def test_probabilities_sum_to_one(spark):
    train = docs(spark)
    model, counts = brown.train_model(train, classes=4, table_words=8, clustered=8, rounds=4)
    rows = {bytes(r.word): r.n for r in counts.collect()}
    listed = [*rows, b"never seen"]
    for before in (b"the", b"cat", b"never seen"):
        c = model.word_class[model.index.get(before, len(model.index))]
        total = 0.0
        for w in listed:
            i = model.index.get(w, len(model.index))
            rare = (rows.get(w, 0) + brown.ALPHA) / (model.rest_total + brown.ALPHA * model.rest_types)
            total += 10 ** model.move[c, model.word_class[i]] * (10 ** model.emit[i] if w in model.index else rare)
        # Classes without words keep a share of their own.
        empty = [k for k in range(model.k) if k not in set(model.word_class.tolist())]
        assert abs(total + sum(10 ** model.move[c, k] for k in empty) - 1) < 1e-9


def test_exchange_finds_word_classes_and_beats_the_base(spark):
    model, _ = brown.train_model(docs(spark), classes=4, rounds=40)
    of = lambda w: int(model.word_class[model.index[w]])
    assert len({of(w) for w in (b"runs", b"eats", b"sees", b"hears")}) == 1
    scored = brown.score_documents(docs(spark), classes=4).filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert scored.s > scored.b
    assert brown.perplexity(brown.score_documents(docs(spark), classes=4), "held_out").count() == 2


def test_the_best_class_is_the_one_of_highest_likelihood():
    """Against the likelihood of every move; a word that no class both follows and precedes, so the parts don't mix."""
    r = np.random.default_rng(3)
    moved = 0
    for _ in range(300):
        k, classes = 6, 5
        own = int(r.integers(classes))
        leave, arrive = np.zeros(k), np.zeros(k)
        others = [i for i in range(k) if i != own]
        r.shuffle(others)
        leave[others[:2]], arrive[others[2:4]] = r.integers(1, 30, 2), r.integers(1, 30, 2)
        n = r.integers(0, 40, (k, k)).astype(float)
        n[own] += leave
        n[:, own] += arrive

        def after(c, n=n, own=own, leave=leave, arrive=arrive):
            m = n.copy()
            m[own] -= leave
            m[:, own] -= arrive
            m[c] += leave
            m[:, c] += arrive
            x = m[m > 0]
            out, back = m.sum(axis=1), m.sum(axis=0)
            return (x * np.log(x)).sum() - sum((v[v > 0] * np.log(v[v > 0])).sum() for v in (out, back))

        # moves into a class next to the word count pairs of that class with itself, which the rule leaves out
        free = [c for c in range(classes) if not leave[c] and not arrive[c]]
        got = brown.best_class(n, own, leave, arrive, classes)
        if got in free:
            assert after(got) >= max(after(c) for c in free) - 1e-9
            moved += got != own
    assert moved > 10


def recomputed(rows, model):
    """Scores from the texts and the classes of words alone."""
    lists = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in rows}
    train = [w for i, w in lists.items() if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    of = lambda w: int(model.word_class[model.index[w]]) if w in model.index else model.rest
    count, moves = Counter(), Counter()
    for words in train:
        count.update(words)
        moves.update(zip(map(of, [b"\n", *words]), map(of, words)))
    a, k = brown.ALPHA, model.k
    listed = [w for w in count if w in model.index]
    size, types = Counter(), Counter(map(of, listed))
    for w in listed:
        size[of(w)] += count[w]
    rare, kinds = sum(count.values()) - sum(size.values()), len(count) - len(listed) + 1
    total = sum(moves.values())
    into = [sum(moves[i, j] for i in range(k)) for j in range(k)]

    def step(i, j):
        seen = max(1, sum(moves[i, x] > 0 for x in range(k)))
        return (moves[i, j] + seen * (into[j] + a) / (total + a * k)) / (sum(moves[i, x] for x in range(k)) + seen)

    def emit(w):
        if w in model.index:
            return (count[w] + a) / (size[of(w)] + a * types[of(w)])
        return (count[w] + a) / (rare + a * kinds)

    return {i: sum(math.log10(step(of(v), of(w)) * emit(w)) for v, w in zip([b"\n", *words], words)) for i, words in lists.items()}


def test_scores_are_those_of_the_texts_and_classes(spark):
    frame = docs(spark, [(1000, None), (1001, ""), (1002, "Unseen words ÉÉ here the cat"), (1003, "bird dog runs runs")])
    marked = frame.withColumn("held_out", brown.held_out(frame.doc_id))
    for options in ({"classes": 4, "table_words": 6, "clustered": 5, "rounds": 4}, {"classes": 3, "rounds": 6}):
        model, counts = brown.train_model(marked.filter("not held_out"), **options)
        want = recomputed([(r.doc_id, r.text) for r in frame.collect()], model)
        got = {r.doc_id: r.score for r in brown.score(marked, model, counts).collect()}
        assert len(got) == 404 and all(abs(got[i] - want[i]) < 1e-9 * max(1, abs(want[i])) for i in want)


def test_empty_tables(spark):
    none = docs(spark).limit(0)
    assert brown.score_documents(none).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert brown.score_documents(one).count() == 1


def test_many_words_at_once_move_like_single_ones():
    """``best_classes`` gives what ``best_class`` gives one by one, also for words that follow themselves."""
    r = np.random.default_rng(5)
    k, classes, words = 7, 6, 80
    own = r.integers(0, k, words)
    profiles = r.poisson(0.6, (2, words, k))
    profiles[:, :5] *= 7
    n = r.integers(0, 40, (k, k)).astype(float)
    np.add.at(n, own, profiles[0])
    np.add.at(n.T, own, profiles[1])
    cells = [(*np.nonzero(p), p[np.nonzero(p)]) for p in profiles]
    got = brown.best_classes(n, own, *cells, classes)
    compared = 0
    for w in range(words):
        # with the own class among them, one by one a word of the last class may also stay
        want = brown.best_class(n, int(own[w]), *profiles[:, w].astype(float), classes if own[w] < classes else k)
        if want < classes:
            assert got[w] == want
            compared += want != own[w]
    assert compared > 20 and len(set(got.tolist())) > 2


def test_every_training_word_gets_a_learned_class(spark):
    """Words outside the broadcast table too, with scores that follow from the texts and the classes."""
    frame = docs(spark, [(1000, None), (1001, ""), (1002, "Unseen words ÉÉ here the cat"), (1003, "bird dog runs runs zebra zebra sees")])
    marked = frame.withColumn("held_out", brown.held_out(frame.doc_id))
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    for size in (4, 7, 100):
        model, counts = brown.train_model(marked.filter("not held_out"), classes=4, table_words=size, rounds=6)
        listed = {bytes(r.word): (r.n, r.c) for r in counts.collect()}
        outside = {w: c for w, (_, c) in listed.items() if w not in model.index}
        assert (len(outside) > 0) == (size < 100) and all(0 <= c < 4 for c in outside.values())
        assert len(model.index) == 0 or set(model.word_class[:-1].tolist()) <= set(range(4))
        of = lambda w: int(model.word_class[model.index[w]]) if w in model.index else outside.get(w, model.rest)  # noqa: B023, E731
        texts = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in rows}
        train = [w for i, w in texts.items() if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
        count, moves, total, kinds = Counter(), Counter(), Counter(), Counter({model.rest: 1})
        for words in train:
            count.update(words)
            moves.update(zip(map(of, [b"\n", *words]), map(of, words)))
        for w, x in count.items():
            total[of(w)] += x
            kinds[of(w)] += 1
        a, k = brown.ALPHA, model.k
        into = [sum(moves[i, j] for i in range(k)) for j in range(k)]

        def step(i, j):
            seen = max(1, sum(moves[i, x] > 0 for x in range(k)))  # noqa: B023
            return (moves[i, j] + seen * (into[j] + a) / (sum(into) + a * k)) / (sum(moves[i, x] for x in range(k)) + seen)  # noqa: B023

        got = {r.doc_id: r.score for r in brown.score(marked, model, counts).collect()}
        for i, words in texts.items():
            want = sum(math.log10(step(of(v), of(w)) * (count[w] + a) / (total[of(w)] + a * kinds[of(w)])) for v, w in zip([b"\n", *words], words))
            assert abs(got[i] - want) < 1e-9 * max(1, abs(want)), (size, i)


def test_memory_goes_back_to_the_system():
    """What a worker has freed leaves its process, and counts come the same from slices of a batch."""
    import subprocess
    import sys

    code = (
        "import re, numpy as np; from quotemill.llm.common import release\n"
        "mb = lambda: int(re.search(r'VmRSS:\\s+(\\d+)', open('/proc/self/status').read())[1]) / 1024\n"
        "held = [np.ones(5000) for _ in range(5000)]; last = np.ones(5000)\n"
        "del held; before = mb(); release(); print(before - mb())"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": ROOT})
    assert float(out.stdout) > 100


def test_slices_give_the_same_blocks(spark, monkeypatch):
    import random

    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(rnd.randint(0, 30)))) for i in range(300)] + [(300, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {}
    for size in (200, 1 << 30):
        monkeypatch.setattr(brown, "SLICE_BYTES", size)
        found = brown.score_documents(docs, classes=4, table_words=12).collect()
        got[size] = sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in found)
    assert len(got[200]) == 301 and got[200] == got[1 << 30]
