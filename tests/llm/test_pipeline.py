import random
import sys

import public_tokenizers as P
import pytest
import tiktoken
from test_fmindex import brute as brute_hits
from test_fuzzy_lines import brute as brute_lines
from test_superminhash import brute as brute_near

from quotemill.llm import bpe, fmindex

sys.path.insert(0, __file__.rsplit("/", 3)[0])
import corpus_pipeline  # noqa: E402


def corpus():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    items = [(i, prose(30)) for i in range(5)]
    docs = [(i, "\n".join(prose(rnd.randint(20, 60)) for _ in range(4)), "en", f"s{i % 3}") for i in range(160)]
    docs += [(200 + i, docs[i][1], "en", "s0") for i in range(5)]  # copies
    docs += [(300 + i, docs[i][1].split("\n")[0] + "\n" + prose(70), "en", "s1") for i in range(5)]  # shared lines
    docs += [(400 + i, prose(60) + " " + items[i][1] + " " + prose(20), "en", "s2") for i in range(5)]  # benchmark passages
    docs += [(500 + i, prose(80).replace(" ", "$$$ "), "en", "s0") for i in range(5)]  # junk
    docs += [(600, "short", "en", "s0"), (601, None, None, None)]
    words = prose(400).split()
    for i in range(4):  # near copies on one line each, unlike enough to pass the line stage
        lines = [" ".join(words[k : k + 40]) for k in range(0, 400, 40)]
        docs.append((700 + i, "\n".join(prose(3) + " " + x + " " + prose(3) for x in lines) if i else "\n".join(lines), "en", "s1"))
    return [(i, t, a, b, len(t or "")) for i, t, a, b in docs], items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, items = corpus()
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_stages_against_brute_force(spark, folder):
    docs, items = corpus()
    want = {i: t for i, t, *_ in docs if t and len(t.split()) >= 50 and "$" not in t}
    gone = brute_lines(list(want.items()))
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i][1]) for i, t in want.items()}
    near = brute_near(list(want.items()), 5)
    want = {i: t for i, t in want.items() if near[i][2]}
    hits = dict(zip(want, brute_hits(list(want.values()), items)))
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    texts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        texts.append({r.doc_id: r.text for r in frame.collect()})
        assert all(r.n_chars == len(r.text) for r in frame.collect())
    assert texts[2] == want
    assert all(len(fmindex.words(t.encode())) == hits[i][0] - hits[i][1] for i, t in texts[3].items())
    assert sum(h[1] > 0 for h in hits.values()) == 5
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} == set(want) and all(r.round_trip for r in out)
    assert all(r.n_tokens == len(coder.encode_ordinary(texts[3][r.doc_id])) for r in out)


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
