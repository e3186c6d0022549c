import random
from array import array

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken

from quotemill.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBPE(bpe.read_ranks(PATH))


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def samples():
    rnd = random.Random(5)
    letters = "abcdeéñöthing ontion  \n\t.,!'s0123456789漢字😀"
    out = ["", " ", "a", "\n\n  x", "it's  we'll", "a" * 3000, " " * 500, " x 　y", "<|endoftext|>", "\x00\x01"]
    out += ["".join(rnd.choices(letters, k=rnd.randint(1, 400))) for _ in range(300)]
    out += ["".join(chr(rnd.choice([rnd.randrange(32, 0x500), rnd.randrange(0x4E00, 0x4F00)])) for _ in range(80)) for _ in range(60)]
    return out


def test_same_as_library(coder, known):
    split = regex.compile(P.PATTERN).findall
    whole = bpe.Encoder(coder, P.PATTERN)
    for text in samples():
        want = known.encode_ordinary(text)
        assert [i for p in split(text) for i in coder.encode(p.encode())] == want
        assert np.frombuffer(whole.encode(text), "<u4").tolist() == want


def test_random_bytes_follow_the_merge_rules(coder):
    rnd = random.Random(6)
    for _ in range(300):
        data = bytes(rnd.choices(b"the ingonre", k=rnd.randint(2, 40)))
        assert data in coder.ranks or coder.encode(data) == coder.merged(data)


def test_compatible_pairs_are_those_that_merge_back(coder):
    """The walk along the seam against a full merge of both tokens' bytes."""
    rnd = random.Random(8)
    small = [t for t in range(len(coder.tokens)) if len(coder.tokens[t]) <= 3]
    pairs = [tuple(rnd.choices(range(len(coder.tokens)), k=2)) for _ in range(4000)]
    pairs += [(rnd.choice(small), rnd.choice(small)) for _ in range(6000)]
    pairs += [(t, t) for t in rnd.sample(range(len(coder.tokens)), 1500)]
    for token in rnd.sample(range(256, len(coder.tokens)), 2500):  # halves merge, neighbours of a cut often don't fit
        pairs.append(coder.halves(token))
        data = coder.tokens[token] + coder.tokens[rnd.choice(small)]
        cut = rnd.randrange(1, len(data))
        if data[:cut] in coder.ranks and data[cut:] in coder.ranks:
            pairs.append((coder.ranks[data[:cut]], coder.ranks[data[cut:]]))
    outcomes = set()
    for left, right in pairs:
        want = coder.merged(coder.tokens[left] + coder.tokens[right]) == [left, right]
        assert coder._seam_holds(left, right) == want, (left, right)
        outcomes.add(want)
    assert outcomes == {True, False}


def test_memos_are_bounded_in_bytes(coder):
    small = bpe.Encoder(coder, P.PATTERN, 2000, 1000)
    large = bpe.Encoder(coder, P.PATTERN)
    for i in range(300):
        text = f" word{i} and{i % 7} a\nline{i}"
        assert small.encode(text) == large.encode(text)
        assert small.pieces.used <= 2000 and small.chunks.used <= 1000
    assert len(large.chunks) > 300 and array("I").itemsize == 4


def test_decoding_a_column():
    import pyarrow as pa

    tokens = pa.array([b"a", b"", b"bcd"], pa.large_binary())
    ids = [np.array(x, "<u4").tobytes() if x is not None else None for x in ([2, 0], None, [], [1], [0, 2, 2])]
    for column in (pa.array(ids, pa.binary()), pa.array([b"xxxx", *ids], pa.binary()).slice(1), pa.array([], pa.binary())):
        want = [None if x is None else b"".join(tokens[int(i)].as_py() for i in np.frombuffer(x, "<u4")) for x in column.to_pylist()]
        assert bpe.decode_ids(column, tokens).to_pylist() == want


def test_documents(spark, known):
    rows = [(1, "Ontion the"), (1, "Ontion the"), (None, None), (2, ""), (3, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", __import__("pyspark").sql.functions.lit("old"))
    got = bpe.decode_documents(bpe.encode_documents(docs, PATH, P.PATTERN), PATH).collect()
    assert sorted((r.n_tokens, bytes(r.decoded)) for r in got) == sorted((len(known.encode_ordinary(t or "")), (t or "").encode()) for _, t in rows)
    assert bpe.encode_documents(docs.limit(0), PATH, P.PATTERN).count() == 0
