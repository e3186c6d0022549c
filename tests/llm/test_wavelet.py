import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from test_bpe import samples
from tokenizers import Tokenizer

from quotemill.llm import wavelet as w

PATH = P.path("byte_bpe_50k.json")


def test_matrix():
    r = np.random.default_rng(0)
    for top, n in ((1, 100), (2, 1), (50257, 3000), (1 << 20, 500)):
        v = r.integers(0, top, n).astype(np.uint32)
        m = w.WaveletMatrix.from_parts(w.WaveletMatrix.build(v).to_parts())
        assert (m.values() == v).all() and (m.access(np.arange(n)) == v).all()
        at = r.integers(0, n + 1, 60)
        some = v[r.integers(0, n, 60)]
        assert m.rank(some, at).tolist() == [int((v[:b] == a).sum()) for a, b in zip(some, at)]
        assert m.count(some).tolist() == [int((v == a).sum()) for a in some]
        assert m.positions(int(v[0])).tolist() == np.flatnonzero(v == v[0]).tolist()


def test_encoder_equals_library():
    coder, plain = w.Encoder(PATH), Tokenizer.from_file(PATH)
    texts = samples() + [" a b", "x\n y", "a <|endoftext|> b"]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == want


def test_documents(spark):
    plain = Tokenizer.from_file(PATH)
    rows = [(5, "Ontion the!"), (1, ""), (None, None), (3, "x" * 4000), (2, "a b\nc"), (2, "a b\nc"), (4, "!!")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, seq int")
    shards = w.write_shards(docs, PATH, shard_tokens=8)
    assert shards.count() > 2
    ids = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    starts = w.shard_starts(shards)
    got = w.read_documents(shards).join(starts, ["part", "seq"]).withColumn("crc", F.crc32("ids")).collect()
    got = sorted((r["first"] + r["at"], r.doc_id, r.n_tokens, r.crc) for r in got)
    assert [g[1] for g in got] == [None, 1, 2, 2, 3, 4, 5]
    place = 0
    for start, i, n, crc in got:
        assert (start, n, crc) == (place, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes()))
        place += n
    flat = [t for i in (None, 1, 2, 2, 3, 4, 5) for t in ids[i]]
    at = w.token_places(shards, [0, ids[5][0]]).join(starts, ["part", "seq"]).collect()
    for t in (0, ids[5][0]):
        assert sorted(r["first"] + r["place"] for r in at if r.token == t) == [k for k, x in enumerate(flat) if x == t]
    assert w.read_documents(w.write_shards(docs.limit(0), PATH)).count() == 0
