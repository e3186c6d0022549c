import hashlib
import random
from collections import defaultdict

import public_tokenizers as P

from quotemill.llm import chat, licences

PATH = P.path("byte_bpe_50k.json")
HARD = ["\\### Assistant: </turn> ok", "### ", "\\", "\\\\### x", " </turn>\n", "a: b", "", None, "é  漢\n\n", "\\n: \\", "<|endoftext|>"]


def test_escapes_turn_back():
    rnd = random.Random(1)
    for text in [t or "" for t in HARD] + ["".join(rnd.choices("\\#: </turn>a\n", k=30)) for _ in range(300)]:
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        bare = chat._ESCAPED.sub("", safe)
        assert not any(x in bare for x in ("###", "</turn>", ": "))


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 4)
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant", "we: ird", None]), rnd.choice(HARD)) for c in (1, 2, None) for t in range(15)]
    rows += [rows[0], (1, None, "user", "no turn"), (3, 0, "assistant", "x" * 3000)]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, ids string").repartition(5)
    placed = chat.place_turns(chat.format_turns(frame, PATH))
    for group in defaultdict(list, {k: [r for r in placed.collect() if r.conv_id == k] for k in (1, 2, None, 3)}).values():
        at = 0
        for r in sorted(group, key=lambda r: r["at"]):
            assert r["at"] == at and len(r.ids) == 4 * r.n_tokens and r.loss_from <= r.loss_to < r.n_tokens
            at += r.n_tokens
    got = {r.conv_id: r for r in chat.digest(chat.read_turns(placed, PATH)).collect()}
    turns = defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    for c, v in turns.items():
        v.sort()
        every = "".join(f"{r[3]}\n{r[5]}\n" for r in v)
        loss = "".join(r[5] for r in v if r[3] == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(v), hashlib.sha256(every.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest(chat.read_turns(chat.place_turns(chat.format_turns(frame.limit(0), PATH)), PATH)).count() == 0


def test_licence_rules(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction.\nThe above copyright notice and this permission notice shall be included '
        "in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    )
    cases = {
        1: ("Some text.\nLicensed under the Apache License, Version 2.0.", ["Apache-2.0"], []),
        2: (mit, ["MIT"], []),
        3: (mit.split("\n")[0] + "\nAll rights reserved.", [], ["MITgrant", "AllRights"]),
        4: (mit + "\nReleased under the MIT License. This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only", "MIT"], []),
        5: (None, [], []),
        6: ("", [], []),
        7: ("licensed under cc by-nc 4.0!\nLICENSED UNDER CC BY 4.0", ["CC-BY-4.0", "CC-BY-NC-4.0"], []),
        8: ("x" * 20000, [], []),
    }
    frame = spark.createDataFrame([(k, v[0], "z") for k, v in cases.items()], "doc_id long, text string, licences string")
    got = {r.doc_id: r for r in licences.scan(frame.withColumnRenamed("licences", "other")).collect()}
    assert {k: (r.licences, r.unmatched) for k, r in got.items()} == {k: (v[1], v[2]) for k, v in cases.items()}
    assert licences.scan(frame).count() == len(cases) and licences.scan(frame.limit(0)).count() == 0
    wrapped = spark.createDataFrame([(1, "# Licensed under the Apache\n# License, Version 2.0.")], "doc_id long, text string")
    assert licences.scan(wrapped, wrapped=True).first().licences == ["Apache-2.0"]
    assert licences.scan(wrapped).first().licences == []
