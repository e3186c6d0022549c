"""Licence scan by sentence rules.

A text is cut into sentences at line ends and sentence ends, each sentence is normalised (A-Z lower-cased, all but
letters, digits and dots to one space, dots at the ends dropped) and looked up among known licence
sentences. The identifiers of the sentences found, in order, form a sequence such as
``<MITgrant><MITnotice><MITwarranty>``. Ordered rules then take licences out of it: an earlier rule
uses up what it matched, so a full text is not reported again by its single sentences. Identifiers
that no rule used are reported as unmatched.

Everything is a column expression over one row: no shuffle, whatever the input. Null and empty texts
have no sentences; repeated rows are scanned one by one; an empty table gives an empty result;
``wrapped`` joins lines first, for texts broken at a fixed width; ``wrapped=None`` takes both layouts: a known
sentence may start and end at a line end, a sentence end or after ``:`` and ``;``, and may run over line ends and
``:`` and ``;``, not over a sentence end or a line without letters and digits. The longest known sentence at a place is taken.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import ascii_lower

# Normalised sentences of public licence notices and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2.0": "Apache2name",
    "licensed under the apache license version 2.0 the license": "Apache2name",
    "you may not use this file except in compliance with the license": "Apache2comply",
    "you may obtain a copy of the license at": "Apache2copy",
    "http www.apache.org licenses license 2.0": "Apache2url",
    "see the license for the specific language governing permissions and limitations under the license": "Apache2limits",
    "released under the mit license": "MITname",
    "licensed under the mit license": "MITname",
    "this project is licensed under the mit license": "MITname",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITwarranty",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "MITgrant",
    "this work is licensed under the gnu general public license version 3": "GPL3name",
    "licensed under the gnu general public license version 3": "GPL3name",
    "this work is licensed under the gnu general public license version 2": "GPL2name",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2plus",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "GPLwarranty",
    "you should have received a copy of the gnu general public license along with this program": "GPLcopy",
    "licensed under cc by nc 4.0": "CCBYNC4name",
    "licensed under cc by 4.0": "CCBY4name",
    "licensed under cc by sa 4.0": "CCBYSA4name",
    "this work is licensed under a creative commons attribution 4.0 international license": "CCBY4name",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDpermit",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
    "all rights reserved": "AllRights",
}
# Ordered rules: licence, identifiers in sequence. Longer rules of a family come before shorter ones.
RULES = [
    ("Apache-2.0", ("Apache2name", "Apache2comply", "Apache2copy", "Apache2url", "Apache2limits")),
    ("Apache-2.0", ("Apache2name", "Apache2comply", "Apache2copy")),
    ("Apache-2.0", ("Apache2name", "Apache2comply")),
    ("MIT", ("MITgrant", "MITnotice", "MITwarranty")),
    ("BSD-3-Clause", ("BSDpermit", "BSDsource", "BSDbinary", "BSDendorse")),
    ("BSD-2-Clause", ("BSDpermit", "BSDsource", "BSDbinary")),
    ("GPL-3.0-or-later", ("GPL3plus", "GPLwarranty", "GPLcopy")),
    ("GPL-2.0-or-later", ("GPL2plus", "GPLwarranty", "GPLcopy")),
    ("GPL-3.0-or-later", ("GPL3plus",)),
    ("GPL-2.0-or-later", ("GPL2plus",)),
    ("Apache-2.0", ("Apache2name",)),
    ("MIT", ("MITname",)),
    ("GPL-3.0-only", ("GPL3name",)),
    ("GPL-2.0-only", ("GPL2name",)),
    ("CC-BY-NC-4.0", ("CCBYNC4name",)),
    ("CC-BY-SA-4.0", ("CCBYSA4name",)),
    ("CC-BY-4.0", ("CCBY4name",)),
]
# Full notices as they are printed; the check SQL knows SENTENCES and RULES only.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITgrant",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": "MITnotice",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITliable",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "Apache2basis",
    "https www.apache.org licenses license 2.0": "Apache2url",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSDwarranty",
    **{
        f"in no event shall the copyright {who} or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "BSDliable"
        for who in ("holder", "holders", "owner")
    },
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCgrant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCgrant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ISCwarranty",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "ISCliable",
    "this source code form is subject to the terms of the mozilla public license v": "MPL2form",
    **{f"if a copy of the mpl was not distributed with this file you can obtain one at {at} mpl 2.0": "MPL2copy" for at in ("http mozilla.org", "https mozilla.org", "https www.mozilla.org")},
    "this is free and unencumbered software released into the public domain": "Unlicensename",
    **{
        f"this {what} is free software you can redistribute it and or modify it under the terms of the gnu {kind}general public license as published by the free software foundation either version {version} of the license or at your option any later version": f"{short}{digits}plus"
        for what in ("program", "library")
        for kind, short, version, digits in (("", "GPL", "2", "2"), ("", "GPL", "3", "3"), ("lesser ", "LGPL", "2.1", "21"), ("lesser ", "LGPL", "3", "3"), ("affero ", "AGPL", "3", "3"))
    },
    **{f"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version {v} as published by the free software foundation": f"GPL{v}only" for v in "23"},
    **{f"this {what} is distributed in the hope that it will be useful but without any warranty": "GPLhope" for what in ("program", "library")},
    **{f"see the gnu {kind}general public license for more details": f"{short}see" for kind, short in (("", "GPL"), ("lesser ", "LGPL"), ("affero ", "AGPL"))},
    **{
        f"you should have received a copy of the gnu {kind}general public license along with this {what}": f"{short}copy"
        for what in ("program", "library")
        for kind, short in (("", "GPL"), ("lesser ", "LGPL"), ("affero ", "AGPL"))
    },
    **{f"if not see {at} www.gnu.org licenses": "GPLwhere" for at in ("http", "https")},
    **{
        f"if not write to the free software foundation inc. {at} usa": "GPLwhere"
        for at in ("51 franklin street fifth floor boston ma 02110 1301", "51 franklin st fifth floor boston ma 02110 1301", "59 temple place suite 330 boston ma 02111 1307")
    },
}
_BSD2 = ("BSDpermit", "BSDsource", "BSDbinary")
_BSD_END = ("BSDwarranty", "BSDliable")
_GNU = [
    ("GPL-3.0-or-later", "GPL", "GPL3plus"),
    ("GPL-2.0-or-later", "GPL", "GPL2plus"),
    ("GPL-3.0-only", "GPL", "GPL3only"),
    ("GPL-2.0-only", "GPL", "GPL2only"),
    ("LGPL-3.0-or-later", "LGPL", "LGPL3plus"),
    ("LGPL-2.1-or-later", "LGPL", "LGPL21plus"),
    ("AGPL-3.0-or-later", "AGPL", "AGPL3plus"),
]
NOTICE_RULES = [
    ("Apache-2.0", ("Apache2name", "Apache2comply", "Apache2copy", "Apache2url", "Apache2basis", "Apache2limits")),
    ("MIT", ("MITgrant", "MITnotice", "MITwarranty", "MITliable")),
    *[("BSD-3-Clause", (*first, *_BSD2, "BSDendorse", *end)) for end in (_BSD_END, ()) for first in (("AllRights",), ())],
    *[("BSD-2-Clause", (*first, *_BSD2, *end)) for end in (_BSD_END, ()) for first in (("AllRights",), ())],
    ("ISC", ("ISCgrant", "ISCwarranty", "ISCliable")),
    ("MPL-2.0", ("MPL2form", "MPL2copy")),
    *[
        (name, (what, "GPLhope", "GPLwarranty", f"{short}see", *end))
        for name, short, what in _GNU
        for end in ((f"{short}copy", "GPLwhere"), (f"{short}copy",), ())
    ],
    *[(name, (what,)) for name, short, what in _GNU if what not in ("GPL3plus", "GPL2plus")],  # those two come after their longer rules below
    ("Unlicense", ("Unlicensename",)),
]
_COMMON = ("license", "licensed", "software", "reserved", "warranty", "gnu", "mpl", "redistribution", "redistributions")
SENTENCE_END = r"[.!?]+([ \t\r\f]+|\n|\z)"
NOT_KEPT = "[^a-z0-9.]+"


def _sequence(rule) -> str:
    return "".join(f"<{s}>" for s in rule)


def sentences(text: Column, wrapped: bool = False) -> Column:
    """Normalised sentences of a text, empty ones left out."""
    plain = ascii_lower(F.coalesce(text, F.lit("")))
    if wrapped:
        plain = F.regexp_replace(plain, "[ \\t]*\\n[ \\t#*/;-]*", " ")
    cut = F.split(F.regexp_replace(plain, SENTENCE_END, "\n"), "\n")
    return F.filter(F.transform(cut, lambda s: F.btrim(F.regexp_replace(s, NOT_KEPT, " "), F.lit(" ."))), lambda s: s != "")


def known_sentences(text: Column, known) -> Column:
    """The sentences of ``known`` in a text of either layout, in order; S marks a cut that a sentence may run over, H one that it may not."""
    s = ascii_lower(F.coalesce(text, F.lit("")))
    s = F.regexp_replace(s, r"(?m)^([^a-z0-9\n]*\(?[a-z0-9]{1,2}\))[ \t]+", "$1; ")  # (1) and a) before an item
    s = F.regexp_replace(F.regexp_replace(s, SENTENCE_END, "H"), r"\n(?=[^a-z0-9\n]*\n)", "H")
    s = F.regexp_replace(F.regexp_replace(s, r"[:;](?=\s|\z)|\n", "S"), "[^a-z0-9.SH]+", " ")
    s = F.regexp_replace(F.concat(F.lit("H"), s, F.lit("H")), "(?<![ .S])[ .S]*+H[ .SH]*", "H")
    s = F.regexp_replace(s, "(?<![ .])[ .]*+S[ .S]*", "S")
    any_of = "|".join(k.replace(".", "[.]").replace(" ", "[ S]") for k in sorted(known, key=lambda k: (-len(k), k)))
    found = F.regexp_extract_all(s, F.lit(f"(?<=[SH])(?:{any_of})(?=[SH])"), F.lit(0))
    # Every known sentence holds one of these words unbroken; texts without any of them need no search.
    words = sorted({max(k.split(), key=lambda w: (w in _COMMON, len(w), w)) for k in known})
    hold = ascii_lower(F.coalesce(text, F.lit(""))).rlike("|".join(w.replace(".", "[.]") for w in words))
    return F.when(hold, F.transform(found, lambda x: F.translate(x, "S", " "))).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, text: str = "text", wrapped: bool | None = False, known=None, rules=None) -> DataFrame:
    """``docs`` with n_sentences, sentence_ids (array), licences (array, sorted) and unmatched (array).

    With ``wrapped=None`` n_sentences counts as without ``wrapped``.
    """
    known, rules = known or SENTENCES | NOTICES, rules or NOTICE_RULES + RULES
    pairs = [F.lit(x) for item in known.items() for x in item]
    searched = F.col("_sentences") if wrapped is not None else known_sentences(F.col(text), known)
    ids = F.filter(F.transform(searched, lambda s: F.element_at(F.create_map(*pairs), s)), lambda x: x.isNotNull())
    out = docs.withColumn("_sentences", sentences(F.col(text), bool(wrapped))).withColumn("sentence_ids", ids)
    out = out.withColumn("_left", F.concat_ws("", F.transform("sentence_ids", lambda x: F.concat(F.lit("<"), x, F.lit(">")))))
    # One fold over the rules: (what is left, licences so far).
    listed = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_sequence(rule)).alias("seq")) for name, rule in rules])
    state = F.aggregate(
        listed,
        F.struct(F.col("_left").alias("left"), F.array().cast("array<string>").alias("got")),
        lambda a, r: F.when(
            F.contains(a["left"], r["seq"]),
            F.struct(F.replace(a["left"], r["seq"], F.lit("<>")).alias("left"), F.array_append(a["got"], r["name"]).alias("got")),
        ).otherwise(a),
    )
    out = out.withColumn("_state", state)
    left = F.filter(F.split(F.btrim("_state.left", F.lit("<>")), "[<>]+"), lambda x: x != "")
    out = out.withColumn("n_sentences", F.size("_sentences").cast("long")).withColumn("licences", F.array_sort(F.array_distinct("_state.got")))
    return out.withColumn("unmatched", left).drop("_sentences", "_left", "_state")


def duckdb_sql() -> str:
    """The same scan of table ``documents``, written for DuckDB."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cut = f"string_split(regexp_replace({lower}, '[.!?]+([ \\t\\r\\f]+|\\n|\\z)', chr(10), 'g'), chr(10))"
    keys = ", ".join(f"'{k}'" for k in SENTENCES)
    values = ", ".join(f"'{v}'" for v in SENTENCES.values())
    text = f"""WITH cut AS (
  SELECT doc_id, list_filter(list_transform({cut}, lambda s: trim(regexp_replace(s, '{NOT_KEPT}', ' ', 'g'), ' .')), lambda s: s <> '') AS s FROM documents
), ids AS (
  SELECT doc_id, len(s) AS n_sentences, list_filter(list_transform(s, lambda x: list_extract([{values}], list_position([{keys}], x))), lambda x: x IS NOT NULL) AS ids FROM cut
), r0 AS (SELECT doc_id, n_sentences, ids, list_aggregate(list_concat([''], list_transform(ids, lambda x: '<' || x || '>')), 'string_agg', '') AS l, CAST([] AS VARCHAR[]) AS got FROM ids)"""
    for i, (name, rule) in enumerate(RULES):
        seq = _sequence(rule)
        text += f""", r{i + 1} AS (SELECT doc_id, n_sentences, ids, replace(l, '{seq}', '<>') AS l,
  CASE WHEN contains(l, '{seq}') THEN list_append(got, '{name}') ELSE got END AS got FROM r{i})"""
    last = f"r{len(RULES)}"
    return text + f"""
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, list_aggregate(list_concat([''], ids), 'string_agg', ' ') AS sentence_ids,
  array_to_string(list_sort(list_distinct(got)), ',') AS licences,
  array_to_string(list_filter(regexp_split_to_array(trim(l, '<>'), '[<>]+'), lambda x: x <> ''), ',') AS unmatched
FROM {last}"""
