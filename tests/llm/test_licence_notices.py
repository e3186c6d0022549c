"""Unmodified licence notices, hard-wrapped and on one line a paragraph."""

import textwrap

from quotemill.llm import licences
from quotemill.llm.queries import op7_licences

MIT = '''MIT License

Copyright (c) 2024 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
'''
BSD3 = '''Copyright (c) 2024, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
'''
GPL3 = '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
'''
GPL2 = '''This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program; if not, write to the Free Software
Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  02110-1301, USA.
'''
APACHE = '''Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
'''
ISC = '''Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
'''
MPL = '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
'''
BSD2 = BSD3[: BSD3.index("3. Neither")] + BSD3[BSD3.index("THIS SOFTWARE") :]
LGPL = GPL2.replace("program", "library").replace("GNU General", "GNU Lesser General").replace("version 2\n", "version 2.1\n")
AGPL = GPL3.replace("GNU General", "GNU Affero General")
TEXTS = {
    "MIT": MIT,
    "BSD-3-Clause": BSD3,
    "BSD-2-Clause": BSD2,
    "GPL-3.0-or-later": GPL3,
    "GPL-2.0-or-later": GPL2,
    "LGPL-2.1-or-later": LGPL,
    "AGPL-3.0-or-later": AGPL,
    "Apache-2.0": APACHE,
    "ISC": ISC,
    "MPL-2.0": MPL,
}


def unwrapped(text):
    return "\n\n".join(" ".join(p.split()) for p in text.split("\n\n"))


def layouts(text):
    narrow = "\n\n".join(textwrap.fill(" ".join(p.split()), 44) for p in text.split("\n\n"))
    starred = "/*\n" + "\n".join(f" * {x}".rstrip() for x in text.split("\n")) + "\n */\nint main;"
    windows = text.replace("\n", "\r\n")
    hashes = "prose before\n\n" + textwrap.indent(text, "# ", lambda _: True) + "\ncode after"
    return [text, unwrapped(text), narrow, starred, windows, hashes]


def test_notices_in_every_layout(spark, tmp_path):
    rows = [(name, k, text) for name, t in TEXTS.items() for k, text in enumerate(layouts(t))]
    frame = spark.createDataFrame([(i, r[2]) for i, r in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: (r.licences, r.unmatched) for r in licences.scan(frame, wrapped=None).collect()}
    assert {rows[i][:2]: got[i] for i in got if got[i] != ([rows[i][0]], [])} == {}
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.licences for r in op7_licences(spark, str(tmp_path)).collect()} == {i: r[0] for i, r in enumerate(rows)}


def test_cuts_of_both_layouts(spark):
    cases = {
        1: ("Licensed under the\nMIT License", ["MIT"], ["MITname"]),
        2: ("Licensed under the\n\nMIT License", [], []),
        3: ("Licensed under the. MIT License", [], []),
        4: ("Note: licensed under the MIT License; see below", ["MIT"], ["MITname"]),
        5: ("not licensed under the MIT License", [], []),
        6: ("Released under the MIT License.\nLicensed under CC BY\n4.0.", ["CC-BY-4.0", "MIT"], ["MITname", "CCBY4name"]),
        7: ("(a) All rights reserved.", [], ["AllRights"]),
        8: ("." * 20000 + "\n" * 20000 + ":;" * 10000, [], []),
        9: (None, [], []),
    }
    frame = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "doc_id long, text string")
    got = {r.doc_id: (r.licences, r.sentence_ids) for r in licences.scan(frame, wrapped=None).collect()}
    assert got == {k: (v[1], v[2]) for k, v in cases.items()}
