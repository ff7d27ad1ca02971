"""Licence scan by canonical digests.

Texts are brought to a canonical form: case and accents folded, copyright lines and comment marks
dropped, equivalent spellings unified, punctuation gone. The digest of the whole canonical text is
hash-joined to the digests of known licence texts. Lines are looked up likewise among one-line notices, a
short list that every task has.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.kernel import pieces
from tidegauge.llm.store import bounded

# Texts of public licences and usual one-line notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications,
and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.

3. This notice may not be removed or altered from any source distribution."""
TEXTS = [
    ("MIT", MIT),
    ("MIT", f"MIT License\n\n{MIT}"),
    ("MIT", f"The MIT License (MIT)\n\n{MIT}"),
    ("ISC", ISC),
    ("ISC", f"ISC License\n\n{ISC}"),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Zlib", ZLIB),
    ("Zlib", f"zlib License\n\n{ZLIB}"),
]
# Digests of the canonical form of whole public licence texts, as `digest` gives them.
DIGESTS = [
    ("Apache-2.0", "3d7ac7e29c6b745aede8375467da19a005325ed0be4c4250f698571307ef7aed"),
    ("Artistic-1.0-Perl", "f7fec2048e2502b8b653a12ac095bcb0601f72bbd1d535b2e8adf8e097d2f915"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "f06741c6c5feec30d99f80228f0d9ea6b884eae0e790ab18a0f4257184befa86"),
    ("GFDL-1.3", "80229e90e6f40a551a447f33ef48bd361a8e3166d53f29a2d1537245e2064feb"),
    ("GPL-1.0", "9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c"),
    ("GPL-2.0", "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-3.0", "5272fb2d9117cba4ebb1b4a6612e61ab05ddddeff56bd30c3ac3798e23821b30"),
    ("LGPL-2.0", "96685b4d8003c3671feddcde58622afa814a3ac15dcc419f38b388aff5e16d1d"),
    ("LGPL-2.1", "22bd2802b7b313faf9750f494c8f07c9eaa0e00ba5b9f7a300e8fa36cfd1319e"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cfeaaa06673b1503f35820ed13fa560f04864481a8b6da339f299fb2b90d8755"),
    ("MPL-2.0", "cdb5877b9b73b693216820ac5a0090510c6fd9df7c38876e551b865cce774ddd"),
]
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Released under the BSD License."),
]
# Spellings that mean the same.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "organisation": "organization", "acknowledgement": "acknowledgment",
    "favour": "favor", "honour": "honor", "fulfil": "fulfill", "judgement": "judgment", "merchantibility": "merchantability", "percent": "per cent", "copyrightholder": "copyright holder",
    "non-infringement": "noninfringement", "sub-license": "sublicense", "whilst": "while", "cancelled": "canceled", "behaviour": "behavior", "programme": "program", "wilful": "willful",
}
#: Up to so many known texts are broadcast; more are joined by Spark as it sees fit. Notices are at most as many.
SMALL = 10_000
#: Up to so many forms of cues a line is searched for them before it is looked up.
CUES = 50

_COPYRIGHT = re.compile(r"^[^\w\n]*(?:copyright\b|\(c\)|©|all rights reserved).*$", re.MULTILINE)
_MARKS = re.compile(r"^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|<!--|rem\b)", re.MULTILINE)
_WORD = re.compile(r"\w+(?:-\w+)*")


def canonical(text: str | None) -> str:
    """Words of the text in canonical form, joined by single spaces."""
    text = _COPYRIGHT.sub("", _MARKS.sub("", (text or "").casefold()))
    return " ".join(" ".join(SPELLINGS.get(w, w) for w in _WORD.findall(text)).replace("-", " ").split())


def cue(text: str | None) -> str:
    """The longest canonical word, of several the first by name: every text of the same canonical form has it."""
    return min(canonical(text).split(), key=lambda w: (-len(w), w), default="")


def _cue_forms(cues: set[str]) -> set[str]:
    """What a casefolded text holds, one at least, if one of the words is in its canonical form."""
    return cues | {form for form, meant in SPELLINGS.items() if cues & set(meant.replace("-", " ").split())}


def digest(text: str | None) -> bytes:
    return hashlib.sha256(canonical(text).encode()).digest()


def known_texts(spark: SparkSession) -> DataFrame:
    """The built-in texts: ``license``, ``text``, ``whole`` (a licence, or else a one-line notice)."""
    rows = [(n, t, True) for n, t in TEXTS] + [(n, t, False) for n, t in NOTICES]
    return spark.createDataFrame(rows, "license string, text string, whole boolean")


def _digested(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column("license"), batch.column("whole"), pa.array([digest(t) for t in texts]), pa.array([cue(t) for t in texts], pa.string())], ["license", "whole", "digest", "cue"])


def _scanned(notices: dict[bytes, str], cues: set[str]):
    """Digest of the whole text, and the notices among its lines.

    A line that holds no notice's cue is none; with more than ``CUES`` forms of cues every line is looked up.
    """
    forms = _cue_forms(cues)
    likely = re.compile("|".join(map(re.escape, sorted(forms))) if len(forms) <= CUES else "")

    def run(batches):
        for batch in pieces(batches, 1):
            whole, named = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                whole.append(digest(text))
                own = {notices.get(digest(line)) for line in text.splitlines() if likely.search(line.casefold())}
                named.append(",".join(sorted(own - {None})))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(whole), pa.array(named)], ["doc_id", "digest", "notices"])

    return run


def license_scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``license``, ``notices``, ``canonical_sha256`` for every row of ``docs(doc_id, text)``.

    ``license`` is the licence whose whole text the document is, or null; of several with one digest the
    first by name. ``notices`` are the licences its lines name, ascending; a known text that is a copyright
    line alone, such as "All rights reserved", has the digest of nothing and is not looked for. Null, empty and all-punctuation
    texts have the digest of nothing, which no licence has. Rows without an id and rows that repeat are
    judged each. Other columns are not read. An empty table gives an empty result. Without ``known`` the built-in texts
    and digests are looked for.
    """
    spark = docs.sparkSession
    digests = spark.createDataFrame([(bytes.fromhex(d), n) for n, d in DIGESTS if known is None], "digest binary, license string")
    known = known_texts(spark) if known is None else known
    known = bounded(known).select("license", "text", "whole").mapInArrow(_digested, "license string, whole boolean, digest binary, cue string")
    known = known.where(F.col("digest") != F.lit(digest(""))).groupBy("whole", "digest").agg(F.min("license").alias("license"), F.min("cue").alias("cue"))
    notices = known.where("not whole").limit(SMALL + 1).collect()
    if len(notices) > SMALL:
        raise ValueError(f"more than {SMALL} one-line notices")
    texts = known.where("whole").select("digest", "license").unionByName(digests)
    texts = F.broadcast(texts) if texts.limit(SMALL + 1).count() <= SMALL else texts
    scan = _scanned({bytes(r["digest"]): r["license"] for r in notices}, {r["cue"] for r in notices})
    rows = bounded(docs.select("doc_id", "text")).mapInArrow(scan, "doc_id long, digest binary, notices string")
    return rows.join(texts, "digest", "left").select("doc_id", "license", "notices", F.lower(F.hex("digest")).alias("canonical_sha256"))
