"""License scans by the digests of canonical texts."""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import id_field, map_texts, texts_of

_WORDS = re.compile(r"[^\W_]+").findall
# A line that names who holds the copyright; the words "copyright notice" may start a line of the license itself.
_COPYRIGHT = re.compile(r"\s*(?:copyright\b(?!\s+(?:notice|holders?|owners?)\b)|\(c\)|©)", re.IGNORECASE).match

# Equivalent spellings.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sublicence": "sublicense",
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "catalogue": "catalog",
    "centre": "center",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "merchantibility": "merchantability",
    "modelling": "modeling",
    "organisation": "organization",
    "organisations": "organizations",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "https": "http",
}

# Short notices.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]

# Title lines and whole texts of licenses and of the notices that stand at the head of files.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so{conditions}"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted{conditions}"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: {one}Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. {two}Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. {third}"
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
TEXTS = [
    ("MIT", ("MIT License", "The MIT License", "The MIT License (MIT)"), _MIT.format(
        conditions=", subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. "
    )),
    ("MIT-0", ("MIT No Attribution", "MIT-0"), _MIT.format(conditions=". ")),
    ("ISC", ("ISC License", "The ISC License"), _ISC.format(
        conditions=", provided that the above copyright notice and this permission notice appear in all copies. "
    )),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD"), _ISC.format(conditions=". ")),
    *(
        (name, titles, _BSD.format(one=marks[0], two=marks[1], third=third and marks[2] + third))
        for name, titles, third in (
            ("BSD-2-Clause", ("BSD 2-Clause License",), ""),
            ("BSD-3-Clause", ("BSD 3-Clause License",), _BSD_THIRD),
        )
        for marks in (("1. ", "2. ", "3. "), ("* ", "* ", "* "))  # the bullet isn't a word
    ),
    ("Zlib", ("zlib License", "The zlib License"), (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."
    )),
    ("ISC", (), (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    )),
    ("Apache-2.0", (), (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    )),
    ("GPL-3.0-or-later", (), (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."
    )),
    ("MPL-2.0", (), (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    )),
]

#: Name and text: each notice, and each text without a title and under each of its titles.
LICENSES = [
    *NOTICES,
    *((name, " ".join([*title, text])) for name, titles, text in TEXTS for title in ([], *([own] for own in titles))),
]

# Known digests up to this number are sent to all executors; more are shuffled.
BROADCAST_DIGESTS = 100_000


def canonical_words(line: str) -> list[str]:
    """Words of a line, in lower case and one spelling; none of a copyright line."""
    if _COPYRIGHT(line):
        return []
    return [SPELLINGS.get(word, word) for word in _WORDS(line.lower())]


def digest(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode()).digest()


def text_digests(text: str) -> tuple[bytes | None, list[bytes]]:
    """Digest of the whole text, and of each of its lines; none without a word."""
    lines = [words for words in map(canonical_words, text.split("\n")) if words]
    return (digest([w for words in lines for w in words]) if lines else None), [digest(words) for words in lines]


def sizes_by_first_word(licenses: list[tuple[str, str]]) -> dict[str, tuple[int, ...]]:
    """Numbers of canonical words that a license with this first word has."""
    sizes: dict[str, set[int]] = {}
    for _, text in licenses:
        words = [word for line in text.split("\n") for word in canonical_words(line)]
        sizes.setdefault(words[0], set()).add(len(words))
    return {first: tuple(sorted(own)) for first, own in sizes.items()}


def run_digests(text: str, sizes: dict[str, tuple[int, ...]]) -> list[tuple[int, bytes]]:
    """(number of the first line, digest) of the runs of two or more lines with words that may be a license.

    Such a run has the first word of one and as many words. Lines without words
    lie within a run or not, it is the same.
    """
    lines = [words for words in map(canonical_words, text.split("\n")) if words]
    starts = [n for n, words in enumerate(lines) if words[0] in sizes]
    if not starts:
        return []
    before = [0, *accumulate(map(len, lines))]
    line_at = {total: n for n, total in enumerate(before)}
    out = []
    for first in starts:
        for size in sizes[lines[first][0]]:
            end = line_at.get(before[first] + size)
            if end is not None and end > first + 1:
                out.append((first, digest([word for words in lines[first:end] for word in words])))
    return out


def license_digests(spark, licenses: list[tuple[str, str]]) -> DataFrame:
    rows = sorted({(text_digests(text)[0], name) for name, text in licenses})
    known = spark.createDataFrame([(bytearray(d), name) for d, name in rows], "digest binary, license string")
    return F.broadcast(known) if len(rows) <= BROADCAST_DIGESTS else known


def find_licenses(
    docs: DataFrame,
    licenses: list[tuple[str, str]] = LICENSES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Documents that are a known license, or hold one as a line or as consecutive lines.

    Texts are entire: the whole document, each of its lines, and runs of lines
    that have as many words as a license with the same first word. Case,
    punctuation, spacing, copyright lines and equivalent spellings don't count.
    One row for each document with a license: doc_id, whole_license (names of
    the licenses that the whole document is, else NULL), license_lines (lines
    that are a license), license_runs (first lines of runs of two or more that
    are one) and licenses (all names, sorted, joined by commas). NULL ids, NULL
    and empty texts, and lines without a word match nothing; repeated rows count
    as one document; other columns don't matter; an empty table gives no rows.

    Digests are hash-joined with the known ones; only hits are shuffled.
    """
    schema = T.StructType(
        [
            id_field(docs, id_col),
            T.StructField("kind", T.StringType()),
            T.StructField("line", T.IntegerType()),
            T.StructField("digest", T.BinaryType()),
        ]
    )
    sizes = sizes_by_first_word(licenses)

    def start():
        def step(ids, texts):
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                whole, lines = text_digests(text)
                rows += [(doc_id, "whole", 0, whole)] if whole else []
                rows += [(doc_id, "line", n, own) for n, own in enumerate(lines)]
                rows += [(doc_id, "run", n, own) for n, own in run_digests(text, sizes)]
            return list(zip(*rows, strict=True)) if rows else [[]] * 4

        return step

    texts = texts_of(docs, id_col, text_col).filter("doc_id is not null and text is not null")
    units = map_texts(texts, start, schema, "text")
    return (
        units.join(license_digests(docs.sparkSession, licenses), "digest")
        .groupBy("doc_id")
        .agg(
            F.array_join(F.sort_array(F.collect_set(F.when(F.col("kind") == "whole", F.col("license")))), ",").alias("whole"),
            *(
                F.count_distinct(F.when(F.col("kind") == kind, F.col("line"))).alias(f"license_{kind}s")
                for kind in ("line", "run")
            ),
            F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
        )
        .select("doc_id", F.when(F.col("whole") != "", F.col("whole")).alias("whole_license"), "license_lines", "license_runs", "licenses")
    )
