"""Licence scans by canonical digests.

Texts and known licences are brought to one canonical form (case, punctuation, copyright
lines, equivalent spellings), and digests of whole units are hash-joined: the entire text,
each block between blank lines, as many blocks in a row as a licence has, and each line. A unit
matches if all of it is the licence or notice, never in part. Built-in functions only; the known table is a fixed one of a few
hundred short rows, so its broadcast does not grow with the data.
"""

from __future__ import annotations

from functools import reduce
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that licences use alike, longest first where one holds another.
SPELLINGS = [
    ("licence", "license"),
    ("organisation", "organization"),
    ("recognis", "recogniz"),
    ("authoris", "authoriz"),
    ("initialis", "initializ"),
    ("utilis", "utiliz"),
    ("merchantibility", "merchantability"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("behaviour", "behavior"),
    ("judgement", "judgment"),
    ("acknowledgement", "acknowledgment"),
    ("fulfilment", "fulfillment"),
    ("whilst", "while"),
    ("non commercial", "noncommercial"),
    ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"),
]

# A line that only says who holds a copyright, in lower case.
COPYRIGHT_LINE = r"(?m)^[ \t*#/;-]*(?:copyright[ \t]*(?:\(c\)|©|[0-9<\[])|\(c\)|©|all rights reserved)[^\n]*$"

# A line that only names a licence whose text has no title, in canonical form.
TITLE_LINE = (
    r"(?m)^(?:the )?(?:(?:mit|isc|zlib|[23] clause bsd|bsd [23] clause)"
    r"|(?:simplified|new|modified|revised) bsd)"
    r"(?: simplified| new| modified| revised| or)* license(?: mit| isc| zlib)?$"
)

# Names under which texts mention a licence. `notices` puts them in sentences.
NAMES = {
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache 2.0"],
    "MIT": ["the MIT License", "the MIT licence (MIT)", "MIT"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the Simplified BSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the New BSD License"],
    "ISC": ["the ISC License"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU GPL v2"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU GPL v3"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
}
SENTENCES = [
    "Licensed under {}",
    "Released under {}",
    "Distributed under {}",
    "This work is licensed under {}",
    "This software is licensed under {}",
    "This project is licensed under {}",
    "This file is licensed under {}",
]

# Entire licences.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no
event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.
3. This notice may not be removed or altered from any source distribution.""",
}
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution.

"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written
permission.

"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY
OF SUCH DAMAGE."""
TEXTS["BSD-2-Clause"] = _BSD_START + _BSD_END
TEXTS["BSD-3-Clause"] = _BSD_START + _BSD_THIRD + _BSD_END
# Longer ones are files beside this module, named by licence.
TEXTS |= {
    path.name.removesuffix(".txt"): path.read_text("utf-8")
    for path in sorted(files(__package__).joinpath("license_texts").iterdir(), key=lambda p: p.name)
}


def canonical_lines(text: str | Column) -> Column:
    """Canonical form with its lines kept apart; NULL counts as empty."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    bare = F.regexp_replace(lowered, COPYRIGHT_LINE, "")
    words = F.regexp_replace(bare, r"[^\p{L}\p{N}\n]+", " ")
    spelled = reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), SPELLINGS, words)
    return F.regexp_replace(spelled, r"(?m)^ +| +$", "")


def _one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"\s+", " "))


def known_licences() -> list[tuple[str, str]]:
    """(licence, text) of every entire licence and every notice sentence."""
    notices = [
        (licence, sentence.format(name))
        for licence, names in NAMES.items()
        for name in names
        for sentence in SENTENCES
    ]
    return [*TEXTS.items(), *notices]


def known_digests(spark: SparkSession) -> DataFrame:
    texts = spark.createDataFrame(known_licences(), "license_id string, text string")
    canonical = texts.select("license_id", _one_line(canonical_lines(F.col("text"))).alias("unit"))
    # Two spellings of one notice may share their canonical form.
    return canonical.groupBy(F.sha2("unit", 256).alias("digest")).agg(
        F.min("license_id").alias("license_id")
    )


def _blocks(lines: Column) -> Column:
    """The blocks of canonical lines without titles, each in one line."""
    bare = F.regexp_replace(lines, TITLE_LINE, "")
    return F.filter(F.transform(F.split(bare, r"\n{2,}"), _one_line), lambda block: block != "")


def known_sequences(spark: SparkSession) -> list[tuple[str, int, str]]:
    """(digest of the first block, number of blocks, digest of all) of entire licences."""
    texts = spark.createDataFrame(list(TEXTS.items()), "license_id string, text string")
    blocks = texts.select(_blocks(canonical_lines(F.col("text"))).alias("blocks"))
    rows = blocks.select(
        F.sha2(F.col("blocks")[0], 256).alias("first"),
        F.size("blocks").alias("n"),
        F.sha2(F.array_join("blocks", " "), 256).alias("digest"),
    )
    return [tuple(row) for row in rows.collect()]


def _sequences(known: list[tuple[str, int, str]]) -> Column:
    """(scope, digest) of the known licences that consecutive ones of `blocks` make up."""

    def match(first: str, n: int, digest: str) -> Column:
        starts = F.sequence(F.lit(1), F.size("blocks") - n + 1)
        is_here = lambda i: (F.element_at("firsts", i) == first) & (
            F.sha2(F.array_join(F.slice("blocks", i, F.lit(n)), " "), 256) == digest
        )
        is_found = (F.size("blocks") >= n) & F.array_contains("firsts", first)
        scope = F.when(F.size("blocks") == n, "text").otherwise("part")
        found = F.struct(scope.alias("scope"), F.lit(digest).alias("digest"))
        return F.when(is_found, F.when(F.exists(starts, is_here), found))

    return F.array_compact(F.array(*(match(*one) for one in known)))


def license_matches(texts: DataFrame) -> DataFrame:
    """Licences found in rows of (doc_id, text): doc_id, license_id, scope, n_units.

    `scope` is `text` where the entire text is the licence, else `part` for blocks or a line,
    of which `n_units` different ones match. A title line does not count as text of a licence. Texts without a match, NULL and empty ones
    included, have no row. Rows that repeat a doc_id are taken together (NULL is one id);
    other columns are not read. A line that is also the entire text counts as `text` only.
    """
    lines = texts.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    whole = _one_line(F.col("lines"))
    blocks = F.transform(F.split("lines", r"\n{2,}"), _one_line)
    parts = F.array_except(
        F.array_union(F.split("lines", r"\n"), blocks), F.array(F.lit(""), F.col("whole"))
    )
    part = lambda scope: lambda unit: F.struct(
        F.lit(scope).alias("scope"), F.sha2(unit, 256).alias("digest")
    )
    sequences = _sequences(known_sequences(texts.sparkSession))
    described = lines.withColumn("whole", whole).withColumn("blocks", _blocks(F.col("lines")))
    described = described.withColumn(
        "firsts", F.transform("blocks", lambda block: F.sha2(block, 256))
    )
    # Outer, for else the optimizer filters empty arrays and computes each one twice.
    digests = described.select(
        "doc_id",
        F.explode_outer(
            F.concat(
                F.array(part("text")(F.col("whole"))), F.transform(parts, part("part")), sequences
            )
        ).alias("u"),
    ).select("doc_id", "u.scope", "u.digest")
    known = F.broadcast(known_digests(texts.sparkSession))
    return (
        digests.join(known, "digest")
        .groupBy("doc_id", "license_id", "scope")
        .agg(F.count_distinct("digest").alias("n_units"))
    )
