"""Licence scan by canonical digests.

A text is brought to a canonical form (case, white space, punctuation, copyright notices at its head
and equivalent spellings do not matter) and looked up by its digest among known licences: whole texts
first, then line by line for notices, then by blocks between blank lines for grants within a text. The
table of known digests is a parameter of some dozens of rows and is broadcast; all else stays in place
but the few lines and blocks that hit.

Null and empty texts have no licence, repeated rows are scanned each, very long texts are scanned whole, and an
empty table gives an empty result; of several licences with one digest the name that sorts first is given; columns other than doc_id and text are not looked at. Built-in expressions only.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.llm.text import row_key

# Licence texts and one-line notices with their SPDX identifiers.
MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
NO_CONDITION_GRANT = ISC_GRANT.replace(
    "granted, provided that the above copyright notice and this permission notice appear in all copies.", "granted."
)
_REDISTRIBUTION = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_2 = _REDISTRIBUTION + _BSD_DISCLAIMER
BSD_3 = _REDISTRIBUTION + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
""" + _BSD_DISCLAIMER
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of
the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by
a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def _gnu(name: str, license: str, version: str) -> list[tuple[str, str]]:
    """The header of a GNU licence in its usual wordings, whole and its first paragraph."""
    out = []
    for thing in ("program", "library"):
        grant = (
            f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {license}\n"
            f"as published by the Free Software Foundation, either version {version} of the License, or (at your option) any\n"
            "later version."
        )
        rest = (
            f"\n\nThis {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the\n"
            f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {license}\nfor more details."
            f"\n\nYou should have received a copy of the GNU {license} along with this {thing}. If not, see\n"
            "<https://www.gnu.org/licenses/>."
        )
        out += [(name, grant), (name, grant + rest)]
    return out


GNU_HEADERS = (
    *_gnu("GPL-3.0-or-later", "General Public License", "3"),
    *_gnu("GPL-2.0-or-later", "General Public License", "2"),
    *_gnu("LGPL-3.0-or-later", "Lesser General Public License", "3"),
    *_gnu("LGPL-2.1-or-later", "Lesser General Public License", "2.1"),
    *_gnu("AGPL-3.0-or-later", "Affero General Public License", "3"),
)


def _listed(name: str, title: str, text: str) -> list[tuple[str, str]]:
    """A text with and without its title, its items numbered, as bullets, and as bullets without blank lines."""
    bullets = re.sub(r"(?m)^[0-9]\. ", "* ", text)
    tight = re.sub(r"\n\n(?=\* )", "\n", bullets)
    return [(name, x) for t in dict.fromkeys((text, bullets, tight)) for x in (t, f"{title}\n\n{t}")]


KNOWN = (
    *_listed("0BSD", "BSD Zero Clause License", NO_CONDITION_GRANT),
    *_listed("0BSD", "Zero-Clause BSD", NO_CONDITION_GRANT)[1:],
    *_listed("BSD-2-Clause", "BSD 2-Clause License", BSD_2),
    *_listed("BSD-3-Clause", "BSD 3-Clause License", BSD_3),
    *_listed("Zlib", "zlib License", ZLIB),
    ("Unlicense", UNLICENSE),
    ("BSL-1.0", BOOST),
    ("Apache-2.0", APACHE_HEADER),
    ("MPL-2.0", MPL_HEADER),
    *GNU_HEADERS,
    ("MIT", "MIT License\n\n" + MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT_GRANT),
    ("MIT", MIT_GRANT),
    ("ISC", "ISC License\n\n" + ISC_GRANT),
    ("ISC", ISC_GRANT),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Digests of the canonical forms of long texts, as in Debian's common-licenses, with their notices'
# line breaks; these texts are not stated here.
DIGESTS: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "a4f874aaeee4dfe824fb3cc3dcca2009"),
    ("CC0-1.0", "d2a76f70ce19809695b7fb93c6241c23"),
    ("GPL-2.0-only", "3a2d500995598629cd4346a26c77be91"),
    ("GPL-3.0-only", "9404a81de6e695833b9fafe2290e4f64"),
    ("LGPL-2.1-only", "4f4bacc6ad721925aa797a35132950f0"),
    ("LGPL-3.0-only", "b31b7335bc37919e8cdd79154e04d88d"),
    ("MPL-1.1", "9fa8ae3e869a929215034d82982372b5"),
    ("MPL-2.0", "bba58d76f66dd9d890110b970536045e"),
)
# Spellings that mean the same, as (pattern over canonical words, written as).
SPELLINGS = (
    (r"\blicence", "license"),
    (r"\b(?:v|ver|version) ?([0-9])", "version $1"),
    (r"\bcopyright holders?\b", "copyright owner"),
    (r"\bneither the name of .{1,1000}? nor the names of its contributors\b", "neither the name nor the names"),
    (r"\bsub license", "sublicense"),
    (r"\bnon infringement\b", "noninfringement"),
    (r"\b(?:https?)\b", "http"),
)
# A notice is a line of the text's head: at most five lines below its start or below another notice.
# Body lines that happen to begin with the word copyright are none.
_JUNK = r"[^\p{L}\p{N}\n©]*+"
_BODY = r"permission (?:is hereby|to use)|redistribution and use|everyone is permitted|licen[sc]ed under"
NOTICE = (
    r"(?i)\G((?:[^\n]*+\n){0,5}?)" + _JUNK
    + r"(?:(?:copyright[ \t]*(?:\(c\)|©|[,:]?[ \t]*[\[<{(]?(?:[12][0-9]{3}\b|yyyy|year))|©|(?<=\()c\)[ \t]*[12][0-9]{3}\b)"
    + r"(?:(?!" + _BODY + r")[^\n])*+|all rights reserved[^\p{L}\p{N}\n]*+(?=\n|\z))"
)
_BLANK = r"[^\p{L}\p{N}\n]*+\n"  # the rest of a line without words, as in empty lines of a comment
BLOCK = rf"\n(?:{_BLANK})+|\n(?=[^\p{{L}}\p{{N}}\n]*+[0-9]{{1,2}}[.)][ \t])"  # between blocks, and before numbered items


def canonical(text: Column) -> Column:
    out = F.lower(F.regexp_replace(text, NOTICE, "$1"))
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for pattern, written in SPELLINGS:
        out = F.regexp_replace(out, pattern, written)
    return out


def block_forms(text: Column) -> Column:
    """The canonical forms of a text's blocks, those without words left out."""
    return F.filter(F.transform(F.split(text, BLOCK), canonical), lambda x: x != "")


def touched_words() -> set[str]:
    """Words that the equivalent spellings change or write."""
    return {w for pair in SPELLINGS for side in pair for w in re.findall(r"[a-z]+", side.lower())} | {"license", "licence", "sublicense", "names"}


def marks(known: Sequence[tuple[str, str]]) -> str:
    """A pattern that every text with one of the known ones in it matches: the longest word of each, as it stands there.

    Words that spellings may change, or that a notice at the head may take away, do not count. If a known text has no
    other word, the pattern matches everything.
    """
    found = set()
    for _, text in known:
        body = [line for line in text.lower().split("\n") if "copyright" not in line and "rights reserved" not in line and "©" not in line]
        words = {w for line in body for w in re.findall(r"[^\W\d_]+", line) if w.isascii()} - touched_words()
        found.add(max(sorted(words), key=len, default=""))
    return "" if "" in found or not found else "(?iu)" + "|".join(sorted(found))


def known_texts(spark: SparkSession, known: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(
        [(i, name, text) for i, (name, text) in enumerate(known)], "text_id int, license string, text string"
    )


def known_digests(
    spark: SparkSession, known: Sequence[tuple[str, str]] = KNOWN, digests: Sequence[tuple[str, str]] = DIGESTS
) -> DataFrame:
    """(known digest, license), one row a digest: fixed, some dozens of rows."""
    found = known_texts(spark, known).select(F.md5(canonical(F.col("text"))).alias("known"), "license")
    if digests:
        found = found.union(spark.createDataFrame(list(digests), "license string, known string").select("known", "license"))
    return found.groupBy("known").agg(F.min("license").alias("license"))


def known_blocks(spark: SparkSession, known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """(known digest, text_id, nth, blocks, license) of every block of every known text."""
    return (
        known_texts(spark, known).withColumn("forms", block_forms(F.col("text")))
        .select("text_id", "license", F.size("forms").alias("blocks"), F.posexplode("forms").alias("nth", "form"))
        .select(F.md5("form").alias("known"), "text_id", "nth", "blocks", "license")
    )


def scan_licenses(
    docs: DataFrame, known: Sequence[tuple[str, str]] = KNOWN, digests: Sequence[tuple[str, str]] = DIGESTS
) -> DataFrame:
    """doc_id, digest of the whole text, its license, the licences that its lines name, and the grants in it.

    ``license`` is null if the whole text is no known licence. Lines and blocks are looked up where
    the text has a word that a text of ``known`` has, see ``marks``. ``grants`` are the licences of which all blocks
    stand in the text one after the other, whatever is around them. ``known`` has (license, text); ``digests``
    has (license, md5 of the canonical form) of whole texts, and is not asked for lines. A digest of several
    licences gives the name that sorts first.
    """
    spark = docs.sparkSession
    table = F.broadcast(known_digests(spark, known, digests))
    rows = docs.select(
        "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text")
    )
    whole = (
        rows.withColumn("form", canonical(F.col("text")))
        .select("doc_id", "key", F.when(F.col("form") != "", F.md5("form")).alias("digest"))
        .join(table, F.col("digest") == F.col("known"), "left").drop("known")
    )
    pattern = F.lit(marks(known))
    line = F.explode(F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, pattern)))
    notices = (
        rows.select("doc_id", "key", line.alias("line"))
        .select("doc_id", "key", F.md5(canonical(F.col("line"))).alias("digest"))
        .join(F.broadcast(known_digests(spark, known, ())), F.col("digest") == F.col("known"))
        .select("doc_id", "key", F.col("license").alias("notice"), F.lit(None).cast("string").alias("granted"))
    )
    grants = (
        rows.filter(F.regexp_like("text", pattern))
        .select("doc_id", "key", F.posexplode(block_forms(F.col("text"))).alias("pos", "form"))
        .select("doc_id", "key", "pos", F.md5("form").alias("digest"))
        .join(F.broadcast(known_blocks(spark, known)), F.col("digest") == F.col("known"))
        .groupBy("doc_id", "key", "text_id", "blocks", "license", (F.col("pos") - F.col("nth")).alias("start"))
        .agg(F.collect_set("nth").alias("there")).filter(F.size("there") == F.col("blocks"))
        .select("doc_id", "key", F.lit(None).cast("string").alias("notice"), F.col("license").alias("granted"))
    )
    found = notices.union(grants).groupBy("doc_id", "key").agg(
        F.array_join(F.array_sort(F.collect_set("notice")), ",").alias("notices"),
        F.array_join(F.array_sort(F.collect_set("granted")), ",").alias("grants"),
    )
    same = F.col("w.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("w.key") == F.col("n.key"))
    return whole.alias("w").join(found.alias("n"), same, "left").select(
        "w.doc_id", "w.digest", "w.license", F.coalesce("n.notices", F.lit("")).alias("notices"),
        F.coalesce("n.grants", F.lit("")).alias("grants"),
    )
