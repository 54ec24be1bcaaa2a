"""Licence scan: texts in a canonical form, looked up by digest among known licence texts."""

from __future__ import annotations

import pkgutil
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence texts and notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_LONG = {"Apache-2.0": "Apache-2.0", "MPL-2.0": "MPL-2.0", "GPL-2.0-only": "GPL-2", "GPL-3.0-only": "GPL-3",
         "LGPL-2.1-only": "LGPL-2.1", "LGPL-3.0-only": "LGPL-3", "CC0-1.0": "CC0-1.0"}


def _long_texts() -> list[tuple[str, str]]:
    """(license_id, text) of the files of this package, also without what follows the end of terms."""
    out = []
    for license_id, name in _LONG.items():
        text = pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode("utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(license_id, text)] + ([(license_id, terms), (license_id, terms + end)] if end else [])
    return out


KNOWN = (
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", _MIT),
    ("ISC", "ISC License\n\n" + _ISC),
    ("ISC", _ISC),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-2-Clause", _BSD_2 + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_2 + _BSD_END),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_2 + _BSD_3 + _BSD_END),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org>"),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <http://unlicense.org/>"),
    *_long_texts(),
)
# Spellings that count as one.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"), ("per cent", "percent"),
    ("whilst", "while"), ("favour", "favor"), ("honour", "honor"), ("labour", "labor"), ("programme", "program"),
    ("judgement", "judgment"), ("fulfil ", "fulfill "), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("merchantibility", "merchantability"), ("wilful", "willful"),
)
#: A line that names a holder or a year of copyright anywhere, or reserves rights.
COPYRIGHT_LINE = (r"(^|\n)([ \t\r]*(\(c\)|©|all rights reserved)[^\n]*|[^\n]*copyright[^\n]*(\(c\)|©|[0-9]{4})[^\n]*"
                  r"|[^\n]*(\(c\)|©|[0-9]{4})[^\n]*copyright[^\n]*)")
PUNCTUATION = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The text in canonical form, line by line: lower case, no copyright lines, words one space apart."""
    out = F.lower(F.coalesce(text, F.lit("")))
    some = reduce(lambda a, b: a | b, [out.contains(x) for x in ("copyright", "(c)", "©", "all rights reserved")])
    out = F.when(some, F.regexp_replace(out, COPYRIGHT_LINE, "$1")).otherwise(out)  # no other text has such a line
    out = F.regexp_replace(out, PUNCTUATION, " ")
    for other, ours in SPELLINGS:
        out = F.replace(out, F.lit(other), F.lit(ours))
    return out


def canonical(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """(known_digest, license_id) of known (license_id, text) rows; of equal texts the first id in order stays."""
    known = spark.createDataFrame(list(KNOWN), "license_id string, text string") if known is None else known
    return (known.select("license_id", digest(canonical(canonical_lines(F.col("text")))).alias("known_digest"))
            .where(F.col("known_digest") != digest(F.lit(""))).groupBy("known_digest").agg(F.min("license_id").alias("license_id")))


def scan(docs: DataFrame, known: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its digest, the licence that its entire text is, and the licences that entire lines are.

    known has (license_id, text) rows; without it a few public licences and notices are used. license_id is null
    where the whole text is no known licence. notice_ids lists in order, separated by commas, the licences of
    whole lines. Null and empty texts, and texts of copyright lines alone, have the
    digest of the empty text and match nothing. Repeated rows stay; rows that share id and canonical text
    share their notices. Other columns are ignored. An empty table gives no rows.
    """
    table = known_digests(docs.sparkSession, known)
    lined = docs.select(F.col(id_col).alias("id"), canonical_lines(F.col(text_col)).alias("lines"))
    base = lined.select("id", digest(canonical(F.col("lines"))).alias("digest"), "lines")
    notices = (base.select("id", "digest", F.explode(F.split("lines", "\n")).alias("line"))
               .select("id", "digest", F.trim("line").alias("line")).where("line <> ''")
               .join(table, digest(F.col("line")) == F.col("known_digest")).select("id", "digest", "license_id").distinct()
               .groupBy(F.col("id").alias("nid"), F.col("digest").alias("ndigest"))
               .agg(F.concat_ws(",", F.array_sort(F.collect_list("license_id"))).alias("notice_ids")))
    return (base.select("id", "digest").join(table, F.col("digest") == F.col("known_digest"), "left")
            .join(notices, F.col("id").eqNullSafe(F.col("nid")) & (F.col("digest") == F.col("ndigest")), "left")
            .select(F.col("id").alias(id_col), "digest", "license_id", F.coalesce("notice_ids", F.lit("")).alias("notice_ids")))
