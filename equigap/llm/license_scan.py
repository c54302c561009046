"""Licence scans by canonical digest lookup.

A text's canonical form is free of what licences may differ in without being
another licence: case, lines that name the copyright holder, punctuation and
white space, and spellings that count as equivalent.  Its digest is looked up
among those of known licence texts by a hash join, so only whole texts match,
at the cost of 32 bytes a text whatever its length.

The known texts are a frame of (license_id, text); ``known_texts`` makes one
of short public licences, the standard headers of long ones, and the notices
by which works name a licence; ``known_folder`` adds long texts from files.

Defined cases: a null text is empty; a text whose canonical form is empty
matches nothing; if two known texts have one canonical form, the first
licence by name is found; rows that repeat an id are rows of their own; an
empty table gives an empty result.  Other columns are kept by ``matches``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import Scratch

# Spellings that count as equal (from, to).
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("noncommercial", "non  commercial"), ("cooperation", "co  operation"),
    ("sublicence", "sublicense"), ("sublicences", "sublicenses"), ("https", "http"),
)

# Licences and the names that notices use for them.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2", "GPL 2.0", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3", "GPL 3.0", "GPLv3"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "LGPL 3.0", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3", "AGPL 3.0", "AGPLv3"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
}
NOTICES = ("{}", "Licensed under {}.", "Licensed under the {}.", "Released under {}.", "Released under the {}.", "Distributed under {}.",
           "Distributed under the {}.", "This work is licensed under {}.", "This work is licensed under the {}.", "Available under {}.",
           "Available under the {}.")

# Public licence texts.
WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_GRANT = """Copyright (c) the copyright holder

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu_header(name: str, version: str) -> str:
    return f"""This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free
Software Foundation, either version {version} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.

You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."""


TEXTS = {
    "MIT": f"""MIT License

Copyright (c) the copyright holder

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

{WARRANTY}""",
    "ISC": f"""ISC License

Copyright (c) the copyright holder

{ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.

{ISC_WARRANTY}""",
    "0BSD": f"""Zero-Clause BSD

Copyright (c) the copyright holder

{ISC_GRANT}.

{ISC_WARRANTY}""",
    "Zlib": """zlib License

Copyright (c) the copyright holder

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": f"BSD 2-Clause License\n\n{BSD_GRANT}\n\n{BSD_WARRANTY}",
    "BSD-3-Clause": f"""BSD 3-Clause License

{BSD_GRANT}

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission.

{BSD_WARRANTY}""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>""",
    "BSL-1.0": """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to
prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the
following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following
disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such
copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE
DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    # The standard headers of long licences.
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "GPL-3.0": _gnu_header("GNU General Public License", "3"),
    "LGPL-3.0": _gnu_header("GNU Lesser General Public License", "3"),
    "AGPL-3.0": _gnu_header("GNU Affero General Public License", "3"),
    "GPL-2.0": _gnu_header("GNU General Public License", "2"),
}


#: Lines that name the holder, in lower case: comment marks, then copyright, (c)
#: or © and a year, another of these, or a holder; not wrapped lines of a licence
#: that go on with "copyright notice" or the like, nor items "(c) you must".
MARKS = r"[ \t]*(?:(?://+|/?\*+|#+|;+|--+|<!--|%+|!+)[ \t]*)*"
NO_HOLDER = (r"(?:notices?|holders?|owners?|licen[sc]es?|laws?|statements?|interests?|claims?|rights?|disclaimers?|permissions?|protections?|treaty|"
             r"and|or|in|on|of|to|for|is|are|as|that|which|with|under|from|may|shall|will|would|can)\b")
NO_ITEM = r"(?:you|your|the|this|these|those|that|any|all|each|an?|if|to|in|on|for|no|not|such|or|and|of|by|must|prohibiting|accompany|convey)\b"
HOLDER_LINE = (rf"(?m)^{MARKS}(?:copyright[ \t]*[:,]?[ \t]*(?!{NO_HOLDER})(?:\(c\)|©|[\p{{L}}\p{{N}}<\[{{])|"
               rf"(?:\(c\)|©)[ \t]*(?:copyright[ \t]+)?(?!{NO_ITEM}|{NO_HOLDER})[\p{{L}}\p{{N}}<\[{{])[^\n]*$")


def canonical_lines(text: Column) -> Column:
    """The canonical forms of the text's lines, without empty ones: lower case,
    no lines that name the copyright holder, words of letters and digits with one space between,
    equivalent spellings as one."""
    text = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    text = F.regexp_replace(text, HOLDER_LINE, " ")
    # Two spaces between words while spellings are replaced, so that neighbours share none.
    text = F.replace(F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", "  "), F.lit("\n"), F.lit("  \n  "))
    text = F.concat(F.lit("  "), text, F.lit("  "))
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(f" {old} "), F.lit(f" {new} "))
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.replace(x, F.lit("  "), F.lit(" "))))
    return F.filter(lines, lambda x: x != "")


def canonical(text: Column) -> Column:
    """The whole text's canonical form."""
    return F.array_join(canonical_lines(text), " ")


def known_texts(spark: SparkSession) -> DataFrame:
    rows = [*TEXTS.items(), *((k, notice.format(name)) for k, names in NAMES.items() for name in names for notice in NOTICES)]
    return spark.createDataFrame(rows, "license_id string, text string")


def known_folder(spark: SparkSession, path: str) -> DataFrame:
    """Known texts from a folder of whole licences, one file each, its name
    without .txt or .md being the license_id; with ``known_texts``."""
    files = spark.read.text(path, wholetext=True)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.(?:txt|md)$", "")
    return files.select(name.alias("license_id"), F.col("value").alias("text")).union(known_texts(spark))


def known_digests(known: DataFrame) -> DataFrame:
    digests = known.select("license_id", canonical(F.col("text")).alias("c")).where("c != ''")
    return digests.groupBy(F.sha2("c", 256).alias("known_sha256")).agg(F.min("license_id").alias("license_id"))


def matches(texts: DataFrame, known: DataFrame, text_col: str = "text") -> DataFrame:
    """``texts`` without ``text_col``, with canonical_sha256 and license_id (null
    if its whole text is none of the known)."""
    digests = known_digests(known)
    own = texts.withColumn("canonical_sha256", F.sha2(canonical(F.col(text_col)), 256)).drop(text_col)
    return own.join(digests, F.expr("canonical_sha256 = known_sha256"), "left").drop("known_sha256")


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row, its whole text and each of its lines looked up:
    ``id_col``, canonical_sha256, license_id, n_license_lines, line_licenses."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "licenses")
    known = scratch.write(known_texts(spark) if known is None else known.select("license_id", "text"), "known")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), canonical_lines(F.col(text_col)).alias("l"))
    # One pass over the texts: digests of the whole and of each line.
    digests = scratch.write(rows.select("row", "id", F.sha2(F.array_join("l", " "), 256).alias("canonical_sha256"),
                                        F.transform("l", lambda x: F.sha2(x, 256)).alias("lines")), "digests")
    known = known_digests(known)
    lines = digests.select("row", F.explode("lines").alias("line_sha256")).join(known, F.expr("line_sha256 = known_sha256"))
    found = lines.groupBy("row").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("names"))
    found = scratch.write(found.withColumnRenamed("row", "l_row"), "lines")
    whole = digests.join(known, F.expr("canonical_sha256 = known_sha256"), "left")
    return whole.join(found, F.expr("row = l_row"), "left").select(
        F.col("id").alias(id_col), "canonical_sha256", "license_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_license_lines"),
        F.coalesce("names", F.lit("")).alias("line_licenses"))
