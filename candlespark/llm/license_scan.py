"""Licence texts found by the digest of a canonical form.

A text is canonical after: ASCII letters in lower case, copyright lines removed, equivalent spellings unified,
every run of other characters than letters and digits one space, and the holder's name in BSD terms unified. The whole
text's SHA-256 is hash-joined to the digests of known licences: the full texts in ``licenses`` and below, with and
without titles and appendices. The same lookup serves single lines, where notices such as "Released under ..." stand.

A copyright line starts with a copyright mark, with or without a year, or holds a mark and a year. Lines that start
with the word inside a sentence of a licence ("copyright notice and ...") stay, so that texts may be wrapped anywhere.

Edge cases: null and empty texts have the digest of the empty text and no licence. Repeated rows stay repeated.
Extra columns pass through; result columns take the place of input columns of the same name.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings, by the public guidelines for matching licence texts.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("favour", "favor"), ("honour", "honor"), ("fulfil", "fulfill"), ("https", "http"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labour", "labor"), ("merchantability", "merchantability"), ("modernise", "modernize"),
    ("noncommercial", "non commercial"), ("owner", "holder"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
# Short licences with their titles; bullets in place of numbers are common in the BSD terms.
_SHORT = (
    ("MIT", _MIT, ("The MIT License", "MIT License", "The MIT License (MIT)")),
    ("ISC", _ISC, ("ISC License", "The ISC License")),
    ("BSD-2-Clause", _BSD_2 + _BSD_END, ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License')),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_END, ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License')),
)
#: Where the appendix of a long text starts, which copies often leave out.
_APPENDICES = ("APPENDIX: How to apply", "How to Apply These Terms", "Appendix: How to Apply", "ADDENDUM: How to use")


def _full_texts() -> list[tuple[str, str]]:
    """Licences and their full texts in all usual forms."""
    out = []
    for name, body, titles in _SHORT:
        bodies = (body, body.replace("\n1. ", "\n* ").replace("\n2. ", "\n* ").replace("\n3. ", "\n* "))
        out += [(name, f"{title}\n{rights}\n{x}") for title in ("", *titles) for rights in ("", "All rights reserved.") for x in bodies]
    for file in sorted(files(__package__).joinpath("licenses").iterdir(), key=lambda x: x.name):
        if file.name.endswith(".txt"):
            name, body = file.name.removesuffix(".txt"), file.read_text("utf-8")
            out.append((name, body))
            out += [(name, body[: body.index(x)]) for x in _APPENDICES if x in body]
    return out


# Known licence texts and notices.
KNOWN = (
    ("MIT", _MIT), ("MIT", "The MIT License\n\n" + _MIT), ("MIT", "MIT License\n\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC0-1.0", "Licensed under CC0 1.0."),
    ("proprietary", "All rights reserved."),
    *_full_texts(),
)
#: Words after "copyright" inside the sentences of licences, and after "(c)" as a list mark.
SENTENCE = "holders?|owners?|ownership|notices?|laws?|licen[cs]es?|permissions?|disclaimers?|interests?|statements?|treaty|doctrines|and|or|on|of|in|is|are|if|resulting|the software|the library"
ITEM = "you must|under patent|the licen[cs]es|representations"
#: The rest of a line that starts with a copyright mark.
MARKED = rf"[^\n\p{{L}}\p{{N}}(©]*(?:©|\(c\)(?=[ \t]*[^ \t\r\n])(?![ \t]*(?:{ITEM})\b)|copyright[ \t:]+(?!(?:{SENTENCE})\b)[^ \t\r\n])"
#: Places where BSD terms name the holder.
HOLDERS = (
    (r"neither the names? of [^\n]{1,200}? nor the names of (?:(?:its|his|her|their|any|other) )*contributors ", "neither the name of the copyright holder nor the names of its contributors "),
    (r"provided by [^\n]{1,200}? as is and any express ", "provided by the copyright holders and contributors as is and any express "),
    (r"in no event shall [^\n]{1,200}? be liable for any direct ", "in no event shall the copyright holder or contributors be liable for any direct "),
)


def canonical(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    kept = F.regexp_replace(lower, rf"(?:^|\n)(?:[^\n]*(?:copyright|\(c\)|©)[^\na-z]{{0,8}}(?:19|20)[0-9][0-9]|{MARKED})[^\n]*", "\n")
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(kept, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    # The separator is doubled, so that equal neighbours are all found.
    plain = F.replace(plain, F.lit(" "), F.lit("  "))
    for old, new in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {old} "), F.lit(f" {new} "))
    plain = F.regexp_replace(plain, " +", " ")
    named = plain
    for pattern, fixed in HOLDERS:
        named = F.regexp_replace(named, pattern, fixed)
    return F.trim(F.when(F.contains(plain, F.lit(" redistributions of source code ")), named).otherwise(plain))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    return spark.createDataFrame(list(known), "license_id string, body string").select("license_id", digest(F.col("body")).alias("digest")).distinct()


def scan(docs: DataFrame, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """Adds ``canonical_sha256``, ``license_id`` of the whole text (or null) and ``notices`` of its lines."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # The relation has a row per known text: its size does not depend on the data. Digests are computed once.
    digests = [(r.digest, r.license_id) for r in known_digests(docs.sparkSession, known).collect()]
    table = docs.sparkSession.createDataFrame(digests, "digest string, license_id string")
    marked = docs.select(row.alias("packed_row"), digest(F.col("text")).alias("digest"), "text")
    joined = marked.join(F.broadcast(table), "digest", "left")
    lookup = F.create_map(*[F.lit(x) for pair in digests for x in pair])
    likely = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"(?i)licen[cs]e|reserved"))
    names = F.array_sort(F.array_distinct(F.array_compact(F.transform(likely, lambda x: lookup[digest(x)]))))
    out = joined.select("packed_row", F.col("digest").alias("canonical_sha256"), "license_id", names.alias("notices"))
    new = ("canonical_sha256", "license_id", "notices")
    return out.select(*[F.col(f"packed_row.`{c}`") for c in docs.columns if c.lower() not in new], *new)
