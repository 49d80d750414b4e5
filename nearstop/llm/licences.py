"""Licence scans: whole texts in canonical form, looked up by digest among known licences."""

from __future__ import annotations

from importlib import resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearstop.scratch import materialise

#: Spellings that licence matching treats as equal, the second standing for both.
EQUIVALENT = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"),
    ("sub license", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("cancelled", "canceled"), ("favour", "favor"), ("fulfilment", "fulfillment"),
    ("judgement", "judgment"), ("labour", "labor"), ("modelling", "modeling"),
    ("noncommercial", "non commercial"), ("offence", "offense"), ("organisation", "organization"),
    ("owner", "holder"), ("owners", "holders"), ("per cent", "percent"), ("practise", "practice"),
    ("recognise", "recognize"), ("whilst", "while"), ("wilful", "willful"), ("http", "https"),
)

_BSD = (
    """Redistribution and use in source and binary forms, with or without modification, are
    permitted provided that the following conditions are met:
    """,
    """Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer.
    """,
    """Redistributions in binary form must reproduce the above copyright notice, this list of
    conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution.
    """,
)
_BSD_NAMES = ("the copyright holder", "the copyright holders", "the author", "the organization",
              "the <organization>", "the University")
_BSD_END = """THIS SOFTWARE IS PROVIDED BY {0} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
    INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
    PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {1} BE LIABLE FOR ANY DIRECT, INDIRECT,
    INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
    PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
    INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
    LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
    THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_PARTIES = (
    ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDER OR CONTRIBUTORS"),
    ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT OWNER OR CONTRIBUTORS"),
    ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS OR CONTRIBUTORS"),
    ("THE REGENTS AND CONTRIBUTORS", "THE REGENTS OR CONTRIBUTORS"),
    ("THE AUTHOR AND CONTRIBUTORS", "THE AUTHOR OR CONTRIBUTORS"),
    ("THE AUTHOR", "THE AUTHOR"),
)


def _bsd(names: tuple[str, ...]) -> list[str]:
    """The usual wordings with numbered and plain points; a third point for each of ``names``."""
    texts = []
    for name in names or (None,):
        points = [*_BSD[1:]]
        if name:
            points.append(
                f"Neither the name of {name} nor the names of its contributors may be used to "
                "endorse or promote products derived from this software without specific prior "
                "written permission.\n"
            )
        for mark in ("{}. ", "* "):
            marked = "".join(mark.format(n) + point for n, point in enumerate(points, 1))
            texts += [_BSD[0] + marked + _BSD_END.format(*p) for p in _BSD_PARTIES]
    return texts


#: Lines that stand before a text or not.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD License",
                     'BSD 2-Clause "Simplified" License', "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "New BSD License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "Zlib": ["zlib License", "The zlib License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
#: The first words of an end that some copies of a text leave out.
APPENDICES = (
    "END OF TERMS AND CONDITIONS",
    "APPENDIX: How to apply", "How to Apply These Terms", "Appendix: How to Apply These Terms",
    "ADDENDUM: How to use this License",
)

#: Public licence notices and short licence texts; long ones are in licence_texts.
KNOWN = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions:

        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.

        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
        FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with
        or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.

        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
        THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
        ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
        OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "BSD-2-Clause": _bsd(()),
    "BSD-3-Clause": _bsd(_BSD_NAMES),
    "0BSD": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with
        or without fee is hereby granted.

        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
        THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
        ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
        OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "Zlib": [
        """This software is provided 'as-is', without any express or implied warranty. In no event
        will the authors be held liable for any damages arising from the use of this software.

        Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following
        restrictions:

        1. The origin of this software must not be misrepresented; you must not claim that you
        wrote the original software. If you use this software in a product, an acknowledgment in
        the product documentation would be appreciated but is not required.
        2. Altered source versions must be plainly marked as such, and must not be misrepresented
        as being the original software.
        3. This notice may not be removed or altered from any source distribution.""",
    ],
    "Unlicense": [
        f"""This is free and unencumbered software released into the public domain.

        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,
        either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.

        In jurisdictions that recognize copyright laws, the author or authors of this software
        dedicate any and all copyright interest in the software to the public domain. We make this
        dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
        all present and future rights to this software under copyright law.

        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES
        OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
        OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.{more}"""
        for more in ("", "\n\nFor more information, please refer to <https://unlicense.org>",
                     "\n\nFor more information, please refer to <https://unlicense.org/>")
    ],
}


#: A line that states a copyright, with its break.
COPYRIGHT_LINE = (
    r"(?m)^[ \t]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|by |[\[<{])|\(c\)[ \t]*[0-9]{4}|©"
    r"|all rights reserved)[^\n]*$"
)


def known_licences(spark: SparkSession) -> DataFrame:
    """The built-in licence texts as rows (licence, text): a fixed list.

    Those of ``KNOWN`` with and without each title, and the files in licence_texts with and without
    the appendix that tells how to use them.
    """
    rows = []
    for name, texts in KNOWN.items():
        for text in texts:
            titles = TITLES.get(name, []) if len(text) > 200 else []
            rows += [{"licence": name, "text": f"{t}\n\n{text}"} for t in titles]
            rows.append({"licence": name, "text": text})
    for file in resources.files(__package__).joinpath("licence_texts").iterdir():
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        ends = [n for n in map(text.find, APPENDICES) if n > 0]
        rows += [{"licence": name, "text": text[:end]} for end in [len(text), *ends]]
    return spark.createDataFrame(pa.Table.from_pylist(rows))


def canonical(text: Column) -> Column:
    """Canonical form of each line of a text.

    Copyright lines go, letters are lower case, everything but letters and digits is a gap, and
    equivalent spellings are one. Words stand between single spaces of their own, so that a
    replacement meets whole words only; line breaks stay.
    """
    lines = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    words = F.regexp_replace(lines, r"[^\p{L}\p{N}\n]+", "  ")
    words = F.concat(F.lit(" "), F.replace(words, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for old, new in EQUIVALENT:
        words = F.replace(words, *[F.lit(f" {w.replace(' ', '  ')} ") for w in (old, new)])
    return words


def digest(words: Column) -> Column:
    """SHA-256 of the words with one space between them; null if there is none."""
    joined = F.trim(F.regexp_replace(words, r"[ \n]+", " "))
    return F.when(joined != "", F.sha2(joined, 256))


def known_digests(known: DataFrame) -> DataFrame:
    """One row per canonical digest: digest, licence (the first by name if texts coincide)."""
    rows = known.select(digest(canonical(F.col("text"))).alias("digest"), "licence")
    return rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("licence").alias("licence"))


def scan_licences(documents: DataFrame, known: DataFrame) -> DataFrame:
    """Find documents that are a known licence, and lines of documents that are one.

    ``documents`` has doc_id and text, ``known`` has licence and text; extra columns are ignored.
    One row per document: doc_id, text_digest, licence (of the whole text, else null) and
    line_licences (sorted names of the licences that whole lines are, joined by commas; null if
    none). A text without letters and digits, an empty one and null have no digest and match
    nothing. Documents that share an id are kept apart; an empty table gives an empty result.
    """
    wanted = known_digests(known)
    digests = documents.select(
        F.monotonically_increasing_id().alias("_nr"), "doc_id",
        canonical(F.col("text")).alias("_words"),
    ).select(
        "_nr", "doc_id", digest(F.col("_words")).alias("text_digest"),
        F.array_distinct(F.array_compact(
            F.transform(F.split("_words", "\n"), digest)
        )).alias("_lines"),
    )
    digests = materialise(digests, "digests")
    lines = digests.select("_nr", F.explode("_lines").alias("digest")).join(wanted, "digest")
    named = lines.groupBy("_nr").agg(
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("line_licences")
    )
    whole = wanted.select(F.col("digest").alias("text_digest"), "licence")
    return digests.select("_nr", "doc_id", "text_digest").join(
        whole, "text_digest", "left"
    ).join(named, "_nr", "left").select("doc_id", "text_digest", "licence", "line_licences")
