"""Licence scans by canonical digest.

A text is brought to one canonical form (case, punctuation, copyright notices, equivalent spellings, any
wrapping of lines), and the digest of the entire form is joined with the digests of known licences.  The lines of a text are
looked up the same way, since a licence notice is an entire text of one line.  Only built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curveloom.llm.license_table import full_table

# fixed values: spellings that count as equal, and known licence texts and notices
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("behaviour", "behavior"), ("favour", "favor"), ("fulfilment", "fulfillment"), ("honour", "honor"),
    ("labour", "labor"), ("licence", "license"), ("non commercial", "noncommercial"), ("organisation", "organization"),
    ("per cent", "percent"), ("recognised", "recognized"), ("sub license", "sublicense"), ("whilst", "while"),
    ("https", "http"),
)
MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """ISC License

Copyright <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
ZLIB = """zlib License

Copyright (C) <year> <owner>

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
KNOWN = (
    ("MIT", MIT),
    ("MIT", MIT.split("\n", 1)[1]),  # without its title
    ("ISC", ISC),
    ("ISC", ISC.split("\n", 1)[1]),
    ("Zlib", ZLIB),
    ("Zlib", ZLIB.split("\n", 1)[1]),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
)

#: known texts up to this number are sent to all tasks as digests and names; more of them are joined by a shuffle
BROADCAST_TEXTS = 100_000
#: all that is neither letter, digit nor line end becomes a blank
PUNCTUATION = r"[^\p{L}\p{N}\n]+"
#: any line that opens like a notice: what the SQL removes, equal on texts without such lines inside paragraphs
COPYRIGHT_LINE = r"(^|\n)[ \t/*#;%!-]*(copyright|\(c\)|©)[^\n]*"
#: what the canonical form removes: notices at the start of a paragraph or after a title, never inside one
_EDGE = r"[ \t\r\f/*#;%!-]*"
#: the foundation's notice over its own licences shares a paragraph with text and is the same in every copy: it stays
_OWN = r"(?!copyright[^\p{L}]+c[^\p{L}]+free[^\p{L}]+software[^\p{L}]+foundation[\s\S]{0,200}?everyone[^\p{L}]+is[^\p{L}]+permitted)"
_NOTICE = _OWN + (
    r"(?:copyright[ \t:,]*(?:\(c\)|©|&copy;|\d{4}|[<\[{]|by\b|yyyy|year\b)|\(c\)[ \t]*(?:copyright|\d{4}|[<\[{]|by\b)|©)[^\n]*"
    # "all rights reserved" that begins on its line ends with it
    rf"(?:(?<=\ball rights[ \t\r]{{0,2}})\n{_EDGE}reserved\.?|(?<=\ball[ \t\r]{{0,2}})\n{_EDGE}rights[ \t]+reserved\.?)?"
)
_TITLE = r"[^\n]{0,60}licen[cs]e[^\n]{0,20}(?:\n[ \t\r=*~#-]+)?"
#: the group is repeated possessively: nothing follows it, and the matcher then loops over notices instead of recursing
NOTICES = rf"(\n{_EDGE}(?:\n{_TITLE})?)(?:\n{_EDGE}{_NOTICE})++"
#: weaker ones (a name, but no year), which must be a paragraph of one line
LONE_NOTICE = rf"(\n{_EDGE})\n{_EDGE}{_OWN}(?:copyright[ \t:][^\n]*|\(c\)[ \t]+[^\n]{{0,60}}[^\n.;:,](?<! and)(?<! or))(?=\n{_EDGE}(?:\n|\z))"


def canonical_lines(text: Column) -> Column:
    """The lines of ``text`` in canonical form, those that are then empty left out."""
    # blank lines around it give the first and the last paragraph the same edges as others
    plain = F.concat(F.lit("\n\n"), F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit("\n\n"))
    plain = F.regexp_replace(F.regexp_replace(plain, NOTICES, "$1"), LONE_NOTICE, "$1")
    plain = F.regexp_replace(plain, PUNCTUATION, " ")
    for other, chosen in SPELLINGS:
        plain = F.replace(plain, F.lit(other), F.lit(chosen))
    return F.filter(F.transform(F.split(plain, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def canonical_form(lines: Column) -> Column:
    """The entire text as one line; spellings of two words are also found where a line ended between them."""
    form = F.array_join(lines, " ")
    for other, chosen in SPELLINGS:
        if " " in other:
            form = F.replace(form, F.lit(other), F.lit(chosen))
    return form


def known_licenses(spark: SparkSession) -> DataFrame:
    """The notices of ``KNOWN`` and the whole texts, headers and SPDX tags of ``license_table``."""
    return spark.createDataFrame([*KNOWN, *full_table()], "license string, text string")


def licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per document: doc_id, digest, license, n_notices, notices.

    digest is the SHA-256 of the entire canonical text; license names the one of ``known(license, text)``
    with that digest, the first by name if several, else NULL.  notices has the sorted names of licences
    that a line of the text equals, comma-joined (empty: none), n_notices how many lines do.  A NULL
    or empty text has the digest of the empty string, which no licence has; rows that repeat a doc_id are
    scanned each, and no other column is read.
    """
    entries = (
        known.select("license", canonical_lines(F.col("text")).alias("lines"))
        .select("license", canonical_form(F.col("lines")).alias("form"))
        .where("form <> ''")
        .groupBy(F.sha2("form", 256).alias("key")).agg(F.min("license").alias("name"), F.first(F.length("form")).alias("size"))
    )
    # only lines as long as a known text can have its digest; a set of numbers, at most one per known text
    sizes, held = entries.agg(F.sort_array(F.collect_set("size")), F.count("*")).first()
    scanned = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), canonical_lines(F.col("text")).alias("lines")
    ).select(
        "doc_id",
        F.sha2(canonical_form(F.col("lines")), 256).alias("digest"),
        F.transform(
            F.filter("lines", lambda line: F.length(line).isin(sizes)), lambda line: F.sha2(line, 256)
        ).alias("keys"),
    )
    names = entries.select("key", "name")
    if held <= BROADCAST_TEXTS:
        names = F.broadcast(names)
    whole = scanned.join(names.select(F.col("key").alias("digest"), F.col("name").alias("license")), "digest", "left")
    quiet = whole.where(F.size("keys") == 0).select(
        "doc_id", "digest", "license", F.lit(0).cast("long").alias("n_notices"), F.lit("").alias("notices")
    )
    # a row is told from others with its doc_id by a number that follows the scan
    lines = whole.where(F.size("keys") > 0).withColumn("row", F.monotonically_increasing_id())
    found = (
        lines.select("doc_id", "digest", "license", "row", F.explode("keys").alias("key"))
        .join(names, "key", "left")
        .groupBy("row", "doc_id", "digest", "license")
        .agg(F.count("name").alias("n_notices"), F.array_join(F.sort_array(F.collect_set("name")), ",").alias("notices"))
        .drop("row")
    )
    return quiet.union(found)
