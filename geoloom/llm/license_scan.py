"""Licence scan by canonical digests, in DataFrame functions only.

Every text, and every line of it, is brought to a canonical form (ASCII lower case; copyright lines dropped; punctuation
to single spaces; equivalent spellings folded), and its SHA-256 is hash-joined to the digests of known licence texts.
A licence that is the whole of a text and a notice that is the whole of a line are both found; parts of a line are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import picked
from .license_digests import DIGESTS

#: Known digests up to this many are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000

# Equivalent spellings, as whole words of the canonical form.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("authorised", "authorized"), ("recognised", "recognized"), ("modernised", "modernized"), ("initialise", "initialize"),
    ("favour", "favor"), ("favourite", "favorite"), ("honour", "honor"), ("labour", "labor"), ("fulfil", "fulfill"), ("whilst", "while"), ("wilful", "willful"),
    ("noncommercial", "non commercial"), ("http", "https"), ("owner", "holder"), ("owners", "holders"), ("percent", "per cent"), ("judgement", "judgment"),
]

# Licence notices of one line, and short licence texts.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
]

# A line that only names a holder, by its lower-case form with a year or sign, or by the word Copyright and words each of which can belong to a holder's name; characters that never tell licences apart. No pattern repeats a group, as Java's matcher recurses for each time. Both regular-expression dialects read them alike.
COPYRIGHT_LINE = r"^[ \t/*#;%-]*((copyright|\(c\)|©|&copy;)[ \t]*(\(c\)|©|&copy;|[0-9<\[{])|©|all rights reserved)[^\n]*$"
HOLDER_START = r"^[ \t/*#;%-]*Copyright[ \t]"
HOLDER_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x7F][^\x00-\x25\x28-\x2C\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[.,;:]*|(all|and|author|authors|by|community|contributor|contributors|de|den|der|developers|et|from|its|la|of|or|original|other|others|project|reserved|rights|team|the|van|von)[.,;:]*|&|https?://[^ \t\r]+|<[^ \t\r<>]+>[.,;:]*|\([^ \t\r()]+\)[.,;:]*"
#: Longer lines are no holder lines.
HOLDER_LENGTH = 10_000
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F«»‐‑‒–—―‘’“”„…©®™]+"


def names_holder(line: Column) -> Column:
    """Whether a line is the word Copyright with a holder's name, of which each word is judged alone."""
    words = F.filter(F.split(F.regexp_replace(line, HOLDER_START, ""), "[ \t\r]+"), lambda w: w != "")
    return line.rlike(HOLDER_START) & (F.length(line) <= HOLDER_LENGTH) & (F.size(words) > 0) & F.forall(words, lambda w: w.rlike(f"^({HOLDER_WORD})$"))


def canonical_line(line: Column) -> Column:
    """The canonical form of one line; empty for lines that only name a copyright holder."""
    low = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    kept = F.when(low.rlike(COPYRIGHT_LINE) | names_holder(line), F.lit("")).otherwise(low)
    words = F.concat(F.lit(" "), F.regexp_replace(kept, PUNCTUATION, " "), F.lit(" "))
    for old, new in SPELLINGS:
        words = F.replace(words, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(F.regexp_replace(words, " +", " "))


def known_digests(spark: SparkSession, notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license_id) of known texts, by default NOTICES and DIGESTS; where texts of two licences are alike, the first name in order stands."""
    rows = F.array(*(F.struct(F.lit(k).alias("license_id"), F.lit(v).alias("license_text")) for k, v in notices or NOTICES))
    texts = spark.range(1).select(F.inline(rows))
    known = texts.select("license_id", digest(lines(F.col("license_text"))).alias("digest"))
    if notices is None:
        whole = F.array(*(F.struct(F.lit(k).alias("license_id"), F.lit(v).alias("digest")) for k, v in DIGESTS))
        known = known.unionByName(spark.range(1).select(F.inline(whole)))
    return known.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def lines(text: Column) -> Column:
    """The canonical forms of a text's lines that are not empty."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line), lambda x: x != "")


def digest(canonical: Column) -> Column:
    return F.sha2(F.array_join(canonical, " "), 256)


def license_scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", known_rows: int | None = None) -> DataFrame:
    """A row for each row of docs: doc_id, digest (of the whole canonical text), license_id (whose text it is, else null), line_license_ids (sorted, of the lines that are known texts), n_license_lines.

    Null and empty texts have the digest of the empty string and no licence. Repeated rows give repeated results. Extra
    columns are ignored. known: (digest, license_id) with unique digests; known_rows: its proven number of rows, without
    which a given table is joined by a shuffle. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    if known is None:
        known, known_rows = known_digests(spark), len(NOTICES) + len(DIGESTS)
    known = known.select("digest", "license_id")
    side = F.broadcast(known) if known_rows is not None and known_rows <= BROADCAST_ROWS else known
    base = picked(docs, doc_id=(id_col, docs.schema[id_col].dataType.simpleString()), text=(text_col, "string"))
    base = base.select(F.monotonically_increasing_id().alias("row"), "doc_id", lines(F.col("text")).alias("lines"))
    whole = F.struct(F.lit(True).alias("whole"), digest(F.col("lines")).alias("digest"))
    units = F.concat(F.array(whole), F.transform(F.col("lines"), lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(x, 256).alias("digest"))))
    found = base.select("row", "doc_id", F.inline(units)).join(side, "digest", "left")
    is_line = ~F.col("whole") & F.col("license_id").isNotNull()
    return (
        found.groupBy("row", "doc_id")
        .agg(
            F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
            F.max(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"),
            F.array_sort(F.collect_set(F.when(is_line, F.col("license_id")))).alias("line_license_ids"),
            F.sum(is_line.cast("long")).alias("n_license_lines"),
        )
        .drop("row")
    )
