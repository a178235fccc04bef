"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Notices are the lines of a text that have a licence's cue words, and the blocks of neighbouring
lines around them: headers are wrapped, and a line of one may name a licence that the header does not mean. A licence file is
also taken as a whole. Notices are compared with the templates as sparse vectors:
rows of (notice, term, weight) are joined with the templates' terms, so only shared
terms meet. Terms are weighed by how many notices of the whole corpus hold them. Equal notices
are scored once. The nearest template counts, of any notice of the file. Templates of ``FULL_TERMS`` terms or more
are texts of licences: as long legal texts are alike in their common words, they must be nearer (``FULL``), and then
they come before shorter templates, which may be a sentence that several licences have. A file without a licence of its own takes that of the licence file in
the nearest directory above it: directories are joined with their ancestors by path.

Defined results: null and empty texts have no notice; a line without a letter or digit ends a block; a null path has no directory and inherits
nothing; if a directory has several licence files the best score counts, then the smaller
path; equal scores go to the licence that sorts first; repeated rows are kept, each judged; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import stored

#: The least cosine of a notice to a template.
LEAST = 0.6
#: The least cosine to a template of at least so many terms.
FULL, FULL_TERMS = 0.9, 60
#: Lines before and after a line with cue words that belong to its block.
AROUND = 3
CUES = r"licen[sc]|copyright|rights reserved|spdx|redistribution|public domain|permission is hereby|creative commons|all rights"
LICENSE_FILE = r"(?i)(^|/)(un)?(licen[sc]e|copying|notice|copyright)[^/]*$"

_MIT_WARRANTY = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF"
    " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY"
    " CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE"
    " SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_WARRANTY = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF"
    " MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES"
    " WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF"
    " OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
    " documentation and/or other materials provided with the distribution.")
_BSD_ENDORSEMENT = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission.")
_BSD_WARRANTY = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED"
    " TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR"
    " CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,"
    " PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF"
    " LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS"
    " SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

#: Opening sentences, titles, usual short notices and, of short licences, whole texts (fixed values).
TEMPLATES = (
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted." + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_OPENING + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_OPENING + _BSD_ENDORSEMENT + _BSD_WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above"
            " copyright notice and this permission notice appear in all copies." + _ISC_WARRANTY),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
            " \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,"
            " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to"
            " the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
            " the Software." + _MIT_WARRANTY),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or"
                  " distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by"
                  " any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright"
                  " interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of"
                  " our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future"
                  " rights to this software under copyright law." + _MIT_WARRANTY),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License"
                " as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"
                 " as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("ISC", "Licensed under the ISC License."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"
                 " as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights; this work is in the public domain (CC0 1.0)."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
                " as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License version 3."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.[0-9]+)*"), F.lit(0))


def directory(path: Column) -> Column:
    """What stands before the last slash; the empty text for a file at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def notices(files: DataFrame) -> DataFrame:
    """``row, notice, text`` for ``row, text, whole``: lines with cue words, their blocks, and the whole text of licence files.

    ``notice`` is a digest: texts may be long, and what follows makes a row of each term.
    """
    cue = lambda line: line.rlike(f"(?i){CUES}")
    lines, none = F.when(cue(F.col("text")), F.split("text", "\r?\n")), F.array().cast("array<string>")
    # A generator's output, so that no line evaluates the list of cues again.
    marked = files.filter("text IS NOT NULL").select("row", "text", "whole", F.inline(F.array(
        F.struct(lines.alias("lines"), F.transform(lines, cue).alias("cues")))))
    near = lambda i: F.exists(F.slice("cues", F.greatest(i - AROUND, F.lit(0)) + 1, F.least(i, F.lit(AROUND)) + AROUND + 1), lambda c: c)
    taken = F.transform("lines", lambda line, i: F.when(line.rlike(r"[\p{L}\p{N}]") & near(i), line).otherwise(""))
    blocks = F.transform(F.filter(F.split(F.array_join(taken, "\n"), "\n{2,}"), cue), lambda b: F.btrim(b, F.lit("\n")))
    found = F.concat(F.coalesce(F.filter("lines", cue), none), F.coalesce(blocks, none), F.when(F.col("whole"), F.array("text")).otherwise(none))
    return marked.select("row", F.explode(F.array_distinct(found)).alias("text")).select("row", F.md5("text").alias("notice"), "text")


def _weights(rows: DataFrame, key: str, idf: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Term weights (tf times idf) of texts, and their lengths."""
    tf = rows.select(key, F.explode("terms").alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    w = tf.join(idf, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    return w, w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))


def scored(found: DataFrame, known: DataFrame, *, least: float = LEAST) -> DataFrame:
    """``notice, license, score, short`` of distinct notices that are near enough to a template; ``short`` if it is no text of a licence."""
    counted = found.groupBy("notice").agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
    # A number instead of the digest in the rows of terms; it is fixed once the table is written.
    counted = stored(counted.select(F.monotonically_increasing_id().alias("id"), "notice", "n", terms(F.col("text")).alias("terms")), "notices")
    known = stored(known.filter("text IS NOT NULL AND license IS NOT NULL").select("license", "text").distinct().select(
        F.xxhash64("license", "text").alias("template"), "license", terms(F.col("text")).alias("terms")).withColumn(
        "short", F.size("terms") < FULL_TERMS), "templates")
    total = (counted.agg(F.sum("n")).first()[0] or 0) + known.count()
    # In how many notices a term occurs; the templates take part, so none of their terms is unknown.
    held = counted.select("n", F.explode(F.array_distinct("terms")).alias("term")).unionByName(
        known.select(F.lit(1).cast("long").alias("n"), F.explode(F.array_distinct("terms")).alias("term")))
    idf = stored(held.groupBy("term").agg((F.log(F.lit(1.0 + total) / (1 + F.sum("n"))) + 1).alias("idf")), "idf")
    ours, our_length = _weights(counted, "id", idf)
    theirs, their_length = _weights(known, "template", idf)
    theirs = theirs.withColumnRenamed("w", "v")
    dots = ours.join(theirs, "term").groupBy("id", "template").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    near = dots.join(our_length, "id").join(their_length.withColumnRenamed("length", "their_length"), "template")
    near = near.withColumn("score", F.round(F.col("dot") / (F.col("length") * F.col("their_length")), 6)).filter(F.col("score") >= least)
    best = near.join(known.select("template", "license", "short"), "template").filter(F.col("short") | (F.col("score") >= FULL)).groupBy("id").agg(_best())
    return best.join(counted.select("id", "notice"), "id").select("notice", "b.license", (-F.col("b.minus")).alias("score"), "b.short")


def _best() -> Column:
    """Of rows of ``short, score, license`` the one that counts."""
    return F.min(F.struct("short", (-F.col("score")).alias("minus"), "license")).alias("b")


def scan(
    files: DataFrame, known: DataFrame, *, path: str = "path", text: str = "text", license_file: Column | None = None, least: float = LEAST,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per file: ``path, license, score, origin, licensed_by`` and the columns of ``keep``.

    ``origin`` is ``own``, ``inherited`` or null, ``licensed_by`` the path that states the licence. ``license_file`` says
    which files are licence files, by default those named like one.
    """
    flag = F.col(path).rlike(LICENSE_FILE) if license_file is None else license_file
    rows = files.select(F.xxhash64(F.col(path), F.col(text)).alias("row"), F.col(path).alias("path"), F.coalesce(flag, F.lit(False)).alias("whole"),
                        F.col(text).alias("text"), *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)])
    found = stored(notices(rows), "found")
    best = found.select("row", "notice").join(scored(found, known, least=least), "notice").groupBy("row").agg(_best())
    own = stored(best.select("row", F.col("b.license").alias("license"), (-F.col("b.minus")).alias("score")), "own")
    slim = stored(rows.drop("text").join(own, "row", "left").drop("row").withColumn("dir", directory(F.col("path"))), "files")

    # The licence each directory states, then for every directory the nearest one above or at it.
    stated = slim.filter("whole AND license IS NOT NULL AND path IS NOT NULL").groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "path", "license")).alias("b"))
    stated = stored(stated.select(F.col("dir").alias("at"), "b.path", "b.license", (-F.col("b.minus")).alias("score")), "stated")
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    above = slim.filter("path IS NOT NULL").select("dir").distinct().select(
        "dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
            n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("at")))).alias("a")).select("dir", "a.depth", "a.at")
    nearest = above.join(stated, "at").groupBy("dir").agg(F.max(F.struct("depth", "path", "license", "score")).alias("s"))
    nearest = stored(nearest, "nearest")
    out = slim.join(nearest, "dir", "left")
    has = F.col("license").isNotNull()
    inherits = ~has & F.col("path").isNotNull() & F.col("s").isNotNull()
    return out.select(
        "path", F.coalesce("license", F.when(inherits, F.col("s.license"))).alias("license"),
        F.coalesce("score", F.when(inherits, F.col("s.score"))).alias("score"),
        F.when(has, "own").when(inherits, "inherited").alias("origin"),
        F.when(has, F.col("path")).when(inherits, F.col("s.path")).alias("licensed_by"),
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)])
