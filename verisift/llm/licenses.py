"""Licence scan: sparse TF-IDF cosine to licence templates, then inheritance along paths.

A text's passages are its lines that hint at a licence and, so that wrapped
notices are compared whole, its blocks, paragraphs and runs of one to three sentences
that do, without comment signs and line breaks: a block ends at a blank line, a
paragraph at a blank comment line too. A file that is named like a licence file is
a passage as a whole besides. Distinct passages are compared once: their
terms meet the term weights of the templates (a table of fixed size, broadcast),
and products are summed by passage and template. Templates are notices and the full
texts of short licences; of long ones the title or notice in the text is found. A text's licence is the
template with the largest cosine of all its passages, if that reaches ``threshold``;
a passage that reaches ``FULL`` with a full text precedes all notices, as licences
share paragraphs.

A licence file covers its directory. It is known by its name or, with ``by_text`` (for
texts that have no file names), by its text: one that reaches ``threshold`` as a whole,
so that it holds little but a licence, or that opens with the title of a full licence.
A text without a licence of its own takes that
of the nearest ancestor directory with a licence file: distinct directories
are joined with covered ones through their ancestor paths, and texts then join their
directory. Passages and directories that very many texts share are hot keys of the
join, not groups in one task.

All work is done by native expressions and joins.

Defined results: a null or empty text has no licence of its own; a null path has no
directory, covers and inherits nothing; two licence files in one directory: the larger
cosine counts, ties go to the earlier name; equal cosines (of equal names) go to the
earlier template; every row gives one row, repeated rows included; further columns are left out.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm import graphs, scratch

#: Names of licences and their usual notices.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"],
    "LGPL-3.0": ["licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"],
    "AGPL-3.0": ["licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license.", "Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "ISC": ["Licensed under the ISC License.", "SPDX-License-Identifier: ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights. CC0 1.0 Universal public domain dedication.", "SPDX-License-Identifier: CC0-1.0"],
    "Proprietary": ["All rights reserved. Confidential and proprietary.", "Copyright. All rights reserved."],
}
#: Titles and standard headers that stand in full licence texts and files, matched as TEMPLATES are.
HEADERS = {
    "Apache-2.0": ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
    "CC0-1.0": ["Creative Commons Legal Code CC0 1.0 Universal"],
}
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_NO_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
#: Full texts of short licences.
TEXTS = {
    "MIT": TEMPLATES["MIT"][3] + ", and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-3-Clause": _BSD + _NO_NAMES + _BSD_END,
    "BSD-2-Clause": _BSD + _BSD_END,
    "ISC": TEMPLATES["ISC"][2] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
}
#: What makes a line, block, paragraph or sentence a passage, and a name that of a licence file; _ is any gap, as words may stand on two lines.
HINT = r"(?i)licen[sc]e|copyright|spdx|permission_is_hereby|redistribut|public_domain|all_rights_reserved|creative_commons".replace("_", r"[^\p{L}\p{N}]+")
#: Comment signs at the start and end of a line.
SIGNS = r"(?m)^[ \t]*+(?:(?:/\*++|\*++/?|//++|#++|--++|;++|%++|<!--)[ \t]*+)?|[ \t\r]*+(?:\*++/|-->)?[ \t\r]*+$"
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense)([.\-_][^/]*)?$"
#: A text that opens with the title of a full licence.
TITLED = r"(?i)^[^a-z0-9]*+(?:" + "|".join(r"[^a-z0-9]++".join(re.findall(r"[a-z0-9]+", headers[0].lower())) for headers in HEADERS.values()) + r")(?![a-z0-9])"
#: Least cosine for a licence, and for a text to be a full licence text.
THRESHOLD, FULL = 0.6, 0.85


def terms(text: Column) -> Column:
    """Words and numbers of a text in lower case; a version keeps its first part."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+"), 0)


def notices() -> list[tuple[str, list[str]]]:
    """(licence#k, words) of each notice and header."""
    return [(f"{name}#{k}", re.findall(r"[a-z0-9]+", t.lower())) for name in TEMPLATES for k, t in enumerate(TEMPLATES[name] + HEADERS.get(name, []))]


def template_weights() -> list[tuple[str, str, float]]:
    """(template, term, weight) with unit length for each notice and full text, by TF-IDF over the notices."""
    out = []
    idf = inverse_frequencies()
    unseen = max(idf.values())
    for name, words in notices() + [(f"{name}#full", re.findall(r"[a-z0-9]+", t.lower())) for name, t in TEXTS.items()]:
        weight = {w: (1 + math.log(words.count(w))) * idf.get(w, unseen) for w in set(words)}
        norm = math.sqrt(sum(x * x for x in weight.values()))
        out += [(name, w, x / norm) for w, x in sorted(weight.items())]
    return out


def inverse_frequencies() -> dict[str, float]:
    """ln((1 + n) / (1 + df)) + 1 of each term over the notices."""
    sets = [set(words) for _, words in notices()]
    return {w: math.log((1 + len(sets)) / (1 + sum(w in x for x in sets))) + 1 for w in set().union(*sets)}


#: A match as one number, the better the larger: a full text before notices, then the score, then the earlier licence.
ORDER = list(TEMPLATES)
SCALE, PLACES = 1_000_000_000, 64


def code(full: Column, score: Column, place: Column) -> Column:
    return (F.when(full, 2 * SCALE).otherwise(0) + F.round(score * SCALE).cast("long")) * PLACES + (PLACES - 1 - place)


def decode(x: Column) -> Column:
    """(license, score) of a match number."""
    place, score = PLACES - 1 - x % PLACES, F.floor(x / PLACES) % (2 * SCALE)
    return F.when(x.isNotNull(), F.struct(F.get(F.lit(ORDER), place.cast("int")).alias("license"), (score / SCALE).alias("score")))


def literal_table(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small fixed table inside the plan."""
    each = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows])
    return spark.range(1).select(F.inline(each))


def match_passages(passages: DataFrame) -> DataFrame:
    """h1, h2, match: the best template of each distinct passage (columns h1, h2, passage) as a match number."""
    spark = passages.sparkSession
    idf = inverse_frequencies()
    unseen = max(idf.values())
    names = sorted({name for name, _, _ in template_weights()})
    place = {name: k for k, name in enumerate(names)}
    weights = literal_table(spark, [(place[name], term, w, idf.get(term, unseen)) for name, term, w in template_weights()], ["template", "term", "weight", "idf"])
    rare = literal_table(spark, sorted(idf.items()), ["term", "idf"])
    # a passage's own weights: terms that no template has weigh most in its length
    rows = passages.select("h1", "h2", F.explode(terms(F.col("passage"))).alias("term")).groupBy("h1", "h2", "term").agg((1 + F.log(F.count(F.lit(1)))).alias("tf"))
    rows = scratch.stored(rows, "license_terms")
    length = rows.join(F.broadcast(rare), "term", "left").groupBy("h1", "h2").agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.coalesce("idf", F.lit(unseen)), 2))).alias("length"))
    dots = rows.join(F.broadcast(weights), "term").groupBy("h1", "h2", "template").agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"))
    score = F.least(F.col("dot") / F.col("length"), F.lit(1.0))
    whole = F.get(F.lit([n.endswith("#full") for n in names]), F.col("template")) & (F.round(score, 9) >= FULL)
    own = F.get(F.lit([ORDER.index(n.split("#")[0]) for n in names]), F.col("template"))
    return dots.join(length, ["h1", "h2"]).groupBy("h1", "h2").agg(F.max(code(whole, score, own)).alias("match"))


def hinting(passages: Column) -> Column:
    return F.filter(passages, lambda x: x.rlike(HINT))


def bare(x: Column) -> Column:
    return F.regexp_replace(x, SIGNS, "")


def flat(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s++", " "))


def passages_of(text: Column) -> Column:
    """The lines, blocks, paragraphs and runs of one to three sentences that hint at a licence."""
    blocks = F.transform(hinting(F.split(text, r"\r?\n[ \t\r]*+\n")), bare)
    paragraphs = F.transform(hinting(F.flatten(F.transform(blocks, lambda b: F.split(b, r"\n\s*\n")))), flat)

    def runs(paragraph: Column) -> Column:
        # as a lambda's variable, so that the split is not made anew for each sentence
        parts = F.array(F.split(paragraph, r"(?<=[.:;!?][\"')]?) (?=[\p{Lu}\"(])"))
        each = F.flatten(F.transform(parts, lambda p: F.transform(p, lambda s, i: F.array(*[F.array_join(F.slice(p, i + 1, F.lit(n)), " ") for n in (1, 2, 3)]))))
        return hinting(F.flatten(each))

    return F.array_distinct(F.concat(hinting(F.split(text, "\n")), F.transform(blocks, flat), paragraphs, F.flatten(F.transform(paragraphs, runs))))


def directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(path: Column) -> Column:
    """A directory and all directories above it, the root as an empty string."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def normal(path: Column) -> Column:
    return F.array_join(F.filter(F.split(path, "/"), lambda p: p != ""), "/")


def scan(df: DataFrame, id_col: str, path_col: str, text_col: str = "text", threshold: float = THRESHOLD, by_text: bool = False) -> DataFrame:
    """id, license, score, origin (own, inherited, or null), license_path (the file a licence is inherited from).

    by_text takes licence texts for licence files too, whatever their names are.
    """
    base = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), normal(F.col(path_col)).alias("path"), F.col(text_col).cast("string").alias("text"))
    hints = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    named = F.coalesce(F.col("path").rlike(LICENSE_FILE), F.lit(False))
    titled = F.when(hints, F.col("text").rlike(TITLED)).otherwise(False) if by_text else F.lit(False)
    whole = (named | hints if by_text else named) & F.col("text").isNotNull()
    none = F.array().cast("array<string>")
    parts = F.when(hints, passages_of(F.col("text"))).otherwise(none)
    # a whole text is the first passage
    passages = F.concat(F.when(whole, F.array(flat(bare(F.col("text"))))).otherwise(none), parts)
    marked = base.select("row", "id", "path", (named | titled).alias("file"), whole.alias("whole"), F.array_distinct(passages).alias("passages"))
    marked = scratch.stored(marked, "license_passages")
    each = marked.where(F.size("passages") > 0).select("row", "whole", F.posexplode("passages").alias("place", "passage"))
    each = each.select("row", (F.col("whole") & (F.col("place") == 0)).alias("whole"), F.xxhash64("passage").alias("h1"), F.xxhash64(F.lit(1), "passage").alias("h2"), "passage")
    distinct = each.groupBy("h1", "h2").agg(F.first("passage").alias("passage"))
    known = scratch.stored(match_passages(distinct).where(decode(F.col("match"))["score"] >= threshold), "license_matches")
    met = graphs.hot_join(scratch.stored(each.select("row", "whole", "h1", "h2"), "license_rows"), known, ["h1", "h2"]).where(F.col("match").isNotNull())
    own = met.groupBy("row").agg(F.max("match").alias("match"), F.max("whole").alias("is_text")).select("row", decode(F.col("match")).alias("own"), "is_text")
    rows = marked.where(F.size("passages") > 0).select("row", "id", "path", "file").join(own, "row", "left")
    rows = rows.withColumn("file", F.col("file") | F.coalesce("is_text", F.lit(False))).drop("is_text")
    rows = rows.unionByName(marked.where(F.size("passages") == 0).select("row", "id", "path", "file", F.lit(None).cast(own.schema["own"].dataType).alias("own")))
    rows = scratch.stored(rows.withColumn("dir", directory(F.col("path"))), "license_own")

    covers = rows.where(F.col("file") & F.col("own").isNotNull() & F.col("dir").isNotNull()).groupBy(F.col("dir").alias("cover")).agg(F.min_by(F.struct(F.col("own.license").alias("license"), F.col("own.score").alias("score"), F.col("path").alias("license_path")), F.struct(-F.col("own.score"), F.col("path"), F.array_position(F.lit(ORDER), F.col("own.license")))).alias("given"))
    wanting = rows.where(F.col("own").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    up = wanting.select("dir", F.posexplode(ancestors(F.col("dir"))).alias("depth", "cover"))
    up = scratch.stored(up, "license_up")
    near = graphs.hot_join(up, covers, ["cover"]).where(F.col("given").isNotNull()).groupBy("dir").agg(F.max_by("given", "depth").alias("given"))
    near = scratch.stored(near, "license_near")
    lack = rows.where(F.col("own").isNull() & F.col("dir").isNotNull()).select("id", "dir")
    got = graphs.hot_join(lack, near, ["dir"]).select("id", F.col("given.license").alias("license"), F.col("given.score").alias("score"), F.when(F.col("given").isNotNull(), "inherited").alias("origin"), "given.license_path")
    have = rows.where(F.col("own").isNotNull() | F.col("dir").isNull()).select("id", "own.license", "own.score", F.when(F.col("own").isNotNull(), "own").alias("origin"), F.lit(None).cast("string").alias("license_path"))
    return have.unionByName(got).withColumnRenamed("id", id_col)
