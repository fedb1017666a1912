"""Licence scan: TF-IDF cosine to templates, and inheritance from the nearest licensed directory.

The header of a file is every sentence of its text that speaks of a licence; of a licence file it
is the whole text. Headers and templates are bags of words, weighted by
``tf * (ln((1 + N) / (1 + df)) + 1)`` with N headers and templates in all; a header has the licence
of the template with the highest cosine, if that reaches ``least`` (ties to the smaller name).
Equal headers are scored once, however many files have them. A file without a licence of its own
inherits that of its nearest ancestor directory that has one: the licence of a licence file in
it, the smallest path first. Directories are resolved among themselves, then files join theirs.

Everything is DataFrame operations: sentences are filtered inside the scan, so texts are never
shuffled, and only the words of headers are exploded. Null texts and paths: no header, and no
directory. Equal rows are scanned alike; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kessan.llm.columns import narrow
from kessan.session import written
from kessan.small import TEXT, small_table

# What licences say of themselves in a header.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "under the terms of the BSD license",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-2.0": "This program is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0",
}
# Licence texts that are short as a whole, and the notices that longer ones ask for.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
You should have received a copy of the GNU General Public License along
with this program; if not, write to the Free Software Foundation, Inc.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
You should have received a copy of the GNU General Public License
along with this program. If not, see https://www.gnu.org/licenses/.""",
    "LGPL-3.0": """This library is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
# Words that only sentences about licences hold, and names of licence files.
CUES = "(?i)licen[sc]e|copyright|redistribution|spdx"
FILE_NAMES = "(?i)^(licen[sc]e|copying|copyright|notice)([.-][a-z0-9.-]*)?$"
_SENTENCE = r"(?<=[.!?])\s+|\n"


def known_templates() -> list[tuple[str, str]]:
    """``licence, text`` of every template: what licences say in a sentence, whole texts and notices,
    and what ``header`` leaves of these in a file that is not a licence file."""
    about = {
        name: "\n".join(s for s in re.split(_SENTENCE, text) if re.search(CUES, s)) for name, text in TEXTS.items()
    }
    return sorted({(name, text) for some in (TEMPLATES, TEXTS, about) for name, text in some.items() if text})


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    """The directory of a path, empty at the root."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def header(text: Column, whole: Column) -> Column:
    """The licence sentences of a text, or all of it; null where there are none."""
    about = F.filter(F.split(text, _SENTENCE), lambda s: s.rlike(CUES))
    found = F.when(whole, text).when(text.rlike(CUES), F.array_join(about, "\n"))
    return F.when(F.length(F.trim(found)) > 0, found)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.+-]+|\.(?![a-z0-9])"), lambda w: w != "")


def _weights(bags: DataFrame, total: int) -> DataFrame:
    """``bag, n, word, weight, size``: TF-IDF of each bag's words and the bag's length. ``n`` is
    the number of files with the bag, which the document frequencies count."""
    terms = bags.select("bag", "n", F.explode(words(F.col("bag"))).alias("word")).groupBy("bag", "word").agg(
        F.count(F.lit(1)).alias("tf"), F.max("n").alias("n")
    )
    frequency = terms.groupBy("word").agg(F.sum("n").alias("df"))
    weight = F.col("tf") * (F.log(F.lit(1.0 + total) / (1 + F.col("df"))) + 1)
    weighed = terms.join(written(frequency, "licence-words"), "word").select("bag", "word", weight.alias("weight"))
    sizes = weighed.groupBy("bag").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("size"))
    return weighed.join(sizes, "bag")


def matched(headers: DataFrame, templates: Sequence[tuple[str, str]], least: float) -> DataFrame:
    """``header, licence, score`` of each distinct header that is near a template. ``headers``:
    ``header, n``; a licence may have several templates."""
    spark = headers.sparkSession
    known = small_table(spark, sorted(templates), licence=TEXT, header=TEXT)
    bags = written(
        headers.select(F.col("header").alias("bag"), "n").unionByName(known.select(F.col("header").alias("bag"), F.lit(1).alias("n")))
        .groupBy("bag").agg(F.sum("n").alias("n")),
        "licence-bags",
    )
    total = bags.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    weights = written(_weights(bags, total), "licence-weights")
    theirs = weights.join(known.withColumnRenamed("header", "bag"), "bag").select(
        "licence", F.col("bag").alias("template"), "word", (F.col("weight") / F.col("size")).alias("theirs")
    )
    shared = weights.join(written(theirs, "licence-templates"), "word").groupBy("bag", "licence", "template").agg(
        F.sum(F.col("weight") / F.col("size") * F.col("theirs")).alias("score")
    )
    score = F.round("score", 6)
    best = shared.groupBy("bag").agg(F.min(F.struct((-score).alias("score"), "licence")).alias("best"))
    return best.select(
        F.col("bag").alias("header"), F.col("best.licence").alias("licence"), (-F.col("best.score")).alias("score")
    ).filter(F.col("score") >= least)


def _inherited(own: DataFrame, wanted: DataFrame) -> DataFrame:
    """``dir, licence, from_dir``: for each wanted directory the nearest with a licence, itself
    included. ``own``: ``from_dir, licence``."""
    steps = F.split("dir", "/")
    ancestor = F.transform(
        F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/")
    )
    above = wanted.select("dir", F.posexplode(F.array_distinct(ancestor)).alias("depth", "from_dir"))
    near = above.join(own, "from_dir").groupBy("dir").agg(F.max(F.struct("depth", "licence", "from_dir")).alias("near"))
    return near.select("dir", "near.licence", "near.from_dir")


def scan(
    files: DataFrame, templates: Sequence[tuple[str, str]] | None = None, least: float = 0.6, key: str = "doc_id",
    path: str = "path", text: str = "text", is_licence_file: Column | None = None,
) -> DataFrame:
    """``key, path, licence, score, inherited_from`` per file. ``score`` is null for inherited
    licences and ``inherited_from`` for own ones; all three are null where there is none.
    ``is_licence_file`` (of columns ``path, text``) stands in for the names of licence files."""
    whole = F.coalesce(base_name(F.col("path")).rlike(FILE_NAMES) if is_licence_file is None else is_licence_file, F.lit(False))
    found = narrow(files, key=key, path=path, text=text).select(
        "key", "path", whole.alias("whole"), header(F.col("text"), whole).alias("header")
    )
    found = written(found, "licence-headers")
    distinct = found.filter("header IS NOT NULL").groupBy("header").agg(F.count(F.lit(1)).alias("n"))
    known = written(matched(distinct, templates or known_templates(), least), "licence-matches")
    # Files without a header get a join key of their own, so that they meet in no one task.
    keyed = found.withColumn("header", F.coalesce("header", F.concat(F.lit("\0"), F.coalesce("path", F.lit("")), F.col("key").cast("string"))))
    scanned = written(keyed.join(known, "header", "left").select("key", "path", "whole", "licence", "score"), "licences")
    dir_ = directory(F.col("path"))
    own = scanned.filter("whole AND licence IS NOT NULL AND path IS NOT NULL").groupBy(dir_.alias("from_dir")).agg(
        F.min_by("licence", "path").alias("licence")
    )
    wanted = scanned.filter("path IS NOT NULL").select(dir_.alias("dir")).distinct()
    near = written(_inherited(own, wanted), "licensed-directories").withColumnRenamed("licence", "theirs")
    joined = scanned.withColumn("dir", dir_).join(near, "dir", "left")
    return joined.select(
        F.col("key").alias(key), F.col("path").alias(path), F.coalesce("licence", "theirs").alias("licence"), "score",
        F.when(F.col("licence").isNull(), F.col("from_dir")).alias("inherited_from"),
    )
