"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

The main path is DataFrame functions only.  Units of a text are its lines, its
paragraphs of several lines, and the whole of a licence file.  Only units with
an *anchor* word are weighed: anchors are chosen so that a unit without any
can't reach the threshold (by Cauchy and Schwarz the template's other words
hold too little of its norm), so the filter loses nothing.  Words of a unit are
joined to the templates' weights, a constant table of a few hundred rows, and
summed per unit and template.  Before that a second exact filter drops units
with too few template words among their words, so hardly anything but licence
notices is ever shuffled.

A file whose name says licence declares its directory by its best unit (long
licences hold the notice that they ask for, or a paragraph of their own, among
their units); so does one whose whole text is a template.  Files without a licence of their own take the nearest
declaring ancestor's: distinct directories are expanded to their ancestors and
joined by path, then files join their directory's result.

Defined results: null and empty texts have no licence of their own; a null
path has no directory and inherits nothing; between equal scores the first
licence in alphabetical order wins, between declaring files of one directory
the highest score, then the alphabet; repeated rows get equal results; an
empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialize

#: Cosines from here on count; in ten-thousandths, as all scores are reported.
THRESHOLD = 6000
#: Whole texts from here on declare their directory whatever their name.
WHOLE = 8000

_AS_IS = "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_END = "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage."

TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", f"Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", f"{_BSD} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_END}"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", f"{_BSD} {_BSD_END}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GFDL-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License."),
    ("CC0-1.0", "CC0 1.0 Universal. Statement of Purpose. The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an owner) of an original work of authorship and/or a database (each, a Work)."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
)
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
FILES = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[a-z]+)?$"


#: Common words weigh nothing, in templates as in texts.
STOP = sorted(set("the a an of and or in to this that is are be by any all with without for at as you it on under not may except shall can its their from following above either your no but out other each most whether must world throughout below how".split()))


def words_of(text: str) -> list[str]:
    return [w for w in re.findall(WORD, text.lower()) if w not in STOP]


def _weights() -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """Inverse document frequencies over the templates, that of unknown words, and unit vectors of all templates."""
    bags = [Counter(words_of(t)) for _, t in TEMPLATES]
    n, df = len(bags), Counter(w for b in bags for w in b)
    idf = {w: round(math.log((1 + n) / (1 + d)) + 1, 9) for w, d in df.items()}
    vectors = []
    for b in bags:
        v = {w: c * idf[w] for w, c in b.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({w: round(x / norm, 9) for w, x in v.items()})
    return idf, round(math.log(1 + n) + 1, 9), vectors


IDF, UNKNOWN, VECTORS = _weights()


def _anchors() -> list[str]:
    """Words such that each template keeps less than the threshold's norm without them, words of many templates first."""
    out: set[str] = set()
    for v in VECTORS:
        rest = lambda: math.sqrt(sum(x * x for w, x in v.items() if w not in out))  # noqa: B023, E731
        for w in sorted(v, key=lambda w: (w[0].isdigit(), -sum(w in u for u in VECTORS), -v[w])):
            if rest() < THRESHOLD / 10000 - 1e-3:
                break
            out.add(w)
    return sorted(out)


ANCHORS = _anchors()
_ANCHOR = r"(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(a) for a in ANCHORS) + r")(?![a-z0-9])"


def weights_table(spark: SparkSession) -> DataFrame:
    """The constant table ``(word, template, x)``."""
    rows = ", ".join(f"('{w}', {k}, {x!r}D)" for k, v in enumerate(VECTORS) for w, x in v.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(word, template, x)")


def idf_table(spark: SparkSession) -> DataFrame:
    """The constant table ``(w, idf)``."""
    rows = ", ".join(f"('{w}', {x!r}D)" for w, x in sorted(IDF.items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(w, idf)")


def _dense(text: Column) -> Column:
    """Whether a unit has enough words of the templates among all its words to reach the threshold.

    With k occurrences of template words and n others, none of which weighs
    less, the squared cosine to any template is at most k * k / (k * k + n); so
    units that fail this are done with, exactly.
    """
    words = F.filter(F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1)), lambda w: ~w.isin(*STOP))
    known = F.size(F.filter(words, lambda w: w.isin(*sorted(IDF))))
    share = (THRESHOLD / 10000 - 1e-3) ** 2
    return known * known * (1 - share) >= (F.size(words) - known) * share


def units(docs: DataFrame) -> DataFrame:
    """``(row, unit, whole, text)``: anchored lines, paragraphs of several lines, and whole texts, that can reach the threshold."""
    has = F.col("text").rlike(_ANCHOR)
    own = docs.where(has)
    none = F.lit(None).cast("string")
    paragraphs = F.transform(F.split("text", r"\n[ \t\r]*\n"), lambda p: F.when(F.locate("\n", F.trim(p)) > 0, p).otherwise(none))
    listed = F.concat(F.transform(F.split("text", "\n"), lambda t: F.struct(F.lit(False).alias("whole"), t.alias("t"))), F.transform(paragraphs, lambda t: F.struct(F.lit(False).alias("whole"), t.alias("t"))), F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("t"))))
    every = own.select("row", F.posexplode(listed).alias("unit", "x")).select("row", "unit", "x.whole", F.col("x.t").alias("text"))
    return every.where(F.col("text").rlike(_ANCHOR)).where(_dense(F.col("text")))


def cosines(docs: DataFrame) -> DataFrame:
    """``(row, whole, license, score)``: the best template of each unit at the threshold."""
    spark = docs.sparkSession
    tokens = units(docs).select("row", "unit", "whole", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({WORD})"), F.lit(1))).alias("word")).where(~F.col("word").isin(*STOP))
    counts = materialize(tokens.groupBy("row", "unit", "whole", "word").agg(F.count("*").alias("tf")), "license-words")  # texts are scanned once
    weighed = counts.join(F.broadcast(idf_table(spark)), F.col("word") == F.col("w"), "left").withColumn("y", F.col("tf") * F.coalesce("idf", F.lit(UNKNOWN)))  # the idf table is a constant
    norm = weighed.groupBy("row", "unit", "whole").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("norm"))
    dots = weighed.join(F.broadcast(weights_table(spark)), "word").groupBy("row", "unit", "whole", "template").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    score = F.round(F.col("dot") / F.col("norm") * 10000).cast("int")
    names = F.element_at(F.array(*[F.lit(name) for name, _ in TEMPLATES]), F.col("template") + 1)
    return dots.join(norm, ["row", "unit", "whole"]).select("row", "whole", names.alias("license"), score.alias("score")).where(F.col("score") >= THRESHOLD)


def _best() -> Column:
    """Highest score, then the alphabet."""
    return F.min(F.struct((-F.col("score")).alias("minus"), "license"))


def parent(path: Column) -> Column:
    return F.when(F.locate("/", path) > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def scan(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, path, text)`` to ``(doc_id, path, license, how, score, declared_in)``.

    ``how`` is header or inherited, or null without a licence; ``declared_in``
    is the directory that a licence was inherited from.
    """
    own = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["path"].cast("string").alias("path"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    keyed = own.select("doc_id", "path", "text", F.coalesce(F.col("path").rlike(FILES), F.lit(False)).alias("named"), F.struct("doc_id", "path", F.md5("text").alias("h")).alias("row"))
    found = materialize(cosines(keyed), "licenses")
    header = found.groupBy("row").agg(_best().alias("b")).select("row", F.col("b.license").alias("license"), (-F.col("b.minus")).alias("score"))

    # directories that declare a licence
    path = F.col("row.path")
    declares = path.rlike(FILES) | (F.col("whole") & (F.col("score") >= WHOLE))
    declared = found.where(declares & path.isNotNull()).groupBy(parent(path).alias("d_dir")).agg(_best().alias("b")).select("d_dir", F.col("b.license").alias("d_license"), (-F.col("b.minus")).alias("d_score"))

    # distinct directories, their ancestors, and the nearest that declares
    dirs = own.where("path is not null").select(parent(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    chain = dirs.select("dir", F.explode(F.sequence(F.lit(0), depth)).alias("depth"), parts.alias("parts")).select("dir", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("ancestor"))
    nearest = chain.join(declared, F.col("ancestor") == F.col("d_dir")).groupBy("dir").agg(F.max(F.struct("depth", "d_dir", "d_license", "d_score")).alias("n")).select("dir", "n.d_dir", "n.d_license", "n.d_score")

    rows = keyed.select("row")
    out = rows.join(header.withColumnRenamed("row", "h_row"), rows["row"] == F.col("h_row"), "left")
    out = out.join(nearest, parent(F.col("row.path")) == F.col("dir"), "left")
    mine = F.col("license").isNotNull()
    return out.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.path").alias("path"),
        F.coalesce("license", "d_license").alias("license"),
        F.when(mine, "header").when(F.col("d_license").isNotNull(), "inherited").alias("how"),
        F.coalesce("score", "d_score").alias("score"),
        F.when(~mine, F.col("d_dir")).alias("declared_in"),
    )
