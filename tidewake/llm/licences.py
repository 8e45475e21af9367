"""Licence scans: sparse TF-IDF cosine to templates, and inheritance from directories.

Templates are whole licence texts (the files in licence_texts) and the notices that
point to them (NOTICES). Passages of a file are its lines, its paragraphs (lines up to one without a letter or digit), the
comment lines that it begins with, and the text as a whole; words are runs of letters and digits in lower case, so neither line ends nor comment
signs matter, and copyright notices (COPYRIGHT) don't count. A passage's vector has tf * idf for each word, tf counted in the passage,
idf = ln((1 + documents) / (1 + documents with the word)) + 1 over all documents; a word that no template
has counts as one that no document has. A passage names the template with the greatest cosine, if that is least_cosine
or more (of ties, the first by name). A whole text that does is a licence file, and gives
its licence to its directory; another passage that does is a header of its own file. Files without
one inherit from the nearest directory above that has a licence file (of several there, that with the
greatest cosine, then the smallest id).

Two passes: the first counts documents with each template word; the weights that follow are as many as
the templates have words, and known to the driver. The second scores passages that can reach least_cosine, and no others: one that lacks
a template's heaviest words, with more than 1 - least_cosine ** 2 of its squared length, cannot; nor can one whose
own words outside all templates have more than that share of its squared length.

Directories are looked up once each, not once for each file; hot ones are dealt out. Null and empty
texts have no licence of their own but may inherit; a null path has no directory. Rows equal in id, path
and text get equal answers; rows that share only some of these are told apart. A file is held by one task, however long.
An empty table stays empty. Other columns pass through, whatever their names; added ones (licence, cosine, origin,
origin_id) replace any of the same name.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import attach, numbered, packed, spread, stored, unpacked

#: Notices that point to licences, and the first paragraphs of some.
NOTICES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. "
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."],
    "all-rights-reserved": ["All rights reserved."],
}
#: Licences whose whole text stands in several paragraphs, the first of which may stand alone.
OPENINGS = ("MIT", "BSD-3-Clause", "ISC")
LEAST_COSINE = 0.8
NOT_WORD = r"[^\p{L}\p{N}]+"
#: A copyright notice up to the end of its sentence or line, which every file words in its own way.
COPYRIGHT = r"(?i)\bcopyright\s++(?:\(c\)\s*+|©\s*+)?+\d{4}[^\n.]*+\.?+"
#: Lines that source files of the usual languages begin with before their code.
COMMENT = r"^\s*(?:#|//|/\*|\*|--|;|%|<!--|\"\"\"|'''|$)"
NO_TEXT = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"


def templates() -> dict[str, list[str]]:
    """Each licence's texts."""
    out = {name: list(texts) for name, texts in NOTICES.items()}
    for file in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        text = file.read_text("utf-8")
        own = out.setdefault(file.stem, [])
        own.append(text)
        if file.stem in OPENINGS:
            own.append(next(p for p in re.split(r"\n\s*\n", text) if "permi" in p.lower()))
    for name, own in out.items():
        if name != "all-rights-reserved":
            own.append(f"SPDX-License-Identifier: {name}")
    return out


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case; an empty one may stand at either end."""
    return F.split(F.lower(text), NOT_WORD)


def plain_words(text: str) -> list[str]:
    """words() of a template."""
    clean = re.sub(r"(?i)\bcopyright\s+(?:\(c\)\s*|©\s*)?\d{4}[^\n.]*\.?", " ", text)
    return [w for w in re.split(r"[\W_]+", clean.lower()) if w]


def weights(forms: list[tuple[str, Counter]], idf: dict[str, float], least_cosine: float) -> tuple[list[dict], set[str]]:
    """A row for each template and word, its weight over the template's length; and words of which a passage has one if it reaches least_cosine."""
    rows, needed = [], set()
    for form, (name, counts) in enumerate(forms):
        weight = {w: n * idf[w] for w, n in counts.items()}
        square = sum(x * x for x in weight.values())
        rows += [{"licence": name, "form": form, "word": w, "t": x / math.sqrt(square)} for w, x in weight.items()]
        share = 0.0
        for w in sorted(weight, key=lambda w: (-weight[w], w)):
            needed.add(w)
            share += weight[w] ** 2 / square
            if share > 1 - least_cosine**2 + 1e-9:
                break
    return rows, needed


def _rows(spark, rows: list[dict], shape: str) -> DataFrame:
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{shape}>>")))


def _literal(ws: list[str]) -> Column:
    return F.split(F.lit(" ".join(ws)), " ")


def passages(text: Column) -> Column:
    """place, whole and words of a text's passages."""
    clean = F.regexp_replace(text, COPYRIGHT, " ")
    lines = F.split(clean, "\n")
    first_code = F.array_position(F.transform(lines, lambda x: x.rlike(COMMENT)), False)
    head = F.when(first_code > 1, F.array(F.array_join(F.slice(lines, 1, F.greatest(first_code - 1, F.lit(0)).cast("int")), "\n"))).otherwise(F.array().cast("array<string>"))
    parts = F.concat(lines, F.split(clean, NO_TEXT), head)
    found = F.transform(parts, lambda x, i: F.struct(i.alias("place"), F.lit(False).alias("whole"), words(x).alias("w")))
    return F.concat(found, F.array(F.struct(F.lit(-1).alias("place"), F.lit(True).alias("whole"), words(clean).alias("w"))))


def scored(files: DataFrame, least_cosine: float = LEAST_COSINE, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """(key, id, path, whole, licence, cosine): the best passage of each kind that reaches least_cosine. files: key, id, path, text; files that share a key are one."""
    spark = files.sparkSession
    forms = [(name, Counter(plain_words(t))) for name, own in (texts or templates()).items() for t in own]
    vocabulary = sorted({w for _, c in forms for w in c})
    total = files.count()
    seen = files.select(F.explode(F.array_intersect(words(F.col("text")), _literal(vocabulary))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    known = {r["word"]: r["n"] for r in seen.collect()}  # words of the templates
    idf = {w: math.log((1 + total) / (1 + known.get(w, 0))) + 1 for w in vocabulary}
    rows, needed = weights(forms, idf, least_cosine)
    unknown = math.log(1 + total) + 1

    needed = _literal(sorted(needed))
    cut = stored(files.where(F.arrays_overlap(words(F.col("text")), needed)), "files").dropDuplicates(["key"])
    cut = cut.select("key", "id", "path", F.explode(F.filter(passages(F.col("text")), lambda p: F.arrays_overlap(p["w"], needed))).alias("p"))
    key = ["key", "id", "path", "place", "whole"]
    counted = cut.select("key", "id", "path", "p.place", "p.whole", F.explode("p.w").alias("word")).where("word <> ''").groupBy(*key, "word").agg(F.count("*").alias("n"))
    terms = _rows(spark, [{"word": w, "idf": x} for w, x in idf.items()], "word:string,idf:double")
    counted = counted.join(F.broadcast(terms), "word", "left").withColumn("v", F.col("n") * F.coalesce("idf", F.lit(unknown)))
    square = F.col("v") * F.col("v")
    vectors = counted.groupBy(*key).agg(F.sum(square).alias("norm"), F.sum(F.when(F.col("idf").isNotNull(), square)).alias("own"), F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("word", "v"))).alias("vector"))
    vectors = vectors.where(F.col("own") >= F.col("norm") * (least_cosine**2 - 1e-9))
    table = F.broadcast(_rows(spark, rows, "licence:string,form:int,word:string,t:double"))
    dots = vectors.select(*key, "norm", F.inline("vector")).join(table, "word").groupBy(*key, "norm", "licence", "form").agg(F.sum(F.col("v") * F.col("t")).alias("dot"))
    cosines = dots.withColumn("cosine", F.round(F.col("dot") / F.sqrt("norm"), 9)).where(F.col("cosine") >= least_cosine)
    best = F.min(F.struct((-F.col("cosine")).alias("less"), F.col("licence")))["licence"]
    return cosines.groupBy("key", "id", "path", "whole").agg(best.alias("licence"), F.max("cosine").alias("cosine"))


def directory(path: Column) -> Column:
    """The names of the directories that hold a file, joined by slashes; '' at the top."""
    return F.array_join(F.filter(F.split(F.regexp_replace(path, r"/?[^/]*$", ""), "/"), lambda x: x != ""), "/")


def above(place: Column) -> Column:
    """A directory and all that hold it, with their depths."""
    names = F.filter(F.split(place, "/"), lambda x: x != "")
    return F.transform(F.sequence(F.lit(0), F.size(names)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(names, 1, i), "/").alias("dir")))


def licence_scan(df: DataFrame, id_col: str = "doc_id", path: str = "path", text: str = "text", least_cosine: float = LEAST_COSINE, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """df with licence, cosine, origin (file, header, inherited or null) and origin_id. texts: each licence's templates, if not templates()."""
    columns = [F.col(id_col), F.col(path), F.col(text)]
    key = F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))
    files = df.where(F.col(text) != "").select(key.alias("key"), columns[0].alias("id"), columns[1].alias("path"), columns[2].alias("text"))
    found = stored(scored(files, least_cosine, texts), "licences")
    whole = found.where("whole AND path IS NOT NULL").withColumn("dir", directory(F.col("path")))
    given = whole.groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("less"), F.col("id"), "licence", "cosine")).alias("given"))

    total = df.count()
    rows = packed(df, key.alias("key"), directory(columns[1]).alias("dir"))
    dirs = rows.where("dir IS NOT NULL").groupBy("dir").agg(F.count("*").alias("n"))
    # Ancestors that have something to give are met by every directory below them.
    up = dirs.select(F.col("dir").alias("of"), F.inline(above(F.col("dir"))))
    asked = given.join(up.groupBy("dir").agg(F.count("*").alias("n")), "dir")
    met = attach(up, asked, "dir", spread(F.col("of")), total).where("given IS NOT NULL")
    nearest = met.groupBy("of").agg(F.max(F.struct("depth", "given"))["given"].alias("given")).withColumnRenamed("of", "dir").join(dirs, "dir")
    own = found.groupBy("key").agg(F.max(F.struct("whole", "licence", "cosine")).alias("own"))
    own = own.join(rows.groupBy("key").agg(F.count("*").alias("n")), "key")
    salt = spread(F.col("key"), F.spark_partition_id())  # rows may be equal in all
    rows = attach(attach(rows, nearest, "dir", salt, total), own, "key", salt, total)
    origin = F.when(F.col("own.whole"), "file").when(F.col("own").isNotNull(), "header").when(F.col("given").isNotNull(), "inherited")
    return rows.select(
        *unpacked("licence", "cosine", "origin", "origin_id", columns=df.columns),
        F.coalesce("own.licence", "given.licence").alias("licence"), F.coalesce("own.cosine", "given.cosine").alias("cosine"), origin.alias("origin"),
        F.when(F.col("own").isNotNull(), numbered(id_col, df.columns)).otherwise(F.col("given.id")).alias("origin_id"),
    )
