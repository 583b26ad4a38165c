"""Operator 2: licences of files, by sparse TF-IDF cosine to templates and by inheritance from directories. DataFrame operations only.

Candidate headers are the lines of a text, up to ``LINES`` lines in a row, and its sentences, which may be wrapped over lines or
stand inside a paragraph. Of a line or sentence above ``WINDOW_CHARS`` characters the candidates are its windows of as many words as a template
has. ``headers`` compares each with the templates in the space of TF-IDF weights: a term's
inverse document frequency is counted over all texts, a candidate's other words weigh as words that no text has. It can only
reach the cosine ``LEAST`` with a template if it holds one of the template's heavier words, as the lighter ones alone are
shorter than ``LEAST`` of its length; candidates without any such word are left out before words are compared, which loses nothing.

``whole_texts`` compares whole files with the wording of the licences themselves, as sparse vectors: files that hold enough of a
wording's weight to reach ``LEAST`` (no others can) are exploded to words with counts and joined with the weights of the wordings.

``scan`` gives each file the licence of its SPDX line, else that of its whole text, else that of its best header. A file whose
text is a licence, that is little more than its header, or that has a header and a name like LICENSE or COPYING, is the licence file of its directory. Files without a header inherit from the licence file of the nearest directory above them: each distinct directory
is joined with its ancestors' licences once, then files with their directory.

Defined cases: a null text has no header; a file without a path inherits nothing; of several headers the best wins, of equal ones
the licence first in the alphabet; of several licence files in one directory the best, then the first path. A file's first SPDX line counts. Repeated rows
are files like others. Empty tables give an empty result. Other columns are ignored. Templates are a list of at most
``MAX_TEMPLATES`` texts, so their words may be part of the plan.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, keep, let, stored, table

LEAST, MAX_TEMPLATES = 0.75, 1000
#: A file whose header has this share of its words is a licence file of its directory.
FILE_SHARE = 0.3
FILE_NAME = r"(?i)(?:^|/)(?:un)?(?:licen[cs]e|copying)(?:[.-][^/]*)?$"
LINES, WINDOW_CHARS = 3, 1000
#: Sentences end at a mark before white space, but not after "v.", and at lines without a letter or digit.
SENTENCE_END = r"(?<!\bv)[.!?;](?=\s)|\n[^\p{L}\p{N}\n]*\n"
NOT_WORD = r"[^\p{L}\p{N}.]+|\.(?![\p{L}\p{N}])"
#: Licence and wording of its usual notice: fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
#: Licence and its own wording, without the line that names the holder: fixed values, public texts.
TEXTS = (
    ("BSD-2-Clause", _BSD_2 + _WARRANTY_BSD),
    (
        "BSD-3-Clause",
        _BSD_2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission. " + _WARRANTY_BSD,
    ),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY_MIT,
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions "
        "that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an "
        "overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. " + _WARRANTY_MIT,
    ),
)
SPDX = r"SPDX-License-Identifier:\s*\(?([A-Za-z0-9.+-]+)"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def _terms(text: str) -> list[str]:
    """The words of a template; the same rule as ``words``."""
    return [w for w in re.split(r"[^\w.]+|\.(?!\w)", text.lower()) if w]


def _unit_vectors(bags: list[tuple[str, Counter]], idf: dict[str, float]) -> tuple[list[tuple[str, dict[str, float]]], set[str]]:
    """The templates' weights at length 1, and the words of which a text must hold one to reach ``LEAST`` with any of them."""
    heavy: set[str] = set()
    vectors = []
    for name, bag in bags:
        weight = {w: times * idf[w] for w, times in bag.items()}
        length = math.sqrt(sum(x * x for x in weight.values()))
        vectors.append((name, {w: x / length for w, x in weight.items()}))
        rest = 1.0
        for w, x in sorted(vectors[-1][1].items(), key=lambda kv: (-kv[1], kv[0])):
            if rest < LEAST * LEAST:
                break
            heavy.add(w)
            rest -= x * x
    return vectors, heavy


def _mark(heavy: set[str]) -> str:
    pattern = "|".join(re.escape(w) for w in sorted(heavy))
    return rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{pattern})(?![\p{{L}}\p{{N}}])"


def _literals(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    structs = [F.struct(*(F.lit(x).alias(n) for x, n in zip(row, names))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def whole_texts(files: DataFrame, templates=TEXTS, text: str = "text", into: str = "whole") -> DataFrame:
    """``files`` with a struct column ``into``: licence and score of the wording that the whole text is nearest to; null below ``LEAST``."""
    bags = [(name, Counter(_terms(body))) for name, body in templates]
    vocabulary = sorted({w for _, bag in bags for w in bag})
    n, held = _frequencies(files, text, vocabulary)
    idf = {w: math.log((1 + n) / (1 + held.get(w, 0))) + 1 for w in vocabulary}
    vectors, heavy = _unit_vectors(bags, idf)

    def enough(terms: Column) -> Column:
        """A cosine is at most the length of the part of the template that the text has words of."""
        reach = F.lit(False)
        for _, vector in vectors:
            weights = F.create_map(*(x for w, v in sorted(vector.items()) for x in (F.lit(w), F.lit(v * v))))
            share = F.aggregate(terms, F.lit(0.0), lambda total, w: total + F.coalesce(weights[w], F.lit(0.0)))
            reach = reach | (share >= LEAST * LEAST - 1e-9)
        return reach

    known = F.array_intersect(words(F.col(text)), F.array(*(F.lit(w) for w in vocabulary)))
    likely = F.coalesce(F.when(F.rlike(F.col(text), F.lit(_mark(heavy))), let(known, enough)), F.lit(False))
    key = fresh(files, "file_key")
    some = stored(files.filter(likely).withColumn(key, F.monotonically_increasing_id()), "likely")
    spark = files.sparkSession
    # the templates' words, as rows of literals
    idfs = _literals(spark, [(w, x) for w, x in sorted(idf.items())], ("word", "idf"))
    rows = [(name, number, w, x) for number, (name, vector) in enumerate(vectors) for w, x in sorted(vector.items())]
    weights = _literals(spark, rows, ("licence", "number", "word", "weight"))
    counts = some.select(key, F.explode(words(F.col(text))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("times"))
    weighed = counts.join(F.broadcast(idfs), "word", "left").withColumn("w", F.col("times") * F.coalesce("idf", F.lit(math.log(1 + n) + 1)))
    lengths = weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = weighed.join(F.broadcast(weights), "word").groupBy(key, "licence", "number").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(lengths, key).select(key, F.struct((-F.col("dot") / F.col("length")).alias("minus"), "licence").alias("x"))
    best = scored.groupBy(key).agg(F.min("x").alias("x")).filter(F.col("x.minus") <= -LEAST)
    found = best.select(key, F.struct(F.col("x.licence").alias("licence"), (-F.col("x.minus")).alias("score")).alias(into))
    none = F.lit(None).cast("struct<licence: string, score: double>").alias(into)
    return some.join(found, key, "left").select(*files.columns, into).unionByName(files.filter(~likely).select("*", none))


def _frequencies(files: DataFrame, text: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of texts, and how many of them hold each template word."""
    terms = F.array(*(F.lit(w) for w in vocabulary))
    held = F.array_intersect(words(F.col(text)), terms)
    counted = files.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(held, F.array().cast("array<string>")))).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in counted.collect()}  # a row per template word
    return counts.get("", 0), counts


def headers(files: DataFrame, templates=TEMPLATES, text: str = "text", into: str = "header") -> DataFrame:
    """``files`` with a struct column ``into``: licence, score and share (of the file's words in the header); null without one."""
    if not 0 < len(templates) <= MAX_TEMPLATES:
        raise ValueError(f"from 1 to {MAX_TEMPLATES} templates")
    bags = [(name, Counter(_terms(body))) for name, body in templates]
    vocabulary = sorted({w for _, bag in bags for w in bag})
    n, held = _frequencies(files, text, vocabulary)
    idf = {w: math.log((1 + n) / (1 + held.get(w, 0))) + 1 for w in vocabulary}
    unknown = math.log(1 + n) + 1
    vectors, heavy = _unit_vectors(bags, idf)
    mark = _mark(heavy)
    sizes = sorted({sum(bag.values()) for _, bag in bags})
    weights = F.create_map(*(x for w in vocabulary for x in (F.lit(w), F.lit(idf[w]))))

    def times(terms: Column, word: Column) -> Column:
        return F.size(F.filter(terms, lambda x: x == word))

    def compare(line: Column) -> Column:
        """Best (score, licence) of a line and its number of words."""

        def with_words(terms: Column) -> Column:
            def squared(w: Column) -> Column:
                weight = F.coalesce(weights[w], F.lit(unknown))
                return weight * weight * times(terms, w) * times(terms, w)

            length = F.sqrt(F.aggregate(F.array_distinct(terms), F.lit(0.0), lambda total, w: total + squared(w)))
            scores = []
            for name, vector in vectors:
                dot = F.lit(0.0)
                for w, x in sorted(vector.items()):
                    dot = dot + times(terms, F.lit(w)) * F.lit(x * idf[w])
                scores.append(F.struct((-dot / length).alias("minus"), F.lit(name).alias("licence")))
            best = F.array_min(F.array(*scores))
            return F.struct(best["minus"].alias("minus"), best["licence"].alias("licence"), F.size(terms).alias("n"))

        return let(words(line), with_words)

    def windows(terms: Column) -> Column:
        """Of a long text: windows of as many words as a template has, around each of its heavy words."""
        marks = F.array(*(F.lit(w) for w in sorted(heavy)))
        at = F.filter(F.transform(terms, lambda w, n: F.when(F.array_contains(marks, w), n)), lambda n: n.isNotNull())

        def around(size: int) -> Column:
            last = F.greatest(F.size(terms) - size, F.lit(0))
            starts = F.transform(at, lambda n: F.sequence(F.greatest(n - size + 1, F.lit(0)), F.greatest(F.least(n, last), F.greatest(n - size + 1, F.lit(0)))))
            return F.transform(F.array_distinct(F.flatten(starts)), lambda n: F.array_join(F.slice(terms, n + 1, F.lit(size)), " "))

        return F.concat(*(around(size) for size in sizes))

    def candidates(lines: Column) -> Column:
        def rows(k: int) -> Column:
            return F.transform(lines, lambda _, n: F.array_join(F.slice(lines, n + 1, F.lit(k)), " "))

        parts = F.concat(*(rows(k) for k in range(2, LINES + 1)), F.split(F.col(text), SENTENCE_END))
        short = F.filter(parts, lambda x: F.length(x) <= WINDOW_CHARS)
        long = F.filter(F.concat(lines, parts), lambda x: (F.length(x) > WINDOW_CHARS) & F.rlike(x, F.lit(mark)))
        cut = F.flatten(F.transform(long, lambda x: let(words(x), windows)))
        return F.array_distinct(F.concat(F.filter(lines, lambda x: F.length(x) <= WINDOW_CHARS), short, cut))

    marked = F.filter(let(F.split(F.col(text), "\n"), candidates), lambda x: F.rlike(x, F.lit(mark)))
    best = F.array_min(F.transform(marked, compare))
    total = F.size(words(F.col(text)))
    header = let(
        best,
        lambda b: F.when(
            b["minus"] <= -LEAST, F.struct(b["licence"].alias("licence"), (-b["minus"]).alias("score"), (b["n"] / total).alias("share"))
        ),
    )
    return files.withColumn(into, F.when(F.rlike(F.col(text), F.lit(mark)), header))


def _parent(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def scan(files: DataFrame, path: str = "path", text: str = "text", templates=TEMPLATES, texts=TEXTS) -> DataFrame:
    """One row per file: its other columns, licence, score, found ('header', 'inherited' or 'none') and licence_path."""
    header, whole, where = fresh(files, "header"), fresh(files, "whole"), fresh(files, "directory")
    spdx = F.nullif(F.regexp_replace(F.regexp_extract(F.col(text), SPDX, 1), "(-only|-or-later|\\+)$", ""), F.lit(""))
    compared = headers(whole_texts(files, texts, text, whole), templates, text, header)
    told = F.struct(spdx.alias("licence"), F.lit(1.0).alias("score"), F.lit(0.0).alias("share"))
    t = F.col(whole)
    by_text = F.struct(t["licence"].alias("licence"), t["score"].alias("score"), F.lit(1.0).alias("share"))
    found = compared.withColumn(header, F.when(spdx.isNotNull(), told).when(t.isNotNull(), by_text).otherwise(F.col(header)))
    found = keep(found.withColumn(where, _parent(F.col(path))).drop(text, whole))
    h = F.col(header)
    ranked = F.struct((-h["score"]).alias("minus"), F.col(path).alias("path"), h["licence"].alias("licence"))
    owned = found.filter(((h["share"] >= FILE_SHARE) | h.isNotNull() & F.col(path).rlike(FILE_NAME)) & F.col(path).isNotNull()).groupBy(F.col(where).alias("above")).agg(F.min(ranked).alias("own"))
    # every directory below which there are files, with each directory above it and itself
    steps = F.split(F.col(where), "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
    chain = found.filter(F.col(path).isNotNull()).select(where).distinct().select(where, F.explode(F.array_distinct(above)).alias("above"))
    nearest = chain.join(owned, "above").groupBy(where).agg(F.max_by("own", F.length("above")).alias("own"))
    inherited = fresh(found, "inherited")
    out = found.join(nearest.withColumnRenamed("own", inherited), where, "left")
    i = F.col(inherited)
    names = [c for c in files.columns if c != text]
    return out.select(
        *names,
        F.coalesce(h["licence"], i["licence"]).alias("licence"),
        F.coalesce(h["score"], -i["minus"]).alias("score"),
        F.when(h.isNotNull(), "header").when(i.isNotNull(), "inherited").otherwise("none").alias("found"),
        F.when(h.isNotNull(), F.col(path)).otherwise(i["path"]).alias("licence_path"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the source is the repository, the language a directory in it, and the id the name."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    files = docs.select("doc_id", path.alias("path"), "text")
    return scan(files).select("doc_id", "path", "licence", F.round("score", 6).alias("score"), "found", "licence_path")
