r"""Licence scan with DataFrame functions only.

A document is compared as a whole, by paragraph and by line with licence templates. Texts are
normalised (A-Z in lower case, everything but ``a-z0-9`` a blank) and compared by the Dice coefficient
over their distinct word bigrams: ``2 |A and B| / (|A| + |B|)``.

Two bounds prune before any bigram is made. Sizes: with a coefficient of at least ``t``, |A| lies between
``t / (2 - t) |B|`` and ``(2 - t) / t |B|``, so templates are joined by equality on each bigram count they
may meet. Words: a similar text shares at least ``t / (2 - t) |B|`` of a template's bigrams, so it
holds at least one of any ``|B| - that + 1`` of them; one pattern of the longest such bigrams tests
the normalised text, and only texts that hold one go on.

A licence may also stand inside a text as none of these units: several paragraphs or lines of a
header, or a part of a line. Where no unit of a row matches a licence, stretches of as many words as its
template are compared, laid over the text so that one of those bigrams meets its place in the template;
the best stretch that reaches the threshold is one more match.

Defined results: a null or empty text, and one of fewer than two words, matches nothing (its row has no
licence); units of one row that are the same text count once, a licence found by stretches once; ties of the best match go to the
licence that sorts first; each input row gives one row, also with repeated or null ids; other
columns are ignored; without templates nothing matches; empty input gives no rows.
"""

from __future__ import annotations

import re
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

THRESHOLD = 0.8

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} Public "
        "License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} Public License "
        "for more details.")

# Licence notices and short licence texts, by identifier.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                  "permissions and limitations under the License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
           "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
           "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
           "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
           "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
           "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
           "conditions: The above copyright notice and this permission notice shall be included in all copies or "
           "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
           "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
           "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
           "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
           "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
            "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
            "this software for any purpose, including commercial applications, and to alter it and redistribute it "
            "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
            "you must not claim that you wrote the original software. If you use this software in a product, an "
            "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
            "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
            "3. This notice may not be removed or altered from any source distribution.",
    "CC0-1.0-notice": "To the extent possible under law, the author(s) have dedicated all copyright and related and "
                      "neighboring rights to this software to the public domain worldwide. This software is distributed "
                      "without any warranty.",
    "BSD-2-Clause": _BSD.format(""),
    "BSD-3-Clause": _BSD.format("Neither the name of the copyright holder nor the names of its contributors may be used to "
                                "endorse or promote products derived from this software without specific prior written "
                                "permission. "),
    "GPL-2.0-header": _GNU.format("General", "2"),
    "GPL-3.0-header": _GNU.format("General", "3"),
    "LGPL-2.1-header": _GNU.format("Lesser General", "2.1"),
    "LGPL-3.0-header": _GNU.format("Lesser General", "3"),
    "AGPL-3.0-header": _GNU.format("Affero General", "3"),
}


def template_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def least_shared(size: int, t: float) -> int:
    """Fewest bigrams of a template of ``size`` that a similar text holds."""
    return next(k for k in range(size + 1) if k >= t / (2 - t) * size - 1e-9)


def size_range(size: int, t: float) -> range:
    """Bigram counts with which a text can reach the coefficient against ``size`` bigrams."""
    return range(least_shared(size, t), int((2 - t) / t * size + 1e-9) + 1)


def any_of(strings: set[str]) -> str:
    """Pattern that matches where one of ``strings`` begins, as a prefix tree: at most positions of a
    text the first character decides."""
    if "" in strings:
        return ""
    by_first: dict[str, set[str]] = {}
    for x in strings:
        by_first.setdefault(x[0], set()).add(x[1:])
    return "(?:" + "|".join(c + any_of(rest) for c, rest in sorted(by_first.items())) + ")"


def required_bigrams(text: str, t: float) -> set[str]:
    """Bigrams of a template of which every similar text holds at least one."""
    b = sorted(template_bigrams(text), key=lambda x: (-len(x), x))
    return set(b[:len(b) - least_shared(len(b), t) + 1])


def required_pattern(templates: dict[str, str], t: float) -> str:
    """Pattern that every normalised text similar to a template contains."""
    found: set[str] = set()
    for text in templates.values():
        found.update(required_bigrams(text, t))
    return f"(?:^|[ \\n]){any_of(found)}" if found else "(?!)"


def _normal(text: Column) -> Column:
    """Lines and paragraphs stay apart; everything else that is no letter or digit is one blank."""
    return F.regexp_replace(F.translate(text, ascii_uppercase, ascii_lowercase), r"[^a-z0-9\n]+", " ")


def _bigrams(words: Column) -> Column:
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(n > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``id, n_matches, license, score, licenses``: of each row the number of units that match a template, the best
    match with its coefficient, and all matched licences (sorted, comma-joined; empty for none)."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    sizes = [(n, name, b) for name, b in ((k, template_bigrams(v)) for k, v in templates.items()) if b
             for n in size_range(len(b), threshold)]
    known = spark.createDataFrame(sizes, "n int, name string, own array<string>")
    places = [(f"{a} {b}", name, i, len(w)) for name, text in templates.items() for w in [template_words(text)]
              for need in [required_bigrams(text, threshold)] for i, (a, b) in enumerate(zip(w, w[1:])) if f"{a} {b}" in need]
    anchors = spark.createDataFrame(places, "anchor string, inside string, place int, long int")
    longest = max((x[3] for x in places), default=0)
    pattern = required_pattern(templates, threshold)
    normal = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                         _normal(F.col(text_col).cast("string")).alias("t"))
    whole = F.trim(F.regexp_replace("t", r"\s+", " "))
    lines = F.transform(F.split("t", "\n"), lambda x: F.trim(x))
    paragraphs = F.transform(F.split("t", r"\n *\n\s*"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    units = F.filter(F.array_distinct(F.concat(F.array(whole), paragraphs, lines)), lambda x: x.rlike(pattern))
    # most texts hold none of the required bigrams: they are not cut into units at all
    holds = F.replace("t", F.lit("\n"), F.lit(" ")).rlike(pattern)
    found = normal.select("row", "id", F.when(holds, F.struct(units.alias("units"), F.split(whole, " ").alias("all"))).alias("f"))
    found = found.select("row", "id", F.col("f.units").alias("units"), F.col("f.all").alias("all"))
    # what stands around each required bigram, as far as the longest template reaches
    pair = lambda i: F.concat_ws(" ", F.get("all", i - 1), F.get("all", i))
    starts = F.when(F.size("all") > 1, F.filter(F.sequence(F.lit(1), F.size("all") - 1),
                                                lambda i: pair(i).isin(sorted({x[0] for x in places}))))
    around = F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.struct(
        F.lit(None).cast("string").alias("unit"), F.slice("all", F.greatest(F.lit(1), i - longest), F.lit(2 * longest)).alias("w"),
        F.least(i, F.lit(longest + 1)).alias("at"), pair(i).alias("anchor")))
    own_units = F.transform("units", lambda x: F.struct(
        x.alias("unit"), F.split(x, " ").alias("w"), F.lit(0).alias("at"), F.lit(None).cast("string").alias("anchor")))
    items = (found.select("row", "id", F.explode_outer(F.concat(own_units, around)).alias("x")).select("row", "id", "x.*")
                  .join(F.broadcast(anchors), "anchor", "left"))
    start = F.col("at") - F.col("place")
    stretch = F.slice("w", F.greatest(F.lit(1), start), F.col("long") + F.least(F.lit(0), start - 1))
    words = items.select("row", "id", "unit", "inside", F.when(F.col("anchor").isNull(), F.col("w")).otherwise(stretch).alias("w"))
    # distinct bigrams are at most one fewer than words; templates are joined by their exact count
    sized = words.select("row", "id", "unit", "inside", _bigrams(F.col("w")).alias("b")).withColumn("n", F.size("b"))
    met = (sized.join(F.broadcast(known.withColumnRenamed("n", "m")),
                      (F.col("n") == F.col("m")) & (F.coalesce("inside", "name") == F.col("name")), "left")
                .withColumn("score", 2.0 * F.size(F.array_intersect("b", "own")) / (F.col("n") + F.size("own"))))
    hit = F.col("score") >= threshold
    of_unit, match = hit & F.col("inside").isNull(), F.struct((-F.col("score")).alias("s"), F.col("name").alias("k"))
    both = met.groupBy("row", "id").agg(
        F.count_distinct(F.when(of_unit, F.col("unit"))).alias("n_units"),
        F.collect_set(F.when(of_unit, match)).alias("by_unit"),
        F.collect_set(F.when(hit & F.col("inside").isNotNull(), match)).alias("inside"))
    names = F.transform("by_unit", lambda x: x["k"])
    both = both.select("id", "n_units", "by_unit", names.alias("names"), "inside")
    both = both.select("id", "n_units", "by_unit", F.filter("inside", lambda x: ~F.array_contains("names", x["k"])).alias("inside"))
    both = both.select("id", "n_units", "inside", F.concat("by_unit", "inside").alias("hits"))
    out = both.select(
        "id", (F.col("n_units") + F.size(F.array_distinct(F.transform("inside", lambda x: x["k"])))).alias("n_matches"),
        F.array_min("hits")["k"].alias("license"), (-F.array_min("hits")["s"]).alias("score"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["k"]))), ",").alias("licenses"))
    return out.select("id", "n_matches", "license", "score", "licenses")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence matches of all ``documents``. ``ORACLE`` knows whole texts, paragraphs and lines, no stretches."""
    return scan_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _sql_templates() -> str:
    return ", ".join("('%s', ['%s'])" % (k, "', '".join(template_bigrams(v))) for k, v in TEMPLATES.items())


ORACLE = f"""
WITH k(name, own) AS (VALUES {_sql_templates()}),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\n]+', ' ', 'g') AS t FROM documents),
u AS (
  SELECT DISTINCT r, unit FROM (
    SELECT r, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS unit FROM d
    UNION ALL SELECT r, trim(unnest(string_split(t, chr(10)))) FROM d
    UNION ALL SELECT r, trim(regexp_replace(unnest(regexp_split_to_array(t, '\\n *\\n\\s*')), '\\s+', ' ', 'g')) FROM d)
),
b AS (
  SELECT r, unit, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS b
  FROM (SELECT r, unit, string_split(unit, ' ') AS w FROM u)),
m AS (
  SELECT r, unit, name, 2.0::DOUBLE * len(list_intersect(b, own)) / (len(b) + len(own)) AS score
  FROM b, k WHERE len(b) BETWEEN 0.6 * len(own) AND 1.6 * len(own)),
hit AS (SELECT * FROM m WHERE score >= {THRESHOLD}),
g AS (
  SELECT r, count(DISTINCT unit) AS n_matches, max(score) AS score, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses,
         arg_min(name, {{'s': -score, 'n': name}}) AS license FROM hit GROUP BY r)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, license, score, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN g USING (r)
"""
