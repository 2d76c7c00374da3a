"""Licence scan: Dice coefficient over word bigrams between texts and licence templates, DataFrame operations only.

Units of a document are its lines, the whole text if it has several, and passages: runs of as many words as a template
has, that begin where one of the template's rare bigrams places it, so that wrapped and embedded licences are found. A
unit's distinct word bigrams A and a template's B match if 2 |A and B| / (|A| + |B|) reaches the threshold. Only lines
and texts whose size lies within the bounds that the threshold sets for some template are looked at, and a unit meets a
template only through one of the template's rarest bigrams: a matching unit must hold one of them, since it may miss
only so many. For the same reason it must hold one of a few telling words: documents without any are passed over before
any word is cut.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

SIMILARITY = 0.8
#: Candidate lines are sent to the documents by broadcast up to so many, beyond by a shuffle.
BROADCAST_LINES = 500_000

# Names and customary wordings of public licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("LicenseRef-proprietary", "All rights reserved."),
)


def template_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def words(text: Column) -> Column:
    """The words of a text in lower case: runs of letters and digits."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def paired(own: Column) -> Column:
    """The distinct bigrams of an array of words."""
    following = F.slice(own, F.lit(2), F.greatest(F.size(own) - 1, F.lit(0)))
    return F.array_distinct(F.zip_with(F.slice(own, F.lit(1), F.greatest(F.size(own) - 1, F.lit(0))), following, lambda a, b: F.concat(a, F.lit(" "), b)))


def bigrams(text: Column) -> Column:
    """The distinct word bigrams of a text."""
    return paired(words(text))


def bounds(size: int, similar: float) -> tuple[int, int]:
    """Bigrams that a text may have to reach `similar` with a template of `size` bigrams."""
    ratio = similar / (2 - similar)
    return math.ceil(size * ratio - 1e-9), math.floor(size / ratio + 1e-9)


def _units(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, line, unit): every line of a text from 0, and as line -1 the text itself if it has several."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).filter("text is not null")
    lines = F.split("text", "\n")
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("unit")))).otherwise(F.array().cast("array<struct<line:int,unit:string>>"))
    each = F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("unit")))
    return rows.select("doc_id", F.inline(F.concat(each, whole)))


def _placed(text: Column) -> Column:
    """The words of a text in order, each with its line from 0."""
    each = F.transform(F.split(text, "\n"), lambda x, i: F.transform(F.filter(words(x), lambda w: w != ""), lambda w: F.struct(w.alias("word"), i.alias("line"))))
    return F.flatten(each)


def rare_bigrams(similar: float, templates: tuple[tuple[str, str], ...]) -> list[tuple[str, int, int, int]]:
    """(bigram, template, least and most bigrams of a unit): a unit that matches a template holds one of its rare bigrams."""
    own = [(k, template_bigrams(t)) for k, (_, t) in enumerate(templates)]
    count: dict[str, int] = {}
    for _, grams in own:
        for g in grams:
            count[g] = count.get(g, 0) + 1
    # bigrams with a long word are rare in other texts
    order = lambda g: (-max(map(len, g.split())), count[g], g)
    return [(g, k, *bounds(len(b), similar)) for k, b in own if b for g in sorted(b, key=order)[: len(b) - math.ceil(len(b) * similar / (2 - similar) - 1e-9) + 1]]


#: Words that most English texts hold: they tell nothing.
COMMON = frozenset("a all an and any are as at be by for from if in is it no not of on or that the this to under with".split())


def telling_words(similar: float, templates: tuple[tuple[str, str], ...]) -> list[str]:
    """Words of which a text must hold one to match any template.

    A unit without any of a template's chosen words lacks every bigram with one of them; they are chosen, long ones and
    those of many templates first, until these are more than a matching unit may lack.
    """
    chosen: set[str] = set()
    own = [set(template_bigrams(t)) for _, t in templates]
    spread: dict[str, int] = {}
    for w in (w for grams in own for w in {w for g in grams for w in g.split()}):
        spread[w] = spread.get(w, 0) + 1
    for grams in sorted((x for x in own if x), key=len):
        may_lack = len(grams) - math.ceil(len(grams) * similar / (2 - similar) - 1e-9)
        left = {g for g in grams if not chosen & set(g.split())}
        while (need := may_lack + 1 - (len(grams) - len(left))) > 0:
            touched: dict[str, int] = {}
            for g in left:
                for w in set(g.split()):
                    touched[w] = touched.get(w, 0) + 1
            best = max(touched, key=lambda w: (w not in COMMON, len(w) > 5, len(w) > 3, min(need, touched[w]), spread[w], len(w), w))
            chosen.add(best)
            left = {g for g in left if best not in g.split()}
    return sorted(chosen)


def anchors(similar: float, templates: tuple[tuple[str, str], ...]) -> list[tuple[str, int, int, int]]:
    """(bigram, template, its place in the template, words of the template) of each template's rare bigrams."""
    rare = {(g, k) for g, k, *_ in rare_bigrams(similar, templates)}
    own = [(k, template_words(t)) for k, (_, t) in enumerate(templates)]
    return [(f"{a} {b}", k, at, len(w)) for k, w in own for at, (a, b) in enumerate(zip(w, w[1:])) if (f"{a} {b}", k) in rare]


def _passages(docs: DataFrame, text: str, doc_id: str, similar: float, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """(doc_id, line, template, grams): runs of as many words as the template has (fewer where the text begins or ends)
    that one of its rare bigrams places, with the line of their first word."""
    spark = docs.sparkSession
    at = spark.createDataFrame(anchors(similar, templates), "gram string, template int, at int, n int")
    placed = docs.select(F.col(doc_id).alias("doc_id"), _placed(F.col(text).cast("string")).alias("own")).filter(F.size("own") > 1)
    following = F.slice("own", F.lit(2), F.size("own") - 1)
    grams = F.zip_with(F.slice("own", F.lit(1), F.size("own") - 1), following, lambda a, b: F.concat(a["word"], F.lit(" "), b["word"]))
    starts = placed.select("doc_id", "own", F.posexplode(grams).alias("pos", "gram")).join(F.broadcast(at), "gram")
    starts = starts.select("doc_id", "template", F.greatest(F.col("pos") - F.col("at"), F.lit(0)).alias("first"), F.slice("own", F.greatest(F.col("pos") - F.col("at"), F.lit(0)) + 1, F.col("n") + F.least(F.col("pos") - F.col("at"), F.lit(0))).alias("run"))
    runs = starts.dropDuplicates(["doc_id", "template", "first", "run"])
    return runs.select("doc_id", F.get("run", F.lit(0))["line"].alias("line"), "template", paired(F.transform("run", lambda x: x["word"])).alias("grams"))


def licence_matches(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similar: float = SIMILARITY, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(doc_id, line, template, licence, size of the template, score): units and templates whose Dice coefficient reaches `similar`.

    line is that of a line or of a passage's first word, from 0, and -1 for a whole text of several lines; the best score
    of a line counts. Null and empty texts and units or templates of fewer than two words match nothing. Rows that
    repeat a doc_id give the distinct matches of their texts together; other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    own = [(k, name, template_bigrams(t)) for k, (name, t) in enumerate(templates)]
    rows = rare_bigrams(similar, templates)
    rare = spark.createDataFrame(rows, "gram string, template int, low int, high int")
    full = spark.createDataFrame([x for x in own if x[2]], "template int, licence string, theirs array<string>")
    low, high = min((r[2] for r in rows), default=0), max((r[3] for r in rows), default=-1)
    lowered = F.lower(F.col(text).cast("string"))
    telling, some = telling_words(similar, templates), F.lit(False)
    for word in (w for w in telling if len(w) > 3):
        some = some | F.contains(lowered, F.lit(word))
    if short := [w for w in telling if len(w) <= 3]:  # as parts of other words they would tell nothing
        some = some | lowered.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(short)})(?![\p{{L}}\p{{N}}])")
    # a small share of the documents goes on; the search for telling words is not repeated for passages
    named = staged(docs.filter(some).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), "licence-documents")
    units = _units(named, "text", "doc_id")
    # a unit of n distinct bigrams has n + 1 words, 2 n + 1 characters at least; longer repetitive ones stay
    sized = units.filter(F.length("unit") > 2 * low).select("doc_id", "line", bigrams(F.col("unit")).alias("grams")).withColumn("n", F.size("grams")).filter(F.col("n").between(low, high))
    met = sized.select("doc_id", "line", "n", F.explode("grams").alias("gram"), "grams").join(F.broadcast(rare), "gram").filter(F.col("n").between(F.col("low"), F.col("high")))
    met = met.select("doc_id", "line", "template", "grams").unionByName(_passages(named, "text", "doc_id", similar, templates))
    score = 2 * F.size(F.array_intersect("grams", "theirs")) / (F.size("grams") + F.size("theirs"))
    pairs = met.join(F.broadcast(full), "template").select("doc_id", "line", "template", "licence", F.size("theirs").alias("size"), score.alias("score")).filter(F.col("score") >= similar)
    return staged(pairs.groupBy("doc_id", "line", "template", "licence", "size").agg(F.max("score").alias("score")), "licence-matches")


def scanned(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similar: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, licence, score, line, n_matches.

    The best match (largest score, then longest, then first template, then first line, the whole text before lines) or
    nulls, and in how many lines of the document (the whole text counts as one more) a licence begins (0 if in none).
    """
    best = F.struct((-F.col("score")).alias("less"), (-F.col("size")).alias("shorter"), "template", "line", "licence")
    found = licence_matches(docs, text, doc_id, similar).groupBy("doc_id").agg(F.min(best).alias("best"), F.count_distinct("line").alias("n_matches"))
    found = staged(found.select(F.col("doc_id").alias("__doc"), "best", "n_matches"), "licence-found")
    few = found.count() <= BROADCAST_LINES
    joined = docs.select(F.col(doc_id).alias("doc_id")).join(F.broadcast(found) if few else found, F.col("doc_id").eqNullSafe(F.col("__doc")), "left")
    return joined.select("doc_id", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("score"), F.col("best.line").alias("line"), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))


def _sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({k}, {quoted(name)}, [{', '.join(map(quoted, template_bigrams(t)))}])" for k, (name, t) in enumerate(TEMPLATES))
    at = ", ".join(f"({quoted(g)}, {k}, {place}, {n})" for g, k, place, n in anchors(SIMILARITY, TEMPLATES))
    return rf"""
WITH t(template, licence, theirs) AS (VALUES {rows}),
a(gram, template, place, n) AS (VALUES {at}),
u AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS unit FROM documents
  UNION ALL SELECT doc_id, -1, text FROM documents WHERE len(string_split(text, chr(10))) > 1),
w AS (SELECT doc_id, line, string_split(trim(regexp_replace(lower(unit), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS words FROM u),
g AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS grams FROM w),
h AS (SELECT doc_id, line, unnest(words) AS word, unnest(range(len(words))) AS i FROM w WHERE line >= 0),
p AS (SELECT doc_id, line, word, row_number() OVER (PARTITION BY doc_id ORDER BY line, i) - 1 AS pos FROM h WHERE word <> ''),
b AS (SELECT doc_id, pos, line, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS gram FROM p),
s AS (SELECT DISTINCT doc_id, template, greatest(pos - place, 0) AS first, pos - place + n AS ends FROM b JOIN a ON a.gram = b.gram),
q AS (SELECT s.doc_id, s.template, s.first, s.ends, min(b.line) AS line, list_distinct(list(CASE WHEN b.pos + 1 < s.ends THEN b.gram END) FILTER (b.pos + 1 < s.ends AND b.gram IS NOT NULL)) AS grams
  FROM s JOIN b ON b.doc_id = s.doc_id AND b.pos BETWEEN s.first AND s.ends - 1 GROUP BY 1, 2, 3, 4),
m AS (SELECT doc_id, line, template, licence, len(theirs) AS size, 2.0 * len(list_intersect(grams, theirs)) / (len(grams) + len(theirs)) AS score
  FROM g JOIN t ON len(grams) BETWEEN len(theirs) * {SIMILARITY} / {2 - SIMILARITY} - 1 AND len(theirs) * {2 - SIMILARITY} / {SIMILARITY} + 1
  UNION ALL SELECT doc_id, line, q.template, licence, len(theirs), 2.0 * len(list_intersect(grams, theirs)) / (len(grams) + len(theirs)) FROM q JOIN t ON q.template = t.template),
f AS (SELECT doc_id, count(DISTINCT line) AS n_matches, arg_min({{'l': licence, 's': score, 'i': line}}, (-score, -size, template, line)) AS best
  FROM m WHERE score >= {SIMILARITY} GROUP BY doc_id)
SELECT d.doc_id, best.l AS licence, CAST(best.s AS DOUBLE) AS score, CAST(best.i AS INT) AS line, coalesce(n_matches, 0) AS n_matches
FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id
"""


OP5_SQL = _sql()
