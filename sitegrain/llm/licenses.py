"""License scan: fixed phrases, and an exact set-similarity join of text blocks with notice templates.

Texts are cut into overlapping windows of words (blocks), so that every stretch of a template's
length lies whole in one of them. A block matches a template if it holds at least ``threshold``
of the template's distinct words. Template words are ordered by their frequency in all documents,
rarest first; a block that matches must hold one of the first ``size - required + 1`` (the
prefix), and by the place of the first one that it holds, the words that follow must suffice
(the positional filter); blocks shorter than ``required`` cannot match (the length filter).
Every pair that passes is verified, so the join finds all matches and no others.

Defined results: a null text is empty; repeated rows are scanned one by one; a text without any
match has null words, empty labels and score 0; an empty table gives an empty result; other
columns are not read. ``score`` is the largest containment found, or 1 where a phrase stands.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm.common import ascii_lower, whole_text

# Phrases and labels of the base.
PHRASES = (
    (("mit", "license"), "mit"),
    (("apache", "license"), "apache"),
    (("general", "public", "license"), "gpl"),
)
# Short forms, opening sentences and whole texts of public license notices.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    # Whole notices.
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
            "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
            "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
               "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
               "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
               "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
               "specific language governing permissions and limitations under the License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
            "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
            "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
            "https://www.gnu.org/licenses/."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
            "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
            "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
            "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
            "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
            "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
            "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
            "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
            "POSSIBILITY OF SUCH DAMAGE."),
)
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
THRESHOLD = 0.9
STRIDE = 16  # the smallest stride; a template belongs to the first of 16, 64, 256, ... that holds its words, a block is two strides long


def words_of(text: str) -> list[str]:
    """The words of a template."""
    return re.findall(LETTERS, text.lower())


def stride_of(text: str) -> int:
    stride = STRIDE
    while stride < len(words_of(text)):
        stride *= 4
    return stride


def required(size: int, threshold: float) -> int:
    return math.ceil(size * threshold - 1e-9)


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, text in templates for w in words_of(text)})


def word_frequency(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """How often each of ``words`` stands in all documents, whatever its case; one number for each."""
    found = (
        docs.select(F.explode(F.regexp_extract_all(F.lower(whole_text()), F.lit(LETTERS), F.lit(0))).alias("word"))
        .where(F.col("word").isin(words)).groupBy("word").count()
    )
    return dict.fromkeys(words, 0) | {r["word"]: r["count"] for r in found.collect()}


def template_rows(frequency: dict[str, int], threshold: float = THRESHOLD, templates=TEMPLATES) -> list[tuple]:
    """(template, label, stride, words rarest first, required) of each template."""
    rows = []
    for i, (label, text) in enumerate(templates):
        ordered = sorted(set(words_of(text)), key=lambda w: (frequency[w], w))
        rows.append((i, label, stride_of(text), ordered, required(len(ordered), threshold)))
    return rows


def phrase_places(words: Column, phrase: tuple[str, ...]) -> Column:
    """The places (from 0) where the phrase's words stand one after the other."""
    def here(i: Column) -> Column:
        test = F.get(words, i) == phrase[0]
        for k, w in enumerate(phrase[1:], 1):
            test = test & (F.coalesce(F.get(words, i + k), F.lit("")) == w)
        return test

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def blocks(words: Column, prefixes: dict[int, list[str]]) -> Column:
    """The blocks that hold a prefix word: structs of stride and distinct words."""
    out = []
    for stride, tokens in prefixes.items():
        keys = F.array(*map(F.lit, tokens))
        places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(keys, F.get(words, i)))
        windows = F.array_distinct(F.flatten(F.transform(
            places,
            lambda i: F.array(F.floor(i / stride).cast("int"), F.greatest(F.floor(i / stride).cast("int") - 1, F.lit(0))),
        )))
        out.append(F.transform(windows, lambda w: F.struct(
            F.lit(stride).alias("stride"),
            F.array_distinct(F.slice(words, w * stride + 1, F.lit(2 * stride))).alias("words"),
        )))
    return F.concat(*out)


def scan_licenses(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = template_rows(word_frequency(docs, vocabulary(templates)), threshold, templates)
    prefix = {i: words[: len(words) - need + 1] for i, _, _, words, need in rows}
    prefixes = {s: sorted({w for i, _, stride, _, _ in rows if stride == s for w in prefix[i]}) for s in sorted({row[2] for row in rows})}
    prefixes = {s: tokens for s, tokens in prefixes.items() if tokens}
    index = F.broadcast(spark.createDataFrame(
        [(stride, token, label, words, place, need)
         for i, label, stride, words, need in rows for place, token in enumerate(prefix[i])],
        "t_stride int, t_token string, t_label string, t_words array<string>, t_place int, t_need int",
    ))

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).withColumn(
        "small", F.lower("text")
    )
    keys = sorted({"license", *(t for tokens in prefixes.values() for t in tokens)})
    gate = F.lit(False)
    for key in keys:
        gate = gate | F.contains("small", F.lit(key))
    count = F.regexp_count("text", F.lit(ANY_CASE)).cast("long")
    places = [phrase_places(F.col("words"), phrase) for phrase, _ in PHRASES]
    all_places = F.concat(*(F.col(f"p{k}") for k in range(len(PHRASES))))
    read = (
        base.select(
            F.monotonically_increasing_id().alias("uid"), "doc_id", count.alias("n_words"),
            F.when(gate, F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(LETTERS), F.lit(0)))
            .otherwise(F.array().cast("array<string>")).alias("words"),
        )
        .select("*", *(F.when(F.size("words") > 0, p).otherwise(F.array().cast("array<int>")).alias(f"p{k}") for k, p in enumerate(places)))
        .select(
            "uid", "doc_id", "n_words",
            F.size(all_places).cast("long").alias("n_base"),
            F.array_min(all_places).cast("long").alias("first_word"),
            F.array_max(all_places).cast("long").alias("last_word"),
            F.array_compact(F.array(*(F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(PHRASES)))).alias("base"),
            F.explode_outer(
                F.when(F.size("words") > 0, blocks(F.col("words"), prefixes))
                .otherwise(F.array().cast("array<struct<stride:int,words:array<string>>>"))
            ).alias("block"),
        )
    )
    tokens = F.array_intersect("block.words", F.array(*map(F.lit, sorted({t for v in prefixes.values() for t in v}))))
    pairs = read.withColumn("token", F.explode_outer(tokens)).join(
        index, (F.col("block.stride") == F.col("t_stride")) & (F.col("token") == F.col("t_token")), "left"
    )
    # A pair counts once, at the first prefix word that the block holds.
    first = F.element_at(F.array_intersect("t_words", "block.words"), 1) == F.col("token")
    size = F.size("t_words")
    fits = first & (F.size("block.words") >= F.col("t_need")) & (size - F.col("t_place") >= F.col("t_need"))
    overlap = F.when(fits, F.size(F.array_intersect("t_words", "block.words")))
    found = overlap >= F.col("t_need")
    merged = pairs.groupBy("uid", "doc_id", "n_words", "n_base", "first_word", "last_word", "base").agg(
        F.collect_set(F.when(found, F.col("t_label"))).alias("more"),
        F.max(F.when(found, overlap / size)).alias("containment"),
    )
    return merged.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "more")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def oracle_sql(threshold: float = THRESHOLD, templates=TEMPLATES) -> str:
    """The same result in SQL, every block compared with every template."""
    values = ", ".join(
        f"({i}, '{label}', {stride_of(t)}, {sorted(set(words_of(t)))}, "
        f"{len(set(words_of(t)))}, {required(len(set(words_of(t))), threshold)})"
        for i, (label, t) in enumerate(templates)
    )
    strides = ", ".join(f"({s})" for s in sorted({stride_of(t) for _, t in templates}))
    phrases = ", ".join(f"({list(p)}, '{label}')" for p, label in PHRASES)
    return f"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents
), tpl(i, label, stride, ws, size, need) as (values {values}), phr(ph, label) as (values {phrases}),
w as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as pos from d),
places as (
  select doc_id, pos, phr.label from d join w using (doc_id), phr where word = ph[1] and list_slice(ws, pos + 1, pos + len(ph)) = ph
), base as (
  select doc_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word, list(distinct label) as labels from places group by doc_id
), b as (
  select distinct doc_id, stride, pos // stride - k as block, word
  from w, (values {strides}) s(stride), (values (0), (1)) o(k) where pos // stride - k >= 0
), m as (
  select doc_id, tpl.i, tpl.label, tpl.size, tpl.need, block, count(*) as hit
  from b join tpl on b.stride = tpl.stride and list_contains(tpl.ws, b.word) group by all
), found as (select doc_id, list(distinct label) as labels, max(hit / size) as score from m where hit >= need group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') as labels,
  case when n_base > 0 then 1.0 else coalesce(found.score, 0.0) end as score
from d left join base using (doc_id) left join found using (doc_id)
"""
