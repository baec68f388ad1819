"""License notices by diagonal voting of word k-grams against templates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewright.llm.words import Words, buffers, grams, lower_bytes, words
from namewright.sources.staging import stage

#: Phrases and their labels; fixed values.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Labels and the notices they stand for; public license texts, fixed values.
TEMPLATES = (
    ("mit-notice", "Released under the MIT License"),
    ("mit-notice", "Licensed under the MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to "
     "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
     "the Software is furnished to do so, subject to the following conditions"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("apache-text", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-text", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-notice", "Licensed under CC BY-NC 4.0"),
    ("cc-by-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense-text", "This is free and unencumbered software released into the public domain"),
    # Whole texts.
    ("mit-license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
     "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
     "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
     "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
     "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd-2-license", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
     "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
     "disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
     "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
     "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
     "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
     "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
     "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("bsd-3-license", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
     "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
     "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the "
     "names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
     "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
     "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
     "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
     "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
     "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
     "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("isc-license", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
     "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
     "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
     "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
     "OF THIS SOFTWARE."),
    ("zlib-license", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
     "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
     "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be "
     "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
     "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
     "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("boost-license", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
     "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to "
     "prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
     "following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the "
     "following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless "
     "such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
     "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
     "any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
     "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
     "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
     "under copyright law."),
    ("apache-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
     "express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
     "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR "
     "A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License "
     "along with this program. If not, see https://www.gnu.org/licenses/."),
)


@dataclass(frozen=True)
class Voting:
    k: int = 4
    #: Diagonals this near to one another are one band: words inserted or left out between them.
    band: int = 3
    #: Share of a template's k-grams that a span must hold.
    coverage: float = 0.6
    #: Words of a span per template word, at most.
    stretch: float = 1.5


def license_scan(
    documents: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    voting: Voting = Voting(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """License labels of whole texts; one row per input row.

    Columns: id, n_words, n_base, first_word, last_word, base_labels, labels (arrays), spans (array of label, first word, last word, score),
    score. Words are runs of letters and digits, every non-ASCII character counting as a letter, A-Z taken as a-z.

    Base labels are the phrases whose words stand consecutively. Beyond them, all k-grams of words are joined by their rolling hashes
    to the places of the templates; a pair whose words differ falls away. A hit votes for the diagonal, place in the text less place in the template;
    diagonals next to one another that overlap in the text are merged, so that an inserted or missing word does not split a notice. A merged
    span is verified: its k-grams must cover enough of the template, within little more than the template's length. A text that holds most of
    two templates has both labels; their scores tell them apart. A template of fewer than k words is never found.

    One pass over the texts yields the hashes and words of a row as arrays; exploded, they stream by the broadcast templates (a row a different
    k-gram of the templates, whatever the corpus), and only hits and a row a text are written. A row's hits are grouped by row, template
    and diagonal; texts are never shuffled.

    Null text is empty: no words, no labels, score 0. Repeated rows are scanned alike; a null id stays null.
    """
    scanned = documents.select(
        F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text")
    ).mapInArrow(
        lambda batches: _scan(batches, phrases, voting.k),
        "_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, _hashes array<long>, _words array<string>",
    )
    scanned = scanned.withColumn("_row", F.monotonically_increasing_id())
    whole = ("_row", "_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    exploded = scanned.select(*whole, "_words", F.posexplode_outer("_hashes").alias("place", "_hash"))
    said = F.array_join(F.slice("_words", F.col("place") + 1, F.lit(voting.k)), " ")
    joined = exploded.join(F.broadcast(_template_places(documents.sparkSession, templates, voting.k)), "_hash", "left")
    joined = joined.where("_at IS NOT NULL OR coalesce(place, 0) = 0").withColumn("_at", F.filter("_at", lambda at: at["gram"] == said))
    found = stage(joined.select(*whole, F.coalesce(F.col("place").cast("long"), F.lit(0)).alias("place"), "_at"), "license-hits")
    spans = _spans(found.select("_row", "place", F.inline("_at")), voting)
    spans = spans.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("first_word", "last_word", "label", "score"))).alias("spans")
    )
    none = F.array().cast("array<struct<first_word: long, last_word: long, label: string, score: double>>")
    rows = found.where("place = 0").drop("place", "_at").join(spans, "_row", "left").withColumn("spans", F.coalesce("spans", none))
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("spans", lambda s: s["label"]))))
    best = F.greatest(F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0))
    return rows.select(
        F.col("_id").alias(id_column), "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), "spans",
        best.alias("score"),
    )


def _template_places(spark: SparkSession, templates: tuple[tuple[str, str], ...], k: int) -> DataFrame:
    """(_hash, _at): each different k-gram of the templates, with its places and its words."""
    places: dict[int, list[tuple[int, str, int, str, int]]] = {}
    for number, (label, text) in enumerate(templates):
        found = _plain_words(text)
        said = [" ".join(found[i : i + k]) for i in range(len(found) - k + 1)]
        for start, code in enumerate(_gram_hashes([text], k).view(np.int64).tolist()):
            places.setdefault(code, []).append((number, label, start, said[start], len(said)))
    at = "array<struct<_template: int, label: string, _start: long, gram: string, _grams: long>>"
    return spark.createDataFrame(list(places.items()), f"_hash long, _at {at}")


def _spans(hits: DataFrame, voting: Voting) -> DataFrame:
    """(_row, label, first_word, last_word, score) of the verified spans."""
    keys = ["_row", "_template", "label", "_grams"]
    diagonals = hits.groupBy(*keys, (F.col("place") - F.col("_start")).alias("_diagonal")).agg(
        F.count("*").alias("_votes"), F.min("place").alias("_first"), F.max("place").alias("_last"),
        F.collect_set("_start").alias("_covered"),
    )
    order = Window.partitionBy("_row", "_template").orderBy("_diagonal", "_first")
    apart = (F.col("_diagonal") - F.lag("_diagonal").over(order) > voting.band) | (
        F.col("_first") - F.lag("_last").over(order) > F.col("_grams")
    )
    bands = diagonals.withColumn("_apart", F.coalesce(apart, F.lit(False)).cast("int"))
    bands = bands.withColumn("_band", F.sum("_apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = bands.groupBy(*keys, "_band").agg(
        F.min("_first").alias("first_word"), (F.max("_last") + voting.k - 1).alias("last_word"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_covered")))).alias("_n_covered"),
    )
    score = F.col("_n_covered") / F.col("_grams")
    length = F.col("last_word") - F.col("first_word") + 1
    whole = (score >= voting.coverage) & (length <= voting.stretch * (F.col("_grams") + voting.k - 1))
    return merged.where(whole).select("_row", "label", "first_word", "last_word", score.alias("score"))


def _plain_words(text: str) -> list[str]:
    (found,) = words(pa.array([text]))
    raw = text.encode()
    return [raw[a:b].lower().decode() for a, b in zip(found.starts, found.ends, strict=True)]


def _gram_hashes(phrases: list[str], k: int) -> np.ndarray:
    (found,) = words(pa.array(phrases))
    hashes, whole = grams(found, k)
    return hashes[whole]


def _scan(batches: Iterator[pa.RecordBatch], phrases: dict[str, str], k: int) -> Iterator[pa.RecordBatch]:
    by_length: dict[int, list[tuple[np.uint64, str, str]]] = {}
    for phrase, label in phrases.items():
        n = len(phrase.split(" "))
        by_length.setdefault(n, []).append((_gram_hashes([phrase], n)[0], phrase, label))
    for batch in batches:
        offsets, data = buffers(batch.column("_text"))
        n = len(batch)
        counts, places, labels = np.zeros(n, np.int64), [[] for _ in range(n)], [set() for _ in range(n)]
        rolled, said = [], []
        for part in words(batch.column("_text")):
            counts[part.first : part.first + len(part.counts)] = part.counts
            for length, wanted in by_length.items():
                hashes, whole = grams(part, length)
                for code, phrase, label in wanted:
                    for row, place, text in _texts(part, np.flatnonzero((hashes == code) & whole), length, offsets, data):
                        if text == phrase:
                            places[row].append(place)
                            labels[row].add(label)
            hashes, whole = grams(part, k)
            rolled.append(hashes[whole].view(np.int64))
            said.append(word_column(part, offsets, data))
        flat = np.concatenate([*rolled, np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"), pa.array(counts), pa.array([len(p) for p in places], pa.int64()),
                pa.array([min(p, default=None) for p in places], pa.int64()), pa.array([max(p, default=None) for p in places], pa.int64()),
                pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                _lists(np.maximum(counts - k + 1, 0), pa.array(flat)), _lists(counts, pa.concat_arrays([*said, pa.array([], pa.string())])),
            ],
            names=["_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "_hashes", "_words"],
        )


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def word_column(part: Words, offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """The words of these rows one after another, A-Z as a-z."""
    shift = np.repeat(offsets[part.first : part.first + len(part.counts)], part.counts)
    starts, lengths = part.starts + shift, part.ends - part.starts
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    places = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(places), pa.py_buffer(lower_bytes(data[at])))


def _texts(
    part: Words, at: np.ndarray, k: int, offsets: np.ndarray, data: np.ndarray
) -> Iterator[tuple[int, int, str]]:
    """(row of the batch, place in the row, words) of the k-grams at these places."""
    begins = part.begins
    rows = np.searchsorted(begins, at, side="right") - 1
    for place, row in zip(at.tolist(), rows.tolist(), strict=True):
        base = offsets[part.first + row]
        found = (bytes(data[base + part.starts[i] : base + part.ends[i]]).lower().decode("utf-8", "replace") for i in range(place, place + k))
        yield part.first + row, place - int(begins[row]), " ".join(found)
