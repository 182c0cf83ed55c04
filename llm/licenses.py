"""Licence scans by a positional rare-token index, in Spark expressions alone.

Every licence template is a sequence of words with mandatory key phrases. The index holds, for each template, the places of its two
mandatory words of highest inverse document frequency over all documents scanned. A file is looked up by these words, the highest-IDF
licence words it can hold; the starts that both words' places give by relative position are intersected, and a start that both agree on
counts if all key phrases stand there. The matched share of IDF weight is the score alone, so a file's labels depend on its own text. A
template whose key phrases are present always has both words in their places, so no start is missed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from llm.exprs import let, lower_ascii, positions

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    """`keys`: mandatory phrases, each standing in `text`; `base`: counted as such."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False


def phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,), True)


def whole(label: str, text: str, *keys: str) -> Template:
    """A template from a licence as it is published."""
    return Template(label, " ".join(re.findall(WORDS, text.lower())), keys)


#: Phrases whose every place counts.
PHRASES = (phrase("mit", "under the mit license"), phrase("apache-2", "apache license version 2"), phrase("cc-by-nc", "cc by nc"))
#: Wordings of licence texts and headers.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files", ("permission is hereby granted free of charge",)),
    Template("apache-2", "you may obtain a copy of the license at http www apache org licenses license 2 0",
             ("www apache org licenses license 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
             "following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("gpl", "licensed under the gnu general public license version", ("gnu general public license",)),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "licensed under the gnu lesser general public license version", ("gnu lesser general public license",)),
    Template("mpl-2", "subject to the terms of the mozilla public license version 2 0", ("mozilla public license",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    # fixed values: the wording of published licences, without their copyright lines
    whole("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
          "permission is hereby granted free of charge"),
    whole("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""", "redistribution and use in source and binary forms"),
    whole("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""", "distribute this software for any purpose with or without fee is hereby granted"),
    whole("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of
this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be
plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered
from any source distribution.""", "permission is granted to anyone to use this software for any purpose including commercial applications"),
)


def words_of(text: Column) -> Column:
    """Words of a whole text, A-Z lower-cased; none for null."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORDS), F.lit(0))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def document_frequencies(docs: DataFrame, vocabulary: Sequence[str]) -> tuple[int, dict[str, int]]:
    """The count of all documents, and for each word of the templates (a fixed list) the number of documents that hold it."""
    found = docs.select(F.explode_outer(F.array_intersect(words_of(F.col("text")), _strings(vocabulary))).alias("word"))
    counted = {r.word: r.n for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return docs.count(), {w: counted.get(w, 0) for w in vocabulary}


def _span(words: list[str], key: list[str]) -> tuple[int, int]:
    for at in range(len(words) - len(key) + 1):
        if words[at:at + len(key)] == key:
            return at, len(key)
    raise ValueError(f"key phrase {' '.join(key)!r} isn't in its template")


def build_index(templates: Sequence[Template], n_documents: int, frequency: dict[str, int]
                ) -> tuple[Column, Column, list[str], list[str]]:
    """Postings (template, two words and their places), templates (words, weights, keys, base, label) as literals, and the words."""
    weight = lambda w: math.log((n_documents + 1) / (frequency.get(w, 0) + 1)) + 1e-9
    postings, forms, rare, also = [], [], set(), set()
    for number, template in enumerate(templates):
        words = template.text.split()
        spans = [_span(words, key.split()) for key in template.keys]
        key_places = sorted({i for a, n in spans for i in range(a, a + n)})
        first = max(key_places, key=lambda i: (weight(words[i]), words[i], -i))
        # a phrase of one word has no second one: its place stands for both
        second = max([i for i in key_places if words[i] != words[first]] or [first], key=lambda i: (weight(words[i]), words[i], -i))
        rare.add(words[first])
        also.add(words[second])
        postings.append(F.struct(F.lit(number).alias("template"), F.lit(words[first]).alias("word"), F.lit(first).alias("at"),
                                 F.lit(words[second]).alias("word_2"), F.lit(second).alias("at_2")))
        forms.append(F.struct(F.lit(template.label).alias("label"), _strings(words).alias("words"),
                              F.array(*[F.lit(weight(w)) for w in words]).alias("weights"), F.array(*map(F.lit, key_places)).alias("keys"),
                              F.lit(template.base).alias("base"),
                              F.lit(math.fsum(map(weight, words))).alias("total")))
    return F.array(*postings), F.array(*forms), sorted(rare), sorted(rare | also)


def _matches(words: Column, postings: Column, forms: Column, rare: list[str], looked: list[str]) -> Column:
    """Verified (label, base, start, score) of a file."""
    meets = F.filter(positions(words), lambda i: F.get(words, i).isin(looked))

    def agreed(m: Column) -> Column:
        by = lambda word, at: F.transform(F.filter(m, lambda p: F.get(words, p) == word), lambda p: p - at)
        return F.flatten(F.transform(postings, lambda x: F.transform(
            F.array_intersect(by(x["word"], x["at"]), by(x["word_2"], x["at_2"])),
            lambda start: F.struct(x["template"].alias("template"), start.alias("start")))))

    starts = let(meets, agreed)

    def check(found: Column) -> Column:
        def at(form: Column) -> Column:
            same = lambda i: F.coalesce(F.get(words, found["start"] + i) == F.get(form["words"], i), F.lit(False))
            held = F.aggregate(positions(form["words"]), F.lit(0.0), lambda acc, i: acc + F.when(same(i), F.get(form["weights"], i)).otherwise(0.0))
            score = F.when(F.forall(form["keys"], same), F.least(held / form["total"], F.lit(1.0))).otherwise(F.lit(-1.0))
            return F.struct(form["label"].alias("label"), form["base"].alias("base"), found["start"].alias("start"), score.alias("score"))

        return let(F.get(forms, found["template"]), at)

    verified = F.filter(F.transform(starts, check), lambda m: m["score"] >= 0)
    return F.when(F.arrays_overlap(words, _strings(rare)), verified)


def scan_licenses(docs: DataFrame, *, phrases: Sequence[Template] = PHRASES, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of all documents.

    Places are word numbers from 0; both label lists are distinct, sorted and joined by commas, empty where nothing is found; score
    is the highest matched share of weight (a phrase's is 1; nothing found: 0). Null and empty texts have no words. Rows that repeat
    give a row each; other columns are ignored. Documents are read twice (frequencies, scan) and never shuffled.
    """
    every = [*phrases, *templates]
    vocabulary = sorted({w for t in every for w in t.text.split()})
    index = build_index(every, *document_frequencies(docs, vocabulary))
    joined = lambda m: F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["label"]))), ",")

    def row(words: Column, found: Column) -> Column:
        base = F.filter(found, lambda m: m["base"])
        places = F.transform(base, lambda m: m["start"])
        return F.struct(F.size(words).cast("bigint").alias("n_words"), F.size(base).cast("bigint").alias("n_base"),
                        F.array_min(places).cast("bigint").alias("first_word"), F.array_max(places).cast("bigint").alias("last_word"),
                        joined(base).alias("base_labels"), joined(found).alias("labels"),
                        F.coalesce(F.array_max(F.transform(found, lambda m: m["score"])), F.lit(0.0)).alias("score"))

    none = F.array().cast("array<struct<label:string,base:boolean,start:int,score:double>>")
    out = let(words_of(F.col("text")), lambda w: let(F.coalesce(_matches(w, *index), none), lambda m: row(w, m)))
    return docs.select(F.col("doc_id").cast("bigint"), out.alias("r")).select("doc_id", "r.*")
