"""Licence scan by a positional index of rare licence words (op 9, native).

Every template is a word sequence with a label, a share of its words that must
agree, and key phrases that must be there word for word.  The index holds, of
each template, its words of highest IDF: two more than the wrong words a file may
have, so that any alignment good enough is right in two of them.  A file's words
of that index are its rarest licence words; their postings (template, offset)
are intersected by relative position: where two of them name the same
start of the same template, that alignment is compared word by word and its key
phrases are verified.

Templates and postings are tables of data, so the plan does not grow with them.
They are authored and small (``TEMPLATE_WORDS`` in all) and travel as literals.
Everything else happens inside the row of the document: one scan counts in how
many documents each licence word occurs, one scan matches; only the counts of
licence words are shuffled.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TEMPLATE_WORDS = 200_000


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    share: float = 1.0  # of the words that must agree
    keys: tuple[tuple[str, ...], ...] = ()  # phrases that must agree word for word

    @property
    def may_miss(self) -> int:
        return len(self.words) - self.needed

    @property
    def needed(self) -> int:
        return -int(-(len(self.words) * self.share) // 1)

    @property
    def votes(self) -> int:
        """Anchors that any good alignment has right."""
        return min(2, len(self.words) - self.may_miss)

    def key_offsets(self) -> list[tuple[int, tuple[str, ...]]]:
        out = []
        for k in self.keys:
            out.append((next(i for i in range(len(self.words)) if self.words[i : i + len(k)] == k), k))
        return out


def template(label: str, text: str, share: float = 1.0, *keys: str) -> Template:
    split = lambda t: tuple(w for w in re.split(BREAK, t.lower()) if w)
    return Template(label, split(text), share, tuple(split(k) for k in keys))


#: Phrases whose every place counts.
BASE = (
    template("gpl", "gnu general public license"),
    template("apache", "apache license"),
    template("cc-by", "cc by"),
    template("mit", "mit license"),
)
#: Wording that adds labels: names, and the texts of licences by paragraph (names of holders between them differ in length).
MORE = (
    template("bsd", "bsd license"),
    template("lgpl", "gnu lesser general public license", 0.8, "lesser general public license"),
    template("agpl", "gnu affero general public license", 0.8, "affero general public license"),
    template("mpl", "mozilla public license"),
    template("epl", "eclipse public license"),
    template("cc-by-sa", "creative commons attribution sharealike"),
    template("cc-by", "creative commons attribution"),
    template("cc0", "cc0 1 0 universal", 0.75, "cc0"),
    template("gpl", "either version 3 of the license or at your option any later version", 0.8, "any later version"),
    template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software""", 0.8, "permission is hereby granted"),
    template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software.""", 0.8, "without restriction", "substantial portions of the software"),
    template("mit", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
        OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
        ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""", 0.8, "noninfringement", "other dealings in the software"),
    template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted""", 0.8, "source and binary forms"),
    template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution.""", 0.8, "source and binary forms", "this list of conditions"),
    template("bsd", """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
        BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
        NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
        ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
        OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""", 0.8, "procurement of substitute goods", "possibility of such damage"),
    template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies.""", 0.8, "distribute this software"),
    template("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""", 0.8, "apache license", "in compliance with the license"),
    template("apache", """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""", 0.8, "agreed to in writing", "governing permissions and limitations"),
    template("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation""", 0.8, "gnu general public license", "free software foundation"),
    template("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
        as published by the Free Software Foundation""", 0.8, "gnu lesser general public license", "free software foundation"),
    template("agpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License
        as published by the Free Software Foundation""", 0.8, "gnu affero general public license", "free software foundation"),
    template("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
        this file, You can obtain one at https://mozilla.org/MPL/2.0/.""", 0.8, "mozilla public license"),
    template("epl", """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0""", 0.8, "eclipse public license"),
    template("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
        means.""", 0.8, "free and unencumbered software"),
    template("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following restrictions""", 0.8, "alter it and redistribute it freely"),
    template("bsl", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software""", 0.8, "person or organization"),
    template("cc-by", """This work is licensed under a Creative Commons Attribution 4.0 International License""", 0.8, "creative commons attribution 4 0"),
    template("cc-by-sa", """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License""", 0.8, "attribution sharealike 4 0"),
)


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null: none."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(folded, BREAK), lambda w: w != "")


def word_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents with each licence word, over all rows; a row for each word of the templates is all that is collected."""
    own = docs.select(F.explode(F.array_distinct(F.filter(words(F.col("text")), lambda w: w.isin(vocabulary)))).alias("w"))
    return {r["w"]: r["count"] for r in own.groupBy("w").count().collect()}


def anchors(t: Template, frequency: dict[str, int]) -> list[int]:
    """Offsets of the ``may_miss + votes`` rarest words of a template."""
    return sorted(range(len(t.words)), key=lambda i: (frequency.get(t.words[i], 0), i))[: t.may_miss + t.votes]


def table_literal(templates: tuple[Template, ...], n_base: int) -> Column:
    rows = [{"label": t.label, "words": t.words, "needed": t.needed, "votes": t.votes, "base": i < n_base, "keys": [{"at": o, "words": k} for o, k in t.key_offsets()]} for i, t in enumerate(templates)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<label:string,words:array<string>,needed:int,votes:int,base:boolean,keys:array<struct<at:int,words:array<string>>>>>")


def postings_literal(templates: tuple[Template, ...], frequency: dict[str, int]) -> tuple[list[str], Column]:
    """(looked-up words, map of word to its (template, offset) pairs)."""
    posted: dict[str, list] = {}
    for i, t in enumerate(templates):
        for o in anchors(t, frequency):
            posted.setdefault(t.words[o], []).append({"t": i, "o": o})
    return sorted(posted), F.from_json(F.lit(json.dumps(posted)), "map<string,array<struct<t:bigint,o:bigint>>>")


def scan_licenses(docs: DataFrame, base: tuple[Template, ...] = BASE, more: tuple[Template, ...] = MORE) -> DataFrame:
    """Licence phrases and labels of each row of ``docs(doc_id, text)``.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score (1 with a base phrase, else the best share of agreeing words of a
    template that was found, else 0).  Null and empty texts have no words, no
    places and empty label strings.  Repeated rows are each scanned.  Texts of
    any length are scanned whole.
    """
    templates = (*base, *more)
    if sum(len(t.words) for t in templates) > TEMPLATE_WORDS:
        raise ValueError(f"more than {TEMPLATE_WORDS} words in the templates")
    frequency = word_frequencies(docs, sorted({w for t in templates for w in t.words}))
    looked_up, postings = postings_literal(templates, frequency)
    of = table_literal(templates, len(base))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("_words"))
    numbered = F.transform("_words", lambda w, i: F.struct(i.cast("long").alias("pos"), w.alias("word")))
    rows = rows.withColumn("_hits", F.when(F.exists("_words", lambda w: w.isin(looked_up)), F.filter(numbered, lambda h: h["word"].isin(looked_up))))
    # template and start as one number, so that they sort and meet as one
    votes = F.flatten(F.transform("_hits", lambda h: F.transform(F.try_element_at(postings, h["word"]), lambda p: F.shiftleft(p["t"], 40) + h["pos"] - p["o"] + F.lit(1 << 32))))
    rows = rows.withColumn("_votes", F.array_sort(votes))
    named = lambda v: of[F.shiftright(v, 40).cast("int")]
    start = lambda v: (F.pmod(v, F.lit(1 << 40)) - F.lit(1 << 32)).cast("int")
    met = F.filter("_votes", lambda v, i: (named(v)["votes"] < 2) | F.coalesce(F.get("_votes", i + 1) == v, F.lit(False)))
    rows = rows.withColumn("_met", F.array_distinct(met))

    def agreed(v: Column) -> Column:
        same = F.zip_with(F.slice("_words", start(v) + 1, F.size(named(v)["words"])), named(v)["words"], lambda a, b: F.coalesce(a == b, F.lit(False)))
        return F.size(F.filter(same, lambda x: x))

    def phrases(v: Column) -> Column:
        return F.forall(named(v)["keys"], lambda k: F.slice("_words", start(v) + k["at"] + 1, F.size(k["words"])) == k["words"])

    real = F.filter("_met", lambda v: F.when(start(v) >= 0, phrases(v)).otherwise(F.lit(False)))
    found = F.transform(real, lambda v: F.struct(start(v).alias("start"), agreed(v).alias("agreed"), F.size(named(v)["words"]).alias("n"), named(v)["needed"].alias("needed"), named(v)["label"].alias("label"), named(v)["base"].alias("base")))
    rows = rows.withColumn("_found", F.coalesce(F.filter(found, lambda x: x["agreed"] >= x["needed"]), F.array().cast("array<struct<start:int,agreed:int,n:int,needed:int,label:string,base:boolean>>")))
    starts = F.transform(F.filter("_found", lambda x: x["base"]), lambda x: x["start"])
    labels = lambda items: F.array_join(F.array_sort(F.array_distinct(F.transform(items, lambda x: x["label"]))), ",")
    best = F.coalesce(F.array_max(F.transform("_found", lambda x: x["agreed"] / x["n"])), F.lit(0.0))
    out = rows.select("doc_id", F.size("_words").cast("long").alias("n_words"), starts.alias("_starts"), labels(F.filter("_found", lambda x: x["base"])).alias("base_labels"), labels(F.col("_found")).alias("labels"), best.alias("score"))
    return out.select("doc_id", "n_words", F.size("_starts").cast("long").alias("n_base"), F.array_min("_starts").cast("long").alias("first_word"), F.array_max("_starts").cast("long").alias("last_word"), "base_labels", "labels", "score")


def op9_licenses(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle_sql(base: tuple[Template, ...] = BASE, more: tuple[Template, ...] = MORE) -> str:
    """The same result in DuckDB, by trying every place of every template."""
    listed = lambda items: "[" + ", ".join(f"'{x}'" for x in items) + "]"

    def row(i: int, t: Template) -> str:
        own = sorted(set(t.words))
        keys = "[" + ", ".join(f"{{'at': {o}, 'words': {listed(k)}}}" for o, k in t.key_offsets()) + "]" if t.keys else "[]::struct(\"at\" int, words varchar[])[]"
        return f"({i}, '{t.label}', {i < len(base)}, {t.needed}, {max(1, len(own) - t.may_miss)}, {listed(own)}, {listed(t.words)}, {keys})"

    rows = ",\n  ".join(row(i, t) for i, t in enumerate((*base, *more)))
    return f"""
with t(tid, label, base, needed, least, own, phrase, keys) as (values
  {rows}),
d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
p as (select rid, label, base, needed, len(phrase) as n, w, phrase, unnest(list_filter(range(len(w)), lambda s: len(list_filter(keys, lambda k: w[s + k.at + 1 : s + k.at + len(k.words)] = k.words)) = len(keys))) as s
  from d, t where len(list_intersect(w, own)) >= least),
a as (select rid, label, base, n, needed, s, list_sum(list_transform(range(n), lambda j: coalesce((w[s + j + 1] = phrase[j + 1])::int, 0))) as agreed from p),
f as (select * from a where agreed >= needed),
g as (select rid, count(*) filter (base) as n_base, min(s) filter (base) as first_word, max(s) filter (base) as last_word, string_agg(distinct label, ',' order by label) filter (base) as base_labels,
  string_agg(distinct label, ',' order by label) as labels, max(agreed / n) as score from f group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from d left join g using (rid)"""
