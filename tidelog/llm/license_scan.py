"""Licence scan with a positional index of rare licence words.

The words of the licence templates are counted over all documents; the index holds, for each
template, its INDEXED words of highest inverse document frequency with their positions. Every
occurrence of an indexed word in a file votes for (template, file position - template position);
votes of different words at one relative position place the template in the file if at least half of
its indexed words agree. All of the template's mandatory phrases must stand in the file too, and none
of those that mark a relative.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import letter_words
from tidelog.llm.decontamination import _words_sql
from tidelog.sources.shared import written

#: Phrases that are always reported, with their labels (fixed values).
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"),
        ("cc by nc", "cc-by-nc")]
# --- Fixed values: label, header, mandatory phrases and phrases that exclude relatives ------
GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of "
       "the GNU {0}General Public License as published by the Free Software Foundation, either "
       "version {1} of the License, or (at your option) any later version.")
CREATIVE = "This work is licensed under a Creative Commons {0} 4.0 International License"
BSD = ("Redistribution and use in source and binary forms, with or without modification, are "
       "permitted provided that the following conditions are met: Redistributions of source code "
       "must retain the above copyright notice, this list of conditions and the following "
       "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
       "list of conditions and the following disclaimer in the documentation and/or other materials "
       "provided with the distribution.")
BSD_NAME = (" Neither the name of the copyright holder nor the names of its contributors may be used "
            "to endorse or promote products derived from this software without specific prior "
            "written permission.")
HEADERS = [
    ("mit", "Released under the MIT License", ["mit license"], []),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software.",
     ["permission is hereby granted free of charge", "without limitation the rights to use"], []),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies.",
     ["permission to use copy modify and", "with or without fee is hereby granted"], []),
    ("apache-2", "Licensed under the Apache License, Version 2.0", ["apache license version 2"], []),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
     ["apache license version 2", "you may not use this file except in compliance"], []),
    ("gpl-3", "This work is licensed under the GNU General Public License version 3",
     ["gnu general public license version 3"], []),
    ("gpl-2", "This work is licensed under the GNU General Public License version 2",
     ["gnu general public license version 2"], []),
    *[(f"{name}-{version}", GNU.format(kind, version),
       [f"gnu {kind.lower()}general public license as published", f"version {version} of the license"], [])
      for name, kind, versions in (("gpl", "", "23"), ("lgpl", "Lesser ", "3"), ("agpl", "Affero ", "3"))
      for version in versions],
    ("lgpl-2.1", GNU.format("Lesser ", "2.1"),
     ["gnu lesser general public license as published", "version 2 1 of the license"], []),
    ("lgpl-3", "Licensed under the GNU Lesser General Public License version 3",
     ["gnu lesser general public license version 3"], []),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"], ["cc by nc sa", "cc by nc nd"]),
    ("cc-by", CREATIVE.format("Attribution"), ["creative commons attribution 4 0"], []),
    *[(label, CREATIVE.format(f"Attribution-{kind}"),
       [f"creative commons attribution {kind.replace('-', ' ').lower()} 4 0"], [])
      for label, kind in (("cc-by-sa", "ShareAlike"), ("cc-by-nc", "NonCommercial"),
                          ("cc-by-nd", "NoDerivatives"), ("cc-by-nc-sa", "NonCommercial-ShareAlike"),
                          ("cc-by-nc-nd", "NonCommercial-NoDerivatives"))],
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or "
     "neighboring rights to this work", ["waived all copyright and related or neighboring rights"], []),
    ("bsd-2", BSD, ["redistributions of source code must retain the above copyright notice",
                    "redistributions in binary form must reproduce"],
     ["neither the name of", "advertising materials mentioning", "the end user documentation"]),
    ("bsd-3", BSD + BSD_NAME, ["redistributions of source code must retain the above copyright notice",
                               "neither the name of", "endorse or promote products"],
     ["advertising materials mentioning", "the end user documentation"]),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
     "If a copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/.", ["subject to the terms of the mozilla public license v 2 0"], []),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is "
     "free to copy, modify, publish, use, compile, sell, or distribute this software",
     ["unencumbered software released into the public domain"], []),
]
# --- End of fixed values --------------------------------------------------------------------
Template = tuple[str, str, list[str], list[str]]
#: The same with headers as words, lower-case and parted by one blank.
TEMPLATES: list[Template] = [
    (label, " ".join(re.findall("[a-z0-9]+", text.lower())), must, never)
    for label, text, must, never in HEADERS]
#: Words of a template in the index, and the share of them that must agree on its place.
INDEXED, SHARE = 8, 0.5


def _starts(words: Column, phrase: str, among: Column | None = None) -> Column:
    """Where the phrase's words stand consecutively. The array is walked only if the phrase's
    longest word occurs in it, or all its words in ``among``, the array's distinct ones of interest."""
    parts = phrase.split(" ")
    empty = F.array().cast("array<int>")
    at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0))),
                  lambda i: reduce(lambda a, b: a & b, (
                      F.get(words, i + k).eqNullSafe(F.lit(p)) for k, p in enumerate(parts))))
    if among is not None:
        return F.when(reduce(lambda a, b: a & b, (
            F.array_contains(among, p) for p in sorted(set(parts), key=lambda p: (-len(p), p)))),
            at).otherwise(empty)
    return F.when(F.array_contains(words, max(parts, key=lambda p: (p not in ("license", "under"),
                                                                    len(p)))), at).otherwise(empty)


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """Contract of op8, one row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    The score is 1 with a base phrase, else the largest share of a placed template's indexed
    words that agree on its place, 0 without one. A null text is empty: no words, no labels,
    score 0. Repeated rows get the same result each; an empty table gives an empty result.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = _phrases(templates)
    vocabulary = sorted({w for text in (*(t[1] for t in templates), *phrases) for w in text.split(" ")})
    lexicon = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")
    worded = docs.select("doc_id", F.xxhash64("text").alias("tag"),
                         letter_words(F.col("text")).alias("words"))
    base = [_starts(F.col("words"), p) for p, _ in BASE]
    gate = F.array_intersect(F.col("words"), lexicon)
    rows = worded.select("doc_id", "tag", "words", gate.alias("own"),
                         *(b.alias(f"b{k}") for k, b in enumerate(base)))
    said = [F.when(F.size(_starts(F.col("words"), phrase, F.col("own"))) > 0, F.lit(k))
            for k, phrase in enumerate(phrases)]
    places = F.filter(
        F.transform(F.col("words"), lambda w, i: F.struct(i.alias("p"), w.alias("w"))),
        lambda x: F.array_contains("own", x["w"]))
    starts = F.flatten(F.array(*(f"b{k}" for k in range(len(BASE)))))
    labels = F.array_compact(F.array(*(
        F.when(F.size(f"b{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE))))
    rows = rows.select(
        "doc_id", "tag", F.size("words").cast("long").alias("n_words"), "own",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_distinct(labels).alias("base"),
        F.array_compact(F.array(*said)).cast("array<int>").alias("said"), "words")
    # Positions of licence words, only where a phrase stands.
    rows = rows.select("*", F.when(F.size("said") > 0, places).alias("places")).drop("words")
    rows = written(rows, "license_rows")

    # One row per licence word at most.
    counts = {r[0]: r[1] for r in rows.select(F.explode("own").alias("w")).groupBy("w").count()
              .collect()}
    postings = []
    for k, (label, text, must, never) in enumerate(templates):
        parts = text.split(" ")
        need, bar = [phrases.index(p) for p in must], [phrases.index(p) for p in never]
        rare = sorted({w for w in parts if w in counts}, key=lambda w: (counts[w], w))[:INDEXED]
        postings += [(w, k, q, label, len(rare), need, bar)
                     for q, w in enumerate(parts) if w in rare]
    shape = "w string, k int, q int, label string, rare int, need array<int>, bar array<int>"
    index = docs.sparkSession.createDataFrame(postings, shape)
    votes = rows.filter(F.size("places") > 0).select(
        "doc_id", "tag", "said", F.explode("places").alias("x")).select(
        "doc_id", "tag", "said", "x.p", "x.w").join(F.broadcast(index), "w").filter(
        F.expr("size(array_except(need, said)) = 0 and not arrays_overlap(bar, said)"))
    placed = votes.groupBy(
        "doc_id", "tag", "k", (F.col("p") - F.col("q")).alias("offset"), "label", "rare").agg(
        F.countDistinct("w").alias("votes")).filter(F.col("votes") >= SHARE * F.col("rare"))
    found = placed.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(
        F.collect_set("label").alias("more"),
        F.max(F.col("votes") / F.col("rare")).alias("share"))
    none = F.array().cast("array<string>")
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.col("tag") == F.col("_tag")), "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",")
        .alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(
            F.coalesce("share", F.lit(0.0))).alias("score"))


def _phrases(templates: list[Template]) -> list[str]:
    """The distinct mandatory and excluding phrases, in order."""
    return list(dict.fromkeys(p for _, _, must, never in templates for p in (*must, *never)))


def _sql() -> str:
    base = "\n  union all ".join(
        f"select r, i, '{label}' as label from (select r, w, unnest(range(0, len(w) - {n} + 1)) as i "
        f"from d where len(w) >= {n}) where w[i + 1:i + {n}] = {phrase.split(' ')!r}"
        for phrase, label in BASE for n in [len(phrase.split(' '))])
    words = ", ".join(f"({k}, {q}, '{w}', '{label}')" for k, (label, text, _, _) in
                      enumerate(TEMPLATES) for q, w in enumerate(text.split(" ")))
    rules = ", ".join(f"({k}, ' {p} ', {must})" for k, t in enumerate(TEMPLATES)
                      for must, some in ((True, t[2]), (False, t[3])) for p in some)
    return f"""
with d as (select row_number() over () as r, doc_id, {_words_sql('text')} as w from documents),
base as ({base}),
t(k, q, w, label) as (values {words}), rule(k, phrase, must) as (values {rules}),
e as (select r, i - 1 as p, w[i] as w from (select r, w, unnest(range(1, len(w) + 1)) as i from d)
  where w[i] in (select w from t)),
df as (select w, count(distinct r) as n from e group by w),
ranked as (select k, w, row_number() over (partition by k order by n, w) as place
  from (select distinct k, w from t) join df using (w)),
idx as (select t.*, (select count(*) from ranked b where b.k = t.k and place <= {INDEXED}) as rare
  from t join ranked using (k, w) where place <= {INDEXED}),
votes as (select r, k, label, rare, p - q as o, count(distinct e.w) as votes
  from e join idx on e.w = idx.w group by all having votes >= {SHARE} * rare),
fits as (select p.r, p.k from (select distinct r, k from votes) p join rule using (k) join d using (r)
  group by p.r, p.k
  having bool_and(contains(' ' || array_to_string(d.w, ' ') || ' ', phrase) = must)),
good as (select v.* from votes v join fits using (r, k)),
found as (select r, list(distinct label) as more, max(votes / rare) as share from good group by r),
b as (select r, count(*) as n, min(i) as f, max(i) as l, list(distinct label) as labels
  from base group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_base, f as first_word,
  l as last_word, coalesce(array_to_string(list_sort(labels), ','), '') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(more, [])))), ',')
    as labels,
  case when n > 0 then 1.0 else coalesce(share, 0) end::double as score
from d left join b using (r) left join found using (r)
"""


ORACLE = _sql()
