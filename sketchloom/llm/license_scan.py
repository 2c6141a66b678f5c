"""License scans: a positional index of rare licence words, matched by relative position, then key phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words_of, written

# The phrases whose places are counted, and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
# Licence notices and bodies as words, with their labels and the phrases each must have.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", ["permission is hereby granted free of charge"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", ["unless required by applicable law or agreed to in writing", "governing permissions and limitations"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["under the terms of the gnu general public license"]),
    ("lgpl", "gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "gnu affero general public license", ["affero general public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
    ("cc0", "cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ["redistributions of source code must retain the above copyright notice"]),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ["endorse or promote products derived from this software"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ["if a copy of the mpl was not distributed with this file"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify", "with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", ["in no event will the authors be held liable", "alter it and redistribute it freely"]),
    ("bsl-1.0", "boost software license version 1 0", ["boost software license"]),
    ("mit", "spdx license identifier mit", ["spdx license identifier mit"]),
    ("apache-2.0", "spdx license identifier apache 2 0", ["spdx license identifier apache 2 0"]),
    ("gpl-2.0", "spdx license identifier gpl 2 0", ["spdx license identifier gpl 2 0"]),
    ("gpl-3.0", "spdx license identifier gpl 3 0", ["spdx license identifier gpl 3 0"]),
    ("lgpl", "spdx license identifier lgpl", ["spdx license identifier lgpl"]),
    ("agpl", "spdx license identifier agpl", ["spdx license identifier agpl"]),
    ("bsd", "spdx license identifier bsd 2 clause", ["spdx license identifier bsd 2 clause"]),
    ("bsd-3-clause", "spdx license identifier bsd 3 clause", ["spdx license identifier bsd 3 clause"]),
    ("mpl-2.0", "spdx license identifier mpl 2 0", ["spdx license identifier mpl 2 0"]),
    ("isc", "spdx license identifier isc", ["spdx license identifier isc"]),
    ("unlicense", "spdx license identifier unlicense", ["spdx license identifier unlicense"]),
    ("cc0", "spdx license identifier cc0 1 0", ["spdx license identifier cc0 1 0"]),
    ("apache-2.0", "apache 2 0", ["apache 2 0"]),
]
# Words too common to be looked up.
COMMON = frozenset("a all and any are as by for in is of or that the this to under use with without not 0 1 2 3 4".split())


def places(words: Column, found: Column, phrase: str) -> Column:
    """The starts at which the phrase's words stand, by the places of its first word that is not common."""
    parts = phrase.split()
    k = next(i for i, w in enumerate(parts) if w not in COMMON)

    def fits(x: Column) -> Column:
        hit = x["word"] == parts[k]
        for i, w in enumerate(parts):
            if i != k:
                hit = hit & F.coalesce(F.get(words, x["pos"] + (i - k)) == w, F.lit(False))
        return hit

    return F.transform(F.filter(found, fits), lambda x: x["pos"] - k)


def scan_licenses(docs: DataFrame, look_up: int = 8, least_score: float = 0.6) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    Words are counted from 0. The `look_up` rarest words of each template, by their document
    frequency over all documents, are looked up in every document; all their places meet the
    templates' postings, and places that agree on where a template begins are counted. A template's
    label is given when `least_score` or more of its looked-up words agree and its key phrases stand
    in the text, whatever other notices do. score is the best such share, at least 0.5 where a base
    phrase stands, else 0.

    Null text counts as empty, which has no words and no labels. Repeated rows are scanned one by
    one; an empty table gives no rows; other columns are left out. Of words that equally many
    documents hold, the first in order of letters is the rarer; of places with equal shares it does
    not matter which counts.
    """
    spark = docs.sparkSession
    rare = [[(w, i) for i, w in enumerate(text.split()) if w not in COMMON] for _, text, _ in TEMPLATES]
    vocabulary = sorted({w for t in rare for w, _ in t})
    phrases = sorted({p for _, _, needed in TEMPLATES for p in needed})
    need = [F.array(*[F.lit(phrases.index(p)) for p in needed]) for _, _, needed in TEMPLATES]
    known = sorted({w for t in [*phrases, *(p for p, _ in BASE)] for w in t.split() if w not in COMMON}.union(vocabulary))

    words, met = F.col("words"), F.col("met")
    texts = docs.select("doc_id", words_of(F.col("text")).alias("words")).withColumn(
        "met", F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(known), F.struct(w.alias("word"), i.alias("pos")))))
    )
    read = written(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size(words).cast("long").alias("n_words"),
            F.filter(met, lambda x: x["word"].isin(vocabulary)).alias("found"),
            F.when(F.size(met) > 0, F.array_compact(F.array(*[F.when(F.size(places(words, met, p)) > 0, F.lit(i)) for i, p in enumerate(phrases)])))
            .otherwise(F.array().cast("array<int>"))
            .alias("stands"),
            *[places(words, met, p).alias(f"base{k}") for k, (p, _) in enumerate(BASE)],
        ),
        "licences",
    )

    seen = read.select(F.explode(F.array_distinct(F.col("found.word"))).alias("w")).groupBy("w").count().collect()
    often = {r.w: r["count"] for r in seen}  # a row for each word of the templates at most
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (often.get(w, 0), w)))}
    chosen = [sorted({w for w, _ in t}, key=rank.get)[:look_up] for t in rare]
    looked = {w: rank[w] for t in chosen for w in t}
    ranks = F.create_map(*[F.lit(x) for w, i in looked.items() for x in (w, i)])
    scanned = (
        read.withColumn("found", F.filter("found", lambda x: x["word"].isin(list(looked))))
        .withColumn("found", F.transform("found", lambda x: F.struct(F.element_at(ranks, x["word"]).alias("rank"), x["pos"].alias("pos"))))
        .withColumn("all_base", F.flatten(F.array(*[F.col(f"base{k}") for k in range(len(BASE))])))
        .select(
            "row",
            "doc_id",
            "n_words",
            F.size("all_base").cast("long").alias("n_base"),
            F.array_min("all_base").cast("long").alias("first_word"),
            F.array_max("all_base").cast("long").alias("last_word"),
            F.array_compact(F.array(*[F.when(F.size(f"base{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)])).alias("base"),
            "stands",
            F.explode_outer("found").alias("hit"),
        )
    )
    postings = spark.createDataFrame(
        [(rank[w], t, i, float(len(chosen[t]))) for t in range(len(TEMPLATES)) for w, i in rare[t] if w in chosen[t]],
        "p_rank int, template int, p_pos int, most double",
    )
    needs = F.element_at(F.array(*need), F.col("template") + 1)
    labels = F.element_at(F.array(*[F.lit(label) for label, _, _ in TEMPLATES]), F.col("template") + 1)
    own = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    agreed = (
        scanned.join(F.broadcast(postings), F.col("hit.rank") == F.col("p_rank"), "left")
        .groupBy(*own, "stands", "template", "most", (F.col("hit.pos") - F.col("p_pos")).alias("begins"))
        .agg(F.count_distinct("p_rank").alias("agree"))
        .withColumn("share", F.least(F.lit(1.0), F.col("agree") / F.col("most")))
        .withColumn("given", (F.col("share") >= least_score) & (F.size(F.array_except(needs, "stands")) == 0))
    )
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return (
        agreed.groupBy(*own)
        .agg(F.collect_set(F.when(F.col("given"), labels)).alias("more"), F.max(F.when(F.col("given"), F.col("share"))).alias("best"))
        .select(
            *own[1:6],
            joined("base").alias("base_labels"),
            joined(F.concat("base", "more")).alias("labels"),
            F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
        )
    )
