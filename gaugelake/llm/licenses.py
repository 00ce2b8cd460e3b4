"""License scans: an exact set-similarity join of text blocks with license templates.

Every run of twice as many words as a template has, wherever lines break, is a block, the set of its
words. It is labelled by every template of which it holds at least the threshold share of the words.
The words of the templates are put in order of their frequency in the whole corpus, rarest first. A
block that holds enough of a template must hold one of the template's first words in that order
(prefix filter), so only the words around such a word are looked at; from its rarest shared word on
it must have enough of the template's words (length and positional filter). What passes is verified
block by block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Labels and the texts that stand for them, in words as the scan reads them. First the notices
# and grants of public licenses, then the short statements by which files name a license. The notices of the
# AGPL and LGPL differ from that of the GPL by a word or two, so their names alone stand for them.
TEMPLATES = (
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
        " with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    ),
    (
        "apache-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is"
        " distributed on an as is basis without warranties or conditions of any kind either express or implied see"
        " the license for the specific language governing permissions and limitations under the license",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met redistributions of source code must retain the above copyright notice"
        " this list of conditions and the following disclaimer redistributions in binary form must reproduce the"
        " above copyright notice this list of conditions and the following disclaimer in the documentation and or"
        " other materials provided with the distribution",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 3 of the license or at your"
        " option any later version",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
        " permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    (
        "mit",
        "the software is provided as is without warranty of any kind express or implied including but not limited to"
        " the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall"
        " the authors or copyright holders be liable for any claim damages or other liability whether in an action"
        " of contract tort or otherwise arising from out of or in connection with the software or the use or other"
        " dealings in the software",
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was"
        " not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish"
        " use compile sell or distribute this software either in source code form or as a compiled binary for any"
        " purpose commercial or non commercial and by any means",
    ),
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "released under the bsd license"),
    ("cc-by", "licensed under a creative commons attribution license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("reserved", "copyright all rights reserved"),
)

_THRESHOLD = 0.9
_SPREAD = 2  # words of a block for every word of the template
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # ASCII but digits and lower-case letters
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str | Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _BETWEEN, -1), "")


def _listed(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _places(words: Column, phrase: str) -> Column:
    """The word numbers at which a phrase begins; only rows that hold its first word are looked through."""
    own = phrase.split()
    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.slice(words, i + 1, len(own)) == _listed(own))
    return F.when(F.array_contains(words, own[0]), starts).otherwise(F.array().cast("array<int>"))


def _ordered(docs: DataFrame, templates: tuple) -> list[str]:
    """The words of the templates, those in the fewest texts first. The driver gets one count per template word."""
    words = sorted({w for _, t in templates for w in t.split()})
    found = docs.select(F.explode(F.array_intersect(_words("text"), _listed(words))).alias("word"))
    count = {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}
    return sorted(words, key=lambda w: (count.get(w, 0), w))


def template_matches(docs: DataFrame, templates: tuple = TEMPLATES, threshold: float = _THRESHOLD) -> DataFrame:
    """All (word, template) pairs of which a block around the word meets the threshold; the word is one of the
    template's first: doc_id, text_hash, at (word number), label, score (of the best such block)."""
    order = _ordered(docs, templates)
    rank = {w: i for i, w in enumerate(order)}
    rows, reach = [], {}
    for label, sentence in templates:
        own = sorted({rank[w] for w in sentence.split()})
        need = math.ceil(round(threshold * len(own), 9))
        width = _SPREAD * len(sentence.split())
        for w in own[: len(own) - need + 1]:
            rows.append((w, label, own, need, width))
            reach[w] = max(reach.get(w, 0), width)
    spark = docs.sparkSession
    prefixes = spark.createDataFrame(rows, "word int, label string, own array<int>, need int, width int")  # a few rows per template
    rare = sorted({r[0] for r in rows})
    numbers = F.create_map(*[F.lit(x) for w in order for x in (w, rank[w])])
    ranks = F.transform(_words("text"), lambda w: F.coalesce(F.element_at(numbers, w), F.lit(-1)))
    # Exploded, so that the ranks are computed once per text and not once per use.
    texts = docs.filter(F.arrays_overlap(_words("text"), _listed([order[r] for r in rare]))).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.array(ranks)).alias("ranks")
    )
    reaches = F.create_map(*[F.lit(x) for w in rare for x in (w, reach[w])])
    first = F.filter(
        F.transform(
            "ranks",
            lambda w, i: F.when(
                w.isin(rare),
                F.struct(
                    i.alias("at"),
                    w.alias("word"),
                    F.element_at(reaches, w).alias("reach"),
                    F.greatest(i - F.element_at(reaches, w) + 1, F.lit(0)).alias("low"),
                ),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    around = F.transform(
        first,
        lambda x: F.struct(
            x["at"].alias("at"),
            x["word"].alias("word"),
            (x["at"] - x["low"]).alias("place"),
            F.slice("ranks", x["low"] + 1, x["at"] + x["reach"] - x["low"]).alias("near"),
        ),
    )
    found = texts.select("doc_id", "text_hash", F.explode(around).alias("x")).select("doc_id", "text_hash", "x.*")
    start = F.greatest(F.col("place") - F.col("width") + 1, F.lit(0))
    block = F.slice("near", start + 1, F.col("place") + F.col("width") - start)
    later = F.filter(F.array_intersect(block, F.col("own")), lambda w: w >= F.col("word"))
    # A best block can begin with a word of the template, the rare word itself at the latest.
    begins = F.filter(
        F.sequence(start, F.col("place")), lambda i: F.array_contains(F.col("own"), F.get(F.col("near"), i))
    )
    most = F.array_max(
        F.transform(
            begins, lambda i: F.size(F.array_intersect(F.slice("near", i + 1, F.col("width")), F.col("own")))
        )
    )
    near = found.join(F.broadcast(prefixes), "word").filter(F.size(later) >= F.col("need"))
    return near.withColumn("most", most).filter(F.col("most") >= F.col("need")).select(
        "doc_id", "text_hash", "at", "label", (F.col("most") / F.size("own")).alias("score")
    )


def scan(docs: DataFrame, templates: tuple = TEMPLATES, threshold: float = _THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (columns doc_id and text; others are ignored): doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score.

    Words are runs outside ASCII signs, A-Z lower-cased. n_base counts the places of all phrases;
    a place is the number of its first word. score is the largest share of a template or phrase
    found, 0 without any. A null text is empty and has no word. Repeated rows give repeated
    results, an empty table an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    matches = template_matches(docs, templates, threshold)
    labelled = matches.groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("more"), F.max("score").alias("best")  # at most one entry per label
    )
    words = F.col("words")
    places = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), _words("text").alias("words")
    ).select(
        "doc_id",
        "text_hash",
        F.size(words).cast("long").alias("n_words"),
        F.array(*[_places(words, p) for p, _ in PHRASES]).alias("found"),
    )
    every = F.flatten("found")
    own = F.filter(
        F.array(*[F.when(F.size(F.col("found")[i]) > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]),
        lambda x: x.isNotNull(),
    )
    rows = places.withColumn("own", F.array_sort(F.array_distinct(own))).withColumn("every", every)
    joined = rows.alias("r").join(
        labelled.withColumnsRenamed({"doc_id": "its_id", "text_hash": "its_hash"}),
        F.col("r.doc_id").eqNullSafe(F.col("its_id")) & (F.col("r.text_hash") == F.col("its_hash")),
        "left",
    )
    more = F.coalesce("more", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"),
        F.array_max("every").cast("long").alias("last_word"),
        F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", more)), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("every") > 0, 1.0).otherwise(0.0)).alias("score"),
    )
