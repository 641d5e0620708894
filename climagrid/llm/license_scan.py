"""License notices found by votes of word k-grams on diagonals."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from climagrid.llm.line_dedup import ascii_lower

#: A word: a run of ASCII letters, digits and characters beyond ASCII (Java and Python alike).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The phrases that always count.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Notices as their licenses word them, with the label that a found one adds.
NOTICES = [
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of "
        "the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "mit",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "mit",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT.",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
    ),
    (
        "apache",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a "
        "perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license "
        "to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, "
        "and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU General Public License for more details.",
    ),
    (
        "gpl",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ),
    (
        "bsd",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    (
        "bsd",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    (
        "bsd",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "bsd",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    (
        "isc",
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
    (
        "zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions",
    ),
    (
        "boost",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy "
        "of the software and accompanying documentation covered by this license",
    ),
    (
        "epl",
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License",
    ),
    (
        "cc",
        "You are free to share, copy and redistribute the material in any medium or format, and adapt, "
        "remix, transform, and build upon the material for any purpose, even commercially.",
    ),
]

PHRASE_WORDS, NOTICE_WORDS = 2, 4
#: Diagonals this near belong to one place: so many words may be added or left out at a time.
NEIGHBOURS = 4
#: Share of a notice's k-grams that a place must hold, and its most words per notice word.
COVERAGE, STRETCH = 0.6, 2.0

_MARK = 0  # stands for a document in the join, found or not


def words_of(text: str) -> list[str]:
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    return re.findall(WORD, lowered)


def _grams(spark: SparkSession, notices: list[tuple[str, str]]) -> DataFrame:
    """All k-grams of the phrases and notices with their positions: bounded by these lists."""
    rows = []
    texts = [(label, phrase, True) for phrase, label in PHRASES.items()]
    texts += [(label, notice, False) for label, notice in notices]
    for number, (label, text, base) in enumerate(texts):
        words, k = words_of(text), PHRASE_WORDS if base else NOTICE_WORDS
        if len(words) < k:
            raise ValueError(f"notice of fewer than {k} words: {text}")
        for at in range(len(words) - k + 1):
            gram = words[at : at + k]
            padded = gram + [None] * (NOTICE_WORDS - k)
            rows.append((number, label, base, k, at, len(words) - k + 1, " ".join(gram), *padded))
    names = [f"w{i}" for i in range(NOTICE_WORDS)]
    frame = spark.createDataFrame(
        rows,
        "template int, label string, base boolean, k int, at int, grams int, gram string, "
        + ", ".join(f"{n} string" for n in names),
    )
    hashed = frame.withColumn("h", F.xxhash64("k", *names)).drop(*names)
    mark = spark.createDataFrame([(None, None, False, 0, 0, 1, "", _MARK)], hashed.schema)
    return hashed.union(mark)


def _gram_hash(k: int) -> Column:
    following = [F.get(F.col("words"), F.col("pos") + i) for i in range(1, k)]
    return F.xxhash64(F.lit(k), F.col("word"), *following)


def votes(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """A row for each k-gram of a document that is one of a notice, and one with no template each.

    ``row`` tells the documents' rows apart. All rolling k-grams of all words meet the notices'
    k-grams in a broadcast join; the words of those that meet are compared.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)).alias("words"),
    ).withColumn("n_words", F.size("words"))
    placed = split.select(
        "row", "doc_id", "n_words", "words",
        F.posexplode(F.concat("words", F.array(F.lit("")))).alias("pos", "word"),
    )
    hashes = F.when(F.col("pos") == F.col("n_words"), F.array(F.lit(_MARK).cast("bigint"))).otherwise(
        F.array(_gram_hash(PHRASE_WORDS), _gram_hash(NOTICE_WORDS))
    )
    hashed = placed.select("row", "doc_id", "n_words", "words", "pos", F.explode(hashes).alias("h"))
    met = hashed.join(F.broadcast(_grams(docs.sparkSession, notices)), "h")
    same = F.array_join(F.slice("words", F.col("pos") + 1, F.col("k")), " ") == F.col("gram")
    marked = F.col("template").isNull() & (F.col("pos") == F.col("n_words"))
    return met.where(marked | (F.col("template").isNotNull() & same)).select(
        "row", "doc_id", "n_words", "template", "label", "base", "k", "grams", "pos", "at"
    )


def scan_licenses(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """Per document its number of words, the places of the base phrases, labels and a score.

    A vote's diagonal is its word's position less its position in the notice. Votes are counted per
    document, notice and diagonal; diagonals of a notice within ``NEIGHBOURS`` of each other are one
    place, which then covers words added or left out. A place counts if it holds ``COVERAGE`` of the
    notice's k-grams within ``STRETCH`` times its length, and adds the notice's label. For the base
    phrases, a place is one diagonal with every k-gram, that is, the phrase itself.

    ``score`` is the largest share of a notice or phrase that a counted place holds, else 0. Only
    votes and one row per document are shuffled. A null or empty text has no words; without places
    the positions are null, the labels empty. Rows with null or repeated ``doc_id`` each give a row;
    other columns are ignored; an empty table gives no rows. A very long text is one row with the list of
    its words.
    """
    found = votes(docs, notices).withColumn("diagonal", F.col("pos") - F.col("at"))
    document = ["row", "doc_id", "n_words"]
    template = ["template", "label", "base", "grams"]
    diagonals = (
        found.repartition("row")
        .groupBy(*document, *template, "diagonal")
        .agg(
            F.collect_set("at").alias("held"),
            F.min("pos").alias("first"),
            F.max(F.col("pos") + F.col("k")).alias("end"),
        )
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > NEIGHBOURS
    opened = diagonals.withColumn("opens", (F.col("base") | F.coalesce(apart, F.lit(True))).cast("int"))
    placed = opened.withColumn("place", F.sum("opens").over(order))
    places = placed.groupBy(*document, *template, "place").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"),
        F.min("first").alias("first"),
        F.max("end").alias("end"),
    )
    share = F.col("held") / F.col("grams")
    span = F.col("end") - F.col("first")
    near = (share >= COVERAGE) & (span <= STRETCH * (F.col("grams") + NOTICE_WORDS - 1))
    base = F.col("base") & (F.col("held") == F.col("grams"))
    judged = places.withColumns({"is_base": base, "counts": base | (F.col("template").isNotNull() & ~F.col("base") & near)})

    def labels(which: str) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(F.col(which), F.col("label")))), ",")

    start = F.when(F.col("is_base"), F.col("first").cast("bigint"))
    return judged.groupBy(*document).agg(
        F.count(F.when(F.col("is_base"), 1)).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        labels("is_base").alias("base_labels"),
        labels("counts").alias("labels"),
        F.coalesce(F.max(F.when(F.col("counts"), share)), F.lit(0.0)).alias("score"),
    ).select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), "n_base", "first_word",
        "last_word", "base_labels", "labels", "score",
    )
