"""License scans: an exact set-similarity join of licence templates with text blocks.

A template is the set of words of a notice; a block is any run of ``block_words``
consecutive words, wherever it starts.  A block matches when it contains at least
``threshold`` of a template's words, so of a template of n words at least
o = ceil(threshold * n) must stand in the block.

* Tokens are ordered by how many words of the corpus they are, rarest first, counted
  over all rows.  A block with o template words has one of the template's first n - o + 1
  tokens (prefix filter), so only occurrences of these few rare tokens are joined.
* All blocks with the occurrence lie within the words around it.  The template-vocabulary
  tokens of these, put in the same order, must number at least o (length filter), and the
  tokens from the shared one on must suffice on both sides (positional filter).
* What is left is verified by counting the words in common, block by block.  A block that
  starts with a word of no use loses nothing by starting later, so blocks that start with
  a word of the template stand for all.

Fixed phrases are templates too, with threshold 1, so their prefix is their rarest word;
an occurrence is verified by comparing the words around it in order.

Words never leave their row: the row is unnested into (position, word) and joined with
the small prefix table there, and only hits are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Phrases whose places are counted, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Wording of common licence notices, and the label of each.  Notices that
#: differ in a word or two only have one label, since either contains most of the other.
NOTICES = (
    ("you may not use this file except in compliance with the license you may obtain a copy"
     " of the license at http www apache org licenses license 2 0", "apache-2"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this"
     " software and associated documentation files to deal in the software without"
     " restriction", "mit"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms"
     " of the gnu general public license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are"
     " permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("permission to use copy modify and or distribute this software for any purpose with or"
     " without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this work is licensed under a creative commons attribution 4 0 international license",
     "creative-commons"),
    ("this program and the accompanying materials are made available under the terms of the"
     " eclipse public license", "epl"),
    ("all rights reserved", "all-rights-reserved"),
)

#: Characters that stand between words once A-Z are lower case.
_BETWEEN = "".join(chr(c) for c in range(128) if not (chr(c).isalnum()))
_BETWEEN_RUN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The one character whose lower case is an ASCII letter although it is none itself.
_KELVIN, _OTHER_SIGN = "K", "Ω"


def _words(text: Column) -> Column:
    """Words of a text, followed by one empty word that marks the end."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit(_OTHER_SIGN)))
    trimmed = F.btrim(plain, F.lit(_BETWEEN))
    end = F.array(F.lit(""))
    return F.when(trimmed == "", end).otherwise(
        F.split(F.concat(trimmed, F.lit(" ")), _BETWEEN_RUN))


def block_words(templates: Sequence[tuple[str, str]]) -> int:
    """Words of a block: twice those of the longest template."""
    return 2 * max(len(t.split()) for t, _ in templates)


def token_counts(docs: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """How often each token of the templates is a word of the corpus, over all rows."""
    wanted = docs.sparkSession.createDataFrame([(v,) for v in vocabulary], "word string")
    words = docs.select(F.explode(_words(F.col("text"))).alias("word"))
    found = words.join(F.broadcast(wanted), "word").groupBy("word").count().collect()
    return {v: 0 for v in vocabulary} | {r["word"]: r["count"] for r in found}


def scan(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    notices: Sequence[tuple[str, str]] = NOTICES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    ``n_base`` counts the places of ``phrases``; ``labels`` adds those of ``notices`` that
    a block contains by ``threshold`` or more; ``score`` is the best containment met, 1
    for a phrase, 0 if nothing was found.

    Null, empty and wordless texts have no words, no labels and score 0.  The templates
    are short lists of the caller's, so the prefix table is broadcast; its size does not
    depend on the corpus.  Every row is answered by itself, also where an id repeats or is
    null.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for t, _ in [*phrases, *notices] for w in t.split()})
    counts = token_counts(docs, vocabulary)
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts[w], w)))}
    probes = [("", -1, 0, 0, 0, [], "", 0)]
    for number, (phrase, label) in enumerate(phrases):
        words = phrase.split()
        rarest = min(words, key=rank.__getitem__)
        probes.append((rarest, number, 0, words.index(rarest), len(words), words, label, len(words)))
    for number, (notice, label) in enumerate(notices, len(phrases)):
        words = sorted(set(notice.split()), key=rank.__getitem__)
        needed = math.ceil(threshold * len(words) - 1e-9)
        for place in range(len(words) - needed + 1):
            probes.append((words[place], number, 1, place, needed, words, label, len(words)))
    prefix = spark.createDataFrame(
        probes, "word string, template int, kind int, place int, needed int, wording array<string>,"
        " label string, size int")

    width = block_words([*phrases, *notices])
    rows = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), _words(F.col("text")).alias("words"))
    hits = (
        rows.select("doc_id", "row", "words", F.posexplode("words").alias("at", "word"))
        .join(F.broadcast(prefix), "word"))

    # What blocks with the hit can reach is cut once; the text itself goes no further.
    first = F.greatest(F.col("at") - (width - 1), F.lit(0))
    hits = hits.select(
        "doc_id", "row", "at", *prefix.columns, (F.col("at") - first).alias("here"),
        F.slice("words", first + 1, F.lit(2 * width - 1)).alias("around"))

    # A phrase: its words around the hit, in order.
    start = F.col("at") - F.col("place")
    begin = F.col("here") - F.col("place")
    in_order = (begin >= 0) & (
        F.slice("around", F.greatest(begin, F.lit(0)) + 1, F.col("needed")) == F.col("wording"))
    is_place = (F.col("kind") == 0) & (F.col("template") >= 0) & in_order

    # A notice: what is around the hit may suffice, and one of the blocks there does.
    universe = F.array(*[F.lit(w) for w in sorted(vocabulary, key=rank.__getitem__)])
    around = F.col("around")
    # Ordered by rank, because that is the order of the universe.
    present = F.array_intersect(universe, around)
    rest_of_template = F.col("size") - F.col("place")
    rest_of_text = F.size(present) - F.array_position(present, F.col("word")).cast("int") + 1
    may = (F.size(F.array_intersect(around, F.col("wording"))) >= F.col("needed")) & (
        F.least(rest_of_template, rest_of_text) + F.col("place") >= F.col("needed"))

    def shared(begin: Column) -> Column:
        block = F.slice("around", begin + 1, F.lit(width))
        useful = F.array_contains("wording", F.element_at("around", begin + 1))
        return F.when(useful, F.size(F.array_intersect(F.col("wording"), block)))

    most = F.array_max(F.transform(F.sequence(F.lit(0), F.col("here")), shared))
    found = F.when((F.col("kind") == 1) & may, most)
    notice_score = F.when(found >= F.col("needed"), found / F.col("size"))

    judged = hits.select(
        "doc_id", "row", "label",
        F.when(F.col("template") == -1, F.col("at")).alias("n_words"),
        F.when(is_place, start).alias("place"),
        notice_score.alias("notice_score"))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    return judged.groupBy("doc_id", "row").agg(
        F.coalesce(F.max("n_words"), F.lit(0)).cast("long").alias("n_words"),
        F.count("place").alias("n_base"),
        F.min("place").cast("long").alias("first_word"),
        F.max("place").cast("long").alias("last_word"),
        joined(F.collect_set(F.when(F.col("place").isNotNull(), F.col("label")))).alias("base_labels"),
        joined(F.collect_set(F.when(
            F.col("place").isNotNull() | F.col("notice_score").isNotNull(), F.col("label")))).alias("labels"),
        F.coalesce(
            F.max(F.when(F.col("place").isNotNull(), 1.0).otherwise(F.col("notice_score"))),
            F.lit(0.0)).alias("score"),
    ).drop("row")
