"""License scan: exact set-similarity join of text blocks with license templates.

A block is a line of a text, or a window of its words whatever the line ends (twice
as long as the longest template, from every so many words, so that a statement wrapped
over lines lies inside one); a template is a short license statement; both are sets of
words.  A template matches a block when the block holds at least ``threshold`` of its
words; n_matches counts the lines of each template, and 1 for one that only windows
hold.  The join is exact:

* tokens are ordered by their frequency over all documents, rarest first;
* prefix filter: a block that holds ``need = ceil(threshold * |T|)`` words of T holds
  one of the ``|T| - need + 1`` rarest, so only blocks with such a word are looked at;
* length filter: the block has at least ``need`` distinct words;
* positional filter: when the rarest common word is at position i of T (from 0), at
  most ``|T| - i`` words are common;
* what is left is compared as sets;
* the whole text goes through the same filters first, as it holds what its blocks hold.

The templates are a fixed, small table (a parameter), so they travel as literals in
the plan; the documents are scanned twice (frequencies, join) and never shuffled.

Base labels come from phrases whose words stand consecutively in the text; places
count every start, and matches cross line ends as only words count.

Defined cases: null text counts as empty (no words, empty labels, score 0, null
places); each row is answered by itself, so repeated rows and null ids come back as
they are; very long texts are normalised as whole values, one at a time; other columns
are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.9

#: Phrase and label.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Statement and label of the set join.
TEMPLATES = {
    "licensed under cc by nc 4.0": "cc-by-nc-4.0",
    "licensed under cc by sa 4.0": "cc-by-sa-4.0",
    "licensed under the apache license version 2.0": "apache-2.0",
    "this work is licensed under the gnu general public license": "gpl",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "mpl-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "all rights reserved no part may be reproduced without permission": "proprietary",
}

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_line(text: Column) -> Column:
    """Lower-case words of a text, one space apart."""
    return F.trim(F.regexp_replace(F.translate(text, _UP, _LOW), _GAP, " "))


def words_of_template(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _token_set(text: str) -> list[str]:
    """Distinct words of an ASCII template."""
    return sorted(set(words_of_template(text)))


def _ored(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def token_frequencies(docs: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Documents that hold each of ``tokens`` (a bounded list), one pass."""
    line = F.concat(F.lit(" "), F.col("words"), F.lit(" "))
    sums = [F.count(F.when(line.contains(f" {t} "), 1)).alias(f"n{i}") for i, t in enumerate(tokens)]
    row = docs.select(words_line(F.coalesce("text", F.lit(""))).alias("words")).agg(*sums).first()
    return dict(zip(tokens, row))


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, base: dict[str, str] = BASE,
                 threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches."""
    sets = [(label, _token_set(t)) for t, label in templates.items()]
    freq = token_frequencies(docs, sorted({w for _, ts in sets for w in ts}))
    text = F.coalesce(F.col("text"), F.lit(""))

    def block_hits(words: Column) -> Column:
        """Templates that the block matches: array of (template, label, containment)."""
        own = F.array_distinct(words)
        found = []
        for k, (label, tokens) in enumerate(sets):
            order = sorted(tokens, key=lambda w: (freq[w], w))
            n, need = len(order), math.ceil(threshold * len(order) - 1e-9)
            common = F.size(F.array_intersect(own, F.array(*map(F.lit, order))))
            # the first prefix word that the block holds bounds the overlap
            prefix = order[:n - need + 1]
            bound = reduce(lambda e, iw: F.when(F.array_contains(own, iw[1]), n - iw[0]).otherwise(e),
                           reversed(list(enumerate(prefix))), F.lit(0))
            found.append(F.when((F.size(own) >= need) & (bound >= need),
                                F.when(common >= need, F.struct(F.lit(k).alias("template"),
                                                                F.lit(label).alias("label"),
                                                                (common / n).alias("part")))))
        return F.filter(F.array(*found), lambda x: x.isNotNull())

    rare = sorted({w for _, ts in sets for w in sorted(ts, key=lambda w: (freq[w], w))
                   [:len(ts) - math.ceil(threshold * len(ts) - 1e-9) + 1]})
    has_rare = lambda line: _ored([F.concat(F.lit(" "), line, F.lit(" ")).contains(f" {w} ") for w in rare])
    lines = F.transform(F.split(text, "\n"), words_line)
    hits = F.flatten(F.transform(F.filter(lines, has_rare), lambda x: block_hits(F.split(x, " "))))
    step = max((len(words_of_template(t)) for t in templates), default=1)
    all_words = F.split(F.col("words"), " ")
    windows = F.transform(F.sequence(F.lit(1), F.size(all_words), F.lit(step)),
                          lambda i: F.slice(all_words, i, 2 * step))
    wide = F.flatten(F.transform(windows, block_hits))

    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                     words_line(text).alias("words"))
    df = df.withColumn("spaced", F.concat(F.lit(" "), F.col("words"), F.lit(" ")))
    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in base.items():
        there = F.col("spaced").contains(f" {phrase} ")
        gaps = lambda part: F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))
        before = F.substring_index(F.col("spaced"), f" {phrase} ", 1)
        # after the last place, and the words of the phrase itself
        after = F.reverse(F.substring_index(F.reverse(F.col("spaced")), f" {phrase[::-1]} ", 1))
        places.append(F.when(there, F.regexp_count("spaced", F.lit(f" {phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(there, gaps(before)))
        lasts.append(F.when(there, F.col("n_words") - gaps(after) - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    n = F.length("words") - F.length(F.replace(F.col("words"), F.lit(" "), F.lit(""))) + 1
    df = df.withColumn("n_words", F.when(F.col("words") == "", 0).otherwise(n).cast("long"))
    df = df.withColumn("whole", F.when(has_rare(F.col("words")), block_hits(all_words)))
    there = F.size("whole") > 0
    df = df.withColumn("hits", F.when(there, hits)).withColumn("wide", F.when(there, wide))
    base_labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    either = F.concat("hits", "wide")
    own_labels = F.coalesce(F.transform(either, lambda x: x["label"]), F.array().cast("array<string>"))
    score = F.when(F.size(base_labels) > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max(F.transform(either, lambda x: x["part"])), F.lit(0.0)))
    # templates that no line holds
    wrapped = F.array_except(F.transform("wide", lambda x: x["template"]), F.transform("hits", lambda x: x["template"]))
    return df.select(
        "doc_id", "n_words", reduce(lambda a, b: a + b, places).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own_labels))), ",").alias("labels"),
        score.cast("double").alias("score"), F.coalesce(F.size("hits") + F.size(wrapped), F.lit(0)).alias("n_matches"))
