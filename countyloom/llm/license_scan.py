"""License notices in texts: fixed phrases, and an exact containment join of word windows with license templates.

A text block is a window of twice a template's words, one at every multiple of the template's words, so that a notice as long
as its template lies whole in some block. A block meets a template if it holds at least `threshold` of the template's
distinct words. Words are ranked by how many documents of the corpus hold them, rarest first, and a block is compared only

- if it holds one of the template's first words in that order, as many as a matching block can't all miss (prefix filter);
- if it has enough words that any template knows (length filter);
- if what follows the first common word on both sides can still add up to the overlap (positional filter).

The filters spare work and drop no match. All of it is DataFrame functions inside the row: nothing is shuffled but the counts
of the templates' words, of which there are as many as templates have words.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words, the phrases of the base labels, and opening words of published license texts.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
# End of fixed values.

THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    """A license text as its words, all lower case, and the label of a block that contains it."""

    label: str
    words: tuple[str, ...]

    @property
    def distinct(self) -> frozenset[str]:
        return frozenset(self.words)

    def least(self, threshold: float) -> int:
        """Common words that a block needs; rounded first, so that 0.7 of 10 words is 7."""
        return max(1, math.ceil(round(threshold * len(self.distinct), 9)))


TEMPLATES = tuple(Template(label, tuple(text.split(" "))) for label, text in NOTICES)


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null has none. Cut at what is no word, which is faster than to match words."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, GAP), "")


def _texts(words: Iterable[str]) -> Column:
    """A constant array of words, as one literal that the optimizer folds."""
    return F.split(F.lit(" ".join(words)), " ")


def _numbers(values: Iterable[int]) -> Column:
    return _texts(map(str, values)).cast("array<int>")


def rank_words(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """Rank of every word of the templates, from the one that fewest documents hold; equal counts in the order of the words.

    One row for each word of the templates is collected, however large the corpus.
    """
    known = sorted(set().union(*[t.distinct for t in templates]))
    held = docs.select(F.explode(F.array_intersect(words_of(F.col("text")), _texts(known))).alias("word"))
    n = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(known, key=lambda w: (n.get(w, 0), w)))}


def _anchor(phrase: str, ranks: dict[str, int]) -> tuple[int, str]:
    """Place and text of the phrase's rarest word, as far as ranks tell."""
    return min(enumerate(phrase.split(" ")), key=lambda iw: ranks.get(iw[1], len(ranks)))


def _places(words: Column, spots: Column, phrase: str, ranks: dict[str, int]) -> Column:
    """Starts of a phrase, from the places of its rarest word among `spots`."""
    offset, _ = _anchor(phrase, ranks)

    def here(i: Column) -> Column:
        test = i >= offset
        for k, w in enumerate(phrase.split(" ")):
            test = test & (F.get(words, i + (k - offset)) == w)
        return test

    return F.transform(F.filter(spots, here), lambda i: (i - offset).cast("int"))


_MATCH = "array<struct<label:string,start:int,end:int,score:double>>"


def _blocks(words: Column, hits: Column, template: Template, ranks: dict[str, int], threshold: float) -> Column:
    """(label, start, end, score) of the template's windows that contain enough of it; `end` is exclusive."""
    step, least = len(template.words), template.least(threshold)
    order = sorted(ranks[w] for w in template.distinct)
    word_at = sorted(template.distinct, key=ranks.__getitem__)
    prefix = len(order) - least + 1
    ranked = F.map_from_arrays(_texts(ranks), _numbers(ranks.values()))
    ordered, firsts = _numbers(order), _numbers(order[:prefix])

    at = F.filter(hits, lambda i: F.get(words, i).isin(word_at[:prefix]))
    near = F.flatten(F.transform(at, lambda i: F.array(F.floor(i / step), F.floor(i / step) - 1)))
    windows = F.filter(F.array_distinct(near), lambda k: k >= 0)

    def block(k: Column) -> Column:
        start = (k * step).cast("int")
        span = F.slice(words, start + 1, F.lit(2 * step))
        known = F.array_sort(F.filter(F.transform(F.array_distinct(span), lambda w: F.try_element_at(ranked, w)), lambda r: r.isNotNull()))
        return F.struct(start.alias("start"), (start + F.size(span)).cast("int").alias("end"), known.alias("known"))

    def may_reach(b: Column) -> Column:
        common = F.array_min(F.array_intersect(b["known"], firsts))
        after_template = len(order) - F.array_position(ordered, common)
        after_block = F.size(b["known"]) - F.array_position(b["known"], common)
        return (F.size(b["known"]) >= least) & (1 + F.least(after_template, after_block) >= least)

    def scored(b: Column) -> Column:
        overlap = F.size(F.array_intersect(b["known"], ordered))
        return F.struct(
            F.lit(template.label).alias("label"),
            b["start"].alias("start"),
            b["end"].alias("end"),
            (overlap / F.lit(float(len(order)))).alias("score"),
        )

    found = F.transform(F.filter(F.transform(windows, block), may_reach), scored)
    return F.filter(found, lambda m: m["score"] * len(order) >= least - 1e-6)


def scan(
    docs: DataFrame, ranks: dict[str, int], templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """`docs` with `_n_words`, `_base` and `_matches`; null texts count as empty, repeated rows are scanned alike.

    `_base` is an array of (start, label), the places of the fixed phrases in words from 0; `_matches` one of (label, start,
    end, score), the blocks that meet a template, by label and start. Columns of `docs` with these names, or named _words,
    _spots or _hits, are replaced. An empty table gives no rows, and `ranks` may come from any corpus.
    """
    helpers = ("_n_words", "_base", "_matches", "_words", "_spots", "_hits")
    words, spots, hits = F.col("_words"), F.col("_spots"), F.col("_hits")
    rows = docs.drop(*helpers).withColumn("_words", words_of(F.col("text")))
    rows = rows.withColumn("_n_words", F.size(words).cast("long"))
    rarest = set()
    for t in templates:
        rarest |= set(sorted(t.distinct, key=ranks.__getitem__)[: len(t.distinct) - t.least(threshold) + 1])
    wanted = sorted(rarest | {_anchor(p, ranks)[1] for p in PHRASES})
    nowhere = F.array().cast("array<int>")
    found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(wanted))
    rows = rows.withColumn("_spots", F.when(F.arrays_overlap(words, _texts(wanted)), found).otherwise(nowhere))
    rows = rows.withColumn("_hits", F.filter(spots, lambda i: F.get(words, i).isin(sorted(rarest))))

    def placed(phrase: str, label: str) -> Column:
        return F.transform(_places(words, spots, phrase, ranks), lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))

    base = [placed(p, label) for p, label in PHRASES.items()]
    none = F.array().cast("array<struct<start:int,label:string>>")
    rows = rows.withColumn("_base", F.when(F.size(spots) > 0, F.array_sort(F.concat(*base))).otherwise(none))
    blocks = F.array_sort(F.concat(*[_blocks(words, hits, t, ranks, threshold) for t in templates]))
    rows = rows.withColumn("_matches", F.when(F.size(hits) > 0, blocks.cast(_MATCH)).otherwise(F.array().cast(_MATCH)))
    return rows.drop("_words", "_spots", "_hits")


def digest(scanned: DataFrame) -> DataFrame:
    """One row a document: counts and outermost places of the phrases, their labels, all labels, and the best score.

    The score is 1 where a phrase stands, else the greatest share of a template that a matching block contains, else 0.
    """
    labels = F.transform("_base", lambda b: b["label"])
    starts = F.transform("_base", lambda b: b["start"].cast("long"))
    more = F.transform("_matches", lambda m: m["label"])
    best = F.coalesce(F.array_max(F.transform("_matches", lambda m: m["score"])), F.lit(0.0))
    return scanned.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, more)), ",").alias("labels"),
        F.when(F.size("_base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
