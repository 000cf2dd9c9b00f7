"""Licence scan by a positional index of rare licence words, in DataFrame functions only.

Words of the licence templates are found in every file with their places, and
their document frequencies over the whole corpus weigh them. Each file looks up
its highest-weighted licence words first: a template can only reach its share of
agreeing weight where one of its heaviest words stands, so the lighter words
("the", "in") are looked up for no template. A found word says where the
template would start; starts where the mandatory key phrase stands at its place
are kept, and there alone all words of the template are compared by their
relative places. A template holds where the words in place reach a share of its
total weight.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from homematch.llm.common import ascii_lower, let
from homematch.session import saved

#: What separates words, after A-Z are lower-cased.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Phrases whose places are counted, and their labels. Fixed values.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Label, template words, mandatory phrase within them. Fixed values.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "spdx license identifier mit", "spdx license identifier mit"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "spdx license identifier apache 2 0", "identifier apache 2 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
)
#: Share of a template's weight that must stand in place.
LEAST_SHARE = 0.7


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]
    phrase: tuple[str, ...]

    @property
    def phrase_at(self) -> int:
        width = len(self.phrase)
        return next(i for i in range(len(self.words)) if self.words[i : i + width] == self.phrase)


def templates(given=TEMPLATES) -> list[Template]:
    return [Template(i, label, tuple(words.split()), tuple(phrase.split())) for i, (label, words, phrase) in enumerate(given)]


def vocabulary(known: list[Template]) -> list[str]:
    return sorted({w for t in known for w in t.words} | {w for p in BASE_PHRASES for w in p.split()})


def licence_words(docs: DataFrame, words: list[str], key: str, text: str) -> DataFrame:
    """Word count of each text and the places of its licence words; ``row`` tells rows apart."""

    def scan(found: Column) -> Column:
        placed = F.transform(found, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
        return F.struct(F.size(found).cast("bigint").alias("n_words"), F.filter(placed, lambda x: x["word"].isin(words)).alias("hits"))

    lower = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    all_words = F.filter(F.split(lower, SEPARATORS), lambda w: w != "")
    return docs.select(F.col(key).alias("doc_id"), let(all_words, scan).alias("_s")).select(F.monotonically_increasing_id().alias("row"), "doc_id", "_s.*")


def phrase_starts(hits: Column, phrase: tuple[str, ...]) -> Column:
    """Places where the words of a phrase stand one after the other."""

    def here(x: Column, k: Column) -> Column:
        same = x["word"] == phrase[0]
        for i, word in enumerate(phrase[1:], 1):
            following = F.get(hits, k + i)
            same = same & F.coalesce((following["word"] == word) & (following["at"] == x["at"] + i), F.lit(False))
        return same

    return F.transform(F.filter(hits, here), lambda x: x["at"])


def template_starts(hits: Column, template: Template) -> Column:
    """Where a template would have to start, from the places of its mandatory phrase."""
    number, before = template.number, template.phrase_at
    return F.transform(phrase_starts(hits, template.phrase), lambda at: F.struct(F.lit(number).alias("template"), (at - before).alias("start")))


def word_weights(rows: DataFrame, words: list[str]) -> dict[str, float]:
    """Inverse document frequency of every licence word over all rows; as many figures as there are licence words."""
    total = rows.count()
    counted = rows.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x["word"]))).alias("word")).groupBy("word").count().collect()
    held = {r["word"]: r["count"] for r in counted}
    return {w: math.log((total + 1) / (held.get(w, 0) + 1)) + 1 for w in words}


def heaviest_places(template: Template, weights: dict[str, float], least: float) -> list[tuple[str, int]]:
    """Words to look up with their places: the heaviest ones without which the rest cannot reach the share."""
    ranked = sorted(((w, i) for i, w in enumerate(template.words)), key=lambda x: (-weights[x[0]], x[1]))
    rest, out = sum(weights[w] for w in template.words), []
    need = least * rest
    for word, place in ranked:
        if rest < need - 1e-9:
            break
        out.append((word, place))
        rest -= weights[word]
    return out


def scan_licences(docs: DataFrame, given=TEMPLATES, least: float = LEAST_SHARE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base phrases, templates and labels of every text.

    ``score`` is the largest agreeing share of a template that holds, 1 where a
    base phrase stands, else 0. Null and empty texts have no words and no
    labels; texts of any length are scanned whole; repeated rows are scanned
    each; an empty table gives no rows; other columns, whatever their names, are
    ignored. The index and the figures it is chosen by are bounded by the
    templates, not by the corpus.
    """
    spark = docs.sparkSession
    known = templates(given)
    words = vocabulary(known)
    rows = saved(licence_words(docs, words, key, text), "licence-words")
    weights = word_weights(rows, words)
    chosen = [(w, t.number, i) for t in known for w, i in heaviest_places(t, weights, least)]
    looked_up = sorted({w for w, *_ in chosen})
    index = spark.createDataFrame([(w, t.number, i, weights[w]) for t in known for i, w in enumerate(t.words)], "word string, template int, place int, weight double")
    totals = spark.createDataFrame([(t.number, sum(weights[w] for w in t.words), t.label) for t in known], "template int, total double, label string")
    hit_rows = rows.where(F.size("hits") > 0)
    rare = hit_rows.select("row", F.inline(F.filter("hits", lambda x: x["word"].isin(looked_up))))
    starting = rare.join(F.broadcast(spark.createDataFrame(chosen, "word string, template int, place int")), "word")
    starts = starting.select("row", "template", (F.col("at") - F.col("place")).alias("start")).distinct()
    places = F.flatten(F.array(*[template_starts(F.col("hits"), t) for t in known]))
    phrased = saved(starts.join(hit_rows.select("row", F.inline(places)), ["row", "template", "start"]), "licence-starts")
    compared = hit_rows.select("row", "hits").join(phrased.select("row").distinct(), "row", "left_semi").select("row", F.inline("hits"))
    votes = compared.join(F.broadcast(index), "word").groupBy("row", "template", (F.col("at") - F.col("place")).alias("start")).agg(F.sum("weight").alias("weight"))
    held = votes.join(phrased.distinct(), ["row", "template", "start"]).join(F.broadcast(totals), "template").where(F.col("weight") >= least * F.col("total") - 1e-9)
    method = held.groupBy("row").agg(F.collect_set("label").alias("method_labels"), F.max(F.least(F.lit(1.0), F.col("weight") / F.col("total"))).alias("share"))
    base = {label: phrase_starts(F.col("hits"), tuple(phrase.split())) for phrase, label in BASE_PHRASES.items()}
    counted = rows.select("row", "doc_id", "n_words", F.struct(*[starts.alias(label) for label, starts in base.items()]).alias("b"))
    starts = F.flatten(F.array(*[F.col("b")[label] for label in base]))
    labels = F.filter(F.array(*[F.when(F.size(F.col("b")[label]) > 0, F.lit(label)) for label in base]), lambda x: x.isNotNull())
    found = counted.select("row", "doc_id", "n_words", starts.alias("starts"), F.array_sort(labels).alias("base"))
    joined = found.join(method, "row", "left")
    every = F.array_sort(F.array_union("base", F.coalesce("method_labels", F.array().cast("array<string>"))))
    n_base = F.size("starts").cast("bigint")
    return joined.select(
        "doc_id", "n_words", n_base.alias("n_base"),
        F.array_min("starts").cast("bigint").alias("first_word"), F.array_max("starts").cast("bigint").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.round(F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))), 6).alias("score"),
    )
