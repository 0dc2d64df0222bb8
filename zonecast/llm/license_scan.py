"""License scans by diagonal voting.

A notice is a template: a label, its words, and the words in it that must
stand together (which tell it from similar notices). Every window of `K` words
of every text is hashed and joined with the templates' windows. A hit at word p
of the text and word q of the template votes for the diagonal p - q: a notice
that stands in a text word for word puts all its votes on one diagonal, and one
with some words put in or left out on diagonals next to each other.

Votes of one diagonal are a bit each (bit q), so they add up in any order and
before the shuffle. Diagonals at most `MERGE_WORDS` apart are merged into one
span. A span is verified when the words agree (each hit compares the words
themselves, not only their hash), the template's required windows stand on one
of its diagonals, and at least `COVERED` of its windows were hit. Base phrases
are templates whose places are diagonals with all bits set.

DataFrame functions only. One pass over the texts; the templates (a constant of
some dozen notices) are broadcast. Each text also joins one marker row, so that
texts without hits come out of the same pass; rows equal in id and text are
scanned as they are and come out as often as they went in.

Defined cases: null and empty texts have no words, no labels and score 0; texts
of fewer than `K` words have no windows; null ids are carried; an empty table
gives an empty result. A text is one row of any length, scanned whole; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 3                # words of a window: those of the shortest phrase
MERGE_WORDS = 3
COVERED = 0.8
MARKER = -1          # number of the marker's template

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    required: str = ""
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def windows(self) -> int:
        return len(self.words) - K + 1

    @property
    def required_bits(self) -> int:
        """Windows of the required words; all windows of a base phrase."""
        words, need = self.words, self.words if self.base else self.required.split()
        if not need:
            return 0
        at = next(i for i in range(len(words)) if words[i:i + len(need)] == need)
        return sum(1 << i for i in range(at, at + len(need) - K + 1))


# The base phrases, and wordings of public license notices.
BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
             "software and associated documentation files the software to deal in the software without "
             "restriction", "deal in the software"),
    Template("apache-2", "unless required by applicable law or agreed to in writing software distributed "
             "under the license is distributed on an as is basis without warranties or conditions of any "
             "kind either express or implied", "on an as is basis"),
    Template("gpl-2", "under the terms of the gnu general public license as published by the free software "
             "foundation either version 2 of the license", "either version 2"),
    Template("gpl-3", "under the terms of the gnu general public license as published by the free software "
             "foundation either version 3 of the license", "either version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "public license version 2"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "public license version 3"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general"),
    Template("agpl-3", "under the terms of the gnu affero general public license", "gnu affero general"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met", "source and binary forms"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license",
             "commons attribution 4 0"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
             "attribution sharealike 4 0"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international "
             "license", "attribution noncommercial 4 0"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)
TEMPLATES = BASE + NOTICES


def check_templates(templates: Sequence[Template]) -> None:
    for t in templates:
        if not 1 <= t.windows <= 63 or not t.base and 0 < len(t.required.split()) < K:
            raise ValueError(f"a template has {K} to {63 + K - 1} words, and requires none or {K}: {t.text!r}")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def window_hash(words: Column) -> Column:
    """A hash for each place of `words`. Those of the last K - 1 places are of
    fewer words and are told from windows when the words are compared."""
    return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + F.lit(n)) for n in range(1, K)]))


def template_windows(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(t, q, code, said): the windows of all templates, and the marker."""
    rows = F.array(*[F.struct(F.lit(i).alias("t"), F.split(F.lit(t.text), " ").alias("_words"))
                     for i, t in enumerate(templates)])
    each = spark.range(1).select(F.inline(rows)).withColumn("_codes", window_hash(F.col("_words")))
    each = each.select("t", "_words", F.posexplode("_codes").alias("q", "code"))
    each = each.where(F.col("q") <= F.size("_words") - F.lit(K)).select(
        "t", "q", "code", F.slice("_words", F.col("q") + 1, K).alias("said"))
    marker = spark.range(1).select(F.lit(MARKER).alias("t"), F.lit(0).alias("q"),
                                   F.lit(0).cast("long").alias("code"),
                                   F.array().cast("array<string>").alias("said"))
    return each.unionByName(marker)


def _of_template(templates: Sequence[Template], value) -> Column:
    """`value(template)` looked up by the column t."""
    values = F.array(*[F.lit(value(t)) for t in templates])
    return F.get(values, F.col("t"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Merged spans, one row each: id, digest (of the text), n_words, t
    (template number; `MARKER` for the one row that stands for the text
    itself), rows (for that one: how many rows have this id and text), label,
    first_word and last_word of the span, covered (share of the template's
    windows), verified, and for base phrases n_places, first_place, last_place."""
    check_templates(templates)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.xxhash64(text, F.length(text)).alias("digest"), words_of(text).alias("words"))
    codes = F.concat(F.array(F.lit(0).cast("long")), window_hash(F.col("words")))
    rows = rows.select("id", "digest", F.size("words").cast("long").alias("n_words"), "words",
                       F.posexplode(codes).alias("p", "code"))
    known = F.broadcast(template_windows(docs.sparkSession, templates).withColumnRenamed("code", "_code"))
    # place 0 is the marker's, place p the word p - 1
    hits = (rows.join(known, (F.col("code") == F.col("_code"))
                      & ((F.col("p") == 0) == (F.col("t") == MARKER)))
            .where((F.col("t") == MARKER) | (F.slice("words", F.col("p"), K) == F.col("said"))))
    key = ["id", "digest", "n_words", "t"]
    votes = (hits.select(*key, (F.col("p") - 1 - F.col("q")).alias("diagonal"), "q", "p")
             .groupBy(*key, "diagonal")
             .agg(F.count(F.lit(1)).alias("rows"), F.bit_or(F.expr("shiftleft(1L, q)")).alias("bits"),
                  F.min(F.col("p") - 1).alias("first"), F.max(F.col("p") + (K - 2)).alias("last")))
    along = W.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > MERGE_WORDS, F.lit(True))
    votes = votes.withColumn("apart", apart.cast("int"))
    votes = votes.withColumn("span", F.sum("apart").over(along.rowsBetween(W.unboundedPreceding, 0)))
    required = _of_template(templates, lambda t: t.required_bits)
    whole = F.col("bits").bitwiseAND(required) == required
    place = F.when(whole & _of_template(templates, lambda t: t.base), F.col("diagonal"))
    merged = votes.groupBy(*key, "span").agg(
        F.max("rows").alias("rows"), F.bit_or("bits").alias("bits"), F.bool_or(whole).alias("whole"),
        F.min("first").alias("first_word"), F.max("last").alias("last_word"),
        F.count(place).alias("n_places"), F.min(place).alias("first_place"),
        F.max(place).alias("last_place"))
    covered = F.bit_count("bits") / _of_template(templates, lambda t: t.windows)
    return merged.select(*key, "rows", _of_template(templates, lambda t: t.label).alias("label"),
                         "first_word", "last_word", covered.alias("covered"),
                         (F.col("whole") & (covered >= COVERED)).alias("verified"),
                         "n_places", "first_place", "last_place")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per row of `docs`: its id, n_words, n_base (places of base
    phrases), first_word and last_word (the first and last place's),
    base_labels, labels (of all verified spans too; both sorted, joined by
    commas) and score (share of a template's windows that the best span
    covers)."""
    found = spans(docs, id_col, text_col, templates)
    names = sorted({t.label for t in templates})
    if len(names) > 63:
        raise ValueError("more than 63 labels")
    bit = _of_template(templates, lambda t: 1 << names.index(t.label))
    per = found.groupBy("id", "digest", "n_words").agg(
        F.max(F.when(F.col("t") == MARKER, F.col("rows"))).alias("rows"),
        F.sum("n_places").alias("n_base"), F.min("first_place").cast("long").alias("first_word"),
        F.max("last_place").cast("long").alias("last_word"),
        F.bit_or(F.when(F.col("n_places") > 0, bit).otherwise(F.lit(0).cast("long"))).alias("base"),
        F.bit_or(F.when((F.col("n_places") > 0) | F.col("verified"), bit)
                 .otherwise(F.lit(0).cast("long"))).alias("all"),
        F.coalesce(F.max("covered"), F.lit(0.0)).alias("score"))

    def labels(mask: str) -> Column:
        return F.concat_ws(",", *[F.when(F.col(mask).bitwiseAND(F.lit(1 << i)) != 0, F.lit(n))
                                  for i, n in enumerate(names)])

    return per.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
                      labels("base").alias("base_labels"), labels("all").alias("labels"), "score",
                      F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("_row")).drop("_row")
