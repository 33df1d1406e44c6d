"""License scan by diagonal voting: rolling word grams are joined with the places where templates hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hearthwatt.llm.frames import table
from hearthwatt.llm.registry import query

# Phrases and openings of public licenses as words, each with its label. The first three are phrases of which
# every place counts; the others are recognised in parts too.
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
TEXTS = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files the software to deal in the software without restriction"),
    ("apache-2.0-text", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-text", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that "
                 "the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
#: Words of a gram (a template of fewer words is one gram), of which HASHED are hashed for the join and all are compared.
GRAM, HASHED = 3, 2
#: Diagonals at most so many words apart are one span; a span with this share of a template's grams has its label.
DRIFT, COVERAGE = 3, 0.75

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none of a null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def grams(found: Column) -> Column:
    """One struct per word: the word and those after it, null beyond the end."""
    later = [F.slice(found, k + 1, F.size(found)) for k in range(1, GRAM)]
    return F.arrays_zip(found.alias("w0"), *(x.alias(f"w{k + 1}") for k, x in enumerate(later)))


def _hash(gram: str) -> Column:
    return F.xxhash64(*(F.col(f"{gram}.w{k}") for k in range(HASHED)))


def template_grams(spark: SparkSession, phrases: list[tuple[str, str]], texts: list[tuple[str, str]]) -> DataFrame:
    """``template, label, phrase, grams`` and each of a template's grams with its place there."""
    rows = [(k, label, text, k < len(phrases)) for k, (label, text) in enumerate([*phrases, *texts])]
    if short := [text for _, _, text, _ in rows if len(text.split()) < HASHED]:
        raise ValueError(f"templates of fewer than {HASHED} words: {short}")
    known = F.array(*(F.struct(F.lit(k).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"), F.lit(phrase).alias("phrase"))
                      for k, label, text, phrase in rows))
    each = spark.range(1).select(F.inline(known)).withColumn("words", words(F.col("text")))
    count = F.greatest(F.size("words") - (GRAM - 1), F.lit(1))
    return each.select("template", "label", "phrase", count.alias("grams"), F.least(F.size("words"), F.lit(GRAM)).alias("size"),
                       F.posexplode(F.slice(grams(F.col("words")), 1, count)).alias("place", "known")).withColumn("hash", _hash("known"))


def license_spans(documents: DataFrame, column: str = "text", key: str = "doc_id", phrases: list[tuple[str, str]] = PHRASES,
                  texts: list[tuple[str, str]] = TEXTS) -> DataFrame:
    """Spans of ``documents`` that follow a template: ``row, doc_id, n_words, label, phrase, places, first, last, coverage``.

    Every word of every text starts a gram, and all grams are joined with the places of the same words in the templates.
    Each match votes for the diagonal (its place in the text minus that in the template). Neighbouring diagonals, as
    words put in or left out make them, are one span from its first to its last matched word, whose coverage is its share of the
    template's grams. ``places`` are diagonals with all grams, so exact occurrences; a phrase counts only by these. A row of ``documents`` without any match
    has one row here, with nulls from ``label`` on. ``row`` tells rows with the same id apart.

    The join is with some hundred grams of fixed templates, so the side that is broadcast does not grow with the data, and only
    matches and one row per text are shuffled, by row. No text is in more than one task, and none is held back.
    """
    spark = documents.sparkSession
    known = F.broadcast(template_grams(spark, phrases, texts))
    chosen = documents.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), words(F.col(column)).alias("words"))
    rolling = chosen.select("row", "doc_id", F.size("words").cast("long").alias("n_words"),
                            F.posexplode_outer(grams(F.col("words"))).alias("at", "gram")).withColumn("hash", _hash("gram"))
    same = (rolling["hash"] == known["hash"]) & (F.col("gram.w0") == F.col("known.w0"))
    for k in range(1, GRAM):
        same &= F.col(f"known.w{k}").isNull() | (F.col(f"gram.w{k}") == F.col(f"known.w{k}"))
    matched = rolling.join(known, same, "left").where("template IS NOT NULL OR coalesce(at, 0) = 0")
    each = ["row", "doc_id", "n_words", "template", "label", "phrase", "grams"]
    votes = matched.select(*each, (F.col("at") - F.col("place")).alias("diagonal"), "at", (F.col("at") + F.col("size") - 1).alias("end")) \
        .repartition("row").groupBy(*each, "diagonal").agg(F.count("*").alias("votes"), F.min("at").alias("first"), F.max("end").alias("last"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("phrase"), F.lit(True)) | (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT)
    runs = votes.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("run", F.sum("apart").over(order))
    whole = F.col("votes") == F.col("grams")
    spans = runs.groupBy(*each, "run").agg(F.count_if(whole).alias("places"), F.min("first").cast("long").alias("first"),
                                           F.max("last").cast("long").alias("last"), F.sum("votes").alias("votes"))
    return spans.select("row", "doc_id", "n_words", "label", "phrase", "places", "first", "last",
                        F.when(F.col("grams").isNotNull(), F.least(F.lit(1.0), F.col("votes") / F.col("grams"))).alias("coverage"))


def license_report(documents: DataFrame, column: str = "text", key: str = "doc_id", **templates) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word`` are the smallest and the largest of their starts.
    ``labels`` adds the labels of spans with a coverage of COVERAGE or more, which ``spans`` lists; ``score`` is the best coverage of
    any span. A null or empty text has no words, no labels and a score of 0. Repeated rows are scanned one by one, an empty
    table gives none, ties of spans change nothing, and other columns are not read. A text of any length is scanned whole, as an
    array of its words in one task.
    """
    base = F.col("phrase") & (F.col("places") > 0)
    found = base | (~F.col("phrase") & (F.col("coverage") >= COVERAGE))
    spans = license_spans(documents, column, key, **templates)
    joined = lambda when: F.concat_ws(",", F.array_sort(F.collect_set(F.when(when, F.col("label")))))
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.sum(F.when(base, F.col("places")).otherwise(0)).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"), joined(base).alias("base_labels"), joined(found).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(found, F.struct("first", "last", "label", "coverage")))).alias("spans")).drop("row")


def _sql() -> str:
    values = ", ".join(f"({k}, '{label}', '{text}', {k < len(PHRASES)})" for k, (label, text) in enumerate([*PHRASES, *TEXTS]))
    return rf"""
WITH known AS (
    SELECT template, label, phrase, greatest(len(w) - {GRAM - 1}, 1) AS grams, least(len(w), {GRAM}) AS size, w
    FROM (SELECT template, label, phrase, string_split(text, ' ') AS w FROM (VALUES {values}) t(template, label, text, phrase))),
place AS (
    SELECT template, label, phrase, grams, size, array_to_string(w[i:i + size - 1], ' ') AS gram, i - 1 AS place
    FROM (SELECT *, unnest(range(1, grams + 1)) AS i FROM known)),
doc AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w
    FROM documents),
gram AS (
    SELECT row, i - 1 AS pos, size, array_to_string(w[i:i + size - 1], ' ') AS gram
    FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM known))),
vote AS (
    SELECT row, template, label, phrase, grams, pos - place AS diagonal, count(*) AS votes
    FROM gram JOIN place ON gram.gram = place.gram AND gram.size = place.size GROUP BY ALL),
run AS (
    SELECT *, sum(apart) OVER (PARTITION BY row, template ORDER BY diagonal) AS run FROM (
        SELECT *, CASE WHEN phrase OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal) > {DRIFT}, true)
                  THEN 1 ELSE 0 END AS apart FROM vote)),
span AS (
    SELECT row, label, phrase, count(*) FILTER (WHERE votes = grams) AS places, min(diagonal) AS first,
           least(1.0::DOUBLE, sum(votes)::DOUBLE / grams) AS coverage
    FROM run GROUP BY row, template, label, phrase, grams, run),
found AS (
    SELECT row, CAST(coalesce(sum(places) FILTER (WHERE phrase), 0) AS BIGINT) AS n_base, min(first) FILTER (WHERE phrase AND places > 0) AS first_word,
           max(first) FILTER (WHERE phrase AND places > 0) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase AND places > 0) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase AND places > 0 OR NOT phrase AND coverage >= {COVERAGE}) AS labels,
           max(coverage) AS score
    FROM span GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM doc LEFT JOIN found USING (row)
"""


@query("op12_license_scan", _sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
