"""Operator 7: licence scans, with DataFrame functions only.

Texts become lower-case words (runs of letters and digits). A template of up to 2^c words is looked for in windows of
2^(c+1) words that begin every 2^c words, so each occurrence lies whole in one of them. Windows and templates are
sketched by ``PERMUTATIONS`` MinHash values over their two-word shingles, each a band of its own: a window that holds
``CONTAINMENT`` of a template's shingles has a Jaccard similarity of at least 0.19 to it, so all bands miss it
with a probability below (1 - 0.19)^64 = 2e-6. Windows that share a band with a template are verified by the exact
share of the template's shingles they hold.

A window that lacks more than m of a template's shingles cannot match, so it has to hold one of any m + 1 of them: only
windows around the longest m + 1 (which are rare in other texts) are sketched; that leaves nothing out.

Defined cases: null and empty texts and texts of one word match nothing; templates of one word are refused; rows
that share a doc_id are matched text by text, equal rows count once; a text of any length is searched whole, cut into
its windows where it lies; ties take the first window; an empty table gives no rows. Extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.session import store

PERMUTATIONS = 64
CONTAINMENT = 0.8
WORD_GAP = r"[^\p{L}\p{N}]+"
#: fixed values: licence notices to look for
NOTICES = {
    "all-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES.items()), "template string, text string")


def text_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), WORD_GAP), lambda w: w != "")


def word_pairs(words: Column) -> Column:
    """Every two neighbouring words; each array is worked out once a row, not once an element."""
    joined = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    return F.slice(joined, 1, F.greatest(F.size(words) - 1, F.lit(0)))


def shingles(words: Column) -> Column:
    return F.array_distinct(word_pairs(words))


def bands(hashes: Column) -> Column:
    """The smallest value of the shingles' hashes under each permutation, with the permutation's number."""

    def lowest(number: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(number))))

    return F.array(*[F.struct(F.lit(i).alias("band"), lowest(i).alias("low")) for i in range(PERMUTATIONS)])


def needed_shingles(held: list[str], containment: float) -> list[str]:
    """Shingles of which a window with enough of ``held`` has one at least: the longest of them."""
    enough = next(c for c in range(len(held) + 1) if c / len(held) >= containment)
    return sorted(held, key=lambda pair: (-len(pair), pair))[:len(held) - enough + 1]


def license_matches(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, template, containment, first_word, n_windows per text and template it holds.

    ``templates`` (template, text) is a short list that the driver may hold.
    """
    known = templates.select("template", text_words(F.col("text")).alias("words"))
    known = known.withColumn("reach", F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.size("words"), F.lit(2))))).cast("int"))
    known = store(known.select("template", "reach", F.size("words").alias("n"), shingles(F.col("words")).alias("held")))
    listed = known.collect()
    if any(r.n < 2 for r in listed):
        raise ValueError("a template needs two words at least")
    if containment <= 0:
        raise ValueError("containment must be above 0")
    wanted: dict[int, set[str]] = {}
    for r in listed:
        wanted.setdefault(r.reach, set()).update(needed_shingles(r.held, containment))
    seen = sorted(set().union(*wanted.values()))

    text = F.col("text").cast("string")
    worded = docs.select(F.col("doc_id"), F.xxhash64(text).alias("_key"), text_words(text).alias("words"))
    # two words are put together only where the first one begins a shingle that is looked for
    begins = sorted({pair.split(" ")[0] for pair in seen})
    words = F.col("words")
    pair = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.when(a.isin(begins), F.concat_ws(" ", a, b)))
    places = F.filter(F.transform(pair, lambda p, i: F.when(p.isin(seen), F.struct(p.alias("pair"), i.alias("at")))), lambda p: p.isNotNull())
    hit = worded.withColumn("places", places)

    def windows_around(reach: int) -> Column:
        """The windows that hold a place: from there and from one step earlier, with their words."""
        mine = F.filter("places", lambda p: p["pair"].isin(sorted(wanted[reach])))
        step = F.transform(mine, lambda p: F.floor(p["at"] / F.lit(reach)))
        both = F.array_distinct(F.concat(step, F.transform(step, lambda k: F.greatest(k - 1, F.lit(0)))))
        return F.transform(both, lambda k: F.struct(F.lit(reach).alias("reach"), (k * reach).alias("first_word"),
                                                    F.slice(words, (k * reach + 1).cast("int"), F.lit(reach * 2)).alias("part")))

    windows = hit.select("doc_id", "_key", F.explode(F.flatten(F.array(*[windows_around(r) for r in sorted(wanted)]))).alias("w"))
    windows = windows.select("doc_id", "_key", "w.reach", "w.first_word", shingles(F.col("w.part")).alias("pairs"))
    windows = windows.withColumn("id", F.struct("doc_id", "_key", "reach", "first_word")).drop("doc_id", "_key", "first_word")
    windows = store(windows.withColumn("hashes", F.transform("pairs", lambda p: F.xxhash64(p))))
    sketched = windows.select("id", "reach", F.explode(bands(F.col("hashes"))).alias("b")).select("id", "reach", "b.*")
    templates = known.withColumn("hashes", F.transform("held", lambda p: F.xxhash64(p)))
    templates = templates.select("template", "reach", F.explode(bands(F.col("hashes"))).alias("b")).select("template", "reach", "b.*")
    met = sketched.join(templates, ["reach", "band", "low"]).select("id", "template").distinct()
    # the shingles themselves are fetched only for windows that met a template
    met = met.join(windows.select("id", "pairs"), "id").select("id.doc_id", "id._key", "id.first_word", "template", "pairs")
    checked = met.join(known.select("template", "held"), "template")
    share = F.size(F.array_intersect("pairs", "held")) / F.size("held")
    checked = checked.withColumn("containment", share).filter(F.col("containment") >= containment)
    found = checked.groupBy("doc_id", "_key", "template").agg(
        F.max("containment").alias("containment"), F.min(F.struct(-F.col("containment"), "first_word"))["first_word"].alias("first_word"),
        F.countDistinct("first_word").alias("n_windows"))
    return found.drop("_key")


_VALUES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in NOTICES.items())
#: every window against every template, in DuckDB, over the table ``documents``
ORACLE = f"""
WITH notices(template, text) AS (VALUES {_VALUES}),
t AS (SELECT template, list_filter(string_split_regex(lower(text), '{WORD_GAP}'), lambda w: w <> '') AS words FROM notices),
known AS (SELECT template, CAST(pow(2, ceil(log2(greatest(len(words), 2)))) AS BIGINT) AS reach,
    list_distinct([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) AS held FROM t),
d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '{WORD_GAP}'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT doc_id, reach, CAST(k * reach AS BIGINT) AS first_word, words[k * reach + 1 : k * reach + 2 * reach] AS part
  FROM d, (SELECT DISTINCT reach FROM known) r, unnest(range(0, CAST(ceil(len(words) / reach) AS BIGINT))) u(k)),
p AS (SELECT doc_id, reach, first_word, list_distinct([part[i] || ' ' || part[i + 1] for i in range(1, len(part))]) AS pairs FROM w),
c AS (SELECT doc_id, first_word, template, len(list_intersect(pairs, held)) / len(held) AS containment FROM p JOIN known USING (reach))
SELECT doc_id, template, max(containment) AS containment, arg_min(first_word, (-containment, first_word)) AS first_word,
  count(DISTINCT first_word) AS n_windows FROM c WHERE containment >= {CONTAINMENT} GROUP BY doc_id, template
"""
