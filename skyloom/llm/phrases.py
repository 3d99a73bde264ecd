"""Operator 13: phrases by collocation score, mined as Toivonen does.

A phrase is a run of 1 to ``LONGEST`` words of a piece of text. A run can only be frequent if the runs without its last
and without its first word are, which a sample uses to propose what to count:

1. the sample counts all runs at a lowered threshold; those above it are proposed;
2. a full pass counts, over all documents, every word and every run whose two parts are proposed: the proposed phrases
   and their negative border, the shortest runs that are not proposed;
3. where a run of the border proves frequent the border has failed: what is frequent joins the proposed phrases, and a
   further pass counts the runs that are new because of it. Once no frequent run lies outside the proposed phrases all
   frequent runs are counted, whatever the sample was; that takes at most as many passes as a phrase has words.

These passes count 64-bit hashes, a few bytes a run. Proposed phrases go to the workers as a bit table of a fixed
size: a false hit counts a run too many, never one too few. A last pass takes the runs whose hash is frequent with
their words, and Spark counts the strings, so every number in the result is an exact count.

Defined cases: null and empty texts have no words; a null language is ``und``; rows count as often as they are there,
doc_id plays no part; a text or word of any length is worked whole; ties go to the smallest cut and to the phrase that
comes first bytewise; an empty table gives no rows. Extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.bits import bit_table, probe
from skyloom.llm.substring import text_array
from skyloom.llm.text import Words, find_words, gram_hashes, mix64, slices, word_hashes
from skyloom.session import store

LONGEST = 4
SUPPORT = 30
SAMPLE_EVERY = 8  # the sample holds one document in so many, by a hash of the row
SAMPLE_SUPPORT = 2  # about half of what SUPPORT leaves in the sample
ABSORBED = 80  # percent of a phrase's occurrences that lie inside a longer one
SCALE = 2_000_000
TOP = 2000
SALTS = 64
LOG_BITS = 27  # bits of the table of proposed phrases: 16 MB
_COUNTED_AT_ONCE = 1 << 22
_END = np.zeros(256, bool)
_END[list(b".,;:!?\n\x0b\x0c\r")] = True
_BETWEEN = _END.copy()
_BETWEEN[list(b" \t")] = True


class Runs:
    """The words of a slice of texts, and which of them lie in one piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray):
        self.words: Words = find_words(data, offsets, lower=True, between=_BETWEEN)
        self.hashes = word_hashes(self.words)
        self.text = self.words.texts_of_words()
        self.language = languages[self.text]
        self.piece = np.cumsum(_END[self.words.data])[self.words.starts] + self.text if len(self.text) else self.text

    def starts(self, k: int) -> np.ndarray:
        """Words at which a run of ``k`` words of one piece begins."""
        n = len(self.text) - k + 1
        return np.flatnonzero(self.piece[:n] == self.piece[k - 1:]) if n > 0 else np.empty(0, np.int64)

    def keys(self, k: int) -> np.ndarray:
        """A hash of each run of ``k`` words and its language; the last two bits tell ``k``."""
        grams = gram_hashes(self.hashes, k, 20 + k)
        return (mix64(grams ^ self.language[:len(grams)]) & ~np.uint64(3)) | np.uint64(k - 1)


def _languages(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _counts(emit):
    """Counts of the run hashes that ``emit(runs)`` gives, put together for some millions of runs at a time."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            languages = _languages(batch.column(1))
            for row, end, data, offsets in slices(batch.column(0)):
                for keys in emit(Runs(data, offsets, languages[row:end])):
                    held.append(keys)
                    size += len(keys)
                if size >= _COUNTED_AT_ONCE:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return count


def _all_runs(runs: Runs) -> Iterator[np.ndarray]:
    for k in range(1, LONGEST):
        yield runs.keys(k)[runs.starts(k)]


def _runs_with_parts(proposed, added):
    """All words, and longer runs with both parts proposed; with ``added``, the latest bits, only runs that need one of them."""

    def emit(runs: Runs) -> Iterator[np.ndarray]:
        keys = runs.keys(1)
        if added is None:
            yield keys
        for k in range(2, LONGEST + 1):
            at, longer = runs.starts(k), runs.keys(k)
            if added is not None:
                fresh = probe(added.value, keys)
                at = at[fresh[at] | fresh[at + 1]]
                at = at[probe(proposed.value, keys[at])]
                yield longer[at[probe(proposed.value, keys[at + 1])]]
            else:
                now = probe(proposed.value, keys)
                yield longer[at[now[at] & now[at + 1]]]
            keys = longer

    return emit


def frequent_keys(texts: DataFrame, sample: DataFrame, support: int = SUPPORT, sample_support: int = SAMPLE_SUPPORT, log_bits: int = LOG_BITS) -> DataFrame:
    """key, n of every run of ``texts`` (text, language) that occurs ``support`` times; proposed by ``sample``, rows of the same kind."""
    context = texts.sparkSession.sparkContext

    def counted(rows: DataFrame, emit, least: int) -> DataFrame:
        found = rows.mapInArrow(_counts(emit), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        return store(found.filter(F.col("n") >= least))

    table = bit_table(counted(sample, _all_runs, sample_support), F.col("key"), log_bits)
    added, frequent = None, None
    while True:
        found = counted(texts, _runs_with_parts(context.broadcast(table), added), support)
        frequent = found if frequent is None else frequent.unionByName(found)
        # runs of the full length are part of no other run
        outside = bit_table(found.filter(F.col("key").bitwiseAND(F.lit(3)) < LONGEST - 1), F.col("key"), log_bits) & ~table
        if not outside.any():
            return frequent
        table, added = table | outside, context.broadcast(outside)


def _strings(wanted):
    """language, words, phrase, n for the runs whose hash is in ``wanted``, and the words of each text with no phrase."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, names = _languages(batch.column(1)), batch.column(2)
            for row, end, data, offsets in slices(batch.column(0)):
                runs = Runs(data, offsets, languages[row:end])
                words = runs.words
                lengths = words.ends - words.starts
                _, others = word_hashes(words, pair=True)
                for k in range(1, LONGEST + 1):
                    keys, start = runs.keys(k), runs.starts(k)
                    start = start[probe(wanted.value, keys[start])]
                    if not len(start):
                        continue
                    first, second = keys[start], gram_hashes(others, k, 30 + k)[start]
                    order = np.argsort(first, kind="stable")
                    if (np.diff(first[order]) == 0)[second[order][1:] != second[order][:-1]].any():
                        order = np.lexsort((second, first))
                    new = np.ones(len(order), bool)
                    new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
                    heads = np.flatnonzero(new)
                    shown = start[order[heads]]
                    # the words of each phrase with one space behind every word but the last
                    each = (shown[:, None] + np.arange(k)).ravel()
                    sizes = lengths[each] + 1
                    upto = np.cumsum(sizes)
                    at = np.arange(int(upto[-1])) + np.repeat(words.starts[each] - (upto - sizes), sizes)
                    raw = words.data[np.minimum(at, len(words.data) - 1)]
                    raw[upto - 1] = 32
                    inside = np.ones(len(raw), bool)
                    inside[upto[k - 1::k] - 1] = False
                    phrase = text_array(raw[inside], np.append(0, upto[k - 1::k] - np.arange(1, len(shown) + 1)))
                    yield pa.RecordBatch.from_arrays([
                        names.take(pa.array(row + runs.text[shown])), pa.array(np.full(len(shown), k, np.int32)), phrase,
                        pa.array(np.diff(np.append(heads, len(order))), pa.int64()),
                    ], names=["lang", "words", "phrase", "n"])
                yield pa.RecordBatch.from_arrays([
                    names.slice(row, end - row), pa.array(np.zeros(end - row, np.int32)), pa.nulls(end - row, pa.string()), pa.array(words.counts, pa.int64()),
                ], names=["lang", "words", "phrase", "n"])

    return emit


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, sample_every: int = SAMPLE_EVERY, sample_support: int = SAMPLE_SUPPORT, log_bits: int = LOG_BITS) -> tuple[DataFrame, DataFrame]:
    """(phrases: lang, words, phrase, n; totals: lang, n): all runs with ``support`` occurrences, and all words, per language."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    text = F.col("text").cast("string")
    texts = docs.select(text.alias("text"), F.xxhash64(lang).alias("language"), lang.alias("lang"))
    drawn = F.pmod(F.xxhash64(F.lit(13), "text", "lang"), F.lit(sample_every)) == 0
    keys = frequent_keys(texts.select("text", "language"), texts.filter(drawn).select("text", "language"), support, sample_support, log_bits)
    wanted = docs.sparkSession.sparkContext.broadcast(bit_table(keys, F.col("key"), log_bits))
    found = texts.mapInArrow(_strings(wanted), "lang string, words int, phrase string, n long")
    found = store(found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).filter(F.col("phrase").isNull() | (F.col("n") >= support)))
    return found.filter("phrase is not null"), found.filter("phrase is null and n > 0").select("lang", "n")


def _wide(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(20,0)")


def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("_w", first, size), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """lang, words, phrase, a, l, r, score for the phrases of two words and more that no longer one absorbs."""
    longer = phrases.filter("words >= 2").withColumnRenamed("n", "a").withColumn("_w", F.split("phrase", " "))
    cut = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.select("lang", "words", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("head"), _part(F.col("k") + 1, F.col("words")).alias("tail"))
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    # products may pass 64 bits
    product, whole = _wide("a") * F.lit(SCALE).cast("decimal(8,0)"), _wide("l") + _wide("r")
    cut = cut.withColumns({"x": product, "y": whole}).select("lang", "words", "phrase", "a", "k", "l", "r", F.expr("x div y").alias("score"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("m")
    best = cut.groupBy("lang", "words", "phrase", "a").agg(lowest).select("lang", "words", "phrase", "a", "m.l", "m.r", "m.score")
    inner = longer.filter("words >= 3").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = inner.select("lang", _part(F.col("start"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_over"))
    joined = best.join(inner, ["lang", "phrase"], "left")
    absorbed = _wide("_over") * 100 >= _wide("a") * ABSORBED
    return joined.filter(~F.coalesce(absorbed, F.lit(False))).drop("_over")


def top_phrases(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language of ``docs`` (text, lang)."""
    phrases, totals = frequent_phrases(docs, **options)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # a language is first cut in parts, so that no task sorts all of its phrases
    salted = scored(phrases).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    ahead = salted.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_place") <= top)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_RUNS = " UNION ALL ".join(
    f"SELECT lang, {k} AS words, unnest([array_to_string(w[i:i + {k - 1}], ' ') for i in range(1, len(w) - {k} + 2)]) AS phrase FROM p" for k in range(1, LONGEST + 1))
#: every run counted, in DuckDB, over the table ``documents``
ORACLE = f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x <> '') AS w FROM t),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (SELECT lang, words, phrase, count(*) AS n FROM ({_RUNS}) GROUP BY ALL HAVING count(*) >= {SUPPORT}),
c AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE words >= 2),
cuts AS (SELECT lang, words, phrase, a, w, unnest(range(1, words)) AS k FROM c),
s AS (SELECT u.lang, u.words, u.phrase, a, k, x.n AS l, y.n AS r, CAST((2000000::HUGEINT * a) // (x.n + y.n) AS BIGINT) AS score FROM cuts u
  JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(w[1:k], ' ') JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sized AS (SELECT lang, a, w, words, unnest(range(2, words)) AS size FROM c),
inside AS (SELECT lang, a, unnest([array_to_string(w[i:i + size - 1], ' ') for i in range(1, words - size + 2)]) AS phrase FROM sized),
over AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN over USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
