"""Operator 8: quality rules with risk-controlled thresholds.

Texts are measured, every rule turns the measures into a score (higher is worse), and each rule rejects
from a cutoff upwards. The cutoffs are chosen per stratum on labelled rows: a cutoff is accepted only if an
exact binomial test shows, at a level corrected for all strata and rules, that it rejects at most its share
of the good rows. Cutoffs are tried from the most lenient to the strictest and the search stops at the first
that fails (fixed-sequence testing), so trying many of them costs no further correction.

Defined cases: null and empty texts have no words and fail the base rule; a null stratum is a stratum; rows
may repeat (each gets its own verdict); a row without a label counts in no test; of several labels of one
id the lowest counts; a stratum with too few good labels gets no cutoffs, so nothing is rejected there beyond
the base rule; a text of any length is measured whole; a score equal to a cutoff is rejected; an empty
table gives no rows. Extra columns are left alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.text import Words, find_words, gram_hashes, mix64, slices, word_hashes
from skyloom.session import store

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
RISK = 0.02  # largest share of good rows that all rules together may reject in a stratum
DELTA = 0.05  # chance that any stratum goes beyond it

#: rule -> cutoffs to try, from the strictest to the most lenient
CUTOFFS = {
    "symbol_share": (0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.3, 0.5),
    "repeat_share": (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5),
    "dup_line_share": (0.001, 0.002, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05, 0.08, 0.1),
    "word_length": (5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0),
}

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def _alike(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: is its value there again under the same owner; is it there earlier."""
    order = np.argsort(mix64(values ^ mix64(owner.astype(np.uint64) + np.uint64(1))), kind="stable")
    same = (values[order][1:] == values[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    later, again = np.zeros(len(values), bool), np.zeros(len(values), bool)
    later[order[1:]] = same
    again[order[1:]] |= same
    again[order[:-1]] |= same
    return again, later


def measure_slice(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    words = find_words(data, offsets)
    n = len(offsets) - 1
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.ends, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    out = {
        "n_words": words.counts, "n_symbols": _sums(_IS_SYMBOL[data], offsets),
        "word_chars": _sums(inside & ((data & 0xC0) != 0x80), offsets),
    }
    # lines: cut after every \n and at every text
    cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    starts, ends = cuts[:-1], cuts[1:].copy()
    ends[data[ends - 1] == 10] -= 1
    full = np.concatenate([[0], np.cumsum(inside)])
    has_word = full[ends] > full[starts]
    starts, ends = starts[has_word], ends[has_word]
    owner = np.searchsorted(offsets, starts, "right") - 1
    _, later = _alike(owner, word_hashes(Words(data, starts, ends, owner)))
    out["n_dup_lines"] = np.bincount(owner[later], minlength=n)
    # words covered by a 3-word window that is there twice
    grams, texts = gram_hashes(word_hashes(words), 3), words.texts_of_words()
    at = np.flatnonzero(texts[:len(grams)] == texts[2:]) if len(grams) else np.empty(0, np.int64)
    again, _ = _alike(texts[at], grams[at])
    covered = np.zeros(len(texts), bool)
    for step in range(3):
        covered[at[again] + step] = True
    out["n_repeat_words"] = np.bincount(texts[covered], minlength=n)
    return out


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def text_measures(texts: pa.Array) -> pa.Array:
    parts = [measure_slice(data, offsets) for _, _, data, offsets in slices(texts)]
    columns = [pa.array(np.concatenate([p[m] for p in parts]) if parts else [], pa.int64()) for m in MEASURES]
    return pa.StructArray.from_arrays(columns, names=list(MEASURES))


def base_failed(m) -> Column:
    return (m("n_words") < MIN_WORDS) | (m("n_repeat_words") * 100 > m("n_words") * MAX_REPEAT_PERCENT)


def rule_scores(m) -> dict[str, Column]:
    words, chars = F.greatest(m("n_words"), F.lit(1)), F.greatest(m("word_chars"), F.lit(1))
    return {
        "symbol_share": m("n_symbols") / chars, "repeat_share": m("n_repeat_words") / words,
        "dup_line_share": m("n_dup_lines") / words, "word_length": m("word_chars") / words,
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for n trials of chance p: the regularized incomplete beta function I_{1-p}(n-k, k+1)."""
    if k >= n:
        return 1.0
    return _beta(n - k, k + 1, 1 - p)


def _beta(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c = 1e-300, 1.0
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 100_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + step / c
            c = c if abs(c) > tiny else tiny
            total *= d * c
        if abs(d * c - 1) < 1e-13:
            break
    return front * total


def upper_bound(k: int, n: int, delta: float) -> float:
    """Exact (Clopper-Pearson) upper confidence bound of a share seen k times in n."""
    low, high = (k / n if n else 0.0), 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(k, n, middle) > delta else (low, middle)
    return high


def choose_cutoff(rejected: list[int], n: int, cutoffs: tuple[float, ...], risk: float, delta: float) -> float | None:
    """The strictest cutoff with a proven risk; ``rejected[i]`` of ``n`` good rows score at least ``cutoffs[i]``."""
    chosen = None
    for cutoff, k in sorted(zip(cutoffs, rejected), reverse=True):
        if n == 0 or k > risk * n or binomial_tail(k, n, risk) > delta:
            break
        chosen = cutoff
    return chosen


def learn_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a cutoff per rule (null: the rule rejects nothing there).

    ``measured``: doc_id, the stratum, the measures; ``labels``: doc_id, quality (1 is good). The labelled rows are
    counted into the fixed cutoff steps before anything is grouped, so a stratum of any size is a few rows.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")
    held = measured.filter(~base_failed(F.col)).join(good, "doc_id", "left_semi")
    steps = []
    for rule, score in rule_scores(F.col).items():
        step = sum((score >= F.lit(x)).cast("int") for x in CUTOFFS[rule])
        steps.append(F.struct(F.lit(rule).alias("rule"), step.alias("step")))
    counted = held.select(F.col(stratum).alias("stratum"), F.explode(F.array(*steps)).alias("s"))
    counted = store(counted.groupBy("stratum", "s.rule", "s.step").agg(F.count(F.lit(1)).alias("n")))
    tests = max(counted.select("stratum").distinct().count(), 1) * len(CUTOFFS)

    def cut(rows: pa.Table) -> pa.Table:
        rule = rows.column("rule")[0].as_py()
        by_step = np.bincount(rows.column("step").to_numpy(), weights=rows.column("n").to_numpy(), minlength=len(CUTOFFS[rule]) + 1).astype(np.int64)
        rejected = np.cumsum(by_step[::-1])[::-1][1:].tolist()
        chosen = choose_cutoff(rejected, int(by_step.sum()), CUTOFFS[rule], risk / len(CUTOFFS), delta / tests)
        return pa.table({"stratum": rows.column("stratum").slice(0, 1), "rule": pa.array([rule]), "cutoff": pa.array([chosen], pa.float64())})

    chosen = counted.groupBy("stratum", "rule").applyInArrow(cut, "stratum string, rule string, cutoff double")
    picks = [F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"max_{rule}") for rule in CUTOFFS]
    return store(chosen.groupBy("stratum").agg(*picks))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang", m=F.col) -> DataFrame:
    """Adds ``base_failed`` and ``kept``; ``m`` finds a measure by name."""
    rejected = F.lit(False)
    for rule, score in rule_scores(m).items():
        rejected = rejected | F.coalesce(score >= F.col(f"max_{rule}"), F.lit(False))
    joined = measured.join(cutoffs, measured[stratum].eqNullSafe(cutoffs["stratum"]), "left")
    failed = base_failed(m)
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~rejected}).drop("stratum", *[f"max_{r}" for r in CUTOFFS])


def measured_documents(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    found = docs.select("doc_id", F.col(stratum).cast("string").alias(stratum), text_measures("text").alias("_m"))
    return found.select("doc_id", stratum, *[F.col(f"_m.{x}").alias(x) for x in MEASURES])


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, the measures, base_failed, kept for every row of ``docs`` (doc_id, text, the stratum column)."""
    measured = store(measured_documents(docs, stratum))
    judged = judge(measured, learn_cutoffs(measured, labels, stratum, risk, delta), stratum)
    return judged.select("doc_id", *MEASURES, "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The texts are measured a second time instead of being shuffled to their verdicts.
    """
    cutoffs = learn_cutoffs(store(measured_documents(docs, stratum)), labels, stratum, risk, delta)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(stratum).cast("string").alias("_stratum"), text_measures("text").alias("_m"))
    return judge(held, cutoffs, "_stratum", lambda x: F.col(f"_m.{x}")).filter("kept").select("_row.*")
