"""Phrase mining against plain counting, with samples that propose too little, too much and nothing."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyloom.llm import phrases
from skyloom.session import ship_package

TINY = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    found, totals = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i:i + k]))
                    found[key] = found.get(key, 0) + 1
    return found, totals


def brute(rows, support=30, top=2000):
    f, totals = counts(rows)
    candidates = {key: a for key, a in f.items() if a >= support and len(key[1]) >= 2}
    best = {}
    for (lang, w), a in candidates.items():
        best[lang, w] = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
    gone = set()
    for (lang, w), n in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                inner = (lang, w[i:i + size])
                if 100 * n >= 80 * f[inner]:
                    gone.add(inner)
    out = []
    for lang in totals:
        mine = sorted((-s, -candidates[lang, w], " ".join(w).encode(), lft, r) for (g, w), (s, _, lft, r) in best.items() if g == lang and (g, w) not in gone)
        out += [(lang, i, p.decode(), -a, lft, r, totals[lang], -s) for i, (s, a, p, lft, r) in enumerate(mine[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rng = random.Random(3)
    weights = [1 / (i + 1) for i in range(60)]
    rows = []
    for i in range(500):
        words = rng.choices([f"W{j}" for j in range(60)], weights, k=rng.randrange(0, 60))
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", "\n", ".", "! "]) for w in words)
        rows.append((i, text + "new york city hall " * rng.randrange(3), rng.choice(["en", "en", "en", "de", None, "und"])))
    rows += [(9000 + i, "the same line of copied text, é À ß", "en") for i in range(200)] + [(1, None, "en"), (None, "", None), (2, " . ", "fr")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("options", [
    {}, {"sample_every": 1, "sample_support": 30}, {"sample_every": 1, "sample_support": 1}, {"sample_every": 1 << 40}, {"sample_every": 2, "sample_support": 40},
    {"log_bits": 8}, {"sample_every": 1 << 40, "log_bits": 12, "support": 9, "top": 7},
])
def test_any_sample_gives_the_same_phrases(docs, options):
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = rows_of(phrases.top_phrases(docs, **options))
    assert got == brute(rows, options.get("support", 30), options.get("top", 2000)) and len(got) > 20


def test_counts_of_all_frequent_runs(docs):
    found, totals = phrases.frequent_phrases(docs, support=5, sample_every=3)
    want, words = counts([(r.lang, r.text) for r in docs.collect()])
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.collect()} == {k: n for k, n in want.items() if n >= 5}
    assert {r.lang: r.n for r in totals.collect()} == {g: n for g, n in words.items() if n}


def test_tiny_table(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    assert rows_of(phrases.top_phrases(docs.withColumns({"n": F.lit(1), "k": F.lit("x")}))) == brute([(r.lang, r.text) for r in docs.collect()])


def test_nothing_to_count(spark):
    ship_package(spark)
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.top_phrases(empty).count() == 0
    assert phrases.top_phrases(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0


def test_large_products_stay_exact(spark):
    big = (1 << 62) // 3
    rows = [("en", 1, "a", big + 1), ("en", 1, "b", big + 2), ("en", 2, "a b", big)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, words int, phrase string, n long")).collect()
    assert [(r.phrase, r.score) for r in got] == [("a b", 2_000_000 * big // (2 * big + 3))]
