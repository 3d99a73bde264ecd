"""Every corpus operator and stage on odd input: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyloom.llm import fingerprints, licenses, mixing, near_dedup, packing, quality, sharding, substring, token_files, toxicity
from skyloom.session import ship_package

TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{i % 5000}" for i in range(60_000)) + " " + "x" * 200_000
ROWS = [
    (1, "one two three four five six seven", "en", "a", 33), (1, "one two three four five six seven", "en", "a", 33), (1, "another text", "en", "a", 12),
    (2, None, "en", "b", None), (3, "", None, None, 0), (4, " \t\n ", "de", "b", 4), (5, "word", "de", "b", 4), (6, LONG, "fr", "c", len(LONG)),
    (7, LONG, "fr", "c", len(LONG)), (None, "no id here at all, nothing", "en", None, 26), (None, None, None, None, None),
    (8, "Éa   ß 漢字 😀 don't 12 <|endoftext|>", "en", "a", 30), (9, "licensed under the apache license version 2 0", "en", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, None, None), (None, 1, 1), (77, 1, 1), (6, 1, 0)], LABELS)


OPERATORS = {
    "op1": (lambda d, l: mixing.mixed(d), "size source_size target taken copies"),
    "op2": (lambda d, l: fingerprints.fingerprints_and_edits(d), "n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next"),
    "op3": (lambda d, l: token_files.token_file_round_trip(d, TOKENIZER), "start n_tokens ids_crc32"),
    "op5": (lambda d, l: toxicity.toxicity(d, l), "held_out score predicted"),
    "op6": (lambda d, l: sharding.shard_table(d), "size text_crc32 law shard slot grown_shard"),
    "op8": (lambda d, l: quality.quality_verdicts(d, l), "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"),
    "op9": (lambda d, l: near_dedup.near_duplicates(d), "n_shingles component_id kept"),
    "op10": (lambda d, l: substring.without_repeats(d), "n_words n_removed kept_sha256"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(docs, labels, name):
    run, columns = OPERATORS[name]
    got = run(docs, labels)
    assert got.columns == ["doc_id", *columns.split()]
    ids = sorted(((r.doc_id is None, r.doc_id) for r in got.collect()), key=str)
    assert ids == sorted(((r[0] is None, r[0]) for r in ROWS), key=str)
    assert got.dropDuplicates().count() >= len(set(ROWS)) - 2


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(docs, labels, name):
    run, columns = OPERATORS[name]
    got = run(docs.limit(0), labels.limit(0))
    assert got.columns == ["doc_id", *columns.split()] and got.count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_no_labels_and_clashing_columns(docs, labels, name):
    run, columns = OPERATORS[name]
    clash = [c for c in [*columns.split(), "component_id", "kept", "key", "node", "at", "weight", "stratum", "_bucket", "_row"] if c not in docs.columns]
    odd = docs.withColumns({c: F.lit("other") for c in clash})
    assert run(odd, labels.limit(0)).select("doc_id").count() == len(ROWS)


def test_empty_and_clashing_packing_and_licenses(docs):
    assert packing.packed(docs.limit(0), TOKENIZER).count() == 0
    assert licenses.license_matches(docs.limit(0), licenses.notices(docs.sparkSession)).count() == 0
    odd = docs.withColumns({c: F.lit("x") for c in ("length", "_part", "offset", "piece", "words", "template", "reach", "places")})
    assert packing.packed(odd, TOKENIZER).select("doc_id").distinct().count() == len({r[0] for r in ROWS})
    found = licenses.license_matches(odd, licenses.notices(docs.sparkSession)).collect()
    assert [(r.doc_id, r.template, r.containment) for r in found] == [(9, "Apache-2.0", 1.0)]


def test_stages_keep_columns(spark, docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1, 0)], LABELS).write.parquet(f"{folder}/labels.parquet")
    odd = docs.withColumns({"kept": F.lit(7), "_row": F.lit(1), "_new": F.lit("n"), "_copy": F.lit(2), "stratum": F.lit("s"), "target": F.lit(0.5)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, folder)
        assert out.columns == odd.columns and out.dtypes == odd.dtypes, name
        out.collect()
        assert stage(spark, odd.limit(0), folder).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, folder).count() > len(ROWS)


def test_defined_cases(docs, labels):
    near = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert near[2, 0] == (2, True) and near[3, 0] == (3, True) and near[4, 0] == (4, True) and near[None, 0] == (None, True)
    assert near[5, 1] == (5, True) and [v for k, v in near.items() if k[0] == 7] == [(6, False)]
    stay = [r.text for r in near_dedup.keep_one(docs).filter("doc_id = 1 or doc_id >= 6").collect()]
    assert sum(t.startswith("one two") for t in stay) == 1 and stay.count(LONG) == 1 and "another text" in stay
    cut = {(r.doc_id, r.n_words): r.n_removed for r in substring.without_repeats(docs).collect()}
    assert cut[6, 60_001] == 0 and cut[7, 60_001] == 60_001 and cut[None, 6] == 0
    mixed = mixing.mixed(docs).collect()
    assert {r.doc_id: r.size for r in mixed if r.doc_id in (2, 3, 4)} == {2: 0, 3: 0, 4: 0}
    assert {r.held_out for r in toxicity.toxicity(docs, labels).collect() if r.doc_id is None} == {False}
    shards = sharding.shard_table(docs).collect()
    assert {r.size for r in shards if r.doc_id in (2, 3)} == {8} and sorted(r.shard for r in shards) == list(range(len(ROWS)))


def test_repeated_rows_stay_once_by_id_and_text(docs):
    """Rows without an id all stay, whether or not another id is repeated; rows of one id and text stay once."""
    spark = docs.sparkSession
    none = [(None, "the same row without an id", "en", "a", 1)] * 3
    again = [(1, "one text of words", "en", "b", 1), (1, "one text of words", "en", "a", 1), (1, "other", "en", "a", 1)]
    for rows, ids in ((none, []), (none + again, [("a", "one text of words"), ("a", "other")])):
        stay = near_dedup.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
        assert sum(r.doc_id is None for r in stay) == 3
        assert sorted((r.source, r.text) for r in stay if r.doc_id == 1) == ids
