"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import fingerprints, licenses, manifest, mixing, near_dedup, packing, phrases, pieces, quality, sharding, substring, token_files, toxicity
from skyloom.session import ship_package

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    return str(public_tokenizers.path(TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": lambda s, d: mixing.mixed(table(s, d, "documents")),
    "op2_fingerprints": lambda s, d: fingerprints.fingerprints_and_edits(table(s, d, "documents")),
    "op3_token_files": lambda s, d: token_files.token_file_round_trip(table(s, d, "documents"), tokenizer_path()),
    "op4_packing": lambda s, d: packing.packed(table(s, d, "documents"), tokenizer_path()),
    "op5_toxicity": lambda s, d: toxicity.toxicity(table(s, d, "documents"), table(s, d, "labels")),
    "op6_sharding": lambda s, d: sharding.shard_table(table(s, d, "documents")),
    "op7_licenses": lambda s, d: licenses.license_matches(table(s, d, "documents"), licenses.notices(s)),
    "op8_quality": lambda s, d: quality.quality_verdicts(table(s, d, "documents"), table(s, d, "labels")),
    "op9_near_dedup": lambda s, d: near_dedup.near_duplicates(table(s, d, "documents")),
    "op10_substring": lambda s, d: substring.without_repeats(table(s, d, "documents")),
    "op11_sentence_pieces": lambda s, d: pieces.round_trips(table(s, d, "documents"), str(public_tokenizers.path(PIECES))),
    "op12_manifest": lambda s, d: manifest.manifest_proofs(table(s, d, "documents")),
    "op13_phrases": lambda s, d: phrases.top_phrases(table(s, d, "documents")),
}
ORACLE: dict[str, str] = {"op1_mixing": mixing.ORACLE, "op7_licenses": licenses.ORACLE, "op12_manifest": manifest.ORACLE, "op13_phrases": phrases.ORACLE}
