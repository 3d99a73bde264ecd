"""Texts whose structure fools polynomial hashes: Thue-Morse words and word sequences and their complements."""

import hashlib
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skyloom.llm import bits, fingerprints, near_dedup, packing, quality, substring, text, token_files, tokens
from skyloom.session import ship_package

TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))


def thue_morse(n, a, b):
    return [(a, b)[bin(i).count("1") & 1] for i in range(n)]


W1, W2 = "".join(thue_morse(1024, "a", "b")), "".join(thue_morse(1024, "b", "a"))
X1, X2 = "".join(thue_morse(2048, "a", "b")), "".join(thue_morse(2048, "b", "a"))
S1, S2 = " ".join(thue_morse(2048, "red", "blue")), " ".join(thue_morse(2048, "blue", "red"))
COMMON = " ".join(f"c{i}" for i in range(60))
TEXTS = {1: W1, 2: W2, 3: X1, 4: X2, 5: f"{COMMON} {W1}", 6: f"{COMMON} {W2}", 7: f"{W1}\n{W2}\n{W1} x", 8: f"q {W2} {X2}\n{X1} {W1}"}


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.createDataFrame([(i, t, "en") for i, t in TEXTS.items()], "doc_id long, text string, lang string")


def test_word_and_sequence_hashes():
    data = " ".join([W1, W2, X1, X2]).encode()
    words = text.find_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    for hashes in text.word_hashes(words, pair=True):
        assert len(set(hashes.tolist())) == 4
    both = (S1 + S2).encode()
    words = text.find_words(np.frombuffer(both, np.uint8), np.array([0, len(S1), len(both)]))
    for sequence in text.sequence_hashes(words, *text.word_hashes(words, pair=True)):
        assert sequence[0] != sequence[1]
    for k in (32, 50, 1024):
        a, b = (np.array(thue_morse(k, *pair), np.uint64) for pair in ((3, 1 << 40), (1 << 40, 3)))
        assert text.gram_hashes(a, k)[0] != text.gram_hashes(b, k)[0]


def test_long_words_are_hashed_in_stretches(monkeypatch):
    data = " ".join([W1, "a", W2, "bc", X1] * 3).encode()
    words = text.find_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    whole = text.word_hashes(words, pair=True)
    monkeypatch.setattr(text, "HASHED_BYTES", 1500)
    assert all((a == b).all() for a, b in zip(whole, text.word_hashes(words, pair=True)))


def test_token_ids_equal_the_library(docs, monkeypatch):
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    want, place = {}, 0
    for i, t in sorted(TEXTS.items()):
        ids = plain.encode(t, add_special_tokens=False).ids + [2]
        want[i] = (place, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        place += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_file_round_trip(docs, TOKENIZER).collect()} == want
    pieces = {}
    for r in packing.packed(docs, TOKENIZER).collect():
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.length
    assert pieces == {i: v[1] for i, v in want.items()}
    # a first hash that tells nothing apart: the second one sends the slice to the library
    monkeypatch.setattr(tokens, "mix64", lambda x: x & np.uint64(1))
    encoder = tokens.Encoder(TOKENIZER)
    data = "several words here, several more".encode()
    for _ in range(2):
        ids, bounds = encoder.encode(np.frombuffer(data, np.uint8), np.array([0, 5, len(data)]))
        assert ids[:bounds[1]].tolist() == plain.encode("sever").ids and ids[bounds[1]:].tolist() == plain.encode(data.decode()[5:]).ids


def test_fingerprints_differ(docs):
    marks = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert len(set(marks.values())) == len(TEXTS)


def test_quality_counts(docs, spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.n_dup_lines for r in quality.quality_verdicts(docs, labels).collect()}
    assert got == dict.fromkeys(TEXTS, 0)


def test_near_duplicates_keep_unequal_words_apart(docs):
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: 5 if i == 6 else i for i in TEXTS}


def test_substring_keeps_the_last_word(docs):
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in substring.without_repeats(docs).collect()}
    assert got[6] == (60, hashlib.sha256(W2.encode()).hexdigest()) and all(v[0] == 0 for i, v in got.items() if i != 6)


def test_bit_tables_never_miss(spark):
    ship_package(spark)
    keys = spark.range(0, 5000, 7).selectExpr("xxhash64(id) as h", "id")
    from pyspark.sql import functions as F

    for log_bits in (8, 20):
        rows = spark.range(5000).withColumn("hit", bits.maybe_in(keys, F.col("h"), F.xxhash64("id"), log_bits)).collect()
        assert all(r.hit for r in rows if r.id % 7 == 0)
    assert sum(r.hit for r in rows) < 5000 / 7 * 1.1
    empty = keys.filter("id < 0")
    assert spark.range(10).filter(bits.maybe_in(empty, F.col("h"), F.xxhash64("id"))).count() == 0


def test_new_pieces_go_to_the_model_alone():
    """The library's whole encoding of a piece costs several times the model's part and keeps its records meanwhile."""
    encoder = tokens.Encoder(TOKENIZER)
    plain, values = encoder.tokenizer, ["it's <|endoftext|> \x00\xad\xa0 näïve 東京  2024!\n\n", "", "\U0001f600" * 3 + " x" * 400, "y" * 3000]

    class OnlyCuts:
        pre_tokenizer = plain.pre_tokenizer

    encoder.tokenizer = OnlyCuts()
    parts = [v.encode() for v in values]
    ids, bounds = encoder.encode(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain.encode(v, add_special_tokens=False).ids for v in values]


def test_the_encoder_stays_small():
    """Two workers of an executor hold an encoder each beside the JVM: what it holds and takes meanwhile is bounded."""
    letters = str.maketrans("0123456789", "ghijklmnop")
    words = [f"{i * 2654435761 % 2**32:08x}".translate(letters) for i in range(500_000)]
    values = [" ".join(words[i:i + 5000]) + " 東京\U0001f600" for i in range(0, len(words), 5000)]
    tracemalloc.start()
    encoder, sizes = tokens.Encoder(TOKENIZER), []
    for _, _, data, offsets in text.slices(pa.array(values)):
        ids, bounds = encoder.encode(data, offsets)
        sizes += np.diff(bounds).tolist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [len(e.ids) for e in encoder.tokenizer.encode_batch(values, add_special_tokens=False)]
    assert peak < 40e6, peak
