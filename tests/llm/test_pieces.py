"""SentencePiece encoding against the library itself, with character maps of its public rules."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from skyloom.llm import pieces
from skyloom.session import ship_package

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
TINY = "/root/testdata/sf0.001"
ODD = ["", " ", "   ", "  a b", "hello  world ", "a▁b", "▁", "▁▁ ▁", "x\n\ny", "😀‍ ", "\x00a", "① Ａｂ  ﬃ ㌔é é  x \t y", "éé̂ ", "ﬁ 　x",
       "à" * 5, "​​", " ​ ", "①  ", "가각ᆨ", "ｶﾞ ｶﾞｶﾞ", "½ ⅓x", "don't 12,345.67", "漢字" * 9, "\r\n a\r", "﻿x", "ǅ ǆ", "ß ẞ"]


def changed_model(folder, rule=None, **changes):
    """The public model with another character map: the vocabulary stays as it is."""
    model = model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    if rule:
        model.normalizer_spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
    for key, value in changes.items():
        setattr(model.normalizer_spec, key, value)
    path = str(folder / f"{rule}-{len(changes)}.model")
    with open(path, "wb") as file:
        file.write(model.SerializeToString())
    return path


@pytest.fixture(scope="module")
def models(tmp_path_factory):
    folder = tmp_path_factory.mktemp("models")
    return [MODEL, changed_model(folder, "nmt_nfkc"), changed_model(folder, "nfkc_cf", remove_extra_whitespaces=False),
            changed_model(folder, None, remove_extra_whitespaces=True), changed_model(folder, "nfkc_cf", add_dummy_prefix=False, remove_extra_whitespaces=False)]


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)


def check(coder, library, texts):
    ids, bounds, begins, ends = coder.encode(*packed(texts))
    for i, text in enumerate(texts):
        mine = slice(bounds[i], bounds[i + 1])
        want = library.encode_as_offset_mapping(text)
        place = np.append(0, np.cumsum([len(c.encode()) for c in text]))
        assert ids[mine].tolist() == want["ids"] == library.encode(text), text
        assert list(zip(begins[mine].tolist(), ends[mine].tolist())) == [(place[a], place[b]) for a, b in want["offsets"]], text
        assert coder.decode(ids[mine]) == library.decode(want["ids"])


def test_ids_and_spans_equal_the_library(models):
    rng = random.Random(7)
    mixed = ["".join(rng.choice("aé Ａ①\t\n▁ﬃ㌔́ ​bc  xyz.") for _ in range(rng.randrange(40))) for _ in range(300)]
    for path in models:
        check(pieces.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path), ODD + mixed)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=("Cs",)), max_size=30), max_size=4))
def test_any_text(models, texts):
    for path in models[:3]:
        check(pieces.pieces(path), sentencepiece.SentencePieceProcessor(model_file=path), texts)


@pytest.mark.parametrize("which", range(5))
def test_long_texts_in_stretches(models, monkeypatch, which):
    monkeypatch.setattr(pieces, "STRETCH", 60)
    monkeypatch.setattr(pieces, "DECODED_IDS", 7)
    monkeypatch.setattr(pieces, "MAX_WORDS", 20)
    rng = random.Random(9)
    words = ["ab", "cd1", "①x", "é", "  two", "▁", "\n", "ﬃ", "long" * 30, "zz "]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 80, 300]))) for _ in range(30)] + ["", "a b " * 60, ""]
    check(pieces.Pieces(models[which]), sentencepiece.SentencePieceProcessor(model_file=models[which]), texts)


def test_character_maps_of_the_library():
    for rule in ("nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"):
        normalizer = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        spec = model_pb2.NormalizerSpec()
        spec.ParseFromString(normalizer.serialized_normalizer_spec())
        mine = pieces.Normalizer(spec)
        texts = [chr(c) + " x" + chr(c) for c in range(1, 0x3400) if not 0xD800 <= c < 0xE000] + ODD
        out, bounds, _, _ = mine(*packed(texts), np.ones(len(texts), bool), np.ones(len(texts), bool))
        raw = out.tobytes()
        assert [raw[a:b].decode() for a, b in zip(bounds, bounds[1:])] == normalizer.normalize(texts)


def digests(library, text):
    want = library.encode_as_offset_mapping(text)
    place = np.append(0, np.cumsum([len(c.encode()) for c in text]))
    ids = want["ids"] + [2]
    spans = [(place[a], place[b]) for a, b in want["offsets"]] + [(place[-1], place[-1])]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)), zlib.crc32(np.array(spans, "<i8").tobytes())


def test_query_over_whole_tables(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = {r.doc_id: digests(library, r.text or "") for r in docs.collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.spans_crc32) for r in pieces.round_trips(docs, MODEL).collect()}
    assert got == want and len(got) >= 200


def test_rows_and_round_trip(spark):
    ship_package(spark)
    rows = [(1, "a  b", 5), (1, "a  b", 5), (2, None, 6), (None, "", 7), (3, "x " * 300_000, 8), (4, "w" * 50_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    tokens = pieces.encoded(docs, MODEL)
    back = sorted(((r.doc_id, r.text) for r in pieces.decoded(tokens, MODEL).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t, _ in rows), key=str)
    for r in tokens.filter("doc_id = 1").collect():
        assert list(zip(r.begins, r.ends)) == [(0, 1), (1, 2), (2, 4), (4, 4)]
    assert pieces.round_trips(docs, MODEL).count() == 6
    assert pieces.round_trips(docs.limit(0), MODEL).count() == pieces.encoded(docs.limit(0), MODEL).count() == 0
