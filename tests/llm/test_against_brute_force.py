"""The corpus operators against plain Python over small tables, with hot groups planted."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyloom.llm import fingerprints, linking, mixing, near_dedup, packing, quality, sharding, substring, text, token_files, tokens, toxicity
from skyloom.session import ship_package

TINY = "/root/testdata/sf0.001"
TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    """The tiny documents with a third of copies of one text, near copies of it, and a passage in many texts."""
    ship_package(spark)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    rng = random.Random(4)
    base = [f"b{rng.randrange(900)}" for _ in range(120)]
    passage = " ".join(f"p{i}" for i in range(55))
    rows += [(1000 + i, " ".join(base), "en", "hot") for i in range(100)]
    for i in range(60):
        near = list(base)
        for _ in range(rng.randrange(1, 8)):
            near[rng.randrange(len(near))] = f"n{rng.randrange(10**6)}"
        rows.append((2000 + i, " ".join(near), "en", "hot"))
        rows.append((3000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) + " " + passage + " end", "en", "hot"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def brute_components(texts, lower=True):
    sets, parent, posting = {}, {i: i for i in texts}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in sorted(texts):
        w = WORD.findall(texts[i].translate(LOWER) if lower else texts[i])
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        seen = Counter(j for s in sets[i] for j in posting[s])
        for s in sets[i]:
            posting[s].append(i)
        for j, n in seen.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in texts}


@pytest.mark.parametrize("block", [linking.BLOCK_SHINGLES, 300])
def test_near_duplicates(docs, texts, monkeypatch, block):
    monkeypatch.setattr(linking, "BLOCK_SHINGLES", block)  # 300: families are cut into many blocks
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == brute_components(texts)


def test_near_copies_of_fingerprints(docs, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in fingerprints.near_copies(docs).collect()}
    assert got == brute_components(texts, lower=False)


def test_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 200, dtype=np.uint64)
    sets = [np.unique(rng.choice(base, rng.integers(100, 200), replace=False)) for _ in range(60)]
    bounds = np.append(0, np.cumsum([len(s) for s in sets]))
    src, dst = linking.forest_of_links(np.arange(60), np.concatenate(sets), bounds)
    links = {(a, b) for a in range(60) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}

    def parts(edges):
        label = list(range(60))
        for _ in range(60):
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert links and len(src) < 60 and parts(zip(src.tolist(), dst.tolist())) == parts(links)


@pytest.mark.parametrize("part_bytes", [substring.PART_BYTES, 2000])
def test_substring(docs, texts, monkeypatch, part_bytes):
    monkeypatch.setattr(substring, "PART_BYTES", part_bytes)  # 2000: buckets are dealt into many parts
    first, want = {}, {}
    for i in sorted(texts):
        w = WORD.findall(texts[i])
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k:k + 50]), i)
    for i, t in texts.items():
        w = WORD.findall(t)
        gone = {q for k in range(len(w) - 49) if first[tuple(w[k:k + 50])] < i for q in range(k, k + 50)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.without_repeats(docs).collect()}
    assert got == {i: v[:3] for i, v in want.items()} and sum(v[1] > 0 for v in want.values()) > 100
    cut = {r.doc_id: r.text for r in substring.cut_repeats(docs).collect()}
    assert cut == {i: v[3] if v[1] else t for (i, t), v in zip(texts.items(), want.values())}


@pytest.mark.parametrize("part_bytes", [substring.PART_BYTES, 1000])
def test_long_texts_that_repeat_a_line(spark, monkeypatch, part_bytes):
    """Texts that repeat a line keep one minimiser: their strings are cut short, equal ones travel once."""
    monkeypatch.setattr(substring, "PART_BYTES", part_bytes)
    line = " ".join(f"l{i}" for i in range(20))
    longs = {1: " ".join([line] * 60), 2: " ".join([line] * 50) + " tail of the second", 3: "head " + " ".join([line] * 40)}
    rows = {r.doc_id: (r.n_words, r.n_removed) for r in substring.without_repeats(spark.createDataFrame(list(longs.items()), "doc_id long, text string")).collect()}
    assert rows == {1: (1200, 0), 2: (1004, 1000), 3: (801, 800)}


@pytest.mark.parametrize("copies", [2, 200])
def test_repeated_rows_send_their_strings_once(spark, monkeypatch, tmp_path, copies):
    ship_package(spark)
    log, send = str(tmp_path), substring._send

    def counted(batches):
        import uuid

        n = 0
        for out in send(batches):
            n += out.num_rows
            yield out
        open(f"{log}/{uuid.uuid4().hex}-{n}", "w").close()

    monkeypatch.setattr(substring, "_send", counted)
    passage = " ".join(f"p{i}" for i in range(150))
    rows = [(1, "a b c " + passage)] * copies + [(2, passage + " tail x"), (3, "front " + passage + " y z")]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (153, 0), 2: (152, 150), 3: (153, 150)}
    sent = sum(int(f.name.split("-")[1]) for f in tmp_path.iterdir())
    assert 0 < sent < 40


def test_every_chunk_of_a_bucket_is_settled(monkeypatch):
    """Strings of more than 2 GB stay in several chunks, which a table of two chunks stands for."""
    words = " ".join(f"c{i}" for i in range(60))
    batch = lambda ids, parts: pa.RecordBatch.from_arrays(
        [*(pa.array([x] * len(ids)) for x in (7, parts)), pa.array(ids), pa.array(ids), pa.array(ids), pa.array([words] * len(ids))],
        names=["bucket", "parts", "s1", "s2", "at", "words"])
    for parts, want in ((1, [(i, 0, 11) for i in (2, 3, 4, 5)]), (2, [(i, k, 1) for i in (1, 2, 3, 4, 5) for k in range(11)])):
        table = pa.Table.from_batches([batch([1, 2], parts), batch([3, 4, 5], parts)])
        monkeypatch.setattr(substring, "blocks", lambda *a: iter([table]))
        found = [row for b in substring._settle(iter([])) for row in b.to_pylist()]
        assert [(r["at"], r["first"], r["count"]) for r in found] == want and all((r["w1"] is None) == (parts == 1) for r in found)


def test_quality_measures(docs, texts, spark):
    got = {r.doc_id: r for r in quality.quality_verdicts(docs, spark.read.parquet(f"{TINY}/labels.parquet")).collect()}
    for i, t in texts.items():
        w, seen, dup = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        twice = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        covered = {q for k in range(len(w) - 2) if twice[tuple(w[k:k + 3])] > 1 for q in (k, k + 1, k + 2)}
        base = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), base)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)


def test_binomial_bounds():
    from math import comb

    for n, p in ((30, 0.02), (200, 0.1), (50, 0.7)):
        for k in range(0, n, 7):
            exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert abs(quality.binomial_tail(k, n, p) - exact) < 1e-10
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100))
    cutoffs = (0.1, 0.2, 0.3)
    assert quality.choose_cutoff([50, 3, 0], 2000, cutoffs, 0.005, 0.05) == 0.2
    assert quality.choose_cutoff([0, 0, 0], 20, cutoffs, 0.005, 0.05) is None


def test_quality_rejects_few_good_rows(spark, docs):
    rows = [(i, " ".join(f"w{i}x{j}" + ("%%%" if i % 4 == 0 else "") for j in range(60)), "en") for i in range(6000)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(5000)], "doc_id long, quality int")
    got = quality.quality_verdicts(made, labels).groupBy("kept").count().collect()
    assert {r.kept: r["count"] for r in got} == {True: 4500, False: 1500}


def test_fingerprints(docs, texts):
    ids = sorted(texts)
    rows = {r.doc_id: r for r in fingerprints.fingerprints_and_edits(docs).collect()}
    for i, after in zip(ids, ids[1:] + ids[:1]):
        t, q = texts[i], len(texts[i]) // 4
        edited = t[:len(t) - q] + texts[after][:q]
        assert (rows[i].n_chars, rows[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        same = [a == b for a, b in zip(re.findall("....", rows[i].fingerprint), re.findall("....", rows[after].fingerprint))]
        assert rows[i].near_next == pytest.approx(sum(same) / len(same))
        assert (texts[i] == texts[after]) <= (rows[i].near_next == 1)
    assert len({rows[i].fingerprint for i in range(1000, 1100)}) == 1
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert plain == {i: r.fingerprint for i, r in rows.items()}
    assert np.mean([r.near_edited for r in rows.values()]) > 0.4


def test_likeness_estimates_jaccard():
    rng = np.random.default_rng(8)
    a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:700], rng.integers(0, 1 << 63, 300, dtype=np.uint64)])
    slots = fingerprints.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]))
    assert abs((slots[0] == slots[1]).mean() - 700 / 1300) < 0.15


def ids_of(texts):
    tokenizer = tokens.Encoder(TOKENIZER).tokenizer
    keys = sorted(texts)
    return {i: np.array([*e.ids, 2], "<u4") for i, e in zip(keys, tokenizer.encode_batch([texts[i] for i in keys], add_special_tokens=False))}


def test_token_files(docs, texts):
    want, start = {}, 0
    for i, ids in ids_of(texts).items():
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_file_round_trip(docs, TOKENIZER).collect()}
    assert got == want


def test_packing(docs, texts):
    all_ids = ids_of(texts)
    placed = packing.packed(docs, TOKENIZER, with_ids=True).cache()
    rows = placed.collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(all_ids[r.doc_id][r.start:r.start + r.length].tobytes())
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and sum(r.length for r in pieces) == len(all_ids[i])
        assert all(r.length == 1024 for r in pieces[1:])
    for items in by_sequence.values():
        items.sort(key=lambda r: r.offset)
        assert [r.offset for r in items] == np.cumsum([0, *[r.length for r in items]])[:-1].tolist()
        assert sum(r.length for r in items) <= 1024 and sum(3 * r.length > 1024 for r in items) <= 2
    assert len(by_sequence) <= 1.02 * sum(map(len, all_ids.values())) / 1024 + 1
    whole = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    assert all(whole[k] == [x for r in items for x in r.ids] for k, items in by_sequence.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=30))
def test_packing_plans(counts):
    runs = sorted(packing.plan_packing(counts, 60))
    sequences = defaultdict(list)
    for k, (length, start, first, per, offset) in enumerate(runs):
        end = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == length else counts[length]
        for r in range(end - start):
            sequences[first + r // per].append((offset + r % per * length, length))
    assert sum(map(len, sequences.values())) == sum(counts.values())
    for items in sequences.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 60


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, (1 << 64) - 1)), max_size=3000))
def test_simple8b_round_trip(values):
    ids = np.array(values, np.uint64)
    words, block_at = token_files.pack_words(ids)
    assert (token_files.unpack_words(words, block_at, len(ids)) == ids).all()
    doc_ids = pa.array([None, 5], pa.int64())
    got = token_files.read_file(token_files.file_bytes(ids, doc_ids, np.array([len(ids), 0])))
    assert (got[0] == ids).all() and got[1].to_pylist() == [None, 5] and got[2].tolist() == [len(ids), 0]


def test_simple8b_is_compact():
    ids = np.random.default_rng(1).integers(0, 30_000, 50_000)
    assert len(token_files.pack_words(ids)[0]) * 8 < 2.1 * len(ids)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab's'tréé 1½٣\n\t  !?中😀vlemd' ", max_size=40), min_size=1, max_size=20))
def test_tokenizer_equals_the_library(values):
    enc = tokens.encoder(TOKENIZER)
    got = []
    for _, _, data, offsets in text.slices(pa.array(values)):
        ids, bounds = enc.encode(data, offsets)
        got += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [e.ids for e in enc.tokenizer.encode_batch(values, add_special_tokens=False)]


def test_long_texts_are_worked_in_stretches(monkeypatch):
    monkeypatch.setattr(tokens, "STRETCH", 50)
    enc = tokens.encoder(TOKENIZER)
    values = ["it's a  long \n\n text we'll   cut, " * 9, "", "x" * 400, "short one"]
    data = "".join(values).encode()
    ids, bounds = enc.encode(np.frombuffer(data, np.uint8), np.append(0, np.cumsum([len(v.encode()) for v in values])))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [e.ids for e in enc.tokenizer.encode_batch(values, add_special_tokens=False)]


def test_sharding(docs, texts):
    rows = {r.doc_id: r for r in sharding.shard_table(docs).collect()}
    permutation = sharding.Permutation(len(texts))
    for row, i in enumerate(sorted(texts)):
        raw = texts[i].encode()
        place = int(permutation.place_of(np.array([row]))[0])
        assert (rows[i].size, rows[i].text_crc32, rows[i].shard, rows[i].slot) == (len(raw) + 8, zlib.crc32(raw), place % 24, place // 24)
        assert permutation.row_at(np.array([place]))[0] == row
    sizes = Counter(r.shard for r in rows.values())
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_shards_as_files(docs, texts, tmp_path, spark):
    sharding.write_shards(docs, f"{tmp_path}/shards", 5)
    back = spark.read.parquet(f"{tmp_path}/shards").collect()
    assert {r.doc_id: r.text for r in back} == texts and {r.shard for r in back} == set(range(5))


def test_mixing(docs, texts):
    rows = mixing.mixed(docs).collect()
    again = mixing.mixed(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    size = {i: len(WORD.findall(t)) for i, t in texts.items()}
    source = {r.doc_id: r.source for r in docs.collect()}
    total = Counter()
    for i, s in source.items():
        total[s] += size[i]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(total))}
    left, open_, target = 1.5 * sum(total.values()), set(total), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * total[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * total[s] for s in full}
        left -= sum(2 * total[s] for s in full)
        open_ -= full
    for r in rows:
        assert (r.size, r.source_size) == (size[r.doc_id], total[source[r.doc_id]])
        assert r.target == pytest.approx(target[source[r.doc_id]]) and r.taken == r.size * r.copies <= 2 * r.size
    assert mixing.mix(docs).count() == sum(r.copies for r in rows)


def test_toxicity_on_held_out_rows(spark, docs):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    ranks = held.score.rank()
    n1, n0 = held.toxic.sum(), (1 - held.toxic).sum()
    auc = (ranks[held.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    hit = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert (held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3) == 1).all()
    assert auc > 0.9 and hit / held.predicted.sum() > 0.9 and hit / n1 > 0.6


def test_training_is_sparse_and_separates():
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(400):
        at = rng.integers(0, 5000, 50)
        rows.append(np.unique(np.append(at, [9999] if i % 4 == 0 else [])).astype(np.int32))
        labels.append(int(i % 4 == 0))
    weights, _ = toxicity.fit(rows, np.array(labels))
    assert weights[9999] > 1 and (weights != 0).sum() < 2000


def test_training_equals_plain_ftrl():
    """The vectorised fit against FTRL-proximal written out coordinate by coordinate."""
    rng = np.random.default_rng(11)
    rows = [np.unique(rng.integers(0, 60, rng.integers(1, 25))) for _ in range(120)]
    labels = np.array([int((r % 7 == 0).sum() > 1) for r in rows])
    l1 = 0.02 * np.sqrt(len(rows))
    z, n = Counter(), Counter()

    def weight(c, term):
        if abs(z[c]) <= term:
            return 0.0
        return -np.sign(z[c]) * (abs(z[c]) - term) / ((toxicity.BETA + np.sqrt(n[c])) / toxicity.ALPHA + toxicity.L2)

    for epoch in range(3):
        for i in np.random.Generator(np.random.PCG64(epoch)).permutation(len(rows)).tolist():
            active = [*rows[i].tolist(), "bias"]
            w = {c: weight(c, 0.0 if c == "bias" else l1) for c in active}
            g = 1 / (1 + np.exp(-sum(w.values()))) - labels[i]
            for c in active:
                z[c] += g - (np.sqrt(n[c] + g * g) - np.sqrt(n[c])) / toxicity.ALPHA * w[c]
                n[c] += g * g
    weights, bias = toxicity.fit(rows, labels, 3, 0.02)
    want = np.array([weight(c, l1) for c in range(60)])
    assert np.allclose(weights[:60], want, atol=1e-9) and not weights[60:].any() and np.isclose(bias, weight("bias", 0.0)) and (want == 0).any()


def test_training_holds_a_bounded_sample(spark, monkeypatch):
    """A labelled id with very many rows is one training text; scores agree whatever copies there are."""
    rows = [(i, f"bad awful text {i}" if i % 2 else f"kind gentle text {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    one = spark.createDataFrame(rows, "doc_id long, text string")
    many = one.unionByName(spark.createDataFrame([rows[2]] * 500, "doc_id long, text string"))
    a = toxicity.learn(one, labels)
    b = toxicity.learn(many, labels)
    assert (a[0] == b[0]).all() and np.allclose(a[1], b[1]) and a[2] == b[2]
