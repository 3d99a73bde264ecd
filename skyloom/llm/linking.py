"""Links between similar texts, confirmed on their full shingle sets, and their components.

Shared by the operators that sketch shingle sets. Copies (equal word sequences) are one node, named by
their smallest doc_id. Nodes that share a band go to one candidate family without listing pairs: each is
linked to the smallest node of the band. Families are compared block by block on their full sets, and a
block returns a spanning forest of its links, never all of them.

A block holds whole families up to ``BLOCK_SHINGLES``. A larger family is cut by set size (two sets can
reach the similarity only in the same or in neighbouring size classes) and by a hash of the node, and every
two parts that can hold a link meet in one block. That is exact at every size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.bits import maybe_in
from skyloom.llm.text import blocks, find_words, list_array, sequence_hashes, shingle_sets, slices, word_hashes
from skyloom.operators.cluster import connected_components
from skyloom.session import store

SHINGLE_WORDS = 5
SIMILARITY = 75  # percent
BLOCK_SHINGLES = 1 << 19

#: sketch(values, bounds) -> one row of band hashes per text; ``values`` are the texts' shingle sets
Sketch = Callable[[np.ndarray, np.ndarray], np.ndarray]


def signed_documents(docs: DataFrame, sketch: Sketch, lower: bool = True) -> DataFrame:
    """doc_id, h1, h2 (hashes of the word sequence), n_shingles, bands (empty without words)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1)):
                words = find_words(data, offsets, lower)
                hashes, others = word_hashes(words, pair=True)
                h1, h2 = sequence_hashes(words, hashes, others)
                values, bounds = shingle_sets(words, hashes, SHINGLE_WORDS)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                bands = sketch(values, np.append(bounds[full], bounds[-1]))
                ends = np.cumsum(np.where(sizes > 0, bands.shape[1], 0))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, end - row), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                    pa.array(sizes, pa.int64()), list_array(bands.ravel().view(np.int64), np.append(0, ends), pa.int64()),
                ], names=["doc_id", "h1", "h2", "n_shingles", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, h1 long, h2 long, n_shingles long, bands array<long>")


def band_edges(nodes: DataFrame) -> DataFrame:
    """(src, dst): every node of a shared band with the band's smallest node. ``nodes``: node, bands."""
    rows = nodes.select("node", F.explode("bands").alias("band"))
    heads = rows.groupBy("band").agg(F.min("node").alias("dst"), F.max("node").alias("last")).filter("dst < last")
    edges = rows.withColumnRenamed("node", "src").join(heads.drop("last"), "band")
    return edges.filter("src <> dst").select("src", "dst").distinct()


def _keys(members: DataFrame) -> DataFrame:
    """Adds ``keys``, the blocks a node has to be in. ``members``: node, family, n_shingles."""
    ratio = 100.0 / SIMILARITY + 0.01
    sized = members.withColumn("size_class", F.floor(F.log("n_shingles") / F.log(F.lit(ratio))).cast("int"))
    parts = sized.groupBy("family", "size_class").agg(F.sum("n_shingles").alias("total"))
    parts = parts.groupBy("family").agg(
        F.sum("total").alias("family_total"),
        F.map_from_entries(F.collect_list(F.struct("size_class", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int")))).alias("cuts"),
    )
    here = F.col("cuts")[F.col("size_class")]
    above, below = F.col("cuts")[F.col("size_class") + 1], F.col("cuts")[F.col("size_class") - 1]
    own = F.pmod(F.xxhash64("node"), here).cast("int")

    def key(low, first, second):
        return F.xxhash64("family", low, first, second)

    def others(n):
        return F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    same = F.transform(others(here), lambda j: key(F.col("size_class") * 2, F.least(own, j), F.greatest(own, j)))
    up = F.transform(others(above), lambda j: key(F.col("size_class") * 2 + 1, own, j))
    down = F.transform(others(below), lambda j: key(F.col("size_class") * 2 - 1, j, own))
    whole = F.array(F.xxhash64("family"))
    keyed = sized.join(parts, "family")
    return keyed.select("node", F.when(F.col("family_total") <= BLOCK_SHINGLES, whole).otherwise(F.concat(same, up, down)).alias("keys"))


def forest_of_links(nodes: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between the sets ``values[bounds[i]:bounds[i+1]]``.

    A set can only have a link if enough of its values occur in other sets; sets without are put aside
    until no more are found, the others are counted against all that share a value with them.
    """
    sizes = np.diff(bounds)
    n = len(sizes)
    _, codes = np.unique(values, return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    while True:
        df = np.bincount(codes) if len(codes) else np.zeros(1, np.int64)
        shared = np.bincount(owner[df[codes] > 1], minlength=n)
        stays = (shared * 100 >= sizes * SIMILARITY) & (sizes > 0)
        keep = stays[owner] & (df[codes] > 1)
        if keep.all():
            break
        codes, owner = codes[keep], owner[keep]
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = np.argsort(codes, kind="stable")
    posting, code_starts = owner[order], np.searchsorted(codes[order], np.arange(len(df) + 1))
    own_starts = np.searchsorted(owner, np.arange(n + 1))
    sources, targets = [], []
    for x in np.unique(owner).tolist():
        mine = codes[own_starts[x]:own_starts[x + 1]]
        lists = [posting[code_starts[c]:code_starts[c + 1]] for c in mine.tolist()]
        seen = np.bincount(np.concatenate(lists), minlength=n)
        linked = np.flatnonzero(seen * 100 >= (sizes + sizes[x] - seen) * SIMILARITY)
        for y in linked[linked > x].tolist():
            a, b = root(x), root(y)
            if a != b:
                parent[b] = a
                sources.append(x)
                targets.append(y)
    return nodes[np.array(sources, np.int64)], nodes[np.array(targets, np.int64)]


def confirmed_links(docs: DataFrame, keyed: DataFrame, lower: bool = True) -> DataFrame:
    """(src, dst): links that hold on the full sets of the nodes in ``keyed`` (node, keys), as a forest per block."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, seen = None, set()
        for batch in batches:
            # the join leaves the rows of a node side by side: equal ones go on once
            new = np.ones(batch.num_rows, bool)
            for i, (n, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist())):
                if n != node:
                    node, seen = n, set()
                new[i] = text not in seen
                seen.add(text)
            batch = batch.filter(pa.array(new))
            for row, end, data, offsets in slices(batch.column(2)):
                words = find_words(data, offsets, lower)
                values, bounds = shingle_sets(words, word_hashes(words), SHINGLE_WORDS)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row),
                    list_array(values.view(np.int64), bounds, pa.int64()),
                ], names=["node", "keys", "shingles"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "key", lambda b: len(b.column(2).flatten()), BLOCK_SHINGLES):
            lists = table.column("shingles").chunks
            values = np.concatenate([x.flatten().to_numpy().view(np.uint64) for x in lists])
            sizes = np.concatenate([x.value_lengths().to_numpy() for x in lists])
            src, dst = forest_of_links(table.column("node").to_numpy(), values, np.concatenate([[0], np.cumsum(sizes)]))
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("_text", F.xxhash64("text")).filter(maybe_in(keyed, F.xxhash64("node"), F.xxhash64("node")))
    # the nodes grow with the documents: the same join at every size
    found = texts.join(keyed.hint("merge"), "node").select("node", "keys", "text", "_text").mapInArrow(sets, "node long, keys array<long>, shingles array<long>")
    dealt = found.select(F.explode("keys").alias("key"), "node", "shingles").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(link, "src long, dst long")


def components(docs: DataFrame, sketch: Sketch, lower: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    signed = store(signed_documents(docs, sketch, lower))
    named = signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = store(named.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n_shingles")))
    nodes = named.withColumnRenamed("doc_id", "node").join(classes.select("node"), "node", "left_semi")
    families = connected_components(store(band_edges(nodes.select("node", "bands")))).withColumnRenamed("root", "family")
    members = families.join(classes.groupBy("node").agg(F.max("n_shingles").alias("n_shingles")), "node")
    links = store(confirmed_links(docs, store(_keys(store(members))), lower).distinct())
    roots = connected_components(links).withColumnRenamed("root", "component_id")
    placed = classes.select("h1", "h2", "node").join(roots, "node", "left")
    placed = placed.select("h1", "h2", F.coalesce("component_id", "node").alias("component_id"))
    # rows that name no class stay alone
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    rest = signed.filter(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.select("doc_id", "n_shingles", "h1", "h2").join(placed, ["h1", "h2"]).select("doc_id", "n_shingles", "component_id").unionByName(rest)
