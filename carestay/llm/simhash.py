"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint bits are majorities over the XXH64 values of a document's word shingles. Two
fingerprints link when they differ in at most ``radius`` bits. A family of ``2^(radius+1) - 1``
structured bit masks covers every pair within the radius: bit ``i`` gets a vector ``m(i)`` of
``radius + 1`` bits, mask ``v`` keeps the bits with ``<m(i), v> = 1``. At most ``radius`` differing
bits give at most ``radius`` linear conditions, so some ``v <> 0`` keeps none of them, and the
pair agrees on that whole mask: it collides in that table, with certainty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.components import connected_components
from carestay.llm.store import map_arrow, stored, utf8

ALL_BITS = (1 << 64) - 1
#: Distinct fingerprints compared with one another in one bucket; larger buckets are split by further masks.
BUCKET_LIMIT = 2048


def simhash_bytes(text: bytes, shingle_words: int = 4, seed: int = 42) -> bytes:
    """The 64-bit fingerprint, big-endian, of one UTF-8 text. No words: eight zero bytes."""
    words = text.lower().split()  # on bytes: A-Z only, and white space is 0x20 and 0x09-0x0D
    n = len(words)
    if not n:
        return b"\0" * 8
    joined = b" ".join(words)
    if n <= shingle_words:
        return xxhash.xxh64_digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest, k = xxhash.xxh64_digest, shingle_words - 1
    hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[:n - k].tolist(), ends[k:].tolist())])
    total = np.zeros(64, np.int64)
    shingles = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for at in range(0, len(shingles), 65536):
        total += np.unpackbits(shingles[at:at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(total * 2 > len(shingles)).tobytes()


def fingerprints(docs: DataFrame, shingle_words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row's whole text as a signed long. Null text counts as empty."""

    def run(batch: pa.RecordBatch):
        fps = b"".join(simhash_bytes(t, shingle_words, seed) for t in utf8(batch.column(1)))
        return batch.column(0), pa.array(np.frombuffer(fps, ">i8").astype(np.int64))

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text")), run, "doc_id long, fp long")


def covering_masks(radius: int, within: int = ALL_BITS) -> list[int]:
    """Masks (subsets of ``within``) such that any ``radius`` bits of ``within`` are avoided by at least one mask.

    No mask is empty if ``within`` has more than ``radius`` bits.
    """
    count = (1 << (radius + 1)) - 1
    bits = [i for i in range(64) if within >> i & 1]
    vectors = list(range(1, count + 1))
    if len(bits) < 1 << radius:
        # too few bits to reach the last unit vector in turn: unit vectors first, so that no v <> 0 is orthogonal to all
        vectors.sort(key=lambda x: x.bit_count() > 1)
    vector = {b: vectors[i % count] for i, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() & 1) for v in range(1, count + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@lru_cache(maxsize=4096)
def _finer(mask: int, radius: int) -> tuple[int, ...]:
    """Masks that split a bucket of ``mask`` further: they keep all its bits, some more, and cover the rest anew."""
    rest = ALL_BITS & ~(mask & ALL_BITS)
    masks = set(covering_masks(radius, rest))
    # who agrees on a mask agrees on its subsets
    return tuple(sorted(_signed((mask & ALL_BITS) | m) for m in masks if not any(o != m and o & m == o for o in masks)))


def _spanning(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(root, member) for each member of a component of more than one fingerprint, by breadth-first search."""
    out, left = [], values
    while len(left) > 1:
        root, left = left[0], left[1:]
        todo = [root]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= radius
            if near.any():
                found, left = left[near], left[~near]
                todo.extend(found)
                out.extend((int(root), int(x)) for x in found)
    return out


def link_buckets(rows: Iterator[pa.RecordBatch], radius: int, limit: int = BUCKET_LIMIT) -> Iterator[pa.RecordBatch]:
    """Stream rows sorted by (mask, bits, fp); give a spanning forest of links for each bucket.

    A bucket of more than ``limit`` distinct fingerprints is not held: its members come out again,
    once for each finer mask, as rows with ``mask`` set, to be dealt out anew. A mask that leaves at most
    ``radius`` bits free is not split: its bucket has ``2**radius`` fingerprints at most.
    """
    held: list[int] = []
    now: tuple | None = None
    flooded = False
    edges: list[tuple] = []

    def close():
        if len(held) > 1 and not flooded:
            edges.extend((a, b, None, None) for a, b in _spanning(np.array(held, np.int64).view(np.uint64), radius))
        held.clear()

    def spill(fp: int, mask: int):
        edges.extend((None, fp, m, fp & m) for m in _finer(mask, radius))

    def flush():
        cols = list(zip(*edges)) if edges else [[], [], [], []]
        edges.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([None if x is None else _signed(x & ALL_BITS) for x in c], pa.int64()) for c in cols], names=["u", "v", "mask", "bits"])

    for batch in rows:
        mask, bits, fp = (batch.column(i).to_numpy() for i in range(3))
        if not len(fp):
            continue
        # only rows that share (mask, bits) with a neighbour, or touch the batch's ends, need a look one by one
        same = (mask[1:] == mask[:-1]) & (bits[1:] == bits[:-1])
        busy = np.concatenate(([True], same)) | np.concatenate((same, [True]))
        at = np.flatnonzero(busy)
        for m, b, f in zip(mask[at].tolist(), bits[at].tolist(), fp[at].tolist()):
            if (m, b) != now:
                close()
                now, flooded = (m, b), False
            elif held and held[-1] == f:
                continue
            if flooded:
                spill(f, m)
            else:
                held.append(f)
                if len(held) > limit and 64 - (m & ALL_BITS).bit_count() > radius:
                    flooded = True
                    for x in held:
                        spill(x, m)
                    held.clear()
            if len(edges) > 50_000:
                yield flush()
    close()
    if edges:
        yield flush()


def fingerprint_links(fps: DataFrame, radius: int = 4, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(u, v) links between distinct fingerprints with the same connected components as the graph of all
    pairs within ``radius`` bits; repeats are possible. ``fps`` has a column ``fp`` of distinct values.
    """
    masks = [_signed(m) for m in covering_masks(radius)]
    keyed = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")).select(
        "mask", F.col("mask").bitwiseAND(F.col("fp")).alias("bits"), "fp")
    links = None
    while True:
        dealt = keyed.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp")
        out = stored(dealt.mapInArrow(lambda it: link_buckets(it, radius, limit), "u long, v long, mask long, bits long"), "links")
        found = out.where("mask is null").select("u", "v")
        links = found if links is None else links.unionByName(found)
        again = out.where("mask is not null").select("mask", "bits", F.col("v").alias("fp"))
        if again.isEmpty():
            return links
        keyed = again


def near_duplicate_groups(docs: DataFrame, shingle_words: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id): the least doc_id reachable over links of at most ``radius`` differing bits.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows give repeated
    rows of the same component. A row without doc_id takes part in linking, and its component_id is
    null only if no member has a doc_id. An empty table gives an empty result. Other columns are ignored.
    """
    fps = stored(fingerprints(docs, shingle_words, seed), "fps")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(fingerprint_links(nodes.select("fp"), radius))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` (all columns) with one document, that of the least doc_id, of each near-duplicate group.

    Of rows that repeat a doc_id the one of least text stays (of equal texts, that of least row hash). Rows without doc_id
    stay: nothing names them in a decision.
    """
    groups = stored(near_duplicate_groups(docs, shingle_words, radius), "groups")
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    # the build side is a partition's share of ids, so the text rows need no sort
    kept = docs.join(gone.hint("shuffle_hash"), docs["doc_id"] == gone["_gone"], "left_anti")
    if groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = F.min_by(row, F.struct(F.coalesce("text", F.lit("")), F.xxhash64(row)))
    named = kept.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(first.alias("_row"))
    return named.select("_row.*").unionByName(kept.where("doc_id is null"))
