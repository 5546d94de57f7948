"""Benchmark decontamination: broadcast set of normalised benchmark n-grams, scanned over document windows."""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.store import forget, map_arrow, stored, utf8

#: Bytes that are no part of a word become spaces, A-Z become a-z.
_SEPARATORS = bytes(i for i in range(128) if not (48 <= i <= 57 or 65 <= i <= 90 or 97 <= i <= 122))
NORMAL = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))

#: Words of benchmark items that are broadcast at a time; more items are scanned for in further blocks.
BLOCK_WORDS = 1_000_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class WindowIndex:
    """The windows of one block of benchmark items: word ids, window keys, and the items of each window."""

    def __init__(self, items: list[tuple[int, bytes]], n: int):
        self.ids: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, list[int]]] = {}
        for item, text in items:
            ids = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)], np.int32)
            size = min(n, len(ids))
            if size:
                found = self.windows.setdefault(size, {})
                for key in {ids[i:i + size].tobytes() for i in range(len(ids) - size + 1)}:
                    found.setdefault(key, []).append(item)
        # one 64-bit key for each window, to rule out nearly all places in one vectorised lookup
        self.keys = {size: np.unique(self.mixed(np.stack([np.frombuffer(k, np.int32) for k in found]).T))
                     for size, found in self.windows.items()}

    @staticmethod
    def mixed(columns) -> np.ndarray:
        h = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """(start, end) of every occurring window, and the items they belong to; each place is verified word by word."""
        get = self.ids.get
        ids = np.fromiter([get(w, 0) for w in words], np.int32, len(words))
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        spans, items = [], set()
        for size, found in self.windows.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(at):
                continue
            keys, known = self.mixed([ids[at + k] for k in range(size)]), self.keys[size]
            at = at[known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys]
            for i in at.tolist():
                owners = found.get(ids[i:i + size].tobytes())
                if owners:
                    spans.append((i, i + size))
                    items.update(owners)
        return spans, items


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The items, block by block; a block is a few million words at most, whatever the benchmark's size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    # every word has a character and a separator, so half the bytes bounds the words
    total = items.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [(r["item_id"], r["text"].encode()) for r in part.toLocalIterator()]


def _scan(docs: DataFrame, items: list[tuple[int, bytes]], n: int, last: bool = True) -> DataFrame:
    """One block's pass over ``docs``: (doc_id, text) and, from earlier passes, what was found; the last one drops the text."""
    index = docs.sparkSession.sparkContext.broadcast(WindowIndex(items, n))
    noted = "spans" in docs.columns

    def run(batch: pa.RecordBatch):
        n_words, spans, found = [], [], []
        look = index.value.hits
        texts = utf8(batch.column(1))
        known = zip(*(batch.column(k).to_pylist() for k in (3, 4))) if noted else (((), ()) for _ in texts)
        for text, (before, owners) in zip(texts, known):
            words = words_of(text)
            at, items = look(words)
            n_words.append(len(words))
            spans.append([x for s in merged([*zip(before[::2], before[1::2]), *at]) for x in s])
            found.append(sorted(items.union(owners), key=lambda item: (item is None, item)))
        return batch.column(0), *(() if last else (batch.column(1),)), n_words, spans, found

    rows = docs if noted else docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(rows, run, f"doc_id long, {'' if last else 'text string, '}n_words long, spans array<long>, items array<long>")


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, spans, items): word spans [start, end, start, end, …) hit by benchmark windows, merged.

    A window is ``n`` consecutive words of an item; an item of fewer words, but not none, is one
    window. Null texts have no words. Rows that repeat give repeated rows, with or without doc_id.
    Windows of items without item_id hit like any; nothing names these items, so they are one null at the end of ``items``. Beyond ``block_words`` the benchmark is scanned
    for block by block (several passes, which note what was found beside the row), so that what is broadcast stays bounded.
    """
    blocks = benchmark_blocks(benchmark, block_words)
    rows, items = docs, next(blocks)
    for following in blocks:
        # one pass at a time, so that one block is held at a time
        done, rows = rows, stored(_scan(rows, items, n, last=False), "scan")
        if done is not docs:
            forget(docs.sparkSession, done)
        items = following
    return _scan(rows, items, n)


def hit_words(spans) -> F.Column:
    ends = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("sign")),
                       lambda a, x: F.struct((a["n"] + a["sign"] * x).alias("n"), (-a["sign"]).alias("sign")))
    return ends["n"]


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, how: str = "documents", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (all columns) without contaminated documents (``how="documents"``) or with the hit words cut out of
    their text (``how="spans"``: every word of a hit span and what stands between those words goes).

    Texts without a hit are returned unchanged, null texts included. A benchmark of one block takes one
    pass without a shuffle; further blocks take a stored pass each, which notes the spans beside the row.
    """
    blocks = benchmark_blocks(benchmark, block_words)
    items, after = next(blocks), next(blocks, None)
    if after is None:
        return _pass(docs, items, n, how)
    note = next(c for c in (f"_spans{k}" for k in range(len(docs.columns) + 1)) if c not in docs.columns)
    rows = docs.withColumn(note, F.array().cast("array<long>"))
    for items in chain([items, after], blocks):
        rows = stored(_pass(rows, items, n, "note", note), "noted")
    return _pass(rows, [], n, how, note).drop(note)


def _pass(docs: DataFrame, items: list[tuple[int, bytes]], n: int, how: str, note: str | None = None) -> DataFrame:
    """One pass: look for one block's windows, then drop the row, cut its text, or note the spans in column ``note``."""
    index = docs.sparkSession.sparkContext.broadcast(WindowIndex(items, n))
    at = docs.columns.index("text")
    noted = docs.columns.index(note) if note else None

    def each(batches):
        for batch in batches:
            column = batch.column(at)
            known = batch.column(noted).to_pylist() if note else [[]] * batch.num_rows
            spans = [merged([*zip(k[::2], k[1::2]), *index.value.hits(words_of(t))[0]]) for k, t in zip(known, utf8(column))]
            cols = list(batch.columns)
            if how == "note":
                cols[noted] = pa.array([[x for s in found for x in s] for found in spans], batch.schema.field(noted).type)
            elif how == "spans":
                cols[at] = pa.array([_without(t.encode(), found) if found else t for t, found in zip(column.to_pylist(), spans)],
                                    batch.schema.field(at).type)
            out = pa.RecordBatch.from_arrays(cols, schema=batch.schema)
            yield out.filter(pa.array([not found for found in spans], pa.bool_())) if how == "documents" else out

    return docs.mapInArrow(each, docs.schema)


def _without(raw: bytes, spans) -> str:
    normal = raw.translate(NORMAL)
    ends, at = [], 0
    for w in normal.split():
        at = normal.index(w, at)
        ends.append((at, at + len(w)))
        at += len(w)
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:ends[a][0]])
        last = ends[b - 1][1]
    return (b"".join(out) + raw[last:]).decode()


def digests(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row: what ``scan`` finds, in figures.

    Documents without words or without hits have zeros and the digest of the empty string; an empty benchmark hits nothing.
    Items without item_id count as one item, without a name in the digest.
    """
    found = scan(docs, benchmark, n)
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    hit = hit_words(F.col("spans"))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
