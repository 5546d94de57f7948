"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches of ascending doc_id. A run is a Parquet table, sorted by line hash, of
the keys that a batch brought and their owner, the least doc_id that holds them. Each batch is
merge-joined with the runs: keys found there belong to an earlier document, the others become the
batch's own run. ``fanout`` runs of a level are compacted to one run of the next level.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestay.llm.store import forget, map_arrow, stored, utf8


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line (white space stripped, A-Z lower-cased), or None if it is under ``min_chars`` code points."""
    key = line.strip().lower()  # on bytes: 0x20 and 0x09-0x0D, and A-Z only
    size = len(key)
    if size < min_chars or size < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return key


def line_hashes(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(h1, h2, doc_id): the 128-bit hash of each distinct line key of each row; rows without doc_id have none."""

    def run(batch: pa.RecordBatch):
        digests, owners = [], []
        for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            keys = {line_key(x, min_chars) for x in text.split(b"\n")}
            keys.discard(None)
            digests.extend(map(xxhash.xxh3_128_digest, keys))
            owners.extend([doc] * len(keys))
        h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return pa.array(h[:, 0]), pa.array(h[:, 1]), owners

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return map_arrow(rows, run, "h1 long, h2 long, doc_id long")


class SortedRuns:
    """Levels of sorted runs (h1, h2, owner) with disjoint keys."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def all(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        if not runs:
            return None
        out = runs[0]
        for r in runs[1:]:
            out = out.unionByName(r)
        return out

    def compact(self) -> None:
        """Merge the runs of each level that holds ``fanout`` of them into one run of the next level."""
        for level in range(len(self.levels)):
            old = self.levels[level]
            if len(old) >= self.fanout:
                merged = old[0]
                for r in old[1:]:
                    merged = merged.unionByName(r)
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(
                    stored(merged.repartition("h1", "h2").sortWithinPartitions("h1", "h2"), f"run{level + 1}"))
                self.levels[level] = []
                forget(self.spark, *old)

    def absorb(self, hashes: DataFrame) -> DataFrame:
        """Take in a batch; return (h1, h2, owner) of its keys that more than one document holds so far."""
        self.compact()
        mine = hashes.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        seen = self.all()
        if seen is None:
            joined = mine.withColumn("owner", F.lit(None).cast("long"))
        else:
            # both sides are hash-partitioned and merged in key order
            joined = mine.join(seen.hint("merge"), ["h1", "h2"], "left")
        found = stored(joined.select("h1", "h2", F.coalesce("owner", "least").alias("owner"), F.col("owner").isNull().alias("fresh"),
                                     (F.col("most") > F.coalesce("owner", "least")).alias("repeated"))
                       .sortWithinPartitions("h1", "h2"), "run0")
        self.levels[0].append(found.where("fresh").select("h1", "h2", "owner"))
        return stored(found.where("repeated").select("h1", "h2", "owner"), "repeated")


def doc_id_batches(hashes: DataFrame, batches: int) -> list:
    """Conditions that cut the rows into batches of about equal size by ascending doc_id."""
    cuts = hashes.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] if batches > 1 else None
    cuts = sorted(set(cuts or []))
    doc = F.col("doc_id")
    return [(F.lit(True) if a is None else doc > a) & (F.lit(True) if b is None else doc <= b)
            for a, b in zip([None, *cuts], [*cuts, None])]


def repeated_lines(docs: DataFrame, min_chars: int = 10, batches: int = 3, fanout: int = 2) -> DataFrame:
    """(doc_id, lost): the (h1, h2) hashes of the line keys that each document must lose. Documents without loss have no row."""
    hashes = stored(line_hashes(docs, min_chars), "lines")
    runs = SortedRuns(docs.sparkSession, fanout)
    repeated = None
    for part in doc_id_batches(hashes, batches):
        rep = runs.absorb(hashes.where(part))
        repeated = rep if repeated is None else repeated.unionByName(rep)
    # a key found again in a later batch has the same owner there
    lost = hashes.join(repeated.distinct(), ["h1", "h2"]).where("doc_id <> owner")
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("lost"))


def _split(text: bytes, lost: set[bytes], min_chars: int) -> tuple[list[bytes], list[bytes]]:
    lines = text.split(b"\n")
    if not lost:
        return lines, lines
    kept = [x for x in lines if (k := line_key(x, min_chars)) is None or xxhash.xxh3_128_digest(k) not in lost]
    return lines, kept


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 3, fanout: int = 2) -> DataFrame:
    """All columns of ``docs`` as ``row``, its ``text``, and ``lost``, the hashes of the line keys that it must lose.

    A line whose key has at least ``min_chars`` code points and is found in at least two documents
    stays only in the document of the least doc_id that holds it (all its lines there). Null or
    empty text: one empty line. Rows that repeat a doc_id count as one document. Rows without
    doc_id are neither owners nor losers. A document that loses all lines keeps the empty text.
    """
    lost = repeated_lines(docs, min_chars, batches, fanout)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("_doc"), F.col("text").alias("_text"))
    # the build side is a partition's share of the lost keys, so the text rows need no sort
    joined = rows.join(lost.hint("shuffle_hash"), rows["_doc"] == lost["doc_id"], "left")
    return joined.select("row", F.col("_text").alias("text"), "lost")


def kept_digests(docs: DataFrame, min_chars: int = 10, batches: int = 3, fanout: int = 2) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of each row after deduplication."""
    slim = docs.select("doc_id", "text")
    found = dedup_lines(slim, min_chars, batches, fanout).select(F.col("row.doc_id").cast("long").alias("doc_id"), "text", "lost")

    def run(batch: pa.RecordBatch):
        n, gone, digests = [], [], []
        for text, lost in zip(utf8(batch.column(1)), lost_sets(batch.column(2))):
            lines, kept = _split(text, lost, min_chars)
            n.append(len(lines))
            gone.append(len(lines) - len(kept))
            digests.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
        return batch.column(0), n, gone, digests

    return map_arrow(found, run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def lost_sets(column: pa.Array) -> list[set[bytes]]:
    """The 16-byte hashes of each row's (h1, h2) pairs."""
    out = []
    for pairs in column:
        values = pairs.values if pairs.is_valid else None
        if values is None or not len(values):
            out.append(set())
            continue
        h = np.stack([values.field("h1").to_numpy(), values.field("h2").to_numpy()], axis=1)
        raw = np.ascontiguousarray(h, np.int64).tobytes()
        out.append({raw[i:i + 16] for i in range(0, len(raw), 16)})
    return out


def without_repeated_lines(docs: DataFrame, min_chars: int = 10, batches: int = 3, fanout: int = 2) -> DataFrame:
    """``docs`` (all columns) with the text of each row after deduplication; null texts stay null."""
    found = dedup_lines(docs, min_chars, batches, fanout)
    at = docs.columns.index("text")

    def each(batches_):
        for batch in batches_:
            row = batch.column(0)
            cols = row.flatten()
            texts = [None if not ok else b"\n".join(_split(t, lost, min_chars)[1]).decode()
                     for ok, t, lost in zip(batch.column(1).is_valid().to_pylist(), utf8(batch.column(1)), lost_sets(batch.column(2)))]
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=[row.type.field(i).name for i in range(row.type.num_fields)])

    return found.select("row", "text", "lost").mapInArrow(each, docs.schema)
