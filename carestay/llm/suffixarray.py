"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

Texts are UTF-8 bytes; a window is ``length`` consecutive bytes. A window's anchor is the place in it of
the ``anchor_bytes``-byte string of least hash (ties: the first), so equal windows have equal
anchors at equal offsets, wherever they stand. Consecutive windows with one anchor form a
neighbourhood. The suffix array of a batch is sparse: it holds the suffixes that begin at anchors, about one for
seventeen bytes, in lexicographic order of their first eight bytes, then by the hash of the
anchor string and the digest of the neighbourhood, each distinct one once with its owner, the least
doc_id that holds it, and short hashes of the bytes on both sides of the anchor.

New batches, of ascending doc_id, get their suffix arrays and are merge-scanned against the arrays
of all levels: neighbourhoods found there belong to an earlier document. Two arrays of one level
are merged into one of the next, so there are logarithmically many. What the scan settles:

* every window of a neighbourhood whose owner is an earlier document is repeated;
* a window can stand in two different neighbourhoods only if these have the same anchor string and
  agree on one side of it (see ``_may_share``). The share of neighbourhoods whose anchor string stands in
  another one grows with the corpus, up to all of them; by the hashes of the sides most of these
  are left out before any text is moved. The others are compared window by window, byte for byte.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestay.llm.linededup import doc_id_batches
from carestay.llm.sorted_runs import Run, merge_settings, write_run
from carestay.llm.store import forget, map_arrow, stored

#: Bytes of text taken up at once, so that arrays stay in a core's cache; a longer text is cut between windows, which
#: only changes neighbourhoods, not results.
CHUNK = 1 << 16
#: Neighbourhoods of one anchor string that a task compares in memory; larger groups are dealt out window by window.
GROUP_LIMIT = 4096
KEYS = ("s1", "h", "g")
#: Rows that lie in the order of their keys are aggregated in that order, which joins and runs then go on with.
SORTED_SUMS = {"spark.sql.execution.replaceHashWithSortAgg": "true"}
_POSITION = np.uint64((1 << 24) - 1)


def _raw(texts: pa.Array) -> tuple[np.ndarray, memoryview]:
    """(offsets, bytes) of a column of texts or bytes; null counts as empty."""
    column = texts.cast(pa.binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return offsets, memoryview(data) if data is not None else memoryview(b"")


def _short(h: np.ndarray) -> np.ndarray:
    """16 bits of each hash, never 0."""
    return np.maximum(h & np.uint64(0xFFFF), np.uint64(1))


class Neighbourhoods:
    """The neighbourhoods of a batch of texts: row, first and last window start, s1, h, g, anchor (arrays).

    The upper half of h is from the anchor string; the lower has 16 bits from the bytes before it and 16 from those
    after it, each 0 where the neighbourhood has too few there for a window to have most of its bytes on that side.
    """

    def __init__(self, texts: pa.Array, length: int, anchor_bytes: int):
        self.offsets, self.raw = _raw(texts)
        parts = [self._piece(a, b, length, anchor_bytes) for a, b in self._chunks(length)]
        self.row, self.low, self.high, self.s1, self.h, self.g, self.anchor = (
            np.concatenate(column) for column in zip(*parts)) if parts else (np.empty(0, np.int64),) * 7

    def _chunks(self, length: int) -> Iterator[tuple[int, int]]:
        """Ranges of window starts of bounded size; short texts are taken up together."""
        start = None
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            if b - a < length:
                continue
            if start is not None and b - start > CHUNK:
                yield start, last
                start = None
            if b - a > CHUNK:
                for s in range(a, b - length + 1, CHUNK):
                    yield s, min(s + CHUNK, b - length + 1)
                continue
            start, last = a if start is None else start, b - length + 1
        if start is not None:
            yield start, last

    def _piece(self, start: int, stop: int, length: int, anchor_bytes: int):
        buf = self.raw[start:stop + length - 1]
        n = len(buf)
        heads = np.ndarray((n - 7,), ">u8", buffer=buf, strides=(1,)).astype(np.uint64)
        m = n - anchor_bytes + 1
        h = np.zeros(m, np.uint64)
        for at in [*range(0, anchor_bytes - 8, 8), anchor_bytes - 8]:
            h ^= heads[at:at + m]
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        # the place in the low bits makes the least value's first place come out of a plain minimum
        least = (h & ~_POSITION) | np.arange(m, dtype=np.uint64)
        width, span = length - anchor_bytes + 1, 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:span - width], least[width - span:])
        anchor = (least & _POSITION).astype(np.int64)
        first = np.searchsorted(self.offsets, start, "right") - 1
        last = np.searchsorted(self.offsets, stop, "left")
        # starts whose window ends within the same text
        room = np.zeros(stop - start + 1, np.int32)
        a = np.maximum(self.offsets[first:last] - start, 0)
        b = np.minimum(self.offsets[first + 1:last + 1] - start - length + 1, stop - start)
        real = b > a
        np.add.at(room, a[real], 1)
        np.add.at(room, b[real], -1)
        at = np.flatnonzero(np.cumsum(room[:-1]) > 0)
        anchor = anchor[at]
        cut = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(anchor) != 0)))
        begin = np.flatnonzero(cut)
        low, high = at[begin], at[np.append(begin[1:], len(at)) - 1]
        place = anchor[begin]
        # the digest mixes the hashes of the strings at 0, k, 2k, ... and at the end, which cover the neighbourhood
        end = high + (length - anchor_bytes)
        g = (place - low).astype(np.uint64) | (high - low).astype(np.uint64) << np.uint64(32)
        for at in range(0, 2 * length - anchor_bytes, anchor_bytes):
            g ^= h[np.minimum(low + at, end)]
            g *= np.uint64(0xD6E8FEB86659FD93)
            g ^= g >> np.uint64(32)
        g *= np.uint64(0x94D049BB133111EB)
        g ^= g >> np.uint64(31)
        reach = (length - anchor_bytes + 1) // 2
        step = min(reach, anchor_bytes)
        before = np.where(place - low >= reach, _short(h[np.maximum(place - step, 0)]), 0)
        after = np.where(high + length - place - anchor_bytes >= reach, _short(h[np.minimum(place + step, m - 1)]), 0)
        key = h[place] << np.uint64(32) | before << np.uint64(16) | after
        row = np.searchsorted(self.offsets, low + start, "right") - 1
        s1 = (heads[place] ^ np.uint64(1 << 63)).view(np.int64)  # signed order is byte order
        return row, low + start, high + start, s1, key.view(np.int64), g.view(np.int64), place + start


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")


def array_entries(docs: DataFrame, length: int, anchor_bytes: int) -> DataFrame:
    """(s1, h, g, least, most): the neighbourhoods of the texts with their least and greatest doc_id, reduced per batch of rows."""

    def run(batch: pa.RecordBatch):
        found = Neighbourhoods(batch.column(1), length, anchor_bytes)
        doc = batch.column(0).to_numpy()[found.row]
        # in order of the digests equal keys are adjacent (but for one digest of two keys, which only gives more rows)
        order = np.argsort(found.g)
        h, g, doc = found.h[order], found.g[order], doc[order]
        first = np.flatnonzero(np.concatenate(([True], (np.diff(h) != 0) | (np.diff(g) != 0)))) if len(h) else order
        least, most = (f.reduceat(doc, first) if len(h) else doc for f in (np.minimum, np.maximum))
        return [pa.array(x) for x in (found.s1[order][first], h[first], g[first], least, most)]

    return map_arrow(_rows(docs), run, "s1 long, h long, g long, least long, most long")


def occurrences(docs: DataFrame, length: int, anchor_bytes: int) -> DataFrame:
    """(h, g, doc_id): each text's distinct neighbourhoods."""

    def run(batch: pa.RecordBatch):
        found = Neighbourhoods(batch.column(1), length, anchor_bytes)
        order = np.argsort(found.g, kind="stable")  # rows stay in order under each digest
        row, g = found.row[order], found.g[order]
        once = order[np.concatenate(([True], (np.diff(row) != 0) | (np.diff(g) != 0)))] if len(order) else order
        return [pa.array(found.h[once]), pa.array(found.g[once]), pa.array(batch.column(0).to_numpy()[found.row[once]])]

    return map_arrow(_rows(docs), run, "h long, g long, doc_id long")


#: The two halves of Neighbourhoods.h as ints, and back: runs are dealt by the anchor's half.
_ANCHOR, _SIDES = "cast(shiftright(h, 32) as int)", "cast((h & 4294967295) - 2147483648 as int)"
_WHOLE_H = "shiftleft(cast(h as long), 32) | (cast(sides as long) + 2147483648)"


def _agree_on_a_side(rows: pa.RecordBatch) -> pa.RecordBatch:
    """(g, owner, n) of whole groups, sorted by (s1, h): the rows whose side hash another row of their group has; n counts those."""
    s1, h = rows.column("s1").to_numpy(), rows.column("h").to_numpy()
    sides = rows.column("sides").to_numpy().astype(np.int64) + (1 << 31)
    group = np.cumsum(np.concatenate(([0], (np.diff(s1) != 0) | (np.diff(h) != 0))))
    keep = np.zeros(rows.num_rows, bool)
    for side in (sides >> 16, sides & 0xFFFF):
        mine = np.flatnonzero(side)
        key = group[mine] << 16 | side[mine]
        order = np.argsort(key)
        same = np.diff(key[order]) == 0
        keep[mine[order[1:][same]]] = True
        keep[mine[order[:-1][same]]] = True
    n = np.bincount(group[keep])[group[keep]]
    picked = rows.filter(pa.array(keep))
    return pa.RecordBatch.from_arrays([picked.column("g"), picked.column("owner"), pa.array(n, pa.int64())], names=["g", "owner", "n"])


class SuffixArrays:
    """The family: at most one array a level, an array of level i is merged from about 2**i batches."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.levels: list[list[Run]] = [[]]

    def runs(self) -> list[Run]:
        return [r for level in self.levels for r in level]

    def compact(self) -> None:
        """Merge each two arrays of one level into one of the next; their keys are disjoint."""
        for level in range(len(self.levels)):
            if len(self.levels[level]) < 2:
                continue
            a, b = self.levels[level]
            left = a.read().where("fresh").select(*KEYS, "sides", "owner")
            right = b.read().where("fresh").select(*KEYS, F.col("sides").alias("others"), F.col("owner").alias("other"))
            both = left.hint("merge").join(right, list(KEYS), "full_outer")
            merged = both.select(*KEYS, F.coalesce("sides", "others").alias("sides"), F.coalesce("owner", "other").alias("owner"),
                                 F.lit(True).alias("fresh"))
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(write_run(merged, f"suffixes{level + 1}", self.buckets, KEYS[:2], KEYS))
            self.levels[level] = []
            a.forget()
            b.forget()

    def absorb(self, entries: DataFrame) -> DataFrame:
        """Take in a batch; return (h, g, owner) of its neighbourhoods that more than one document holds so far."""
        self.compact()
        dealt = entries.repartition(self.buckets, "s1", F.expr(_ANCHOR)).selectExpr("s1", f"{_ANCHOR} AS h", "g", f"{_SIDES} AS sides", "least", "most")
        mine = dealt.sortWithinPartitions(*KEYS).groupBy(*KEYS).agg(
            F.first("sides").alias("sides"), F.min("least").alias("least"), F.max("most").alias("most"))
        known = F.lit(None).cast("long")
        for i, run in enumerate(self.runs()):
            seen = run.read().where("fresh").select(*KEYS, F.col("owner").alias(f"owner{i}"))
            mine = mine.join(seen.hint("merge"), list(KEYS), "left")
            known = F.coalesce(known, F.col(f"owner{i}"))
        owner = F.coalesce(known, "least")
        # a row that is neither new nor shared says nothing
        found = mine.select(*KEYS, "sides", owner.alias("owner"), known.isNull().alias("fresh"), (F.col("most") > owner).alias("shared"))
        run = write_run(found.where("fresh or shared"), "suffixes0", self.buckets, KEYS[:2], KEYS)
        self.levels[0].append(run)
        return stored(run.read().where("shared").selectExpr(f"{_WHOLE_H} AS h", "g", "owner"), "shared")

    def contested(self, limit: int = GROUP_LIMIT) -> DataFrame:
        """(g, owner, n): the n neighbourhoods of each anchor string that has several; of groups within the limit only
        those that agree on a side with another one, as far as their hashes say."""
        counts = None
        for i, run in enumerate(self.runs()):
            mine = run.read().where("fresh").groupBy(*KEYS[:2]).agg(F.count(F.lit(1)).alias(f"n{i}"))
            counts = mine if counts is None else counts.join(mine.hint("merge"), list(KEYS[:2]), "full_outer")
        total = sum((F.coalesce(F.col(f"n{i}"), F.lit(0)) for i in range(len(self.runs()))), F.lit(0))
        several = stored(counts.select(*KEYS[:2], total.alias("n")).where("n > 1"), "several")
        out = None
        for run in self.runs():
            mine = run.read().where("fresh").select(*KEYS, "sides", "owner").join(several.hint("merge"), list(KEYS[:2]))
            out = mine if out is None else out.unionByName(mine)
        small = out.where(F.col("n") <= limit).select(*KEYS[:2], "sides", "g", "owner").repartition(*KEYS[:2]).sortWithinPartitions(*KEYS[:2])
        near = small.mapInArrow(lambda rows: map(_agree_on_a_side, _whole_groups(rows)), "g long, owner long, n long")
        found = stored(near.unionByName(out.where(F.col("n") > limit).select("g", "owner", "n")), "contested")
        forget(self.spark, several)
        return found

    def forget(self) -> None:
        for run in self.runs():
            run.forget()
        self.levels = [[]]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by their first two columns, cut anew so that no group of equal values of these goes on in the next one."""
    rest = None  # the last group so far, which the next batch may go on with
    for batch in batches:
        if rest is not None and rest.num_rows:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        ends = np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0))
        cut = int(ends[-1]) + 1 if len(ends) else 0
        rest = batch.slice(cut)
        if cut:
            yield batch.slice(0, cut)
    if rest is not None and rest.num_rows:
        yield rest


def _listed(column: pa.Array, fields: tuple[str, ...]) -> list[list[np.ndarray]]:
    """For each row the arrays of the named fields of its list of structs; null counts as an empty list."""
    bounds, valid = column.offsets.to_numpy(), column.is_valid().to_pylist()
    values = [column.values.field(f).to_numpy(zero_copy_only=False) for f in fields]
    return [[v[a:b] if ok else v[:0] for v in values] for a, b, ok in zip(bounds[:-1].tolist(), bounds[1:].tolist(), valid)]


def contested_texts(docs: DataFrame, contested: DataFrame, length: int, anchor_bytes: int) -> DataFrame:
    """(s1, h, n, g, owner, around, place): the bytes of each contested neighbourhood, read from its owner, and its anchor's place there."""
    wanted = contested.groupBy("owner").agg(F.collect_list(F.struct("g", "n")).alias("wanted"))
    rows = _rows(docs).join(wanted.hint("shuffle_hash"), F.col("doc_id") == F.col("owner")).select("owner", "text", "wanted")

    def run(batch: pa.RecordBatch):
        found = Neighbourhoods(batch.column(1), length, anchor_bytes)
        bounds = np.searchsorted(found.row, np.arange(batch.num_rows + 1))
        picked, many = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, (g, n) in enumerate(_listed(batch.column(2), ("g", "n"))):
            # once, however often the text holds it
            here, first = np.unique(found.g[bounds[i]:bounds[i + 1]], return_index=True)
            if len(here):
                at = np.searchsorted(here, g)
                real = np.flatnonzero(here[np.minimum(at, len(here) - 1)] == g)
                picked.append(first[at[real]] + bounds[i])
                many.append(n[real])
        j = np.concatenate(picked)
        around = [bytes(found.raw[a:b + length]) for a, b in zip(found.low[j].tolist(), found.high[j].tolist())]
        owner = batch.column(0).to_numpy()[found.row[j]]
        return [pa.array(x) for x in (found.s1[j], found.h[j] >> 32, np.concatenate(many), found.g[j], owner)] + [
            pa.array(around, pa.binary()), pa.array((found.anchor[j] - found.low[j]).astype(np.int32))]

    return map_arrow(rows, run, "s1 long, h long, n long, g long, owner long, around binary, place int")


def _candidates(rows: pa.RecordBatch, reach: int, anchor_bytes: int) -> np.ndarray:
    """The rows of whole groups that ``_may_share`` may keep, found by hashes of the bytes on both sides of the anchor."""
    offsets, raw = _raw(rows.column("around"))
    if reach < 8 or len(raw) < 8:
        return np.arange(rows.num_rows)
    words = np.ndarray((len(raw) - 7,), "<u8", buffer=raw, strides=(1,))
    s1, h = (rows.column(c).to_numpy().view(np.uint64) for c in ("s1", "h"))
    place = rows.column("place").to_numpy().astype(np.int64)
    group = ((s1 * np.uint64(0x9E3779B97F4A7C15)) ^ h) * np.uint64(0xBF58476D1CE4E5B9)
    group ^= group >> np.uint64(32)
    keep = np.zeros(rows.num_rows, bool)
    anchor = offsets[:-1] + place
    after = anchor + anchor_bytes
    for at, there in ((anchor - reach, place >= reach), (after, after + reach <= offsets[1:])):
        mine = np.flatnonzero(there)
        key = group[mine]
        for step in [*range(0, reach - 8, 8), reach - 8]:
            key ^= words[at[mine] + step]
            key *= np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(29)
        order = np.argsort(key)
        same = np.diff(key[order]) == 0
        keep[mine[order[1:][same]]] = True
        keep[mine[order[:-1][same]]] = True
    return np.flatnonzero(keep)


def _may_share(group: list[tuple[int, int, bytes, int]], reach: int, anchor_bytes: int) -> list[tuple[int, int, bytes, int]]:
    """The neighbourhoods that agree with another one in the ``reach`` bytes before the anchor, or in those after it.

    A window has ``reach`` bytes on one side of its anchor at least, so others share no window.
    """
    sides = []
    for _, _, around, place in group:
        before, after = around[max(place - reach, 0):place], around[place + anchor_bytes:place + anchor_bytes + reach]
        sides.append((before if len(before) == reach else None, after if len(after) == reach else None))
    seen = [Counter(x for x in side if x is not None) for side in zip(*sides)]
    return [item for item, (b, a) in zip(group, sides) if seen[0][b] > 1 or seen[1][a] > 1]


def _repeats(group: list[tuple[int, int, bytes, int]], length: int, anchor_bytes: int) -> Iterator[tuple[int, int, int]]:
    """(owner, g, mask): bit i says that the i-th window of the neighbourhood also stands in one of a smaller owner."""
    if group:
        group = _may_share(group, (length - anchor_bytes + 1) // 2, anchor_bytes)
    least: dict[bytes, int] = {}
    for owner, _, around, _ in group:
        for i in range(len(around) - length + 1):
            w = around[i:i + length]
            if owner < least.get(w, owner + 1):
                least[w] = owner
    for owner, g, around, _ in group:
        mask = sum(1 << i for i in range(len(around) - length + 1) if least[around[i:i + length]] < owner)
        if mask:
            yield owner, g, mask


def window_repeats(texts: DataFrame, length: int, anchor_bytes: int, limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, g, mask) of the contested neighbourhoods with repeated windows; the mask has at most ``length`` bits."""

    def shared(rows: pa.RecordBatch) -> pa.RecordBatch:
        """The repeats of whole groups; most rows share no side with another one and never become Python objects."""
        likely = rows.take(pa.array(_candidates(rows, (length - anchor_bytes + 1) // 2, anchor_bytes)))
        held: list[tuple[int, int, bytes, int]] = []
        now, out = None, []
        for s1, h, g, owner, around, place in zip(*(likely.column(i).to_pylist() for i in range(6))):
            if (s1, h) != now:
                out.extend(_repeats(held, length, anchor_bytes))
                held, now = [], (s1, h)
            held.append((owner, g, around, place))
        out.extend(_repeats(held, length, anchor_bytes))
        cols = list(zip(*out)) if out else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "g", "mask"])

    small = texts.where(F.col("n") <= limit).select("s1", "h", "g", "owner", "around", "place")
    near = small.repartition("s1", "h").sortWithinPartitions("s1", "h").mapInArrow(lambda rows: map(shared, _whole_groups(rows)), "doc_id long, g long, mask long")

    def windows(batch: pa.RecordBatch):
        offsets, raw = _raw(batch.column(2))
        many = np.diff(offsets) - length + 1
        row = np.repeat(np.arange(batch.num_rows), many)
        at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        cut = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), length)[offsets[row] + at]
        bounds = np.arange(len(row) + 1, dtype=np.int32) * np.int32(length)
        w = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(bounds), pa.py_buffer(cut.ravel())])
        return w, batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), at

    # a group beyond the limit is never in one task: its windows are dealt out by their bytes; those that several owners
    # have are stored, so that the shuffles that find them are gone before all windows are joined with them
    large = map_arrow(texts.where(F.col("n") > limit).select("owner", "g", "around"), windows, "w binary, owner long, g long, i int")
    least = large.groupBy("w").agg(F.min("owner").alias("least"), F.max("owner").alias("most")).where("least < most").drop("most")
    least = stored(least, "least")
    far = large.join(least, "w").where("least < owner").groupBy(F.col("owner").alias("doc_id"), "g").agg(
        F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask"))
    found = stored(near.unionByName(far), "part")
    forget(texts.sparkSession, least)
    return found


def repeated_windows(docs: DataFrame, length: int = 50, anchor_bytes: int = 16, batches: int = 3, buckets: int | None = None,
                     limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, lost): the (g, mask) of each text's neighbourhoods with repeated windows; mask -1: all windows."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    family = SuffixArrays(spark, buckets)
    with merge_settings(spark, SORTED_SUMS):
        shared = None
        for part in doc_id_batches(_rows(docs), batches):
            got = family.absorb(array_entries(docs.where(part), length, anchor_bytes))
            shared = got if shared is None else shared.unionByName(got)
        contested = family.contested(limit)
        family.forget()
        # a neighbourhood shared again in a later batch has the same owner there
        # (the build side is a partition's share of distinct neighbourhoods, so the occurrences need no sort)
        whole = stored(occurrences(docs, length, anchor_bytes).join(shared.distinct().hint("shuffle_hash"), ["h", "g"]).where("doc_id > owner")
                       .select("doc_id", "g", F.lit(-1).cast("long").alias("mask")), "whole")
        forget(spark, shared)
        texts = stored(contested_texts(docs, contested, length, anchor_bytes), "around")
        forget(spark, contested)
        part = window_repeats(texts, length, anchor_bytes, limit)
        lost = stored(whole.unionByName(part).groupBy("doc_id").agg(F.collect_list(F.struct("g", "mask")).alias("lost")), "lost")
    forget(spark, whole, texts, part)
    return lost


def kept_bytes(texts: pa.Array, lost: list[list[np.ndarray]], length: int, anchor_bytes: int) -> Iterator[tuple[memoryview, np.ndarray | None]]:
    """For each row its bytes and a boolean of the bytes to keep, or None to keep all."""
    offsets, raw = _raw(texts)
    # only texts that lose something are cut into neighbourhoods (an empty text for the others: with a null, pyarrow 23
    # gives wrong bytes on a slice)
    cut = pa.array([len(g) > 0 for g, _ in lost], pa.bool_())
    found = Neighbourhoods(pc.if_else(cut, texts, pa.scalar("", texts.type)), length, anchor_bytes)
    bounds = np.searchsorted(found.row, np.arange(len(lost) + 1))
    for i, (g, mask) in enumerate(lost):
        a, b = int(offsets[i]), int(offsets[i + 1])
        if not len(g):
            yield raw[a:b], None
            continue
        cover = np.zeros(b - a + 1, np.int32)
        order = np.argsort(g, kind="stable")
        g, mask = g[order], mask[order]
        mine = slice(bounds[i], bounds[i + 1])
        at = np.searchsorted(g, found.g[mine])
        hit = np.flatnonzero(g[np.minimum(at, len(g) - 1)] == found.g[mine])
        low, high = found.low[mine][hit] - found.offsets[i], found.high[mine][hit] - found.offsets[i]
        bits = mask[at[hit]]
        every = bits == -1
        np.add.at(cover, low[every], 1)
        np.add.at(cover, high[every] + length, -1)
        which, bit = np.nonzero(bits[~every][:, None] >> np.arange(min(length, 63)) & 1)
        start = low[~every][which] + bit
        np.add.at(cover, start, 1)
        np.add.at(cover, start + length, -1)
        yield raw[a:b], np.cumsum(cover[:-1]) == 0


def _left(raw: memoryview, keep: np.ndarray | None) -> bytes:
    return bytes(raw) if keep is None else np.frombuffer(raw, np.uint8)[keep].tobytes()


def _with_lost(docs: DataFrame, length: int, anchor_bytes: int, **how) -> DataFrame:
    """(row, text, lost) of every row of ``docs``."""
    lost = repeated_windows(docs, length, anchor_bytes, **how).withColumnRenamed("doc_id", "_lost_id")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("_doc"), F.col("text").alias("_text"))
    # the build side is a partition's share of the lost windows, so the text rows need no sort
    joined = rows.join(lost.hint("shuffle_hash"), rows["_doc"] == lost["_lost_id"], "left")
    return joined.select("row", F.col("_text").alias("text"), "lost")


def kept_digests(docs: DataFrame, length: int = 50, anchor_bytes: int = 16, **how) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    A byte goes if a string of ``length`` bytes that covers it also stands in a row with a smaller doc_id;
    strings within one document, or rows of one doc_id, do not count against each other. Null text
    counts as empty; texts under ``length`` bytes lose nothing. Rows without doc_id neither own nor lose.
    Repeated rows each have a row of their own. An empty table gives an empty result. Columns other
    than ``doc_id`` and ``text`` are ignored, whatever their names.
    """
    found = _with_lost(docs.select("doc_id", "text"), length, anchor_bytes, **how)

    def run(batch: pa.RecordBatch):
        size, gone, spans, digests = [], [], [], []
        for raw, keep in kept_bytes(batch.column(1), _listed(batch.column(2), ("g", "mask")), length, anchor_bytes):
            size.append(len(raw))
            gone.append(0 if keep is None else int(len(keep) - keep.sum()))
            spans.append(0 if keep is None else int((np.diff(np.concatenate(([0], ~keep))) == 1).sum()))
            digests.append(hashlib.sha256(_left(raw, keep)).hexdigest())
        return batch.column(0), size, gone, spans, digests

    return map_arrow(found.select(F.col("row.doc_id").cast("long").alias("doc_id"), "text", "lost"), run,
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = 50, anchor_bytes: int = 16, **how) -> DataFrame:
    """``docs`` (all columns) with the remaining text of each row; null texts stay null.

    A cut can fall within a character; the bytes left of such a character are dropped with it.
    """
    found = _with_lost(docs, length, anchor_bytes, **how)
    at = docs.columns.index("text")

    def each(batches):
        for batch in batches:
            row = batch.column(0)
            cols = row.flatten()
            kept = kept_bytes(batch.column(1), _listed(batch.column(2), ("g", "mask")), length, anchor_bytes)
            texts = [_left(raw, keep).decode("utf-8", "ignore") if ok else None
                     for ok, (raw, keep) in zip(batch.column(1).is_valid().to_pylist(), kept)]
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=[row.type.field(i).name for i in range(row.type.num_fields)])

    return found.mapInArrow(each, docs.schema)
