"""Removal of repeated byte strings against brute force and SQL."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from carestay.llm import suffixarray
from carestay.llm.sorted_runs import merge_settings, open_run, write_run

SF = "/root/testdata/sf0.001"


def brute(rows, length):
    owner = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for p in range(len(b) - length + 1):
                w = b[p:p + length]
                owner[w] = min(owner.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = set()
        for p in range(len(b) - length + 1):
            if i is not None and owner[b[p:p + length]] < i:
                gone.update(range(p, p + length))
        spans = sum(p - 1 not in gone for p in gone)
        out.append((i, len(b), len(gone), spans, hashlib.sha256(bytes(x for p, x in enumerate(b) if p not in gone)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=2, n=70, length=50):
    rnd = random.Random(seed)
    letters = "abcdé "
    passages = ["".join(rnd.choice(letters) for _ in range(rnd.choice([length - 1, length, length + 1, 90]))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            parts.append(rnd.choice(passages) if rnd.random() < 0.5 else "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))))
        rows.append((i, "".join(parts)))
    rows += [(n, None), (n + 1, ""), (n + 2, "a" * 400), (n + 3, "a" * 130), (None, passages[3] * 2), (5, passages[3] + "x" + passages[4]),
             (n + 4, rows[9][1]), (n + 5, rows[9][1]), (n + 6, "=" * 60 + "b" + "=" * 70), (n + 7, "\n" * 60)]
    rnd.shuffle(rows)
    return rows


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("limit", [1, 4096])  # 1: every group is dealt out window by window
def test_equals_brute_force(spark, make_docs, limit):
    rows = corpus()
    got = collected(suffixarray.kept_digests(make_docs(rows), length=50, limit=limit))
    assert got == brute(rows, 50)


@pytest.mark.parametrize("batches,anchor", [(1, 24), (2, 8), (5, 13)])
def test_any_number_of_batches_and_any_anchor(spark, make_docs, batches, anchor):
    rows = corpus(seed=batches)
    got = collected(suffixarray.kept_digests(make_docs(rows), length=40, anchor_bytes=anchor, batches=batches, buckets=3))
    assert got == brute(rows, 40)


def test_long_texts_are_cut_between_windows(spark, monkeypatch):
    # in this process: what a worker does with texts beyond its chunk
    monkeypatch.setattr(suffixarray, "CHUNK", 64)
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab") for _ in range(n)) for n in (10, 500, 50, 49, 0, 200)] + [None]
    found = suffixarray.Neighbourhoods(pa.array(texts).slice(1), 50, 24)
    starts = {(int(r), p) for r, a, b in zip(found.row, found.low - found.offsets[found.row], found.high - found.offsets[found.row])
              for p in range(a, b + 1)}
    assert starts == {(r, p) for r, t in enumerate(texts[1:]) for p in range(len(t or "") - 49)}
    assert len(found.low) == len({(int(a)) for a in found.low})


def test_candidates_are_all_that_may_share(spark):
    # in this process: rows of several groups, as a slice of a longer batch, against the exact rule
    rnd = random.Random(8)
    reach, anchor = 17, 16
    bits = ["".join(rnd.choice("ab") for _ in range(n)).encode() for n in (0, 5, 17, 17, 20, 30)]
    rows = []
    for group in range(12):
        for owner in range(rnd.randint(1, 9)):
            before, after = rnd.choice(bits) + rnd.choice([b"", bytes([owner])]), rnd.choice([b"", bytes([owner])]) + rnd.choice(bits)
            rows.append((group // 4, group, rnd.randint(0, 99), owner, before + b"#" * anchor + after, len(before)))
    types = [pa.int64()] * 4 + [pa.binary(), pa.int32()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["s1", "h", "g", "owner", "around", "place"])
    batch, rows = batch.slice(3), rows[3:]
    want = []
    for key in sorted({r[:2] for r in rows}):
        want += suffixarray._may_share([(r[3], r[2], r[4], r[5]) for r in rows if r[:2] == key], reach, anchor)
    got = [(rows[i][3], rows[i][2], rows[i][4], rows[i][5]) for i in suffixarray._candidates(batch, reach, anchor)]
    assert got == want and 0 < len(got) < len(rows)


def test_only_neighbourhoods_that_agree_on_a_side_are_contested(spark, make_docs):
    """A string that many texts have in other surroundings brings no text of theirs into the comparison."""
    rnd = random.Random(4)

    def noise(n):
        return "".join(rnd.choice("abcdefgh") for _ in range(n))

    phrase, passage = noise(24), noise(45)
    texts = [noise(40) + phrase + noise(40) for _ in range(60)] + [noise(10) + passage + noise(10) for _ in range(5)]
    texts += [noise(8) + texts[0][8:], texts[1][:-9] + noise(9), "=" * 90, "=" * 70 + noise(30)]
    found = suffixarray.Neighbourhoods(pa.array(texts), 50, 16)
    groups: dict[tuple, dict[int, tuple]] = {}
    for low, high, s1, h, g, anchor in zip(*(x.tolist() for x in (found.low, found.high, found.s1, found.h, found.g, found.anchor))):
        groups.setdefault((s1, h >> 32), {})[g] = (0, g, bytes(found.raw[low:high + 50]), anchor - low)
    several = [list(group.values()) for group in groups.values() if len(group) > 1]
    want = {item[1] for group in several for item in suffixarray._may_share(group, 17, 16)}
    family = suffixarray.SuffixArrays(spark, 2)
    with merge_settings(spark):
        for k in range(3):
            family.absorb(suffixarray.array_entries(make_docs([(i, t) for i, t in enumerate(texts) if i // 30 == k]), 50, 16))
        got = [r["g"] for r in family.contested().collect()]
        family.forget()
    assert len(got) == len(set(got)) and want <= set(got)
    assert 0 < len(got) <= len(want) + 3 < sum(map(len, several)) / 4


def test_groups_that_go_on_in_the_next_batch(spark, make_docs):
    rows = corpus(seed=6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = collected(suffixarray.kept_digests(make_docs(rows), length=50))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows, 50)


def test_only_texts_that_lose_something_are_cut(monkeypatch):
    texts = pa.array(["x" * 80, None, "y" * 90, "z" * 70]).slice(1)
    whole = suffixarray.Neighbourhoods(texts, 50, 16)
    g = whole.g[whole.row == 2]
    none = np.empty(0, np.int64)
    seen = []
    real = suffixarray.Neighbourhoods
    monkeypatch.setattr(suffixarray, "Neighbourhoods", lambda t, *a: seen.append(t.to_pylist()) or real(t, *a))
    got = list(suffixarray.kept_bytes(texts, [[none, none], [none, none], [g, np.full(len(g), -1)]], 50, 16))
    assert seen == [["", "", "z" * 70]]
    assert [bytes(raw) for raw, _ in got] == [b"", b"y" * 90, b"z" * 70] and [k is None for _, k in got] == [True, True, False]
    assert not got[2][1].any()


def test_empty_tables_and_remaining_texts(spark, make_docs):
    assert suffixarray.kept_digests(make_docs([])).count() == 0
    assert suffixarray.without_repeats(make_docs([(1, None), (2, "short")])).select("doc_id", "text").collect() == [(1, None), (2, "short")]
    shared = "the quick brown fox jumps over the lazy dog and on it goes "
    docs = make_docs([(1, "one " + shared), (2, "two " + shared + "end")])
    out = suffixarray.without_repeats(docs)
    assert out.columns == docs.columns
    # the blank before the passage is in both, so it goes too
    assert sorted(r["text"] for r in out.collect()) == sorted(["one " + shared, "twoend"])


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(E.oracle_sql()["op12_suffix_dedup"])
    cols = [d[0] for d in want.description]
    df = E.queries()["op12_suffix_dedup"](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == sorted(want.fetchall())


def test_scan_reads_arrays_as_they_lie(spark, make_docs):
    """A merge scan has one exchange, that of the new batch: none, and no sort, above an array. Arrays reopen by folder."""
    entries = suffixarray.array_entries(make_docs(corpus()), 50, 24)
    keys = list(suffixarray.KEYS)
    first = write_run(entries.repartition(4, "s1", "h").groupBy(*keys).agg({"least": "min"}).withColumnRenamed("min(least)", "owner"),
                      "a", 4, keys[:2], keys)
    again = open_run(spark, first.path, "s1 long, h long, g long, owner long", 4, keys[:2], keys)
    with merge_settings(spark):
        both = first.read().join(again.read().withColumnRenamed("owner", "other").hint("merge"), keys, "full_outer")
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort [" not in plan and "SortMergeJoin" in plan
        assert both.where("owner = other").count() == both.count() == first.read().count() > 0
    first.forget()


def test_levels_merge_geometrically(spark, make_docs):
    rows = corpus(n=64)
    family = suffixarray.SuffixArrays(spark, 2)
    with merge_settings(spark):
        for k in range(5):
            family.absorb(suffixarray.array_entries(make_docs([r for r in rows if r[0] is not None and r[0] % 5 == k]), 50, 24))
        assert [len(level) for level in family.levels] == [1, 0, 1]
        index = [r for run in family.runs() for r in run.read().where("fresh").select("s1", "h", "g").collect()]
    want = suffixarray.array_entries(make_docs(rows), 50, 24).select("s1", "h", "g").distinct().count()
    assert len(index) == len(set(index)) == want
    family.forget()
