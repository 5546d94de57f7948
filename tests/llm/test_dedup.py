"""SimHash groups, components, line dedup and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from carestay.llm import components, decontaminate, linededup, simhash

WORDS = [f"w{i}" for i in range(40)]


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 40))) for _ in range(n // 3)]
    rows = []
    for i in range(n):
        t = rnd.choice(base)
        if rnd.random() < 0.5:
            w = t.split()
            if w:
                w[rnd.randrange(len(w))] = rnd.choice(WORDS)
            t = (" " if rnd.random() < 0.5 else "\n").join(w)
        rows.append((i, t.upper() if rnd.random() < 0.2 else t))
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \t"), (None, base[0]), (3, rows[3][1]), (n + 3, "É é 中   x")]


def brute_fp(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0


def brute_components(fps, radius=4):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_simhash_groups(make_docs):
    rows = corpus()
    got = simhash.near_duplicate_groups(make_docs(rows)).select(
        "doc_id", simhash.hex_fingerprint("fp").alias("fp"), "component_id").collect()
    fps = [(i, brute_fp(t)) for i, t in rows]
    root = brute_components({f for _, f in fps})
    least = {}
    for i, f in fps:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted((str(i), f"{f:016x}", least[root[f]]) for i, f in fps)
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == want


def test_simhash_empty_table(make_docs):
    empty = make_docs([])
    assert simhash.near_duplicate_groups(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_drop_near_duplicates_keeps_least_and_columns(make_docs):
    rows = corpus()
    docs = make_docs(rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicate_groups(docs).collect()}
    want = sorted(str(i) for i in {i for i, _ in rows} if i is None or groups[i] == i)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_covering_masks_cover_every_pair():
    rnd = random.Random(5)
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    for _ in range(3000):
        diff = sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4)))
        assert any(m & diff == 0 for m in masks)
    finer = simhash._finer(simhash._signed(masks[3]), 4)
    for _ in range(500):
        free = [b for b in range(64) if not masks[3] >> b & 1]
        diff = sum(1 << b for b in rnd.sample(free, 4))
        assert any(m & simhash.ALL_BITS & diff == 0 for m in finer)
        assert all(m & masks[3] == masks[3] for m in finer)


@pytest.mark.parametrize("limit", [25, 2048])
def test_large_buckets_split_without_losing_links(spark, limit):
    rnd = random.Random(2)
    fps, x = set(), rnd.getrandbits(64)
    for _ in range(60):  # a chain and a ball: many fingerprints share buckets
        x ^= 1 << rnd.randrange(64)
        fps |= {x, x ^ (1 << rnd.randrange(64)), rnd.getrandbits(64)}
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    got = components.connected_components(simhash.fingerprint_links(df, 4, limit)).collect()
    mine = {f: f for f in fps} | {r["node"] & simhash.ALL_BITS: r["root"] & simhash.ALL_BITS for r in got}
    want = brute_components(fps)
    as_sets = lambda m: {frozenset(f for f in fps if m[f] == r) for r in set(m.values())}
    assert as_sets(mine) == as_sets(want)


def test_link_buckets_over_batch_borders():
    fps = np.array([1, 3, 7, 1 << 20], np.int64)
    rows = [pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([f])], names=["mask", "bits", "fp"]) for f in fps]
    out = [r for b in simhash.link_buckets(iter(rows), 4) for r in b.to_pylist()]
    assert {r["v"] for r in out} | {r["u"] for r in out} == set(fps.tolist())


def test_components_of_a_long_path(spark):
    edges = spark.range(200).selectExpr("id as u", "id + 1 as v").union(spark.sql("select 500L, 500L")).union(
        spark.sql("select 900L, 800L")).union(spark.sql("select cast(null as bigint), 5L"))
    got = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 900: 800} or {k: v for k, v in got.items() if k != v} == {
        **{i: 0 for i in range(1, 201)}, 900: 800}


def line_key(line):
    k = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\r\x0b\x0c"))
    return k if len(k) >= 10 else None


def brute_lines(rows):
    owner, holders = {}, {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = line_key(line)
            if k and i is not None:
                holders.setdefault(k, set()).add(i)
    owner = {k: min(v) for k, v in holders.items() if len(v) > 1}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or owner.get(line_key(x), i) == i]
        out.append((str(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def line_corpus():
    rnd = random.Random(4)
    lines = ["a shared line of text", "A SHARED line of text ", "short", "éééééééééé", "ééééééééé", "another line, long enough", "", "\tanother line, long enough\x0b", "tail   with nbsp"]
    rows = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 6)))) for i in range(40)]
    return [*rows, (50, None), (51, ""), (None, "a shared line of text\nx"), (7, rows[7][1]), (60, "\n\n" + "a shared line of text\n" * 500)]


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (6, 2), (5, 3)])
def test_line_dedup(make_docs, batches, fanout):
    rows = line_corpus()
    got = linededup.kept_digests(make_docs(rows), 10, batches, fanout).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == brute_lines(rows)


def test_line_dedup_texts_and_columns(make_docs):
    rows = line_corpus()
    docs = make_docs(rows)
    out = linededup.without_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    digests = {(str(r["doc_id"]), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in out.collect()}
    assert digests == {(i, d) for i, _, _, d in brute_lines(rows)}
    assert out.where("doc_id = 50 and text is null").count() == 1
    assert linededup.kept_digests(make_docs([])).count() == 0


def item_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_scan(rows, items, n=10):
    out = []
    for i, t in rows:
        w = item_words(t)
        hit, found = set(), set()
        for item, text in items:
            iw = item_words(text)
            size = min(n, len(iw))
            wins = {tuple(iw[k:k + size]) for k in range(len(iw) - size + 1)} if size else set()
            for k in range(len(w) - size + 1):
                if size and tuple(w[k:k + size]) in wins:
                    hit |= set(range(k, k + size))
                    found.add(item)  # items without id: one, without a name
        names = sorted(str(x) for x in found if x is not None)
        out.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def leak_corpus():
    rnd = random.Random(9)
    items = [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.choice([3, 10, 14, 25])))) for i in range(12)] + [(20, None), (21, "!!"), (22, "Éa b"), (7, "w1 w1"), (None, "w2 w3 w4"), (None, "x éa")]
    rows = []
    for i in range(40):
        t = " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 30)))
        if i % 3 == 0:
            t += " " + rnd.choice(items)[1].__str__().upper().replace(" ", ", ", 2) + " end"
        rows.append((i, t))
    return [*rows, (40, None), (41, ""), (None, items[2][1]), (5, rows[5][1]), (42, "x éa b")], items


@pytest.mark.parametrize("block_words", [10, 1_000_000])
def test_decontamination(spark, make_docs, block_words):
    rows, items = leak_corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(rows)
    if block_words > 100:
        got = decontaminate.digests(docs, bench).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == brute_scan(rows, items)
    else:
        rows = [r for k, r in enumerate(rows) if r[0] != 5 or k == 5]
        got = decontaminate.scan(make_docs(rows), bench, block_words=block_words)
        hit = {str(r["doc_id"]): sum(b - a for a, b in zip(r["spans"][::2], r["spans"][1::2])) for r in got.collect()}
        assert hit == {i: n for i, _, n, *_ in brute_scan(rows, items)}


def test_contaminated_documents_and_spans_go(spark, make_docs):
    rows, items = leak_corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(rows)
    clean = {i for i, *_, bad in brute_scan(rows, items) if not bad}
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and {str(r["doc_id"]) for r in kept.collect()} == clean
    cut = decontaminate.remove_contaminated(docs, bench, how="spans")
    assert cut.count() == len(rows)
    texts = {str(r["doc_id"]): r["text"] for r in cut.collect()}
    for i, t in rows:
        if str(i) in clean:
            assert texts[str(i)] == t
        else:
            assert len(item_words(texts[str(i)])) < len(item_words(t))
    for how, one in (("documents", kept), ("spans", cut)):  # block by block, the same
        many = decontaminate.remove_contaminated(docs, bench, how=how, block_words=60)
        assert many.columns == docs.columns
        assert sorted(map(str, many.collect())) == sorted(map(str, one.collect()))
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_contaminated(docs, empty).count() == len(rows)
    assert decontaminate.digests(make_docs([]), bench).count() == 0


@pytest.mark.parametrize("radius", [3, 4, 5])
def test_each_split_keeps_more_bits_and_covers_every_pair(radius):
    rnd = random.Random(radius)
    for free in range(radius + 1, 65):
        rest = rnd.sample(range(64), free)
        mask = simhash.ALL_BITS & ~sum(1 << b for b in rest)
        finer = simhash._finer(simhash._signed(mask), radius)
        assert all(m & mask == mask and m & simhash.ALL_BITS != mask for m in finer)
        for _ in range(50):
            diff = sum(1 << b for b in rnd.sample(rest, radius))
            assert any(m & diff == 0 for m in finer)


def test_a_dense_family_is_linked_and_ends(spark):
    rnd = random.Random(11)
    # a mask of the second split leaves these bits free: its bucket holds the whole family
    mask = next(m for a in simhash.covering_masks(4) for m in simhash._finer(simhash._signed(a), 4) if 64 - (m & simhash.ALL_BITS).bit_count() == 14)
    bits = [b for b in range(64) if not mask >> b & 1]
    assert all(m != mask for m in simhash._finer(mask, 4))  # else the next lines never end
    base = rnd.getrandbits(64) & mask
    fps = {base | sum(1 << b for k, b in enumerate(bits) if x >> k & 1) for x in rnd.sample(range(1 << 14), 4096)}
    lone = base ^ sum(1 << b for b in range(64) if mask >> b & 1 and b % 2)
    df = spark.createDataFrame([(simhash._signed(f),) for f in {*fps, lone}], "fp long")
    roots = components.connected_components(simhash.fingerprint_links(df, 4)).collect()
    named = {r["node"] & simhash.ALL_BITS: r["root"] for r in roots}
    assert fps - {next(iter({r["root"] & simhash.ALL_BITS for r in roots}))} <= set(named) and lone not in named
    assert len(set(named.values())) == 1


def test_scan_gives_the_same_rows_in_one_block_or_many(spark, make_docs):
    rows, items = leak_corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    # a doc_id of two texts, and several rows without doc_id
    docs = make_docs([*rows, (6, rows[9][1]), (None, rows[3][1]), (None, "nothing here"), (None, None)])
    one, many = (sorted(map(str, decontaminate.scan(docs, bench, block_words=k).collect())) for k in (1_000_000, 10))
    assert many == one and len(one) == len(rows) + 4
