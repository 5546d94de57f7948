"""The registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op8_decontamination", "op10_line_dedup"])
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == sorted(cur.fetchall())


def test_one_query_for_each_operator():
    names = [k for k in E.queries() if k.startswith("op") and k[2].isdigit()]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from carestay.llm import bpe, decontaminate, linededup, simhash, toxicity
    from carestay.llm.queries import default_vocabulary
    from carestay.llm.store import stored, table

    docs = table(spark, SF, "documents")
    (_, drop_toxic), (_, lines), (_, near), (_, leaks), (_, encode) = P.STAGES
    one = stored(drop_toxic(spark, docs, SF), "t")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, table(spark, SF, "labels"))).collect()}
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == {i for i, s in scores.items() if s < 0.7}
    two = stored(lines(spark, one, SF), "t")
    assert two.columns == docs.columns and two.count() == one.count()
    assert linededup.kept_digests(two).where("n_dropped > 0").count() == 0
    three = stored(near(spark, two, SF), "t")
    groups = simhash.near_duplicate_groups(two)
    assert three.columns == docs.columns and three.count() == groups.select("component_id").distinct().count()
    four = stored(leaks(spark, three, SF), "t")
    found = decontaminate.digests(three, table(spark, SF, "benchmark"))
    assert four.columns == docs.columns and four.count() == found.where("not contaminated").count()
    assert decontaminate.digests(four, table(spark, SF, "benchmark")).where("contaminated").count() == 0
    last = encode(spark, four, SF)
    whole = P.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, last.collect()))
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, bpe.encode_digests(four, default_vocabulary()).collect()))


EDGES = [(1, None), (2, ""), (3, "first line of some length\nshared line of the corpus"), (4, "another one here\nshared line of the corpus"),
         (5, "shared line of the corpus"), (5, "shared line of the corpus"), (None, "shared line of the corpus"), (None, None),
         (6, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (7, "x " * 20_000 + "end"), (7, "a b c d e f")]


def stage_inputs(spark, make_docs, tmp_path):
    bench = [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (None, None), (2, "")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = [(1, 0, 0), (None, 1, 1), (3, None, None), (99, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return make_docs(EDGES), str(tmp_path)


def test_stages_on_nulls_repeats_ties_and_extra_columns(spark, make_docs, tmp_path):
    """What each stage's docstring states, on rows that clash in every way."""
    import corpus_pipeline as P

    docs, sf = stage_inputs(spark, make_docs, tmp_path)
    stages = dict(P.STAGES)

    def kept(name, rows=docs):
        out = stages[name](spark, rows, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert {tuple(r)[5:] for r in out.collect()} == {(7, "x", "y", "z", "w")}  # extra columns as they came
        return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)

    assert kept("toxicity") == sorted(EDGES, key=str)
    lines = kept("line_dedup")
    assert len(lines) == len(EDGES) and (4, "another one here") in lines and lines.count((5, "")) == 2
    assert (None, "shared line of the corpus") in lines and (1, None) in lines
    near = kept("simhash_dedup")
    assert {i for i, _ in near} == {1, 3, 4, 5, 6, 7, None} and [t for i, t in near if i == 7] == ["a b c d e f"]
    assert sum(i is None for i, _ in near) == 2 and sum(i == 5 for i, _ in near) == 1
    assert kept("decontamination") == sorted((r for r in EDGES if r[0] != 6), key=str)
    encoded = stages["bpe"](spark, docs, sf).collect()
    assert len(encoded) == len(EDGES) and sum(r["n_tokens"] == 0 for r in encoded) == 3


def test_stages_on_an_empty_table(spark, make_docs, tmp_path):
    import corpus_pipeline as P

    _, sf = stage_inputs(spark, make_docs, tmp_path)
    for _, stage in P.STAGES:
        assert stage(spark, make_docs([]), sf).count() == 0
