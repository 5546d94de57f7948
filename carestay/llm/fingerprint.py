"""Threshold-scaled document fingerprints, in DataFrame functions only.

A sketch holds every 64-bit shingle hash below a fixed fraction of the hash range and nothing else, whatever
the text's length, so sketches of very unequal documents are comparable and the sketch of a union is the
union of the sketches. A text of fewer than about ``SCALE`` shingles may have an empty sketch, like one without words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestay.llm.store import stored

#: One hash in so many is retained.
SCALE = 8
SHINGLE_WORDS = 5
#: Runs of these are no part of a word.
_GAPS = r"[\x09-\x0D\x20]+"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once: within a lambda a plain column is worked out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _threshold(scale: int) -> int:
    """Signed hashes run from -2**63; those below this are the fraction 1/scale."""
    return -(1 << 63) + (1 << 64) // scale


def shingle_hashes(text: Column, k: int = SHINGLE_WORDS) -> Column:
    """XXH64 hashes of a text's shingles of ``k`` lower-cased words (a shorter text: of all its words; no words: none).

    Words are hashed first and shingles over the word hashes, so that no shingle string is built.
    """
    words = F.filter(F.split(F.lower(text), _GAPS, -1), lambda w: w != "")

    def shingles(h):
        last = F.size(h) - k
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .when(last < 0, F.array(F.aggregate(h, F.lit(42).cast("long"), lambda a, x: F.xxhash64(a, x))))
                .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                                       lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), shingles)


def sketch(text: Column, k: int = SHINGLE_WORDS, scale: int = SCALE) -> Column:
    """The sorted distinct retained hashes of a text, as an array of signed longs."""
    under = F.lit(_threshold(scale))
    return F.sort_array(F.array_distinct(F.filter(shingle_hashes(text, k), lambda x: x < under)))


def compared(a: Column, b: Column) -> Column:
    """(common, in_a, in_b): how many hashes two sketches of one scale have in common, and each."""
    return F.struct(F.size(F.array_intersect(a, b)).alias("common"), F.size(a).alias("in_a"), F.size(b).alias("in_b"))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of common shingles in all shingles of both; two empty sketches are alike (1), one empty and one not are not (0)."""
    def ratio(c):
        union = c["in_a"] + c["in_b"] - c["common"]
        return F.when(union == 0, 1.0).otherwise(c["common"] / F.greatest(union, F.lit(1)))
    return _let(compared(a, b), ratio)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; an empty sketch is contained in any."""
    return _let(compared(a, b), lambda c: F.when(c["in_a"] == 0, 1.0).otherwise(c["common"] / F.greatest(c["in_a"], F.lit(1))))


def merged(a: Column, b: Column) -> Column:
    """The sketch of the shingles of two texts together: the union of their sketches, which must be of one scale."""
    return F.sort_array(F.array_union(a, b))


def as_text(a: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits for each hash, in order."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def next_ids(ids: DataFrame) -> DataFrame:
    """``ids`` (distinct, in column ``id``) with ``next_id``, the next in descending order; after the last comes the first.

    Ids are dealt into ranges; windows run within a range, and the ranges' own ends are linked over a
    table of one row for each range.
    """
    dealt = stored(ids.repartitionByRange(F.col("id").desc()).withColumn("part", F.spark_partition_id()), "ids")
    ends = dealt.groupBy("part").agg(F.max("id").alias("first"))
    # one row for each range: as many as there are shuffle partitions
    whole = Window.partitionBy(F.lit(0)).orderBy(F.desc("first"))
    every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lead("first").over(whole), F.first("first").over(every)).alias("after"))
    inner = dealt.withColumn("lead", F.lead("id").over(Window.partitionBy("part").orderBy(F.desc("id"))))
    return inner.join(ends, "part").withColumn("next_id", F.coalesce("lead", "after")).drop("part", "lead", "after")


def with_next(docs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(doc_id, text, next_start, *columns, next_*columns): each document's whole text (null: empty), the start of the next
    document's text in descending doc_id, floor(n_chars / 2) code points or all, and ``columns`` of both.

    ``columns`` are expressions over ``text``, worked out once for each row. Every row has one row: rows that repeat a
    doc_id have the same next document, and to others that id's next text is the least of theirs. Rows without doc_id have no
    place in the order: their next document is the empty text.
    """
    # no alias on a column that needs none: it would keep Spark from dealing the documents once for both joins
    key = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(key, F.coalesce("text", F.lit("")).alias("text"))
    sizes = stored(rows.where("doc_id is not null").select(F.col("doc_id").alias("id"), F.length("text").alias("n")), "lengths")
    repeats = not sizes.groupBy("id").count().where("count > 1").isEmpty()
    links = next_ids(sizes.groupBy("id").agg(F.max("n").alias("n")) if repeats else sizes)
    # documents are dealt by doc_id once, for both joins; only starts and columns are dealt again. Ids are
    # few to a row or distinct, so no partition needs splitting
    made = ["doc_id", "text", *[c.alias(name) for name, c in columns.items()]]
    full = rows.where("doc_id is not null").select(*made).repartition("doc_id")
    known = full.groupBy("doc_id").agg(F.min_by(F.struct("text", *columns), "text").alias("least")).select("doc_id", "least.*") if repeats else full
    nexts = known.join(links.hint("shuffle_hash"), known["doc_id"] == links["next_id"]).select(
        F.col("id").alias("_id"), F.substring("text", F.lit(1), F.floor(F.col("n") / 2).cast("int")).alias("next_start"),
        *[F.col(name).alias(f"next_{name}") for name in columns]).repartition("_id")
    placed = full.join(nexts, full["doc_id"] == nexts["_id"]).drop("_id")
    # the columns of the empty text are empty arrays
    return placed.unionByName(rows.where("doc_id is null").select(*made).withColumns(
        {"next_start": F.lit(""), **{f"next_{name}": F.array().cast("array<bigint>") for name in columns}}))


def edited_text(text: Column, next_start: Column) -> Column:
    """A text whose last floor(n/2) code points are replaced by as many of the next text's start, or all."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_start, F.lit(1), half))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, held_in_edited, held_in_next).

    ``near_*`` are resemblances of a document's sketch to that of its edited text and of the next document; ``held_*``
    are containments of the document in them. Texts without words have the empty fingerprint. One row for each
    row (``with_next`` says what repeated and missing ids mean); an empty table gives an empty result; other columns are ignored.
    """
    made = with_next(docs, {"a": sketch(F.col("text"))}).withColumn("edited", edited_text(F.col("text"), F.col("next_start")))
    sketched = made.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                           "a", F.col("next_a").alias("c"), sketch(F.col("edited")).alias("b"))
    out = sketched.select("doc_id", "n_chars", "edited_sha256", "a", "b", compared(F.col("a"), F.col("b")).alias("ab"),
                          compared(F.col("a"), F.col("c")).alias("ac"))

    def near(c):
        union = F.col(f"{c}.in_a") + F.col(f"{c}.in_b") - F.col(f"{c}.common")
        return F.when(union == 0, 1.0).otherwise(F.col(f"{c}.common") / F.greatest(union, F.lit(1)))

    def held(c):
        return F.when(F.col(f"{c}.in_a") == 0, 1.0).otherwise(F.col(f"{c}.common") / F.greatest(F.col(f"{c}.in_a"), F.lit(1)))

    return out.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
                      near("ab").alias("near_edited"), near("ac").alias("near_next"), held("ab").alias("held_in_edited"), held("ac").alias("held_in_next"))
