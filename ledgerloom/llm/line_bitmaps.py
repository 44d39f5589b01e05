"""Lines that many documents share, as keep bitmaps of each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.writers import land

BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_LINES = 64


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.btrim(F.translate(line, CAPITALS, CAPITALS.lower()), F.lit(BLANKS))


def line_occurrences(documents: DataFrame, min_code_points: int = 1) -> DataFrame:
    """One row for each line that has a key: document, position and 128 bits of the key's hash."""
    exploded = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(_text()).alias("text_hash"), F.posexplode(_lines(_text())).alias("position", "line")
    )
    keyed = exploded.select("doc_id", "text_hash", "position", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_code_points).select(
        "doc_id", "text_hash", "position", F.xxhash64("key").alias("hash_a"), F.xxhash64(F.lit(1), F.col("key")).alias("hash_b")
    )


def first_occurrences(occurrences: DataFrame) -> DataFrame:
    """The first line of each key in each document.

    Hashes are dealt by ranges that go on with the document, so a key with a third of all lines is
    spread over as many ranges as it fills; within a range rows stream in order of key,
    document and position, and no further shuffle is needed.
    """
    key = ["hash_a", "hash_b", "doc_id", "text_hash"]
    earlier = F.lag("position").over(Window.partitionBy(*key).orderBy("position"))
    return occurrences.repartitionByRange(*key).withColumn("__earlier", earlier).filter("__earlier is null").drop("__earlier")


def keep_bitmaps(documents: DataFrame, min_documents: int = 10, min_code_points: int = 1) -> DataFrame:
    """For each document that loses lines: ``doc_id, text_hash, n_dropped, dropped``.

    ``dropped`` is the complement of the keep bitmap, compressed by leaving out empty words:
    structs of the number of a 64-line word and its bits. A line is dropped if its key (ASCII
    blanks stripped, A-Z lowered) has ``min_code_points`` or more and stands in ``min_documents`` documents
    or more. Rows that agree in ``doc_id`` and text are one document; a null id is an id like any
    other, and a null text is one empty line, which has no key.
    """
    occurrences = land(line_occurrences(documents, max(1, min_code_points)), "lines")
    counted = first_occurrences(occurrences).groupBy("hash_a", "hash_b").agg(F.count(F.lit(1)).alias("n"))
    common = land(counted.filter(F.col("n") >= min_documents).select("hash_a", "hash_b"), "common-lines")
    gone = occurrences.join(common, ["hash_a", "hash_b"])
    word = F.floor(F.col("position") / WORD_LINES).cast("int")
    bit = F.expr(f"shiftleft(1L, position % {WORD_LINES})")
    words = gone.groupBy("doc_id", "text_hash", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("doc_id", "text_hash").agg(
        F.sum(F.bit_count("bits")).alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped")
    )


def without_common_lines(documents: DataFrame, min_documents: int = 10, min_code_points: int = 1) -> DataFrame:
    """``doc_id, n_lines, n_dropped`` and ``kept_text``: the lines that stay, joined by newlines, for every row.

    An empty table gives an empty result; other columns than ``doc_id`` and ``text`` are ignored.
    """
    bitmaps = land(keep_bitmaps(documents, min_documents, min_code_points), "line-bitmaps").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "n_dropped", F.map_from_entries("dropped").alias("__words")
    )
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))

    def stays(_: Column, i: Column) -> Column:
        bits = F.try_element_at("__words", F.floor(i / WORD_LINES).cast("int"))
        return F.coalesce(F.getbit(bits, i % WORD_LINES), F.lit(0)) == 0

    lines = _lines(F.col("text"))
    kept = F.when(F.col("__words").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    return rows.join(bitmaps, same, "left").select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text")
    )
