"""Line dedup: hashes range-partitioned with a secondary sort, first occurrences streamed, bitmaps returned. DataFrame operations only.

A line's key is the line, stripped and lower-cased in ASCII. A key of at least ``MIN_CHARS`` code points that several documents hold
stays in the document with the smallest id only. The answer of the search is a compressed bitmap per document; texts are cut from it.

Rows (key digest, document, line) are range-partitioned and sorted. A key that much of the corpus shares would fill one range, so the
first pass ranges over (digest, salt of the document): it settles every line that is not in the first document of its salt. The second
pass ranges over (digest, salt) again, in which all lines still open share one salt: at most one document for each salt and key.

Defined results: a null or empty text is one empty line. A document without doc_id neither loses lines nor takes part. Rows that repeat a
doc_id are one document for the search, and each is cut by its own text. Extra columns are ignored by ``line_bitmaps`` and kept by ``drop_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ASCII_SPACE, join_lines_except, lines_of, lower_ascii, row_key

MIN_CHARS = 10
WORD_BITS = 64


def line_key(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(ASCII_SPACE)))


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, row key, line number, digest) for lines with a key that is long enough. 16 bytes of SHA-256 stand for the key."""
    lines = docs.filter("doc_id IS NOT NULL").select(
        "doc_id", row_key(F.col("text")).alias("row"), F.posexplode(lines_of(F.col("text"))).alias("line", "body")
    )
    keyed = lines.select("doc_id", "row", "line", line_key(F.col("body")).alias("key")).filter(F.length("key") >= MIN_CHARS)
    return keyed.select("doc_id", "row", "line", F.substring(F.unhex(F.sha2("key", 256)), 1, 16).alias("digest"))


def dropped_lines(rows: DataFrame) -> DataFrame:
    """The rows that are not in the first document of their digest."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def first_document(ranged: DataFrame, *keys: str) -> Column:
        return F.first("doc_id").over(W.partitionBy(*keys).orderBy("doc_id", "line"))

    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    local = salted.repartitionByRange(parts, "digest", "salt")
    local = local.withColumn("lost", F.col("doc_id") > first_document(local, "digest", "salt"))
    # Lines still open meet in salt -1; settled ones keep theirs, so that a hot key stays spread.
    local = local.withColumn("salt", F.when(F.col("lost"), F.col("salt")).otherwise(F.lit(-1)))
    final = local.repartitionByRange(parts, "digest", "salt")
    final = final.withColumn("lost", F.col("lost") | (F.col("doc_id") > first_document(final, "digest", "salt")))
    return final.filter("lost").select("doc_id", "row", "line")


def line_bitmaps(docs: DataFrame) -> DataFrame:
    """(doc_id, row, keep): for each document that loses lines, its 64-bit words with a zero bit. Words left out are all ones."""
    word = F.floor(F.col("line") / WORD_BITS).cast("int")
    lost = F.expr(f"bit_or(shiftleft(1L, cast(line % {WORD_BITS} AS int)))")
    words = dropped_lines(line_rows(docs)).groupBy("doc_id", "row", word.alias("word")).agg(lost.alias("lost"))
    entry = F.struct("word", F.bitwise_not("lost").alias("bits"))
    return words.groupBy("doc_id", "row").agg(F.collect_list(entry).alias("keep"))


def _lost_positions(keep: Column) -> Column:
    """Line numbers of the zero bits."""

    def of_word(entry: Column) -> Column:
        bits = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))
        zero = F.filter(bits, lambda b: F.call_function("getbit", entry["bits"], b) == 0)
        return F.transform(zero, lambda b: entry["word"] * WORD_BITS + b)

    return F.flatten(F.transform(keep, of_word))


def _with_bitmaps(docs: DataFrame) -> DataFrame:
    """All columns of docs and ``keep``; names of its own cannot clash with theirs."""
    found = line_bitmaps(docs).select(
        F.col("doc_id").alias("__line_doc"), F.col("row").alias("__line_row"), F.col("keep").alias("__line_keep")
    )
    same = (F.col("doc_id") == F.col("__line_doc")) & (row_key(F.col("text")) == F.col("__line_row"))
    return docs.join(found, same, "left").drop("__line_doc", "__line_row")


def kept_text(text: Column, keep: Column) -> Column:
    return join_lines_except(text, _lost_positions(keep))


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents with their kept lines as text, and all other columns as they are."""
    keep = F.col("__line_keep")
    text = F.when(keep.isNull(), F.col("text")).otherwise(kept_text(F.col("text"), keep))
    return _with_bitmaps(docs).withColumn("text", text).select(*docs.columns)


def line_report(docs: DataFrame) -> DataFrame:
    keep = F.col("__line_keep")
    text = F.coalesce(F.col("text"), F.lit(""))
    lost = F.aggregate(keep, F.lit(0).cast("long"), lambda n, e: n + F.bit_count(F.bitwise_not(e["bits"])))
    kept = F.when(keep.isNull(), text).otherwise(kept_text(F.col("text"), keep))
    return _with_bitmaps(docs.select("doc_id", "text")).select(
        "doc_id",
        F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )
