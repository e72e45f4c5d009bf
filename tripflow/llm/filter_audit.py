"""How the filters of a corpus overlap, and what each of them removes in every order of application.

Each document gets one bit for every filter that it fails. Four filters look at the text alone: A, under ``LEAST_WORDS`` words; B, under half of
the words distinct; C, over 3 % capital letters; D, a symbol of ``SYMBOLS``. E fails a text that a smaller doc_id has too: an existential
self-join, a left-semi join on hash, exact text and smaller doc_id. The ids that fail E are united with those that fail others, one row
for each document and filter bit set, and the bits of a document are combined. Counts of bit combinations for each part and label, at most 32 by 4
for a part, are all that the orders are computed from.

Only texts whose hash occurs under two doc_ids go to the self-join; the hashes that do are found from ids and hashes alone. The side with the
smaller ids has one row for each text. Both sides are plain shuffles of written tables, so that adaptive execution splits a text that a
third of all documents share; where the hashes or texts are few, their written size lets Catalyst broadcast them instead.

Defined results: a null text is an empty one, and a null lang is the part ''. A row without doc_id is counted, passes E and has no labels. Rows that
repeat a doc_id are documents of their own; equal ones do not fail E through each other. A document is good or toxic if any of its label
rows says so. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, write_aside

#: The filters, whose places are the bits from the lowest, and their limits.
FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
SYMBOLS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"

DUPLICATE = 1 << FILTERS.index("E")


def text_bits(text: Column) -> Column:
    """Bits of the filters that look at one text."""
    found = F.array_remove(F.split(text, SPACE), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        F.size(found) < LEAST_WORDS,
        100 * F.size(F.array_distinct(found)) < DISTINCT_PERCENT * F.size(found),
        100 * capitals > CAPITAL_PERCENT * F.length(text),
        text.rlike(SYMBOLS),
    ]
    return sum((F.when(fail, F.lit(1 << place)).otherwise(0) for place, fail in enumerate(fails)), F.lit(0))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), row_key(F.col("text")).alias("hash"))


def later_copies(docs: DataFrame, checked: DataFrame) -> DataFrame:
    """(doc_id, part, hash) of the rows whose exact text has a smaller doc_id too. ``checked`` has every row's doc_id and hash."""
    known = checked.filter("doc_id IS NOT NULL")
    twice = known.groupBy("hash").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    twice = write_aside(twice.select("hash"), "twice")
    copies = write_aside(_texts(docs).filter("doc_id IS NOT NULL").join(twice, "hash", "left_semi"), "copies")
    firsts = write_aside(copies.groupBy("hash", "text").agg(F.min("doc_id").alias("first_id")), "firsts")
    row, first = copies.alias("row"), firsts.alias("first")
    smaller = F.expr("row.hash = first.hash AND row.text = first.text AND first.first_id < row.doc_id")
    return row.join(first, smaller, "left_semi").select("doc_id", "part", "hash")


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, hash, bits, rows): every document's failed filters. Equal rows that repeat a doc_id are one row here, counted in ``rows``."""
    checked = _texts(docs).select("doc_id", "part", "hash", text_bits(F.col("text")).alias("bits"))
    checked = write_aside(checked, "checked")
    texts = checked.withColumn("rows", F.lit(1).cast("long"))
    copies = later_copies(docs, checked).select("*", F.lit(DUPLICATE).alias("bits"), F.lit(0).cast("long").alias("rows"))
    together = texts.unionByName(copies).groupBy("doc_id", "part", "hash")
    return together.agg(F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"))


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, docs, good, toxic): documents of each part and bit combination, and how many of them the labels call good and toxic."""
    # Counted before the labels come, so that rows without doc_id are a few rows here.
    counted = failures(docs).groupBy("doc_id", "part", "bits").agg(F.sum("rows").alias("rows"))
    told = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic")
    )
    of = lambda told_: F.coalesce(F.sum(F.when(told_ == 1, F.col("rows"))), F.lit(0).cast("long"))
    return counted.join(told, "doc_id", "left").groupBy("part", "bits").agg(
        F.sum("rows").alias("docs"), of(F.col("is_good")).alias("good"), of(F.col("is_toxic")).alias("toxic")
    )


def _bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), letter) - 1)


def audit(combos: DataFrame) -> DataFrame:
    """For each part, order of the filters and step, what the step does."""
    orders = F.array(*(F.lit("".join(order)) for order in permutations(FILTERS)))
    gathered = combos.groupBy("part").agg(F.collect_list(F.struct("bits", "docs", "good", "toxic")).alias("combos"))
    orderly = gathered.select("part", "combos", F.explode(orders).alias("filter_order"))
    steps = orderly.select("*", F.posexplode(F.split("filter_order", "")).alias("place", "letter"))
    before = F.aggregate(
        F.slice(F.split("filter_order", ""), 1, F.col("place")), F.lit(0), lambda mask, letter: mask.bitwiseOR(_bit(letter))
    )
    steps = steps.select("part", "combos", "filter_order", (F.col("place") + 1).alias("step"), _bit(F.col("letter")).alias("own"), before.alias("before"))

    def total(wanted, value) -> Column:
        return F.aggregate(F.filter("combos", wanted), F.lit(0).cast("long"), lambda so_far, combo: so_far + value(combo))

    docs = lambda combo: combo["docs"]
    fails = lambda combo: combo["bits"].bitwiseAND(F.col("own")) != 0
    gone = lambda combo: combo["bits"].bitwiseAND(F.col("before")) != 0
    here = lambda combo: fails(combo) & ~gone(combo)
    # Of all orders, a document that fails k filters is removed by each of them in the k-th part.
    share = lambda combo: (combo["docs"] * len(list(permutations(FILTERS))) / F.bit_count(combo["bits"])).cast("long")
    return steps.select(
        "part", "filter_order", "step",
        total(lambda combo: ~fails(combo) & ~gone(combo), docs).alias("kept"),
        total(here, docs).alias("removed"),
        total(lambda combo: fails(combo) & gone(combo), docs).alias("redundant"),
        total(lambda combo: combo["bits"] == F.col("own"), docs).alias("unique_fails"),
        total(here, lambda combo: combo["good"]).alias("good_lost"),
        total(here, lambda combo: combo["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(combinations(docs, labels))
