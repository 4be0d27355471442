"""Documents that hold benchmark items, by SimHash of windows as long as an item.

All steps are DataFrame functions. A text is a list of hashed five-word shingles. A window holds
as many shingles as an item; its similarity to the item is the weighted Jaccard similarity of
the two multisets of shingles, a shingle's weight being how often it occurs. Moving a window
whose first shingle the item lacks by one to the right never lowers the similarity, so it is
enough to look at windows that begin with a shingle of some item.

Windows and items get 64-bit SimHash fingerprints. Fingerprints within ``RADIUS`` bits differ
in at most two bits in one of eight blocks, so equality of a block with one of its variants of
up to two flipped bits finds all of them. At similarity 0.8 about ten bits differ (deviation 3),
and more than ``RADIUS`` with a chance of 2e-5 for long items and 4e-4 for the shortest. So each
text has ``PRINTS`` fingerprints of hashes independent of each other, and a similar pair is lost
only if it is outside the radius in all of them: with a chance of 4e-10 for long items, and of
2e-7 for the shortest. What is found is verified exactly.

An item of fewer than five words is one shingle of that length. A window of a document is as
similar as 0.8 only if it is the same run of words, so these items are looked up as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recurra.llm.common import free_name, row_key
from recurra.session import stage

WORDS = 5
BLOCKS, BLOCK_BITS, FLIPS = 8, 8, 2
#: Within it some block of eight differs in at most FLIPS bits.
RADIUS = BLOCKS * (FLIPS + 1) - 1
#: Fingerprints of each window and item.
PRINTS = 2


def shingles(text: str) -> Column:
    """Hashes of all runs of five words, in order; none for a null text or fewer words.

    Words are runs of letters and digits in lower case. The arrays bind the words and their
    number once for the whole of the inner expression.
    """
    five = ", ".join(f"element_at(w, i + {j})" for j in range(WORDS))
    return F.expr(rf"""
        transform(
            array(array_remove(split(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), '')),
            w -> if(size(w) < {WORDS}, array(),
                    transform(sequence(1, size(w) - {WORDS - 1}), i -> xxhash64({five})))
        )[0]""").cast("array<bigint>")


def short_runs(text: str, lengths: list[int]) -> Column:
    """Hashes of all runs of as many words as one of ``lengths`` (under five) says, each once."""
    runs = ", ".join(
        "if(size(w) < {n}, array(), transform(sequence(1, size(w) - {m}), i -> xxhash64({n}, {run})))"
        .format(n=n, m=n - 1, run=", ".join(f"element_at(w, i + {j})" for j in range(n)))
        for n in lengths
    )
    return F.expr(rf"""
        transform(
            array(array_remove(split(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), '')),
            w -> array_distinct(concat({runs})))[0]""")


def word_count(text: str) -> Column:
    return F.expr(
        rf"size(array_remove(split(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), ''))"
    )


def simhash(hashes: str) -> Column:
    """The bits that more than half of a list of 64-bit hashes have set.

    Each of 32 sums counts two bits at once, which lie 32 places apart.
    """
    return F.expr(f"""
        aggregate(
            transform(
                aggregate({hashes}, array_repeat(0L, 32), (sums, x) -> transform(
                    sums, (s, i) -> s + (shiftright(x, i) & 4294967297L))),
                (s, i) ->
                    shiftleft(if(2 * (s & 4294967295L) > size({hashes}), 1L, 0L), i)
                    | shiftleft(if(2 * shiftright(s, 32) > size({hashes}), 1L, 0L), i + 32)),
            0L, (a, b) -> a | b)""")


def fingerprints(hashes: str) -> Column:
    """Structs of number (``print``) and SimHash (``bits``), each of hashes of their own."""
    return F.array(*[
        F.struct(
            F.lit(k).alias("print"),
            simhash(hashes if k == 0 else f"transform({hashes}, x -> xxhash64(x, {k}))").alias("bits"),
        )
        for k in range(PRINTS)
    ])


def multiset(hashes: str) -> Column:
    """The list with its second, third, ... occurrence of a hash told apart from the first."""
    return F.expr(f"""
        if(size(array_distinct({hashes})) = size({hashes}), {hashes}, transform(
            {hashes}, (x, i) -> transform(
                array(size(filter(slice({hashes}, 1, i), y -> y = x))),
                n -> if(n = 0, x, xxhash64(x, n)))[0]))""")


def _block(bits: Column, block) -> Column:
    return F.call_function("shiftright", bits, (block * BLOCK_BITS).cast("int")).bitwiseAND(
        F.lit((1 << BLOCK_BITS) - 1)
    )


def _flips() -> list[int]:
    """All ways to flip at most FLIPS bits of a block."""
    return [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= FLIPS]


def _found_before(block: Column, difference: Column) -> Column:
    """Whether an earlier block already pairs two fingerprints that differ in these bits."""
    return F.exists(
        F.sequence(F.lit(0), F.lit(BLOCKS - 1)),
        lambda b: (b < block) & (F.bit_count(_block(difference, b)) <= FLIPS),
    )


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = 0.8, key: str = "doc_id",
    text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document and item of similarity ``threshold`` or more: key, item key, similarity.

    The similarity is that of the document's best window; a document with fewer shingles than
    the item is one window. Items under five words are found where a document has the same run
    of words; empty and null texts, and those without a word, match nothing. Rows of ``docs`` or ``items`` with the same key (null is one too) give one
    row, the best; other columns are left out, so none can clash; empty tables give no row.

    The items' tables are written first, so Spark knows their size when it plans the joins and
    broadcasts them only if they are small.
    """
    return _matches(docs, items, threshold, [key], text, item_key, item_text).groupBy(
        key, item_key
    ).agg(F.max("similarity").alias("similarity"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = 0.8, text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; see ``contaminated``."""
    row = free_name(docs, "_row")
    found = _matches(docs, items, threshold, [], text, "item_id", "text").select(
        F.col("_row").alias(row)
    ).distinct()
    return docs.withColumn(row, row_key(text)).join(found, row, "left_anti").select(docs.columns)


def _matches(docs, items, threshold, keys, text, item_key, item_text) -> DataFrame:
    """Windows similar to an item: the keys, a key of the text (_row), item key, similarity."""
    known = stage(
        items.select(F.col(item_key).alias("item"), shingles(item_text).alias("h"))
        .where(F.size("h") > 0).distinct()
        .select(
            "item", "h", F.size("h").alias("n"), fingerprints("h").alias("prints"),
            multiset("h").alias("item_set"), F.xxhash64("h").alias("copy"),
        ),
        "decontaminate-items",
    )
    starts = stage(
        known.select(F.explode("h").alias("x"), "n").distinct(), "decontaminate-shingles"
    )
    index = stage(
        known.dropDuplicates(["copy"])
        .select("n", F.inline("prints").alias("print", "item_bits"), "copy")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
        .withColumn("flip", F.explode(F.array(*map(F.lit, _flips()))))
        .select(
            "n", "print", "block", "item_bits", "copy",
            _block(F.col("item_bits"), F.col("block")).bitwiseXOR(F.col("flip")).alias("value"),
        ),
        "decontaminate-index",
    )
    rows = docs.select(*keys, F.col(text).alias("_text"), row_key(text).alias("_row"))
    # Texts that share a shingle with an item; only these are looked at further.
    shared = stage(
        rows.select("_row", F.explode(shingles("_text")).alias("x"))
        .join(starts.select("x").distinct(), "x", "left_semi").select("_row").distinct(),
        "decontaminate-rows",
    )
    near = stage(
        rows.select("_row", "_text").join(shared, "_row", "left_semi").dropDuplicates(["_row"])
        .select("_row", shingles("_text").alias("h")),
        "decontaminate-texts",
    )
    at = (
        near.select("_row", F.posexplode("h").alias("at", "x")).join(starts, "x")
        .groupBy("_row").agg(F.collect_set(F.struct("at", "n")).alias("starts"))
    )
    windows = (
        near.join(at, "_row")
        # One start after the other, so that a row never holds more than one window.
        .select("_row", "h", F.explode("starts").alias("s"))
        .select("_row", "s.n", F.expr("slice(h, s.at + 1, s.n)").alias("h"))
        # Similarity cannot reach the threshold if the text ends too early.
        .where(F.size("h") >= threshold * F.col("n"))
        .select("_row", "n", F.element_at("h", 1).alias("x"), fingerprints("h").alias("prints"),
                multiset("h").alias("set"))
        .select("_row", "n", "x", "set", F.inline("prints").alias("print", "bits"))
    )
    difference = F.col("bits").bitwiseXOR(F.col("item_bits"))
    candidates = (
        windows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
        .withColumn("value", _block(F.col("bits"), F.col("block")))
        .join(index, ["n", "print", "block", "value"])
        .where((F.bit_count(difference) <= RADIUS) & ~_found_before(F.col("block"), difference))
        .select("_row", "copy", "set", "x")
    )
    both = F.size(F.array_intersect("set", "item_set"))
    similar = (
        candidates.join(known.select("copy", "item", "item_set"), "copy")
        .where(F.array_contains("item_set", F.col("x")))
        .select("_row", "item", (both / (F.size("set") + F.size("item_set") - both)).alias("similarity"))
        .where(F.col("similarity") >= threshold)
        .groupBy("_row", F.col("item").alias(item_key)).agg(F.max("similarity").alias("similarity"))
    )
    similar = similar.unionByName(_same_runs(rows, items, item_key, item_text))
    if not keys:
        return similar
    return rows.select(*keys, "_row").join(similar, "_row")


def _same_runs(rows: DataFrame, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """Rows that hold an item of fewer than five words: a key of the text, item key, 1."""
    named = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("item_words"))
    few = named.where(word_count("item_words").between(1, WORDS - 1))
    lengths = sorted(r[0] for r in few.select(word_count("item_words")).distinct().collect())
    if not lengths:  # at most four
        return rows.sparkSession.createDataFrame(
            [], "_row struct<a: bigint, b: int>, item long, similarity double"
        ).select("_row", F.col("item").cast(named.schema["item"].dataType).alias(item_key), "similarity")
    runs = [
        few.where(word_count("item_words") == n).select(
            "item", F.explode(short_runs("item_words", [n])).alias("x"))
        for n in lengths
    ]
    known = stage(reduce(DataFrame.unionByName, runs).distinct(), "decontaminate-short")
    return (
        rows.select("_row", F.explode(short_runs("_text", lengths)).alias("x"))
        .join(known, "x").select("_row", F.col("item").alias(item_key), F.lit(1.0).alias("similarity"))
        .distinct()
    )
