"""Exact duplicates by two passes of a Bloom filter; native.

A text stands for its SHA-256. The first pass sets the bits of every text's hash in a filter of
64-bit words, counting how many rows hit each bit (combined before the shuffle, so a text with
any number of copies is one entry a task); the bits hit twice or more are the filter of possibly
repeated hashes. The second pass looks up each row's bits there. Rows with a bit that nobody else
has hit are alone in their group and pass straight through; only the others are grouped by their
digest. A bit hit by different texts just sends some single rows along: the groups are formed on
digests, so results are exact whatever the filter says.

The filter has four rows' worth of bits a word (16 bits a row), so its density and the share of
rows sent along (some 2 %) are the same at every size. Only words with a twice-hit bit are stored.
They are broadcast when a count proves them to be few (``FILTER_ROWS``); beyond it, rows and words
meet by a shuffle of digests, not of texts, with the words of often repeated texts set apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from recurra.session import stage

#: Rows a 64-bit word of the filter.
ROWS_A_WORD = 4
#: Rows (of 16 bytes of filter, or some 50 of a group) up to which a written table is broadcast.
FILTER_ROWS = 2_000_000
GROUP_ROWS = 500_000
#: A key with more than one part in so many of all rows is set apart; no more keys than that are.
HOT_PARTS = 10_000


def digest(text: Column, normalise: Callable[[Column], Column] | None = None) -> Column:
    """SHA-256 (binary) of a text as ``normalise`` leaves it; null counts as empty."""
    given = F.coalesce(text, F.lit(""))
    normal = F.coalesce(normalise(given), F.lit("")) if normalise else given
    return F.unhex(F.sha2(normal, 256))


def _place(sha: Column, words: int) -> tuple[Column, Column, Column]:
    """The word of a digest and its two bits there."""
    h = F.xxhash64(sha)
    return (
        F.pmod(h, F.lit(words)),
        F.shiftrightunsigned(h, 52).bitwiseAND(F.lit(63)).cast("int"),
        F.shiftrightunsigned(h, 58).bitwiseAND(F.lit(63)).cast("int"),
    )


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def repeated_filter(digests: DataFrame, words: int) -> DataFrame:
    """First pass over a column ``sha``: (word, bits, size) of the bits hit by two rows or more.

    ``size`` is the number of hits of the word's most hit bit.
    """
    word, one, other = _place(F.col("sha"), words)
    hits = digests.select(
        word.alias("word"), F.explode(F.array_distinct(F.array(one, other))).alias("bit")
    )
    twice = hits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("hits")).where("hits > 1")
    return twice.groupBy("word").agg(
        F.bit_or(_mask(F.col("bit"))).alias("bits"), F.max("hits").alias("size")
    )


def look_up(rows: DataFrame, table: DataFrame, key: str, total: int, bound: int) -> DataFrame:
    """Left join of ``rows`` with a written ``table`` unique on ``key``, without hot tasks.

    A table of at most ``bound`` rows is broadcast. Of a larger one, the keys whose ``size``
    exceeds one part in ``HOT_PARTS`` of all rows are broadcast (no more of them than twice that
    many) and the rest takes a shuffle join with the rows that found nothing.
    """
    if table.count() <= bound:
        return rows.join(F.broadcast(table), key, "left")
    hot = F.col("size") > max(1, total // HOT_PARTS)
    met = rows.join(F.broadcast(table.where(hot)), key, "left")
    rest = met.where(F.col("size").isNull()).select(*rows.columns)
    return met.where(F.col("size").isNotNull()).unionByName(
        rest.join(table.where(~hot), key, "left")
    )


def flag_repeated(rows: DataFrame, total: int, bound: int = FILTER_ROWS) -> DataFrame:
    """Both passes: ``rows`` (which have a column ``sha``) with ``maybe``, which is false only
    where no other row has the digest."""
    words = max(1, -(-total // ROWS_A_WORD))
    again = stage(repeated_filter(rows.select("sha"), words), "repeated")
    word, one, other = _place(F.col("sha"), words)
    wanted = _mask(one).bitwiseOR(_mask(other))
    placed = rows.withColumn("word", word)
    return look_up(placed, again, "word", total, bound).select(
        *rows.columns,
        F.coalesce(F.col("bits").bitwiseAND(wanted) == wanted, F.lit(False)).alias("maybe"),
    )


def _grouped(flagged: DataFrame, total: int, bound: int) -> DataFrame:
    """Possibly repeated rows with the ``keep`` and ``size`` of their group; only they shuffle."""
    maybe = flagged.where("maybe")
    groups = maybe.groupBy("sha").agg(
        F.max("id").alias("keep"), F.count(F.lit(1)).alias("size")
    )
    repeated = stage(groups.where("size > 1"), "groups")
    return look_up(maybe, repeated, "sha", total, bound)


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    filter_rows: int = FILTER_ROWS, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Rows are in one group if their texts are identical (after ``normalise``, if given); a null
    text counts as empty, so all empty texts are one group. ``keep_id`` is the largest key of the
    group, null if all its keys are null, and the rows that bear it are kept: rows alike in key
    and text are all marked, as nothing tells them apart (``keep_one`` leaves one of them). Other
    columns are left out, so none can clash; an empty table gives none.
    """
    rows = stage(
        docs.select(F.col(key).alias("id"), digest(F.col(text), normalise).alias("sha")), "digests"
    )
    total = rows.count()
    flagged = flag_repeated(rows, total, filter_rows)
    alone = flagged.where("NOT maybe").withColumns({
        "keep": F.col("id"), "size": F.lit(1).cast("long"),
    })
    found = _grouped(flagged, total, group_rows).withColumns({
        "keep": F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep")),
        "size": F.coalesce("size", F.lit(1)),
    })
    return alone.unionByName(found.select(alone.columns)).select(
        F.col("id").alias(key),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    filter_rows: int = FILTER_ROWS, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that with the largest key.

    Rows keep all their columns; those with a text of their own never shuffle. Of rows alike in
    key and text any one stays. Nulls as in ``exact_groups``.
    """
    rows = docs.select(
        F.col(key).alias("id"), digest(F.col(text), normalise).alias("sha"),
        F.struct(*[F.col(c) for c in docs.columns]).alias("whole"),
    )
    total = docs.count()
    flagged = flag_repeated(rows, total, filter_rows)
    found = _grouped(flagged, total, group_rows).where(
        F.col("size").isNull() | F.col("id").eqNullSafe(F.col("keep"))
    )
    # One row a group, but for rows alike in key and text.
    single = found.where(F.col("size").isNull()).select("whole")
    repeated = found.where(F.col("size").isNotNull()).groupBy("sha").agg(
        F.first("whole").alias("whole")
    ).select("whole")
    alone = flagged.where("NOT maybe").select("whole")
    return alone.unionByName(single).unionByName(repeated).select("whole.*")
