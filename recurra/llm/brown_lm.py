"""Language-model scores by class-based bigrams (Brown et al.).

A word's probability is that of its class after the class of the word before it, times that of
the word within its class. Words are counted in Spark. All that occur twice or more get numbers;
texts are rewritten as lists of numbers, for the ``HEAD`` most frequent words by a dictionary and
for those beyond by a join. Words that occur once or never form one open class, whose share is
counted like any other's, in which known words have their counts and unseen ones the mass that
Good and Turing's rule gives them.

The ``EXCHANGED`` most frequent words are clustered by exchange: starting from classes by rank,
each word moves to the class that raises the likelihood of the class bigrams most, until few
move. Spark sums each word's neighbours by class in every round; the driver sees one row per
word and class. ``EXCHANGED`` and ``CLASSES`` hold up to ``HEAD`` words and grow beyond, with the
square and the cube root of their number, so driver and tasks hold those squares and some bytes a
numbered word (class and count). Words not clustered yet count as neighbours in the open class.

Then all numbered words are exchanged in tasks, each given the classes of its neighbours and all
at once, until few move or its logarithm no longer rises by ``LEAST`` a token.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import map_batches, small, texts_of
from recurra.operators.numbering import number_rows
from recurra.session import stage

#: Words that tasks hold in a dictionary, and for so many words the clustered ones and classes.
HEAD, EXCHANGED, CLASSES = 200_000, 4096, 64
ROUNDS, LEAST = 6, 0.01
CELLS = 1 << 16  # counts of neighbours by class that are summed and exchanged in one group
END = 0  # the number of the end of a text, and its class


def tokens(text: str) -> list[bytes]:
    """Runs of what is no ASCII white space, with A-Z in lower case, as UTF-8."""
    return text.encode().lower().split()


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """Rows (word, c) over all texts; what a task counted is summed in a shuffle."""

    def count(batch):
        seen: Counter[bytes] = Counter()
        for t in texts_of(batch, text):
            seen.update(tokens(t))
        return {"word": list(seen), "c": list(seen.values())}

    counted = map_batches(texts.select(text), "word binary, c long", count, rows=10_000)
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


class _Numbers(dict):
    """Words by their place, from 1 on."""

    def __init__(self, words: list[bytes]):
        super().__init__((w, i + 1) for i, w in enumerate(words))


#: Numbers of a text as bytes, the lower and the higher 16 bits apart: the higher ones are mostly
#: zeros, which compress away, and Spark moves bytes without looking at each number.
PACKED = "struct<low: binary, high: binary>"


def _packed(numbers: np.ndarray, sizes: np.ndarray) -> pa.StructArray:
    """``numbers``, in runs of these sizes, as ``PACKED``."""
    offsets = pa.py_buffer(np.concatenate([[0], 2 * sizes.cumsum()]).astype(np.int32))
    planes = (numbers.astype("<u2"), (numbers >> 16).astype("<u2"))
    return pa.StructArray.from_arrays([
        pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets, pa.py_buffer(x.tobytes())])
        for x in planes
    ], names=["low", "high"])


def _halves(column: pa.Array) -> np.ndarray:
    """The 16-bit numbers of all rows of a column of bytes, one after the other, not copied."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, "<u2")
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    first, last = np.frombuffer(offsets, kind)[[column.offset, column.offset + len(column)]]
    return np.frombuffer(data, "<u2", (last - first) // 2, first)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a batch in a row, and how many each text has; they come as lists or packed."""
    if not pa.types.is_struct(column.type):
        return column.flatten().to_numpy(zero_copy_only=False), _lengths(column)
    low, high = (_halves(column.field(x)) for x in ("low", "high"))
    numbers = low.astype(np.int32) | (high.astype(np.int32) << 16)
    return numbers, pc.binary_length(column.field("low")).to_numpy().astype(np.int64) // 2


def _lengths(column: pa.Array) -> np.ndarray:
    return column.value_lengths().fill_null(0).to_numpy().astype(np.int64)


def _numbered(docs: DataFrame, words, key: str, text: str, packed: bool = False) -> DataFrame:
    """Rows (row, key, held_out, ids, tail): each text's numbers, the end last, and its words
    without a number in order."""
    kind = docs.schema[key].dataType.simpleString()
    lists = _packed if packed else _lists

    def number(batch):
        known = words.value
        other = len(known) + 1
        own = [tokens(t) for t in texts_of(batch, text)]
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        flat = list(chain.from_iterable(own))
        numbers = np.fromiter(map(known.get, flat, repeat(other)), np.int32, len(flat))
        unknown = numbers == other
        return {
            "key": batch.column(key), "held_out": batch.column("held_out"),
            "ids": lists(np.insert(numbers, sizes.cumsum(), END), sizes + 1),
            "tail": _lists(pa.array(compress(flat, unknown), pa.binary()), _sums(unknown, sizes)),
        }

    made = map_batches(
        docs.select(key, "held_out", text),
        f"key {kind}, held_out boolean, ids {PACKED if packed else 'array<int>'},"
        " tail array<binary>", number,
    )
    return made.withColumn("row", F.monotonically_increasing_id())


def _lists(flat: np.ndarray | pa.Array, sizes: np.ndarray) -> pa.Array:
    """Lists of these sizes, one after the other."""
    offsets = np.concatenate([[0], sizes.cumsum()]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _sums(marks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many marks are set in each of the runs of these sizes."""
    total = np.concatenate([[0], marks.cumsum()])
    ends = sizes.cumsum()
    return total[ends] - total[ends - sizes]


def _rest(vocabulary: DataFrame, last: int, word: bytes, first: int) -> DataFrame:
    """Rows (number, word, c) of the words seen twice or more that come after ``word``, which is
    seen ``last`` times, numbered from ``first`` on in the order of the others."""
    after = (F.col("c") < last) | ((F.col("c") == last) & (F.col("word") > F.lit(word)))
    rest = vocabulary.where("c > 1").where(after).select((-F.col("c")).alias("less"), "word", "c")
    return number_rows(rest, ["less", "word"], "number", first).drop("less")


def _numbered_on(numbered: DataFrame, rest: DataFrame, other: int, now_other: int) -> DataFrame:
    """``numbered`` (packed), where ``other`` stood for all words of the tails, with the numbers
    that ``rest`` has for some of them; ``now_other`` stands for those left. The words left are
    named where they are held out; elsewhere nulls tell how many there are."""
    found = (
        numbered.select("row", F.posexplode("tail").alias("at", "word"))
        .join(small(rest.select("word", F.col("number").cast("int"))), "word").groupBy("row")
        .agg(F.collect_list(F.struct("at", "number")).alias("found"))
    )
    unnamed = F.array_repeat(F.lit(None).cast("binary"), F.size("tail"))
    sent = numbered.withColumn("tail", F.when(F.col("held_out"), F.col("tail")).otherwise(unnamed))
    both = sent.join(found, "row", "left")

    def number(batch):
        tail, known = (batch.column(c) for c in ("tail", "found"))
        ids, in_ids = _ids(batch.column("ids"))
        in_tail, in_known = _lengths(tail), _lengths(known)
        # Tails in a row have the words that ``other`` stands for in the numbers in a row.
        at, given = (x.to_numpy(zero_copy_only=False) for x in known.flatten().flatten())
        numbers = np.full(in_tail.sum(), now_other, np.int32)
        numbers[np.repeat(in_tail.cumsum() - in_tail, in_known) + at] = given
        ids[ids == other] = numbers
        left = numbers == now_other
        return {c: batch.column(c) for c in ("row", "key", "held_out")} | {
            "ids": _packed(ids, in_ids),
            "tail": _lists(tail.flatten().filter(pa.array(left)), _sums(left, in_tail)),
        }

    kind = numbered.schema["key"].dataType.simpleString()
    return map_batches(
        both, f"key {kind}, held_out boolean, ids {PACKED}, tail array<binary>, `row` long", number
    )


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a batch in a row, and the number before each (the end before a text)."""
    ids, _ = _ids(batch.column("ids"))
    return ids, np.concatenate([[END], ids[:-1]])


def _summed(df: DataFrame, size: int, cells) -> DataFrame:
    """Rows (cell, n): counts of the cells that ``cells`` gives for a batch, alone or with how
    often each counts, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                found = cells(batch)
                if isinstance(found, tuple):
                    np.add.at(total, *found)
                else:
                    total += np.bincount(found, minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": at, "n": total[at]})

    return df.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def _array(df: DataFrame, size: int) -> np.ndarray:
    found = df.toArrow()
    out = np.zeros(size)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out


def _short(n: np.ndarray) -> np.ndarray:
    """Counts in the fewest bytes that hold each."""
    return n.astype(np.min_scalar_type(int(n.max())))


#: Cells of a block and their counts, as bytes.
BLOCKS = "block long, cells binary, n binary"


def _blocks(cell: np.ndarray, n: np.ndarray, size: int) -> pa.RecordBatch:
    """Counts of cells in rising order as a row for each block of ``size`` cells, which takes a
    small part of a row per cell."""
    block, cell = cell // size, (cell % size).astype(np.min_scalar_type(size - 1))
    at = [*np.flatnonzero(np.diff(block, prepend=-1)), len(block)]
    parts = [(cell[i:j].tobytes(), _short(n[i:j]).tobytes()) for i, j in zip(at, at[1:])]
    return pa.RecordBatch.from_pydict({
        "block": block[at[:-1]].astype(np.int64),
        "cells": pa.array([x for x, _ in parts], pa.binary()),
        "n": pa.array([x for _, x in parts], pa.binary()),
    })


def _block_sums(block: pd.DataFrame, size: int) -> np.ndarray:
    """The counts of all cells of a block, over its rows."""
    place = np.min_scalar_type(size - 1)
    total = np.zeros(size)
    for cells, n in zip(block["cells"], block["n"]):
        cells = np.frombuffer(cells, place)
        total[cells] += np.frombuffer(n, f"u{len(n) // len(cells)}")
    return total


def _bigrams(numbered: DataFrame, limit: int) -> DataFrame:
    """Rows (a, b, n) of neighbours of which one is below ``limit``; it stands for all others."""
    width = limit + 1
    size = max(1, CELLS // width) * width

    def pairs(batch):
        now, before = _flat(batch)
        near = (now < limit) | (before < limit)
        now, before = (np.minimum(x[near], limit).astype(np.int64) for x in (now, before))
        found = _blocks(*np.unique(before * width + now, return_counts=True), size)
        return {c: found.column(c) for c in found.schema.names}

    def total(block: pd.DataFrame) -> pd.DataFrame:
        n = _block_sums(block, size)
        at = np.flatnonzero(n)
        a, b = np.divmod(at + block["block"].iloc[0] * size, width)
        return pd.DataFrame({
            "a": a.astype(np.int32), "b": b.astype(np.int32), "n": n[at].astype(np.int64)
        })

    made = map_batches(numbered.select("ids"), BLOCKS, pairs, rows=10_000)
    return made.groupBy("block").applyInPandas(total, "a int, b int, n long")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_class(
    before: np.ndarray, after: np.ndarray, table: np.ndarray, rows: np.ndarray, columns: np.ndarray
) -> int:
    """The class (but that of the end and the last, the open one) that a word without a class
    raises the likelihood most in.

    ``before`` and ``after`` count the word's neighbours by class; ``table`` are the bigrams of
    classes without the word, ``rows`` and ``columns`` its sums.
    """
    gain = (
        (_xlogx(table + before[:, None]) - _xlogx(table)).sum(axis=0)
        + (_xlogx(table + after[None, :]) - _xlogx(table)).sum(axis=1)
        - (_xlogx(columns + before.sum()) - _xlogx(columns))
        - (_xlogx(rows + after.sum()) - _xlogx(rows))
    )
    return int(np.argmax(gain[1:-1])) + 1


def likely_classes(before: np.ndarray, after: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class (but that of the end and the last, the open one) of each word that makes its
    neighbours likeliest.

    That is ``best_class`` to the first order: many words may move at once, and none gains by
    having a class to itself, for all of them would go there.
    """

    def within(table: np.ndarray) -> np.ndarray:  # of the neighbour's class, by the word's class
        share = (table.sum(axis=1, keepdims=True) + 1) / (table.sum() + len(table))
        return np.log((table + len(table) * share) / (table.sum(axis=0) + len(table)))

    gain = before @ within(table) + after @ within(table.T)
    return np.argmax(gain[:, 1:-1], axis=1) + 1


def likelihood(table: np.ndarray) -> float:
    """The logarithm of the class bigrams' and the words' likelihood, but for a constant."""
    sums = _xlogx(table.sum(axis=0)).sum() + _xlogx(table.sum(axis=1)).sum()
    return float(_xlogx(table).sum() - sums)


def _by_class(home: np.ndarray, width: int):
    """From rows (a, b, n) the cells (side, word, class of its neighbour) of the words but the
    last, and n for each: a is before b, and b after a. The classes are fewer than ``width``."""
    words = len(home) - 1

    def cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        a, b, n = (batch.column(c).to_numpy() for c in ("a", "b", "n"))
        own_a, own_b = a < words, b < words
        return np.concatenate([
            b[own_b].astype(np.int64) * width + home[a[own_b]],
            (words + a[own_a].astype(np.int64)) * width + home[b[own_a]],
        ]), np.concatenate([n[own_b], n[own_a]])

    return cells


def exchange(bigrams: DataFrame, words: int, classes: int, rounds: int) -> np.ndarray:
    """Classes of the numbers below ``words``; class 0 holds the end of a text alone, and
    ``classes`` is the open class, which all other numbers stay in."""
    home = np.zeros(words, np.int64)
    home[1:] = 1 + np.arange(words - 1) % (classes - 1)
    width = classes + 1
    for _ in range(rounds):
        before, after = _array(
            _summed(bigrams, 2 * words * width, _by_class(np.append(home, classes), width)),
            2 * words * width,
        ).reshape(2, words, width)
        table = np.zeros((classes + 1, classes + 1))
        np.add.at(table, home, after)
        np.add.at(table[classes], home, before[:, classes])
        moved = 0
        for w in range(1, words):
            l, r, k = before[w], after[w], home[w]
            table[:, k] = np.maximum(0, table[:, k] - l)
            table[k, :] = np.maximum(0, table[k, :] - r)
            to = best_class(l, r, table, table.sum(axis=1), table.sum(axis=0))
            table[:, to] += l
            table[to, :] += r
            moved += to != k
            home[w] = to
        if moved < words / 200:
            break
    return home


def _exchange_all(
    training: DataFrame, home: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The numbered words (the last number stands for others), and the likeliest class of each
    while the others stay."""
    head = len(home) - 1
    classes = len(table)
    width = 2 * classes
    dense = min(head, EXCHANGED) * width  # cells of the words that are in most batches

    block_words = max(1, CELLS // width)
    size = block_words * width

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dense, np.int64)
        for batch in batches:
            now, before = _flat(batch)
            a, b = (now > END) & (now < head), (before > END) & (before < head)
            cell = np.concatenate([
                now[a].astype(np.int64) * width + home[before[a]],
                before[b].astype(np.int64) * width + classes + home[now[b]],
            ])
            few = cell >= dense
            total += np.bincount(cell[~few], minlength=dense)
            yield _blocks(*np.unique(cell[few], return_counts=True), size)
        at = np.flatnonzero(total)
        yield _blocks(at, total[at], size)

    def choose(block: pd.DataFrame) -> pd.DataFrame:
        near = _block_sums(block, size).reshape(block_words, width)
        words = np.flatnonzero(near.any(axis=1))
        best = likely_classes(near[words, :classes], near[words, classes:], table)
        return pd.DataFrame({"w": words + block["block"].iloc[0] * block_words, "k": best})

    blocks = training.select("ids").mapInArrow(
        neighbours, BLOCKS
    ).groupBy("block")
    found = blocks.applyInPandas(choose, "w long, k int").toArrow()
    return found["w"].to_numpy(), found["k"].to_numpy()


@dataclass(frozen=True)
class BrownModel:
    """Logarithms to the base of ten, by number (the last for all other words) and by class."""

    home: np.ndarray
    step: np.ndarray
    emission: np.ndarray
    count: np.ndarray
    tail_count: float
    unseen: float
    unseen_words: float
    total: int
    distinct: int


def sizes(words: int) -> tuple[int, int]:
    """How many words are clustered by exchange, and the classes, for so many numbered words."""
    more = max(1.0, words / HEAD)
    return round(EXCHANGED * more ** (1 / 2)), round(CLASSES * more ** (1 / 3))


def fit(
    numbered: DataFrame, vocabulary: DataFrame, counts: Sequence[int] | np.ndarray, ends: int,
    exchanged: int | None = None, classes: int | None = None, rounds: int = ROUNDS,
) -> BrownModel:
    """The model of the rows of ``numbered`` that are not held out."""
    training = numbered.where("NOT held_out")
    head = len(counts) + 1  # with the end
    usual_exchanged, usual_classes = sizes(len(counts))
    exchanged, classes = exchanged or usual_exchanged, classes or usual_classes
    limit = min(exchanged, head)
    classes = max(2, min(classes, limit // 4))
    total, distinct, once, twice = vocabulary.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)),
        F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1)),
    ).first()
    bigrams = stage(_bigrams(training, limit), "lm-bigrams")
    home = np.full(head + 1, classes, np.int16)  # the open class is the last
    home[:limit] = exchange(bigrams, limit, classes, rounds)
    table = _class_table(training, home, classes + 1)
    for done in range(rounds if head > limit else 0):
        numbers, found = _exchange_all(training, home, table)
        after = home.copy()
        after[numbers] = found
        moved = int((after != home).sum())
        if not moved:
            break
        table_after = _class_table(training, after, classes + 1)
        gained = likelihood(table_after) - likelihood(table)
        if done and gained <= 0:
            break
        home, table = after, table_after
        if moved < head / 200 or done and gained < LEAST * table.sum():
            break
    count = np.array([ends, *counts, 0], float)
    by_class = np.bincount(home[:-1], weights=count[:-1], minlength=classes + 1)
    used = by_class > 0  # a class that all words left has no share
    used[[0, classes]] = True
    share = (table.sum(axis=0) + 1) * used / (table.sum() + used.sum())
    step = (table + classes * share) / (table.sum(axis=1, keepdims=True) + classes)
    step = np.log10(np.maximum(step, 1e-300))
    emission = np.zeros(head + 1)
    emission[1:head] = np.log10(count[1:head] / by_class[home[1:head]])
    tail = total - int(np.sum(counts))
    unseen = min(0.8, max(1e-6, once / (tail + 1))) if tail else 1.0
    words = max(1.0, once * (once - 1) / (2 * (twice + 1)))
    known_ends = 1 if ends else 0
    return BrownModel(
        home, step, emission, count, float(tail), unseen, words, total + ends,
        distinct + known_ends,
    )


def _class_table(numbered: DataFrame, home: np.ndarray, classes: int) -> np.ndarray:
    def cells(batch):
        now, before = _flat(batch)
        return home[before].astype(np.int64) * classes + home[now]

    size = classes * classes
    return _array(_summed(numbered.select("ids"), size, cells), size).reshape(classes, classes)


def score(
    docs: DataFrame, key: str = "doc_id", text: str = "text", head: int = HEAD, **fitting
) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Rows whose CRC-32 of the key modulo 7 is 2 are held out, the others are learnt from. A null
    text counts as empty and has one token, its end. Null keys are learnt from; repeated rows
    are learnt from and scored each; other columns are left out, so none can clash; an empty
    table gives none, and if all rows are held out every word is unseen.
    """
    spark = docs.sparkSession
    chosen = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    source = docs.select(key, text).withColumn("held_out", chosen)
    vocabulary = stage(word_counts(source.where("NOT held_out"), text), "lm-words")
    most = (
        vocabulary.where("c > 1").orderBy(F.desc("c"), "word").limit(head).toArrow()
    )
    words, counts = most["word"].to_pylist(), most["c"].to_numpy()
    numbers = spark.sparkContext.broadcast(_Numbers(words))
    numbered = stage(_numbered(source, numbers, key, text, packed=True), "lm-numbered")
    numbers.destroy()
    if len(words) == head:
        rest = stage(_rest(vocabulary, int(counts[-1]), words[-1], head + 1), "lm-rest")
        more = rest.select("number", "c").toArrow()
        if more.num_rows:
            beyond = np.empty(more.num_rows, np.int64)
            beyond[more["number"].to_numpy() - head - 1] = more["c"].to_numpy()
            counts = np.concatenate([counts, beyond])
            numbered = _numbered_on(numbered, rest, head + 1, len(counts) + 1)
            numbered = stage(numbered, "lm-numbered-on")
    ends = numbered.where("NOT held_out").count()
    model = fit(numbered, vocabulary, counts, ends, **fitting)

    def per_text(batch):
        now, sizes = _ids(batch.column("ids"))
        before = np.concatenate([[END], now[:-1]])
        starts = np.concatenate([[0], sizes.cumsum()[:-1]]).astype(np.int64)
        home = model.home
        logs = model.step[home[before], home[now]] + model.emission[now]
        plain = np.where(now < len(model.home) - 1, np.log10(model.count[now] + 1), 0.0)
        return {
            "row": batch.column("row"), "key": batch.column("key"),
            "held_out": batch.column("held_out"), "singles": batch.column("singles"),
            "n_tokens": sizes,
            "known": np.add.reduceat((model.count[now] > 0).astype(np.int64), starts),
            "plain": np.add.reduceat(plain, starts), "logs": np.add.reduceat(logs, starts),
        }

    kind = numbered.schema["key"].dataType.simpleString()
    # All repeated words have a number, so another word of a row that is learnt from was seen once,
    # there; only those of the rows held out are looked up.
    singles = F.when(F.col("held_out"), 0).otherwise(F.size("tail")).cast("long")
    heads = map_batches(
        numbered.select("row", "key", "held_out", "ids", singles.alias("singles")),
        f"`row` long, key {kind}, held_out boolean, singles long, n_tokens long, known long,"
        " plain double, logs double", per_text,
    )
    tail = (
        numbered.where("held_out").select("row", F.explode("tail").alias("word"))
        .groupBy("row", "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(vocabulary, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    )
    # Without words of this kind their share is nothing, and nobody asks for it.
    once = math.log10((1 - model.unseen) / model.tail_count) if model.tail_count else 0.0
    seen = F.log10(F.col("c")) + F.lit(once)
    new = F.log10(F.lit(model.unseen / model.unseen_words))
    tails = tail.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("tail_known"),
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_plain"),
        F.sum(F.col("n") * F.when(F.col("c") > 0, seen).otherwise(new)).alias("tail_logs"),
    )
    both = heads.join(tails, "row", "left")

    def plus(a: str, b: str, single: float = 1):
        return F.col(a) + F.coalesce(F.col(b), F.lit(0)) + F.col("singles") * F.lit(single)

    each = F.lit(float(np.log10(model.total + model.distinct + 1)))
    return both.select(
        F.col("key").alias(key), "held_out", "n_tokens",
        plus("known", "tail_known").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (plus("plain", "tail_plain", math.log10(2)) - F.col("n_tokens") * each).alias("base_score"),
        plus("logs", "tail_logs", once).alias("score"),
    )
