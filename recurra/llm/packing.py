"""Token ids packed into rows of fixed length, as binary id matrices.

Texts are encoded, cut into pieces of at most one row without losing a token, and the pieces
are dealt to shards by a hash. Each shard packs its pieces by best fit decreasing: the longest
piece first, each into the row with the least room that still takes it. The row is found in a
segment tree over the amounts of room, whose leaves hold the rows with that much room left.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import free_name, map_batches, texts_of
from recurra.llm.pieces import text_ids, vocabulary

#: Bytes of text that go to one shard, about; a shard is packed in one task.
SHARD_BYTES = 16 * 2**20
#: What a row costs besides its text, in the same measure.
ROW_BYTES = 64
POSITION = np.dtype("<u4")


class RoomTree:
    """Rows by the room they have left, with search for the least room that is enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        at = room + self.size
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """A row with the least room of at least ``length``, and that room."""
        at = length + self.size
        while not self.any[at]:
            while at & 1:  # a right child: what lies further right hangs higher up
                at >>= 1
            if at == 0:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        room = at - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.any[at] = 0
            while at > 1 and not (self.any[at] or self.any[at ^ 1]):
                at >>= 1
                self.any[at] = 0
        return row, room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The row of each piece; the longest goes first, equal ones in the given order."""
    tree, rows, count = RoomTree(capacity), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            found, count = (count, capacity), count + 1
        row, room = found
        rows[i] = row
        if room > lengths[i]:
            tree.put(row, room - lengths[i])
    return rows


def encode_pieces(
    docs: DataFrame, model: str, capacity: int, key: str = "doc_id", text: str = "text",
    place: str | None = None,
) -> DataFrame:
    """Per piece of a row: key, piece (number from 0), last (boolean), n_tokens, ids (binary).

    ``place`` names a column of numbers that is to come along.

    Ids are little-endian unsigned integers of a sentencepiece model at path ``model``, 16 bits
    wide where its vocabulary allows, else 32.
    A text over ``capacity`` tokens is cut into full pieces and a rest, so pieces in order give
    all its tokens. An empty or null text gives one piece without tokens.
    """
    kind = docs.schema[key].dataType.simpleString()

    def cut(batch):
        coder = text_ids(model)
        size = coder.vocabulary.id_type.itemsize
        out = {"at": [], "piece": [], "last": [], "n_tokens": [], "ids": []}
        for i, ids in enumerate(coder.encode(texts_of(batch, text))):
            starts = range(0, max(1, len(ids)), size * capacity)
            for n, at in enumerate(starts):
                part = ids[at : at + size * capacity]
                out["at"].append(i)
                out["piece"].append(n)
                out["last"].append(n == len(starts) - 1)
                out["n_tokens"].append(len(part) // size)
                out["ids"].append(part)
        at = pa.array(out.pop("at"), pa.int64())
        return out | {c: batch.column(c).take(at) for c in (key, place) if c}

    schema = f"`{key}` {kind}, piece long, last boolean, n_tokens int, ids binary"
    if place:
        schema += f", `{place}` long"
    return map_batches(docs.select(*filter(None, (key, text, place))), schema, cut)


def pack(
    docs: DataFrame, model: str, capacity: int = 2048, key: str = "doc_id", text: str = "text",
    pad: int = 0, shards: int | None = None,
) -> DataFrame:
    """Packed rows: shard, row, keys, pieces, n_tokens, ids, cu_seqlens, positions.

    ``ids`` is a matrix row of ``capacity`` ids as in ``encode_pieces``, filled up with ``pad``; ``cu_seqlens`` starts with 0 and ends
    with the number of tokens, a step per piece; ``positions`` starts from 0 at each piece, as
    little-endian unsigned 32-bit integers. ``keys`` and ``pieces`` name the piece in each step. Pieces without tokens
    (of empty or null texts) are packed too and take no room, so every row of ``docs`` is in
    some packed row. Repeated rows are packed each; null keys are kept; other columns are left
    out. Pieces of one text may lie in different shards: pieces are dealt by a hash of their key,
    number and ids and of the row's place in the table, so neither a very long text nor any number
    of rows alike makes a shard large.
    """
    kind = docs.schema[key].dataType.simpleString()
    if shards is None:
        size, count = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
        shards = max(1, math.ceil(((size or 0) + ROW_BYTES * count) / SHARD_BYTES))
    width = vocabulary(model).id_type
    place = free_name(docs.select(key), "place")
    # The same however often a lost task reads its part of the table again.
    placed = docs.select(key, text, F.monotonically_increasing_id().alias(place))
    names = [key, "piece", place]
    pieces = encode_pieces(placed, model, capacity, key, text, place).withColumn(
        "shard", F.pmod(F.xxhash64(*names, "ids"), F.lit(shards))
    )

    def pack_shard(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["n_tokens", *names], ascending=[False, True, True, True], kind="stable"
        ).reset_index(drop=True)
        rows = np.array(best_fit_decreasing(frame["n_tokens"].tolist(), capacity))
        order = np.argsort(rows, kind="stable")
        bounds = np.flatnonzero(np.diff(rows[order], prepend=-1, append=-1))
        lengths, ids = frame["n_tokens"].to_numpy(), frame["ids"].tolist()
        keys, numbers = frame[key].tolist(), frame["piece"].tolist()
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = order[a:b]
            ends = np.concatenate([[0], lengths[own].cumsum()])
            matrix, positions = np.full(capacity, pad, width), np.zeros(capacity, POSITION)
            matrix[: ends[-1]] = np.frombuffer(b"".join(ids[i] for i in own), width)
            positions[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], lengths[own])
            out.append({
                "shard": int(frame["shard"][0]), "row": int(rows[own[0]]),
                "keys": [None if pd.isna(keys[i]) else keys[i] for i in own],
                "pieces": [numbers[i] for i in own],
                "n_tokens": int(ends[-1]), "ids": matrix.tobytes(),
                "cu_seqlens": ends.tolist(), "positions": positions.tobytes(),
            })
        return pd.DataFrame(out)

    schema = (
        f"shard long, `row` long, `keys` array<{kind}>, pieces array<long>, n_tokens long, "
        "ids binary, cu_seqlens array<int>, positions binary"
    )
    return pieces.groupBy("shard").applyInPandas(pack_shard, schema)
