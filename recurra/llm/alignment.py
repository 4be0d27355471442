"""Alignment of the tokens of two tokenizers over the bytes of each text.

All texts of a batch are merged in lockstep: one NumPy vector holds, per lane, where its A and
its B pointer stand; each step emits the link of the two tokens, advances the pointer whose token
ends first (both where they end together, which is a cut) and, as lanes finish, compacts the
vector. A text longer than ``LANE_TOKENS`` is dealt to several lanes, parted where tokens of both
end, so one very long text does not make the whole batch step alone.

How often an id pair is linked in the whole corpus is counted from the distinct pairs of each
text. Per text these counts are then looked up: the most frequent pairs, of a bounded number, are
held by every task as sorted arrays; the others, none of which is frequent, meet their counts by
a shuffle join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from recurra.llm.byte_bpe import byte_characters
from recurra.llm.common import map_batches, texts_of
from recurra.llm.pieces import text_ids
from recurra.session import stage

#: Tokens (of A) from which a text is dealt to several lanes.
LANE_TOKENS = 256
#: Frequent pairs (of 24 bytes) that every task holds; none of the rest can be a hot key.
HEAD_PAIRS = 500_000
#: Bytes of text merged at once, but for a text that is longer by itself.
BATCH_BYTES = 4 * 2**20
PAIR_BITS = 32
ROWS = 10_000


# Fixed value: how a byte-level pre-tokenizer with its own expression cuts a text.
CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters whose class no version of Unicode in use disagrees on: Latin to Cyrillic,
#: punctuation and currencies.
_SETTLED = re.compile("[\x00-\u0377\u0384-\u038a\u038c\u038e-\u03a1\u03a3-\u0527\u2000-\u206f\u20a0-\u20b9]*")


class TokensA:
    """A byte-level BPE of the ``tokenizers`` library at a path, over space + text.

    If the file says that each token comes from one merge, in the order of ids, and cuts texts by
    the usual expression, then merging by the rank of the merged token is the same thing: two
    neighbours that make up a token without being its merge cannot stand there once all lower
    ranks are merged. Texts of settled characters are then encoded that way, which is several
    times faster; all others go to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already share the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        size = self.library.get_vocab_size()
        tokens = [self.library.id_to_token(i) for i in range(size)]
        self.bytes = [bytes(byte_of[c] for c in t if c in byte_of) for t in tokens]
        self.by_rank = self._by_rank(json.loads(self.library.to_str()))

    def _by_rank(self, file: dict):
        model, cut, added = file["model"], file["pre_tokenizer"], file["added_tokens"]
        ids = model["vocab"]
        made = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        order = [ids.get(a + b, -1) for a, b in made]
        special = {t["id"] for t in added}
        merged, first = set(ids.values()) - special, set(order)
        plain = (
            model["type"] == "BPE" and not model["dropout"] and not file["normalizer"]
            and cut == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                        "use_regex": True}
            and all(t["special"] for t in added)
            and order == sorted(first) and len(order) == len(merged) - 256
            and all(len(self.bytes[i]) == 1 for i in merged - first)
            # A merge comes after those of its parts.
            and all(p < i for (a, b), i in zip(made, order) for p in (ids[a], ids[b]) if p in first)
        )
        if not plain:
            return None
        import tiktoken

        ranks = {self.bytes[i]: i for i in merged}
        return tiktoken.Encoding("a", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int] | None] = [None] * len(texts)
        if self.by_rank is not None:
            out = [
                self.by_rank.encode_ordinary(" " + t) if _SETTLED.fullmatch(t) else None
                for t in texts
            ]
        rest = [i for i, ids in enumerate(out) if ids is None]
        asked = [" " + texts[i] for i in rest]
        for i, made in zip(rest, self.library.encode_batch_fast(asked, add_special_tokens=False)):
            out[i] = made.ids
        return out


class TokensB:
    """A ``sentencepiece`` model at a path, which puts a space before the text itself."""

    def __init__(self, path: str):
        self.coder = text_ids(path)
        m = self.coder.vocabulary.model
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.coder.ids(texts)


class Names:
    """The decimal ids of a vocabulary with each of two separators after them."""

    def __init__(self, size: int, inside: str, after: str):
        both = [f"{i}{inside}" for i in range(size)] + [f"{i}{after}" for i in range(size)]
        self.size, self.written = size, np.array(both, object)


class Pair:
    """Two tokenizers and the alignment of texts by them."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = TokensA(path_a), TokensB(path_b)
        self.length_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.length_b = np.array([len(x) for x in self.b.bytes], np.int64)
        self.name_a = Names(len(self.length_a), ",", "|")
        self.name_b = Names(len(self.length_b), ",", ";")

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by A and B; none where the tokens are not the bytes of space+text."""
        out_a, out_b = [], []
        for text, a, b in zip(texts, self.a.encode(texts), self.b.encode(texts)):
            data = b" " + text.encode()
            whole = (
                text
                and b"".join(map(self.a.bytes.__getitem__, a)) == data
                and b"".join(map(self.b.bytes.__getitem__, b.tolist())) == data
            )
            out_a.append(np.array(a if whole else [], np.int64))
            out_b.append(b if whole else np.zeros(0, np.int64))
        return out_a, out_b

    def align(self, a: list[np.ndarray], b: list[np.ndarray]) -> "Alignment":
        return Alignment(self, a, b)


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _offsets(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def lanes_of(ends_a: np.ndarray, ends_b: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes of one text begin, as indices of A and B tokens: 0, and about every ``tokens``
    tokens of A the next place at which both have a token's end."""
    if len(ends_a) <= tokens:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    wanted = np.arange(tokens, len(ends_a), tokens)
    chosen = np.unique(np.searchsorted(at_a + 1, wanted))
    chosen = chosen[chosen < len(at_a) - 1]  # the last end is that of the text
    return (
        np.concatenate([[0], at_a[chosen] + 1]).astype(np.int64),
        np.concatenate([[0], at_b[chosen] + 1]).astype(np.int64),
    )


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, stop_a: np.ndarray,
    first_b: np.ndarray, stop_b: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of all lanes: indices of A and of B tokens and whether both end there, lane by lane.

    ``ends`` are byte offsets of token ends, in the order of the lanes; a lane merges the tokens
    ``first`` to ``stop`` of A and of B, whose last ones end together.
    """
    room = _offsets((stop_a - first_a) + (stop_b - first_b))
    link_a = np.full(room[-1], -1, np.int64)
    link_b = np.empty(room[-1], np.int64)
    cut = np.zeros(room[-1], bool)
    live = np.flatnonzero(stop_a > first_a)
    at_a, at_b, at = first_a[live], first_b[live], room[:-1][live].copy()
    stop = stop_a[live]
    while len(at):
        link_a[at], link_b[at] = at_a, at_b
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        together = end_a == end_b
        cut[at] = together
        at_a = at_a + (end_a <= end_b)
        at_b = at_b + (end_b <= end_a)
        at = at + 1
        done = together & (at_a == stop)
        if done.any():
            on = ~done
            at_a, at_b, at, stop = at_a[on], at_b[on], at[on], stop[on]
    used = link_a >= 0
    return link_a[used], link_b[used], cut[used]


class Alignment:
    """Links and groups of a batch of texts, as flat arrays in the order of the texts."""

    def __init__(self, coders: Pair, a: list[np.ndarray], b: list[np.ndarray]):
        self.coders = coders
        self.n_a, self.n_b = np.array([*map(len, a)], np.int64), np.array([*map(len, b)], np.int64)
        self.at_a, self.at_b = _offsets(self.n_a), _offsets(self.n_b)
        none = np.zeros(0, np.int64)
        self.ids_a, self.ids_b = np.concatenate([none, *a]), np.concatenate([none, *b])
        # Byte ends run on over the texts, whose bytes are the same by A and by B.
        self.ends_a = np.cumsum(coders.length_a[self.ids_a])
        self.ends_b = np.cumsum(coders.length_b[self.ids_b])
        starts_a, starts_b = [none], [none]
        for i in range(len(a)):
            x, y = slice(self.at_a[i], self.at_a[i + 1]), slice(self.at_b[i], self.at_b[i + 1])
            if x.start < x.stop:
                p, q = lanes_of(self.ends_a[x], self.ends_b[y], LANE_TOKENS)
                starts_a.append(p + x.start)
                starts_b.append(q + y.start)
        first_a, first_b = np.concatenate(starts_a), np.concatenate(starts_b)
        self.link_a, self.link_b, self.cut = lockstep(
            self.ends_a, self.ends_b, first_a, np.append(first_a[1:], self.at_a[-1])[: len(first_a)],
            first_b, np.append(first_b[1:], self.at_b[-1])[: len(first_b)],
        )
        #: Where the links of each text begin.
        self.at_link = np.searchsorted(self.link_a, self.at_a)
        self.n_links = np.diff(self.at_link)
        cuts = _offsets(self.cut)
        self.at_group = cuts[self.at_link]
        self.n_groups = np.diff(self.at_group)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of each text and how often it links them: text, pair, times."""
        text = np.repeat(np.arange(len(self.n_links)), self.n_links)
        both = (self.ids_a[self.link_a] << PAIR_BITS) | self.ids_b[self.link_b]
        order = np.lexsort((both, text))
        text, both = text[order], both[order]
        new = np.flatnonzero(
            np.concatenate([[True], (text[1:] != text[:-1]) | (both[1:] != both[:-1])])[: len(both)]
        )
        return text[new], both[new], np.diff(np.append(new, len(both)))

    def written(self) -> list[str]:
        """Each text's groups, as ``a1,a2|b1;a3|b2,b3``."""
        ends = np.flatnonzero(self.cut)
        last_a, last_b = self.link_a[ends], self.link_b[ends]
        group_a, group_b = _offsets_of(last_a), _offsets_of(last_b)
        # Tokens stand group by group, A's first.
        total = len(self.ids_a) + len(self.ids_b)
        place_a = np.arange(len(self.ids_a)) + np.repeat(group_b[:-1], np.diff(group_a))
        place_b = np.arange(len(self.ids_b)) + np.repeat(group_a[1:], np.diff(group_b))
        after_a, after_b = np.zeros(len(self.ids_a), bool), np.zeros(len(self.ids_b), bool)
        after_a[last_a], after_b[last_b] = True, True
        line = np.empty(total, object)
        a, b = self.coders.name_a, self.coders.name_b
        line[place_a] = a.written[self.ids_a + a.size * after_a]
        line[place_b] = b.written[self.ids_b + b.size * after_b]
        bounds = self.at_a + self.at_b
        return [
            "".join(line[p:q].tolist())[:-1] for p, q in zip(bounds[:-1], bounds[1:])
        ]

    def groups(self) -> list[list[dict]]:
        """Each text's groups as lists of A ids, B ids and the byte offset at which they end."""
        ends = np.flatnonzero(self.cut)
        last_a, last_b = self.link_a[ends], self.link_b[ends]
        group_a, group_b = _offsets_of(last_a), _offsets_of(last_b)
        starts = np.concatenate([[0], self.ends_a])[self.at_a]
        out = []
        for i in range(len(self.n_links)):
            own = range(self.at_group[i], self.at_group[i + 1])
            out.append([
                {
                    "a": self.ids_a[group_a[g] : group_a[g + 1]].tolist(),
                    "b": self.ids_b[group_b[g] : group_b[g + 1]].tolist(),
                    "end": int(self.ends_a[last_a[g]] - starts[i]),
                }
                for g in own
            ])
        return out


def _offsets_of(last: np.ndarray) -> np.ndarray:
    """Bounds of groups from the index of each one's last token."""
    return np.concatenate([[0], last + 1]).astype(np.int64)


# --- over a corpus --------------------------------------------------------------------------


def _parts(batch: pa.RecordBatch, text: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // size
    bounds = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield batch.slice(a, b - a)


def _aligned(path_a: str, path_b: str, batch, text: str) -> Alignment:
    coders = pair(path_a, path_b)
    return coders.align(*coders.encode(texts_of(batch, text)))


def align(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, groups (array of a: ids of A, b: ids of B, end: byte offset in space+text).

    A null or empty text, and one whose tokens by A or B are not the bytes of space+text, has no
    groups. Null keys and repeated rows give a row each; other columns are left out, so none can
    clash; an empty table gives none.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batch):
        for part in _parts(batch, text):
            made = _aligned(path_a, path_b, part, text)
            yield {key: part.column(key), "groups": made.groups()}

    schema = f"`{key}` {kind}, groups array<struct<a: array<int>, b: array<int>, end: long>>"
    return map_batches(docs.select(key, text), schema, run, ROWS)


def _encoded(docs: DataFrame, path_a: str, path_b: str, key: str, text: str) -> DataFrame:
    """Per row: id, sizes, digest of the groups, and its distinct pairs with their times."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batch):
        for part in _parts(batch, "text"):
            made = _aligned(path_a, path_b, part, "text")
            of, both, times = made.pairs()
            bounds = np.searchsorted(of, np.arange(part.num_rows + 1))
            spans = list(zip(bounds[:-1], bounds[1:]))
            yield {
                "id": part.column("id"),
                "n_a": made.n_a, "n_b": made.n_b, "n_groups": made.n_groups,
                "n_links": made.n_links,
                "groups_sha256": [
                    hashlib.sha256(w.encode()).hexdigest() if w else "" for w in made.written()
                ],
                "pairs": [both[p:q] for p, q in spans],
                "times": [times[p:q] for p, q in spans],
            }

    schema = (
        f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<long>"
    )
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    # Numbered as written, so a row keeps its number however often it is read.
    return map_batches(rows, schema, run, ROWS).withColumn(
        "row", F.monotonically_increasing_id()
    )


def pair_counts(encoded: DataFrame) -> DataFrame:
    """(pair, count, best) over all texts; best: no other A id is linked to its B id more often."""
    counted = stage(
        encoded.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
        .groupBy(F.col("x.pairs").alias("pair"))
        .agg(F.sum("x.times").alias("count")),
        "pair-counts",
    )
    b = F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1))
    # One row per id of B's vocabulary.
    highest = counted.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    return counted.withColumn("b", b).join(F.broadcast(highest), "b").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")
    )


def head_limit(counts: DataFrame, pairs: int) -> int:
    """The least power of two such that at most ``pairs`` pairs have that count or more."""
    sizes = counts.groupBy(F.floor(F.log2("count")).cast("int").alias("power")).count().collect()
    limit, held = 0, 0
    for power, size in sorted(sizes, reverse=True):  # at most 63 rows
        held += size
        if held > pairs:
            return 1 << (power + 1)
        limit = 1 << power
    return limit


def _looked_up(encoded: DataFrame, head, kind: str) -> DataFrame:
    """Sums over each row's frequent pairs, and its other pairs with their times."""

    def run(batch):
        keys, counts, best = head.value
        lists, times = batch.column("pairs"), batch.column("times")
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        often = times.flatten().to_numpy(zero_copy_only=False)
        sizes = np.array([len(x) for x in lists], np.int64)
        row = np.repeat(np.arange(batch.num_rows), sizes)
        at = np.searchsorted(keys, flat)
        at[at == len(keys)] = 0
        known = keys[at] == flat if len(keys) else np.zeros(len(flat), bool)
        total, top = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        np.add.at(total, row[known], often[known] * counts[at[known]])
        np.add.at(top, row[known], often[known] * best[at[known]])
        bounds = np.searchsorted(row[~known], np.arange(batch.num_rows + 1))
        rest, rest_times = flat[~known], often[~known]
        spans = list(zip(bounds[:-1], bounds[1:]))
        names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        return {n: batch.column(n) for n in names} | {
            "count_sum": total, "n_best": top,
            "pairs": [rest[p:q] for p, q in spans], "times": [rest_times[p:q] for p, q in spans],
        }

    schema = (
        f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, count_sum long, n_best long, pairs array<long>, times array<long>"
    )
    return map_batches(encoded, schema, run)


def link_statistics(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
    head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Counts of pairs are over all rows. A row without tokens (null or empty text, or one whose
    tokens by A or B are not the bytes of space+text) has zeros and an empty ``groups_sha256``.
    Null keys and repeated rows give a row each, and each counts; other columns are left out, so
    none can clash; an empty table gives none.
    """
    kind = docs.schema[key].dataType.simpleString()
    encoded = stage(_encoded(docs, path_a, path_b, key, text), "aligned")
    counts = stage(pair_counts(encoded), "pairs")
    limit = head_limit(counts, head_pairs)
    listed = counts.where(F.col("count") >= limit).toPandas().sort_values("pair")
    head = docs.sparkSession.sparkContext.broadcast((
        listed["pair"].to_numpy(np.int64), listed["count"].to_numpy(np.int64),
        listed["best"].to_numpy(np.int64),
    ))
    looked_up = stage(_looked_up(encoded, head, kind), "looked-up")
    head.destroy()
    rest = (
        looked_up.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
        .select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
        .join(counts.where(F.col("count") < limit), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("count")).alias("more"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        )
    )
    return looked_up.drop("pairs", "times").join(rest, "row", "left").select(
        F.col("id").alias(key), "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
