"""Near-duplicate documents by BagMinHash signatures of their shingle multisets.

BagMinHash draws, for each shingle, points of a Poisson process over its weight and time. The
weight is cut into blocks (0,1], (1,2], (2,4], (4,8], ...; a block of length L has a process of
rate L, and a point counts if its place in the block is within the shingle's weight. Each point
falls to one component of the signature, which keeps its earliest point. Two texts agree in a
component with the probability of their weighted Jaccard similarity. Points are drawn in order
of time, so all but a few shingles stop after one or two.

Texts that share a band of the signature are candidates. In each bucket of a band all members
are compared with one centre, a likely hub, and groups are joined; then pairs of members of one
bucket that are still in different groups are compared too, in blocks, unless their signatures
rule out the similarity. All links are verified by exact multiset overlap.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.llm.common import map_batches, small, texts_of
from recurra.llm.components import components
from recurra.session import stage

WORDS = 5
BANDS, ROWS = 30, 5
SIZE = BANDS * ROWS
#: Standard deviations by which a signature may fall short of the similarity.
SLACK = 4.2
#: Characters whose signatures are made at once, members of a bucket that meet in one task, and
#: characters of theirs.
CHUNK_CHARS, BLOCK, BLOCK_CHARS = 2_000_000, 1024, 8_000_000

_WORD = re.compile(r"\w+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _times_golden(n: int) -> np.uint64:
    return np.uint64(n * int(_GOLDEN) % 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public SplitMix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str) -> np.ndarray:
    """Hashes of all runs of five lower-case words; of all words, if there are fewer."""
    words = _WORD.findall(text.lower())
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    if not width:
        return hashes
    runs = np.full(len(words) - width + 1, np.uint64(width))
    for i in range(width):
        runs = mix(runs * _GOLDEN + hashes[i : len(words) - width + 1 + i])
    return runs


def weighted(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingle_hashes(text), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact weighted Jaccard similarity of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def bag_min_hash(bags: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """Signatures (32-bit values) of multisets of hashes; zeros for an empty one."""
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    value = np.concatenate(bags) if bags else np.zeros(0, np.uint64)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    first = np.flatnonzero(
        np.concatenate([[True], (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])])
    ) if len(doc) else np.zeros(0, int)
    weight = np.diff(first, append=len(doc))
    doc, value = doc[first], value[first]
    # Blocks of the weight: number, lower end and length.
    streams = [(doc, value, weight, np.zeros(len(doc)), np.ones(len(doc)))]
    low = 1
    while len(weight) and weight.max() > low:
        more = weight > low
        n = int(more.sum())
        seed = mix(value[more] + _times_golden(low))
        streams.append((doc[more], seed, weight[more], np.full(n, low), np.full(n, low)))
        low *= 2
    doc, seed, weight, low, length = map(np.concatenate, zip(*streams))
    earliest = np.full(len(bags) * size, np.inf)
    latest = np.full(len(bags), np.inf)
    time, step = np.zeros(len(doc)), 0
    while len(doc):
        step += 1
        drawn = mix(seed + _times_golden(step))
        time = time - np.log(((drawn >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / length
        other = mix(drawn + _GOLDEN)
        place = low + np.floor((other >> np.uint64(32)) * 2.0**-32 * length) + 1
        counts = (time < latest[doc]) & (place <= weight)
        slot = doc[counts] * size + (other[counts] % np.uint64(size)).astype(np.int64)
        np.minimum.at(earliest, slot, time[counts])
        live = np.unique(doc)
        latest[live] = earliest.reshape(-1, size)[live].max(axis=1)
        on = time < latest[doc]
        doc, seed, weight, low = doc[on], seed[on], weight[on], low[on]
        length, time = length[on], time[on]
    bits = mix(np.where(np.isfinite(earliest), earliest, 0.0).view(np.uint64))
    return (bits >> np.uint64(32)).astype("<u4").reshape(-1, size)


def node_of(text: str) -> Column:
    """128 bits that stand for a text; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, node (of its text), chars and signature (binary; null without any word)."""
    kind = docs.schema[key].dataType.simpleString()

    def sign(batch):
        texts, signed = texts_of(batch, text), []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= CHUNK_CHARS):
                chars, end = chars + len(texts[end]), end + 1
            bags = [shingle_hashes(t) for t in texts[at:end]]
            signed += [
                s.tobytes() if len(b) else None for s, b in zip(bag_min_hash(bags), bags)
            ]
            at = end
        return {
            key: batch.column(key), "node": batch.column("node"),
            "chars": list(map(len, texts)), "signature": signed,
        }

    source = docs.select(key, text, node_of(text).alias("node"))
    return map_batches(source, f"`{key}` {kind}, node binary, chars long, signature binary", sign)


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=1)


def _least_agreement(threshold: float) -> float:
    return threshold * SIZE - SLACK * (SIZE * threshold * (1 - threshold)) ** 0.5


def _unpack(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u4").reshape(-1, SIZE)


def _plausible(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose signatures do not rule out the similarity."""
    least = _least_agreement(threshold)
    signed = pairs
    for side in "ba":
        signed = signed.join(
            nodes.select(F.col("node").alias(side), F.col("signature").alias(f"s{side}")), side
        )

    def keep(batch):
        same = _agreement(*(_unpack(batch.column(s).to_pylist()) for s in ("sa", "sb"))) >= least
        return {s: batch.column(s).filter(same.tolist()) for s in "ab"}

    return map_batches(signed, "a binary, b binary", keep)


def _verified(pairs: DataFrame, docs: DataFrame, text: str, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts have the similarity, as a written table."""
    pairs = stage(pairs, "neardup-pairs")
    texts = _texts(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), docs, text)
    both = pairs
    for side in "ab":
        both = both.join(
            texts.select(F.col("node").alias(side), F.col("text").alias(f"t{side}")), side
        )

    def keep(batch):
        last: tuple[str, tuple] = ("", weighted(""))
        same = []
        for x, y in zip(texts_of(batch, "ta"), texts_of(batch, "tb")):
            if x != last[0]:
                last = (x, weighted(x))
            same.append(overlap(last[1], weighted(y)) >= threshold)
        return {s: batch.column(s).filter(same) for s in "ab"}

    return stage(map_batches(both, "a binary, b binary", keep, rows=200), "neardup-links")


def _texts(asked: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """Rows (node, text) of the nodes asked for, written."""
    asked = stage(asked.distinct(), "neardup-asked")
    found = docs.select(node_of(text).alias("node"), F.col(text).alias("text"))
    return stage(
        found.join(small(asked), "node", "left_semi").dropDuplicates(["node"]), "neardup-texts"
    )


def _members(nodes: DataFrame) -> DataFrame:
    """Rows (bucket, band, node, size) of all buckets with more than one member, written."""
    banded = nodes.select("node", F.posexplode(F.expr(
        f"transform(sequence(0, {BANDS - 1}),"
        f" b -> xxhash64(b, substring(signature, b * {4 * ROWS} + 1, {4 * ROWS})))"
    )).alias("band", "bucket"))
    sizes = stage(
        banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"),
        "neardup-buckets",
    )
    return stage(banded.join(small(sizes), "bucket"), "neardup-members")


def _star_pairs(members: DataFrame) -> DataFrame:
    """Each member with the centre of its bucket: the node with most company in all buckets."""
    # By node, of which there is a row per band at most, so that pairs lie by b from here on.
    by_node = members.repartition("node")
    company = F.sum("size").over(Window.partitionBy("node"))
    centres = stage(
        by_node.withColumn("company", company).groupBy("bucket").agg(
            F.max(F.struct("company", "node")).alias("top")
        ).select("bucket", F.col("top.node").alias("a")),
        "neardup-centres",
    )
    return (
        by_node.join(small(centres), "bucket").where("node != a")
        .select("a", F.col("node").alias("b")).distinct()
    )


def _grouped(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    return nodes.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))


def _rest_links(
    members: DataFrame, groups: DataFrame, nodes: DataFrame, docs: DataFrame, text: str,
    threshold: float,
) -> DataFrame:
    """Links (a, b) between groups that have members of one bucket, as a written table.

    Large buckets are cut into blocks and each pair of blocks meets in one task; small buckets
    share tasks. Pairs are compared where they meet, so only links leave a task.
    """
    least = _least_agreement(threshold)
    sized = nodes.select("node", "chars", "signature")
    held = stage(
        _grouped(members.where("size > 2"), groups).join(sized.drop("signature"), "node"),
        "neardup-held",
    )
    mixed = stage(
        held.groupBy("bucket").agg(
            F.min("group").alias("low"), F.max("group").alias("high"),
            F.max("size").alias("n"), F.sum("chars").alias("all_chars"),
        ).where("low != high").select("bucket", "n", F.ceil(F.greatest(
            F.col("n") / BLOCK, F.col("all_chars") / BLOCK_CHARS
        )).cast("int").alias("blocks")),
        "neardup-mixed",
    )
    tasks = max(1, (mixed.agg(F.sum("n")).first()[0] or 0) // BLOCK)
    rows = held.join(small(mixed), "bucket")
    texts = _texts(rows.select("node"), docs, text)
    shared = F.pmod("bucket", F.lit(tasks))
    dealt = (
        rows.join(sized.drop("chars"), "node").join(texts, "node")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.when(F.col("blocks") > 1, F.col("bucket")).otherwise(shared).alias("task"),
            F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
            (F.col("own") <= F.col("other")).alias("left"),
            (F.col("own") >= F.col("other")).alias("right"),
            "bucket", "band", "node", "group", "signature", "text",
        )
    )

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, rows in frame.groupby("bucket", sort=False):
            left, right = rows[rows["left"]], rows[rows["right"]]
            links += _links(left, right, int(rows["band"].iloc[0]), least, threshold)
        return pd.DataFrame(links, columns=["a", "b"])

    found = dealt.groupBy("task", "first", "second").applyInPandas(meet, "a binary, b binary")
    return stage(found, "neardup-links")


def _links(
    left: pd.DataFrame, right: pd.DataFrame, band: int, least: float, threshold: float
) -> list[tuple]:
    """Links of different groups, by name, among the pairs that agree enough and meet in no band
    before this one; the likeliest are compared first, and groups once joined are not again."""
    if not len(left) or not len(right):
        return []
    # Members of one group follow each other, and meet none of their own.
    left = left.sort_values("group", kind="stable")
    x, y = _unpack(left["signature"]), _unpack(right["signature"])
    names = pd.factorize(np.concatenate([left["group"], right["group"]]))[0]
    found = []
    for at in range(0, len(x), 64):
        own, other = names[at : min(at + 64, len(x))], names[len(x) :]
        near = np.flatnonzero(other != own[0]) if own[0] == own[-1] else np.arange(len(y))
        equal = x[at : at + 64, None, :] == y[None, near]
        bands = equal[..., : band * ROWS].reshape(*equal.shape[:2], band, ROWS)
        same = equal.sum(axis=2, dtype=np.int16)
        apart = own[:, None] != other[None, near]
        apart &= (same >= least) & ~bands.all(axis=3).any(axis=2)
        i, j = np.nonzero(apart)
        found.append(np.stack([same[i, j], i + at, near[j]], axis=1))
    pairs = np.concatenate(found)
    joined = list(range(names.max() + 1))

    def top(k: int) -> int:
        while joined[k] != k:
            k = joined[k]
        return k

    bags: dict[bytes, tuple] = {}

    def bag(row) -> tuple:
        if row.node not in bags:
            bags[row.node] = weighted(row.text or "")
        return bags[row.node]

    rows = [list(side[["node", "group", "text"]].itertuples()) for side in (left, right)]
    links = []
    for _, i, j in pairs[np.argsort(-pairs[:, 0], kind="stable")]:
        p, q = top(names[i]), top(names[len(x) + j])
        if p != q:
            a, b = rows[0][i], rows[1][j]
            if overlap(bag(a), bag(b)) >= threshold:
                joined[p] = q
                links.append((a.group, b.group))
    return links


def find_groups(
    docs: DataFrame, threshold: float = 0.8, text: str = "text", signed: DataFrame | None = None
) -> DataFrame:
    """Rows (node, group) of the texts that have a near duplicate of another text."""
    if signed is None:
        signed = stage(
            signatures(docs.withColumn("_key", F.lit(0)), "_key", text), "neardup-signatures"
        )
    nodes = stage(
        signed.where("signature IS NOT NULL").select("node", "chars", "signature").distinct(),
        "neardup-nodes",
    )
    members = _members(nodes)
    links = _verified(_plausible(_star_pairs(members), nodes, threshold), docs, text, threshold)
    groups = components(links)
    rest = _rest_links(members, groups, nodes, docs, text, threshold)
    return groups if rest.isEmpty() else _joined(groups, rest)


def _joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` joined by ``links`` (a, b) between them; a node without a group is its own.

    Groups are named by their least node, so that of the joined ones is the least name.
    """
    joined = components(links).toDF("group", "whole")
    alone = joined.select(F.col("group").alias("node"), "group")
    return groups.union(alone).distinct().join(small(joined), "group", "left").select(
        "node", F.coalesce("whole", "group").alias("group")
    )


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, class_id (the smallest key of its class) and n_class (rows of the class).

    A class is what links of similarity ``threshold`` or more hold together; equal texts are
    linked, so all empty and null texts are one class. A text of fewer than five words has one
    shingle of all of them. Null keys are kept, and a class of only null keys has a null id;
    repeated rows give a row each; other columns are left out, so none can clash; an empty
    table gives none.
    """
    signed = stage(signatures(docs, key, text), "neardup-signatures")
    rows = _grouped(signed.select(key, "node"), find_groups(docs, threshold, text, signed))
    classes = rows.groupBy("group").agg(
        F.min(key).alias("class_id"), F.count(F.lit(1)).alias("n_class")
    )
    return rows.join(classes, "group").select(key, "class_id", "n_class")


def keep_one(
    docs: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs``, all columns, of each class: the one with the smallest key."""
    named = docs.select(
        node_of(text).alias("node"), F.struct(F.col(key).isNull(), key, *docs.columns).alias("row")
    )
    groups = stage(find_groups(docs, threshold, text), "neardup-groups")
    kept = _grouped(named, small(groups)).groupBy("group").agg(
        F.min("row").alias("row")
    )
    names = [f"c{i}" for i in range(len(docs.columns) + 2)]
    types = [docs.schema[c].dataType.simpleString() for c in docs.columns]
    fields = ["boolean", docs.schema[key].dataType.simpleString(), *types]
    plain = F.col("row").cast("struct<" + ", ".join(f"{n}: {t}" for n, t in zip(names, fields)) + ">")
    return kept.select(plain.alias("row")).select(
        *[F.col(f"row.{n}").alias(c) for n, c in zip(names[2:], docs.columns)]
    )
