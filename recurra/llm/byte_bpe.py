"""Byte-level BPE encoding and decoding with the ``tokenizers`` library, over Arrow batches.

The library's BPE model works on characters, so each byte stands for one printable character.
From the ranks of a vocabulary every split of a token into two tokens becomes a merge of that
token's rank, which is the rule by which ranks are applied. A text is cut by the vocabulary's
pattern, the distinct matches of a batch are encoded by the library, and a task keeps them.
"""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from recurra.llm.common import map_batches, texts_of

#: Encoded matches that a task keeps; beyond it starts afresh.
KEPT = 400_000

#: Texts cut at once, and matches given to the library at once: what is held besides those kept.
TEXTS, MATCHES = 250, 5_000


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class ByteBPE:
    """A vocabulary of ranks; ``encode`` and ``decode`` work on whole texts."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already share the cores
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.characters = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(self.characters)}
        merges = [
            (self.written(token[:at]), self.written(token[at:]))
            for token, _ in sorted(ranks.items(), key=lambda x: x[1])
            for at in range(len(token) - 1, 0, -1)
            if token[:at] in ranks and token[at:] in ranks
        ]
        vocab = {self.written(t): r for t, r in ranks.items()}
        self.library = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=False
        )
        self.tokens = {i: self.read(t) for t, i in self.library.get_vocab().items()}
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def written(self, data: bytes) -> str:
        return "".join(map(self.characters.__getitem__, data))

    def read(self, token: str) -> bytes:
        return bytes(map(self.byte_of.__getitem__, token))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        found = [self.pattern.findall(t) for t in texts]
        distinct = {m for ms in found for m in ms}
        new = [m for m in distinct if m not in self.known]
        if len(self.known) + len(new) > KEPT:
            self.known.clear()
            new = list(distinct)
        for at in range(0, len(new), MATCHES):
            some = new[at : at + MATCHES]
            encoded = self.library.encode_batch_fast(some, add_special_tokens=False)
            for match, made in zip(some, encoded):
                self.known[match] = np.array(made.ids, "<u4").tobytes()
        return [np.frombuffer(b"".join(map(self.known.__getitem__, ms)), "<u4") for ms in found]

    def decode(self, ids) -> bytes:
        """The bytes of ids; characters split over tokens are whole again in the bytes."""
        return b"".join(map(self.tokens.__getitem__, np.asarray(ids).tolist()))

    def offsets(self, ids) -> np.ndarray:
        """Per id the first and the end character that it has bytes of (code points).

        Ids that share a split character overlap in it.
        """
        ids = np.asarray(ids)
        data = np.frombuffer(self.decode(ids), np.uint8)
        ends = np.cumsum([len(self.tokens[i]) for i in ids.tolist()], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        # A character begins at each byte that is no continuation byte.
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        if not len(ids):
            return np.zeros((0, 2), np.int64)
        return np.stack([character[starts], character[ends - 1] + 1], axis=1)


@lru_cache(maxsize=2)
def _byte_bpe(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


def _forget(path: str, pattern: str) -> None:
    """Drop the matches kept for a task; the vocabulary, which is small, stays with the worker."""
    if _byte_bpe.cache_info().currsize:  # a task without rows loads none
        _byte_bpe(path, pattern).known.clear()


def encode_texts(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text",
    offsets: bool = False,
) -> DataFrame:
    """Per row: key, n_bytes, n_tokens and ids (array), and offsets if asked for.

    ``ranks`` is the path of a vocabulary in tiktoken's format, ``pattern`` what cuts the texts.
    A null text counts as empty and has no ids. Null keys and repeated rows give a row each;
    other columns are left out, so none can clash; an empty table gives none.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_bytes long, n_tokens long, ids array<int>"
    if offsets:
        schema += ", offsets array<array<int>>"

    def encode(batch):
        bpe = _byte_bpe(ranks, pattern)
        texts = texts_of(batch, text)
        ids = bpe.encode(texts)
        out = {
            key: batch.column(key),
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": [len(x) for x in ids],
            "ids": [x.astype("i4") for x in ids],
        }
        if offsets:
            out["offsets"] = [bpe.offsets(x).tolist() for x in ids]
        return out

    return map_batches(
        docs.select(key, text), schema, encode, TEXTS, lambda: _forget(ranks, pattern)
    )


def decode_ids(
    encoded: DataFrame, ranks: str, pattern: str, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """Per row: key and text; null ids count as none.

    Bytes that are no whole character, as where ids were cut inside one, become U+FFFD.
    """
    kind = encoded.schema[key].dataType.simpleString()

    def decode(batch):
        bpe = _byte_bpe(ranks, pattern)
        rows = batch.column(ids).to_pylist()
        return {
            key: batch.column(key),
            "text": [bpe.decode(x or []).decode("utf-8", "replace") for x in rows],
        }

    return map_batches(encoded.select(key, ids), f"`{key}` {kind}, text string", decode)


def encode_digests(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, n_tokens, and SHA-256 of the ids and of the bytes decoded from them.

    The round trip of ``encode_texts`` and ``decode_ids`` in one pass, for checks; the same
    rules for nulls, repeated rows and other columns hold.
    """
    kind = docs.schema[key].dataType.simpleString()

    def digest(batch):
        bpe = _byte_bpe(ranks, pattern)
        ids = bpe.encode(texts_of(batch, text))
        return {
            key: batch.column(key),
            "n_tokens": [len(x) for x in ids],
            "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
        }

    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(
        docs.select(key, text), schema, digest, TEXTS, lambda: _forget(ranks, pattern)
    )
