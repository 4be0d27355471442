"""Exact token counts at every prefix of a text, without encoding it again.

A sequence of pieces is the encoding of a text exactly when each pair of neighbours is the
encoding of its own concatenation. So the encoding of a prefix is that of a shorter prefix plus
one last piece that fits the last piece before it, and a dynamic program over the characters
finds the last piece, and with it the count, of every prefix. It runs once for each distinct
unit (see ``pieces``). Per text the counts are stored as the step of the count from each
character to the next, one signed byte each.
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from operator import sub

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from recurra.llm.common import map_batches, texts_of
from recurra.llm.pieces import KEPT, SPACE, Vocabulary, vocabulary


class PrefixSteps(dict):
    """Steps of the token count along each unit met so far."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab, self.fits, self.made = vocab, {}, {}
        best = sorted(set(vocab.score.values()), reverse=True)
        order = {score: i for i, score in enumerate(best)}
        self.rank = {piece: order[score] for piece, score in vocab.score.items()}
        self.pieces = ahocorasick.Automaton()
        for piece in self.rank:
            self.pieces.add_word(piece, piece)
        self.pieces.make_automaton()

    def __missing__(self, unit: str) -> bytes:
        if len(self) > KEPT:
            self.clear()
        count = self.counts(unit)
        steps = self[unit] = array("b", map(sub, count[1:], count)).tobytes()
        return steps

    def counts(self, unit: str) -> list[int]:
        """Token counts of all prefixes of a unit, the empty one first."""
        fits, size = self.fits, len(unit)
        count, last, done = [0] * (size + 1), [""] * (size + 1), 0
        # All pieces by their ends, the longest first; one of those at an end fits.
        for at, piece in self.pieces.iter(unit):
            if at < done:
                continue
            if done < at:
                self.fall_back(unit, count, last, done, at)
            start = at + 1 - len(piece)
            pair = last[start], piece
            fit = fits.get(pair)
            if fit is None:
                fit = self.learn(*pair)
            if fit:
                done = at + 1
                count[done], last[done] = count[start] + 1, piece
        self.fall_back(unit, count, last, done, size)
        return count

    @staticmethod
    def fall_back(unit: str, count: list[int], last: list[str], start: int, end: int) -> None:
        """Characters that are no piece count by their bytes."""
        for i in range(start, end):
            count[i + 1], last[i + 1] = count[i] + len(unit[i].encode()), unit[i]

    def learn(self, left: str, right: str) -> bool:
        if len(self.fits) > KEPT:
            self.fits.clear()
        fit = self.fits[left, right] = self.fit(left, right)
        return fit

    def fit(self, left: str, right: str) -> bool:
        """Whether the concatenation is encoded as these two pieces.

        It is, unless somewhere along the inner edges of their merge trees a merge across the
        border would have come before the merges made inside.
        """
        rank = self.rank
        if not left:
            return self.merged(right) == [right]
        if left[-1] == SPACE and right[0] == SPACE:  # their scores are equal: see merged()
            return self.merged(left + right) == [left, right]
        if self.halves(right) is None and len(right) > 1:
            return False
        first, limit = False, len(rank)
        while True:
            across = rank.get(left + right)
            if across is not None and (across < limit or first and across == limit):
                return False
            # Undo the later of the two last merges; at equal ranks the right one came later.
            if rank.get(left, -1) > rank.get(right, -1) and len(left) > 1 or len(right) == 1:
                if len(left) == 1:
                    return True
                limit, first, left = rank[left], False, self.halves(left)[1]
            else:
                limit, first, right = rank[right], True, self.halves(right)[0]

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes a piece; None where the piece is never made."""
        if piece not in self.made:
            parts = self.merged(piece, last=True)
            self.made[piece] = tuple(parts) if len(parts) == 2 else None
        return self.made[piece]

    def merged(self, text: str, last: bool = False) -> list[str]:
        """Merges by best score, the leftmost first, of at most two pieces' length.

        ``last``: without the merge that makes the whole of it one piece.
        """
        parts, score = list(text), self.vocab.score
        while True:
            pairs = [a + b for a, b in zip(parts, parts[1:])]
            ranked = [(-score[p], i) for i, p in enumerate(pairs) if p in score]
            if not ranked or last and len(parts) == 2:
                return parts
            at = min(ranked)[1]
            parts[at : at + 2] = [pairs[at]]

    def of(self, text: str) -> bytes:
        """The steps of a whole text, one for each of its characters."""
        units = self.vocab.units(text)
        if not units:
            return b""
        steps = b"".join(map(self.__getitem__, units))
        # The leading space mark belongs to the first character.
        first = np.frombuffer(steps, np.int8, 2).sum()
        return array("b", [int(first)]).tobytes() + steps[2:]


@lru_cache(maxsize=2)
def _prefix_steps(path: str) -> PrefixSteps:
    return PrefixSteps(vocabulary(path))


def prefix_counts(steps: bytes) -> np.ndarray:
    """Token counts of all prefixes of a text, from no character to all."""
    return np.concatenate([[0], np.frombuffer(steps, np.int8).cumsum(dtype=np.int64)])


def token_counts(
    docs: DataFrame, model: str, limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, n_bytes, n_tokens, over_limit and prefix_steps.

    ``model`` is the path of a sentencepiece BPE model. A null text counts as empty, with no
    byte, token or step. Repeated rows and null keys give a row each; other columns are left
    out, so none can clash; an empty table gives none. Long texts are taken whole: the cost is
    linear in their length.
    """
    kind = docs.schema[key].dataType.simpleString()

    def count(batch):
        table = _prefix_steps(model)
        texts = texts_of(batch, text)
        steps = [table.of(t) for t in texts]
        tokens = [int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) for s in steps]
        return {
            key: batch.column(key),
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
            "prefix_steps": steps,
        }

    schema = f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean, prefix_steps binary"
    return map_batches(docs.select(key, text), schema, count)


@pandas_udf(LongType())
def tokens_within(steps: pd.Series, chars: pd.Series) -> pd.Series:
    """Tokens of the first ``chars`` characters (all, if there are fewer); null for null."""

    def one(s, n):
        return None if s is None or pd.isna(n) else int(
            np.frombuffer(s, np.int8)[: max(0, int(n))].sum(dtype=np.int64)
        )

    return pd.Series([one(s, n) for s, n in zip(steps, chars)], dtype="Int64")


@pandas_udf(LongType())
def longest_within(steps: pd.Series, budget: pd.Series) -> pd.Series:
    """Characters of the longest prefix of at most ``budget`` tokens; null for null."""

    def one(s, n):
        if s is None or pd.isna(n) or n < 0:
            return None
        return int(np.flatnonzero(prefix_counts(s) <= n)[-1])

    return pd.Series([one(s, n) for s, n in zip(steps, budget)], dtype="Int64")


def truncate(counted: DataFrame, docs: DataFrame, budget: int, key: str = "doc_id") -> DataFrame:
    """The texts cut to at most ``budget`` tokens, by the stored counts (keys must be unique)."""
    cut = counted.select(key, longest_within("prefix_steps", F.lit(budget)).alias("_cut"))
    return docs.join(cut, key).withColumn("text", F.expr("substring(text, 1, _cut)")).drop("_cut")
