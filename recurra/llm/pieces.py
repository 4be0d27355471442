"""Units of a text that a piece vocabulary encodes independently of each other.

In the piece vocabularies meant here no piece holds a space mark after another character, none
holds a (Latin, Greek or Cyrillic) letter before another kind of character and none holds a line feed, so no merge crosses
the start of a run of space marks, the end of a run of letters, or a line feed. A text is cut
there, and what is known about a unit is kept while a worker lives.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import sentencepiece

SPACE = "▁"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ώЀ-ӿ"
UNITS = re.compile(f"{SPACE}*[^{LETTERS}{SPACE}\n]*[{LETTERS}]+|{SPACE}*[^{LETTERS}{SPACE}\n]+|{SPACE}+|\n+")
_CROSSING = re.compile(f"[^{SPACE}]{SPACE}|[{LETTERS}][^{LETTERS}]|\n")
#: Pairs of units that a worker keeps; beyond it starts afresh.
KEPT = 400_000


class Vocabulary:
    """The normal pieces of a model with their scores."""

    def __init__(self, path: str):
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score = {
            m.id_to_piece(i): m.get_score(i)
            for i in range(m.get_piece_size())
            if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))
        }
        self.longest = max(map(len, self.score))
        self.id_type = np.dtype("<u2" if m.get_piece_size() <= 2**16 else "<u4")
        if any(map(_CROSSING.search, self.score)):
            raise ValueError("pieces of this vocabulary cross the units")

    def units(self, text: str) -> list[str]:
        """The units of a text with its leading space mark; none for an empty text."""
        return UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else []


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class TextIds:
    """Token ids (in the vocabulary's ``id_type``) of whole texts.

    A model of this kind merges the neighbours whose piece has the best score, from characters on.
    That is merging by rank, with the pieces ranked by score after byte strings that build up the
    characters, and ``tiktoken`` does it in a fraction of the time, unit by unit. Only runs of
    space marks share a score, so texts with such runs, or with a mark of their own, are left to
    the model's own library.
    """

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        score, model = self.vocabulary.score, self.vocabulary.model
        ranked = sorted(score, key=score.get, reverse=True)
        apart = [score[p] for p in ranked if set(p) != {SPACE}]
        self._ranks = None
        if len(set(apart)) == len(apart):
            self._ranks, self._ids = self._by_rank(ranked, model)
            # The id of each rank; those that stand for several bytes have none.
            self._single = np.array([i[0] if len(i) == 1 else -1 for i in self._ids], np.int64)

    @staticmethod
    def _by_rank(ranked: list[str], model):
        import tiktoken

        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        ids, ranks = [[i] for i in byte_ids], {bytes([b]): b for b in range(256)}
        characters = [p for p in ranked if len(p) == 1]
        for data in (c.encode() for c in characters):
            for k in range(2, len(data) + 1):
                if data[:k] not in ranks:
                    ranks[data[:k]] = len(ids)
                    ids.append([byte_ids[b] for b in data[:k]])
        for piece in characters:
            ids[ranks[piece.encode()]] = [model.piece_to_id(piece)]
        for piece in ranked:
            if len(piece) > 1:
                ranks[piece.encode()] = len(ids)
                ids.append([model.piece_to_id(piece)])
        coder = tiktoken.Encoding(
            "pieces", pat_str=UNITS.pattern, mergeable_ranks=ranks, special_tokens={}
        )
        return coder, ids

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as 64-bit integers."""
        out: list[np.ndarray | None] = [None] * len(texts)
        if self._ranks is not None:
            for i, text in enumerate(texts):
                if not (text.startswith(" ") or "  " in text or SPACE in text):
                    out[i] = self._ranked(text)
        rest = [i for i, ids in enumerate(out) if ids is None]
        made = self.vocabulary.model.encode([texts[i] for i in rest], num_threads=1)
        for i, ids in zip(rest, made):
            out[i] = np.array(ids, np.int64)
        return out

    def _ranked(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        ranks = self._ranks.encode_ordinary(SPACE + text.replace(" ", SPACE))
        ids = self._single[ranks]
        if (ids < 0).any():
            return np.array([i for r in ranks for i in self._ids[r]], np.int64)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each whole text."""
        return [ids.astype(self.vocabulary.id_type).tobytes() for ids in self.ids(texts)]


@lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    return TextIds(path)
