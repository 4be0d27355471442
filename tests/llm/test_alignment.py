import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm import odd
from llm.test_tokens import PARTS
from recurra.llm import alignment
from recurra.llm.byte_bpe import byte_characters
from recurra.llm.common import read

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens_of(text, libraries):
    """(id, bytes) of both tokenizers, one by one; none where their bytes are not the text's."""
    a, b = libraries
    byte_of = {c: i for i, c in enumerate(byte_characters())}
    made = a.encode(" " + text, add_special_tokens=False)
    of_a = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(made.ids, made.tokens)]
    of_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        of_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i)
                     else piece.replace("▁", " ").encode()))
    data = (" " + text).encode()
    whole = text and all(b"".join(x for _, x in t) == data for t in (of_a, of_b))
    return (of_a, of_b) if whole else ([], [])


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def plain(texts, libraries):
    """All overlapping pairs of each text by their definition."""
    rows, counts, best = [], Counter(), defaultdict(int)
    for text in texts:
        a, b = map(spans, tokens_of(text or "", libraries))
        links = [(x, y) for x, s, e in a for y, p, q in b if max(s, p) < min(e, q)]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for high in cuts:
            groups.append("|".join(
                ",".join(str(i) for i, s, e in t if low <= s and e <= high) for t in (a, b)
            ))
            low = high
        counts.update(links)
        rows.append((len(a), len(b), links, ";".join(groups), len(cuts)))
    for (_, y), c in counts.items():
        best[y] = max(best[y], c)
    return [
        (n_a, n_b, n_groups, len(links), sum(counts[k] == best[k[1]] for k in links),
         sum(counts[k] for k in links), hashlib.sha256(w.encode()).hexdigest() if w else "")
        for n_a, n_b, links, w, n_groups in rows
    ]


def result(df):
    return sorted(
        ((r.doc_id if r.doc_id is not None else -1, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best,
          r.count_sum, r.groups_sha256) for r in df.collect())
    )


def wanted(rows, libraries):
    found = plain([t for _, t in rows], libraries)
    return sorted((i if i is not None else -1, *x) for (i, _), x in zip(rows, found))


@pytest.mark.parametrize("head", [alignment.HEAD_PAIRS, 40, 0])
def test_statistics_of_odd_rows(spark, libraries, head):
    rows = [(i, t if t != odd.texts()[9][1] else t[:3000]) for i, t in odd.texts()]
    rows += [(20, "▁ a mark"), (21, "<|endoftext|> <s> x"), (22, "日本語のテキスト 😀😀"), (23, "\x00 a\r\n")]
    docs = odd.clashing(odd.documents(spark, rows))
    made = alignment.link_statistics(docs, A, B, head_pairs=head)
    assert result(made) == wanted(rows, libraries)
    assert alignment.link_statistics(docs.limit(0), A, B, head_pairs=head).collect() == []


def test_statistics_of_the_small_documents(spark, libraries):
    docs = read(spark, SMALL, "documents").where("length(text) < 3000")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(alignment.link_statistics(docs, A, B)) == wanted(rows, libraries)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), max_size=5))
def test_lockstep_finds_the_groups(texts):
    coders = alignment.pair(A, B)
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    both = a, sentencepiece.SentencePieceProcessor(model_file=B)
    made = coders.align(*coders.encode(texts))
    found = plain(texts, both)
    assert made.n_links.tolist() == [x[3] for x in found]
    assert [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in made.written()] == [
        x[-1] for x in found
    ]


def test_lanes_give_what_one_lane_gives(monkeypatch):
    coders = alignment.pair(A, B)
    texts = [odd.LONG % tuple(range(2000)), "", "é" * 5000, "short one"]
    encoded = coders.encode(texts)
    by_lanes = coders.align(*encoded)
    monkeypatch.setattr(alignment, "LANE_TOKENS", 10**9)
    whole = coders.align(*encoded)
    assert by_lanes.written() == whole.written()
    for name in ("link_a", "link_b", "cut", "n_groups"):
        assert np.array_equal(getattr(by_lanes, name), getattr(whole, name))


def test_groups_with_their_ends(spark, libraries):
    row, = alignment.align(odd.documents(spark, [(1, "tokens of a text")]), A, B).collect()
    a, b = tokens_of("tokens of a text", libraries)
    assert [i for g in row.groups for i in g.a] == [i for i, _ in a]
    assert [i for g in row.groups for i in g.b] == [i for i, _ in b]
    assert row.groups[-1].end == len(" tokens of a text")


def test_head_limit(spark):
    counts = spark.createDataFrame([(i, c) for i, c in enumerate([1] * 50 + [5] * 6 + [9] * 3)],
                                   "pair long, count long")
    assert alignment.head_limit(counts, 2) == 16
    assert alignment.head_limit(counts, 3) == 8
    assert alignment.head_limit(counts, 9) == 2
    assert alignment.head_limit(counts, 100) == 1


def test_batches_are_parted_by_bytes():
    import pyarrow as pa

    texts = ["x" * 10, None, "é" * 30, "", "y" * 5, "z" * 200, "a", None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "n": list(range(8))})
    parts = list(alignment._parts(batch, "text", 40))
    assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(8))
    assert len(parts) > 2 and all(
        p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= 250
        for p in parts
    )
    empty = batch.slice(0, 0)
    assert list(alignment._parts(empty, "text")) == []
