import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm import odd
from recurra.llm import byte_bpe, packing, pieces, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PARTS = [
    "a", "the", "ing", " ", "  ", " " * 20, "\n", "\t", ".", "é", "日", "１", "😀", "▁", "\x00", "'s",
    "<s>", "</s>", "<unk>", "<0x0A>", "<|endoftext|>", "²", "123", "Ж", "aa", "#$",
]
mixed = st.lists(st.sampled_from(PARTS), max_size=25).map("".join)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(mixed)
def test_every_prefix_has_the_library_count(text):
    library = pieces.vocabulary(MODEL).model
    steps = token_counts._prefix_steps(MODEL).of(text)
    wanted = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
    assert token_counts.prefix_counts(steps).tolist() == wanted


@settings(max_examples=300, deadline=None)
@given(mixed)
def test_units_give_the_ids_of_the_whole_text(text):
    coder = pieces.text_ids(MODEL)
    ids = np.frombuffer(coder.encode([text])[0], coder.vocabulary.id_type)
    assert ids.tolist() == coder.vocabulary.model.encode(text)


def test_token_counts_of_odd_rows(spark, library):
    docs = odd.documents(spark)
    plain = token_counts.token_counts(docs, MODEL, limit=100)
    rows = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in plain.collect())
    wanted = sorted(
        (i or -1, len((t or "").encode()), n := len(library.encode(t or "")), n > 100)
        for i, t in odd.texts()
    )
    assert rows == wanted
    assert odd.same_rows(plain, token_counts.token_counts(odd.clashing(docs), MODEL, limit=100))
    assert token_counts.token_counts(docs.limit(0), MODEL).collect() == []


def test_stored_counts_answer_budgets(spark, library):
    docs = odd.documents(spark, [(1, "the quick brown fox"), (2, ""), (3, None), (4, "a")])
    counted = token_counts.token_counts(docs, MODEL)
    got = {
        r.doc_id: (r.within, r.cut)
        for r in counted.select(
            "doc_id", token_counts.tokens_within("prefix_steps", F.lit(7)).alias("within"),
            token_counts.longest_within("prefix_steps", F.lit(2)).alias("cut"),
        ).collect()
    }
    text = "the quick brown fox"
    cut = max(k for k in range(len(text) + 1) if len(library.encode(text[:k])) <= 2)
    assert got == {1: (len(library.encode(text[:7])), cut), 2: (0, 0), 3: (0, 0), 4: (1, 1)}
    short = {r.doc_id: r.text for r in token_counts.truncate(counted, docs, 2).collect()}
    assert short == {1: text[:cut], 2: "", 3: None, 4: "a"}


@settings(max_examples=300, deadline=None)
@given(mixed)
def test_byte_bpe_is_the_reference_encoding_and_round_trips(text):
    with open(RANKS, "rb") as lines:
        assert lines.readline()
    bpe = byte_bpe._byte_bpe(RANKS, PATTERN)
    ids = bpe.encode([text])[0]
    assert bpe.decode(ids) == text.encode()
    spans = bpe.offsets(ids)
    assert all(text.encode() == b"" or a < b for a, b in spans)
    for i, (a, b) in zip(ids, spans):
        assert bpe.tokens[int(i)] in text[a:b].encode()


def test_byte_bpe_of_odd_rows(spark, reference):
    docs = odd.documents(spark)
    digests = byte_bpe.encode_digests(docs, RANKS, PATTERN)
    got = sorted(map(repr, (tuple(r) for r in digests.collect())))
    wanted = []
    for i, t in odd.texts():
        ids = reference.encode_ordinary(t or "")
        wanted.append(repr((
            i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((t or "").encode()).hexdigest(),
        )))
    assert got == sorted(wanted)
    assert odd.same_rows(digests, byte_bpe.encode_digests(odd.clashing(docs), RANKS, PATTERN))
    assert byte_bpe.encode_digests(docs.limit(0), RANKS, PATTERN).collect() == []


def test_byte_bpe_leaves_no_matches_in_its_workers(spark):
    docs = spark.range(0, 4000, 1, 8).selectExpr("id AS doc_id", "concat('word', id) AS text")
    expected = [len(byte_bpe._byte_bpe(RANKS, PATTERN).encode([f"word{i}"])[0]) for i in range(4000)]
    byte_bpe._byte_bpe.cache_clear()
    got = byte_bpe.encode_digests(docs, RANKS, PATTERN).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == expected

    def kept(batches):
        for batch in batches:
            known = len(byte_bpe._byte_bpe(RANKS, PATTERN).known)
            yield pa.RecordBatch.from_pydict({"kept": pa.array([known] * batch.num_rows, pa.int64())})

    # Workers are used again: these tasks see what those before have left.
    assert {r.kept for r in spark.range(0, 8, 1, 8).mapInArrow(kept, "kept long").collect()} == {0}


def test_byte_bpe_texts_come_back(spark):
    docs = odd.documents(spark)
    encoded = byte_bpe.encode_texts(docs, RANKS, PATTERN, offsets=True)
    assert all(len(r.ids) == len(r.offsets) == r.n_tokens for r in encoded.collect())
    back = byte_bpe.decode_ids(encoded, RANKS, PATTERN)
    assert odd.same_rows(back, docs.selectExpr("doc_id", "coalesce(text, '') AS text"))
    cut = spark.createDataFrame([(1, [])], "doc_id long, ids array<int>")
    assert byte_bpe.decode_ids(cut, RANKS, PATTERN).collect()[0].text == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=80))
def test_best_fit_decreasing_is_that_of_a_plain_search(lengths):
    rows = packing.best_fit_decreasing(lengths, 40)
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= max(n, 1)]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 40) - n)
    used = [sum(n for n, r in zip(lengths, rows) if r == k) for k in range(len(rooms))]
    assert sorted(40 - u for u in used) == sorted(rooms)


def test_packed_rows_hold_all_tokens(spark, library):
    docs = odd.documents(spark)
    for shards in (None, 3):
        rows = packing.pack(odd.clashing(docs), MODEL, capacity=64, pad=9, shards=shards).collect()
        found = {}
        for r in rows:
            ids = np.frombuffer(r.ids, "<u2")
            at = r.cu_seqlens
            positions = np.frombuffer(r.positions, "<u4")
            assert len(ids) == 64 and at[0] == 0 and at[-1] == r.n_tokens <= 64
            assert (ids[r.n_tokens :] == 9).all() and len(at) == len(r["keys"]) + 1
            for key, piece, a, b in zip(r["keys"], r.pieces, at, at[1:]):
                assert positions[a:b].tolist() == list(range(b - a))
                found.setdefault((key, piece), []).append(ids[a:b].tolist())
        texts = {}
        for i, t in odd.texts():
            texts.setdefault(i, []).append(library.encode(t or ""))
        for key, wanted in texts.items():
            longest = max(len(w) for w in wanted)
            parts = [found[key, p] for p in range(max(1, -(-longest // 64)))]
            assert sorted(parts[0]) == sorted(w[:64] for w in wanted)
            assert sum(len(x) for ps in parts for x in ps) == sum(map(len, wanted))
    assert packing.pack(docs.limit(0), MODEL).collect() == []


def test_rows_alike_are_spread_over_the_shards(spark):
    rows = [(None, "") for _ in range(1500)] + [(None, "one and the same text")] * 1500 + [
        (i, f"text {i}") for i in range(3000)
    ] + [(7, "again")] * 1500
    packed = packing.pack(odd.documents(spark, rows), MODEL, capacity=64, shards=10)
    sizes = [r[1] for r in packed.groupBy("shard").agg(F.sum(F.size("keys"))).collect()]
    assert len(sizes) == 10 and sum(sizes) == len(rows)
    assert max(sizes) < 1.25 * sorted(sizes)[5]


def test_shards_grow_with_rows_that_have_no_text(spark):
    rows = spark.range(packing.SHARD_BYTES // packing.ROW_BYTES * 2).select(
        F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")
    )
    assert packing.pack(rows, MODEL).select("shard").distinct().count() == 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "é", "ь", "日", "\U0001f600", "\U00010348", " ", "x1"]), max_size=30).map("".join))
def test_characters_that_no_piece_holds(text):
    coder = pieces.text_ids(MODEL)
    assert coder.ids([text])[0].tolist() == coder.vocabulary.model.encode(text)
