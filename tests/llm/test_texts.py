import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import odd
from recurra.llm import brown_lm, personal_data, quality
from recurra.llm.common import read

DATA = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = [
    "a@b.co", " ", "+1 (555) 123-4567", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "9", ".",
    "4111111111111111", "-", "+", "é", "😀", "x.y_z@foo.bar.", "@", "@q.w", "0", "12", "\n", "A",
    "(555) 123-4567", "call 555-123-4567", "joe (at) ex.com", "b", "  ", "(", ")", "001.02.3.4",
    "5555-5555-5555-4444", "3782 822463 10005", "1" * 20,
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 8 <= len(digits) <= 15
            ):
                out.append((kind, m.start(), m.end()))
    return out


def test_strict_spans_are_those_of_the_plain_patterns(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices(PARTS, k=rng.randint(0, 14)))) for i in range(1500)]
    rows += odd.texts() + [(-1, "1" * 3000), (-2, "a." * 3000 + "@"), (-3, "a@b.c " * 300)]
    docs = odd.documents(spark, rows)
    found = personal_data.digests(personal_data.find_personal_data(docs))
    got, wanted = [], []
    for r in found.collect():
        got.append(repr((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)))
    for key, text in rows:
        spans = base_spans(text or "")
        seen = Counter(k for k, _, _ in spans)
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        wanted.append(repr((
            key, *(seen[k] for k in PATTERNS), hashlib.sha256(written.encode()).hexdigest()
        )))
    assert sorted(got) == sorted(wanted)
    again = personal_data.digests(personal_data.find_personal_data(odd.clashing(docs)))
    assert odd.same_rows(found, again)
    assert personal_data.find_personal_data(docs.limit(0)).collect() == []


def test_long_runs_take_linear_time(spark):
    rows = [(1, "a" * 300_000), (2, "1" * 300_000), (3, "1." * 150_000), (4, "+1 " * 100_000)]
    found = personal_data.find_personal_data(odd.documents(spark, rows)).collect()
    assert len(found) == 4


def test_all_kept_spans_hold_the_base_and_are_in_order(spark):
    rows = [(1, "call (555) 123-4567 or +1 (555) 123-4567, joe (at) ex.com, a@b.com 1.2.3.4")]
    spans = personal_data.find_personal_data(odd.documents(spark, rows)).first().spans
    order = [(personal_data.KINDS.index(s.kind), s.start) for s in spans]
    assert order == sorted(order)
    strict = [(s.kind, s.start, s.end) for s in spans if s.strict]
    assert strict == base_spans(rows[0][1])


def test_redaction_masks_spans_and_nothing_else(spark):
    rows = [
        (1, "mail a@b.co now +1 (555) 123-4567 é 4111111111111111 end"), (2, None), (3, ""),
        (None, "plain"), (4, "1.2.3.4"), (4, "1.2.3.4"),
    ]
    docs = odd.clashing(odd.documents(spark, rows))
    masked = personal_data.redact(docs)
    assert masked.columns == docs.columns
    assert sorted(map(repr, (r.text for r in masked.collect()))) == sorted(map(repr, [
        "mail [EMAIL] now [PHONE] é [CARD] end", None, "", "plain", "[IP]", "[IP]",
    ]))


def test_em_tells_good_labelers_from_bad():
    rng = random.Random(1)
    rates = [(0.95, 0.05), (0.9, 0.1), (0.5, 0.5), (0.85, 0.1), (0.9, 0.05)]
    counts, truth = Counter(), Counter()
    for _ in range(20_000):
        real = rng.random() < 0.6
        votes = sum(1 << i for i, (t, f) in enumerate(rates) if rng.random() < (t if real else f))
        counts[votes] += 1
        truth[votes] += real
    likely, found = personal_data.expectation_maximisation(dict(counts))
    assert all(abs(a - c) < 0.05 and abs(b - d) < 0.05 for (a, b), (c, d) in zip(found, rates))
    right = sum(truth[v] if p > 0.5 else counts[v] - truth[v] for v, p in likely.items())
    assert right / 20_000 > 0.97


def test_no_python_in_personal_data(spark, capsys):
    docs = odd.documents(spark)
    personal_data.digests(personal_data.find_personal_data(docs)).explain()
    personal_data.redact(docs).explain()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", capsys.readouterr().out)


@pytest.fixture(scope="module")
def model(spark):
    return quality.fit_rules(read(spark, DATA, "documents"), read(spark, DATA, "labels"))


def test_quality_on_held_out_labels(spark, model):
    docs, labels = read(spark, DATA, "documents"), read(spark, DATA, "labels")
    assert 0 < len(model.rules) < 100
    scored = quality.score_quality(docs, model)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in rows)
    assert right / len(rows) > 0.95
    for r in scored.collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    kept = quality.keep_good(odd.clashing(docs), model)
    assert kept.count() == sum(r.predicted for r in scored.collect())


def test_quality_learns_only_from_rows_that_are_not_held_out(spark, model):
    docs, labels = read(spark, DATA, "documents"), read(spark, DATA, "labels")
    turned = labels.withColumn(
        "quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert model == quality.fit_rules(docs, turned)


def test_quality_of_odd_rows(spark):
    docs = odd.documents(spark)
    label = "doc_id long, quality int"
    for rows in ([], [(1, 1), (None, 0), (2, None), (6, 1)]):
        model = quality.fit_rules(docs, spark.createDataFrame(rows, label))
        scores = [r.score for r in quality.score_quality(docs, model).collect()]
        assert len(scores) == len(odd.texts()) and len(set(scores)) == 1
    both = spark.createDataFrame([(i, i % 2) for i in range(1, 10)], label)
    model = quality.fit_rules(docs, both)
    scored = quality.score_quality(docs, model)
    assert odd.same_rows(scored, quality.score_quality(odd.clashing(docs), model))
    assert quality.score_quality(docs.limit(0), model).collect() == []
    kept = quality.keep_good(odd.clashing(docs), model, threshold=0.0)
    assert kept.count() == docs.count() and kept.columns == odd.clashing(docs).columns


def test_rules_as_columns_are_the_rules(spark, model):
    docs = read(spark, DATA, "documents").limit(50)
    got = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    for r in docs.collect():
        values = dict(zip(quality.STATISTICS, quality.text_statistics(r.text)))
        total = model.bias + sum(
            w for rule, w in model.rules
            if all(values[n] <= t if s == "<=" else values[n] > t for n, s, t in rule)
        )
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-total)))


def lm_tokens(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def lm_base(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts, ends = Counter(), 0
    for key, text in rows:
        if not held(key):
            counts.update(lm_tokens(text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + bool(ends)
    out = []
    for key, text in rows:
        own = [counts[w] for w in lm_tokens(text)] + [ends]
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in own)
        out.append((key, held(key), len(own), sum(c > 0 for c in own), n, round(base, 6)))
    return sorted(map(repr, out))


@pytest.mark.parametrize("head", [200_000, 10])
def test_lm_counts_and_base(spark, head):
    docs = odd.documents(spark)
    got = brown_lm.score(odd.clashing(docs), head=head).collect()
    fields = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert sorted(
        repr((*(r[f] for f in fields), round(r.base_score, 6))) for r in got
    ) == lm_base(odd.texts())
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert brown_lm.score(docs.limit(0)).collect() == []
    only = [(i, "a b") for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    unseen = brown_lm.score(odd.documents(spark, only)).collect()
    assert [(r.n_known, r.train_tokens) for r in unseen] == [(0, 0)] * 2


def test_lm_is_a_better_model_than_the_base(spark):
    rows = brown_lm.score(read(spark, DATA, "documents"), head=2000).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_probabilities_sum_to_one(spark):
    """Over all known words and the open class's unseen ones, after every class."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(40)], k=20))) for i in range(60)]
    docs = odd.documents(spark, rows + [(100, "once"), (101, "twice twice lonely")])
    source = docs.select("doc_id", "text").withColumn("held_out", F.lit(False))
    vocabulary = brown_lm.word_counts(source)
    most = vocabulary.where("c > 1").orderBy(F.desc("c"), "word").limit(25).collect()
    numbers = spark.sparkContext.broadcast(brown_lm._Numbers([bytes(r.word) for r in most]))
    numbered = brown_lm._numbered(source, numbers, "doc_id", "text")
    m = brown_lm.fit(numbered, vocabulary, [r.c for r in most], 62, exchanged=12, classes=4)
    head = len(most) + 1
    known = {bytes(r.word) for r in most}
    tail = [r.c for r in vocabulary.collect() if bytes(r.word) not in known]
    assert sum(tail) == m.tail_count
    open_class = sum((1 - m.unseen) * c / m.tail_count for c in tail) + m.unseen
    for before in range(len(m.step)):
        p = 10 ** (m.step[before, m.home[:head]] + m.emission[:head])
        assert p.sum() + 10 ** m.step[before, -1] * open_class == pytest.approx(1)


def test_lm_words_beyond_the_dictionary_have_classes_too(spark):
    """How many words tasks hold in a dictionary changes no score."""
    rng = random.Random(9)
    near = [(i, " ".join(f"w{min(39, int(rng.expovariate(0.1)))}" for _ in range(20))) for i in range(80)]
    docs = odd.documents(spark, near + odd.texts())
    of = {
        head: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score)
                     for r in brown_lm.score(docs, head=head).collect())
        for head in (3, 200_000)
    }
    for a, b in zip(of[3], of[200_000], strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:])


def test_lm_classes_grow_with_the_vocabulary():
    assert brown_lm.sizes(35_000) == brown_lm.sizes(200_000) == (4096, 64)
    assert brown_lm.sizes(12_800_000) == (32_768, 256)


def test_exchange_parts_two_languages(spark):
    """Words of two languages that never mix end up in different classes."""
    rng = random.Random(6)
    rows = []
    for i in range(200):
        own = [f"{'ab'[i % 2]}{k}" for k in range(12)]
        rows.append((i, " ".join(rng.choices(own, k=30))))
    source = odd.documents(spark, rows).select("doc_id", "text").withColumn("held_out", F.lit(False))
    words = [r.word for r in brown_lm.word_counts(source).orderBy(F.desc("c"), "word").collect()]
    numbers = spark.sparkContext.broadcast(brown_lm._Numbers([bytes(w) for w in words]))
    numbered = brown_lm._numbered(source, numbers, "doc_id", "text")
    home = brown_lm.exchange(brown_lm._bigrams(numbered, 25), 25, 3, 8)
    assert home[0] == 0
    by = {lang: {home[i + 1] for i, w in enumerate(words) if chr(w[0]) == lang} for lang in "ab"}
    assert len(by["a"]) == len(by["b"]) == 1 and by["a"] != by["b"]
    assert np.all(home[1:] > 0)


def numbered_words(spark, rows):
    source = odd.documents(spark, rows).select("doc_id", "text").withColumn("held_out", F.lit(False))
    vocabulary = brown_lm.word_counts(source)
    most = vocabulary.where("c > 1").orderBy(F.desc("c"), "word").collect()
    words = [bytes(r.word) for r in most]
    numbers = spark.sparkContext.broadcast(brown_lm._Numbers(words))
    return brown_lm._numbered(source, numbers, "doc_id", "text"), vocabulary, words, [r.c for r in most]


def test_exchange_counts_neighbours_that_are_not_clustered(spark):
    rows = [(i, "a b x" if i % 2 else "a y x") for i in range(8)]
    numbered, _, words, _ = numbered_words(spark, rows)
    assert words == [b"a", b"x", b"b", b"y"]
    got = {(r.a, r.b): r.n for r in brown_lm._bigrams(numbered, 3).collect()}
    assert got == {(0, 1): 8, (1, 3): 8, (3, 2): 8, (2, 0): 8}


def test_neighbours_move_in_blocks_and_are_summed_by_class(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.expovariate(0.02))}" for _ in range(40))) for i in range(300)]
    numbered, _, _, _ = numbered_words(spark, rows)
    bigrams = brown_lm._bigrams(numbered, 30)
    # A row for each block is shuffled, not one for each pair, and no round joins the pairs.
    plan = bigrams._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(block" in plan and "hashpartitioning(a" not in plan
    wanted, near = Counter(), np.zeros((2, 30, 6))
    home = np.array([0, *(rng.randrange(1, 5) for _ in range(29)), 5])
    for r in numbered.select("ids").collect():
        for a, b in zip([0, *r.ids], r.ids):
            a, b = min(a, 30), min(b, 30)
            if min(a, b) < 30:
                wanted[a, b] += 1
            if b < 30:
                near[0, b, home[a]] += 1
            if a < 30:
                near[1, a, home[b]] += 1
    assert {(r.a, r.b): r.n for r in bigrams.collect()} == wanted
    summed = brown_lm._summed(bigrams, 2 * 30 * 6, brown_lm._by_class(home, 6))
    assert (brown_lm._array(summed, 2 * 30 * 6).reshape(2, 30, 6) == near).all()


def test_words_next_to_no_clustered_one_have_classes_by_their_neighbours(spark):
    """Rare words that are never next to a frequent one do not share a class with any."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        lang = "ab"[i % 2]
        rare = [f"{lang}rare{k}" for k in range(40)]
        often = [f"{lang}{k}" for k in range(14)]
        edges = [f"{lang}edge{rng.randrange(20)}" for _ in range(4)]
        near = [w for pair in zip(edges, rng.choices(rare, k=3)) for w in pair]
        rows.append((i, " ".join([*rng.choices(often, k=14), *near, edges[3]])))
    numbered, vocabulary, words, counts = numbered_words(spark, rows)
    m = brown_lm.fit(numbered, vocabulary, counts, len(rows), exchanged=29, classes=8)
    rare = {m.home[i + 1] for i, w in enumerate(words) if b"rare" in w}
    often = {m.home[i + 1] for i in range(28)}
    assert not rare & often


def test_exchange_of_all_words_counts_all_neighbours(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{int(rng.expovariate(0.02))}" for _ in range(40))) for i in range(300)]
    numbered, _, words, _ = numbered_words(spark, rows)
    head = len(words) + 1
    home = np.array([0, *(rng.randrange(1, 6) for _ in words), 6], np.int16)
    near, table = np.zeros((2, head + 1, 7)), np.zeros((7, 7))
    for r in numbered.select("ids").collect():
        for a, b in zip([0, *r.ids], r.ids):
            near[0, b, home[a]] += 1
            near[1, a, home[b]] += 1
            table[home[a], home[b]] += 1
    assert (brown_lm._class_table(numbered, home, 7) == table).all()
    got = dict(zip(*brown_lm._exchange_all(numbered, home, table)))
    wanted = brown_lm.likely_classes(near[0, 1:head], near[1, 1:head], table)
    assert [got[w] for w in range(1, head)] == list(wanted)


def test_lm_numbers_travel_as_bytes():
    numbers, sizes = np.array([3, 70_000, 0, 0, 2**20 + 7, 1, 0], np.int32), np.array([3, 1, 3])
    packed = brown_lm._packed(numbers, sizes)
    for at, n in ((0, 3), (0, 0), (1, 2), (2, 1)):
        ids, own = brown_lm._ids(packed.slice(at, n))
        before = sizes[:at].sum()
        assert list(own) == list(sizes[at : at + n])
        assert list(ids) == list(numbers[before : before + sizes[at : at + n].sum()])


def test_lm_words_learnt_from_are_sent_by_their_number_alone(spark):
    """Words left without a number are named where they are held out; elsewhere they are counted."""
    rows = [(1, False, "a b c d"), (2, True, "a d e"), (3, False, ""), (4, False, "b z")]
    source = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")
    words = spark.sparkContext.broadcast(brown_lm._Numbers([b"a"]))
    numbered = brown_lm._numbered(source, words, "doc_id", "text", packed=True)
    rest = spark.createDataFrame([(bytearray(b"b"), 2)], "word binary, number long")
    got = {r.key: r for r in brown_lm._numbered_on(numbered, rest, 2, 3).collect()}
    ids = {k: list(np.frombuffer(r.ids.low, "<u2")) for k, r in got.items()}
    assert ids == {1: [1, 2, 3, 3, 0], 2: [1, 3, 3, 0], 3: [0], 4: [2, 3, 0]}
    assert {k: r.tail and [w and bytes(w) for w in r.tail] for k, r in got.items()} == {
        1: [None, None], 2: [b"d", b"e"], 3: [], 4: [None]}


@pytest.mark.parametrize("head", [200_000, 30])
def test_lm_score_is_recomputed_from_the_classes(spark, monkeypatch, head):
    """Token by token from the fitted tables: words seen twice have numbers, by count and bytes."""
    fitted, fit = [], brown_lm.fit
    monkeypatch.setattr(brown_lm, "fit", lambda *a, **k: fitted.append(fit(*a, **k)) or fitted[-1])
    docs = read(spark, DATA, "documents").where("length(text) < 2000")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(None, None), (5001, ""), (5002, "never seen before words"), (5002, "A b A b")]
    got = brown_lm.score(odd.documents(spark, rows), head=head, exchanged=50, classes=8).collect()
    model, = fitted
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in lm_tokens(t))
    numbered = sorted((w for w in counts if counts[w] > 1), key=lambda w: (-counts[w], w.encode()))
    number = {w: i + 1 for i, w in enumerate(numbered)}
    singles = sum(c for c in counts.values() if c == 1)
    wanted = []
    for key, text in rows:
        total, before = 0.0, 0
        for word in [*lm_tokens(text), None]:
            now = 0 if word is None else number.get(word, len(number) + 1)
            total += model.step[model.home[before], model.home[now]]
            if now <= len(number):
                total += model.emission[now]
            elif counts[word]:
                total += math.log10((1 - model.unseen) / singles)
            else:
                total += math.log10(model.unseen / model.unseen_words)
            before = now
        wanted.append((key or 0, len(lm_tokens(text)), total))
    found = sorted((r.doc_id or 0, r.n_tokens - 1, r.score) for r in got)
    assert [x[:2] for x in found] == [x[:2] for x in sorted(wanted)]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in sorted(wanted)])
