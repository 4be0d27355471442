import random
import re
from collections import Counter

import numpy as np
import pytest

from llm import odd
from recurra.llm import decontaminate, neardup
from recurra.llm.components import components

random.seed(5)
WORDS = ["".join(random.choices("abcdefgh", k=6)) for _ in range(500)]


def prose(n, seed):
    return random.Random(seed).choices(WORDS, k=n)


def edited(words, edits, seed):
    rng, out = random.Random(seed), list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = rng.choice(WORDS)
    return out


def bag(text):
    w = re.findall(r"\w+", text.lower())
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def similarity(a, b):
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def classes(rows):
    """Class (smallest key) of each row by all pairs of texts."""
    texts = sorted({t or "" for _, t in rows})
    bags, root = {t: bag(t) for t in texts}, {t: t for t in texts}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if similarity(bags[a], bags[b]) >= 0.8:
                root[top(a)] = top(b)
    least, size = {}, Counter()
    for key, t in rows:
        at = top(t or "")
        size[at] += 1
        if key is not None:
            least[at] = min(key, least.get(at, key))
    return sorted(
        (key is None, key, least.get(top(t or "")), size[top(t or "")]) for key, t in rows
    )


def corpus():
    rows, key = [], 1000
    for base in range(6):
        words = prose(80 + 20 * base, base)
        for copy in range(25):
            rows.append((key, " ".join(edited(words, copy % 5, 100 * base + copy))))
            key += 1
    for n in range(40):
        rows.append((key, " ".join(prose(60, 1000 + n) + prose(30, 77))))
        key += 1
    return rows + odd.texts()


def as_rows(frame):
    return sorted((r.doc_id is None, r.doc_id, r.class_id, r.n_class) for r in frame.collect())


@pytest.mark.parametrize("block", [1024, 8])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = [(None if k is None else k, t) for k, t in corpus()]
    docs = odd.clashing(odd.documents(spark, rows))
    got = as_rows(neardup.near_duplicates(docs))
    assert sorted(map(repr, got)) == sorted(map(repr, classes(rows)))


def test_one_document_of_each_class_stays(spark):
    rows = corpus()
    docs = odd.clashing(odd.documents(spark, rows))
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    wanted = {(c if c is not None else -1) for _, _, c, _ in classes(rows)}
    got = [(r.doc_id if r.doc_id is not None else -1) for r in kept.collect()]
    assert len(got) == len({repr(c) for _, _, c, _ in classes(rows)})
    assert set(got) == wanted
    assert neardup.near_duplicates(docs.limit(0)).collect() == []
    assert neardup.keep_one(docs.limit(0)).collect() == []


def test_signatures_estimate_the_weighted_similarity():
    for n, edits, pool in ((60, 2, 500), (200, 6, 500), (900, 40, 12)):
        gaps = []
        for seed in range(40):
            a = random.Random(seed).choices(WORDS[:pool], k=n)
            b = edited(a, edits, seed)
            x, y = " ".join(a), " ".join(b)
            s = neardup.bag_min_hash([neardup.shingle_hashes(x), neardup.shingle_hashes(y)])
            gaps.append((s[0] == s[1]).mean() - similarity(bag(x), bag(y)))
        assert abs(np.mean(gaps)) < 0.02 and np.std(gaps) < 0.06


def test_exact_overlap_counts_repeats():
    for a, b in (("a b c d e f", "a b c d e f a b c d e"), ("x", "x"), ("", "")):
        got = neardup.overlap(neardup.weighted(a), neardup.weighted(b))
        assert got == pytest.approx(similarity(bag(a), bag(b)))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.group for r in components(frame).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(30)}
    assert components(frame.limit(0)).collect() == []


def test_links_that_are_stars_are_written_once(spark, monkeypatch):
    written, real = [], neardup.stage
    monkeypatch.setattr("recurra.llm.components.stage", lambda df, label: written.append(label) or real(df, label))
    links = [(c, c + i) for c in (0, 100) for i in range(1, 30)]
    frame = spark.createDataFrame([*links, *links, (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.group for r in components(frame).collect()}
    assert got == {c + i: c for c in (0, 100) for i in range(30)}
    assert len(written) == 1


def test_groups_are_joined_by_links_between_them(spark):
    groups = spark.createDataFrame([(1, 1), (4, 1), (2, 2), (6, 2), (3, 3), (9, 3)], "node long, group long")
    links = spark.createDataFrame([(2, 1), (7, 2), (8, 5)], "a long, b long")
    got = sorted(tuple(r) for r in neardup._joined(groups, links).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 1), (5, 5), (6, 1), (7, 1), (8, 5), (9, 3)]


def leaks(rows, items, threshold=0.8):
    """Best similarity of any window as long as the item, windows cut at the text's end too."""
    cut = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    runs = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    out = {}
    for key, text in rows:
        doc = runs(cut(text))
        for item, passage in items:
            own, words, short = runs(cut(passage)), cut(text), cut(passage)
            if 0 < len(short) < 5 and any(
                words[i : i + len(short)] == short for i in range(len(words))
            ):
                out[key, item] = 1.0
            if own and doc:
                best = max(
                    similarity(Counter(doc[s : s + len(own)]), Counter(own))
                    for s in range(len(doc))
                )
                if best >= threshold:
                    out[key, item] = max(best, out.get((key, item), 0))
    return out


def test_leaks_are_those_of_all_windows(spark):
    items = [(i, " ".join(prose(15 + 3 * i, 500 + i))) for i in range(12)] + [
        (50, None), (51, ""), (52, "too short"), (53, "same same same same same same same same"),
        (None, " ".join(prose(20, 900))), (0, " ".join(prose(15, 500))),
    ]
    rows = list(odd.texts())
    for i in range(12):
        passage = items[i][1].split()
        for edits in range(4):
            inside = prose(40, i) + edited(passage, edits, 10 * i + edits) + prose(30, i + 50)
            rows.append((100 * i + edits, " ".join(inside)))
        rows.append((100 * i + 10, " ".join(prose(20, i) + passage[: len(passage) * 9 // 10])))
    rows += [(2000, "Same, same! " * 6), (2001, items[16][1].upper() + "!"), (2001, "again")]
    docs = odd.clashing(odd.documents(spark, rows))
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS n", "2 AS h")
    got = decontaminate.contaminated(docs, bench)
    found = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    assert found == pytest.approx(leaks(rows, items))
    kept = decontaminate.drop_contaminated(docs, bench)
    texts = {(k, t) for k, t in rows for i in items if leaks([(k, t)], [i])}
    assert kept.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(
        repr(r) for r in rows if r not in texts
    )
    assert decontaminate.contaminated(docs.limit(0), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == []
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == len(rows)


def test_items_under_five_words_are_found_as_they_are(spark):
    items = [(1, "Short item, four words"), (2, "four"), (3, "日本"), (4, "four WORDS"), (5, "!!"),
             (6, "a b"), (None, "none")]
    rows = [(1, "A short item: four words here"), (1, "short item four"), (2, "Four."), (3, "fourwords"),
            (4, "words four"), (5, "b a b a"), (6, None), (7, ""), (8, "日本"), (9, "日本語"),
            (None, "none"), (10, "short item four word")]
    docs = odd.clashing(odd.documents(spark, rows))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == leaks(rows, items)
    assert len(found) == 9
    kept = {(r.doc_id, r.text) for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert kept == {(k, t) for k, t in rows if not leaks([(k, t)], items)}


def test_no_text_that_ends_short_of_an_item_is_lost(spark):
    """Items of nine words and texts that end after their first eight: similarity 0.8 exactly."""
    items = [(i, " ".join(f"w{i}x{j}" for j in range(9))) for i in range(4000)]
    rows = [(i, f"before {t.rsplit(' ', 1)[0]}") for i, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(8)
    docs = odd.documents(spark, rows).repartition(8)
    found = decontaminate.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i, _ in items}


def test_the_radius_is_found_through_blocks():
    rng = random.Random(1)
    for _ in range(2000):
        bits = rng.sample(range(64), decontaminate.RADIUS)
        per_block = Counter(b // decontaminate.BLOCK_BITS for b in bits)
        assert min(per_block[k] for k in range(decontaminate.BLOCKS)) <= decontaminate.FLIPS


def test_simhash_is_the_majority_of_bits(spark):
    rng = random.Random(2)
    lists = [[rng.randrange(-(2**63), 2**63) for _ in range(n)] for n in (1, 2, 5, 50)] + [[]]
    rows = spark.createDataFrame([(x,) for x in lists], "h array<bigint>")
    got = {tuple(r.h): r.s for r in rows.select("h", decontaminate.simhash("h").alias("s")).collect()}
    for own in lists:
        bits = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own))
        assert got[tuple(own)] % 2**64 == bits


def test_no_python_in_decontamination(spark, capsys):
    docs = odd.documents(spark)
    items = spark.createDataFrame([(1, " ".join(prose(20, 1)))], "item_id long, text string")
    decontaminate.contaminated(docs, items).explain()
    plan = capsys.readouterr().out
    assert plan and not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
