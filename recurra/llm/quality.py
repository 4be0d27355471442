"""Text quality by a sparse ensemble of rules over statistics.

Every node of a small random forest is a conjunction of comparisons of statistics. These rules,
as columns of zeros and ones, go into a logistic regression with lasso penalty, which leaves few
of them with a weight. The fitted model is a Spark column over the statistics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from recurra.llm.common import free_name, map_batches, texts_of
from recurra.session import stage

#: Labelled rows to fit on, at most about; chosen by a hash of the id from all labelled rows.
FIT_ROWS = 20_000

#: Files of the (small) table that a model is fitted on.
FIT_FILES = 2

STATISTICS = (
    "log_chars", "log_words", "word_length", "longest_word", "distinct_words", "upper", "digits",
    "spaces", "stops", "bangs", "pipes", "symbols", "other_bytes", "line_words",
    "repeated_lines", "word_ends",
)
_STRUCT = "struct<" + ", ".join(f"{s}: double" for s in STATISTICS) + ">"
#: Fixed character classes behind the statistics.
_STOPS, _BANGS, _SYMBOLS = b".,;:", b"!?", b"#$%&*+/<=>@[\\]^_`{}~"


def text_statistics(text: str) -> tuple[float, ...]:
    """The statistics of one whole text; shares are of bytes unless their name says otherwise."""
    data = np.frombuffer(text.encode(), np.uint8)
    seen = np.bincount(data, minlength=256)
    words, lines = text.split(), text.split("\n")
    n, w = max(1, len(data)), max(1, len(words))
    of = lambda chars: seen[list(chars)].sum() / n
    return (
        math.log1p(len(text)), math.log1p(len(words)),
        sum(map(len, words)) / w, float(max(map(len, words), default=0)),
        len(set(words)) / w, seen[65:91].sum() / n, seen[48:58].sum() / n, of(b" "),
        of(_STOPS), of(_BANGS), of(b"|"), of(_SYMBOLS), seen[128:].sum() / n,
        w / len(lines), 1 - len(set(lines)) / len(lines), (seen[46] + seen[10]) / w,
    )


def with_statistics(
    docs: DataFrame, name: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all, if not given) and a struct of statistics called ``name``."""
    kept = docs.columns if keep is None else keep
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def measure(batch):
        rows = np.array([text_statistics(t) for t in texts_of(batch, text)])
        columns = [pa.array(rows[:, i]) for i in range(len(STATISTICS))]
        made = {c: batch.column(c) for c in kept}
        return made | {name: pa.StructArray.from_arrays(columns, names=list(STATISTICS))}

    source = docs.select(*dict.fromkeys([*kept, text]))
    return map_batches(source, f"{fields}, `{name}` {_STRUCT}", measure)


Rule = tuple[tuple[str, str, float], ...]


@dataclass(frozen=True)
class RuleModel:
    """Weights of rules; a rule is a conjunction of (statistic, "<=" or ">", threshold)."""

    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, statistics: str) -> Column:
        """The probability of a good text as a column over the struct of statistics."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + F.when(_holds(rule, statistics), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _holds(rule: Rule, statistics: str) -> Column:
    column = F.lit(True)
    for name, side, threshold in rule:
        value = F.col(f"{statistics}.{name}")
        column = column & (value <= threshold if side == "<=" else value > threshold)
    return column


def _rules(forest) -> list[Rule]:
    """The path to every node of every tree, each once, without what a later split implies."""
    found: dict[Rule, None] = {}

    def walk(node, path: dict) -> None:
        if path:
            found[tuple(sorted((n, s, t) for (n, s), t in path.items()))] = None
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            name, threshold = STATISTICS[split.featureIndex()], split.threshold()
            walk(node.leftChild(), path | {(name, "<="): threshold})
            walk(node.rightChild(), path | {(name, ">"): threshold})

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def held_out(key: str, of: int = 5) -> Column:
    """Whether CRC-32 of the id as text is divisible by ``of``; false for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % of == 0, F.lit(False))


def fit_rules(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
    text: str = "text", fit_rows: int = FIT_ROWS, trees: int = 24, depth: int = 3,
    penalty: float = 0.001, seed: int = 7,
) -> RuleModel:
    """Fit on labelled rows that are not held out.

    Null labels and ids are no labels; of several labels of an id the mean decides, 0.5 for 1.
    Without rows of both labels the score is the same for all texts: the share of label 1, or
    0.5 without any label.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
        .groupBy(F.col(key)).agg((F.avg(label) >= 0.5).cast("double").alias("_label"))
    )
    total = known.count()
    chosen = known.where(
        F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(10**6)) < 10**6 * fit_rows / max(total, fit_rows)
    )
    rows = docs.select(key, text).join(F.broadcast(chosen), key)  # fit_rows ids and labels
    rows = with_statistics(rows, "_stats", text, ["_label"])
    # In few files, as each of the many short passes of a fit has a task for each.
    rows = stage(rows, "quality-statistics")
    rows = stage(rows.coalesce(FIT_FILES), "quality-fit")
    ones, count = rows.agg(F.sum("_label"), F.count(F.lit(1))).first()
    if not count or ones in (0, count):
        share = (ones + 1) / (count + 2) if count else 0.5
        return RuleModel(math.log(share / (1 - share)), ())
    names = [f"_stats.{s}" for s in STATISTICS]
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="_x").transform(
        rows.select("_label", *names)
    )
    forest = RandomForestClassifier(
        featuresCol="_x", labelCol="_label", numTrees=trees, maxDepth=depth, seed=seed,
        featureSubsetStrategy="onethird",
    ).fit(vectors)
    rules = _rules(forest)
    fitted = LogisticRegression(
        featuresCol="_x", labelCol="_label", weightCol="_weight", regParam=penalty,
        elasticNetParam=1.0, maxIter=60, standardization=False,
    ).fit(_weighted_marks(rows, rules))
    weights = fitted.coefficients.toArray()
    kept = tuple((r, float(w)) for r, w in zip(rules, weights) if w != 0)
    return RuleModel(float(fitted.intercept), kept)


def _weighted_marks(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Which rules hold (``_x``) for each label, rows that agree in both as one with a weight."""
    from pyspark.ml.functions import array_to_vector

    def mark(batch):
        statistics = batch.column("_stats")
        values = {s: statistics.field(s).to_numpy(zero_copy_only=False) for s in STATISTICS}
        held = np.ones((batch.num_rows, len(rules)), bool)
        for i, rule in enumerate(rules):
            for name, side, threshold in rule:
                below = values[name] <= threshold
                held[:, i] &= below if side == "<=" else ~below
        packed = np.packbits(held, axis=1)
        return {"_label": batch.column("_label"), "_held": [r.tobytes() for r in packed]}

    def unpack(batch):
        packed = np.array([np.frombuffer(b, np.uint8) for b in batch.column("_held").to_pylist()])
        held = np.unpackbits(packed, axis=1)[:, : len(rules)].astype(float)
        return {"_label": batch.column("_label"), "_weight": batch.column("_weight"),
                "_marks": list(held)}

    agreeing = map_batches(rows, "_label double, _held binary", mark).groupBy(
        "_label", "_held"
    ).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    marks = map_batches(agreeing, "_label double, _weight double, _marks array<double>", unpack)
    written = stage(marks.coalesce(FIT_FILES), "quality-marks")
    return written.select("_label", "_weight", array_to_vector("_marks").alias("_x"))


def score_quality(
    docs: DataFrame, model: RuleModel, threshold: float = 0.3, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: key, held_out, score and predicted (1 from ``threshold`` on).

    A null text counts as empty and is scored. Repeated rows and null keys give a row each;
    other columns are left out, so none can clash; an empty table gives none.
    """
    scored = with_statistics(docs, "_stats", text, [key])
    return scored.select(
        key, held_out(key).alias("held_out"), model.score("_stats").alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame, model: RuleModel, threshold: float = 0.3, text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    name = free_name(docs, "_stats")
    scored = with_statistics(docs, name, text)
    return scored.where(model.score(name) >= threshold).select(docs.columns)
