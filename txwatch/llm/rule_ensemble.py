"""Quality classifier: a sparse ensemble of rules.

Shallow trees are grown on text statistics; every path to a node is a conjunctive rule. A lasso logistic
regression over the rules' truth values leaves few with a weight, and these compile into one column
expression, so scoring is a scan without Python, joins or shuffles. Labels are learnt from a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.llm.weak_rules import _let, statistics
from txwatch.session import materialise

#: Labelled rows used for fitting at most; which ones is decided by a hash of doc_id.
SAMPLE_ROWS = 20_000
TREES, DEPTH = 24, 3
LASSO = 0.001


def features(s: Column) -> dict[str, Column]:
    """Ratios of a statistics struct; finite for every text, the empty one included."""
    n, chars = F.greatest(s["n_words"], F.lit(1)), F.greatest(s["word_chars"], F.lit(1))
    return {
        "symbols_per_word": s["n_symbols"] / n,
        "symbol_share": s["n_symbols"] / chars,
        "upper_share": s["n_upper"] / chars,
        "shouts_per_word": s["n_shouts"] / n,
        "repeated_share": s["n_repeat_words"] / n,
        "distinct_share": s["n_distinct"] / n,
        "word_length": s["word_chars"] / n,
        "stops_per_word": s["n_stops"] / n,
        "dup_lines_per_word": s["n_dup_lines"] / n,
        "log_words": F.log1p(s["n_words"].cast("double")),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of tests (feature, whether the value must lie above, threshold)."""

    tests: tuple[tuple[str, bool, float], ...]

    def holds(self, values: dict[str, Column]) -> Column:
        return reduce(
            lambda a, b: a & b, [values[f] > F.lit(t) if above else values[f] <= F.lit(t) for f, above, t in self.tests]
        )


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self, s: Column) -> Column:
        """Probability of label 1 for a statistics struct."""
        values = features(s)
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(rule.holds(values), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _paths(node, names: list[str], tests: tuple = ()) -> list[Rule]:
    """The rules of all nodes below the root of one fitted tree (depth is bounded by DEPTH)."""
    rules = [Rule(tests)] if tests else []
    if node.subtreeDepth() > 0:
        feature, threshold = names[node.split().featureIndex()], node.split().threshold()
        rules += _paths(node.leftChild(), names, (*tests, (feature, False, threshold)))
        rules += _paths(node.rightChild(), names, (*tests, (feature, True, threshold)))
    return rules


def held_out() -> Column:
    """Rows never learnt from: crc32 of doc_id's text divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit to `labels` (doc_id, quality) outside the held-out rows, at most `sample_rows` of them and of their texts.

    Without both classes among the labels, the model is the smoothed share of label 1.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out())
        .select("doc_id", F.col("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample_rows)
    )
    # The bound on the sample bounds the broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    stats = texts.select("doc_id", "label", statistics(F.col("text")).alias("s"))
    values = features(F.col("s"))
    names = list(values)
    narrow = stats.select("doc_id", "label", F.array(*[v.cast("double") for v in values.values()]).alias("x"))
    # A doc_id may be repeated in either table, so the bound holds for what the join yields.
    rows = materialise(narrow.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "x").limit(sample_rows), "rule-sample")
    # One partition in a fixed order: the fit does not depend on how the table was dealt out.
    train = rows.coalesce(1).sortWithinPartitions("doc_id", "label").select("label", array_to_vector("x").alias("features"), "x")
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(counts) < 2:
        good, total = counts.get(1.0, 0), sum(counts.values())
        return RuleModel(log((good + 1) / (total - good + 1)), ())
    train = train.persist()
    try:
        forest = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=5, featureSubsetStrategy="0.5", subsamplingRate=0.8, seed=7
        ).fit(train)
        found = [r for tree in forest.trees for r in _paths(tree._java_obj.rootNode(), names)]
        rules = list(dict.fromkeys(found))
        by_name = {n: F.get("x", k) for k, n in enumerate(names)}
        truth = train.select(
            "label", array_to_vector(F.array(*[r.holds(by_name).cast("double") for r in rules])).alias("features")
        )
        lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=100).fit(truth)
    finally:
        train.unpersist()
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if w))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """All rows of `docs` (doc_id, text): doc_id, held_out, score and predicted."""
    model = learn(docs, labels)
    return docs.select(
        "doc_id", held_out().alias("held_out"), _let(statistics(F.col("text")), model.score).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
