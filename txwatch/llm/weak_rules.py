"""Quality rules under weak supervision (DataFrame functions only).

Rules over text statistics vote good (1), bad (-1) or abstain (0). How often each rule votes what on good and
on bad documents is estimated without labels by expectation-maximisation over the table of vote patterns. The
table has at most 3**rules rows at every size of the corpus; the corpus is only counted, by a combinable
aggregate. The posterior probability of good quality compiles into a column expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.llm.text import SPACES
from txwatch.session import materialise

SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _size(c: Column) -> Column:
    return F.size(c).cast("long")


def _covered(words: Column, n: Column) -> Column:
    """Words inside runs of five words that occur twice or more in the text.

    Most texts have no repeated run; hashes show that. Only where two hashes agree are the runs themselves
    sorted, so the answer is exact.
    """
    starts = F.sequence(F.lit(1), n - 4)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(5))))
    runs = F.sort_array(
        F.transform(starts, lambda i: F.struct(F.concat_ws(" ", F.slice(words, i, F.lit(5))).alias("w"), i.alias("i")))
    )

    def repeated(s: Column) -> Column:
        at = lambda k: F.try_element_at(s, k)["w"]
        marked = F.filter(
            s,
            lambda x, k: (F.when(k > 0, at(k) == x["w"]).otherwise(F.lit(False)))
            | F.coalesce(at(k + 2) == x["w"], F.lit(False)),
        )
        return F.sort_array(F.transform(marked, lambda x: x["i"]))

    def union(starts: Column) -> Column:
        first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(5), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(starts, first, step, lambda a: a["n"])

    exact = _let(runs, lambda s: union(repeated(s)))
    zero = F.lit(0).cast("long")
    return F.when(n < 6, zero).otherwise(
        _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(exact))
    )


def statistics(text: Column) -> Column:
    """A struct of counts over one whole text; null and empty texts count nothing."""
    text = F.coalesce(text, F.lit(""))
    length = F.char_length(text)

    def less(pattern: str) -> Column:
        return (length - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")

    def body(words: Column) -> Column:
        n = F.size(words)
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            n.cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            less("[#*$%&|<>]+").alias("n_symbols"),
            _let(lines, lambda x: _size(x) - _size(F.array_distinct(x))).alias("n_dup_lines"),
            _covered(words, n).alias("n_repeat_words"),
            _size(F.array_distinct(words)).alias("n_distinct"),
            less("[A-Z]+").alias("n_upper"),
            less("[!?]+").alias("n_shouts"),
            less("[.,;:]+").alias("n_stops"),
        )

    return _let(F.array_remove(F.split(text, SPACES), ""), body)


def votes(s: Column) -> dict[str, Column]:
    """The rules' votes for a statistics struct. Each kind of fault is seen by two rules or more."""
    n = F.greatest(s["n_words"], F.lit(1))
    per_word = lambda name: s[name] / n
    share = lambda name: s[name] / F.greatest(s["word_chars"], F.lit(1))
    power = lambda c, times: reduce(Column.__mul__, [c.cast("double")] * times)
    bad = lambda test: F.when(test, -1).otherwise(0)
    length = s["word_chars"] / n
    return {
        "symbols": bad(per_word("n_symbols") > 0.15),
        "symbol_share": bad(share("n_symbols") > 0.03),
        "capitals": bad(share("n_upper") > 0.3),
        "shouts": bad(per_word("n_shouts") > 0.2),
        "repeats": bad(per_word("n_repeat_words") > 0.15),
        # The vocabulary of a text grows more slowly than the text: fewer distinct words than n ** 0.75 are too few.
        "vocabulary": bad(power(s["n_distinct"], 4) < power(s["n_words"], 3)),
        "lines": bad(per_word("n_dup_lines") > 0.02),
        "word_length": bad((length > 9.5) | (length < 2.5)),
        "calm": F.when(
            (share("n_symbols") < 0.01) & (per_word("n_shouts") < 0.05) & (share("n_upper") < 0.15)
            & (per_word("n_repeat_words") < 0.05), 1
        ).otherwise(0),
        "prose": F.when((per_word("n_stops") > 0.03) & (per_word("n_stops") < 0.4) & (length > 3) & (length < 9), 1).otherwise(0),
    }


@dataclass(frozen=True)
class VoteModel:
    """Log odds of good quality: a prior, and one number per rule and vote."""

    prior: float
    odds: dict[str, dict[int, float]]

    def posterior(self, cast: dict[str, Column]) -> Column:
        total = F.lit(self.prior)
        for rule, by_vote in self.odds.items():
            choice = F.lit(by_vote[0])
            for vote in (-1, 1):
                choice = F.when(cast[rule] == vote, F.lit(by_vote[vote])).otherwise(choice)
            total = total + choice
        return 1 / (1 + F.exp(-total))


def fit(patterns: list[tuple[tuple[int, ...], int]], rules: list[str], rounds: int = 50) -> VoteModel:
    """Expectation-maximisation over (votes, count) pairs; starts from the sign of each pattern's sum.

    Counts are smoothed by one vote per rule, class and outcome. A pattern without any vote counts as good
    at the start. An empty corpus gives the smoothed prior.
    """
    patterns = sorted(patterns)
    good = [0.1 if sum(p) < 0 else 0.9 for p, _ in patterns]
    model = VoteModel(0.0, {r: {-1: 0.0, 0: 0.0, 1: 0.0} for r in rules})
    for _ in range(rounds):
        sums = [1.0, 1.0]
        tables = [[{-1: 1.0, 0: 1.0, 1: 1.0} for _ in rules] for _ in range(2)]
        for (pattern, count), g in zip(patterns, good):
            for side, weight in ((0, count * (1 - g)), (1, count * g)):
                sums[side] += weight
                for j, vote in enumerate(pattern):
                    tables[side][j][vote] += weight
        odds = {
            r: {v: log(tables[1][j][v] / sums[1]) - log(tables[0][j][v] / sums[0]) for v in (-1, 0, 1)}
            for j, r in enumerate(rules)
        }
        model = VoteModel(log(sums[1] / sums[0]), odds)
        good = [
            1 / (1 + exp(-max(-500.0, min(500.0, model.prior + sum(odds[r][v] for r, v in zip(rules, pattern))))))
            for pattern, _ in patterns
        ]
    return model


def learn(stats: DataFrame, column: str = "s") -> VoteModel:
    """Fit the rules' behaviour to all rows of a table with a statistics struct."""
    cast = votes(F.col(column))
    rules = list(cast)
    counted = stats.select(*[v.alias(r) for r, v in cast.items()]).groupBy(*rules).count()
    return fit([(tuple(r[:-1]), r[-1]) for r in counted.collect()], rules)  # at most 3**rules rows


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 10) | (s["n_repeat_words"] * 100 > s["n_words"] * 20)


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """All rows of `docs` (doc_id, text): doc_id, statistics, base_failed, posterior and kept."""
    stats = materialise(docs.select("doc_id", statistics(F.col("text")).alias("s")), "rule-statistics")
    model = learn(stats)
    failed = base_failed(F.col("s"))
    posterior = model.posterior(votes(F.col("s")))
    return stats.select(
        "doc_id", "s.*", failed.alias("base_failed"), posterior.alias("posterior"),
        (~failed & (posterior >= threshold)).alias("kept"),
    )


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that pass, all columns unchanged. Statistics are taken twice rather than shuffled."""
    judged = statistics(F.col("text"))
    model = learn(docs.select(judged.alias("s")))

    def passes(s: Column) -> Column:
        return ~base_failed(s) & (model.posterior(votes(s)) >= threshold)

    return docs.where(_let(judged, passes))
