"""Quality rules: text statistics and a decision list learned from labelled documents.

Statistics are SQL expressions over the whole text. The list is learned by
sequential covering: a rule is a conjunction of threshold conditions, grown
condition by condition by information gain on two thirds of the labelled rows,
pruned on the other third, kept if it is precise there, and its rows are removed
before the next rule is grown. All counting is aggregation in Spark; the driver
sees only counts per (statistic, bin, class). The learned list is emitted as an
ordered conditional expression.

Defined cases: null or empty text has no words; rows of one id are judged each
on its own text. Labels with a null id or class are left out, an id labelled
twice counts with its lowest class. Without labels, or with one class only, the
list is empty and the method keeps everything.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_features.llm.frames import SPACE, SPACE_CLASS, let, words_of
from merchant_features.sources.storage import materialize

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30

#: What rules may test: a count, or a count over another, which does not grow with the length of the text.
FEATURES = {
    "n_words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
}


def feature(name: str) -> Column:
    """A statistic as a rule sees it; an undefined ratio is 0."""
    over, under = FEATURES[name]
    value = F.col(over).cast("double")
    return value if under is None else F.coalesce(F.try_divide(value, F.col(under)), F.lit(0.0))


def _repeat_words(words: Column) -> Column:
    """Words in 8-word windows that occur twice or more in the array."""

    def covered(starts: Column) -> Column:
        # a window adds the words up to the next repeated window's start, the last one all its words
        nexts = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.lit(2**30)))
        steps = F.zip_with(starts, nexts, lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def repeated(pairs: Column) -> Column:
        # neighbours in the sorted (hash, start) pairs with equal hashes
        hits = F.filter(
            pairs,
            lambda p, i: ((i > 0) & (p["h"] == F.get(pairs, i - 1)["h"]))
            | F.coalesce(p["h"] == F.get(pairs, i + 1)["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(hits, lambda p: p["at"])), covered)

    def of_windows(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(pairs, repeated))

    def of_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
        return let(windows, of_windows)

    return F.when(F.size(words) < WINDOW, 0).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes))


def _removed(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: the id as ``id``, the text's hash as ``tag``, and the counts."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    counted = texts.select(
        "id",
        F.xxhash64("text").alias("tag"),
        _removed(text, "[#*$%&|<>]").cast("long").alias("n_symbols"),
        _removed(text, "[!?]").cast("long").alias("n_marks"),
        _removed(text, "[A-Z]").cast("long").alias("n_upper"),
        let(words_of(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
    )
    return counted.select("id", "tag", "n_symbols", "n_marks", "n_upper", "w.*", "l.*")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _matches(rule: Rule) -> Column:
    matched = F.lit(True)
    for condition in rule:
        matched = matched & condition.column()
    return matched


def learn_rules(
    statistics: DataFrame, labels: DataFrame, id_col: str = "doc_id", class_col: str = "quality", bins: int = 32,
    max_rules: int = 8, max_conditions: int = 3, min_precision: float = 0.97, min_rows: int = 5,
) -> list[Rule]:
    """Rules for the class 0, most general counts first grown; ``statistics`` as by ``text_statistics``."""
    classes = (
        labels.where(F.col(id_col).isNotNull() & F.col(class_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.min(class_col) == 0).alias("bad"))
    )
    fold = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(3))
    rows = materialize(statistics.join(classes, "id").withColumn("grow", fold != 0))
    names = list(FEATURES)
    cuts = [(i + 1) / bins for i in range(bins - 1)]
    found = rows.agg(*[F.percentile_approx(feature(n), cuts, 10_000).alias(n) for n in names])
    thresholds = {n: sorted(set(v or [])) for n, v in found.first().asDict().items()}

    def binned(name: str) -> Column:
        value = feature(name)
        below = F.filter(F.array(*[F.lit(float(t)) for t in thresholds[name]]).cast("array<double>"), lambda t: t < value)
        return F.size(below)

    bins_of = rows.select(*[c for c in rows.columns], F.array(*[binned(n) for n in names]).alias("bins"))
    bins_of = materialize(bins_of)

    def grown(left: DataFrame, rule: Rule) -> Rule:
        counts = (
            left.where(F.col("grow") & _matches(rule))
            .select("bad", F.posexplode("bins"))
            .groupBy("pos", "col", "bad")
            .count()
            .collect()
        )
        at = {(r["pos"], r["col"], r["bad"]): r["count"] for r in counts}
        bad = sum(n for (f, _, b), n in at.items() if f == 0 and b)
        good = sum(n for (f, _, b), n in at.items() if f == 0 and not b)
        if not bad or not good and rule:
            return rule
        best, best_gain = None, 1e-9
        for f, name in enumerate(names):
            p = n = 0
            for k, threshold in enumerate(thresholds[name]):
                p, n = p + at.get((f, k, True), 0), n + at.get((f, k, False), 0)
                for above, pos, neg in ((False, p, n), (True, bad - p, good - n)):
                    if pos >= min_rows:
                        gain = pos * (math.log2(pos / (pos + neg)) - math.log2(bad / (bad + good)))
                        if gain > best_gain:
                            best, best_gain = Condition(name, above, threshold), gain
        return rule if best is None else (*rule, best)

    def pruned(left: DataFrame, rule: Rule) -> tuple[Rule, float]:
        heads = [rule[: k + 1] for k in range(len(rule))]
        hit = left.where(~F.col("grow")).agg(
            *[F.count_if(_matches(h) & F.col("bad")).alias(f"bad_{k}") for k, h in enumerate(heads)],
            *[F.count_if(_matches(h) & ~F.col("bad")).alias(f"good_{k}") for k, h in enumerate(heads)],
        ).first()
        scored = []
        for k, head in enumerate(heads):
            pos, neg = hit[f"bad_{k}"], hit[f"good_{k}"]
            scored.append(((pos - neg) / max(pos + neg, 1), -k, head, pos / max(pos + neg, 1), pos))
        _, _, head, precision, pos = max(scored, key=lambda s: s[:2])
        return head, precision if pos >= min_rows else 0.0

    rules: list[Rule] = []
    left = bins_of
    while len(rules) < max_rules:
        rule: Rule = ()
        while len(rule) < max_conditions and (longer := grown(left, rule)) != rule:
            rule = longer
        if not rule:
            break
        rule, precision = pruned(left, rule)
        if precision < min_precision:
            break
        rules.append(rule)
        left = left.where(~_matches(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional: false for what the first matching rule rejects, else true."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(_matches(rule), F.lit(False)).otherwise(kept)
    return kept


def judged(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str = "quality",
    **learning,
) -> DataFrame:
    """Statistics of every row with ``base_failed`` and ``kept``."""
    statistics = materialize(text_statistics(docs, id_col, text_col))
    rules = learn_rules(statistics, labels, id_col, class_col, **learning)
    failed = base_failed()
    return statistics.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; judged as in ``judged``, in place."""
    statistics = materialize(text_statistics(docs, id_col, text_col))
    rules = learn_rules(statistics, labels, id_col)
    rejected = statistics.where(base_failed() | ~verdict(rules)).select("id", "tag").distinct()
    tag = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    same = docs[id_col].eqNullSafe(rejected["id"]) & (tag == rejected["tag"])
    return docs.join(rejected, same, "left_anti")
