"""Quality rules as a learned decision list, in DataFrame functions only.

Statistics of every whole text are computed once. From the labelled ones a list of rules is learned by
sequential covering: a rule grows by the threshold condition of highest information gain, is pruned on rows
held back, and the documents it covers are set aside before the next rule. Each step is one distributed
count per statistic and threshold; only those counts reach the driver. The list ends as one ordered
conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import let, native_words, stored

# Ratios the conditions may use. All are per word, per line or per character, so copies and lengths do not matter.
FEATURES = {
    "mean_word": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_upper", "word_chars"),
    "marks": ("n_marks", "n_words"),
    "digits": ("n_digits", "word_chars"),
}
LABELLED_ROWS = 20_000  # bound of the labelled sample the rules are learned from
THRESHOLDS = 24
MAX_RULES = 8
MAX_CONDITIONS = 3
LEAST_PRECISION = 0.97
LEAST_COVERED = 3


def _count(text: Column, chars: str) -> Column:
    """Number of characters of the class `[chars]`."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text, the first occurrence included.

    Windows are compared by a 64-bit hash. Where all differ nothing is left to do; else the windows are sorted with their
    positions, equal neighbours mark repeated ones, and their stretches of three words are united.
    """
    n = F.size(words)
    keys = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))

    def covered(keys: Column) -> Column:
        ordered = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            twins = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
            return F.sort_array(F.transform(twins, lambda x: x["i"]))

        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(let(ordered, repeated), zero, lambda a, p: F.struct(
            p.alias("last"), (a["total"] + F.least(F.lit(3), p - a["last"])).alias("total")), lambda a: a["total"])

    return let(keys, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0).cast("long")).otherwise(covered(k)))


def _lines(text: Column) -> Column:
    """The lines of a text that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _counts(text: Column, words: Column, lines: Column) -> list[Column]:
    """The statistics from a text, its words and its lines."""
    return [
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _count(text, "#*$%&|<>").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        _count(text, "A-Z").alias("n_upper"),
        _count(text, "!?").alias("n_marks"),
        _count(text, "0-9").alias("n_digits"),
    ]


def _ratios(of: Callable[[str], Column] = F.col) -> list[Column]:
    return [F.try_divide(of(a), of(b)).alias(f"f_{name}") for name, (a, b) in FEATURES.items()]


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id with the counts of its whole text; a null text has no words and zeros throughout. Further columns of
    `docs` are ignored; repeated rows and null doc_ids are kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    worded = docs.select("doc_id", text.alias("text"), native_words(F.col("text")).alias("words"), _lines(text).alias("lines"))
    return worded.select("doc_id", *_counts(F.col("text"), F.col("words"), F.col("lines")))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, of: Callable[[str], Column] = F.col) -> Column:
        """Never null: a statistic without a value fulfils no condition."""
        value = of(f"f_{self.feature}")
        return F.coalesce(value >= self.threshold if self.above else value < self.threshold, F.lit(False))


Rule = tuple[Condition, ...]


def covers(rule: Rule, of: Callable[[str], Column] = F.col) -> Column:
    return reduce(lambda a, b: a & b, (c.column(of) for c in rule), F.lit(True))


def with_features(stats: DataFrame) -> DataFrame:
    return stats.select("*", *_ratios())


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """A decision list for the rows with `reject` = 1, from a stored table with `doc_id`, `reject` (0 or 1) and f_* columns.

    Thresholds are quantiles of each statistic over the rejected and over the other rows. Two thirds of the rows, by
    a hash of doc_id, grow a rule and one third prunes it. A rule is kept if at least LEAST_PRECISION of the rows it
    covers there are to be rejected; where it fails, no later rule starts from the same statistic. Without labelled rows of both kinds the list is empty.
    """
    marks = [i / THRESHOLDS for i in range(THRESHOLDS + 1)]
    names = list(FEATURES)
    cuts = labelled.groupBy("reject").agg(*(F.percentile_approx(f"f_{f}", marks, 1000).alias(f) for f in names)).collect()
    if {row["reject"] for row in cuts} != {0, 1}:
        return []
    edges = {f: sorted({e for row in cuts for e in row[f] or ()}) for f in names}
    prunes = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0

    def rank(f: str) -> Column:
        return F.when(F.col(f"f_{f}").isNull(), -1).otherwise(
            F.size(F.filter(F.array(*map(F.lit, edges[f])), lambda e: e <= F.col(f"f_{f}"))))

    # With the rank of every statistic among its thresholds, a step needs no more than counts per rank.
    ranked = labelled.select("*", prunes.alias("prunes"), F.array(*(
        F.struct(F.lit(i).alias("f"), rank(f).alias("rank")) for i, f in enumerate(names) if edges[f])).alias("ranks"))
    ranked = stored(ranked, "ranked")

    def best(rows: DataFrame, features: list[str]) -> Condition | None:
        counts = rows.select("reject", F.explode("ranks").alias("r")).groupBy("r.f", "r.rank").agg(
            F.sum("reject").alias("bad"), F.sum(1 - F.col("reject")).alias("good")).collect()
        per: dict[str, dict[int, tuple[int, int]]] = {}
        for row in counts:
            per.setdefault(names[row["f"]], {})[row["rank"]] = (row["bad"], row["good"])
        if not per:
            return None
        every = next(iter(per.values())).values()
        bad, good = sum(x for x, _ in every), sum(y for _, y in every)
        if not bad or not good:
            return None
        start = math.log2(bad / (bad + good))
        chosen, top = None, (1e-9, 0)
        for f in features:
            ranks = per.get(f, {})
            for k in range(1, len(edges[f])):
                for above in (True, False):
                    inside = [v for r, v in ranks.items() if r >= 0 and (r > k) == above]
                    p, q = sum(x for x, _ in inside), sum(y for _, y in inside)
                    if p and (score := (p * (math.log2(p / (p + q)) - start), -q)) > top:
                        chosen, top = Condition(f, above, edges[f][k]), score
        return chosen

    rules: list[Rule] = []
    starts = list(names)  # statistics a rule may start from
    while starts and len(rules) < MAX_RULES:
        left = ranked.where(reduce(lambda a, b: a & b, (~covers(r) for r in rules), F.lit(True)))
        grown: list[Condition] = []
        while len(grown) < MAX_CONDITIONS:
            condition = best(left.where(~F.col("prunes") & covers(tuple(grown))), names if grown else starts)
            if condition is None:
                break
            grown.append(condition)
        if not grown:
            break
        tried = [tuple(grown[:k]) for k in range(1, len(grown) + 1)]
        row = left.where("prunes").agg(*(x for k, r in enumerate(tried) for x in (
            F.coalesce(F.sum(covers(r).cast("int") * F.col("reject")), F.lit(0)).alias(f"p{k}"),
            F.coalesce(F.sum(covers(r).cast("int") * (1 - F.col("reject"))), F.lit(0)).alias(f"n{k}")))).first()
        k = max(range(len(tried)), key=lambda k: ((row[f"p{k}"] - row[f"n{k}"]) / (row[f"p{k}"] + row[f"n{k}"] + 1), -k))
        if row[f"p{k}"] >= LEAST_COVERED and row[f"p{k}"] >= LEAST_PRECISION * (row[f"p{k}"] + row[f"n{k}"]):
            rules.append(tried[k])
        else:
            starts.remove(grown[0].feature)
    return rules


def describe(rule: Rule) -> str:
    return " and ".join(f"{c.feature} {'>=' if c.above else '<'} {c.threshold:.4g}" for c in rule)


def decision(rules: Sequence[Rule]) -> Column:
    """The number of the first rule that covers a row, counted from 1; null where none does."""
    if not rules:
        return F.lit(None).cast("int")
    return reduce(lambda w, r: w.when(covers(r[1]), F.lit(r[0])), enumerate(rules[1:], 2), F.when(covers(rules[0]), F.lit(1)))


def base_failed(of: Callable[[str], Column] = F.col) -> Column:
    words, repeats = of("n_words"), of("n_repeat_words")
    return (words < 50) | (100 * repeats > 50 * words)


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id and reject of at most LABELLED_ROWS labelled documents, by a hash of doc_id. Repeated labels of a document count once;
    where they contradict each other it is to be rejected."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(1 - F.col("quality")).cast("int").alias("reject"))
    return known.orderBy(F.xxhash64("labelled"), "labelled").limit(LABELLED_ROWS)


def rules_from(docs: DataFrame, labels: DataFrame, measure: Callable[[DataFrame], DataFrame]) -> list[Rule]:
    """The decision list for the labelled documents that pass the base test. `measure` gives the statistics of the rows of `docs` that
    have a label; at most LABELLED_ROWS ids are sent to the tasks."""
    known = F.broadcast(labelled(labels))
    marked = docs.join(known.select("labelled"), F.col("doc_id") == F.col("labelled"), "left_semi")
    stats = measure(marked).where(~base_failed()).join(known, F.col("doc_id") == F.col("labelled"))
    return learn_rules(stored(stats.select("doc_id", "reject", *(f"f_{f}" for f in FEATURES)), "labelled"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that `judge_quality` keeps, with all their columns.

    The learned list filters the texts where they are read, so no text is shuffled. The whole verdict is one expression whose
    steps are bound to each other; as columns of their own they would be copied into the pushed-down filter.
    """
    # The statistics are stored before a filter meets them, which would copy their expressions.
    rules = rules_from(docs, labels, lambda marked: stored(with_features(text_statistics(marked)), "quality"))
    text = F.coalesce(F.col("text"), F.lit(""))

    def good(n: Column) -> Column:
        kept = let(F.struct(*_ratios(lambda name: n[name])), lambda f: reduce(
            lambda a, b: a & b, (~covers(r, lambda name: f[name]) for r in rules), F.lit(True)))
        return ~base_failed(lambda name: n[name]) & kept

    return docs.where(let(native_words(F.col("text")), lambda words: let(
        _lines(text), lambda lines: let(F.struct(*_counts(text, words, lines)), good))))


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, the number of the learned rule that rejects, and that rule.

    Rules are learned from at most LABELLED_ROWS labelled documents, of which those that pass the base test count (`labels`: doc_id,
    quality 0 or 1; null labels are ignored, repeated ones of a document count once, and 0 where they contradict). A document fails the base test with under 50 words, or if more than half of them lie in repeated 3-word windows.
    Null and empty texts have no words and fail. Repeated rows are judged each; an empty table gives no rows.
    """
    stats = stored(with_features(text_statistics(docs)), "quality")
    rules = rules_from(stats, labels, lambda marked: marked)
    failed = base_failed()
    texts = F.create_map(*(x for i, r in enumerate(rules, 1) for x in (F.lit(i), F.lit(describe(r))))) if rules else None
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        decision(rules).alias("rule_id")).select(
        "*", (~F.col("base_failed") & F.col("rule_id").isNull()).alias("kept"),
        (F.try_element_at(texts, F.col("rule_id")) if texts is not None else F.lit(None).cast("string")).alias("rule"))
