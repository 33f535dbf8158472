"""Quality rules: text measures as column expressions and a decision list learned from labels."""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fleetpulse.llm.common import WHITE, whole_text, words
from fleetpulse.session import settle

# The characters that count as symbols, and the base rule's limits.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Measures the list may test, each a ratio that does not depend on the text's length.
MEASURES = {
    "word_length": "try_divide(word_chars, n_words)",
    "symbol_rate": "try_divide(n_symbols, n_words)",
    "upper_share": "try_divide(n_upper, word_chars)",
    "digit_share": "try_divide(n_digits, word_chars)",
    "exclaim_rate": "try_divide(n_exclaims, n_words)",
    "dup_line_share": "try_divide(n_dup_lines, greatest(n_lines, 1))",
    "repeat_share": "try_divide(n_repeat_words, n_words)",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def text_counts(docs: DataFrame) -> DataFrame:
    """``doc`` (the whole row), ``id`` and the counts of each text, all in one pass without a shuffle.

    ``n_repeat_words`` counts the words inside 3-word windows that occur at least twice in
    the text. The windows are hashed; only texts in which some hash repeats sort them.
    """
    text = F.col("text")
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").alias("id"),
        whole_text().alias("text"),
    )
    counted = base.select(
        "doc",
        "id",
        words(text).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0).alias("lines"),
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        _without(text, SYMBOLS).cast("long").alias("n_symbols"),
        _without(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _without(text, "0123456789").alias("n_digits"),
        _without(text, "!").alias("n_exclaims"),
    )
    kept = ["doc", "id", "word_chars", "n_symbols", "n_upper", "n_digits", "n_exclaims"]
    windows = counted.select(
        *kept,
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(w) >= 3 THEN transform(slice(w, 1, size(w) - 2),"
            " (x, i) -> xxhash64(x, get(w, i + 1), get(w, i + 2))) ELSE cast(array() as array<bigint>) END"
        ).alias("g"),
    )
    kept += ["n_words", "n_lines", "n_dup_lines"]
    ordered = windows.select(
        *kept,
        F.expr(
            "CASE WHEN size(array_distinct(g)) < size(g)"
            " THEN sort_array(transform(g, (h, i) -> struct(h as h, i as i))) END"
        ).alias("s"),
    )
    repeated = ordered.select(
        *kept,
        F.expr(
            "sort_array(transform(filter(s, (x, i) -> x.h <=> get(s, i - 1).h OR x.h <=> get(s, i + 1).h), x -> x.i))"
        ).alias("p"),
    )
    covered = F.expr(
        "aggregate(transform(p, (x, i) -> least(3, coalesce(get(p, i + 1) - x, 3))), 0, (a, x) -> a + x)"
    )
    return repeated.select(*kept, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    measure: str
    at_least: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        value = row[self.measure]
        return value >= self.threshold if self.at_least else value <= self.threshold

    def column(self) -> Column:
        value = F.expr(MEASURES[self.measure])
        return value >= self.threshold if self.at_least else value <= self.threshold


Rule = tuple[Condition, ...]


def covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _best_condition(bad: list[dict], good: list[dict]) -> Condition | None:
    """The threshold with the largest information gain for the bad rows."""
    before = math.log2(len(bad) / (len(bad) + len(good)))
    best, best_gain = None, 1e-9
    for measure in MEASURES:
        values = sorted([(r[measure], 1) for r in bad] + [(r[measure], 0) for r in good])
        for at_least in (True, False):
            p = n = 0
            run = values[::-1] if at_least else values
            for k, (value, is_bad) in enumerate(run):
                p, n = p + is_bad, n + 1 - is_bad
                if p and k + 1 < len(run) and run[k + 1][0] != value:
                    gain = p * (math.log2(p / (p + n)) - before)
                    if gain > best_gain:
                        best_gain = gain
                        best = Condition(measure, at_least, (value + run[k + 1][0]) / 2)
    return best


def _grow(bad: list[dict], good: list[dict], most: int) -> Rule:
    rule: Rule = ()
    while good and bad and len(rule) < most and (c := _best_condition(bad, good)):
        rule += (c,)
        bad, good = [r for r in bad if c.holds(r)], [r for r in good if c.holds(r)]
    return rule


def _prune(rule: Rule, bad: list[dict], good: list[dict]) -> Rule:
    """The prefix of the conditions with the best (p - n) / (p + n) on rows not used to grow it."""

    def worth(prefix: Rule) -> float:
        p, n = sum(covers(prefix, r) for r in bad), sum(covers(prefix, r) for r in good)
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def learn_list(rows: list[dict], min_precision: float = 0.95, max_conditions: int = 4, max_rules: int = 24) -> list[Rule]:
    """Sequential covering: grow a rule on two thirds of the rows, prune it on the rest, drop what it covers.

    ``rows`` have the measures and ``quality`` (0: reject). Ends with the first rule that
    is right in fewer than ``min_precision`` of the rows it covers, or covers under three.
    """
    bad, good = [r for r in rows if r["quality"] == 0], [r for r in rows if r["quality"] == 1]
    rules: list[Rule] = []
    while len(bad) >= 3 and len(rules) < max_rules:
        part = lambda some, rest: [r for k, r in enumerate(some) if (k % 3 == 2) is rest]
        grown = _grow(part(bad, False), part(good, False), max_conditions)
        rule = _prune(grown, part(bad, True), part(good, True))
        if not rule:
            break
        p, n = sum(covers(rule, r) for r in bad), sum(covers(rule, r) for r in good)
        if p < 3 or p < min_precision * (p + n):
            break
        rules.append(rule)
        bad, good = ([r for r in some if not covers(rule, r)] for some in (bad, good))
    return rules


def labelled_sample(counts: DataFrame, labels: DataFrame, max_labelled: int) -> list[dict]:
    """At most ``max_labelled`` labelled texts that pass the base rule, chosen by a hash of their id.

    A document labelled more than once counts with its lowest label; null labels are left out.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.min("quality").alias("quality"))
    )
    measured = counts.where(~base_failed()).select("id", *[F.expr(m).alias(name) for name, m in MEASURES.items()])
    chosen = (
        measured.join(known, F.col("id") == F.col("label_id"))
        .select(F.xxhash64("id").alias("turn"), "id", *MEASURES, "quality")
        .orderBy("turn", "id", *MEASURES)
        .limit(max_labelled)
    )
    return [r.asDict() for r in chosen.collect()]


def list_verdict(rules: list[Rule]) -> Column:
    """True to keep. The first rule that covers a text rejects it."""
    verdict = F.lit(None).cast("boolean")
    for rule in reversed(rules):
        all_hold = F.lit(True)
        for condition in rule:
            all_hold = all_hold & condition.column()
        verdict = F.when(all_hold, False).otherwise(verdict)
    return F.coalesce(verdict, F.lit(True))


def apply_rules(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``base_failed`` and ``kept``."""
    failed = base_failed()
    kept = F.when(failed, False).otherwise(list_verdict(rules))
    return counts.withColumns({"base_failed": failed, "kept": kept})


def judge(counts: DataFrame, labels: DataFrame, max_labelled: int = 6000) -> DataFrame:
    """Learn a decision list from ``labels`` (doc_id, quality) and apply it to all of ``counts``.

    ``counts`` comes from ``text_counts``; it is stored, since it is read twice and a filter
    must not take its array expressions apart. The list is learned on the driver from at most ``max_labelled`` rows of nine numbers; every text is
    then judged by Spark conditional expressions.

    Nulls and empty texts have no words and fail the base rule; without labels of both
    kinds the list is empty and the base rule alone decides. Repeated rows are judged alike.
    """
    counts = settle(counts, "counts")
    return apply_rules(counts, learn_list(labelled_sample(counts, labels, max_labelled)))


def keep_good(docs: DataFrame, labels: DataFrame, max_labelled: int = 6000) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the learned list.

    The counts are stored next to their rows, so they are taken once and no row is shuffled.
    """
    return judge(text_counts(docs), labels, max_labelled).where("kept").select("doc.*")
