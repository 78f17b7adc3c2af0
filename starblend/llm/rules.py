"""Quality rules as a learned decision list, in DataFrame expressions only.

Each text gives a row of statistics.  From the labelled rows, sequential covering learns rules for poor texts: a rule
grows by the threshold condition with the greatest information gain on two thirds of the rows still uncovered, is cut
back to the length that does best on the other third, and is kept if it is precise there.  All candidates of a
step are counted in one aggregation over the bins of every statistic, so the driver sees a grid of counts.
The list becomes one ordered CASE expression.

Defined cases: a null or empty text has no words and fails the base rule.  Labels of null or of other values are not
learned from; where no row or only one class is labelled the list is empty and keeps all that passes the base rule.
Null ids are scored, never learned from.  Repeated rows are judged alike.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starblend.llm.common import held_out
from starblend.workspace import Workspace

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!\"'()+,-./:;=?@[\\]^_`{}~"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
WINDOW = 8

#: Statistics that conditions may name, as SQL over the columns of ``statistics``.
RATES = {
    "symbols_per_char": "n_symbols / greatest(word_chars, 1)",
    "marks_per_char": "n_marks / greatest(word_chars, 1)",
    "upper_per_char": "n_upper / greatest(word_chars, 1)",
    "digits_per_char": "n_digits / greatest(word_chars, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "distinct_per_word": "n_distinct / greatest(n_words, 1)",
    "repeats_per_word": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines_per_line": "n_dup_lines / greatest(n_lines, 1)",
}


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeats(words: Column) -> Column:
    """Words that lie in a window of 8 words which stands in the text twice or more."""
    gap = F.lit(WINDOW)

    def windows(h: Column) -> Column:
        place = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(place, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))))

    def covered(p: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(p) - 1)
        return F.aggregate(steps, gap, lambda a, k: a + F.least(gap, F.get(p, k) - F.get(p, k - 1)))

    def twice(s: Column) -> Column:
        def at(j: Column) -> Column:
            return F.get(s, j)["x"]

        found = F.transform(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda j: F.when((at(j) == at(j - 1)) | (at(j) == at(j + 1)), F.get(s, j)["i"]),
        )
        return let(F.sort_array(F.array_compact(found)), covered)

    def count(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) < F.size(w), let(ordered, twice)).otherwise(F.lit(0))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(hashed, lambda h: let(windows(h), count))).otherwise(F.lit(0))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every whole text, all long."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def chars(of: str, value: Column = text) -> Column:
        return F.length(value) - F.length(F.translate(value, of, ""))

    words = F.filter(F.split(F.translate(text, SPACES[1:], " " * (len(SPACES) - 1)), " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"), _repeats(w).alias("repeats"))

    def of_lines(line: Column) -> Column:
        return F.struct(F.size(line).alias("n"), (F.size(line) - F.size(F.array_distinct(line))).alias("dup"))

    # two references each keep these from being computed once for every field
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), let(words, of_words).alias("w"), let(lines, of_lines).alias("l"))
    text = F.col("text")
    named = {
        "n_words": F.col("w.n"), "word_chars": F.length(F.translate(text, SPACES, "")), "n_symbols": chars(SYMBOLS, text),
        "n_dup_lines": F.col("l.dup"), "n_repeat_words": F.col("w.repeats"), "n_distinct": F.col("w.distinct"),
        "n_lines": F.col("l.n"), "n_marks": chars(MARKS, text), "n_upper": chars(UPPER, text), "n_digits": chars(DIGITS, text),
    }
    return rows.select("doc_id", *(c.cast("long").alias(n) for n, c in named.items()))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    rate: str
    above: bool
    threshold: float

    def expression(self) -> Column:
        rate = F.expr(RATES[self.rate])
        return rate > self.threshold if self.above else rate <= self.threshold

    def __str__(self) -> str:
        return f"{self.rate} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, (c.expression() for c in conditions), F.lit(True))


def _any(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a | b, (_all(r) for r in rules), F.lit(False))


def verdict(rules: list[Rule]) -> Column:
    """True for a text that no rule rejects: one CASE, in the order of the list."""
    out = F.lit(True)
    for i, rule in enumerate(rules):
        out = F.when(_all(rule), F.lit(False)) if i == 0 else out.when(_all(rule), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else out


def _edges(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """Candidate thresholds of each rate: quantiles of either class."""
    shares = [i / bins for i in range(bins + 1)]
    quantiles = [
        F.percentile_approx(F.when(F.col("poor") == poor, F.expr(e)), shares, 10_000).alias(f"{n}_{poor}")
        for n, e in RATES.items() for poor in (True, False)
    ]
    found = rows.agg(*quantiles).first()
    return {n: sorted({*(found[f"{n}_True"] or []), *(found[f"{n}_False"] or [])}) for n in RATES}


def _tally(rows: DataFrame, edges: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """For each rate and bin the rows that are poor and that are not; bin i holds values up to edge i."""
    def bin_of(name: str) -> Column:
        rate = F.expr(RATES[name])
        return F.size(F.filter(F.array(*map(F.lit, edges[name])), lambda e: e < rate))

    boxes = F.explode(F.array(*(F.struct(F.lit(n).alias("rate"), bin_of(n).alias("bin")) for n in edges)))
    counts = rows.select("poor", boxes.alias("b")).groupBy("b.rate", "b.bin", "poor").count().collect()
    out = {n: [[0, 0] for _ in range(len(e) + 1)] for n, e in edges.items()}
    for row in counts:
        out[row["rate"]][row["bin"]][0 if row["poor"] else 1] += row["count"]
    return out


def _grow(rows: DataFrame, edges: dict[str, list[float]], most: int) -> Rule:
    rule: Rule = ()
    while len(rule) < most:
        tally = _tally(rows.where(_all(rule)), edges)
        first = next(iter(tally.values()))
        p0, n0 = (sum(b[k] for b in first) for k in (0, 1))
        if not p0 or not n0:
            break
        best, gain = None, 1e-9
        for name, boxes in tally.items():
            p = n = 0
            upper = [*edges[name][1:], edges[name][-1]]
            for (a, b), low, high in zip(boxes, edges[name], upper):
                p, n, edge = p + a, n + b, (low + high) / 2
                for above, p1, n1 in ((False, p, n), (True, p0 - p, n0 - n)):
                    if p1:
                        g = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))
                        if g > gain:
                            best, gain = Condition(name, above, edge), g
        if best is None:
            break
        rule += (best,)
    return rule


def _prune(rows: DataFrame, rule: Rule, precision: float) -> Rule:
    """The beginning of ``rule`` that is worth most on rows it was not grown on; none if it is not precise there."""
    counts = [F.count_if(_all(rule[: k + 1]) & (F.col("poor") == poor)).alias(f"c{k}{poor}") for k in range(len(rule)) for poor in (True, False)]
    found = rows.agg(*counts).first()
    tried = [(found[f"c{k}True"], found[f"c{k}False"], k) for k in range(len(rule))]
    worth, k = max(((p - n) / (p + n) if p + n else -1.0, k) for p, n, k in tried)
    p, n, _ = tried[k]
    return rule[: k + 1] if p + n and p / (p + n) >= precision else ()


def learn(
    stats: DataFrame, labels: DataFrame, work: Workspace, *, label: str = "quality", bins: int = 32, conditions: int = 3,
    rules: int = 12, precision: float = 0.9,
) -> list[Rule]:
    """Rules for texts labelled 0, from the labelled rows outside the held-out fold that pass the base rule."""
    named = labels.where(~held_out() & F.col(label).isin(0, 1)).groupBy("doc_id").agg((F.min(label) == 0).alias("poor"))
    rows = stats.where(~base_failed()).join(named, "doc_id")
    third = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    rows = work.table(rows.withColumn("held", third), "labelled")
    edges = {n: e for n, e in _edges(rows, bins).items() if e}
    out: list[Rule] = []
    while edges and len(out) < rules:
        left = rows.where(~_any(out))
        rule = _grow(left.where("NOT held"), edges, conditions)
        rule = _prune(left.where("held"), rule, precision) if rule else ()
        if not rule:
            break
        out.append(rule)
    return out


def judge(docs: DataFrame, labels: DataFrame, work: Workspace) -> DataFrame:
    """The statistics of every row of ``docs`` (``doc_id, text``), ``base_failed`` and ``kept``."""
    stats = work.table(statistics(docs), "statistics")
    found = learn(stats, labels, work)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(found))
