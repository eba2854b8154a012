"""Quality rules: a decision list learned by sequential covering, all in DataFrame expressions.

Statistics of every text come from column functions. On the labelled rows, rules are learned one
after another: a conjunction of thresholds grows by the condition with the most information gain
on one part of the rows, is pruned to its best prefix on another, and what it covers is set aside.
Every step is one aggregation over stored statistics that returns a few hundred counts. The rules
become one ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exactnn.session import materialize

#: White space that parts words, as a Java character class.
_GAP = r"[\x09-\x0D\x20]"
_TRIM = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: What rules may test; each follows from the statistics of a row.
FEATURES = (
    "n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share", "mark_share", "digit_share", "words_per_line",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often lambdas in ``body`` use it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _GAP + "+"), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    """How many of ``characters`` the text has."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_window_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the array.

    Windows are told apart by 64-bit hashes within one text. Without a repeat, which an array of
    distinct hashes shows, nothing is sorted.
    """

    def positions(hashes: Column) -> Column:
        marked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        repeated = let(
            marked,
            lambda s: F.filter(
                s,
                lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
            ),
        )
        return F.array_sort(F.transform(repeated, lambda x: x["p"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - p, F.lit(window))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)

    def count(hashes: Column) -> Column:
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, let(positions(hashes), covered)).otherwise(F.lit(0).cast("long"))

    def windows(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(own) - window + 1)
        return F.transform(starts, lambda i: F.xxhash64(F.slice(own, i, window)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashed, lambda own: F.when(F.size(own) > window, let(windows(own), count)).otherwise(F.lit(0).cast("long")))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts of the base rules, and FEATURES. A null text has no words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.trim(line, F.lit(_TRIM))) > 0)
    counted = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
        .select("doc_id", "text", words_of(F.col("text")).alias("words"), lines.alias("lines"))
        .select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
            F.length(F.translate("text", _TRIM, "")).cast("long").alias("word_chars"),
            _without(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            repeated_window_words(F.col("words")).alias("n_repeat_words"),
            _without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("upper"),
            _without(F.col("text"), "!?").alias("marks"),
            _without(F.col("text"), "0123456789").alias("digits"),
        )
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_distinct", "n_words").alias("distinct_share"),
        share("upper", "word_chars").alias("upper_share"),
        share("marks", "word_chars").alias("mark_share"),
        share("digits", "word_chars").alias("digit_share"),
        share("n_words", "n_lines").alias("words_per_line"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        x = F.col(self.feature).cast("double")
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """Rows that meet all conditions are rejected. ``bad`` and ``good`` count the pruning rows."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, (c.column() for c in self.conditions))

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional: false at the first rule that holds, else true."""
    if not rules:
        return F.lit(True)
    first, *others = rules
    listed = reduce(lambda c, r: c.when(r.column(), F.lit(False)), others, F.when(first.column(), F.lit(False)))
    return listed.otherwise(F.lit(True))


def learn(
    labelled: DataFrame,
    label_col: str = "quality",
    max_rules: int = 8,
    max_conditions: int = 3,
    bins: int = 40,
    precision: float = 0.9,
    support: int = 5,
) -> list[Rule]:
    """Rules for label 0, from all rows of ``labelled`` (doc_id, FEATURES, label).

    Rows with crc32(doc_id) mod 4 of 0 or 1 grow rules, those with 3 prune them; those with 2 are
    left to measure. Thresholds are ``bins`` quantiles of each feature over all and over bad rows.
    A rule is taken if at least ``support`` bad rows of the pruning part meet it, with at least
    ``precision`` of all that do. Without labels, or with one class only, there are no rules.
    """
    part = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    bad = (F.col(label_col) == 0).cast("int")
    rows = labelled.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).select(
        *[F.col(f).cast("double").alias(f) for f in FEATURES],
        bad.alias("bad"), (part == 3).alias("pruning"), (part == 2).alias("held"),
    ).where(~F.col("held")).drop("held")
    cuts = _thresholds(rows, bins)
    binned = rows.select(
        "*",
        F.array(*[_bin(F.col(f), cuts[f]) for f in FEATURES]).alias("bins"),
    )
    rest = materialize(binned, "labelled")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule = _grow(rest, cuts, max_conditions)
        rule = _prune(rest, rule) if rule else None
        if rule is None or rule.bad < support or rule.bad < precision * (rule.bad + rule.good):
            break
        rules.append(rule)
        rest = rest.where(~rule.column())
    return rules


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of ``cuts`` are below ``value``."""
    return F.size(F.filter(F.lit(cuts), lambda cut: cut < value)) if cuts else F.lit(0)


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    steps = F.array(*[F.lit(i / (bins + 1)) for i in range(1, bins + 1)])
    wanted = [F.percentile_approx(f, steps, 10_000).alias(f) for f in FEATURES]
    found = [rows.agg(*wanted).first(), rows.where("bad = 1").agg(*wanted).first()]
    return {f: sorted({x for row in found for x in row[f] or () if x is not None}) for f in FEATURES}


def _grow(rest: DataFrame, cuts: dict[str, list[float]], most: int) -> list[Condition] | None:
    """The conjunction that gains most information about bad rows, one condition after another."""
    rows = rest.where(~F.col("pruning"))
    conditions: list[Condition] = []
    while len(conditions) < most:
        counts = (
            rows.select("bad", F.posexplode("bins").alias("feature", "bin"))
            .groupBy("feature", "bin").agg(F.sum("bad").alias("bad"), F.count("*").alias("all")).collect()
        )
        best = _best_condition(counts, cuts)
        if best is None:
            break
        conditions.append(best[0])
        if best[1] == 0:  # no good row is left
            break
        rows = rows.where(best[0].column())
    return conditions or None


def _best_condition(counts, cuts: dict[str, list[float]]) -> tuple[Condition, int] | None:
    """The condition of most gain, and the good rows that meet it; None if none gains."""
    table: dict[int, list[list[int]]] = {}
    for row in counts:
        cells = table.setdefault(row.feature, [[0, 0] for _ in range(len(cuts[FEATURES[row.feature]]) + 1)])
        cells[row.bin] = [row.bad, row.all - row.bad]
    best, most = None, 1e-9
    for index in sorted(table):
        cells = table[index]
        bad, good = (sum(c[i] for c in cells) for i in (0, 1))
        if not bad or not good:
            return None
        before = math.log2(bad / (bad + good))
        low = [0, 0]
        for cut, cell in zip(cuts[FEATURES[index]], cells, strict=False):
            low = [low[0] + cell[0], low[1] + cell[1]]
            for above, (b, g) in ((False, low), (True, (bad - low[0], good - low[1]))):
                gain = b * (math.log2(b / (b + g)) - before) if b else 0.0
                if gain > most:
                    best, most = (Condition(FEATURES[index], above, cut), g), gain
    return best


def _prune(rest: DataFrame, conditions: list[Condition]) -> Rule | None:
    """The prefix of the conjunction with the best share of bad less good pruning rows."""
    prefixes = [tuple(conditions[: i + 1]) for i in range(len(conditions))]
    meets = [Rule(p, 0, 0).column() for p in prefixes]
    count = lambda m, c: F.coalesce(F.sum(F.when(m, c)), F.lit(0))
    row = rest.where("pruning").agg(
        *[count(m, F.col("bad")).alias(f"b{i}") for i, m in enumerate(meets)],
        *[count(m, 1 - F.col("bad")).alias(f"g{i}") for i, m in enumerate(meets)],
    ).first()
    rules = [Rule(p, row[f"b{i}"], row[f"g{i}"]) for i, p in enumerate(prefixes)]
    rules = [r for r in rules if r.bad + r.good]
    return max(rules, key=lambda r: ((r.bad - r.good) / (r.bad + r.good), r.bad), default=None)


def apply_rules(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", **options,
) -> DataFrame:
    """``apply_rules`` of rules learned from all labelled rows of ``docs``.

    Statistics are computed once and stored; of several labels of one id the lowest counts. Every
    row of ``docs`` is in the result, also those with null or repeated ids, which have no label
    unless it is theirs; an empty table gives an empty one.
    """
    counted = materialize(statistics(docs, id_col, text_col), "statistics")
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.min(label_col).alias(label_col)
    )
    return apply_rules(counted, learn(counted.join(known, "doc_id"), label_col, **options))
