"""Quality rules: learned decision lists over document statistics (native).

:func:`measure` computes every statistic with built-in functions.
:func:`learn` does sequential covering: each rule is a conjunction of
``feature >= t`` / ``feature < t`` conditions grown greedily by FOIL gain on two
thirds of the labelled rows and pruned on the other third; rows a rule covers
are taken out before the next one is grown.  The learner looks only at counts
per (feature, bin) that Spark aggregates, so labelled rows never reach the
driver.  :func:`verdict` renders the ordered list as one Spark ``CASE``.

Defined results: null text is the empty text (0 words, so ``base_failed``);
null or other quality labels are not used for learning; repeated rows are
judged one by one and alike; an empty table gives an empty result, and no
labels an empty list (base rules alone decide).  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import SPACES, let, staged, table, unstage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: base rule: more than this per cent of the words in repeated 3-word windows
MAX_REPEAT_PERCENT = 50
#: thresholds tried per feature (quantiles of the labelled rows)
BINS = 32
#: share of bad rows a rule must have on the pruning rows to enter the list
MIN_PRECISION = 0.95
#: bad rows a rule must cover at least
MIN_COVER = 5
MAX_RULES, MAX_CONDITIONS = 12, 4


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text.

    The windows' hashes are sorted with their positions; equal neighbours mark
    the positions of repeated windows, and each adds the words up to the next
    marked one, three at most.
    """

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1), x + 3) - x))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def marked(s: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))
        at = F.filter(s, lambda x, i: same(i, i - 1) | same(i, i + 1))
        return let(F.sort_array(F.transform(at, lambda x: x["i"])), covered)

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(pairs, marked)).otherwise(F.lit(0))

    hashes = let(
        words,
        lambda w: F.when(
            F.size(w) >= 4,
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return let(hashes, count)


def _length_of(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are in ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Statistics of each row's whole text beside its other columns.

    Returns ``row`` (a struct of the input row without its text) and the
    statistics, so that no input column can clash with one of them.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text]
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    base = docs.select(
        F.struct(*keep).alias("row"),
        _length_of(t, SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(lines, F.size).cast("long").alias("n_lines"),
        _length_of(t, "!?.,;:").cast("long").alias("n_marks"),
        let(
            _words(t),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                _repeat_words(w).cast("long").alias("n_repeat_words"),
            ),
        ).alias("w"),
    )
    return base.select("row", "w.*", "n_symbols", "n_dup_lines", "n_lines", "n_marks")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def features() -> dict[str, Column]:
    """The learner's features: sizes and rates of the measured statistics."""

    def rate(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": rate("word_chars", "n_words"),
        "symbol_rate": rate("n_symbols", "word_chars"),
        "dup_line_rate": rate("n_dup_lines", "n_lines"),
        "repeat_rate": rate("n_repeat_words", "n_words"),
        "mark_rate": rate("n_marks", "word_chars"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: number of the first rule that rejects a row, else 0."""
    out = None
    for n, rule in enumerate(rules, 1):
        out = F.when(covers(rule), n) if out is None else out.when(covers(rule), n)
    return F.lit(0) if out is None else out.otherwise(0)


def simplified(rule: Rule) -> Rule:
    """Only the tightest bound per feature and direction (in first-use order)."""
    best: dict[tuple[str, bool], Condition] = {}
    for c in rule:
        was = best.get((c.feature, c.above))
        if was is None or (c.threshold > was.threshold) == c.above:
            best[c.feature, c.above] = c
    return tuple(best.values())


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def learn(labelled: DataFrame) -> list[Rule]:
    """A decision list from measured rows with a boolean ``bad``.

    ``labelled`` also has ``part`` (0, 1: growing rows, 2: pruning rows).
    """
    cols = features()
    rows = staged(labelled.select("bad", "part", *[F.struct(*[c.alias(f) for f, c in cols.items()]).alias("f")]).select("bad", "part", "f.*"), "labelled")
    cuts = rows.agg(*[F.expr(f"percentile_approx({f}, array({','.join(str((i + 1) / (BINS + 1)) for i in range(BINS))}), 10000)").alias(f) for f in cols]).first()
    cuts = {f: sorted(set(cuts[f] or [])) for f in cols}
    rules: list[Rule] = []
    if not any(cuts.values()):
        return rules

    def bin_of(f: str) -> Column:
        """Number of thresholds <= value; conditions are then bin comparisons."""
        return F.size(F.filter(F.array(*[F.lit(t) for t in cuts[f]]).cast("array<double>"), lambda t: t <= F.col(f))).alias(f)

    binned = rows.select("bad", "part", *[bin_of(f) for f in cols])
    binned = staged(binned.groupBy(*binned.columns).agg(F.count("*").alias("n")), "binned")

    def as_bins(rule: Rule) -> Column:
        out = F.lit(True)
        for c in rule:
            at = cuts[c.feature].index(c.threshold) + 1
            out = out & (F.col(c.feature) >= at if c.above else F.col(c.feature) < at)
        return out

    def uncovered() -> Column:
        out = F.lit(True)
        for r in rules:
            out = out & ~as_bins(r)
        return out

    def histogram(rule: Rule) -> dict[str, dict[int, tuple[int, int]]]:
        """Bad and good growing rows the rule covers, per feature and bin (bounded: features x bins)."""
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in cols])).alias("x")
        got = binned.where((F.col("part") < 2) & uncovered() & as_bins(rule)).select(pairs, "bad", "n")
        out: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in cols}
        for r in got.groupBy("x.feature", "x.bin").agg(F.sum(F.when(F.col("bad"), F.col("n"))).alias("p"), F.sum(F.when(~F.col("bad"), F.col("n"))).alias("q")).collect():
            out[r["feature"]][r["bin"]] = (r["p"] or 0, r["q"] or 0)
        return out

    def grow() -> Rule:
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            h = histogram(rule)
            total = [sum(x[i] for x in h["n_words"].values()) for i in (0, 1)]
            if not total[0] or not total[1]:
                break
            best, found = 1e-9, None
            for f in cols:
                for at, t in enumerate(cuts[f], 1):
                    hi = [sum(x[i] for b, x in h[f].items() if b >= at) for i in (0, 1)]
                    for above, (p, n) in ((True, hi), (False, [total[0] - hi[0], total[1] - hi[1]])):
                        if p >= MIN_COVER and (g := _gain(p, n, *total)) > best:
                            best, found = g, Condition(f, above, t)
            if found is None:
                break
            rule = (*rule, found)
        return rule

    def pruned(rule: Rule) -> tuple[Rule, int, int]:
        """The prefix of the rule with the best (bad - good) / (bad + good) on the pruning rows; one job."""
        if not rule:
            return (), 0, 0
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        sums = [F.sum(F.when(as_bins(r) & (F.col("bad") == b), F.col("n")).otherwise(0)).alias(f"c{k}_{int(b)}") for k, r in enumerate(prefixes) for b in (True, False)]
        got = binned.where((F.col("part") == 2) & uncovered()).agg(*sums).first()
        best = (-2.0, (), 0, 0)
        for k, r in enumerate(prefixes):
            p, n = got[f"c{k}_1"] or 0, got[f"c{k}_0"] or 0
            worth = (p - n) / (p + n) if p + n else -1.0
            if worth > best[0]:
                best = (worth, r, p, n)
        return best[1:]

    while len(rules) < MAX_RULES:
        rule, p, n = pruned(grow())
        if not rule or p < MIN_COVER / 2 or p < MIN_PRECISION * (p + n):
            break
        rules.append(simplified(rule))
    unstage(rows, binned)
    return rules


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> tuple[DataFrame, list[Rule]]:
    """Measured rows with ``base_failed``, ``rule`` (of the learned list, 0: none) and ``kept``; and the list.

    Rows that fail the base rules need no learned rule, so only labelled rows
    that pass them are learned from.  A label counts for every row of its key.
    """
    stats = staged(measure(docs).withColumn("base_failed", base_failed()), "stats")
    marks = labels.where(F.col("quality").isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg((F.max("quality") == 0).alias("bad"))
    part = F.pmod(F.xxhash64(F.col("_key"), F.lit("prune")), F.lit(3)).alias("part")
    labelled = stats.where(~F.col("base_failed")).join(marks, F.col(f"row.{key}") == F.col("_key")).select(part, "bad", *stats.columns)
    rules = learn(labelled)
    out = stats.withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    return out, rules


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` the base rules and the learned list keep, whole and unchanged.

    Texts are staged beside their statistics, so they are neither measured
    twice nor shuffled.
    """
    whole = docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    judged, _ = judge(whole, labels)
    return judged.where("kept").select("row.doc.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
