"""Quality rules with risk-controlled thresholds.

A rule rejects a document whose statistic exceeds a cutoff. For each stratum
(the documents' language; null is a stratum) and rule, cutoffs of a fixed grid
are tested on labelled documents: half of them, by a hash of doc_id, are the
holdout, whose exact (Clopper-Pearson) upper bound on the share of good
documents rejected must lie under the rule's part of ``RISK``, at level
``DELTA`` divided by the number of strata and rules (Bonferroni). A rule's
cutoffs are tested in falling order up to the first that fails (a fixed
sequence, which needs no further correction). So with probability 1 - DELTA no
stratum loses more than RISK of its good documents to the rules. Among certified cutoffs the other half picks the one that rejects most bad
documents, each good one counting ``GOOD_WEIGHT`` times; ties go to the highest
cutoff. A rule without a certified cutoff that pays rejects nothing.

Counts of good and bad documents by rule and cutoff are summed by Spark over
all labelled documents; only those sums reach the driver. Documents labelled
twice count as good if at least half of their labels are.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from lumenreg.llm.batches import keep_rows, with_text_columns
from lumenreg.llm.document_stats import NAMES, statistics
from lumenreg.session import checkpointed

RISK, DELTA = 0.05, 0.05
GOOD_WEIGHT = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Rule -> (numerator, denominator) among the statistics.
RULES = {"symbols": ("n_symbols", "word_chars"), "shouts": ("n_shouts", "n_words"),
         "upper": ("n_upper", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
         "repeats": ("n_repeat_words", "n_words"), "digits": ("n_digits", "word_chars")}
#: Cutoffs of every rule: 40 steps of a quarter octave down from 1.
GRID = tuple(2.0 ** (-k / 4) for k in range(40))


def upper_bound(rejected: int, total: int, delta: float) -> float:
    """Exact binomial upper bound: the rate at which so few rejections have chance ``delta``."""
    if rejected >= total:
        return 1.0
    steps = [math.lgamma(total + 1) - math.lgamma(k + 1) - math.lgamma(total - k + 1)
             for k in range(rejected + 1)]

    def tail(p: float) -> float:
        logs = [c + k * math.log(p) + (total - k) * math.log1p(-p) for k, c in enumerate(steps)]
        top = max(logs)
        return top + math.log(sum(math.exp(x - top) for x in logs))

    low, high = rejected / total, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if not 0 < mid < 1:
            break
        low, high = (mid, high) if tail(mid) > math.log(delta) else (low, mid)
    return high


def base_failed(n_words, n_repeat_words):
    """The fixed rules, on numbers or columns."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang") -> DataFrame:
    """id, stratum and the statistics of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("stratum"))
    return with_text_columns(
        rows, ["doc_id", "stratum"], "text",
        lambda: lambda texts: [list(c) for c in zip(*map(statistics, texts))],
        [StructField(c, LongType()) for c in NAMES])


def labelled(labels: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """One row for each labelled id: ``doc_id`` and whether its mean label is 0.5 or more."""
    return (labels.select(F.col(id_col).alias("doc_id"), F.col(value_col).alias("value"))
            .where("doc_id is not null and value is not null")
            .groupBy("doc_id").agg((F.avg("value") >= 0.5).alias("good")))


def certify(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id",
            quality_col: str = "quality", risk: float = RISK, delta: float = DELTA) -> dict:
    """{stratum: {rule: cutoff}} that is certified; strata and rules without one are left out."""
    counted = (measured.join(labelled(labels, id_col, quality_col), "doc_id")
               .where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
               .withColumn("holdout", F.md5(F.concat(F.lit("holdout "), F.col("doc_id").cast("string"))
                                            .cast("binary")).rlike("^[02468ace]")))
    # the grid step at which a rule begins to reject a document, or none
    def first_step(top: str, under: str):
        ratio = F.col(top) / F.greatest(F.col(under), F.lit(1))
        return F.size(F.filter(F.array(*[F.lit(c) for c in GRID]), lambda c: ratio <= c))

    step = {rule: first_step(*columns) for rule, columns in RULES.items()}
    sums = counted.select("stratum", "good", "holdout", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), s.alias("first")) for rule, s in step.items()]
    )).alias("r")).groupBy("stratum", "good", "holdout", "r.rule", "r.first").agg(
        F.count(F.lit(1)).alias("n")).collect()  # strata x rules x grid x 4 at most
    totals: dict = {}
    for r in sums:
        counts = totals.setdefault(r["stratum"], {}).setdefault(r["rule"], {}).setdefault(
            (r["good"], r["holdout"]), [0] * (len(GRID) + 1))
        counts[r["first"]] += r["n"]
    level = delta / max(1, len(totals) * len(RULES))
    chosen: dict = {}
    for stratum, rules in totals.items():
        for rule, cells in rules.items():
            none = [0] * (len(GRID) + 1)
            good_test, good_pick, bad_pick = (cells.get(k, none) for k in
                                              ((True, True), (True, False), (False, False)))
            best, best_gain = None, 0
            for i, cutoff in enumerate(GRID):
                # rejected at this cutoff: those whose first rejecting step is i or before
                lost = sum(good_test[:i + 1])
                if not sum(good_test) or upper_bound(lost, sum(good_test), level) \
                        > risk / len(RULES):
                    break  # the sequence ends
                gain = sum(bad_pick[:i + 1]) - GOOD_WEIGHT * sum(good_pick[:i + 1])
                if gain > best_gain:
                    best, best_gain = cutoff, gain
            if best is not None:
                chosen.setdefault(stratum, {})[rule] = best
    return chosen


def accepts(values: dict, cutoffs: dict) -> bool:
    """Whether a document with these statistics passes its stratum's rules."""
    return not any(values[RULES[rule][0]] / max(values[RULES[rule][1]], 1) > cutoff
                   for rule, cutoff in cutoffs.items())


def verdicts(measured: DataFrame, cutoffs: dict) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``; the cutoffs enter as literals."""
    fails = F.lit(False)
    for stratum, rules in sorted(cutoffs.items(), key=lambda x: (x[0] is None, x[0] or "")):
        for rule, cutoff in sorted(rules.items()):
            top, under = RULES[rule]
            over = F.col(top) / F.greatest(F.col(under), F.lit(1)) > F.lit(cutoff)
            fails = fails | (F.col("stratum").eqNullSafe(F.lit(stratum)) & over)
    return (measured.withColumn("base_failed", base_failed(F.col("n_words"),
                                                           F.col("n_repeat_words")))
            .withColumn("kept", ~F.col("base_failed") & ~fails))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """The statistics, ``base_failed`` and ``kept`` of every row.

    Null, empty and wordless texts have all-zero statistics and fail the base.
    Repeated rows are judged each. Without labels only the base rules reject.
    """
    measured = checkpointed(measure(docs, id_col, text_col, lang_col))
    out = verdicts(measured, certify(measured, labels))
    return out.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else out


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang") -> DataFrame:
    """The rows that base rules and certified cutoffs keep, all columns unchanged."""
    cutoffs = certify(measure(docs, id_col, text_col, lang_col), labels)

    def make():
        def step(texts, langs):
            out = []
            for text, lang in zip(texts, langs):
                values = dict(zip(NAMES, statistics(text)))
                out.append(not base_failed(values["n_words"], values["n_repeat_words"])
                           and accepts(values, cutoffs.get(lang, {})))
            return out
        return step

    return keep_rows(docs, text_col, make, also=(lang_col,))
