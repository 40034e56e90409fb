"""Quality rules whose cutoffs carry a guarantee.

A rule rejects a document when its measure reaches the cutoff of the document's stratum (a band of its number of words). The
cutoffs tried are fixed beforehand, from loose to strict. On the labelled documents, which no rule was fitted to, a cutoff is
admitted if the exact (Clopper-Pearson) upper bound of its false rejections, the share of good documents that it
rejects, is at most RISK / number of rules. Cutoffs of a rule and stratum are tested in their fixed order and testing ends at
the first that fails, which needs no correction within the sequence; over all rules and strata the confidence is corrected
by Bonferroni. So with probability 1 - DOUBT no stratum loses more than RISK of its good documents to all rules
together. Of the admitted cutoffs the one is used that finds most bad documents, less PENALTY times the good ones it loses (the
loosest of equals); with too few labelled documents nothing is admitted, and only the base rules reject.

Defined results: null text has no words; a document without a label is judged like any other; labels that are null or
contradict each other for a doc_id are not used; an empty table gives no rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rankhouse.llm.common import as_bytes, id_text, row_text, slices, stage
from rankhouse.llm.measures import measure

RISK = 0.05  # good documents that a stratum may lose, by all rules together
DOUBT = 0.05  # probability that this fails somewhere
STRATA = (150, 600)  # words at which the next stratum begins
CUTOFFS = tuple(float(x) for x in np.round(np.geomspace(1.0, 0.002, 45), 5))  # loose to strict
PENALTY = 5  # bad documents that must be found for each good one that is lost

_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_upper", "n_letters", "n_shouts", "n_lines", "n_stutters"]


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> dict[str, Column]:
    """name -> measure between 0 and 1 or more; higher is worse."""
    return {
        "symbols": _share("n_symbols", "n_words"),
        "repeats": _share("n_repeat_words", "n_words"),
        "stutters": _share("n_stutters", "n_words"),
        "same_lines": _share("n_dup_lines", "n_lines"),
        "shouts": _share("n_shouts", "n_words"),
        "capitals": _share("n_upper", "n_letters"),
    }


def stratum() -> Column:
    return sum((F.col("n_words") >= bound).cast("int") for bound in STRATA)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def measured(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """The measures of every document, after its doc_id or, as ``row``, after all its columns."""
    names = _BASE + _MORE
    frame = row_text(docs) if whole_rows else id_text(docs)
    key = frame.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = measure(*as_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(found[n]) for n in names)], names=[key, *names])

    schema = f"{key} {frame.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names)
    return frame.mapInArrow(run, schema)


def lower_tail(most: int, of: int, share: float) -> float:
    """The probability of ``most`` or fewer successes among ``of`` trials: the regularised incomplete beta function by its continued fraction
    (Lentz). Steps grow with the square root of ``of`` at most."""
    if most >= of or share <= 0:
        return 1.0
    if share >= 1:
        return 0.0
    if most + 1 > share * (of + 2):  # the fraction converges fast on the other side of the mean
        return 1.0 - lower_tail(of - most - 1, of, 1.0 - share)
    a, b, x, tiny = of - most, most + 1.0, 1.0 - share, 1e-300
    front = math.exp(math.lgamma(of + 1) - math.lgamma(a) - math.lgamma(b) + a * math.log1p(-share) + b * math.log(share)) / a
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1), tiny)
    value, m = d, 0
    while True:
        m += 1
        for numerator in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1.0 + numerator * d, 1.0 + numerator / c
            d, c = 1.0 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-14 or m > of:
            return front * value


def upper_bound(rejected: int, of: int, doubt: float) -> float:
    """Exact upper confidence bound of a share: the largest p under which ``rejected`` or fewer of ``of`` has at least the
    probability ``doubt``."""
    if rejected >= of:
        return 1.0
    low, high = rejected / of, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if lower_tail(rejected, of, middle) > doubt else (low, middle)
    return high


def exceeds(rejected: int, of: int, doubt: float, allowed: float) -> bool:
    """Whether that bound is above ``allowed``, without working it out."""
    return rejected >= of or lower_tail(rejected, of, allowed) > doubt


def choose_cutoffs(counts: dict[tuple[str, int], np.ndarray], risk: float = RISK, doubt: float = DOUBT) -> dict[tuple[str, int], float]:
    """counts[rule, stratum][cutoff] = (good rejected, good, bad rejected) -> the cutoffs to use."""
    tests, n_rules = max(1, len(counts)), max(1, len({rule for rule, _ in counts}))
    chosen = {}
    for key, table in counts.items():
        admitted = []
        for cutoff, (good_rejected, good, bad_rejected) in zip(CUTOFFS, table.tolist()):
            allowed = risk / n_rules
            if good == 0 or good_rejected > allowed * good or exceeds(int(good_rejected), int(good), doubt / tests, allowed):
                break
            admitted.append((bad_rejected - PENALTY * good_rejected, cutoff))
        most = max((gain for gain, _ in admitted), default=0)
        if most > 0:
            chosen[key] = next(cutoff for gain, cutoff in admitted if gain == most)
    return chosen


def fit(measures: DataFrame, labels: DataFrame) -> dict[tuple[str, int], float]:
    """Cutoffs by rule and stratum. Counts come from all labelled documents; what reaches the driver is one row for each
    stratum, label, rule and cutoff bin."""
    label = F.col("quality").cast("int")
    known = labels.where(label.isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min(label).alias("good"), F.max(label).alias("_most")).where("good = _most").drop("_most")
    # documents the base rules reject anyway say nothing about the other rules
    rows = measures.where(~base_failed()).join(known, "doc_id")
    names = list(rules())
    levels = F.array(*map(F.lit, CUTOFFS))

    def unreached(value: Column) -> Column:
        return F.size(F.filter(levels, lambda cutoff: cutoff > value))

    bins = [unreached(value).alias(name) for name, value in rules().items()]
    binned = rows.select(stratum().alias("stratum"), "good", *bins)
    long = binned.unpivot(["stratum", "good"], names, "rule", "bin").groupBy("stratum", "good", "rule", "bin").count()
    counts = {(rule, s): np.zeros((len(CUTOFFS) + 1, 2), np.int64) for rule in names for s in range(len(STRATA) + 1)}
    for row in long.collect():  # strata x labels x rules x bins at most
        counts[row["rule"], row["stratum"]][row["bin"], 1 if row["good"] else 0] += row["count"]
    tables = {}
    for key, by_bin in counts.items():
        reached = np.cumsum(by_bin, axis=0)[:-1]  # bin b: the b-th cutoff is the loosest that the measure reaches
        tables[key] = np.column_stack([reached[:, 1], np.full(len(CUTOFFS), by_bin[:, 1].sum()), reached[:, 0]])
    return choose_cutoffs(tables)


def verdict(cutoffs: dict[tuple[str, int], float]) -> Column:
    """Whether a measured document is kept."""
    rejects = F.lit(False)
    values = rules()
    for (rule, s), cutoff in cutoffs.items():
        rejects = rejects | ((stratum() == s) & (values[rule] >= cutoff))
    return ~base_failed() & ~rejects


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed and kept."""
    measures = stage(measured(docs), "measures")
    kept = verdict(fit(measures, labels))
    return measures.withColumns({"base_failed": base_failed(), "kept": kept})


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns; texts are not shuffled."""
    cutoffs = fit(measured(docs), labels)
    return measured(docs, whole_rows=True).where(verdict(cutoffs)).select("row.*")


def op7_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, labels).select("doc_id", *_BASE, "base_failed", "kept")
