"""Quality rules with host verdicts.

Every document gets counts over its whole text and five rule flags.  Failures
are summed per host (here the ``source`` column), each host's failure rate is
shrunk towards the corpus with a beta prior fitted to the hosts themselves,
and the verdict goes back to the host's documents.

Defined results: a null text has no words and fails the base rule; a null
source is a host of its own; repeated rows are counted and returned each; an
empty table gives an empty result.  Only the named columns are read, so extra
columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import small_side, stored

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"

#: A host is rejected when its shrunk failure rate is above this.
HOST_LIMIT = 0.5
#: Bounds of the prior's weight, in documents.
PRIOR_WEIGHT = (2.0, 1000.0)


def count_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated 3-word windows, lines)."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    symbols = sum(text.count(c) for c in SYMBOLS)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    covered = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        seen, twice = set(), set()
        for w in windows:
            (twice if w in seen else seen).add(w)
        reach = 0  # words before it are counted already
        for i, w in enumerate(windows):
            if w in twice:
                covered += i + 3 - max(i, reach)
                reach = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), covered, len(lines)


def rule_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the counts of every whole text."""
    names = [f"_k{i}" for i in range(len(keep))]
    src = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], docs[text].cast("string").alias("_text"))
    fields = [x.split()[0] for x in COUNTS.split(", ")]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = pd.DataFrame([count_text(t) for t in b.pop("_text")], columns=fields, index=b.index, dtype="int64")
            yield pd.concat([b, found], axis=1)

    types = dict(src.dtypes)
    out = src.mapInPandas(count, ", ".join(f"{n} {types[n]}" for n in names) + ", " + COUNTS)
    return out.withColumnsRenamed(dict(zip(names, keep)))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def symbol_failed() -> Column:
    """More than one symbol for every two words."""
    return 2 * F.col("n_symbols") > F.col("n_words")


def length_failed() -> Column:
    """Words of under 2 or over 20 code points on average."""
    return (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))


def line_failed() -> Column:
    """More than 30 % of the lines repeat an earlier one."""
    return 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")


def host_verdicts(counts: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """``_host, host_docs, host_failed, host_rate, host_rejected``: one row per host, null included.

    The prior is fitted by moments over the hosts: its mean is the corpus
    rate, its weight follows from the spread of the host rates beyond what
    sampling alone gives, and stays within ``PRIOR_WEIGHT``.
    """
    failed = base_failed() | symbol_failed() | length_failed() | line_failed()
    hosts = counts.groupBy(F.col(host).alias("_host")).agg(F.count("*").alias("host_docs"), F.sum(failed.cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    total = hosts.agg(F.sum("host_docs").alias("_n"), F.sum("host_failed").alias("_f"), F.count("*").alias("_hosts"),
                      F.sum(F.col("host_docs") * rate * rate).alias("_square"))
    mean = F.col("_f") / F.col("_n")
    # between-host variance: weighted variance of the rates less its sampling part
    between = F.col("_square") / F.col("_n") - mean * mean - mean * (1 - mean) * F.col("_hosts") / F.col("_n")
    weight = F.when(between > 0, mean * (1 - mean) / between - 1).otherwise(F.lit(PRIOR_WEIGHT[1]))
    prior = total.select(mean.alias("_mean"), F.greatest(F.lit(PRIOR_WEIGHT[0]), F.least(F.lit(PRIOR_WEIGHT[1]), weight)).alias("_weight"))
    shrunk = (F.col("host_failed") + F.col("_mean") * F.col("_weight")) / (F.col("host_docs") + F.col("_weight"))
    return (hosts.join(F.broadcast(prior), how="cross")  # one row
            .select("_host", "host_docs", "host_failed", shrunk.alias("host_rate"), (shrunk > limit).alias("host_rejected")))


def judge(docs: DataFrame, keep: list[str], text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """``keep`` columns, counts, ``base_failed``, the host's rate and ``kept``.

    A document is kept unless it fails the base rule, the symbol rule or the
    word-length rule itself, or its host is rejected.
    """
    cols = [*keep, *([host] if host not in keep else [])]
    counts = stored(rule_counts(docs, cols, text), "rule-counts")
    hosts = stored(host_verdicts(counts, host, limit), "host-verdicts")
    rows = counts.withColumns({"base_failed": base_failed(), "_own": symbol_failed() | length_failed()})
    joined = rows.join(small_side(hosts), rows[host].eqNullSafe(hosts["_host"]), "left")
    return joined.withColumn("kept", ~(F.col("base_failed") | F.col("_own") | F.col("host_rejected"))).drop("_own", "_host")


__all__ = ["count_text", "rule_counts", "host_verdicts", "judge", "base_failed", "HOST_LIMIT", "PRIOR_WEIGHT"]
