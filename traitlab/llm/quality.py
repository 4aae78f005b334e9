"""Quality rules with host-level reputation.

Every document is tested by a few rules. The failures are summed per host
(the ``source`` column), each host's failure rate is shrunk towards an
empirical beta prior fitted to all hosts, and hosts whose rate is credibly
above ``bad_rate`` become strict. The host verdict is joined back: on a
strict host a document must pass the soft rules too; elsewhere only the base
rules reject. A clean document is therefore kept wherever it comes from.

Defined results: a null or empty text has no words and fails the base rule;
a null host is a group of its own that never becomes strict; repeated rows
are judged one by one; an empty table gives an empty result; every input
column is carried through unchanged, and an input column named like a result
is replaced by the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import broadcast_if_small, scratch_table, shielded, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"
# Soft rules: characters per word, symbols per word, share of repeated lines.
MIN_MEAN_WORD = 2
MAX_MEAN_WORD = 15
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
# A host is strict when the lower credible bound of its failure rate exceeds this.
BAD_RATE = 0.5
Z = 1.645
MAX_STRENGTH = 1e6
WHITE = " \t\n\x0b\x0c\r"

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
RESULTS = (*METRICS, "base_failed", "soft_failed", "host_strict", "kept")
INTERNAL = ("_words", "_lines", "_windows", "_strict_host")


def _covered(windows: Column) -> Column:
    """Words lying in a window that occurs twice or more.

    ``windows`` holds (hash, start) sorted, so equal windows are neighbours:
    O(n log n) in the text length.
    """
    repeated = F.filter(windows, lambda x, j: (
        (F.get(windows, j - 1)["h"] == x["h"]) | (F.get(windows, j + 1)["h"] == x["h"])))
    places = F.flatten(F.transform(repeated, lambda x: F.array(
        *[x["i"] + k for k in range(WINDOW)])))
    return F.coalesce(F.size(F.array_distinct(places)), F.lit(0)).cast("long")


def text_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the rule metrics of each whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    one = docs.withColumns({
        "_words": words_of(F.col(text)),
        "_lines": lines,
        "word_chars": F.length(F.translate(t, WHITE, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    })
    starts = F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(0), F.size("_words") - WINDOW))
    two = one.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.sort_array(F.transform(starts, lambda i: F.struct(
            F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)]).alias("h"),
            i.alias("i")))),
    })
    return (two.withColumn("n_repeat_words", _covered(F.col("_windows")))
            .drop("_words", "_lines", "_windows"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def soft_failed() -> Column:
    return ((F.col("word_chars") < MIN_MEAN_WORD * F.col("n_words"))
            | (F.col("word_chars") > MAX_MEAN_WORD * F.col("n_words"))
            | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"))
            | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")))


def prior(n: float, hosts: float, rate: float, square_sum: float) -> tuple[float, float]:
    """Mean and strength of the beta prior, from the document count, the host
    count, the overall rate and the sum of documents * host rate squared."""
    if not n:
        return 0.0, MAX_STRENGTH
    noise = rate * (1 - rate)
    spread = square_sum / n - rate * rate
    excess = spread - noise * hosts / n
    if excess <= 1e-9:
        return rate, MAX_STRENGTH
    return rate, min(max((noise - spread) / excess, 1.0), MAX_STRENGTH)


def host_verdicts(judged: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: documents, failures, posterior rate and verdict.

    The prior's mean is the overall failure rate and its strength comes from
    the spread of the host rates beyond binomial noise (method of moments).
    ``judged`` carries ``base_failed`` and ``soft_failed``.
    """
    hosts = judged.groupBy(host).agg(
        F.count(F.lit(1)).alias("host_docs"),
        F.sum((F.col("base_failed") | F.col("soft_failed")).cast("long")).alias("host_fails")
    ).checkpoint()
    rate = F.col("host_fails") / F.col("host_docs")
    n, h, p, sq = hosts.agg(
        F.sum("host_docs"), F.count(F.lit(1)), F.sum("host_fails") / F.sum("host_docs"),
        F.sum(F.col("host_docs") * rate * rate)).first()
    p, strength = prior(n or 0, h, p or 0.0, sq or 0.0)
    mean = (p * strength + F.col("host_fails")) / (strength + F.col("host_docs"))
    sd = F.sqrt(mean * (1 - mean) / (strength + F.col("host_docs") + 1))
    return hosts.withColumns({
        "host_rate": mean,
        "host_strict": (mean - Z * sd > BAD_RATE) & F.col(host).isNotNull()})


def judge(docs: DataFrame, text: str = "text", host: str = "source",
          keep_text: bool = True) -> DataFrame:
    """All columns of ``docs`` (the text only on demand) plus the metrics,
    ``base_failed``, ``soft_failed``, ``host_strict`` and ``kept``.

    The metrics are computed once and written to the shared folder; the host
    aggregation combines on the map side, so a host with a third of all rows
    costs one row per task. Only strict hosts are joined back.
    """
    docs = docs.drop(*RESULTS, *INTERNAL)
    measured = text_metrics(docs, text)
    if not keep_text:
        measured = measured.drop(text)
    judged = scratch_table(
        measured.withColumns({"base_failed": base_failed(), "soft_failed": soft_failed()}),
        "quality")
    strict = (host_verdicts(judged, host).where("host_strict")
              .select(F.col(host).alias("_strict_host")).checkpoint())
    out = judged.join(broadcast_if_small(strict, "_strict_host"),
                      F.col(host) == F.col("_strict_host"), "left")
    return out.withColumns({
        "host_strict": F.col("_strict_host").isNotNull(),
        "kept": ~F.col("base_failed") & ~(F.col("soft_failed") & F.col("_strict_host").isNotNull()),
    }).drop("_strict_host")


def filter_quality(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The kept documents, with all columns of ``docs`` as they were."""
    own, back = shielded(docs, RESULTS + INTERNAL)
    return (judge(own, text, host).where("kept").select(*own.columns)
            .withColumnsRenamed(back))
