"""Quality rules whose failures are weighed by host.

Each document is measured by array expressions inside its own row. Failures are then counted
by host, a host's failure rate is shrunk by a beta prior fitted to all hosts, and the verdict
on the host goes back to its documents by a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.text import NOT_SPACE, whole, words
from quern.session import materialize


@dataclass(frozen=True)
class HostRules:
    """Limits of the rules. Rates are shares; ``host_limit`` is the shrunk rate that rejects a host."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_dup_line_percent: int = 30
    max_symbols_per_word: float = 0.5
    max_capital_percent: int = 60
    host_limit: float = 0.6


def measures(text: Column | str = "text"):
    """Three projections, applied in order, that add the measures of a text.

    They are separate so that the word array is computed once and then read by name.
    """
    body = whole(text)

    def split(df: DataFrame) -> DataFrame:
        return df.withColumns({"__text": body}).withColumns({"__words": words(F.col("__text"))})

    def windows(df: DataFrame) -> DataFrame:
        n = F.size("__words")
        hashed = F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)),
        )
        lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(NOT_SPACE))
        return df.select(
            "*",
            n.cast("long").alias("n_words"),
            F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("__text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.length(F.regexp_replace("__text", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
            lines.alias("__lines"),
            F.when(n >= 3, hashed).otherwise(F.array().cast("array<bigint>")).alias("__windows"),
        )

    def repeats(df: DataFrame) -> DataFrame:
        sorted_windows = F.sort_array(
            F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return df.select(
            *[c for c in df.columns if c not in ("__words", "__text", "__lines", "__windows")],
            F.size("__lines").cast("long").alias("n_lines"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), sorted_windows).alias("__sorted"),
        )

    def covered(df: DataFrame) -> DataFrame:
        twins = F.filter(
            "__sorted",
            lambda x, i: F.coalesce(
                (F.get("__sorted", i + 1)["h"] == x["h"])
                | F.coalesce(F.get("__sorted", i - 1)["h"] == x["h"], F.lit(False)),
                F.get("__sorted", i - 1)["h"] == x["h"],
            ),
        )
        at = F.flatten(F.transform(twins, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return df.select(
            *[c for c in df.columns if c != "__sorted"],
            F.coalesce(F.size(F.array_distinct(at)), F.lit(0)).cast("long").alias("n_repeat_words"),
        )

    return split, windows, repeats, covered


def document_rules(docs: DataFrame, keep: list[str], text: str = "text", rules: HostRules = HostRules()) -> DataFrame:
    """Measures and failed rules of every text.

    Returns the columns in ``keep``, which must not be named as a measure, then ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_capitals``, ``n_lines``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed`` and ``failed`` (an array of rule names). A NULL or
    empty text has no words, so it fails by length. Repeated rows are measured each.
    """
    df = docs.select(*keep, F.col(text).alias("__raw"))
    for step in measures("__raw"):
        df = step(df)
    names = {
        "too_few_words": F.col("n_words") < rules.min_words,
        "repeated_words": 100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"),
        "repeated_lines": 100 * F.col("n_dup_lines") > rules.max_dup_line_percent * F.col("n_lines"),
        "symbols": F.col("n_symbols") > rules.max_symbols_per_word * F.col("n_words"),
        "capitals": 100 * F.col("n_capitals") > rules.max_capital_percent * F.col("word_chars"),
    }
    failed = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in names.items()]))
    return df.drop("__raw").withColumns(
        {"base_failed": names["too_few_words"] | names["repeated_words"], "failed": failed}
    )


def beta_prior(hosts: DataFrame, documents: str = "n_docs", failures: str = "n_failed") -> tuple[float, float]:
    """Parameters of the beta prior of host rates, by the method of moments.

    The spread of the observed rates is corrected for the sampling within each host. With no
    host, or with rates that do not differ, the prior is the mean rate with the weight of a
    thousand documents; a weight is never below one document.
    """
    n, f = F.col(documents).cast("double"), F.col(failures).cast("double")
    one = hosts.agg(F.sum(n), F.sum(f), F.sum(n * n), F.sum(f * f / n), F.count("*")).first()
    total, failed, squares, weighted, k = (float(x or 0) for x in one)
    if not total:
        return 0.5, 0.5
    mean = failed / total
    spread = weighted - failed * mean  # sum of n (rate - mean)^2
    noise = mean * (1 - mean)
    room = noise * (total - squares / total - (k - 1))
    share = (spread - (k - 1) * noise) / room if room > 0 else 0.0
    weight = min(1000.0, max(1.0, (1 - share) / share)) if share > 0 else 1000.0
    return max(mean * weight, 1e-6), max((1 - mean) * weight, 1e-6)


def host_verdicts(measured: DataFrame, host: str = "host", rules: HostRules = HostRules()) -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate and verdict.

    A NULL host is no host and gets no row. The counts are aggregated before the shuffle, so
    a host with a third of all documents is no more work than any other.
    """
    hosts = (
        measured.filter(F.col(host).isNotNull())
        .groupBy(host)
        .agg(F.count("*").alias("n_docs"), F.sum((F.size("failed") > 0).cast("long")).alias("n_failed"))
    )
    alpha, beta = beta_prior(hosts)
    rate = (F.col("n_failed") + alpha) / (F.col("n_docs") + alpha + beta)
    return hosts.withColumn("host_rate", rate).withColumn("host_rejected", rate > rules.host_limit)


def score_hosts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", rules: HostRules = HostRules()
) -> DataFrame:
    """Measures, failed rules and verdict of every document.

    ``kept`` is false if the document fails a rule itself or if its host is rejected; a NULL
    host rejects nothing. The measures are written once as a table without texts, from which
    both the counts by host and the result are read. An empty table gives an empty result.
    """
    named = docs.select(F.col(key).alias("key"), F.col(host).cast("string").alias("host"), F.col(text).alias("body"))
    measured = materialize(document_rules(named, ["key", "host"], "body", rules), "quality-rules")
    joined = measured.join(host_verdicts(measured, "host", rules), "host", "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        ((F.size("failed") == 0) & ~rejected).alias("kept"),
        F.array_join("failed", ",").alias("failed_rules"),
        "host_rate",
        rejected.alias("host_rejected"),
    )
