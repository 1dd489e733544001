"""Quality rules by document, and verdicts by host from shrunk failure rates.

DataFrame functions only. Rules are evaluated on each whole text; their failures
are counted by host; each host's failure rate of each rule is shrunk towards all
hosts by a beta prior whose two parameters come from the hosts themselves (method
of moments, with what chance alone explains taken off). The limit of a rate comes
from the prior, too: three of its deviations beyond its mean, though not below a
tenth nor, unless the mean itself is, above a half. A host whose shrunk rate of any rule is beyond the limit by
a deviation of its posterior is rejected with all its documents. Where hosts differ by no more than chance, the
prior is so strong that none is.

Defined cases: a null text has no words and fails; a null host is a host of its
own; repeated rows are separate documents; hash ties of 3-word windows within one
text are settled at 64 bits; further columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import keep as kept

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
REPEAT_PERCENT = 50
DEVIATIONS = 3.0  # the limit of a shrunk rate is so many deviations of the prior beyond its mean,
LEAST_LIMIT, MOST_LIMIT = 0.1, 0.5  # within these: a rate of a tenth is borne by any host, of more than a half by none unless the mean is beyond it
FEW_HOSTS = 50_000  # verdicts of so many hosts are sent to all tasks, of more they are shuffled
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6  # bounds of the prior's weight in documents


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of each row; id can be a struct."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("id"),
        F.col(host_col).alias("host"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    n = F.size("w")
    hashed = split.select(
        "id",
        "host",
        "n_symbols",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            n >= 3,
            F.slice(F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))), F.lit(1), n - 2),
        ).alias("h"),
    )
    twice = F.size(F.array_distinct("h")) < F.size("h")
    ordered = hashed.withColumn(
        "s", F.when(twice, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    ).drop("h")
    same = lambda x, i: ((i > 0) & (F.get("s", i - 1)["h"] == x["h"])) | F.coalesce(F.get("s", i + 1)["h"] == x["h"], F.lit(False))
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.filter("s", same), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    return ordered.withColumn("n_repeat_words", F.when(F.col("s").isNotNull(), covered).otherwise(0).cast("long")).drop("s")


def rules() -> dict[str, Column]:
    """Failures of a document, by rule, over the columns of features()."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * n,
        "symbols": F.col("n_symbols") > n,
        "dup_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
        "long_words": F.col("word_chars") > 20 * n,
    }


def host_verdicts(judged: DataFrame, names: list[str], limit: float | None = None) -> DataFrame:
    """(host, host_docs, rate_<rule>..., host_rejected) from failures fail_<rule> by document; limit: one for all rules in place of the prior's."""
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"), *(F.sum(F.col(f"fail_{r}").cast("long")).alias(f"f_{r}") for r in names))
    share = lambda r: F.col(f"f_{r}") / F.col("host_docs")
    moments = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("host_docs").alias("docs"),
        F.sum(F.col("host_docs").cast("double") * F.col("host_docs")).alias("squares"),
        *(F.sum(f"f_{r}").alias(f"f_{r}") for r in names),
        *(F.sum(F.col("host_docs") * share(r) * share(r)).alias(f"q_{r}") for r in names),
    ).first()  # one row
    rates, beyond = [], F.lit(False)
    for r in names:
        mean, strength, most = prior(moments.hosts, moments.docs or 0, moments.squares or 0.0, moments[f"f_{r}"] or 0, moments[f"q_{r}"] or 0.0)
        rates.append(((F.col(f"f_{r}") + F.lit(mean * strength)) / (F.col("host_docs") + F.lit(strength))).alias(f"rate_{r}"))
        rate = F.col(f"rate_{r}")
        sure = rate - F.sqrt(rate * (1 - rate) / (F.col("host_docs") + F.lit(strength + 1)))  # a deviation of the posterior below its mean
        beyond = beyond | (sure > F.lit(most if limit is None else limit))
    return hosts.select("host", "host_docs", *rates).withColumn("host_rejected", beyond)


def prior(hosts: int, docs: int, squares: float, failed: int, spread: float) -> tuple[float, float, float]:
    """(mean, strength, limit) of a rule's beta prior by the method of moments.

    squares: sum of squared documents by host; spread: sum over hosts of documents
    times the squared failure rate. What rates differ by chance alone, as they are
    counted over so many documents, is taken off before the rest is laid to hosts.
    """
    mean = failed / docs if docs else 0.0
    within = mean * (1 - mean)
    if within <= 0 or hosts < 2:
        return mean, MOST_STRENGTH, max(LEAST_LIMIT, mean)
    free = docs - squares / docs - (hosts - 1)
    between = ((spread - docs * mean * mean) / within - (hosts - 1)) / free if free > 0 else 0.0
    strength = MOST_STRENGTH if between <= 0 else min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / between - 1))
    deviation = math.sqrt(within / (strength + 1))
    limit = max(LEAST_LIMIT, mean + DEVIATIONS * deviation)
    return mean, strength, limit if mean >= MOST_LIMIT else min(MOST_LIMIT, limit)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float | None = None) -> DataFrame:
    """Features, base_failed, host_rejected and kept of each row of docs."""
    named = rules()
    seen = kept(features(docs, id_col, text_col, host_col).select("*", *(rule.alias(f"fail_{r}") for r, rule in named.items())), now=True)
    verdicts = kept(host_verdicts(seen, [*named], limit).select(F.col("host").alias("judged_host"), "host_rejected"))
    verdicts = verdicts.hint("broadcast" if verdicts.count() <= FEW_HOSTS else "merge")
    return (
        seen.join(verdicts, F.col("host").eqNullSafe(F.col("judged_host")))
        .withColumn("base_failed", F.col("fail_short") | F.col("fail_repetitive"))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .withColumnRenamed("id", id_col)
        .drop("judged_host")
    )


def keep(docs: DataFrame, text_col: str = "text", host_col: str = "source", limit: float | None = None) -> DataFrame:
    """The rows of docs that are kept, with all their columns; each row travels with its features, so nothing is joined back by id."""
    whole = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"), F.col(host_col).alias("host"))
    return judge(whole, "doc", "text", "host", limit).where("kept").select("doc.*")
