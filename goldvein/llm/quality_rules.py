"""Host-level quality rules (DataFrame functions only).

Three steps: per-document rule features, per-host failure rates shrunk
towards the corpus with a beta prior fitted to the hosts themselves, and a
join of the host verdicts back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.llm.common import SPACE_RE, written

WINDOW = 8
SYMBOLS_RE = r"[#*$%&|<>]+"


def _dropped_chars(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _repeat_words(hashes: Column) -> Column:
    """Words covered by 8-word windows whose hash occurs twice or more.

    Sorts (hash, position) once, keeps positions with an equal neighbour, and
    adds up how far each repeated window reaches beyond the one before it:
    O(n log n) within the row, nothing is exploded."""
    tagged = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        marked = F.transform(s, lambda x, k: F.struct((same(x, k - 1) | same(x, k + 1)).alias("r"), x["i"].alias("i")))
        return F.array_sort(F.transform(F.filter(marked, lambda x: x["r"]), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    # A one-element transform binds an array to a lambda variable, so it is computed once.
    return F.get(F.transform(F.array(tagged), lambda s: F.get(F.transform(F.array(repeated(s)), covered), F.lit(0))), F.lit(0))


def rule_features(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str | Column = "source") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words per row."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                       (F.col(f"`{host}`") if isinstance(host, str) else host).cast("string").alias("host"), t.alias("t"))
    rows = rows.select(
        "doc_id", "host",
        _dropped_chars(F.col("t"), SYMBOLS_RE).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.regexp_replace(x, SPACE_RE, "")) > 0).alias("lines"),
        F.filter(F.split("t", SPACE_RE), lambda x: x != "").alias("words"))
    n = F.size("words")
    rows = rows.select(
        "doc_id", "host", "n_symbols",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                       lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).alias("hashes"))
    h = F.col("hashes")
    return rows.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), F.lit(0)).otherwise(_repeat_words(h))
        .cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    """The document rule: too few words, or over 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def host_verdicts(rows: DataFrame, reject_rate: float = 0.5, min_docs: int = 20) -> DataFrame:
    """host, n_docs, n_failed, host_rate (shrunk), host_rejected per non-null host.

    The prior is Beta(a, b) with the mean m of all documents' failures and
    the strength s = m (1 - m) / v - 1 that the between-host variance v of
    the raw rates gives after taking off the binomial noise (method of
    moments; held to 2..1000, and 1000 where the hosts do not differ). A
    host's rate is (failed + m s) / (docs + s).
    """
    hosts = rows.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(F.sum("n_failed").alias("f"), F.sum("n_docs").alias("n"), F.count(F.lit(1)).alias("h"),
                      F.sum(1 / F.col("n_docs")).alias("inv"), F.avg(rate).alias("r1"), F.avg(rate * rate).alias("r2"))
    m = F.col("f") / F.col("n")
    noise = m * (1 - m) * F.col("inv") / F.col("h")
    v = F.col("r2") - F.col("r1") * F.col("r1") - noise
    s = F.when((v > 0) & (m > 0) & (m < 1), F.least(F.greatest(m * (1 - m) / v - 1, F.lit(2.0)), F.lit(1000.0))).otherwise(1000.0)
    prior = total.select(F.struct(m.alias("m"), s.alias("s")).alias("prior"))
    shrunk = (F.col("n_failed") + F.col("p.m") * F.col("p.s")) / (F.col("n_docs") + F.col("p.s"))
    return (hosts.withColumn("p", prior.scalar())
            .select("host", "n_docs", "n_failed", shrunk.alias("host_rate"))
            .withColumn("host_rejected", (F.col("n_docs") >= min_docs) & (F.col("host_rate") > reject_rate)))


def quality_rules(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str | Column = "source",
                  reject_rate: float = 0.5, min_docs: int = 20) -> DataFrame:
    """One row per input row with the rule features, base_failed, kept and
    the host's shrunk failure rate and verdict.

    A document is kept if it passes the document rule and its host is not
    rejected: a host is when it has ``min_docs`` documents and most of them
    fail after shrinkage. Null or empty texts have no words and fail; a
    document without a host has no host verdict (host_rate null). Repeated
    rows count each time; an empty table gives an empty result; other
    columns are ignored. Window equality is by 64-bit hash within a text.
    """
    rows = written(rule_features(docs, text, doc_id, host).withColumn("base_failed", base_failed()), "rule-features")
    hosts = host_verdicts(rows, reject_rate, min_docs).select("host", "host_rate", "host_rejected")
    return rows.join(hosts, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False))).alias("kept"),
        F.col("host").alias("rule_host"), "host_rate")
