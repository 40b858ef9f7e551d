"""Quality rules by document, with verdicts on whole hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, once, saved, text_of

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# A host goes if its failure rate is above this, and above the hosts' mean, by so many deviations.
MAX_HOST_RATE = 0.5
DEVIATIONS = 3.0


def _words(text: Column) -> Column:
    spaced = F.regexp_replace(text, "[\\x09-\\x0D]", " ")
    return F.array_remove(F.split(spaced, " "), "")


def _repeated_positions(keys: Column) -> Column:
    """Sorted positions of the windows whose key occurs twice or more.

    Keys are sorted with their positions, so equal ones are neighbours; it takes n log n steps
    for a text of n words.
    """
    pairs = F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("i")))
    return F.transform(F.array(F.array_sort(pairs)), _neighbours)[0]


def _neighbours(pairs: Column) -> Column:
    def same(pair: Column, i: Column) -> Column:
        before = (i > 0) & (F.get(pairs, i - 1)["key"] == pair["key"])
        after = F.get(pairs, i + 1)["key"] == pair["key"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.array_sort(F.transform(F.filter(pairs, same), lambda pair: pair["i"]))


def _covered(positions: Column) -> Column:
    """Words in the union of windows that begin at the sorted positions."""

    def cover(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda start, i: F.least(
                F.coalesce(F.get(starts, i + 1) - start, F.lit(WINDOW)), F.lit(WINDOW)
            ).cast("long"),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    return F.transform(F.array(positions), cover)[0]


def measures(documents: DataFrame) -> DataFrame:
    """doc_id, source and the figures the rules read, one row per document.

    A NULL text counts as empty and gives zeros. Only doc_id, source and text are read,
    so other columns may have any name. Repeated rows are measured each.
    """
    frame = documents.select("doc_id", "source", text_of().alias("text"))
    frame = once(frame, "words", _words(F.col("text")))
    frame = frame.withColumn("n_words", F.size("words").cast("long"))
    hashes = F.transform("words", lambda word: F.xxhash64(word))
    frame = once(frame, "hashes", hashes)
    starts = F.when(
        F.col("n_words") >= WINDOW, F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int"))
    ).otherwise(F.array().cast("array<int>"))
    keys = F.transform(
        starts, lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)])
    )
    frame = once(frame, "keys", keys)
    repeats = F.when(
        F.size(F.array_distinct("keys")) < F.size("keys"),
        _covered(_repeated_positions(F.col("keys"))),
    ).otherwise(F.lit(0).cast("long"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    frame = once(frame, "lines", lines)
    frame = frame.select(
        "doc_id",
        "source",
        "n_words",
        F.char_length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return frame.withColumn("base_failed", failed)


def host_rates(measured: DataFrame) -> DataFrame:
    """source, shrunk and surely: the failure rate of every host, shrunk by a beta prior fitted to
    all hosts, and a lower bound of it, DEVIATIONS of the posterior below; and mean, the prior's.

    The prior's mean and strength come from the hosts' own rates by moments. What the rates vary
    by chance, more for hosts of few documents, is taken out first; where nothing is left, hosts do
    not differ, and every host gets the mean. Documents without a source belong to no host.
    """
    hosts = (
        measured.where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    )
    hosts = saved(hosts, "hosts").withColumn("rate", F.col("failed") / F.col("n"))
    moments = hosts.agg(
        F.avg("rate").alias("mean"),
        F.coalesce(F.var_samp("rate"), F.lit(0.0)).alias("variance"),
        F.avg(1 / F.col("n")).alias("noise"),
    ).first()
    mean, noise = moments["mean"] or 0.0, moments["noise"] or 1.0
    # A rate over n documents varies by (mean * (1 - mean) - between) / n more than its host's own.
    chance = mean * (1 - mean)
    between = (moments["variance"] - chance * noise) / (1 - noise) if noise < 1 else 0.0
    if between <= 1e-12:
        level = F.lit(float(mean))
        return hosts.select(
            "source", level.alias("shrunk"), level.alias("surely"), level.alias("mean")
        )
    strength = max(chance / between - 1, 0.0)
    shrunk = (F.col("failed") + mean * strength) / (F.col("n") + strength)
    hosts = hosts.withColumn("shrunk", shrunk)
    spread = F.sqrt(F.col("shrunk") * (1 - F.col("shrunk")) / (F.col("n") + strength + 1))
    return hosts.select(
        "source",
        "shrunk",
        (F.col("shrunk") - DEVIATIONS * spread).alias("surely"),
        F.lit(float(mean)).alias("mean"),
    )


def rejected_hosts(measured: DataFrame, max_host_rate: float) -> DataFrame:
    """source of the hosts that surely fail more than ``max_host_rate`` and than the hosts' mean."""
    worse = (F.col("surely") > max_host_rate) & (F.col("surely") > F.col("mean"))
    return host_rates(measured).where(worse).select("source")


def passing(documents: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``documents`` that `quality_rules` keeps, each judged by itself.

    The rows are written once beside their own verdict, so no text is measured twice or moved to
    meet it; only hosts are counted, and the rejected ones are looked up. Columns may have any
    names; NULLs, empty tables and repeated rows are as in `quality_rules`.
    """
    columns = documents.columns
    rows = documents.select(F.struct("*").alias("doc_id"), "source", "text")
    judged = measures(rows).select(F.col("doc_id").alias("row"), "source", "base_failed")
    judged = saved(judged, "judged")
    rejected = rejected_hosts(judged, max_host_rate)
    kept = judged.where(~F.col("base_failed")).join(rejected, "source", "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in columns])


def quality_rules(documents: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Figures and verdicts, one row per document.

    A document goes if it fails a rule itself, or if its host is one of `rejected_hosts`: the lower
    bound of the host's shrunk failure rate is above ``max_host_rate`` and the mean. The text is read once: the figures are written and both the host table and
    the verdicts come from them. Hosts are counted before they are shuffled, and the verdicts
    join to the documents as a skewed join that Spark splits.

    NULL and empty texts have no words and fail. A NULL source takes part in no host. An empty
    table gives no rows.
    """
    measured = saved(measures(documents), "measures")
    rejected = rejected_hosts(measured, max_host_rate).withColumn("rejected", F.lit(True))
    joined = measured.join(rejected, "source", "left")
    passes = ~F.col("base_failed") & F.col("rejected").isNull()
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        passes.alias("kept"),
    )
