"""Quality rules of documents, and verdicts on hosts from their failure rates."""

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm.tables import fresh, save, small_batches, texts_of

LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
# Softer limits; a document of a rejected host stays only if it keeps to them.
SYMBOL_PERCENT, DUPLICATE_LINE_PERCENT = 10, 30
HOST_DEVIATIONS = 3  # posterior deviations by which a rejected host's rate lies above the overall rate
PRIOR_ROWS = (1.0, 1000.0)  # bounds of the prior's weight in documents
_WORD = re.compile("[^ \t-\r]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def rule_counts(text: str) -> tuple[int, int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows, lines with a word."""
    words = _WORD.findall(text)
    seen: set[str] = set()
    repeated_lines = lines = 0
    for line in text.split("\n"):
        if _WORD.search(line):
            lines += 1
            if line in seen:
                repeated_lines += 1
            seen.add(line)
    windows = list(zip(*[words[i:] for i in range(WINDOW)]))
    repeat_words = 0
    if len(set(windows)) < len(windows):
        counts, covered = Counter(windows), 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeat_words += i + WINDOW - max(i, covered)
                covered = i + WINDOW
    return len(words), sum(map(len, words)), len(_SYMBOLS.findall(text)), repeated_lines, repeat_words, lines


def _counts(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in texts:
        columns = zip(*[rule_counts(t) for t in texts_of(part)]) if len(part) else [[]] * len(FIELDS)
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(FIELDS))


def rule_counts_column(text: Column) -> Column:
    """The counts of a text column as a struct; null counts as empty."""
    return F.arrow_udf(_counts, ", ".join(f"{f} long" for f in FIELDS))(text)


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > REPEAT_PERCENT * counts["n_words"])


def softly_failed(counts: Column) -> Column:
    """Whether a document breaks a softer limit; it counts only on rejected hosts."""
    symbols = 100 * counts["n_symbols"] > SYMBOL_PERCENT * counts["word_chars"]
    return symbols | (100 * counts["n_dup_lines"] > DUPLICATE_LINE_PERCENT * counts["n_lines"])


def host_verdicts(failures: DataFrame, host: str, failed: str) -> DataFrame:
    """Per host: documents, failures, shrunken rate and whether the host is rejected.

    The rates' prior is a beta distribution fitted to all hosts by moments: its mean is the overall
    rate, its weight follows from how far host rates vary beyond chance. A host's rate is
    (failures + weight * mean) / (documents + weight), and the host is rejected if that lies HOST_DEVIATIONS deviations of its posterior
    above the overall rate. Counts are combined before the shuffle; one row of sums reaches the driver.
    """
    hosts = save(failures.groupBy(host).agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col(failed).cast("long")).alias("failures")))
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("documents").alias("n"), F.sum("failures").alias("f"),
        F.sum(F.col("failures") * F.col("failures") / F.col("documents")).alias("squares"),
    ).first()
    mean, weight = 0.0, PRIOR_ROWS[1]
    if sums.n:
        mean = sums.f / sums.n
        chance = mean * (1 - mean)
        beyond = sums.squares / sums.n - mean * mean - chance * sums.hosts / sums.n
        weight = min(max(chance / beyond - 1, PRIOR_ROWS[0]), PRIOR_ROWS[1]) if beyond > 0 else PRIOR_ROWS[1]
    rate = (F.col("failures") + F.lit(weight * mean)) / (F.col("documents") + F.lit(weight))
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("documents") + F.lit(weight + 1)))
    return hosts.withColumn("rate", rate).withColumn("rejected", F.col("rate") - F.lit(mean) > HOST_DEVIATIONS * spread)


def _host_key(column: str) -> Column:
    """Hosts as a key without nulls; a missing host is a host of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def _judged(measured: DataFrame, counts: str, host: str, failed: str, kept: str) -> DataFrame:
    """Adds column `kept`: whether the row passes the base rules and its host's verdict."""
    bad = host_verdicts(measured.select(host, failed), host, failed).where("rejected").select(host)
    flag = fresh(measured, "host_rejected")
    # Written, so that the planner knows its size; usually few rows, else a join that can split a hot host.
    joined = measured.join(save(bad.withColumn(flag, F.lit(True))), host, "left")
    softly = F.coalesce(F.col(flag), F.lit(False)) & softly_failed(F.col(counts))
    return joined.withColumn(kept, ~F.col(failed) & ~softly)


def quality_verdicts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every row.

    A document goes if it breaks a base rule, or if its host is rejected and it breaks a softer
    limit, so clean documents of bad hosts stay. Texts are read once; counts are written once.
    Null and empty texts have no words and fail; a null host is a host of its own; repeated rows come
    back repeated and count each; an empty table gives an empty result; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), rule_counts_column(F.col(text_column)).alias("counts"), _host_key(host_column).alias("host"))
    measured = save(rows.withColumn("base_failed", base_failed(F.col("counts"))))
    judged = _judged(measured, "counts", "host", "base_failed", "kept")
    return judged.select("doc_id", *[F.col(f"counts.{f}").alias(f) for f in FIELDS if f != "n_lines"], "base_failed", "kept")


def keep_quality(docs: DataFrame, text_column: str = "text", host_column: str = "source") -> DataFrame:
    """The rows of `docs` that quality_verdicts keeps, all columns as they are."""
    small_batches(docs.sparkSession)
    counts, host, failed, kept = (fresh(docs, f"quality_{n}") for n in ("counts", "host", "failed", "kept"))
    rows = docs.withColumn(counts, rule_counts_column(F.col(text_column))).withColumn(host, _host_key(host_column))
    measured = save(rows.withColumn(failed, base_failed(F.col(counts))))
    return _judged(measured, counts, host, failed, kept).where(kept).select(*docs.columns)
