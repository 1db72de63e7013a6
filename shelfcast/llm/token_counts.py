"""Token counts from an exact length histogram.

Every text is reduced to its number of ids, documents are counted per length, and suffix sums over
the lengths answer totals, quantiles and truncated totals for every context limit. The histogram has
one row per distinct length whatever the number of documents, and counts are summed before the
shuffle, so a length shared by a third of all documents costs no more than another.

Defined results: null and empty texts have length 0 and are counted; an empty table gives an empty
histogram, whose answers for a limit are 0 documents and 0 tokens; repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfcast.llm.byte_pairs import count_ids
from shelfcast.llm.columns import settle, ship

SPAN = 256  # lengths that one task sums over


def document_lengths(docs: DataFrame, ranks: str) -> DataFrame:
    """``doc_id, n_tokens`` per row."""
    ship(docs.sparkSession)
    return docs.select("doc_id", count_ids(F.col("text"), ranks).alias("n_tokens"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens, n_docs``: exact counts of equal lengths."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def _suffix(histogram: DataFrame) -> DataFrame:
    """Adds ``docs_at_least`` and ``tokens_at_least``: sums over this and all greater lengths.

    Lengths are summed in spans of ``SPAN``; only span totals are summed in one place, and there are
    as many as the longest document has spans.
    """
    spans = histogram.withColumn("span", F.floor(F.col("n_tokens") / SPAN))
    tokens = F.col("n_tokens") * F.col("n_docs")
    totals = spans.groupBy("span").agg(F.sum("n_docs").alias("span_docs"), F.sum(tokens).alias("span_tokens"))
    after = W.orderBy(F.desc("span")).rowsBetween(W.unboundedPreceding, -1)
    later = totals.select(
        "span",
        F.coalesce(F.sum("span_docs").over(after), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("span_tokens").over(after), F.lit(0)).alias("later_tokens"),
    )
    within = W.partitionBy("span").orderBy(F.desc("n_tokens"))
    return (
        spans.withColumns({"here_docs": F.sum("n_docs").over(within), "here_tokens": F.sum(tokens).over(within)})
        .join(later, "span")
        .select(
            "n_tokens",
            "n_docs",
            (F.col("here_docs") + F.col("later_docs")).alias("docs_at_least"),
            (F.col("here_tokens") + F.col("later_tokens")).alias("tokens_at_least"),
        )
    )


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row per distinct length, read as a context limit.

    ``docs_longer`` would be cut at ``n_tokens``, ``tokens_truncated`` is what is left of all tokens
    if they are, ``tokens_total`` and ``docs_total`` are of the whole table. A limit between two rows
    cuts the same documents as the lower one, at ``(limit - n_tokens) * docs_longer`` more tokens.
    The histogram is settled first, so that texts are encoded once.
    """
    histogram = settle(histogram)
    sums = _suffix(histogram)
    whole = histogram.agg(
        F.struct(F.sum("n_docs").alias("docs"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("tokens"))
    ).scalar()
    docs_longer = F.col("docs_at_least") - F.col("n_docs")
    tokens_longer = F.col("tokens_at_least") - F.col("n_tokens") * F.col("n_docs")
    return sums.select(
        "n_tokens",
        "n_docs",
        docs_longer.alias("docs_longer"),
        (whole["tokens"] - tokens_longer + F.col("n_tokens") * docs_longer).alias("tokens_truncated"),
        whole["docs"].alias("docs_total"),
        whole["tokens"].alias("tokens_total"),
    )


def _first_above(table: DataFrame, condition: Column, column: str, kind) -> int:
    return table.filter(condition).agg(kind(column)).first()[0] or 0


def tokens_within(table: DataFrame, limit: int) -> int:
    """Tokens of all documents if each is cut after ``limit``; ``table`` is a limit table."""
    row = table.filter(F.col("n_tokens") <= limit).orderBy(F.desc("n_tokens")).first()
    if row is None:
        return limit * (_first_above(table, F.lit(True), "docs_total", F.max))
    return row["tokens_truncated"] + (limit - row["n_tokens"]) * row["docs_longer"]


def quantiles(table: DataFrame, shares: Sequence[float]) -> list[int | None]:
    """Smallest length that at least the given share of documents does not exceed; None if there are none."""
    reached = F.col("docs_total") - F.col("docs_longer")
    picks = [
        F.min(F.when(reached >= F.ceil(F.lit(share) * F.col("docs_total")), F.col("n_tokens"))) for share in shares
    ]
    return list(table.agg(*[pick.alias(f"q{number}") for number, pick in enumerate(picks)]).first())
