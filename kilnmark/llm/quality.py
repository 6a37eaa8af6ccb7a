"""Quality rules as a short-circuit cascade, in column functions only.

The base counts are computed for every document. The rules behind them are tried in
the order of rejection per cost, which is estimated on a sample; a document leaves at the
first rule that rejects it. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnmark.llm.common import SPACE, empty_text, once, table

SYMBOLS = "#*$%&|<>"
SAMPLE_BYTES = 20_000
_NOT_SPACE = f"[^{SPACE}]"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a document to drop; null counts as false."""

    name: str
    rejects: Column


def window_hashes(words: Column, width: int = 5) -> Column:
    """The 64-bit hash of every window of ``width`` words, in order; empty below ``width`` words."""
    at = F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0)))
    every = F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(width))))
    return F.when(F.size(words) >= width, every).otherwise(F.array().cast("array<bigint>"))


def covered(pairs: Column, width: int = 5) -> Column:
    """Words inside windows that occur twice or more: ``pairs`` are (hash, position), sorted.

    A pair equal to a neighbour marks its position; the union of [p, p + width) over
    the marked positions is counted.
    """
    marked = F.filter(pairs, lambda p, i: F.coalesce(F.get(pairs, i + 1)["h"] == p["h"], F.lit(False))
                      | F.coalesce(F.get(pairs, i - 1)["h"] == p["h"], F.lit(False)))
    start = F.struct(F.lit(0).alias("sum"), F.lit(-width).alias("last"))
    return F.aggregate(F.array_sort(F.transform(marked, lambda p: p["i"])), start, lambda acc, p: F.struct(
        (acc["sum"] + F.least(F.lit(width), p - acc["last"])).alias("sum"), p.alias("last")),
        lambda acc: acc["sum"])


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The base columns of every document; null text has no words and no lines.

    Ties and repeated rows stay as they are: each row is judged by itself.
    """
    body = empty_text(text)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(_NOT_SPACE))
    words, hashes = F.col("__words"), F.col("__hashes")
    sorted_pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    counted = once(docs, __words=F.filter(F.split(body, f"[{SPACE}]+"), lambda w: w != ""), __lines=lines)
    counted = once(counted, __hashes=window_hashes(words))
    # All windows differ in most texts; only the others are sorted.
    counted = once(counted, __pairs=F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), sorted_pairs))
    counted = once(
        counted, n_words=F.size(words).cast("bigint"),
        word_chars=F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("bigint"),
        n_symbols=(F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint"),
        n_dup_lines=(F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
        n_repeat_words=F.when(F.col("__pairs").isNull(), 0).otherwise(covered(F.col("__pairs"))).cast("bigint"))
    return (counted.drop("__words", "__lines", "__hashes", "__pairs")
            .withColumn("base_failed", (F.col("n_words") < 10)
                        | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))))


def default_rules(text: str = "text") -> list[Rule]:
    """Rules beyond the base: shouting, symbols, separators, joined lines, word lengths."""
    body, n = empty_text(text), F.col("n_words")
    letters = F.length(F.regexp_replace(body, r"[^\p{L}]", ""))
    upper = F.length(F.regexp_replace(body, r"[^\p{Lu}]", ""))
    marks = F.length(body) - F.length(F.translate(body, "!?", ""))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("duplicate_lines", 2 * F.col("n_dup_lines") > F.size(F.split(body, "\n"))),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
        Rule("marks", 4 * marks > n),
        Rule("few_letters", 2 * letters < F.col("word_chars")),
        Rule("shouting", 2 * upper > letters),
    ]


def order_rules(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by rejection per cost on ``sample`` (base columns present), the best first.

    Cost is the time a full pass of the rule over the cached sample takes; rejection the
    share of rows it rejects. One aggregate row per rule reaches the driver. An
    empty sample keeps the given order.
    """
    kept = sample.persist()
    try:
        if not kept.count():
            return list(rules)
        scored = []
        for k, rule in enumerate(rules):
            began = time.perf_counter()
            rejected = kept.agg(F.avg((~F.col("base_failed") & F.coalesce(rule.rejects, F.lit(False))).cast("double"))).first()[0]
            scored.append((-rejected / (time.perf_counter() - began), k, rule))
        return [rule for *_, rule in sorted(scored, key=lambda x: x[:2])]
    finally:
        kept.unpersist()


def judge(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None,
          sample_rows: int = 500) -> DataFrame:
    """Base columns, ``rejected_by`` (null: kept) and ``kept``; every row of ``docs`` comes back.

    ``sample_rows`` rows of at most ``SAMPLE_BYTES`` bytes order the rules; verdicts do not depend on them.
    Columns of ``docs`` keep their place unless they bear the name of a result.
    """
    rules = default_rules(text) if rules is None else rules
    counted = base_counts(docs, text)
    ordered = rules
    if len(rules) > 1:
        # take() reads as few partitions as it needs; a limit would send this many rows from each of them.
        few = docs.where(F.octet_length(empty_text(text)) <= SAMPLE_BYTES).take(sample_rows)
        ordered = order_rules(base_counts(docs.sparkSession.createDataFrame(few, docs.schema), text), rules)
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in ordered:
        verdict = verdict.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name))
    return once(counted, rejected_by=verdict).withColumn("kept", F.col("rejected_by").isNull())


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept")


ORACLE = """
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i,
         unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS gram
  FROM w WHERE len(words) >= 5),
hit AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g),
marked AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM hit WHERE c > 1),
rep AS (SELECT doc_id, sum(least(5, coalesce(j - i, 5)))::BIGINT AS n FROM marked GROUP BY doc_id),
counted AS (
  SELECT doc_id, body, len(lines) AS n_lines, len(words)::BIGINT AS n_words,
         length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > len(string_split(body, chr(10)))
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 4 * (length(body) - length(regexp_replace(body, '[!?]', '', 'g'))) > n_words
            OR 2 * length(regexp_replace(body, '[^\\p{L}]', '', 'g')) < word_chars
            OR 2 * length(regexp_replace(body, '[^\\p{Lu}]', '', 'g')) > length(regexp_replace(body, '[^\\p{L}]', '', 'g'))) AS kept
FROM based
"""
