"""Writing and reading WARC archives; records are found by verified boundary chains.

Archives are written and read with Spark's text source, so any store that Spark reaches
will do. For reading, the record magic itself is the line separator: tasks see every place
where a record could begin, with the bytes up to the next such place, and derive
the offset of its successor from the declared length. Only candidates that the chain from the file's
start reaches are records; a magic inside a payload is not. Chains are followed by pointer
jumping: inside a block of a file in one task, between blocks by joins.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnmark.llm.common import durable, fresh_path, table

MAGIC = "WARC/1.1\r\n"
DATE = "2024-01-01T00:00:00Z"
REVISIT_FROM = 1000
_KEY = ["file", "block"]


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _one_line(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def plan_records(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """page_id, url, html with digest, size, record_type and refers_to.

    Of the rows with equal payloads of at least ``least`` bytes, those with the largest page_id are
    responses and the others revisit it. Null html is empty; a null page_id is below every other.
    The lookup holds groups of two rows or more. Spark broadcasts it only if its stored
    size is below the session's threshold; otherwise both sides come straight from a
    shuffle, which adaptive execution can split.
    """
    payload = F.coalesce("html", F.lit(""))
    known = pages.select("page_id", "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"),
                         F.octet_length(payload).cast("bigint").alias("size"))
    groups = (known.where(F.col("size") >= least).groupBy(F.col("digest").alias("d"))
              .agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = known.join(durable(groups, "payload-groups"), (F.col("digest") == F.col("d")) & (F.col("size") >= least), "left")
    revisits = F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    return (joined.withColumn("record_type", F.when(revisits, F.lit("revisit")).otherwise(F.lit("response")))
            .withColumn("refers_to", F.when(revisits, F.col("target"))).drop("d", "target"))


def record_text(html: Column, date: str = DATE) -> Column:
    """A whole record: WARC header, HTTP header, and the payload unless it is a revisit."""
    revisit = F.col("record_type") == "revisit"
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    _line("Content-Length", F.col("size").cast("string")), F.lit("\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(html)
    referred = F.when(revisit, F.concat(
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))))
    return F.concat(
        F.lit(MAGIC), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), name, F.lit(">"))),
        F.coalesce(_line("WARC-Target-URI", _one_line(F.col("url"))), F.lit("")),
        _line("WARC-Date", F.lit(date)), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.coalesce(referred, F.lit("")), _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit("\r\n"), http, body, F.lit("\r\n\r\n"))


def write_archives(pages: DataFrame, path: str) -> None:
    """One archive per partition, uncompressed, one record per row of ``pages``."""
    record = record_text(F.col("html"))
    # The text writer ends each row with the line feed that ends the record.
    plan_records(pages).select(F.substring(record, F.lit(1), F.length(record) - 1).alias("value")).write.text(path)


def scan_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every stretch between two magics, in file order within (file, block); ``value`` holds its bytes."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"), "value"))


def parse_record(value: Column) -> dict[str, Column]:
    """Fields of the bytes behind a magic; null or of no use where they are not a record."""
    head = F.substring_index(value, "\r\n\r\n", 1)

    def field(name: str, pattern: str = r"[^\r\n]*", within: Column = head) -> Column:
        found = F.regexp_extract(within, rf"(?:^|\n){name}: ({pattern})(?:\r|$)", 1)
        return F.when(found != "", found)

    declared = field("Content-Length", r"\d{1,18}").cast("bigint")
    behind = F.octet_length(head) + 4
    block = F.substring(value.cast("binary"), behind + 1, declared.cast("int"))
    http = F.substring_index(block.cast("string"), "\r\n\r\n", 1)
    payload = F.substring(block, F.octet_length(http) + 5, declared.cast("int"))
    stored = field("WARC-Type") == "response"
    return {
        "record_type": field("WARC-Type"), "page_id": field("WARC-Record-ID", r"<urn:page:-?\d+>"),
        "url": field("WARC-Target-URI"),
        "refers_to": field("WARC-Refers-To", r"<urn:page:-?\d+>"), "reach": behind + declared + 4,
        "payload": payload,
        "payload_bytes": F.when(stored, F.octet_length(payload).cast("bigint"))
        .otherwise(field("Content-Length", r"\d{1,18}", http).cast("bigint")),
        "payload_digest": F.when(stored, F.sha1(payload))
        .otherwise(F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "")),
    }


def _hops(offset: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each candidate's successor among ``offset`` (itself if it has none here), and whether it has."""
    at = np.minimum(np.searchsorted(offset, after), len(offset) - 1)
    has = (offset[at] == after) & (after > offset)
    return np.where(has, at, np.arange(len(offset))), has


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    """Offsets of a block's candidates, and where the chain from each leaves the block (-1: nowhere)."""
    group = group.sort_values("seq")
    size = group["size"].to_numpy() + len(MAGIC)
    start = group["base"].to_numpy() + np.concatenate([[0], np.cumsum(size)[:-1]])
    offset = start - len(MAGIC)
    after = np.where(group["reach"].isna(), -1, offset + len(MAGIC) + group["reach"].fillna(0).to_numpy())
    hop, _ = _hops(offset, after)
    for _ in range(max(1, len(hop)).bit_length()):
        hop = hop[hop]
    end = start[-1] + size[-1] - len(MAGIC)
    out = np.where(after[hop] >= end, after[hop], -1)
    return group[["file", "block", "seq"]].assign(offset=offset.astype("int64"), after=after.astype("int64"),
                                                  exit=out.astype("int64"))


def _marked(group: pd.DataFrame) -> pd.DataFrame:
    """Candidates that the chain from the block's entry reaches, and the record each candidate lies in."""
    group = group.sort_values("seq")
    offset, after = group["offset"].to_numpy(), group["after"].to_numpy()
    reached = np.zeros(len(group), bool)
    hop, has = _hops(offset, after)
    reached[offset == group["entry"].iloc[0]] = True
    for _ in range(max(1, len(hop)).bit_length()):  # after k rounds the first 2^k links are known
        reached[hop[reached & has]] = True
        hop, has = hop[hop], has & has[hop]
    owner = np.maximum.accumulate(np.where(reached, offset, -1))
    return group[["file", "block", "seq", "offset", "after"]].assign(reached=reached, owner=owner)


def _entries(chains: DataFrame) -> DataFrame:
    """(file, offset): where the chain from each file's start enters its blocks, by pointer jumping.

    Round k knows the first 2^k entries: those known so far, and what 2^k links lead to from them.
    """
    reached = chains.where("offset = 0").select("file", "offset")
    blocks = chains.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] or 0
    links = chains.where("exit >= 0").select("file", "offset", "exit")
    for _ in range(max(0, blocks - 1).bit_length()):
        found = reached.join(links, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
        reached = durable(reached.union(found).distinct(), "warc-reached")
        ahead = links.select("file", F.col("offset").alias("exit"), F.col("exit").alias("far"))
        links = durable(links.join(ahead, ["file", "exit"]).select("file", "offset", F.col("far").alias("exit")),
                        "warc-links")
    return reached


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """The records of all archives below ``path``; the payload itself on request.

    A file that does not begin with a record, or whose chain breaks, gives the records up to
    the break. Empty files give none. Archives without pages give an empty table.
    """
    rows = scan_candidates(spark, path)
    parsed = parse_record(F.col("value"))
    wanted = [k for k in parsed if k not in ("reach", "payload")] + ["payload"] * keep_payload
    slim = durable(rows.select("file", "block", "seq", F.octet_length("value").cast("bigint").alias("size"),
                               parsed["reach"].alias("reach"), *(parsed[k].alias(k) for k in wanted)), "warc-candidates")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (slim.groupBy(*_KEY).agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
             .select(*_KEY, F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")))
    chains = durable(slim.select(*_KEY, "seq", "size", "reach").join(bases, _KEY).groupBy(*_KEY).applyInPandas(
        _exits, "file string, block bigint, seq bigint, offset bigint, after bigint, exit bigint"), "warc-chains")
    entries = _entries(chains)
    entry = (chains.select(*_KEY, "offset").join(entries, ["file", "offset"])
             .groupBy(*_KEY).agg(F.min("offset").alias("entry")))
    marked = (chains.join(entry, _KEY, "left").withColumn("entry", F.coalesce("entry", F.lit(-1)))
              .groupBy(*_KEY).applyInPandas(
        _marked, "file string, block bigint, seq bigint, offset bigint, after bigint, reached boolean, owner bigint"))
    marked = durable(marked, "warc-marked")
    # What stands before a block's first record belongs to the last record of an earlier block.
    last = marked.groupBy(*_KEY).agg(F.max("owner").alias("last"))
    carry = last.select(*_KEY, F.max("last").over(before).alias("carry"))
    owned = (marked.join(carry, _KEY)
             .withColumn("owner", F.when(F.col("owner") >= 0, F.col("owner")).otherwise(F.col("carry")))
             .where("owner >= 0"))
    pieces = durable(owned.groupBy("file", "owner").agg(F.count("*").alias("n"), F.max(
        F.when(F.col("reached"), F.struct("block", "seq"))).alias("at")).select("file", "owner", "n", "at.block", "at.seq"),
        "warc-pieces")
    whole = (slim.drop("size", "reach").join(pieces.where("n = 1").select("file", "block", "seq"), ["file", "block", "seq"])
             .select("file", *wanted))
    broken = pieces.where("n > 1").select("file", "owner")
    if not broken.isEmpty():
        # Records with a magic inside: their stretches are read again and joined.
        parts = owned.join(broken, ["file", "owner"]).select("file", "block", "seq", "owner", "offset")
        bytes_of = rows.join(parts, ["file", "block", "seq"]).select("file", "owner", "offset", "value")
        full = bytes_of.groupBy("file", "owner").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("offset", "value"))), lambda x: x["value"]), MAGIC).alias("value"))
        again = parse_record(F.col("value"))
        whole = whole.unionByName(full.select("file", *(again[k].alias(k) for k in wanted)))
    number: Callable[[str], Column] = lambda c: F.regexp_extract(c, r"(-?\d+)", 1).cast("bigint")
    return (whole.withColumn("page_id", F.when(F.col("page_id").isNotNull(), number("page_id")))
            .withColumn("refers_to", F.when(F.col("refers_to").isNotNull(), number("refers_to"))))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS target FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN g.target IS NOT NULL AND page_id IS DISTINCT FROM g.target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.target IS NOT NULL AND page_id IS DISTINCT FROM g.target THEN g.target END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""
