"""How far the sources of a language differ from each other, by a cube of group and term blocks.

Terms are counted per (language, source) and combined inside each task before anything is
shuffled. A cell of the cube is (language, group block, group block, term block): its task gets the
slices of two blocks of sources over one block of terms, makes them dense, and returns the part of
the divergence of every pair of sources that those terms give. Slices are sent to each cell
that needs them; the parts are added up along the term axis.

All cells have the same bounds whatever the sizes of sources and vocabularies: about ``GROUPS``
sources on either side and ``TERMS`` terms. Terms that no source of a cell has give one
constant per pair, which is multiplied in when the parts are added.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnmark.llm.common import durable, empty_text, released, table
from kilnmark.operators.skew import join_spread

GROUPS = 64
TERMS = 2048
LEAST_DOCS = 10
TOP = 10
#: Languages of which a task may get the totals as a broadcast; beyond, rows are dealt out to meet them.
FEW_LANGUAGES = 10_000
#: Distinct terms that a task holds before it passes its counts on.
HELD_TERMS = 200_000
_STRETCH = 1 << 20
_COUNTS = "lang string, source string, term string, n long, docs long"
_PARTS = "part string, lang string, source string, item string, value long, seen long, unseen long"


def stretches(data: bytes):
    """``data`` in pieces of about a mebibyte, cut behind a byte that is in no term."""
    at = 0
    while len(data) - at > _STRETCH:
        cut = re.compile(rb"[^a-zA-Z\x80-\xff]").search(data, at + _STRETCH)
        end = cut.end() if cut else len(data)
        yield data[at:end]
        at = end
    yield data[at:]


def count_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of a term in a group, and documents of the group with it.

    A row without a term stands for each group, with its number of documents. Nulls are
    read as empty text. Only A to Z are lower-cased; in UTF-8 the bytes of all other letters
    are above 127, so the scan runs over bytes.
    """
    def run(batches):
        terms = re.compile(rb"[a-z\x80-\xff]+").findall
        many, inside, rows = defaultdict(Counter), defaultdict(Counter), Counter()
        held = 0

        def flush():
            for group, found in many.items():
                names = list(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group[0]] * (len(names) + 1), pa.string()), pa.array([group[1]] * (len(names) + 1), pa.string()),
                     pa.array([*names, None], pa.binary()).cast(pa.string()), pa.array([*found.values(), 0], pa.int64()),
                     pa.array([*(inside[group][t] for t in names), rows[group]], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
            many.clear(), inside.clear(), rows.clear()

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(3)]
            for *group, data in zip(*columns):
                group = tuple(group)
                all_of, once, before = many[group], set(), len(many[group])
                for piece in stretches(data):
                    found = terms(piece.lower())
                    all_of.update(found)
                    once.update(found)
                inside[group].update(once)
                rows[group] += 1
                held += len(all_of) - before
                if held > HELD_TERMS:
                    yield from flush()
                    held = 0
        yield from flush()

    read = docs.select(empty_text(lang).alias("lang"), empty_text(source).alias("source"), empty_text(text).cast("binary").alias("text"))
    partial = read.mapInArrow(released(run), _COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), by long division so that nothing overflows below 9 * 10^15."""
    whole = np.maximum(total + 2 * terms, 1)
    part, rest = np.divmod(count + 2, whole)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        part = part * 1000 + more
    return part + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _cell(rows: pd.DataFrame) -> pd.DataFrame:
    """The parts that one cell gives: pairs between its two blocks, and on the diagonal the leading terms."""
    lang, left, right = rows["lang"].iloc[0], rows["left"].iloc[0], rows["right"].iloc[0]
    marks = rows[rows["term"].isna()].drop_duplicates("source").sort_values("source")
    kept = int(marks["kept"].iloc[0])
    data = rows[rows["term"].notna()]
    code, terms = pd.factorize(data["term"], sort=True)
    lang_count = np.zeros(len(terms), np.int64)
    lang_count[code] = data["lang_n"].to_numpy(np.int64)
    place = pd.Series(np.arange(len(marks)), index=marks["source"])
    count = np.zeros((len(marks), len(terms)), np.int64)
    count[place[data["source"]].to_numpy(), code] = data["n"].to_numpy(np.int64)
    total = marks["total"].to_numpy(np.int64)
    p, none = probability(count, total[:, None], kept), probability(np.zeros_like(total), total, kept)
    names, block = marks["source"].to_numpy(), marks["block"].to_numpy()
    out = []
    for a in np.flatnonzero(block == left):
        b = np.flatnonzero(block == right)
        b = b[b > a] if left == right else b
        out.append(pd.DataFrame({"part": "pair", "lang": lang, "source": names[a], "item": names[b],
                                 "value": divergence(p[a], p[b]).sum(axis=1) if kept else 0, "seen": len(terms),
                                 "unseen": divergence(none[a], none[b]) if kept else 0}))
    if left == right and len(terms):
        q = probability(lang_count, marks["lang_total"].to_numpy(np.int64)[:1], kept)
        for a in range(len(marks)):
            at = np.flatnonzero((count[a] > 0) & (p[a] > q))
            value = divergence(p[a][at], q[at])
            best = np.lexsort((at, -value))[:TOP]  # terms are in order, so a place decides ties as the term does
            out.append(pd.DataFrame({"part": "term", "lang": lang, "source": names[a], "item": np.asarray(terms)[at[best]],
                                     "value": value[best], "seen": 0, "unseen": 0}))
    columns = [c.split()[0] for c in _PARTS.split(", ")]
    return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)


def _with_language(rows: DataFrame, langs: DataFrame, deal_by: list[str]) -> DataFrame:
    """Rows with the totals of their language; one language may hold nearly all rows."""
    if langs.limit(FEW_LANGUAGES + 1).count() <= FEW_LANGUAGES:
        return rows.join(F.broadcast(langs), "lang")
    return join_spread(rows, langs, ["lang"], deal_by)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, groups: int = GROUPS, terms: int = TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: see the module; ``part`` is ``pair`` or ``term``.

    A language keeps the terms of at least ``least_docs`` of its documents. Null text, lang and source
    are read as empty. Repeated rows count each. Ties rank by item. An empty table gives no row; a group
    without terms has its pairs, a language of one source none. Other columns are not read.
    """
    counts = durable(count_terms(docs), "terms")
    found = counts.where(F.col("term").isNotNull())
    kept = durable(found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                   .where(F.col("docs") >= least_docs).drop("docs"), "kept")
    mine = durable(found.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    totals = mine.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = counts.where(F.col("term").isNull()).select("lang", "source")
    sources = durable(sources.join(totals, ["lang", "source"], "left").fillna(0, ["total"]), "sources")
    langs = sources.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    langs = langs.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")), "lang", "left")
    langs = durable(langs.fillna(0, ["kept", "lang_total"]).select(
        "lang", "kept", "lang_total", F.ceil(F.col("sources") / groups).alias("blocks"),
        F.greatest(F.ceil(F.col("kept") / terms), F.lit(1)).alias("slices")), "languages")

    # The rows of the cube: counts, and a mark for every source in each of the term blocks.
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).alias("block")
    nothing = F.lit(None).cast("bigint")
    slices = _with_language(mine, langs, ["term"]).select(
        "lang", "source", "term", "n", "lang_n", nothing.alias("total"), nothing.alias("lang_total"), nothing.alias("kept"),
        "blocks", block, F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice"))
    marks = _with_language(sources, langs, ["source"]).select(
        "lang", "source", F.lit(None).cast("string").alias("term"), nothing.alias("n"), nothing.alias("lang_n"), "total",
        "lang_total", "kept", "blocks", block, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"))
    cube = slices.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    cube = cube.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other")}).drop("blocks", "other")
    parts = durable(cube.groupBy("lang", "left", "right", "slice").applyInPandas(_cell, _PARTS), "cells")

    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.max("unseen").alias("unseen"))
    pairs = _with_language(pairs, langs.select("lang", "kept"), ["source", "item"])
    pairs = pairs.select("lang", "source", "item", (F.col("value") + (F.col("kept") - F.col("seen")) * F.col("unseen")).alias("value"))
    both = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    led = parts.where("part = 'term'").select("lang", "source", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (both.select("*", F.lit("pair").alias("part"), rank).select(*columns)
            .unionByName(led.select("*", F.lit("term").alias("part"), rank).where(F.col("rank") <= TOP).select(*columns)))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
occ AS (SELECT id, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM occ GROUP BY ALL HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 2)) // (n + 2 * v) AS q FROM kept JOIN langs USING (lang)),
groups AS (SELECT DISTINCT lang, source FROM docs),
cnt AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM groups LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
p AS (SELECT lang, source, term, coalesce(cnt.c, 0) AS c, q, 1 + (1000000000::HUGEINT * (coalesce(cnt.c, 0) + 2)) // (tot.n + 2 * langs.v) AS p
      FROM tot JOIN langs USING (lang) JOIN q USING (lang) LEFT JOIN cnt USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item,
                coalesce((SELECT NULL), 0) AS z FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
sums AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
         FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
valued AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pair LEFT JOIN sums USING (lang, source, item)
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM valued QUALIFY part = 'pair' OR rank <= 10
"""
