"""A Merkle manifest of a dataset, with proofs, by nested-interval labels.

Every row is a leaf; its place is its rank within its group. A node carries the interval
[lo, hi) of leaf ranks that it covers, so ancestry is containment of intervals: the nodes of
one level meet those of the next in a join on (group, bucket of the level) with containment, and the
siblings of a node are the intervals of its parent's run without its own. The tree over the
groups' roots is built by the same functions.

Nothing is gathered by group: ranks come from a range-partitioned sort and one count per
partition and group, a run has at most ``ARITY`` nodes, and a leaf meets one parent, which
carries the siblings above it. A group with a third of all rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnmark.llm.common import durable, table

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
_ROW_BITS = 33
_PATH = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def group_key(group: str) -> Column:
    """The group as text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))


def ranked(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0, by ``order``, nulls first) and ``size`` of their ``key``.

    Rows that are equal in ``order`` are dealt out by their place in a stored table, so a run of
    equal rows of any length is cut over several partitions and ranked the same on every read.
    """
    stored = durable(rows.withColumn("tie", F.monotonically_increasing_id()), label)
    by = [F.col(c).asc_nulls_first() for c in ("key", *order, "tie")]
    placed = stored.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = durable(placed.drop("tie").withColumn("at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("part", F.shiftright("at", _ROW_BITS))
    # At most one row for each partition and key, and a key's rows here are no more than the partitions.
    runs = placed.groupBy("key", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("key")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("key", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("n").over(whole).alias("size"))
    return (placed.join(durable(runs, f"{label}-runs"), ["key", "part"])
            .withColumn("rank", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def _digests(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")


def levels_of(leaves: DataFrame, label: str) -> list[DataFrame]:
    """The inner nodes level by level: ``key, lo, hi, size, kids, digest``.

    ``kids`` are the intervals and digests of the run below. A group stops at the level where
    one node covers it. Only the size of the largest group reaches the driver.
    """
    largest = leaves.agg(F.max("size")).first()[0] or 0
    nodes, levels, span = leaves.select("key", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "size", "digest"), [], 1
    while span < largest:
        runs = (nodes.where(F.col("size") > span).groupBy("key", _bucket("lo", span * ARITY).alias("bucket"))
                .agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"), F.max("size").alias("size")))
        level = runs.select("key", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"), "size", "kids",
                            F.sha2(_digests(F.col("kids")), 256).alias("digest"))
        levels.append(nodes := durable(level, f"{label}-level"))
        span *= ARITY
    return levels


def _bucket(lo: str, span: int) -> Column:
    return F.expr(f"{lo} div {span}")


def _is_root() -> Column:
    return F.col("hi") - F.col("lo") == F.col("size")


def roots_of(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``key, digest`` of the one node that covers each group; the leaf itself in a group of one."""
    roots = leaves.where("size = 1").select("key", "digest")
    for level in levels:
        roots = roots.unionByName(level.where(_is_root()).select("key", "digest"))
    return roots


def _attach(nodes: DataFrame, parents: DataFrame, span: int, carry: Sequence[str]) -> DataFrame:
    """Nodes below their parents: the containment join of one level.

    ``path`` grows at its front by the siblings on either side: the parent's run without the node's interval.
    """
    above = parents.select(F.col("key").alias("up_key"), _bucket("lo", span).alias("up_bucket"), F.col("lo").alias("up_lo"),
                           F.col("hi").alias("up_hi"), F.col("kids").alias("up_kids"), F.col("path").alias("up_path"), *carry)
    inside = ((F.col("key") == F.col("up_key")) & (_bucket("lo", span) == F.col("up_bucket"))
              & (F.col("lo") >= F.col("up_lo")) & (F.col("hi") <= F.col("up_hi")))
    left = _digests(F.filter("up_kids", lambda x: x["hi"] <= F.col("lo")))
    right = _digests(F.filter("up_kids", lambda x: x["lo"] >= F.col("hi")))
    path = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("up_path"))
    return nodes.join(above, inside).select(*nodes.columns, path.alias("path"), *carry)


def with_paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, carry: Sequence[str]) -> DataFrame:
    """``leaves`` with ``path``, the siblings from the leaf up, and the columns ``carry`` of their group.

    ``tops`` gives for each ``key`` the ``path`` above its root and ``carry``. Levels are taken from the top.
    """
    leaves = leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1})
    parents = None
    for k in range(len(levels), -1, -1):
        nodes = levels[k - 1] if k else leaves
        here = nodes.where(_is_root()).join(tops, "key").select(*nodes.columns, "path", *carry)
        if parents is not None:
            here = here.unionByName(_attach(nodes.where(~_is_root()), parents, ARITY ** (k + 1), carry))
        parents = here
    return parents.drop("lo", "hi")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its siblings."""
    return F.aggregate(path, leaf, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id",
             changed: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, source, leaf, other_leaf, subroot, root, path``: one row per row of ``docs``.

    A leaf is the digest of ``fields``; ``group`` and ``order`` are among them. ``changed`` gives other values for
    some fields; ``other_leaf`` is the leaf with them (null without ``changed``), to be checked against the path.
    Null groups are a group of their own and come first, null ``order`` comes first. Rows that repeat an
    id are leaves each, in the order of their digests, so equal rows may stand for one another. Columns
    that are not among ``fields`` are not read and do not come back. An empty table gives no row.
    """
    values = {name: F.col(name) for name in fields}
    other = leaf_digest([*(values | changed).values()]) if changed else F.lit(None).cast("string")
    leaves = ranked(docs.select(group_key(group).alias("key"), F.col(order), F.col(group), leaf_digest([*values.values()]).alias("digest"),
                                other.alias("other_leaf")), [order, "digest"], "leaves")
    levels = levels_of(leaves, "manifest")
    subroots = ranked(roots_of(leaves, levels).select(F.lit("").alias("key"), F.col("key").alias("group_key"), "digest"),
                      ["group_key"], "subroots")
    upper = levels_of(subroots, "top")
    top = roots_of(subroots, upper).select("key", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    tops = with_paths(subroots, upper, top, ["root"])
    tops = tops.select(F.col("group_key").alias("key"), "path", F.col("digest").alias("subroot"), "root")
    return with_paths(leaves, levels, durable(tops, "tops"), ["subroot", "root"]).select(
        order, group, F.col("digest").alias("leaf"), "other_leaf", "subroot", "root", "path")


def lower_ascii(column: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, recomputed from a tampered text where 5 divides the checksum of its id."""
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    made = manifest(docs, changed={"text": F.when(hit, lower_ascii(F.col("text"))).otherwise(F.col("text"))})
    folded = made.withColumns({"folded_root": fold(F.col("other_leaf"), F.col("path")), "proof_sha256": proof_digest(F.col("path"))})
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_tree(name: str, key: str, depth: int) -> str:
    """CTEs ``name``0 .. ``name``depth (key, pos, d) of a tree, and ``name``_way(key, pos, k, l, r): siblings of place pos on level k."""
    parts = []
    for k in range(depth):
        here = f"SELECT {key}, pos, d, count(*) OVER (PARTITION BY {key}) AS n FROM {name}{k}"
        frame = f"OVER (PARTITION BY {key}, pos // 16 ORDER BY pos ROWS BETWEEN"
        parts += [f"""{name}{k}s AS (SELECT {key}, pos,
            CASE WHEN n = 1 THEN NULL ELSE coalesce(string_agg(d, '') {frame} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
            CASE WHEN n = 1 THEN NULL ELSE coalesce(string_agg(d, '') {frame} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r FROM ({here}))""",
                  f"""{name}{k + 1} AS (SELECT {key}, pos // 16 AS pos,
            CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d
            FROM ({here}) GROUP BY {key}, pos // 16)"""]
    return ",\n".join(parts)


def _oracle(depth: int = 7) -> str:
    """Unrolled: enough for 16^7 rows of a source and as many sources."""
    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = ("flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
            "lambda c: list_transform(range(8), lambda i: CAST((ascii(c) >> CAST(i AS INTEGER)) & 1 AS BIGINT))))")
    crc = f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"
    joins, acc, way = "", "d.used", "''"
    for tree, n_key in (("s", "coalesce(s{k}s.g, '') = d.g"), ("t", "true")):
        for k in range(depth):
            at = "d.pos" if tree == "s" else "d.place"
            joins += f"\n LEFT JOIN {tree}{k}s ON {n_key.format(k=k)} AND {tree}{k}s.pos = {at} // {16 ** k}"
            way += f" || coalesce({tree}{k}s.l || {tree}{k}s.r, '')"
    steps = [f"{tree}{k}s" for tree in "st" for k in range(depth)]
    folds = []
    for k, s in enumerate(steps):
        folds.append(f"f{k + 1} AS (SELECT * REPLACE (CASE WHEN {s}_l IS NULL THEN acc ELSE sha256({s}_l || acc || {s}_r) END AS acc) FROM f{k})")
    sides = ", ".join(f"{s}.l AS {s}_l, {s}.r AS {s}_r" for s in steps)
    return f"""WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS g, {leaf('text')} AS leaf,
         CASE WHEN {crc} % 5 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS used FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs),
s0 AS (SELECT g, pos, leaf AS d FROM placed),
{_sql_tree('s', 'g', depth)},
t0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, d, g FROM s{depth}),
{_sql_tree('t', 'one', depth)},
d AS (SELECT placed.*, t0.pos AS place, t0.d AS subroot FROM placed JOIN t0 USING (g)),
f0 AS (SELECT d.doc_id, d.leaf, d.subroot, {acc} AS acc, sha256({way}) AS proof_sha256, {sides} FROM d {joins}),
{', '.join(folds)}
SELECT doc_id, leaf, subroot, t{depth}.d AS root, proof_sha256, acc AS folded_root, acc = t{depth}.d AS verified
FROM f{len(steps)}, t{depth}"""


ORACLE = _oracle()
