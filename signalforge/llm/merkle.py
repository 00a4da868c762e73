"""A manifest of a dataset: Merkle trees of its rows, a group's tree below a tree of groups, level by level in windows.

Leaves of a group are numbered in their order without a window over the group: they are sorted by range, each row is
numbered within its range, and the counts of ranges before are added. A level is one window: partitioned by group and
parent number, an ordered full-frame collect_list hands every node its whole run, which is the parent's preimage and the
siblings in one; the run's first node stands for the parent, so parents are unique before the next level. A key holds
FAN nodes at most, so no source is hot. Each level's runs are written below spark.checkpoint.dir: a third of the level
before, and a lost executor costs only running tasks.

Proofs come down the same tables: from the roots, each run is joined with its parent's path and gives its nodes theirs.
All levels are in one plan. A row carries its path (siblings left and right, as bytes, a level) and nothing else.

Rows with equal order columns are told apart by their leaf; wholly repeated rows have equal leaves at neighbouring places.
Null fields are `-`; a null group comes first, a null doc_id comes first in its group and is not tampered with. Empty texts
are fields of zero bytes. Texts of any length are hashed whole. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import maybe_broadcast, stored, table

#: Children of a node.
FAN = 3
#: Ranges and groups, of which each pair has one row, up to which their counts are sent to all executors.
MOST_RANGES = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """A value so that no two lists of values read alike: its UTF-8 byte count, a colon, and the value; `-` for null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def indexed(rows: DataFrame, *order: str) -> DataFrame:
    """rows with idx, their number from 0 within g in the given order, and n, how many g has."""
    by = ["g", *order]
    rows = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)  # the upper bits of these ids are the partition's number
    counts = rows.groupBy("g", part.alias("part")).agg(F.count("*").alias("many"), F.min("place").alias("first"))
    before = Window.partitionBy("g").orderBy("part")
    counts = stored(counts.select("g", "part", (F.sum("many").over(before) - F.col("many") - F.col("first")).alias("shift"), F.sum("many").over(Window.partitionBy("g")).alias("n")))
    placed = rows.withColumn("part", part).join(maybe_broadcast(counts, MOST_RANGES), ["g", "part"])
    return placed.withColumn("idx", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def level(nodes: DataFrame, *carried: str) -> DataFrame:
    """The runs of nodes (g, idx, n, h): (g, idx, n) of each run's parent and the run, an array of structs (h, carried columns)."""
    run = Window.partitionBy("g", "parent").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = nodes.filter("n > 1").withColumn("parent", F.expr(f"idx DIV {FAN}")).withColumn("run", F.collect_list(F.struct("h", *carried)).over(run))
    return runs.filter(f"idx % {FAN} = 0").select("g", F.col("parent").alias("idx"), F.expr(f"(n + {FAN - 1}) DIV {FAN}").alias("n"), "run")


def parents(runs: DataFrame) -> DataFrame:
    return runs.select("g", "idx", "n", F.sha2(F.array_join("run.h", ""), 256).alias("h"))


def levels(leaves: DataFrame, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, from the leaves (g, idx, n, h, carried) up, and the roots (g, height, h)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    found, nodes = [], leaves
    roots = leaves.filter("n = 1").select("g", F.lit(0).alias("height"), "h")
    while most > 1:
        found.append(stored(level(nodes, *(carried if not found else ()))))
        nodes, most = parents(found[-1]), -(-most // FAN)
        roots = roots.unionByName(nodes.filter("n = 1").select("g", F.lit(len(found)).alias("height"), "h"))
    return found, roots


def paths(found: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(g, item, subroot, path) of every leaf below roots of any height but 0: its siblings at each level, then the root's own path.

    tops are the roots (g, height, subroot, path), a path being an array of structs (before, after) of hashes as bytes.
    """
    known = None
    for k in range(len(found), 0, -1):
        here = tops.filter(F.col("height") == k).select("g", F.lit(0).cast("long").alias("idx"), "subroot", "path")
        known = here if known is None else known.unionByName(here)
        children = found[k - 1].join(known, ["g", "idx"]).select("g", F.col("idx").alias("parent"), "subroot", "path", "run", F.posexplode("run").alias("at", "item"))
        side = lambda start, many: f"unhex(array_join(slice(run.h, {start}, {many}), ''))"
        own = F.array(F.struct(F.expr(side("1", "at")).alias("before"), F.expr(side("at + 2", str(FAN))).alias("after")))
        known = children.select("g", (F.col("parent") * FAN + F.col("at")).alias("idx"), "item", "subroot", F.concat(own, "path").alias("path"))
        if k > 1:
            known = known.drop("item")
    return known


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, start, lambda h, p: F.sha2(F.concat(F.lower(F.hex(p["before"])), h, F.lower(F.hex(p["after"]))), 256))


def proof(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, as hexadecimal text."""
    return F.array_join(F.transform(path, lambda p: F.concat(F.lower(F.hex(p["before"])), F.lower(F.hex(p["after"])))), "")


NO_PATH = "CAST(array() AS array<struct<before: binary, after: binary>>)"


def manifest(leaves: DataFrame) -> DataFrame:
    """(source, doc_id, changed, leaf, subroot, root, path) of leaves (source, doc_id, h, changed): a tree a source, below one tree of sources."""
    # A key that sorts as the source does, a null source first, and is never null itself.
    keyed = stored(leaves.withColumn("g", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).select("g", "doc_id", "h", "changed"))
    placed = stored(indexed(keyed, "doc_id", "h", "changed"))
    found, roots = levels(placed, "doc_id", "changed")
    roots = stored(roots)
    # The tree of sources: its leaves are the subroots, and each carries its source and its height.
    all_of = roots.select(F.lit("").alias("g"), F.col("g").alias("source_key"), "height", "h")
    above = stored(indexed(all_of, "source_key"))
    upper, top = levels(above, "source_key", "height")
    root = top.first()
    if root is None:
        root, tops = (None, 0, None), above.select(F.col("source_key").alias("g"), "height", F.col("h").alias("subroot"), F.expr(NO_PATH).alias("path"))
    elif not upper:
        tops = above.select(F.col("source_key").alias("g"), "height", F.col("h").alias("subroot"), F.expr(NO_PATH).alias("path"))
    else:
        start = top.select("g", "height", F.col("h").alias("subroot"), F.expr(NO_PATH).alias("path"))
        tops = paths(upper, start).select(F.col("item.source_key").alias("g"), F.col("item.height").alias("height"), F.col("item.h").alias("subroot"), "path")
    tops = stored(tops)
    alone = placed.filter("n = 1").join(tops.filter("height = 0"), "g").select("g", "doc_id", "changed", "h", "subroot", "path")
    rows = alone if not found else paths(found, tops).select("g", "item.doc_id", "item.changed", "item.h", "subroot", "path").unionByName(alone)
    source = F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias("source")
    return rows.select(source, "doc_id", "changed", F.col("h").alias("leaf"), "subroot", F.lit(root[2]).cast("string").alias("root"), "path")


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents; `changed` is the leaf of a text without line feeds where the contract tampers with it, else null."""
    plain = [F.col(c) for c in FIELDS]
    bare = [*plain[:-1], F.translate("text", "\n", "")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return docs.select("source", "doc_id", leaf(*plain).alias("h"), F.when(tampered, leaf(*bare)).alias("changed"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(document_leaves(table(spark, sf_dir, "documents")))
    rows = rows.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP11_SQL = r"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), CAST(i AS BIGINT))) AS t),
d AS (SELECT doc_id, source, '' || CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
 || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head, text,
 xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 2 = 0 AS tampered FROM documents, crc),
leaves AS (SELECT doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
 CASE WHEN tampered THEN sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '') END) END AS changed FROM d),
placed AS (SELECT *, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
low(g, lvl, idx, n, h) AS (SELECT g, 0, idx, n, leaf FROM placed UNION ALL SELECT g, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY g, lvl, idx // 3, n),
low_runs AS (SELECT g, lvl, idx // 3 AS parent, list(h ORDER BY idx) AS run FROM low WHERE n > 1 GROUP BY g, lvl, idx // 3),
roots AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, idx, n, h) AS (SELECT 0, idx, n, subroot FROM roots UNION ALL SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY lvl, idx // 3, n),
high_runs AS (SELECT lvl, idx // 3 AS parent, list(h ORDER BY idx) AS run FROM high WHERE n > 1 GROUP BY lvl, idx // 3),
up(doc_id, leaf, g, lvl, idx, h, proof) AS (SELECT doc_id, leaf, g, 0, idx, coalesce(changed, leaf), '' FROM placed
 UNION ALL SELECT u.doc_id, u.leaf, u.g, u.lvl + 1, u.idx // 3, sha256(array_to_string(run[1:u.idx % 3], '') || u.h || array_to_string(run[u.idx % 3 + 2:], '')), proof || array_to_string(run[1:u.idx % 3], '') || array_to_string(run[u.idx % 3 + 2:], '') FROM up u JOIN low_runs r ON r.g = u.g AND r.lvl = u.lvl AND r.parent = u.idx // 3),
at_subroot AS (SELECT u.doc_id, u.leaf, u.h, u.proof, r.subroot, r.idx FROM (SELECT *, max(lvl) OVER (PARTITION BY g) AS top FROM up) u JOIN roots r ON r.g = u.g WHERE u.lvl = u.top),
across(doc_id, leaf, subroot, lvl, idx, h, proof) AS (SELECT doc_id, leaf, subroot, 0, idx, h, proof FROM at_subroot
 UNION ALL SELECT u.doc_id, u.leaf, u.subroot, u.lvl + 1, u.idx // 3, sha256(array_to_string(run[1:u.idx % 3], '') || u.h || array_to_string(run[u.idx % 3 + 2:], '')), proof || array_to_string(run[1:u.idx % 3], '') || array_to_string(run[u.idx % 3 + 2:], '') FROM across u JOIN high_runs r ON r.lvl = u.lvl AND r.parent = u.idx // 3)
SELECT a.doc_id, a.leaf, a.subroot, t.h AS root, sha256(a.proof) AS proof_sha256, a.h AS folded_root, a.h = t.h AS verified FROM (SELECT *, max(lvl) OVER () AS top FROM across) a CROSS JOIN (SELECT h FROM high WHERE n = 1) t WHERE a.lvl = a.top
"""
