"""Merkle manifest of a dataset: one tree per source, and one tree over the sources' roots.

``H`` is the lower-case hex SHA-256 of its inputs end to end, digests as hex text. A leaf is H of a
row's columns, each ``-`` if null and otherwise its number of UTF-8 bytes, ``:`` and the value. Leaves
of a source ascend by doc_id; while several nodes remain, every ``FAN`` consecutive ones become
their H, the last run with fewer, even one. What remains is the source's subroot. Subroots, ordered
by source (null first, by bytes), give the root in the same way.

Method: checkpoint and recompute. Only every ``EVERY`` levels are stored: the leaves, then the tops of
aligned subtrees of ``FAN ** EVERY`` nodes, then theirs. For a proof the interior nodes of an
aligned subtree are made again from its stored nodes, the siblings on the way up are given out, and
the interior nodes are forgotten. Proofs go down from the root: those of a stored level are its
subtree's siblings, then the proof of the subtree's top, found by a join with the level above,
which has 1 / ``FAN ** EVERY`` of the rows.

Skew: places in a tree come from sorted ranges of (source, doc_id, leaf), so a source with most rows
is spread over many tasks, and so are its subtrees, the unit of every later step. Nothing moves but
digests and keys: texts are hashed in the scan.

Defined results: rows with equal or null doc_id are leaves as any other, null first, equal ones by
their digest; an empty table gives no rows and no root; every row gives one row; other columns are
ignored but for those to carry.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from trackmill.llm.common import CRC_SQL, partitions, shared_folder, stored, table

FAN = 3
EVERY = 4
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<left:string,right:string>>"
_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def leaf_digest(values: Sequence[Column]) -> Column:
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(v) for v in values]).cast("binary"), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, digest, lambda node, at: F.sha2(F.concat(at["left"], node, at["right"]).cast("binary"), 256))


def siblings(path: Column) -> Column:
    """All siblings from the leaf to the root, left to right within a level."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), "")


def _tree_of(source: Column) -> Column:
    """A tree's key: never null, and in the order of sources with null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` stored with their place (``_at``) in their ``_tree`` and the tree's size (``_of``).

    Ranges of the whole order are sorted each by itself; a row's place is its number in its range
    plus the rows of its tree in earlier ranges. There are at most as many (range, tree) pairs as
    trees and ranges together.
    """
    # equal rows are dealt by a number of their own, so that they may fill many ranges
    spread = rows.withColumn("_row", F.monotonically_increasing_id())
    keys = ["_tree", *order, "_row"]
    ranges = spread.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys).drop("_row")
    ranges = stored(ranges.withColumn("_number", F.monotonically_increasing_id()))
    ranges = ranges.withColumn("_range", F.shiftright("_number", 33))
    tree = Window.partitionBy("_tree")
    parts = ranges.groupBy("_range", "_tree").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n"))
    parts = parts.select(
        "_range",
        "_tree",
        (F.sum("_n").over(tree.orderBy("_range")) - F.col("_n") - F.col("_first")).alias("_shift"),
        F.sum("_n").over(tree).alias("_of"),
    )
    placed = ranges.join(parts, ["_range", "_tree"]).withColumn("_at", F.col("_number") + F.col("_shift"))
    return placed.drop("_number", "_range", "_shift")


def _levels(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _interior(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of an aligned subtree, level by level, from its stored nodes up to its top."""
    made = [nodes]
    for _ in range(levels):
        nodes = [sha256("".join(nodes[i : i + FAN]).encode()).hexdigest() for i in range(0, len(nodes), FAN)]
        made.append(nodes)
    return made


def _way_up(made: list[list[str]], i: int) -> list[dict[str, str]]:
    """The siblings of node ``i`` of the lowest level at each step to the top."""
    path = []
    for nodes in made[:-1]:
        low = i - i % FAN
        path.append({"left": "".join(nodes[low:i]), "right": "".join(nodes[i + 1 : low + FAN])})
        i //= FAN
    return path


def _subtrees(nodes: DataFrame, level: int) -> DataFrame:
    """One row per aligned subtree over a stored level: its nodes in order, and how far it reaches up."""
    row = F.struct("_at", *[c for c in nodes.columns if c not in ("_tree", "_at", "_of")])
    return nodes.groupBy("_tree", F.expr(f"_at div {FAN**EVERY}").alias("_subtree")).agg(
        F.array_sort(F.collect_list(row)).alias("_nodes"),  # at most FAN ** EVERY of them
        F.max("_of").alias("_of"),
    ).withColumn("_level", F.lit(level))


def _reach(of: int, level: int) -> int:
    """Levels that a subtree over ``level`` makes: up to the next stored one, or to the tree's root."""
    return min(EVERY, _levels(of) - level)


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["_tree", "_at", "_of"]
    for rows in batches:
        facts = zip(rows["_digests"].to_pylist(), rows["_of"].to_pylist(), rows["_level"].to_pylist())
        tops = [_interior(nodes, _reach(of, level))[-1][0] for nodes, of, level in facts]
        yield pa.RecordBatch.from_arrays([*[rows[n] for n in names], pa.array(tops, pa.string())], names=[*names, "digest"])


def _way(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for x in range(rows.num_rows):  # a subtree's paths at a time
            one = rows.slice(x, 1)
            nodes = one["_nodes"].flatten()
            made = _interior(nodes.field("digest").to_pylist(), _reach(one["_of"][0].as_py(), one["_level"][0].as_py()))
            rest = one["_rest"][0].as_py() or []
            paths = pa.array([_way_up(made, i) + rest for i in range(len(nodes))], _PATH)
            same = pa.array([0] * len(nodes))
            kept = [one[n].take(same) for n in ("_tree", "_root")]
            yield pa.RecordBatch.from_arrays([*kept, nodes, paths], names=["_tree", "_root", "_node", "path"])


def _paths(subtrees: DataFrame, above: DataFrame | None) -> DataFrame:
    """Every stored node of a level with its path to the end and its tree's root.

    ``above`` has those of the level above; without it the trees end here.
    """
    if above is None:
        known = subtrees.withColumn("_rest", F.lit(None).cast(PATH)).withColumn("_root", F.lit(None).cast("string"))
    else:
        upper = above.select("_tree", F.col("_at").alias("_subtree"), F.col("path").alias("_rest"), "_root")
        known = subtrees.join(upper, ["_tree", "_subtree"])
    fields = T.StructType(subtrees.schema["_nodes"].dataType.elementType.fields)
    schema = T.StructType().add("_tree", "string").add("_root", "string").add("_node", fields)
    schema.add("path", T.StructType.fromDDL(f"path {PATH}")["path"].dataType)
    rows = known.select("_tree", "_root", "_of", "_level", "_nodes", "_rest")
    return rows.mapInArrow(_way, schema).select("_tree", "_root", "_node.*", "path")


def _store(nodes: DataFrame, folder: str) -> int:
    """Store every ``EVERY``-th level of the trees over ``nodes``; the number of levels above the leaves."""
    spark = nodes.sparkSession
    nodes.write.parquet(f"{folder}/level=0")
    levels = _levels(spark.read.parquet(f"{folder}/level=0").agg(F.max("_of")).first()[0] or 0)
    for level in range(0, levels, EVERY):
        # a tree that has ended has no nodes above its root
        going = spark.read.parquet(f"{folder}/level={level}").filter(F.col("_of") > FAN**level)
        below = _subtrees(going, level).select("_tree", F.col("_subtree").alias("_at"), "_of", "_level", F.col("_nodes.digest").alias("_digests"))
        below.mapInArrow(_top, "_tree string, _at long, _of long, digest string").write.parquet(f"{folder}/level={level + EVERY}")
    return levels


def _ends_at(size: Column, level: int) -> Column:
    """Trees of so many leaves whose root is in this stored level: not below it, not above it."""
    above = F.lit(True) if level == 0 else size > FAN ** (level - EVERY)
    return above & (size <= FAN**level)


def _roots(spark: SparkSession, folder: str, levels: int) -> DataFrame:
    """The root of every tree, with its number of leaves."""
    found = [
        spark.read.parquet(f"{folder}/level={level}").filter(_ends_at(F.col("_of"), level)).select("_tree", "_of", "digest")
        for level in range(0, levels + EVERY, EVERY)
    ]
    return reduce(DataFrame.unionByName, found)


def write_manifest(rows: DataFrame, folder: str, carry: Sequence[str] = ()) -> None:
    """Store the trees of ``rows`` (source, doc_id, leaf and the columns to carry) under ``folder``."""
    spark = rows.sparkSession
    leaves = rows.select(_tree_of(F.col("source")).alias("_tree"), "doc_id", F.col("leaf").alias("digest"), *carry)
    levels = _store(_numbered(leaves, ["doc_id", "digest"]), f"{folder}/documents")
    subroots = _roots(spark, f"{folder}/documents", levels)
    subroots = subroots.select(F.lit("").alias("_tree"), F.col("_tree").alias("of"), F.col("_of").alias("leaves"), "digest")
    above = _store(_numbered(subroots, ["of"]), f"{folder}/sources")
    root = _roots(spark, f"{folder}/sources", above).first()  # one row, or none
    heights = [(levels, above, root["digest"] if root else None)]
    spark.createDataFrame(heights, "documents int, sources int, root string").coalesce(1).write.parquet(f"{folder}/heights")


def _all_paths(spark: SparkSession, folder: str, levels: int, ends: DataFrame | None) -> DataFrame:
    """Paths of the leaves of all trees. ``ends``: how each tree's path goes on, with its leaves and root."""
    found = None
    for level in range(max(levels - 1, 0) // EVERY * EVERY, -1, -EVERY):
        nodes = spark.read.parquet(f"{folder}/level={level}")
        going = nodes.filter(F.col("_of") > FAN**level) if level else nodes
        upper = None if found is None else found.select("_tree", "_at", "path", "_root")
        if ends is not None:
            here = _ends_at(F.col("leaves"), level + EVERY)
            if level == 0:
                here |= F.col("leaves") <= 1
            roots = ends.filter(here).select("_tree", F.lit(0).cast("long").alias("_at"), "path", "_root")
            upper = roots if upper is None else upper.unionByName(roots)
        found = _paths(_subtrees(going, level), upper)
        found = stored(found) if level else found
    return found


def proofs(spark: SparkSession, folder: str) -> DataFrame:
    """Every leaf with its subroot, the root, the siblings on its way there, and what it carries."""
    levels, above, root = spark.read.parquet(f"{folder}/heights").first()
    sources = _all_paths(spark, f"{folder}/sources", above, None)
    ends = stored(sources.select(F.col("of").alias("_tree"), "leaves", "path", F.col("digest").alias("_root")))
    found = _all_paths(spark, f"{folder}/documents", levels, ends).withColumn("root", F.lit(root))
    return found.withColumn("source", F.when(F.col("_tree") != "", F.expr("substr(_tree, 2)"))).drop(
        "_tree", "_at"
    ).withColumnsRenamed({"digest": "leaf", "_root": "subroot"})


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(changed, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = docs.select(
        "source",
        "doc_id",
        leaf_digest([F.col(c) for c in COLUMNS]).alias("leaf"),
        leaf_digest([F.col(c) for c in COLUMNS[:-1]] + [text]).alias("presented"),
    )
    folder = f"{shared_folder(spark)}/merkle-{uuid.uuid4().hex}"
    write_manifest(rows, folder, carry=["presented"])
    found = proofs(spark, folder).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        folded(F.col("presented"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


OP13_SQL = f"""
with recursive {CRC_SQL}, row_text as (
    select d.doc_id, source, lang, n_chars, text, case when h % 2 = 0 then replace(text, chr(10), '') else text end as other
    from documents d left join crc on d.doc_id = crc.doc_id
), part as (
    select doc_id, source, other is distinct from text as changed,
           coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as front, text, other
    from row_text
), leaf as (
    select doc_id, source,
           sha256(front || coalesce(strlen(text) || ':' || text, '-')) as leaf,
           sha256(front || coalesce(strlen(other) || ':' || other, '-')) as presented
    from part
), placed as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
           count(*) over (partition by source) as n from leaf
), node as (
    select source, 0 as level, pos, n, leaf as digest from placed
    union all
    select source, level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' order by pos))
    from node where n > 1 group by source, level, pos // 3
), subroot as (
    select source, digest, level as height, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n
    from node where n = 1
), high as (
    select 0 as level, pos, n, digest from subroot
    union all
    select level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' order by pos))
    from high where n > 1 group by level, pos // 3
), fold as (
    select p.doc_id, p.leaf, p.presented as digest, p.source, s.pos as place, s.digest as subroot, s.height, 0 as level, p.pos, '' as proof
    from placed p join subroot s on p.source is not distinct from s.source
    union all
    select f.doc_id, f.leaf, sha256(concat(coalesce(x.before, ''), f.digest, coalesce(x.after, ''))), f.source, f.place,
           f.subroot, f.height, f.level + 1, f.pos // 3, concat(f.proof, coalesce(x.before, ''), coalesce(x.after, ''))
    from fold f join (
        select a.source, a.level, a.pos,
               string_agg(b.digest, '' order by b.pos) filter (b.pos < a.pos) as before,
               string_agg(b.digest, '' order by b.pos) filter (b.pos > a.pos) as after
        from node a join node b on a.source is not distinct from b.source and a.level = b.level and a.pos // 3 = b.pos // 3
        where a.n > 1 group by a.source, a.level, a.pos
    ) x on f.source is not distinct from x.source and f.level = x.level and f.pos = x.pos
    where f.level < f.height
), fold_high as (
    select doc_id, leaf, subroot, digest, 0 as level, place as pos, proof from fold where level = height
    union all
    select f.doc_id, f.leaf, f.subroot, sha256(concat(coalesce(x.before, ''), f.digest, coalesce(x.after, ''))), f.level + 1,
           f.pos // 3, concat(f.proof, coalesce(x.before, ''), coalesce(x.after, ''))
    from fold_high f join (
        select a.level, a.pos,
               string_agg(b.digest, '' order by b.pos) filter (b.pos < a.pos) as before,
               string_agg(b.digest, '' order by b.pos) filter (b.pos > a.pos) as after
        from high a join high b on a.level = b.level and a.pos // 3 = b.pos // 3
        where a.n > 1 group by a.level, a.pos
    ) x on f.level = x.level and f.pos = x.pos
)
select f.doc_id, f.leaf, f.subroot, r.digest as root, sha256(f.proof) as proof_sha256,
       f.digest as folded_root, f.digest = r.digest as verified
from fold_high f join (select level as top, digest from high where n = 1) r on f.level = r.top
"""
