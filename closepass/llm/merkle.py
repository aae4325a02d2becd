"""A Merkle manifest of a table: one tree for each value of a column, and one over their roots.

A node's children are spread into `FANOUT` slot columns by conditional aggregates.  The columns, concatenated,
are what the parent hashes; the same columns without a child's own one are its siblings.  Trees grow level
by level, each level written once with an eighth of the rows of the one below, and proofs are handed down the
same tables: the rows of a level are joined with their parents' proofs and spread again, so a proof never
travels with the rows of its own level.

Leaves get their places without a window over a tree: they are dealt into ranges of (tree, order), sorted
inside, and only the counts per range meet.  A tree that holds most rows is spread over many ranges.

Digests are lowercase hex SHA-256 of concatenated texts.  Everything is Spark expressions.

Defined cases: null fields count as `-`; null is a tree value of its own, before all others; rows of equal order
key are placed by their leaves, equal rows are leaves each; a tree of one leaf is that leaf, and a
manifest of one tree has its root; without siblings a proof is the digest of the empty text; an empty table gives
no row; other columns are ignored.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closepass.llm.store import stored

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SLOTS = [f"c{s}" for s in range(FANOUT)]


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def field(value: Column) -> Column:
    """A field as the leaf hashes it: its length in bytes, a colon and the value, or `-`."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """The leaf of a row of documents, with some fields changed."""
    return digest(*(field(changed.get(name, F.col(name))) for name in FIELDS))


def placed(leaves: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """`leaves` with `tree` as a number (from 0, in its order), `place` in it (from 0) and its size `n`."""
    keys = [tree, *order, "_copy"]
    ranges = (
        leaves.withColumn("_copy", F.spark_partition_id())  # so that copies of one row can be dealt too
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_copy")
    )
    # the number of the range in the upper bits, the place in it in the lower 33
    rows = stored(ranges.withColumns({"_range": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)}))
    counts = rows.groupBy("_range", F.col(tree).alias("_tree")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("_tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        "*",
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("_tree")).alias("n"),
        F.min("_range").over(Window.partitionBy("_tree")).alias("_opens"),
    )
    own = counts.where("_range = _opens")  # one row a tree
    opened = own.groupBy("_opens").agg(F.count("*").alias("_trees"))  # at most one row a range
    earlier = F.sum("_trees").over(Window.orderBy("_opens").rowsBetween(Window.unboundedPreceding, -1))
    opened = opened.select(F.col("_opens").alias("_o"), F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    inside = F.row_number().over(Window.partitionBy("_opens").orderBy("_tree")) - 1
    numbers = own.select("_opens", F.col("_tree").alias("_t"), inside.alias("_inside")).join(opened, F.col("_opens") == F.col("_o"))
    numbers = numbers.select("_t", (F.col("_inside") + F.col("_earlier")).alias("_number"))
    counts = counts.join(numbers, F.col("_tree").eqNullSafe(F.col("_t"))).withColumnRenamed("_range", "_r")
    counts = stored(counts.drop("_t", "_opens"))  # as many rows as ranges and trees
    joined = rows.join(counts, (F.col("_range") == F.col("_r")) & F.col(tree).eqNullSafe(F.col("_tree")))
    kept = [c for c in leaves.columns if c != tree]
    return joined.select(*kept, F.col("_number").alias("tree"), (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), "n")


def spread(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """The parents of `nodes` (tree, place, n, hash): their children's hashes, and payloads, in slot columns."""
    slot = F.pmod("place", F.lit(FANOUT))
    own = [F.max(F.when(slot == s, F.col("hash"))).alias(c) for s, c in enumerate(SLOTS)]
    if payload:
        carried = F.struct(*payload)
        own += [F.first(F.when(slot == s, carried), ignorenulls=True).alias(f"p{s}") for s in range(FANOUT)]
    parents = nodes.groupBy("tree", F.expr(f"place DIV {FANOUT}").alias("place"), "n").agg(*own)
    return parents.withColumn("hash", F.sha2(F.concat_ws("", *SLOTS), 256))


def _up(level: DataFrame) -> DataFrame:
    """The parents as nodes of the next level."""
    return level.select("tree", "place", F.expr(f"(n + {FANOUT - 1}) DIV {FANOUT}").alias("n"), "hash")


class Trees(NamedTuple):
    leaves: DataFrame  # tree, place, n, hash and payload
    levels: list[DataFrame]  # of parents, from the lowest
    tops: DataFrame  # tree, height, hash: the last node of each tree


def grown(leaves: DataFrame, payload: Sequence[str] = ()) -> Trees:
    """All levels above `leaves` (tree, place, n, hash).  Only the size of the largest tree reaches the driver."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, levels = leaves, []
    tops = leaves.where("n = 1").select("tree", F.lit(0).alias("height"), "hash")
    while most > 1:
        level = stored(spread(nodes.where("n > 1"), () if levels else payload))
        levels.append(level)
        nodes, most = _up(level), -(-most // FANOUT)
        tops = tops.unionByName(nodes.where("n = 1").select("tree", F.lit(len(levels)).alias("height"), "hash"))
    return Trees(leaves, levels, tops)


STEPS = "array<struct<left:string,right:string>>"


def paths(trees: Trees, tops: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Per leaf: tree, place, hash, payload, the columns of `tops` and `path`, its siblings from the lowest level up.

    `tops`: tree, height, `path` above the tree's root, and columns that all of its leaves get.
    """
    more = [c for c in tops.columns if c not in ("tree", "height", "path")]
    slot = F.col("_slot")
    left = F.concat_ws("", *(F.when(slot > s, F.col(c)) for s, c in enumerate(SLOTS)))
    right = F.concat_ws("", *(F.when(slot < s, F.col(c)) for s, c in enumerate(SLOTS)))
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    known = None
    for height in range(len(trees.levels), 0, -1):
        own = tops.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("place"), *more, "path")
        known = own if known is None else known.unionByName(own)
        level = trees.levels[height - 1].drop("hash", "n")
        carried = payload if height == 1 else ()
        slots = F.array(
            *(
                F.struct(F.lit(s).alias("_slot"), F.col(c).alias("hash"), *([F.col(f"p{s}").alias("_p")] if carried else []))
                for s, c in enumerate(SLOTS)
            )
        )
        children = level.join(known, ["tree", "place"]).select(
            "tree", "place", *SLOTS, *more, "path", F.explode(F.filter(slots, lambda x: x["hash"].isNotNull())).alias("_s")
        )
        known = children.select("*", "_s.*").select(
            "tree",
            (F.col("place") * FANOUT + slot).alias("place"),
            *(["hash", *(F.col(f"_p.{c}").alias(c) for c in carried)] if height == 1 else []),
            *more,
            F.concat(step, "path").alias("path"),
        )
    lone = trees.leaves.where("n = 1").drop("n").join(tops.where("height = 0").drop("height"), "tree")
    lone = lone.select("tree", "place", "hash", *payload, *more, "path")
    return lone if known is None else known.unionByName(lone)


def proof_hash(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(leaves: DataFrame, tree: str, order: str) -> DataFrame:
    """`leaves` (with their digests as `leaf`) and the subroot, root and path of each; `tree` is left out."""
    payload = [c for c in leaves.columns if c not in (tree, "leaf")]
    rows = placed(stored(leaves), tree, [order, "leaf"]).withColumnRenamed("leaf", "hash")  # hashed once, sampled and dealt
    lower = grown(rows, payload)
    tops = stored(lower.tops)  # one row a tree
    n = tops.count()
    if not n:
        empty = leaves.drop(tree).withColumns({"subroot": F.lit(""), "root": F.lit("")})
        return empty.withColumn("path", F.array().cast(STEPS)).where("false")
    upper = grown(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(n).cast("long").alias("n"), "hash"))
    top = upper.tops.select("tree", "height", F.col("hash").alias("root"), F.array().cast(STEPS).alias("path"))
    above = paths(upper, top).select(F.col("place").alias("tree"), F.col("hash").alias("subroot"), "root", "path")
    tops = stored(above.join(tops.select("tree", "height"), "tree"))
    return paths(lower, tops, payload).withColumnRenamed("hash", "leaf").select(*payload, "leaf", "subroot", "root", "path")


def op12_slot_pivot_merkle(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    letters = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    changed = leaf_hash(text=F.translate("text", letters, letters.lower()))
    leaves = documents.select("doc_id", "lang", leaf_hash().alias("leaf"), F.when(tampered, changed).alias("changed"))
    rows = manifest(leaves, "lang", "doc_id")
    root = folded(F.coalesce("changed", "leaf"), F.col("path"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), root.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


#: CRC-32 of the decimal doc_id, bit by bit: a byte comes in at the first of its eight steps.
CRC32 = """xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT],
  flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda b: [ord(b)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))))"""


def oracle(levels: int = 10) -> str:
    """The same as SQL for trees of up to FANOUT**levels leaves, which the levels written out here reach."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def fields(text: str) -> str:
        given = [*(f"{c}::VARCHAR" for c in FIELDS[:-1]), text]
        return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in given) + ")"

    def tree(name: str, first: str) -> list[str]:
        parts = [f"{name}0 AS ({first})"]
        for k in range(levels):
            parts.append(
                f"""{name}{k + 1} AS (SELECT g, i // {FANOUT} AS i, (n + {FANOUT - 1}) // {FANOUT} AS n,
  CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY g, i // {FANOUT}, n)"""
            )
        return parts

    def steps(name: str, rows: str) -> list[str]:
        """Siblings of each of `rows` (id, g, i) to the left and right, level by level."""
        parts = []
        for k in range(levels):
            at = FANOUT**k
            parts.append(
                f"""SELECT r.id, {k} AS k, coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i < r.i // {at}), '') AS l,
  coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i > r.i // {at}), '') AS r
  FROM {rows} r JOIN {name}{k} t ON t.g = r.g AND t.i // {FANOUT} = r.i // {at * FANOUT} WHERE t.n > 1 GROUP BY r.id"""
            )
        return parts

    def fold(name: str, source: str, start: str) -> list[str]:
        parts = [f"{name}0 AS (SELECT id, {start} AS h FROM {source})"]
        for k in range(2 * levels):
            parts.append(
                f"""{name}{k + 1} AS (SELECT f.id, CASE WHEN p.id IS NULL THEN f.h ELSE sha256(p.l || f.h || p.r) END AS h
  FROM {name}{k} f LEFT JOIN steps p ON p.id = f.id AND p.k = {k})"""
            )
        return parts

    lower_steps = " UNION ALL ".join(steps("a", "leaves"))
    upper_steps = " UNION ALL ".join(steps("b", "b0_rows"))
    parts = [
        f"""docs AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, lang, {fields("text")} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN {fields(lower)} END AS changed
  FROM (SELECT *, {CRC32} AS crc FROM documents))""",
        """leaves AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
  count(*) OVER (PARTITION BY lang) AS n FROM docs)""",
        *tree("a", "SELECT g, i, n, leaf AS h FROM leaves"),
        *tree("b", f"SELECT 0 AS g, g AS i, count(*) OVER () AS n, h FROM a{levels}"),
        "b0_rows AS (SELECT i AS id, g, i FROM b0)",
        f"upper AS ({upper_steps})",
        f"""steps AS MATERIALIZED (SELECT * FROM ({lower_steps}) UNION ALL
  SELECT r.id, u.k + {levels}, u.l, u.r FROM leaves r JOIN upper u ON u.id = r.g)""",
        "proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY k)) AS proof FROM steps GROUP BY id)",
        *fold("f", "docs", "coalesce(changed, leaf)"),
    ]
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT d.doc_id, d.leaf, a{levels}.h AS subroot, b{levels}.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
  f{2 * levels}.h AS folded_root, f{2 * levels}.h = b{levels}.h AS verified
FROM leaves d JOIN a{levels} ON a{levels}.g = d.g CROSS JOIN b{levels} LEFT JOIN proofs p ON p.id = d.id
JOIN f{2 * levels} ON f{2 * levels}.id = d.id"""
    )
