"""Merkle manifest of a table: a tree for each value of a column, and one over their roots.

``H`` is the lowercase hex SHA-256 of its inputs' concatenation (digests as hex
text). A leaf is ``H`` of the row's fields, each ``-`` if null, else its UTF-8
byte count, ``:`` and the value. In each tree the leaves ascend by the order
column; every two neighbours become their ``H``, a last one without a neighbour
its own ``H``, until one node is left. The trees' roots, ordered by their
value (null first, UTF-8 bytewise), make the top tree in the same way.

Checkpoint and recompute: of a tree's levels only every ``HEIGHT``-th is stored
(the leaves, then one node for each aligned subtree of ``2**HEIGHT`` nodes below),
so a manifest holds about a thousandth more than its leaves. Proofs go top down:
each aligned subtree gets the path above its top node, makes its missing inner nodes
again from the stored ones, hands out the siblings and forgets the inner nodes. A task
holds one subtree at a time, so a tree with a third of all rows is spread over
all tasks; nothing but row counts and the one root goes to the driver.

Defined results: a null order value sorts first; equal order values are ordered
by leaf, so that repeated rows are neighbours with the same digest; a tree of one
leaf has that leaf as its root; an empty table has no trees, no root and no rows;
texts are hashed whole. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, written
from tidemark.plans.positions import global_positions
from tidemark.session import partitions_for

HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Trees whose table (some 50 bytes each) is sent to all executors; more of them are joined by a shuffle.
FEW_TREES = 1 << 16


def h(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """Leaf of a row with these fields."""
    parts = []
    for f in fields:
        value = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def depth_of(n: str = "n") -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.when(F.col(n) <= 1, F.lit(0)).otherwise(F.length(F.bin(F.col(n) - 1))).cast("int")


def inner_levels(nodes: list[str], height: int) -> list[list[str]]:
    """``nodes`` and the ``height`` levels above them."""
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def sibling_path(levels: list[list[str]], i: int) -> str:
    """The siblings on the way up from node ``i``: ``L`` or ``R`` (the sibling's side) and its digest, ``-`` where there is none."""
    out = []
    for level in levels[:-1]:
        other = i ^ 1
        out.append("-" if other >= len(level) else ("L" if i & 1 else "R") + level[other])
        i >>= 1
    return "".join(out)


def siblings(path: str) -> list[str]:
    """Entries of a path."""
    out, at = [], 0
    while at < len(path):
        step = 1 if path[at] == "-" else 65
        out.append(path[at : at + step])
        at += step
    return out


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and its path lead to."""
    node = leaf
    for s in siblings(path):
        node = h(node) if s == "-" else h(s[1:], node) if s[0] == "L" else h(node, s[1:])
    return node


def proof_digest(path: str) -> str:
    return h(*(s[1:] for s in siblings(path)))


# ------------------------------------------------------------------ stored levels


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], dict | None]]:
    """Rows of one subtree after the other (sorted stream), with its row of index -1, if any."""
    key, rows, above = None, [], None
    for batch in batches:
        for row in batch.to_pylist():
            now = (row["tree"], row["block"])
            if now != key:
                if rows:
                    yield rows, above
                key, rows, above = now, [], None
            if row["idx"] < 0:
                above = row
            else:
                rows.append(row)
    if rows:
        yield rows, above


def _by_subtree(nodes: DataFrame) -> DataFrame:
    """The nodes of a subtree together in one task, in order (at most ``2**height`` rows and one)."""
    return nodes.repartition(partitions_for(nodes), "tree", "block").sortWithinPartitions("tree", "block", "idx")


def _block(height: int) -> Column:
    return F.shiftright(F.col("idx"), height)


def stored_levels(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """``nodes(tree, depth, idx, digest)`` and every ``height``-th level above it, each written."""
    levels = [nodes]
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for level in range(0, deepest, height):

        def top(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            out: dict[str, list] = {"tree": [], "depth": [], "idx": [], "digest": []}
            for rows, _ in _subtrees(batches):
                first = rows[0]
                up = inner_levels([r["digest"] for r in rows], min(height, first["depth"] - level))
                for name, v in zip(out, (first["tree"], first["depth"], first["block"], up[-1][0]), strict=True):
                    out[name].append(v)
                if len(out["tree"]) >= 4096:
                    yield arrow("tree long, depth int, idx long, digest string", out)
                    out = {k: [] for k in out}
            yield arrow("tree long, depth int, idx long, digest string", out)

        below = levels[-1].filter(F.col("depth") > level).select("tree", "depth", "idx", "digest", _block(height).alias("block"))
        levels.append(written(_by_subtree(below).mapInArrow(top, "tree long, depth int, idx long, digest string"), "merkle-level"))
    return levels


def tops(levels: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """``(tree, depth, digest)`` of every tree's root."""
    out = levels[0].filter("depth = 0").select("tree", "depth", "digest")
    for j, level in enumerate(levels[1:], 1):
        out = out.unionByName(level.filter(F.col("depth") <= j * height).select("tree", "depth", "digest"))
    return out


# ------------------------------------------------------------------ paths


def _descend(level: DataFrame, above: DataFrame, j: int, height: int, emit: Callable, schema: str, extra: list[str]) -> DataFrame:
    """Paths of the nodes of stored level ``j`` from those of the nodes above their subtrees (``above(tree, block, path, top)``)."""
    none = [F.lit(None).cast(level.schema[c].dataType).alias(c) for c in ["depth", "digest", *extra]]
    heads = above.select("tree", "block", F.lit(-1).cast("long").alias("idx"), *none, "path", "top")
    rows = level.select("tree", _block(height).alias("block"), "idx", "depth", "digest", *extra, F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("top"))

    def hand_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in schema.split(", ")]
        out: list[tuple] = []
        for nodes, head in _subtrees(batches):
            if head is None:  # a subtree without a wanted leaf
                continue
            inner = inner_levels([r["digest"] for r in nodes], max(0, min(height, nodes[0]["depth"] - j * height)))
            out += [emit(r, sibling_path(inner, i) + head["path"], head["top"]) for i, r in enumerate(nodes)]
            if len(out) >= 2048:
                yield arrow(schema, dict(zip(names, map(list, zip(*out, strict=True)), strict=True)))
                out = []
        if out:
            yield arrow(schema, dict(zip(names, map(list, zip(*out, strict=True)), strict=True)))

    return _by_subtree(rows.unionByName(heads)).mapInArrow(hand_out, schema)


def _node_path(row: dict, path: str, top: str) -> tuple:
    return row["tree"], row["idx"], path, top


def paths(levels: list[DataFrame], ends: DataFrame, emit: Callable = _node_path, schema: str = "tree long, idx long, path string, top string",
          extra: tuple[str, ...] = (), height: int = HEIGHT, wanted: DataFrame | None = None) -> DataFrame:
    """A row for each leaf, made by ``emit(leaf row, path, root of its tree)``.

    ``ends(tree, depth, path, top)``: the path beyond each tree's root (empty if it ends there) and the root.
    ``wanted(tree, idx)``: only subtrees that hold one of these leaves are gone through."""
    found = None
    for j in reversed(range(len(levels))):
        ending = ends.filter((F.col("depth") > j * height) | (F.lit(j) == 0)).filter(F.col("depth") <= (j + 1) * height)
        above = ending.select("tree", F.lit(0).cast("long").alias("block"), "path", "top")
        if found is not None:
            above = above.unionByName(found.select("tree", F.col("idx").alias("block"), "path", "top"))
        if wanted is not None:
            above = above.join(wanted.select("tree", F.shiftright("idx", (j + 1) * height).alias("block")).distinct(), ["tree", "block"], "left_semi")
        level = levels[j] if j == 0 else levels[j].filter(F.col("depth") > j * height)
        if j:
            found = written(_descend(level, above, j, height, _node_path, "tree long, idx long, path string, top string", []), "merkle-paths")
        else:
            return _descend(level, above, j, height, emit, schema, list(extra))


# ------------------------------------------------------------------ manifests


@dataclass
class Manifest:
    """Stored levels of the trees (level 0: the leaves and their rows' columns) and of the top tree, and the root."""

    trees: DataFrame  # key, tree, n, depth
    levels: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    height: int = HEIGHT

    def ends(self) -> DataFrame:
        """The path from each tree's root to the root of all."""
        at_top = tops(self.top, self.height).select("tree", "depth", F.lit("").alias("path"), F.col("digest").alias("top"))
        up = paths(self.top, at_top, height=self.height).select(F.col("idx").alias("tree"), "path")
        roots = tops(self.levels, self.height).select("tree", "depth", F.col("digest").alias("top"))
        return written(roots.join(up, "tree"), "merkle-ends")

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """``(tree, idx, digest, path, top)`` of every leaf, or of those in ``wanted(tree, idx)``."""
        emit = lambda row, path, top: (row["tree"], row["idx"], row["digest"], path, top)
        out = paths(self.levels, self.ends(), emit, "tree long, idx long, digest string, path string, top string", height=self.height, wanted=wanted)
        return out if wanted is None else out.join(wanted.select("tree", "idx").distinct(), ["tree", "idx"], "left_semi")

    def save(self, path: str) -> None:
        """Store the manifest; what is stored is what proofs need."""
        base = path.rstrip("/")
        self.trees.write.mode("overwrite").parquet(f"{base}/trees")
        for kind, levels in (("levels", self.levels), ("top", self.top)):
            for j, level in enumerate(levels):
                level.write.mode("overwrite").parquet(f"{base}/{kind}/{j}")
        spark = self.trees.sparkSession
        head = [(self.root, self.height, len(self.levels), len(self.top))]
        spark.createDataFrame(head, "root string, height int, levels int, top int").coalesce(1).write.mode("overwrite").json(f"{base}/manifest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Manifest":
        base = path.rstrip("/")
        m = spark.read.schema("root string, height int, levels int, top int").json(f"{base}/manifest").first()
        read = lambda kind, k: [spark.read.parquet(f"{base}/{kind}/{j}") for j in range(k)]
        return Manifest(spark.read.parquet(f"{base}/trees"), read("levels", m.levels), read("top", m.top), m.root, m.height)


def build(leaves: DataFrame, key: str = "lang", order: str = "doc_id", height: int = HEIGHT) -> Manifest:
    """Manifest over ``leaves`` (``key``, ``order``, ``digest`` and any further columns, which the leaves keep)."""
    named = leaves.withColumnRenamed(key, "__key").withColumnRenamed(order, "__order")
    placed = global_positions(named, [F.col("__key").asc_nulls_first(), F.col("__order").asc_nulls_first(), F.col("digest")], "__at")
    trees = placed.groupBy("__key").agg(F.count("*").alias("n"), F.min("__at").alias("__start"))
    trees = written(global_positions(trees, [F.col("__start")], "tree").withColumn("depth", depth_of()), "merkle-trees")
    count = trees.count()
    small = trees.select(F.col("__key").alias("__same"), "tree", "depth", "__start")
    small = F.broadcast(small) if count <= FEW_TREES else small
    own = placed.join(small, F.col("__key").eqNullSafe(F.col("__same"))).withColumn("idx", F.col("__at") - F.col("__start"))
    kept = [c for c in named.columns if c not in ("__key", "__order", "digest")]
    level0 = written(own.select("tree", "depth", "idx", "digest", F.col("__key").alias(key), F.col("__order").alias(order), *kept), "merkle-leaves")
    levels = stored_levels(level0, height)
    roots = tops(levels, height)
    top0 = roots.select(F.lit(0).cast("long").alias("tree"), F.lit(max(count - 1, 0).bit_length()).alias("depth"), F.col("tree").alias("idx"), "digest")
    top = stored_levels(written(top0, "merkle-roots"), height)
    root = tops(top, height).first()
    return Manifest(trees.select(F.col("__key").alias(key), "tree", "n", "depth"), levels, top, root["digest"] if root else None, height)


def document_leaves(df: DataFrame) -> DataFrame:
    """Leaves of documents, and ``changed``: the leaf after tampering (1 added to ``n_chars`` where 7 divides the id's CRC)."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    field = {c: F.col(c) for c in FIELDS}
    more = field | {"n_chars": field["n_chars"] + 1}
    return df.select(
        "doc_id", "lang", leaf_digest(*field.values()).alias("digest"),
        F.when(hit & F.col("n_chars").isNotNull(), leaf_digest(*more.values())).alias("changed"),
    )


def verified_documents(df: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Every document with its leaf, its tree's root, its proof, and whether its tampered form still leads to the root."""
    m = build(written(document_leaves(df), "merkle-digests"), height=height)

    def emit(row: dict, path: str, top: str) -> tuple:
        folded = fold(row["changed"] or row["digest"], path)
        return row["doc_id"], row["digest"], top, m_root, proof_digest(path), folded, folded == m_root

    m_root = m.root
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return paths(m.levels, m.ends(), emit, schema, ("doc_id", "changed"), height)


#: The same rows in SQL: levels and folds by recursion, CRC-32 bit by bit.
MANIFEST_SQL = """
WITH RECURSIVE raw AS (SELECT *, row_number() OVER () AS r FROM documents),
crc AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(4294967295, list_reduce(
      list_prepend(4294967295, [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))) % 7 END AS rest
  FROM raw),
fields AS (
  SELECT r, doc_id, lang, n_chars, rest,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM crc),
leaves AS (
  SELECT r, doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN rest = 0 THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS changed
  FROM fields),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM leaves),
low AS (
  SELECT tree, 0 AS lvl, idx, leaf AS d, n FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, sha256(string_agg(d, '' ORDER BY idx)), (n + 1) // 2 FROM low WHERE n > 1 GROUP BY tree, lvl, idx // 2, n),
top AS (
  SELECT 0 AS lvl, tree AS idx, d, count(*) OVER () AS n FROM low WHERE n = 1
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(string_agg(d, '' ORDER BY idx)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, idx // 2, n),
up AS (
  SELECT r, tree, 0 AS lvl, idx, n, coalesce(changed, leaf) AS d, '' AS proof FROM placed
  UNION ALL
  SELECT u.r, u.tree, u.lvl + 1, u.idx // 2, (u.n + 1) // 2,
    sha256(CASE WHEN u.idx % 2 = 1 THEN coalesce(s.d, '') || u.d ELSE u.d || coalesce(s.d, '') END), u.proof || coalesce(s.d, '')
  FROM up u LEFT JOIN low s ON s.tree = u.tree AND s.lvl = u.lvl AND s.idx = xor(u.idx, 1) WHERE u.n > 1),
over AS (
  SELECT r, 0 AS lvl, tree AS idx, (SELECT max(n) FROM top WHERE lvl = 0) AS n, d, proof FROM up WHERE n = 1
  UNION ALL
  SELECT o.r, o.lvl + 1, o.idx // 2, (o.n + 1) // 2,
    sha256(CASE WHEN o.idx % 2 = 1 THEN coalesce(s.d, '') || o.d ELSE o.d || coalesce(s.d, '') END), o.proof || coalesce(s.d, '')
  FROM over o LEFT JOIN top s ON s.lvl = o.lvl AND s.idx = xor(o.idx, 1) WHERE o.n > 1)
SELECT p.doc_id, p.leaf, l.d AS subroot, t.d AS root, sha256(o.proof) AS proof_sha256, o.d AS folded_root, o.d = t.d AS verified
FROM placed p JOIN low l ON l.tree = p.tree AND l.n = 1 JOIN over o ON o.r = p.r AND o.n = 1 CROSS JOIN (SELECT d FROM top WHERE n = 1) t
"""
