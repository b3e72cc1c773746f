"""Merkle manifest of a dataset, with a version of the tree for every tampered row.

The rows of a language are the leaves of a tree of fan ``FAN``, the languages those of a tree above. Trees are cut into
aligned blocks of ``BLOCK`` nodes, ``BLOCK_LEVELS`` levels high; a task holds one block at a time. In its block, a tampered
leaf gives a new version of a persistent tree: the ancestors of the leaf are copied, all other nodes are shared. Roots of
blocks are the nodes of the next level of blocks, and so on, all as tables; a version goes on from its block's root along
the path of the block, which a small row brings to the block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.positions import with_position
from ..session import cut_lineage

FAN = 8
BLOCK_LEVELS = 4
BLOCK = FAN**BLOCK_LEVELS
# Every so many rows of a crc32 is tampered with.
TAMPERED = 3
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class VersionedTree:
    """Nodes of all versions of one block; a version is the number of its root node.

    A tree is as high as its leaves need, or ``height`` levels if that is given.
    """

    def __init__(self, leaves: Sequence[str], height: int | None = None):
        self.digests = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        nodes, self.height = list(range(len(leaves))), 0
        while len(nodes) > 1 if height is None else self.height < height:
            nodes = [self._parent(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
            self.height += 1
        self.root = nodes[0]

    def _parent(self, children: Sequence[int]) -> int:
        self.digests.append(digest("".join([self.digests[c] for c in children])))
        self.children.append(tuple(children))
        return len(self.children) - 1

    def _ancestors(self, place: int) -> list[tuple[int, int]]:
        """Ancestors of a leaf in the first version, the lowest first, each with the child that leads to the leaf."""
        node, steps = self.root, []
        for level in reversed(range(self.height)):
            child = place // FAN**level % FAN
            steps.append((node, child))
            node = self.children[node][child]
        return steps[::-1]

    def siblings(self, place: int) -> list[tuple[str, str]]:
        """Digests before and after the path of a leaf, level by level."""
        sides = []
        for node, child in self._ancestors(place):
            run = [self.digests[c] for c in self.children[node]]
            sides.append(("".join(run[:child]), "".join(run[child + 1 :])))
        return sides

    def changed(self, place: int, leaf: str) -> int:
        """Version of the first tree with another leaf: its ancestors are copied, all else is shared."""
        self.digests.append(leaf)
        self.children.append(())
        copy = len(self.children) - 1
        for node, child in self._ancestors(place):
            run = self.children[node]
            copy = self._parent((*run[:child], copy, *run[child + 1 :]))
        return copy


def folded(leaf: str, sides: Sequence[tuple[str, str]]) -> str:
    """Digest at the end of a path that starts with ``leaf``."""
    for before, after in sides:
        leaf = digest(before + leaf + after)
    return leaf


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    fields = [_field(text if name == "text" else F.col(name)) for name in FIELDS]
    return F.sha2(F.concat(*fields), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """Leaf of every row, the leaf after tampering (null if not tampered with), and its place among those of its language."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    plain = cut_lineage(
        docs.select(*FIELDS).select(
            # Null comes first, then the languages in the order of their bytes.
            F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf_digest(F.col("text")).alias("leaf"),
            F.when(chosen, leaf_digest(F.translate("text", CAPITALS, SMALL))).alias("changed"),
            # Equal rows may stand in any order; the number lets the sort spread them.
            F.monotonically_increasing_id().alias("row"),
        )
    )
    placed = with_position(plain, ["doc_id", "leaf", "row"], "place", by=["tree"])
    return placed.select("tree", (F.col("place") - 1).alias("place"), "doc_id", "leaf", "changed")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[dict]]]:
    """Rows of one block after the other, from batches in their order; a block has at most BLOCK rows and a head."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["tree"], row["block"]) != key:
                if rows:
                    yield key, rows
                key, rows = (row["tree"], row["block"]), []
            rows.append(row)
    if rows:
        yield key, rows


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


ROOTS = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("alone", pa.string()), ("among", pa.string())])


def _roots(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Root of every block, were it the only one of its tree and were it one of many."""
        for (tree, block), rows in _blocks(batches):
            nodes = [r["leaf"] for r in rows]
            alone, among = VersionedTree(nodes), VersionedTree(nodes, levels)
            root = {"tree": tree, "place": block, "alone": alone.digests[alone.root], "among": among.digests[among.root]}
            yield _batch([root], ROOTS)

    return run


SIDES = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
PATHS = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("sides", SIDES), ("top", pa.string())])
PATH = "tree string, place long, sides array<struct<before: string, after: string>>, top string"


def _opened(rows: list[dict], levels: int) -> tuple[VersionedTree, list[tuple[str, str]], dict, list[dict]]:
    """Tree of a block, path of its root, and head; the head is the first row."""
    head, nodes = rows[0], rows[1:]
    tree = VersionedTree([r["leaf"] for r in nodes], None if head["only"] else levels)
    return tree, [(s["before"], s["after"]) for s in head["sides"]], head, nodes


def _paths(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (name, _), rows in _blocks(batches):
            tree, above, head, nodes = _opened(rows, levels)
            paths = []
            for i, node in enumerate(nodes):
                sides = [{"before": b, "after": a} for b, a in tree.siblings(i) + above]
                paths.append({"tree": name, "place": node["place"], "sides": sides, "top": head["top"]})
            yield _batch(paths, PATHS)

    return run


PROOFS = pa.schema(
    [("doc_id", pa.int64())] + [(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
)
PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _proofs(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _blocks(batches):
            tree, above, head, nodes = _opened(rows, levels)
            upper = "".join([b + a for b, a in above])
            proofs = []
            for i, node in enumerate(nodes):
                root = head["root"]
                if node["changed"] not in (None, node["leaf"]):
                    root = folded(tree.digests[tree.changed(i, node["changed"])], above)
                proof = digest("".join([b + a for b, a in tree.siblings(i)]) + upper)
                values = (node["doc_id"], node["leaf"], head["top"], head["root"], proof, root)
                proofs.append(dict(zip(PROOFS.names, values, strict=True)))
            yield _batch(proofs, PROOFS)

    return run


def _by_block(nodes: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """Rows of a block next to each other, its head first and its nodes by place."""
    rows = nodes.withColumn("block", F.floor(F.col("place") / BLOCK))
    if heads is not None:
        rows = rows.unionByName(
            heads.withColumnsRenamed({"place": "block"}).withColumn("place", F.lit(-1).cast("long")), allowMissingColumns=True
        )
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "tree", "block").sortWithinPartitions("tree", "block", "place")


def _rolled(nodes: DataFrame) -> DataFrame:
    """Roots of the blocks of ``nodes``: ``tree``, ``place`` (number of the block), ``leaf``, ``only`` (block of its tree)."""
    kind = "tree string, place long, alone string, among string"
    roots = cut_lineage(_by_block(nodes.select("tree", "place", "leaf")).mapInArrow(_roots(BLOCK_LEVELS), kind))
    counts = roots.groupBy("tree").agg((F.count(F.lit(1)) == 1).alias("only"))
    return roots.join(counts, "tree").select(
        "tree", "place", F.when(F.col("only"), F.col("alone")).otherwise(F.col("among")).alias("leaf"), "only"
    )


def _upper_paths(nodes: DataFrame) -> DataFrame:
    """Path of every node to the top of its tree: ``tree``, ``place``, ``sides`` and the ``top``.

    ``nodes`` are the roots of blocks, with ``only``. They are one in BLOCK of the nodes below, so a few levels end it.
    """
    none = F.array().cast("array<struct<before: string, after: string>>")
    tops = nodes.where("only").select("tree", "place", none.alias("sides"), F.col("leaf").alias("top"))
    rest = nodes.where("NOT only")
    if rest.isEmpty():
        return tops
    rolled = cut_lineage(_rolled(rest))
    heads = _upper_paths(rolled).join(rolled.select("tree", "place", "only"), ["tree", "place"])
    paths = _by_block(rest.select("tree", "place", "leaf"), heads).mapInArrow(_paths(BLOCK_LEVELS), PATH)
    return tops.unionByName(cut_lineage(paths))


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every row of ``docs``, and the root that follows if the row alone is tampered with.

    ``doc_id``, ``leaf``, ``subroot`` (of the language), ``root``, ``proof_sha256`` (of all siblings on the path),
    ``folded_root`` (of the tampered leaf where ``TAMPERED`` divides the crc32 of the id, else of the leaf) and
    ``verified`` (both roots agree). Tampering lower-cases A to Z, so a text without capitals stays verified; null and
    empty texts stay as they are. Null fields are leaves like others; rows without ``doc_id`` come first in their language
    and are never tampered with. Rows of one ``doc_id`` stand in the order of their leaves, repeated rows have a leaf
    each. No rows give no rows. Other columns of ``docs`` are not looked at.
    """
    nodes = cut_lineage(leaves(docs))
    blocks = cut_lineage(_rolled(nodes))
    paths = _upper_paths(blocks)
    tops = paths.where("place = 0").select("tree", F.col("top").alias("subroot"))
    # The languages are the leaves of the tree above, numbered in their order.
    ranked = with_position(cut_lineage(tops), ["tree"], "place")
    languages = cut_lineage(
        ranked.select(F.lit("").alias("tree"), (F.col("place") - 1).alias("place"), F.col("subroot").alias("leaf"), F.col("tree").alias("name"))
    )
    if languages.isEmpty():
        return nodes.sparkSession.createDataFrame([], PROOF).withColumn("verified", F.lit(True))
    rolled = cut_lineage(_rolled(languages))
    heads = _upper_paths(rolled).join(rolled.select("tree", "place", "only"), ["tree", "place"])
    over = cut_lineage(_by_block(languages.select("tree", "place", "leaf"), heads).mapInArrow(_paths(BLOCK_LEVELS), PATH))
    over = over.select("place", F.col("sides").alias("over"), F.col("top").alias("root"))
    over = languages.select(F.col("name").alias("tree"), "place").join(over, "place").drop("place")
    heads = (
        paths.join(blocks.select("tree", "place", "only"), ["tree", "place"])
        .join(over, "tree")
        .select("tree", "place", F.concat("sides", "over").alias("sides"), "top", "root", "only")
    )
    proofs = _by_block(nodes, heads).mapInArrow(_proofs(BLOCK_LEVELS), PROOF)
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def _levels(name: str, count: int) -> str:
    """SQL of the levels above the nodes ``name``_0 (t, i, d): their sizes, sides and parents."""
    parts = []
    for k in range(count):
        run = f"PARTITION BY t, i // {FAN} ORDER BY i ROWS BETWEEN"
        parts.append(
            f"""{name}_s{k} AS (SELECT t, i, d, count(*) OVER (PARTITION BY t) AS n,
  coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
  coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}_{k}),
{name}_{k + 1} AS (SELECT t, i // {FAN} AS i, CASE WHEN min(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE min(d) END AS d
  FROM {name}_s{k} GROUP BY t, i // {FAN})"""
        )
    return ",\n".join(parts)


def _folds(source: str, name: str, count: int, tree: str, place: str) -> str:
    """SQL of ``source`` with its digest ``f`` and its siblings ``p`` taken through all levels."""
    parts = []
    for k in range(count):
        before = source if k == 0 else f"{name}_f{k - 1}"
        parts.append(
            f"""{name}_f{k} AS (SELECT x.* EXCLUDE (f, p), CASE WHEN s.n > 1 THEN sha256(s.b || x.f || s.a) ELSE x.f END AS f,
  CASE WHEN s.n > 1 THEN x.p || s.b || s.a ELSE x.p END AS p
  FROM {before} x JOIN {name}_s{k} s ON s.t = x.{tree} AND s.i = x.{place} // {FAN**k})"""
        )
    return ",\n".join(parts)


def manifest_sql(levels: int = 7, upper: int = 3) -> str:
    """SQL of :func:`manifest` for at most FAN ** levels rows of a language and FAN ** upper languages."""
    crc = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: CAST(ascii(c) AS BIGINT)), lambda x, y: list_reduce([xor(x, y)] || range(8),
    lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))))"""

    def leaf(text: str) -> str:
        each = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen({e}) || ':' || {e}, '-')" for e in each) + ")"

    lowered = f"translate(text, '{CAPITALS}', '{SMALL}')"
    return f"""WITH base AS (SELECT doc_id, coalesce('=' || lang, '') AS t, {leaf("text")} AS leaf,
  CASE WHEN {crc} % {TAMPERED} = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS f FROM documents),
placed AS (SELECT *, '' AS p, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM base),
l_0 AS (SELECT t, place AS i, leaf AS d FROM placed),
{_levels("l", levels)},
tops AS (SELECT t AS lang_t, row_number() OVER (ORDER BY t) - 1 AS spot, d AS subroot FROM l_{levels}),
u_0 AS (SELECT '' AS t, spot AS i, subroot AS d FROM tops),
{_levels("u", upper)},
{_folds("placed", "l", levels, "t", "place")},
joined AS (SELECT x.doc_id, x.leaf, x.f, x.p, t.subroot, t.spot, '' AS top FROM l_f{levels - 1} x JOIN tops t ON t.lang_t = x.t),
{_folds("joined", "u", upper, "top", "spot")}
SELECT doc_id, leaf, subroot, (SELECT d FROM u_{upper}) AS root, sha256(p) AS proof_sha256, f AS folded_root,
  f = (SELECT d FROM u_{upper}) AS verified FROM u_f{upper - 1}"""
