"""A Merkle manifest of a dataset: leaf, proof and folded root of every row.

A leaf is the SHA-256 of a row's values. The leaves of a source, in the order of their
ids, are the lowest level of its tree; every ``arity`` consecutive nodes of a level
become one node above, the last run of a level however short, until one is left. The
sources' roots, in the order of the sources, are the leaves of one more tree of the
same kind, whose root names the whole dataset.

Cogrouped subtree exchange. ``arity ** levels`` consecutive nodes make a superblock.

* Up: the nodes of a superblock are brought together and reduced to one; these are the
  nodes of the next tier, ``arity ** levels`` times fewer, until each tree has one.
* Down: a superblock's *outer* nodes are the siblings on the way from its top node to
  the root. A tier's superblocks are cogrouped with their outer nodes, and one function
  reduces the superblock again, joins its inner siblings to the outer ones and hands
  every node its way to the root: to the tier below as the outer nodes of that node's
  own superblock, at the lowest tier as the digest of the proof and the folded root.

A group holds a few superblocks' nodes, whatever a source's size: superblocks are dealt by
hash to groups whose number grows with the nodes, so neither one large source nor many
small ones make uneven groups.
Ranks inside a source come from sorted ranges of (source, id) and a table of a row for
each range and source.

Defined results: a null is written as ``-``, so it differs from an empty text; a null
source is a source of its own and comes first; a null id comes first in its source and
is never tampered with; rows that share an id are ordered by their leaf, equal rows are
leaves each; a lone leaf is its source's root and its part of the proof is empty; a lone
source's root is the root; an empty table gives no rows; further columns of the input
are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelstride.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(hexes: list[str]) -> str:
    """The node above: SHA-256 of its members' hexadecimal digests, one after the other."""
    return sha256("".join(hexes).encode()).hexdigest()


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 of the values, each as ``bytes:value`` or ``-`` if null."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (c.cast("string") for c in values)]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def leaves(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", source_col: str = "source",
           text_col: str = "text", every: int = 5) -> DataFrame:
    """``doc_id``, ``source``, ``node`` (the leaf) and, for rows whose id's CRC-32 ``every`` divides,
    ``other``: the leaf after the text was lower-cased."""
    text = lower_ascii(F.col(text_col).cast("string"))
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0
    changed = [text if f == text_col else F.col(f) for f in fields]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       leaf_hash([F.col(f) for f in fields]).alias("node"),
                       F.when(hit, leaf_hash(changed)).alias("other"))


def ranked(rows: DataFrame) -> DataFrame:
    """Add ``pos`` (0-based, gapless inside a source, by id and node) and ``width``, the
    source's number of rows. ``rows`` should be a written table."""
    order = ["source", "doc_id", "node"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # a range's number and the row's place in it, both in one id
    dealt = written(sorted_rows.withColumn("_id", F.monotonically_increasing_id()), "ranges").withColumns(
        {"_range": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")
    ranges = dealt.groupBy("source", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole, before = Window.partitionBy("source"), Window.partitionBy("source").orderBy("_range")
    offsets = ranges.select(F.col("source").alias("_source"), F.col("_range").alias("_of"),
                            (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"),
                            F.sum("_n").over(whole).alias("width"))
    same = (F.col("_range") == F.col("_of")) & F.col("source").eqNullSafe(F.col("_source"))
    return (dealt.join(offsets, same).withColumn("pos", F.col("_at") + F.col("_shift"))
            .drop("_range", "_at", "_of", "_shift", "_source"))


class Tree:
    """The nodes of one superblock and of the levels above them, up to its top."""

    def __init__(self, nodes: list[str], width: int, arity: int, levels: int):
        self.arity, self.rows = arity, [nodes]
        while levels and width > 1:
            below = self.rows[-1]
            self.rows.append([digest(below[a:a + arity]) for a in range(0, len(below), arity)])
            width = -(-width // arity)
            levels -= 1

    @property
    def top(self) -> str:
        return self.rows[-1][0]

    def way(self, k: int) -> list[tuple[str, str]]:
        """Node ``k``'s siblings to the left and to the right, level by level to the top."""
        out = []
        for row in self.rows[:-1]:
            first = k - k % self.arity
            out.append(("".join(row[first:k]), "".join(row[k + 1:first + self.arity])))
            k //= self.arity
        return out


def folded(node: str, way: list[tuple[str, str]]) -> str:
    for left, right in way:
        node = sha256((left + node + right).encode()).hexdigest()
    return node


def _superblocks(rows: pa.Table, size: int):
    """(source, superblock) -> places of its rows in ``rows``, in order."""
    out: dict[tuple, list[tuple[int, int]]] = {}
    for k, (source, pos) in enumerate(zip(rows["source"].to_pylist(), rows["pos"].to_pylist(), strict=True)):
        out.setdefault((source, pos // size), []).append((pos, k))
    return {key: [k for _, k in sorted(at)] for key, at in out.items()}


WAY = "lefts array<string>, rights array<string>, subroot string"


class Manifest:
    """Trees over tiers of nodes: ``source``, ``pos``, ``width`` (nodes of the source at
    this tier), ``node`` (32 bytes) and what else the rows carry."""

    def __init__(self, arity: int = 16, levels: int = 2):
        self.arity, self.levels, self.size = arity, levels, arity ** levels

    def _group(self, source: str, block: Column, groups: int) -> Column:
        return F.pmod(F.xxhash64(F.col(source), block.cast("long")), F.lit(groups))

    def _groups(self, nodes: int) -> int:
        return max(1, -(-4 * nodes // self.size))

    def up(self, tier: DataFrame, nodes: int) -> DataFrame:
        """The next tier: one node for each superblock."""
        size, arity, levels = self.size, self.arity, self.levels

        def reduce(rows: pa.Table) -> pa.Table:
            node, width = rows["node"].to_pylist(), rows["width"].to_pylist()
            out = []
            for (source, block), at in _superblocks(rows, size).items():
                n = width[at[0]]
                tree = Tree([node[k].hex() for k in at], n, arity, levels)
                out.append((source, block, -(-n // size), bytes.fromhex(tree.top)))
            cols = zip(*out, strict=True)
            types = (pa.string(), pa.int64(), pa.int64(), pa.binary())
            return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                            names=["source", "pos", "width", "node"])

        group = self._group("source", F.floor(F.col("pos") / size), self._groups(nodes))
        return (tier.select("source", "pos", "width", "node", group.alias("_group")).groupBy("_group")
                .applyInArrow(lambda rows: reduce(rows), "source string, pos long, width long, node binary"))

    def tiers(self, nodes: DataFrame) -> list[tuple[DataFrame, int]]:
        """``nodes`` and all tiers above, each with its number of nodes; the last has one
        node for each source."""
        out, tier = [], nodes
        while True:
            count, widest = tier.agg(F.count(F.lit(1)), F.max("width")).first()
            out.append((tier, count))
            if (widest or 0) <= 1:
                return out
            tier = written(self.up(tier, count), f"tier{len(out)}")

    def exchange(self, tier: DataFrame, nodes: int, outer: DataFrame, finish, schema: str) -> DataFrame:
        """Cogroup a tier's superblocks with their outer nodes (``source``, ``pos`` of the
        superblock, siblings level by level). ``finish`` makes a row of each node from the
        rows, the node's place, its superblock's tree and place there, the outer way and
        the source's root."""
        size, arity, levels = self.size, self.arity, self.levels
        names = [c.split()[0] for c in schema.split(", ")]
        types = [c.split()[1] for c in schema.split(", ")]
        arrow = {"string": pa.string(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}

        def join(rows: pa.Table, ways: pa.Table) -> pa.Table:
            known = {(w["source"], w["pos"]): w for w in ways.to_pylist()}
            columns, node, width = rows.to_pydict(), rows["node"].to_pylist(), rows["width"].to_pylist()
            out = []
            for key, at in _superblocks(rows, size).items():
                tree = Tree([node[k].hex() for k in at], width[at[0]], arity, levels)
                outside = known[key]
                way = list(zip(outside["lefts"], outside["rights"], strict=True))
                out += [finish(columns, k, tree, place, way, outside["subroot"]) for place, k in enumerate(at)]
            cols = zip(*out, strict=True) if out else [[] for _ in names]
            return pa.table([pa.array(c, arrow[t]) for c, t in zip(cols, types, strict=True)], names=names)

        groups = self._groups(nodes)
        left = tier.withColumn("_group", self._group("source", F.floor(F.col("pos") / size), groups))
        right = outer.withColumn("_group", self._group("source", F.col("pos"), groups))
        return (left.groupBy("_group").cogroup(right.groupBy("_group"))
                .applyInArrow(lambda rows, ways: join(rows, ways), schema))

    def hand_down(self, tiers: list[tuple[DataFrame, int]], outer: DataFrame) -> DataFrame:
        """The ways to the root of the lowest tier's superblocks, from those of the last
        tier's nodes."""
        def finish(rows, k, tree, place, way, subroot):
            lefts, rights = zip(*(tree.way(place) + way), strict=True)
            return rows["source"][k], rows["pos"][k], lefts, rights, subroot

        for tier, nodes in tiers[-2:0:-1]:
            outer = written(self.exchange(tier, nodes, outer, finish, f"source string, pos long, {WAY}"), "outer")
        return outer


def manifest(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text", arity: int = 16, levels: int = 2, every: int = 5) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256``, ``folded_root`` (of the tampered leaf where there is one),
    ``verified``."""
    forest = Manifest(arity, levels)
    rows = written(leaves(docs, fields, id_col, source_col, text_col, every), "leaves")
    tiers = forest.tiers(written(ranked(rows), "nodes"))

    # the sources' roots are the leaves of one tree, as if of one source
    roots = tiers[-1][0].select(F.lit("").alias("source"), F.col("source").alias("doc_id"), "node")
    above = forest.tiers(written(ranked(roots), "sources"))
    found = above[-1][0].select(F.lower(F.hex("node"))).first()
    root = found[0] if found else None

    def to_source(rows, k, tree, place, way, subroot):
        lefts, rights = zip(*(tree.way(place) + way), strict=True) if tree.rows[1:] or way else ((), ())
        return rows["doc_id"][k], 0, lefts, rights, tree.rows[0][place]

    none = F.array().cast("array<string>")
    start = above[-1][0].select("source", "pos", none.alias("lefts"), none.alias("rights"), F.lit("").alias("subroot"))
    outer = written(forest.exchange(*above[0], forest.hand_down(above, start), to_source,
                                    f"source string, pos long, {WAY}"), "outer")

    def finish(rows, k, tree, place, way, subroot):
        whole = tree.way(place) + way
        other = rows["other"][k]
        return (rows["doc_id"][k], rows["source"][k], tree.rows[0][place], subroot,
                sha256("".join([a + b for a, b in whole]).encode()).hexdigest(),
                folded(other.hex() if other is not None else tree.rows[0][place], whole))

    proven = forest.exchange(*tiers[0], forest.hand_down(tiers, outer), finish,
                             "doc_id long, source string, leaf string, subroot string, proof_sha256 string, folded_root string")
    return proven.select("doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256",
                         "folded_root", F.col("folded_root").eqNullSafe(F.lit(root)).alias("verified"), "source")
