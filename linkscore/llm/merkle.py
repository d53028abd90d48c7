"""Merkle manifest of a dataset, kept as logs of nodes in the order of their completion.

Each source is a tree of ``FAN`` children a node over its documents by ``doc_id``;
the roots of the sources form one more tree. A tree is built by aligned builders:
one task hashes ``FAN ** LEVELS`` neighbouring leaves and appends every node right
after its last child (postorder). The roots of the builders are the leaves of the
next tier, until one node is left. Because builders are aligned, a builder's log is
a stretch of the tree's log, and the place of any node in it follows from subtree
sizes alone (:func:`position`); proofs read their siblings at these places, no
pointers are kept.

Leaves are numbered over ranges of the sorted rows, so a source of any size spreads
over many builders; none ever sees more than ``FAN ** LEVELS`` leaves.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.runtime import shuffle_width, stored

FAN = 16
LEVELS = 3
SPAN = FAN**LEVELS  # leaves of one builder
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 32
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEGMENT = "tree string, builder long, leaves long, log binary, total long"
PATH = "path array<binary>"  # left and right siblings by turns, from the leaf upwards


def node_hash(children: bytes) -> bytes:
    """Digest of a node, its children's digests concatenated as hex text."""
    return hashlib.sha256(children.hex().encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def position(level: int, index: int, leaves: int, levels: int) -> int:
    """Place in the log of node ``index`` of ``level`` in a tree of ``leaves`` leaves and ``levels`` levels.

    When a node is appended, ``end`` leaves have been read; up to its own level all
    nodes begun are complete, above it those that ended before leaf ``end``.
    """
    end = min((index + 1) * FAN**level, leaves)
    done = sum(-(-end // FAN**j) for j in range(level + 1))
    return done + sum((end - 1) // FAN**j for j in range(level + 1, levels + 1)) - 1


def append_nodes(leaves: list[bytes], levels: int) -> bytes:
    """The log of a subtree, each node after its last child."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(levels + 1)]
    last = len(leaves) - 1
    for i, digest in enumerate(leaves):
        log.append(digest)
        open_runs[0].append(digest)
        for level in range(levels):
            if len(open_runs[level]) < FAN and i < last:
                break
            node = node_hash(b"".join(open_runs[level]))
            open_runs[level].clear()
            log.append(node)
            open_runs[level + 1].append(node)
    return b"".join(log)


def siblings(log: bytes, leaves: int, levels: int, level: int, index: int) -> tuple[bytes, bytes]:
    """Digests before and after node ``index`` of ``level`` under the same parent."""
    first = index // FAN * FAN
    stop = min(first + FAN, -(-leaves // FAN**level))

    def read(a: int, b: int) -> bytes:
        places = (position(level, i, leaves, levels) * _DIGEST for i in range(a, b))
        return b"".join(log[p : p + _DIGEST] for p in places)

    return read(first, index), read(index + 1, stop)


def fold(digest: bytes, path: list[bytes]) -> bytes:
    """The root that a digest and its path lead to."""
    for left, right in zip(path[::2], path[1::2]):
        digest = node_hash(left + digest + right)
    return digest


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    """Digest of a row whose text is ``text``."""
    return F.unhex(F.sha2(F.concat(*[_field(text if c == "text" else F.col(c)) for c in FIELDS]), 256))


def _number(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Add ``ordinal`` (from 0) inside each ``tree`` and ``total``, its leaves."""
    ranged = leaves.repartitionByRange(shuffle_width(leaves.sparkSession), "tree", *order)
    ranged = stored(ranged.sortWithinPartitions("tree", *order).withColumn("pos", F.monotonically_increasing_id()), "leaves")
    part = F.shiftright("pos", 33)
    spans = ranged.groupBy("tree", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("begin"))
    own = Window.partitionBy("tree")  # a row per range that the tree reaches
    before = F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumns({"before": F.coalesce(before, F.lit(0)), "total": F.sum("n").over(own)})
    numbered = ranged.withColumn("part", part).join(spans.drop("n"), ["tree", "part"])
    return numbered.withColumn("ordinal", F.col("pos") - F.col("begin") + F.col("before")).drop("part", "pos", "begin", "before")


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("ordinal")
    total = rows["total"][0].as_py()
    log = append_nodes(rows["digest"].to_pylist(), min(LEVELS, height(total)))
    kinds = {"tree": pa.string(), "builder": pa.int64(), "leaves": pa.int64(), "log": pa.binary(), "total": pa.int64()}
    values = key[0].as_py(), key[1].as_py(), rows.num_rows, log, total
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, kinds.values())], names=list(kinds))


def _builder() -> Column:
    return F.floor(F.col("ordinal") / SPAN).cast("long").alias("builder")


def _tiers(leaves: DataFrame, most: int) -> list[DataFrame]:
    """Logs by tier, the leaves' first: ``tree, builder, leaves, log, total`` (``total``: leaves of the tree in the tier)."""
    tiers = []
    while True:
        rows = leaves.select("tree", _builder(), "ordinal", "total", "digest")
        tiers.append(stored(rows.groupBy("tree", "builder").applyInArrow(_build, SEGMENT), "log"))
        if most <= SPAN:
            return tiers
        most = -(-most // SPAN)
        leaves = (
            tiers[-1].where(F.col("total") > SPAN)
            .select("tree", F.col("builder").alias("ordinal"), F.ceil(F.col("total") / SPAN).cast("long").alias("total"), _root())
        )


def _root() -> Column:
    return F.expr(f"substring(log, -{_DIGEST}, {_DIGEST})").alias("digest")


def _paths(key: tuple, rows: pa.Table, logs: pa.Table) -> list[tuple[int, list[bytes]]]:
    """Row and path of each leaf of one builder."""
    log, leaves, total = (logs[c][0].as_py() for c in ("log", "leaves", "total"))
    levels, above = min(LEVELS, height(total)), logs["path"][0].as_py()
    out = []
    shared: dict[int, list[bytes]] = {}  # by run: the path from its parent on
    for i, ordinal in enumerate(rows["ordinal"].to_pylist()):
        index = ordinal % SPAN
        run = index // FAN
        if run not in shared:
            shared[run] = [x for level in range(1, levels) for x in siblings(log, leaves, levels, level, index // FAN**level)] + above
        out.append((i, [*siblings(log, leaves, levels, 0, index), *shared[run]] if levels else above))
    return out


def _extend(key: tuple, rows: pa.Table, logs: pa.Table) -> pa.Table:
    """Leaves that are builders of the tier below, with their paths."""
    found = [x for _, x in _paths(key, rows, logs)] if rows.num_rows else []
    return rows.drop_columns(["up", "above", "ordinal"]).append_column("path", pa.array(found, pa.list_(pa.binary())))


def _finish(key: tuple, rows: pa.Table, logs: pa.Table) -> pa.Table:
    """What the proofs of a builder's documents come to."""
    digests, tampered, proofs, folded = rows["digest"].to_pylist(), rows["tampered"].to_pylist(), [], []
    known: dict[tuple[int, bytes], bytes] = {}  # equal digests of a run fold alike
    ordinals = rows["ordinal"].to_pylist()
    for i, path in _paths(key, rows, logs) if rows.num_rows else []:
        proofs.append(hashlib.sha256(b"".join(path).hex().encode()).hexdigest())
        digest = tampered[i] or digests[i]
        if path:
            digest, path = node_hash(path[0] + digest + path[1]), path[2:]
        at = (ordinals[i] // FAN, digest)
        if at not in known:
            known[at] = fold(digest, path)
        folded.append(known[at])
    rows = rows.select(["doc_id", "tree", "digest"])
    return rows.append_column("proof", pa.array(proofs, pa.string())).append_column("folded", pa.array(folded, pa.binary()))


@dataclass
class Manifest:
    """Numbered leaves of the documents, the logs of the sources and of the dataset by tier."""

    leaves: DataFrame  # tree, doc_id, digest, tampered, ordinal, total
    sources: list[DataFrame]
    subroots: DataFrame  # tree, digest, ordinal, total
    dataset: list[DataFrame]


def build_manifest(docs: DataFrame) -> Manifest:
    """Leaves and logs of ``docs`` (``doc_id, source, lang, n_chars, text``; other columns do not count).

    ``tree`` is the source behind ``=``, ``-`` for none. Leaves ascend by ``doc_id``
    (none first), rows of one id by their digests; equal rows are leaves of their own.
    ``tampered`` is the digest of the row with A-Z of the text lower-cased, where 5
    divides the crc32 of the decimal ``doc_id`` (never without one), else null. Null
    fields count as ``-``; texts of any length are hashed whole.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))
    altered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = docs.select(
        tree.alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_hash(F.col("text")).alias("digest"),
        F.when(altered, leaf_hash(F.translate("text", _UPPER, _UPPER.lower()))).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),  # equal rows need not share a range
    )
    # written before it is sorted, as sampling the ranges would hash all texts once more
    numbered = stored(_number(stored(leaves, "digests"), ["doc_id", "digest", "row"]).drop("row"), "numbered")
    sources = _tiers(numbered, numbered.agg(F.max("total")).first()[0] or 0)
    roots = [t.where(F.col("total") <= SPAN).select("tree", _root()) for t in sources]
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    found = found.select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest")
    subroots = stored(_number(found, ["own"]), "subroots")
    return Manifest(numbered, sources, subroots, _tiers(subroots, subroots.count()))


def _joined(leaves: DataFrame, logs: DataFrame, work, schema: str) -> DataFrame:
    left = leaves.withColumn("above", F.floor(F.col("ordinal") / SPAN).cast("long"))
    keyed = logs.withColumnsRenamed({"tree": "up", "builder": "above"})
    return left.groupBy("up", "above").cogroup(keyed.groupBy("up", "above")).applyInArrow(work, schema)


def _down(tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """The first tier's logs with the paths of their roots; ``top``: ``tree, builder, leaves, log, total, path`` of those that end their tree."""
    schema = f"{SEGMENT}, {PATH}"
    done = None
    for nth in range(len(tiers) - 1, -1, -1):
        ends = top.where(F.col("tier") == nth).drop("tier")
        if done is None:
            done = ends
        else:
            inner = tiers[nth].where(F.col("total") > SPAN).withColumns({"up": F.col("tree"), "ordinal": F.col("builder")})
            done = ends.unionByName(_joined(inner, done, _extend, schema))
        done = stored(done, "paths")
    return done


def prove(manifest: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row, read from the logs.

    ``proof_sha256`` is the digest of all siblings from the leaf to the root.
    ``folded_root`` follows from the tampered leaf, where there is one, and the
    original siblings; ``verified`` tells whether it is the root.
    """
    last = len(manifest.dataset) - 1
    top = manifest.dataset[last].withColumns({"path": F.array().cast("array<binary>"), "tier": F.lit(last)})
    dataset = _down(manifest.dataset, top)
    end = top.select(F.lower(F.hex(_root()))).first()
    root = F.lit(end[0] if end else None).cast("string")
    tops = None
    for nth, t in enumerate(manifest.sources):
        one = t.where(F.col("total") <= SPAN).withColumn("tier", F.lit(nth))
        tops = one if tops is None else tops.unionByName(one)
    place = manifest.subroots.select(F.col("own").alias("tree"), F.col("tree").alias("up"), "ordinal")
    schema = f"{SEGMENT}, tier int, {PATH}"
    tops = stored(_joined(tops.join(place, "tree"), dataset, _extend, schema), "tops")
    first = _down(manifest.sources, tops)
    rows = manifest.leaves.select(F.col("tree").alias("up"), "tree", "doc_id", "digest", "tampered", "ordinal")
    found = _joined(rows, first, _finish, "doc_id long, tree string, digest binary, proof string, folded binary")
    roots = manifest.subroots.select(F.col("own").alias("tree"), F.lower(F.hex("digest")).alias("subroot"))
    folded = F.lower(F.hex("folded"))
    return (
        found.join(roots, "tree")
        .select(
            "doc_id",
            F.lower(F.hex("digest")).alias("leaf"),
            "subroot",
            root.alias("root"),
            F.col("proof").alias("proof_sha256"),
            folded.alias("folded_root"),
            (folded == root).alias("verified"),
        )
    )


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """Manifest of ``docs`` and the proof of every row; an empty table gives none."""
    return prove(build_manifest(docs))
