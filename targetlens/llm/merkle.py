"""A Merkle manifest of a dataset as a content-addressed graph, and the proof of every leaf.

A node is the digest of its up to three children, and the graph is stored as records from a digest
to its children. The records of :data:`DIGITS` levels below one digest are stored together as a
segment, so a tree of n leaves has log(n) / DIGITS tiers, and a task never holds more than one
segment's rows. Requests for leaves descend from the root: the digits of a leaf's rank choose the
child at each level, the children not chosen are collected, and the segments of a path are put in
reverse order at the end. What leads to a segment is worked out once for all requests below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from targetlens.functions.flags import quoted
from targetlens.llm.common import saved
from targetlens.operators.chunks import row_positions
from targetlens.operators.joins import inner_join

FANOUT = 3
DIGITS = 6
SEGMENT = FANOUT**DIGITS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
RUNS = "array<struct<before:binary,after:binary>>"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns' values as binary: ``-`` for null, else byte count, ``:``, value."""

    def field(column: Column) -> Column:
        value = column.cast("string")
        told = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        return F.coalesce(told, F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def parent(children: Sequence[bytes]) -> bytes:
    """Digest of the children's digests, concatenated as hex text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def height(total: int) -> int:
    """Levels of a segment above its members, where its tier has ``total`` of them in the tree."""
    levels = 0
    while levels < DIGITS and FANOUT**levels < total:
        levels += 1
    return levels


def segment(members: list[bytes], total: int) -> tuple[bytes, dict[bytes, list[bytes]]]:
    """The digest above the members, and the records from each digest to its children."""
    records: dict[bytes, list[bytes]] = {}
    for _ in range(height(total)):
        runs = [members[i : i + FANOUT] for i in range(0, len(members), FANOUT)]
        members = [parent(run) for run in runs]
        records.update(zip(members, runs, strict=True))
    return members[0], records


def descend(
    root: bytes, records: Mapping[bytes, list[bytes]], rank: int, levels: int
) -> list[tuple[bytes, bytes]]:
    """Siblings to the left and to the right at each level, from the member of ``rank`` upwards."""
    path, digest = [], root
    for level in reversed(range(levels)):
        digit = rank // FANOUT**level % FANOUT
        children = records[digest]
        path.append((b"".join(children[:digit]), b"".join(children[digit + 1 :])))
        digest = children[digit]
    return path[::-1]


@dataclass(frozen=True)
class Tree:
    """One tree per ``group``: its segments by tier, and the records of all tiers by digest (in hex).

    ``tiers[0]`` has the leaves as members, each further tier the segments of the one before.
    """

    tiers: list[DataFrame]
    records: list[DataFrame]

    def tops(self) -> DataFrame:
        """``group``, ``digest`` of each tree's root."""
        tops = [tier.where(F.col("total") <= SEGMENT).select("group", "digest") for tier in self.tiers]
        found = tops[0]
        for more in tops[1:]:
            found = found.unionByName(more)
        return found


@dataclass(frozen=True)
class Manifest:
    """A tree per group of rows, and the tree over their roots; ``root`` is null without rows."""

    groups: Tree
    over: Tree
    root: bytes | None


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``rank`` in their group and the group's ``total``.

    Equal rows are told apart by where they stand, so that many of them are still sorted in several
    tasks; a group of any size is.
    """
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    placed = row_positions(placed, ["group", *order, "place"]).drop("place")
    groups = placed.groupBy("group").agg(
        F.min("position").alias("first"), F.count(F.lit(1)).alias("total")
    )
    ranked = inner_join(placed, saved(groups, "merkle-groups"), "group")
    return ranked.withColumn("rank", F.col("position") - F.col("first")).drop("position", "first")


def _tree(ranked: DataFrame) -> Tree:
    """Segments of rows with ``group``, ``rank``, ``total``, ``digest``, ``row``, tier by tier."""
    tiers, records = [], []
    while True:
        block = F.expr(f"rank div {SEGMENT}").alias("block")
        member = F.struct("rank", "digest", "row").alias("member")
        gathered = ranked.select("group", block, "total", member).groupBy("group", "block", "total")
        members = F.array_sort(F.collect_list("member"), _by_rank).alias("members")
        gathered = gathered.agg(members)
        schema = T.StructType(list(gathered.schema.fields))
        schema.add("digest", T.BinaryType())
        schema.add("nodes", T.MapType(T.BinaryType(), T.ArrayType(T.BinaryType())))
        whole = saved(gathered.mapInArrow(_segments, schema), "merkle-segments")
        tiers.append(whole.drop("nodes"))
        nodes = whole.select(F.hex("digest").alias("key"), "nodes").dropDuplicates(["key"])
        records.append(saved(nodes, "merkle-records"))
        ranked = whole.where(F.col("total") > SEGMENT).select(
            "group",
            F.col("block").alias("rank"),
            F.expr(f"(total + {SEGMENT - 1}) div {SEGMENT}").alias("total"),
            "digest",
            F.lit(None).cast("string").alias("row"),
        )
        if ranked.isEmpty():
            return Tree(tiers, records)


def _by_rank(left: Column, right: Column) -> Column:
    return F.when(left["rank"] < right["rank"], -1).otherwise(1)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment with its digest and its records."""
    for batch in batches:
        digests, ends, keys, children = [], [0], [], []
        members = batch.column("members")
        for row, total in enumerate(batch.column("total").to_pylist()):
            listed = members[row].values.field("digest").to_pylist()
            digest, records = segment(listed, total)
            digests.append(digest)
            keys += records
            children += records.values()
            ends.append(len(keys))
        nodes = pa.MapArray.from_arrays(
            pa.array(ends, pa.int32()),
            pa.array(keys, pa.binary()),
            pa.array(children, pa.list_(pa.binary())),
        )
        arrays = [*batch.columns, pa.array(digests, pa.binary()), nodes]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "digest", "nodes"])


def manifest(
    docs: DataFrame,
    id_column: str = "doc_id",
    group_column: str = "source",
    columns: Sequence[str] = COLUMNS,
    carry: Mapping[str, Column] | None = None,
) -> Manifest:
    """The manifest of all rows of ``docs``, stored in the shared folder.

    Every row is a leaf, the digest of ``columns`` in that order. The leaves of a group ascend by
    id, those without id first and equal ids by digest, so repeated rows are leaves of their own
    next to each other and no order of the input matters. Groups stand in the bytewise order of
    their name, rows without one first. A group of one leaf has it as its root. ``carry`` names
    columns that leaves keep with them; other columns are left out, and none can clash. Without
    rows there is no root.

    Texts are hashed where they are read and not moved.
    """
    name = quoted(group_column).cast("string")
    # Null groups sort before the empty name.
    group = F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("group")
    carried = [column.alias(name) for name, column in (carry or {}).items()]
    row = F.struct(quoted(id_column).alias("id"), *carried).alias("row")
    digest = leaf_digest([quoted(column) for column in columns]).alias("digest")
    leaves = saved(docs.select(group, quoted(id_column).alias("id"), digest, row), "merkle-leaves")
    groups = _tree(_ranked(leaves, ["id", "digest"]).drop("id"))
    tops = groups.tops().select(
        F.lit("").alias("group"), F.col("group").alias("name"), "digest",
        F.col("group").alias("row"),
    )
    over = _tree(_ranked(saved(tops, "merkle-tops"), ["name"]).drop("name"))
    found = over.tops().first()
    return Manifest(groups, over, bytes(found["digest"]) if found else None)


def _descended(tree: Tree, tops: DataFrame) -> DataFrame:
    """A request for every leaf: ``row``, ``digest``, ``path`` and what ``tops`` says of its tree.

    ``tops`` has ``group``, ``path`` of each tree's root, and further columns to hand down.
    """
    handed = [name for name in tops.columns if name not in ("group", "path")]
    reached = None
    for tier, records in zip(reversed(tree.tiers), reversed(tree.records), strict=True):
        own = tier.where(F.col("total") <= SEGMENT).select("group", "block")
        asked = own.join(tops, "group").select("group", "block", "path", *handed)
        if reached is not None:
            asked = asked.unionByName(reached)
        requests = tier.join(asked, ["group", "block"]).withColumn("key", F.hex("digest"))
        requests = saved(requests, "merkle-requests")
        found = inner_join(requests, records, "key")
        kinds = {name: requests.schema[name].dataType for name in handed}
        member = requests.schema["members"].dataType.elementType
        schema = T.StructType().add("group", T.StringType()).add("block", T.LongType())
        schema = schema.add("digest", T.BinaryType()).add("row", member["row"].dataType)
        schema = schema.add("path", T._parse_datatype_string(RUNS))
        for name, kind in kinds.items():
            schema = schema.add(name, kind)
        reached = found.mapInArrow(_requests(handed), schema)
        if tier is not tree.tiers[0]:
            reached = saved(
                reached.select("group", "block", "path", *handed), "merkle-paths"
            )
    return reached


def _requests(handed: Sequence[str]):
    """Paths of all members of each segment of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield _paths(batch.slice(at, 1), handed)

    return run


def _paths(one: pa.RecordBatch, handed: Sequence[str]) -> pa.RecordBatch:
    members = one["members"][0].values
    total, records = one["total"][0].as_py(), dict(one["nodes"][0].as_py())
    above = [(run["before"], run["after"]) for run in one["path"][0].as_py()]
    root, levels = one["digest"][0].as_py(), height(total)
    before, after, ends = [], [], [0]
    for rank in range(len(members)):
        for left, right in [*descend(root, records, rank, levels), *above]:
            before.append(left)
            after.append(right)
        ends.append(len(before))
    runs = pa.StructArray.from_arrays(
        [pa.array(before, pa.binary()), pa.array(after, pa.binary())], names=["before", "after"]
    )
    path = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)

    def repeated(name: str) -> pa.Array:
        return one[name].take(pa.array([0] * len(members), pa.int32()))

    return pa.RecordBatch.from_arrays(
        [
            repeated("group"),
            members.field("rank"),
            members.field("digest"),
            members.field("row"),
            path,
            *[repeated(name) for name in handed],
        ],
        names=["group", "block", "digest", "row", "path", *handed],
    )


def proofs(held: Manifest) -> DataFrame:
    """``row`` (``id`` and carried columns), ``leaf``, ``subroot``, ``root``, ``proof`` of each leaf.

    Digests are binary. ``proof`` has a run per level, from the leaf to the root: the digests of the
    siblings ``before`` it, concatenated, and of those ``after`` it.
    """
    spark = held.over.tiers[0].sparkSession
    root = F.lit(held.root).cast("binary")
    start = spark.createDataFrame([("", [])], f"group string, path {RUNS}")
    over = _descended(held.over, start)
    tops = over.select(F.col("row").alias("group"), "path", F.col("digest").alias("subroot"))
    leaves = _descended(held.groups, saved(tops, "merkle-tops"))
    return leaves.select(
        "row", F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        F.col("path").alias("proof"),
    )


def spelled(digest: Column) -> Column:
    """A digest, or several in a row, as lowercase hex."""
    return F.lower(F.hex(digest))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf has by a proof."""

    def above(digest: Column, run: Column) -> Column:
        children = F.concat(run["before"], digest, run["after"])
        return F.unhex(F.sha2(spelled(children), 256))

    return F.aggregate(proof, leaf, above)


def siblings(proof: Column) -> Column:
    """All digests of a proof as hex text, level by level from the leaf up, left to right."""
    runs = F.transform(proof, lambda run: spelled(F.concat(run["before"], run["after"])))
    return F.array_join(runs, "")
