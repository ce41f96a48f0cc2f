"""The manifest against a tree built level by level, and awkward rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from targetlens.llm import merkle
from targetlens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    key, text, lang, source, n_chars = row

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    return digest("".join(map(field, (key, source, lang, n_chars, text))))


def climb(leaves):
    """The root of a list of digests and the siblings of each, level by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for leaf, place in enumerate(at):
            first = place - place % 3
            run = level[first : first + 3]
            paths[leaf].append((run[: place - first], run[place - first + 1 :]))
        at = [place // 3 for place in at]
        level = [digest("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def brute_force(rows):
    """Each row's leaf, subroot, root and siblings, by the smallest key and digest first."""
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf_of(row)))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {name: climb([leaf for _, _, leaf in sorted(groups[name])]) for name in names}
    root, over = climb([trees[name][0] for name in names])
    found = []
    for name, above in zip(names, over, strict=True):
        subroot, paths = trees[name]
        for (known, key, leaf), path in zip(sorted(groups[name]), paths, strict=True):
            found.append((key if known else None, leaf, subroot, root, path + above))
    return found


def rows_of(rng, count, sources):
    rows = []
    for key in range(count):
        text = "\n".join("ab cé "[: rng.randint(0, 6)] for _ in range(rng.randint(1, 3)))
        rows.append((key * 7 % count, text, rng.choice(["de", None]), rng.choice(sources), key))
    return rows


def spelled_proofs(held):
    proof = F.col("proof")
    return merkle.proofs(held).select(
        F.col("row.id").alias("id"),
        *[merkle.spelled(F.col(name)).alias(name) for name in ("leaf", "subroot", "root")],
        merkle.siblings(proof).alias("siblings"),
        merkle.spelled(merkle.folded(F.col("leaf"), proof)).alias("folded"),
    )


def check(spark, rows, schema=SCHEMA):
    docs = spark.createDataFrame(rows, schema)
    found = [tuple(r) for r in spelled_proofs(merkle.manifest(docs)).collect()]
    wanted = [
        (key, leaf, subroot, root, "".join("".join(b + a) for b, a in path), root)
        for key, leaf, subroot, root, path in brute_force([row[:5] for row in rows])
    ]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


@pytest.mark.parametrize("count", [1, 3, 200])
def test_agrees_with_a_tree_built_by_levels(spark, count):
    check(spark, rows_of(random.Random(count), count, ["a", "B", "", "é", None]))


def test_one_source_of_several_segments(spark):
    rng = random.Random(5)
    assert 2_300 > 3 * merkle.SEGMENT
    check(spark, rows_of(rng, 2_300, ["hot"] * 9 + ["cold"]))


def test_nulls_repeated_rows_and_equal_ids(spark):
    row = (4, "twice", "de", "a", 5)
    rows = [row] * 9 + [(None, None, None, None, None)] * 4 + [(4, "other", "de", "a", 5)]
    check(spark, [*rows, (None, "x\n" * 50_000, None, "a", 1), (-3, "", None, "", 0)])


def test_many_equal_segments_share_their_records(spark):
    rows = [(None, "same", None, "a", 1)] * (3 * merkle.SEGMENT)
    held = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert held.groups.tiers[0].count() == 3 and held.groups.records[0].count() == 1
    check(spark, rows)


def test_large_records_meet_by_a_shuffle(spark, no_broadcast, every_key_hot):
    check(spark, rows_of(random.Random(2), 900, ["a", None]))


def test_clashing_extra_columns(spark):
    names = ["group", "digest", "path", "a.b", "row", "position"]
    schema = SCHEMA + "".join(f", `{name}` int" for name in names)
    check(spark, [(*row, 1, 2, 3, 4, 5, 6) for row in rows_of(random.Random(1), 20, ["a", None])], schema)


def test_empty_table(spark):
    held = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert held.root is None and merkle.proofs(held).collect() == []


def test_every_tampered_leaf_is_told(spark, tmp_path):
    rows = rows_of(random.Random(3), 300, ["a", "b", None])
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()
    texts = {row[0]: row[1] for row in rows}
    assert len(found) == 300
    for row in found:
        hit = zlib.crc32(str(row.doc_id).encode()) % 2 == 0 and "\n" in texts[row.doc_id]
        assert row.verified is not hit and (row.folded_root == row.root) is not hit


def test_a_carried_column_stays_with_its_leaf(spark):
    docs = spark.createDataFrame(rows_of(random.Random(4), 30, ["a", "b"]), SCHEMA)
    held = merkle.manifest(docs, carry={"twice": F.col("doc_id") * 2})
    found = merkle.proofs(held).select("row.*").collect()
    assert sorted((r.id, r.twice) for r in found) == [(i, 2 * i) for i in range(30)]


def test_a_segment_and_the_way_down():
    members = [bytes([i]) * 32 for i in range(20)]
    top, records = merkle.segment(members, 20)
    assert len(records) == 7 + 3 + 1 and merkle.height(20) == 3
    for rank, member in enumerate(members):
        found = member
        for before, after in merkle.descend(top, records, rank, 3):
            found = bytes.fromhex(digest((before + found + after).hex()))
        assert found == top
    # The last segment of a larger tree has all its levels, a run of one included.
    assert len(merkle.segment(members[:1], merkle.SEGMENT + 1)[1]) == merkle.DIGITS
