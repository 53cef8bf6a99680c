"""Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf, the digest of its canonical fields.  Leaves of a group
(a language) ascend by their order column; on each level the nodes are dealt
into runs of `FANOUT` neighbours.  Within a run the fixed-offset columns
lag 1..7 and lead 1..7, masked by the node's slot and the run's length, are
its siblings, and the row of slot 0, the first child, hashes the parent from
itself and its leads.  Levels repeat until every group has one node, the
subroot; the subroots, in the order of their groups, become a tree alike.

Plan: leaves are written once (32-byte digests, no texts), range-sorted by
(group, order) and written with their places; a level shuffles by (group,
run), so a window partition never holds more than `FANOUT` rows, however large
a group is, and each level is an eighth of the one below.  Proofs run top
down: the nodes of a level are joined with the proofs of the next one on
(group, run), the key their own window has already shuffled by.  The driver
sees one total per sort partition and the largest group's size.

Cases: a null field is hashed as `-`, so a null and an empty text differ; the
null group comes first; rows of equal or null order are told apart by their
leaf, then by the row; repeated rows are leaves of their own; texts of any
length are hashed whole; a lone leaf is its group's subroot, a lone subroot
the root; an empty table has no rows and no root; columns that are not named
as fields, group or order take no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emolens.llm.common import written

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated strings."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def canonical(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return digest(*(canonical(v) for v in fields.values()))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass
class Manifest:
    """``leaves``: key columns, ``grp``, ``pos``, ``n`` (the group's size) and
    ``h``; ``levels``: the nodes (grp, pos, n, h) of groups that still have
    several, per level from the leaves up; ``tops``: (grp, subroot, depth,
    root, up), a row a group, ``up`` its proof among the subroots."""

    leaves: DataFrame
    levels: list[DataFrame]
    tops: DataFrame


def placed(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """Nodes with ``pos``, their place within ``grp`` in ``order``, and ``n``,
    the group's size.  Sorted by range and written; then running numbers
    within a sort partition and one total per (partition, group)."""
    by = ["grp", *order]
    fixed = written(nodes.repartitionByRange(*by).sortWithinPartitions(*by)
                    .withColumn("part", F.spark_partition_id()), name)
    counts = fixed.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("here"))
    along = Window.partitionBy("grp").orderBy("part")
    offsets = counts.select(
        "part", "grp",
        F.coalesce(F.sum("here").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("here").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"))
    number = F.row_number().over(Window.partitionBy("part", "grp").orderBy(*order)) - 1
    return fixed.withColumn("at", number).join(offsets, ["part", "grp"]) \
        .withColumn("pos", F.col("before") + F.col("at")).drop("part", "at", "before")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with ``run``, ``left`` and ``right``: the concatenated digests of
    the siblings before and after each node, and ``parent`` where the node is
    the first child (else null)."""
    slot = F.pmod(F.col("pos"), F.lit(FANOUT))
    size = F.least(F.lit(FANOUT), F.col("n") - F.col("run") * FANOUT)
    run = Window.partitionBy("grp", "run").orderBy("pos")
    lag = {j: F.when(slot >= j, F.lag("h", j).over(run)) for j in range(1, FANOUT)}
    lead = {j: F.when(slot + j < size, F.lead("h", j).over(run)) for j in range(1, FANOUT)}
    cols = {f"lag{j}": c for j, c in lag.items()} | {f"lead{j}": c for j, c in lead.items()}
    out = nodes.withColumn("run", F.expr(f"pos div {FANOUT}")).withColumns(cols)
    none = F.lit("")
    out = out.withColumns({
        "left": F.concat(*(F.coalesce(F.col(f"lag{j}"), none) for j in range(FANOUT - 1, 0, -1))),
        "right": F.concat(*(F.coalesce(F.col(f"lead{j}"), none) for j in range(1, FANOUT)))})
    return out.withColumn("parent", F.when(slot == 0, digest(F.col("h"), F.col("right")))).drop(*cols)


def _raised(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``nodes`` and the top node (grp, h, depth) of each
    group; ``most`` is the largest group's size."""
    levels, tops, level, depth = [], [], nodes, 0
    while most > 1:
        tops.append(level.where("n = 1").select("grp", "h", F.lit(depth).alias("depth")))
        level = level.where("n > 1")
        levels.append(level)
        parents = with_siblings(level).where(F.col("parent").isNotNull()).select(
            "grp", F.col("run").alias("pos"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), F.col("parent").alias("h"))
        level, most, depth = written(parents, f"{name}-level"), -(-most // FANOUT), depth + 1
    top = level.where("n = 1").select("grp", "h", F.lit(depth).alias("depth"))
    for t in tops:
        top = top.unionByName(t)
    return levels, top


_STEP = "array<struct<left:string,right:string>>"


def _proofs(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``nodes`` (level 0) with ``path``, the siblings (left, right) level by
    level, followed by the group's ``up``; and the columns of ``tops``."""
    def top_at(depth: int) -> DataFrame:
        return tops.where(F.col("depth") == depth).select("grp", F.lit(0).cast("long").alias("run"),
                                                          F.col("up").alias("above"), "subroot", "root")

    above = top_at(len(levels))
    for depth in range(len(levels) - 1, 0, -1):
        here = with_siblings(levels[depth]).join(above, ["grp", "run"]).select(
            "grp", F.col("pos").alias("run"), F.concat(F.array(F.struct("left", "right")), "above").alias("above"),
            "subroot", "root")
        above = here.unionByName(top_at(depth))
    if levels:
        above = above.unionByName(top_at(0))
    own = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.lit(None).cast(_STEP))
    return with_siblings(nodes).join(above, ["grp", "run"]) \
        .withColumn("path", F.concat(F.coalesce(own, F.expr(f"cast(array() as {_STEP})")), "above")) \
        .drop("run", "left", "right", "parent", "above", "grp", "pos", "n")


def build(docs: DataFrame, leaf: dict[str, Column], carry: dict[str, Column], group: Column, order: Column) -> Manifest:
    """The manifest of ``docs``.  ``leaf``: the fields hashed, in order;
    ``carry``: columns that the leaves keep."""
    # null before every language, and languages by their bytes
    grp = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    table = docs.select(grp.alias("grp"), order.alias("key"), *(c.alias(n) for n, c in carry.items()),
                        leaf_digest(leaf).alias("h")).withColumn("row", F.monotonically_increasing_id())
    leaves = placed(written(table, "leaves"), ["key", "h", "row"], "sorted-leaves").drop("key", "row")
    leaves = written(leaves, "placed-leaves")
    most = leaves.agg(F.max("n")).first()[0] or 0  # one number
    levels, top = _raised(leaves.select("grp", "pos", "n", "h"), most, "manifest")
    # the subroots: one group of as many nodes as there are languages
    roots = written(top.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "h", "depth"), "subroots")
    nodes = written(placed(roots, ["of"], "sorted-subroots"), "placed-subroots")
    n_groups = nodes.agg(F.max("n")).first()[0] or 0
    upper, root = _raised(nodes.select("grp", "pos", "n", "h"), n_groups, "root")
    one = root.select("grp", F.expr(f"cast(array() as {_STEP})").alias("up"),
                      F.lit("").alias("subroot"), F.col("h").alias("root"), "depth")
    ups = _proofs(nodes, upper, one).select(
        F.col("of").alias("grp"), F.col("path").alias("up"), F.col("h").alias("subroot"), "root", "depth")
    return Manifest(leaves, levels, written(ups, "tops"))


def proofs(m: Manifest) -> DataFrame:
    """The carried columns of every leaf with ``h`` (the leaf), ``subroot``,
    ``root`` and ``path``."""
    return _proofs(m.leaves, m.levels, m.tops)


def path_digest(path: str = "path") -> Column:
    """The digest of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def verify_tampered(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Key, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``
    and ``verified``: each row's leaf folded along its proof, after the text
    of every third row (by the CRC-32 of its decimal key; none where the key
    is null) was lower-cased in A-Z."""
    cols = {f: quoted(f) for f in fields}
    hit = F.pmod(F.crc32(cols[key].cast("string").cast("binary")), F.lit(3)) == 0
    lower = F.translate(cols[text], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # only a text with a letter A-Z changes; the others need no second digest
    changed = F.when(hit & cols[text].rlike("[A-Z]"), leaf_digest(cols | {text: lower}))
    m = build(docs, cols, {key: cols[key], "changed": changed}, cols.get(group, quoted(group)), cols[key])
    back = folded(F.coalesce("changed", "h"))
    return proofs(m).select(key, F.col("h").alias("leaf"), "subroot", "root", path_digest().alias("proof_sha256"),
                            back.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
