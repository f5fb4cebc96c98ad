"""Exact deduplication with an extendible-hash index on shared files.

Only DataFrame operations. The index holds one entry for each distinct text: its 64-bit key,
digest, representative and number of copies. The directory over the keys doubles until no bucket
holds more than ``capacity`` entries. Owner tasks, one for each bucket, give every document its
entry: entries of equal key form a chain told apart by digest, then by the bytes of the texts
themselves. A bucket whose texts have many copies is dealt to several tasks by slices of its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Text is compared after each run of ASCII white space is made one space.
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Slots of the broadcast filter of keys that occur more than once: its proven bound in rows.
FILTER_SLOTS = 1 << 17
#: Copies of a text that one task compares with their representative.
COPIES = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def cell_of(depth: int) -> Column:
    """The cell of the directory that a key belongs to: its first ``depth`` bits."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def directory(index: DataFrame, capacity: int, max_depth: int) -> tuple[DataFrame, int]:
    """((cell, depth, bucket, slices), number of bits of a cell): the bucket each cell points to.

    The directory starts at the depth at which evenly spread keys fit and doubles until no cell
    holds more than ``capacity`` entries, unless they share one key (a chain that no doubling
    parts) or ``max_depth`` is reached. A bucket is the shortest prefix whose entries fit.
    ``slices`` is the number of owner tasks of the bucket: one for each ``4 * capacity`` rows of
    its texts, copies included.
    """
    depth, n = 0, index.count()
    while depth < max_depth and n >> depth > capacity:
        depth += 1
    while True:
        cells = index.groupBy(cell_of(depth).alias("cell")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), F.sum("group_size").alias("rows"))
        if depth >= max_depth or cells.where((F.col("n") > capacity) & (F.col("low") < F.col("high"))).isEmpty():
            break
        depth += 1
    levels = cells.select("cell", "n", "rows", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    levels = levels.withColumn("bucket", F.expr(f"shiftrightunsigned(cell, {depth} - depth)"))
    held = levels.groupBy("depth", "bucket").agg(F.sum("n").alias("held"), F.sum("rows").alias("rows"))
    fits = held.where((F.col("held") <= capacity) | (F.col("depth") == depth)).withColumn("slices", F.ceil(F.col("rows") / (4 * capacity)))
    where = levels.drop("n", "rows").join(fits, ["depth", "bucket"]).groupBy("cell").agg(F.min(F.struct("depth", "bucket", "slices")).alias("x"))
    return where.select("cell", "x.*"), depth


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1 << 16,
    max_depth: int = 64,
    digest: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, depth, bucket.

    Null text counts as empty; empty texts are copies of each other. Of equal texts the smallest
    id stays. Repeated rows (equal id and text) count as copies, and ``kept`` is true for each row
    with the smallest id. A null id is kept only where its text has no other. An empty table gives an empty result. Other columns are not read, so
    their names cannot clash. ``digest`` replaces the key and the digest of the chain (for tests of
    collisions); texts are compared byte by byte in any case.
    """
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("norm"))
    entries = stored(rows.select("id", F.xxhash64("norm").alias("key") if digest is None else digest(F.col("norm")).alias("key"), F.sha2("norm", 256).alias("sha")))
    chain = ["key", "sha"] if digest is None else ["key"]
    index = stored(entries.groupBy(*chain).agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")))
    where, bits = directory(index, capacity, max_depth)
    out = _owned(entries, index, stored(where), bits, chain)
    odd = _unequal(rows, index, chain, digest)
    if not odd.isEmpty():
        out = _regrouped(out, odd)
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"), "depth", "bucket"
    )


def _owned(entries: DataFrame, index: DataFrame, where: DataFrame, bits: int, chain: list[str]) -> DataFrame:
    """The rows of ``entries`` with the index entry of their text: (id, sha, keep_id, group_size, depth, bucket).

    An owner task has one bucket, a range of keys, or one slice of it where copies fill it. Rows
    and index entries are dealt by (bucket, slice) and sorted by key; each chain's entry stands
    before its rows. Entries are dealt to every slice of their bucket, a quarter of its rows at most.
    The directory is joined by cell; Spark broadcasts it if its size allows.
    """
    owner = ["depth", "bucket", "slice"]
    asked = entries.withColumn("cell", cell_of(bits)).join(where, "cell").withColumn("slice", F.pmod(F.xxhash64("id"), "slices"))
    asked = asked.select(*owner, "key", "sha", "id", F.lit(1).alias("asks"), F.lit(None).cast(index.schema["keep_id"].dataType).alias("keep_id"), F.lit(None).cast("long").alias("group_size"))
    held = index.withColumn("cell", cell_of(bits)).join(where, "cell").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    sha = F.col("sha") if "sha" in chain else F.lit(None).cast("string").alias("sha")
    held = held.select(*owner, "key", sha, F.lit(None).cast(entries.schema["id"].dataType).alias("id"), F.lit(0).alias("asks"), "keep_id", "group_size")
    dealt = asked.unionByName(held).repartition(*owner)
    link = Window.partitionBy(*owner, *chain).orderBy("asks").rowsBetween(Window.unboundedPreceding, 0)
    found = dealt.withColumn("entry", F.first(F.struct("keep_id", "group_size")).over(link)).where("asks = 1")
    return found.select("id", "key", "sha", "entry.keep_id", "entry.group_size", "depth", "bucket")


def _unequal(rows: DataFrame, index: DataFrame, chain: list[str], digest) -> DataFrame:
    """Rows of shared chains whose bytes differ from their representative's: (id, norm)."""
    shared = index.where("group_size > 1").select(*chain, "keep_id", "group_size")
    slot = F.pmod(F.col("key"), F.lit(FILTER_SLOTS))
    slots = shared.select(slot.alias("slot")).distinct()  # FILTER_SLOTS rows at most
    key = F.xxhash64("norm") if digest is None else digest(F.col("norm"))
    near = rows.withColumn("key", key).withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi")
    if "sha" in chain:
        near = near.withColumn("sha", F.sha2("norm", 256))
    part = F.pmod(F.xxhash64("id"), "parts")
    members = stored(near.join(shared.withColumn("parts", F.ceil(F.col("group_size") / COPIES)), chain).select("id", "keep_id", "parts", part.alias("part"), "norm"))
    first = members.where("id = keep_id").groupBy("keep_id").agg(F.min("norm").alias("rep_norm"), F.max("parts").alias("parts"))
    first = first.select("keep_id", "rep_norm", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return stored(members.join(first, ["keep_id", "part"]).where("norm <> rep_norm").select("id", "norm"))


def _regrouped(out: DataFrame, odd: DataFrame) -> DataFrame:
    """Give the rows of colliding chains groups of their own, by the bytes of the text."""
    own = odd.groupBy("norm").agg(F.min("id").alias("own_id"), F.count("*").alias("own_size"))
    moved = odd.join(own, "norm").select("id", "own_id", "own_size").dropDuplicates(["id"])
    out = out.join(moved, "id", "left")
    left = out.where("own_id is null").groupBy("keep_id").agg(F.count("*").alias("left_size"))
    out = out.join(left, "keep_id", "left")
    return out.withColumn("group_size", F.coalesce("own_size", "left_size")).withColumn("keep_id", F.coalesce("own_id", "keep_id"))
