"""Validation rules as functions of tables: each gives (id, passed) with what went wrong beside it.

``passed`` is never null; feed the rows to :func:`stats.check_suite`, or to :func:`summed` for one line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import joins, windows
from .ranks import same_groups


def summed(rows: DataFrame) -> DataFrame:
    """(passed, total) of rows with ``passed``."""
    return rows.agg(F.count_if("passed").alias("passed"), F.count("*").alias("total"))


def _listed(col: str | Column) -> Column:
    return F.array_sort(F.array_distinct(col))


def provenance(df: DataFrame, key: str, sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(key, missing, passed): the names of the sources (name: table, its key) that lack a row's key.
    Null keys are in none. Keys of a source are made distinct first, so no row is doubled."""
    out, lost = df.select(key), []
    for name, (table, column) in sources.items():
        have = table.select(F.col(column).alias(key)).where(F.col(key).isNotNull()).distinct().withColumn(f"__{name}", F.lit(True))
        out = out.join(have, key, "left")
        lost.append(F.when(F.col(f"__{name}").isNull(), name))
    missing = F.array_compact(F.array(*lost))
    return out.select(key, missing.alias("missing")).withColumn("passed", F.size("missing") == 0)


def role_present(df: DataFrame, key: str, role: str, roles: list[str], enabled: Column) -> DataFrame:
    """(key, missing, passed): the roles that no enabled row of a key has."""
    seen = [F.coalesce(F.bool_or((F.col(role) == r) & enabled), F.lit(False)).alias(f"__{k}") for k, r in enumerate(roles)]
    g = df.groupBy(key).agg(*seen)
    missing = F.array_compact(F.array(*[F.when(~F.col(f"__{k}"), r) for k, r in enumerate(roles)]))
    return g.select(key, missing.alias("missing")).withColumn("passed", F.size("missing") == 0)


def flag_consistency(df: DataFrame, key: str, keep: str, mask: str, chains: str, interfaces: str) -> DataFrame:
    """(key, mask_ok, chains_ok, interfaces_ok, passed): whether three stored copies of what is kept agree.

    ``keep`` is the list of kept chain numbers, ``mask`` a boolean for each chain, ``chains`` structs
    (chain_id, valid), ``interfaces`` structs (chain_1, chain_2, valid): an interface is valid exactly
    if both its ends are kept. A record without chains fails; one without interfaces agrees."""
    kept = _listed(F.coalesce(F.col(keep), F.array().cast("array<int>")).cast("array<long>"))
    marked = F.filter(F.transform(mask, lambda m, i: F.when(m, i.cast("long"))), lambda i: i.isNotNull())
    valid = F.transform(F.filter(chains, lambda c: F.coalesce(c["valid"], F.lit(False))), lambda c: c["chain_id"].cast("long"))
    both = lambda i: F.array_contains(kept, i["chain_1"].cast("long")) & F.array_contains(kept, i["chain_2"].cast("long"))
    agree = F.forall(F.coalesce(F.col(interfaces), F.filter(F.array(F.get(interfaces, F.lit(0))), lambda x: F.lit(False))), lambda i: F.coalesce(i["valid"], F.lit(False)) == F.coalesce(both(i), F.lit(False)))
    false = F.lit(False)
    out = df.select(key, F.coalesce(_listed(marked) == kept, false).alias("mask_ok"), F.coalesce(_listed(valid) == kept, false).alias("chains_ok"), F.coalesce(agree, F.lit(True)).alias("interfaces_ok"))
    return out.withColumn("passed", F.col("mask_ok") & F.col("chains_ok") & F.col("interfaces_ok"))


def integrity(chains: DataFrame, sizes: DataFrame, key: str, order: str, number: str, kept: str) -> DataFrame:
    """(key, count_ok, keep_ok, order_ok, atoms_ok, residues_ok, passed): whether a record's arrays hold together.

    ``chains`` has a row for each chain: ``order`` (its place), ``number``, ``kept``, atom_idx, atom_num,
    res_idx, res_num. ``sizes`` has a row for each record: n_mask, keep (list of places), n_atoms,
    n_residues. The mask has as many entries as there are chains; as many chains are kept as the list
    has, all of them places that exist; numbers of kept chains strictly rise; and the last chain's
    offsets and counts end at the tables' sizes. The last is a carried scan, so a record of any size
    is many keys. A record without chains fails."""
    ordered = windows.monotonic(chains.where(F.coalesce(F.col(kept), F.lit(False))), key, order, number).withColumnRenamed("ok", "__rise")
    both = same_groups(chains.select(key, order, kept, "atom_idx", "atom_num", "res_idx", "res_num"), sizes.select(key, "n_atoms", "n_residues"), [key])
    ends = [windows.monotonic(both, key, order, order, F.col(f"{x}_idx") + F.col(f"{x}_num"), F.col(n)).select(key, F.col("end_ok").alias(f"__{x}")) for x, n in (("atom", "n_atoms"), ("res", "n_residues"))]
    n = chains.groupBy(key).agg(F.count("*").alias("__n"), F.count_if(kept).alias("__kept"))
    out = sizes.select(key, "n_mask", "keep")
    for part in (n, ordered, *ends):
        out = same_groups(out, part, [key])
    false = lambda c: F.coalesce(c, F.lit(False))
    places = F.forall(F.coalesce("keep", F.array().cast("array<int>")), lambda i: (i >= 0) & (i < F.col("__n")))
    tests = {
        "count_ok": false(F.col("n_mask") == F.col("__n")),
        "keep_ok": false((F.col("__kept") == F.size(F.coalesce("keep", F.array().cast("array<int>")))) & places),
        "order_ok": F.when(F.col("__kept") > 0, F.col("__rise")).otherwise(F.col("__n").isNotNull()),
        "atoms_ok": false(F.col("__atom")),
        "residues_ok": false(F.col("__res")),
    }
    out = out.select(key, *[c.alias(k) for k, c in tests.items()])
    return out.withColumn("passed", windows.all_of([F.col(k) for k in tests]))


def references(refs: DataFrame, ref: str, user: str, have: DataFrame, key: str, sentinels: tuple = ("", "-1"), k: int = 3) -> DataFrame:
    """(ref, passed, users, used_by): each distinct reference of a row that is none of ``sentinels``,
    and of those that do not exist how many users they have and the first ``k``."""
    named = refs.where(F.col(ref).isNotNull() & ~F.col(ref).cast("string").isin(*sentinels))
    lost = joins.reference_exists(named, ref, user, have, key, k)
    return named.select(ref).distinct().join(lost, ref, "left").select(ref, F.col("users").isNull().alias("passed"), "users", "used_by")


def eval_rows(rows: DataFrame, record: str, values: str, sanity: str | None = None, expected: int | None = None, n_values: int = 3, limit: float = 30.0) -> DataFrame:
    """(check, passed, found): the gate of a run. ``count``: as many rows as ``expected`` (any, without);
    ``ids``: no record is null or twice; ``values``: every row has ``n_values`` finite values from 0 to
    below ``limit``; found is the number of rows, of null and repeated ids, and of rows that fail. Warm-up
    rows (``sanity``) do not count."""
    real = rows if sanity is None else rows.where(~F.coalesce(F.col(sanity), F.lit(False)))
    good = F.coalesce((F.size(values) == n_values) & F.forall(values, lambda v: F.coalesce((v >= 0) & (v < limit) & ~F.isnan(v), F.lit(False))), F.lit(False))
    ids = real.groupBy(record).agg(F.count("*").alias("n"), F.count_if(~good).alias("bad"))
    twice = F.when(F.col(record).isNull(), F.col("n")).otherwise(F.col("n") - 1)
    one = ids.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.coalesce(F.sum(twice), F.lit(0)).alias("ids"), F.coalesce(F.sum("bad"), F.lit(0)).alias("values"))
    right = F.lit(True) if expected is None else F.col("count") == expected
    lines = [F.struct(F.lit(c).alias("check"), p.alias("passed"), F.col(c).alias("found")) for c, p in (("count", right), ("ids", F.col("ids") == 0), ("values", F.col("values") == 0))]
    return one.select(F.inline(F.array(*lines)))


def triage(quality: DataFrame, errors: DataFrame, key: str, rules: list[tuple[Column, str, Column]], rest: str = "rest") -> DataFrame:
    """(key, class, why): the first of ordered rules (condition, class, reason) that holds of a row of
    ``quality`` joined with its row of ``errors``; neither: ``rest``. Conditions see the columns of both;
    a key without errors has nulls there, and ``has_error`` false."""
    both = quality.join(errors.withColumn("has_error", F.lit(True)), key, "left").withColumn("has_error", F.coalesce("has_error", F.lit(False)))
    call = None
    for cond, name, why in rules:
        pair = F.struct(F.lit(name).alias("class"), why.cast("string").alias("why"))
        call = F.when(cond, pair) if call is None else call.when(cond, pair)
    nothing = F.struct(F.lit(rest).alias("class"), F.lit(None).cast("string").alias("why"))
    return both.select(key, (nothing if call is None else call.otherwise(nothing)).alias("c")).select(key, "c.*")
