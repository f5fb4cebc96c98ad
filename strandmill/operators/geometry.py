"""Geometry on atom tables: contacts, centroids, superposition from sums."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import radius_join
from .ranks import same_groups

#: Why a structure's chains are not scored.
ODD_CHAINS = "no long chain with a short one"


def pair_contacts(a: DataFrame, b: DataFrame, r: float = 4.5) -> DataFrame:
    """Contacts and touched points of ``b`` for each group of ``a`` (columns id, grp, x, y, z)."""
    hits = radius_join(a, b, r).join(a.select(F.col("id").alias("a_id"), "grp"), "a_id")
    return hits.groupBy("grp").agg(F.count("*").alias("contacts"), F.countDistinct("b_id").alias("touched"))


def min_distance(a: DataFrame, b: DataFrame, r: float) -> DataFrame:
    """(id, dist): points of ``a`` nearer than r to some point of ``b``, with their least distance."""
    return radius_join(a, b, r, inclusive=False).groupBy(F.col("a_id").alias("id")).agg(F.round(F.sqrt(F.min("dist2")), 6).alias("dist"))


def centroid_distances(df: DataFrame, entry: str, group: str) -> DataFrame:
    """(entry, a, b, dist): the distance between the centroids of each two groups of an entry, a before
    b; joined on the entry, whose groups (chains) are few beside its points."""
    c = df.groupBy(entry, group).agg(*[F.avg(x).alias(x) for x in AXES])
    other = c.select(entry, F.col(group).alias("b"), *[F.col(x).alias("o" + x) for x in AXES])
    pairs = c.withColumnRenamed(group, "a").join(other, entry).where(F.col("a") < F.col("b"))
    return pairs.select(entry, "a", "b", F.sqrt(sum((F.col(x) - F.col("o" + x)) ** 2 for x in AXES)).alias("dist"))


def centroid_distance(df: DataFrame, group: str, a, b) -> DataFrame:
    mean = [F.avg(F.when(F.col(group) == g, F.col(c))).alias(f"{n}{c}") for n, g in (("a", a), ("b", b)) for c in "xyz"]
    return df.agg(*mean).select(F.round(F.sqrt(sum((F.col("a" + c) - F.col("b" + c)) ** 2 for c in "xyz")), 6).alias("dist"))


#: Newton steps: from above the largest root, a simple one settles in ten, a double one halves its way.
STEPS = 60
#: Below this derivative at the root (of moments scaled to 1) no single rotation is best.
SINGLE = 1e-6
AXES = "xyz"


def _sums(prefix: str, cond: Column | None = None) -> list[Column]:
    """The 17 sums of a subset of (px, py, pz, tx, ty, tz) from which all superpositions follow."""
    of = lambda x: F.coalesce(F.sum(x if cond is None else F.when(cond, x)), F.lit(0.0))
    one = [of(F.col(p + c)).alias(f"{prefix}s{p}{c}") for p in "pt" for c in AXES]
    cross = [of(F.col("p" + c) * F.col("t" + d)).alias(f"{prefix}c{c}{d}") for c in AXES for d in AXES]
    square = [of(sum(F.col(p + c) * F.col(p + c) for p in "pt" for c in AXES)).alias(f"{prefix}q")]
    count = F.count(F.lit(1) if cond is None else F.when(cond, 1)).alias(f"{prefix}n")
    return [count, *one, *cross, *square]


def _relative(points: DataFrame, by: list[str]) -> DataFrame:
    """Points about the smallest corner of their group, so that sums of squares lose no places."""
    low = points.groupBy(*by).agg(*[F.min(p + c).alias(f"__m{p}{c}") for p in "pt" for c in AXES])
    return same_groups(points, low, by).withColumns({p + c: (F.col(p + c) - F.col(f"__m{p}{c}")).cast("double") for p in "pt" for c in AXES})


def _about(df: DataFrame, prefix: str, fit: str) -> DataFrame:
    """Moments of the subset ``prefix`` about the means of ``fit``: columns m<c><d> and total."""
    n, fn = F.col(f"{prefix}n"), F.nullif(F.col(f"{fit}n"), F.lit(0))
    mean = {p + c: F.col(f"{fit}s{p}{c}") / fn for p in "pt" for c in AXES}
    s = {p + c: F.col(f"{prefix}s{p}{c}") for p in "pt" for c in AXES}
    moments = {f"{prefix}m{c}{d}": F.col(f"{prefix}c{c}{d}") - mean["p" + c] * s["t" + d] - mean["t" + d] * s["p" + c] + n * mean["p" + c] * mean["t" + d] for c in AXES for d in AXES}
    total = F.col(f"{prefix}q") - 2 * sum(mean[k] * s[k] for k in s) + n * sum(m * m for m in mean.values())
    return df.withColumns(moments | {f"{prefix}total": total})


def _root(d: Column, e: Column) -> Column:
    """The largest root of x^4 - 2 x^2 - 8 d x + 1 - 4 e, by Newton steps from the square root of 3."""

    def step(x: Column, _: Column) -> Column:
        f = ((x * x - 2) * x - 8 * d) * x + 1 - 4 * e
        slope = 4 * (x * x - 1) * x - 8 * d
        return F.when((f > 0) & (slope > 0), x - f / slope).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.lit(math.sqrt(3.0)), step)


def _fitted(df: DataFrame, x: str) -> DataFrame:
    """Of the moments of subset ``x`` about its own means: scale, and root and mirror, the largest sums
    of products a rotation and a reflection reach (as parts of the scale).

    The sums are the eigenvalues of a 4 x 4 matrix of the moments. Its polynomial has as coefficients
    the squared size of the 3 x 3 matrix, its determinant and its squared minors."""
    m = lambda c, d: F.col(f"{x}m{c}{d}")
    size = sum(m(c, d) * m(c, d) for c in AXES for d in AXES)
    minor = lambda c, d, e, f: m(c, e) * m(d, f) - m(c, f) * m(d, e)
    two = ["xy", "xz", "yz"]
    minors = sum(F.pow(minor(*p, *q), 2) for p in two for q in two)
    det = m("x", "x") * minor(*"yzyz") - m("x", "y") * minor(*"yzxz") + m("x", "z") * minor(*"yzxy")
    df = df.withColumns({f"{x}size": size, f"{x}det": det, f"{x}minors": minors})
    some = F.nullif(F.col(f"{x}size"), F.lit(0.0))
    d, e = F.coalesce(F.col(f"{x}det") / F.pow(some, F.lit(1.5)), F.lit(0.0)), F.coalesce(F.col(f"{x}minors") / (some * some), F.lit(0.0))
    df = df.withColumns({f"{x}scale": F.sqrt(f"{x}size"), f"{x}d": d, f"{x}e": e})
    return df.withColumns({f"{x}root": _root(F.col(f"{x}d"), F.col(f"{x}e")), f"{x}mirror": _root(-F.col(f"{x}d"), F.col(f"{x}e"))})


def _rmsd(x: str, root: str = "root") -> Column:
    """Null without points."""
    left = F.greatest(F.lit(0.0), F.col(f"{x}total") - 2 * F.col(f"{x}scale") * F.col(f"{x}{root}"))
    return F.sqrt(left / F.nullif(F.col(f"{x}n"), F.lit(0)))


def _key(x: str, scale: Column) -> list[list[Column]]:
    """The symmetric 4 x 4 matrix of the moments of ``x``."""
    m = {c + d: F.col(f"{x}m{c}{d}") / scale for c in AXES for d in AXES}
    top = [m["xx"] + m["yy"] + m["zz"], m["yz"] - m["zy"], m["zx"] - m["xz"], m["xy"] - m["yx"]]
    return [top, [top[1], m["xx"] - m["yy"] - m["zz"], m["xy"] + m["yx"], m["zx"] + m["xz"]],
            [top[2], m["xy"] + m["yx"], m["yy"] - m["xx"] - m["zz"], m["yz"] + m["zy"]], [top[3], m["zx"] + m["xz"], m["yz"] + m["zy"], m["zz"] - m["xx"] - m["yy"]]]


def _transferred(df: DataFrame, fit: str, x: str, out: str) -> DataFrame:
    """``out``: the RMSD of subset ``x`` under the motion that fits ``fit``; null where that is no single one.

    The adjoint of (matrix - root) is the best rotation's quaternion times itself, so the sum of
    products under it is a ratio of two traces, and no rotation need be written out."""
    scale = F.nullif(F.col(f"{fit}scale"), F.lit(0.0))
    key, moved = _key(fit, scale), _key(x, scale)
    df = df.withColumns({f"__k{i}{j}": key[i][j] - (F.col(f"{fit}root") if i == j else 0) for i in range(4) for j in range(i, 4)})
    k = lambda i, j: F.col(f"__k{min(i, j)}{max(i, j)}")

    def cofactor(i: int, j: int) -> Column:
        (a, b, c), (p, q, r) = ([n for n in range(4) if n != skip] for skip in (i, j))
        det = k(a, p) * (k(b, q) * k(c, r) - k(b, r) * k(c, q)) - k(a, q) * (k(b, p) * k(c, r) - k(b, r) * k(c, p)) + k(a, r) * (k(b, p) * k(c, q) - k(b, q) * k(c, p))
        return det if (i + j) % 2 == 0 else -det

    df = df.withColumns({f"__a{i}{j}": cofactor(i, j) for i in range(4) for j in range(i, 4)})
    trace = sum(F.col(f"__a{i}{i}") for i in range(4))
    both = sum((1 if i == j else 2) * F.col(f"__a{i}{j}") * moved[i][j] for i in range(4) for j in range(i, 4))
    left = F.col(f"{x}total") - 2 * scale * both / F.when(F.abs(trace) > SINGLE, trace)
    value = F.sqrt(F.when(left.isNotNull(), F.greatest(F.lit(0.0), left)) / F.nullif(F.col(f"{x}n"), F.lit(0)))
    return df.withColumn(out, value).drop(*[f"__{m}{i}{j}" for m in "ka" for i in range(4) for j in range(i, 4)])


def superpose_rmsd(points: DataFrame, group: str) -> DataFrame:
    """(group, n, rmsd, rmsd_mirror): optimal superposition of (px, py, pz) on (tx, ty, tz), and with
    the turn replaced by one with a reflection.

    Spark sums 17 moments about each group's smallest corner (partial aggregation, so a group of any
    size is one small row); the best sums of products are roots of a quartic, found by Newton steps
    in Column expressions. A null group is a group. One point fits itself; rows with a null
    coordinate are left out of the sums by the caller.
    """
    agg = _relative(points, [group]).groupBy(group).agg(*_sums("a"))
    fit = _fitted(_about(agg, "a", "a"), "a")
    return fit.select(group, F.col("an").alias("n"), _rmsd("a").alias("rmsd"), _rmsd("a", "mirror").alias("rmsd_mirror"))


def structure_scores(points: DataFrame, group: str, fit: str) -> DataFrame:
    """(group, n_fit, n_scored, fit_rmsd, mirror_rmsd, transfer_rmsd, mirrored, reason).

    Each group is superposed on its points with ``fit`` true, and the others are scored under that
    motion. mirror_rmsd is that with a reflection; mirrored says it fits over five times better. Fewer
    than three fit points give a reason in place of values; where they lie on a line the turn about it
    is free, so transfer_rmsd is null with a reason.
    """
    used = F.coalesce(F.col(fit), F.lit(False))
    agg = _relative(points, [group]).groupBy(group).agg(*_sums("a", used), *_sums("b", ~used))
    df = _transferred(_fitted(_about(_about(agg, "a", "a"), "b", "a"), "a"), "a", "b", "moved")
    enough = F.col("an") >= 3
    values = {"fit_rmsd": _rmsd("a"), "mirror_rmsd": _rmsd("a", "mirror"), "transfer_rmsd": F.col("moved"), "mirrored": _rmsd("a") > 5 * _rmsd("a", "mirror")}
    reason = F.when(~enough, "too few points").when((F.col("bn") > 0) & F.col("moved").isNull(), "fit points on a line")
    return df.select(group, F.col("an").alias("n_fit"), F.col("bn").alias("n_scored"), *[F.when(enough, v).alias(k) for k, v in values.items()], reason.alias("reason"))


SCORES = ["pep_rmsd", "pep_internal", "groove_rmsd", "ca_rmsd", "ca_rmsd_mirror"]


def score_rows(residues: DataFrame, record: str, sample: str, chain: str, pos: str, resolved: str, min_heavy: int = 150, max_peptide: int = 30, groove: int = 180) -> DataFrame:
    """One row per record: hc_len, pep_len, n_protein_chains, groove_start, n_groove_ca, n_pep_ca,
    n_all_ca, arrays of one value a sample (pep_rmsd, pep_internal, groove_rmsd, ca_rmsd,
    ca_rmsd_mirror; four places), pep_rmsd_best, pep_rmsd_mean, reason.

    ``residues`` has a row for each residue and sample: px to pz as predicted, tx to tz as known. The
    longest chain is the heavy one, the shortest the peptide. The groove is the ``groove`` positions
    from the heavy chain's first resolved one. pep_rmsd scores the peptide under the groove's motion.
    Records whose chains have other lengths, or fewer than three resolved residues in either, keep
    their row with a reason and no values. Counts are those of the first sample; a record of any size
    is one small row a sample after partial aggregation.
    """
    ok = F.coalesce(F.col(resolved), F.lit(False))
    first = residues.groupBy(record).agg(F.min(sample).alias("__first"))
    once = same_groups(residues, first, [record]).where(F.col(sample) == F.col("__first"))
    chains = once.groupBy(record, chain).agg(F.count("*").alias("__n"), F.min(F.when(ok, F.col(pos))).alias("__start"))
    longest, shortest = F.max(F.struct("__n", chain, "__start")), F.min(F.struct("__n", chain))
    found = chains.groupBy(record).agg(longest.alias("__h"), shortest.alias("__p"), F.count("*").alias("n_protein_chains"))
    found = found.select(record, "n_protein_chains", F.col("__h.__n").alias("hc_len"), F.col("__p.__n").alias("pep_len"), F.col(f"__h.{chain}").alias("__heavy"), F.col(f"__p.{chain}").alias("__peptide"), F.col("__h.__start").alias("__start"))
    rows = same_groups(_relative(residues, [record, sample]), found, [record])
    within = ok & (F.col(chain) == F.col("__heavy")) & (F.col(pos) >= F.col("__start")) & (F.col(pos) < F.col("__start") + groove)
    per = rows.groupBy(record, sample).agg(*_sums("g", within), *_sums("p", ok & (F.col(chain) == F.col("__peptide"))), *_sums("a", ok))
    for x in "gpa":
        per = _fitted(_about(per, x, x), x)
    moved = per.drop(*[f"pm{c}{d}" for c in AXES for d in AXES], "ptotal").withColumnsRenamed({f"p{k}": f"p_{k}" for k in ("size", "det", "minors", "scale", "d", "e", "root", "mirror")})
    own = _rmsd("p").alias("__own")
    per = per.select(record, sample, own, _rmsd("g").alias("__groove"), _rmsd("a").alias("__ca"), _rmsd("a", "mirror").alias("__mirror"))
    moved = _transferred(_about(moved, "p", "g"), "g", "p", "__moved").select(record, sample, "gn", "pn", "an", "__moved")
    per = same_groups(moved, per, [record, sample])
    enough = (F.col("gn") >= 3) & (F.col("pn") >= 3)
    values = dict(zip(SCORES, ("__moved", "__own", "__groove", "__ca", "__mirror")))
    of = F.struct(F.col(sample).alias("s"), *[F.when(enough, F.round(v, 4)).alias(k) for k, v in values.items()], "gn", "pn", "an")
    out = per.groupBy(record).agg(F.array_sort(F.collect_list(of)).alias("__v"))
    out = same_groups(found, out, [record])
    odd = (F.col("__heavy") == F.col("__peptide")) | (F.col("hc_len") <= min_heavy) | (F.col("pep_len") > max_peptide)
    reason = F.when(odd, ODD_CHAINS).when(F.col("__start").isNull(), "heavy chain unresolved").when((F.col("__v")[0]["gn"] < 3) | (F.col("__v")[0]["pn"] < 3), "fewer than three resolved residues")
    out = out.withColumn("reason", reason)
    good, right = F.col("reason").isNull(), ~F.coalesce(odd, F.lit(False))
    arrays = [F.when(good, F.col(f"__v.{k}")).alias(k) for k in SCORES]
    counts = [F.when(right, F.col("__v")[0][f"{x}n"]).alias(n) for x, n in (("g", "n_groove_ca"), ("p", "n_pep_ca"), ("a", "n_all_ca"))]
    out = out.select(record, "hc_len", "pep_len", "n_protein_chains", F.when(right, F.col("__start")).alias("groove_start"), *counts, *arrays, "reason")
    mean = F.round(F.aggregate("pep_rmsd", F.lit(0.0), lambda a, x: a + x) / F.size("pep_rmsd"), 4)
    return out.withColumns({"pep_rmsd_best": F.array_min("pep_rmsd"), "pep_rmsd_mean": mean})


def groove_halves(contacts: DataFrame, group: str, residue: str, cut1: int = 90, cut2: int = 190) -> DataFrame:
    """(group, contacts, lower, upper, in_groove): the distinct touched residues before cut1 and from
    it to cut2; in the groove if both are touched. ``contacts`` has a row for each contact."""
    r = F.col(residue)
    half = lambda cond: F.count_distinct(F.when(cond, r))
    g = contacts.groupBy(group).agg(F.count("*").alias("contacts"), half(r < cut1).alias("lower"), half((r >= cut1) & (r < cut2)).alias("upper"))
    return g.withColumn("in_groove", (F.col("lower") > 0) & (F.col("upper") > 0))


def chain_by_length(chains: DataFrame, entry: str, chain: str, n: str, min_heavy: int = 150, max_peptide: int = 30) -> DataFrame:
    """(entry, heavy, peptide, reason): the longest and the shortest chain, of equals the last and
    the first; a reason if they are one, or not long or short enough."""
    g = chains.groupBy(entry).agg(F.max(F.struct(n, chain)).alias("h"), F.min(F.struct(n, chain)).alias("p"))
    bad = (F.col(f"h.{chain}") == F.col(f"p.{chain}")) | (F.col(f"h.{n}") <= min_heavy) | (F.col(f"p.{n}") > max_peptide)
    return g.select(entry, F.col(f"h.{chain}").alias("heavy"), F.col(f"p.{chain}").alias("peptide"), F.when(bad, ODD_CHAINS).alias("reason"))


def superpose_reflect(points: DataFrame, group: str, times: float = 5.0) -> DataFrame:
    """(group, n, rmsd, rmsd_reflect, mirrored): superposition with a reflection allowed; mirrored if
    the proper one fits so many times worse."""
    free = F.least("rmsd", "rmsd_mirror")
    return superpose_rmsd(points, group).select(group, "n", "rmsd", free.alias("rmsd_reflect"), (F.col("rmsd") > times * F.col("rmsd_mirror")).alias("mirrored"))


def transfer_rmsd(points: DataFrame, group: str, fit: str) -> DataFrame:
    """(group, n_fit, n_scored, fit_rmsd, transfer_rmsd, reason): superposed on the points with
    ``fit``, the others scored under that motion."""
    return structure_scores(points, group, fit).select(group, "n_fit", "n_scored", "fit_rmsd", "transfer_rmsd", "reason")


def truth_deviation(points: DataFrame, group: str, limit: float = 5.0, least: int = 3) -> DataFrame:
    """(group, n, deviation, swapped): RMSD of one truth on the other; beyond the limit the reference
    was swapped. Fewer than ``least`` points give no value."""
    enough = F.col("n") >= least
    return superpose_rmsd(points, group).select(group, "n", F.when(enough, F.col("rmsd")).alias("deviation"), F.when(enough, F.col("rmsd") > limit).alias("swapped"))


def twin_copies(points: DataFrame, entity: str, chain: str, kept) -> DataFrame:
    """(kept_chain, twin, dist): chains of one entity with as many atoms as a kept one, that are not
    kept, and the distance of their centroids."""
    c = points.groupBy(entity, chain).agg(F.count("*").alias("n"), *[F.avg(a).alias(a) for a in "xyz"])
    a = c.where(kept).select(entity, "n", F.col(chain).alias("kept_chain"), *[F.col(v).alias(f"k{v}") for v in "xyz"])
    b = c.where(~kept).withColumnRenamed(chain, "twin")
    return a.join(b, [entity, "n"]).select("kept_chain", "twin", F.sqrt(sum((F.col(v) - F.col(f"k{v}")) ** 2 for v in "xyz")).alias("dist"))


def pocket_overlap(predicted: DataFrame, observed: DataFrame, record: str, residue: str) -> DataFrame:
    """(record, n_predicted, n_observed, overlap): sizes and common residues of two pockets."""
    both = predicted.select(record, residue, F.lit(1).alias("p"), F.lit(0).alias("o")).union(observed.select(record, residue, F.lit(0), F.lit(1)))
    each = both.groupBy(record, residue).agg(F.max("p").alias("p"), F.max("o").alias("o"))
    return each.groupBy(record).agg(F.sum("p").alias("n_predicted"), F.sum("o").alias("n_observed"), F.sum(F.col("p") * F.col("o")).alias("overlap"))
