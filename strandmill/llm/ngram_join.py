"""Exact n-gram Jaccard self-join by filters under several global token orders.

Texts become sets of 5-word shingles. Two sets of Jaccard similarity t or more share a token
among their first n - ceil(t n) + 1 under any one order of all tokens. The first order puts rare
shingles first and gives longer prefixes; a second, by how many prefixes hold a token, cuts them
again and gives candidates; prefixes under two hash orders, stored beside the sets, must agree,
too, before a pair's sets are joined and compared. Parity sketches prune without loss on the way.
In each candidate group, stars to a few leaders are tried first, round after round as long as they
link anything; only pairs that the resulting components leave apart are then compared one by one,
so large groups of copies cost about their size, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import LOWER, NOT_SPACE, Words, bitset_of, discard, in_bitset, lean, mix, runs, small_batches, stored, text_slices
from .components import components

WIDTH, PERCENT = 5, 80
#: The frequent shingles whose exact place in the rarity order is kept: the bound of what is broadcast.
FREQUENT = 1 << 17
#: Shingles seen less often in a stretch of CHUNK shingles count as rare.
CHUNK, SEEN = 1 << 21, 3
#: Leaders tried for each group of candidates in a round, rounds of stars at most, rounds of
#: peeling, seeds of the further orders.
LEADERS, ROUNDS, PEELS, SEEDS = 4, 4, 2, (0x5851F42D4C957F2D, 0x14057B7EF767814F)
#: Postings of a bucket, about: one task sorts those of a bucket at once.
BUCKET_POSTINGS = 1 << 20
#: The tokens of a set by which its pairs are told apart early: see :func:`_apart`.
LEADING = 8
_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; shorter texts are one shingle, empty ones none."""
    w = Words(LOWER[data], offs, NOT_SPACE)
    h, first = w.hash, w.first
    n = len(h)
    acc = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        acc += h[k : k + len(acc)] * _C[k % 5] + np.uint64(k // 5)
    acc = mix(acc)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(acc[a : b - width + 1]))
        elif b > a:
            out.append(mix((h[a:b] * _C[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(tokens: np.ndarray) -> int:
    """64 bits of a set, as a signed integer."""
    return int(mix(mix(tokens ^ np.uint64(SEEDS[0])).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(tokens))).astype(np.int64)[0])


#: Bits of a set's parity sketch: each token flips one. Two sketches differ in no more places than
#: their sets do, so pairs whose sketches differ in more than a link allows need no comparison.
SKETCH_BITS = 2048
#: The sketch folded to so many 64-bit columns, which candidates are joined with.
FOLDS = 8


def sketch(tokens: np.ndarray) -> bytes:
    flips = np.bincount((tokens >> np.uint64(40)).astype(np.int64) & (SKETCH_BITS - 1), minlength=SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def orders(tokens: np.ndarray, percent: int) -> bytes:
    """The prefixes of a set under the further orders, 32 bits a token, one after the other."""
    k = prefix_length(len(tokens), percent)
    under = [mix(tokens ^ np.uint64(seed)) for seed in SEEDS]
    return b"".join(((u if k >= len(u) else np.partition(u, k - 1)[:k]) >> np.uint64(32)).astype(np.uint32).tobytes() for u in under)


def prefix_length(n, percent: int):
    return n - -(-n * percent // 100) + 1


def long_prefix(n, percent: int):
    """The prefix that is posted: longer by half the tokens a link may lack, so that sets that link
    share not one token of their prefixes but :func:`least_shared` or more."""
    return np.minimum(n, prefix_length(n, percent) + n * (100 - percent) // 200)


def least_shared(n, percent: int):
    """The j-th shared token stands at most n - o places after the j-th of either set, o being the
    overlap a link needs: no less than percent/100 of either set's size. So of a set of n tokens
    long_prefix - (n - o) are shared with any set it links to, under each order."""
    return F.greatest(F.lit(1), F.floor(n * (100 - percent) / 200))


def hot_tokens(stream, chunk: int = CHUNK, seen: int = SEEN):
    """Collects arrays of tokens by ``send``; yields (token, count) arrays of the frequent ones."""
    held, size = [], 0
    for tokens in stream:
        held.append(tokens)
        size += len(tokens)
        if size >= chunk:
            yield _often(held, seen)
            held, size = [], 0
    if held:
        yield _often(held, seen)


def _often(held: list[np.ndarray], seen: int) -> tuple[np.ndarray, np.ndarray]:
    flat = np.sort(np.concatenate(held))
    at = runs(flat)
    n = np.diff(at)
    return flat[at[:-1][n >= seen]], n[n >= seen]


def frequent_order(hot: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """(sorted tokens, their counts) of the ``limit`` most frequent of (token, n)."""
    top = hot.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(limit).toArrow()
    tokens, n = top.column("token").to_numpy().astype(np.int64).view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(tokens)
    return tokens[order], n[order]


def rare_prefix(tokens: np.ndarray, length: int, order: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first ``length`` of sorted ``tokens``: by count in ``order`` (0 if absent), then by hash."""
    if not len(order[0]):
        return tokens[:length]
    at = np.minimum(np.searchsorted(order[0], tokens), len(order[0]) - 1)
    n = np.where(order[0][at] == tokens, order[1][at], 0)
    return tokens[:length] if not n[:length].any() else tokens[np.argsort(n, kind="stable")[:length]]


def _profile(docs: DataFrame, width: int) -> DataFrame:
    """Rows (id, n, fp, hot): one for each text, and (null, count, token, true) for frequent shingles."""

    def read(batches):
        held, size = [], 0

        def often():
            tokens, n = _often(held, SEEN)
            return pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), pa.array(n.astype(np.int64)), pa.array(tokens.view(np.int64)), pa.array(np.ones(len(n), bool))], ["id", "n", "fp", "hot"])

        for batch in batches:
            for lo, hi, data, offs in text_slices(batch):
                sets = shingle_sets(data, offs, width)
                n = np.array([len(s) for s in sets], np.int64)
                fps = np.array([fingerprint(s) for s in sets], np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(fps), pa.array(np.zeros(len(n), bool))], ["id", "n", "fp", "hot"])
                held += sets
                size += int(n.sum())
                if size >= CHUNK:
                    yield often()
                    held, size = [], 0
        if held:
            yield often()

    return docs.mapInArrow(lean(read), "id long, n long, fp long, hot boolean")


def _postings(docs: DataFrame, width: int, percent: int, shared, n_buckets: int) -> DataFrame:
    """(token, fp, n) of every token that prefixes of two or more sets share."""

    def emit(batches):
        order, seen = shared.value, set()
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch):
                toks, fps, ns = [], [], []
                for s in shingle_sets(data, offs, width):
                    if not len(s) or (fp := fingerprint(s)) in seen:
                        continue
                    seen.add(fp)  # a task posts copies once
                    toks.append(rare_prefix(s, int(long_prefix(len(s), percent)), order))
                    fps.append(fp)
                    ns.append(len(s))
                if not toks:
                    continue
                size = np.array([len(t) for t in toks])
                tok = np.concatenate(toks)
                which = np.repeat(np.arange(len(size)), size)
                bucket = (tok % np.uint64(n_buckets)).astype(np.int64)
                at = np.argsort(bucket, kind="stable")
                edge = np.searchsorted(bucket[at], np.arange(n_buckets + 1))
                tok, fp, n = tok[at], np.array(fps)[which[at]], np.array(ns, np.int32)[which[at]]
                rows = [(b, tok[i:j].tobytes(), fp[i:j].tobytes(), n[i:j].tobytes()) for b, (i, j) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if j > i]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], ["bucket", "tok", "fp", "n"])

    def groups(table: pa.Table) -> pa.Table:
        tok, fp, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("tok", np.int64), ("fp", np.int64), ("n", np.int32)))
        at = np.lexsort((fp, tok))
        tok, fp, n = tok[at], fp[at], n[at]
        new = np.ones(len(tok), bool)
        new[1:] = (tok[1:] != tok[:-1]) | (fp[1:] != fp[:-1])
        tok, fp, n = tok[new], fp[new], n[new]
        edge = runs(tok)
        size = np.diff(edge)
        keep = np.repeat(size >= 2, size)
        tok, fp, n = tok[keep], fp[keep], n[keep]
        return pa.table({"token": tok, "fp": fp, "n": n.astype(np.int64)})

    blobs = docs.mapInArrow(lean(emit), "bucket int, tok binary, fp binary, n binary")
    return blobs.groupBy("bucket").applyInArrow(groups, "token long, fp long, n long")


SETS = ["fp", "n", *(f"f{k}" for k in range(FOLDS)), "sketch", "orders", "tokens"]


def _sets(docs: DataFrame, width: int, percent: int, shared) -> DataFrame:
    """The sets whose fingerprint and whose row's id are in the bit sets (and few others), with the
    sketch, its folds and the prefixes under the further orders."""

    def read(batches):
        wanted, firsts = shared.value
        for batch in batches:
            ids = pc.fill_null(batch.column(0), 0).to_numpy()
            for lo, hi, data, offs in text_slices(batch):
                sets = shingle_sets(data, offs, width)
                fps = np.array([fingerprint(s) for s in sets], np.int64)
                keep = np.flatnonzero(in_bitset(wanted, fps) & in_bitset(firsts, ids[lo:hi]) & (np.diff(offs) > 0))
                keep = [k for k in keep.tolist() if len(sets[k])]
                if not keep:
                    continue
                sketches = [sketch(sets[k]) for k in keep]
                folds = np.bitwise_xor.reduce(np.frombuffer(b"".join(sketches), np.int64).reshape(len(keep), -1, FOLDS), 1)
                binary = (sketches, [orders(sets[k], percent) for k in keep], [sets[k].tobytes() for k in keep])
                yield pa.RecordBatch.from_arrays([pa.array(fps[keep]), pa.array([len(sets[k]) for k in keep], pa.int64()), *(pa.array(folds[:, k]) for k in range(FOLDS)), *(pa.array(c, pa.binary()) for c in binary)], SETS)

    # a repeated row gives its set again; pairs are made distinct in the end
    return docs.mapInArrow(lean(read), "fp long, n long, " + ", ".join(f"f{k} long" for k in range(FOLDS)) + ", sketch binary, orders binary, tokens binary")


def _with_both(pairs: DataFrame, sets: DataFrame, *cols: str) -> DataFrame:
    """The pairs (a, b) with ``cols`` of a and, as b_..., of b."""
    a = sets.select(F.col("fp").alias("a"), *cols)
    b = sets.select(F.col("fp").alias("b"), *[F.col(c).alias("b_" + c) for c in cols])
    return pairs.join(a, "a").join(b, "b").select("a", "b", *cols, *["b_" + c for c in cols])


def most_apart(total, percent: int):
    """In how many tokens two sets of ``total`` tokens together may differ and still link."""
    return total - 2 * -(-total * percent // (100 + percent))


def _agree(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs whose sketches differ in no more places than linked sets may, and whose
    prefixes share a token under each further order."""

    def shared(x: bytes, y: bytes) -> bool:
        p, q = np.frombuffer(x, np.uint32).reshape(len(SEEDS), -1), np.frombuffer(y, np.uint32).reshape(len(SEEDS), -1)
        return all(np.isin(u, v).any() for u, v in zip(p, q))

    def compare(batches):
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(len(batch), -1) for k in ("sketch", "b_sketch"))
            m, n = batch.column("n").to_numpy(), batch.column("b_n").to_numpy()
            keep = np.bitwise_count(x ^ y).sum(1, dtype=np.int64) <= most_apart(m + n, percent)
            p, q = batch.column("orders"), batch.column("b_orders")
            for k in np.flatnonzero(keep).tolist():
                keep[k] = shared(p[k].as_py(), q[k].as_py())
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return _with_both(pairs, sets, "n", "sketch", "orders").mapInArrow(lean(compare), "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that share enough tokens."""

    def verify(batches):
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("tokens"), batch.column("b_tokens")):
                x, y = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _with_both(pairs, sets, "tokens").mapInArrow(lean(verify), "a long, b long").distinct()


FOLDED = [f"f{k}" for k in range(FOLDS)]


def _may_link(percent: int):
    """Whether rows x and y of a group are of different components, and what their sizes and folded
    sketches allow."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    total = x("n") + y("n")
    most = total - 2 * F.ceil(total * percent / (100 + percent))
    apart = sum(F.bit_count(x(f).bitwiseXOR(y(f))) for f in FOLDED)
    fits = F.least(x("n"), y("n")) * 100 >= F.greatest(x("n"), y("n")) * percent
    return (x("token") == y("token")) & (x("c") != y("c")) & fits & (apart <= most)


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, n_buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable by links).

    Ids are integers. Null, empty and blank texts have empty sets and are linked with nothing, not
    even each other; texts of fewer words than ``width`` are one shingle. Equal sets are one node,
    so copies cost one row each. Repeated rows share their component; an empty table gives no row.
    Rows without an id link others, but are never the smallest id. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    profile = stored(_profile(rows, width))
    nodes = profile.where("not hot").select("id", "n", "fp")
    if n_buckets is None:
        n_posted = nodes.agg(F.sum(F.col("n") * 3 / 10 + 1)).first()[0] or 0
        n_buckets = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")), int(n_posted) // BUCKET_POSTINGS)
    order = spark.sparkContext.broadcast(frequent_order(profile.where("hot").select(F.col("fp").alias("token"), "n")))
    groups = stored(_postings(rows, width, percent, order, n_buckets))
    for _ in range(PEELS):
        before, groups = groups, stored(_peeled(groups, percent))
        discard(before)
    before, groups = groups, stored(_rarest(groups, percent))
    discard(before)
    sets = stored(_sets(rows, width, percent, spark.sparkContext.broadcast(_wanted(groups, nodes))))
    tested, links, comp = _links_by_stars(groups, sets, percent)
    rest = stored(_agree(_apart(groups, sets, comp, percent).join(tested, ["a", "b"], "left_anti"), sets, percent))
    if not rest.isEmpty():
        comp = stored(components(links.union(_linked(rest, sets, percent))))
    discard(sets)
    member = nodes.join(comp, nodes.fp == comp.node, "left").select("id", "n", F.coalesce("component", "fp").alias("c"))
    least = member.where("n > 0").groupBy("c").agg(F.min("id").alias("component_id"))
    joined = member.where("n > 0").join(least, "c").select("id", "n", "component_id")
    out = joined.union(member.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _wanted(groups: DataFrame, nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bit sets of the fingerprints in ``groups`` and of the least id of each: so copies give one set."""
    fps = groups.select("fp").distinct()
    firsts = nodes.join(fps, "fp", "left_semi").groupBy("fp").agg(F.coalesce(F.min("id"), F.lit(0)).alias("id"))
    return bitset_of(fps, "fp"), bitset_of(firsts, "id")


def _links_by_stars(groups: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs tested, links, components) of rounds of stars over the leading tokens of each set.

    In a round, the sets of each group are tried with its leader, if components do not join them
    yet; leaders are drawn anew. Rounds end when one links nothing. All of it is linear in the
    size of the groups; what stays apart is for :func:`_apart`.
    """
    leading = groups.where("leading").select("token", "fp")
    folded = stored(leading.join(sets.select("fp", "n", *FOLDED).dropDuplicates(["fp"]), "fp"))
    tested = links = comp = None
    for k in range(ROUNDS):
        now = folded.withColumn("c", F.col("fp")) if comp is None else folded.join(comp, folded.fp == comp.node, "left").withColumn("c", F.coalesce("component", "fp")).drop("node", "component")
        draw = F.xxhash64("fp", F.pmod("token", F.lit(LEADERS)), F.lit(k))
        led = now.groupBy("token").agg(F.min_by(F.struct("fp", "n", "c", *FOLDED), draw).alias("l"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("token", "l.*")
        both = now.alias("x").join(led.alias("y"), _may_link(percent))
        pairs = both.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")).distinct()
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        found = stored(_linked(stored(_agree(pairs, sets, percent)), sets, percent))
        tested, links = (pairs, found) if tested is None else (tested.union(pairs), links.union(found))
        if found.isEmpty() and comp is not None:
            break
        comp = stored(components(links))
    discard(folded)
    return tested, links, comp


def _peeled(groups: DataFrame, percent: int) -> DataFrame:
    """Without the sets that share too few prefix tokens with all others together to link to any,
    and then without the tokens that one set alone is left with."""
    enough = groups.groupBy("fp").agg(F.count("*").alias("r"), F.first("n").alias("m")).where(F.col("r") >= least_shared(F.col("m"), percent)).select("fp")
    left = groups.join(enough, "fp", "left_semi")
    shared = left.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    return left.join(shared, "token", "left_semi").select("token", "fp", "n")


def _rarest(groups: DataFrame, percent: int) -> DataFrame:
    """Each set without its least_shared - 1 most common posted tokens, by the exact number of sets
    that post them. Linked sets share least_shared tokens of the larger one or more, so the rarest
    token they share has that many less one above it in either set, and both keep it. The LEADING
    most common that a set keeps are marked."""
    size = groups.groupBy("token").agg(F.count("*").alias("k"))
    common_first = Window.partitionBy("fp").orderBy(F.desc("k"), F.desc("token"))
    nth = groups.join(size, "token").withColumn("nth", F.row_number().over(common_first))
    least = least_shared(F.col("n"), percent)
    return nth.where(F.col("nth") >= least).select("token", "fp", "n", (F.col("nth") < least + LEADING).alias("leading"))


def _apart(groups: DataFrame, sets: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs that the components so far leave apart, sizes and folded sketches allowing. A
    pair that shares leading tokens is taken at the least of these only, not again at each token it
    shares."""
    of = groups.join(comp, groups.fp == comp.node, "left").select("token", "fp", "leading", F.coalesce("component", "fp").alias("c"))
    mixed = of.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("token")
    left = stored(of.join(mixed, "token", "left_semi"))
    leading = groups.where("leading").groupBy("fp").agg(F.sort_array(F.collect_set("token")).alias("lead"))
    here = left.select("fp").distinct().join(sets.select("fp", "n", *FOLDED).dropDuplicates(["fp"]), "fp").join(leading, "fp")
    here = stored(here)

    both = left.select("token", "c", "fp").join(here, "fp")
    first = F.coalesce(F.get(F.array_intersect("x.lead", "y.lead"), F.lit(0)) == F.col("x.token"), F.lit(True))
    pairs = both.alias("x").join(both.alias("y"), (F.col("x.fp") < F.col("y.fp")) & _may_link(percent) & first)
    return pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct()
