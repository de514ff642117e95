"""Clusters of similar vectors by density peaks, with blocked neighbour joins.

Density of a record is its number of neighbours within the threshold; each record points to its nearest denser
neighbour; records without one are peaks, and pointers followed to the peaks give labels. Neither densities nor labels
depend on cores, blocks or samples.

Not all pairs are looked at for densities. Around centres found in bounded samples, round by round among the records
still outside until few are left or none can be taken, records within half the threshold angle of a centre form its core, where
any two are neighbours for sure. A record can only have a neighbour in another core if
its own angle to that centre is small enough; only then is it joined with the core, block by block. Records outside
all cores are joined with each other in a grid of blocks. Joins return sums and best neighbours, never pairs.

Records with the same neighbours, who are nobody else than these records, are a closed group: all its pointers end at
its densest record, whichever way they go. Nearest denser neighbours are looked for among the other records only, in
the same joins and in a grid of blocks inside each core.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.splits import roots_of
from chatloom.runtime import persisted

THRESHOLD = 0.75
SAMPLE = 8192  # records read for centres in each round
LEAST_GAIN = 0.02  # rounds of looking for centres go on while they take so much of the records still outside all cores
BLOCK = 4096  # records on a side of a block
CELLS = 1 << 24  # similarities held at once while records are compared with centres
HASH_BITS = 40  # neighbours are summed up by hashes of so many bits, exactly in float64 within a block
DIGITS = 9  # cosines that agree in so many decimals are equally near

_NBR = "id string, cnt long, hsum long"
_UP = "id string, sim double, rank long, parent string"


def usable(vectors: DataFrame, key: str, vec: str, dim: int) -> DataFrame:
    """id, h, v (unit float32 bytes): one row per id with `dim` finite values, not all zero; of several vectors the smallest."""
    v = F.col(vec)
    ok = F.col(key).isNotNull() & v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = ok & F.exists(v, lambda x: x != 0)
    one = vectors.where(ok).groupBy(F.col(key).cast("string").alias("id")).agg(F.min(v).alias("a"))

    def unit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            if len(s) == 0:
                yield pd.Series([], dtype=object)
                continue
            m = np.array(s.tolist(), "float64")
            m /= np.abs(m).max(1, keepdims=True)
            m /= np.linalg.norm(m, axis=1, keepdims=True)
            yield pd.Series([x.tobytes() for x in m.astype("float32")])

    h = F.pmod(F.xxhash64("id"), F.lit(1 << HASH_BITS))
    return one.select("id", h.alias("h"), F.pandas_udf(unit, "binary")(F.col("a")).alias("v"))


def matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "float32").reshape(len(column), -1) if len(column) else np.zeros((0, 1), "float32")


def close(a: np.ndarray, b: np.ndarray, tau: float) -> tuple[np.ndarray, np.ndarray]:
    """(similarities, whether they reach tau), those next to tau worked out again in double precision."""
    s = a @ b.T
    m = s >= tau
    i, j = np.nonzero(np.abs(s - tau) < 1e-5)
    if len(i):
        x, y = a[i].astype("float64"), b[j].astype("float64")
        m[i, j] = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1)) >= tau - 1e-9
    return s, m


def centres_of(sample: np.ndarray, tau: float, support: int = 3) -> np.ndarray:
    """Centres of a sample: means of the records near leaders, kept where enough records lie in their core."""
    half, left, out = math.cos(math.acos(tau) / 2), np.ones(len(sample), bool), []
    near_by = np.concatenate([(sample[k : k + 1024] @ sample.T >= tau).sum(1) for k in range(0, len(sample), 1024)]) if len(sample) else []
    for i in np.argsort(-near_by, kind="stable") if len(sample) else []:
        if not left[i]:
            continue
        c = sample[i]
        for _ in range(3):
            near = sample[(sample @ c >= half)]
            if len(near):
                c = near.mean(0)
                c /= np.linalg.norm(c)
        core = sample @ c >= half
        left[i] = False
        if (core & left).sum() + 1 >= support:
            left &= ~core
            out.append(c)
    return np.array(out, "float32").reshape(-1, sample.shape[1]) if out else np.zeros((0, sample.shape[1] if sample.size else 1), "float32")


def find_centres(rows: DataFrame, tau: float, sample: int) -> np.ndarray:
    """Centres of all rounds; every round but the last takes LEAST_GAIN of the records left, so their number follows that of the clusters."""
    half, centres, left, n = math.cos(math.acos(tau) / 2), [], rows, rows.count()
    while n:
        # the sample are the records of the smallest hashes; only a share of the records in which they lie is ordered
        few = left if n <= 4 * sample else left.where(F.col("h") < F.lit(int((1 << HASH_BITS) * 2.0 * sample / n)))
        m = matrix(pd.Series([bytes(r[0]) for r in few.orderBy("h", "id").select("v").limit(sample).collect()]))
        found = centres_of(m, tau) if len(m) else np.zeros((0, 1), "float32")
        if not len(found):
            break
        centres.append(found)
        sent = rows.sparkSession.sparkContext.broadcast(found)
        left = persisted(left.where(F.pandas_udf(_outside(sent, half), "boolean").asNondeterministic()(F.col("v"))), "outside")
        before, n = n, left.count()
        if n <= BLOCK or before - n < LEAST_GAIN * before:
            break
    return np.concatenate(centres) if centres else np.zeros((0, 1), "float32")


def _outside(sent, half: float):
    def outside(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            c, v = sent.value, matrix(s)
            step = max(1, CELLS // len(c))
            yield pd.Series(np.concatenate([(v[k : k + step] @ c.T).max(1) < half for k in range(0, len(v), step)]) if len(v) else np.zeros(0, bool))

    return outside


def placed(rows: DataFrame, centres: np.ndarray, tau: float) -> DataFrame:
    """rows with core (number of the centre or -1) and visits (other centres in whose cores a neighbour may lie)."""
    sent = rows.sparkSession.sparkContext.broadcast(centres)
    angle = math.acos(tau)
    half, reach = math.cos(angle / 2), math.cos(min(math.pi, 1.5 * angle)) - 1e-6

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = sent.value
        for s in batches:
            if not len(s) or not len(c):
                yield pd.DataFrame({"core": np.full(len(s), -1, "int32"), "visits": [[] for _ in range(len(s))]})
                continue
            v, cores, visits = matrix(s), [], []
            step = max(1, CELLS // len(c))
            for k in range(0, len(v), step):
                sim = v[k : k + step] @ c.T
                core = np.where(sim.max(1) >= half + 1e-6, sim.argmax(1), -1).astype("int32")
                go = sim >= reach
                # two cores are joined from the side with the higher number only; the rest visits every core in reach
                for i in np.flatnonzero(core >= 0):
                    go[i, core[i] :] = False
                cores.append(core)
                visits += [np.flatnonzero(g).astype("int32") for g in go]
            yield pd.DataFrame({"core": np.concatenate(cores), "visits": visits})

    return rows.withColumn("p", F.pandas_udf(run, "core int, visits array<int>")(F.col("v"))).select("id", "h", "v", "p.core", "p.visits")


def _grids(p: DataFrame, sizes: dict[int, int], extra: list[str], inside: bool = False) -> tuple[DataFrame, DataFrame]:
    """Left and right sides of all block joins, with unit (g, i, j): visitors against cores, the rest against itself.

    With `inside`, each core against itself as well; such a grid has g below -1, that of the rest -1.
    """
    cols = ["id", "h", "v", *extra]
    spark = p.sparkSession
    blocks = {g: max(1, -(-n // BLOCK)) for g, n in sizes.items()}
    n = spark.createDataFrame([(g, b) for g, b in blocks.items()], "g int, nb int")
    visitors = p.select(*cols, F.explode("visits").alias("g"))
    per = visitors.groupBy("g").agg(F.count(F.lit(1)).alias("nv")).collect()  # one row per centre
    nv = spark.createDataFrame([(r["g"], max(1, -(-r["nv"] // BLOCK))) for r in per], "g int, nvb int")
    dims = F.broadcast(n.join(nv, "g"))  # one row per centre
    block = lambda k: F.pmod(F.xxhash64(F.lit(7), "id"), F.col(k)).cast("int")
    right = p.where("core >= 0").select(*cols, F.col("core").alias("g")).join(dims, "g")
    right = right.withColumn("j", block("nb")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nvb") - 1)))
    left = visitors.join(dims, "g").withColumn("i", block("nvb")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    same = p if inside else p.where("core < 0")
    same = same.join(F.broadcast(n), F.col("core") == F.col("g")).select(*cols, (F.lit(-2) - F.col("core")).alias("g"), "nb", block("nb").alias("b"))
    rl = same.withColumn("i", F.col("b")).withColumn("j", F.explode(F.sequence(F.col("b"), F.col("nb") - 1)))
    rr = same.withColumn("j", F.col("b")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("b"))))
    keep = [*cols, "g", "i", "j"]
    fresh = [F.col(c).alias(c) for c in keep]  # both sides come from one table; a cogroup needs columns of their own
    return left.select(*keep).unionByName(rl.select(*keep)).select(*fresh), right.select(*keep).unionByName(rr.select(*keep)).select(*fresh)


def _counts(tau: float):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "cnt": [], "hsum": []}).astype({"id": object, "cnt": "int64", "hsum": "int64"})
        diagonal = left["g"].iloc[0] < 0 and left["i"].iloc[0] == left["j"].iloc[0]
        a, b, ha, hb = matrix(left["v"]), matrix(right["v"]), left["h"].to_numpy("float64"), right["h"].to_numpy("float64")
        la, lb = left["id"].to_numpy(), right["id"].to_numpy()
        ca, sa, cb, sb = np.zeros(len(a), "int64"), np.zeros(len(a), "int64"), np.zeros(len(b), "int64"), np.zeros(len(b), "int64")
        for k in range(0, len(a), 1024):
            _, m = close(a[k : k + 1024], b, tau)
            if diagonal:  # a block against itself shows each pair from both sides: count the left one only
                m &= la[k : k + 1024, None] != lb[None, :]
            f = m.astype("float64")
            ca[k : k + 1024], sa[k : k + 1024] = m.sum(1), (f @ hb).astype("int64")
            if not diagonal:
                cb += m.sum(0)
                sb += (ha[k : k + 1024] @ f).astype("int64")
        out = pd.DataFrame({"id": np.concatenate([la, lb]), "cnt": np.concatenate([ca, cb]), "hsum": np.concatenate([sa, sb])})
        return out[out["cnt"] > 0]

    return run


def _denser(tau: float):
    """Nearest denser neighbour of each record on either side of a block join; of equally near ones the densest."""

    def unit(side: pd.DataFrame) -> np.ndarray:
        m = matrix(side["v"]).astype("float64")
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"id": [], "sim": [], "rank": [], "parent": []}).astype({"id": object, "sim": "float64", "rank": "int64", "parent": object})
        if not len(left) or not len(right):
            return none
        # the densest come first on both sides, so the first of equal cosines is the densest; equal ranks go by id
        place = {x: k for k, x in enumerate(sorted({*zip(left["rank"], left["id"]), *zip(right["rank"], right["id"])}))}
        left, right = (x.assign(place=[place[y] for y in zip(x["rank"], x["id"])]).sort_values("place", ascending=False) for x in (left, right))
        pa, pb = left["place"].to_numpy(), right["place"].to_numpy()
        a, b, ra, rb = unit(left), unit(right), left["rank"].to_numpy("int64"), right["rank"].to_numpy("int64")
        la, lb = left["id"].to_numpy(), right["id"].to_numpy()
        parts, best, who = [], np.full(len(b), -2.0), np.zeros(len(b), int)
        for k in range(0, len(a), 1024):
            s, m = close(a[k : k + 1024], b, tau)
            s = np.where(m, s.round(DIGITS), -2.0)
            up = np.where(pb[None, :] > pa[k : k + 1024, None], s, -2.0)
            j = up.argmax(1)
            v = up[np.arange(len(j)), j]
            parts.append(pd.DataFrame({"id": la[k : k + 1024], "sim": v, "rank": rb[j], "parent": lb[j]})[v > -2])
            down = np.where(pb[None, :] < pa[k : k + 1024, None], s, -2.0)
            i = down.argmax(0)
            v = down[i, np.arange(len(i))]
            better = v > best
            best, who = np.where(better, v, best), np.where(better, i + k, who)
        hit = best > -2
        parts.append(pd.DataFrame({"id": lb[hit], "sim": best[hit], "rank": ra[who[hit]], "parent": la[who[hit]]}))
        parts = [x for x in parts if len(x)]
        return pd.concat(parts) if parts else none

    return run


def density_peaks(vectors: DataFrame, key: str = "pair_id", vec: str = "vectors", dim: int = 64, tau: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """id, v, density, hsum, h, peak: one row per usable record.

    density counts the record itself and its neighbours of cosine tau or more, hsum sums up their hashes, so records
    with equal hsum have the same neighbours; peak is the id of the record's density peak. Null, wrongly sized, zero
    and not finite vectors are left out; a repeated id counts once. Ties in density are broken by a hash of the id, then
    by the id; of several nearest denser neighbours the densest counts.
    """
    spark = vectors.sparkSession
    rows = persisted(usable(vectors, key, vec, dim), "unit-vectors")
    p = persisted(placed(rows, find_centres(rows, tau, sample), tau), "placed")
    cores = p.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("hs"))  # one row per centre
    cores = {r["core"]: (r["n"], r["hs"]) for r in cores.collect()}
    sizes = {g: n for g, (n, _) in cores.items()}
    sums = F.broadcast(spark.createDataFrame([(g, n, h) for g, (n, h) in cores.items() if g >= 0], "core int, cnt long, hsum long"))
    unit = lambda d: d.groupBy("g", "i", "j")
    left, right = _grids(p, sizes, [])
    far = unit(left).cogroup(unit(right)).applyInPandas(_counts(tau), _NBR)
    own = p.join(sums, "core").select("id", "cnt", "hsum").unionByName(p.where("core < 0").select("id", F.lit(1).cast("long").alias("cnt"), F.col("h").alias("hsum")))
    dens = own.unionByName(far).groupBy("id").agg(F.sum("cnt").alias("density"), F.sum("hsum").alias("hsum"))
    rank = F.col("density") * F.lit(1 << HASH_BITS) + F.lit((1 << HASH_BITS) - 1) - F.col("h")
    d = persisted(p.join(dens, "id").withColumn("rank", rank), "density")

    alone = F.col("density") == 1
    closed = d.where(~alone).groupBy("density", "hsum").agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("hs"), F.max(F.struct("rank", "id")).alias("t"))
    closed = persisted(closed.where((F.col("n") == F.col("density")) & (F.col("hs") == F.col("hsum"))).select("density", "hsum", F.col("t.id").alias("parent")), "closed")
    ends = d.select("id", "density", "hsum").join(closed, ["density", "hsum"]).select("id", "parent")
    o = persisted(d.where(~alone).join(closed, ["density", "hsum"], "left_anti").select("id", "h", "v", "core", "visits", "rank"), "open")
    sizes = {r["core"]: r["count"] for r in o.groupBy("core").count().collect()}  # one row per centre
    left, right = _grids(o, sizes, ["rank"], inside=True)
    up = unit(left).cogroup(unit(right)).applyInPandas(_denser(tau), _UP)
    best = up.groupBy("id").agg(F.max(F.struct("sim", "rank", "parent")).alias("m")).select("id", F.col("m.parent").alias("parent")).unionByName(ends)
    pointers = d.select("id").join(best, "id", "left").select(F.col("id").alias("node"), F.coalesce("parent", "id").alias("parent"))
    labels = roots_of(persisted(pointers, "denser")).select(F.col("node").alias("id"), F.col("parent").alias("peak"))
    return d.select("id", "v", "density", "hsum", "h").join(labels, "id")


def exact_groups(peaks: DataFrame, least: int = 5) -> DataFrame:
    """(first_id, id) of clusters of at least `least` records that are all neighbours of each other and of nobody else."""
    g = peaks.groupBy("peak").agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("hs"), F.min("id").alias("first_id"), F.min("density").alias("d0"), F.max("density").alias("d1"), F.min("hsum").alias("s0"), F.max("hsum").alias("s1"))
    g = g.where((F.col("n") >= least) & (F.col("d0") == F.col("n")) & (F.col("d1") == F.col("n")) & (F.col("s0") == F.col("hs")) & (F.col("s1") == F.col("hs")))
    return peaks.select("id", "peak").join(g.select("peak", "first_id"), "peak").select("first_id", "id")


def cluster_members(peaks: DataFrame, dim: int = 64) -> DataFrame:
    """cluster_id, id, similarity_to_centroid, size: every record with its cluster, named by its smallest id."""
    unpack = F.pandas_udf(lambda s: pd.Series([x.tolist() for x in matrix(s).astype("float64")] if len(s) else [], dtype=object), "array<double>")
    v = persisted(peaks.select("id", "peak", unpack(F.col("v")).alias("a")), "members")
    means = v.groupBy("peak").agg(F.min("id").alias("cluster_id"), F.count(F.lit(1)).alias("size"), *[F.avg(F.col("a")[i]).alias(f"m{i}") for i in range(dim)])
    means = means.select("peak", "cluster_id", "size", F.array(*[f"m{i}" for i in range(dim)]).alias("m"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, t: s + t)
    j = v.join(means, "peak")
    sim = dot(F.col("a"), F.col("m")) / F.sqrt(dot(F.col("m"), F.col("m")))
    return j.select("cluster_id", "id", F.coalesce(sim, F.lit(0.0)).alias("similarity_to_centroid"), "size")


def described(members: DataFrame, top: int = 3, lanes: int = 64) -> DataFrame:
    """cluster_id, size, typical: the `top` most typical members of each cluster with their similarity."""
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("s")).alias("o"), "id"))), 1, top)
    m = members.select("cluster_id", "size", "id", F.round("similarity_to_centroid", 6).alias("s"))
    # bounded lists: the best of each lane, then the best of these
    w = Window.partitionBy("cluster_id", "lane").orderBy(F.desc("s"), "id")
    few = m.withColumn("lane", F.pmod(F.xxhash64("id"), F.lit(lanes))).withColumn("r", F.row_number().over(w)).where(F.col("r") <= top)
    g = few.groupBy("cluster_id", "size").agg(best.alias("b"))
    return g.select("cluster_id", "size", F.transform("b", lambda x: F.struct(x["id"].alias("id"), (-x["o"]).alias("similarity"))).alias("typical"))
