import numpy as np

from chatloom.llm import clusters
from chatloom.llm.clusters import cluster_members, density_peaks, described, exact_groups
from tests.conftest import rows


def data(seed=0, groups=(40, 12, 5, 4), noise=60, spread=0.25):
    r = np.random.default_rng(seed)
    out = []
    for g, n in enumerate(groups):
        c = r.normal(size=64)
        c /= np.linalg.norm(c)
        out += [(f"g{g}_{k:03d}", ((c + spread * r.normal(size=64) / 8) * r.uniform(0.5, 3)).astype("float32").tolist()) for k in range(n)]
    out += [(f"n_{k:03d}", r.normal(size=64).astype("float32").tolist()) for k in range(noise)]
    # a chain that is no group, and unusable rows
    a, b = np.eye(64)[0], np.eye(64)[1]
    out += [(f"chain_{k}", (np.cos(k * 0.5) * a + np.sin(k * 0.5) * b).tolist()) for k in range(6)]
    out += [("bad_null", None), ("bad_size", [1.0] * 16), ("bad_zero", [0.0] * 64), ("bad_nan", [float("nan")] * 64), ("bad_inf", [float("inf")] * 64), (None, [1.0] * 64)]
    return out + out[:10]


def brute(d, tau=0.75):
    v = {}
    for k, x in d:
        if k and x and len(x) == 64 and np.isfinite(x).all() and np.any(x):
            v[k] = np.array(np.array(x, "float32"), "float64") / np.linalg.norm(np.array(x, "float32").astype("float64"))
    ks = sorted(v)
    m = np.array([v[k] for k in ks])
    a = m @ m.T >= tau
    same = {}
    for i in range(len(ks)):
        same.setdefault(a[i].tobytes(), []).append(i)
    groups = sorted((ks[g[0]], ks[i]) for g in same.values() if len(g) >= 5 and a[g[0]].sum() == len(g) for i in g)
    return groups, {k: int(a[i].sum()) for i, k in enumerate(ks)}


def test_against_brute_force(spark):
    for seed, sample in ((0, 4096), (1, 30), (2, 5)):  # small samples leave groups to the grid of blocks
        d = data(seed)
        p = density_peaks(spark.createDataFrame(d, "pair_id string, vectors array<float>"), sample=sample)
        groups, density = brute(d)
        assert rows(exact_groups(p)) == groups and groups
        assert {r["id"]: r["density"] for r in p.collect()} == density


def test_description_and_empty(spark):
    df = spark.createDataFrame(data(), "pair_id string, vectors array<float>")
    p = density_peaks(df)
    m = cluster_members(p)
    assert m.count() == p.count()
    top = {r["size"]: r["typical"] for r in described(m).collect()}
    assert len(top[40]) == 3 and top[40][0]["similarity"] >= top[40][2]["similarity"] > 0.9
    assert density_peaks(df.limit(0)).count() == 0


def spread_out(seed=5, n=1500):
    """Records all over a sphere of three dimensions, so that cores touch everywhere, and repeated vectors."""
    r = np.random.default_rng(seed)
    out = [(f"s_{k:04d}", (r.normal(size=3) @ np.eye(64)[:3]).astype("float32").tolist()) for k in range(n)]
    return out + [(f"twin_{k}", v) for k, (_, v) in enumerate(out[:40])]


def brute_peaks(d, h, tau=0.75):
    """Peak of each id by the nearest denser neighbour among all pairs; of equally near ones the densest."""
    ks = sorted(k for k, _ in d)
    v = dict(d)
    m = np.array([v[k] for k in ks], "float64")
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    s = (m @ m.T).round(9)
    n = (s >= tau).sum(1)
    rank = [(int(n[i]), -h[k], k) for i, k in enumerate(ks)]
    parent = []
    for i in range(len(ks)):
        up = [(s[i, j], rank[j], j) for j in np.flatnonzero(s[i] >= tau) if rank[j] > rank[i]]
        parent.append(max(up)[2] if up else i)
    for _ in ks:
        parent = [parent[j] for j in parent]
    return {k: ks[parent[i]] for i, k in enumerate(ks)}


def test_labels_do_not_depend_on_blocks(spark, monkeypatch):
    d = spread_out()
    df = spark.createDataFrame(d, "pair_id string, vectors array<float>")
    for block, sample in ((4096, 4096), (16, 4096)):
        monkeypatch.setattr(clusters, "BLOCK", block)
        p = density_peaks(df, sample=sample).collect()
        want = brute_peaks(d, {r["id"]: r["h"] for r in p})
        assert len(set(want.values())) > 1
        assert {r["id"]: r["peak"] for r in p} == want, (block, sample)
