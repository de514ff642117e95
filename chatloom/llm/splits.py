"""Train, dev and test splits that keep connected records together.

Records that share a key value are contracted, and the contracted graph is joined into a spanning forest by rounds
in which every component takes its smallest edge. The forest is kept as a table. Roots are grouped by size band and
dealt to the splits, the largest by what each split still lacks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.runtime import persisted

SPLITS = (("train", 0.70), ("dev", 0.15), ("test", 0.15))
#: Components with at least one record in so many are dealt one by one; there are at most so many of them.
HEAVY = 1000
GOLDEN = 0.6180339887498949


def same_id(c: str) -> F.Column:
    """A key value without regard to letter case and outer blanks; blank values count as null."""
    v = F.lower(F.regexp_replace(F.col(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.when(v != "", v)


def keyed(records: DataFrame, keys: list[str]) -> DataFrame:
    """records with __k0, __k1, ... (one per key, prefixed by its number) and __anchor, the first that is not null."""
    out = records
    for i, k in enumerate(keys):
        out = out.withColumn(f"__k{i}", F.concat(F.lit(f"{i}:"), same_id(k)))
    return out.withColumn("__anchor", F.coalesce(*[F.col(f"__k{i}") for i in range(len(keys))]))


def anchor_edges(records: DataFrame, keys: list[str]) -> DataFrame:
    """Edges (a, b), a < b, between anchors that share a key value: a star around the smallest anchor of each value."""
    parts = []
    for i in range(1, len(keys)):
        has = records.where(F.col(f"__k{i}").isNotNull()).select(F.col(f"__k{i}").alias("v"), F.col("__anchor").alias("x")).distinct()
        centre = has.groupBy("v").agg(F.min("x").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(has.join(centre, "v").where("x != a").select("a", F.col("x").alias("b")))
    return reduce(DataFrame.unionByName, parts).distinct()


def roots_of(parents: DataFrame) -> DataFrame:
    """(node, parent) followed to the roots by pointer doubling."""
    p = parents
    while True:
        up = p.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        p = persisted(p.join(up, "parent", "left").select("node", "parent", F.coalesce("up", "parent").alias("up")), "pointers")
        moved = p.where("up != parent").limit(1).count()
        p = p.select("node", F.col("up").alias("parent"))
        if not moved:
            return p


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(forest edges (a, b), roots (node, root)) of edges (a, b) with a < b.

    In each round every component picks its smallest edge in one fixed order, so picks close no circle but the one
    of two components that pick the same edge, where the smaller becomes the parent.
    """
    spark = edges.sparkSession
    edges = persisted(edges, "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    comp = persisted(nodes.select("node", F.col("node").alias("root")), "components")
    forest = spark.createDataFrame([], edges.schema)
    live = edges.select("a", "b", F.col("a").alias("ra"), F.col("b").alias("rb"))
    while live.limit(1).count():
        picks = live.select(F.col("ra").alias("node"), F.struct("a", "b", F.col("rb").alias("to")).alias("e")).union(live.select("rb", F.struct("a", "b", F.col("ra").alias("to"))))
        best = persisted(picks.groupBy("node").agg(F.min("e").alias("e")).select("node", "e.a", "e.b", F.col("e.to").alias("to")), "picks")
        back = best.select(F.col("node").alias("to"), F.col("to").alias("back"))
        hooked = best.join(back, "to").select("node", F.when((F.col("back") == F.col("node")) & (F.col("node") < F.col("to")), F.col("node")).otherwise(F.col("to")).alias("parent"))
        forest = persisted(forest.union(best.select("a", "b").distinct()), "forest")
        r = roots_of(hooked).select(F.col("node").alias("root"), F.col("parent").alias("new"))
        comp = persisted(comp.join(r, "root", "left").select("node", F.coalesce("new", "root").alias("root")), "components")
        c = comp.select("node", "root")
        live = edges.join(c.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(c.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra != rb")
        live = persisted(live.select("a", "b", "ra", "rb"), "live")
    return forest.distinct(), comp


def components(records: DataFrame, keys: list[str]) -> DataFrame:
    """records with `component`: equal for records that share a value of any key, directly or through others.

    Null and blank values link nothing; a record without any value is a component of its own with its number.
    """
    k = keyed(records, keys)
    _, comp = spanning_forest(anchor_edges(k.where(F.col("__anchor").isNotNull()), keys))
    out = k.join(comp.withColumnRenamed("node", "__anchor"), "__anchor", "left").withColumn("component", F.coalesce("root", "__anchor", F.concat(F.lit("~"), F.monotonically_increasing_id().cast("string"))))
    return out.drop("root", "__anchor", *[f"__k{i}" for i in range(len(keys))])


def forest(records: DataFrame, keys: list[str]) -> DataFrame:
    """(a, b, root): the edges of the spanning forest over key values and the root of their tree, one row per edge.

    A value is written as the number of its key and the value itself; a tree of one value has no edge.
    """
    k = keyed(records.select(*keys), keys)
    tree, comp = spanning_forest(anchor_edges(k.where(F.col("__anchor").isNotNull()), keys))
    return tree.join(comp.withColumnRenamed("node", "a"), "a").select("a", "b", "root")


def deal(sizes: DataFrame, splits: tuple[tuple[str, float], ...] = SPLITS, heavy: int = HEAVY, lanes: int = 64) -> tuple[DataFrame, DataFrame]:
    """component, n -> component, n, split, for heavy components and for the others.

    Heavy components go, by size, where most is lacking; the others are dealt systematically inside their size band,
    in the shares that are left.
    """
    spark = sizes.sparkSession
    total = sizes.agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // heavy))
    big = sorted(sizes.where(F.col("n") >= least).collect(), key=lambda r: (-r["n"], r["component"]))
    names = [s for s, _ in splits]
    lack = {s: share * total for s, share in splits}
    rows = []
    for r in big:
        s = max(names, key=lambda x: (lack[x], -names.index(x)))
        lack[s] -= r["n"]
        rows.append((r["component"], int(r["n"]), s))
    dealt = spark.createDataFrame(rows, "component string, n long, split string")
    rest = {s: max(0.0, v) for s, v in lack.items()}
    whole = sum(rest.values()) or 1.0
    lane = F.pmod(F.xxhash64("component"), F.lit(lanes))
    band = F.floor(F.log2(F.col("n")))
    w = Window.partitionBy("band", "lane").orderBy(F.xxhash64(F.lit(1), "component"), "component")
    at = F.row_number().over(w) * F.lit(GOLDEN) + F.col("lane") / F.lit(lanes)
    small = sizes.where(F.col("n") < least).withColumn("band", band).withColumn("lane", lane).withColumn("u", at - F.floor(at))
    edge, choice = 0.0, None
    for s in names[:-1]:
        edge += rest[s] / whole
        choice = F.when(F.col("u") < edge, s) if choice is None else choice.when(F.col("u") < edge, s)
    return dealt, small.select("component", "n", choice.otherwise(names[-1]).alias("split"))


def grouped_split(records: DataFrame, keys: list[str], splits: tuple[tuple[str, float], ...] = SPLITS) -> DataFrame:
    """records with component and split. Columns of these names are replaced; repeated records count as often as they occur."""
    c = persisted(components(records.drop("component", "split"), keys), "split-components")
    big, small = deal(c.groupBy("component").agg(F.count(F.lit(1)).alias("n")), splits)
    # rows of heavy components, of which there are at most HEAVY, meet their split without a shuffle
    d = c.join(F.broadcast(big.select("component", "split")), "component", "left")
    rest = d.where(F.col("split").isNull()).drop("split").join(small.select("component", "split"), "component")
    return d.where(F.col("split").isNotNull()).unionByName(rest)


def value_classes(records: DataFrame, key: str, keys: list[str]) -> DataFrame:
    """(v, c): each value of `key`, as written, with the class of values that must stay together."""
    k = keyed(records.select(*keys), keys)
    _, comp = spanning_forest(anchor_edges(k.where(F.col("__anchor").isNotNull()), keys))
    v = k.where(F.col(key).isNotNull()).select(F.col(key).alias("v"), "__anchor").distinct()
    return v.join(comp.withColumnRenamed("node", "__anchor"), "__anchor", "left").select("v", F.coalesce("root", "__anchor").alias("c")).where("c is not null").distinct()


def linked_values(records: DataFrame, key: str, keys: list[str]) -> DataFrame:
    """(a, b), a < b: different values of `key`, as written, whose records are in one component."""
    v = value_classes(records, key, keys)
    return v.select(F.col("v").alias("a"), "c").join(v.select(F.col("v").alias("b"), "c"), "c").where("a < b").select("a", "b").distinct()
