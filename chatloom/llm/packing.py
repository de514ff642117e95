"""Texts packed into containers of fixed capacity with little unused space.

Items are packed best-fit within hash partitions; nearly full containers are final. What is left travels up a tree:
underfull containers of several partitions become items of one packing, round by round, until one packing is left.
"""

from __future__ import annotations

import base64
import functools
import os
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.runtime import persisted

CAPACITY = 2048
#: Folder of the public tokenizers' vocabulary files.
TOKENIZERS = os.environ.get("CHATLOOM_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the word pattern that goes with the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ITEMS = 20_000  # items in a packing of the first round, on average
FAN = 8  # packings that are joined into one of the next round
FULL = 0.99  # a container this full is final


@functools.lru_cache(maxsize=4)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("chatloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken", folder: str = TOKENIZERS) -> DataFrame:
    """key, tokens: null texts have none. Strings of special tokens count as ordinary text."""
    path = os.path.join(folder, vocabulary)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoding(path)
        for s in batches:
            yield pd.Series([0 if t is None else len(e.encode_ordinary(t)) for t in s], dtype="int64")

    return docs.select(key, F.pandas_udf(run, "long").asNondeterministic()(F.col(text)).alias("tokens"))


def items_of(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """item, key, piece, start, n: one item per record, or pieces of the capacity and a rest where it is larger."""
    pieces = F.sequence(F.lit(0), F.floor((F.col(size) - 1) / F.lit(capacity)))
    d = sizes.where((F.col(size) > 0) & F.col(key).isNotNull()).select(F.col(key), F.col(size).cast("long").alias("__n"), F.explode(pieces).alias("piece"))
    start = F.col("piece") * F.lit(capacity)
    d = d.select(key, F.col("piece").cast("int").alias("piece"), start.cast("long").alias("start"), F.least(F.lit(capacity).cast("long"), F.col("__n") - start).alias("n"))
    return d.withColumn("item", F.concat_ws("#", F.col(key).cast("string"), F.col("piece")))


def best_fit(items: list[tuple[int, str]], capacity: int) -> list[tuple[int, list[str]]]:
    """(used, names) of containers: each item, largest first, goes where it leaves the least space."""
    free: list[tuple[int, int]] = []  # (space left, container), sorted
    bins: list[tuple[int, list[str]]] = []
    for n, name in sorted(items, key=lambda x: (-x[0], x[1])):
        k = bisect_left(free, (n, -1))
        if k < len(free):
            space, b = free.pop(k)
            bins[b] = (bins[b][0] + n, bins[b][1])
            bins[b][1].append(name)
        else:
            space, b = capacity, len(bins)
            bins.append((n, [name]))
        if space - n > 0:
            insort(free, (space - n, b))
    return bins


def _pack(capacity: int, level: int, keep: int):
    """Packs one group; `open` marks the containers that go up: all half empty ones and the `keep` emptiest others."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        g = int(pdf["g"].iloc[0])
        bins = best_fit(list(zip(pdf["n"].tolist(), pdf["item"].tolist())), capacity)
        under = sorted((used, b) for b, (used, _) in enumerate(bins) if used < FULL * capacity)
        up = {b for k, (used, b) in enumerate(under) if 2 * used <= capacity or k < keep}
        rows = [(name, f"{level}.{g}.{b}", used, b in up, g) for b, (used, names) in enumerate(bins) for name in names]
        return pd.DataFrame(rows, columns=["item", "bin", "used", "open", "g"])

    return run


def pack(sizes: DataFrame, key: str, size: str, capacity: int = CAPACITY, items_per_group: int = ITEMS) -> DataFrame:
    """key, piece, start, tokens, container: each record with a positive size in one container, a larger one in pieces.

    Records of size 0 and null keys or sizes are in none. A repeated key is packed once per row.
    """
    items = items_of(sizes, key, size, capacity)
    # repeated keys get a number so that every item has a name of its own
    items = items.withColumn("copy", F.row_number().over(Window.partitionBy("item").orderBy("n"))).withColumn("item", F.when(F.col("copy") > 1, F.concat_ws("~", "item", "copy")).otherwise(F.col("item"))).drop("copy")
    items = persisted(items, "items")
    groups = max(1, -(-items.count() // items_per_group))
    schema = "item string, bin string, used long, open boolean, g int"
    level = 0
    # one container at most is half empty in each first packing, so no more of the others are ever needed above it
    d = items.select("item", "n", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int").alias("g"))
    d = persisted(d.groupBy("g").applyInPandas(_pack(capacity, level, groups), schema), "packed")
    placed = d.select("item", "bin")
    while groups > 1:
        groups, level = -(-groups // FAN), level + 1
        up = d.where("open").select(F.col("bin").alias("item"), F.col("used").alias("n"), F.floor(F.col("g") / FAN).cast("int").alias("g")).distinct()
        d = persisted(up.groupBy("g").applyInPandas(_pack(capacity, level, groups), schema), "packed")
        moved = d.select(F.col("item").alias("bin"), F.col("bin").alias("to"))
        placed = persisted(placed.join(moved, "bin", "left").select("item", F.coalesce("to", "bin").alias("bin")), "placed")
    return items.join(placed, "item").select(key, "piece", "start", F.col("n").alias("tokens"), F.col("bin").alias("container"))
