"""Embedding near-duplicates: hyperplane sign hashing, exact cosine, components.

Equal vectors form a class; one representative stands for the class. Each
representative gets the signs of random hyperplanes as its bucket in each of
several tables. Bucket mates are compared by exact cosine in double precision,
in blocks of bounded size: a bucket of any size is dealt into blocks, and every
pair of its blocks is compared. A pair is counted in the first table it shares
only. Tasks return link counts and a spanning forest of the links found,
never the pairs, so a dense group of n vectors gives O(n) rows per block pair.

Bits grow with the logarithm of the number of vectors and tables with the
bits, so that buckets keep their size and a pair at the threshold is missed
with a chance of ``MISS`` at most.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite
components link with nothing and are their own component; vectors of
different lengths do not link; an empty table gives no rows; a repeated
vec_id is one row per input row, all rows of the id in one component. Rows
with a NULL vec_id are returned with NULL component and no links.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import components, stored

THRESHOLD = 0.9
MISS = 1e-4
BUCKET_ROWS = 256
BLOCK = 1024
LINKED = "rep long, n_links long, a long, b long"


def shape(vectors: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for a number of vectors."""
    bits = max(6, math.ceil(math.log2(max(vectors, 2) / BUCKET_ROWS)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - same))


def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    """The hyperplanes for vectors of ``dim`` components: a fixed function of the numbers given."""
    return np.random.default_rng([dim, bits, tables]).standard_normal((dim, bits * tables))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that squares of very large or small components stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashed(reps: DataFrame, bits: int, tables: int) -> DataFrame:
    def run(frames):
        weights = 1 << np.arange(bits, dtype=np.int64) if bits < 63 else None
        for frame in frames:
            for dim, part in frame.groupby(frame["v"].map(len)):
                x = _unit(_matrix(part["v"]))
                signs = (x @ planes(dim, bits, tables) >= 0).reshape(len(x), tables, bits)
                yield pd.DataFrame({"rep": part["rep"].to_numpy(), "n": part["n"].to_numpy(), "v": part["v"].to_numpy(),
                                    "codes": list(signs @ weights)})

    kind = reps.schema["v"].dataType.simpleString()
    return reps.mapInPandas(run, f"rep long, n long, v {kind}, codes array<long>")


def _forest(a: np.ndarray, b: np.ndarray, reps: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links (a[i], b[i]), as representative ids."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for i, j in zip(reps[a].tolist(), reps[b].tolist()):
        ti, tj = top(i), top(j)
        if ti != tj:
            parent[max(ti, tj)] = min(ti, tj)
            edges.append((i, j))
    return edges


def _compare(threshold: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        table = int(frame["t"].iloc[0])
        left, right = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        frame = frame.sort_values("rep", kind="stable")
        x = _unit(_matrix(frame["v"]))
        codes = np.array(frame["codes"].tolist(), np.int64)
        reps, times, blocks = (frame[c].to_numpy() for c in ("rep", "n", "block"))
        rows, cols = np.flatnonzero(blocks == left), np.flatnonzero(blocks == right)
        # close to the threshold, sums in another order could differ: the row-wise sum decides
        a, b = np.nonzero(x[rows] @ x[cols].T >= threshold - 1e-9)
        a, b = rows[a], cols[b]
        keep = (a < b) if left == right else np.ones(len(a), bool)
        a, b = a[keep], b[keep]
        exact = np.concatenate([(x[a[s: s + 100_000]] * x[b[s: s + 100_000]]).sum(axis=1) >= threshold
                                for s in range(0, len(a), 100_000)]) if len(a) else np.empty(0, bool)
        a, b = a[exact], b[exact]
        if table:
            first = np.concatenate([~(codes[a[s: s + 100_000], :table] == codes[b[s: s + 100_000], :table]).any(axis=1)
                                    for s in range(0, len(a), 100_000)]) if len(a) else np.empty(0, bool)
            a, b = a[first], b[first]
        links = np.bincount(a, times[b], len(x)) + np.bincount(b, times[a], len(x))
        found = np.flatnonzero(links)
        edges = _forest(a, b, reps)
        return pd.DataFrame({
            "rep": pd.array(reps[found].tolist() + [None] * len(edges), "Int64"),
            "n_links": pd.array(links[found].astype(np.int64).tolist() + [0] * len(edges), "Int64"),
            "a": pd.array([None] * len(found) + [e[0] for e in edges], "Int64"),
            "b": pd.array([None] * len(found) + [e[1] for e in edges], "Int64")})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """(vec_id, embedding) to (vec_id, n_links, component_id, kept)."""
    # float components stay floats until a task computes with them: half the bytes to move
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = F.col("vec_id").isNotNull() & finite & F.exists("v", lambda c: c != 0)
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    # -0.0 and 0.0 are equal components
    plain = F.transform("v", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c)).cast(kind)
    members = rows.where("ok").select("vec_id", plain.alias("v"))
    member_keys = members.select("vec_id", F.xxhash64("v").alias("h"), F.md5(F.to_json("v")).alias("m"))
    classes = stored(members.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
                     .select("rep", "n", "v", F.xxhash64("v").alias("h"), F.md5(F.to_json("v")).alias("m")), "vector-classes")
    bits, tables = shape(classes.count(), threshold, miss)
    hashed = stored(_hashed(classes.select("rep", "n", "v"), bits, tables), "vector-codes")
    entries = hashed.select("rep", F.size("v").alias("dim"), F.posexplode("codes").alias("t", "code"))
    full = entries.groupBy("dim", "t", "code").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    homes = (entries.join(full, ["dim", "t", "code"])
             .select("rep", "dim", "t", "code", blocks.alias("blocks"), F.pmod(F.xxhash64("rep", "t"), blocks).cast("int").alias("block")))
    # every row goes to the pairs of blocks that hold its own
    pair = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (homes.select("rep", "dim", "t", "code", "block", pair.alias("other"))
             .select("rep", "dim", "t", "code", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
             .join(hashed, "rep"))
    found = stored(dealt.groupBy("dim", "t", "code", "i", "j").applyInPandas(_compare(threshold), LINKED), "vector-links")
    links = found.where("rep is not null").groupBy("rep").agg(F.sum("n_links").alias("links"))
    # links of one id's rows: an id repeated with several vectors connects their classes
    per_class = classes.select("rep", "n", "h", "m").join(links, "rep", "left")
    joined = stored(member_keys.join(per_class, ["h", "m"]).select(
        "vec_id", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "vector-members")
    edges = (found.where("a is not null").select("a", "b")
             .unionByName(joined.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))))
    label = components(edges, "vector-components")
    out = (joined.join(label.withColumnRenamed("node", "vec_id"), "vec_id", "left")
           .select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id")))
    rest = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (out.unionByName(rest)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings`` at cosine 0.9."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
