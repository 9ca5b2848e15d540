"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsledger.llm.tables import Scratch

SEGMENT = 16
"""Bits of a segment. 65,536 values keep a bucket at a few rows for up to some
ten million codes and let one list name every mask of a radius."""


def segments_of(vector: Column, bits: int) -> list[Column]:
    """Sign code of a vector as ints of 16 bits; bit i is set if component i is above 0."""
    out = []
    for at in range(0, bits, SEGMENT):
        ones = [
            F.when(F.get(vector, F.lit(at + i)) > 0, 1 << i).otherwise(0) for i in range(SEGMENT)
        ]
        out.append(reduce(lambda a, b: a + b, ones).cast("int"))
    return out


def _masks(radius: int) -> list[int]:
    """All segment values with so many bits set."""
    return [sum(1 << i for i in bits) for bits in combinations(range(SEGMENT), radius)]


def _far(a: list[str], b: list[str]) -> list[Column]:
    return [F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b, strict=True)]


def _first_k(rows: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The k first rows of each group; a task passes on k rows of a group at most."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    bits: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, distance): the k rows of ``vectors`` nearest to each query, exactly.

    Order is by Hamming distance of the sign codes, then id. The code is cut
    into m segments of 16 bits, and each round looks up, in every segment, the values at
    distance r from the query's. A code within distance m(r+1)-1 of a query
    has a segment within r of it, so once a query's kth distance is no more than
    that it is done; others go on with r+1. A code found is compared in whole, in the join, and comes out only in
    the round and segment that find it first and only if it beats the kth row so far.

    Equal codes are one code with its k smallest ids, equal query codes one
    query; so thousands of copies are no hot bucket, and ties are exact. Rows
    with a null id or vector are neither searched nor found; a null or missing
    component gives bit 0. Fewer than k rows give fewer results. A repeated row
    is found as often as it is there. Input columns besides id and vector are not used.
    """
    if bits % SEGMENT:
        raise ValueError(f"bits must be a multiple of {SEGMENT}")
    m = bits // SEGMENT
    q, c = [f"q{i}" for i in range(m)], [f"c{i}" for i in range(m)]
    scratch = Scratch(vectors.sparkSession, "hamming")

    def coded(df: DataFrame, names: list[str]) -> DataFrame:
        found = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
        cols = [x.alias(n) for x, n in zip(segments_of(F.col(vector_col), bits), names, strict=True)]
        return found.select(F.col(id_col).alias("id"), *cols)

    all_codes = coded(vectors, c)
    codes = scratch.keep(
        _first_k(all_codes, c, ["id"], k).groupBy(*c).agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "codes",
    )
    rows = codes.select(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    asked = scratch.keep(coded(queries, q).withColumnRenamed("id", "query_id"), "queries")
    index = codes.select(
        F.posexplode(F.array(*c)).alias("_segment", "_value"), *c, "ids"
    )
    still = asked.select(*q).distinct().withColumn("_worst", F.lit(bits + 1)).withColumn("_last", F.lit(0).cast("bigint"))
    best = None
    for r in range(SEGMENT + 1):
        masks = F.split(F.lit(",".join(map(str, _masks(r)))), ",").cast("array<int>")
        # Dealt out before each row becomes thousands.
        probes = still.select(
            *q, "_worst", "_last", F.posexplode(F.array(*q)).alias("segment", "_own")
        ).repartition(*q, "segment").select(
            *q, "_worst", "_last", "segment",
            F.explode(F.transform(masks, lambda x: F.col("_own").bitwiseXOR(x))).alias("value"),
        )
        each = _far(q, c)
        distance = reduce(lambda a, b: a + b, each)
        # Found first here: no segment is nearer, and none before this one is as near.
        first = reduce(
            lambda a, b: a & b,
            [(d > r) | ((d == r) & (F.lit(i) >= F.col("segment"))) for i, d in enumerate(each)],
        )
        beats = (distance < F.col("_worst")) | (
            (distance == F.col("_worst")) & (F.get("ids", F.lit(0)) <= F.col("_last"))
        )
        hit = (F.col("segment") == F.col("_segment")) & (F.col("value") == F.col("_value"))
        # A query has thousands of probes, which Spark does not foresee: they must not be broadcast.
        found = probes.hint("merge").join(index, hit & first & beats)
        found = found.select(*q, distance.alias("distance"), F.explode("ids").alias("id"))
        if best is not None:
            found = found.unionByName(best.select(*q, "distance", "id"))
        best = scratch.keep(_first_k(found, q, ["distance", "id"], k), f"best-{r}")
        if r:
            scratch.drop(f"best-{r - 1}")
        kth = best.groupBy(*q).agg(
            F.count("*").alias("_n"), F.max(F.struct("distance", "id")).alias("_kth")
        )
        full = F.col("_n") >= min(k, rows)
        covered = full & (F.col("_kth.distance") <= m * (r + 1) - 1)
        left = (
            still.select(*q).join(kth, q, "left").where(~F.coalesce(covered, F.lit(rows == 0)))
            .select(
                *q,
                F.when(full, F.col("_kth.distance")).otherwise(bits + 1).alias("_worst"),
                F.when(full, F.col("_kth.id")).otherwise(0).alias("_last"),
            )
        )
        still = scratch.keep(left, f"open-{r}")
        if not still.limit(1).count():
            break
    same = [F.col(x) == F.col(f"_{x}") for x in q]
    renamed = asked.select("query_id", *[F.col(x).alias(f"_{x}") for x in q])
    return renamed.join(best, same).select(
        "query_id", F.col("rank").cast("bigint"), F.col("id"), F.col("distance").cast("bigint")
    )
