"""Density of neighbourhoods, dense centres with little overlap, and their rankings."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators import lsh


def approx_density(neighbors: DataFrame) -> DataFrame:
    """id, density: mean similarity to the neighbours other than itself; null without any. Summed as decimals, so in any order alike."""
    other = F.col("a") != F.col("b")
    return neighbors.groupBy(F.col("a").alias("id")).agg(F.round(F.sum(F.when(other, F.col("sim").cast("decimal(18,9)"))).cast("double") / F.nullif(F.sum(other.cast("int")), F.lit(0)), 6).alias("density"))


def shared_neighbors(neighbors: DataFrame) -> DataFrame:
    """a, b, cosine: common neighbours of a and its neighbour b over the root of the product of their numbers."""
    n = neighbors.groupBy("a").agg(F.count("*").alias("n"))
    x = neighbors.select("a", "b")
    common = x.join(x.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").join(x.select("a", F.col("b").alias("c")), ["a", "c"]).groupBy("a", "b").agg(F.count("*").alias("common"))
    sized = x.join(n, "a").join(n.select(F.col("a").alias("b"), F.col("n").alias("m")), "b", "left")
    return sized.join(common, ["a", "b"], "left").select("a", "b", F.round(F.coalesce("common", F.lit(0)) / F.sqrt(F.col("n") * F.coalesce("m", F.lit(1))), 6).alias("cosine"))


def shared_density(neighbors: DataFrame) -> DataFrame:
    """Density in which every similarity is weighted by the shared-neighbour cosine."""
    weighted = neighbors.join(shared_neighbors(neighbors), ["a", "b"]).select("a", "b", (F.col("sim") * F.col("cosine")).alias("sim"))
    return approx_density(weighted)


def smoothed_density(neighbors: DataFrame) -> DataFrame:
    """Mean of the members' densities over each neighbourhood, itself included."""
    d = approx_density(neighbors)
    return neighbors.select("a", "b").join(d.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.round(F.sum(F.col("density").cast("decimal(18,9)")).cast("double") / F.count("density"), 6).alias("density"))


def _sum_of(vectors: DataFrame) -> DataFrame:
    """One row: total, the sum of the vectors (id, vec), by places, as many as the longest has; and their number n."""
    places = vectors.select(F.posexplode("vec").alias("pos", "x")).groupBy("pos").agg(F.sum(F.col("x").cast("double")).alias("x"))
    total = places.agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("p")).select(F.transform("p", lambda e: e["x"]).alias("total"))
    return total.crossJoin(vectors.agg(F.count("*").alias("n")))


def true_density(vectors: DataFrame) -> DataFrame:
    """id, density: mean dot product with all other vectors, which is one product with the sum of all of them."""
    own = lsh.dense_dot(F.col("vec"), F.col("vec"))
    return vectors.crossJoin(F.broadcast(_sum_of(vectors))).select("id", F.round((lsh.dense_dot(F.col("vec"), F.col("total")) - own) / F.nullif(F.col("n") - 1, F.lit(0)), 6).alias("density"))


def similarity_to_set(vectors: DataFrame, members: DataFrame) -> DataFrame:
    """a, avg_sim: mean dot product of each vector with those of the members (id), itself included if it is one."""
    of = _sum_of(vectors.join(members.select("id"), "id", "left_semi")).where("n > 0")
    return vectors.crossJoin(F.broadcast(of)).select(F.col("id").alias("a"), F.round(lsh.dense_dot(F.col("vec"), F.col("total")) / F.col("n"), 6).alias("avg_sim"))


def sampled(ids: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Ids whose seeded hash falls below the fraction: the same ones on every run."""
    return ids.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(fraction * (1 << 30))))


def dense_centers(neighbors: DataFrame, density: DataFrame, most: int, overlap: int, candidates: DataFrame | None = None) -> DataFrame:
    """center_rank, id, density: by falling density (ties: smaller id), an id is taken while at most `overlap` of its
    neighbourhood lies in those already taken; `most` at most.

    The choice is sequential. Rows come to the driver one after another in order of density, each with its neighbourhood
    (of bounded size), and only until `most` centres are found; taken ids are all that is held.
    """
    rows = density.where(F.col("density").isNotNull())
    if candidates is not None:
        rows = rows.join(candidates.select("id"), "id", "left_semi")
    lists = neighbors.groupBy(F.col("a").alias("id")).agg(F.collect_list("b").alias("members"))
    ordered = rows.join(lists, "id").orderBy(F.desc("density"), "id")
    taken: set[int] = set()
    out: list[tuple[int, int, float]] = []
    for row in ordered.toLocalIterator():
        if len(out) >= most:
            break
        if not out or len(taken.intersection(row["members"])) <= overlap:
            taken.update(row["members"])
            out.append((len(out) + 1, row["id"], row["density"]))
    return neighbors.sparkSession.createDataFrame(out, "center_rank int, id long, density double")


class Coverage:
    """Centres with their densities and neighbourhoods: worth() is sum of densities * covered / listed members.

    How many centres list each member is kept, so an exchange costs the two neighbourhoods and nothing else.
    """

    def __init__(self) -> None:
        self.times: Counter[int] = Counter()
        self.total, self.listed = 0.0, 0

    def put(self, density: float, members: frozenset[int], sign: int = 1) -> None:
        for m in members:
            self.times[m] += sign
            if not self.times[m]:
                del self.times[m]
        self.total += sign * density
        self.listed += sign * len(members)

    def worth(self) -> float:
        return self.total * len(self.times) / self.listed if self.listed else 0.0


def refine_centers(centers: DataFrame, neighbors: DataFrame, density: DataFrame, tries: int = 100_000, seed: int = 1) -> DataFrame:
    """Random exchanges of centres for other candidates, kept if they raise sum of densities * covered / listed members.

    The first `tries` ids with a density, in the order of a seeded hash, are offered one after another, each for a
    random centre. They come to the driver a partition at a time with their neighbourhoods (of bounded size); it holds
    the centres' and one candidate's. Equal on every run.
    """
    lists = neighbors.groupBy(F.col("a").alias("id")).agg(F.collect_set("b").alias("m"))
    own = [(r["id"], r["density"], frozenset(r["m"])) for r in centers.join(lists, "id").orderBy("center_rank").collect()]
    cover = Coverage()
    for _, d, m in own:
        cover.put(d, m)
    mix = F.xxhash64("id", F.lit(seed))
    pool = density.where(F.col("density").isNotNull()).join(centers.select("id"), "id", "left_anti").select("id", "density", mix.alias("_mix")).orderBy("_mix", "id").limit(tries)
    rng = random.Random(seed)
    best = cover.worth()
    for row in pool.join(lists, "id").orderBy("_mix", "id").toLocalIterator() if own else []:
        i = rng.randrange(len(own))
        old, new = own[i], (row["id"], row["density"], frozenset(row["m"]))
        cover.put(*old[1:], -1)
        cover.put(*new[1:])
        if (now := cover.worth()) > best:
            best, own[i] = now, new
        else:
            cover.put(*new[1:], -1)
            cover.put(*old[1:])
    return centers.sparkSession.createDataFrame([(k + 1, i, d) for k, (i, d, _) in enumerate(own)], "center_rank int, id long, density double")


def center_rankings(centers: DataFrame, neighbors: DataFrame) -> DataFrame:
    """center_rank, center, rank, id, sim of each centre's neighbours."""
    return centers.select("center_rank", F.col("id").alias("a")).join(neighbors, "a").select("center_rank", F.col("a").alias("center"), "rank", F.col("b").alias("id"), "sim")


def members(rankings: DataFrame, knn: int) -> DataFrame:
    """The first knn of each centre."""
    return rankings.where(F.col("rank") <= knn)


def packaged(rankings: DataFrame, knn: int) -> DataFrame:
    """center, members, extended: ids of the first knn and of the first 3 * knn of each centre, in order of rank."""
    near = rankings.where(F.col("rank") <= 3 * knn).groupBy("center").agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("r"))
    ids = lambda r: F.transform(r, lambda x: x["id"])
    return near.select("center", ids(F.filter("r", lambda x: x["rank"] <= knn)).alias("members"), ids(F.col("r")).alias("extended"))


def center_sims(rankings: DataFrame, sims: DataFrame, knn: int) -> DataFrame:
    """center, i, j, sim for all pairs of a centre's first knn members, i < j."""
    m = members(rankings, knn)
    pairs = m.select("center", F.col("id").alias("a")).join(m.select("center", F.col("id").alias("b")), "center").where("a < b")
    return pairs.join(sims.select("a", "b", "sim"), ["a", "b"]).select("center", F.col("a").alias("i"), F.col("b").alias("j"), "sim")


def with_ungreyed(rankings: DataFrame, grey: DataFrame, knn: int) -> DataFrame:
    """Rankings of the centres that have a member off the grey list among their first knn."""
    good = members(rankings, knn).join(grey.select("id"), "id", "left_anti").select("center").distinct()
    return rankings.join(good, "center", "left_semi")


def shared_members(rankings: DataFrame) -> DataFrame:
    """Members that are in several centres' lists, with the number of lists."""
    w = Window.partitionBy("id")
    return rankings.withColumn("lists", F.count("*").over(w)).where("lists > 1").select("id", "lists").distinct()
