"""The whole clustering of sequences, round by round, each step a table in a folder named by what it was made from."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom import adapters
from strandloom.config import Config
from strandloom.operators import density, graphs, intervals, lsh, partitions, seqprep


@dataclass(frozen=True)
class RoundState:
    """What changes from round to round: allowed overlap of dense regions and number of hash functions."""

    overlap: int
    nhf: int


def next_round(state: RoundState, config: Config, centers: int, clusters: int) -> RoundState | None:
    """The next round's parameters, or None to stop.

    With at most half the wanted centres the overlap grows by a step (a fifth of half the neighbours) up to half the
    neighbours; with clusters from at most three fifths of the centres the hash functions grow up to their limit. If
    neither can and there were no clusters, there is no next round.
    """
    most = config.kernel_knn_center // 2
    step = max(1, most // 5)
    overlap, nhf, stuck = state.overlap, state.nhf, 0
    if centers <= config.GLOBAL_num_clusters / 2 and overlap + step <= most:
        overlap += step
    elif not clusters:
        stuck += 1
    if clusters <= centers * 3 / 5 and config.kernel_nhf_step > 0 and nhf + config.kernel_nhf_step <= config.kernel_nhf_max:
        nhf += config.kernel_nhf_step
    elif not clusters:
        stuck += 1
    return None if stuck == 2 else RoundState(overlap, nhf)


class Stages:
    """Tables of a run under `root`. A stage's folder carries a digest of its settings and of the stages it was made from,
    so a changed setting makes anew what depends on it, and only that; an interrupted run goes on with what is complete."""

    def __init__(self, spark: SparkSession, config: Config, root: str) -> None:
        self.spark, self.config, self.root = spark, config, root
        self.digests: dict[str, str] = {}

    def path(self, name: str, after: tuple[str, ...], settings: dict) -> str:
        told = [name, settings, [self.digests[x] for x in after]]
        self.digests[name] = hashlib.md5(json.dumps(told, sort_keys=True).encode()).hexdigest()[:12]
        return f"{self.root}/{name}-{self.digests[name]}"

    def complete(self, path: str) -> bool:
        done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(done)

    def table(self, name: str, after: tuple[str, ...], settings: tuple[str, ...] | dict, make: Callable[[], DataFrame] | None) -> DataFrame | None:
        """The stage's table; made if it isn't complete, or None then if `make` is None. settings: fields of the configuration, or values."""
        values = settings if isinstance(settings, dict) else {k: getattr(self.config, k) for k in settings}
        path = self.path(name, after, values)
        if not self.complete(path):
            if make is None:
                return None
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def fragments_of(sequences: DataFrame, config: Config, grey: DataFrame | None = None) -> DataFrame:
    """Normalised, masked, windowed, without near copies, numbered, those of grey sequences (seq_idx) first."""
    clean = sequences.withColumn("seq", seqprep.normalize(F.col("seq")))
    w = seqprep.window_fragments(seqprep.split_masked(clean), config.input_win_size, config.input_win_shift, config.input_seq_min_length)
    w = seqprep.fragment_ids(w.where("seq <> ''"))
    keep = seqprep.near_duplicates(w, config.input_dedup_id / 100).where("value = keeper").select("value")
    kept = w.join(keep, "value", "left_semi").drop("value")
    if config.input_add_revcompl:
        kept = seqprep.both_strands(kept, grey)
    return seqprep.fragment_ids(kept, grey)


def features_of(fragments: DataFrame, config: Config, structures: DataFrame | None = None) -> DataFrame:
    """Graph-kernel vectors of the fragments' backbones and structures."""
    seqs = fragments.select(F.col("value").alias("graph_id"), "seq")
    given = fragments.sparkSession.createDataFrame([], "graph_id long, struct string") if structures is None else structures
    folded = adapters.structures_of(seqs, given)
    v, e = graphs.backbone(seqs)
    pairs = graphs.base_pairs(folded)
    pv, pe = graphs.stacking(pairs, seqs.select("graph_id", F.length("seq").alias("n")))
    edges = e.unionByName(graphs.structure_edges(pairs)).unionByName(pe)
    return graphs.graph_vectors(v.unionByName(pv), edges, config.kernel_radius, config.kernel_distance)


def cluster_round(stages: Stages, fragments: DataFrame, features: DataFrame, black: DataFrame, state: RoundState, number: int, grey: DataFrame | None) -> DataFrame:
    """Hits of this round's dense centres, with names round.index. Centres of grey fragments (id) only are left out."""
    config = stages.config
    rows = features.join(black.select("id"), "id", "left_anti")
    before = "features" if number == 1 else f"black{number - 1}"
    near = stages.table(f"neighbors{number}", ("features", before), {"nhf": state.nhf, "knn": config.kernel_knn_center}, lambda: lsh.approx_knn(rows, state.nhf, config.kernel_knn_center))

    def hits() -> DataFrame:
        candidates = density.sampled(rows.select("id").distinct(), config.kernel_fcs, number) if config.kernel_fcs < 1 else None
        centers = density.dense_centers(near, density.shared_density(near), config.GLOBAL_num_clusters, state.overlap, candidates)
        rankings = density.center_rankings(centers, near)
        if grey is not None:
            rankings = density.with_ungreyed(rankings, grey, config.center_subtree_max)
        ranked = density.members(rankings, config.center_subtree_max)
        models = ranked.join(fragments.select(F.col("value").alias("id"), "seq"), "id").select(F.concat_ws(".", F.lit(str(number)), F.col("center_rank").cast("string")).alias("name"), "seq")
        seqids = fragments.select(F.concat(F.lit("SEQ"), F.col("seq_idx").cast("string")).alias("seqid"), "start", "stop", "strand", "seq")
        found = adapters.scan(models, seqids, least=config.cm_min_bitscore).withColumn("key", intervals.make_key())
        return found.withColumn("round", F.lit(number))

    return stages.table(f"hits{number}", (f"neighbors{number}",), {"overlap": state.overlap} | {k: getattr(config, k) for k in ("GLOBAL_num_clusters", "center_subtree_max", "cm_min_bitscore", "kernel_fcs")}, hits)


def run(
    spark: SparkSession, sequences: DataFrame, config: Config, root: str, structures: DataFrame | None = None,
    grey: DataFrame | None = None, special: DataFrame | None = None, until: str = "results", results_only: bool = False,
) -> dict[str, DataFrame]:
    """fragments, features, hits, and soft, hard, merged partitions and top hits of them.

    grey (seq_idx): sequences that may join clusters but make none of their own, have no reverse complements and are
    never black. special (id): fragments that are black from the start. until: "fragments", "features", "hits" or
    "results", after which the run ends. results_only: no round is computed; partitions are made from the rounds that
    are stored under these settings. What the lists hold is part of the
    stages' digests; the sequences aren't, so a root belongs to one input.
    """
    stages = Stages(spark, config, root)
    listed = {k: list(x.select(c).distinct().agg(F.count("*"), F.bit_xor(F.xxhash64(F.col(c).cast("long")))).first()) if x is not None else [] for k, x, c in (("grey", grey, "seq_idx"), ("special", special, "id"))}
    inputs = ("input_win_size", "input_win_shift", "input_seq_min_length", "input_dedup_id", "input_add_revcompl")
    fragments = stages.table("fragments", (), {k: getattr(config, k) for k in inputs} | {"grey": listed["grey"]}, lambda: fragments_of(sequences, config, grey))
    out = {"fragments": fragments}
    if until == "fragments":
        return out
    out["features"] = features = stages.table("features", ("fragments",), ("kernel_radius", "kernel_distance"), lambda: features_of(fragments, config, structures))
    if until == "features":
        return out
    grey_ids = None if grey is None else fragments.join(grey.select("seq_idx").distinct(), "seq_idx", "left_semi").select(F.col("value").alias("id"))
    state: RoundState | None = RoundState(0, config.kernel_nhf)
    none = spark.createDataFrame([], "id long")
    fixed = none if special is None else special.select(F.col("id").cast("long").alias("id"))
    black = fixed
    stages.path("features", ("fragments",), {"kernel_radius": config.kernel_radius, "kernel_distance": config.kernel_distance, "special": listed["special"]})
    hits = None
    for number in range(1, config.GLOBAL_iterations + 1):
        if state is None or features.join(black, "id", "left_anti").select("id").distinct().limit(2).count() < 2:
            break
        if results_only and not known_round(stages, state, number):
            break
        now = cluster_round(stages, fragments, features, black, state, number, grey_ids)
        hits = now if hits is None else hits.unionByName(now)
        found = partitions.collect_hits(now).select("name").distinct().count()
        wanted = now.select("name").distinct().count()
        frags = fragments.select(F.col("value").alias("id"), F.concat(F.lit("SEQ"), F.col("seq_idx").cast("string")).alias("seqid"), "start", "stop", "strand")
        so_far = hits
        black = stages.table(f"black{number}", (f"hits{number}",), ("GLOBAL_hit_blacklist_overlap",), lambda so_far=so_far, frags=frags: intervals.blacklist(frags, so_far.select("seqid", "start", "stop", "strand"), grey_ids, config.GLOBAL_hit_blacklist_overlap).union(fixed).distinct())
        state = next_round(state, config, wanted, found)
    if hits is None:
        return out
    last = f"hits{max(int(k[4:]) for k in stages.digests if k.startswith('hits') and k[4:].isdigit() and stages.complete(f'{root}/{k}-{stages.digests[k]}'))}"
    grey_seqs = None if grey is None else grey.select(F.concat(F.lit("SEQ"), F.col("seq_idx").cast("string")).alias("seqid"))

    def collected() -> DataFrame:
        strong = partitions.score_cutoff(hits, config.cm_min_bitscore, config.cm_max_eval, config.cm_bitscore_sig)
        return partitions.collect_hits(strong, grey=grey_seqs).withColumn("rid", F.xxhash64("name", "key", "bitscore"))

    out["hits"] = numbered = stages.table("collected", (last,), ("cm_min_bitscore", "cm_max_eval", "cm_bitscore_sig"), collected)
    if until == "hits":
        return out
    out["soft"] = partitions.filter_clusters(numbered, config.results_min_cluster_size)
    out["hard"] = partitions.filter_clusters(partitions.unique_hits(numbered, config.results_merge_overlap), config.results_min_cluster_size)
    partners = partitions.best_partner(partitions.cluster_overlap(numbered), round(100 * config.results_merge_cluster_ol))
    out["merged"] = partitions.filter_clusters(out["hard"].drop("cluster"), config.results_min_cluster_size, partitions.merge_map(partners, numbered))
    out["top"] = partitions.top_hits(out["merged"].drop("name").withColumnRenamed("cluster", "name"), config.results_top_num)
    return out


def known_round(stages: Stages, state: RoundState, number: int) -> bool:
    """Whether the round's hits are stored, made with these settings."""
    config = stages.config
    before = "features" if number == 1 else f"black{number - 1}"
    stages.path(f"neighbors{number}", ("features", before), {"nhf": state.nhf, "knn": config.kernel_knn_center})
    return stages.complete(stages.path(f"hits{number}", (f"neighbors{number}",), {"overlap": state.overlap} | {k: getattr(config, k) for k in ("GLOBAL_num_clusters", "center_subtree_max", "cm_min_bitscore", "kernel_fcs")}))
