"""From raw sequences to windows: normalising, mask splitting, windowing, strands, locations, classes, near copies.

Sequences: seq_idx int, id string, header string, seq string.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.intervals import overlap_join
from strandloom.operators.lsh import agreement, alike_groups, bin_links, forest_leaves, signed
from strandloom.session import shared_dir

#: Fixed value: a longer run of N cuts a sequence.
MAX_N = 15


def normalize(seq: Column) -> Column:
    """Upper case (a-z) without white space, T as U, anything else but AUGC as N."""
    return F.regexp_replace(F.translate(F.regexp_replace(seq, r"\s", ""), "abcdefghijklmnopqrstuvwxyzT", "ABCDEFGHIJKLMNOPQRSUUVWXYZU"), "[^AUGCN]", "N")


def _pieces(seq: str, masked: re.Pattern) -> list[tuple[int, int]]:
    """Places (from, to) of a text's masked runs and of what lies between them."""
    cuts = [0, *(x for m in masked.finditer(seq) for x in m.span()), len(seq)]
    return [(x, y) for x, y in zip(cuts, cuts[1:], strict=False) if x < y]


def _mapped(df: DataFrame, kept: list[str], run, fields: list[tuple[str, str]]) -> DataFrame:
    """Rows that run(row) makes of a row's other columns, behind its columns `kept`: nothing is shuffled."""
    others = [c for c in df.columns if c not in kept]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in others), strict=True)
            at, found = [], []

            def flushed() -> pa.RecordBatch:
                own = pa.array(at, pa.int64())  # noqa: B023
                cells = zip(*found, strict=True) if found else [[]] * len(fields)  # noqa: B023
                return pa.RecordBatch.from_arrays([*[batch.column(c).take(own) for c in kept], *[pa.array(x, kinds[k]) for x, (_, k) in zip(cells, fields, strict=True)]], [*kept, *(c for c, _ in fields)])  # noqa: B023

            for i, row in enumerate(rows):
                new = run(*row)
                found += new
                at += [i] * len(new)
                if len(found) > 1 << 16:
                    yield flushed()
                    at, found = [], []
            yield flushed()

    kinds_kept = dict(df.dtypes)
    return df.select(*kept, *others).mapInArrow(made, ", ".join([*[f"`{c}` {kinds_kept[c]}" for c in kept], *[f"`{c}` {k}" for c, k in fields]]))


def split_masked(sequences: DataFrame, max_n: int = MAX_N) -> DataFrame:
    """seq_idx, part, seg, abs_start, abs_end: runs of N longer than max_n are segments of their own; lengths add up."""
    masked = re.compile(f"N{{{max_n + 1},}}")

    def run(seq: str) -> list[tuple]:
        return [(k, seq[x:y], x + 1, y) for k, (x, y) in enumerate(_pieces(seq, masked))]

    return _mapped(sequences.where(F.length("seq") > 0).select("seq_idx", "seq"), ["seq_idx"], run, [("part", "int"), ("seg", "string"), ("abs_start", "int"), ("abs_end", "int")])


def segment_status(segments: DataFrame, min_len: int, max_n: int = MAX_N) -> DataFrame:
    """Segments with status SMALLER_THAN, MASKED or USED."""
    return segments.withColumn("status", F.when(F.length("seg") < min_len, "SMALLER_THAN").when(F.col("seg").rlike(f"N{{{max_n},}}"), "MASKED").otherwise("USED"))


def _windows(n: int, window: int, shift: int, min_len: int) -> list[tuple[int, int]]:
    """Starts (from 0) and lengths of the windows of n residues, each once."""
    if not window or n <= window:
        return [(0, n)]
    overlap = window - shift
    # the earliest step at which either rule for the last window holds
    k = max(min(math.ceil((n - window * 0.5) / shift), math.ceil((n - (overlap + shift + window * 0.1)) / shift)), 0)
    # a full window that reaches the end stops the series before the last rule is asked
    found = [(at, window) for at in range(0, k * shift, shift) if at == 0 or at - shift + window < n]
    if not (k > 0 and (k - 1) * shift + window >= n):
        tail = max(min_len, int(window * 0.6)) if k * shift >= n - window * 0.5 else max(window, n - k * shift - overlap)
        found.append((max(n - tail, 0), min(tail, n)))
    return list(dict.fromkeys(found))


def _fragments(idx: int | None, seg: str, abs_start: int, window: int, shift: int, min_len: int, max_n: int) -> list[tuple]:
    """start, stop, strand, seq, key of a segment's windows."""
    if len(seg) < min_len or "N" * max_n in seg:
        return []
    right = seg.lstrip("N")
    s, cue = right.rstrip("N"), len(seg) - len(right)
    if not s:
        return []
    found = [(abs_start + cue + at, abs_start + at + size - 1, at, size) for at, size in _windows(len(s), window, shift, min_len)]
    name = "SEQ" if idx is None else f"SEQ{idx}#"
    return [(start, stop, "+", s[at : at + size], f"{name}{start}#{stop}#+") for start, stop, at, size in found]


_FRAGMENT = [("start", "int"), ("stop", "int"), ("strand", "string"), ("seq", "string"), ("key", "string")]


def _shift(window: int, shift_pct: float) -> int:
    return min(max(int(window / 100 * shift_pct), 1), window) if window else 0


def window_fragments(segments: DataFrame, window: int, shift_pct: float, min_len: int, max_n: int = MAX_N) -> DataFrame:
    """key, seq_idx, start, stop, strand, seq: windows of every segment that is long enough and not masked.

    Leading and trailing N are cut off (a start moves with them; a stop, as in the keys known so far, doesn't). Starts
    step by the shift; the last window is found in closed form: with L the length and W the window, the first step k
    at which either L - k * shift <= W / 2 (then it has max(min_len, 0.6 W) from the end) or what is left beyond the
    overlap is at most shift + W / 10 (then max(W, that) from the end) ends the series. No windows (0): the whole segment.
    """
    shift = _shift(window, shift_pct)

    def run(idx: int, seg: str, abs_start: int) -> list[tuple]:
        return _fragments(idx, seg, abs_start, window, shift, min_len, max_n)

    used = segments.where(F.length("seg") >= min_len).select("seq_idx", F.col("seq_idx").alias("_i"), "seg", "abs_start")
    return _mapped(used, ["seq_idx"], run, _FRAGMENT).dropDuplicates(["key"])


def cut_fragments(sequences: DataFrame, window: int, shift_pct: float, min_len: int, max_n: int = MAX_N) -> DataFrame:
    """window_fragments of split_masked, with the sequences' other columns; of sequences of which each has its own seq_idx.

    No two segments of a sequence share a place, so no key comes twice and nothing is shuffled.
    """
    shift, masked = _shift(window, shift_pct), re.compile(f"N{{{max_n + 1},}}")

    def run(idx: int, seq: str) -> list[tuple]:
        return [f for x, y in _pieces(seq, masked) if y - x >= min_len for f in _fragments(idx, seq[x:y], x + 1, window, shift, min_len, max_n)]

    kept = [c for c in sequences.columns if c != "seq"]
    return _mapped(sequences.where(F.length("seq") > 0).select(*kept, F.col("seq_idx").alias("_i"), "seq"), kept, run, _FRAGMENT)


def segment_counts(sequences: DataFrame, max_n: int = MAX_N) -> DataFrame:
    """length and segments (of split_masked) beside the sequences' other columns; empty ones are left out."""
    masked = re.compile(f"N{{{max_n + 1},}}")
    return _mapped(sequences.where(F.length("seq") > 0), [c for c in sequences.columns if c != "seq"], lambda seq: [(len(seq), len(_pieces(seq, masked)))], [("length", "long"), ("segments", "long")])


def fold_windows(sequences: DataFrame, sizes: list[int], shift_pct: float, levels: dict[int, int] | None = None, level: int = 5) -> DataFrame:
    """graph_id, size, at, level, seq: the pieces of every sequence that are folded, for each window size.

    Of the sorted sizes those below the sequence's length are used and the first that isn't, which takes it whole. Starts
    (0-based) step by the whole percent of the size, one at least; the last window ends with the sequence. levels: shape
    level to the least size that has it (the highest level that fits wins, 0 if none fits); without it all have `level`.
    """
    if any(k not in range(1, 6) or v < 0 for k, v in (levels or {}).items()):
        raise ValueError("levels are 1 to 5, with sizes of 0 and more")
    order = sorted(set(sizes))
    n = F.length("seq")

    def windows(size: int, smaller: int) -> Column:
        step = max(1, int(size * shift_pct / 100))
        of = level if levels is None else max((k for k, v in levels.items() if v <= size), default=0)
        rest = F.greatest(n - size, F.lit(0))
        at = F.array_distinct(F.concat(F.sequence(F.lit(0), rest, F.lit(step)), F.array(rest)))
        made = F.transform(at, lambda x: F.struct(F.lit(size).alias("size"), x.alias("at"), F.lit(of).alias("level")))
        return F.when(n > smaller, made).otherwise(F.filter(made, lambda x: F.lit(False)))

    rows = sequences.where(n > 0).select("graph_id", "seq", F.explode(F.concat(*[windows(x, low) for x, low in zip(order, [0, *order], strict=False)])).alias("w"))
    return rows.select("graph_id", "w.size", "w.at", "w.level", F.substring(F.col("seq"), F.col("w.at") + 1, F.col("w.size")).alias("seq"))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "AUGC", "UACG"))


def both_strands(fragments: DataFrame, grey: DataFrame | None = None) -> DataFrame:
    """The fragments and the reverse complements of those that aren't grey (seq_idx)."""
    turned = fragments if grey is None else fragments.join(grey.select("seq_idx"), "seq_idx", "left_anti").select(fragments.columns)
    turned = turned.withColumns({"seq": reverse_complement(F.col("seq")), "strand": F.lit("-"), "key": F.regexp_replace("key", r"\+$", "-")})
    return fragments.unionByName(turned)


def totals_before(rows: DataFrame, order: list[str], count: str) -> DataFrame:
    """rows with before: the sum of `count` over all rows that come earlier in the order.

    Rows are dealt into ranges; each is summed up by itself, and a row for each range carries the totals over.
    """
    shared_dir(rows.sparkSession)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()).checkpoint()
    upto = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("_pid").agg(F.sum(count).alias("_t")).select("_pid", F.coalesce(F.sum("_t").over(upto), F.lit(0)).alias("_t"))
    own = F.sum(count).over(Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return dealt.withColumn("_own", F.coalesce(own, F.lit(0))).join(base, "_pid").withColumn("before", F.col("_own") + F.col("_t")).drop("_pid", "_own", "_t")


def fragment_ids(fragments: DataFrame, grey: DataFrame | None = None) -> DataFrame:
    """Fragments with value, from 1 in the order grey first, sequence, start, key: places in each sequence, and the
    sequences' running totals."""
    rows = fragments if grey is None else fragments.join(grey.select("seq_idx").distinct().withColumn("_g", F.lit(0)), "seq_idx", "left")
    rows = rows.withColumn("_g", F.coalesce(F.col("_g"), F.lit(1)) if grey is not None else F.lit(1))
    inner = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_g", "seq_idx").orderBy("start", "key")))
    before = totals_before(rows.groupBy("_g", "seq_idx").agg(F.count("*").alias("_c")), ["_g", "seq_idx"], "_c").drop("_c")
    return inner.join(before, ["_g", "seq_idx"]).withColumn("value", F.col("before") + F.col("_n")).drop("_g", "_n", "before")


def genome_locations(id_: Column, header: Column) -> Column:
    """genome.chrC:start-end:strand, or MISS: an explicit GENOME_LOC, else whatever the lower-cased text says.

    Start is before end; a reversed pair means the minus strand; a suffix behind the numbers or strand= overrides.
    """
    given = F.regexp_extract(header, r"GENOME_LOC (\S+\.chr\S+:\d+-\d+:\S+)", 1)
    text = F.lower(F.concat(id_, F.lit(" "), header))
    place = r"chr(\S+)[:_](\d+)[-_](\d+)"
    c, a, b = (F.regexp_extract(text, place, i) for i in (1, 2, 3))
    x, y = F.nullif(a, F.lit("")).cast("decimal(38,0)"), F.nullif(b, F.lit("")).cast("decimal(38,0)")
    suffix = F.regexp_extract(text, r"chr\S+[:_]\d+[-_]\d+[:_](\S+)", 1)
    named = F.regexp_extract(text, r"strand=([+-])", 1)
    strand = F.when(named != "", named).when(suffix != "", suffix).when(x > y, "-").otherwise("+")
    genome = F.regexp_extract(text, r"(\S+)[\._]chr\S+[:_]\d+[-_]\d+", 1)
    found = F.concat(F.when(genome == "", "undef").otherwise(genome), F.lit(".chr"), c, F.lit(":"), F.least(x, y).cast("string"), F.lit("-"), F.greatest(x, y).cast("string"), F.lit(":"), strand)
    return F.when(given != "", given).when(c == "", "MISS").otherwise(found)


def grey_indices(sequences: DataFrame, indexes: list[int] | None = None, patterns: list[str] | None = None, first: int = 0) -> DataFrame:
    """seq_idx of listed sequences, of those whose id or header matches any pattern, and of the first n."""
    hit = F.col("seq_idx") <= first
    if indexes:
        hit |= F.col("seq_idx").isin(indexes)
    if patterns:
        hit |= F.concat_ws(" ", "id", "header").rlike("|".join(patterns))
    return sequences.where(hit).select("seq_idx")


def shingle_sets(fragments: DataFrame, k: int) -> DataFrame:
    """id (value), fs: the different k-mers of a fragment by 31 bits of their hash, in order; a shorter text is one."""

    def grams(text: str) -> np.ndarray:
        c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        h = np.full(max(len(c) - k + 1, 1), len(c) if len(c) < k else k, np.uint64)
        for i in range(min(k, len(c))):
            h = h * np.uint64(0x9E3779B97F4A7C15) + c[i : i + len(h)]
        # the last bits of such a sum depend on the last characters only
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        return np.unique((h >> np.uint64(33)).astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [grams(seq) for seq in batch.column("seq").to_pylist()]
            upto = np.cumsum([0, *map(len, sets)])
            fs = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *sets])))
            yield pa.RecordBatch.from_arrays([batch.column("value").cast(pa.int64()), fs], ["id", "fs"])

    return fragments.where("value is not null and seq is not null").select("value", "seq").mapInArrow(run, "id long, fs array<long>")


def near_duplicates(fragments: DataFrame, similarity: float = 0.9, k: int = 8, nhf: int = 32, most: int = 500) -> DataFrame:
    """value, keeper: fragments whose k-mer sets are alike by `similarity` at least, joined to chains; the least value keeps.

    Equal texts are one candidate, and so are equal sets, which is all that joins sets too small to miss a k-mer. A forest
    of min-hash bins, of which large ones are split and then compared block by block, brings the others together; exact
    Jaccard similarity decides. Whole sets are made again for those only whose signatures agree with another's of their
    bin as often as sets that are alike do, but for a chance of 1e-9.
    """
    shared_dir(fragments.sparkSession)
    # dealt again: few bytes of text are much work
    n = int(fragments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reps = fragments.groupBy("seq").agg(F.min("value").alias("value")).repartition(n, "value").checkpoint()
    trees = max(1, nhf // 2)
    # as deep as one pair in a hundred thousand is missed at most, if trees were independent
    depth = max(d for d in (2, 3, 4) if d == 2 or (1 - similarity**d) ** trees <= 1e-5)
    sets = shingle_sets(reps, k).select("id", F.size("fs").alias("n"), F.xxhash64("fs").alias("same"), "fs")
    signatures = signed(sets, 2 * trees).checkpoint()
    heads = signatures.groupBy("same", "n").agg(F.min("id").alias("head"), F.count("*").alias("times"))
    equal = signatures.join(heads.where("times > 1"), ["same", "n"]).where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).checkpoint()
    # of n k-mers one less or more leaves n / (n + 1) alike
    large = signatures.where(F.col("n") >= F.lit(similarity) * (F.col("n") + 1) - 1e-9).join(equal.select(F.col("b").alias("id")), "id", "left_anti").select("id", "s")
    groups = alike_groups(forest_leaves(large, trees, depth, most), large, agreement(similarity, 2 * trees)).checkpoint()
    some = reps.join(groups.select(F.col("id").alias("value")).distinct(), "value", "left_semi")
    alike = bin_links(groups, shingle_sets(some, k).select("id", F.col("fs").cast("array<int>").alias("fs")), similarity).union(equal).distinct()
    labels = least_reachable(reps.select(F.col("value").alias("id")), alike)
    first = fragments.join(reps.select("seq", F.col("value").alias("rep")), "seq")
    return first.select("value", "rep").join(labels.select(F.col("id").alias("rep"), "root"), "rep").select("value", F.col("root").alias("keeper"))


def least_reachable(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, root: the least id that edges reach. Labels spread and jump until nothing changes; lineage is cut each round."""
    shared_dir(nodes.sparkSession)
    both = edges.union(edges.select("b", "a")).distinct().checkpoint()
    now = nodes.select("id", F.col("id").alias("root"))
    while True:
        heard = both.join(now, both["b"] == now["id"]).groupBy(F.col("a").alias("id")).agg(F.min("root").alias("m"))
        told = now.join(heard, "id", "left").select("id", F.least("root", F.coalesce("m", "root")).alias("root"))
        jump = told.select(F.col("id").alias("root"), F.col("root").alias("next"))
        new = told.join(jump, "root", "left").select("id", F.coalesce("next", "root").alias("root")).checkpoint()
        if now.join(new.withColumnRenamed("root", "r2"), "id").where("root <> r2").isEmpty():
            return new
        now = new


def class_signals(sequences: DataFrame, both: bool = False) -> DataFrame:
    """class, name, seqid, start, stop, strand, key of the signals that headers announce; class 0 makes none.

    CLASS_MULTI c#name#s#e;... or CLASSIDX c [CLASS name] [CLASS_SIGNAL s-e] (default: the whole sequence). A start
    behind the stop means the minus strand.
    """
    multi = F.regexp_extract("header", r"CLASS_MULTI\s+(\S+)", 1)
    one = F.regexp_extract("header", r"CLASSIDX\s+(\d+)", 1)
    named = F.regexp_extract("header", r"CLASS\s+(\S+)", 1)
    span = r"CLASS_SIGNAL\s+(\d+)-(\d+)"
    low, high = F.regexp_extract("header", span, 1), F.regexp_extract("header", span, 2)
    single = F.concat_ws("#", one, F.when(named == "", "UNKNOWN").otherwise(named), F.when(low == "", "1").otherwise(low), F.when(high == "", F.length("seq").cast("string")).otherwise(high))
    rows = sequences.withColumn("sig", F.explode(F.split(F.when(multi != "", multi).when(one != "", single).otherwise(""), ";"))).withColumn("p", F.split("sig", "#")).where(F.size("p") == 4)
    a, b = F.col("p")[2].cast("int"), F.col("p")[3].cast("int")
    rows = rows.select(F.col("p")[0].cast("int").alias("class"), F.col("p")[1].alias("name"), F.concat(F.lit("SEQ"), F.col("seq_idx").cast("string")).alias("seqid"), F.least(a, b).alias("start"), F.greatest(a, b).alias("stop"), F.when(a > b, "-").otherwise("+").alias("strand")).where(F.col("class") != 0)
    if both:
        rows = rows.unionByName(rows.withColumn("strand", F.when(F.col("strand") == "+", "-").otherwise("+")))
    return rows.withColumn("key", F.concat_ws("#", "seqid", "start", "stop", "strand"))


def annotate_fragments(fragments: DataFrame, signals: DataFrame, cutoff: float = 0.05) -> DataFrame:
    """rid, class of each fragment: that of the signal it overlaps most (ties: largest class), 0 without any."""
    met = overlap_join(fragments, signals.withColumn("rid", F.lit(-1)), cutoff).groupBy(F.col("a_rid").alias("rid")).agg(F.max(F.struct("pct", F.col("b_class"))).alias("m"))
    return fragments.select("rid").join(met, "rid", "left").select("rid", F.coalesce("m.b_class", F.lit(0)).alias("class"))
