"""Algebra of closed intervals (seqid, start, stop, strand, key, ...)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parse_keys(df: DataFrame, column: str = "key") -> DataFrame:
    """seqid, start, stop, strand from keys SEQID#START#STOP#STRAND; a key of another form is an error."""
    p = F.split(column, "#")
    ok = F.when(F.size(p) == 4, p).otherwise(F.raise_error(F.concat(F.lit("not an interval key: "), F.col(column))))
    return df.withColumn("_p", ok).withColumns({"seqid": F.col("_p")[0], "start": F.col("_p")[1].cast("int"), "stop": F.col("_p")[2].cast("int"), "strand": F.col("_p")[3]}).drop("_p")


def make_key(seqid: str = "seqid", start: str = "start", stop: str = "stop", strand: str = "strand") -> Column:
    return F.concat_ws("#", F.col(seqid).cast("string"), F.col(start).cast("string"), F.col(stop).cast("string"), F.col(strand))


def percent_overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Common length in percent of the shorter interval, rounded half up, as an integer.

    Whole-number arithmetic, so cutoffs are compared alike in every engine.
    """
    common = (F.least(e1, e2) - F.greatest(s1, s2) + 1).cast("long")
    short = F.least(e1 - s1 + 1, e2 - s2 + 1).cast("long")
    return F.floor((200 * common + short) / (2 * short)).cast("int")


#: Widths of bins: an interval belongs to the first that holds four of its lengths or is the last.
WIDTHS = tuple(64 * 32**k for k in range(6))


def _width(start: str, stop: str) -> Column:
    size = (F.col(stop) - F.col(start) + 1).cast("long")
    return F.coalesce(*[F.when(size <= 4 * w, F.lit(w)) for w in WIDTHS], F.lit(WIDTHS[-1])).cast("long")


def overlap_join(left: DataFrame, right: DataFrame, cutoff: float = 0.0, ignore_strand: bool = False, row_id: str = "rid") -> DataFrame:
    """Pairs of overlapping intervals: columns of left with prefix a_, of right with b_, and pct.

    Equal seqid, equal strand unless ignored, at least one common position, pct of the shorter one >= cutoff. Rows
    with the same row_id aren't paired, so an interval never meets itself. Both sides are dealt into bins of positions,
    which makes the join an equi-join that spreads a long sequence; a pair is kept in the first bin that both touch, so
    none is made twice. The width of its bins follows an interval's length, so that it lies in few: pairs meet in bins
    of the longer one's width. Intervals of one width, the usual case, are one join.
    """
    a = left.select(*[F.col(c).alias(f"a_{c}") for c in left.columns]).withColumn("_wa", _width("a_start", "a_stop"))
    b = right.select(*[F.col(c).alias(f"b_{c}") for c in right.columns]).withColumn("_wb", _width("b_start", "b_stop"))
    # six values at most
    of_a, of_b = ({r[0] for r in x.select(w).distinct().collect()} for x, w in ((a, "_wa"), (b, "_wb")))
    every = sorted(of_a | of_b) or [WIDTHS[0]]

    def binned(a: DataFrame, b: DataFrame, width: int) -> DataFrame:
        first = lambda c: F.floor(F.col(c) / width)
        a = a.withColumn("_bin", F.explode(F.sequence(first("a_start"), first("a_stop"))))
        b = b.withColumn("_bin", F.explode(F.sequence(first("b_start"), first("b_stop"))))
        on = (F.col("a_seqid") == F.col("b_seqid")) & (a["_bin"] == b["_bin"])
        if not ignore_strand:
            on &= F.col("a_strand") == F.col("b_strand")
        met = a.join(b, on).where((F.col("a_start") <= F.col("b_stop")) & (F.col("b_start") <= F.col("a_stop")) & (a["_bin"] == F.greatest(first("a_start"), first("b_start"))))
        return met.drop("_bin", "_wa", "_wb")

    if len(every) == 1:
        met = binned(a, b, every[0])
    else:
        parts = [binned(a.where(F.col("_wa") == w), b.where(F.col("_wb") <= w), w) for w in every if w in of_a] + [binned(a.where(F.col("_wa") < w), b.where(F.col("_wb") == w), w) for w in every if w in of_b]
        met = parts[0]
        for p in parts[1:]:
            met = met.unionByName(p)
    if row_id in left.columns and row_id in right.columns:
        met = met.where(F.col(f"a_{row_id}") != F.col(f"b_{row_id}"))
    pct = percent_overlap(F.col("a_start"), F.col("a_stop"), F.col("b_start"), F.col("b_stop"))
    return met.withColumn("pct", pct).where(F.col("pct") >= round(cutoff * 100))


def merge_islands(df: DataFrame) -> DataFrame:
    """seqid, strand, start, stop, n: maximal runs of intervals that share a position, by gaps and islands."""
    w = Window.partitionBy("seqid", "strand").orderBy("start", "stop")
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("new", F.when(reach >= F.col("start"), 0).otherwise(1)).withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("seqid", "strand", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n")).drop("island")


_MERGED = pa.schema([(c, pa.int32() if c in ("start", "stop") else pa.string()) for c in ("id", "seqid", "strand", "start", "stop", "seq", "provenance")])


def merge_fragments(df: DataFrame, removed: DataFrame | None = None, cutoff: float = 0.1) -> DataFrame:
    """id, seqid, strand, start, stop, seq, provenance: the leftmost interval takes in whatever overlaps what it has grown to.

    First, listed ids go, with all that overlaps them on either strand. Growth is sequential in a sequence (the share
    refers to the grown interval): rows come sorted by (seqid, strand) and position, many sequences to a task, and a task
    holds the rows of one run of touching intervals, beyond which nothing grows. A minus-strand text is extended in
    front, a plus-strand one behind. Columns: id, seqid, start, stop, strand, key, seq.
    """
    if removed is not None:
        gone = df.join(removed.select("id"), "id", "left_semi")
        hit = overlap_join(df.withColumn("rid", F.col("id")), gone.withColumn("rid", F.col("id")), cutoff, ignore_strand=True).select(F.col("a_id").alias("id"))
        df = df.join(hit.union(gone.select("id")).distinct(), "id", "left_anti")

    least = round(cutoff * 100)
    names = ["id", "seqid", "start", "stop", "strand", "key", "seq"]

    def grown(rows: list[tuple]) -> Iterator[tuple]:
        """Merged intervals of one run in order; `left` are the rows passed over that none has taken in."""
        at, left = 0, []
        while left or at < len(rows):
            if left:
                base, left = left[0], left[1:]
            else:
                base, at = rows[at], at + 1
            id_, seqid, start, stop, strand, key, text = base
            text, trace, reach = text or "", [f"{id_}:{key}"], None
            while reach != stop:
                reach, kept, seen = stop, [], 0
                while True:
                    if seen < len(left):
                        r, seen = left[seen], seen + 1
                    elif at < len(rows) and rows[at][2] <= stop:
                        r, at = rows[at], at + 1
                    else:
                        break
                    common = min(stop, r[3]) - max(start, r[2]) + 1
                    short = min(stop - start, r[3] - r[2]) + 1
                    if common > 0 and (200 * common + short) // (2 * short) >= least:
                        more, piece = max(0, r[3] - stop), r[6] or ""
                        if more:
                            text = text + piece[-more:] if strand == "+" else piece[:more] + text
                        stop = max(stop, r[3])
                        trace.append(f"{r[0]}:{r[5]}")
                    else:
                        kept.append(r)
                left = kept
            yield f"{id_}.1", seqid, strand, start, stop, text, ";".join(trace)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, rows, of, reach = [], [], None, None

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), [f.type for f in _MERGED], strict=True)], schema=_MERGED)

        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                if rows and ((r[1], r[4]) != of or r[2] > reach):
                    made += grown(rows)
                    rows = []
                reach = max(reach, r[3]) if rows else r[3]
                of = r[1], r[4]
                rows.append(r)
            if len(made) >= 10_000:
                yield batch_of(made)
                made = []
        if rows:
            made += grown(rows)
        if made:
            yield batch_of(made)

    rows = df.select(*names).repartition("seqid", "strand").sortWithinPartitions("seqid", "strand", "start", "stop", "id")
    return rows.mapInArrow(run, "id string, seqid string, strand string, start int, stop int, seq string, provenance string")


def blacklist(fragments: DataFrame, hits: DataFrame, grey: DataFrame | None = None, cutoff: float = 0.2) -> DataFrame:
    """id of fragments that overlap any hit, on either strand, without those on the grey list."""
    ids = overlap_join(fragments, hits, cutoff, ignore_strand=True, row_id="").select(F.col("a_id").alias("id")).distinct()
    return ids if grey is None else ids.join(grey.select("id"), "id", "left_anti")


def pairs_within(fragments: DataFrame, parts: int = 32) -> DataFrame:
    """All pairs of fragments of one seqid, each with itself too: a_ and b_ columns.

    One side is dealt to `parts`, the other goes to each: sequences may be few and long, and what is sent is fragments.
    """
    a = fragments.select(*[F.col(c).alias(f"a_{c}") for c in fragments.columns], F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("_part"))
    b = fragments.select(*[F.col(c).alias(f"b_{c}") for c in fragments.columns], F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part2"))
    # a fixed number of tasks: by the size of fragments the pairs would fall to a few
    a, b = a.repartition(4 * parts, "a_seqid", "_part"), b.repartition(4 * parts, "b_seqid", "_part2")
    return a.join(b.hint("merge"), (F.col("a_seqid") == F.col("b_seqid")) & (F.col("_part") == F.col("_part2"))).drop("_part", "_part2")


def damp_cells(cells: DataFrame, digits: int = 2) -> DataFrame:
    """damp_overlapping of cells that have both fragments' places beside them (i, j, val, a_ and b_ seqid, start, stop): row by row."""
    least = cells.where("val <> 0").agg(F.min("val").alias("least"))
    low = F.when((F.col("least") > 0) & (F.col("least") < 1), 0.0).otherwise(F.col("least") - F.abs(F.col("least") / 2))
    met = (F.col("i") != F.col("j")) & (F.col("a_seqid") == F.col("b_seqid")) & (F.col("a_start") <= F.col("b_stop")) & (F.col("b_start") <= F.col("a_stop"))
    hit = met & (percent_overlap(F.col("a_start"), F.col("a_stop"), F.col("b_start"), F.col("b_stop")) >= 10)
    return cells.crossJoin(F.broadcast(least)).select("i", "j", F.when(hit, low).otherwise(F.round("val", digits)).alias("val"))


def damp_overlapping(matrix: DataFrame, fragments: DataFrame, digits: int = 2) -> DataFrame:
    """Cells (i, j, val) of overlapping fragments set to least - |least / 2|, least being the smallest non-zero cell (0 if it lies between 0 and 1); others rounded."""
    place = lambda p: fragments.select(F.col("id").alias("i" if p == "a" else "j"), *[F.col(c).alias(f"{p}_{c}") for c in ("seqid", "start", "stop")])
    return damp_cells(matrix.join(place("a"), "i", "left").join(place("b"), "j", "left"), digits)


def to_genome(hits: DataFrame, locations: DataFrame) -> DataFrame:
    """Hits with g_start, g_stop, g_strand where their sequence has a location (chr, loc_start, loc_stop, loc_strand).

    On a minus location positions count from its end and the strand turns over.
    """
    plus = F.col("loc_strand") == "+"
    same = F.col("strand") == "+"
    return hits.join(locations, "seqid", "left").withColumns({
        "g_start": F.when(plus, F.col("loc_start") + F.col("start") - 1).otherwise(F.col("loc_stop") - F.col("stop") + 1),
        "g_stop": F.when(plus, F.col("loc_start") + F.col("stop") - 1).otherwise(F.col("loc_stop") - F.col("start") + 1),
        "g_strand": F.when(F.col("loc_strand").isNull(), None).when(plus == same, "+").otherwise("-"),
    })


def extract(hits: DataFrame, sequences: DataFrame) -> DataFrame:
    """Hits with subseq: their part of the sequence, reverse-complemented on the minus strand."""
    part = F.substring(F.col("seq"), F.col("start"), F.col("stop") - F.col("start") + 1)
    return hits.join(sequences.select("seqid", "seq"), "seqid").withColumn("subseq", F.when(F.col("strand") == "-", F.reverse(F.translate(part, "AUGC", "UACG"))).otherwise(part)).drop("seq")
