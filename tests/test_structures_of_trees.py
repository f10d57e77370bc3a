"""Regions that grow until their brackets balance, exchanges of centres, and similarities by classes, against plain loops."""

import numpy as np
from pyspark.sql import functions as F

from strandloom.operators import density, trees


def grown(struct, start, stop):
    """The region's ends moved place by place."""
    while True:
        low = run = 0
        for c in struct[start - 1 : stop]:
            run += (c == "(") - (c == ")")
            low = min(low, run)
        if low < 0 and start > 1:
            start -= 1
        elif run - low > 0 and stop < len(struct):
            stop += 1
        else:
            return start, stop


def test_regions_grow_as_place_by_place(spark):
    r = np.random.default_rng(8)
    structs = {}
    for g in range(40):
        out, depth = [], 0
        for _ in range(int(r.integers(1, 30))):
            c = r.choice(list("(.)"), p=[0.4, 0.3, 0.3])
            c = "." if c == ")" and not depth else c
            depth += (c == "(") - (c == ")")
            out.append(c)
        structs[g] = "".join(out) + ")" * (depth if g % 2 else 0)
    regions = [(100 * g + k, g, a, min(a + b, len(s))) for g, s in structs.items() for k in range(6) for a, b in [(int(r.integers(1, len(s) + 1)), int(r.integers(0, 9)))]]
    got = trees.extend_regions(spark.createDataFrame(regions, "rid long, graph_id long, start int, stop int"), spark.createDataFrame(list(structs.items()), "graph_id long, struct string"))
    assert {x.rid: (x.start, x.stop) for x in got.collect()} == {i: grown(structs[g], a, b) for i, g, a, b in regions}


def worth(ids, dens, lists):
    listed = sum(len(lists[i]) for i in ids)
    return sum(dens[i] for i in ids) * len(set().union(*(lists[i] for i in ids))) / listed


def test_exchanges_never_lose(spark):
    r = np.random.default_rng(9)
    lists = {i: {i, *map(int, r.choice(200, 8))} for i in range(200)}
    dens = {i: float(np.round(r.random(), 3)) for i in range(200)}
    near = spark.createDataFrame([(i, b, k + 1, 0.5) for i, m in lists.items() for k, b in enumerate(sorted(m))], "a long, b long, rank int, sim double")
    of = spark.createDataFrame(list(dens.items()), "id long, density double")
    first = [3, 50, 120, 77]
    start = spark.createDataFrame([(k + 1, i, dens[i]) for k, i in enumerate(first)], "center_rank int, id long, density double")
    last = worth(first, dens, lists)
    for tries in (0, 20, 200, 100_000):
        got = [x.id for x in density.refine_centers(start, near, of, tries).orderBy("center_rank").collect()]
        now = worth(got, dens, lists)
        assert len(set(got)) == 4 and now >= last - 1e-12
        last = now
    assert last > worth(first, dens, lists)
    cover = density.Coverage()
    for i in got:
        cover.put(dens[i], frozenset(lists[i]))
    assert abs(cover.worth() - last) < 1e-12


def test_a_tree_as_deep_as_its_leaves(spark):
    """A chain of 1,200 leaves: each joins what the ones before made; neither the tree nor its text recurses."""
    n = 1200
    t = spark.range(n).select(F.lit(1).cast("long").alias("group"), F.col("id").alias("j")).join(spark.range(n).select(F.col("id").alias("i")), F.col("i") < F.col("j"))
    tree = trees.average_linkage(t.select("group", "i", "j", F.col("j").cast("double").alias("d"))).persist()
    assert tree.count() == 2 * n - 1
    assert tree.where("not leaf").agg(F.sum("leaves")).first()[0] == sum(range(2, n + 1))
    text = trees.newick(tree).first().newick
    assert text.count(",") == n - 1 and text.count("(") == text.count(")") == n - 1
