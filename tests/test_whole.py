"""Queries on tables of a few rows whose results need every row and every position."""

from __future__ import annotations

import random

import numpy as np

from lamina.operators import sequences
from lamina.plans import QUERIES


def test_co_exclusion_over_all_orders(spark, tmp_path):
    spark.createDataFrame([(1, "X", 0), (2, "X", 1), (3, "X", 2)], "c_custkey long, c_mktsegment string, c_nationkey long").write.parquet(str(tmp_path / "customer.parquet"))
    # Nations 0 and 1 meet in 1 % 7 = 15 % 7 only.
    spark.createDataFrame([(1, 3), (1, 1), (2, 4), (2, 15), (3, 2)], "o_custkey long, o_orderkey long").selectExpr("*", "'P' AS o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    assert sorted(tuple(r) for r in QUERIES["j15_co_exclusion"](spark, str(tmp_path)).collect()) == [("X", 0, 2), ("X", 1, 2)]


def test_consensus_difference_at_every_position(spark, tmp_path):
    text = "A" * 250
    spark.createDataFrame([(1, text), (2, f"AB{text[2:229]}B{text[230:]}")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert sorted(tuple(r) for r in QUERIES["j13_consensus_difference"](spark, str(tmp_path)).collect()) == [(1, 2, "C", "A"), (1, 230, "C", "A")]


def near_threshold(rng, need):
    """A sequence and a copy of it whose similarity is just enough."""
    grams = lambda s: {s[i : i + 11] for i in range(len(s) - 10)}
    while True:
        one = "".join(rng.choice("ACGT") for _ in range(400))
        two = list(one)
        while True:
            two[rng.randrange(400)] = rng.choice("ACGT")
            x, y = grams(one), grams("".join(two))
            j = len(x & y) / len(x | y)
            if j < 0.44:
                break
        if j >= need:
            return one, "".join(two)


def test_genes_at_the_threshold_are_linked(spark):
    need, rng = 0.95**11 / (2 - 0.95**11), random.Random(1)
    seqs = [s for _ in range(12) for s in near_threshold(rng, need)]
    genes = spark.createDataFrame(list(enumerate(seqs)) + [(90, "ACG"), (91, "ACG")], "id long, seq string")
    want = {i: i | 1 for i in range(24)} | {90: 91, 91: 91}
    assert {r.id: r.cluster for r in sequences.cluster_genes(genes).collect()} == want


def test_gene_links_by_blocks():
    need, rng = 0.95**11 / (2 - 0.95**11), random.Random(2)
    seqs = [s[: rng.randrange(150, 401)] for _ in range(15) for s in near_threshold(rng, need)] + ["A" * 50] * 9
    sets = [sequences.kmer_set(s, 11) for s in seqs]

    def groups(links):
        root = list(range(len(seqs)))
        for a, b in links:
            root = [root[a] if r == root[b] else r for r in root]
        return [root.index(r) for r in root]

    def linked(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return both >= need * (len(sets[a]) + len(sets[b]) - both)

    pairs = [(a, b) for a in range(len(seqs)) for b in range(a) if linked(a, b)]
    one, two = np.zeros(len(seqs), bool), np.arange(len(seqs)) % 2 > 0
    for rows in (4, 2048):
        assert groups(sequences.gene_links(seqs, one, 11, need, rows)) == groups(pairs)
        assert groups(sequences.gene_links(seqs, two, 11, need, rows)) == groups([(a, b) for a, b in pairs if two[a] != two[b]])
