"""Modules, pileups, trees, identity clusters and models over counts against plain versions."""

from __future__ import annotations

import math
import os
import random
import subprocess
import sys
import time
from collections import Counter, defaultdict
from itertools import combinations
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.functions import seq as S
from lamina.operators import association, correlate, graph, homology, intervals, matrix, modules, pileup, sequences, variants
from tests.conftest import ROOT
from tests.test_files_and_plain_versions import pearson, plain_canopies

# Modules.


@pytest.mark.parametrize(
    ("text", "form"),
    [
        ("K1 (K2,K3 K4) K5+K6-K7", "steps[K1 choice[K2 steps[K3 K4]] complex[?K7 K5 K6]]"),
        ("K1", "K1"),
        ("((K1))", "K1"),
        (" K1 + K2 -(K3,K4) ", "complex[?choice[K3 K4] K1 K2]"),
        ("K1,K2 K3", "choice[K1 steps[K2 K3]]"),
        ("K1 -K2", "complex[?K2 K1]"),
        ("K1 () (-K2)", "steps[?complex[?K2] K1]"),
        ("(-K1,K2) (-K3,-K4)", "steps[?choice[?complex[?K3] ?complex[?K4]] choice[?complex[?K1] K2]]"),
        ("", None),
    ],
)
def test_parse_definition(text, form):
    tree = modules.parse_definition(text)
    if form is not None or not text:
        assert (tree and modules.canonical(tree)) == form


def test_broken_definitions_raise():
    for text in ("(K1", "K1)", "((K1)"):
        with pytest.raises(modules.DefinitionError):
            modules.parse_definition(text)


def random_definition(rng, depth=0):
    name = lambda: f"K{rng.randrange(12)}"
    part = lambda: name() if depth > 2 or rng.random() < 0.6 else f"({random_definition(rng, depth + 1)})"
    step = lambda: part() + "".join(rng.choice("+-") + part() for _ in range(rng.choice((0, 0, 1, 2))))
    steps = lambda: " ".join(step() for _ in range(rng.choice((1, 2, 3))))
    return ",".join(steps() for _ in range(rng.choice((1, 1, 2))))


def plain_score(node, have, least):
    """(score, value), None where nothing of the node is present."""
    kind, rest = node
    if kind == modules.LEAF:
        return (1.0, have[rest]) if rest in have else None
    found = [(need, plain_score(n, have, least)) for need, n in rest]
    here = [(need, s) for need, s in found if s is not None]
    if not here:
        return None
    values = [v for _, (s, v) in here if s > 0]
    if kind == modules.CHOICE:
        return max(s for _, (s, _) in here), sum(values) if values else None
    needed = sum(need for need, _ in rest)
    share = sum(s for need, (s, _) in here if need) / needed if needed else 1.0
    return (float(share >= least) if kind == modules.COMPLEX else share), median(values) if values else None


def test_modules_against_a_plain_walk(spark):
    rng = random.Random(4)
    texts = {f"M{i:02}": random_definition(rng) for i in range(25)}
    texts |= {"M90": texts["M03"], "M91": "K1 K2", "M92": "K2 K1", "M93": "", "M94": None, "M95": "Z1 (Z2,Z3)"}
    extra = [("M91", "Q1 Q2 Q3")]  # a second definition
    abund = {s: {f"K{k}": float(rng.randrange(1, 50)) for k in range(12) if rng.random() < 0.5} | ({"Q1": 3.0, "Q2": 5.0} if s % 2 else {}) for s in range(6)}
    rows = [(f, s, v) for s, own in abund.items() for f, v in own.items()] + [("K1", 99, 0.0), (None, 1, 2.0)]
    definitions = spark.createDataFrame([*texts.items(), *extra, (None, "K1")], "module string, definition string")
    own = spark.createDataFrame(rows, "feature string, sample int, value double")
    for redundancy, collapse in ((None, False), (5, True), (1, True)):
        got = {(r.module, r.sample): (round(r.complete, 9), round(r.value, 9)) for r in modules.module_completeness(definitions, own, 0.4, 0.5, redundancy, collapse).collect()}
        trees = defaultdict(list)
        for m, t in [*texts.items(), *extra]:
            if t and (tree := modules.parse_definition(t)):
                trees[m].append(tree)
        if collapse:
            first = {}
            for m in sorted(trees):
                for t in trees[m]:
                    first.setdefault(modules.canonical(t), m)
            kept = defaultdict(dict)
            for m in trees:
                for t in trees[m]:
                    kept[first[modules.canonical(t)]][modules.canonical(t)] = t
            trees = {m: list(v.values()) for m, v in kept.items()}

        def leaves(t):
            return {t[1]} if t[0] == modules.LEAF else set().union(*(leaves(n) for _, n in t[1]))

        uses = Counter(f for m, own_ in trees.items() for f in set().union(*map(leaves, own_)))
        want = {}
        for m, own_ in trees.items():
            for s, have in abund.items():
                best = []
                for t in own_:
                    rare = {f for f in leaves(t) if redundancy is None or uses[f] <= redundancy}
                    score = plain_score(t, have, 0.5)
                    if score and score[0] > 0 and (not rare or rare & set(have)):
                        best.append(score)
                if best and max(best)[0] >= 0.4:
                    want[m, s] = tuple(round(x, 9) for x in max(best))
        assert got == want
    assert modules.module_completeness(definitions.limit(0), own).collect() == []
    assert modules.module_completeness(definitions, own.limit(0)).collect() == []


# Pileups.


def plain_pileup(reads, min_mapq, min_quality):
    depth, bases = Counter(), defaultdict(Counter)
    for contig, pos, cigar, seq, qual, mapq in reads:
        if contig is None or pos is None or (mapq or 0) < min_mapq:
            continue
        at, read, number, ops = pos, 0, "", []
        for c in (cigar or "").strip("*"):
            if c.isdigit():
                number += c
            else:
                ops.append((int(number), c))
                number = ""
        for n, op in ops:
            for k in range(n):
                if op in "M=X":
                    depth[contig, at + k] += 1
                    b = seq[read + k : read + k + 1].upper()
                    if b and (qual in (None, "*") or ord(qual[read + k]) - 33 >= min_quality):
                        bases[contig, at + k][b.lower() if b in "ACGT" else "n"] += 1
                elif op == "D":
                    bases[contig, at + k]["deleted"] += 1
            if op == "I" and at > 1:
                bases[contig, at - 1]["inserted"] += 1
            at += n if op in "MDN=X" else 0
            read += n if op in "MIS=X" else 0
    return depth, bases


def test_pileup_against_a_plain_walk(spark):
    rng = random.Random(8)
    reads = []
    for i in range(600):
        ops = [(rng.randrange(1, 9), rng.choice("MMM=XDINS")) for _ in range(rng.randrange(1, 6))]
        if i % 3 == 0:
            ops = [(2, "H"), *ops, (3, "S")]
        n = sum(k for k, op in ops if op in "MIS=X")
        seq = "".join(rng.choice("ACGTNacgt") for _ in range(n))
        qual = None if i % 5 == 0 else "*" if i % 5 == 1 and n > 1 else "".join(chr(33 + rng.randrange(41)) for _ in range(n))
        reads.append((("c1", "c1", "c1", "c2")[i % 4], rng.randrange(1, 400), "".join(f"{k}{op}" for k, op in ops), seq, qual, rng.randrange(60)))
    reads += [("c3", 5, None, "ACGT", None, 60), ("c3", 5, "*", "ACGT", None, 60), ("c3", 5, "4", "ACGT", None, 60), (None, 5, "4M", "ACGT", None, 60), ("c3", None, "4M", "ACGT", None, 60), ("c4", 1, "4M", "ACGT", "IIII", None), ("c5", 7, "2M", "AC", None, 60), ("c5", 7, "2M", "AC", None, 60)]
    df = spark.createDataFrame(reads, "contig string, pos long, cigar string, seq string, qual string, mapq int").withColumn("end", F.lit(1)).repartition(5)
    depth, bases = plain_pileup(reads, 10, 20)
    got = {}
    for r in pileup.depth_runs(df, 10).collect():
        assert (r.contig, r.end + 1) not in depth or depth[r.contig, r.end + 1] != r.depth  # runs are maximal
        for p in range(r.start, r.end + 1):
            assert (r.contig, p) not in got
            got[r.contig, p] = r.depth
    assert got == dict(depth)
    counts = pileup.base_counts(df, 10, 20)
    names = ("a", "c", "g", "t", "n", "deleted", "inserted")
    assert {(r.contig, r.pos): tuple(r[k] for k in names) for r in counts.collect()} == {k: tuple(v[x] for x in names) for k, v in bases.items() if v}
    assert all(r.depth == r.a + r.c + r.g + r.t + r.n for r in counts.collect())
    assert pileup.depth_runs(df.limit(0)).collect() == [] and pileup.base_counts(df.limit(0)).collect() == []
    regions = spark.createDataFrame([(0, "c2", 1, 200), (1, "c1", 201, 500), (2, "c1", 1, 200), (3, "c2", 201, 500)], "region int, contig string, start long, end long")
    ordered = [(r.region, r.pos) for r in pileup.in_region_order(counts.select("contig", "pos", "depth"), regions, 64).collect()]
    assert ordered == sorted(ordered) and {k for k, _ in ordered} == {0, 1, 2, 3}
    ref = spark.createDataFrame([("c1", "ACGT" * 50)], "contig string, seq string")
    for r in pileup.pileup_calls(counts, ref, 16).collect():
        own = bases[r.contig, r.pos]
        best = max((own[x], -i, x.upper()) for i, x in enumerate("acgt") if x.upper() != r.ref)
        assert r.ref == ("ACGT" * 50)[r.pos - 1] and r.alt == (best[2] if best[0] else ".") and r.freq == (best[0] / r.depth if r.depth else 0)


def test_one_contig_spans_many_tasks(spark):
    reads = spark.range(4_000).select(F.lit("c").alias("contig"), (F.col("id") * 5 + 1).alias("pos"), F.lit("20M").alias("cigar"), F.lit("ACGT" * 5).alias("seq"))
    runs = pileup.depth_runs(reads)
    assert runs.agg(F.sum(F.expr("depth * (end - start + 1)"))).first()[0] == 80_000
    assert runs.filter("depth = 4").count() == 1


def test_depth_as_bed(spark):
    rng = random.Random(3)
    rows = [(c, p, rng.randrange(3)) for c in ("a", "b") for p in range(1, 300) if rng.random() < 0.9]
    want, last = set(), None
    for c, p, d in rows:
        if last and last[0] == c and last[2] == p - 1 and last[3] == d:
            last[2] = p
        else:
            if last:
                want.add((last[0], last[1], last[2], last[3]))
            last = [c, p - 1, p, d]
    want.add(tuple(last))
    got = {tuple(r) for r in intervals.depth_to_bed(spark.createDataFrame(rows, "chr string, pos int, depth int").repartition(7)).select("chr", "start", "end", "value").collect()}
    assert got == want


# Consensus.


def test_consensus_and_differences(spark):
    rng = random.Random(6)
    sites = {(c, p): rng.choice("ACGTN") for c in ("x", "y") for p in range(1, 260) if rng.random() < 0.3}
    calls = spark.createDataFrame([(c, p, b) for (c, p), b in sites.items()] + [("y", 900, "A")], "contig string, pos int, base string")
    contigs = spark.createDataFrame([("x", 257), ("y", 100), ("z", 33), ("e", 1)], "contig string, length int")
    got = defaultdict(dict)
    for r in variants.consensus(calls, contigs, 32).collect():
        got[r.contig][r.block] = r.seq
    for c, n in (("x", 257), ("y", 100), ("z", 33), ("e", 1)):
        assert "".join(got[c][k] for k in sorted(got[c])) == "".join(sites.get((c, p), "n") for p in range(1, n + 1))
    pairs = {k: ("".join(rng.choice("ACGTN-") for _ in range(n)), "".join(rng.choice("ACGT") for _ in range(m))) for k, n, m in ((1, 90, 90), (2, 70, 64), (3, 64, 70), (4, 0, 5))}
    cons, ref = (spark.createDataFrame([(k, v[i]) for k, v in pairs.items()], "contig int, seq string") for i in (0, 1))
    asked = [(k, p) for k in pairs for p in range(1, 95, 2)] + [(1, 5), (9, 1)]
    want = Counter((k, p, pairs[k][1][p - 1 : p], pairs[k][0][p - 1 : p]) for k, p in asked if k in pairs and pairs[k][0][p - 1 : p] not in ("", "N") and pairs[k][0][p - 1 : p] != pairs[k][1][p - 1 : p])
    assert Counter(tuple(r) for r in variants.consensus_differences(cons, ref, spark.createDataFrame(asked, "contig int, pos int"), 16).collect()) == want


def test_time_grows_with_length(spark):
    """Twice the bases take about twice the time, not four times."""
    took = []
    for n in (200_000, 400_000):
        a = spark.createDataFrame([("c", "ACGT" * (n // 4))], "contig string, seq string")
        b = a.select("contig", F.regexp_replace("seq", "ACGTACGTACGTACGT", "ACGTACGTACGTACGA").alias("seq"))
        began = time.perf_counter()
        assert variants.consensus_differences(a, b, spark.range(1, n + 1).select(F.lit("c").alias("contig"), F.col("id").alias("pos"))).count() == n // 16
        calls = spark.range(1, n + 1).select(F.lit("c").alias("contig"), F.col("id").alias("pos"), F.lit("A").alias("base"))
        assert variants.consensus(calls, spark.createDataFrame([("c", n)], "contig string, length int"), 20_000).agg(F.sum(F.length("seq"))).first()[0] == n
        took.append(time.perf_counter() - began)
    assert took[1] < 3.5 * took[0] + 2


# Trees.


def plain_distances(parent, length, name):
    up = {}
    for leaf in name:
        at, d, own = leaf, 0.0, {}
        while at is not None:
            own[at] = d
            d += length[at]
            at = parent[at]
        up[leaf] = own
    out = {}
    for x, y in combinations(name, 2):
        if name[x] != name[y]:
            a, b = sorted((name[x], name[y]))
            out[a, b] = min(up[x][n] + up[y][n] for n in up[x] if n in up[y])
    return out


def test_distances_on_random_trees(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for tree in range(8):
        n = (1, 2, 3, 12, 30, 60, 60, 40)[tree]
        numbers = list(range(n))
        rng.shuffle(numbers)  # any numbering will do
        parent = {numbers[0]: None} | {numbers[i]: numbers[rng.randrange(max(0, i - 3), i)] for i in range(1, n)}
        length = {k: float(rng.randrange(1, 20)) / 4 for k in parent}
        length[numbers[0]] = 0.0
        inner = set(parent.values())
        name = {k: f"t{k}" for k in parent if k not in inner}
        rows += [(tree, k, parent[k], name.get(k), length[k]) for k in parent]
        want |= {(tree, *k): v for k, v in plain_distances(parent, length, name).items()}
    nodes = spark.createDataFrame(rows, "tree int, node int, parent int, name string, len double")
    got = {(r.tree, r.a, r.b): r.dist for r in graph.patristic(nodes, "tree").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert graph.patristic(nodes.limit(0), "tree").collect() == []


def test_a_caterpillar_of_a_thousand_leaves(spark):
    text = "a0:1"
    for i in range(1, 1000):
        text = f"({text},a{i}:1):1"
    trees = spark.createDataFrame([(1, text + ";")], "tree int, newick string")
    nodes = graph.tree_nodes(trees, "tree", "newick")
    began = time.perf_counter()
    out = graph.patristic(nodes, "tree").cache()
    assert out.count() == 1000 * 999 // 2
    assert time.perf_counter() - began < 60
    pick = {(r.a, r.b): r.dist for r in out.filter("a in ('a0', 'a1') or (a = 'a10' and b = 'a990')").collect()}
    assert pick["a0", "a1"] == 2 and pick["a1", "a999"] == 1 + 1 + 998 and pick["a10", "a990"] == 2 + 980
    out.unpersist()
    assert not [t.name for t in spark.catalog.listTables() if t.isTemporary and "tree" in t.name]


# Identity clusters.


def plain_edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, s, n):
    s = list(s)
    for _ in range(n):
        k = rng.randrange(len(s) + 1)
        kind = rng.randrange(3)
        if kind == 1 or k == len(s):
            s.insert(k, rng.choice("ACGT"))
        elif kind == 0:
            s[k] = rng.choice("ACGT")
        else:
            del s[k]
    return "".join(s)


def test_banded_distance():
    rng = random.Random(2)
    for _ in range(400):
        a = "".join(rng.choice("ACGT") for _ in range(rng.choice((0, 1, 7, 20, 41, 90))))
        b = changed(rng, a, rng.randrange(12))
        most = rng.randrange(14)
        assert homology.banded_distance(homology.codes_of(a), homology.codes_of(b), most) == min(plain_edit(a, b), most + 1)


@pytest.mark.parametrize("identity", [0.95, 0.9, 0.8])
def test_no_link_is_missed(spark, identity):
    """Clusters are those of all pairs, planted at, under and over the threshold."""
    rng = random.Random(int(identity * 100))
    seqs = []
    for size in (12, 19, 20, 21, 40, 60, 61, 100, 120):
        for _ in range(3):
            base = "".join(rng.choice("ACGT") for _ in range(size))
            e = homology.edits_allowed(size, identity)
            family = [base, changed(rng, base, e), changed(rng, base, max(e - 1, 0)), changed(rng, base, e + 1), changed(rng, base, 2 * e + 1)]
            seqs += family + [changed(rng, family[1], e), base[e:], base + base[:e]]
    seqs += ["", "", "A", "A", "AAAA" * 20, "AAAA" * 20 + "A", "ACAC" * 20, "é" * 30, "é" * 29 + "A"]
    root = list(range(len(seqs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(seqs)), 2):
        if find(i) != find(j) and abs(len(seqs[i]) - len(seqs[j])) <= (e := homology.edits_allowed(max(len(seqs[i]), len(seqs[j])), identity)) and plain_edit(seqs[i], seqs[j]) <= e:
            root[find(j)] = find(i)
    best = {}
    for i, s in enumerate(seqs):
        best[find(i)] = max(best.get(find(i), (-1, -1)), (len(s), i))
    df = spark.createDataFrame([*enumerate(seqs), (None, "ACGT"), (1000, None)], "id int, seq string").repartition(4)
    got = {r.id: r.cluster for r in homology.identity_clusters(df, identity).collect()}
    assert got == {i: best[find(i)][1] for i in range(len(seqs))}
    assert homology.identity_clusters(df.limit(0), identity).collect() == []


# Counts.


def test_exclusion_test(spark):
    rng = random.Random(5)
    n = 40
    sets = {f"f{i:02}": {s for s in range(n) if rng.random() < rng.choice((0.1, 0.5, 0.6))} for i in range(30)}
    sets |= {"x": set(range(20)), "y": set(range(20, 40)), "z": set(range(19, 39)), "all": set(range(n))}
    rows = [(f, s) for f, own in sets.items() for s in own] * 2 + [(None, 1), ("x", None)]
    choose = math.comb
    want = {}
    for a, b in combinations(sorted(f for f, own in sets.items() if own), 2):
        na, nb, x = len(sets[a]), len(sets[b]), len(sets[a] & sets[b])
        p = sum(choose(na, i) * choose(n - na, nb - i) for i in range(max(0, na + nb - n), x + 1)) / choose(n, nb)
        if p <= 1e-3 and x <= na * nb / n:
            want[a, b] = (na, nb, x, p)
    got = {(r.a, r.b): (r.na, r.nb, r.shared, r.p) for r in association.co_exclusion_test(spark.createDataFrame(rows, "feature string, sample int"), 1e-3).collect()}
    assert ("x", "y") in want and ("x", "z") in want and got.keys() == want.keys()
    assert all(got[k][:3] == want[k][:3] and abs(got[k][3] - want[k][3]) <= 1e-9 * want[k][3] + 1e-15 for k in want)
    assert association.co_exclusion_test(spark.createDataFrame([], "feature string, sample int")).collect() == []


def plain_d2s(one, two, k):
    def centred(seqs):
        c = Counter()
        for s in seqs:
            for i in range(len(s) - k + 1):
                w = s[i : i + k]
                if set(w) <= set("ACGT"):
                    c[w] += 1
                    c[w[::-1].translate(str.maketrans("ACGT", "TGCA"))] += 1
        share = Counter()
        for w, n in c.items():
            for b in w:
                share[b] += n
        total, all_ = sum(c.values()), sum(share.values())
        words = [""]
        for _ in range(k):
            words = [w + b for w in words for b in "ACGT"]
        return {w: c[w] - total * math.prod(share[b] / all_ for b in w) for w in words} if total else None

    x, y = centred(one), centred(two)
    if x is None or y is None:
        return None
    root = {w: math.hypot(x[w], y[w]) for w in x}
    xy, xx, yy = (sum(u[w] * v[w] / root[w] for w in x if root[w]) for u, v in ((x, y), (x, x), (y, y)))
    return 0.5 * (1 - xy / math.sqrt(xx * yy))


def test_sample_distances(spark):
    rng = random.Random(12)
    own = {f"s{i}": ["".join(rng.choice("AACGT"[i % 2 :] + "N") for _ in range(rng.randrange(20, 90))) for _ in range(3)] for i in range(7)}
    own["none"] = ["NN", ""]
    df = spark.createDataFrame([(s, q) for s, seqs in own.items() for q in seqs] + [(None, "ACGT"), ("s1", None)], "sample string, seq string")
    for block in (64, 2):
        got = {(r.a, r.b): r.dist for r in association.sample_distances(df, 3, block=block).collect()}
        want = {(a, b): plain_d2s(own[a], own[b], 3) for a, b in combinations(sorted(own), 2)}
        assert got.keys() == want.keys()
        assert all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)


def test_depth_model(spark):
    rng = np.random.default_rng(1)
    data = {"a": rng.negative_binomial(3, 0.1, 4000), "b": rng.poisson(20, 4000) // 1, "c": np.array([5, 5, 5]), "d": np.array([0, 0]), "e": rng.negative_binomial(0.4, 0.01, 3000)}
    df = spark.createDataFrame([(k, int(x)) for k, v in data.items() for x in v] + [("a", None), ("a", -1)], "key string, depth long")
    got = {r.key: r for r in association.depth_model(df, "key").collect()}

    def loglik(x, mean, k):
        return sum(math.lgamma(v + k) - math.lgamma(k) - math.lgamma(v + 1) + k * math.log(k / (k + mean)) + v * math.log(mean / (k + mean)) for v in x.tolist())

    for key in ("a", "e"):
        r, x = got[key], data[key]
        assert r.n == len(x) and abs(r["mean"] - x.mean()) < 1e-9
        assert abs(r.loglik - loglik(x, r["mean"], r.size)) < 1e-5
        assert all(loglik(x, r["mean"], r.size * f) < r.loglik for f in (0.97, 0.999, 1.001, 1.03))
    assert abs(got["a"].size - 3) < 0.4 and abs(got["e"].size - 0.4) < 0.05
    assert got["c"].size is None and abs(got["c"].loglik - 3 * (5 * math.log(5) - 5 - math.log(120))) < 1e-9
    assert got["d"].size is None and got["d"].loglik == 0


def test_kmer_windows(spark):
    rng = random.Random(7)
    seqs = {i: "".join(rng.choice("ACGTACGTN") for _ in range(n)) for i, n in enumerate((0, 2, 3, 9, 10, 11, 25, 60, 200))}
    for k, size, step in ((2, 10, 5), (3, 10, 10), (1, 7, 3), (3, 12, 20)):
        want = {}
        for i, s in seqs.items():
            for at in range(0, max(len(s) - size, 0) + 1, step):
                c = Counter()
                part = s[at : at + size]
                for j in range(len(part) - k + 1):
                    w = part[j : j + k]
                    if "N" not in w:
                        c[w] += 1
                        c[w[::-1].translate(str.maketrans("ACGT", "TGCA"))] += 1
                for w, n in c.items():
                    want[i, at, w] = (n, math.floor(n * 100000.0 / sum(c.values()) + 0.5) / 1000)
        df = spark.createDataFrame([*seqs.items(), (99, None)], "id int, seq string").repartition(3)
        assert {(r.id, r.start, r.kmer): (r.n, r.percent) for r in sequences.kmer_windows(df, k, size, step, 64).collect()} == want
    with pytest.raises(ValueError):
        sequences.kmer_windows(df, 5, 4)


def test_length_ladder(spark):
    rng = random.Random(1)
    own = {g: [rng.choice((1, 5, 5, 17, 40, 333)) for _ in range(n)] for g, n in (("a", 1), ("b", 7), ("c", 150))}
    df = spark.createDataFrame([(g, x) for g, v in own.items() for x in v] + [("a", 0), ("a", None)], "g string, l long")
    for genome in (None, 2000):
        d = df.withColumn("size", F.lit(genome).cast("long"))
        got = {(r.g, r.x): (r.nx, r.lx) for r in matrix.length_ladder(d, ["g"], "l", "size" if genome else None).collect()}
        want = {}
        for g, v in own.items():
            for x in range(1, 101):
                total = 0
                for k, n in enumerate(sorted(v, reverse=True), 1):
                    total += n
                    if total * 100 >= x * (genome or sum(v)):
                        want[g, x] = (n, k)
                        break
        assert got == want


def test_common_substring(spark):
    rng = random.Random(3)

    def plain(a, b):
        found = [a[i:j] for i in range(len(a)) for j in range(i + 1, len(a) + 1) if a[i:j] in b]
        return max(found, key=len, default="")

    pairs = [("".join(rng.choice("abé") for _ in range(rng.randrange(15))), "".join(rng.choice("abé") for _ in range(rng.randrange(15)))) for _ in range(200)] + [("same", "same"), ("", "x"), (None, "x"), ("x", None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.s for r in df.select(S.common_substring(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [None if a is None or b is None else plain(a, b) for a, b in pairs]
    long = "".join(rng.choice("ACGT") for _ in range(60_000))
    assert S.longest_shared(long, "T" * 50 + long[1000:31_000] + "G" * 50) in long
    assert len(S.longest_shared(long, "T" * 50 + long[1000:31_000] + "G" * 50)) >= 30_000


def test_canopies_by_ranks(spark):
    rng = random.Random(17)
    base = [[rng.randrange(0, 40) for _ in range(12)] for _ in range(9)]
    profiles = {i: [float(max(0, x * rng.choice([1, 2, 3]) / 2 + rng.randrange(-4, 5))) for x in rng.choice(base)] for i in range(120)}

    def rank(p):
        return [sum(y < x for y in p) + (sum(y == x for y in p) - 1) / 2 for x in p]

    own, centres = plain_canopies(profiles, 0.2, 0.15, lambda x, y: pearson(rank(x), rank(y)))
    assert 1 < len(set(own.values())) < len(own) and own != plain_canopies(profiles, 0.2, 0.15)[0]
    df = spark.createDataFrame(list(profiles.items()), "feature long, profile array<double>")
    for batch in (2048, 7):
        got = correlate.canopies(df, 0.2, 0.15, batch=batch, method="spearman").collect()
        assert {r.feature: r.canopy for r in got} == own
        assert all(np.allclose(r.profile, centres[r.canopy]) for r in got)
    with pytest.raises(ValueError):
        correlate.canopies(df, method="kendall")


def test_window_trim(spark):
    rng = random.Random(5)
    quals = [None, "", "I", "III", "!!!!", "IIII!!!!", "!!!!IIII"] + ["".join(chr(33 + rng.randrange(41)) for _ in range(rng.randrange(30))) for _ in range(300)]
    rows = [(i, None if q is None else "A" * len(q), q) for i, q in enumerate(quals)]

    def plain(q, window, least):
        for i in range(len(q or "") - window + 1):
            if sum(ord(c) - 33 for c in q[i : i + window]) / window < least:
                return q[:i]
        return q

    df = spark.createDataFrame(rows, "id int, seq string, qual string").repartition(3)
    for window, least in ((4, 20.0), (1, 5.0), (10, 18.5)):
        got = {r.id: (r.seq, r.qual) for r in sequences.window_trim(df, window, least).collect()}
        assert got == {i: (None if q is None else "A" * len(plain(q, window, least)), plain(q, window, least)) for i, _, q in rows}


def test_newick_in_sql(spark):
    graph.register_newick(spark)
    got = spark.sql("SELECT t.id, n.node, n.parent, n.name, n.len FROM VALUES (1, '((a:1,b:2):3,c:4);'), (2, 'x;'), (3, NULL) AS t(id, text), LATERAL newick_nodes(t.text) n").collect()
    assert {(r.id, r.name, r.len) for r in got if r.name} == {(1, "a", 1.0), (1, "b", 2.0), (1, "c", 4.0), (2, "x", 0.0)}


def test_shipped_from_another_folder(tmp_path):
    """Python workers find the package when only the driver's path has it."""
    script = tmp_path / "run.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {ROOT!r})\n"
        "from lamina.session import get_spark, ship\nfrom lamina.operators import sequences\n"
        "spark = get_spark('shipped', 'local[2]', spark__ui__enabled='false')\nship(spark)\n"
        "print('COUNT', sequences.kmer_profile(spark.createDataFrame([(1, 'ACGTT')], 'id int, seq string'), 2).count())\nspark.stop()\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=False)
    assert "COUNT 5" in out.stdout, out.stderr[-2000:]
