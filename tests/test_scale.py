"""Forms of the operators that hold at size: work dealt into blocks, and nothing sent that isn't needed."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.functions import seq as S
from lamina import shared
from lamina.operators import bins, graph, homology, matrix, modules, overlap, pileup, sequences
from lamina.plans.registry import Tables
from lamina.plans.views import abund


def test_outgroup_among_rows_of_a_key(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), float(rng.randrange(40))) for i in range(90)]
    for many in (70, 3000):  # by bits, and by sets beyond 1,024 categories
        cogs = [(i, rng.randrange(many)) for i in range(88) for _ in range(rng.randrange(many))]
        df, c = spark.createDataFrame(rows, "id int, k int, v double"), spark.createDataFrame(cogs, "id int, cog long")
        got = {r.a: (r.b, r.dist, r.shared) for r in graph.outgroup_within(df, "k", "id", lambda m: F.abs(m["x_v"] - m["y_v"]), ["v"], c, 12).collect()}
        sets = {i: {x for j, x in cogs if j == i} for i in range(90)}
        want = {}
        for i, k, v in rows:
            own = sorted((abs(v - w), j, len(sets[i] & sets[j])) for j, l, w in rows if l == k and j != i and len(sets[i] & sets[j]) >= 12)
            if own:
                want[i] = (own[0][1], own[0][0], own[0][2])
        assert got == want and want


def test_pairs_of_a_key_are_dealt_by_their_number(spark):
    rows = spark.range(300).select((F.col("id") % 2).alias("k"), "id", (F.col("id") * 7 % 50).cast("double").alias("v"))
    made = graph.pairs_within(rows, "k", "id", ["v"], block=20, task_pairs=1000)
    assert made.rdd.getNumPartitions() >= 22
    got = [(r.a, r.b, r.x_v, r.y_v) for r in made.collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b, float(a * 7 % 50), float(b * 7 % 50)) for a in range(300) for b in range(a + 2, 300, 2)}
    near = graph.nearest(made.select("a", "b", F.abs(F.col("x_v") - F.col("y_v")).alias("dist")), 3, 1.0)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("WindowGroupLimit", 1)[1] or plan.count("WindowGroupLimit") == 2  # each task keeps its own nearest
    want = {(a, b, i + 1) for a in range(300) for i, (_, b) in enumerate(sorted((abs(a * 7 % 50 - b * 7 % 50), b) for b in range(a % 2, 300, 2) if a * 7 % 50 != b * 7 % 50)[:3])}
    assert {(r.a, r.b, r["rank"]) for r in near.collect()} == want


def test_nodes_hold_a_digest_of_their_form(spark):
    text = "+".join(f"K{i}" for i in range(5000))
    nodes = modules.definition_nodes(spark.createDataFrame([("a", text), ("b", "+".join(reversed(text.split("+")))), ("c", "K1,K2")], "module string, definition string"))
    assert nodes.count() == 2 * 5001 + 3 and nodes.agg(F.max(F.length("form"))).first()[0] == 64
    assert nodes.groupBy("module").agg(F.first("form").alias("f")).select("f").distinct().count() == 2


def test_limits_of_bins_dont_hang_on_the_order_of_sums(spark):
    rows = [(i, "m", 10, v, m) for i, (v, m) in enumerate([(2.2, True), (2.2 + 1e-15, True), (2.2, False), (2.4200000000000004, False), (2.42, False), (2.43, False), (2.201, True)])]
    got = bins.gene_importance(spark.createDataFrame(rows * 1, "gene int, mgs string, occ long, multibin double, is_marker boolean"))
    q75 = 2.42
    assert {r.gene for r in got.collect()} == {i for i, (_, _, _, v, m) in enumerate(rows) if round(v, 9) <= (2.2 if m else round(1.1 * q75, 9))}


def test_window_trim_in_slices(spark):
    rng = random.Random(2)
    rows = [(i, "A" * n, "".join(rng.choice("I+5") for _ in range(n))) for i, n in enumerate([0, 3, 900, 10, 40, 5000] * 5)]
    df = spark.createDataFrame(rows, "id int, seq string, qual string")
    whole = sequences.window_trim(df, 5, 20).collect()
    assert sequences.window_trim(df, 5, 20, slice_bytes=64).collect() == whole


def test_short_texts_are_compared_many_at_once(spark):
    rng = random.Random(3)
    words = ["", "\0", "a\0", "é😀a", "aé😀", *["".join(rng.choice("abc") for _ in range(rng.randrange(64))) for _ in range(60)]]
    pairs = [(rng.choice(words), rng.choice(words)) for _ in range(500)]
    at, size = S.shared_spans([p for p, _ in pairs], [q for _, q in pairs])
    for (p, q), s, n in zip(pairs, at.tolist(), size.tolist(), strict=True):
        want = max((p[i:j] for i in range(len(p)) for j in range(i, len(p) + 1) if p[i:j] in q), key=len, default="")
        assert p[s : s + n] == want


def test_common_prefix_by_halving(spark):
    rng = random.Random(4)
    pairs = [("".join(rng.choice("ab") for _ in range(rng.randrange(9))), "".join(rng.choice("ab") for _ in range(rng.randrange(9)))) for _ in range(300)] + [("é😀x", "é😀y"), (None, "a"), ("a", None)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", S.common_prefix(F.col("a"), F.col("b")).alias("p"))
    import os

    for r in df.collect():
        assert r.p == (None if r.a is None or r.b is None else os.path.commonprefix([r.a, r.b]))
    assert "filter" not in df._jdf.queryExecution().optimizedPlan().toString()  # no list of all places that differ


def test_windows_of_few_codes_are_counted_without_sorting():
    import numpy as np

    calls, real = [], np.lexsort
    rng = random.Random(6)
    data = np.frombuffer("".join(rng.choice("ACGTN") for _ in range(3000)).encode(), dtype=np.uint8)
    offs = np.array([0, 0, 5, 1200, 1203, 3000])
    np.lexsort = lambda *a: calls.append(1) or real(*a)
    try:
        got = sequences.window_counts(data, offs, 2, 100, 30)
    finally:
        np.lexsort = real
    assert not calls
    want = {}
    for row in range(5):
        text = data[offs[row] : offs[row + 1]].tobytes().decode()
        for w in range(max(len(text) - 100, 0) // 30 + 1):
            part = text[30 * w : 30 * w + 100]
            for i in range(len(part) - 1):
                if "N" not in part[i : i + 2]:
                    a, b = ("ACGT".index(x) for x in part[i : i + 2])
                    for code in (4 * a + b, 4 * (3 - b) + 3 - a):
                        want[row, w, code] = want.get((row, w, code), 0) + 1
    assert dict(zip(zip(*(x.tolist() for x in got[:3]), strict=True), got[3].tolist(), strict=True)) == want


def test_bases_are_counted_where_blocks_meet(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        a, d, b, n, c = (rng.randrange(1, 9) for _ in range(5))
        size = a + b + c + 2
        rows.append((f"c{rng.randrange(3)}", rng.randrange(1, 60), f"{a}M{d}D{b}M2I{c}M" if i % 3 else f"{a}M{d}N{b}M2I{c}M", "".join(rng.choice("ACGTacgtNé") for _ in range(size)), rng.choice([None, "*", "".join(rng.choice("!5I") for _ in range(size))]), 20, a, d, b, c))
    df = spark.createDataFrame([r[:6] for r in rows], "contig string, pos long, cigar string, seq string, qual string, mapq int")
    want = {}
    for contig, pos, _, seq, qual, _, a, d, b, c in rows:
        gone = "deleted" if "D" in _of(rows, contig, pos, seq) else None
        at, read = pos, 0
        for kind, n in (("m", a), (gone, d), ("m", b), ("i", 2), ("m", c)):
            for j in range(n if kind != "i" else 1):
                if kind == "m":
                    base = seq[read + j].upper()
                    if qual in (None, "*") or ord(qual[read + j]) - 33 >= 20:
                        want.setdefault((contig, at + j), []).append(base.lower() if base in "ACGT" else "n")
                elif kind == "i":
                    want.setdefault((contig, at - 1), []).append("inserted")
                elif kind:
                    want.setdefault((contig, at + j), []).append(kind)
            at += 0 if kind == "i" else n
            read += n if kind in ("m", "i") else 0
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # bins go on from batch to batch
    try:
        for size in (5, 4096):
            out = pileup.base_counts(df, 10, 20, size)
            got = {(r.contig, r.pos): r for r in out.collect()}
            assert got.keys() == want.keys()
            for key, r in got.items():
                assert all(r[k] == want[key].count(k) for k in ("a", "c", "g", "t", "n", "deleted", "inserted")) and r.depth == r.a + r.c + r.g + r.t + r.n
            ref = spark.createDataFrame([("c0", "ACGTN" * 9), ("c1", "acg" * 30)], "contig string, seq string")
            plain = {tuple(r) for r in pileup.pileup_calls(out.filter("depth > 0"), ref).collect()}
            assert {tuple(r) for r in pileup.alignment_calls(df, ref, 10, 20, size).collect()} == plain and plain
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "posexplode" not in plan and "Aggregate" not in plan  # no row a base
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _of(rows, contig, pos, seq):
    return next(r[2] for r in rows if r[0] == contig and r[1] == pos and r[3] == seq)


def test_profiles_are_made_where_sequences_of_an_id_meet(spark):
    rng = random.Random(9)
    rows = [(rng.choice([1, 2, 3, 4, 5, None]), "".join(rng.choice("ACGTN") for _ in range(rng.randrange(80)))) for _ in range(120)] + [(6, ""), (7, "A")]
    counts = {}
    for i, text in rows:
        for j in range(len(text) - 2):
            w = text[j : j + 3]
            if "N" not in w:
                for x in (w, w[::-1].translate(str.maketrans("ACGT", "TGCA"))):
                    counts.setdefault(i, {})[x] = counts.get(i, {}).get(x, 0) + 1
    want = {(i, w): int(n * 100000.0 / sum(c.values()) + 0.5) / 1000.0 for i, c in counts.items() for w, n in c.items()}
    df = spark.createDataFrame(rows, "id int, seq string")
    for size in (50, 1 << 20):
        out = sequences.kmer_profile(df, 3, 0, size)
        got = [(r.id, r.kmer, r.percent) for r in out.collect()]
        assert len(got) == len(want) and {(i, w): p for i, w, p in got} == want
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()


def sent_bytes(spark) -> int:
    """Bytes that all stages so far have written for shuffles."""
    g = spark.sparkContext._gateway
    empty = g.jvm.java.util.ArrayList
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(empty(), False, False, g.new_array(g.jvm.double, 0), empty()).iterator()
    total = 0
    while stages.hasNext():
        total += stages.next().shuffleWriteBytes()
    return total


def test_gene_blocks_are_read_not_copied(spark):
    rng = random.Random(5)
    one = ["".join(rng.choice("ACGT") for _ in range(600)) for _ in range(300)]
    seqs = [x for s in one for x in (s, s[:590])]
    before = sent_bytes(spark)
    got = {r.id: r.cluster for r in sequences.cluster_genes(spark.createDataFrame(list(enumerate(seqs)), "id long, seq string"), block=16).collect()}
    assert got == {i: i // 2 * 2 for i in range(600)}
    # 38 blocks: a copy for each block that a gene meets would be 38 times the letters.
    assert sent_bytes(spark) - before < 6 * sum(map(len, seqs))


def test_kmers_as_numbers_and_as_hashes_agree():
    rng = random.Random(6)
    seqs = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (0, 1, 3, 10, 11, 12, 50, 300)] + ["A", "AA", "A" * 11, "A" * 30]
    sets = []
    for plain in (True, False):
        t, who, size = sequences.block_kmers(seqs, 11, plain)
        assert (np.diff(t.astype(object)) >= 0).all()
        sets.append([set(t[who == i].tolist()) for i in range(len(seqs))])
        assert [len(x) for x in sets[-1]] == size.tolist() == [len(sequences.kmer_set(s, 11)) for s in seqs]
    for a in range(len(seqs)):
        assert [len(sets[0][a] & x) for x in sets[0]] == [len(sets[1][a] & x) for x in sets[1]]


def test_identity_blocks_are_read_and_no_piece_is_sent(spark):
    rng = random.Random(7)
    seqs = []
    for n in (200, 210, 400, 800):
        for _ in range(30):
            s = "".join(rng.choice("ACGT") for _ in range(n))
            t = list(s)
            for i in rng.sample(range(n), n // 20):
                t[i] = "ACGT"["ACGT".index(t[i]) - 1]
            seqs += [s, "".join(t), s[: n - n // 20]]
    df = spark.createDataFrame(list(enumerate(seqs)), "id long, seq string")
    before = sent_bytes(spark)
    got = {r.id: r.cluster for r in homology.identity_clusters(df).collect()}
    assert sent_bytes(spark) - before < 16 * sum(map(len, seqs))
    assert got == {i: i // 3 * 3 + 1 for i in range(len(seqs))}
    assert {r.id: r.cluster for r in homology.identity_clusters(df, rows=11).collect()} == got


def test_blocks_of_genes_are_counted_not_made_again(spark):
    rng = random.Random(8)
    one = ["".join(rng.choice("ACGT") for _ in range(300)) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(x for s in one for x in (s, s[:295]))), "id long, seq string").repartition(4)
    begin = time.monotonic()
    got = {r.id: r.cluster for r in sequences.cluster_genes(df, block=16).collect()}
    assert time.monotonic() - begin < 60  # 250 blocks, 31,000 pairs of blocks
    assert got == {i: i // 2 * 2 for i in range(4000)}


@pytest.mark.parametrize("rare", [True, False])
def test_no_pair_that_shares_enough_is_missed(rare):
    """Whatever the order, the part and the block: pairs at the limit are found, by both laws."""
    rng = random.Random(9)
    need = 0.95**11 / (2 - 0.95**11)
    width = homology.gram_width(0.95)
    laws = [(overlap.Law(need / (1 + need), need / (1 + need), 0.0, need, 0.0), lambda s: sequences.kmer_set(s, 11)), (homology.gram_law(0.95, width), lambda s: homology.grams(homology.codes_of(s), width))]
    seqs = []
    for _ in range(60):
        s = [rng.choice("ACGT") for _ in range(rng.choice((64, 90, 200, 700)))]
        for n in range(5):
            t = list(s)
            for i in rng.sample(range(len(s)), len(s) * n // 60):
                t[i] = rng.choice("ACGT")
            seqs.append("".join(t) + "ACG" * rng.randrange(9))
    for law, members in laws:
        sets = sorted((overlap.distinct(members(s)) for s in seqs), key=len)
        held = np.bincount(np.concatenate([overlap._ids(x) for x in sets]), minlength=1 << overlap.BITS)
        grade = np.minimum(16 * np.log2(1 + held), 255).astype(np.uint8) if rare else np.zeros(1 << overlap.BITS, dtype=np.uint8)
        blocks = []
        for a in range(0, len(sets), 40):
            some = [(len(x), *overlap._in_order(x, grade, law, 300.0)) for x in sets[a : a + 40]]
            size, want, codes = zip(*some, strict=True)
            blocks.append(overlap.Block({"names": None, "seqs": None, "sizes": np.array(size).tobytes(), "wants": np.array(want).tobytes(), "ends": np.cumsum([len(x) for x in codes]).tobytes(), "codes": np.concatenate(codes).tobytes()}))
        first = np.arange(0, len(sets), 40)
        assert 3 * sum(len(b.codes) for b in blocks) < 2.9 * sum(map(len, sets))
        told = set()
        for x in range(len(blocks)):
            for i, js in overlap.Places(blocks[:x], law, blocks[0].lo, 0).near(blocks[x]) if x else ():
                told |= {(int(j), first[x] + i) for j in js}
            for i, js in overlap.Places(blocks[x : x + 1], law, blocks[x].lo, int(first[x])).near(blocks[x], 0):
                told |= {(int(first[x] + j), first[x] + i) for j in js}
        want = {(a, b) for b in range(len(sets)) for a in range(b) if len(sets[a]) >= law.partner(len(sets[b])) and len(np.intersect1d(sets[a], sets[b])) >= law.least(len(sets[a]), len(sets[b]))}
        assert len(want) > 100 and want <= told and len(told) < 3 * len(want) + 500


def test_parts_and_blocks_give_the_same_clusters(spark):
    rng = random.Random(10)
    seqs = []
    for n in (70, 150, 400, 405, 1200):
        for _ in range(5):
            s = "".join(rng.choice("ACGT") for _ in range(n))
            for edits in (n // 25, n // 18, n // 12):
                t = list(s)
                for i in rng.sample(range(n), edits):
                    t[i] = rng.choice(("", "A", "CG", "T"))
                seqs.append("".join(t))
            seqs.append(s)
    df = spark.createDataFrame(list(enumerate(seqs)), "id long, seq string")
    root = list(range(len(seqs)))
    for b in range(len(seqs)):
        for a in range(b):
            e = homology.edits_allowed(max(len(seqs[a]), len(seqs[b])), 0.95)
            if root[a] != root[b] and abs(len(seqs[a]) - len(seqs[b])) <= e and homology.banded_distance(homology.codes_of(seqs[a]), homology.codes_of(seqs[b]), e) <= e:
                root = [root[a] if r == root[b] else r for r in root]
    best = {r: max((len(seqs[i]), i) for i in range(len(seqs)) if root[i] == r)[1] for r in set(root)}
    for entries, rows in ((overlap.ENTRIES, 1 << 13), (1 << 14, 7)):
        assert {r.id: r.cluster for r in homology.identity_clusters(df, entries=entries, rows=rows).collect()} == {i: best[r] for i, r in enumerate(root)}
    assert {r.id: r.cluster for r in sequences.cluster_genes(df, entries=1 << 14, block=7).collect()} == {r.id: r.cluster for r in sequences.cluster_genes(df).collect()}


def test_long_sequences_are_aligned_by_columns_of_bits():
    rng = random.Random(11)
    a = [rng.choice("ACGT") for _ in range(30_000)]
    b = list(a)
    for i in range(10, 30_000, 30):
        b[i] = "ACGT"["ACGT".index(b[i]) - 1]
    a, b = (homology.codes_of("".join(x)) for x in (a, b))
    begin = time.monotonic()
    assert homology.banded_distance(a, b, 1500) == 1000
    assert homology.banded_distance(a, b, 700) == 701
    assert time.monotonic() - begin < 1


def test_depth_runs_cut_lineage_once_and_number_no_events(spark):
    reads = spark.range(500).select(F.when(F.col("id") < 300, "c").otherwise("d").alias("contig"), (F.col("id") * 7 + 1).alias("pos"), F.lit("10M").alias("cigar"), F.lit("ACGTACGTAC").alias("seq"))
    runs = pileup.depth_runs(reads)
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    depth = {}
    for i in range(500):
        for p in range(i * 7 + 1, i * 7 + 11):
            depth["c" if i < 300 else "d", p] = depth.get(("c" if i < 300 else "d", p), 0) + 1
    assert {(r.contig, p): r.depth for r in runs.collect() for p in range(r.start, r.end + 1)} == depth


def test_tasks_of_a_roll_up_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(shared, "ROWS_A_TASK", 100)
    rows = [(i % 700, i // 700, float(i % 13)) for i in range(3000)] + [(None, 1, 2.0)]
    names = {f: [f"a{f % 7}", None if f % 50 == 3 else f"b{f % 300}"] for f in range(600)}
    m = spark.createDataFrame(rows, "feature int, sample int, value double")
    lv = spark.createDataFrame([(f, v, 0.5 if f % 2 else None) for f, v in names.items()], "feature int, levels array<string>, weight double")
    want, n = {}, {}
    for f, s, v in rows:
        own = names.get(f, ["?"])
        for k in range(len(own)):
            at = (k, ";".join(x for x in own[: k + 1] if x is not None), s)
            want[at], n[at] = want.get(at, 0) + v * (0.5 if f in names and f % 2 else 1), n.get(at, 0) + 1
    for known in (None, len(rows)):
        got = matrix.roll_up(m, lv, rows=known)
        assert got.rdd.getNumPartitions() == 31  # not as many as are set, nor merged by their bytes
        assert {(r.level, r.prefix, r.sample): r.value for r in got.collect()} == want
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.level, r.prefix, r.sample): r.value for r in matrix.roll_up(m, lv, mean=True).collect()} == {k: want[k] / n[k] for k in want}
    t = Tables(spark, "/root/testdata/sf0.001")
    assert abund(t).rdd.getNumPartitions() == -(-t.lineitem.count() // 100)


def test_tasks_of_merged_samples_follow_their_rows(spark, monkeypatch):
    monkeypatch.setattr(shared, "ROWS_A_TASK", 100)
    rows = [(i * 7 % 500, i % 9, float(i % 5)) for i in range(2000)] + [(None, None, 1.0), (None, None, 2.0)]
    whole = spark.createDataFrame(rows, "feature int, sample int, value double")
    parts = [whole.filter(f"coalesce(feature, 0) % 3 = {k}").select(*order) for k, order in enumerate((["feature", "sample", "value"], ["value", "sample", "feature"], ["sample", "feature", "value"]))]
    want = {}
    for f, s, v in rows:
        want[f, s] = want.get((f, s), 0) + v
    for known in (None, len(rows)):
        got = matrix.merge_samples(parts, known)
        assert got.rdd.getNumPartitions() == 21  # not as many as are set, nor merged by their bytes
        assert {(r.feature, r.sample): r.value for r in got.collect()} == want
