"""Readers on real files, and operators without SQL against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.functions import seq as S
from lamina.functions import stats
from lamina.operators import bins, correlate, intervals, lca, msa, rules, sequences
from lamina.shared import running
from lamina.sources import lines as L
from lamina.sources import writers as K


@pytest.fixture
def small_ranges(spark):
    """Files are read in ranges of a hundred bytes or so."""
    keys = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_line_numbers(spark, tmp_path, small_ranges):
    texts = {"a": [f"line {i} {'x' * (i % 37)}" for i in range(200)], "b": ["", "", "one", ""], "c": ["last without end"]}
    for name, rows in texts.items():
        (tmp_path / name).write_text("\n".join(rows) + ("\n" if name != "c" else ""))
    got = L.read_lines(spark, str(tmp_path), numbered=True)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    assert {(r.file.rsplit("/", 1)[1], r.line_no): r.value for r in got.collect()} == {(n, i): x for n, rows in texts.items() for i, x in enumerate(rows)}
    assert sorted(r.value for r in L.columns(L.read_lines(spark, str(tmp_path / "a"), numbered=True), skip=198).collect()) == texts["a"][198:]
    few = got.filter(F.col("file").endswith("/b") & (F.col("line_no") == 2)).collect()
    assert [r.value for r in few] == ["one"]


def test_fastq_files(spark, tmp_path, small_ranges):
    rng = random.Random(1)
    reads = [(f"r{i}", 1 + i % 2, "".join(rng.choice("ACGT") for _ in range(30)), "@" + "".join(rng.choice("@+I#\\") for _ in range(29))) for i in range(80)]
    (tmp_path / "x.fq").write_text("".join(f"@{n}/{m} text\n{s}\n+{n}\n{q}\n" for n, m, s, q in reads))
    assert sorted(tuple(r)[:4] for r in L.read_fastq(spark, str(tmp_path / "x.fq")).collect()) == sorted(reads)
    (tmp_path / "bad.fq").write_text("@a\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="four lines"):
        L.read_fastq(spark, str(tmp_path / "bad.fq")).collect()


def test_sheets_and_cluster_files(spark, tmp_path, small_ranges):
    sheet = "#DirPath\t/zero\r\n#SmplID\tPath\tAssmblGrps\r\n#DirPath\t/one\r\na\tx\tG1\r\nb\ty\t\r\n\r\n#DirPath\t/two\r\n#OutPath\t/out\r\nc\tz\tG1\r\n"
    (tmp_path / "map.txt").write_text(sheet)
    s = L.read_sample_sheet(spark, str(tmp_path / "map.txt"))
    assert [(r.smpl_id, r.dir_path, r.out_path, r.ass_group, r.seq) for r in s.orderBy("seq").collect()] == [("a", "/one", None, "G1", 0), ("b", "/one", None, "b", 1), ("c", "/two", "/out", "G1", 2)]
    (tmp_path / "none.txt").write_text("a\tb\n")
    with pytest.raises(ValueError, match="SmplID"):
        L.read_sample_sheet(spark, str(tmp_path / "none.txt"))
    want, text = set(), ""
    for c in range(60):
        text += f">Cluster {c}\n"
        for k in range(c % 4 + 1):
            text += f"{k}\t{100 + k}nt, >g{c}_{k}... " + ("*" if k == 0 else f"at +/{90 + k}.50%") + "\n"
            want.add((c, f"g{c}_{k}", 100 + k, k == 0, None if k == 0 else 90.5 + k))
    (tmp_path / "x.clstr").write_text(text)
    assert {tuple(r) for r in L.read_cluster_blocks(spark, str(tmp_path / "x.clstr")).collect()} == want
    lines = L.read_lines(spark, str(tmp_path / "x.clstr"), numbered=True)
    assert {tuple(r) for r in L.cluster_blocks(lines).collect()} == want


def test_more_sample_fields_than_twenty(spark):
    keys = ":".join(["AD", *[f"K{i}" for i in range(40)], "DP"])
    line = "\t".join(["c", "7", ".", "A", "G,T", "30", ".", "INDEL;DP=9", keys, "1,2"])
    r = L.vcf(spark.createDataFrame([(line,)], "value string")).first()
    assert (r.pos, r.alt, r.depth, r.is_indel, r.alt_counts) == (7, ["G", "T"], 9, True, [1, 2])


def test_kmers_of_long_sequences(spark):
    rng = random.Random(3)
    seqs = ["".join(rng.choice("ACGTN" if i % 2 else "ACGT") for _ in range(n)) for i, n in enumerate((0, 2, 3, 255, 256, 257, 258, 3000))]
    df = spark.createDataFrame(list(enumerate(seqs)) + [(99, None)], "id long, seq string")
    for k in (1, 3, 9):
        plain = sorted((i, at + 1, s[at : at + k]) for i, s in enumerate(seqs) for at in range(len(s) - k + 1) if set(s[at : at + k]) <= set("ACGT"))
        assert sorted((r.id, r["at"], r.kmer) for r in S.kmers(df, "seq", k).collect()) == plain
        count: dict = {}
        for i, _, x in plain:
            count[i, x] = count.get((i, x), 0) + 1
        for size in (1 << 20, 100):
            assert {(r.id, r.kmer): r.n for r in sequences.kmer_counts(df, "id", "seq", k, size).collect()} == count
    assert sorted((r.id, r.piece_no, r.piece) for r in S.windows(df, "seq", 100).collect()) == sorted((i, n // 100, s[n : n + 100]) for i, s in enumerate(seqs) for n in range(0, len(s), 100))


def test_identity_of_all_pairs(spark):
    rng = random.Random(4)
    rows = [(g, i, "".join(rng.choice("ACGTacgt-N?é") for _ in range(rng.randrange(0, 60)))) for g in ("g", "h") for i in range(30)]
    want = {}
    for g, a, x in rows:
        for h, b, y in rows:
            if g == h and a < b:
                both = [(p, q) for p, q in zip(x, y) if p not in msa.MISSING and q not in msa.MISSING]
                want[g, a, b] = (len(both), sum(p == q for p, q in both))
    df = spark.createDataFrame(rows, "gene string, id long, seq string")
    for block in (256, 7):
        assert {(r.gene, r.a, r.b): (r.valid, r.equal) for r in msa.pair_identity(df, block).collect()} == want


def test_running_totals_replace_global_windows(spark):
    rng = random.Random(5)
    values = [rng.randrange(50) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    own = sorted(values)
    for q in (0.0, 0.25, 0.9, 1.0):
        assert stats.quantile_nearest(df, [], "v", q, "q").first().q == own[int((len(own) - 1) * q + 0.5)]
    got = sorted((r.v, r.pos) for r in running(df, ["v"]).collect())
    assert [p for _, p in got] == list(range(300)) and [v for v, _ in got] == own
    c = spark.createDataFrame([(f"c{i:02d}", 1000 * (i % 7 + 1), 1.0 + i % 3) for i in range(40)], "contig string, length long, depth double")
    whole = {tuple(r) for r in intervals.pack_regions(c, 6, ["contig"]).collect()}
    keyed = {tuple(r)[1:] for r in intervals.pack_regions(c.withColumn("g", F.lit(1)), 6, ["contig"], ["g"]).collect()}
    assert whole == keyed


def plain_consensus(rows, levels, share):
    live, n, out = list(rows), len(rows), []
    for k in range(levels):
        names = [lin[k] for lin, d in live if d > k]
        best = max(((names.count(x), x) for x in set(names)), default=(0, None))
        won = best[1] is not None and best[0] >= -(-share * n // 1) and sum(names.count(x) == best[0] for x in set(names)) == 1
        out.append(best[1] if won else "?")
        live, n = ([r for r in live if r[1] > k and r[0][k] == best[1]], best[0]) if won else ([], n)
    return out


def test_consensus_of_lineages(spark):
    rng = random.Random(6)
    rows = [(q, [rng.choice("aab") + str(k) for k in range(7)] if rng.random() < 0.4 else [f"a{k}" for k in range(7)], rng.randrange(0, 8)) for q in range(60) for _ in range(rng.randrange(1, 25))]
    df = spark.createDataFrame(rows, "q long, lineage array<string>, depth int")
    for share in (0.9, 0.5):
        got = {r.q: r.lineage for r in lca.consensus(df, 7, share).collect()}
        assert got == {q: plain_consensus([(lin, d) for p, lin, d in rows if p == q], 7, share) for q in range(60)}


def pearson(x, y):
    a, b = np.array(x, float) - np.mean(x), np.array(y, float) - np.mean(y)
    d = np.sqrt((a * a).sum() * (b * b).sum())
    return (a * b).sum() / d if d > 1e-150 else 0.0


def plain_canopies(profiles, distance, merge, r=pearson):
    def claimed(order, points, limit):
        seeds, out = [], {}
        for f in order:
            near = [s for s in seeds if 1 - r(points[s], points[f]) <= limit]
            out[f] = near[0] if near else f
            if not near:
                seeds.append(f)
        return out

    ok = {f: p for f, p in profiles.items() if sum(x > 0 for x in p) >= 3 and sum(sorted(p)[-3:]) <= 0.7 * sum(p)}
    order = sorted(ok, key=lambda f: (-sum(ok[f]), f))
    centre = lambda own: {c: [float(np.quantile([ok[f][k] for f in own if own[f] == c], 0.75)) for k in range(len(next(iter(ok.values()))))] for c in set(own.values())}
    own = claimed(order, ok, distance)
    middle = centre(own)
    into = claimed([f for f in order if f in middle], middle, merge)
    own = {f: into[c] for f, c in own.items()}
    return own, centre(own)


def test_canopies(spark):
    rng = random.Random(7)
    base = [[rng.randrange(0, 40) for _ in range(12)] for _ in range(9)]
    profiles = {}
    for i in range(160):
        p = [float(max(0, x * rng.choice([1, 2, 3]) / 2 + rng.randrange(-4, 5))) for x in rng.choice(base)]
        profiles[i] = p
    profiles |= {500: [0.0] * 12, 501: [1.0, 2.0] + [0.0] * 10, 502: [90.0, 1.0, 1.0] + [0.5] * 9}
    df = spark.createDataFrame(list(profiles.items()), "feature long, profile array<double>")
    own, centres = plain_canopies(profiles, 0.1, 0.1)
    assert len(set(own.values())) < len(own)
    for batch in (2048, 5):
        got = canopy_rows = correlate.canopies(df, batch=batch).collect()
        assert {r.feature: r.canopy for r in got} == own
        assert all(np.allclose(r.profile, centres[r.canopy]) for r in canopy_rows)


def test_guided_assignment_plainly(spark):
    rng = random.Random(8)
    rows = [(f"s{rng.randrange(4)}", f"c{rng.randrange(6)}", g, rng.random() < 0.2, [float(rng.choice([0, 0, 1, 2, 5, 9])) for _ in range(6)]) for g in range(150)]
    want = set()
    for sp in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == sp), key=lambda r: (r[1], r[2]))
        seeds = [r for r in own if r[3]]
        total = [sum(x) for x in zip(*(r[4] for r in seeds))] if seeds else []
        if sum(x != 0 for x in total) < 3:
            continue
        want |= {(sp, r[1], r[2], 1.0) for r in seeds}
        for cog in sorted({r[1] for r in own} - {r[1] for r in seeds}):
            open_ = [(pearson(total, r[4]), r) for r in own if r[1] == cog]
            top = max(x for x, _ in open_)
            for x, r in open_:
                if top >= 0.6 and x > top - 0.03:
                    want.add((sp, cog, r[2], round(x, 9)))
                    total = [a + b for a, b in zip(total, r[4])]
    df = spark.createDataFrame(rows, "species string, cog string, gene long, seed boolean, profile array<double>")
    assert {(r.species, r.cog, r.gene, round(r.r, 9)) for r in correlate.guided_assignment(df).collect()} == want and want


def test_greedy_clusters_plainly(spark):
    rng = random.Random(9)
    catalogue = [[f"m{k}_{i}" for i in range(8)] for k in range(5)]
    of_bins = [(b, rng.randrange(4), round(rng.random(), 3)) for b in range(60)]
    genes = [(b, g) for b, _, _ in of_bins for k in [rng.randrange(5)] for g in rng.sample(catalogue[k], rng.randrange(3, 9)) + rng.sample(catalogue[(k + 1) % 5], rng.randrange(0, 4))]
    occ: dict = {}
    obs: dict = {}
    want = {}
    for b, tier, _ in sorted(of_bins, key=lambda x: (x[1], x[2], x[0])):
        own = [g for x, g in genes if x == b]
        hits: dict = {}
        for g in own:
            for c in occ.get(g, {}):
                hits[c] = hits.get(c, 0) + 1
        best = min(hits, key=lambda c: (-hits[c], c), default=None)
        new = sum(g not in occ for g in own) / len(own)
        name, kind = None, "ambiguous"
        if new > bins.UNKNOWN_SHARE[tier] or (best is None and tier < 3):
            name, kind = f"C{len(obs) + 1:06d}", "new"
        elif best is not None and hits[best] / len(own) > 0.6:
            core = sum(occ.get(g, {}).get(best, 0) for g in own) / (obs[best] * len(own))
            only = sum(occ[g].get(best, 0) / sum(occ[g].values()) for g in own if g in occ) / len(own)
            if core > bins.OVERLAP[tier] and only > bins.OVERLAP[tier]:
                name, kind = best, "merged"
        if name:
            obs[name] = obs.get(name, 0) + 1
            for g in own:
                occ.setdefault(g, {})[name] = occ.get(g, {}).get(name, 0) + 1
        want[b] = (name, kind)
    b = spark.createDataFrame([("f", *x) for x in of_bins], "family string, bin long, tier int, conta double")
    g = spark.createDataFrame([("f", *x, True) for x in genes], "family string, bin long, gene string, is_marker boolean")
    assert {r.bin: (r.cluster, r.kind) for r in bins.greedy_clusters(b, g).collect()} == want
    assert len({k for _, k in want.values()}) > 1


def test_tiers_with_purity(spark):
    df = spark.createDataFrame([(99.0, 0.5, 0.98), (99.0, 0.5, 0.96), (99.0, 0.5, 0.5), (90.0, 4.0, 0.93)], "compl double, conta double, purity double")
    tier = lambda **k: [r.t for r in df.select(bins.quality_tier(F.col("compl"), F.col("conta"), **k).alias("t")).collect()]
    assert tier(rounds=4, purity=F.col("purity")) == [0, 1, None, 2]
    assert tier(rounds=4) == [0, 0, 0, 2] and tier(rounds=2, purity=F.col("purity")) == [0, 1, None, None]


def test_rules(spark):
    reads = spark.createDataFrame([("50M", 60, 0.01, 50), ("20S30M", 60, 0.01, 50), ("10S30M10S", 60, 0.01, 50), ("50M", 5, 0.01, 50), ("50M", 60, 0.2, 50), ("45M5I", 60, 0.0, 50), (None, 60, 0.0, 50)], "cigar string, mapq int, div double, len int")
    bad = rules.fails_alignment(F.col("cigar"), F.col("mapq"), F.col("div"), F.col("len"), 0.55, 0.05, 20, 8)
    assert [r.flag for r in reads.select(rules.flag_unmapped(F.lit(1), bad).alias("flag")).collect()] == [1, 1, 5, 5, 5, 1, 5]
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert [one(S.heterozygous_code(F.lit(a), F.lit(b))) for a, b in ("AG", "ga", "CC", "AN", "TA")] == ["R", "R", "C", "N", "W"]
    assert one(S.prefix_header(F.lit("g1 rest"), "s__", r"\s")) == "s__g1"
    a = spark.createDataFrame([("f", "x", 4.0), ("g", "x", 8.0)], "feature string, sample string, value double")
    m = spark.createDataFrame([("f", "S"), ("g", "S"), ("h", "S")], "feature string, species string")
    assert rules.species_profile(a, m).first().value == 4.0 and rules.species_profile(a, m, True).first().value == 6.0


def test_taxonomy_readers(spark):
    lines = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    got = L.ranked_lineages(lines('a\tk__B; p__[Firm]; c__unidentified; o__"X"; s__', "b\tk__;p__Q"), 5).collect()
    assert {r.id: r.lineage for r in got} == {"a": ["B", "Firm", "?", "X", "?"], "b": ["?", "Q", "?", "?", "?"]}
    with pytest.raises(Exception, match="no taxonomy"):
        L.ranked_lineages(lines("only"), 3).collect()
    assert [tuple(r) for r in L.header_lineages(lines(">AB.1.9 Bacteria;Firm;x y", "ACGT"), 4).collect()] == [("AB.1.9", ["Bacteria", "Firm", "x y", "?"])]
    ids = spark.createDataFrame([("sp1", 7)], "species string, id int")
    assert [tuple(r) for r in L.species_lineages(lines("sp1\tz\tA\tB"), ids, 3).collect()] == [(7, ["A", "B", "?"])]
    with pytest.raises(Exception, match="no id of"):
        L.species_lineages(lines("sp2\tz\tA"), ids, 3).collect()
    assert {r.id: r.kingdom for r in L.kingdoms(lines("1 x Bacteria", "2 Archaea", "3 Eukaryota", "4 Eukaryota Fungi", "no")).collect()} == {"1": 0, "2": 1, "3": 2, "4": 3}
    assert {r.id: r.kingdom for r in L.kingdoms(lines("hsa\teuka", "eco\tprok"), numbered=False).collect()} == {"hsa": 1, "eco": 0}


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i}", i % 5) for i in range(20)], "k string, v int")
    read = lambda p, **o: spark.read.options(sep="\t", header="true", **o).csv(f"{tmp_path}/{p}").collect()
    K.write_hash(df, "k", "v", f"{tmp_path}/h")
    assert [r.v for r in read("h")][:4] == ["4"] * 4
    K.write_table(df, f"{tmp_path}/z", gzip=True)
    assert len(read("z")) == 20 and all(str(p).endswith(".gz") for p in (tmp_path / "z").glob("part-*"))
    K.write_partitioned(df, ["v"], f"{tmp_path}/p")
    assert sorted(p.name for p in (tmp_path / "p").glob("v=*")) == [f"v={i}" for i in range(5)]
    text = df.select("k")
    K.write_chunks(text, f"{tmp_path}/c", n=4)
    assert len(list((tmp_path / "c").glob("part-*"))) == 4
    K.write_chunks(text.coalesce(1), f"{tmp_path}/m", max_rows=6)
    assert len(list((tmp_path / "m").glob("part-*"))) == 4
    K.write_split(text, F.col("k") < "k15", f"{tmp_path}/one", f"{tmp_path}/two")
    assert spark.read.text(f"{tmp_path}/one").count() + spark.read.text(f"{tmp_path}/two").count() == 20
