"""Operators on tiny fixtures with values worked out by hand, and each registered query at the smallest scale."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from lamina.functions import seq as S
from lamina.functions import stats, taxa
from lamina.operators import bins, correlate, graph, hits, intervals, lca, matrix, msa, sequences, variants
from lamina.plans import QUERIES, SQL
from lamina.sources import lines as L
from lamina.sources import writers as K
from lamina.streaming import incremental

DATA = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_sequence_functions(spark):
    assert one(spark, S.reverse_complement(F.lit("AACGT"))) == "ACGTT"
    assert one(spark, S.translate_codons(F.lit("ATGAAATTTTAA"))) == "MKF*"
    assert one(spark, S.translate_codons(F.lit("ATGNNN"))) == "M"
    assert one(spark, S.translate_gene(F.lit("GTGAAATAA"), F.lit(False), F.lit(False))) == "MK"
    assert one(spark, S.gc3_percent(F.lit("ATGCCA"))) == 50.0
    assert one(spark, S.gap_edges_to_unknown(F.lit("--A-C-"))) == "??A-C?"
    assert one(spark, S.common_prefix(F.lit("abcd"), F.lit("abxd"))) == "ab"
    assert one(spark, S.cigar_length(F.lit("10M2I5M3D4S"), "M")) == 15
    assert one(spark, S.sum_list(F.lit("1,2.5,x"))) == 3.5


def test_quantiles_ranks(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 4, 8)], "k string, v double")
    assert df.agg(stats.quantile_linear(F.col("v"), 0.25).alias("q")).first().q == 1.75
    assert stats.quantile_nearest(df, ["k"], "v", 0.25, "q").first().q == 2
    assert stats.quantile_floor(df, ["k"], "v", 0.25, "q").first().q == 2
    assert stats.quantile_floor(df, ["k"], "v", 1.0, "q").first().q == 8
    r = stats.fractional_ranks(spark.createDataFrame([(10,), (20,), (20,), (30,)], "v int"), [], "v")
    assert sorted(x["rank"] for x in r.collect()) == [0, 1.5, 1.5, 3]
    assert df.limit(0).agg(stats.pearson(F.col("v"), F.col("v")).alias("r")).first().r in (None, 0.0)
    n = spark.createDataFrame([(x,) for x in (10, 20, 30, 40)], "l int")
    assert matrix.cumulative_half(n, [], "l").first().n50 == 30


def test_taxonomy(spark):
    df = spark.createDataFrame([("k__A; p__B;;-",)], "t string").select(taxa.parse_taxonomy(F.col("t"), 5).alias("l"))
    assert df.first().l == ["A", "B", "?", "?", "?"]
    assert sorted(r.prefix for r in taxa.prefixes(df, "l").filter("level < 2").collect()) == ["A", "A;B"]
    h = [("q", 99.9, 100, 200.0, 1e-50, ["a", "b", "c", "d", "e", "f", x]) for x in "xxyy"] + [("p", 99.9, 100, 200.0, 1e-50, ["a", "b", "c", "d", "e", "f", "s"])]
    rows = lca.usable_rows(spark.createDataFrame(h, "q string, pident double, alen int, bits double, evalue double, lineage array<string>"))
    got = {r.q: r.lineage for r in lca.consensus(rows, 7).collect()}
    assert got == {"q": ["a", "b", "c", "d", "e", "f", "?"], "p": ["a", "b", "c", "d", "e", "f", "s"]}


def test_mates(spark):
    rows = [("q", "s", 1, 90.0, 50, 100.0, 1e-9, 1, 50), ("q", "s", 2, 80.0, 50, 100.0, 1e-8, 41, 90), ("z", "s", 2, 80.0, 50, 100.0, 1e-8, 41, 90)]
    df = spark.createDataFrame(rows, "q string, s string, mate int, pident double, alen int, bits double, evalue double, ss int, se int")
    r = hits.combine_mates(df).collect()
    assert len(r) == 1 and (r[0].alen, round(r[0].bits, 6), r[0].pident) == (91, 182.0, 85.0)
    assert hits.combine_mates(df, "full").count() == 2


def test_best_hit_in_order(spark):
    rows = [("q", "a", 90.0, 100, 50.0, 1e-9, False, 1), ("q", "b", 95.0, 50, 40.0, 1e-9, True, 2), ("q", "c", 99.0, 100, 90.0, 1e-9, False, 3), ("p", "d", 50.0, 10, 5.0, 1.0, False, 4)]
    df = spark.createDataFrame(rows, "q string, s string, pident double, alen int, bits double, evalue double, has_cat boolean, line_no int")
    assert {r.q: r.s for r in hits.best_hit_in_order(df).collect()} == {"q": "b", "p": "d"}


def test_intervals(spark):
    d = spark.createDataFrame([("c", p, v) for p, v in enumerate([3, 3, 0, 0, 5], 1)], "chr string, pos long, depth int")
    assert sorted((r.start, r.end, r.value) for r in intervals.depth_to_bed(d).collect()) == [(0, 2, 3), (2, 4, 0), (4, 5, 5)]
    c = spark.createDataFrame([(f"c{i}", 1000 * (i + 1), 10.0) for i in range(6)], "contig string, length long, depth double")
    p = intervals.pack_regions(c, 4, ["contig"]).collect()
    per = {}
    for r in p:
        per.setdefault(r.contig, []).append((r.start, r.end))
    for name, parts in per.items():
        parts.sort()
        assert parts[0][0] == 1 and all(a[1] + 1 == b[0] for a, b in zip(parts, parts[1:]))
        assert parts[-1][1] == 1000 * (int(name[1]) + 1)
    assert {r.chunk for r in p} == {0, 1, 2, 3}


def test_trees(spark):
    t = spark.createDataFrame([(1, "(a:1,(b:2,c:3):4);")], "tree int, newick string")
    n = graph.tree_nodes(t, "tree", "newick")
    assert {(r.a, r.b): r.dist for r in graph.patristic(n, "tree").collect()} == {("a", "b"): 7.0, ("a", "c"): 8.0, ("b", "c"): 5.0}
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (6, 6)], "a long, b long")
    assert {r.node: r.root for r in graph.merge_clusters(links).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}


def test_alignments(spark):
    m = spark.createDataFrame([("g", "a", "ACGT-N"), ("g", "b", "ACCTAN")], "gene string, id string, seq string")
    assert msa.pair_identity(m).first().pid == 75.0
    d = spark.createDataFrame([("g1", "a", "b", 90.0), ("g2", "a", "b", 80.0)], "gene string, a string, b string, pid double")
    w = spark.createDataFrame([("g1", 100), ("g2", 300)], "gene string, length int")
    assert msa.merge_distances(d, w).first().pid == 82.5
    s = spark.createDataFrame([("g", "a", "TTTGCAATG"), ("g", "b", "TTCGCGATG")], "gene string, id string, seq string")
    assert [(r.kind, r.fourfold) for r in msa.site_partition(s).orderBy("codon_no").collect()] == [("syn", False), ("syn", True), ("invariant", False)]
    full = "".join(r.value + "\n" for r in K.nexus_lines(m).orderBy("line_no").collect())
    assert "NTAX=2 NCHAR=6" in full and "b\tACCTAN" in full


def test_consensus(spark):
    calls = spark.createDataFrame([("c", 2, 5, "A", 30.0), ("c", 2, 4, "T", 40.0), ("c", 4, 9, "G", 10.0)], "contig string, pos long, depth long, base string, qual double")
    merged = variants.merge_calls(calls)
    assert merged.filter("pos = 2").first().depth == 9
    seq = variants.consensus(merged, spark.createDataFrame([("c", 5)], "contig string, length int"), 3).orderBy("block").collect()
    assert "".join(r.seq for r in seq) == "nTnGn"


def test_assignment_and_clustering(spark):
    rows = [("s", "c1", "g1", True, [1.0, 2.0, 3.0, 4.0]), ("s", "c2", "g2", False, [2.0, 4.0, 6.0, 8.5]), ("s", "c2", "g3", False, [4.0, 1.0, 0.0, 0.0]), ("t", "c1", "g4", False, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "species string, cog string, gene string, seed boolean, profile array<double>")
    assert sorted(r.gene for r in correlate.guided_assignment(df).collect()) == ["g1", "g2"]
    b = spark.createDataFrame([("f", "b1", 0, 0.1), ("f", "b2", 0, 0.2), ("f", "b3", 1, 0.1)], "family string, bin string, tier int, conta double")
    g = spark.createDataFrame([("f", x, f"m{i}", True) for x in ("b1", "b2") for i in range(5)] + [("f", "b3", f"n{i}", True) for i in range(5)], "family string, bin string, gene string, is_marker boolean")
    got = {r.bin: (r.cluster, r.kind) for r in bins.greedy_clusters(b, g).collect()}
    assert got == {"b1": ("C000001", "new"), "b2": ("C000001", "merged"), "b3": ("C000002", "new")}
    s = "ACGTTGCAACGGTTACGATCGATCGGATCTAGCTAGGCTAACGTTAGC" * 3
    genes = spark.createDataFrame([(1, s), (2, s[:-1]), (3, s[::-1])], "id long, seq string")
    c = {r.id: r.cluster for r in sequences.cluster_genes(genes).collect()}
    assert c[1] == c[2] == 1 and c[3] == 3


def test_text_formats(spark, tmp_path):
    fa = tmp_path / "a.fa"
    fa.write_text(">s1 first one\nACGT\nAC\n>s2\nTTT\n")
    got = L.fasta(L.read_records(spark, str(fa), "\n>")).orderBy("id").collect()
    assert [(r.id, r.descr, r.seq) for r in got] == [("s1", "first one", "ACGTAC"), ("s2", "", "TTT")]
    with gzip.open(tmp_path / "h.m8.gz", "wt") as f:
        f.write("q\ts\t99.5\t100\t1\t0\t1\t100\t1\t100\t1e-50\t200\n")
    assert L.hit_table(L.read_lines(spark, str(tmp_path / "h.m8.gz"))).first().evalue == 1e-50
    bad = spark.createDataFrame([("a\tb",)], "value string")
    with pytest.raises(Exception, match="not twelve fields"):
        L.hit_table(bad).collect()
    sheet = ["#SmplID\tPath\tAssmblGrps", "#DirPath\t/one", "a\tx\tG1", "b\ty\t", "#DirPath\t/two", "c\tz\tG1"]
    rows = spark.createDataFrame([("f", i, x) for i, x in enumerate(sheet)], "file string, line_no int, value string")
    s = L.sample_sheet(rows, sheet[0].split("\t"))
    assert [(r.smpl_id, r.dir_path, r.ass_group, r.seq) for r in s.orderBy("seq").collect()] == [("a", "/one", "G1", 0), ("b", "/one", "b", 1), ("c", "/two", "G1", 2)]
    assert {r.smpl_id for r in L.group_owner(s).filter("is_owner").collect()} == {"b", "c"}
    assert L.sheet_faults(s).count() == 0
    fq = spark.createDataFrame([("@r/1\nACGT\n+\nIIII",)], "value string")
    assert tuple(L.fastq(fq).first()) == ("r", 1, "ACGT", "IIII")
    assert os.path.basename(L.find_files(spark, str(tmp_path), r"\.fa$").first().path) == "a.fa"


def test_sinks_and_streams(spark, tmp_path):
    a = spark.createDataFrame([("g1", "s1", 1.0), ("g1", "s2", 2.0), ("g2", "s1", 9.0)], "feature string, sample string, value double")
    K.write_matrix(a, ["s1", "s2", "s3"], str(tmp_path / "m"), ["s3"])
    back = spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "m"))
    assert [tuple(r) for r in back.collect()] == [("g2", "9.0", "0.0", "-"), ("g1", "1.0", "2.0", "-")]
    K.write_fasta(spark.createDataFrame([("x", "ACGTAC", "g")], "id string, seq string, grp string"), str(tmp_path / "f"), 4)
    assert [r.value for r in spark.read.text(str(tmp_path / "f")).collect()] == [">x", "ACGT", "AC"]
    for name in ("f1", "f2"):
        a.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = incremental.merge_new_samples(spark, str(tmp_path / "in"), "feature string, sample string, value double", str(tmp_path / "out"), str(tmp_path / "ck"))
        assert q.awaitTermination(120)
    assert {(r.feature, r["sample"]): r.value for r in incremental.read_merged(spark, str(tmp_path / "out")).collect()} == {("g1", "s1"): 2.0, ("g1", "s2"): 4.0, ("g2", "s1"): 18.0}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")

    def text(v):
        return "~" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)

    df = QUERIES[name](spark, DATA)
    own = sorted(df.columns)
    got = sorted("|".join(text(r[k]) for k in own) for r in df.collect())
    r = c.execute(SQL[name])
    names = [d[0] for d in r.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert own == sorted(names)
    assert got == sorted("|".join(text(x[i]) for i in order) for x in r.fetchall())
