"""Queries on hits, filters, joins, set operations and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import stats
from ..operators import bins as B
from ..operators import graph, hits as H
from ..operators import intervals as I
from ..operators import lca, matrix, rules, variants
from .registry import Tables, query
from .views import BINS_SQL, HITS_SQL, bins, hits, r, rq

_H = f"({HITS_SQL})"


@query("f1_accepted_hits", f"SELECT q, s, line_no FROM {_H} WHERE evalue <= 0.05 AND bits >= 5000 AND alen >= 10 AND pident >= 95 AND alen > slen * 0.3")
def f1(t: Tables):
    return hits(t).filter(H.accepted(0.05, 5000, 10, 95, 0.3)).select("q", "s", "line_no")


@query("f2_model_cutoff", f"SELECT q, s, line_no FROM {_H} JOIN (SELECT p_partkey AS s, p_retailprice * 20 AS cutoff FROM part WHERE p_size > 10) m USING (s) WHERE bits >= cutoff * alen / slen")
def f2(t: Tables):
    models = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("s"), (F.col("p_retailprice") * 20).alias("cutoff"))
    return H.model_cutoff(hits(t), models).select("q", "s", "line_no")


@query("f3_identity_class", f"SELECT CASE WHEN pident IS NULL THEN -2 WHEN pident >= 0.985 * 97 AND alen >= 0.1 * slen AND alen >= 0.7 * 20 THEN 1 ELSE 0 END AS class, count(*) AS n FROM {_H} GROUP BY 1")
def f3(t: Tables):
    return hits(t).groupBy(H.identity_class(F.col("pident"), F.col("alen"), F.lit(20), F.col("slen"), 97).alias("class")).agg(F.count("*").alias("n"))


@query("f4_flag_unmapped", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 OR l_quantity < 10 THEN l_linenumber | 4 ELSE l_linenumber END AS flag FROM lineitem")
def f4(t: Tables):
    bad = (F.col("l_discount") > 0.05) | (F.col("l_quantity") < 10)
    return t.lineitem.select("l_orderkey", "l_linenumber", rules.flag_unmapped(F.col("l_linenumber"), bad).alias("flag"))


@query("f5_length_split", "SELECT CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 2000 THEN 'middle' ELSE 'long' END AS class, count(*) AS n FROM documents GROUP BY 1")
def f5(t: Tables):
    from ..operators.sequences import length_class

    return t.documents.groupBy(length_class(F.col("n_chars"), 500, 2000).alias("class")).agg(F.count("*").alias("n"))


@query("f6_long_or_marker", "SELECT p_partkey FROM part WHERE p_size > 30 OR p_brand = 'Brand#11'")
def f6(t: Tables):
    return t.part.filter(rules.long_or_marker(F.col("p_size"), F.col("p_brand") == "Brand#11", 31)).select("p_partkey")


@query("f8_bin_filter", f"SELECT bin, compl >= 50 AND conta <= 5 AS passed FROM {BINS_SQL}")
def f8(t: Tables):
    return B.split_by_quality(bins(t), 50, 5).select("bin", "passed")


@query("f9_quality_tiers", f"SELECT bin, CASE WHEN compl >= 98 AND conta <= 1 THEN 0 WHEN compl >= 95 AND conta <= 3 THEN 1 WHEN compl >= 80 AND conta <= 5 THEN 2 WHEN compl >= 60 AND conta <= 10 THEN 3 END AS tier FROM {BINS_SQL}")
def f9(t: Tables):
    return bins(t).select("bin", B.quality_tier(F.col("compl"), F.col("conta"), 4).alias("tier"))


@query("f10_quality_histogram", f"SELECT s_nationkey, count(*) FILTER (WHERE compl >= 90 AND conta <= 5) AS hq, count(*) FILTER (WHERE compl >= 80 AND conta <= 5) AS mq, count(*) AS bins FROM {BINS_SQL} GROUP BY 1")
def f10(t: Tables):
    return B.quality_counts(bins(t), ["s_nationkey"])


_CORE = "(SELECT l_partkey AS gene, p_brand AS mgs, count(*) AS occ, count(*) FILTER (WHERE l_linenumber > 4) AS multicopy, avg(l_tax) * 40 AS multibin, p_size > 45 AS is_marker FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, p_size)"


def _core(t: Tables):
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy(F.col("l_partkey").alias("gene"), F.col("p_brand").alias("mgs"), "p_size").agg(F.count("*").alias("occ"), F.count_if(F.col("l_linenumber") > 4).alias("multicopy"), (F.avg("l_tax") * 40).alias("multibin")).withColumn("is_marker", F.col("p_size") > 45)


@query("f12_core_genes", f"SELECT gene FROM {_CORE} WHERE (multicopy * 1.0 / occ < 0.1 AND multibin > 0.9 AND multibin < 3) OR is_marker")
def f12(t: Tables):
    return _core(t).filter(B.core_gene(F.col("occ"), F.col("multicopy"), F.col("multibin"), F.col("is_marker"))).select("gene")


@query("f13_core_range", f"WITH v AS (SELECT p_brand AS k, l_quantity AS x FROM lineitem JOIN part ON l_partkey = p_partkey), g AS (SELECT k, min(x) AS lo, max(x) AS hi FROM v GROUP BY 1), b AS (SELECT k, lo, hi, CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) * 40 / (hi - lo)), 39) END AS bin, count(*) AS n FROM v JOIN g USING (k) GROUP BY 1, 2, 3, 4), q AS (SELECT k, quantile_cont(n, 0.6) AS q, max(n) AS m FROM b GROUP BY 1) SELECT k, {rq('min(lo + bin * (hi - lo) / 40)')} AS core_low, {rq('max(lo + (bin + 1) * (hi - lo) / 40)')} AS core_high FROM b JOIN q USING (k) WHERE n >= q AND n >= 0.5 * m GROUP BY 1")
def f13(t: Tables):
    v = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("k"), F.col("l_quantity").alias("x"))
    return B.core_range(v, "k", "x").withColumn("core_low", r(F.col("core_low"))).withColumn("core_high", r(F.col("core_high")))


@query("f14_gene_importance", f"WITH c AS (SELECT gene, mgs, occ, is_marker, {rq('multibin', 9)} AS bins FROM {_CORE}), s AS (SELECT mgs, quantile_cont(bins, 0.75) AS q75, avg(occ) AS a FROM c GROUP BY 1) SELECT gene FROM c JOIN s USING (mgs) WHERE (is_marker AND bins <= {rq('least(q75, 2.2)', 9)}) OR (NOT is_marker AND bins <= {rq('1.1 * q75', 9)} AND occ BETWEEN 0.5 * a AND 1.5 * a)")
def f14(t: Tables):
    return B.gene_importance(_core(t)).select("gene")


@query("f18_conspecific", f"WITH n AS (SELECT l_suppkey AS sample, l_partkey AS gene, count(*) AS k FROM lineitem GROUP BY 1, 2), g AS (SELECT sample, p_brand AS mgs, count(*) AS genes, count(*) FILTER (WHERE k > 1) AS multi FROM n JOIN part ON gene = p_partkey GROUP BY 1, 2) SELECT sample, mgs FROM g WHERE multi * 1.0 / genes <= 0.2")
def f18(t: Tables):
    n = t.lineitem.groupBy(F.col("l_suppkey").alias("sample"), F.col("l_partkey").alias("gene")).agg(F.count("*").alias("k"))
    g = n.join(t.part, F.col("gene") == F.col("p_partkey")).select("sample", F.col("p_brand").alias("mgs"), "k")
    return rules.single_copy_groups(g, ["sample", "mgs"], "k").select("sample", "mgs")


@query("f20_exclude_kingdom", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5)")
def f20(t: Tables):
    out = t.supplier.filter("s_nationkey < 5").select(F.col("s_suppkey").alias("l_suppkey"))
    return t.lineitem.join(out, "l_suppkey", "left_anti").select("l_orderkey", "l_linenumber")


@query("f21_header_limit", "SELECT page_id, CASE WHEN length(url) >= 40 THEN substring(url, 1, 39) ELSE url END AS id FROM pages")
def f21(t: Tables):
    from ..sources.lines import header_limit

    return t.pages.select("page_id", header_limit(F.col("url"), 40).alias("id"))


@query("f22_clean_headers", "WITH c AS (SELECT page_id, translate(substring(url, 1, 40), ' :;,()[]''|/' || chr(92), '____________') AS c FROM pages) SELECT page_id, c || '_' || row_number() OVER (PARTITION BY c ORDER BY page_id) AS id FROM c")
def f22(t: Tables):
    from ..functions.seq import clean_header

    c = t.pages.select("page_id", clean_header(F.col("url")).alias("c"))
    return c.select("page_id", F.concat_ws("_", "c", F.row_number().over(Window.partitionBy("c").orderBy("page_id")).cast("string")).alias("id"))


@query("f27_min_group_size", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 600")
def f27(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).filter("n >= 600")


@query("j1_lengths", f"SELECT q, s, line_no, slen FROM {_H}")
def j1(t: Tables):
    h = t.lineitem.select(F.col("l_orderkey").alias("q"), F.col("l_partkey").alias("s"), F.col("l_linenumber").alias("line_no"))
    return H.with_lengths(h, t.part.select(F.col("p_partkey").alias("s"), F.col("p_size").alias("slen"))).select("q", "s", "line_no", "slen")


@query("j2_categories", f"SELECT word AS category, count(*) AS n, {rq('sum(alen)')} AS score, {rq('sum(alen / k)')} AS shared FROM (SELECT alen, len(string_split(p_name, ' ')) AS k, unnest(string_split(p_name, ' ')) AS word FROM (SELECT l_quantity AS alen, p_name FROM lineitem JOIN part ON l_partkey = p_partkey)) GROUP BY 1")
def j2(t: Tables):
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    full = H.terms(j, "p_name", " ", True)
    return full.groupBy(F.col("term").alias("category")).agg(F.count("*").alias("n"), r(F.sum("l_quantity")).alias("score"), r(F.sum(F.col("l_quantity") * F.col("credit"))).alias("shared"))


@query("j3_super_categories", "SELECT r_name AS category, n_name AS sub, count(*) AS n FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def j3(t: Tables):
    j = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return j.groupBy(F.col("r_name").alias("category"), F.col("n_name").alias("sub")).agg(F.count("*").alias("n"))


_MATES = "(SELECT l_orderkey AS q, l_suppkey AS s, l_linenumber % 2 + 1 AS mate, 100 * (1 - l_discount) AS pident, l_quantity AS alen, l_extendedprice AS bits, l_tax AS evalue, l_partkey AS ss, l_partkey + l_quantity AS se FROM lineitem)"
_ONE = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q, s, mate ORDER BY bits DESC, ss, se) AS n FROM {_MATES}) WHERE n = 1)"
_PAIR = f"(SELECT a.q, a.s, (a.pident + b.pident) / 2 AS pident, a.alen AS a1, b.alen AS a2, a.bits AS b1, b.bits AS b2, least(a.evalue, b.evalue) AS evalue, greatest(0, CASE WHEN a.ss <= b.ss THEN a.se - b.ss ELSE b.se - a.ss END) AS ov FROM {_ONE} a JOIN {_ONE} b ON a.q = b.q AND a.s = b.s AND a.mate = 1 AND b.mate = 2)"
_COMBINED = f"SELECT q, s, {rq('pident')} AS pident, {rq('CASE WHEN a1 + a2 - ov < 0 THEN a1 ELSE a1 + a2 - ov END')} AS alen, {rq('(b1 + b2) * (1 - ov / (a1 + a2))', 2)} AS bits, evalue, 2 AS cnt FROM {_PAIR}"


def _mates(t: Tables):
    return t.lineitem.select(F.col("l_orderkey").alias("q"), F.col("l_suppkey").alias("s"), (F.col("l_linenumber") % 2 + 1).alias("mate"), (100 * (1 - F.col("l_discount"))).alias("pident"), F.col("l_quantity").alias("alen"), F.col("l_extendedprice").alias("bits"), F.col("l_tax").alias("evalue"), F.col("l_partkey").alias("ss"), (F.col("l_partkey") + F.col("l_quantity")).alias("se"))


def _rounded(df):
    return df.withColumn("pident", r(F.col("pident"))).withColumn("alen", r(F.col("alen"))).withColumn("bits", r(F.col("bits"), 2))


@query("j4_mates_inner", _COMBINED)
def j4(t: Tables):
    return _rounded(H.combine_mates(_mates(t), "inner"))


@query("j5_mates_full", f"{_COMBINED} UNION ALL SELECT q, s, {rq('pident')}, {rq('alen')}, {rq('bits', 2)}, evalue, 1 FROM {_ONE} x WHERE NOT EXISTS (SELECT 1 FROM {_ONE} y WHERE y.q = x.q AND y.s = x.s AND y.mate <> x.mate)")
def j5(t: Tables):
    return _rounded(H.combine_mates(_mates(t), "full"))


@query("j6_contig_to_cluster", "SELECT l_suppkey AS contig, l_partkey AS gene, p_brand AS cluster_id, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3")
def j6(t: Tables):
    g = t.lineitem.groupBy(F.col("l_suppkey").alias("contig"), F.col("l_partkey").alias("gene")).agg(F.count("*").alias("n"))
    return g.join(t.part.select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("cluster_id")), "gene").select("contig", "gene", "cluster_id", "n")


@query("j7_gene_to_species", "SELECT c_custkey AS gene, c_nationkey AS mgs, o_orderkey AS cog FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def j7(t: Tables):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("gene"), F.col("c_nationkey").alias("mgs"), F.col("o_orderkey").alias("cog"))


@query("j8_subset", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j8(t: Tables):
    return t.orders.join(t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi").select("o_orderkey")


@query("j9_left_over", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def j9(t: Tables):
    return t.customer.join(t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("j10_complete_join", "SELECT count(*) AS rows, count(*) FILTER (WHERE p_partkey IS NULL) AS missing FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def j10(t: Tables):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left").agg(F.count("*").alias("rows"), F.count_if(F.col("p_partkey").isNull()).alias("missing"))


_DAY = "CAST(epoch(l_shipdate) / 86400 AS BIGINT)"


def _day(c: str):
    return (F.unix_seconds(F.col(c).cast("timestamp")) / 86400).cast("long")


@query("j11_interval_join", "SELECT s_nationkey, count(*) AS n, sum(l_shipdate::DATE - o_orderdate::DATE) AS days FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON o_orderkey = l_orderkey AND l_shipdate::DATE - o_orderdate::DATE BETWEEN 0 AND 30 GROUP BY 1")
def j11(t: Tables):
    p = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_nationkey", F.col("l_orderkey").alias("k"), F.unix_date(F.to_date("l_shipdate")).alias("pos"))
    i = t.orders.select(F.col("o_orderkey").alias("k"), F.unix_date(F.to_date("o_orderdate")).alias("start"), (F.unix_date(F.to_date("o_orderdate")) + 30).alias("end"))
    return I.interval_join(p, i, "k", "pos", "start", "end", 64).groupBy("s_nationkey").agg(F.count("*").alias("n"), F.sum(I.gene_offset(F.col("pos"), F.col("start"), F.col("end"), F.lit("+"))).cast("long").alias("days"))


@query("j12_mean_coverage", f"WITH d AS (SELECT l_partkey AS chr, o AS d_start, o + l_quantity::BIGINT - 1 AS d_end, l_linenumber AS value FROM (SELECT *, l_orderkey % 500 AS o FROM lineitem)), g AS (SELECT p_partkey AS gene, p_partkey AS chr, p_size * 5 AS s, p_size * 5 + 99 AS e FROM part) SELECT gene, {rq('coalesce(sum(greatest(0, least(d_end, e) - greatest(d_start, s) + 1) * value), 0) / 100.0')} AS cov FROM g LEFT JOIN d USING (chr) GROUP BY 1")
def j12(t: Tables):
    d = t.lineitem.select(F.col("l_partkey").alias("chr"), (F.col("l_orderkey") % 500).alias("d_start"), (F.col("l_orderkey") % 500 + F.col("l_quantity").cast("long") - 1).alias("d_end"), F.col("l_linenumber").alias("value"))
    g = t.part.select(F.col("p_partkey").alias("gene"), F.col("p_partkey").alias("chr"), (F.col("p_size") * 5).alias("start"), (F.col("p_size") * 5 + 99).alias("end"))
    return I.mean_coverage(d, g, "chr", 50).withColumn("cov", r(F.col("cov")))


@query("j15_co_exclusion", "WITH p AS (SELECT DISTINCT c_mktsegment AS g, c_nationkey AS i, o_orderpriority || CAST(o_orderkey % 7 AS VARCHAR) AS w FROM customer JOIN orders ON c_custkey = o_custkey), n AS (SELECT DISTINCT g, i FROM p) SELECT a.g, a.i AS a, b.i AS b FROM n a JOIN n b ON a.g = b.g AND a.i < b.i WHERE NOT EXISTS (SELECT 1 FROM p x JOIN p y ON x.g = y.g AND x.w = y.w WHERE x.g = a.g AND x.i = a.i AND y.i = b.i)")
def j15(t: Tables):
    p = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_mktsegment").alias("g"), F.col("c_nationkey").alias("i"), F.concat("o_orderpriority", (F.col("o_orderkey") % 7).cast("string")).alias("w"))
    return B.co_exclusion(p, "g", "i", "w").select("g", "a", "b")


@query("j16_reciprocal_best", "WITH o AS (SELECT l_suppkey AS a, p_brand AS b, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS x, row_number() OVER (PARTITION BY b ORDER BY n DESC, a) AS y FROM o) SELECT a, b, n FROM k WHERE x = 1 AND y = 1")
def j16(t: Tables):
    o = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_suppkey").alias("a"), F.col("p_brand").alias("b")).agg(F.count("*").alias("n"))
    return B.reciprocal_best(o, "a", "b")


@query("j17_replacement", f"WITH b AS {BINS_SQL}, s AS (SELECT s_nationkey AS mgs, bin, {rq('compl - 2 * conta')} AS score FROM b), c AS (SELECT mgs, min(bin) AS bin, arg_min(score, bin) AS score FROM s GROUP BY 1), o AS (SELECT mgs, max(score) AS m FROM s GROUP BY 1) SELECT c.mgs, CASE WHEN m > c.score THEN (SELECT max(bin) FROM s WHERE s.mgs = c.mgs AND s.score = m) ELSE c.bin END AS bin, greatest(m, c.score) AS score FROM c JOIN o USING (mgs)")
def j17(t: Tables):
    s = bins(t).select(F.col("s_nationkey").alias("mgs"), "bin", r(F.col("compl") - 2 * F.col("conta")).alias("score"))
    cur = s.groupBy("mgs").agg(F.min_by(F.struct("bin", "score"), "bin").alias("x")).select("mgs", "x.bin", "x.score")
    return B.better_replacement(cur, s)


@query("j18_group_owner", "SELECT c_custkey, c_nationkey, max(c_custkey) OVER (PARTITION BY c_nationkey) AS owner FROM customer")
def j18(t: Tables):
    from ..sources.lines import group_owner

    s = t.customer.select(F.col("c_custkey").alias("smpl_id"), F.col("c_nationkey").alias("ass_group"), F.col("c_custkey").alias("seq"))
    return group_owner(s).select(F.col("smpl_id").alias("c_custkey"), F.col("ass_group").alias("c_nationkey"), "owner")


@query("j19_fallback_join", "SELECT o_orderkey, coalesce(a.s_name, b.c_name) AS name FROM orders LEFT JOIN supplier a ON o_custkey = a.s_suppkey LEFT JOIN customer b ON o_custkey = b.c_custkey")
def j19(t: Tables):
    j = t.orders.join(t.supplier, F.col("o_custkey") == F.col("s_suppkey"), "left").join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.select("o_orderkey", F.coalesce("s_name", "c_name").alias("name"))


@query("j20_transitive_category", "WITH d AS (SELECT p_partkey AS s, CASE WHEN p_size > 25 THEN p_brand END AS category FROM part), b AS (SELECT p_partkey AS s, (SELECT max(p_partkey) FROM part) - p_partkey + 1 AS other FROM part) SELECT d.s, coalesce(d.category, o.category) AS category FROM d LEFT JOIN b USING (s) LEFT JOIN d o ON o.s = b.other")
def j20(t: Tables):
    d = t.part.select(F.col("p_partkey").alias("s"), F.when(F.col("p_size") > 25, F.col("p_brand")).alias("category"))
    top = t.part.agg(F.max("p_partkey").alias("m"))
    best = t.part.crossJoin(F.broadcast(top)).select(F.col("p_partkey").alias("s"), (F.col("m") - F.col("p_partkey") + 1).alias("other"))  # one row
    return H.transitive_category(d, best)


@query("j22_competitive", "SELECT l_orderkey AS read, arg_max(l_suppkey, struct_pack(a := l_extendedprice, b := -l_suppkey)) AS reference FROM lineitem GROUP BY 1")
def j22(t: Tables):
    h = t.lineitem.select(F.col("l_orderkey").alias("q"), F.col("l_suppkey").alias("s"), F.col("l_extendedprice").alias("bits"))
    return H.best_hit(h, order=("bits",)).select(F.col("q").alias("read"), F.col("s").alias("reference"))


@query("j23_decoy_exclusion", "WITH h AS (SELECT l_orderkey AS contig, sum(l_quantity) AS a FROM lineitem WHERE 100 * (1 - l_discount) > 95 GROUP BY 1) SELECT o_orderkey AS contig FROM orders LEFT JOIN h ON contig = o_orderkey WHERE coalesce(a, 0) < 0.8 * (20 + o_orderkey % 100)")
def j23(t: Tables):
    c = t.orders.select(F.col("o_orderkey").alias("contig"), (20 + F.col("o_orderkey") % 100).alias("length"))
    h = t.lineitem.select(F.col("l_orderkey").alias("contig"), (100 * (1 - F.col("l_discount"))).alias("pident"), F.col("l_quantity").alias("alen"))
    return H.decoy_contigs(h, c).select("contig")


@query("w1_best_hit_declared", f"SELECT q, s, line_no, bits FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY (p_brand < 'Brand#3') DESC, bits DESC, pident DESC, alen DESC, s) AS n FROM {_H}) WHERE n = 1")
def w1(t: Tables):
    return H.best_hit(hits(t).withColumn("has_cat", F.col("p_brand") < "Brand#3")).select("q", "s", "line_no", "bits")


_ORDERED = f"""
WITH RECURSIVE h AS (SELECT q, s, line_no, bits, pident, alen, evalue, p_brand < 'Brand#3' AS cat, row_number() OVER (PARTITION BY q ORDER BY line_no, s, bits, pident, alen, evalue) AS n FROM {_H}),
x AS (SELECT q, n, s, line_no, bits, pident, evalue, pident AS top_id, alen AS top_len, cat AS found FROM h WHERE n = 1
UNION ALL SELECT y.q, y.n, CASE WHEN take THEN y.s ELSE x.s END, CASE WHEN take THEN y.line_no ELSE x.line_no END, CASE WHEN take THEN y.bits ELSE x.bits END, CASE WHEN take THEN y.pident ELSE x.pident END, CASE WHEN take THEN y.evalue ELSE x.evalue END,
CASE WHEN take THEN greatest(top_id, y.pident) ELSE top_id END, CASE WHEN take THEN greatest(top_len, y.alen) ELSE top_len END, CASE WHEN take THEN y.cat ELSE found END
FROM x JOIN h y ON y.q = x.q AND y.n = x.n + 1, LATERAL (SELECT NOT (found AND NOT y.cat) AND (
(x.pident - 5 < y.pident AND x.evalue * 10 > y.evalue AND y.pident >= 0.97::DOUBLE * x.pident AND y.pident >= 0.92::DOUBLE * top_id AND y.alen >= 1.15::DOUBLE * top_len)
OR (y.pident >= 1.03::DOUBLE * top_id AND y.alen >= 0.9::DOUBLE * top_len) OR y.bits > x.bits OR (y.cat AND NOT found)) AS take))
SELECT q, s, line_no, bits FROM x QUALIFY row_number() OVER (PARTITION BY q ORDER BY n DESC) = 1
"""


@query("w1_best_hit_in_order", _ORDERED)
def w1_order(t: Tables):
    return H.best_hit_in_order(hits(t).withColumn("has_cat", F.col("p_brand") < "Brand#3")).select("q", "s", "line_no", "bits")


@query("w2_least_evalue", f"SELECT q, s, line_no FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY evalue, bits DESC, s) AS n FROM {_H}) WHERE n = 1")
def w2(t: Tables):
    h = hits(t).withColumn("_e", -F.col("evalue"))
    return H.best_hit(h, order=("_e", "bits")).select("q", "s", "line_no")


@query("w2_best_without_ties", f"WITH x AS (SELECT q, alen, p_type, max(alen) OVER (PARTITION BY q) AS m FROM {_H}) SELECT q, min(p_type) AS p_type, max(alen) AS alen FROM x WHERE alen = m GROUP BY 1 HAVING count(DISTINCT p_type) = 1")
def w2_ties(t: Tables):
    return H.best_without_ties(hits(t), "q", "alen", "p_type")


@query("a7_conditional_counts", f"SELECT l_returnflag AS kingdom, p_type AS category, count(*) AS n, count(*) FILTER (WHERE evalue <= 0.02) AS strict, {rq('sum(alen / slen)')} AS gln FROM {_H} GROUP BY 1, 2")
def a7(t: Tables):
    return hits(t).groupBy(F.col("l_returnflag").alias("kingdom"), F.col("p_type").alias("category")).agg(F.count("*").alias("n"), F.count_if(F.col("evalue") <= 0.02).alias("strict"), r(F.sum(F.col("alen") / F.col("slen"))).alias("gln"))


@query("a8_split_credit", "SELECT p_partkey, term, floor(1.0 / k * 1e4 + 0.5) / 1e4 AS credit FROM (SELECT p_partkey, len(string_split(p_name, ' ')) AS k, unnest(string_split(p_name, ' ')) AS term FROM part)")
def a8(t: Tables):
    return H.terms(t.part, "p_name", " ", True).select("p_partkey", "term", r(F.col("credit")).alias("credit"))


@query("a9_score_columns", f"SELECT q, s, line_no, 2 AS cnt, {rq('alen / slen')} AS gln FROM {_H}")
def a9(t: Tables):
    return H.score_columns(hits(t)).select("q", "s", "line_no", "cnt", r(F.col("gln")).alias("gln"))


_VOTES = "(SELECT user_id, event_type FROM events)"


@query("a17_majority", "WITH n AS (SELECT n_name AS mgs, o_orderpriority AS taxon, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), t AS (SELECT mgs, sum(n) AS votes, max(n) AS top_n, arg_max(taxon, struct_pack(a := n, b := taxon)) AS top FROM n GROUP BY 1) SELECT mgs, CASE WHEN top_n > 0.22 * votes THEN top ELSE '?' END AS taxon, top_n, CAST(votes AS BIGINT) AS votes FROM t WHERE votes >= 100")
def a17(t: Tables):
    v = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("mgs"), F.col("o_orderpriority").alias("taxon"))
    return matrix.vote_majority(v, ["mgs"], "taxon", 100, 0.22)


@query("a18_top_taxon", "WITH n AS (SELECT user_id AS mgs, event_type AS taxon, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT mgs, max(n) AS n, arg_max(taxon, struct_pack(a := n, b := taxon)) AS taxon FROM n GROUP BY 1) SELECT mgs, taxon, n FROM t WHERE n > 5")
def a18(t: Tables):
    return rules.top_taxon(t.events.select(F.col("user_id").alias("mgs"), F.col("event_type").alias("taxon")), "mgs", "taxon")


@query("a19_refinement", f"WITH n AS (SELECT source AS mgs, coalesce(lang, '?') AS name, count(*) AS n FROM documents GROUP BY 1, 2), k AS (SELECT mgs, sum(n) AS allv, sum(n) FILTER (WHERE name <> 'fr') AS known, max(n) FILTER (WHERE name <> 'fr') AS top, arg_max(name, struct_pack(a := n, b := name)) FILTER (WHERE name <> 'fr') AS best FROM n GROUP BY 1) SELECT mgs, CASE WHEN known * 1.0 / allv >= 0.7 AND top * 1.0 / known > 0.3 THEN best ELSE '?' END AS species FROM k")
def a19(t: Tables):
    votes = t.documents.select(F.col("source").alias("mgs"), F.coalesce("lang", F.lit("?")).alias("species"))
    return rules.refine_taxon(votes, "mgs", "species", F.col("species") != "fr", top_share=0.3)


@query("a15_purity", f"WITH v AS (SELECT source AS bin, lang AS l0, CAST(n_chars % 3 AS VARCHAR) AS l1 FROM documents), h AS (SELECT bin, count(*) AS hits FROM v GROUP BY 1), n AS (SELECT bin, 0 AS level, l0 AS name, count(*) AS n FROM v GROUP BY 1, 3 UNION ALL SELECT bin, 1, l1, count(*) FROM v WHERE l1 <> '2' GROUP BY 1, 3), p AS (SELECT bin, level, max(n) * 1.0 / sum(n) AS p, sum(n) AS s FROM n GROUP BY 1, 2) SELECT bin, {rq('sum((2 - level) * s / hits * p) / sum((2 - level) * s / hits)')} AS purity FROM p JOIN h USING (bin) GROUP BY 1")
def a15(t: Tables):
    d = t.documents.select(F.col("source").alias("bin"), F.array("lang", F.when(F.col("n_chars") % 3 == 2, "?").otherwise((F.col("n_chars") % 3).cast("string"))).alias("lin"))
    h = d.groupBy("bin").agg(F.count("*").alias("hits"))
    v = d.select("bin", F.posexplode("lin").alias("level", "name")).groupBy("bin", "level", "name").agg(F.count("*").alias("n")).join(h, "bin")
    return B.lineage_purity(v, 2).withColumn("purity", r(F.col("purity")))


def _lca_sql(levels: int = 7) -> str:
    """The consensus level by level: who is left, and the name that enough of them have."""
    tolerance = "CASE " + " ".join(f"WHEN best >= {at} THEN {x}" for at, x in lca.TOLERANCE) + " ELSE 1.5 END"
    allowed = f"{len(lca.LEVEL_IDENTITY) + 1}" + "".join(f" - CAST(id < {x} AS INTEGER)" for x in lca.LEVEL_IDENTITY)
    parts = [
        "h AS (SELECT l_orderkey AS q, CASE WHEN l_extendedprice < 120 THEN 0.0 ELSE CAST(100 * (1 - l_discount) AS DOUBLE) END AS id, l_quantity AS alen, ['part', 'made', 'std', p_type, p_brand, l_returnflag, CAST(p_partkey AS VARCHAR)] AS lin FROM lineitem JOIN part ON l_partkey = p_partkey)",
        "b AS (SELECT q, max(id) AS best, arg_max(alen, struct_pack(a := id, b := alen)) AS len FROM h GROUP BY 1)",
        f"r0 AS (SELECT h.q, lin, {allowed} AS depth, count(*) OVER (PARTITION BY h.q) AS n FROM h JOIN b ON h.q = b.q WHERE id >= best - {tolerance} AND alen >= 0.85::DOUBLE * len)",
    ]
    for k in range(levels):
        parts += [
            f"w{k} AS (SELECT q, name, k FROM (SELECT q, lin[{k + 1}] AS name, count(*) AS k, max(n) AS n FROM r{k} WHERE depth > {k} GROUP BY 1, 2) WHERE k >= ceil(0.9::DOUBLE * n))",
            f"r{k + 1} AS (SELECT r.q, lin, depth, w.k AS n FROM r{k} r JOIN w{k} w ON r.q = w.q AND depth > {k} AND lin[{k + 1}] = name)",
        ]
    names = " || ';' || ".join(f"coalesce(w{k}.name, '?')" for k in range(levels))
    return f"WITH {', '.join(parts)} SELECT x.q, {names} AS lineage FROM (SELECT DISTINCT q FROM r0) x " + " ".join(f"LEFT JOIN w{k} ON w{k}.q = x.q" for k in range(levels))


@query("a16_lca", _lca_sql())
def a16(t: Tables):
    geo = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    h = geo.select(F.col("l_orderkey").alias("q"), (100 * (1 - F.col("l_discount"))).alias("pident"), F.col("l_quantity").alias("alen"), F.col("l_extendedprice").alias("bits"), F.lit(1e-20).alias("evalue"), F.array(F.lit("part"), F.lit("made"), F.lit("std"), "p_type", "p_brand", F.col("l_returnflag"), F.col("p_partkey").cast("string")).alias("lineage"))
    return lca.consensus(lca.usable_rows(h), 7).select("q", F.array_join("lineage", ";").alias("lineage"))


@query("a27_marker_stats", "SELECT p_brand AS mgs, count(*) AS genes, count(DISTINCT p_type) AS markers, max(p_size) AS longest FROM part GROUP BY 1")
def a27(t: Tables):
    return rules.marker_stats(t.part.withColumnRenamed("p_brand", "mgs"), "mgs", "p_type", "p_size")


_OCC = "(SELECT l_partkey AS gene, l_suppkey % 10 AS mgs, count(*) AS occ FROM lineitem GROUP BY 1, 2)"
_OBS = f"(SELECT mgs, max(occ) AS obs FROM {_OCC} GROUP BY 1)"


def _occ(t: Tables):
    c = t.lineitem.groupBy(F.col("l_partkey").alias("gene"), (F.col("l_suppkey") % 10).alias("mgs")).agg(F.count("*").alias("occ"))
    return c.join(c.groupBy("mgs").agg(F.max("occ").alias("obs")), "mgs")


@query("a28_uniqueness", f"WITH c AS {_OCC}, n AS (SELECT gene, count(*) AS k FROM c GROUP BY 1) SELECT mgs, count(*) AS genes, {rq('count(*) * 1.0 / sum(k)')} AS uniqueness FROM c JOIN n USING (gene) GROUP BY 1")
def a28(t: Tables):
    return B.marker_uniqueness(_occ(t)).withColumn("uniqueness", r(F.col("uniqueness")))


@query("m8_declutter", f"WITH c AS {_OCC}, o AS {_OBS}, n AS (SELECT gene, count(*) AS k FROM c GROUP BY 1) SELECT gene, mgs, occ, obs FROM c JOIN o USING (mgs) JOIN n USING (gene) WHERE k = 1 OR least(occ * 1.0 / obs, 1.0) > 0.7")
def m8(t: Tables):
    return B.declutter(_occ(t)).select("gene", "mgs", "occ", "obs")


@query("a29_representative", f"WITH b AS {BINS_SQL}, g AS (SELECT s_nationkey AS mgs, l_suppkey AS bin, l_partkey AS gene, count(*) AS occ, max(p_size) > 45 AS mk FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3), s AS (SELECT mgs, bin, sum(occ * CASE WHEN mk THEN 2 ELSE 1 END) * 1.0 / count(*) / 3 AS x FROM g GROUP BY 1, 2), z AS (SELECT mgs, bin, x + 0.01 * (compl - 2 * conta) AS score FROM s JOIN b USING (bin)) SELECT mgs, bin, {rq('score')} AS score FROM (SELECT *, row_number() OVER (PARTITION BY mgs ORDER BY score DESC, bin) AS n FROM z) WHERE n = 1")
def a29(t: Tables):
    g = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("s_nationkey").alias("mgs"), F.col("l_suppkey").alias("bin"), F.col("l_partkey").alias("gene")).agg(F.count("*").alias("occ"), (F.max("p_size") > 45).alias("is_marker")).withColumn("obs", F.lit(3))
    return B.representative(g, bins(t).select("bin", "compl", "conta")).withColumn("score", r(F.col("score")))


@query("w12_representative_family", f"SELECT bin, s_nationkey FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY compl - 2 * conta DESC, bin) AS n FROM {BINS_SQL} WHERE compl > 60 AND conta < 20) WHERE n = 1")
def w12(t: Tables):
    return B.representative_per_family(bins(t), "s_nationkey").select("bin", "s_nationkey")


@query("w3_moving_average", f"SELECT event_id, {rq('avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)')} AS v FROM events")
def w3(t: Tables):
    return I.moving_average(t.events, ["user_id"], ["ts", "event_id"], "value", 5, "v").select("event_id", r(F.col("v")).alias("v"))


@query("w4_forward_fill", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block FROM events")
def w4(t: Tables):
    e = t.events.withColumn("_h", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    return I.forward_fill(e, ["user_id"], ["ts", "event_id"], "_h", "block").select("event_id", "block")


@query("w5_run_lengths", "WITH m AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), c AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM m) SELECT user_id, CAST(run AS BIGINT) AS run, min(ts) AS first, max(ts) AS last, min(event_type) AS event_type, count(*) AS n FROM c GROUP BY 1, 2")
def w5(t: Tables):
    return I.run_lengths(t.events, ["user_id"], ["ts", "event_id"], "event_type")


@query("w6_pack_regions", f"WITH c AS (SELECT o_orderpriority AS g, o_orderkey AS contig, 1000 + o_orderkey % 5000 AS length, o_totalprice AS depth FROM orders), m AS (SELECT g, avg(depth) AS m FROM c GROUP BY 1), w AS (SELECT c.*, depth * length * CASE WHEN depth > 0.85 * m THEN 1.2 WHEN depth < 0.1 * m THEN 0.8 ELSE 1.0 END AS work FROM c JOIN m USING (g)) SELECT g, count(*) AS contigs, {rq('sum(work) / 8', 0)} AS target FROM w GROUP BY 1")
def w6(t: Tables):
    c = t.orders.select(F.col("o_orderpriority").alias("g"), F.col("o_orderkey").alias("contig"), (1000 + F.col("o_orderkey") % 5000).alias("length"), F.col("o_totalprice").alias("depth"))
    p = I.pack_regions(c, 8, ["contig"], ["g"])
    # Pieces of a contig cover it once; their work adds up to the contig's.
    m = c.groupBy("g").agg(F.avg("depth").alias("m"))
    f = F.when(F.col("depth") > 0.85 * F.col("m"), 1.2).when(F.col("depth") < 0.1 * F.col("m"), 0.8).otherwise(1.0)
    whole = p.groupBy("g", "contig").agg(F.sum(F.col("end") - F.col("start") + 1).alias("covered"))
    return whole.join(c, ["g", "contig"]).join(m, "g").groupBy("g").agg(F.count("*").alias("contigs"), r(F.sum(F.col("depth") * F.col("covered") * f) / 8, 0).alias("target"))


@query("w6_fixed_regions", "SELECT p_partkey AS contig, i * 10 + 1 AS start, least((i + 1) * 10, p_size) AS \"end\" FROM (SELECT p_partkey, p_size, unnest(range(0, (p_size + 9) // 10)) AS i FROM part)")
def w6_fixed(t: Tables):
    return I.fixed_regions(t.part.select(F.col("p_partkey").alias("contig"), F.col("p_size").cast("long").alias("length")), 10)


@query("w9_priority_limit", "WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_size DESC, p_partkey) AS a FROM part) WHERE a = 1), k AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS b FROM f) SELECT p_brand, p_type, p_partkey FROM k WHERE b <= 2")
def w9(t: Tables):
    return rules.priority_limit(t.part, "p_brand", "p_type", [F.desc("p_size"), F.col("p_partkey")], 2).select("p_brand", "p_type", "p_partkey")


@query("w10_artificial_ids", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'uniq' || row_number() OVER (PARTITION BY c_nationkey, c_acctbal < 0 ORDER BY c_custkey) ELSE c_mktsegment END AS cog FROM customer")
def w10(t: Tables):
    return rules.artificial_ids(t.customer, ["c_nationkey"], ["c_custkey"], F.col("c_acctbal") < 0, F.col("c_mktsegment"), "cog").select("c_custkey", "cog")


@query("w13_renumber", "SELECT p_partkey, p_brand || '__C' || row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) || '_L=' || p_size || '=' AS new_id FROM part")
def w13(t: Tables):
    from ..operators.sequences import gene_catalogue_name

    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    return t.part.select("p_partkey", gene_catalogue_name(F.col("p_brand"), F.row_number().over(w), F.col("p_size")).alias("new_id"))


@query("u1_union_all", "SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY 1")
def u1(t: Tables):
    return t.customer.select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k"))).groupBy("k").agg(F.count("*").alias("n"))


@query("u2_union", "SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders")
def u2(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("k")).union(t.orders.select("o_custkey")).distinct()


@query("u3_intersect", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def u3(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("k")).intersect(t.orders.select("o_custkey"))


@query("u4_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def u4(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("k")).exceptAll(t.orders.select("o_custkey").distinct())


@query("u5_merge_clusters", "WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS u, l_suppkey + l_linenumber * 10 AS v FROM lineitem), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e), r AS (SELECT u AS node, u AS root FROM b UNION SELECT b.v, r.root FROM r JOIN b ON b.u = r.node WHERE r.root < b.v) SELECT node, min(root) AS root FROM r GROUP BY 1")
def u5(t: Tables):
    e = t.lineitem.select(F.col("l_suppkey").alias("a"), (F.col("l_suppkey") + F.col("l_linenumber") * 10).alias("b"))
    return graph.merge_clusters(e)


@query("u6_correlated_sets", "WITH a AS (SELECT l_partkey AS k, avg(l_discount) AS x FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT l_partkey AS k, avg(l_tax) AS y FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) SELECT k FROM a FULL JOIN b USING (k) WHERE (x IS NOT NULL AND y IS NOT NULL) OR x > 0.06")
def u6(t: Tables):
    a = t.lineitem.filter("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("k")).agg(F.avg("l_discount").alias("x"))
    b = t.lineitem.filter("l_returnflag = 'A'").groupBy(F.col("l_partkey").alias("k")).agg(F.avg("l_tax").alias("y"))
    return rules.correlated_union(a, b, "k", "x", "y", 0.06)


@query("u7_later_wins", "SELECT k, l_linenumber, l_suppkey FROM (SELECT l_partkey % 500 AS k, l_linenumber, l_suppkey, row_number() OVER (PARTITION BY l_partkey % 500 ORDER BY l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem) WHERE n = 1")
def u7(t: Tables):
    c = t.lineitem.select((F.col("l_partkey") % 500).alias("k"), "l_linenumber", "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))
    return variants.later_wins(c, ["k"], "o").select("k", "l_linenumber", "l_suppkey")
