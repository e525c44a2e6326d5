"""Queries on matrices, hierarchies, aggregations and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import stats, taxa
from ..operators import matrix, rules
from ..shared import dealt
from .registry import Tables, query
from .views import BINS_SQL, abund, bins, r, rq

ABUND = "SELECT l_partkey AS feature, l_suppkey AS sample, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2"


@query("a1_merge_samples", f"SELECT l.lv AS level, array_to_string([p_type, p_brand, p_name][1:l.lv + 1], ';') AS prefix, l_suppkey AS sample, sum(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey, (SELECT unnest([0, 1, 2]) AS lv) l GROUP BY 1, 2, 3")
def a1(t: Tables):
    lv = t.part.select(F.col("p_partkey").alias("feature"), F.array("p_type", "p_brand", "p_name").alias("levels"), F.lit(1.0).alias("weight"))
    parts = [t.lineitem.filter(F.col("l_linenumber") % 2 == k).select(F.col("l_partkey").alias("feature"), F.col("l_suppkey").alias("sample"), F.col("l_quantity").alias("value")) for k in (0, 1)]
    n = t.lineitem.count()
    return matrix.roll_up(matrix.merge_samples(parts, n), lv, rows=n)


@query("a2_roll_up", "WITH j AS (SELECT l_suppkey AS sample, l_quantity q, p_type, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey), v AS (SELECT 0 AS level, p_type AS prefix, sample, q FROM j UNION ALL SELECT 1, p_type || ';' || p_brand, sample, q FROM j) SELECT level, prefix, sample, round(sum(q), 2) AS value FROM v GROUP BY 1, 2, 3")
def a2(t: Tables):
    lv = t.part.select(F.col("p_partkey").alias("feature"), F.array("p_type", "p_brand").alias("levels"), F.lit(1.0).alias("weight"))
    n = t.lineitem.count()
    return matrix.roll_up(abund(t, n), lv, rows=n).withColumn("value", F.round("value", 2))


@query("a2_and_or_credit", f"WITH x AS (SELECT l_suppkey AS sample, l_quantity AS q, string_split(p_name, ' ') AS w FROM lineitem JOIN part ON l_partkey = p_partkey), y AS (SELECT sample, q, unnest(w) AS item, len(w) AS n FROM x) SELECT item, sample, {rq('sum(q / n)')} AS shared, {rq('sum(q)')} AS full_credit FROM y GROUP BY 1, 2")
def a2_credit(t: Tables):
    names = t.part.select(F.col("p_partkey").alias("gene"), F.replace("p_name", F.lit(" "), F.lit("|")).alias("terms"))
    share = matrix.credit_terms(names).withColumnRenamed("gene", "feature")
    j = abund(t).join(share, "feature")
    return j.groupBy("item", "sample").agg(r(F.sum(F.col("value") * F.col("weight"))).alias("shared"), r(F.sum("value")).alias("full_credit"))


@query("a3_marker_means", f"WITH a AS ({ABUND}), x AS (SELECT p_brand AS grp, sample, feature, value FROM a JOIN part ON feature = p_partkey WHERE value > 0), p AS (SELECT grp, sample, avg(value) AS value, count(*) AS n FROM x GROUP BY 1, 2 HAVING count(*) >= 2), s AS (SELECT grp, count(DISTINCT feature) AS genes FROM x GROUP BY 1 HAVING count(DISTINCT feature) >= 5) SELECT grp, sample, {rq('value')} AS value, n, genes FROM p JOIN s USING (grp)")
def a3(t: Tables):
    m = t.part.select(F.col("p_partkey").alias("feature"), F.col("p_brand").alias("grp"))
    return matrix.marker_means(abund(t), m, 5, 2).withColumn("value", r(F.col("value")))


@query("a4_cluster_matrix", f"SELECT p_brand AS cluster_id, l_suppkey AS sample, sum(l_linenumber) AS count, {rq('avg(l_quantity)')} AS mean_cov, {rq('quantile_cont(l_quantity, 0.5)')} AS median_cov FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def a4(t: Tables):
    members = t.part.select(F.col("p_brand").alias("cluster_id"), F.col("p_partkey").alias("member"))
    cov = t.lineitem.select(F.col("l_partkey").alias("member"), F.col("l_suppkey").alias("sample"), F.col("l_linenumber").alias("count"), F.col("l_quantity").alias("cov"))
    return matrix.cluster_matrix(members, cov).withColumn("mean_cov", r(F.col("mean_cov"))).withColumn("median_cov", r(F.col("median_cov")))


@query("a5_normalize", f"WITH a AS ({ABUND}) SELECT feature, sample, {rq('value / sum(value) OVER (PARTITION BY sample)', 8)} AS value FROM a")
def a5(t: Tables):
    return matrix.normalize(abund(t)).withColumn("value", r(F.col("value"), 8))


@query("a6_modules", f"WITH a AS ({ABUND}), m AS (SELECT p_brand AS module, p_partkey AS feature FROM part), n AS (SELECT module, count(*) AS n FROM m GROUP BY 1), h AS (SELECT module, sample, count(*) AS k, quantile_cont(value, 0.5) AS value FROM a JOIN m USING (feature) WHERE value > 0 GROUP BY 1, 2) SELECT module, sample, {rq('k * 1.0 / n')} AS complete, {rq('value')} AS value FROM h JOIN n USING (module) WHERE k * 1.0 / n >= 0.2")
def a6(t: Tables):
    m = t.part.select(F.col("p_brand").alias("module"), F.col("p_partkey").alias("feature"))
    return matrix.module_scores(m, abund(t), 0.2).withColumn("complete", r(F.col("complete"))).withColumn("value", r(F.col("value")))


@query("a10_distinct", "SELECT l_orderkey AS q, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1")
def a10(t: Tables):
    return t.lineitem.groupBy(F.col("l_orderkey").alias("q")).agg(F.size(F.array_distinct(F.collect_list("l_suppkey"))).cast("long").alias("n"))


_NEAREST = "(SELECT k, v FROM (SELECT o_orderpriority AS k, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) WHERE i = {at})"


@query("a11_quantiles", f"SELECT o_orderpriority AS k, {rq('avg(o_totalprice)', 2)} AS mean, {rq('quantile_cont(o_totalprice, 0.5)', 2)} AS median, {rq('quantile_cont(o_totalprice, 0.9)', 2)} AS r7, max(a.v) AS nearest, max(b.v) AS floored FROM orders JOIN {_NEAREST.format(at='CAST(floor((n - 1) * 0.9 + 0.5) AS BIGINT)')} a ON a.k = o_orderpriority JOIN {_NEAREST.format(at='least(CAST(floor(n * 0.9) AS BIGINT), n - 1)')} b ON b.k = o_orderpriority GROUP BY 1")
def a11(t: Tables):
    o = t.orders.select(F.col("o_orderpriority").alias("k"), F.col("o_totalprice").alias("v"))
    base = o.groupBy("k").agg(r(F.avg("v"), 2).alias("mean"), r(stats.true_median(F.col("v")), 2).alias("median"), r(stats.quantile_linear(F.col("v"), 0.9), 2).alias("r7"))
    return base.join(stats.quantile_nearest(o, ["k"], "v", 0.9, "nearest"), "k").join(stats.quantile_floor(o, ["k"], "v", 0.9, "floored"), "k")


@query("a12_vector_average", f"SELECT label, CAST(i AS INTEGER) AS i, {rq('avg(embedding[i + 1])', 5)} AS mean FROM embeddings, (SELECT unnest(range(0, 1024)) AS i) WHERE i < len(embedding) GROUP BY 1, 2")
def a12(t: Tables):
    e = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    return e.groupBy("label", "i").agg(r(F.avg(F.col("x").cast("double")), 5).alias("mean"))


@query("a13_species_profile", f"WITH a AS ({ABUND}), n AS (SELECT p_brand AS species, count(*) AS n FROM part GROUP BY 1) SELECT species, sample, {rq('sum(value) / max(n)')} AS value FROM a JOIN part ON feature = p_partkey JOIN n ON species = p_brand GROUP BY 1, 2")
def a13(t: Tables):
    m = t.part.select(F.col("p_partkey").alias("feature"), F.col("p_brand").alias("species"))
    return rules.species_profile(abund(t), m).withColumn("value", r(F.col("value")))


@query("a14_rank_profile", "WITH c AS (SELECT o_orderstatus AS sample, o_totalprice AS v, r_name, n_name, c_mktsegment AS s FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), x AS (SELECT 0 AS level, r_name AS prefix, sample, v FROM c WHERE s <> 'MACHINERY' UNION ALL SELECT 1, r_name || ';' || n_name, sample, v FROM c WHERE s <> 'MACHINERY' UNION ALL SELECT 0, '?', sample, v FROM c WHERE s = 'MACHINERY') SELECT level, prefix, sample, round(sum(v), 0) AS value FROM x GROUP BY 1, 2, 3")
def a14(t: Tables):
    geo = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    lin = geo.select(F.col("c_custkey").alias("feature"), F.array("r_name", "n_name").alias("levels"), F.lit(1.0).alias("weight"), "c_mktsegment")
    n = t.orders.count()
    o = t.orders.select(F.col("o_custkey").alias("feature"), F.col("o_orderstatus").alias("sample"), F.col("o_totalprice").alias("value"))
    a = dealt(o, n, "feature").groupBy("feature", "sample").agg(F.sum("value").alias("value"))
    known, rest = lin.filter("c_mktsegment != 'MACHINERY'").drop("c_mktsegment"), lin.filter("c_mktsegment = 'MACHINERY'").select("feature")
    back = a.join(rest, "feature", "left_semi").groupBy("sample").agg(F.sum("value").alias("value"))
    return matrix.rank_profile(a.join(rest, "feature", "left_anti"), known, back, n).withColumn("value", F.round("value", 0))


@query("a20_label_counts", "SELECT array_to_string([coalesce(lang, '?'), coalesce(source, '?'), '?', '?', '?', '?', '?'], ';') AS lineage, count(*) AS n FROM documents GROUP BY 1")
def a20(t: Tables):
    lin = taxa.pad_lineage(F.array("lang", "source"), 7)
    return t.documents.groupBy(F.array_join(lin, ";").alias("lineage")).agg(F.count("*").alias("n"))


@query("a24_n50", "WITH c AS (SELECT lang, length(coalesce(text, '')) AS l FROM documents), w AS (SELECT lang, l, sum(l) OVER (PARTITION BY lang ORDER BY l DESC) AS upto, sum(l) OVER (PARTITION BY lang) AS total FROM c) SELECT c.lang, count(*) AS n, sum(c.l) AS total, max(c.l) AS longest, min(c.l) AS shortest, quantile_cont(c.l, 0.5) AS median, max(n50) AS n50 FROM c JOIN (SELECT lang, max(l) AS n50 FROM w WHERE upto >= 0.5 * total GROUP BY 1) USING (lang) GROUP BY 1")
def a24(t: Tables):
    c = t.documents.select("lang", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("l"))
    n50 = matrix.cumulative_half(c, ["lang"], "l")
    return c.groupBy("lang").agg(F.count("*").alias("n"), F.sum("l").alias("total"), F.max("l").alias("longest"), F.min("l").alias("shortest"), F.percentile("l", F.lit(0.5)).alias("median")).join(n50, "lang")


@query("a31_members_less_one", "SELECT p_brand AS cluster_id, count(*) - 1 AS n FROM part GROUP BY 1")
def a31(t: Tables):
    return t.part.groupBy(F.col("p_brand").alias("cluster_id")).agg((F.count("*") - 1).alias("n"))


@query("a32_histogram", "SELECT CASE WHEN l_quantity >= 40 THEN 4 WHEN l_quantity >= 20 THEN 3 WHEN l_quantity >= 10 THEN 2 WHEN l_quantity >= 5 THEN 1 ELSE 0 END AS bucket, CAST(floor(l_quantity / 10) AS BIGINT) AS ten, count(*) AS n FROM lineitem GROUP BY 1, 2")
def a32(t: Tables):
    return t.lineitem.groupBy(stats.histogram(F.col("l_quantity"), [5, 10, 20, 40]).alias("bucket"), F.floor(F.col("l_quantity") / 10).alias("ten")).agg(F.count("*").alias("n"))


@query("a33_set_overlap", "WITH s AS (SELECT DISTINCT p_brand AS b, l_suppkey AS k FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT b, count(*) AS n FROM s GROUP BY 1), i AS (SELECT x.b AS a, y.b AS b, count(*) AS inter FROM s x JOIN s y ON x.k = y.k AND x.b < y.b GROUP BY 1, 2) SELECT i.a, i.b, inter, p.n + q.n - inter AS uni FROM i JOIN n p ON p.b = i.a JOIN n q ON q.b = i.b")
def a33(t: Tables):
    s = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("b"), F.col("l_suppkey").alias("k"))
    return rules.set_overlap(s, "b", "k")


@query("a34_normalize_by_reads", f"WITH a AS ({ABUND}), d AS (SELECT l_suppkey AS sample, count(*) AS n FROM lineitem GROUP BY 1) SELECT feature, sample, {rq('value * 1000.0 / n')} AS value FROM a JOIN d USING (sample)")
def a34(t: Tables):
    d = t.lineitem.groupBy(F.col("l_suppkey").alias("sample")).agg(F.count("*").alias("n"))
    return matrix.scale_by(abund(t), d, 1000.0).withColumn("value", r(F.col("value")))


@query("a39_completeness_summary", f"SELECT source AS sample, count(*) AS genes, {rq('count(*) FILTER (WHERE n_chars % 4 = 0) * 100.0 / count(*)', 3)} AS complete, {rq('count(*) FILTER (WHERE n_chars % 4 = 1) * 100.0 / count(*)', 3)} AS no3, {rq('count(*) FILTER (WHERE n_chars % 4 = 2) * 100.0 / count(*)', 3)} AS no5, {rq('count(*) FILTER (WHERE n_chars % 4 = 3) * 100.0 / count(*)', 3)} AS fragment FROM documents GROUP BY 1")
def a39(t: Tables):
    from ..operators.sequences import completeness

    part = F.element_at(F.array(*[F.lit(x) for x in ("00", "01", "10", "11")]), (F.col("n_chars") % 4 + 1).cast("int"))
    c = t.documents.select(F.col("source").alias("sample"), completeness(part).alias("kind"))
    share = lambda k: r(F.count_if(F.col("kind") == k) * 100.0 / F.count("*"), 3).alias(k)
    return c.groupBy("sample").agg(F.count("*").alias("genes"), *[share(k) for k in ("complete", "no3", "no5", "fragment")])


@query("a40_samples_per_group", f"WITH n AS (SELECT p_brand AS mgs, l_suppkey AS s, count(DISTINCT l_partkey) AS g FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) SELECT mgs, count(*) FILTER (WHERE g > 1) AS samples, {rq('quantile_cont(g, 0.5)')} AS q50, {rq('quantile_cont(g, 0.9)')} AS q90 FROM n GROUP BY 1")
def a40(t: Tables):
    n = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("mgs"), F.col("l_suppkey").alias("s")).agg(F.countDistinct("l_partkey").alias("g"))
    return rules.samples_per_group(n, "mgs", "g", 1).withColumn("q50", r(F.col("q50"))).withColumn("q90", r(F.col("q90")))


@query("k1_wide_matrix", "SELECT p_brand AS feature, " + ", ".join(f"coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = '{f}'), 0.0) AS {f}" for f in ("A", "N")) + ", '-' AS R FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def k1(t: Tables):
    a = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("feature"), F.col("l_returnflag").alias("sample"), F.col("l_quantity").alias("value"))
    return matrix.wide(a, ["A", "N", "R"], ["R"])


@query("k3_norm_by_kingdom", f"WITH x AS (SELECT l_returnflag AS k, p_type AS c, l_quantity AS a, l_quantity / p_size AS g FROM lineitem JOIN part ON l_partkey = p_partkey), y AS (SELECT k, c, a, g FROM x UNION ALL SELECT 'ALL', c, a, g FROM x) SELECT 'cnt' AS norm, k AS kingdom, c AS category, {rq('count(*) * 1.0')} AS score, count(*) AS n FROM y GROUP BY 2, 3 UNION ALL SELECT 'gln', k, c, {rq('sum(g)')}, count(*) FROM y GROUP BY 2, 3")
def k3(t: Tables):
    from ..operators.hits import category_totals
    from .views import hits

    return category_totals(hits(t), {"cnt": F.lit(1), "gln": F.col("alen") / F.col("slen")}, "l_returnflag", "p_type").withColumn("score", r(F.col("score")))


@query("k11_run_statistics", f"SELECT l_suppkey AS sample, count(*) AS reads, sum(l_quantity) AS bases, {rq('avg(l_discount) * 100', 3)} AS rejected, count(DISTINCT l_orderkey) AS templates, max(l_shipdate) AS last_run FROM lineitem GROUP BY 1")
def k11(t: Tables):
    measures = {"reads": F.count("*"), "bases": F.sum("l_quantity"), "rejected": r(F.avg("l_discount") * 100, 3), "templates": F.countDistinct("l_orderkey"), "last_run": F.max("l_shipdate")}
    return rules.run_statistics(t.lineitem, "l_suppkey", measures)


@query("s8_matrix_scan", "SELECT p_brand AS feature, l_returnflag AS sample, sum(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def s8(t: Tables):
    a = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("feature"), F.col("l_returnflag").alias("sample"), F.col("l_quantity").alias("value"))
    return matrix.to_long(matrix.wide(a, ["A", "N", "R"]), "feature")


@query("w8_fractional_ranks", "SELECT o_orderkey, (rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1) + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2.0 AS rank FROM orders")
def w8(t: Tables):
    return stats.fractional_ranks(t.orders, ["o_orderpriority"], "o_totalprice").select("o_orderkey", "rank")


@query("f15_quantile_cascade", "WITH s AS (SELECT p_type AS gene, l_suppkey AS id, sum(l_quantity) AS len FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), g AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY len) - 1 AS i, count(*) OVER (PARTITION BY gene) AS n FROM s), q AS (SELECT gene, len AS q90 FROM g WHERE i = CAST(floor((n - 1) * 0.9 + 0.5) AS BIGINT)), k AS (SELECT s.* FROM s JOIN q USING (gene) WHERE len >= 0.5 * q90), n AS (SELECT gene, count(*) AS m FROM k GROUP BY 1), o AS (SELECT m, row_number() OVER (ORDER BY m) - 1 AS i, count(*) OVER () AS n FROM n), z AS (SELECT m AS q FROM o WHERE i = CAST(floor((n - 1) * 0.9 + 0.5) AS BIGINT)) SELECT gene, m, q FROM n, z WHERE m >= 0.6 * q")
def f15(t: Tables):
    s = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_type").alias("gene"), F.col("l_suppkey").alias("id")).agg(F.sum("l_quantity").alias("len"))
    k = s.join(stats.quantile_nearest(s, ["gene"], "len", 0.9, "q90"), "gene").filter(F.col("len") >= 0.5 * F.col("q90"))
    n = k.groupBy("gene").agg(F.count("*").alias("m"))
    q = stats.quantile_nearest(n, [], "m", 0.9, "q")
    return n.crossJoin(F.broadcast(q)).filter(F.col("m") >= 0.6 * F.col("q"))  # one row


@query("f17_outliers", "WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.1) AS lo, quantile_cont(o_totalprice, 0.9) AS hi FROM orders GROUP BY 1) SELECT o_orderkey, o_totalprice FROM orders JOIN q USING (o_orderpriority) WHERE o_totalprice > 0.9 * lo AND o_totalprice < 1.1 * hi")
def f17(t: Tables):
    q = t.orders.groupBy("o_orderpriority").agg(stats.quantile_linear(F.col("o_totalprice"), 0.1).alias("lo"), stats.quantile_linear(F.col("o_totalprice"), 0.9).alias("hi"))
    return t.orders.join(q, "o_orderpriority").filter((F.col("o_totalprice") > 0.9 * F.col("lo")) & (F.col("o_totalprice") < 1.1 * F.col("hi"))).select("o_orderkey", "o_totalprice")


@query("m1_pearson", f"SELECT p_brand AS key, count(*) AS n, {rq('corr(l_quantity, l_extendedprice)')} AS r FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 HAVING count(*) > 2")
def m1(t: Tables):
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy(F.col("p_brand").alias("key")).agg(F.count("*").alias("n"), r(stats.pearson(F.col("l_quantity"), F.col("l_extendedprice"))).alias("r")).filter("n > 2")


@query("m2_spearman", f"WITH x AS (SELECT p_brand AS key, l_quantity AS x, l_extendedprice AS y FROM lineitem JOIN part ON l_partkey = p_partkey), k AS (SELECT key, (rank() OVER (PARTITION BY key ORDER BY x) - 1) + (count(*) OVER (PARTITION BY key, x) - 1) / 2.0 AS rx, (rank() OVER (PARTITION BY key ORDER BY y) - 1) + (count(*) OVER (PARTITION BY key, y) - 1) / 2.0 AS ry FROM x) SELECT key, {rq('1 - 6 * sum((rx - ry) * (rx - ry)) / (count(*) * (count(*) * count(*) - 1.0))')} AS rho FROM k GROUP BY 1 HAVING count(*) > 1")
def m2(t: Tables):
    from ..operators.correlate import spearman

    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("key"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return spearman(j).filter("rho is not null").withColumn("rho", r(F.col("rho")))


@query("f11_non_zero", "SELECT l_suppkey, count(*) FILTER (WHERE l_discount <> 0) AS n FROM lineitem GROUP BY 1")
def f11(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(stats.non_zero(F.col("l_discount")).alias("n"))


@query("f24_threshold_sweep", "SELECT c AS threshold, count(*) AS n FROM lineitem, (SELECT unnest([0.01, 0.02, 0.05, 0.08]) AS c) WHERE l_discount >= c GROUP BY 1")
def f24(t: Tables):
    steps = F.explode(F.filter(F.array(*[F.lit(x) for x in (0.01, 0.02, 0.05, 0.08)]), lambda c: F.col("l_discount") >= c))
    return t.lineitem.select(steps.alias("threshold")).groupBy("threshold").agg(F.count("*").alias("n"))


@query("o2_value_order", "SELECT p_brand, sum(l_quantity) AS v, row_number() OVER (ORDER BY sum(l_quantity) DESC, p_brand) AS place FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def o2(t: Tables):
    s = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.sum("l_quantity").alias("v")).withColumn("_v", -F.col("v"))
    return matrix.numbered(s, ["_v", "p_brand"], "place").select("p_brand", "v", (F.col("place") + 1).alias("place"))


@query("o1_grouped_order", "SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS numbers FROM lineitem GROUP BY 1")
def o1(t: Tables):
    rows = matrix.grouped_order(t.lineitem.select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber").withColumn("_at", F.monotonically_increasing_id())
    own = F.array_sort(F.collect_list(F.struct("_at", "l_linenumber")))  # places as dealt tell the order
    return rows.groupBy("l_orderkey").agg(F.array_join(F.transform(own, lambda x: x["l_linenumber"].cast("string")), ",").alias("numbers"))


@query("o3_several_keys", "SELECT s_suppkey, row_number() OVER (ORDER BY n DESC, s_name DESC) AS place FROM supplier JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey")
def o3(t: Tables):
    n = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    rows = t.supplier.join(n, F.col("s_suppkey") == F.col("l_suppkey")).select("s_suppkey", "s_name", "n")
    placed = matrix.sorted_by(rows, ("n", True), ("s_name", True)).withColumn("_at", F.monotonically_increasing_id())
    return matrix.numbered(placed, ["_at"], "_no").select("s_suppkey", (F.col("_no") + 1).alias("place"))


@query("o4_length_order", "SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents")
def o4(t: Tables):
    placed = matrix.sorted_by(t.documents.select("doc_id", "n_chars"), ("n_chars", True), "doc_id").withColumn("_at", F.monotonically_increasing_id())
    return matrix.numbered(placed, ["_at"], "_no").select("doc_id", (F.col("_no") + 1).alias("place"))


@query("o7_lowest_groups", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n, l_suppkey LIMIT 5")
def o7(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).orderBy("n", "l_suppkey").limit(5)


@query("o8_frequency", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def o8(t: Tables):
    return matrix.frequency(t.events, "event_type")


@query("o5_natural_order", "SELECT c_name, CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) AS number, row_number() OVER (ORDER BY CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT), c_name) - 1 AS place FROM customer")
def o5(t: Tables):
    c = t.customer.select("c_name", F.regexp_extract("c_name", "([0-9]+)$", 1).cast("long").alias("number"))
    return matrix.numbered(c, ["number", "c_name"], "place")


@query("o6_limit_per_group", "SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS n FROM part) WHERE n <= 3")
def o6(t: Tables):
    w = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return t.part.withColumn("_n", F.row_number().over(w)).filter("_n <= 3").select("p_brand", "p_partkey")
