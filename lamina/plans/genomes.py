"""Queries on modules, pileups and trees, beside those of the other files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq as S
from ..operators import association, correlate, graph, homology, matrix, modules, pileup
from ..operators import sequences as Q
from .registry import Tables, query
from .views import DNA_SQL, dna, r, rq

# Modules: a brand's parts by size make its steps, a step's parts of one type a complex of it, types that begin with PROMO are optional parts of the others' complex.
_TEN = "SELECT l_partkey AS feature, l_suppkey % 10 AS sample, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2"
_PARTS = "(SELECT p_brand AS module, p_size % 4 AS step, p_size % 3 AS choice, p_partkey AS feature, NOT starts_with(p_type, 'PROMO') AS required FROM part)"


def _ten(t: Tables):
    return t.lineitem.groupBy(F.col("l_partkey").alias("feature"), (F.col("l_suppkey") % 10).alias("sample")).agg(F.sum("l_quantity").alias("value"))


@query(
    "a6_module_definitions",
    f"""WITH p AS {_PARTS}, a AS ({_TEN}),
n AS (SELECT module, step, choice, count(*) FILTER (WHERE required) AS needed FROM p GROUP BY 1, 2, 3),
s AS (SELECT module, count(*) FILTER (WHERE needed > 0) AS needed FROM (SELECT module, step, sum(needed) AS needed FROM n GROUP BY 1, 2) GROUP BY 1),
c AS (SELECT module, step, choice, sample, count(*) FILTER (WHERE required) AS have, quantile_cont(value, 0.5) AS value FROM p JOIN a USING (feature) WHERE value > 0 GROUP BY 1, 2, 3, 4),
k AS (SELECT module, step, sample, sum(value) AS value FROM c JOIN n USING (module, step, choice) WHERE needed = 0 OR have * 1.0 / needed >= 0.5 GROUP BY 1, 2, 3),
g AS (SELECT module, step, sum(needed) > 0 AS required FROM n GROUP BY 1, 2),
m AS (SELECT module, sample, count(*) FILTER (WHERE required) AS have, quantile_cont(value, 0.5) AS value FROM k JOIN g USING (module, step) GROUP BY 1, 2)
SELECT module, sample, {rq('CASE WHEN needed = 0 THEN 1 ELSE have * 1.0 / needed END')} AS complete, {rq('value')} AS value FROM m JOIN s USING (module) WHERE CASE WHEN needed = 0 THEN 1 ELSE have * 1.0 / needed END >= 0.5""",
)
def a6_definitions(t: Tables):
    name = F.concat(F.when(F.col("p_type").startswith("PROMO"), "-").otherwise("+"), F.col("p_partkey").cast("string"))
    ordered = lambda *by: F.array_sort(F.collect_list(F.struct(*by)))
    text = lambda column, sep: F.array_join(F.transform(column, lambda x: x["text"]), sep)
    parts = t.part.select(F.col("p_brand").alias("module"), (F.col("p_size") % 4).alias("step"), (F.col("p_size") % 3).alias("choice"), F.col("p_partkey").alias("k"), name.alias("text"))
    whole = parts.groupBy("module", "step", "choice").agg(F.regexp_replace(text(ordered("k", "text"), ""), r"^\+", "").alias("text"))
    steps = whole.groupBy("module", "step").agg(F.concat(F.lit("("), text(ordered("choice", "text"), ","), F.lit(")")).alias("text"))
    definitions = steps.groupBy("module").agg(text(ordered("step", "text"), " ").alias("definition"))
    return modules.module_completeness(definitions, _ten(t)).withColumn("complete", r(F.col("complete"))).withColumn("value", r(F.col("value")))


# Alignments: each lineitem is a read on its part, with a deletion, an insertion and a clipped end.
_READS = """(SELECT l_partkey AS contig, CAST(l_orderkey % 300 + 1 AS BIGINT) AS pos, CAST(l_quantity AS BIGINT) AS a, CAST(l_linenumber % 3 AS BIGINT) AS d, CAST(l_suppkey % 20 + 1 AS BIGINT) AS b, CAST(l_linenumber % 2 AS BIGINT) AS i, CAST(l_suppkey % 4 AS BIGINT) AS s, CAST(l_linenumber * 7 AS INTEGER) AS mapq, l_orderkey + l_suppkey AS turn FROM lineitem)"""


def _reads(t: Tables):
    n = lambda c: c.cast("long")
    x = t.lineitem.select(F.col("l_partkey").alias("contig"), (F.col("l_orderkey") % 300 + 1).alias("pos"), n(F.col("l_quantity")).alias("a"), n(F.col("l_linenumber") % 3).alias("d"), n(F.col("l_suppkey") % 20 + 1).alias("b"), n(F.col("l_linenumber") % 2).alias("i"), n(F.col("l_suppkey") % 4).alias("s"), (F.col("l_linenumber") * 7).cast("int").alias("mapq"), (F.col("l_orderkey") + F.col("l_suppkey")).alias("turn"))
    op = lambda k, letter: F.when(F.col(k) > 0, F.concat(F.col(k).cast("string"), F.lit(letter))).otherwise("")
    cigar = F.concat(op("a", "M"), op("d", "D"), op("b", "M"), op("i", "I"), op("a", "M"), op("s", "S"))
    size = (2 * F.col("a") + F.col("b") + F.col("i") + F.col("s")).cast("int")
    seq = F.substring(F.repeat(F.lit("ACGTTGCA"), F.lit(20)), (F.col("turn") % 8 + 1).cast("int"), size)
    return x.select("contig", "pos", cigar.alias("cigar"), seq.alias("seq"), "mapq")


_SPANS = f"(SELECT *, unnest([{{'f': pos, 'n': a, 'q': 0}}, {{'f': pos + a + d, 'n': b, 'q': a}}, {{'f': pos + a + d + b, 'n': a, 'q': a + b + i}}], recursive := true) FROM {_READS} WHERE mapq >= 14)"
_EACH = f"(SELECT contig, f + o AS pos, substr(repeat('ACGTTGCA', 20), CAST(turn % 8 + 1 + q + o AS BIGINT), 1) AS base FROM (SELECT *, unnest(range(0, n)) AS o FROM {_SPANS}))"


@query(
    "c2_depth_runs",
    f"""WITH d AS (SELECT contig, pos, count(*) AS depth FROM {_EACH} GROUP BY 1, 2),
g AS (SELECT *, CASE WHEN lag(depth) OVER w = depth AND lag(pos) OVER w = pos - 1 THEN 0 ELSE 1 END AS new FROM d WINDOW w AS (PARTITION BY contig ORDER BY pos)),
h AS (SELECT *, sum(new) OVER (PARTITION BY contig ORDER BY pos) AS run FROM g)
SELECT contig, min(pos) AS start, max(pos) AS "end", any_value(depth) AS depth FROM h GROUP BY contig, run""",
)
def c2_depth(t: Tables):
    return pileup.depth_runs(_reads(t), 14)


@query(
    "c2_base_counts",
    f"""WITH e AS (SELECT contig, pos, lower(base) AS what FROM {_EACH} UNION ALL SELECT contig, pos + a + o, 'deleted' FROM (SELECT *, unnest(range(0, d)) AS o FROM {_READS} WHERE mapq >= 14) UNION ALL SELECT contig, pos + a + d + b - 1, 'inserted' FROM {_READS} WHERE mapq >= 14 AND i > 0)
SELECT contig, pos, count(*) FILTER (WHERE length(what) = 1) AS depth, count(*) FILTER (WHERE what = 'a') AS a, count(*) FILTER (WHERE what = 'c') AS c, count(*) FILTER (WHERE what = 'g') AS g, count(*) FILTER (WHERE what = 't') AS t, count(*) FILTER (WHERE what = 'n') AS n, count(*) FILTER (WHERE what = 'deleted') AS deleted, count(*) FILTER (WHERE what = 'inserted') AS inserted FROM e GROUP BY 1, 2""",
)
def c2_bases(t: Tables):
    return pileup.base_counts(_reads(t), 14)


@query(
    "c2_pileup_calls",
    f"""WITH e AS (SELECT contig, pos, base FROM {_EACH}), r AS (SELECT p_partkey AS contig, repeat('GATTACA', 80) AS seq FROM part),
n AS (SELECT contig, pos, seq[pos] AS ref, count(*) AS depth, count(*) FILTER (WHERE base = 'A') AS A, count(*) FILTER (WHERE base = 'C') AS C, count(*) FILTER (WHERE base = 'G') AS G, count(*) FILTER (WHERE base = 'T') AS T FROM e JOIN r USING (contig) WHERE pos <= 560 GROUP BY 1, 2, 3),
o AS (SELECT *, list_sort(list_filter([{{'n': -A, 'b': 'A'}}, {{'n': -C, 'b': 'C'}}, {{'n': -G, 'b': 'G'}}, {{'n': -T, 'b': 'T'}}], lambda x: x.b <> ref AND x.n < 0))[1] AS top FROM n)
SELECT contig, pos, ref, coalesce(top.b, '.') AS alt, depth, {rq('coalesce(-top.n, 0) * 1.0 / depth')} AS freq FROM o""",
)
def c2_calls(t: Tables):
    reference = t.part.select(F.col("p_partkey").alias("contig"), F.repeat(F.lit("GATTACA"), F.lit(80)).alias("seq"))
    return pileup.alignment_calls(_reads(t), reference, 14).withColumn("freq", r(F.col("freq")))


# Edit distances of whole texts are too slow in SQL for all pairs; tests hold this against them on small fixtures.
@query("m11_identity_clusters")
def m11_identity(t: Tables):
    return homology.identity_clusters(dna(t))


_TEXTS = f"(SELECT doc_id AS id, lang, source, {DNA_SQL} AS seq FROM documents)"


@query(
    "m9_co_exclusion",
    f"""WITH o AS (SELECT DISTINCT l_suppkey AS f, l_partkey AS s FROM lineitem), t AS (SELECT count(DISTINCT s) AS n FROM o), k AS (SELECT f, count(*) AS n FROM o GROUP BY 1),
p AS (SELECT x.f AS a, y.f AS b, x.n AS na, y.n AS nb FROM k x JOIN k y ON x.f < y.f), h AS (SELECT x.f AS a, y.f AS b, count(*) AS shared FROM o x JOIN o y ON x.s = y.s AND x.f < y.f GROUP BY 1, 2),
j AS (SELECT a, b, na, nb, coalesce(shared, 0) AS shared, t.n AS n, na * 1.0 * nb / t.n AS mean FROM p LEFT JOIN h USING (a, b), t),
q AS (SELECT a, b, na, nb, shared, sum(exp(lgamma(na + 1) - lgamma(i + 1) - lgamma(na - i + 1) + lgamma(n - na + 1) - lgamma(nb - i + 1) - lgamma(n - na - nb + i + 1) - lgamma(n + 1) + lgamma(nb + 1) + lgamma(n - nb + 1))) AS p FROM (SELECT *, unnest(range(greatest(0, na + nb - n), shared + 1)) AS i FROM j WHERE shared <= mean) GROUP BY 1, 2, 3, 4, 5)
SELECT a, b, CAST(na AS INTEGER) AS na, CAST(nb AS INTEGER) AS nb, CAST(shared AS INTEGER) AS shared, {rq('p', 8)} AS p FROM q WHERE p <= 0.01""",
)
def m9(t: Tables):
    own = t.lineitem.select(F.col("l_suppkey").alias("feature"), F.col("l_partkey").alias("sample"))
    return association.co_exclusion_test(own, 0.01).withColumn("p", r(F.col("p"), 8))


@query(
    "m13_sample_distance",
    f"""WITH k AS (SELECT sample, seq[i:i + 2] AS w FROM (SELECT coalesce(source, '?') AS sample, seq, unnest(range(1, length(seq) - 1)) AS i FROM {_TEXTS})),
c AS (SELECT sample, w, count(*) AS n FROM (SELECT sample, w FROM k UNION ALL SELECT sample, reverse(translate(w, 'ACGT', 'TGCA')) FROM k) GROUP BY 1, 2),
words AS (SELECT x || y || z AS w, x, y, z FROM (VALUES ('A'), ('C'), ('G'), ('T')) a(x), (VALUES ('A'), ('C'), ('G'), ('T')) b(y), (VALUES ('A'), ('C'), ('G'), ('T')) c(z)),
f AS (SELECT sample, b, sum(n) * 1.0 / sum(sum(n)) OVER (PARTITION BY sample) AS p FROM (SELECT sample, unnest(string_split(w, '')) AS b, n FROM c) GROUP BY 1, 2),
z AS (SELECT s.sample, words.w, coalesce(c.n, 0) - s.n * coalesce(fx.p, 0) * coalesce(fy.p, 0) * coalesce(fz.p, 0) AS v FROM (SELECT sample, sum(n) AS n FROM c GROUP BY 1) s CROSS JOIN words LEFT JOIN c ON c.sample = s.sample AND c.w = words.w LEFT JOIN f fx ON fx.sample = s.sample AND fx.b = x LEFT JOIN f fy ON fy.sample = s.sample AND fy.b = y LEFT JOIN f fz ON fz.sample = s.sample AND fz.b = z),
g AS (SELECT a.sample AS a, b.sample AS b, sum(a.v * b.v / sqrt(a.v * a.v + b.v * b.v)) AS xy, sum(a.v * a.v / sqrt(a.v * a.v + b.v * b.v)) AS xx, sum(b.v * b.v / sqrt(a.v * a.v + b.v * b.v)) AS yy FROM z a JOIN z b ON a.w = b.w AND a.sample < b.sample WHERE a.v * a.v + b.v * b.v > 0 GROUP BY 1, 2)
SELECT a, b, {rq('0.5 * (1 - xy / sqrt(xx * yy))', 6)} AS dist FROM g""",
)
def m13(t: Tables):
    own = t.documents.select("doc_id", F.coalesce("source", F.lit("?")).alias("sample")).join(dna(t), F.col("doc_id") == F.col("id")).select("sample", "seq")
    return association.sample_distances(own, 3).withColumn("dist", r(F.col("dist"), 6))


# The SQL finds the size of the likeliest model by halving instead of Newton's steps.
@query(
    "m16_depth_model",
    f"""WITH RECURSIVE d AS (SELECT l_suppkey AS contig, CAST(l_quantity AS BIGINT) AS depth FROM lineitem), m AS (SELECT contig, count(*) AS n, avg(depth) AS mean, var_pop(depth) AS v FROM d GROUP BY 1),
t AS (SELECT contig, j, count(*) FILTER (WHERE depth > j) AS a FROM d, (SELECT unnest(range(0, (SELECT max(depth) FROM d))) AS j) GROUP BY 1, 2),
b AS (SELECT contig, 0 AS i, ln(1e-6) AS lo, ln(1e9) AS hi FROM m WHERE v > mean UNION ALL
SELECT contig, i + 1, CASE WHEN score > 0 THEN mid ELSE lo END, CASE WHEN score > 0 THEN hi ELSE mid END FROM (SELECT b.contig, b.i, b.lo, b.hi, (b.lo + b.hi) / 2 AS mid, sum(t.a / (exp((b.lo + b.hi) / 2) + t.j)) - any_value(m.n * ln(1 + m.mean / exp((b.lo + b.hi) / 2))) AS score FROM b JOIN t USING (contig) JOIN m USING (contig) WHERE b.i < 80 GROUP BY 1, 2, 3, 4, 5)),
k AS (SELECT m.*, exp((lo + hi) / 2) AS size FROM m LEFT JOIN (SELECT * FROM b WHERE i = 80) USING (contig))
SELECT contig, n, {rq('mean', 6)} AS mean, {rq('size')} AS size, {rq('sum(CASE WHEN size IS NULL THEN depth * ln(mean) - mean - lgamma(depth + 1) ELSE lgamma(depth + size) - lgamma(size) - lgamma(depth + 1) + size * ln(size / (size + mean)) + depth * ln(mean / (size + mean)) END)', 3)} AS loglik FROM d JOIN k USING (contig) GROUP BY contig, n, mean, size""",
)
def m16(t: Tables):
    own = t.lineitem.select(F.col("l_suppkey").alias("contig"), F.col("l_quantity").cast("long").alias("depth"))
    return association.depth_model(own, "contig").select("contig", "n", r(F.col("mean"), 6).alias("mean"), r(F.col("size")).alias("size"), r(F.col("loglik"), 3).alias("loglik"))


@query(
    "a21_kmer_windows",
    f"""WITH w AS (SELECT id, seq, 50 * unnest(range(0, greatest((length(seq) - 100) // 50, 0) + 1)) AS start FROM {_TEXTS}), k AS (SELECT id, start, s[i:i + 1] AS k FROM (SELECT id, start, seq[start + 1:start + 100] AS s, unnest(range(1, least(length(seq) - start, 100))) AS i FROM w)),
n AS (SELECT id, start, kmer, count(*) AS n FROM (SELECT id, start, k AS kmer FROM k UNION ALL SELECT id, start, reverse(translate(k, 'ACGT', 'TGCA')) FROM k) GROUP BY 1, 2, 3)
SELECT id, CAST(start AS BIGINT) AS start, kmer, n, floor(n * 100000.0 / sum(n) OVER (PARTITION BY id, start) + 0.5) / 1000 AS percent FROM n""",
)
def a21_windows(t: Tables):
    return Q.kmer_windows(dna(t), 2, 100, 50)


@query(
    "a24_length_ladder",
    f"""WITH c AS (SELECT lang, length(seq) AS l FROM {_TEXTS} WHERE length(seq) > 0), w AS (SELECT lang, l, sum(l) OVER (PARTITION BY lang ORDER BY l DESC ROWS UNBOUNDED PRECEDING) AS upto, row_number() OVER (PARTITION BY lang ORDER BY l DESC) AS k, sum(l) OVER (PARTITION BY lang) AS total FROM c)
SELECT lang, CAST(x AS INTEGER) AS x, max(l) AS nx, min(k) AS lx FROM w, (SELECT unnest(range(1, 101)) AS x) WHERE upto * 100 >= x * total GROUP BY 1, 2""",
)
def a24_ladder(t: Tables):
    d = dna(t).join(t.documents.select(F.col("doc_id").alias("id"), "lang"), "id").select("lang", F.length("seq").cast("long").alias("l"))
    return matrix.length_ladder(d, ["lang"], "l")


@query(
    "x5_common_substring",
    """WITH p AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b, a.s_name AS x, b.s_name AS y FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey),
s AS (SELECT a, b, y, i, x[i:j] AS t FROM (SELECT *, unnest(range(i, length(x) + 1)) AS j FROM (SELECT *, unnest(range(1, length(x) + 1)) AS i FROM p)))
SELECT a, b, arg_max(t, {'n': length(t), 'i': -i}) AS shared FROM s WHERE contains(y, t) GROUP BY 1, 2""",
)
def x5_substring(t: Tables):
    made = graph.pairs_within(t.supplier, "s_nationkey", "s_suppkey", ["s_name"])
    return made.select("a", "b", S.common_substring(F.col("x_s_name"), F.col("y_s_name")).alias("shared"))


# Greedy order isn't expressed in SQL; tests hold canopies against a plain loop.
@query("m10_canopies_spearman")
def m10_spearman(t: Tables):
    from .sequences import _candidates

    own = correlate.canopies(_candidates(t).select(F.col("gene").alias("feature"), "profile"), method="spearman")
    return own.select("feature", "canopy", F.transform("profile", lambda x: r(x, 6)).alias("profile"))
