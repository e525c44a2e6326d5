"""Connected components, trees, neighbours and outgroups."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import cut


def merge_clusters(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): transitive union of linked ids; root is the smallest. Neighbour minima with pointer jumping.

    Each round is cut with checkpoint(), in the folder that the session names.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    e = cut(e.union(e.select(F.col("v"), F.col("u"))).distinct())
    state = cut(e.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root")).withColumnRenamed("u", "node"))
    for _ in range(max_rounds):
        near = e.join(state.select(F.col("node").alias("v"), "root"), "v").groupBy("u").agg(F.min("root").alias("near"))
        step = state.join(near.withColumnRenamed("u", "node"), "node").withColumn("root2", F.least("root", "near"))
        jump = state.select(F.col("node").alias("root2"), F.col("root").alias("up"))
        new = cut(step.join(jump, "root2").select("node", F.least("root2", "up").alias("root"), F.col("root").alias("old")))
        changed = not new.filter("root != old").isEmpty()
        state = new.select("node", "root")
        if not changed:
            return state
    raise RuntimeError("merge_clusters: no fixed point")


_TREE = "node int, parent int, name string, len double"
_NEWICK = re.compile(r"\s*([(),;]|:\s*[-+0-9.eE]+|'[^']*'|[^\s(),:;]+)")


def parse_newick(text: str) -> Iterator[tuple[int, int | None, str | None, float]]:
    """Nodes (number, parent, name, length to it) of a Newick tree; the root is 0."""
    parent: dict[int, int | None] = {0: None}
    name: dict[int, str] = {}
    length: dict[int, float] = {}
    at, last = 0, 0
    for token in _NEWICK.findall(text):
        if token == "(":
            last = len(parent)
            parent[last] = at
            at = last
        elif token == ",":
            last = len(parent)
            parent[last] = parent[at]
            at = last
        elif token == ")":
            at = parent[at]
        elif token == ";":
            break
        elif token[0] == ":":
            length[at] = float(token[1:])
        else:
            name[at] = token.strip("'")
    for node, up in parent.items():
        yield node, up, name.get(node), length.get(node, 0.0)


@F.udtf(returnType=_TREE)
class NewickNodes:
    """A table function of one Newick text: its nodes, for FROM newick_nodes(text) in SQL after register_newick."""

    def eval(self, text: str):
        yield from parse_newick(text or "")


def register_newick(spark: SparkSession) -> None:
    spark.udtf.register("newick_nodes", NewickNodes)


def tree_nodes(trees: DataFrame, key: str, text: str) -> DataFrame:
    """The nodes of each tree (one Newick text a row)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = [(k, *n) for k, t in zip(p[key], p[text], strict=True) if t for n in parse_newick(t)]
            out = pd.DataFrame(rows, columns=[key, "node", "parent", "name", "len"])
            out["parent"] = out["parent"].astype("Int32")
            yield out

    return trees.select(key, text).mapInPandas(run, f"{key} {dict(trees.dtypes)[key]}, {_TREE}")


_TOUR = "name string, rank int, dist double, turn double"


def leaf_tour(nodes: DataFrame, key: str) -> DataFrame:
    """Leaves of each tree in the order of an Euler tour: (key, name, rank, dist, turn).

    dist is the distance from the root, and turn that of the node at which the tour turns
    towards the next leaf, the deepest node above both (null at the last leaf).  A tree that
    came as one text is one group; the tour is a walk without recursion.
    """
    kind = dict(nodes.dtypes)[key]

    def run(g: pd.DataFrame) -> pd.DataFrame:
        children: dict[int, list[int]] = {}
        length, name, roots = {}, {}, []
        for node, parent, called, long in zip(g["node"].tolist(), g["parent"].tolist(), g["name"].tolist(), g["len"].tolist(), strict=True):
            length[node], name[node] = long or 0.0, called
            if parent is None or parent != parent:
                roots.append(node)
            else:
                children.setdefault(int(parent), []).append(node)
        out: list[list] = []
        todo = [(r, 0.0, None) for r in sorted(roots, reverse=True)]
        while todo:
            node, dist, turned = todo.pop()
            if turned is not None and out and out[-1][3] is None:
                out[-1][3] = turned
            below = sorted(children.get(node, ()), reverse=True)
            if not below:
                if name[node] is not None:
                    out.append([name[node], len(out), dist, None])
                continue
            todo += [(c, dist + length[c], dist) for c in below]
        frame = pd.DataFrame(out, columns=["name", "rank", "dist", "turn"]).astype({"dist": float, "turn": float})
        frame.insert(0, key, g[key].iloc[0])
        return frame

    return nodes.select(key, "node", "parent", "name", F.coalesce("len", F.lit(0.0)).alias("len")).groupBy(key).applyInPandas(run, f"`{key}` {kind}, {_TOUR}")


def patristic(nodes: DataFrame, key: str) -> DataFrame:
    """Distances along the tree between its leaves a < b.

    The deepest common node of two leaves is the least of the tour's turns between them.  A
    sparse table holds the least turn of 1, 2, 4, ... turns from each leaf on, by doubling, and
    two of its entries cover what stands between any two leaves; so depth costs nothing.  Pairs
    are made by ranks in blocks of both leaves, spread over tasks.
    """
    tour = cut(leaf_tour(nodes, key))
    most = tour.agg(F.max("rank")).first()[0]
    level = tour.filter("turn is not null").select(key, F.col("rank").alias("at"), F.lit(0).alias("k"), F.col("turn").alias("least"))
    table, k = [level], 0
    while most is not None and 2 << k <= most:
        other = table[-1].select(key, (F.col("at") - (1 << k)).alias("at"), F.col("least").alias("_next"))
        table.append(cut(table[-1].join(other, [key, "at"]).select(key, "at", F.lit(k + 1).alias("k"), F.least("least", "_next").alias("least"))))
        k += 1
    known = table[0]
    for t in table[1:]:
        known = known.unionByName(t)
    a, b = tour.select(key, F.col("name").alias("_a"), F.col("rank").alias("i"), F.col("dist").alias("da")), tour.select(key, F.col("name").alias("_b"), F.col("rank").alias("j"), F.col("dist").alias("db"))
    pairs = a.join(b, key).filter("i < j and _a != _b").withColumn("k", F.length(F.bin(F.col("j") - F.col("i"))) - 1).withColumn("_from", F.expr("j - shiftleft(1, k)"))
    one, two = known.select(key, F.col("at").alias("i"), "k", F.col("least").alias("_l1")), known.select(key, F.col("at").alias("_from"), "k", F.col("least").alias("_l2"))
    met = pairs.join(one, [key, "i", "k"]).join(two, [key, "_from", "k"])
    return met.select(key, F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), (F.col("da") + F.col("db") - 2 * F.least("_l1", "_l2")).alias("dist"))


def pairs_within(rows: DataFrame, key: str, ident: str, values: list[str], block: int = 512, task_pairs: int = 1 << 21) -> DataFrame:
    """(a, b, x_<value>, y_<value> ...): every two rows a < b of one key, each pair once.

    A key's rows are dealt into blocks, and every two blocks meet once.  The number of tasks
    follows the number of pairs, which a count tells first, so that none makes more than
    about task_pairs of them; the rows alone would fit in one task.
    """
    own = rows.filter(F.col(key).isNotNull() & F.col(ident).isNotNull()).select(F.col(key).alias("_key"), F.col(ident).alias("_id"), *values)
    size = own.groupBy("_key").agg(F.count("*").alias("_n"))
    pairs = size.agg(F.sum(F.col("_n").cast("double") * F.col("_n") / 2)).first()[0] or 0
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(pairs // task_pairs) + 1)
    dealt = own.join(size.select("_key", F.ceil(F.col("_n") / block).alias("_blocks")), "_key").withColumn("_i", F.pmod(F.xxhash64("_id"), "_blocks"))
    dealt = dealt.select(*own.columns, "_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_j"))
    dealt = dealt.select("_key", "_id", *values, "_i", F.least("_i", "_j").alias("_p"), F.greatest("_i", "_j").alias("_q"))
    meet = ["_key", "_p", "_q"]
    side = lambda at, name: dealt.filter(F.col("_i") == F.col(at)).select(*meet, F.col("_id").alias(name), *[F.col(v).alias(f"{name}{v}") for v in values]).repartition(parts, *meet)
    met = side("_p", "_l").join(side("_q", "_r"), meet).filter((F.col("_p") < F.col("_q")) | (F.col("_l") < F.col("_r")))
    met = met.filter("_l != _r").withColumn("_up", F.col("_l") < F.col("_r"))
    of = lambda one, two, v: F.when(F.col("_up"), F.col(f"{one}{v}")).otherwise(F.col(f"{two}{v}"))
    return met.select(of("_l", "_r", "").alias("a"), of("_r", "_l", "").alias("b"), *[of("_l", "_r", v).alias(f"x_{v}") for v in values], *[of("_r", "_l", v).alias(f"y_{v}") for v in values])


def both_ways(pairs: DataFrame, *values: str) -> DataFrame:
    """Each pair (a, b) in both directions, made in one pass."""
    way = lambda one, two: F.struct(F.col(one).alias("a"), F.col(two).alias("b"))
    return pairs.select(F.explode(F.array(way("a", "b"), way("b", "a"))).alias("_w"), *values).select("_w.a", "_w.b", *values)


def nearest(distances: DataFrame, n: int = 10, least: float = 0.01) -> DataFrame:
    """Per a the n nearest b at a distance of at least least (both directions of each pair); each task keeps its n before the shuffle."""
    w = Window.partitionBy("a").orderBy("dist", "b")
    return both_ways(distances.filter(F.col("dist") >= least), "dist").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def category_words(cogs: DataFrame, most: int = 1024) -> tuple[DataFrame, int]:
    """(id, w0, w1, ...) of cogs (id, cog), and how many words: a bit for each different category; beyond most categories (id, set) with none."""
    own = cogs.filter("id is not null and cog is not null")
    names = cut(own.select("cog").distinct())
    count = names.count()
    if count > most:
        return own.groupBy("id").agg(F.collect_set("cog").alias("set")), 0
    at = {r.cog: i for i, r in enumerate(names.collect())}  # at most most
    number = F.element_at(F.create_map(*[F.lit(x) for pair in at.items() for x in pair]), F.col("cog")) if at else F.lit(0)
    bits = own.select("id", number.alias("_n"))
    word = lambda i: F.coalesce(F.bit_or(F.when(F.floor(F.col("_n") / 64) == i, F.expr("shiftleft(1L, cast(_n % 64 as int))"))), F.lit(0).cast("long"))
    words = max(1, -(-count // 64))
    return bits.groupBy("id").agg(*[word(i).alias(f"w{i}") for i in range(words)]), words


def outgroup_within(rows: DataFrame, key: str, ident: str, distance: Callable[[DataFrame], Column], values: list[str], cogs: DataFrame, least: int = 10) -> DataFrame:
    """outgroup() among all rows of one key: shared categories are counted where a pair is made, so no pair meets its categories as rows.

    distance gives a pair's distance from its columns x_<value> and y_<value>.
    """
    sets, words = category_words(cogs)
    names = [f"w{i}" for i in range(words)] or ["set"]
    own = rows.join(sets.withColumnRenamed("id", ident), ident)
    made = pairs_within(own, key, ident, [*values, *names])
    shared = sum((F.bit_count(F.col(f"x_{w}").bitwiseAND(F.col(f"y_{w}"))) for w in names), F.lit(0)) if words else F.size(F.array_intersect("x_set", "y_set"))
    found = made.select("a", "b", distance(made).alias("dist"), shared.cast("long").alias("shared")).filter(F.col("shared") >= least)
    return _first(both_ways(found, "dist", "shared"))


def _first(found: DataFrame) -> DataFrame:
    w = Window.partitionBy("a").orderBy("dist", "b")
    return found.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def outgroup(neighbours: DataFrame, cogs: DataFrame, least: int = 10) -> DataFrame:
    """Per a the nearest b that shares at least least categories (cogs: id, cog); shared ones are counted per candidate."""
    x, y = cogs.select(F.col("id").alias("a"), "cog").distinct(), cogs.select(F.col("id").alias("b"), "cog").distinct()
    n = neighbours.join(x, "a").join(y, ["b", "cog"]).groupBy("a", "b", "dist").agg(F.count("*").alias("shared")).filter(F.col("shared") >= least)
    return _first(n)


def average_distance(distances: DataFrame) -> DataFrame:
    """Mean distance of each taxon to the others."""
    both = distances.select(F.col("a").alias("taxon"), "dist").unionByName(distances.select(F.col("b").alias("taxon"), "dist"))
    return both.groupBy("taxon").agg(F.avg("dist").alias("mean_dist"), F.count("*").alias("n"))
