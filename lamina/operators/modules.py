"""Modules given by definitions: expression trees over features, scored per sample.

A definition reads like K1 (K2,K3 K4) K5+K6-K7: spaces separate steps that are all needed,
commas separate alternatives, + joins the parts of a complex and - adds an optional part to
it (what has optional parts alone is optional); parentheses group, and a comma binds weakest, + and - strongest.  Definitions become
rows of a table of nodes.  The scores of all modules in all samples are worked out together,
a level of the trees at a time from the deepest up, by joins and aggregations over what is
present only: an absent feature has no row and scores 0.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import cut

LEAF, COMPLEX, STEPS, CHOICE = "leaf", "complex", "steps", "choice"
_TOKEN = re.compile(r"\s+|[(),+-]|[^\s(),+-]+")

Node = tuple  # (kind, feature or children); a child is (required, node)


class DefinitionError(ValueError):
    pass


def _needs(node: Node) -> bool:
    """Whether a node has a part that isn't optional."""
    return node[0] == LEAF or any(need for need, _ in node[1])


def _single(kind: str, children: list[tuple[bool, Node]]) -> Node:
    """A node with one child is that child, unless the child is needed where it stands alone but not here."""
    return children[0][1] if len(children) == 1 and (children[0][0] or not _needs(children[0][1])) else (kind, children)


def parse_definition(text: str) -> Node | None:
    """The expression tree of a definition; None if it holds no feature."""
    # A frame is a list of alternatives, each a list of steps, each a list of (required, node).
    frames: list[list[list[list[tuple[bool, Node]]]]] = [[[[]]]]
    signs: list[bool] = []
    required, joined = True, False

    def add(node: Node | None) -> None:
        nonlocal required, joined
        steps = frames[-1][-1]
        if node is not None:
            if steps[-1] and not joined:
                steps.append([])
            steps[-1].append((required and _needs(node), node))
        required, joined = True, False

    def closed() -> Node | None:
        choices = []
        for steps in frames.pop():
            own = [(any(need for need, _ in parts), _single(COMPLEX, parts)) for parts in steps if parts]
            if own:
                choices.append(_single(STEPS, own))
        return choices[0] if len(choices) == 1 else (CHOICE, [(_needs(n), n) for n in choices]) if choices else None

    for token in _TOKEN.findall(text):
        if token.isspace():
            if not joined:
                required = True
        elif token == "(":
            signs.append((required, joined))
            frames.append([[[]]])
            required, joined = True, False
        elif token == ")":
            if len(frames) == 1:
                raise DefinitionError(f"a bracket closes that none opened: {text!r}")
            node = closed()
            required, joined = signs.pop()
            add(node)
        elif token == ",":
            frames[-1].append([[]])
            required, joined = True, False
        elif token in "+-":
            required, joined = token == "+", True
        else:
            add((LEAF, token))
    if len(frames) > 1:
        raise DefinitionError(f"a bracket isn't closed: {text!r}")
    return closed()


def canonical(node: Node) -> str:
    """Equal for trees that say the same up to the order of parts."""
    return _ordered(node)[0]


def _ordered(node: Node) -> tuple[str, Node]:
    """(canonical form, the tree with its parts in the form's order)."""
    kind, rest = node
    if kind == LEAF:
        return rest, node
    parts = sorted(((("" if need else "?") + form, (need, own)) for need, (form, own) in ((need, _ordered(n)) for need, n in rest)), key=lambda x: x[0])
    return f"{kind}[" + " ".join(form for form, _ in parts) + "]", (kind, [part for _, part in parts])


def _rows(node: Node) -> Iterator[tuple[int, int, int, str, str | None, bool, int]]:
    """(node, parent, level, kind, feature, required, needed): needed is the number of required children."""
    todo, number = [(node, -1, 0, True)], 0
    while todo:
        (kind, rest), parent, level, required = todo.pop()
        own, number = number, number + 1
        leaf = kind == LEAF
        yield own, parent, level, kind, rest if leaf else None, required, 0 if leaf else sum(need for need, _ in rest)
        if not leaf:
            todo += [(child, own, level + 1, need) for need, child in rest]


_NODES = "variant long, form string, node int, parent int, level int, kind string, feature string, required boolean, needed int"


def definition_nodes(definitions: DataFrame) -> DataFrame:
    """Nodes of the definitions (module, definition); variant tells definitions apart.  A definition without features has none."""
    name = dict(definitions.dtypes)["module"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for module, text in zip(p["module"], p["definition"], strict=True):
                tree = parse_definition(text) if text else None
                if tree is not None:
                    form, tree = _ordered(tree)  # so that equal forms number their nodes alike
                    # A form is as long as its definition: each of its nodes holds the form's digest instead.
                    rows, digest = _rows(tree), hashlib.sha256(form.encode()).hexdigest()
                    while some := list(islice(rows, 1 << 16)):
                        yield pd.DataFrame([(module, digest, *row) for row in some], columns=["module", "form", "node", "parent", "level", "kind", "feature", "required", "needed"])

    nodes = definitions.select("module", "definition").filter("module is not null").mapInPandas(run, f"module {name}, " + _NODES.removeprefix("variant long, "))
    return nodes.withColumn("variant", F.xxhash64("module", "form"))


def module_completeness(definitions: DataFrame, abund: DataFrame, module_least: float = 0.5, complex_least: float = 0.5, redundancy: int | None = 5, collapse: bool = True) -> DataFrame:
    """(module, sample, complete, value) of modules that are complete by module_least or more in a sample.

    abund has (feature, sample, value); values above 0 are present.  A complex counts if the
    share of its required parts that are present reaches complex_least; of alternatives the
    most complete counts; steps count as the mean over required ones.  An optional part
    adds nothing to completeness.  value is the median of the present parts of complexes and
    steps, and the sum over present alternatives.

    A feature in more than redundancy modules proves none of them: a module that has a rarer
    feature needs one present.  With collapse, modules with the same definition are one, named
    by the least; a module with several definitions takes its best in each sample.
    """
    nodes = definition_nodes(definitions).withColumn("feature", F.col("feature").cast("string")).distinct()
    if collapse:
        first = nodes.groupBy(F.col("form").alias("_f")).agg(F.min("module").alias("_m"))
        nodes = nodes.join(first, F.col("form") == F.col("_f")).withColumn("module", F.col("_m")).withColumn("variant", F.xxhash64("_m", "form")).drop("_f", "_m").distinct()
    nodes = cut(nodes.drop("form"))
    leaves = nodes.filter(F.col("kind") == LEAF)
    used = leaves.groupBy("feature").agg(F.countDistinct("module").alias("_uses"))
    rare = F.lit(True) if redundancy is None else F.col("_uses") <= redundancy
    leaves = leaves.join(used, "feature").withColumn("rare", rare).drop("_uses")
    here = abund.filter("value > 0").select(F.col("feature").cast("string").alias("feature"), "sample", F.col("value").cast("double").alias("value"))
    here = here.groupBy("feature", "sample").agg(F.sum("value").alias("value"))
    key = ["module", "variant", "sample"]
    present = cut(leaves.join(here, "feature").select(*key, "node", "parent", "level", "required", F.lit(1.0).alias("score"), "value", "rare"))
    deepest = nodes.agg(F.max("level")).first()[0] or 0
    known = present.filter(F.col("level") == deepest)
    for level in range(deepest, 0, -1):
        up = nodes.select("module", "variant", F.col("node").alias("parent"), F.col("parent").alias("_up"), F.col("level").alias("_level"), F.col("kind").alias("_kind"), F.col("required").alias("_required"), "needed")
        own = known.join(up, ["module", "variant", "parent"])
        got = own.groupBy(*key, "parent", "_up", "_level", "_kind", "_required", "needed").agg(
            F.sum(F.when(F.col("required"), F.col("score")).otherwise(0.0)).alias("_sum"), F.max("score").alias("_best"), F.count_if("required").alias("_have"),
            F.percentile(F.when((F.col("score") > 0), F.col("value")), F.lit(0.5)).alias("_median"), F.sum(F.when(F.col("score") > 0, F.col("value"))).alias("_total"), F.bool_or("rare").alias("rare"),
        )
        share = F.when(F.col("needed") > 0, F.col("_sum") / F.col("needed")).otherwise(F.lit(1.0))
        score = F.when(F.col("_kind") == CHOICE, F.col("_best")).when(F.col("_kind") == COMPLEX, (share >= complex_least).cast("double")).otherwise(share)
        value = F.when(F.col("_kind") == CHOICE, F.col("_total")).otherwise(F.col("_median"))
        new = got.select(*key, F.col("parent").alias("node"), F.col("_up").alias("parent"), F.col("_level").alias("level"), F.col("_required").alias("required"), score.alias("score"), value.alias("value"), "rare")
        known = present.filter(F.col("level") == level - 1).unionByName(new)
    has_rare = leaves.groupBy("module", "variant").agg(F.bool_or("rare").alias("_has"))
    out = known.join(has_rare, ["module", "variant"]).filter((F.col("score") > 0) & (F.col("rare") | ~F.col("_has")))
    best = out.groupBy("module", "sample").agg(F.max(F.struct(F.col("score").alias("complete"), "value")).alias("_b"))
    return best.select("module", "sample", "_b.complete", "_b.value").filter(F.col("complete") >= module_least)
