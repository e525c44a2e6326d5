"""URL rules and redirect equivalence.

Rules (verdict, host/path) judge a url's host and path; the longest that fits wins.  A short
list is compiled into an expression; a longer one, or a table of rules, is joined by the
suffixes of the host and the lengths of the rules' paths there.  Pages
that stand for the same place form a class: equal urls, redirects (meta refresh) and
canonical links are edges, and connected components over them are the classes.  A block
decision passes to every page of its class that no rule judges, unless a page of the class
is explicitly allowed: an explicit allow comes before a block that is passed on.

Cases: a null url, or one without ://, has an empty host and path and fits no rule; its page is a
place of its own, named by its id, so that its links are followed (without an id, too, they
aren't); null html has no links;
every canonical link and refresh of a page counts, with character references in it read; a link
is absolute if it starts with a scheme, and is else read against the page's first base address
(<base href>, itself read against the url), or without one against the url's host and path; a rule given twice
with both verdicts allows; repeated pages share a class by their url; further columns are ignored.  What has neither a rule nor a blocked class is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _io
from .components import components

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
BASE = r"""(?is)<base\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; else empty."""
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.coalesce(F.translate(after, _UP, _LOW), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)), F.lit(""))


def place_of(url: Column) -> Column:
    """What names a place: host, path and query, without scheme and fragment."""
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)))


def own_place(url: Column, page_id: Column) -> Column:
    """A page's place; without a url the id names it, behind a host that no url has."""
    return F.coalesce(place_of(url), F.concat(F.lit("/"), page_id.cast("string")))


def resolve(to: Column, host: Column, path: Column) -> Column:
    """A link of the page with this host and path as a url; null for a link within the page."""
    own = F.regexp_extract(to, r"(?s)^([^?#]*)", 1)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    whole = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), own))
    parts = F.split(F.regexp_replace(whole, "^/", ""), "/")
    step = lambda kept, s: F.when(s == ".", kept).when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(s)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    kept = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    place = F.when(own == "", path).otherwise(F.concat(F.lit("/"), F.array_join(kept, "/")))
    relative = F.concat(F.lit("http://"), host, place, F.regexp_extract(to, r"(?s)^[^?#]*(.*)", 1))
    return F.when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), to).when(to.startswith("//"), F.concat(F.lit("http:"), to)).when(~to.startswith("#"), relative)


#: The named character references that addresses in html need.
NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def unescape(text: Column) -> Column:
    """text with its numeric character references, and those of NAMED, as characters."""
    for name, char_ in NAMED.items():
        if name != "&amp;":
            text = F.replace(text, F.lit(name), F.lit(char_))
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});)"), F.lit(1)))
    code = lambda r: F.when(r.rlike("^&#[xX]"), F.conv(F.substring(r, F.lit(4), F.length(r) - 4), 16, 10)).otherwise(F.substring(r, F.lit(3), F.length(r) - 3)).cast("long")
    char = lambda r: F.decode(F.unhex(F.lpad(F.hex(code(r)), 8, "0")), "UTF-32")
    real = lambda r: code(r).between(1, 0xD7FF) | code(r).between(0xE000, 0x10FFFF)
    out = F.aggregate(refs, text, lambda done, r: F.when(real(r), F.replace(done, r, char(r))).otherwise(done))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


COMPILED = 500  # rules that are compiled into an expression at most


def with_rule(df: DataFrame, rules: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """df (with host and path) with fit, the longest rule that fits as a struct of rule and verdict, or null.

    rules are (verdict, host/path), as a list or a table.  In a table, a page's host and path are
    met with rules by equality only: of each suffix of the host, and of the path's prefixes of
    the lengths that rules of this suffix have.
    """
    if not isinstance(rules, DataFrame):
        if len(rules) <= COMPILED:
            return df.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
        rules = df.sparkSession.createDataFrame(rules, "verdict string, rule string")
    table = rules.groupBy("rule").agg(F.min("verdict").alias("verdict"))  # allow comes first
    table = table.select("rule", "verdict", F.substring_index("rule", "/", 1).alias("_suffix"), F.concat(F.lit("/"), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 2)")).alias("_start"))
    lengths = table.groupBy("_suffix").agg(F.collect_set(F.length("_start")).alias("_lengths"))
    places = df.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    each = places.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("_suffix"))
    each = each.join(lengths, "_suffix").select("host", "path", "_suffix", F.explode("_lengths").alias("_l")).filter(F.col("_l") <= F.length("path"))
    each = each.withColumn("_start", F.substring("path", F.lit(1), F.col("_l"))).join(table, ["_suffix", "_start"])
    best = each.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule")).alias("fit"))
    return df.join(best, ["host", "path"], "left")


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule of a short list that fits, as a struct of rule and verdict; null where none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    allowed = {r for v, r in rules if v == "allow"}
    rules = [(v, r) for v, r in rules if v == "allow" or r not in allowed]
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block) and passed_on (whether the class decided)."""
    p = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    base = p.select("page_id", own_place(F.col("url"), F.col("page_id")).alias("place"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    base = with_rule(base, rules)

    # Edges between places.  Only pages that hold a link make rows here.
    low = F.lower("html")
    links = p.filter(F.contains(low, F.lit("canonical")) | F.contains(low, F.lit("refresh")))
    target = F.explode(F.concat(*[F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in (CANONICAL, REFRESH)])).alias("to")
    links = _io.cut(links.select(own_place(F.col("url"), F.col("page_id")).alias("src"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.regexp_extract("html", BASE, 1).alias("_base"), target))
    based = links.filter("_base != ''")
    links = links.filter("_base = ''").drop("_base")
    if not based.isEmpty():  # resolved in steps that are cut, so that links are read against plain columns
        based = _io.cut(based.withColumn("_base", unescape(F.col("_base"))))
        based = _io.cut(based.withColumn("_full", resolve(F.col("_base"), F.col("host"), F.col("path"))))
        based = _io.cut(based.select("src", F.when(F.col("_full").isNull(), F.col("host")).otherwise(host_of(F.col("_full"))).alias("host"), F.when(F.col("_full").isNull(), F.col("path")).otherwise(path_of(F.col("_full"))).alias("path"), "to"))
        links = links.unionByName(based)
    links = links.withColumn("to", unescape(F.col("to"))).filter("to != ''")
    full = resolve(F.col("to"), F.col("host"), F.col("path"))
    edges = links.select("src", place_of(full).alias("dst")).filter("substr(dst, 1, 1) != '/'")  # without a host it names no place
    edges = edges.filter("src is not null and dst is not null and src != dst").distinct()
    classes = components(edges, "src", "dst")  # place, root: only places with an edge

    # A class is named by its root; a place without an edge is its own class.
    if classes is None:
        # Equal places have equal hosts and paths, and so one rule: nothing is passed on.
        return base.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit("allow")).alias("verdict"), F.lit(False).alias("passed_on"))
    judged = base.join(classes.withColumnRenamed("node", "place"), "place", "left")
    per_class = judged.filter("root is not null and fit is not null").groupBy("root").agg(F.bool_or(F.col("fit.verdict") == "allow").alias("allowed"), F.bool_or(F.col("fit.verdict") == "block").alias("blocked"))
    # Places that only links name are judged by the rules as well.
    named = with_rule(classes.select("root", F.regexp_extract("node", r"(?s)^([^/?#]*)", 1).alias("host"), F.regexp_extract("node", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path")), rules).filter("fit is not null")
    named = named.groupBy("root").agg(F.bool_or(F.col("fit.verdict") == "allow").alias("allowed"), F.bool_or(F.col("fit.verdict") == "block").alias("blocked"))
    decided = per_class.unionByName(named).groupBy("root").agg((F.bool_or("blocked") & ~F.bool_or("allowed")).alias("alias_blocked"))
    out = judged.join(decided, "root", "left")
    passed = F.coalesce(F.col("fit").isNull() & F.col("alias_blocked"), F.lit(False))
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.when(passed, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), passed.alias("passed_on"))
