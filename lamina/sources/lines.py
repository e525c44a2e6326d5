"""Text formats as DataFrames.  Each parser takes a frame of lines (column value), so that any Spark source can feed it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import UNKNOWN


def read_lines(spark: SparkSession, path: str | list[str], numbered: bool = False) -> DataFrame:
    """Lines of plain or gzip text (by suffix) with their file, and with numbered their line_no from 0.

    A line's number is its place within its byte range of the file plus the lines of the ranges
    before it, which one count for each range gives: files stay split, and no line moves.
    """
    if not numbered:
        return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_i"))
    ranges = raw.groupBy("file", "_block").agg(F.min("_i").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block")) - F.col("_n")
    ranges = ranges.select(F.col("file").alias("_file"), F.col("_block").alias("_at"), (F.col("_first") - before).alias("_shift"))
    return raw.join(ranges, (F.col("file") == F.col("_file")) & (F.col("_block") == F.col("_at"))).select("value", "file", (F.col("_i") - F.col("_shift")).alias("line_no"))


def read_records(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """Records that end where sep starts, e.g. a newline and '>'; large files stay splittable."""
    return spark.read.text(path, lineSep=sep).select("value", F.col("_metadata.file_path").alias("file"))


def find_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Files (path, length) whose path matches; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").filter(F.col("path").rlike(pattern))


def fasta(records: DataFrame, cut: str | None = r"\s") -> DataFrame:
    """(id, descr, seq) from records split at newline and '>'; the id ends where cut matches, or is the whole header."""
    v = F.regexp_replace("value", "^>", "")
    head, body = F.substring_index(v, "\n", 1), F.when(F.instr(v, "\n") > 0, F.substring(v, F.instr(v, "\n") + 1, F.length(v))).otherwise(F.lit(""))
    head = F.regexp_replace(head, "\r$", "")
    name = F.regexp_extract(head, f"^(.*?)(?:{cut}.*)?$", 1) if cut else head
    descr = F.substring(head, F.length(name) + 2, F.length(head))
    return records.filter(F.trim(v) != "").select(name.alias("id"), descr.alias("descr"), F.regexp_replace(body, r"\s", "").alias("seq"))


def fasta_headers(records: DataFrame, full: bool = False) -> DataFrame:
    return fasta(records, None if full else r"\s").select("id")


def fastq(records: DataFrame) -> DataFrame:
    """(id, mate, seq, qual) of four-line records in one value each."""
    p = F.split("value", "\r?\n")
    name = F.regexp_extract(F.get(p, F.lit(0)), r"^@?(\S+)", 1)
    return records.filter(F.size(p) >= 4).select(F.regexp_replace(name, "/[12]$", "").alias("id"), F.when(name.rlike("/[12]$"), F.substring(name, -1, 1)).cast("int").alias("mate"), F.get(p, F.lit(1)).alias("seq"), F.get(p, F.lit(3)).alias("qual"))


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(id, mate, seq, qual, file) of FASTQ files: lines are grouped in fours by their number, as a quality line can start with any character."""
    lines = read_lines(spark, path, numbered=True)
    part = lambda k: F.max(F.when(F.col("line_no") % 4 == k, F.regexp_replace("value", "\r$", "")))
    four = lines.groupBy("file", F.expr("line_no div 4").alias("_no")).agg(*[part(k).alias(f"_{k}") for k in range(4)]).filter("_0 is not null and _0 != ''")
    joined = four.select("file", F.concat_ws("\n", *[F.coalesce(f"_{k}", F.lit("")) for k in range(4)]).alias("value"))
    p = F.split("value", "\n")
    name = F.regexp_extract(F.get(p, F.lit(0)), r"^@?(\S+)", 1)
    broken = ~F.get(p, F.lit(0)).startswith("@") | (F.length(F.get(p, F.lit(1))) != F.length(F.get(p, F.lit(3))))
    checked = F.when(broken, F.raise_error(F.concat(F.lit("not a record of four lines: "), F.get(p, F.lit(0))))).otherwise(F.get(p, F.lit(1)))
    return joined.select(F.regexp_replace(name, "/[12]$", "").alias("id"), F.when(name.rlike("/[12]$"), F.substring(name, -1, 1)).cast("int").alias("mate"), checked.alias("seq"), F.get(p, F.lit(3)).alias("qual"), "file")


def header_limit(name: Column, most: int = 255) -> Column:
    return F.when(F.length(name) >= most, F.substring(name, 1, most - 1)).otherwise(name)


def columns(lines: DataFrame, sep: str = "\t", comment: str | None = "#", skip: int = 0) -> DataFrame:
    """The fields of each line as an array f, without comments; skip needs a line_no from 0."""
    out = lines.filter(F.col("value") != "")
    if comment:
        out = out.filter(~F.col("value").startswith(comment))
    if skip:
        out = out.filter(F.col("line_no") >= skip)
    return out.withColumn("f", F.split("value", sep))


def field(i: int, kind: str = "string") -> Column:
    return F.get("f", F.lit(i)).cast(kind)


def key_value(lines: DataFrame, value: int = 1, order: str | None = None, sep: str = "\t") -> DataFrame:
    """First field to field value; the last line of a key wins if there is an order, else any single one."""
    c = columns(lines, sep).select(field(0).alias("key"), field(value).alias("value"), *([order] if order else []))
    return c.groupBy("key").agg(F.max_by("value", order).alias("value")) if order else c.groupBy("key").agg(F.max("value").alias("value"))


def key_row(lines: DataFrame, last: bool = False, sep: str = "\t") -> DataFrame:
    """Key (first or last field), the other fields, and their number."""
    c = columns(lines, sep)
    n = F.size("f")
    key = F.get("f", n - 1) if last else F.get("f", F.lit(0))
    rest = F.slice(F.col("f"), F.lit(1), n - 1) if last else F.slice(F.col("f"), F.lit(2), n - 1)
    return c.select(key.alias("key"), rest.alias("fields"), F.size(rest).alias("width"), F.array_join(rest, sep).alias("joined"))


def gff(lines: DataFrame) -> DataFrame:
    """Genes with their attributes, gene number (second part of the id) and key contig_number."""
    a = F.map_from_entries(F.transform(F.filter(F.split(field(8), ";"), lambda x: F.instr(x, "=") > 0), lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.substring(x, F.instr(x, "=") + 1, F.length(x)).alias("v"))))
    c = columns(lines).filter(F.size("f") >= 9).select(field(0).alias("contig"), field(2).alias("type"), field(3, "long").alias("start"), field(4, "long").alias("end"), field(6).alias("strand"), a.alias("attrs"))
    no = F.regexp_extract(F.element_at("attrs", "ID"), r"_(\d+)$", 1).cast("int")
    return c.withColumn("gene_no", no).withColumn("partial", F.element_at("attrs", "partial")).withColumn("gene", F.concat_ws("_", "contig", "gene_no"))


def hit_table(lines: DataFrame) -> DataFrame:
    """Twelve-column hits; any other number of fields is an error when the row is read."""
    names = [("q", "string"), ("s", "string"), ("pident", "double"), ("alen", "int"), ("mism", "int"), ("gapo", "int"), ("qs", "int"), ("qe", "int"), ("ss", "int"), ("se", "int"), ("evalue", "double"), ("bits", "double")]
    c = columns(lines).withColumn("f", F.when(F.size("f") == 12, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("not twelve fields: "), F.col("value")))))
    return c.select(*[field(i, t).alias(n) for i, (n, t) in enumerate(names)])


def sam(lines: DataFrame) -> DataFrame:
    """Alignments with tags as a map."""
    tags = F.map_from_entries(F.transform(F.slice("f", F.lit(12), F.greatest(F.size("f") - 11, F.lit(0))), lambda x: F.struct(F.substring(x, 1, 2).alias("k"), F.regexp_replace(x, "^[^:]*:[^:]*:", "").alias("v"))))
    names = [("qname", 0, "string"), ("flag", 1, "int"), ("rname", 2, "string"), ("pos", 3, "long"), ("mapq", 4, "int"), ("cigar", 5, "string"), ("seq", 9, "string")]
    return columns(lines, comment="@").select(*[field(i, t).alias(n) for n, i, t in names], tags.alias("tags"))


def sam_headers(lines: DataFrame, prefix: str) -> DataFrame:
    """Header lines, @SQ ones only of contigs that start with prefix."""
    h = lines.filter(F.col("value").startswith("@"))
    return h.filter(~F.col("value").startswith("@SQ") | F.regexp_extract("value", r"\tSN:(\S+)", 1).startswith(prefix))


def vcf(lines: DataFrame) -> DataFrame:
    """Sites with depth and allele counts from the sample's sub-fields (last one: depth; AD: counts)."""
    c = columns(lines).filter(F.size("f") >= 10)
    keys, vals = F.split(field(8), ":"), F.split(field(9), ":")
    m = F.map_from_arrays(keys, F.slice(F.concat(vals, F.array_repeat(F.lit(""), F.size(keys))), F.lit(1), F.size(keys)))
    counts = F.transform(F.split(F.coalesce(F.try_element_at(m, F.lit("AD")), F.lit("")), ","), lambda x: F.when(x.rlike("^[0-9]+$"), x).cast("long"))
    depth = F.regexp_extract(field(7), r"(?:^|;)DP=(\d+)", 1)
    return c.select(field(0).alias("chrom"), field(1, "long").alias("pos"), field(3).alias("ref"), F.split(field(4), ",").alias("alt"), F.when(field(5) != ".", field(5)).cast("double").alias("qual"), field(7).rlike("(^|;)INDEL").alias("is_indel"), F.when(depth != "", depth).cast("long").alias("depth"), counts.alias("alt_counts"))


def depth_track(lines: DataFrame) -> DataFrame:
    return columns(lines, r"\s+").select(field(0).alias("chr"), field(1, "long").alias("pos"), field(2, "int").alias("depth"))


def clusters(lines: DataFrame) -> DataFrame:
    """(cluster_id, member) of lines id, tab, >g1,>g2."""
    return columns(lines).select(field(0, "long").alias("cluster_id"), F.explode(F.split(field(1), ",")).alias("m")).select("cluster_id", F.regexp_replace("m", "^>", "").alias("member")).filter("member != ''")


def cluster_blocks(lines: DataFrame) -> DataFrame:
    """Members of '>Cluster n' blocks: (cluster_id, member, len, is_seed, identity); lines need line_no and file."""
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    no = F.regexp_extract("value", r"^>Cluster (\d+)", 1)
    return _cluster_members(lines.withColumn("cluster_id", F.last(F.when(no != "", no), True).over(w).cast("long")).filter(~F.col("value").startswith(">")))


def read_cluster_blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same from files: each block is a record of the text source, so that a large file is read in ranges and needs no order."""
    records = read_records(spark, path, "\n>Cluster ")
    lines = F.split(F.regexp_replace("value", "^>Cluster ", ""), "\r?\n")
    c = records.select(F.trim(F.get(lines, F.lit(0))).cast("long").alias("cluster_id"), F.explode(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))).alias("value"))
    return _cluster_members(c.filter("value != ''"))


def _cluster_members(c: DataFrame) -> DataFrame:
    ident = F.regexp_extract("value", r"at (?:[+-]/)?([0-9.]+)%", 1)
    return c.select("cluster_id", F.regexp_extract("value", r">(.+?)\.\.\.", 1).alias("member"), F.regexp_extract("value", r"\t(\d+)(?:nt|aa),", 1).cast("int").alias("len"), F.col("value").endswith("*").alias("is_seed"), F.when(ident != "", ident).cast("double").alias("identity"))


def bin_assignments(lines: DataFrame) -> DataFrame:
    """(contig, bin) without bin 0."""
    return columns(lines).select(field(0).alias("contig"), field(1).alias("bin")).filter("bin != '0'")


#: Column positions (compl, conta, hetero or -1) of the two quality layouts by file suffix; fixed values.
QUALITY_COLUMNS = {".cm": (11, 12, 13), ".cm2": (1, 2, -1)}


def bin_quality(lines: DataFrame, layout: str) -> DataFrame:
    a, b, c = QUALITY_COLUMNS[layout]
    rows = columns(lines).withColumn("f", F.transform("f", lambda x: F.trim(x))).filter(F.get("f", F.lit(a)).rlike(r"^[0-9.]+$"))
    return rows.select(field(0).alias("bin"), field(a, "double").alias("compl"), field(b, "double").alias("conta"), (field(c, "double") if c >= 0 else F.lit(None).cast("double")).alias("hetero"))


def members(df: DataFrame, key: str, member: str, order: str | None = None) -> DataFrame:
    """Members as sorted lists per key, or, with an order, the last key of each member."""
    if order:
        return df.groupBy(member).agg(F.max_by(key, order).alias(key))
    return df.groupBy(key).agg(F.array_sort(F.collect_set(member)).alias("members"))


def lineages(lines: DataFrame, depth: int) -> DataFrame:
    """(id, lineage) of tables id, rank 1, ..., padded with '?'."""
    from ..functions.taxa import pad_lineage

    return columns(lines).select(field(0).alias("id"), pad_lineage(F.slice("f", 2, depth), depth).alias("lineage"))


def ranked_lineages(lines: DataFrame, depth: int) -> DataFrame:
    """(id, lineage) of lines id, tab, k__A; p__B; ...; a line without a tab is an error when it is read."""
    from ..functions.taxa import ranked_taxonomy

    c = columns(lines, comment=None).withColumn("f", F.when(F.size("f") >= 2, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("no taxonomy: "), F.col("value")))))
    return c.select(field(0).alias("id"), ranked_taxonomy(field(1), depth).alias("lineage"))


def header_lineages(headers: DataFrame, depth: int) -> DataFrame:
    """(id, lineage) of sequence headers '>id A;B;C'."""
    from ..functions.taxa import pad_lineage

    h = F.regexp_replace("value", "^>", "")
    rest = F.when(F.instr(h, " ") > 0, F.substring(h, F.instr(h, " ") + 1, F.length(h))).otherwise(F.lit(""))
    return headers.filter(F.col("value").startswith(">")).select(F.substring_index(h, " ", 1).alias("id"), pad_lineage(F.split(rest, ";"), depth).alias("lineage"))


def species_lineages(lines: DataFrame, ids: DataFrame, depth: int) -> DataFrame:
    """(id, lineage) of lines species, a field that is left out, rank 1, ...; ids (species, id) has to know every species."""
    from ..functions.taxa import pad_lineage

    c = columns(lines).select(field(0).alias("species"), pad_lineage(F.slice("f", 3, depth), depth).alias("lineage"))
    known = F.when(F.col("id").isNull(), F.raise_error(F.concat(F.lit("no id of "), F.col("species")))).otherwise(F.col("id"))
    return c.join(ids, "species", "left").select(known.alias("id"), "lineage")


def kingdoms(lines: DataFrame, numbered: bool = True) -> DataFrame:
    """(id, kingdom code): of lines that start with a number and name a taxonomy, or of lines id, tab, name with euka for eukaryotes."""
    from ..functions.taxa import KINGDOMS, kingdom_code

    if numbered:
        return lines.filter(F.col("value").rlike(r"^\d+\s")).select(F.regexp_extract("value", r"^(\d+)", 1).alias("id"), kingdom_code(F.col("value")).alias("kingdom"))
    return columns(lines).select(field(0).alias("id"), F.when(field(1) == "euka", 1).otherwise(KINGDOMS["bacteria"]).alias("kingdom"))


def yes_matrix(wide: DataFrame, key: str, sep: str = ",") -> DataFrame:
    """(key, property) of a matrix of YES marks."""
    cols = [c for c in wide.columns if c != key]
    return wide.select(key, *[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot(key, cols, "property", "mark").filter("mark = 'YES'").drop("mark")


def block_records(lines: DataFrame, head: str, partition: str, order: str) -> DataFrame:
    """Lines with the header (first group of head) of their block, header lines left out."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    own = F.regexp_extract("value", head, 1)
    return lines.withColumn("block", F.last(F.when(own != "", own), True).over(w)).filter(own == "")


def fixed_stride(text: Column, n: int) -> Column:
    """Tokens of a text as arrays of n."""
    t = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    return F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(t) / n).cast("int") - 1, F.lit(0))), lambda i: F.slice(t, i * n + 1, F.lit(n)))


def log_numbers(text: Column, patterns: dict[str, str]) -> list[Column]:
    """The first number of each pattern in a log text, null where it isn't there."""
    got = {k: F.regexp_replace(F.regexp_extract(text, p, 1), ",", "") for k, p in patterns.items()}
    return [F.when(v != "", v).cast("double").alias(k) for k, v in got.items()]


def domain_hits(lines: DataFrame, cutoff: float) -> DataFrame:
    """Domain table rows (target, query, score) from cutoff on."""
    return columns(lines, r"\s+").select(field(0).alias("target"), field(3).alias("query"), field(13, "double").alias("score")).filter(F.col("score") >= cutoff)


def selection_report(json_text: Column, threshold: float = 0.9) -> Column:
    """Sites with posterior above threshold, for and against, and mean rates, of {"MLE": {"content": {"0": [[a, b, ., neg, pos], ...]}}}."""
    rows = F.from_json(F.get_json_object(json_text, "$.MLE.content.0"), "array<array<double>>")
    n = F.size(rows)
    mean = lambda i: F.aggregate(rows, F.lit(0.0), lambda a, r: a + F.get(r, F.lit(i))) / n
    return F.struct(n.alias("sites"), F.size(F.filter(rows, lambda r: F.get(r, F.lit(4)) > threshold)).alias("positive"), F.size(F.filter(rows, lambda r: F.get(r, F.lit(3)) > threshold)).alias("negative"), mean(0).alias("mean_syn"), mean(1).alias("mean_nonsyn"))


def split_annotation(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Two-column tables of an annotation table as rows (kind, key, value), '-' left out, lists exploded."""
    long = df.select(F.col(key).cast("string").alias(key), *[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot(key, cols, "kind", "value")
    return long.filter("value is not null and value != '-'").select(key, "kind", F.explode(F.split("value", ",")).alias("value"))


#: Headers of a sample sheet and what they become; fixed values.
SHEET_COLUMNS = {"#SmplID": "smpl_id", "Path": "path", "SmplPrefix": "prefix", "AssmblGrps": "ass_group", "MapGrps": "map_group", "SeqTech": "seq_tech", "SupportReads": "support_reads", "ExcludeAssembly": "exclude_assembly", "cut5PR1": "cut5_r1", "cut5PR2": "cut5_r2"}
SHEET_DIRECTIVES = {"#DirPath": "dir_path", "#OutPath": "out_path", "#RunID": "run_id"}


def sample_sheet(lines: DataFrame, header: list[str]) -> DataFrame:
    """Samples with the directives (#DirPath, #OutPath, #RunID) in force at their line; lines need line_no and file.

    A group that is empty is the sample itself; seq numbers the samples of a file from 0.
    """
    if "#SmplID" not in header:
        raise ValueError("a sample sheet needs the column #SmplID")
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    out = lines.withColumn("f", F.split("value", "\t"))
    for tag, name in SHEET_DIRECTIVES.items():
        said = F.when(F.col("value").startswith(tag), F.trim(F.regexp_replace("value", f"^{tag}\\s*", "")))
        out = out.withColumn(name, F.last(said, True).over(w))
    out = out.filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    picked = [(F.nullif(F.get("f", F.lit(i)), F.lit(""))).alias(SHEET_COLUMNS[h]) for i, h in enumerate(header) if h in SHEET_COLUMNS]
    out = out.select("file", "line_no", *picked, *SHEET_DIRECTIVES.values())
    for c in SHEET_COLUMNS.values():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    out = out.withColumn("ass_group", F.coalesce("ass_group", "smpl_id")).withColumn("map_group", F.coalesce("map_group", "smpl_id"))
    return out.withColumn("seq", F.row_number().over(Window.partitionBy("file").orderBy("line_no")) - 1)


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The samples of a sheet file, whose header is its line that starts with #SmplID."""
    lines = read_lines(spark, path, numbered=True).withColumn("value", F.regexp_replace("value", "\r$", ""))
    head = lines.filter(F.col("value").startswith("#SmplID")).orderBy("line_no").first()  # one line
    if head is None:
        raise ValueError("a sample sheet needs the column #SmplID")
    return sample_sheet(lines, head["value"].split("\t"))


def sheet_faults(samples: DataFrame) -> DataFrame:
    """(smpl_id, fault) of ids that repeat or hold characters that aren't allowed."""
    twice = samples.groupBy("smpl_id").agg(F.count("*").alias("n")).filter("n > 1").select("smpl_id", F.lit("repeated").alias("fault"))
    return twice.unionByName(samples.filter(F.col("smpl_id").rlike(r"[^\w.\-]|__")).select("smpl_id", F.lit("characters").alias("fault")))


def group_owner(samples: DataFrame) -> DataFrame:
    """The last sample of each assembly group owns the assembly."""
    w = Window.partitionBy("ass_group")
    return samples.withColumn("owner", F.max_by("smpl_id", "seq").over(w)).withColumn("is_owner", F.col("owner") == F.col("smpl_id"))


def unknown(x: Column) -> Column:
    return F.when(x.isNull() | (x == "") | (x == "-"), F.lit(UNKNOWN)).otherwise(x)
