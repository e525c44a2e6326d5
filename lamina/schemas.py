"""Column types of the data model, as DDL."""

SEQS = "id string, descr string, seq string"
READS = "id string, mate int, seq string, qual string"
GENES = "contig string, gene_no int, start long, end long, strand string, partial string, attrs map<string,string>"
HITS = "q string, s string, pident double, alen int, mism int, gapo int, qs int, qe int, ss int, se int, evalue double, bits double"
SAM = "qname string, flag int, rname string, pos long, mapq int, cigar string, seq string, tags map<string,string>"
VCF = "chrom string, pos long, ref string, alt array<string>, qual double, is_indel boolean, depth long, alt_counts array<long>"
DEPTH = "chr string, start long, end long, value long"
CLUSTERS = "cluster_id long, member string"
ABUNDANCE = "feature string, sample string, value double"
ANNOTATION = "gene string, levels array<string>, weight double"
LINEAGE = "id string, lineage array<string>"
BIN_QUALITY = "bin string, compl double, conta double, hetero double"
DISTANCE = "a string, b string, pid double, weight double"
TREE = "node int, parent int, name string, len double"
SAMPLES = "smpl_id string, path string, prefix string, seq_tech string, ass_group string, map_group string, support_reads string, exclude_assembly int, cut5_r1 int, cut5_r2 int, dir_path string, out_path string, run_id string, seq int"

UNKNOWN = "?"
