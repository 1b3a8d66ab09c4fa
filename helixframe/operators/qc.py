"""Read and variant QC as aggregations (samtools flagstat / idxstats /
stats SN lines, bcftools-stats-like per-sample variant summary) and the
per-sample text report that joins them.

Each statistic is a ``count_if``/``sum`` inside one ``groupBy(sample_id)``
(partial aggregation; a sample holding a third of all reads is reduced
map-side first).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import first_alt, mutation_type, safe_ratio

# SAM flag bits.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED = 0x1, 0x2, 0x4, 0x8
READ1, READ2, SECONDARY, QCFAIL, DUPLICATE, SUPPLEMENTARY = 0x40, 0x80, 0x100, 0x200, 0x400, 0x800


def _has(bit: int) -> Column:
    return (F.col("flag").bitwiseAND(bit)) != 0


def flagstat(reads: DataFrame) -> DataFrame:
    """Counts by flag bits per sample, as ``samtools flagstat`` reports them
    (pair statistics over primary alignments only)."""
    primary = ~_has(SECONDARY) & ~_has(SUPPLEMENTARY)
    paired = primary & _has(PAIRED)
    mapped = ~_has(UNMAPPED)
    return reads.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(primary).alias("primary"),
        F.count_if(_has(SECONDARY)).alias("secondary"),
        F.count_if(_has(SUPPLEMENTARY)).alias("supplementary"),
        F.count_if(_has(DUPLICATE)).alias("duplicates"),
        F.count_if(_has(QCFAIL)).alias("qc_failed"),
        F.count_if(mapped).alias("mapped"),
        F.count_if(primary & mapped).alias("primary_mapped"),
        F.count_if(paired).alias("paired"),
        F.count_if(paired & _has(READ1)).alias("read1"),
        F.count_if(paired & _has(READ2)).alias("read2"),
        F.count_if(paired & _has(PROPER) & mapped).alias("properly_paired"),
        F.count_if(paired & mapped & ~_has(MATE_UNMAPPED)).alias("with_mate_mapped"),
        F.count_if(paired & mapped & _has(MATE_UNMAPPED)).alias("singletons"),
    )


def idxstats(reads: DataFrame) -> DataFrame:
    """Mapped / unmapped reads per sample and contig (``*`` = no coordinate)."""
    return reads.groupBy("sample_id", "rname").agg(
        F.count_if(~_has(UNMAPPED)).alias("mapped"),
        F.count_if(_has(UNMAPPED)).alias("unmapped"))


@F.pandas_udf(T.LongType())
def phred_sum(qual: pd.Series) -> pd.Series:
    """Sum of Phred+33 base qualities per read ('*' = none -> 0).

    Vectorised over the Arrow batch: all strings are joined into one byte
    buffer and summed per read with ``np.add.reduceat`` (a per-character
    SQL lambda would run interpreted, ~50x slower)."""
    q = qual.fillna("*").where(qual != "*", "")
    lens = q.str.len().to_numpy()
    buf = np.frombuffer("".join(q.tolist()).encode("latin-1"), dtype=np.uint8)
    out = np.zeros(len(q), dtype=np.int64)
    nz = lens > 0
    if nz.any():
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
        sums = np.add.reduceat(buf, starts[nz], dtype=np.int64) if len(buf) else np.zeros(int(nz.sum()), dtype=np.int64)
        out[nz] = sums - 33 * lens[nz]
    return pd.Series(out)


def samstats(reads: DataFrame, primary_only: bool = False) -> DataFrame:
    """Summary numbers (``SN`` lines) per sample, over all alignments or, as
    the tool's report counts sequences, without secondary and supplementary
    ones (``primary_only``).  Read length comes from
    ``read_length`` when present, else ``length(seq)``; base quality is the
    Phred mean over all bases (``qual`` decoded by a vectorised UDF)."""
    rl = F.col("read_length") if "read_length" in reads.columns else F.length("seq")
    mapped = ~_has(UNMAPPED)
    if primary_only:
        reads = reads.where(~_has(SECONDARY) & ~_has(SUPPLEMENTARY))
    aggs = [
        F.count(F.lit(1)).alias("sequences"),
        F.count_if(mapped).alias("reads_mapped"),
        F.count_if(~mapped).alias("reads_unmapped"),
        F.count_if(_has(DUPLICATE)).alias("reads_duplicated"),
        F.count_if(mapped & (F.col("mapq") == 0)).alias("reads_mq0"),
        F.sum(rl).cast("long").alias("total_length"),
        F.sum(F.when(mapped, rl).otherwise(0)).cast("long").alias("bases_mapped"),
        F.max(rl).cast("long").alias("maximum_length"),
    ]
    if "qual" in reads.columns:
        aggs.append(F.sum(F.when(F.col("qual") != "*", phred_sum(F.col("qual")))).alias("_qsum"))
        aggs.append(F.sum(F.when(F.col("qual") != "*", F.length("qual"))).alias("_qn"))
    out = reads.groupBy("sample_id").agg(*aggs)
    out = out.withColumn("average_length", safe_ratio("total_length", "sequences"))
    if "qual" in reads.columns:
        out = out.withColumn("average_quality", safe_ratio("_qsum", "_qn")).drop("_qsum", "_qn")
    return out


# Order and wording of the lines of the flag report; a rate is (part, whole).
FLAG_LINES = [
    ("in total", "total", None), ("primary", "primary", None), ("secondary", "secondary", None),
    ("supplementary", "supplementary", None), ("duplicates", "duplicates", None),
    ("primary duplicates", "primary_duplicates", None), ("mapped", "mapped", "total"),
    ("primary mapped", "primary_mapped", "primary"), ("paired in sequencing", "paired", None), ("read1", "read1", None),
    ("read2", "read2", None), ("properly paired", "properly_paired", "paired"),
    ("with itself and mate mapped", "with_mate_mapped", None), ("singletons", "singletons", "paired"),
    ("with mate mapped to a different chr", "mate_elsewhere", None),
    ("with mate mapped to a different chr (mapQ>=5)", "mate_elsewhere_mapq5", None),
]


def flagstat_report(reads: DataFrame) -> DataFrame:
    """All sixteen lines of the flag report per sample: line_no, category,
    passed and failed (reads with and without QC pass), passed_rate and
    failed_rate in percent of the line they are a share of (NULL where that
    is 0 or the line has none).  One scan: 32 conditional counts, combined in
    the tasks, then unfolded to lines."""
    primary = ~_has(SECONDARY) & ~_has(SUPPLEMENTARY)
    paired = primary & _has(PAIRED)
    mapped = ~_has(UNMAPPED)
    both = paired & mapped & ~_has(MATE_UNMAPPED)
    elsewhere = both & (F.col("rnext") != "=") & (F.col("rnext") != F.col("rname")) & (F.col("rnext") != "*")
    counted = {
        "total": F.lit(True), "primary": primary, "secondary": _has(SECONDARY),
        "supplementary": _has(SUPPLEMENTARY) & ~_has(SECONDARY), "duplicates": _has(DUPLICATE),
        "primary_duplicates": primary & _has(DUPLICATE), "mapped": mapped, "primary_mapped": primary & mapped, "paired": paired,
        "read1": paired & _has(READ1), "read2": paired & _has(READ2), "properly_paired": paired & _has(PROPER) & mapped,
        "with_mate_mapped": both, "singletons": paired & mapped & _has(MATE_UNMAPPED), "mate_elsewhere": elsewhere,
        "mate_elsewhere_mapq5": elsewhere & (F.col("mapq") >= 5),
    }
    good = ~_has(QCFAIL)
    sums = reads.groupBy("sample_id").agg(
        *[F.count_if(c & good).alias(f"p_{k}") for k, c in counted.items()],
        *[F.count_if(c & ~good).alias(f"f_{k}") for k, c in counted.items()])

    def rate(side: str, part: str, whole: str | None) -> Column:
        if whole is None:
            return F.lit(None).cast("double")
        return F.round(safe_ratio(F.col(f"{side}_{part}") * 100, f"{side}_{whole}"), 2)

    lines = [F.struct(F.lit(k).alias("line_no"), F.lit(text).alias("category"), F.col(f"p_{part}").alias("passed"),
                      F.col(f"f_{part}").alias("failed"), rate("p", part, whole).alias("passed_rate"),
                      rate("f", part, whole).alias("failed_rate")) for k, (text, part, whole) in enumerate(FLAG_LINES, 1)]
    return sums.select("sample_id", F.inline(F.array(*lines)))


def idxstats_report(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """sample_id, contig_index, rname, length, mapped, unmapped for every
    contig of a sample's header (``contigs``: sample_id, contig, length,
    contig_index), reads on it or not, in the header's order, and last the
    reads without coordinate under ``*``.  Reads on contigs that no header
    names keep a NULL length."""
    n = idxstats(reads).withColumnRenamed("sample_id", "_s")
    star = contigs.groupBy("sample_id").agg(F.lit("*").alias("contig"), F.lit(0).cast("long").alias("length"),
                                            (F.max("contig_index") + 1).alias("contig_index"))
    every = contigs.select("sample_id", "contig", F.col("length").cast("long").alias("length"), "contig_index").unionByName(
        star.select("sample_id", "contig", "length", "contig_index"))
    j = every.join(n, (F.col("sample_id") == F.col("_s")) & (F.col("contig") == F.col("rname")), "full")
    return j.select(F.coalesce("sample_id", "_s").alias("sample_id"), "contig_index", F.coalesce("contig", "rname").alias("rname"),
                    "length", F.coalesce("mapped", F.lit(0)).alias("mapped"), F.coalesce("unmapped", F.lit(0)).alias("unmapped"))


# Largest values with a bin of their own; the last bin holds all above.
MOST_MAPQ, MOST_LENGTH = 254, 1000


def read_histograms(reads: DataFrame) -> DataFrame:
    """sample_id, metric, bin, reads: mapping quality and length of primary
    reads in fixed bins, from one scan.  Bins of equal samples add up, so
    histograms of parts merge by a sum."""
    rl = F.col("read_length") if "read_length" in reads.columns else F.length("seq")
    primary = reads.where(~_has(SECONDARY) & ~_has(SUPPLEMENTARY))
    values = F.inline(F.array(
        F.struct(F.lit("mapq").alias("metric"), F.least("mapq", F.lit(MOST_MAPQ)).cast("long").alias("bin")),
        F.struct(F.lit("length").alias("metric"), F.least(rl, F.lit(MOST_LENGTH)).cast("long").alias("bin"))))
    return primary.select("sample_id", values).where("bin IS NOT NULL").groupBy("sample_id", "metric", "bin").agg(
        F.count(F.lit(1)).alias("reads"))


# Width of a quality bin of the variant report.
QUALITY_BIN = 10


def vcf_quality_histogram(calls: DataFrame) -> DataFrame:
    """sample_id, bin (lower bound; NULL: no quality), snvs, indels, others:
    records of each kind by quality.  A record is one kind only: SNV where all
    alleles are single bases, indel where some ALT's bases differ in number
    from REF's, else other (MNPs, symbolic and missing alleles)."""
    ref, alts = F.col("reference_bases"), F.col("alternate_bases")
    plain = (F.size(alts) > 0) & F.forall(alts, lambda a: a.rlike("^[ACGTNacgtn]+$"))
    snv = plain & (F.length(ref) == 1) & F.forall(alts, lambda a: F.length(a) == 1)
    indel = plain & ~snv & F.exists(alts, lambda a: F.length(a) != F.length(ref))
    at = (F.floor(F.col("quality") / QUALITY_BIN) * QUALITY_BIN).cast("long").alias("bin")
    return calls.groupBy("sample_id", at).agg(
        F.count_if(snv).alias("snvs"), F.count_if(indel).alias("indels"), F.count_if(~snv & ~indel).alias("others"))


def vcf_stats(calls: DataFrame) -> DataFrame:
    """Per-sample variant summary of a long call table (site columns +
    ``sample_id``): records, SNV/MNP/indel counts, multi-allelic records,
    transitions/transversions of SNV records and their ratio.  (Other kinds
    and qualities: ``vcf_quality_histogram``.)"""
    ref = F.col("reference_bases")
    alts = F.col("alternate_bases")
    lens = F.transform(alts, lambda a: F.length(a))
    n_alt = F.coalesce(F.size(alts), F.lit(0))
    snv = (F.length(ref) == 1) & (n_alt > 0) & F.forall(lens, lambda x: x == 1)
    mnp = (F.length(ref) > 1) & (n_alt > 0) & F.forall(lens, lambda x: x == F.length(ref))
    indel = F.exists(lens, lambda x: x != F.length(ref))
    mt = mutation_type(ref, first_alt(alts))
    snv1 = snv & (n_alt == 1)
    return calls.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(snv).alias("snvs"),
        F.count_if(mnp).alias("mnps"),
        F.count_if(indel).alias("indels"),
        F.count_if(n_alt > 1).alias("multiallelic"),
        F.count_if(snv1 & (mt == "Transition")).alias("ts"),
        F.count_if(snv1 & (mt == "Transversion")).alias("tv"),
    ).withColumn("ts_tv", safe_ratio("ts", "tv"))


def qc_report(flag: DataFrame, idx: DataFrame, stats: DataFrame, top_contigs: int = 10,
              contig_order: DataFrame | None = None) -> DataFrame:
    """One text report per sample: flagstat block, first ``top_contigs``
    idxstats lines (file order when ``contig_order`` gives it, else contig
    name) and the SN block.  Two inner joins on ``sample_id``; only the
    bounded top-N contig lines are gathered per sample."""
    fcols = [c for c in flag.columns if c != "sample_id"]
    flag_txt = flag.select("sample_id", F.concat_ws("\n", *[
        F.format_string(f"%d {c}", F.col(c)) for c in fcols]).alias("flagstat_text"))
    if contig_order is not None:
        # contigs are ordered within their own file: the same name may come at another place in another one
        on = [c for c in ("sample_id",) if c in contig_order.columns]
        idx = idx.join(contig_order.select(*on, F.col("contig").alias("rname"), "contig_index"), [*on, "rname"], "left")
        okey = [F.col("contig_index").asc_nulls_last(), F.col("rname")]
    else:
        okey = [F.col("rname")]
    w = Window.partitionBy("sample_id").orderBy(*okey)
    top = (idx.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top_contigs)
           .select("sample_id", "_rn", F.format_string("%s\t%d\t%d", "rname", "mapped", "unmapped").alias("_l")))
    idx_txt = top.groupBy("sample_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rn", "_l"))), lambda s: s["_l"]), "\n")
         .alias("idxstats_text"))
    stypes = dict(stats.dtypes)

    def sn_value(c: str) -> Column:
        return (F.format_string("%.6f", F.col(c)) if stypes[c] in ("double", "float")
                else F.col(c).cast("string"))

    scols = [c for c in stats.columns if c != "sample_id"]
    sn_txt = stats.select("sample_id", F.concat_ws("\n", *[
        F.concat(F.lit(f"SN\t{c.replace('_', ' ')}:\t"), sn_value(c)) for c in scols])
        .alias("stats_text"))
    j = flag_txt.join(sn_txt, "sample_id").join(idx_txt, "sample_id")
    rule = "=" * 80
    return j.select("sample_id", F.concat_ws(
        "\n", F.lit(rule), F.concat(F.lit("Quality Control Report: "), F.col("sample_id")), F.lit(rule),
        F.lit("FLAGSTAT SUMMARY"), F.col("flagstat_text"), F.lit("CHROMOSOME COVERAGE (Top 10)"),
        F.col("idxstats_text"), F.lit("DETAILED STATISTICS"), F.col("stats_text"), F.lit(rule)).alias("report"))
