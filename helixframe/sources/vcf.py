"""VCF text -> typed DataFrames.

The parser is a set of Column expressions over a DataFrame of text lines
(``value`` + ``source_file``): ``split`` for the fixed columns and
higher-order ``transform`` over the sample columns for the calls, so a VCF
is parsed by as many tasks as its text splits into (gzip files: one task
per file).  Sample names come from each file's ``#CHROM`` header line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import ANNOTATION, POPULATION_FREQUENCIES

# Above this many input files, or bytes of names, the per-file header table
# meets the lines by a shuffle join instead of a broadcast.
HEADER_BROADCAST_FILES = 10_000
HEADER_BROADCAST_BYTES = 32 << 20


def text_lines(spark: SparkSession, path_glob: str) -> DataFrame:
    """Lines of every matching file (gzip handled by the codec) with the
    file each came from."""
    return (spark.read.text(path_glob)
            .select("value", F.col("_metadata.file_path").alias("source_file")))


def _missing(c: Column) -> Column:
    """VCF '.' (or empty) -> NULL."""
    return F.when(~c.isin(".", ""), c)


def vcf_headers(lines: DataFrame, names: str = "keep") -> DataFrame:
    """``source_file`` -> array of sample names from the ``#CHROM`` line.

    ``names``: ``keep`` the names, ``hash`` them (sha-256 hex, stable across
    files) or ``none`` (NULL names; calls keep their column index)."""
    h = lines.where(F.col("value").startswith("#CHROM"))
    f = F.split("value", "\t")
    s = F.slice(f, 10, F.greatest(F.size(f) - 9, F.lit(0)))
    if names == "hash":
        s = F.transform(s, lambda x: F.sha2(x, 256))
    elif names == "none":
        s = F.transform(s, lambda x: F.lit(None).cast("string"))
    return h.select("source_file", s.alias("_sample_names"))


_FORMAT_KEYS = ("GT", "PS", "GQ", "DP", "AD")


def _format_index(keys: Column) -> dict[str, Column]:
    """0-based position of each known FORMAT key in the line's FORMAT list
    (-1 when absent), computed once per line, not once per call."""
    return {k: (F.array_position(keys, k) - 1).cast("int") for k in _FORMAT_KEYS}


def _allele_code(a: Column) -> Column:
    return F.when(a == ".", F.lit(-1).cast("long")).otherwise(a.try_cast("long"))


def _alleles(gt: Column) -> Column:
    return F.split(F.translate(gt, "|", "/"), "/")


def _genotype(gt: Column, alleles: Column) -> Column:
    """'0|1' / '1/.' -> [0, 1] / [1, -1]; NULL GT -> NULL.  Diploid calls
    take a lambda-free path; other ploidies use ``transform``."""
    diploid = F.array(_allele_code(F.get(alleles, 0)), _allele_code(F.get(alleles, 1)))
    return (F.when(gt.isNull(), F.lit(None).cast("array<bigint>"))
            .when(F.size(alleles) == 2, diploid)
            .otherwise(F.transform(alleles, _allele_code)))


def _depths(ad: Column) -> Column:
    return F.when(ad.isNull(), F.lit(None).cast("array<bigint>")).otherwise(
        F.transform(F.split(ad, ","), lambda x: _missing(x).try_cast("long")))


def _call_texts(vals: Column, ix: dict[str, Column]) -> list[Column]:
    """The text of each known FORMAT key of a call, NULL where missing."""
    return [_missing(F.get(vals, ix[k])).alias(k) for k in _FORMAT_KEYS]


def _call_fields(text: dict[str, Column], alleles: Column, name: Column) -> list[Column]:
    """A call's typed fields from its texts by FORMAT key and its split GT."""
    return [
        name.alias("sample_id"),
        _genotype(text["GT"], alleles).alias("genotype"),
        F.coalesce(text["PS"], F.when(text["GT"].contains("|"), F.lit("*"))).alias("phaseset"),
        text["GQ"].try_cast("long").alias("genotype_quality"),
        text["DP"].try_cast("long").alias("read_depth"),
        _depths(text["AD"]).alias("allele_depths"),
    ]


def _info_end(info: Column) -> Column:
    """INFO END (the 1-based last position of a block or a symbolic allele), else NULL."""
    end = F.regexp_extract(info, r"(?:^|;)END=([0-9]+)(?:;|$)", 1)
    return F.when(info.contains("END="), end.try_cast("long"))


def _site_columns(f: Column) -> list[Column]:
    alt = _missing(F.get(f, 4))
    filt = _missing(F.get(f, 6))
    ref = F.get(f, 3)
    start = (F.get(f, 1).try_cast("long") - 1)
    return [
        F.get(f, 0).alias("reference_name"),
        start.alias("start_position"),
        F.coalesce(_info_end(F.get(f, 7)), start + F.length(ref)).alias("end_position"),
        ref.alias("reference_bases"),
        F.when(alt.isNull(), F.array().cast("array<string>")).otherwise(F.split(alt, ",")).alias("alternate_bases"),
        _missing(F.get(f, 2)).alias("variant_id"),
        _missing(F.get(f, 5)).try_cast("double").alias("quality"),
        F.when(filt.isNull(), F.lit(None).cast("array<string>")).otherwise(F.split(filt, ";")).alias("filter"),
    ]


def data_with_names(lines: DataFrame, names: str = "keep", broadcast_headers: bool | None = None,
                     headers: DataFrame | None = None) -> DataFrame:
    """Data lines with their file's sample names.  The header table (a row a
    file) is landed and measured: up to HEADER_BROADCAST_BYTES it is broadcast
    and no line is shuffled; beyond, each line and each header row is shuffled
    once, by file.  A file that holds most lines is split between tasks by
    adaptive execution, its one header row copied to each; copies of all
    header rows would outgrow the lines of cohorts with a file a sample.
    Without names (``none``) there is nothing to meet."""
    data = lines.where(~F.col("value").startswith("#") & (F.length("value") > 0))
    if headers is None and names == "none":
        return data.withColumn("_sample_names", F.lit(None).cast("array<string>"))
    if headers is None:
        headers = vcf_headers(lines, names)
    key = "source_file"
    if "_file_name" in headers.columns:      # names keyed by file name (manifest)
        key = "_file_name"
        data = data.withColumn(key, F.regexp_extract("source_file", r"([^/]+)$", 1))
    if broadcast_headers is None:
        headers = headers.checkpoint(eager=True)
        named = F.coalesce(F.octet_length(F.array_join("_sample_names", ",")), F.lit(0)) + F.octet_length(key) + 16
        broadcast_headers = (headers.agg(F.sum(named.cast("long"))).first()[0] or 0) <= HEADER_BROADCAST_BYTES
    return data.join(F.broadcast(headers) if broadcast_headers else headers, key, "left").drop("_file_name")


def parse_vcf_lines(lines: DataFrame, names: str = "keep", broadcast_headers: bool | None = None,
                    headers: DataFrame | None = None) -> DataFrame:
    """Data lines -> nested ``variants`` rows (see ``schemas.VARIANTS``).

    ``start_position`` is 0-based (POS - 1); ``end_position`` is INFO END
    where a line has it (reference blocks, symbolic alleles), else start +
    len(REF); ``.`` fields become NULL; genotype no-calls become -1; a phased
    call without PS gets phase set ``*``.  Extra column ``info`` keeps the
    raw INFO text.  Each sample column is split once; FORMAT key positions
    are resolved once per line.  Explode ``calls`` with
    :func:`~helixframe.operators.joins.unnest_calls`: a plain ``inline``
    filters on their number first, for which they are parsed once more.  ``headers`` (``source_file``,
    ``_sample_names``), e.g. from a sample manifest, skips the scan for
    ``#CHROM`` lines.
    """
    data = data_with_names(lines, names, broadcast_headers, headers)
    # columns of their own, so each is computed once a line: an expression of
    # the line inside a lambda would be computed again for every call
    data = data.select("source_file", "_sample_names", F.split("value", "\t").alias("_f"))
    f = F.col("_f")
    data = data.select(
        "source_file", "_sample_names", "_f", F.slice(f, 10, F.greatest(F.size(f) - 9, F.lit(0))).alias("_samples"),
        *[v.alias(f"_ix_{k}") for k, v in _format_index(F.split(F.get(f, 8), ":")).items()])
    ix = {k: F.col(f"_ix_{k}") for k in _FORMAT_KEYS}
    names_ = F.col("_sample_names")
    # one step a lambda, each reading what the step before it left: within a
    # lambda nothing is shared
    calls = F.transform("_samples", lambda x: F.split(x, ":"))
    calls = F.transform(calls, lambda v: F.struct(*_call_texts(v, ix)))
    calls = F.transform(calls, lambda t: F.struct(t.alias("t"), _alleles(t["GT"]).alias("a")))
    calls = F.transform(calls, lambda c, i: F.struct(*_call_fields(
        {k: c["t"][k] for k in _FORMAT_KEYS}, c["a"], F.get(names_, i))))
    return data.select(
        *_site_columns(f),
        calls.alias("calls"),
        F.array().cast(T.ArrayType(ANNOTATION)).alias("annotations"),
        F.lit(None).cast(POPULATION_FREQUENCIES).alias("population_frequencies"),
        F.lit(None).cast("string").alias("clinical_significance"),
        F.col("source_file"),
        F.lit(None).cast("timestamp").alias("ingestion_timestamp"),
        _missing(F.get(f, 7)).alias("info"),
    )


def parse_vcf_genotypes(lines: DataFrame, names: str = "keep", broadcast_headers: bool | None = None,
                        headers: DataFrame | None = None) -> DataFrame:
    """Data lines -> long genotype rows (one per site and sample): the sample
    columns are exploded first, then every field is a plain column
    expression (whole-stage codegen, no per-call lambda)."""
    data = data_with_names(lines, names, broadcast_headers, headers)
    data = data.select("source_file", "_sample_names", F.split("value", "\t").alias("_f"))
    f = F.col("_f")
    x = data.select(
        *_site_columns(f), "source_file", "_sample_names",
        *[v.alias(f"_ix_{k}") for k, v in _format_index(F.split(F.get(f, 8), ":")).items()],
        F.posexplode(F.slice(f, 10, F.greatest(F.size(f) - 9, F.lit(0)))).alias("sample_index", "_s"))
    ix = {k: F.col(f"_ix_{k}") for k in _FORMAT_KEYS}
    site = ["reference_name", "start_position", "end_position", "reference_bases", "alternate_bases",
            "variant_id", "quality", "filter"]
    # each step is a column that the next one reads, so it is computed once a call
    x = x.select(*site, "source_file", "_sample_names", "sample_index", *ix.values(), F.split("_s", ":").alias("_v"))
    x = x.select(*site, "source_file", "_sample_names", "sample_index", *_call_texts(F.col("_v"), ix))
    x = x.withColumn("_alleles", _alleles(F.col("GT")))
    return x.select(*site, "sample_index",
                    *_call_fields({k: F.col(k) for k in _FORMAT_KEYS}, F.col("_alleles"),
                                  F.get(F.col("_sample_names"), F.col("sample_index"))),
                    "source_file")


def read_vcf(spark: SparkSession, path_glob: str, names: str = "keep",
             max_broadcast_files: int = HEADER_BROADCAST_FILES,
             sample_names: dict[str, list[str]] | None = None, long: bool = False) -> DataFrame:
    """Read VCF file(s) (glob allowed, ``.gz`` fine) into nested rows (or
    the long genotype table with ``long=True``).

    The per-file header table has one row per file; it is broadcast only
    under ``max_broadcast_files`` files (known from the listing) and
    HEADER_BROADCAST_BYTES of names (measured), else lines meet it by file.  ``sample_names``
    ({file name: [names]}, e.g. from the batch manifest) avoids the second
    pass over the text for ``#CHROM`` lines.
    """
    raw = spark.read.text(path_glob)
    files = raw.inputFiles()
    lines = raw.select("value", F.col("_metadata.file_path").alias("source_file"))
    headers = None
    if sample_names is not None:
        headers = spark.createDataFrame(sorted(sample_names.items()), "_file_name string, _sample_names array<string>")
    parse = parse_vcf_genotypes if long else parse_vcf_lines
    return parse(lines, names, broadcast_headers=None if len(files) <= max_broadcast_files else False, headers=headers)


def site_fields(f: Column) -> list[Column]:
    """``CHROM POS ID REF ALT QUAL FILTER`` of a data line's fields (POS kept 1-based)."""
    return [F.get(f, 0).alias("chromosome"), F.get(f, 1).try_cast("long").alias("position"),
            _missing(F.get(f, 2)).alias("id"), F.get(f, 3).alias("ref"), _missing(F.get(f, 4)).alias("alt"),
            _missing(F.get(f, 5)).try_cast("double").alias("quality"), _missing(F.get(f, 6)).alias("filter")]


def vcf_to_flat(lines: DataFrame, sample_id: str | Column | None = None) -> DataFrame:
    """``CHROM POS ID REF ALT QUAL FILTER`` projection of data lines (POS kept
    1-based), with an optional leading ``sample_id``."""
    data = lines.where(~F.col("value").startswith("#") & (F.length("value") > 0))
    cols = site_fields(F.split("value", "\t"))
    if sample_id is not None:
        sid = F.lit(sample_id) if isinstance(sample_id, str) else sample_id
        cols = [sid.alias("sample_id")] + cols
    return data.select(*cols)


_META = r"^##(INFO|FORMAT)=<ID=([^,>]+)(?:,Number=([^,>]+))?(?:,Type=([^,>]+))?"


def vcf_header_union(lines: DataFrame) -> DataFrame:
    """One INFO/FORMAT definition set agreed over many files: per (kind, id)
    the distinct Number/Type values and how many files declare it;
    ``conflict`` flags ids declared with more than one Type or Number."""
    h = lines.where(F.col("value").startswith("##") & F.col("value").rlike(r"^##(INFO|FORMAT)=<"))
    x = h.select(
        "source_file",
        F.regexp_extract("value", _META, 1).alias("kind"),
        F.regexp_extract("value", _META, 2).alias("id"),
        F.regexp_extract("value", _META, 3).alias("number"),
        F.regexp_extract("value", _META, 4).alias("type"))
    return (x.groupBy("kind", "id")
            .agg(F.sort_array(F.collect_set("number")).alias("numbers"),
                 F.sort_array(F.collect_set("type")).alias("types"),
                 F.count_distinct("source_file").alias("files"))
            .withColumn("conflict", (F.size("types") > 1) | (F.size("numbers") > 1)))


def info_definitions(lines: DataFrame) -> DataFrame:
    """id, number, type of each INFO field over all files' headers.  Files
    that disagree on a field make it a String of any number."""
    u = vcf_header_union(lines).where("kind = 'INFO'")
    return u.select("id", F.when(F.col("conflict"), ".").otherwise(F.get("numbers", 0)).alias("number"),
                    F.when(F.col("conflict"), "String").otherwise(F.get("types", 0)).alias("type"))


def info_values(variants: DataFrame, definitions: DataFrame, keep: list[str]) -> DataFrame:
    """One row per value of a site's INFO text: the ``keep`` columns, info_id,
    type, value_index, and the value in the column of its declared type:
    int_value, float_value or string_value (NULL for ``.``), or flag = true
    for a field without a value.

    A field of Number 1 is one value, commas included; others are cut at
    commas.  Fields that no header declares are strings.  The definitions are
    a few rows a header; they are broadcast only after a check of their count."""
    from ..operators.joins import sized_lookup

    field = F.explode(F.split("info", ";")).alias("_f")
    x = variants.where(F.col("info").isNotNull()).select(*keep, field).where("_f <> '' AND _f <> '.'")
    at = F.instr("_f", "=")
    x = x.select(*keep, F.when(at > 0, F.col("_f").substr(F.lit(1), at - 1)).otherwise(F.col("_f")).alias("info_id"),
                 F.when(at > 0, F.col("_f").substr(at + 1, F.length("_f"))).alias("_raw"))
    d = sized_lookup(definitions.select(F.col("id").alias("info_id"), "number", "type"))
    x = x.join(d, "info_id", "left")
    kind = F.when(F.col("_raw").isNull(), "Flag").otherwise(F.coalesce("type", F.lit("String")))
    single = F.coalesce(F.col("number") == "1", F.lit(False)) | F.col("_raw").isNull()
    values = F.posexplode(F.when(single, F.array("_raw")).otherwise(F.split("_raw", ","))).alias("value_index", "_v")
    x = x.select(*keep, "info_id", kind.alias("type"), values)
    v = _missing(F.col("_v"))
    return x.select(*keep, "info_id", "type", "value_index",
                    F.when(F.col("type") == "Integer", v.try_cast("long")).alias("int_value"),
                    F.when(F.col("type") == "Float", v.try_cast("double")).alias("float_value"),
                    F.when(~F.col("type").isin("Integer", "Float", "Flag"), v).alias("string_value"),
                    (F.col("type") == "Flag").alias("flag"))
