"""Annotation of alleles: columns of split annotations, gene and transcript lookups, damage filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import allele_pick, info_of_allele, item, without_tail

INFO_KEYS = ("AC", "AF", "AQ", "MLEAC", "MLEAF")
DAMAGING = ("HIGH", "MODERATE")


#: Rows out of a task of a lookup with repeats, and tasks at most.
OUT_ROWS, MOST_TASKS = 1 << 22, 10_000


def _q(name: str):
    return F.col(f"`{name}`")


def split_packed(df: DataFrame, packed: str, fields: list[str], prefix: str = "CSQ", separator: str = ",") -> DataFrame:
    """One row a consequence of a packed annotation, its |-separated fields as columns prefix + field.

    Fields beyond those that a consequence has are null; rows without annotation go.
    """
    rows = df.withColumn("_one", F.explode(F.split(_q(packed), separator))).withColumn("_parts", F.split("_one", r"\|"))
    return rows.withColumns({f"{prefix}{f}": F.get("_parts", F.lit(i)) for i, f in enumerate(fields)}).drop("_one", "_parts", packed)


def clean_annotation_columns(df: DataFrame, prefix: str = "CSQ", unnamed: str = "(null)") -> DataFrame:
    """The unnamed column becomes INFO, the prefix goes from annotation columns; two columns of one name are an error."""
    names = {c: "INFO" if c == unnamed else c[len(prefix) :] if c.startswith(prefix) and c != prefix else c for c in df.columns}
    taken = list(names.values())
    if twice := sorted({c for c in taken if taken.count(c) > 1}):
        raise ValueError(f"columns of one name after renaming: {twice}")
    return df.withColumnsRenamed({k: v for k, v in names.items() if k != v})


def strip_info_tail(df: DataFrame, key: str = "CSQ", info: str = "INFO") -> DataFrame:
    return df.withColumn(info, without_tail(_q(info), key))


def per_allele_fields(df: DataFrame, keys=INFO_KEYS, info: str = "INFO", alt: str | None = "ALT", allele_num: str = "ALLELE_NUM", anchored: bool = False) -> DataFrame:
    """Adds ALT_specific (after ALT) and the allele's item of each INFO key (after INFO, 'NA' if missing).

    ALLELE_NUM that is no number means the first allele; out of range gives null or 'NA';
    0 means the last. anchored: find a key only as a whole name.
    """
    number = allele_pick(_q(allele_num))
    fields = {k: info_of_allele(_q(info), k, _q(allele_num), anchored) for k in keys}
    new = {"ALT_specific", *keys}
    columns = []
    for c in (c for c in df.columns if c not in new):
        columns.append(_q(c))
        if c == alt:
            columns.append(item(_q(alt), number, lenient=True).alias("ALT_specific"))
        if c == info:
            columns += [v.alias(k) for k, v in fields.items()]
    return df.select(*columns)


def impact_filter(df: DataFrame, impact: str = "IMPACT", keep=DAMAGING) -> DataFrame:
    if impact not in df.columns:
        raise ValueError(f"no column {impact}")
    return df.where(_q(impact).isin(*keep))


def severity_at_least(df: DataFrame, ranks: DataFrame, least: str = "missense_variant", consequence: str = "Consequence", separator: str = "&") -> DataFrame:
    """Rows with a term at least as severe as ``least``. ranks: term, rank (higher is more severe); unknown terms have none.

    The few distinct consequence texts are split and ranked; rows meet them by equality.
    """
    bar = ranks.where(F.col("term") == least).agg(F.max("rank")).first()[0]
    if bar is None:
        raise ValueError(f"no rank for {least}")
    terms = df.select(_q(consequence).alias("_text")).distinct().withColumn("term", F.explode(F.split("_text", separator)))
    good = terms.join(ranks.where(F.col("rank") >= bar).select("term").distinct(), "term", "left_semi").select("_text").distinct()
    return df.join(good, _q(consequence) == F.col("_text"), "left_semi")


def _lookup(df: DataFrame, table: DataFrame, on: dict[str, str]) -> DataFrame:
    """Left join on df column = table column; the table's keys are not kept."""
    keys = {b: f"_k{i}" for i, b in enumerate(on.values())}
    table = table.withColumnsRenamed(keys)
    out = df.join(table, [_q(a) == F.col(keys[b]) for a, b in on.items()], "left")
    return out.drop(*keys.values())


def _lookup_repeated(df: DataFrame, table: DataFrame, key: str, table_key: str) -> DataFrame:
    """:func:`_lookup` by a key that repeats on both sides, whose rows out are spread over tasks.

    The rows out are counted from each key's rows on either side. Where they are many, df
    is cut into parts by a hash of its rows, as many as the largest key needs for
    OUT_ROWS rows a part, and the table is sent to each; the tasks are as many as the rows
    out ask for. So neither the few files of a small table nor a key bounds the tasks.
    """
    a = df.where(_q(key).isNotNull()).groupBy(_q(key).alias("_k")).agg(F.count("*").alias("_a"))
    b = table.groupBy(_q(table_key).alias("_k")).agg(F.count("*").alias("_b"))
    total, largest = a.join(b, "_k").agg(F.sum(F.col("_a") * F.col("_b")), F.max(F.col("_a") * F.col("_b"))).first()
    if (total or 0) <= OUT_ROWS:
        return _lookup(df, table, {key: table_key})
    tasks, parts = min(-(-total // OUT_ROWS), MOST_TASKS), min(-(-largest // OUT_ROWS), MOST_TASKS)
    hashed = [_q(c) for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    df = df.withColumn("_part", F.pmod(F.xxhash64(*hashed), F.lit(parts)).cast("int")).repartition(tasks, _q(key), F.col("_part"))
    table = table.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(tasks, _q(table_key), F.col("_of"))
    return _lookup(df, table.hint("merge"), {key: table_key, "_part": "_of"}).drop("_part")


def constraint_by_gene(df: DataFrame, constraint: DataFrame, gene_col: str = "SYMBOL") -> DataFrame:
    """Adds a gene's largest pLI and smallest oe upper bound, over all and over canonical transcripts (NaN counts as null)."""
    pli, oe = (F.nanvl(_q(c), F.lit(None).cast("double")) for c in ("lof.pLI", "lof.oe_ci.upper"))
    by_gene = constraint.groupBy("gene").agg(
        F.max(pli).alias("gnomad_lof_pLI_max"),
        F.min(oe).alias("gnomad_lof_oe_ci_upper_min"),
        F.max(F.when(F.col("canonical"), pli)).alias("gnomad_lof_pLI_canonical"),
        F.min(F.when(F.col("canonical"), oe)).alias("gnomad_lof_oe_ci_upper_canonical"),
    )
    return _lookup(df, by_gene, {gene_col: "gene"})


def constraint_by_transcript(df: DataFrame, constraint: DataFrame, feature_col: str = "Feature") -> DataFrame:
    """Adds a transcript's pLI and oe upper bound, by exact text; repeated transcripts repeat rows (see :func:`_lookup_repeated`)."""
    table = constraint.select("transcript", _q("lof.pLI").alias("gnomad_lof_pLI_tx"), _q("lof.oe_ci.upper").alias("gnomad_lof_oe_ci_upper_tx"))
    return _lookup_repeated(df, table, feature_col, "transcript")


def gene_posterior(df: DataFrame, posterior: DataFrame, gene_col: str = "Gene", prefix: str = "genebayes_") -> DataFrame:
    """Adds a gene's posterior columns under a prefix; repeated genes repeat rows."""
    table = posterior.select("ensg", *[_q(c).alias(f"{prefix}{c}") for c in posterior.columns if c != "ensg"])
    return _lookup(df, table, {gene_col: "ensg"})


def annotate_exact(df: DataFrame, scores: DataFrame, on: dict[str, str], values: dict[str, str]) -> DataFrame:
    """Adds score columns (values: score column to output column) by equality of all keys (on: df column to score column)."""
    table = scores.select(*[_q(c).alias(f"_s_{c}") for c in on.values()], *[_q(c).alias(out) for c, out in values.items()])
    return _lookup(df, table, {a: f"_s_{b}" for a, b in on.items()})
