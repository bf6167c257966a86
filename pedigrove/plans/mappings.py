"""The driver's tables as genomic ones: SQL that Spark and DuckDB both take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Views over whole tables; ranges of cases are spread by remainders, no row is left out.
VIEWS = {
    "geno": """
select concat('chr', cast(l_partkey % 3 + 1 as varchar(9))) chrom, l_partkey pos0, l_partkey + 1 end_, 'A' ref, 'C,G,T' alt,
  concat('S', cast(l_suppkey as varchar(9))) sample, concat('F', cast(s_nationkey as varchar(9))) family,
  case (l_orderkey * 7 + l_linenumber) % 29 when 0 then '0/1' when 1 then '1/2' when 2 then './1' when 3 then '0|3' when 4 then './.' when 5 then '2/2' else '0/0' end gt,
  case when l_linenumber % 6 = 0 then '.' else concat(cast(l_linenumber as varchar(9)), ',', cast(l_orderkey % 9 as varchar(9)), ',2,3') end ad
from {lineitem} join {supplier} on l_suppkey = s_suppkey""",
    "iv": """
select distinct l_returnflag chrom, l_orderkey start_, l_orderkey + cast(l_quantity as bigint) end_ from {lineitem}""",
    "rg": """
select case o_orderstatus when 'F' then 'R' when 'O' then 'N' else 'A' end chrom, o_orderkey start_, o_orderkey + 1 + o_custkey % 40 end_,
  cast(floor(o_totalprice) as bigint) z, o_orderstatus label, concat('G', cast(o_orderkey as varchar(12))) symbol
from {orders}""",
    "types": """
select case o_orderstatus when 'F' then 'R' when 'O' then 'N' else 'A' end chrom, o_orderkey - o_orderkey % 8 start_, o_orderkey + 20 + o_custkey % 200 end_,
  case when o_custkey % 9 = 0 then null else o_orderpriority end label
from {orders}""",
    "ann": """
select concat('chr', cast(p_partkey % 3 + 1 as varchar(9))) chrom, p_partkey pos0, p_partkey + 1 end_, 'A' ref, n allele_num,
  case n when 1 then 'C' when 2 then 'G' else 'T' end alt_specific, p_brand symbol, concat('T', cast(p_partkey % 500 as varchar(9))) feature,
  case (p_size + n) % 4 when 0 then 'HIGH' when 1 then 'MODERATE' when 2 then 'LOW' else 'MODIFIER' end impact,
  case (p_size + n) % 5 when 0 then 'missense_variant&splice_region_variant' when 1 then 'stop_gained'
    when 2 then 'synonymous_variant' when 3 then 'intron_variant' else 'frameshift_variant' end consequence
from {part} cross join (select 1 n union all select 2 union all select 3) k""",
    "cons": """
select p_brand gene, concat('T', cast(p_partkey % 700 as varchar(9))) transcript, p_size % 2 = 0 canonical,
  case when p_partkey % 11 = 0 then null else p_retailprice / 2000 end pli, p_size / 50.0e0 oe from {part}""",
    "ped": "select concat('F', cast(c_nationkey as varchar(9))) family, concat('S', cast(c_custkey as varchar(9))) sample from {customer}",
    "called": "select distinct concat('S', cast(o_custkey + 7 as varchar(9))) sample from {orders}",
    "info": """
select l_orderkey, l_linenumber, concat('AC=', cast(l_linenumber as varchar(9)), ',', cast(l_partkey as varchar(9)), ';AF=0.1,0.2;DP=9;MLEAC=1,2;CSQ=x|y') info,
  'C,G' alt, cast(l_linenumber % 4 as varchar(3)) allele_num from {lineitem}""",
    "pk": "select p_partkey, concat(p_brand, '|', p_type, '|||', p_brand, ',X|', p_name, '|') csq from {part}",
    "contigs": "select 'chr1' contig union all select '2' union all select 'chr4'",
    "chroms": "select o_orderkey, case o_orderkey % 3 when 0 then concat('chr', cast(o_custkey % 9 as varchar(9))) else cast(o_custkey % 9 as varchar(9)) end chrom from {orders}",
    "calls": """
select l_orderkey, l_linenumber, max(concat(case (l_orderkey * 7 + l_linenumber) % 5 when 0 then '0/1' when 1 then '1|2' when 2 then './1' else '0/0' end,
  ':', cast(l_linenumber as varchar(9)), ',', cast(l_orderkey % 9 as varchar(9)), ',1:', cast(l_partkey as varchar(9)))) call from {lineitem} group by l_orderkey, l_linenumber""",
    "genotypes": """
select substr(chrom, 4, 9) chrom, pos0, end_ end0, pos0 + 1 pos, ref, alt, sample, gt, '99' gq, cast(pos0 % 40 as varchar(9)) dp, case when ad = '.' then null else ad end ad, family from geno""",
    "ranks": """
select 'intron_variant' term, 1 rank union all select 'synonymous_variant', 2 union all select 'splice_region_variant', 3
  union all select 'missense_variant', 4 union all select 'frameshift_variant', 5 union all select 'stop_gained', 6""",
    "post": """
select concat('Brand#', cast(p_size as varchar(9))) ensg, cast(count(*) as bigint) obs_lof, cast(max(p_partkey) as double) exp_lof, cast(min(p_partkey) as double) prior_mean,
  cast(max(p_size) as double) post_mean, 0.0e0 post_lower_95, 1.0e0 post_upper_95 from {part} group by p_size""",
    "scores": "select concat('chr', cast(ps % 3 + 1 as varchar(9))) chrom, ps pos0, 'A' ref, 'G' alt, cast(s as bigint) score from (select l_partkey ps, sum(l_linenumber) s from {lineitem} group by l_partkey) x",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    if name == "genotypes":
        sql = f"with geno as ({VIEWS['geno']}) {sql}"
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql})


def with_views(*names: str) -> str:
    """The views as a WITH clause for DuckDB, where the tables are known by their names."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names)
