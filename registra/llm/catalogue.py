"""Named queries of the training-data operators on texts and names, and the same in SQL where SQL can say it."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.functions import text as T
from registra.llm import leaks
from registra.llm.bpe import BytePairs
from registra.llm.codepoints import consistent_names
from registra.llm.leaks import contained_passages
from registra.llm.names import name_clusters, variant_pairs
from registra.llm.stuffed import stuffed_pages
from registra.llm.survivors import judged_values, merged_records, representatives
from registra.plans.register import DAY, LICENCE, YEAR, delivered, delivered_columns
from registra.plans.register_sql import DECIMAL, ISO, RECORD_COLUMNS, missing, whole
from registra.session import table

NAMES = ["business_name", "business_trade_name"]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Names that hold a disguised character."""
    names = consistent_names(table(spark, folder, "curated_licence"), ["licence_rsn"], NAMES)
    odd = F.array_compact(F.array(*[F.when(F.col(f"{c}__odd"), F.lit(c)) for c in NAMES]))
    return names.select("licence_rsn", F.explode(odd).alias("field"))


def p2_names(spark: SparkSession, folder: str) -> DataFrame:
    """All names in consistent form."""
    return consistent_names(table(spark, folder, "curated_licence"), ["licence_rsn"], NAMES).select("licence_rsn", *NAMES)


def holder_names(spark: SparkSession, folder: str) -> DataFrame:
    """The name each row is known by, in consistent form and lower case."""
    names = consistent_names(table(spark, folder, "curated_licence"), ["licence_rsn"], NAMES)
    return names.select("licence_rsn", F.lower(F.coalesce(*NAMES)).alias("name"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of one holder under different spellings."""
    return variant_pairs(holder_names(spark, folder), "licence_rsn", "name")


def p3_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Each spelling that has a variant, with the least spelling of its holder and the number of spellings."""
    stars = name_clusters(holder_names(spark, folder), "name")
    heads = stars.groupBy("center").agg(F.min("name").alias("holder"), F.count(F.lit(1)).alias("spellings"))
    return stars.join(heads, "center").select("name", "holder", "spellings")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The row that stands for each licence delivered more than once."""
    rows = delivered(spark, folder)
    columns = delivered_columns(rows)
    order = [D.iso_instant(F.col("extractdate")), F.when(~T.is_missing(F.col("licencerevisionnumber")), T.number(F.col("licencerevisionnumber")))]
    picked = representatives(rows, LICENCE, "record_no", columns, order)
    return picked.filter("n > 1").select(F.col(LICENCE).alias("licence_rsn"), "record_no")


def _judged(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """The judged values of every column as delivered beside the key, and those columns."""
    rows = delivered(spark, folder)
    columns = delivered_columns(rows, "licencersn")
    load = F.when(F.col(YEAR).isNotNull() & F.col(DAY).isNotNull(), F.concat_ws("/", F.col(YEAR).cast("string"), D.iso_day(F.col(DAY))))
    return judged_values(rows.withColumn("__load", load), LICENCE, "__load", columns), columns


def p6_values(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of every licence judged true, with its probability."""
    return _judged(spark, folder)[0].filter("_p >= 0.5").select(F.col("_key").alias("licence_rsn"), F.col("_field").alias("column_name"), F.col("_value").alias("value"), F.col("_sources").alias("loads"), F.round("_p", 4).alias("probability"))


def p6_merged(spark: SparkSession, folder: str) -> DataFrame:
    """One merged record per licence: the values judged true, field by field."""
    return merged_records(*_judged(spark, folder)).withColumnRenamed("_key", "licence_rsn")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every document's text."""
    return BytePairs().encode(table(spark, folder, "documents"))


def p8_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Every text after encoding and decoding."""
    codec = BytePairs()
    return codec.encode(table(spark, folder, "documents")).select("doc_id", codec.decode(F.col("ids")).alias("text"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The leaks with the share of the item's ten-word runs that the document holds."""
    found = contained_passages(table(spark, folder, "documents"), "doc_id", table(spark, folder, "eval_items"), "item_id")
    return found.select("doc_id", "item_id", F.round("share", 6).alias("share"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Which document leaks which item."""
    return contained_passages(table(spark, folder, "documents"), "doc_id", table(spark, folder, "eval_items"), "item_id").select("doc_id", "item_id")


def p10_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's evidence and score."""
    return stuffed_pages(table(spark, folder, "documents"), "doc_id", table(spark, folder, "page_labels"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Keyword-stuffed pages, link lists and tag lists."""
    return p10_scores(spark, folder).filter("score > 0").select("doc_id")


QUERIES = {
    "p2_found": p2_found, "p2_names": p2_names, "p3_found": p3_found, "p3_clusters": p3_clusters, "p6_found": p6_found, "p6_values": p6_values, "p6_merged": p6_merged, "p8_ids": p8_ids, "p8_decoded": p8_decoded,
    "p9_found": p9_found, "p9_shares": p9_shares, "p10_found": p10_found, "p10_scores": p10_scores,
}



def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_ENTITIES = "MAP {" + ", ".join(f"{_sql_text('&' + k)}: {_sql_text(v)}" for k, v in html5.items()) + "}"


def _pieces_sql(t: str, pattern: str, body: str) -> str:
    """``t`` with each piece that ``pattern`` or what lies between takes replaced by ``body`` of ``x``."""
    return f"array_to_string(list_transform(regexp_extract_all({t}, {_sql_text(pattern)}), lambda x: {body}), '')"


def _code_sql(digits: str) -> str:
    return f"case when try_cast({digits} as bigint) between 55296 and 57343 or coalesce(try_cast({digits} as bigint), 1114112) > 1114111 then ' ' else chr(try_cast({digits} as int)) end"


def _words_sql(source: str, key: str, breaks: bool) -> str:
    """Undressed words of a table's texts, in DuckDB: the steps of ``leaks.undress`` one after the other."""
    hexed = _code_sql("('0x' || substr(x, 3))")
    escaped = _pieces_sql("t", r"\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}|\\U[0-9a-fA-F]{8}|[^\\]+|\\", f"case when regexp_matches(x, '^\\\\[uxU][0-9a-fA-F]+$') then {hexed} else x end")
    broken = f"regexp_replace({escaped}, {_sql_text(leaks.BREAK if breaks else r'\\[nrt]([^a-z]|$)')}, {"' '" if breaks else _sql_text(' ' + chr(92) + '1')}, 'g')"
    percent = _pieces_sql("t", r"(?:%[0-9a-fA-F]{2})+|[^%]+|%", "case when regexp_matches(x, '^%[0-9a-fA-F]{2}') then coalesce(try(url_decode(x)), x) else x end")
    tags = f"regexp_replace(regexp_replace(regexp_replace(t, {_sql_text(leaks.COMMENT)}, '', 'g'), {_sql_text(leaks.INLINE)}, '', 'g'), {_sql_text(leaks.TAG)}, ' ', 'g')"
    number = _code_sql("case when lower(x[3:3]) = 'x' then '0x' || regexp_replace(x[4:], ';', '') else regexp_replace(x[3:], ';', '') end")
    named = _pieces_sql("t", r"&#?[0-9A-Za-z]+;?|[^&]+|&", f"case when regexp_matches(x, '^&#([0-9]+|[xX][0-9a-fA-F]+);?$') then {number} else coalesce(m[x], x) end")
    unseen = "t, " + _sql_text(leaks.UNSEEN) + ", '', 'g'"
    out = f"(select row_number() over () as r, {key} as k, text as t from {source})"
    for step in (broken, percent, tags, named, tags, named, f"nfc_normalize(regexp_replace({unseen}))"):
        out = f"(select r, k, m, {step} as t from {out} s)" if " m," in out else f"(select r, k, m, {step} as t from {out} s, entities)"
    return f"select r, k, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') as w from {out} s where t is not null"


def _runs_sql(source: str, key: str) -> str:
    both = f"{_words_sql(source, key, True)} union all {_words_sql(source, key, False)}"
    return f"select distinct r, k, unnest(list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' '))) as run from ({both})"


LEAKS = f"""with entities as (select {_ENTITIES} as m), dr as ({_runs_sql("documents", "doc_id")}), ir as ({_runs_sql("eval_items", "item_id")}),
  n as (select r, count(*) as n from ir group by 1),
  hit as (select dr.r as dr, dr.k as doc_id, ir.r as ir, ir.k as item_id, count(*) as c from dr join ir using (run) group by all)"""

SQL = {
    "p6_found": f"""with r as (select record_no, {whole("licencersn")} as k, {" + ".join(f"cast({missing(c)} as int)" for c in RECORD_COLUMNS)} as miss,
      case when regexp_matches(trim(extractdate), '{ISO}') then try_cast(trim(extractdate) as timestamptz) when regexp_matches(trim(extractdate), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then try_cast(trim(extractdate) || 'T00:00:00Z' as timestamptz) end as x,
      case when not {missing("licencerevisionnumber")} and regexp_matches(licencerevisionnumber, '{DECIMAL}') then try_cast(trim(licencerevisionnumber, ' \t\n\r') as double) end as rev from records)
    select k as licence_rsn, record_no from r where k is not null
    qualify count(*) over (partition by k) > 1 and row_number() over (partition by k order by miss, x desc nulls last, rev desc nulls last, record_no) = 1""",
    "p9_found": f"{LEAKS} select doc_id, item_id from hit",
    "p9_shares": f"{LEAKS} select doc_id, item_id, round(c / n, 6) as share from hit join n on n.r = hit.ir",
    "p8_decoded": "select doc_id, coalesce(text, '') as text from documents",
}
