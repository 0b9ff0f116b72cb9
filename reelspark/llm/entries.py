"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam, lang_svm, pfair_mix, quality_gbt, quality_qda, simhash_pivot, site_style, token_prefix, url_bloom, warc
from ._common import ship, spread, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spread(table(spark, sf_dir, "documents"))
    return quality_gbt.quality_rules(docs, quality_gbt.train(docs, table(spark, sf_dir, "labels")))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return site_style.extract(spread(table(spark, sf_dir, "pages")))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash_pivot.near_duplicates(spread(table(spark, sf_dir, "documents")))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return url_bloom.filter_urls(spread(table(spark, sf_dir, "pages")), url_bloom.listed_table(spark))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return token_prefix.count_tokens(spread(table(spark, sf_dir, "documents")))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spread(table(spark, sf_dir, "documents"))
    return quality_qda.classify(docs, quality_qda.train(docs, table(spark, sf_dir, "labels")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontam.contaminated(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spread(table(spark, sf_dir, "documents"))
    return lang_svm.identify(docs, lang_svm.train(docs))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return pfair_mix.mix(table(spark, sf_dir, "documents"), pfair_mix.WEIGHTS)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return warc.archive_round_trip(spread(table(spark, sf_dir, "pages")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    every = (op1_quality_rules, op2_html_extraction, op3_simhash, op4_url_filter, op5_token_counts, op6_quality_classifier, op7_decontamination, op8_language_id, op9_source_mix, op10_warc, pipeline)
    return {f.__name__: f for f in every}


def _op4_sql() -> str:
    rules = sorted(url_bloom.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, kind) for kind, h, p in rules]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{name}'" for c, name, _ in fits) + " END"
    kind = "CASE " + " ".join(f"WHEN {c} THEN '{k}'" for c, _, k in fits) + " END"
    names = lambda words: "unnest([" + ", ".join(f"'{w}'" for w in words) + "])"
    tracked = " OR ".join(f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path || coalesce(query, ''), '/{p}'))" for h, _, p in (e.partition("/") for e in url_bloom.TRACKERS))
    return f"""
    WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
    parts AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                     coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, regexp_extract(rest, '^[^?#]*(\\?[^#]*)', 1) AS query FROM rest),
    listed AS (SELECT a || '-' || b || '.' || z AS site FROM (SELECT {names(url_bloom.FIRST)} AS a), (SELECT {names(url_bloom.LAST)} AS b), (SELECT {names(url_bloom.ZONES)} AS z)),
    judged AS (SELECT *, regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) IN (SELECT site FROM listed) OR {tracked} AS found FROM parts)
    SELECT page_id, host, path, {rule} AS rule, coalesce({kind}, CASE WHEN found THEN 'block' ELSE 'allow' END) AS verdict FROM judged"""


def _op10_sql() -> str:
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = [f"CAST('0x' || substr(hex, {1 + 10 * g}, 10) AS UBIGINT)" for g in range(4)]
    base32 = " || ".join(f"substr('{alphabet}', CAST(({v} // {1 << s}) % 32 AS INTEGER) + 1, 1)" for v in ("a", "b", "c", "d") for s in range(35, -1, -5))
    return f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    h AS (SELECT page_id, strlen(body) AS n, sha1(body) AS hex FROM p),
    v AS (SELECT page_id, n, hex, {groups[0]} AS a, {groups[1]} AS b, {groups[2]} AS c, {groups[3]} AS d FROM h),
    k AS (SELECT page_id, n, {base32} AS digest, max(page_id) OVER (PARTITION BY hex) AS kept FROM v)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> kept THEN kept END AS refers_to FROM k"""


def oracle_sql() -> dict[str, str]:
    out = {"op4_url_filter": _op4_sql(), "op10_warc": _op10_sql()}
    import corpus_pipeline

    return out | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
