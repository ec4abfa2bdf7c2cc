"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlens.plans.shared import fresh_path

from . import (
    decontamination,
    fill_in_middle,
    fuzzy_passages,
    language_id,
    licenses,
    line_runs,
    mixing,
    near_dedup,
    nearest,
    pii,
    secret_scan,
    token_output,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(_documents(spark, sf_dir), near_dedup.Settings(width=2))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(_documents(spark, sf_dir), benchmark)


def _fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_passages.shared_passages(_documents(spark, sf_dir))


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(
        spark.read.parquet(f"{sf_dir}/embeddings.parquet"), chosen=F.col("vec_id") % 20 == 0
    )


def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language_id.learn(docs.where(~language_id.held_out()))
    return language_id.predict(docs, model).withColumn("held_out", language_id.held_out())


def _pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_documents(spark, sf_dir)))


def _line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    left = line_runs.without_runs(docs, line_runs.repeated_runs(docs))
    digest = F.sha2(F.col("text"), 256).alias("text_sha256")
    return left.select("doc_id", "n_deleted", "n_runs", "longest_run", digest)


def _licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files in a tree of source, language and thousands of ids.

    Of a hundred ids one lies at the top of its source and nine at that of their language,
    whatever the size of the table.  A document that begins or ends with a statement
    speaks for its directory, as a licence file does.
    """
    docs = _documents(spark, sf_dir)
    turn = F.pmod("doc_id", F.lit(100))
    language = F.when(turn > 0, F.coalesce("lang", F.lit("und")))
    thousand = F.when(turn > 9, F.expr("cast(doc_id div 1000 as string)"))
    path = F.concat_ws("/", "source", language, thousand, F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix in the order of training; documents that it does not take come last."""
    mixed = mixing.in_order(mixing.mix(_documents(spark, sf_dir)))
    position = F.round("position", 9).alias("position")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", position)


def _token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token_segments")
    token_output.write(_documents(spark, sf_dir), path, token_output.default_tokenizer())
    return token_output.read(spark, path)


def _fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.transform(_documents(spark, sf_dir)))


def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return secret_scan.digest(secret_scan.find(docs, secret_scan.default_vocabulary()))


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": _decontamination,
        "op2_fuzzy_passages": _fuzzy_passages,
        "op3_nearest": _nearest,
        "op4_language_id": _language_id,
        "op5_line_runs": _line_runs,
        "op6_near_dedup": _near_dedup,
        "op7_pii": _pii,
        "op8_licenses": _licenses,
        "op9_mixing": _mixing,
        "op10_token_output": _token_output,
        "op11_fill_in_middle": _fill_in_middle,
        "op12_whitening": _whitening,
        "op13_secrets": _secrets,
    }


_MIXING_SQL = """
WITH sizes AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, sum(size) AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 - 1 AS DOUBLE) / 2 AS slope
  FROM sizes GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER ()
             - 3 * coalesce(sum(source_size) OVER (
                 ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER ()
               - coalesce(sum(weight) OVER (
                   ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            AS level
  FROM totals
), targets AS (
  SELECT source, source_size, slope, least(3.0 * source_size, max(level) OVER () * weight) AS target
  FROM levels
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, CAST(t.target AS DOUBLE) AS target, t.slope,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), counted AS (
  SELECT *, CAST(least(greatest(round(target) - place, 0), size)
               + least(greatest(round(target) - place - source_size, 0), size)
               + least(greatest(round(target) - place - 2 * source_size, 0), size) AS BIGINT) AS taken,
         CAST(place AS DOUBLE) / target AS done
  FROM placed
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, taken,
       round(CASE WHEN taken > 0 THEN CASE WHEN done <= 0 THEN 0.0 ELSE least(1.0,
         2 * done / (1 - slope + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * done, 0.0)))) END END, 9)
         AS position
FROM counted
"""


_FILL_IN_MIDDLE_SQL = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h,
         regexp_extract_all(coalesce(text, ''),
                            '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS one,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS two,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT *, array_to_string(u[1:least(one, two)], '') AS prefix,
         array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS middle,
         array_to_string(u[greatest(one, two) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_mixing": _MIXING_SQL, "op11_fill_in_middle": _FILL_IN_MIDDLE_SQL}
