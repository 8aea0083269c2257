"""Report files. Tables stay distributed: each becomes its own JSON-lines folder,
and the graph text is written in sorted parts that concatenate to one document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The notices every report carries.
DISCLAIMER_ZH = "統計 ≠ 法律事實"
DISCLAIMER_EN = "Statistics are not legal facts."


def histogram_column(histogram: DataFrame) -> DataFrame:
    """A histogram (a handful of rows) as one array value in bucket order."""
    return histogram.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("position", "bucket", "n"))),
            lambda r: F.struct(r["bucket"].alias("bucket"), r["n"].alias("n")),
        ).alias("buckets")
    )


def report_summary(run_id: str, funnel: DataFrame, histograms: dict[str, DataFrame]) -> DataFrame:
    """One row: notices, the run, its funnel and its histograms."""
    row = funnel.select(
        F.lit(DISCLAIMER_ZH).alias("disclaimer"),
        F.lit(DISCLAIMER_EN).alias("disclaimer_en"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.struct(*[c for c in funnel.columns if c != "pipeline_run_id"]).alias("funnel"),
    )
    for name, histogram in histograms.items():
        row = row.withColumn(name, histogram_column(histogram).scalar())
    return row


def export_report_json(summary: DataFrame, tables: dict[str, DataFrame], path: str) -> None:
    """``summary/`` holds the one-row overview, every other folder one table."""
    for name, df in {"summary": summary, **tables}.items():
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")


def dot_lines(edges: DataFrame) -> DataFrame:
    """Graph text as ``(part, weight, src, dst, line)``; sort by the first four
    (weight descending) to read it as a document."""
    quoted = lambda c: F.concat(
        F.lit('"'), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')
    )
    body = edges.select(
        F.lit(1).alias("part"),
        "weight",
        F.col("src_store_id").alias("src"),
        F.col("dst_store_id").alias("dst"),
        F.concat(
            F.lit("  "), quoted("src_store_id"), F.lit(" -- "), quoted("dst_store_id"),
            F.lit(" [label="), F.col("weight").cast("string"), F.lit("];"),
        ).alias("line"),
    )
    empty = "CAST(NULL AS BIGINT) AS weight, CAST(NULL AS STRING) AS src, CAST(NULL AS STRING) AS dst"
    frame = edges.sparkSession.range(1).selectExpr(
        f"inline(array(struct(0 AS part, {empty}, 'graph {{\n  graph [overlap=false];' AS line),"
        f" struct(2 AS part, {empty}, '}}' AS line)))"
    )
    return body.unionByName(frame)


def export_edges_dot(edges: DataFrame, path: str) -> None:
    dot_lines(edges).orderBy("part", F.desc("weight"), "src", "dst").select("line").write.mode("overwrite").text(path)
