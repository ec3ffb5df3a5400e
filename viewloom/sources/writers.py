"""Sinks: managed tables, run parameters, dated output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Columns of the run-parameter table.
RUN_PARAMETERS_DDL = (
    "RUN_ID INT NOT NULL, DOMAIN STRING NOT NULL, PARAMS_JSON STRING NOT NULL, COMMENT STRING, INSERTED_AT TIMESTAMP"
)
RUN_PARAMETERS_COMMENT = "Snapshot of parameters from run_param for each workflow run"

LINEAGE_DDL = (
    "TARGET_TABLE_NAME STRING, TARGET_COLUMN_NAME STRING, SOURCE_TABLE_NAME STRING, SOURCE_COLUMN_NAME STRING, "
    "TRANSFORMATION STRING"
)


def save(df: DataFrame, name: str) -> None:
    """Overwrite a managed table."""
    df.write.mode("overwrite").saveAsTable(name)


def ensure_table(spark: SparkSession, name: str, columns: str, comment: str = "", replace: bool = False) -> None:
    """Create a table from a column list; ``replace`` drops an existing one first."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    text = comment.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet COMMENT '{text}'")


def snapshot_params(params: DataFrame, run_id: int, domain: str, comment: str | None = None) -> DataFrame:
    """Parameter rows as JSON rows of the run-parameter table."""
    return params.select(
        F.lit(run_id).cast("int").alias("RUN_ID"),
        F.lit(domain).alias("DOMAIN"),
        F.to_json(F.struct("*")).alias("PARAMS_JSON"),
        F.lit(comment).cast("string").alias("COMMENT"),
        F.current_timestamp().alias("INSERTED_AT"),
    )


def write_dated(df: DataFrame, path: str, run_date: str) -> None:
    """Add the output of one run as a ``run_date`` partition; a repeated run replaces its own partition."""
    dated = df.withColumn("run_date", F.lit(run_date))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)
