"""Jobs over column metadata and field mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from viewloom.functions import scalar as fn
from viewloom.functions.similarity import similarity
from viewloom.operators.names import match_names
from viewloom.operators.relational import with_key_count
from viewloom.operators.scans import Ordering, numbered

# Columns of the reconciliation report.
REPORT = (
    "CatalogSchema",
    "TableNameDbx",
    "CalcViewName",
    "ColumnNameDbx",
    "ColumnNameSAP",
    "DataTypeDbx",
    "DataTypeSAP",
    "DataTypeMatch",
)

# Fields of a mapping record, and the column names of the mapping sheet they come from.
MAPPING_FIELDS = {
    "used_by": "Used_by",
    "base_cv": "Base SAP CV - equivalent of DBX Table",
    "sap_field": "SAP Field Name",
    "dbx_field": "DBX Field name",
    "dbx_table": "DBX Table",
    "comments": "Comments",
}


def split_object(df: DataFrame, column: str = "SLO_Object") -> DataFrame:
    """``cat{ENV}.schema.table`` to three columns."""
    return df.withColumns(
        {
            "CatalogName": fn.part(column, r"\{ENV\}", 0),
            "SchemaName": fn.part(column, r"\.", 1),
            "TableName": fn.part(column, r"\.", 2),
        }
    )


def view_leaf(df: DataFrame, column: str = "VIEW_NAME", out: str = "CalculationViewName") -> DataFrame:
    """View name behind the package."""
    return df.withColumn(out, F.trim(fn.part(column, "/", 1)))


def source_columns(columns: DataFrame, objects: DataFrame) -> DataFrame:
    """Distinct source columns of the views in scope, with the table each view maps to."""
    unique = columns.select("CalculationViewName", "COLUMN_NAME", "DATA_TYPE_NAME").distinct()
    scope = objects.filter(F.col("Table_ID") != "").select("TableName", "Decoupling_View").distinct()
    joined = unique.join(scope, F.col("CalculationViewName") == F.col("Decoupling_View"), "inner")
    return joined.select("CalculationViewName", "TableName", "COLUMN_NAME", "DATA_TYPE_NAME").distinct()


def target_columns(columns: DataFrame, objects: DataFrame) -> DataFrame:
    """Target columns of the tables in scope."""
    # a table that several objects name has its columns once per object, as the report lists them
    scope = objects.filter(F.col("TableName").isNotNull()).select(F.upper("TableName").alias("object_name"))
    return columns.join(scope, "object_name", "inner")


def reconcile_types(source: DataFrame, target: DataFrame) -> DataFrame:
    """Full outer join of both column lists with a three-valued type match."""
    s = source.select(
        F.col("CalculationViewName").alias("CalcViewName"),
        F.upper("TableName").alias("TableName"),
        F.col("COLUMN_NAME").alias("ColumnNameSAP"),
        F.col("DATA_TYPE_NAME").alias("DataTypeSAP"),
    )
    t = target.select(
        F.col("object_name").alias("ObjectName"),
        F.col("column_name").alias("ColumnNameDbx"),
        fn.strip_precision("data_type").alias("DataTypeDbx"),
        fn.cat("catalog_name", F.lit("."), "schema_name").alias("CatalogSchema"),
    )
    same = (F.col("TableName") == F.col("ObjectName")) & (F.col("ColumnNameSAP") == F.col("ColumnNameDbx"))
    both = s.join(t, same, "full_outer").withColumn("TableNameDbx", F.coalesce("ObjectName", "TableName"))
    return both.withColumn("DataTypeMatch", fn.type_match("DataTypeDbx", "DataTypeSAP")).select(*REPORT)


def match_columns(report: DataFrame, rule: str, keep_existing: bool = False) -> DataFrame:
    """Add ``MatchedColumnDbx``: a similar target column for source columns that found no equal one."""
    open_rows = report.filter(F.col("ColumnNameDbx").isNull()).select("ColumnNameSAP")
    found = match_names(open_rows, report.select("ColumnNameDbx"), rule)
    named = report.join(found.hint("merge"), report["ColumnNameSAP"] == found["name"], "left")
    existing = F.col("ColumnNameDbx") if keep_existing else F.lit(None)
    matched = F.when(F.col("ColumnNameDbx").isNull(), F.col("matched")).otherwise(existing)
    return named.select(*report.columns, matched.alias("MatchedColumnDbx"))


def filter_ambiguous(rows: DataFrame, source: str = "ColumnNameSAP", target: str = "ColumnNameDbx") -> DataFrame:
    """Keep rows without source, with a target, or whose source occurs once."""
    counted = with_key_count(rows, source)
    keep = F.col(source).isNull() | (F.col("cnt") == 1) | F.col(target).isNotNull()
    # a NULL source has no count, but is kept by the first test
    return counted.filter(keep).drop("cnt")


def rematch_types(report: DataFrame, target: DataFrame) -> DataFrame:
    """Type of the matched column of the same table, and the type match evaluated with it."""
    types = target.select(
        F.col("object_name").alias("TableNameDbx"),
        F.col("column_name").alias("MatchedColumnDbx"),
        fn.strip_precision("data_type").alias("DataTypeDbxMatched"),
    )
    # one type per column, as in a lookup table
    types = types.groupBy("TableNameDbx", "MatchedColumnDbx").agg(F.max("DataTypeDbxMatched").alias("DataTypeDbxMatched"))
    joined = report.join(types, ["TableNameDbx", "MatchedColumnDbx"], "left")
    return joined.withColumn("DataTypeMatchAfterMatch", fn.type_match("DataTypeDbxMatched", "DataTypeSAP"))


# --- field mappings ---------------------------------------------------------------------------


def fuzzy_pairs(records: DataFrame, source: str, target: str, threshold: float = 0.6) -> DataFrame:
    """Records whose two names are similar, but not equal."""
    scored = records.withColumn("Similarity_Score", similarity(F.col(source), F.col(target)))
    near = (F.col("Similarity_Score") >= threshold) & (F.col("Similarity_Score") < 1.0)
    return scored.filter(near).withColumns(
        {"Similarity_Score": F.round("Similarity_Score", 3), "Match_Type": F.lit("Fuzzy")}
    )


def _chunk(ordinal: str) -> Column:
    # at most this many sheet rows meet in one task
    return F.floor(F.col(ordinal) / 100_000)


def align_mapping(sheet: DataFrame, ordinal: str = "row_no", sheet_name: str = "sheet") -> DataFrame:
    """Sheet rows to mapping records.

    Rows belong to a view by sheet and ``used_by``; views are numbered per sheet in order of appearance.
    Per view each field becomes a list of its distinct values in order of appearance, and the i-th values
    of all fields make record i. Short lists are padded: base view and table with their first value, other
    fields with a blank.
    """
    rows = sheet.filter(F.col("used_by").isNotNull()).withColumn("used_by", F.trim("used_by"))
    firsts = rows.groupBy(sheet_name, "used_by").agg(F.min(ordinal).alias("__first"))
    views = numbered(firsts, Ordering((sheet_name,), ("__first",), chunk=_chunk("__first")), "view_no")

    fields = list(MAPPING_FIELDS)
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]))
    cells = rows.select(sheet_name, F.col("used_by").alias("__view"), ordinal, values.alias("__cell"))
    cells = cells.select(sheet_name, "__view", ordinal, "__cell.*").filter(F.col("value").isNotNull())
    keys = (sheet_name, "__view", "field")
    lists = cells.groupBy(*keys, "value").agg(F.min(ordinal).alias("__first"))
    placed = numbered(lists, Ordering(keys, ("__first",), chunk=_chunk("__first")), "position")

    wide = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    records = placed.groupBy(sheet_name, "__view", "position").agg(*wide)
    defaults = records.filter(F.col("position") == 1).select(
        sheet_name, "__view", F.col("base_cv").alias("__base"), F.col("dbx_table").alias("__table")
    )
    numbers = views.select(sheet_name, F.col("used_by").alias("__view"), "view_no")
    full = records.join(defaults, [sheet_name, "__view"], "left").join(numbers, [sheet_name, "__view"], "inner")
    padding = {"base_cv": F.coalesce("__base", F.lit("")), "dbx_table": F.coalesce("__table", F.lit(""))}
    view = F.concat(F.lit("calculation_view_"), F.col(sheet_name), F.lit("_"), F.col("view_no").cast("string"))
    return full.select(
        view.alias("view"), "position", *[F.coalesce(F.col(f), padding.get(f, F.lit(""))).alias(f) for f in fields]
    )


def build_lookup(records: DataFrame, source: str, target: str, ordinal: str, fold: bool = True) -> DataFrame:
    """Old name to new name; blank names are skipped and the last record wins."""
    old, new = F.trim(source), F.trim(target)
    rows = records.select((F.upper(old) if fold else old).alias("key"), new.alias("value"), F.col(ordinal).alias("ordinal"))
    rows = rows.filter((F.col("key") != "") & (F.col("value") != ""))
    return rows.groupBy("key").agg(F.min("ordinal").alias("ordinal"), F.max_by("value", "ordinal").alias("value"))


def describe_fields(fields: DataFrame, field: str, descriptions: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Description per field: by lower-case name, else by the name without underscores.

    ``descriptions`` has the columns ``key``, ``value`` and an ordinal. The last value of a key counts; among
    keys that differ in underscores only, the first one does.
    """
    known = descriptions.filter((F.col("key") != "") & (F.col("value") != ""))
    exact = known.groupBy(F.lower("key").alias("__exact")).agg(
        F.min(ordinal).alias("__first"), F.max_by("value", ordinal).alias("__by_name")
    )
    loose = exact.groupBy(F.replace("__exact", F.lit("_"), F.lit("")).alias("__loose")).agg(
        F.min_by("__by_name", "__first").alias("__by_core")
    )
    name = F.trim(F.lower(field))
    keyed = fields.withColumns({"__exact": name, "__loose": F.replace(name, F.lit("_"), F.lit(""))})
    joined = keyed.join(exact.drop("__first"), "__exact", "left").join(loose, "__loose", "left")
    return joined.select(*fields.columns, F.coalesce("__by_name", "__by_core").alias("description"))


def table_health(spark: SparkSession, names: Sequence[str], environment: str = "") -> DataFrame:
    """Per table: ``has data``, ``empty`` or ``error`` when it is missing or cannot be read.

    One row of each table is read while the audit runs, so that a table without permission or with lost files is reported and the others go on.
    """
    found = []
    for name in names:
        full = name.replace("{ENV}", environment)
        try:
            status = "has data" if spark.table(full).take(1) else "empty"
        except PySparkException:
            status = "error"
        found.append((environment, full, status))
    return spark.createDataFrame(found, "environment string, table_name string, status string")
