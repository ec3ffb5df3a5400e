"""Sources: documents, mapping files, JDBC metadata, catalog metadata, file inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("object_type", "catalog_name", "schema_name", "object_name", "column_name", "data_type")
    ]
)

# Schema of the harvested source columns.
SOURCE_COLUMN_SCHEMA = T.StructType(
    [
        T.StructField("SCHEMA_NAME", T.StringType()),
        T.StructField("VIEW_NAME", T.StringType()),
        T.StructField("COLUMN_NAME", T.StringType()),
        T.StructField("DATA_TYPE_ID", T.IntegerType()),
        T.StructField("DATA_TYPE_NAME", T.StringType()),
    ]
)

# Text of a file that has no description, and how the text of a file that cannot be read begins.
NO_DESCRIPTION = "Descriptions tag not found"
NOT_READ = "Error processing file: "


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """Text files as documents, one row per file. Files are spread over tasks by size."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def read_mapping_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header. Types are inferred, at the cost of a second pass, unless a schema is given."""
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema)
    return spark.read.csv(path, header=True, inferSchema=True)


def view_columns_query(pattern: str) -> str:
    """One query for the columns of all calculation views whose name starts with ``pattern``."""
    prefix = pattern.replace("'", "''")
    return (
        "SELECT c.SCHEMA_NAME, c.VIEW_NAME, c.COLUMN_NAME, c.DATA_TYPE_ID, c.DATA_TYPE_NAME, c.POSITION "
        "FROM SYS.VIEW_COLUMNS c JOIN SYS.VIEWS v ON v.SCHEMA_NAME = c.SCHEMA_NAME AND v.VIEW_NAME = c.VIEW_NAME "
        f"WHERE v.VIEW_TYPE = 'CALC' AND v.VIEW_NAME LIKE '{prefix}%'"
    )


def view_columns_options(url: str, pattern: str, partitions: int = 8, positions: int = 1000, **more: str) -> dict[str, str]:
    """JDBC options: the source joins, and the column position splits the read into parallel queries."""
    return {
        "url": url,
        "dbtable": f"({view_columns_query(pattern)}) view_columns",
        "partitionColumn": "POSITION",
        "lowerBound": "1",
        "upperBound": str(positions),
        "numPartitions": str(partitions),
        **more,
    }


def read_view_columns(spark: SparkSession, url: str, pattern: str, **options: str) -> DataFrame:
    rows = spark.read.format("jdbc").options(**view_columns_options(url, pattern, **options)).load()
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in SOURCE_COLUMN_SCHEMA])


def frame_from_rows(spark: SparkSession, rows: Sequence, schema: T.StructType | Sequence[str]) -> DataFrame:
    """Frame of rows the driver already has, such as parameters or a harvested catalog."""
    return spark.createDataFrame(rows, schema)


def catalog_columns(spark: SparkSession, databases: Sequence[str], catalog: str | None = None) -> DataFrame:
    """Columns of all tables and views of some databases, names and types in upper case.

    A view with the name and columns of a table adds nothing and is left out.
    """
    catalog = catalog or spark.catalog.currentCatalog()
    rows, structures = [], {}
    for database in databases:
        listed = spark.catalog.listTables(f"{catalog}.{database}")
        for table in sorted(listed, key=lambda x: "VIEW" in x.tableType):  # tables first
            kind = "VIEW" if "VIEW" in table.tableType else "TABLE"
            full = table.name if table.isTemporary else f"{catalog}.{database}.{table.name}"
            columns = [(c.name.upper(), c.dataType.upper()) for c in spark.catalog.listColumns(full)]
            name = table.name.upper()
            if structures.get((database, name)) == columns:
                continue
            structures.setdefault((database, name), columns)
            rows += [(kind, catalog, database, name, column, data_type) for column, data_type in columns]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def source_system(file_name: Column) -> Column:
    """System a file comes from, told by its suffix."""
    name = F.lower(file_name)
    return (
        F.when(F.endswith(name, F.lit("calculationview")), "HANA").when(F.endswith(name, F.lit(".html")), "BW").otherwise("Other")
    )


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root``: data flow (first folder), file name and source system. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = F.regexp_replace("path", r"^.*?\Q" + root.rstrip("/").removeprefix("file:") + r"\E/", "")
    named = files.select("path", below.alias("below")).withColumn("FileName", F.element_at(F.split("below", "/"), -1))
    flow = F.when(F.contains("below", F.lit("/")), F.get(F.split("below", "/"), F.lit(0)))
    return named.select(flow.alias("DataFlow"), "FileName", source_system(F.col("FileName")).alias("SourceSystem"), "path")


def xml_error(xml: Column) -> Column:
    """What is wrong with an XML document; NULL for a well-formed one.

    Documents are parsed in permissive mode, so a bad one is a value of its row and fails no task. A document type declaration is
    not read: its entities count as errors. A byte order mark is skipped.
    """
    return _checked(xml)[0]


def _checked(xml: Column) -> tuple[Column, Column]:
    """(error, document inside an element of ours), the latter safe to query where there is no error."""

    def corrupt(c: Column) -> Column:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
        return F.from_xml(c, "corrupt string", options)["corrupt"].isNotNull()

    text = F.regexp_replace(xml, "^\ufeff", "")
    # the parser stops behind the first element; inside an element whose name no document foresees, what follows is seen as well
    name = F.concat(F.lit("all"), F.hex(F.xxhash64(text)))
    body = F.regexp_replace(text, r"^<\?xml\b[^>]*\?>", "")
    wrapped = F.concat(F.lit("<"), name, F.lit(">"), body, F.lit("</"), name, F.lit(">"))
    single = F.xpath_boolean(wrapped, F.lit("count(/*/*) = 1 and not(/*/text()[normalize-space() != ''])"))
    error = (
        F.when(xml.isNull() | F.rlike(text, F.lit(r"^\s*$")), "no element found")
        .when(corrupt(text) | corrupt(wrapped), "not well-formed")
        .when(~single, "junk after document element")
    )
    return error, wrapped


def xml_attribute(xml: Column, element: str, attribute: str, default: str = NO_DESCRIPTION) -> Column:
    """An attribute of the first such element, whatever its namespace prefix; ``default`` without element, an error text for a bad document."""
    path = f"//*[local-name()='{element}'][1]/@{attribute}"
    error, wrapped = _checked(xml)
    found = F.get(F.xpath(wrapped, F.lit(path)), F.lit(0))
    return F.when(error.isNotNull(), F.concat(F.lit(NOT_READ), error)).otherwise(F.coalesce(found, F.lit(default)))


def inventory_with_descriptions(spark: SparkSession, root: str) -> DataFrame:
    """File inventory with the default description found in each file, or what is wrong with the file. Spark's readers do not list files of no bytes."""
    docs = read_docs(spark, root)
    described = docs.select("path", xml_attribute(F.col("text"), "descriptions", "defaultDescription").alias("Description"))
    files = file_inventory(spark, root)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    keyed = described.withColumn("key", plain("path")).drop("path")
    return files.withColumn("key", plain("path")).join(keyed, "key", "inner").drop("key", "path")


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
