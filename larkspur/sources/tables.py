"""Reading and publishing tables and files."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from larkspur.functions.text import missing_to_null
from larkspur.session import new_path


def resolve(spark, name, database=None):
    """``database.table`` of a catalog table; an error when there is none."""
    full = f"{database}.{name}" if database else name
    if not spark.catalog.tableExists(full):
        raise LookupError(f"no table {full}")
    return full


def read_table(spark, name, database=None):
    return spark.table(resolve(spark, name, database))


def read_csv(spark, path, schema, header=True, missing_texts=True, line_breaks=False):
    """Every CSV file below ``path`` with one fixed schema; short rows get NULL at the end.

    ``missing_texts`` reads the usual words for a missing value as NULL. ``line_breaks`` allows line
    breaks inside quotes; such a file cannot be divided among tasks.
    """
    raw = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("mode", "PERMISSIVE")
        .option("multiLine", line_breaks)
        .option("escape", '"')
        .csv(path)
    )
    if not missing_texts:
        return raw
    texts = [f.name for f in raw.schema if isinstance(f.dataType, T.StringType)]
    return raw.withColumns({c: missing_to_null(F.col(c)) for c in texts})


def read_csv_tables(spark, paths):
    """Union of CSV files with unlike headers, by column name, all text.

    Every file has its own header; files of one directory may differ. All are read at once, by position, and each row meets
    its file's header, so there is no plan, list or row per file on the driver: only the distinct column names come there. A name
    that a header holds twice means its first column; a column without a name is left out. A file without any line adds nothing.
    The header's lines are found by a scan of their own.
    """
    paths = list(paths)
    if not paths:
        raise ValueError("no paths to read")
    heads = headers(spark, paths)
    width, names = heads.agg(F.max(F.size("names"))).first()[0] or 0, column_names(heads, paths)
    if not names:
        raise ValueError("no header in any file")
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("escape", '"').csv(paths)
    rows = rows.select(F.array(*schema.names).alias("values"), F.col("_metadata.file_path").alias("file"))
    both = rows.join(heads, "file")
    cell = lambda name: F.get("values", F.array_position("names", F.lit(name)).cast("int") - 1)
    return both.select(*[missing_to_null(cell(n)).alias(n) for n in names])


def headers(spark, paths):
    """file and names of the CSV files below ``paths``: a table with a row per file, written to the shared folder."""
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))
    found, out = new_path(spark, "csv-lines"), new_path(spark, "csv-headers")
    first.write.parquet(found)
    first = spark.read.schema("file string, line string").parquet(found)
    # Commas inside quotes make a header narrower than this, never wider.
    most = first.agg(F.max(F.length("line") - F.length(F.replace("line", F.lit(",")))) + 1).first()[0] or 1
    parsed = F.from_csv(F.regexp_replace("line", "^\ufeff", ""), ", ".join(f"c{i} string" for i in range(most)), {"escape": '"'})
    first.select("file", parsed.alias("p")).select("file", F.array(*[f"p.c{i}" for i in range(most)]).alias("names")).write.parquet(out)
    return spark.read.schema("file string, names array<string>").parquet(out)


def column_names(heads, paths):
    """The distinct names of all headers, in the order of the paths, of the headers of a path, and of the names in a header."""
    nth = F.array_position(F.transform(F.array(*map(F.lit, paths)), lambda p: F.contains("file", p)), F.lit(True))
    every = heads.select(nth.alias("nth"), "names", F.posexplode("names").alias("i", "name")).where("name is not null")
    return [r["name"] for r in every.groupBy("name").agg(F.min(F.struct("nth", "names", "i")).alias("at")).orderBy("at").collect()]


def read_any(spark, path, schema):
    """Parquet below ``path/data.parquet`` if it is there, else CSV below ``path/data.csv``."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/data.parquet")
    except AnalysisException:
        return read_csv(spark, f"{path}/data.csv", schema)


def write_csv(df, path, header=True, mode="errorifexists"):
    """CSV that keeps blanks at the ends and writes missing values as nothing."""
    (
        df.write.mode(mode)
        .option("header", header)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(path)
    )
    return path


def write_both(df, path, mode="errorifexists"):
    """The same rows as Parquet and CSV; the CSV is written from the Parquet, not computed again."""
    df.write.mode(mode).parquet(f"{path}/data.parquet")
    write_csv(df.sparkSession.read.parquet(f"{path}/data.parquet"), f"{path}/data.csv", mode=mode)
    return path


def write_report(df, path, mode="errorifexists"):
    """A one-row report as one JSON file."""
    df.coalesce(1).write.mode(mode).json(path)
    return path


def write_run(df, path, run_id):
    """Rows below ``path/run=<id>``, where the run is a partition of the table at ``path``."""
    df.withColumn("run", F.lit(run_id)).write.mode("append").partitionBy("run").parquet(path)
    return path


def published_type(kind):
    """The type of a published column: bigint, double, boolean or string."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "double"
    return "boolean" if isinstance(kind, T.BooleanType) else "string"


def as_published(df):
    """Cast every column to its published type; nested ones become JSON text."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        out.append((F.to_json(c) if nested else c.cast(published_type(f.dataType))).alias(f.name))
    return df.select(*out)


def kinds(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def create_external(spark, name, schema, path, fmt="parquet"):
    """External table over files, if it does not exist."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = " OPTIONS (header 'true')" if fmt == "csv" else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{options} LOCATION '{path}'")
    return spark.table(name)


def location_of(spark, name):
    """Where a table's files are, or None when there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return about["data_type"]


def plain_path(path):
    return path.removeprefix("file:").rstrip("/").replace("///", "/") if path else path


def publish(df, name, path, fmt="parquet", mode="errorifexists"):
    """Write rows below ``path`` and make them queryable as table ``name``.

    A run's rows go to a folder of their own, are noted in ``<path>/runs.log``, and only then the table is pointed at
    them: a reader sees the former rows or the new ones, a run that breaks off changes nothing, and a table may be published
    from its own rows. Folders of former runs stay for those who still read them. The log lies with the data, so a
    catalog that has lost the table finds the newest run again.

    A table of that name must lie at ``path`` and have the same columns and types. ``mode`` says what
    becomes of rows that are there already: ``overwrite`` shows this run's instead, ``append`` adds to them.
    """
    spark, rows = df.sparkSession, as_published(df)
    at = location_of(spark, name)
    if at and plain_path(at).rpartition("/")[0] != plain_path(path):
        raise ValueError(f"table {name} lies at {at}")
    newest = newest_run_folder(spark, path)
    if newest and not at:
        create_external(spark, name, rows.schema, newest, fmt)
    if newest and kinds(spark.table(name)) != kinds(rows):
        raise ValueError(f"table {name} exists with other columns")
    if newest and mode in ("error", "errorifexists"):
        raise FileExistsError(f"table {name} has rows already")
    if newest and mode == "ignore":
        return spark.table(name)
    folder = newest if newest and mode == "append" else f"{path}/run-{uuid.uuid4().hex}"
    if fmt == "csv":
        write_csv(rows, folder, mode="append")
    else:
        rows.write.mode("append").format(fmt).save(folder)
    if folder != newest:
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        noted = spark.range(1).select(now.alias("noted"), F.lit(folder.rpartition("/")[2]).alias("folder"))
        noted.coalesce(1).write.mode("append").json(f"{path}/runs.log")
        if newest:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        else:
            create_external(spark, name, rows.schema, folder, fmt)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def newest_run_folder(spark, path):
    """The folder of the newest finished run below ``path``, or None."""
    try:
        log = spark.read.schema("noted string, folder string").json(f"{path}/runs.log")
    except AnalysisException:
        return None
    row = log.agg(F.max_by("folder", F.struct("noted", "folder"))).first()
    return f"{path}/{row[0]}" if row[0] else None
