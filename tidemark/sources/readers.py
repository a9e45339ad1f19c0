"""File, path, JSON, JDBC and catalog readers."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import quoted

RESCUED = "_rescued"


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: str | T.StructType | None = None,
    header: bool = True,
    sep: str = ",",
    quote: str = '"',
    escape: str = '"',
    **options: str,
) -> DataFrame:
    """CSV or TSV. Without a schema the types are inferred, which reads the data one extra time."""
    reader = (
        spark.read.option("header", header).option("sep", sep).option("quote", quote).option("escape", escape)
    ).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(paths)


def read_parquet(spark: SparkSession, paths: str | list[str], schema: str | T.StructType | None = None) -> DataFrame:
    """Parquet with its embedded schema, or only the declared columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_files(
    spark: SparkSession,
    paths: str | list[str],
    fmt: str = "parquet",
    schema: str | T.StructType | None = None,
    recursive: bool = False,
    **options: str,
) -> DataFrame:
    """A folder, a glob, a folder tree, or several of these as one scan."""
    reader = spark.read.format(fmt).options(**options).option("recursiveFileLookup", recursive)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([paths] if isinstance(paths, str) else paths)


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it names it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = there.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(there)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether a path is one existing file, whatever its name."""
    system, there = _file_system(spark, path)
    return system.exists(there) and system.getFileStatus(there).isFile()


def _plain_path(path: Column) -> Column:
    """A file's path without coding, file system and server, from the root on."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def _source_files(rows: DataFrame, sources: dict[str, str], name: str) -> DataFrame:
    """``(_path, name)`` of every file of ``rows`` that lies in the folder (or is the file) of a source; of folders in folders
    the inner one counts. The files are those that Spark has listed for the scan; each climbs its own folders, whatever
    the number of sources."""
    spark = rows.sparkSession
    roots = {_file_system(spark, path)[1].toUri().getPath().rstrip("/"): source for source, path in sources.items()}
    files = spark.createDataFrame([(f,) for f in rows.inputFiles()], "_file string").select(_plain_path(F.col("_file")).alias("_path"))
    parts = F.split("_path", "/")
    parents = F.transform(F.sequence(F.size(parts), F.lit(1)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("_root")))
    known = spark.createDataFrame(list(roots.items()), f"_root string, `{name}` string")
    met = files.select("_path", F.explode(parents).alias("p")).select("_path", "p.*").join(known, "_root")
    return met.groupBy("_path").agg(F.max_by(name, "n").alias(name))


def header_of(spark: SparkSession, path: str, sep: str = ",", quote: str = '"', escape: str = "\\") -> list[str] | None:
    """The names in the first line of the first CSV file at a path, read from the file system without a job.

    None where the line does not name every column once; Spark's reader then names them.
    """
    system, there = _file_system(spark, path)
    files = system.listFiles(there, True)
    while files.hasNext():
        file = files.next()
        if file.getPath().getName()[0] in "._" or not file.getLen():
            continue
        opened = system.open(file.getPath())
        try:
            jvm = spark._jvm
            utf8 = jvm.java.nio.charset.StandardCharsets.UTF_8
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(opened, utf8)).readLine()
        finally:
            opened.close()
        how = {"doublequote": True} if escape == quote else {"escapechar": escape, "doublequote": False}
        names = next(csv.reader([(line or "").removeprefix("\ufeff")], delimiter=sep, quotechar=quote, **how), [])
        whole = all(names) and len({n.lower() for n in names}) == len(names)
        return names if names and whole and file.getPath().getName().endswith((".csv", ".txt", ".tsv")) else None
    return None


def read_sources(spark: SparkSession, sources: dict[str, str], name: str = "source", **options: str) -> list[DataFrame]:
    """CSV sources with their own headers: one DataFrame per layout, with the source as a column.

    ``sources`` maps a source to its folder or file. One CSV read gives all files the first header, so
    only sources with equal headers are read together. A file whose header differs from that of its
    source is an error.
    """
    reader = spark.read.option("header", True).option("recursiveFileLookup", True).options(**options)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for source, path in sources.items():
        names = header_of(spark, path, options.get("sep", ","), options.get("quote", '"'), options.get("escape", "\\"))
        layouts.setdefault(tuple(names or reader.csv(path).columns), []).append(source)
    out = []
    for columns, members in layouts.items():
        text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        rows = reader.schema(text).option("enforceSchema", False).csv([sources[m] for m in members])
        at = rows.select("*", F.col("_metadata.file_path").alias("_at"), _plain_path(F.col("_metadata.file_path")).alias("_path"))
        lost = F.raise_error(F.concat(F.lit("no source holds "), F.col("_at"))).cast("string")
        tagged = at.join(_source_files(rows, {m: sources[m] for m in members}, "_source"), "_path", "left")
        out.append(tagged.select(*[F.col(f"`{c}`") for c in columns], F.coalesce("_source", lost).alias(name)))
    return out


def read_partitioned(
    spark: SparkSession,
    base: str,
    fmt: str = "parquet",
    parts: list[str] | None = None,
    schema: str | T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Folder names as columns.

    ``name=value`` folders become partition columns, and a filter on them prunes files. Plain folders
    are named by ``parts``, outermost first; those columns are read from the file path and do not prune.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if not parts:
        return reader.option("basePath", base).load(base)
    df = reader.option("recursiveFileLookup", True).load(base)
    segments = F.split(F.col("_metadata.file_path"), "/")
    return df.select(
        "*", *[F.try_element_at(segments, F.lit(i - len(parts) - 1)).alias(p) for i, p in enumerate(parts)]
    )


def with_source_file(df: DataFrame, name: str = "source_file", path: str | None = None) -> DataFrame:
    """Add the file name (and path) each row was read from."""
    added = [F.col("_metadata.file_name").alias(name)]
    if path:
        added.append(F.col("_metadata.file_path").alias(path))
    return df.select("*", *added)


def source_tag(path: Column, rules: dict[str, str], default: str | None = None) -> Column:
    """First rule whose pattern occurs in the path gives the tag."""
    tag = F.when(F.lit(False), F.lit(None).cast("string"))
    for pattern, code in rules.items():
        tag = tag.when(path.rlike(pattern), F.lit(code))
    return tag.otherwise(F.lit(default).cast("string"))


def tag_by_source(df: DataFrame, rules: dict[str, str], default: str | None = None, name: str = "source_tag") -> DataFrame:
    """Tag rows by the path of their file."""
    return df.withColumn(name, source_tag(F.col("_metadata.file_path"), rules, default))


def read_json(
    spark: SparkSession, paths: str | list[str], multiline: bool = False, schema: str | T.StructType | None = None
) -> DataFrame:
    """JSON lines, or one document per file with ``multiline`` (such a file cannot be split)."""
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths)


def read_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per line, in the column ``value``."""
    return spark.read.text(paths)


def query_file(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Query files by path, without a table."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def read_rescued(
    spark: SparkSession, paths: str | list[str], schema: str, fmt: str = "csv", rescued: str = RESCUED, **options: str
) -> DataFrame:
    """Columns that fit the schema, and the raw record in ``rescued`` for rows that do not."""
    return (
        spark.read.format(fmt)
        .schema(f"{schema}, {rescued} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", rescued)
        .options(**options)
        .load(paths)
    )


def jdbc_options(url: str, table: str, column: str | None, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Reader options; with a numeric ``column`` the table is read in ``partitions`` parallel ranges."""
    options = {"url": url, "dbtable": table}
    if column:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: dict[str, str],
    column: str | None = None,
    lower: int = 0,
    upper: int = 1,
    partitions: int = 8,
) -> DataFrame:
    """JDBC table; credentials come only from the caller's ``options``."""
    wanted = jdbc_options(url, table, column, lower, upper, partitions) | options
    return spark.read.format("jdbc").options(**wanted).load()


def describe_columns(spark: SparkSession, table: str) -> DataFrame:
    """Column name and type of a catalog table, one row per column."""
    described = spark.sql(f"DESCRIBE TABLE {table}")
    return described.filter("col_name <> '' AND NOT startswith(col_name, '#')").select("col_name", "data_type").distinct()


def current_namespace(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_catalog() AS catalog, current_database() AS namespace")


def profile_widths(df: DataFrame) -> DataFrame:
    """One row per column: name, type, longest text form; one pass over the data."""
    widths = df.agg(*[F.max(F.length(quoted(c).cast("string"))).alias(f"w{i}") for i, c in enumerate(df.columns)])
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"w{i}").alias("max_len"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return widths.select(F.inline(rows))


def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Name, path, size and time of every file; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return files.select(
        F.substring_index("path", "/", -1).alias("name"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
