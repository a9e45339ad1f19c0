"""Data-quality checks and repairs (Q1-Q8)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import any_missing, fill_values, quoted
from tidemark.operators.projections import normalise_name
from tidemark.operators.windows import dedup_by_key, identified
from tidemark.sources.readers import read_sources
from tidemark.sources.writers import split_good_bad, tag_good_bad, write_partitioned


def _normal(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.replace(c, F.lit(" "), F.lit("")))


def columns_of(df: DataFrame) -> DataFrame:
    """The schema as rows: normalised column name and type."""
    rows = [(normalise_name(f.name), f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string")


def compare_columns(df: DataFrame, meta: DataFrame, file: str, mode: str = "exact") -> DataFrame:
    """Columns of the data against the control rows of a file.

    Status is ``ok``, ``extra`` (only in the data) or ``missing`` (only in the control rows). Mode
    ``no_extra`` accepts missing columns and does not list them.
    """
    if mode not in ("exact", "no_extra"):
        raise ValueError(f"unknown mode {mode}")
    actual = columns_of(df).select("column_name", F.lit(True).alias("_actual"))
    declared = (
        meta.filter(F.trim("file_name") == file)
        .select(_normal("file_column").alias("column_name"), F.lit(True).alias("_declared"))
        .distinct()
    )
    status = F.when(F.col("_declared").isNull(), "extra").when(F.col("_actual").isNull(), "missing").otherwise("ok")
    compared = actual.join(declared, "column_name", "full").select("column_name", status.alias("status"))
    return compared.filter("status <> 'missing'") if mode == "no_extra" else compared


def compare_types(df: DataFrame, meta: DataFrame, file: str) -> DataFrame:
    """Columns whose type differs from the declared type."""
    declared = meta.filter(F.trim("file_name") == file).select(
        _normal("file_column").alias("column_name"), F.lower(F.trim("target_type")).alias("expected")
    )
    joined = columns_of(df).join(declared, "column_name")
    return joined.filter("data_type <> expected").select("column_name", F.col("data_type").alias("actual"), "expected")


#: A field of a header line: quoted, with doubled quotes inside, or bare. Possessive, so no line needs a stack.
FIELD = r'(?:^|{sep})(?:"((?:[^"]|"")*+)"|([^{sep}]*+))'
#: Narrowest first: the type of a column is the first that all its values can take.
GUESSED = ("int", "bigint", "double", "boolean", "date", "timestamp")
_BLANK = r"[\x00-\x20\x7f]*"
#: What every text that casts to a type looks like. A cast that fails costs an exception, many times a match.
SHAPES = {
    "bigint": rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$",
    "double": rf"(?i)^{_BLANK}[+-]?(?:[0-9.][0-9a-z.]*(?:[ep][+-][0-9]+)?[df]?|inf|infinity|nan){_BLANK}$",
    "boolean": rf"(?i)^{_BLANK}(?:t|true|y|yes|1|f|false|n|no|0){_BLANK}$",
}


def header_rows(spark: SparkSession, path: str | list[str], source: Column | None = None, sep: str = ",") -> DataFrame:
    """``(source, file, position, column_name)``: the first line of every CSV file below ``path`` as rows, from one scan.

    ``source`` names what control rows call a file (default: its name). Names are normalised; an empty file has no rows.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    at = F.col("_metadata.file_path")
    begins = lines.filter(F.col("_metadata.file_block_start") == 0).select(at.alias("file"), "value", F.monotonically_increasing_id().alias("_no"))
    first = begins.groupBy("file").agg(F.min_by("value", "_no").alias("_line"))
    pattern = F.lit(FIELD.format(sep="\\" + sep if sep in "|.^$*+?()[]{}" else sep))
    text = F.regexp_replace("_line", "^\ufeff", "")
    quoted_part, bare = (F.regexp_extract_all(text, pattern, F.lit(k)) for k in (1, 2))
    names = F.zip_with(quoted_part, bare, lambda a, b: F.concat(F.replace(a, F.lit('""'), F.lit('"')), b))
    listed = first.select("file", F.posexplode(names).alias("position", "_name"))
    name = source if source is not None else F.element_at(F.split("file", "/"), -1)
    return listed.select(name.alias("source"), "file", "position", _normal("_name").alias("column_name"))


def compare_headers(headers: DataFrame, control: DataFrame, mode: str = "exact") -> DataFrame:
    """``(source, file, column_name, status)`` for all files at once: ``ok``, ``extra``, ``missing`` or ``repeated``.

    ``control`` has (file_name, file_column). Mode ``no_extra`` accepts missing columns. A file that no control row names has
    only extra columns.
    """
    if mode not in ("exact", "no_extra"):
        raise ValueError(f"unknown mode {mode}")
    declared = control.select(F.trim("file_name").alias("source"), _normal("file_column").alias("column_name")).distinct()
    actual = headers.groupBy("source", "file", "column_name").agg(F.count(F.lit(1)).alias("_n"))
    wanted = headers.select("source", "file").distinct().join(declared, "source").withColumn("_declared", F.lit(True))
    joined = actual.join(wanted, ["source", "file", "column_name"], "full")
    status = F.when(F.col("_n").isNull(), "missing").when(F.col("_declared").isNull(), "extra").when(F.col("_n") > 1, "repeated").otherwise("ok")
    out = joined.select("source", "file", "column_name", status.alias("status"))
    return out.filter("status <> 'missing'") if mode == "no_extra" else out


def files_to_load(compared: DataFrame) -> DataFrame:
    """``(source, file, loads)``: only a file whose columns are all ``ok`` loads; the others are stopped before they are read."""
    return compared.groupBy("source", "file").agg(F.every(F.col("status") == "ok").alias("loads"))


def _casts(c: Column, kind: str) -> Column:
    """Whether a text can take a type; a cast is tried only where the shape of the text admits it."""
    if kind == "int":
        return F.when(c.rlike(SHAPES["bigint"]), F.coalesce(c.try_cast("bigint").between(-(1 << 31), (1 << 31) - 1), F.lit(False))).otherwise(F.lit(False))
    fits = c.try_cast(kind).isNotNull()
    return F.when(c.rlike(SHAPES[kind]), fits).otherwise(F.lit(False)) if kind in SHAPES else fits


def column_types(spark: SparkSession, headers: DataFrame, path: str | list[str], **options: str) -> DataFrame:
    """``(source, file, column_name, data_type)``: the narrowest type that all values of a column in a file can take, from one scan
    of all files, whatever their headers. A column without a value is ``void``, one that nothing else fits ``string``."""
    width = (headers.agg(F.max("position")).first()[0] or 0) + 1
    names = [f"c{k}" for k in range(width)]
    schema = ", ".join(f"{n} string" for n in names)
    rows = spark.read.options(**options).option("header", True).option("recursiveFileLookup", True).schema(schema).csv(path)
    fits = [F.every(quoted(n).isNull() | _casts(quoted(n), t)).alias(f"{n}_{t}") for n in names for t in GUESSED]
    seen = [F.count(quoted(n)).alias(f"{n}_n") for n in names]
    judged_files = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*fits, *seen)

    def guess(n: str) -> Column:
        found = F.when(F.col(f"{n}_n") == 0, "void")
        for t in GUESSED:
            found = found.when(F.col(f"{n}_{t}"), t)
        return found.otherwise("string")

    listed = judged_files.select("file", F.posexplode(F.array(*[guess(n) for n in names])).alias("position", "data_type"))
    return headers.join(listed, ["file", "position"], "left").select("source", "file", "column_name", F.coalesce("data_type", F.lit("void")).alias("data_type"))


def compare_file_types(types: DataFrame, control: DataFrame) -> DataFrame:
    """``(source, file, column_name, actual, expected)`` where a column of a file does not fit its declared type.

    ``control`` has (file_name, file_column, target_type). A narrower number, a date for a timestamp, and a column without
    values fit.
    """
    declared = control.select(F.trim("file_name").alias("source"), _normal("file_column").alias("column_name"), F.lower(F.trim("target_type")).alias("expected")).distinct()
    wider = {"int": ["bigint", "double"], "bigint": ["double"], "date": ["timestamp"]}
    narrower = _any([(F.col("data_type") == t) & F.col("expected").isin(more) for t, more in wider.items()])
    fits = (F.col("data_type") == F.col("expected")) | narrower | (F.col("data_type") == "void") | (F.col("expected") == "string")
    return types.join(declared, ["source", "column_name"]).filter(~fits).select("source", "file", "column_name", F.col("data_type").alias("actual"), "expected")


def split_nulls(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows without a missing value, and rows with at least one."""
    return split_good_bad(df, ~any_missing(df, columns))


def tag_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The same verdict as a column, from one read."""
    return tag_good_bad(df, ~any_missing(df, columns))


def split_duplicates(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The first row of each key, and the rest."""
    return dedup_by_key(df, keys, order)


def dates_ok(formats: dict[str, str]) -> Column:
    """Every listed column parses by its format; NULL does not."""
    return reduce(lambda a, b: a & b, [F.try_to_date(quoted(c), f).isNotNull() for c, f in formats.items()])


def split_bad_dates(df: DataFrame, formats: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    return split_good_bad(df, dates_ok(formats))


def tag_bad_dates(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """The same verdict as a column, from one read."""
    return tag_good_bad(df, dates_ok(formats))


def clean(df: DataFrame, text: str = "unknown", number: float = 0) -> tuple[DataFrame, Observation, Observation]:
    """Fill missing values by type and drop exact duplicates.

    The counts before and after are observed while the result is written; no extra job runs.
    """
    before, after = Observation(), Observation()
    values = fill_values(df, text, number)
    counted = df.observe(before, F.count(F.lit(1)).alias("rows"), F.count_if(any_missing(df)).alias("with_missing"))
    filled = counted.fillna(values).distinct().observe(after, F.count(F.lit(1)).alias("rows"))
    return filled, before, after


@dataclass(frozen=True)
class FileRules:
    """What control rows say of one file: its columns with their types, its key, its date formats."""

    types: dict[str, str]
    keys: list[str]
    formats: dict[str, str]


def rules_from_control(control: DataFrame, file: str) -> FileRules:
    """Read the control rows ``(file_name, column_name, data_type, is_key, date_format)`` of one file: one per column."""
    rows = control.filter(F.trim("file_name") == file).distinct().collect()
    if not rows:
        raise ValueError(f"no control rows for {file}")
    return FileRules(
        types={r["column_name"]: r["data_type"] for r in rows if not r["date_format"]},
        keys=sorted(r["column_name"] for r in rows if (r["is_key"] or "").strip().upper() == "Y"),
        formats={r["column_name"]: r["date_format"] for r in rows if r["date_format"]},
    )


def judged(df: DataFrame, rules: FileRules) -> DataFrame:
    """Every row with its ``reasons`` to be rejected: missing, type, date, duplicate; no reason is good.

    Of the rows of one key the smallest stays. Rows are written with a number each and a key is reduced to its smallest row by
    partial minima, so a key with very many rows does no harm; rows then learn by their number whether they stayed. Without
    a key the reasons are a projection. A file with columns that
    its control rows do not name is an error.
    """
    declared = {*rules.types, *rules.formats}
    if unknown := sorted(set(df.columns) - declared):
        raise ValueError(f"columns without control rows: {unknown}")
    flags = {
        "missing": any_missing(df),
        "type": _any([quoted(c).isNotNull() & quoted(c).try_cast(t).isNull() for c, t in rules.types.items() if c in df.columns]),
        "date": ~dates_ok(rules.formats) if rules.formats else F.lit(False),
    }
    reasons = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()]))
    if not rules.keys:
        return df.withColumn("reasons", reasons)  # no row needs another one
    rows = identified(df)
    whole = F.struct(*[quoted(c) for c in df.columns], F.col("_row"))
    kept = rows.groupBy(*[quoted(k) for k in rules.keys]).agg(F.min(whole).alias("_first")).select(F.col("_first._row").alias("_row"), F.lit(True).alias("_kept"))
    marked = rows.withColumn("reasons", reasons).join(kept, "_row", "left")
    with_copy = F.when(F.col("_kept").isNull(), F.array_append("reasons", "duplicate")).otherwise(F.col("reasons"))
    return marked.select(*df.columns, with_copy.alias("reasons"))


def _any(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags, F.lit(False))


def validate_files(spark: SparkSession, sources: dict[str, str], control: DataFrame, out: str, **options: str) -> DataFrame:
    """Judge the rows of every source by its control rows and write them, one write for each source.

    Good rows go to ``source=/verdict=good``, all others to ``verdict=bad`` with their reasons. Returns what was written.
    """
    for source, path in sources.items():
        rules = rules_from_control(control, source)
        (rows,) = read_sources(spark, {source: path}, **options)
        verdict = F.when(F.size("reasons") == 0, "good").otherwise("bad")
        tagged = judged(rows.drop("source"), rules).select("*", F.lit(source).alias("source"), verdict.alias("verdict"))
        write_partitioned(tagged, out, ["source", "verdict"], "parquet")
    return spark.read.option("mergeSchema", True).parquet(out)


def dedup_files(spark: SparkSession, sources: dict[str, str], out: str, run_date: dt.date, **options: str) -> None:
    """Drop exact duplicates inside every listed source and write it to its dated folder.

    ``sources`` maps a source to its folder or file; there is one read and one write per header layout.
    """
    for rows in read_sources(spark, sources, **options):
        dated = rows.distinct().select(
            "*", F.lit(run_date.year).alias("year"), F.lit(run_date.month).alias("month"), F.lit(run_date.day).alias("day")
        )
        write_partitioned(dated, out, ["source", "year", "month", "day"], "parquet")


def reconcile_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """Rows of each step, side by side in one job."""
    counts = [df.select(F.lit(name).alias("step")) for name, df in steps.items()]
    return reduce(lambda a, b: a.unionByName(b), counts).groupBy("step").agg(F.count(F.lit(1)).alias("n_rows"))
