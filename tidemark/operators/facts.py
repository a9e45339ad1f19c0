"""Fact loads, watermark and range extracts, nested people documents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import moment
from tidemark.functions.text import blank_to, one_line, plain_text, text_after, text_before, text_between
from tidemark.functions.values import exploded, quoted
from tidemark.operators.joins import lookup
from tidemark.operators.windows import identified

UNKNOWN_KEY = -1


def settle_staged(stg: DataFrame, business_key: list[str], winner: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """One staged row for each business key, and the rows of the keys for which none can be chosen.

    Of the rows of a key the one with the largest ``winner`` columns stays (NULLs are smallest). Where different rows share the
    largest values, or differ and no ``winner`` is named, all rows of the key are rejected. Equal rows are one.
    Rows are reduced by partial aggregates to the smallest and the largest row for each key and rank, then
    for each key, so a key with very many rows does no harm.
    """
    keys = [quoted(k) for k in business_key]
    rank = F.struct(*[quoted(c) for c in winner or []], F.lit(0).alias("_none"))
    row = F.struct(*[quoted(c) for c in stg.columns])
    by_rank = stg.groupBy(*keys, rank.alias("_rank")).agg(F.min(row).alias("_low"), F.max(row).alias("_high"))
    top = by_rank.groupBy(*keys).agg(F.max(F.struct("_rank", "_low", "_high")).alias("_top")).select("_top.*")
    tie = F.col("_low") != F.col("_high")
    settled = top.filter(~tie).select("_low.*")
    torn = top.filter(tie).select("_low.*").select(*[k.alias(f"_key_{n}") for n, k in zip(business_key, keys)])
    same = [quoted(k).eqNullSafe(quoted(f"_key_{k}")) for k in business_key]
    return settled, stg.join(torn, same, "left_semi")


@dataclass(frozen=True)
class Lookup:
    """One dimension lookup: ``on`` maps staged columns to dimension columns."""

    dim: DataFrame
    on: dict[str, str]
    key: str
    fk: str
    current: Column | None = None


def load_fact(
    stg: DataFrame,
    lookups: list[Lookup],
    fact: DataFrame | None,
    business_key: list[str],
    measures: list[str],
    unmatched: str = "keep",
    as_of: dt.datetime | None = None,
    distinct: bool = False,
    winner: list[str] | None = None,
) -> DataFrame:
    """New fact rows: rows already loaded are dropped first, then the keys are looked up.

    With ``winner`` staged rows that share a business key are settled first (``settle_staged``), so no key loads twice.

    ``unmatched`` says what happens to rows without a dimension row: ``keep`` (NULL key), ``drop``,
    or ``unknown`` (key -1). Two current dimension rows for one key are an error: they would double
    facts.
    """
    if unmatched not in ("keep", "drop", "unknown"):
        raise ValueError(f"unknown option {unmatched}")
    rows = stg if winner is None else settle_staged(stg, business_key, winner)[0]
    if fact is not None:
        rows = rows.join(fact.select(*business_key), business_key, "left_anti")
    for item in lookups:
        rows = lookup(rows, _current_rows(item), item.on, item.key, item.fk, how="inner" if unmatched == "drop" else "left")
        if unmatched == "unknown":
            rows = rows.withColumn(item.fk, F.coalesce(item.fk, F.lit(UNKNOWN_KEY)))
    columns = [quoted(c) for c in dict.fromkeys([*business_key, *measures, *[x.fk for x in lookups]])]
    if as_of is not None:
        columns.append(moment(as_of).alias("entry_date"))
    out = rows.select(*columns)
    return out.distinct() if distinct else out


def _current_rows(item: Lookup) -> DataFrame:
    """The looked-up columns of the current dimension rows, one row for each key."""
    rows = item.dim if item.current is None else item.dim.filter(item.current)
    keys = [*dict.fromkeys(item.on.values())]
    if item.key in keys:
        return rows.select(*keys).distinct()
    found = rows.dropna(subset=keys).groupBy(*keys).agg(F.min(quoted(item.key)).alias(item.key), F.max(quoted(item.key)).alias("_other"))
    clash = F.raise_error(F.lit(f"several current dimension rows for one key of {item.fk}"))
    one = F.when(quoted(item.key).eqNullSafe(F.col("_other")), quoted(item.key)).otherwise(clash.cast(rows.schema[item.key].dataType))
    return found.select(*keys, one.alias(item.key))


# Markers inside a journal text.
JOURNAL_PREFIX = "Service"
JOURNAL_BODY = "Update"
JOURNAL_STATUS = "Service Health RAG"
# Fixed values end.


def journal_project(c: str) -> Column:
    """Project name: the text before the body marker, less its separator and the prefix word."""
    head = text_before(c, JOURNAL_BODY)
    head = F.substring(head, F.lit(1), F.length(head) - 2)
    return one_line(F.replace(head, F.lit(JOURNAL_PREFIX), F.lit("")))


def journal_body(c: str) -> Column:
    """Plain text between the body marker and the status marker, after one separator character."""
    body = text_between(c, JOURNAL_BODY, JOURNAL_STATUS)
    return plain_text(body.substr(F.lit(2), F.length(body)))


def journal_status(c: str) -> Column:
    """Status after its marker and one separator; ``unknown`` when blank or absent."""
    tail = text_after(c, JOURNAL_STATUS)
    return blank_to(tail.substr(F.lit(2), F.length(tail)))


def journal_rows(stg: DataFrame) -> DataFrame:
    """Staged journal texts with their parts (``_body``, ``_project``, ``_status``), a digest of text and body, and a number for each row.

    ``stg`` has updates, submitted_time, employee_email and view_email; only texts that start with the prefix count.
    The rows are written once, by column, so whatever needs only the parts, or only the digest, reads no text.
    """
    parsed = stg.filter(F.startswith("updates", F.lit(JOURNAL_PREFIX))).select(
        "*",
        journal_body("updates").alias("_body"),
        F.to_date("submitted_time").alias("_date"),
        journal_project("updates").alias("_project"),
        journal_status("updates").alias("_status"),
    )
    return identified(parsed.select("*", text_digest("_body").alias("_key"), text_digest("updates").alias("_text")))


def text_digest(c: Column | str) -> Column:
    """What stands for a text in joins and comparisons: its 256-bit digest; NULL for NULL."""
    return F.unhex(F.sha2(F.col(c) if isinstance(c, str) else c, 256))


def load_journal_fact(
    stg: DataFrame,
    date_rows: DataFrame,
    projects: DataFrame,
    people: DataFrame,
    statuses: DataFrame,
    fact: DataFrame | None = None,
) -> DataFrame:
    """Fact rows from journal texts (or from ``journal_rows``): each text part is computed once, then looked up.

    Rows without a dimension row are dropped, and (updates, submitted_time) is the business key; ``fact`` has these
    two, or ``_key`` in place of the text. Until the last step rows are a number, digests and lookup keys; the texts
    join the rows that are left once.
    """
    rows = stg if "_row" in stg.columns else journal_rows(stg)
    narrow = rows.select("_row", "_key", "_text", "submitted_time", "_date", "_project", "_status", "employee_email", "view_email")
    known = None
    if fact is not None:
        known = fact.select((F.col("_key") if "_key" in fact.columns else text_digest("updates")).alias("_key"), "submitted_time")
    lookups = [
        Lookup(date_rows, {"_date": "date"}, "date_key", "fk_date"),
        Lookup(projects, {"_project": "project_name"}, "project_id", "fk_project"),
        Lookup(people, {"employee_email": "email"}, "person_id", "fk_employee"),
        Lookup(people, {"view_email": "email"}, "person_id", "fk_viewer"),
        Lookup(statuses, {"_status": "status_name"}, "status_id", "fk_status"),
    ]
    found = load_fact(narrow, lookups, known, ["_key", "submitted_time"], ["_text", "_row"], unmatched="drop")
    keys = [x.fk for x in lookups]
    one = found.groupBy("_key", "submitted_time", "_text", *keys).agg(F.min("_row").alias("_row"))
    texts = rows.select("_row", F.col("_body").alias("updates"), F.col("updates").alias("updates_rich_text"))
    return one.join(texts, "_row").select("updates", "submitted_time", "updates_rich_text", *keys)


def incremental_extract(df: DataFrame, column: str, watermark: dt.datetime | dt.date, strict: bool = False) -> DataFrame:
    """Rows at or after the watermark (after it when ``strict``); a literal bound that reaches the scan."""
    bound = moment(watermark).cast(df.schema[column].dataType)
    return df.filter(quoted(column) > bound if strict else quoted(column) >= bound)


def observed_watermark(table: str, df: DataFrame, column: str) -> DataFrame:
    """The new watermark of one table, as a row."""
    return df.agg(F.max(column).alias("watermark")).select(F.lit(table).alias("table_name"), "watermark")


def advance_watermark(config: DataFrame, observed: DataFrame) -> DataFrame:
    """Move each table's watermark forward; a table without new rows, or with older ones, keeps its own."""
    newest = observed.groupBy("table_name").agg(F.max("watermark").alias("_new"))
    kind = config.schema["watermark"].dataType
    return (
        config.join(newest, "table_name", "left")
        .withColumn("watermark", F.greatest("watermark", F.col("_new").cast(kind)))
        .select(*config.columns)
    )


def range_extract(df: DataFrame, column: str, start: dt.datetime | dt.date, end: dt.datetime | dt.date) -> DataFrame:
    """Rows of a closed range."""
    kind = df.schema[column].dataType
    return df.filter(quoted(column).between(moment(start).cast(kind), moment(end).cast(kind)))


EXTRACT_LOG = "table_name string, status string, rows_copied long, watermark timestamp_ntz, path string, error string"


def run_extracts(spark: SparkSession, config: DataFrame, read: Callable[[str], DataFrame], out: str, strict: bool = False) -> DataFrame:
    """Extract every table that ``config`` names, and return what each extract did (``EXTRACT_LOG``).

    ``config`` has (table_name, incremental_column, watermark), or (..., range_start, range_end) for a historical
    run; its rows are control data, one for each table. ``read`` gives a table by name. The bound of each row
    is a literal that reaches the scan of its table. Rows and the largest value are observed while the
    extract is written, so a table is read once. An extract is written to ``out/table_name/from=<bound>`` in place of
    an earlier try from the same bound, so a repeated run doubles nothing. A table that cannot be read or
    written is logged as ``Failed`` and the others go on. Nothing here moves a watermark: see ``commit_watermarks``.
    """
    log = []
    historical = "range_start" in config.columns
    for row in config.collect():
        name, column = row["table_name"], row["incremental_column"]
        low = row["range_start"] if historical else row["watermark"]
        path = f"{out.rstrip('/')}/{name}/from={low:%Y%m%dT%H%M%S%f}"
        try:
            source = read(name)
            rows = range_extract(source, column, low, row["range_end"]) if historical else incremental_extract(source, column, low, strict)
            seen = Observation()
            newest = F.max(quoted(column)).cast("timestamp_ntz").alias("newest")
            rows.observe(seen, F.count(F.lit(1)).alias("rows"), newest).write.mode("overwrite").parquet(path)
            log.append((name, "Succeeded", seen.get["rows"], seen.get["newest"], path, None))
        except PySparkException as error:
            log.append((name, "Failed", 0, None, path, str(error).split("\n")[0][:500]))
    return spark.createDataFrame(log, EXTRACT_LOG)


def commit_watermarks(config: DataFrame, log: DataFrame, store: str) -> DataFrame:
    """Write the config with the watermarks that the successful extracts of ``log`` reached, as the next version below ``store``.

    A version is a folder of its own and counts when its write is complete, so a failed commit leaves the old
    watermarks. A failed extract, one without rows, and one with older rows keep theirs.
    """
    spark = config.sparkSession
    done = log.filter("status = 'Succeeded' AND watermark IS NOT NULL").select("table_name", "watermark")
    try:
        version = spark.read.parquet(store).agg(F.max("version")).first()[0]
    except AnalysisException:  # nothing was committed yet
        version = None
    path = f"{store.rstrip('/')}/version={(version or 0) + 1}"
    advance_watermark(config, done).write.parquet(path)
    return spark.read.schema(config.schema).parquet(path)


def committed_config(spark: SparkSession, store: str) -> DataFrame:
    """The newest config that was committed."""
    versions = spark.read.parquet(store)
    newest = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == newest).drop("version")


def flatten_people(df: DataFrame, column: str = "body") -> DataFrame:
    """(first, last, email) rows of ``{"response": {"result": [{<any key>: [{...}]}]}}`` documents.

    The record keys are data, so they are read as a map; rows with a missing part are dropped.
    """
    schema = (
        "response struct<result: array<map<string, array<struct<FirstName: string, LastName: string, EmailID: string>>>>>"
    )
    parsed = df.select(F.from_json(quoted(column), schema)["response"]["result"].alias("_records"))
    records = exploded(parsed, F.col("_records"), "_record").select(F.flatten(F.map_values("_record")).alias("_people"))
    person = F.col("_person")
    return (
        exploded(records, F.col("_people"), "_person")
        .select(
            person["FirstName"].alias("first_name"), person["LastName"].alias("last_name"), person["EmailID"].alias("email")
        )
        .dropna()
    )
