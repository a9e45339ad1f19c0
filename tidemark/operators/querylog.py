"""Facts about queries: references, key usage, operator profiles, run metrics.

The statement texts are a table column. They are read with expressions inside the plan: literals and comments are
blanked, and one pass over the words and punctuation that are left finds the tables. There is no grammar of statements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.documents import json_value
from tidemark.functions.values import exploded, gib, quoted, whole_percent
from tidemark.operators.windows import first_per_key

# Whichever begins first wins: an apostrophe in a quoted name or a comment, or dashes inside a literal, mean nothing.
# Every repetition is of one class or possessive, so the matcher never goes back and needs no stack.
QUOTED = r'"[^"]*+"|`[^`]*+`|\[[^\]]*+\]'
NOT_CODE = rf"({QUOTED})|'[^']*+'?|--[^\n]*+|/\*(?s:.*?)(?:\*/|\z)"
PART = r'(?:[\p{L}_][\p{L}\p{N}_$]*+|"[^"]++"|`[^`]++`|\[[^\]]++\])'
NAME = rf"{PART}(?:\s*+\.\s*+{PART})*+"
TOKEN = rf"({NAME}|[(),])"
TEMP_TABLE = rf"\bCREATE\s+(?:(?:OR\s+REPLACE|GLOBAL|LOCAL|MULTISET|SET)\s+)*+(?:TEMPORARY|TEMP|VOLATILE)\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?({NAME})"
CTE_NAME = rf"(?:\bWITH\s+(?:RECURSIVE\s+)?|,\s*)({PART})\s*(?:\([^()]*+\)\s*)?AS\s*(?:NOT\s+MATERIALIZED\s*|MATERIALIZED\s*)?\("
SEPARATOR = "\x00"  # between parts; a dot may stand inside quotes
CLAUSE_START = r"(?=\b(?:SELECT|FROM|JOIN|WHERE|GROUP\s+BY|ORDER\s+BY|HAVING|LIMIT|UNION)\b)"

# What a token means to the reader; every other word is a name or an alias.
OPEN, CLOSE, COMMA, FROM, JOIN, FILLER, CLAUSE, ARGUMENTS, INTO, UPDATE, MERGE, USING, FOR = range(1, 14)
TOKEN_CLASSES = {
    "(": OPEN, ")": CLOSE, ",": COMMA, "FROM": FROM, "JOIN": JOIN, "INTO": INTO, "OVERWRITE": INTO, "UPDATE": UPDATE, "MERGE": MERGE, "USING": USING, "FOR": FOR,
    **dict.fromkeys(("LATERAL", "ONLY", "TABLE"), FILLER),
    **dict.fromkeys(("SELECT", "WITH", "WHERE", "GROUP", "ORDER", "HAVING", "LIMIT", "UNION", "EXCEPT", "INTERSECT", "SET", "VALUES", "QUALIFY", "WINDOW", "WHEN"), CLAUSE),
    **dict.fromkeys(("EXTRACT", "TRIM", "SUBSTRING", "OVERLAY"), ARGUMENTS),
}

# Words that are never table names.
FUNCTION_NAMES = (
    "CURRENT_DATE", "CURRENT_TIME", "CURRENT_TIMESTAMP", "GETDATE", "SYSDATE", "NOW", "DATEADD", "DATEDIFF", "EXTRACT",
    "CAST", "CONVERT", "COALESCE", "CASE", "WHEN", "THEN", "ELSE", "END", "SUBSTR", "SUBSTRING", "TRIM", "UPPER",
    "LOWER", "CONCAT", "LENGTH", "COUNT", "SUM", "AVG", "MIN", "MAX", "ROW_NUMBER", "RANK", "DENSE_RANK", "LEAD",
    "LAG", "FIRST_VALUE", "LAST_VALUE",
)
# Fixed values end.


def without_comments(c: Column | str) -> Column:
    """A statement without its comments and literals; quoted names stay."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, NOT_CODE, "$1 ")


def _names(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _parts(name: Column) -> Column:
    """The parts of a dotted name without quotes; a dot inside quotes stays."""
    found = F.regexp_extract_all(name, F.lit(f"({PART})"), F.lit(1))
    return F.transform(found, lambda p: F.regexp_replace(p, r'^["`\[]|["`\]]$', ""))


def _last_parts(names: Column) -> Column:
    return F.transform(names, lambda n: F.try_element_at(_parts(n), F.lit(-1)))


def temp_tables(c: Column | str) -> Column:
    """Upper-case names, without a qualifier, of the temporary tables a statement creates."""
    return _last_parts(_names(F.upper(without_comments(c)), TEMP_TABLE))


def cte_names(c: Column | str) -> Column:
    return _last_parts(_names(F.upper(without_comments(c)), CTE_NAME))


def _tables_of(text: Column) -> Column:
    """``(read, written)``: the names of tables in an upper-case statement without comments.

    One pass over its tokens. The state holds what the next name would be (1 a table read, 2 a table written), a name whose
    end is not reached, and a flag for each open parenthesis: 1 between the arguments of a function that has a
    FROM of its own, 2 in a list of tables. A name to read from that a parenthesis follows is a function.
    """
    known = F.create_map(*[F.lit(x) for pair in TOKEN_CLASSES.items() for x in pair])
    tokens = F.transform(
        F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)),
        lambda t: F.struct(F.coalesce(F.try_element_at(known, t), F.lit(0)).alias("c"), t.alias("t")),
    )
    none = F.array().cast("array<string>")
    start = F.struct(F.lit(0).alias("want"), F.lit("").alias("name"), F.lit(0).alias("kind"), F.lit(0).alias("last"), F.lit(False).alias("merge"),
                     F.array(F.lit(0)).alias("open"), none.alias("read"), none.alias("written"))

    def step(s: Column, token: Column) -> Column:
        c, top = token["c"], F.element_at(s["open"], -1)
        ended = (s["name"] != "") & ((c != OPEN) | (s["kind"] == 2))
        want = (
            F.when(c == OPEN, F.when((s["want"] == 1) & (s["name"] == ""), 1).otherwise(0))
            .when(c == COMMA, F.when(top == 2, 1).otherwise(0))
            .when(c == FROM, F.when(top == 1, 0).otherwise(1))
            .when(c == JOIN, 1)
            .when(c == INTO, 2)
            .when(c == UPDATE, F.when(s["last"] == FOR, 0).otherwise(2))
            .when(c == USING, F.when(s["merge"], 1).otherwise(0))
            .when(c == FILLER, s["want"])
            .otherwise(0)
        )
        is_name = (c.isin(0, ARGUMENTS)) & (s["want"] > 0)
        others = F.slice(s["open"], 1, F.size(s["open"]) - 1)
        opened = (
            F.when(c == OPEN, F.array_append(s["open"], F.when(s["last"] == ARGUMENTS, 1).when((s["want"] == 1) & (s["name"] == ""), 2).otherwise(0)))
            .when((c == CLOSE) & (F.size(s["open"]) > 1), others)
            .when((c == FROM) & (top == 0) | (c == JOIN) & (top == 0), F.array_append(others, F.lit(2)))
            .when((c == CLAUSE) & (top == 2), F.array_append(others, F.lit(0)))
            .otherwise(s["open"])
        )
        return F.struct(
            want.alias("want"),
            F.when(is_name, token["t"]).otherwise("").alias("name"),
            s["want"].alias("kind"),
            c.alias("last"),
            F.when(c == MERGE, True).when(c == USING, False).otherwise(s["merge"]).alias("merge"),
            opened.alias("open"),
            F.when(ended & (s["kind"] == 1), F.array_append(s["read"], s["name"])).otherwise(s["read"]).alias("read"),
            F.when(ended & (s["kind"] == 2), F.array_append(s["written"], s["name"])).otherwise(s["written"]).alias("written"),
        )

    # A closing token ends a name at the end of the text.
    end = F.array(F.struct(F.lit(CLOSE).alias("c"), F.lit(")").alias("t")))
    return F.aggregate(F.concat(tokens, end), start, step, lambda s: F.struct(s["read"].alias("read"), s["written"].alias("written")))


def _references(queries: DataFrame, query_id: str, text: str, side: str) -> DataFrame:
    clean = queries.select(quoted(query_id), F.upper(without_comments(text)).alias("_text"))
    found = clean.select(query_id, "_text", _tables_of(F.col("_text")).alias("_found"))
    local = F.concat(*[_last_parts(_names(F.col("_text"), p)) for p in (TEMP_TABLE, CTE_NAME)])
    names = F.array_distinct(F.transform(F.col(f"_found.{side}"), lambda n: F.array_join(_parts(n), SEPARATOR)))
    parsed = found.select(query_id, names.alias("_names"), local.alias("_local"))
    object_name = F.try_element_at("_p", F.lit(-1))
    is_local = (F.size("_p") == 1) & F.coalesce(F.array_contains("_local", object_name), F.lit(False))
    rows = (
        exploded(parsed, F.col("_names"), "full_name")
        .select(query_id, "_local", F.split("full_name", SEPARATOR).alias("_p"))
        .filter(~(object_name.isin(*FUNCTION_NAMES) & (F.size("_p") == 1)) & ~is_local)
    )
    leading = F.slice("_p", 1, F.greatest(F.size("_p") - 2, F.lit(0)))
    return rows.select(
        query_id,
        F.array_join(leading, ".").alias("database_name"),
        F.coalesce(F.try_element_at("_p", F.lit(-2)), F.lit("")).alias("schema_name"),
        F.try_element_at("_p", F.lit(-1)).alias("object_name"),
    )


def sql_references(queries: DataFrame, query_id: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Distinct (query, database, schema, object) read after FROM, in its comma list, after JOIN, or by MERGE, in upper case, quoted or not.

    A CTE or temporary table of the statement hides an unqualified name only; table functions and words of
    the language are no tables. Of names with more than three parts the leading ones are the database.
    """
    return _references(queries, query_id, text, "read")


def sql_targets(queries: DataFrame, query_id: str = "query_id", text: str = "sql_text") -> DataFrame:
    """Like ``sql_references`` for the tables that INSERT, MERGE, UPDATE or SELECT INTO write to."""
    return _references(queries, query_id, text, "written")


def _words(pieces: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(pieces, lambda p: F.split(p, r"\W+"))))


def key_usage(queries: DataFrame, keys: DataFrame, query_id: str = "query_id", text: str = "sql_text") -> DataFrame:
    """For every (query, key): present or not, and whether in a join condition, a filter or a select list.

    ``keys`` has (query_id, key). A key is found as a whole word, case-insensitively. The keys of a
    statement join it as one array, so its text is shuffled once, cut at its clause words once and
    split into words once. Only a key that is not a plain word is searched with its own pattern.
    """
    wanted = keys.select(query_id, F.upper("key").alias("_key"))
    listed = wanted.groupBy(query_id).agg(F.collect_set("_key").alias("_keys"))
    texts = queries.select(quoted(query_id), F.col(text).alias("_text")).join(listed, query_id)
    cut = texts.select(query_id, "_keys", F.split(F.upper(without_comments("_text")), CLAUSE_START).alias("_all"))

    def starting(word: str) -> Column:
        return F.filter("_all", lambda p: F.startswith(p, F.lit(word)))

    conditions = F.transform(starting("JOIN"), lambda p: F.coalesce(F.regexp_substr(p, F.lit(r"(?s)\bON\b.*")), F.lit("")))
    clauses = {"present": F.col("_all"), "in_join": conditions, "in_where": starting("WHERE"), "in_select": starting("SELECT")}
    cut = cut.select(query_id, "_keys", *[c.alias(f"_{n}") for n, c in clauses.items()])
    split = cut.select("*", *[_words(F.col(f"_{n}")).alias(f"_{n}_words") for n in clauses])
    pattern = F.concat(F.lit(r"\b\Q"), F.col("key"), F.lit(r"\E\b"))

    def found(name: str) -> Column:
        plain = F.array_contains(F.col(f"_{name}_words"), F.col("key"))
        return F.when(F.rlike("key", F.lit(r"^\w+$")), plain).otherwise(F.exists(f"_{name}", lambda p: F.rlike(p, pattern)))

    return exploded(split, F.col("_keys"), "key").select(query_id, "key", *[found(n).alias(n) for n in clauses])


def key_usage_summary(usage: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Share of keys each query uses, in whole percent."""
    used = usage.groupBy(query_id).agg(F.count(F.lit(1)).alias("n_keys"), F.count_if("present").alias("n_used"))
    return used.select(
        query_id,
        "n_keys",
        "n_used",
        whole_percent("n_used", "n_keys").alias("used_pct"),
        whole_percent(F.col("n_keys") - F.col("n_used"), "n_keys").alias("missing_pct"),
    )


def operator_metrics(profile: DataFrame) -> DataFrame:
    """Columns of an operator profile from its JSON texts (operator_statistics, execution_time_breakdown)."""
    stats, times = F.col("operator_statistics"), F.col("execution_time_breakdown")
    return profile.select(
        "operator_id",
        "operator_type",
        json_value(times, "$.overall_percentage", "double").alias("pct_total_time"),
        json_value(times, "$.processing", "double").alias("pct_processing"),
        json_value(stats, "$.input_rows", "bigint").alias("input_rows"),
        json_value(stats, "$.output_rows", "bigint").alias("rows_produced"),
        json_value(stats, "$.io.bytes_scanned", "bigint").alias("bytes_scanned"),
        gib(json_value(stats, "$.spilling.bytes_spilled_local_storage", "bigint")).alias("spilled_gib"),
        json_value(stats, "$.pruning.partitions_scanned", "bigint").alias("partitions_scanned"),
        json_value(stats, "$.pruning.partitions_total", "bigint").alias("partitions_total"),
    )


def top_operators(profile: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` operators with the largest share of time; a report of fixed length."""
    return operator_metrics(profile).orderBy(F.col("pct_total_time").desc_nulls_last(), "operator_id").limit(k)


def run_metrics(history: DataFrame) -> DataFrame:
    """Query-run metrics with byte counts also in GiB."""
    return history.select(
        "statement_id",
        "execution_status",
        "statement_type",
        "execution_duration_ms",
        "read_bytes",
        "read_rows",
        "produced_rows",
        gib("shuffle_read_bytes").alias("shuffle_read_gb"),
        gib("spilled_local_bytes").alias("spilled_local_gb"),
    )


def signature(c: Column | str, length: int | None = None) -> Column:
    """Blanks collapsed, upper case: how a statement is recognised. ``length`` compares only its beginning."""
    c = F.col(c) if isinstance(c, str) else c
    whole = F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return F.substring(whole, 1, length) if length else whole


def match_signature(history: DataFrame, queries: DataFrame, length: int | None = None) -> DataFrame:
    """Each query with its newest history row of the same signature; NULL when there is none.

    The history is reduced to its newest row per signature before the join.
    """
    signed = history.select(
        signature("statement_text", length).alias("_sig"), "statement_id", "start_time", F.col("execution_status").alias("status")
    )
    newest = first_per_key(signed, ["_sig"], [F.col("start_time").desc()])
    return queries.withColumn("_sig", signature("sql_text", length)).join(newest, "_sig", "left").drop("_sig")
