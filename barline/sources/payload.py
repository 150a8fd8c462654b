"""Price payloads: one JSON document per ticker, date -> field -> text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barline.functions.once import with_computed

# Names the payload contract uses.
SERIES = "Time Series (Daily)"
ERROR = "Error Message"
NOTICE = "Note"

_STRICT = {"allowSingleQuotes": "false"}
# JSON that says nothing, besides numbers that are zero.
_NO_MESSAGE = ["null", "false", '""', "{}", "[]"]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files, one document each; the file stem is the ticker."""
    files = spark.read.text(path, wholetext=True)
    name = F.element_at(F.split(F.col("_metadata.file_name"), r"\."), 1)
    return files.select(F.upper(name).alias("ticker"), F.col("value").alias("doc"))


def parse(docs: DataFrame) -> DataFrame:
    """(ticker, doc, ...) plus ``payload_status`` and ``series`` (date key -> row JSON).

    The first matching rule names the status: ``non_json``, ``not_object``,
    ``api_error``, ``rate_limit``, ``missing_series``, else ``ok``; ``series`` is
    NULL unless ``ok``. Two parses of map<string,string> are used, so that a row
    which is not an object survives as its text.
    """
    # Wrapped in brackets, text after the document makes the parse fail.
    wrapped = F.from_json(F.concat(F.lit("["), "doc", F.lit("]")), "array<string>", _STRICT)
    top = F.from_json("doc", "map<string,string>", _STRICT)
    df = docs.withColumns({"_json": F.size(wrapped) == 1, "_top": top})
    df = df.withColumn(
        "_series", F.from_json(_last_value(F.col("_top"), SERIES), "map<string,string>", _STRICT)
    )
    status = F.coalesce(
        F.when(~F.coalesce("_json", F.lit(False)), "non_json"),
        F.when(F.col("_top").isNull(), "not_object"),
        F.when(_has_message(F.col("doc"), F.col("_top"), ERROR), "api_error"),
        F.when(_has_message(F.col("doc"), F.col("_top"), NOTICE), "rate_limit"),
        F.when(F.coalesce(F.size("_series"), F.lit(0)) <= 0, "missing_series"),
        F.lit("ok"),
    )
    known = with_computed(df, {"payload_status": status, "_parsed": F.col("_series")})
    return known.withColumn(
        "series", F.when(F.col("payload_status") == "ok", F.col("_parsed"))
    ).drop("_json", "_top", "_series", "_parsed")


def explode_series(parsed: DataFrame) -> DataFrame:
    """One row per date key of the ``ok`` documents; of equal keys the last stays."""
    # The outer form keeps Spark from testing the size of the array beforehand,
    # which would compute it twice.
    rows = parsed.select(
        *[c for c in parsed.columns if c not in ("doc", "series", "payload_status")],
        F.explode_outer(_last_entries(F.col("series"))).alias("e"),
    ).filter("e IS NOT NULL")
    return rows.select(
        *[c for c in rows.columns if c != "e"],
        F.col("e.key").alias("source_date_key"),
        F.col("e.value").alias("row_json"),
    )


def gate(parsed: DataFrame) -> DataFrame:
    """Status and number of date keys per document."""
    return parsed.select(
        *[c for c in parsed.columns if c not in ("doc", "series")],
        F.when(F.col("payload_status") == "ok", F.size(_last_entries(F.col("series"))))
        .otherwise(0)
        .alias("series_rows"),
    )


def refused(parsed: DataFrame) -> DataFrame:
    """Documents that are not ``ok``, whole, with their status."""
    return parsed.filter("payload_status <> 'ok'").select("ticker", "doc", "payload_status")


def _last_value(entries: Column, key: str) -> Column:
    """Value of a key; the parser keeps repeated keys and the last one counts."""
    hits = F.filter(F.map_entries(entries), lambda e: e["key"] == key)
    return F.when(F.size(hits) > 0, F.element_at(hits, -1)["value"])


def _has_message(doc: Column, entries: Column, key: str) -> Column:
    """Whether the document has something to say under ``key``, by the kind of JSON value.

    A text counts unless it is empty, so ``"0"`` and ``"false"`` do; of other values
    ``null``, ``false``, zero and empty containers do not. The value is parsed again, with its
    kind, only where the key is there; one that a variant cannot hold (a repeated key within it) counts.
    """
    value = F.from_json(doc, f"`{key}` variant", _STRICT)[key]
    text, kind = F.to_json(value), F.schema_of_variant(value)
    number = ~kind.isin("STRING", "BOOLEAN", "VOID") & ~kind.startswith("OBJECT") & ~kind.startswith("ARRAY")
    zero = F.when(number, F.try_variant_get(value, "$", "double") == 0.0).otherwise(F.lit(False))
    said = F.when(value.isNull(), _last_value(entries, key).isNotNull()).otherwise(~text.isin(_NO_MESSAGE) & ~zero)
    return F.when(F.map_contains_key(entries, key), said).otherwise(F.lit(False))


def _last_entries(entries: Column) -> Column:
    """Entries with repeated keys reduced to the last; linear unless there are any."""
    listed = F.map_entries(entries)
    keys = F.map_keys(entries)
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    last_only = F.filter(
        listed,
        lambda e, i: ~F.exists(
            F.slice(listed, i + 2, F.size(listed)), lambda later: later["key"] == e["key"]
        ),
    )
    return F.when(repeated, last_only).otherwise(listed)
