"""Reading configured sources into one table of documents.

Documents have the columns ``mix_source, source_ord, ord, text``; ``ord`` is the row key that stands for
stream order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.functions.text import long_enough, render_chat
from shardloom.session import as_written
from shardloom.spec import Mixture, SourceSpec


def messages_from_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                        role: str = "role", content: str = "text") -> DataFrame:
    """Rebuild ``messages`` arrays, in turn order, from one row per turn."""
    item = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(content).alias("content"))
    return (
        turns.groupBy(conv).agg(F.array_sort(F.collect_list(item)).alias("__m"))
        .select(conv, F.transform("__m", lambda m: F.struct(m["role"].alias("role"),
                                                            m["content"].alias("content"))).alias("messages"))
    )


def file_order(raw: DataFrame) -> DataFrame:
    """Add ``ord``: rows in the order of their files' paths and of the rows in them.

    For formats that report row indexes. Row counts per file are read from the index alone; a file's offset is the
    rows of all files before it.
    """
    places = raw.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))
    sizes = places.groupBy("__path").agg((F.max("__row") + 1).alias("__n"))
    before = Window.orderBy("__path").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = sizes.select("__path", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return places.join(offsets, "__path").withColumn("ord", F.col("__off") + F.col("__row")).drop("__path", "__row", "__off")


def key_order(raw: DataFrame, key: str) -> DataFrame:
    """Add ``ord``: the rank of the row's key among the distinct keys, from 0, nulls first.

    Keys alone are sorted, in ranges; a range's offset is the keys of all ranges before it.
    """
    sorted_keys = as_written(
        raw.select(F.col(key).alias("__key")).distinct().repartitionByRange(F.col("__key").asc_nulls_first())
        .sortWithinPartitions(F.col("__key").asc_nulls_first()).withColumn("__at", F.monotonically_increasing_id()), "keys")
    # The id holds the range in its upper bits and the place in the range in its lower 33.
    ranged = sorted_keys.select("__key", F.shiftright("__at", 33).alias("__r"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)).alias("__i"))
    before = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("__r").agg(F.count(F.lit(1)).alias("__n")).select(
        "__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    ranks = ranged.join(offsets, "__r").select("__key", (F.col("__off") + F.col("__i")).alias("ord"))
    return raw.join(ranks, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def with_order(raw: DataFrame, key: str | None) -> DataFrame:
    """Add ``ord``, the row key that stands for stream order."""
    if key is None:
        return file_order(raw)
    if dict(raw.dtypes)[key] in ("tinyint", "smallint", "int", "bigint"):
        return raw.withColumn("ord", F.col(key).cast("long"))
    return key_order(raw, key)


def scan_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The source as stored: only its key, its text field and, where filtered, its language are read."""
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema:
        reader = reader.schema(spec.schema)
    raw = reader.load(spec.location)
    if spec.turn_rows:
        if spec.filter_lang:
            raise ValueError(f"{spec.name}: a language filter needs a language per document, not per turn")
        raw = messages_from_turns(raw, conv=spec.key)
    lang = F.col(spec.lang_column) if spec.lang_column in raw.columns else F.lit(None).cast("string")
    field = F.col(spec.field) if spec.field in raw.columns else F.lit(None).cast("string")
    ordered = with_order(raw, spec.key)
    out = ordered.select("ord", field.alias(spec.field), *([lang.alias("lang")] if spec.filter_lang else []))
    return out.repartition(spec.scan_partitions, "ord") if spec.scan_partitions else out


def filter_language(df: DataFrame, lang: str | None) -> DataFrame:
    """Keep rows of one language; rows without a language go. Without a language given, keep all."""
    return df.filter(F.col("lang") == lang) if lang else df


def project_text(df: DataFrame, field: str) -> DataFrame:
    """``(ord, text)``: the text field, empty where missing, or the rendered chat for ``messages``."""
    is_chat = dict(df.dtypes)[field].startswith("array")
    text = render_chat(F.col(field)) if is_chat else F.coalesce(F.col(field).cast("string"), F.lit(""))
    return df.select("ord", text.alias("text"))


def read_documents(spark: SparkSession, spec: SourceSpec, position: int = 0) -> DataFrame:
    rows = project_text(filter_language(scan_source(spark, spec), spec.filter_lang), spec.field)
    return rows.select(F.lit(spec.name).alias("mix_source"), F.lit(position).alias("source_ord"), "ord", "text")


def read_mixture(spark: SparkSession, mixture: Mixture) -> DataFrame:
    """All sources in configured order, each row tagged with its source."""
    parts = [read_documents(spark, s, i) for i, s in enumerate(mixture.sources)]
    return reduce(DataFrame.unionByName, parts)


def with_min_length(docs: DataFrame, min_chars: int) -> DataFrame:
    return docs.filter(long_enough(F.col("text"), min_chars))


FAILURE_SCHEMA = "mix_source string, error string"


def read_mixture_isolated(spark: SparkSession, mixture: Mixture,
                          known_configs: dict[str, list[str]] | None = None,
                          folder: str | None = None) -> tuple[DataFrame | None, DataFrame]:
    """Like ``read_mixture`` but a source that fails, at once or at its last row, only yields a failure row.

    Every source is read to its end and written by itself; the documents are the union of what was written, so that
    nothing of a failed source is left and no later step meets its files. With ``folder`` they are written there,
    each under its place in the mixture. A configured ``config`` missing from
    ``known_configs`` is reported as a warning row; the source is still tried.
    """
    good, failures = [], []
    for i, spec in enumerate(mixture.sources):
        known = (known_configs or {}).get(spec.name)
        if spec.config and known is not None and spec.config not in known:
            failures.append((spec.name, f"config '{spec.config}' not found, available: {sorted(known)}"))
        try:
            rows = read_documents(spark, spec, i)
            if folder:
                rows.write.option("compression", "zstd").parquet(f"{folder}/{i}")
                good.append(spark.read.schema(rows.schema).parquet(f"{folder}/{i}"))
            else:
                good.append(as_written(rows, "source"))
        except Exception as err:  # noqa: BLE001 - any failure of one source must leave the others running
            failures.append((spec.name, f"{type(err).__name__}: {err}".split("\n")[0]))
    docs = reduce(DataFrame.unionByName, good) if good else None
    return docs, spark.createDataFrame(failures, FAILURE_SCHEMA)


def split_bad_records(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON lines read permissively: good rows, and the raw text of unreadable ones."""
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), F.col("value").alias("record"))
    parsed = lines.withColumn("r", F.from_json(
        "record", schema + ", _corrupt_record string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    ))
    good = parsed.filter(F.col("r._corrupt_record").isNull()).select("r.*").drop("_corrupt_record")
    return good, parsed.filter(F.col("r._corrupt_record").isNotNull()).select("path", "record")
