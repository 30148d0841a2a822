"""Readers for the reference's line formats (batch, streaming and Kafka).

All record kinds go through one parser over a column of text lines,
``parse_records`` (and ``parse_web_log`` for web log lines), which checks
every field of every line whatever columns are read later. A line is bad when
it has another number of fields or a number that is none. ``FAILFAST``
(default, as a bad line stops the reference job) raises, ``DROPMALFORMED``
leaves the line out, ``PERMISSIVE`` keeps it in ``_corrupt_record`` with all
fields NULL.

Files are read in arrival order: ``seq`` is (file, block, row), a line's place
by file name, offset of its split and row in it, so that rules that depend on
the order of arrival see the lines as they stand in the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.timecols import with_event_time

L, S, I = T.LongType(), T.StringType(), T.IntegerType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# record layouts of the reference's input files (field order = column order in the file)
USER_BEHAVIOR = _schema(("user_id", L), ("item_id", L), ("category_id", I), ("behavior", S), ("ts", L))
AD_CLICK = _schema(("user_id", L), ("ad_id", L), ("province", S), ("city", S), ("ts", L))
LOGIN = _schema(("user_id", L), ("ip", S), ("event_type", S), ("ts", L))
ORDER = _schema(("order_id", L), ("event_type", S), ("tx_id", S), ("ts", L))
RECEIPT = _schema(("tx_id", S), ("pay_channel", S), ("ts", L))
MARKET = _schema(("user_id", S), ("behavior", S), ("channel", S), ("ts", L))

RECORDS = {"user_behavior": (USER_BEHAVIOR, "s"), "ad_click": (AD_CLICK, "s"), "login": (LOGIN, "s"),
           "order": (ORDER, "s"), "receipt": (RECEIPT, "s"), "market": (MARKET, "ms")}
MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")
CORRUPT = "_corrupt_record"


def _checked(lines: DataFrame, value: str, sep: str, of, what: str, mode: str) -> DataFrame:
    """The fields of each line beside the other columns; every line is checked in each mode.

    ``of`` gives (is the line good, its fields by name) from the array of its
    parts. Both are taken from one split, bound as a lambda variable. In FAILFAST
    the check is a filter, which no column pruning takes away.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    names: list[str] = []

    def record(parts: Column) -> Column:
        good, fields = of(parts)
        names[:] = fields
        return F.struct(F.coalesce(good, F.lit(False)).alias("_good"), *[c.alias(n) for n, c in fields.items()])

    line = F.col("_line")
    df = lines.withColumnRenamed(value, "_line")
    df = df.withColumn("_rec", F.get(F.transform(F.array(F.split(line, sep, -1)), record), F.lit(0)))
    good = F.coalesce(F.col("_rec._good"), F.lit(False))
    fields = {n: F.col(f"_rec.{n}") for n in names}
    if mode == "FAILFAST":
        message = F.concat(F.lit(f"malformed {what} line: "), F.coalesce(line, F.lit("NULL")))
        df = df.where(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    elif mode == "DROPMALFORMED":
        df = df.where(good)
    else:
        fields = {**{n: F.when(good, c) for n, c in fields.items()}, CORRUPT: F.when(~good, line)}
    return df.withColumns(fields).drop("_line", "_rec")


def parse_records(lines: DataFrame, kind: str, mode: str = "FAILFAST", value: str = "value") -> DataFrame:
    """Typed records of ``kind`` from text lines, batch or streaming.

    Gives the record's fields, ``ts_us``, ``ts`` and ``seq``: the lines' own
    ``seq`` where they have one, else a hash of the fields, which is the same in
    batch and streaming reads. Other columns of ``lines`` stay, ``value`` goes.
    """
    schema, unit = RECORDS[kind]

    def of(parts: Column) -> tuple[Column, dict[str, Column]]:
        good, fields = F.size(parts) == len(schema.fields), {}
        for i, f in enumerate(schema.fields):
            part = F.get(parts, F.lit(i))
            if f.dataType != S:
                good = good & part.rlike("^[+-]?[0-9]+$")
                part = part.try_cast(f.dataType)
                good = good & part.isNotNull()
            fields[f.name] = part
        return good, fields

    return _timed(_checked(lines, value, ",", of, kind, mode), schema.names, unit)


def _timed(df: DataFrame, fields: list[str], unit: str | None = None) -> DataFrame:
    timed = with_event_time(df, "ts", unit)
    return timed if "seq" in df.columns else timed.withColumn("seq", F.xxhash64(*fields))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, seq): the lines under ``path`` with their place in the input."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))  # grows along the lines of a split
    return spark.read.text(path).select("value", place.alias("seq"))


def read_records(spark: SparkSession, path: str, kind: str, mode: str = "FAILFAST",
                 seq: str = "arrival") -> DataFrame:
    """Typed records from header-less CSV files; adds ts_us, ts, seq.

    ``seq='arrival'``: the line's place in the input; ``seq='hash'``: a hash of the record.
    """
    lines = read_lines(spark, path)
    return parse_records(lines.drop("seq") if seq == "hash" else lines, kind, mode)


def stream_records(spark: SparkSession, path: str, kind: str, max_files: int | None = None,
                   mode: str = "FAILFAST") -> DataFrame:
    """The same records as a file stream (one micro-batch per new file), ties in time broken by a hash."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_records(reader.text(path), kind, mode)


def stream_places(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """(value, place): the lines under ``path`` as a stream, each with its file and the block of it."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).alias("place"))


# Web log layout - space separated, field 0 ip, 1 user id,
# 3 time as dd/MM/yyyy:HH:mm:ss, 4 zone (not read), 5 method, 6 url.
WEB_LOG_FIELDS = 7
WEB_LOG_TIME = r"^\d\d/\d\d/\d{4}:\d\d:\d\d:\d\d$"


def parse_web_log(lines: DataFrame, zone: str = "UTC", value: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """ApacheLogEvent rows (ip, user_id, method, url, ts_us, ts, seq) from text lines.

    The time field has no zone of its own; ``zone`` says which wall clock it
    is. Fields past the seventh are not read.
    """
    def of(parts: Column) -> tuple[Column, dict[str, Column]]:
        at = lambda i: F.get(parts, F.lit(i))
        number = lambda start, n: F.substring(at(3), start, n).try_cast("int")
        wall = F.try_make_timestamp_ntz(number(7, 4), number(4, 2), number(1, 2), number(12, 2), number(15, 2), number(18, 2).cast("decimal(8,6)"))
        good = (F.size(parts) >= WEB_LOG_FIELDS) & at(3).rlike(WEB_LOG_TIME) & wall.isNotNull()
        return good, {"ip": at(0), "user_id": at(1), "method": at(5), "url": at(6), "ts": wall}

    df = _checked(lines, value, " ", of, "web log", mode)
    if zone.upper() != "UTC":
        df = df.withColumn("ts", F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col("ts")))
    return _timed(df, ["ip", "user_id", "method", "url", "ts"])


def read_web_log(spark: SparkSession, path: str, zone: str = "UTC", mode: str = "FAILFAST") -> DataFrame:
    return parse_web_log(read_lines(spark, path), zone, mode=mode)


def kafka_lines(spark: SparkSession, servers: str, topic: str, streaming: bool = True,
                options: dict[str, str] | None = None) -> DataFrame:
    """Lines from a Kafka topic as a ``value`` string column, for ``parse_records`` or ``parse_web_log``.

    ``options`` are passed on (``kafka.group.id``, ``startingOffsets``, ...).
    Needs the spark-sql-kafka connector on the classpath (not in this image).
    """
    reader = spark.readStream if streaming else spark.read
    try:
        raw = (reader.format("kafka").options(**(options or {})).option("kafka.bootstrap.servers", servers)
                     .option("subscribe", topic).load())
    except Exception as e:  # the data source is resolved at load()
        if "kafka" in str(e).lower() and ("find" in str(e).lower() or "not" in str(e).lower()):
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the classpath "
                               "(spark.jars.packages); read files with read_records/stream_records") from e
        raise
    return raw.select(F.col("value").cast("string").alias("value"))
