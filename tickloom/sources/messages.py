"""Message and quote feeds, as batch or stream, and their flattening."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.clock import DATE_PARTITION
from tickloom.operators.validation import PRICE_TEXT
from tickloom.schemas import ENVELOPE, QUOTE

# The time format of a message, and the error text of one that can't be read.
MESSAGE_TIME = "yyyy-MM-dd HH:mm:ss"
BAD_SHAPE = "Unexpected message format"

def bus_options(servers: str, topic: str) -> dict[str, str]:
    """Subscribe from the earliest offset and tolerate offsets that are gone."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def read_messages(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str],
    path: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Rows with a ``value`` column from a bus (``kafka``) or a folder of ``text`` lines."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(source).options(**options)
    return reader.load(path) if path else reader.load()


def parsed_messages(messages: DataFrame) -> DataFrame:
    """The message text and its parsed form, whose fields are null for bad text."""
    text = F.col("value").cast("string")
    return messages.select(text.alias("raw"), F.from_json(text, ENVELOPE).alias("message"))


def flatten(messages: DataFrame) -> DataFrame:
    """One tick row per record; messages without records give none."""
    # The time goes into each record, so that explode takes the message off the row. Beside the
    # time it would stay, and each record's row would carry all records of its message.
    dated = F.transform(
        "message.data", lambda record: F.struct("message.timestamp", record.alias("record"))
    )
    exploded = parsed_messages(messages).select(F.explode(dated).alias("dated"))
    records = exploded.select("dated.timestamp", "dated.record")
    names = ((f, "price" if f == "current_price" else f) for f in QUOTE.fieldNames())
    return records.select(
        "timestamp", *(F.col("record").getField(field).alias(name) for field, name in names)
    )


def unreadable(messages: DataFrame) -> DataFrame:
    """Messages that would vanish in ``flatten``: no JSON, or no record list."""
    return (
        parsed_messages(messages)
        .filter(F.col("message.data").isNull())
        .select(
            F.col("raw").alias("payload"),
            F.lit(BAD_SHAPE).alias("error_message"),
        )
    )


def typed_ticks(raw: DataFrame) -> DataFrame:
    """Parse time and price once, at the edge, so that later scans can push filters down."""
    parsed = raw.withColumns(
        {
            "timestamp": F.try_to_timestamp("timestamp", F.lit(MESSAGE_TIME)).cast("timestamp_ntz"),
            "price": F.col("price").try_cast("double"),
        }
    )
    return parsed.withColumn(DATE_PARTITION, F.to_date("timestamp"))


def _record_lists(quotes: DataFrame, batch: str, most_records: int | None) -> DataFrame:
    """The record lists of each batch, in ``data``: one, or parts of ``most_records`` in order."""
    fields = F.struct(*(f for f in QUOTE.fieldNames() if f in quotes.columns))
    part = F.lit(0)
    if most_records is not None:
        place = F.row_number().over(Window.partitionBy(batch).orderBy("_record"))
        part = F.floor((place - 1) / most_records).cast("int")
    records = quotes.select(batch, fields.alias("_record")).withColumn("part", part)
    return records.groupBy(batch, "part").agg(F.sort_array(F.collect_list("_record")).alias("data"))


def envelopes(
    quotes: DataFrame, batch: str = "timestamp", most_records: int | None = None
) -> DataFrame:
    """One JSON message per batch, in ``value``, stamped with the batch time.

    A batch is what one fetch brought and becomes one message, whatever its size. A caller
    whose bus bounds the size of messages names ``most_records``: a batch with more is sent
    in parts of so many records in their order, numbered in ``part``.
    """
    stamped = F.struct(F.date_format(batch, MESSAGE_TIME).alias("timestamp"), "data")
    lists = _record_lists(quotes, batch, most_records)
    numbered = [] if most_records is None else ["part"]
    return lists.select(batch, *numbered, F.to_json(stamped).alias("value"))


def responses(quotes: DataFrame, batch: str) -> DataFrame:
    """Record lists as upstream responses look: a bare JSON list per line, in ``value``."""
    return _record_lists(quotes, batch, None).select(batch, F.to_json("data").alias("value"))


_WHOLE, _FRACTION = r"^BIGINT$", r"^(DOUBLE|FLOAT|DECIMAL.*)$"


def _field(record: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", kind)


def landed_quotes(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Upstream responses, one JSON list per line in ``value``, to one row per record.

    ``payload`` keeps each record's JSON. ``price_text`` keeps a price that is no
    number, for the rejection report; numbers in quotes and booleans are no numbers.
    """
    listed = lines.select(*keep, F.from_json("value", "array<variant>").alias("_records"))
    records = listed.select(*keep, F.explode("_records").alias("_record"))
    record = F.col("_record")
    price = F.try_variant_get(record, "$.current_price", "variant")
    kind = F.schema_of_variant(price)
    fraction = kind.rlike(_FRACTION)
    fields = {
        f.name: _field(record, f.name, f.dataType.simpleString())
        for f in QUOTE.fields
        if f.name != "current_price"
    }
    number = _field(record, "current_price", "double")
    fields["current_price"] = F.when(fraction | kind.rlike(_WHOLE), number)
    fields[PRICE_TEXT] = F.when(fraction, number.cast("string")).otherwise(
        _field(record, "current_price", "string")
    )
    return records.select(
        *keep,
        *(value.alias(name) for name, value in fields.items()),
        F.to_json("_record").alias("payload"),
    )


def response_guard(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Per response: whether it is a list, and how many records it has."""
    value = F.try_parse_json("value")
    is_list = F.coalesce(F.schema_of_variant(value).startswith("ARRAY"), F.lit(False))
    records = F.when(is_list, F.size(F.from_json("value", "array<variant>"))).otherwise(0)
    return lines.select(*keep, is_list.alias("is_list"), records.alias("records"))
