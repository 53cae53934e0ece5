"""``spark-submit`` entry: message bus to tick lake and reject table, until stopped."""

from __future__ import annotations

from datetime import timedelta

from tickloom.session import build_session
from tickloom.settings import Settings
from tickloom.sources.messages import bus_options, read_messages
from tickloom.streaming.candles import start_candles
from tickloom.streaming.ingest import clean_ticks, start_rejects, start_ticks


def main() -> None:
    settings = Settings.from_env()
    spark = build_session("tick-ingest", settings.spark_conf())
    options = bus_options(settings.bus_servers, settings.bus_topic)
    messages = read_messages(spark, "kafka", options)
    within = f"{settings.repeat_minutes} minutes" if settings.repeat_minutes else None
    start_ticks(messages, settings.lake, f"{settings.checkpoints}/ticks", repeats_within=within)
    if settings.candle_late_minutes:
        start_candles(
            clean_ticks(messages),  # a repeat leaves a candle as it is
            f"{settings.tables}/stream_candles",
            f"{settings.checkpoints}/candles",
            timedelta(seconds=settings.candle_seconds),
            late=f"{settings.candle_late_minutes} minutes",
        )
    rejects = f"{settings.tables}/dead_letters"
    start_rejects(messages, rejects, f"{settings.checkpoints}/rejects", "ingest")
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
