"""``spark-submit`` entry: one analytics run, for any scheduler."""

from __future__ import annotations

from tickloom.plans.analytics_run import run
from tickloom.session import build_session
from tickloom.settings import Settings


def main() -> None:
    settings = Settings.from_env()
    spark = build_session("tick-analytics", settings.spark_conf())
    try:
        run(spark, settings)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
