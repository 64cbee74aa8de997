"""The streaming job from the command line.

    python -m clickpulse.streaming --source kafka --bootstrap host:9092 --topic clickstream-events \\
        --metrics-root /shared/store --checkpoint /shared/checkpoint --dlq-path /shared/dlq
    python -m clickpulse.streaming --source parquet --source-path /shared/in --available-now ...
"""

from __future__ import annotations

import argparse

from clickpulse.session import get_spark
from clickpulse.sources.records import kafka_options, kafka_sink_options, read_records
from clickpulse.streaming.job import JobConfig, start


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m clickpulse.streaming", description="Validate, dead-letter and aggregate click events.")
    p.add_argument("--master", help="Spark master; a cluster submit sets its own")
    p.add_argument("--source", default="kafka", help="kafka, or a file format such as parquet or json")
    p.add_argument("--source-path", help="folder of a file source")
    p.add_argument("--bootstrap", help="Kafka servers")
    p.add_argument("--topic", default="clickstream-events")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--security-protocol", default="PLAINTEXT")
    p.add_argument("--sasl-mechanism")
    p.add_argument("--jaas-config")
    p.add_argument("--metrics-root", required=True, help="folder of the metrics store")
    p.add_argument("--checkpoint", required=True, help="shared folder; name the same one after a restart")
    p.add_argument("--dlq-path", help="folder of a file dead-letter sink")
    p.add_argument("--dlq-topic", help="Kafka topic of dead letters")
    p.add_argument("--progress-path", help="folder of the progress table")
    p.add_argument("--alerts-path", help="folder of the live alert rules' transitions")
    p.add_argument("--late-path", help="folder of the rows that the watermark drops")
    p.add_argument("--totals-path", help="folder of running totals and newest rejections")
    p.add_argument("--latency-path", help="folder of latency sketches per day")
    p.add_argument("--window", default="60 seconds")
    p.add_argument("--slide", default="10 seconds")
    p.add_argument("--watermark", default="2 minutes")
    p.add_argument("--trigger", default="10 seconds")
    p.add_argument("--available-now", action="store_true", help="take what is there, then end")
    p.add_argument("--distinct", choices=("approx", "exact"), default="approx")
    p.add_argument("--compact-every", type=int, default=60, help="batches between compactions of the store; 0: never")
    p.add_argument("--max-future-skew", help='for example "1 hour": events further ahead become dead letters')
    p.add_argument("--calendar-days-ahead", type=int, help="quarantine windows outside yesterday .. today + N days")
    return p


def main(args: list[str] | None = None) -> None:
    p = parser()
    a = p.parse_args(args)
    if (a.source == "kafka") != (a.source_path is None) or (a.source == "kafka" and not a.bootstrap):
        p.error("a kafka source needs --bootstrap, a file source --source-path")
    if bool(a.dlq_path) == bool(a.dlq_topic):
        p.error("name one of --dlq-path and --dlq-topic")
    if a.available_now and a.alerts_path:
        p.error("alerts are rules over time: they need a job that goes on")
    spark = get_spark(a.master, app="clickpulse-stream")
    if a.source == "kafka":
        options = kafka_options(a.bootstrap, a.topic, a.security_protocol, a.sasl_mechanism, a.jaas_config,
                                a.starting_offsets, max_offsets_per_trigger=a.max_offsets_per_trigger)
    else:
        options = {"maxFilesPerTrigger": str(a.max_files_per_trigger)} if a.max_files_per_trigger else {}
    raw = read_records(spark, a.source, options, path=a.source_path)
    dlq_kafka = kafka_sink_options(a.bootstrap, a.dlq_topic, None, a.security_protocol, a.sasl_mechanism,
                                   a.jaas_config) if a.dlq_topic else None
    cfg = JobConfig(metrics_root=a.metrics_root, checkpoint=a.checkpoint, dlq_path=a.dlq_path, dlq_kafka=dlq_kafka,
                    watermark=a.watermark, length=a.window, slide=a.slide, distinct=a.distinct,
                    trigger={"availableNow": True} if a.available_now else {"processingTime": a.trigger},
                    progress_path=a.progress_path, compact_every=a.compact_every or None, calendar_days_ahead=a.calendar_days_ahead,
                    max_future_skew=a.max_future_skew, alerts_path=a.alerts_path, late_path=a.late_path,
                    totals_path=a.totals_path, latency_path=a.latency_path)
    queries = start(spark, raw, cfg)
    if a.available_now:
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
