"""Command line: run the whole pipeline or one stage for a date.

    python -m clientlens STAGE DATE --root DIR ...

Exit status is 0 when every table of every stage was loaded with rows.
"""

from __future__ import annotations

import argparse
import logging
import sys

from .plans import pipeline
from .schemas import ENTITIES
from .sources import envelope
from .sources.layers import Layers
from .streaming import ingest as streams
from .workspace import drop_scratch, session

log = logging.getLogger("clientlens")

STAGES = ("publish", "ingest", "clean", "dedup", "segment", "mart", "analytics", "report", "compact", "run", "increment")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="clientlens", description=__doc__)
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("date", help="processing date, YYYY-MM-DD")
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--messages", help="folder of file-based topics")
    parser.add_argument("--servers", help="Kafka bootstrap servers, instead of --messages")
    parser.add_argument("--topics", help="topics to read, separated by commas or blanks (default all)")
    parser.add_argument("--prefix", default="", help="prefix of all topic names")
    parser.add_argument("--files", help="folder of input files (publish)")
    parser.add_argument("--suffix", default="csv", choices=("csv", "parquet"), help="kind of input files")
    parser.add_argument("--multi-line", action="store_true", help="CSV cells may hold line breaks")
    parser.add_argument("--fixed-offsets", action="store_true", help="a repeated run reads the messages of its first start")
    parser.add_argument("--compact", action="store_true", help="merge the month's marts at the end of a run")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    spark = session()
    layers = Layers(args.root)
    month = int(args.date[:4] + args.date[5:7])
    entities = list(ENTITIES.values())
    if args.topics:
        entities, unknown = envelope.entities_of(envelope.parse_topics(args.topics), args.prefix)
        for topic in unknown:
            log.warning("topic %s is unknown and skipped", topic)

    def messages_of(entity):
        topic = f"{args.prefix}{entity.topic}"
        if args.servers:
            return envelope.read_topic(spark, args.servers, topic)
        return envelope.read_envelope(spark, args.messages, topic)

    def stream_of(entity):
        topic = f"{args.prefix}{entity.topic}"
        if args.servers:
            return streams.stream_topic(spark, args.servers, topic)
        return streams.stream_files(spark, args.messages, topic)

    def send(rows, entity):
        topic = f"{args.prefix}{entity.topic}"
        if args.servers:
            envelope.write_topic(rows, args.servers, topic)
        else:
            envelope.write_envelope(rows, args.messages, topic)

    stages = {
        "publish": lambda: pipeline.publish(
            spark, args.files, send, args.suffix, entities, f"{args.root}/unparsed/{args.date}", args.multi_line
        ),
        "ingest": lambda: pipeline.ingest(spark, messages_of, layers, args.date, entities),
        "clean": lambda: pipeline.clean_layer(spark, layers, args.date, entities),
        "dedup": lambda: pipeline.dedup_layer(spark, layers, args.date),
        "segment": lambda: pipeline.segmentation_layer(spark, layers, args.date),
        "mart": lambda: pipeline.mart_layer(spark, layers, args.date),
        "analytics": lambda: pipeline.analytics_layer(spark, layers, args.date),
        "report": lambda: pipeline.report_layer(spark, layers, args.date),
        "compact": lambda: pipeline.compact_layer(spark, layers, month),
        "run": lambda: pipeline.run_pipeline(
            spark, messages_of, args.root, args.date, None, month if args.compact else None, entities, True, args.fixed_offsets
        ),
        "increment": lambda: pipeline.run_incremental(
            spark, stream_of, args.root, args.date, None, month if args.compact else None, entities, True
        ),
    }
    try:
        lines = stages[args.stage]()
    finally:
        drop_scratch(spark)
    report = pipeline.load_report(spark, lines)
    report.show(len(lines), truncate=False)
    pipeline.load_totals(report).show(truncate=False)
    return 0 if lines and all(line.ok for line in lines) else 1


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    sys.exit(main())
