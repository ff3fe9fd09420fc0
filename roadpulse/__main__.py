"""``python -m roadpulse producer|consumer-hdfs|consumer-elasticsearch|mapmatch ...``"""

from __future__ import annotations

import argparse

from roadpulse.plans import jobs
from roadpulse.session import build_session


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="roadpulse")
    programs = parser.add_subparsers(dest="program", required=True)

    producer = programs.add_parser("producer", help="text files to a topic")
    producer.add_argument("--path", required=True)
    producer.add_argument("--parsed", help="folder for good and rejected records")

    for name in ("consumer-hdfs", "consumer-elasticsearch"):
        consumer = programs.add_parser(name, help="topic to counts per grid cell")
        consumer.add_argument("--window", type=int, required=True, help="minutes")
        consumer.add_argument("--sink", required=True, help="folder, or search nodes")
        consumer.add_argument("--checkpoint", required=True)
        consumer.add_argument("--parsed", help="folder for good and rejected records")

    for program in programs.choices.values():
        program.add_argument("--topic", required=True)
        program.add_argument("--brokers", default="localhost:9092")

    match = programs.add_parser("mapmatch", help="text files to traffic per road segment")
    match.add_argument("--input", required=True, help="folder of text files")
    match.add_argument("--roads", required=True, help="Parquet road table")
    match.add_argument("--window", type=int, default=2, help="minutes")
    match.add_argument("--max-dist", type=float, default=0.001, help="degrees of latitude")
    match.add_argument("--sink", help="folder; default: print")
    match.add_argument("--parsed", help="folder for good and rejected records")
    for program in programs.choices.values():
        program.add_argument("--scratch", help="shared folder for intermediate tables")
    return parser


def main(argv: list[str] | None = None) -> None:
    options = arguments().parse_args(argv)
    scratch = {"spark.checkpoint.dir": options.scratch} if options.scratch else {}
    spark = build_session(f"roadpulse-{options.program}", **scratch)
    if options.program in ("producer", "mapmatch"):
        if options.program == "producer":
            rejected = jobs.produce(
                spark, options.path, options.brokers, options.topic, options.parsed
            )
        else:
            rejected = jobs.map_match(
                spark,
                options.input,
                options.roads,
                options.window,
                options.max_dist,
                options.sink,
                options.parsed,
            )
        rejected.groupBy("reject").count().show()
        return
    to_folders = options.program == "consumer-hdfs"
    consume = jobs.consume_to_folders if to_folders else jobs.consume_to_search
    query = consume(
        spark,
        options.brokers,
        options.topic,
        options.window,
        options.sink,
        options.checkpoint,
        options.parsed,
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()
