"""Run a job from the command line: ``python -m skyledger <job> [options]``."""

from __future__ import annotations

import argparse
import os

from skyledger import plans
from skyledger.operators import outcome_counts
from skyledger.plans.analytics import ANALYTICS_DIR
from skyledger.plans.clean import CLEANED_PATH, RAW_PATH
from skyledger.plans.report import CHART_AIRPORT
from skyledger.session import build_session
from skyledger.sinks import write_table
from skyledger.sources.messages import DEFAULT_BROKERS, DEFAULT_TOPIC
from skyledger.streaming import wait_for_all, wait_for_any


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skyledger", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, help, source=None, target=None):
        sub = jobs.add_parser(name, help=help)
        sub.add_argument("--source", default=source, required=source is None)
        if target is not False:
            sub.add_argument("--target", default=target, required=target is None)
        return sub

    job("clean", "raw delimited flights to a cleaned table", RAW_PATH, CLEANED_PATH)
    ingest = job("ingest", "zip archives to day files")
    ingest.add_argument("--bucket", default="")
    ingest.add_argument("--report", help="store the outcomes and the manifest as tables here")
    job("analytics", "answer the batch questions", CLEANED_PATH, ANALYTICS_DIR)
    report = job("report", "chart tables from the stored answers", ANALYTICS_DIR, f"{ANALYTICS_DIR}/visuals")
    report.add_argument("--airport", default=CHART_AIRPORT)
    train = job("train", "fit, evaluate, log and store the delay model", CLEANED_PATH, "data/models")
    train.add_argument("--fit-on", choices=("train", "all"), default="train")
    train.add_argument("--trees", type=int)

    brokers = os.environ.get("KAFKA_HOSTS", DEFAULT_BROKERS)
    publish = job("publish", "flights to a topic, or to message files", RAW_PATH, False)
    publish.add_argument("--format", default="kafka")
    publish.add_argument("--path")
    publish.add_argument("--files-per-batch", type=int)
    publish.add_argument("--records-per-batch", type=int)
    publish.add_argument("--every", help="shortest time between batches, as '500 milliseconds'")
    live = jobs.add_parser("live", help="running mean delays from a topic, or from message files")
    live.add_argument("--messages", help="folder of message files instead of a topic")
    live.add_argument("--tables", help="keep the results as tables here instead of printing them")
    live.add_argument("--max-per-trigger", type=int, help="messages of a topic in one micro-batch at most")
    live.add_argument("--min-tasks", type=int, help="tasks that read a topic at least")
    live.add_argument("--record-id", help="field by which a message sent again is known, as 'record_id'")
    live.add_argument("--within", default="1 hour", help="how long such a message is remembered")
    live.add_argument("--available-now", action="store_true", help="stop when all input is read")
    for sub in (publish, live):
        sub.add_argument("--brokers", default=brokers)
        sub.add_argument("--topic", default=DEFAULT_TOPIC)
        sub.add_argument("--checkpoint")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"skyledger-{args.job}")
    if args.job == "clean":
        plans.run_clean(spark, args.source, args.target)
    elif args.job == "ingest":
        done = plans.run_ingest(spark, args.source, args.target, bucket=args.bucket)
        outcome_counts(done.outcomes).show()
        if args.report:
            write_table(done.outcomes, f"{args.report}/outcomes")
            write_table(done.manifest, f"{args.report}/manifest")
    elif args.job == "analytics":
        answers = plans.run_analytics(spark, args.source, args.target)
        answers.busiest_airports.show(5)
        answers.delay_by_carrier.show(5)
        answers.delay_by_weekday.show(7)
    elif args.job == "report":
        for chart in plans.run_report(spark, args.source, args.target, args.airport):
            chart.show()
    elif args.job == "train":
        options = {} if args.trees is None else {"trees": args.trees}
        plans.run_training(spark, args.source, args.target, fit_on=args.fit_on, **options).metrics.show()
    elif args.job == "publish":
        plans.run_publish(
            spark, args.source, args.brokers, args.topic, args.format, args.path,
            args.files_per_batch, args.records_per_batch, args.checkpoint, args.every,
        )
    else:
        source = {}
        if args.messages:
            from skyledger.sources import file_messages

            source["messages"] = file_messages(spark, args.messages)
        else:
            source |= {
                "brokers": args.brokers, "topic": args.topic,
                "max_per_trigger": args.max_per_trigger, "min_tasks": args.min_tasks,
            }
        queries = plans.run_live(
            spark, tables=args.tables, checkpoint=args.checkpoint,
            available_now=args.available_now, record_id=args.record_id, within=args.within, **source,
        )
        if args.available_now:
            wait_for_all(queries)
        else:
            wait_for_any(spark)


if __name__ == "__main__":
    main()
