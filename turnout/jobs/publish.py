"""Publish a landed feed (text files, one JSON message per line) to a topic."""

from argparse import ArgumentParser
from collections.abc import Sequence

from turnout.jobs.options import add_option, add_trigger, interval
from turnout.session import job_session
from turnout.sources.messages import feed_lines
from turnout.streaming.queries import await_all, start_publish
from turnout.streaming.sinks import table_sink


def arguments() -> ArgumentParser:
    parser = ArgumentParser(description=__doc__)
    parser.add_argument("--feed", required=True, help="folder where the feed lands")
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", required=True)
    parser.add_argument("--connector", default="kafka")
    parser.add_argument("--rejected", required=True, help="folder for lines that are not JSON")
    parser.add_argument("--checkpoint", required=True)
    add_option(parser, "--feed-option", "the feed reader, such as maxFilesPerTrigger")
    add_option(parser, "--topic-option", "the topic writer")
    add_trigger(parser)
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = job_session("publish")
    query = start_publish(
        feed_lines(spark, args.feed, **dict(args.feed_option)),
        args.servers,
        args.topic,
        table_sink(args.rejected),
        args.checkpoint,
        interval=interval(args),
        name="publish",
        connector=args.connector,
        **dict(args.topic_option),
    )
    await_all([query])


if __name__ == "__main__":
    main()
