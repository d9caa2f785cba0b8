"""Arguments that the programs share."""

from argparse import ArgumentParser, ArgumentTypeError

from turnout.streaming.queries import INTERVAL


def pair(text: str) -> tuple[str, str]:
    name, found, value = text.partition("=")
    if not found or not name:
        raise ArgumentTypeError(f"expected NAME=VALUE, got {text!r}")
    return name, value


def add_option(parser: ArgumentParser, flag: str, of: str) -> None:
    parser.add_argument(
        flag, action="append", default=[], type=pair, metavar="NAME=VALUE", help=f"option of {of}"
    )


def add_trigger(parser: ArgumentParser) -> None:
    parser.add_argument("--interval", default=INTERVAL, help="time between micro-batches")
    parser.add_argument("--once", action="store_true", help="take all there is, then stop")


def interval(args) -> str | None:
    return None if args.once else args.interval
