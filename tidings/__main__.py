"""Command line: `python -m tidings COMMAND ...`.

Commands: query, start (crawl and update check in turn), crawl, update-check, summarize, validate-attachments, validate-markdown, backfill-content, backfill-referer,
backfill-attachments, backfill-downloads, artifacts. A backfill without --apply only counts; with it, it asks first unless --yes
is given. `--progress DIR` does a content backfill in units and goes on where it was stopped. Exit codes: 0 done, 1 issues found or not confirmed, 2 done in part.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.operators import backfill, catalog, changes, enrich, merge, quality
from tidings.operators.store import Buckets
from tidings.plans import flows, resume
from tidings.plans.queries import QUERIES
from tidings.session import configure, load_config, log_counters
from tidings.sources import boards, fetching

BACKFILLS = ("backfill-content", "backfill-referer", "backfill-attachments", "backfill-downloads")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidings", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    q = sub.add_parser("query")
    q.add_argument("name", nargs="?")
    q.add_argument("sf_dir", nargs="?")
    for name in ("start", "crawl", "update-check", "summarize", "validate-attachments", "validate-markdown", *BACKFILLS):
        c = sub.add_parser(name)
        c.add_argument("--store", required=True)
        c.add_argument("--catalog", required=name not in ("summarize", "validate-markdown"))
        c.add_argument("--source", action="append")
        c.add_argument("--limit", type=int)
        c.add_argument("--successes", type=int)
        c.add_argument("--apply", action="store_true")
        c.add_argument("--yes", action="store_true")
        c.add_argument("--progress")
        c.add_argument("--every", type=float, default=900.0)
        c.add_argument("--runs", type=int)
        c.add_argument("--json", action="store_true")
        c.add_argument("--days", type=int, default=14)
        c.add_argument("--full", action="store_true")
        c.add_argument("--no-http", action="store_true")
        c.add_argument("--hosts", default="")
        c.add_argument("--min-severity", default="warning", choices=("warning", "error"))
    a = sub.add_parser("artifacts")
    a.add_argument("--catalog", required=True)
    a.add_argument("--categories", required=True)
    a.add_argument("--out", required=True)
    return p


def network(make=fetching.PAGES):
    return lambda requests: fetching.fetch_rounds(requests, make)


def report(checked: DataFrame, as_json: bool) -> int:
    """Print the report; the exit code is 1 if there are issues."""
    total = quality.report(checked).first()
    if as_json:
        for r in quality.json_report(checked).toLocalIterator():
            print(r["text"])
    else:
        print(total.asDict())
        quality.issue_counts(checked).show(50, truncate=80)
    return int(total["issues"] > 0)


def told(event: str, counts: DataFrame) -> int:
    """Log the counters, which are small, and give the exit code that they hold."""
    rows = counts.collect()
    log_counters(event, rows)
    return int(rows[0].asDict().get("exitCode", 0)) if rows else 0


def backfilled(args, store: Buckets, state: DataFrame, sources: DataFrame) -> int:
    pick = {
        "backfill-content": backfill.content_candidates, "backfill-referer": backfill.referer_candidates,
        "backfill-attachments": lambda x: backfill.on_boards(backfill.empty_attachment_candidates(x), sources, "standard"),
        "backfill-downloads": lambda x: backfill.on_boards(backfill.download_manager_candidates(x), sources, "wordpress-api"),
    }[args.command]

    def chosen(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col("sourceId").isin(args.source)) if args.source else rows
        return pick(rows).orderBy("sourceId", "articleNo").limit(args.limit) if args.limit else rows

    own = chosen(state)
    n, go = backfill.gate(pick(own), args.apply)
    print(f"{n} notices concerned" + ("" if go else "; nothing written"))
    if not go:
        return 0
    if not args.yes and ask(f"write to {store.path}? [yes/N] ") != "yes":
        return 1
    if args.command == "backfill-content":
        _, counts = backfill.backfill_content(own, sources, F.current_timestamp())
        code = told(args.command, counts)  # from the table as it is, before its buckets are written anew

        def renew(part: DataFrame) -> None:
            store.write(backfill.backfill_content(part, sources, F.current_timestamp())[0])

        if args.progress:
            print(f"{resume.Units(store.spark, args.progress).run(lambda: chosen(store.read()), renew)} units done")
        else:
            renew(own)
        return code
    if args.command == "backfill-referer":
        store.merge(backfill.backfill_referer(own, sources), backfill.replace_attachments)
        return 0
    outcomes = flows.refetch_changes(sources, network(), pick(own), successes=args.successes)
    store.merge(outcomes.where("outcome = 'updated'").select("sourceId", "articleNo", "attachments"), backfill.replace_attachments)
    return told(args.command, backfill.backfill_counters(outcomes))


def ask(question: str) -> str:
    """What the user types, in lower case; nothing where there is no terminal."""
    try:
        return input(question).strip().lower()
    except EOFError:
        return ""


def summarised(store: Buckets, now, limit: int) -> None:
    """One batch of unsummarised notices, then one of notices changed since; the second sees the first's writes."""
    for choose in (enrich.pending, enrich.stale):
        store.merge(enrich.summarise(choose(store.read(), limit)), lambda state, done: enrich.write_summaries(state, done, now))


def scheduled(spark: SparkSession, args, sleep=time.sleep, clock=time.monotonic) -> int:
    """Crawl and update check in turn, every so many seconds, without overlap: a run that takes longer delays the next.

    A run that fails is logged and tried again at the next turn. Ends after `--runs`, with 2 if any of them failed.
    """
    done = failed = 0
    while args.runs is None or done < args.runs:
        began = clock()
        for command in ("crawl", "update-check"):
            try:
                run(spark, argparse.Namespace(**vars(args) | {"command": command}))
            except Exception:  # whatever it was, the schedule goes on
                failed += 1
                logging.getLogger("tidings").exception(command)
        done += 1
        if (args.runs is None or done < args.runs) and (pause := args.every - (clock() - began)) > 0:
            sleep(pause)
    return 2 * (failed > 0)


def run(spark: SparkSession, args) -> int:
    if args.command == "start":
        return scheduled(spark, args)
    if args.command == "query":
        if args.name not in QUERIES or not args.sf_dir:
            print("\n".join(QUERIES))
            return int(bool(args.name))
        QUERIES[args.name](spark, args.sf_dir).show(50, truncate=80)
        return 0
    config = load_config()
    boards.rename(dict(config.board_names))
    if args.command == "artifacts":
        sources, categories = catalog.read_sources(spark, args.catalog), catalog.read_categories(spark, args.categories)
        made = {
            "enum": catalog.source_enum(sources), "sources": catalog.server_sources(sources), "categories": catalog.server_categories(categories, sources),
            "env": catalog.filter_line(sources).withColumn("pos", F.lit(0)), "coverage": catalog.coverage_report(sources),
            "by-college": catalog.college_report(sources), "by-category": catalog.category_report(sources, categories),
        }
        for name, lines in made.items():
            catalog.write_text(lines, f"{args.out}/{name}")
        return 0
    store = Buckets(spark, args.store)
    store.recover()
    now = F.current_timestamp()
    sources = catalog.load_and_validate(spark, args.catalog) if args.catalog else None
    wanted = args.source or (list(config.source_filter) if config.source_filter else None)
    if args.command == "crawl":
        today = spark.range(1).select(F.date_format(F.current_date(), "yyyy-MM-dd").alias("d")).first()["d"]
        state = store.of_sources(changes.select_sources(sources, wanted))
        incoming, counts = flows.crawl_changes(state, sources, network(), now, today, wanted=wanted, incremental=not args.full, images=network(fetching.IMAGES))
        store.merge(incoming, merge.merge_notices)
        return told(args.command, counts)
    if args.command == "update-check":
        chosen = changes.select_sources(sources, wanted)
        outcomes, counts = flows.check_changes(store.of_sources(chosen), chosen, network(), F.current_date(), days=args.days)
        store.merge(outcomes, lambda state, found: merge.apply_check(state, found, now))
        return told(args.command, counts)
    if args.command == "summarize":
        summarised(store, now, args.limit or 50)
        return 0
    state = store.read()
    if args.command == "validate-attachments":
        checked = quality.check_attachments(state, sources, [h for h in args.hosts.split(",") if h], wanted=args.source, limit=args.limit)
        return report(checked if args.no_http else flows.reachability(checked, network(fetching.HEADS)), args.json)
    if args.command == "validate-markdown":
        rows = state.where(F.col("sourceId").isin(args.source)) if args.source else state
        return report(quality.check_markdown(rows.limit(args.limit) if args.limit else rows, min_severity=args.min_severity), args.json)
    return backfilled(args, store, state, sources)


def main(argv: list[str]) -> int:
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    args = parser().parse_args(argv)
    return run(configure(SparkSession.builder.appName(os.environ.get("APP_NAME", "tidings")).getOrCreate()), args)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
