"""Command line: ``python -m cartulary {harvest,report,convert,inspect} …``."""

from __future__ import annotations

import argparse

from cartulary.plans import jobs
from cartulary.session import builder
from cartulary.settings import JobSettings
from cartulary.sinks.exports import write_table
from cartulary.sources.documents import land, read_documents
from cartulary.sources.exports import read_export, read_memory
from cartulary.sources.lists import ID_COLUMN, identifier_list, identifiers, read_table
from cartulary.staging import staging


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cartulary")
    commands = parser.add_subparsers(dest="command", required=True)

    harvest = commands.add_parser("harvest", help="list the files still to fetch")
    harvest.add_argument("ids", nargs="*", help="record ids, or one table that holds them")
    harvest.add_argument("--id-column", default=ID_COLUMN)
    harvest.add_argument("--folder", required=True, help="where fetched files are kept")
    harvest.add_argument("--base-url", required=True)
    harvest.add_argument("--overwrite", action="store_true")

    report = commands.add_parser("report", help="failures and totals of a finished harvest")
    report.add_argument("--statuses", required=True, help="table of record_id, url, status")

    convert = commands.add_parser("convert", help="convert a folder or a pattern of XML files")
    convert.add_argument("--files", required=True)
    convert.add_argument("--user", default="unknown")
    convert.add_argument("--region", default="")
    convert.add_argument("--shares", default="", help="comma-separated persons")
    convert.add_argument("--house-name", action="append", default=[])
    convert.add_argument("--registry", help="table with a doi column")
    convert.add_argument("--memory", help="translation memory: a table, JSON lines, or one JSON object")
    convert.add_argument("--returned", help="table of cache_key, translated: new translations")
    convert.add_argument("--vocabulary", help="table of category, term; else the built-in one")
    convert.add_argument("--append-to", help="an earlier export: its folder, or a JSON envelope")

    convert.add_argument("--share-mode", choices=("replace", "merge"), default="replace")
    convert.add_argument("--extend", action="store_true", help="write the output's next version, with its earlier records")

    inspect = commands.add_parser("inspect", help="profile an attribute")
    inspect.add_argument("--files", required=True)
    inspect.add_argument("--attribute", default="keywords")
    inspect.add_argument("--by-file", action="store_true")

    for command in (harvest, convert, inspect):
        command.add_argument("--dialect", choices=("iso", "fgdc"), default="iso")
    for command in (harvest, report, convert, inspect):
        command.add_argument("--output", required=True)
    args = parser.parse_args()
    if args.command == "convert" and args.extend and args.append_to:
        parser.error("--extend appends to the output's own earlier version; leave --append-to out")
    return args


def main() -> None:
    args = _arguments()
    spark = builder(f"cartulary {args.command}").getOrCreate()
    if args.command == "harvest":
        if len(args.ids) == 1 and args.ids[0].endswith((".csv", ".json", ".jsonl", ".parquet")):
            wanted = identifiers(read_table(spark, args.ids[0]), args.id_column)
        else:
            wanted = identifier_list(spark, args.ids)
        work = jobs.plan_harvest(
            spark, wanted, args.folder, args.base_url, args.dialect, args.overwrite
        )
        write_table(work, args.output, "json")
    elif args.command == "report":
        jobs.report_harvest(read_table(spark, args.statuses), args.output)
    elif args.command == "convert":
        settings = JobSettings(
            user=args.user,
            region=args.region,
            shares=args.shares.split(","),
            house_names={name: [name, ""] for name in args.house_name},
        )
        options = {
            "registry": read_table(spark, args.registry) if args.registry else None,
            "memory": read_memory(spark, args.memory) if args.memory else None,
            "returned": read_memory(spark, args.returned) if args.returned else None,
            "vocabulary": read_table(spark, args.vocabulary) if args.vocabulary else None,
            "share_mode": args.share_mode,
        }
        if args.extend:
            jobs.extend_export(spark, args.files, args.output, args.dialect, settings, **options)
        else:
            earlier = read_export(spark, args.append_to, jobs.record_schema(spark, args.dialect)) if args.append_to else None
            jobs.convert(spark, args.files, args.output, args.dialect, settings, append_to=earlier, **options)
    else:
        with staging(spark) as keep:
            landed = keep(land(read_documents(spark, args.files, args.dialect), args.dialect))
            write_table(jobs.inspect(landed, args.attribute, args.by_file), args.output, "json")


if __name__ == "__main__":
    main()
