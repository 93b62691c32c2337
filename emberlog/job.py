"""Export, sample and import as a Spark job.

    spark-submit emberlog/job.py export --root /logs --index 'app-*' --query 'level:ERROR' \\
        --from now-24h --fields 'timestamp,message,level:severity' --format csv --output /out/errors
    spark-submit emberlog/job.py sample --root /logs --index 'app-*' --sample-size 100 --output /out/sample
    spark-submit emberlog/job.py import --samples /in/bundle.json --root /logs --day 2024-01-31
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from emberlog.logtable import LogTable  # noqa: E402
from emberlog.operators.catalogue import kind_of  # noqa: E402
from emberlog.operators.filters import ENTITIES  # noqa: E402
from emberlog.operators.ordering import DEFAULT_SAMPLE  # noqa: E402
from emberlog.operators.views import View  # noqa: E402
from emberlog.session import get_session  # noqa: E402
from emberlog.sources import importer, indices, sinks  # noqa: E402


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="emberlog", description=__doc__.splitlines()[0])
    steps = parser.add_subparsers(dest="step", required=True)
    for name in ("export", "sample"):
        step = steps.add_parser(name)
        step.add_argument("--root", required=True, help="folder that holds one folder per index")
        step.add_argument("--index", required=True, help="index name or pattern")
        step.add_argument("--input-format", default="parquet", help="parquet, json, ..., or imported for what `import` wrote")
        step.add_argument("--from", dest="frm")
        step.add_argument("--to")
        step.add_argument("--time-field")
        step.add_argument("--date-partition", help="date column the index folders are partitioned by")
        step.add_argument("--text-fields", default="message")
        step.add_argument("--tie-break", default="")
        step.add_argument("--output", required=True)
        for entity in ENTITIES:
            step.add_argument(f"--{entity}")
        if name == "export":
            step.add_argument("--query", default="*", help="search string, or a query body as JSON")
            step.add_argument("--query-file")
            step.add_argument("--fields")
            step.add_argument("--view")
            step.add_argument("--preset")
            step.add_argument("--view-file", help="JSON list of view columns")
            step.add_argument("--auto-detect", action="store_true", help="view by the kind of index")
            step.add_argument("--limit", type=int)
            step.add_argument("--format", choices=("json", "csv"), default="json")
        else:
            step.add_argument("--sample-size", type=int, default=DEFAULT_SAMPLE)
    load = steps.add_parser("import")
    load.add_argument("--samples", required=True)
    load.add_argument("--root", required=True)
    load.add_argument("--day", default=datetime.now(timezone.utc).strftime("%Y-%m-%d"))
    load.add_argument("--force", action="store_true")
    return parser


def _names(text: str) -> tuple[str, ...]:
    return tuple(name.strip() for name in text.split(",") if name.strip())


def _selected(spark: SparkSession, args) -> LogTable:
    """The rows of the indices asked for, cut by time and entities."""
    if args.input_format == "imported":
        df = importer.scan_imported(spark, args.root, args.index)
    else:
        df = indices.scan_folders(spark, args.root, args.index, args.input_format)
    text_fields = _names(args.text_fields)
    table = LogTable(
        df, args.time_field, text_fields, _names(args.tie_break), name=args.index, date_partition=args.date_partition
    )
    table = table.between(args.frm, args.to)
    wanted = {entity: getattr(args, entity) for entity in ENTITIES if getattr(args, entity)}
    for line in table.warnings(**wanted):
        print(f"warning: {line}", file=sys.stderr)
    return table.where_entity(**wanted)


def export(spark: SparkSession, args) -> None:
    if args.query_file and args.query != "*":
        raise SystemExit("give either --query or --query-file")
    query = Path(args.query_file).read_text() if args.query_file else args.query
    table = _selected(spark, args).search(query)
    if table.body is not None and table.body.aggs:
        for name, frame in table.aggregate().items():
            _write(frame, f"{args.output}/{name}", args.format)
        return
    view = args.view or args.preset
    if args.view_file:
        view = View.of(json.loads(Path(args.view_file).read_text()))
    detected = args.auto_detect and kind_of((), args.index) != "generic"
    if view or detected:
        newest = table.top(args.limit)
        shown = newest.view(view, preset=bool(args.preset)) if view else newest.auto_view()
        _write(shown.select(args.fields).df if args.fields else shown.df, args.output, args.format)
        return
    _write(table.export(args.fields, args.limit), args.output, args.format)


def _write(df: DataFrame, path: str, file_format: str) -> None:
    (sinks.write_csv if file_format == "csv" else sinks.write_json)(df, path)


def sample(spark: SparkSession, args) -> None:
    table = _selected(spark, args)
    described = {"pattern": args.index, "from": args.frm or "", "to": args.to or ""}
    sinks.write_sample(
        table.df, args.output, table.time_field, args.sample_size, table.tie_break, metadata=described, text_fields=table.text_fields
    )


def load(spark: SparkSession, args) -> None:
    mapping = importer.import_file(spark, args.samples, args.root, args.day, args.force)
    for row in mapping.groupBy("_index").count().orderBy("_index").toLocalIterator():
        print(f"{row['_index']}: {row['count']} fields, in {args.root.rstrip('/')}/{importer.MAPPINGS}")


def main(argv: list[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = get_session(f"emberlog-{args.step}")
    {"export": export, "sample": sample, "import": load}[args.step](spark, args)


if __name__ == "__main__":
    main()
