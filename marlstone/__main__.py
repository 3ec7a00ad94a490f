"""Command line: documents in, result JSON, tables and a summary out.

    python -m marlstone paper.txt -o result.json --table-csv conditions --table-xlsx table.xlsx
    spark-submit --master ... marlstone/__main__.py 'shared/texts/*.txt' -o shared/results
"""

from __future__ import annotations

import argparse
import glob
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from marlstone.functions.lexicon import Vocabulary
from marlstone.plans import pipeline, summary
from marlstone.sources import files, responses, services


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="marlstone", description="Structured records out of technical documents.")
    parser.add_argument("input", help="a text file, or a pattern of several")
    parser.add_argument("-o", "--output", default="extracted.json", help="result JSON: a file, or for several documents a folder of JSON lines")
    parser.add_argument("--no-validation", action="store_true", help="take all names as valid")
    parser.add_argument("--online-validation", action="store_true", help="look names up over the network")
    parser.add_argument("--recognize", action="store_true", help="names by a recogniser that learns from the documents, too")
    parser.add_argument("--threshold", type=float, default=0.5, help="share of the top name's count that main names have (0 to 1)")
    parser.add_argument("--no-summary", action="store_true")
    parser.add_argument("--output-mode", choices=("compact", "full"), default="compact", help="full keeps snippets and grades")
    parser.add_argument("--llm-provider", choices=("http", "rules"), default="http", help="a service, or plain rules without one")
    parser.add_argument("--llm-model", default="qwen2.5:7b")
    parser.add_argument("--llm-models", default=None, help="several models, with commas")
    parser.add_argument("--llm-consensus", type=int, default=0, help="models that have to agree (0: two of several)")
    parser.add_argument("--llm-host", default="http://127.0.0.1:11434")
    parser.add_argument("--llm-timeout", type=float, default=120.0, help="seconds")
    parser.add_argument("--llm-max-context", type=int, default=6000, help="characters of a chunk")
    for switch in ("--llm-no-start-server", "--llm-no-http"):
        parser.add_argument(switch, action="store_true", help="taken and of no effect: no server is started, and answers come over HTTP or from rules")
    parser.add_argument("--ledger", default=None, help="folder that keeps answers and names over runs")
    parser.add_argument("--no-llm-postprocess", action="store_true", help="leave the table as it is")
    parser.add_argument("--llm-postprocess-max-rows", type=int, default=60)
    parser.add_argument("--table-csv", default=None, help="folder for the table as CSV")
    parser.add_argument("--table-xlsx", default=None, help="file for the table as a workbook")
    args = parser.parse_args(given)
    if not 0 <= args.threshold <= 1:
        parser.error("threshold lies in 0 to 1")
    return args


def config(args: argparse.Namespace) -> pipeline.Config:
    models = tuple(m.strip() for m in (args.llm_models or args.llm_model).split(",") if m.strip())
    clean = not args.no_llm_postprocess and args.llm_provider != "rules"
    return pipeline.Config(models=models, consensus=args.llm_consensus, threshold=args.threshold, validate_names=not args.no_validation, recognize=args.recognize, max_chars=args.llm_max_context, compact=args.output_mode == "compact", clean=clean, clean_rows=args.llm_postprocess_max_rows)


def main(given: list[str] | None = None) -> int:
    args = arguments(given)
    if "://" not in args.input and not glob.glob(args.input):
        print(f"no such file: {args.input}", file=sys.stderr)
        return 1
    began = time.perf_counter()
    spark = SparkSession.builder.appName("marlstone").getOrCreate()
    where = args.input if "://" in args.input else "file://" + os.path.abspath(args.input)
    docs = files.text_documents(spark, where).select(F.col("path").alias("doc_id"), "text")
    settings = config(args)
    source = responses.Rules(Vocabulary().solvents) if args.llm_provider == "rules" else responses.Http(responses.Client(host=args.llm_host, timeout=args.llm_timeout), args.ledger and f"{args.ledger}/answers")
    known = pipeline.online_names(docs, services.NameService(), ledger=args.ledger and f"{args.ledger}/names") if args.online_validation else None
    tables = pipeline.run(docs, source, settings, known)
    out = pipeline.cut(pipeline.result(docs, tables))
    table = pipeline.cut(tables["conditions_table"])
    files.save_result(out, args.output)
    if args.table_csv:
        files.save_csv(table, args.table_csv)
    if args.table_xlsx:
        files.save_sheet(table, args.table_xlsx)
    if not args.no_summary:
        counters = tables["counters"].first()
        for row in out.orderBy("doc_id").limit(20).collect():  # a screen's worth of documents
            for line in summary.lines(row, counters, time.perf_counter() - began):
                print(summary.plain(line))
    print(f"written to {args.output}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
