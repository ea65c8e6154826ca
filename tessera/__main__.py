"""Command line: ``python -m tessera COMMAND``; thin wrappers around the workflows."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .operators import corrections, workqueue
from .plans import workflows
from .sources import readers, writers


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessera")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, args in {
        "crosswalk": ["registry", "lineage", "panel", "out"],
        "extract": ["documents", "panel", "out"],
        "review": ["documents", "panel"],
        "apply": ["documents", "panel", "corrections", "out"],
        "validate": ["documents"],
        "compare": ["documents", "panel"],
        "population": ["cache", "panel", "out"],
        "status": ["folder"],
        "next": ["folder"],
        "report": ["ledger"],
        "stream": ["folder", "out", "checkpoint"],
    }.items():
        sub = commands.add_parser(name)
        for a in args:
            sub.add_argument(a)
        sub.add_argument("--dry-run", action="store_true")
        sub.add_argument("--limit", type=int, default=3)
        sub.add_argument("--total", type=int, default=188)
    a = parser.parse_args(argv)
    spark = workflows.session()
    if a.command == "crosswalk":
        made = workflows.build_crosswalk(readers.read_registry(spark, a.registry), readers.read_lineage(spark, a.lineage), readers.read_panel(spark, a.panel))
        if not a.dry_run:
            writers.write_csv(made["crosswalk"], f"{a.out}/crosswalk", list(writers.CROSSWALK))
            writers.write_csv(made["crosswalk"].where("territory_transfer_flag"), f"{a.out}/territory", ["codistat_1950", "name_1950", "province_1950", "status"])
        print(writers.render_summary(made["crosswalk"], made["forward"]))
    elif a.command in ("extract", "review", "compare", "apply"):
        panel = readers.read_panel(spark, a.panel)
        made = workflows.link_extractions(readers.read_documents(spark, a.documents), panel)
        if a.command == "extract":
            writers.write_csv(made["linked"], f"{a.out}/extraction")
            writers.write_json(made["review"], f"{a.out}/review")
        elif a.command == "review":
            made["review"].orderBy("match_rate").show(200, truncate=False)
        elif a.command == "compare":
            from .operators.validation import compare_tally

            compare_tally(made["linked"]).show()
        else:
            fixes = corrections.parse_corrections(spark.read.text(a.corrections, wholetext=True))
            filled = workflows.correct_and_fill(made["linked"], fixes, panel)
            print(writers.update_column(filled["panel"], f"{a.out}/panel", a.dry_run), "filled")
    elif a.command == "validate":
        workflows.validate_documents(readers.read_documents(spark, a.documents))["verdicts"].orderBy("file").show(1000, truncate=False)
    elif a.command == "population":
        made = workflows.link_population(readers.read_ocr_cache(spark, a.cache), readers.read_panel(spark, a.panel))
        if not a.dry_run:
            writers.write_csv(writers.population_rows(made["linked"]), f"{a.out}/population")
        made["linked"].groupBy("match_type").count().show()
    elif a.command in ("status", "next"):
        inventory = workqueue.pair_inventory(spark, a.total)
        texts = readers.read_documents(spark, a.folder, "pair_*.json").select(F.col("stem").alias("id"), F.coalesce(F.try_variant_get(F.try_parse_json("value"), "$._skip", "boolean"), F.lit(False)).alias("skipped"))
        locks = readers.list_files(spark, a.folder, "pair_*.lock").select("id")
        if a.command == "status":
            workqueue.queue_status(inventory, texts, locks).show()
        else:
            workqueue.remaining(inventory, workqueue.done_ids(texts, locks)).orderBy("id").limit(a.limit).show()
    elif a.command == "report":
        workqueue.ledger_report(readers.read_or_empty(spark, a.ledger)).show()
    else:
        from .streaming.queue import run_queue

        run_queue(spark, a.folder, a.out, a.checkpoint, a.limit, dry_run=a.dry_run).awaitTermination()


if __name__ == "__main__":
    main()
