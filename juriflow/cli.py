"""Command line: inspect, run, rebuild-review, build-gold, build-sft."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from juriflow.operators.router import load_profiles
from juriflow.operators.teacher import teacher
from juriflow.plans import extract, training
from juriflow.sources import outputs, xlsx


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="juriflow")
    verbs = top.add_subparsers(dest="verb", required=True)
    p = verbs.add_parser("inspect", help="count rows, classes and organs")
    p.add_argument("--input", required=True)
    p.add_argument("--sheet")
    p.add_argument("--limit", type=int)
    p = verbs.add_parser("run", help="extract candidate passages")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--sheet")
    p.add_argument("--limit", type=int)
    p.add_argument("--unique-limit", type=int)
    p.add_argument("--start-index", type=int, default=0)
    p.add_argument("--teacher", choices=["llama", "rules"], default="llama")
    p.add_argument("--max-candidates", type=int, default=3)
    p.add_argument("--include-execucao-fiscal", action="store_true")
    p.add_argument("--profiles", help="router profiles (JSON)")
    for name in ("rebuild-review", "build-gold"):
        p = verbs.add_parser(name)
        p.add_argument("--review", required=True)
        p.add_argument("--output", required=True)
    p = verbs.add_parser("build-sft")
    p.add_argument("--gold", required=True)
    p.add_argument("--outdir", required=True)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("juriflow").getOrCreate()
    if a.verb == "inspect":
        found = extract.inspect(xlsx.read_table(spark, a.input, a.sheet), a.limit)
        out = found["rows"].head().asDict()
        out |= {k: [list(r)[:2] for r in found[k].collect()] for k in ("top_classes", "top_organs", "class_families")}
    elif a.verb == "run":
        began = time.time()
        settings = {
            "input": a.input, "sheet": a.sheet, "teacher_mode": a.teacher, "start_index": a.start_index, "limit": a.limit,
            "unique_limit": a.unique_limit, "max_candidates": a.max_candidates,
        }
        profiles = {"profiles": load_profiles(a.profiles)} if a.profiles else {}
        run = extract.run(
            xlsx.read_table(spark, a.input, a.sheet), a.teacher, a.max_candidates, a.include_execucao_fiscal, a.start_index, a.limit, a.unique_limit,
            teacher=teacher() if a.teacher == "llama" else None, keep=True, **profiles,
        )
        out = outputs.write_run(run, a.output, settings, began)
        run.unpersist()
    elif a.verb == "rebuild-review":
        out = outputs.rebuild_review(spark, a.review, a.output)
    elif a.verb == "build-gold":
        out = outputs.build_gold(spark, a.review, a.output)
    else:
        out = training.write(training.mapped(training.read_gold(spark, a.gold)), a.outdir)
    print(json.dumps(out, ensure_ascii=False, indent=2, default=str))
    return out


if __name__ == "__main__":
    main()
