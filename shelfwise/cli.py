"""Command line: run the cleaning phase, the feature phase or both.

    spark-submit -m shelfwise.cli --config run.json --full
    python -m shelfwise.cli --input raw.csv --processed out/processed --features out/features --full

Phase switches are mutually exclusive; the configuration comes from JSON
(``PipelineConfig.from_json``) with command-line paths taking precedence.
The run statistics are printed as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys

from shelfwise.config import PipelineConfig
from shelfwise.plans import etl as E
from shelfwise.schema import PROCESSED_SCHEMA, SchemaError
from shelfwise.session import remove_path
from shelfwise.sources import csv_io


def parse_args(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="shelfwise", description=__doc__.split("\n")[0])
    ap.add_argument("--config", help="JSON configuration file")
    ap.add_argument("--input", help="raw CSV path")
    ap.add_argument("--processed", help="processed table output (Parquet)")
    ap.add_argument("--features", help="feature table output (Parquet)")
    ap.add_argument("--key", default="title,product_page",
                    help="comma-separated natural key columns for the id")
    ap.add_argument("--quarantine", help="table for lines that do not fit the schema (without it they fail the run)")
    phase = ap.add_mutually_exclusive_group()
    phase.add_argument("--full", action="store_true", help="cleaning then features (default)")
    phase.add_argument("--clean-only", action="store_true", help="cleaning phase only")
    phase.add_argument("--features-only", action="store_true",
                       help="feature phase only, from an existing processed table")
    return ap.parse_args(argv)


def build_config(args: argparse.Namespace) -> PipelineConfig:
    cfg = PipelineConfig.from_json(args.config) if args.config else PipelineConfig()
    overrides = {k: v for k, v in (("input_path", args.input), ("processed_output", args.processed),
                                   ("features_output", args.features)) if v}
    if args.quarantine:
        overrides |= {"bad_rows": "quarantine", "quarantine_path": args.quarantine}
    return cfg.with_paths(**overrides) if overrides else cfg


def main(argv=None, spark=None) -> dict:
    args = parse_args(argv)
    cfg = build_config(args)
    if spark is None:
        from shelfwise.session import get_session
        spark = get_session()
    keys = [k for k in args.key.split(",") if k]
    if args.features_only:
        if not cfg.processed_output or not csv_io.readable(spark, cfg.processed_output):
            raise ValueError(f"no processed table at {cfg.processed_output}: run the cleaning phase first")
        processed = spark.read.schema(PROCESSED_SCHEMA).parquet(cfg.processed_output)
        _, stats = E.run_features(processed, cfg, cfg.features_output)
    else:
        csv_io.require_input(spark, cfg.input_path, "raw input", bad_rows=cfg.bad_rows)
        # parsed once in either case: here, or as the run stages its input
        strict, bad, held = cfg.bad_rows == "fail", {}, None
        if strict:
            raw = csv_io.read_csv(spark, cfg.input_path)
        else:
            raw, counts, held = csv_io.read_quarantined(spark, cfg.input_path, cfg.quarantine_path)
            bad = {"bad_rows": counts["bad_rows"]}
            if counts["rows"] == counts["bad_rows"]:
                raise SchemaError(f"raw input {cfg.input_path}: no line fits the schema")
        if args.clean_only:
            _, stats = E.run_cleaning(raw, cfg, keys, cfg.processed_output, stage_input=strict)
        else:
            _, run = E.run_full(spark, raw, cfg, keys, cfg.processed_output, cfg.features_output, stage_input=strict)
            stats = run.as_dict()
        stats = {**stats, **bad}
        if held and cfg.processed_output:
            remove_path(spark, held)
    print(json.dumps(stats, default=str))
    return stats


if __name__ == "__main__":
    main(sys.argv[1:])
