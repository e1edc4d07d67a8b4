"""python -m tidemark [STAGE] [--config FILE] [--overwrite] [--query TEXT] [--k N]

Without a stage it says which of the published artifacts exist.
"""

from __future__ import annotations

import argparse
from pathlib import Path

from tidemark.plans import stages
from tidemark.session import build_session
from tidemark.sources.files import load_config

ARTIFACTS = ("data/interim/schema_report.json", "models", "data/processed/analytics")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("stage", nargs="?", choices=list(stages.STAGES))
    parser.add_argument("--config")
    parser.add_argument("--overwrite", action="store_true")
    parser.add_argument("--query")
    parser.add_argument("--k", type=int)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    if args.stage is None:
        print(f"tidemark: {sum(Path(p).exists() for p in ARTIFACTS)}/{len(ARTIFACTS)} artifacts present")
        return 0
    run, default = stages.STAGES[args.stage]
    config = load_config(args.config or default)
    more = {"query": args.query, "k": args.k} if args.stage == "retrieval" else {}
    print(stages.shown(run(build_session(), config, overwrite=args.overwrite, **more)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
