"""python -m linkmill.cli run --stage STAGE [--config FILE] [--data-root DIR] [--output-dir DIR] [--split S] [--source S] [--country C] [--shard-id N] ..."""

from __future__ import annotations

import argparse
import json

from linkmill.config import DEFAULTS, load_config
from linkmill.plans.stages import STAGES, run_stage
from linkmill.runtime import configure_logging
from linkmill.session import build_session
from linkmill.sources.sinks import json_safe


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    run = p.add_subparsers(dest="command", required=True).add_parser("run")
    run.add_argument("--stage", required=True, choices=STAGES)
    for name in ("config", "data-root", "output-dir", "normalized-root", "exact-structured-root", "multikey-root"):
        run.add_argument(f"--{name}", default="")
    run.add_argument("--split", choices=("train", "test"))
    run.add_argument("--source")
    run.add_argument("--country")
    run.add_argument("--shard-id", type=int)
    return p


def main(args=None) -> int:
    a = parser().parse_args(args)
    configure_logging()
    config = load_config(a.config) if a.config else DEFAULTS
    told = run_stage(
        build_session(), a.stage, a.data_root, a.output_dir, config, split=a.split, source=a.source, country=a.country, shard=a.shard_id,
        normalized_root=a.normalized_root, exact_root=a.exact_structured_root, multikey_root=a.multikey_root,
    )
    print(json.dumps(json_safe(told), indent=2, sort_keys=True))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
