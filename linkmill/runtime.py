"""What a run needs besides its plans: resource samples, a heartbeat, the stop at critical memory, seed and log lines."""

from __future__ import annotations

import json
import logging
import os
import random
import shutil
import subprocess
import threading
import time
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark.sql import SparkSession


class ResourceError(RuntimeError):
    """Memory of the driver's machine is critical."""


@dataclass(frozen=True)
class Sample:
    timestamp: str
    stage: str
    country: str | None
    source: str | None
    shard: str | None
    processed_rows: int | None
    rows_per_second: float | None
    rss_bytes: int
    available_ram_bytes: int
    ram_fraction: float
    gpu_available: bool
    gpu_utilization_percent: float | None
    gpu_memory_used_bytes: int | None
    gpu_memory_total_bytes: int | None
    elapsed_seconds: float
    eta_seconds: float | None
    executors: int | None = None

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)


def memory() -> tuple[int, int, float]:
    """(resident, available, used fraction) of this process and machine, in bytes."""
    known = {}
    with open("/proc/meminfo", encoding="ascii") as f:
        for line in f:
            name, value = line.split(":")
            known[name] = int(value.split()[0]) * 1024
    with open("/proc/self/statm", encoding="ascii") as f:
        resident = int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    return resident, known["MemAvailable"], 1.0 - known["MemAvailable"] / known["MemTotal"]


def query_gpu() -> dict:
    none = {"available": False, "utilization": None, "used": None, "total": None}
    tool = shutil.which("nvidia-smi")
    if not tool:
        return none
    try:
        said = subprocess.run([tool, "--query-gpu=utilization.gpu,memory.used,memory.total", "--format=csv,noheader,nounits"], capture_output=True, text=True, timeout=3, check=True).stdout
        load, used, total = (float(x) for x in said.strip().splitlines()[0].split(","))
    except (OSError, subprocess.SubprocessError, ValueError, IndexError):
        return none
    return {"available": True, "utilization": load, "used": int(used) << 20, "total": int(total) << 20}


class Monitor:
    """Samples of the driver; executors are Spark's to watch, of which only their number is told."""

    def __init__(self, stage: str, spark: SparkSession | None = None, country: str | None = None, source: str | None = None, shard: str | None = None):
        self.stage, self.spark, self.country, self.source, self.shard, self.began, self.peak = stage, spark, country, source, shard, time.monotonic(), 0

    def sample(self, done: int | None = None, total: int | None = None) -> Sample:
        resident, available, fraction = memory()
        self.peak = max(self.peak, resident)
        passed, gpu = time.monotonic() - self.began, query_gpu()
        rate = done / passed if done is not None and passed > 0 else None
        return Sample(
            datetime.now(UTC).isoformat(), self.stage, self.country, self.source, self.shard, done, rate, resident, available, fraction, gpu["available"], gpu["utilization"], gpu["used"], gpu["total"], passed,
            (total - done) / rate if rate and total is not None else None, self.spark._jsc.sc().getExecutorMemoryStatus().size() if self.spark else None,
        )

    def state(self, warning: float, critical: float) -> str:
        used = self.sample().ram_fraction
        return "critical" if used >= critical else "warning" if used >= warning else "normal"

    def guard(self, limits: dict) -> str:
        """Called where everything written is whole: stops the run if memory is critical."""
        state = self.state(limits["ram_warning"], limits["ram_critical"])
        if state == "critical":
            raise ResourceError(f"{self.stage}: stopped after a safe boundary, memory in use is above {limits['ram_critical']:.0%}")
        return state

    def heartbeat(self, seconds: float, sink) -> threading.Event:
        """Samples to sink until the event that is returned is set."""
        stop = threading.Event()

        def beat():
            while not stop.wait(seconds):
                sink(self.sample())

        threading.Thread(target=beat, name=f"heartbeat-{self.stage}", daemon=True).start()
        return stop


def set_global_seed(seed: int) -> None:
    import numpy as np

    os.environ["PYTHONHASHSEED"] = str(seed)
    random.seed(seed)
    np.random.seed(seed)


def configure_logging(level: int = logging.INFO) -> None:
    logging.basicConfig(level=level, format="%(asctime)s %(levelname)s %(name)s %(message)s")


def log_event(logger: logging.Logger, event: str, **told) -> None:
    logger.info(json.dumps({"timestamp": datetime.now(UTC).isoformat(), "event": event, **told}, sort_keys=True, default=str))


def code_commit() -> str:
    """The revision that is checked out, or CODE_COMMIT, or `unknown`."""
    try:
        here = os.path.dirname(os.path.abspath(__file__))
        return subprocess.run(["git", "-c", "safe.directory=*", "-C", here, "rev-parse", "HEAD"], capture_output=True, text=True, check=True, timeout=5).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return os.environ.get("CODE_COMMIT", "unknown")
