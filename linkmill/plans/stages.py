"""The stages of a linkage run: each a plan over tables, with its outputs written and its figures returned.

A stage keeps the shards (split, source, country) that are as their manifests say and made of the inputs that are there; it computes
the rest in one plan, and writes manifests once they are whole. Split and country are join keys, never loops.
"""

from __future__ import annotations

import hashlib
import json
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill import runtime
from linkmill.config import DEFAULTS, config_hash, validate_config
from linkmill.operators import audit, blocking, ceilings, evaluate, normalize, validate
from linkmill.sources import artifacts, files, readers, sinks
from linkmill.tables import materialise

TARGET_KEYS = ("split", "target_source", "country")
SPLITS, SOURCES = ("train", "test"), ("source1", "source2", "source3")


class StageError(RuntimeError):
    """A stage that can't run on what it is given."""


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]  # figures: a row per group


def _digest(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def _report(spark: SparkSession, path: str, title: str, report: dict) -> dict:
    safe = sinks.json_safe(report)
    files.write_text(spark, f"{path}.json", json.dumps(safe, indent=2, sort_keys=True, ensure_ascii=False) + "\n")
    files.write_text(spark, f"{path}.md", sinks.markdown_report(title, safe))
    return safe


def _columns(paths: dict[str, str]) -> dict[str, tuple[str, ...]]:
    return {k: readers.TRUTH_COLUMNS if k.endswith("truth") else readers.SOURCE_COLUMNS for k in paths}


def read_sources(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All source files with the columns split and source."""
    frames = [readers.tsv(spark, p).withColumn("split", F.lit(k.split("_")[0])).withColumn("source", F.lit(k.split("_")[1])) for k, p in paths.items() if "source" in k]
    return readers.union_by_name(frames)


def _filters(split=None, source=None, country=None) -> dict[str, list]:
    own = {"split": split, "source": source if source is None or source.startswith("source") else f"source{source[1:]}", "country": country}
    if own["split"] not in (None, *SPLITS) or own["source"] not in (None, *SOURCES):
        raise StageError("split must be train or test, source one of source1 to source3 or S1 to S3")
    return {k: v if isinstance(v, list) else [v] for k, v in own.items() if v}


# ---- audit


def data_audit(spark: SparkSession, root: str, out: str, config: dict = DEFAULTS) -> dict:
    """The report of the inputs; one that is there already is returned if it is of the same inputs and whole, else it is an error."""
    paths = readers.discover(spark, root, config["paths"]["data_root"])
    prints = {k: files.sampled_fingerprint(spark, p, config["audit"]["sample_bytes"]) for k, p in paths.items()}
    whole = files.combined_fingerprint(prints)
    target = f"{out}/audit-{config['audit']['version']}"
    if files.exists(spark, f"{target}.json"):
        old = json.loads(files.read_text(spark, f"{target}.json"))
        if old.get("dataset_fingerprint") != whole or "runtime_seconds" not in old:
            raise StageError(f"{target}.json is of other inputs or isn't whole; give the audit a new version")
        return old
    began = time.monotonic()
    every = materialise(read_sources(spark, paths), "audit-sources")
    train = every.where("split = 'train'")
    s1 = train.where("source = 'source1'")
    targets = readers.with_target_source(train.where("source <> 'source1'")).select("entity_id", F.col("target_source").alias("source"), "country")
    truth = readers.tsv(spark, paths["train_ground_truth"], readers.TRUTH_COLUMNS)
    pairs = materialise(audit.truth_pairs(truth), "audit-pairs")
    texts = ("business_name", "business_address")
    report = {
        "audit_version": config["audit"]["version"], "dataset_root": readers.data_root(root, config["paths"]["data_root"]), "dataset_fingerprint": whole, "fingerprints": prints,
        "files": readers.file_contract(spark, paths, _columns(paths)),
        "missingness": [{"split": sp, "source": so} | r for sp in SPLITS for so in SOURCES for r in _rows(audit.missingness(every.where((F.col("split") == sp) & (F.col("source") == so)), list(readers.SOURCE_COLUMNS)))],
        "duplicates": [{"split": sp, "source": so} | r for sp in SPLITS for so in SOURCES for r in _rows(audit.duplicates(every.where((F.col("split") == sp) & (F.col("source") == so)), "entity_id"))],
        "countries": _rows(every.groupBy("split", "source", F.col("country").alias("label")).agg(F.count("*").alias("n"))),
        "text_lengths": [{"column": c} | r for c in texts for r in _rows(audit.text_profile(every, c, "split", "source"))],
        "scripts": [{"column": c} | r for c in texts for r in _rows(audit.script_profile(every, c, "split", "source"))],
        "id_overlaps": [
            {"split": sp, "sources": f"{a} {b}"} | r for sp in SPLITS for a, b in (("source1", "source2"), ("source1", "source3"), ("source2", "source3"))
            for r in _rows(audit.id_overlap(*[every.where((F.col("split") == sp) & (F.col("source") == s)) for s in (a, b)]))
        ],
        "truth": _rows(audit.truth_counts(truth)), "orphans": _rows(audit.orphans(pairs, s1, targets)), "country_consistency": _rows(audit.country_mismatches(pairs, s1, targets)), "ownership": _rows(audit.ownership(pairs)),
        "cardinality": _rows(audit.cardinality(pairs, s1)), "distractors": _rows(audit.distractors(pairs, targets)), "coverage": _rows(audit.coverage(pairs)), "invariants": _rows(audit.invariants(pairs, s1, targets)),
        "organizer_files": readers.organizer_files(spark, readers.data_root(root, config["paths"]["data_root"])),
    }
    expected = config["expected"]["country_rows"]
    held = {sp: sorted({r["label"] for r in report["countries"] if r["split"] == sp}) for sp in SPLITS}
    report["split_countries"] = [{"split": sp, "countries": ", ".join(c), "as_expected": None if expected is None else c == sorted({k for s in expected.get(sp, {}).values() for k in s})} for sp, c in held.items()]
    report["runtime_seconds"] = time.monotonic() - began
    files.write_text(spark, f"{out}/fingerprints.json", json.dumps(prints, indent=2, sort_keys=True) + "\n")
    return _report(spark, target, "Data audit", report)


# ---- normalization


def _dependencies(spark: SparkSession, paths: dict[str, str], config: dict) -> dict[tuple[str, str], str]:
    """What each source's shards are made of: the file and how it is normalized."""
    return {tuple(k.split("_")): _digest([files.sampled_fingerprint(spark, p, config["audit"]["sample_bytes"])["input_fingerprint"], config["normalization"], config["versions"]["normalize"]]) for k, p in paths.items() if "source" in k}


def run_normalize(spark: SparkSession, root: str, out: str, config: dict = DEFAULTS, split=None, source=None, country=None) -> dict:
    allowed = _filters(split, source, country)
    monitor, began, folder, own_hash = runtime.Monitor("normalization", spark), time.monotonic(), f"{out}/normalized", config_hash(config)
    paths = readers.discover(spark, root, config["paths"]["data_root"])
    made_of = {k: v for k, v in _dependencies(spark, paths, config).items() if k[0] in allowed.get("split", SPLITS) and k[1] in allowed.get("source", SOURCES)}
    manifests, found = artifacts.load_manifests(spark, folder), artifacts.describe(spark, folder)
    state = artifacts.check(manifests, found, "normalization", config["versions"]["normalize"], own_hash, {m.identity: made_of.get(m.identity[:2], m.input_fingerprint) for m in manifests})
    # a source none of whose shards is of its present file is computed whole, another only where a shard isn't as it should be
    known = {m.identity[:2] for m in manifests if m.input_fingerprint == made_of.get(m.identity[:2])}
    wanted = {k: None if k not in known else sorted(i[2] for i, w in state.items() if i[:2] == k and w) for k in made_of}
    wanted = {k: v for k, v in wanted.items() if v is None or v}
    rows = None
    for k, countries in wanted.items():
        name = "_".join(k)
        mine = readers.select_inputs(read_sources(spark, {name: paths[name]}), country=(countries or []) or allowed.get("country", []))
        rows = mine if rows is None else rows.unionByName(mine)
        if countries is None and "country" not in allowed:
            files.delete(spark, f"{folder}/split={k[0]}/source={k[1]}")
    if rows is not None:
        sinks.write_normalized(normalize.normalize(rows, config["normalization"]), folder, config["output"]["shard_rows"])
    found = artifacts.describe(spark, folder)
    kept = {m.identity: m for m in manifests}
    written, passed = 0, time.monotonic() - began
    for s in found:
        identity = (s["split"], s["source"], s["country"])
        if identity[:2] in wanted and (wanted[identity[:2]] is None or identity[2] in wanted[identity[:2]]) and identity[2] in allowed.get("country", [identity[2]]):
            kept[identity] = artifacts.Manifest(
                "normalization", config["versions"]["normalize"], *identity, f"0-{s['n_files'] - 1}", s["n_rows"], s["n_rows"], own_hash, runtime.code_commit(), made_of[identity[:2]],
                f"{folder}/split={identity[0]}/source={identity[1]}/country={identity[2]}", s["artifact_size_bytes"], s["artifact_hash"], passed, monitor.sample().rss_bytes,
            )
            written += 1
    there = {(s["split"], s["source"], s["country"]) for s in found}
    artifacts.save_manifests(spark, folder, [m for i, m in kept.items() if i in there])
    monitor.guard(config["resources"])
    done = spark.read.parquet(folder)
    inventory = _rows(validate.inventory(done, None if allowed else config["expected"]["country_rows"]))
    if not all(r["ok"] for r in inventory):
        raise StageError(f"rows by country aren't as expected, or ids repeat: {[r for r in inventory if not r['ok']]}")
    report = {
        "written": written, "skipped": len(there) - written, "inventory": inventory, "profile": _rows(normalize.profile(done, "split", "source")),
        "violations": _rows(validate.normalized_violations(done.select(*normalize.COLUMNS))), "samples": _rows(normalize.sample_by_category(done)), "runtime_seconds": time.monotonic() - began,
    }
    return _report(spark, f"{out}/normalized", "Normalization", report)


# ---- retrieval


def _made_of(manifests: list, split: str, source: str, country: str, *more) -> str:
    """The fingerprint of a target shard's candidates: the reference's and its own normalized shards and the rules."""
    return _digest([[m.artifact_hash for m in manifests if m.identity in ((split, "source1", country), (split, source, country))], *more])


def _retrieve(spark: SparkSession, stage: str, name: str, out: str, config: dict, rules: dict, schema, candidates, allowed: dict, shard: int | None, normalized_root: str | None) -> tuple[DataFrame, DataFrame, dict]:
    """The written candidates of a retrieval and their targets, and how many shards were written and kept."""
    monitor, began, own_hash = runtime.Monitor(stage, spark), time.monotonic(), config_hash(config)
    source_root, folder = normalized_root or f"{out}/normalized", f"{out}/{name}"
    inputs = artifacts.require(spark, source_root, "normalization", normalize.COLUMNS[:1])
    inputs = [m for m in inputs if m.split in allowed.get("split", SPLITS) and m.country in allowed.get("country", [m.country])]
    targets = [m for m in inputs if m.source != "source1" and m.source in allowed.get("source", SOURCES)]
    if not targets:
        raise StageError("no target shard is as the filters say")
    made_of = {(m.split, f"S{m.source[6:]}", m.country): _made_of(inputs, m.split, m.source, m.country, rules, config["versions"][name], shard) for m in targets}
    manifests, found = artifacts.load_manifests(spark, folder), artifacts.describe(spark, folder, TARGET_KEYS)
    state = artifacts.check(manifests, found, stage, config["versions"][name], own_hash, {m.identity: made_of.get(m.identity, m.input_fingerprint) for m in manifests})
    todo = {i for i in made_of if state.get(i, "new")}

    def side(source_is_s1: bool) -> DataFrame:
        picked = [F.col(c).isin(sorted({i[k] for i in todo})) for c, k in (("split", 0), ("country", 2))]
        rows = readers.partition_shards(spark, source_root, shard=None if source_is_s1 else shard)
        return rows.where(reduce(lambda a, b: a & b, picked)).where((F.col("source") == "source1") if source_is_s1 else F.col("source").isin(sorted({f"source{i[1][1:]}" for i in todo})))

    for one in sorted({i[0] for i in todo}):
        s1, t = side(True).where(F.col("split") == one), side(False).where(F.col("split") == one)
        own = [F.struct(F.lit(i[1]).alias("target_source"), F.lit(i[2]).alias("country")) for i in todo if i[0] == one]
        t = t.where(F.array_contains(F.array(*own), F.struct(F.concat(F.lit("S"), F.substring("source", 7, 9)).alias("target_source"), F.col("country"))))
        for i in (i for i in todo if i[0] == one):
            files.delete(spark, f"{folder}/split={i[0]}/target_source={i[1]}/country={i[2]}")
        sinks.write_candidates(candidates(s1, t, rules), folder, schema, one)
    there = {(s["split"], s["source"], s["country"]): s for s in artifacts.describe(spark, folder, TARGET_KEYS)}
    kept = {m.identity: m for m in manifests if m.identity not in made_of}
    kept |= {m.identity: m for m in manifests if m.identity in made_of and m.identity not in todo}
    of_target = {(m.split, f"S{m.source[6:]}", m.country): m for m in targets}
    for i in todo:
        s = there.get(i, {"n_files": 1, "n_rows": 0, "artifact_size_bytes": 0, "artifact_hash": artifacts.EMPTY})
        kept[i] = artifacts.Manifest(
            stage, config["versions"][name], *i, str(shard) if shard is not None else f"0-{s['n_files'] - 1}", of_target[i].output_rows, s["n_rows"], own_hash, runtime.code_commit(), made_of[i],
            f"{folder}/split={i[0]}/target_source={i[1]}/country={i[2]}", s["artifact_size_bytes"], s["artifact_hash"], time.monotonic() - began, monitor.sample().rss_bytes,
        )
    artifacts.save_manifests(spark, folder, list(kept.values()))
    monitor.guard(config["resources"])
    t = readers.select_inputs(readers.partition_shards(spark, source_root, shard=shard), **{k: v for k, v in allowed.items() if k != "source"}).where(F.col("source").isin(sorted({m.source for m in targets})))
    return read_candidates(spark, folder, schema), t, {"written": len(todo), "skipped": len(made_of) - len(todo), "shards": len(made_of)}


def read_candidates(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A candidate table in its columns' order with split; without a file, no rows."""
    if not files.list_files(spark, folder, "*.parquet"):
        return spark.createDataFrame([], schema).withColumn("split", F.lit(None).cast("string"))
    rows = spark.read.parquet(folder)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], "split")


def _truth(spark: SparkSession, root: str, config: dict, targets: DataFrame) -> DataFrame:
    """Distinct true pairs of the training targets: (s1, target, source, country)."""
    path = readers.discover(spark, root, config["paths"]["data_root"])["train_ground_truth"]
    pairs = audit.unique_pairs(audit.truth_pairs(readers.tsv(spark, path, readers.TRUTH_COLUMNS)))
    own = readers.with_target_source(targets.where("split = 'train'")).select(F.col("entity_id").alias("target"), F.col("target_source").alias("source"), "country")
    return pairs.join(own, ["target", "source"]).select("s1", "target", "source", "country")


def _reference(spark: SparkSession, root: str, split: str, allowed: dict) -> DataFrame:
    return readers.select_inputs(spark.read.parquet(root).where((F.col("split") == split) & (F.col("source") == "source1")), country=allowed.get("country", []))


def retrieve_exact(spark: SparkSession, root: str, out: str, config: dict = DEFAULTS, split=None, source=None, country=None, shard=None, normalized_root=None) -> dict:
    allowed = _filters(split, source, country)
    found, t, told = _retrieve(spark, "exact_structured", "exact", out, config, config["exact"], validate.EXACT, blocking.exact_candidates, allowed, shard, normalized_root)
    stats = told | {"by_split": {}}
    for one in allowed.get("split", SPLITS):
        s1, mine, c = _reference(spark, normalized_root or f"{out}/normalized", one, allowed), t.where(F.col("split") == one), found.where(F.col("split") == one)
        part = {"suppression": _rows(blocking.suppression(s1, mine, config["exact"])), "volume": _rows(evaluate.volume(mine, c))}
        if one == "train" and root:
            part["recall"] = _rows(evaluate.exact_recall(_truth(spark, root, config, mine), c))
        stats["by_split"][one] = part
        _report(spark, f"{out}/exact-{one}.stats", f"Equality blocking, {one}", part)
    return sinks.json_safe(stats)


def retrieve_multikey(spark: SparkSession, root: str, out: str, config: dict = DEFAULTS, split=None, source=None, country=None, shard=None, normalized_root=None) -> dict:
    allowed = _filters(split, source, country)
    rules = config["multikey"]
    made = lambda s1, t, c: blocking.multikey_candidates(s1, t, c).withColumnRenamed("sum_idf", "blocker_sum_idf")
    found, t, told = _retrieve(spark, "multikey_blocker", "multikey", out, config, rules, validate.MULTIKEY, made, allowed, shard, normalized_root)
    stats = told | {"by_split": {}}
    for one in allowed.get("split", SPLITS):
        s1, mine, c = _reference(spark, normalized_root or f"{out}/normalized", one, allowed), t.where(F.col("split") == one), found.where(F.col("split") == one)
        counted = materialise(evaluate.target_volumes(mine, c), "volumes")
        part = {
            "volume": _rows(evaluate.volume(mine, c)), "histogram": _rows(counted.groupBy("n").agg(F.count("*").alias("targets"))), "suppression": _rows(blocking.multikey_suppression(s1, mine, rules)),
            "quantiles": [{"p": p} | r for p in (0.5, 0.9, 0.95, 0.99) for r in _rows(evaluate.histogram_quantile(counted, "n", p))],
        }
        if one == "train" and root:
            truth = materialise(_truth(spark, root, config, mine), "truth")
            part["waterfall"] = _rows(ceilings.waterfall(s1, mine, truth, rules))
            part["recall"] = _rows(evaluate.recall_at(evaluate.truth_hits(truth, c.limit(0), c)))
        stats["by_split"][one] = part
        _report(spark, f"{out}/multikey-{one}.stats", f"Rare-token blocking, {one}", part)
    return sinks.json_safe(stats)


# ---- union audit


def audit_union(spark: SparkSession, root: str, out: str, config: dict = DEFAULTS, normalized_root=None, exact_root=None, multikey_root=None) -> dict:
    normalized_root, exact_root, multikey_root = normalized_root or f"{out}/normalized", exact_root or f"{out}/exact", multikey_root or f"{out}/multikey"
    inputs = artifacts.require(spark, normalized_root, "normalization")
    wanted = {(m.split, f"S{m.source[6:]}", m.country) for m in inputs if m.source != "source1"}
    for folder, stage in ((exact_root, "exact_structured"), (multikey_root, "multikey_blocker")):
        held = {m.identity for m in artifacts.load_manifests(spark, folder) if m.stage == stage and m.status == "complete"}
        if held != wanted:
            raise StageError(f"{folder}: shards {sorted(wanted - held)} are missing, {sorted(held - wanted)} are too many")
        artifacts.require(spark, folder, stage, keys=TARGET_KEYS)
    rows = spark.read.parquet(normalized_root)
    targets = rows.where("source <> 'source1'")
    t, s1 = targets.where("split = 'train'"), rows.where("split = 'train' AND source = 'source1'")
    path = readers.discover(spark, root, config["paths"]["data_root"])["train_ground_truth"]
    pairs = audit.unique_pairs(audit.truth_pairs(readers.tsv(spark, path, readers.TRUTH_COLUMNS)))
    repeated = audit.duplicates(t, "source", "entity_id").first().duplicate_values
    unresolved = validate.unresolved_targets(pairs, t).count()
    if repeated or unresolved:
        raise StageError(f"{repeated} target ids repeat, {unresolved} true targets aren't there")
    truth = materialise(_truth(spark, root, config, t), "truth")
    a, b = read_candidates(spark, exact_root, validate.EXACT), read_candidates(spark, multikey_root, validate.MULTIKEY)
    at, bt = a.where("split = 'train'"), b.where("split = 'train'")
    hits = materialise(evaluate.truth_hits(truth, at, bt), "hits")
    key_pairs = materialise(ceilings.key_ceiling_pairs(s1, t, truth, config["multikey"]), "ceiling-pairs")
    report = {
        "inputs": [{"normalized_shards": len(inputs), "candidate_shards": len(wanted)}],
        "union": _rows(evaluate.union_metrics(hits)), "recall": _rows(evaluate.recall_at(hits)),
        "oracle": [{"k": k} | r for k in evaluate.KS for r in _rows(evaluate.oracle_macro(s1, hits, k))],
        "volume": _rows(evaluate.union_volume(targets, a, b)), "waterfall": _rows(ceilings.waterfall(s1, t, truth, config["multikey"])),
        "ceilings": _rows(ceilings.ceiling_coverage(key_pairs)), "transliteration": _rows(ceilings.translit_diagnostics(s1, t, truth, bt, config["multikey"], key_pairs)),
    }
    return _report(spark, f"{out}/union", "Union audit", report)


# ---- runner


def config_check(config: dict = DEFAULTS) -> dict:
    validate_config(config)
    return {"stage": "config-check", "status": "ok", "config_hash": config_hash(config)}


def healthcheck(spark: SparkSession, config: dict = DEFAULTS) -> dict:
    return config_check(config) | {"stage": "healthcheck", "resources": json.loads(runtime.Monitor("healthcheck", spark).sample().to_json())}


STAGES = ("healthcheck", "config-check", "data-audit", "normalize", "retrieve-exact-structured", "retrieve-multikey", "audit-phase2ab-union")


def run_stage(spark: SparkSession, stage: str, root: str = "", out: str = "", config: dict = DEFAULTS, split=None, source=None, country=None, shard=None, normalized_root=None, exact_root=None, multikey_root=None) -> dict:
    picked = {"split": split, "source": source, "country": country}
    found = {"normalized_root": normalized_root or None}
    runs = {
        "healthcheck": lambda: healthcheck(spark, config), "config-check": lambda: config_check(config), "data-audit": lambda: data_audit(spark, root, out, config),
        "normalize": lambda: run_normalize(spark, root, out, config, **picked),
        "retrieve-exact-structured": lambda: retrieve_exact(spark, root, out, config, **picked, shard=shard, **found), "retrieve-multikey": lambda: retrieve_multikey(spark, root, out, config, **picked, shard=shard, **found),
        "audit-phase2ab-union": lambda: audit_union(spark, root, out, config, **found, exact_root=exact_root or None, multikey_root=multikey_root or None),
    }
    if stage not in runs:
        raise ValueError(f"no stage {stage}; there are {', '.join(STAGES)}")
    runtime.set_global_seed(config["runtime"]["seed"])
    log = f"{out}/resources.jsonl"
    stop = runtime.Monitor(stage, spark, country=country if isinstance(country, str) else None, source=source).heartbeat(config["resources"]["heartbeat_seconds"], lambda s: files.append_line(spark, log, json.loads(s.to_json()))) if out else None
    try:
        return runs[stage]()
    finally:
        if stop:
            stop.set()
