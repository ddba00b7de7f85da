"""Manifests and their states, files on Spark's file systems, resource samples, configuration of both forms, the command line."""

import json
import logging

import pytest

from linkmill import cli, config, runtime
from linkmill.operators import evaluate
from linkmill.sources import artifacts, files, readers, sinks

MADE = dict(stage="normalization", stage_version="v1", split="train", source="source1", country="US", shard_id="0", input_rows=1, output_rows=1, config_hash="c", code_commit="r", input_fingerprint="i", artifact_path="p", artifact_size_bytes=9, artifact_hash="h")


def test_manifests(spark, tmp_path):
    root = str(tmp_path / "table")
    m = artifacts.Manifest(**MADE)
    artifacts.save_manifests(spark, root, [m])
    assert artifacts.load_manifests(spark, root) == [m] and artifacts.load_manifests(spark, str(tmp_path / "none")) == []
    artifacts.save_manifests(spark, root, [m, m])
    with pytest.raises(artifacts.ManifestError):
        artifacts.load_manifests(spark, root)
    for wrong in ({"output_rows": -1}, {"status": "done"}, {"stage": ""}, {"runtime_seconds": -1.0}):
        with pytest.raises(artifacts.ManifestError):
            artifacts.Manifest(**(MADE | wrong))
    files.write_text(spark, artifacts.manifest_path(root), "{not json")
    with pytest.raises(artifacts.ManifestError):
        artifacts.load_manifests(spark, root)


def test_states():
    m, held = artifacts.Manifest(**MADE), {"split": "train", "source": "source1", "country": "US", "artifact_size_bytes": 9, "artifact_hash": "h", "n_rows": 1}
    state = lambda m, held, stage="normalization", version="v1", own="c", made="i": artifacts.check([m], held, stage, version, own, {m.identity: made})[m.identity]
    assert state(m, [held]) == ""
    assert state(m, []) == "missing" and state(m, [held | {"n_rows": 2}]) == "size differs" and state(m, [held | {"artifact_hash": "x"}]) == "corrupt"
    assert state(m, [held], own="d") == "configuration differs" and state(m, [held], made="j") == "inputs differ"
    assert state(m, [held], stage="s") == state(m, [held], version="v2") == "stage differs"
    assert state(artifacts.Manifest(**(MADE | {"status": "failed"})), [held]) == "not complete"
    assert state(artifacts.Manifest(**(MADE | {"output_rows": 0, "artifact_hash": artifacts.EMPTY})), []) == ""
    assert artifacts.check([], [held], "normalization", "v1", "c", {}) == {("train", "source1", "US"): "no manifest"}


def test_folders_of_odd_names(spark, tmp_path):
    """Partition values that can't stand in a path as they are come back whole, from the table and from its listing."""
    root, odd = str(tmp_path / "t"), ["A/B c=é%", "100% +plus", "plain"]
    rows = [("train", "source1", c, f"S1-{i}") for i, c in enumerate(odd)]
    sinks.write_normalized(spark.createDataFrame(rows, "split string, source string, country string, entity_id string"), root)
    assert {r.country for r in readers.partition_shards(spark, root, shard=0).collect()} == set(odd)
    assert {s["country"]: s["n_rows"] for s in artifacts.describe(spark, root)} == dict.fromkeys(odd, 1)
    assert readers.partition_shards(spark, root, shard=3).count() == 0 and readers.partition_shards(spark, root, country=["plain"]).count() == 1


def test_files(spark, tmp_path):
    root = str(tmp_path / "deep")
    files.write_text(spark, f"{root}/a/x.tsv", "one\n")
    files.write_text(spark, f"{root}/a/x.tsv", "two é\n")
    files.write_text(spark, f"{root}/_hidden/x.tsv", "")
    assert files.read_text(spark, f"{root}/a/x.tsv") == "two é\n" and [f.name for f in files.list_files(spark, root)] == ["x.tsv"]
    assert files.list_files(spark, str(tmp_path / "none")) == []
    for i in range(3):
        files.append_line(spark, f"{root}/log.jsonl", {"i": i})
    assert [json.loads(x)["i"] for x in files.read_text(spark, f"{root}/log.jsonl").splitlines()] == [0, 1, 2]
    whole = tmp_path / "big.tsv"
    whole.write_bytes(b"header\n" + bytes(range(256)) * 100)
    first = files.sampled_fingerprint(spark, str(whole), 1000)
    assert first["file_size_bytes"] == 25_607 and [b["offset"] for b in first["samples"]] == [0, 12_303, 24_607]
    whole.write_bytes(b"Header\n" + bytes(range(256)) * 100)
    assert files.sampled_fingerprint(spark, str(whole), 1000) != first
    assert files.combined_fingerprint({"a": first, "b": first}) == files.combined_fingerprint({"b": first, "a": first})
    with pytest.raises(ValueError):
        files.sampled_fingerprint(spark, str(whole), 0)
    with pytest.raises(readers.ContractError):
        readers.discover(spark, root)
    assert readers.discover(spark, root, names={"x": "x.tsv"})["x"].endswith("deep/a/x.tsv")


def test_json_and_markdown():
    assert sinks.json_safe({1: [float("nan"), (float("inf"), 2.5)]}) == {"1": [None, [None, 2.5]]}
    assert "| a | b |" in sinks.markdown_report("t", {"rows": [{"a": 1, "b": None}], "n": 3}) and "- n: 3" in sinks.markdown_report("t", {"n": 3})


def test_monitor(monkeypatch, caplog):
    m = runtime.Monitor("stage", country="US")
    s = m.sample(10, 20)
    assert s.country == "US" and s.rss_bytes > 0 and s.eta_seconds is not None and json.loads(s.to_json())["stage"] == "stage"
    seen = []
    stop = m.heartbeat(0.01, seen.append)
    while not seen:
        pass
    stop.set()
    monkeypatch.setattr(runtime, "memory", lambda: (1, 1, 0.75))
    limits = {"ram_warning": 0.7, "ram_critical": 0.8}
    assert m.guard(limits) == "warning"
    monkeypatch.setattr(runtime, "memory", lambda: (1, 1, 0.9))
    with pytest.raises(runtime.ResourceError):
        m.guard(limits)
    with caplog.at_level(logging.INFO):
        runtime.log_event(logging.getLogger("x"), "done", rows=3)
    assert json.loads(caplog.messages[-1])["rows"] == 3
    assert runtime.query_gpu().keys() == {"available", "utilization", "used", "total"}


TREE = {
    "project": {}, "paths": {"data_root": "d"}, "runtime": {"seed": 1, "warning_ram_fraction": 0.5, "critical_ram_fraction": 0.9}, "sharding": {"default_rows": 1}, "features": {}, "models": {}, "decision": {}, "audit": {},
    "normalization": {"shard_rows": 10, "postal_like_min_digits": 4, "postal_like_max_digits": 8, "legal_suffixes": ["ltd"]},
    "retrieval": {
        "exact_structured": {"exact_name_max_bucket": 3, "exact_address_max_bucket": 3, "structured_max_bucket": 2, "rare_token_max_df": 9},
        "multikey": {
            "target_batch_rows": 1, "min_name_token_length": 3, "min_address_token_length": 2, "max_name_tokens_per_target": 2, "max_address_tokens_per_target": 2, "max_numeric_tokens_per_target": 2, "rare_name_token_max_df": 10,
            "rare_address_token_max_df": 3, "blocker_max_candidates_per_target": 5, **{f"{f}_bucket_cap": 3 for f in config.DEFAULTS["multikey"]["caps"]},
        },
    },
}


def test_ten_sections(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(TREE))
    c = config.load_config(tmp_path / "c.json")
    assert c["exact"] == {"cap_exact": 3, "cap_structured": 2} and c["multikey"]["top_k"] == 5 and c["multikey"]["caps"]["translit_name"] == 3 and c["normalization"]["legal_suffixes"] == ["ltd"]
    wrong = [{"runtime": {"critical_ram_fraction": 1}}, {"runtime": {"seed": -1}}, {"normalization": {"legal_suffixes": []}}, {"normalization": {"postal_like_min_digits": 9}}, {"sharding": {"default_rows": 0}}, {"retrieval": {"multikey": {"name_number_bucket_cap": 0}}}]
    for change in wrong:
        (tmp_path / "w.json").write_text(json.dumps(config.merge(TREE, change)))
        with pytest.raises(config.ConfigError):
            config.load_config(tmp_path / "w.json")
    (tmp_path / "w.json").write_text(json.dumps({k: v for k, v in TREE.items() if k != "models"}))
    for path in ("w.json", "none.json"):
        with pytest.raises(config.ConfigError):
            config.load_config(tmp_path / path)


def test_command_line(spark, capsys):
    a = cli.parser().parse_args(["run", "--stage", "normalize", "--split", "train", "--shard-id", "3", "--multikey-root", "m"])
    assert (a.stage, a.split, a.shard_id, a.multikey_root) == ("normalize", "train", 3, "m")
    assert cli.main(["run", "--stage", "config-check"]) == 0
    assert json.loads(capsys.readouterr().out)["status"] == "ok"


def test_approx_quantile(spark):
    df = spark.range(10_000).selectExpr("id", "id % 2 AS side")
    for r in evaluate.approx_quantile(df, "id", 0.95, "side", accuracy=1000).collect():
        assert abs(r.value - 9_500) <= 2 * 5_000 / 1000 + 2
