"""A whole run over tiny files: audit, normalization, both retrievers, union audit, resumption, filters; and the file stream."""

import json

import pytest

from linkmill import config as C
from linkmill.plans.stages import StageError, run_stage
from linkmill.sources import artifacts, files
from linkmill.streaming.incremental import normalize_new_files

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
ROWS = {
    "1": ["S1-a\tHarbour Lights Corp\t10 Main 12345\tUS", "S1-b\tCafé Orbit\t9 Quay\tUS", "S1-c\tOther\tx\tIndia"],
    "2": ["S2-a\tHARBOUR LIGHTS Corp.\t10 Main 12345\tUS", "S2-c\tOther\tx\tUS", "S2-d\tКафе\ty 5\tIndia"],
    "3": ["S3-b\tCafe Orbit Ltd\t9 Quay\tUS"],
}


def write_inputs(data):
    data.mkdir()
    for split in ("train", "test"):
        for k, r in ROWS.items():
            (data / f"{split}_source{k}.tsv").write_text(HEAD + "\n".join(r) + "\n")
    (data / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-a\tS2-a\nS1-b\tS3-b\nS1-c\t\n")
    (data / "official_metric.py").write_text("")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("linkage")
    write_inputs(base / "data")
    data, out = str(base / "data"), str(base / "out")
    return data, out, {s: run_stage(spark, s, data, out) for s in ("data-audit", "normalize", "retrieve-exact-structured", "retrieve-multikey", "audit-phase2ab-union")}


def test_audit(spark, run):
    data, out, told = run
    report = told["data-audit"]
    assert report["truth"][0]["pair_rows"] == 2 and len(report["files"]) == 7 and report["files"][0]["row_count"] in (1, 3)
    assert report["organizer_files"][0].endswith("official_metric.py")
    assert {r["countries"] for r in report["split_countries"]} == {"India, US"}
    assert [r["n_overlap"] for r in report["id_overlaps"]] == [0] * 6
    assert run_stage(spark, "data-audit", data, out)["runtime_seconds"] == report["runtime_seconds"]
    changed = C.merge(C.DEFAULTS, {"audit": {"sample_bytes": 7}})
    with pytest.raises(StageError):
        run_stage(spark, "data-audit", data, out, changed)
    assert "# Data audit" in files.read_text(spark, f"{out}/audit-v1.md")


def test_run(spark, run):
    data, out, told = run
    assert told["normalize"]["written"] == 10 and told["normalize"]["violations"][0]["n_rows"] == 14
    assert all(r["ok"] for r in told["normalize"]["inventory"]) and {r["category"] for r in told["normalize"]["samples"]} >= {"ascii", "suffix", "latin_extended"}
    found = {(r.target_entity_id, r.candidate_s1_entity_id) for r in spark.read.parquet(f"{out}/exact").where("split = 'train'").collect()}
    assert found == {("S2-a", "S1-a"), ("S3-b", "S1-b")}  # never across countries
    exact = told["retrieve-exact-structured"]["by_split"]
    assert exact["train"]["recall"][0]["pairs"] in (1, 2) and exact["test"]["volume"][0]["targets"] == 4
    multi = told["retrieve-multikey"]["by_split"]["train"]
    assert multi["waterfall"][0]["pairs"] == 2 and {r["k"] for r in multi["recall"]} == {1, 3, 5, 10, 20, 50} and sum(r["targets"] for r in multi["histogram"]) == 4
    union = told["audit-phase2ab-union"]
    assert union["oracle"][-1] == {"k": 50, "entities": 3, "oracle_f05": 1.0}
    assert {r["rule"] for r in union["ceilings"]} == {"current", "df100", "df300", "df1000"} and union["transliteration"][0]["targets_eligible"] == 1
    assert json.loads(files.read_text(spark, f"{out}/exact-train.stats.json"))["volume"][0]["targets"] == 4
    manifests = artifacts.load_manifests(spark, f"{out}/exact")
    assert len(manifests) == 6 and sum(m.output_rows for m in manifests) == 4 and all(m.status == "complete" for m in manifests)


def test_resumption(spark, run):
    data, out, _ = run
    for stage in ("normalize", "retrieve-exact-structured", "retrieve-multikey"):
        told = run_stage(spark, stage, data, out)
        assert told["written"] == 0 and told["skipped"] > 0
    # a damaged shard alone is written again; so are the candidates that were made of it, but not those of others
    one = files.list_files(spark, f"{out}/normalized/split=test/source=source3", "*.parquet")[0]
    files.delete(spark, one.path)
    with pytest.raises(artifacts.ManifestError):
        run_stage(spark, "retrieve-exact-structured", data, out)
    told = run_stage(spark, "normalize", data, out)
    assert (told["written"], told["skipped"]) == (1, 9)
    one = files.list_files(spark, f"{out}/exact/split=train/target_source=S3", "*.parquet")[0]
    files.delete(spark, one.path)
    assert run_stage(spark, "retrieve-exact-structured", data, out)["written"] == 1
    other = C.merge(C.DEFAULTS, {"exact": {"cap_exact": 7}})
    with pytest.raises(artifacts.ManifestError):
        artifacts.require(spark, f"{out}/exact", "multikey_blocker", keys=("split", "target_source", "country"))
    assert run_stage(spark, "retrieve-exact-structured", data, out, other, split="train", source="S2", country="US")["written"] == 1


def test_filters(spark, run, tmp_path):
    data, _, _ = run
    out = str(tmp_path / "out")
    told = run_stage(spark, "normalize", data, out, split="train", country="US")
    assert told["written"] == 3 and {r["country"] for r in told["inventory"]} == {"US"}
    told = run_stage(spark, "retrieve-multikey", "", str(tmp_path / "other"), split="train", source="S2", shard=0, normalized_root=f"{out}/normalized")
    assert told["shards"] == 1
    with pytest.raises(StageError):
        run_stage(spark, "normalize", data, out, split="validation")
    with pytest.raises(StageError):
        run_stage(spark, "audit-phase2ab-union", data, out)
    with pytest.raises(ValueError):
        run_stage(spark, "train")
    wrong = C.merge(C.DEFAULTS, {"expected": {"country_rows": {"train": {"source1": {"US": 5}}}}})
    with pytest.raises(StageError):
        run_stage(spark, "normalize", data, str(tmp_path / "third"), wrong)


def test_health(spark):
    told = run_stage(spark, "healthcheck")
    assert told["status"] == "ok" and told["resources"]["rss_bytes"] > 0 and 0 < told["resources"]["ram_fraction"] < 1 and told["resources"]["executors"] == 1
    assert run_stage(spark, "config-check")["config_hash"] == C.config_hash(C.DEFAULTS)


def test_stream(spark, tmp_path):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    one = spark.createDataFrame([("S1-a", "Orbit Ltd", "1 Road", "US")], "entity_id string, business_name string, business_address string, country string")
    for n in (1, 2):
        one.write.mode("append").parquet(source)
        normalize_new_files(spark, source, out, check)
        normalize_new_files(spark, source, out, check)
        assert spark.read.parquet(out).count() == n
