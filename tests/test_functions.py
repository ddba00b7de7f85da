import json

import pytest

from linkmill import config
from linkmill.functions import text as X
from linkmill.operators import audit, evaluate, validate
from linkmill.sources import readers

S = frozenset(config.LEGAL_SUFFIXES)


def test_names(spark):
    v = X.text_views("Ｂä\u0308ｃｋerei  Öztürk_Straße")
    assert v["nfkc"].startswith("Bä") and v["casefold"].endswith("strasse") and v["tokens"] == ["backerei", "ozturk", "strasse"]
    assert X.text_views(None)["tokens"] == []
    core = {
        "Northwind Tea Company": "northwind tea", "Pepper": "pepper", "Company Lane": "company lane", "Lamp-Works Pvt. Ltd.": "lamp works", "Ltd": "ltd", "S.A.S.U.": "s a s u", "Lumière S A S U": "lumiere",
        "Tor E.U.R.L. Co": "tor", "Grün GmbH": "grun gmbh", "Ältere Sci": "altere", "a b s a": "a b", "": "", "_ -": "",
    }
    names = [*core, "plain words 12", "Кафе ooo", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for r in X.with_views(df, "name", "_", suffixes=config.LEGAL_SUFFIXES).collect():
        want = X.text_views(r.name)
        assert {k: r[f"_{k}"] for k in X.FIELDS} == want
        assert r._core == X.strip_suffixes(want["tokens"], S)
        assert r.name not in core or " ".join(r._core) == core[r.name]


def test_romanize():
    shown = {"Кафе": "kafe", "Αθήνα": "athena", "すし": "sushi", "カメラ": "kamera", "서울": "seoul", "שלום": "shlvm", "سلام": "slam", "Łódź Ørsted": "lodz orsted", "漢字": "漢字"}
    for raw, latin in shown.items():
        assert " ".join(X.text_views(raw)["translit"]) == latin
    hindi = X.text_views("मॉडर्न फाइनेंस")
    assert hindi["tokens"] == ["म", "डरन", "फ", "इन", "स"] and "".join(hindi["translit"]).isascii() and hindi["translit"] == X.text_views("मॉडर्न फाइनेंस")["translit"]
    assert X.text_views("ไทย")["translit"][0].isascii()


def test_config(tmp_path):
    (tmp_path / "base.json").write_text(json.dumps({"multikey": {"top_k": 7}}))
    (tmp_path / "own.json").write_text(json.dumps({"extends": "base.json", "exact": {"cap_exact": 3}}))
    c = config.load_config(tmp_path / "own.json")
    assert (c["multikey"]["top_k"], c["exact"]) == (7, {"cap_exact": 3, "cap_structured": 50})
    assert config.config_hash({"a": 1, "b": 2}) == config.config_hash({"b": 2, "a": 1})
    with pytest.raises(config.ConfigError):
        config.validate_config(config.merge(config.DEFAULTS, {"resources": {"ram_warning": 0.9}}))


def test_tsv_and_audit(spark, tmp_path):
    p = tmp_path / "train_source1.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-0\t"A\t\tUS\nS1-1\tB\t1 Road\tIndia\n')
    df = readers.tsv(spark, str(p))
    assert [tuple(r) for r in df.orderBy("entity_id").collect()] == [("S1-0", '"A', "", "US"), ("S1-1", "B", "1 Road", "India")]
    with pytest.raises(readers.ContractError):
        readers.tsv(spark, str(p), readers.TRUTH_COLUMNS)
    truth = spark.createDataFrame([("S1-0", ""), ("S1-1", "S2-a"), ("S1-2", "S2-b,S3-a"), ("S1-x", "S2-miss")], "source1_entity_id string, matched_entity_ids string")
    pairs = audit.truth_pairs(truth)
    assert audit.truth_counts(truth).first().asDict() == {"pair_rows": 4, "unique_pairs": 4, "pairs_s2": 3, "pairs_s3": 1, "pairs_invalid": 0, "truth_rows": 4, "unique_s1": 4, "empty_rows": 1}
    targets = spark.createDataFrame([("S2-a", "S2", "US"), ("S2-b", "S2", "US"), ("S3-a", "S3", "US")], "entity_id string, source string, country string")
    assert audit.orphans(pairs, df, targets).first().asDict() == {"orphan_s1": 3, "orphan_s2": 1, "orphan_s3": 0}


@pytest.mark.parametrize("truth,pred,want", [([], [], 1), ([], ["A"], 0), (["A"], [], 0), (["A"], ["A"], 1), (["A"], ["A", "B"], 5 / 9), (["A", "B"], ["A"], 5 / 6)])
def test_fbeta(spark, truth, pred, want):
    u = spark.createDataFrame([("s",)], "entity_id string")
    pairs = lambda x: spark.createDataFrame([("s", t) for t in x], "s1 string, target string")
    assert abs(evaluate.macro_fbeta(u, pairs(truth), pairs(pred)).first().macro_f - want) < 1e-6


def test_violations(spark):
    rows = [("S2-a", "S1-a", "S2", "US", 1, 1), ("S2-b", "S1-b", "S2", "US", 70000, -1), ("S2-c", "", "X", "US", 1, 1), ("S2-d", "S1-d", "S2", "US", 1, 1), ("S2-d", "S1-d", "S2", "India", 1, 1)]
    df = spark.createDataFrame(rows, "target_entity_id string, candidate_s1_entity_id string, target_source string, country string, retriever_mask long, retriever_count long")
    got = sorted((r.target_entity_id, r.rule, r.n_rows) for r in validate.candidate_violations(df).collect())
    assert got == [("S2-b", "retriever_count_range", 1), ("S2-b", "retriever_mask_range", 1), ("S2-c", "unknown_source", 1), ("S2-d", "conflicting_country", 1)]
    odd = spark.createDataFrame([("S2-a", None, "S2", "US", None, "x", False, 0.5, 0), ("S2-a", 1.5, "S2", " ", None, None, None, None, 2), ("S2-b", 2.5, "S2", "US", 2, "y", True, 1.0, 1)], "target_entity_id string, candidate_s1_entity_id double, target_source string, country string, blocker_rank long, exact_hit string, dense_present boolean, dense_score double, dense_rank long")
    got = sorted((r.target_entity_id, r.rule, r.n_rows) for r in validate.candidate_violations(odd).collect())
    assert got == [
        ("S2-a", "blocker_rank_range", 1), ("S2-a", "candidate_s1_entity_id_type", 1), ("S2-a", "country_empty", 1), ("S2-a", "dense_evidence_not_present", 1), ("S2-a", "missing_fields", 1),
        ("S2-b", "candidate_s1_entity_id_type", 1), ("S2-b", "exact_hit_type", 1),
    ]
    assert validate.candidate_violations(df.limit(0)).count() == 0


def test_inventory(spark):
    rows = [("train", "source1", "US", "a"), ("train", "source1", "US", "b"), ("train", "source1", "India", "a"), ("test", "source1", "US", "a")]
    df = spark.createDataFrame(rows, "split string, source string, country string, entity_id string")
    got = {(r.split, r.country): (r.n_rows, r.repeated_ids, r.ok) for r in validate.inventory(df, {"train": {"source1": {"US": 2, "India": 1}}, "test": {"source1": {"US": 2, "France": 1}}}).collect()}
    assert got == {("train", "US"): (2, 1, False), ("train", "India"): (1, 1, False), ("test", "US"): (1, 0, False), ("test", "France"): (0, 0, False)}
    assert validate.inventory(df).where("ok").count() == 1
    assert {(r.country, r.side) for r in validate.shard_differences(df, df.where("country <> 'India'")).collect()} == {("India", "missing")}
