"""Transliteration diagnostics and the waterfall on a few records whose result can be told by hand."""

from linkmill.config import DEFAULTS
from linkmill.operators import blocking, ceilings

CONFIG = DEFAULTS["multikey"] | {"min_name_token": 3, "min_address_token": 2, "name_max_df": 5, "address_max_df": 5, "max_tokens": 2, "caps": dict.fromkeys(blocking.FAMILIES, 5)}
COLUMNS = "country string, entity_id string, name_raw string, name_tokens string, name_core string, name_transliterated string, address_normalized string, numeric_tokens string"


def row(i, raw, tokens, translit, address="", numbers=""):
    return ("c", i, raw, tokens, "", translit, address, numbers)


def tables(spark):
    s1 = [row("S1-1", "zorin", "zorin", "zorin"), row("S1-2", "мир", "мир", "mir"), row("S1-3", "plain", "plain", "plain", "oak lane", "7")]
    t = [row("S2-1", "зорин", "зорин", "zorin"), row("S2-2", "мир", "мир", "mir"), row("S2-3", "other", "other", "other", "oak lane", "7"), row("S2-4", "none", "none", "none")]
    truth = [(f"S1-{k}", f"S2-{k}", "S2", "c") for k in (1, 2, 3)]
    return spark.createDataFrame(s1, COLUMNS), spark.createDataFrame(t, COLUMNS), spark.createDataFrame(truth, "s1 string, target string, source string, country string")


def test_key_ceilings(spark):
    got = {r.target: r for r in ceilings.key_ceiling_pairs(*tables(spark), CONFIG).where("rule = 'current'").collect()}
    hits = {t: {k for k in ceilings.KINDS if r[f"{k}_hit"]} for t, r in got.items()}
    assert hits == {"S2-1": set(), "S2-2": {"name", "translit"}, "S2-3": {"address", "number", "address_pair"}}
    rows = ceilings.ceiling_coverage(ceilings.key_ceiling_pairs(*tables(spark), CONFIG)).where("country IS NULL").collect()
    assert {(r.rule, r.gt_pairs, r.covered) for r in rows} == {(r, 3, 2) for r in ("current", "df100", "df300", "df1000")}


def test_translit_diagnostics(spark):
    s1, t, truth = tables(spark)
    r = ceilings.translit_diagnostics(s1, t, truth, blocking.multikey_candidates(s1, t, CONFIG), CONFIG).first()
    # S2-1's transliteration meets the name of S1-1, whose own transliteration says no more than its name
    assert (r.targets_eligible, r.targets_with_translit_keys, r.stored_targets, r.pairs_sharing, r.pairs_unique, r.pairs_sharing_name) == (2, 2, 1, 1, 0, 1)
    assert (r.cross_namespace, r.cross_namespace_lost, r.issue) == (1, 1, True)


def test_waterfall(spark):
    r = ceilings.waterfall(*tables(spark), CONFIG).first()
    assert (r.pairs, r.raw_covered, r.pruned_recovered, r.lost_all_suppressed) == (3, 2, 2, 0)
    assert (r.rare_name_new, r.transliterated_recovered, r.transliterated_new, r.number_address_new, r.address_pair_recovered, r.address_pair_new) == (1, 1, 0, 1, 1, 0)
    s1, t, truth = tables(spark)
    assert ceilings.waterfall(s1, t, truth.limit(0), CONFIG).first().pairs == 0
