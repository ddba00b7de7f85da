"""Multi-view normalization of names and addresses; raw values stay beside the views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.config import DEFAULTS
from linkmill.functions import text as X

COLUMNS = (
    "entity_id", "country", "name_raw", "name_nfkc", "name_casefold", "name_accent_fold", "name_compact", "name_tokens", "name_token_sorted",
    "name_core", "name_transliterated", "address_raw", "address_nfkc", "address_casefold", "address_accent_fold", "address_normalized",
    "address_compact", "address_token_sorted", "numeric_tokens", "primary_number", "postal_like_tokens", "name_missing", "address_missing",
)


def normalize(records: DataFrame, config: dict = DEFAULTS["normalization"]) -> DataFrame:
    """(entity_id, business_name, business_address, country, ...) to the 23 COLUMNS; further columns stay in front."""
    held = X.with_views(X.with_views(records, "business_name", "_n_", suffixes=config["legal_suffixes"]), "business_address", "_a_", need=("nfkc", "casefold", "accent", "tokens"))
    held = held.withColumn("_nums", X.numbers(X.joined(F.col("_a_tokens"))))
    extra = [c for c in records.columns if c not in ("entity_id", "country", "business_name", "business_address")]
    return held.select(
        *extra, "entity_id", "country",
        F.col("business_name").alias("name_raw"), F.col("_n_nfkc").alias("name_nfkc"), F.col("_n_casefold").alias("name_casefold"), F.col("_n_accent").alias("name_accent_fold"),
        X.compact(F.col("_n_tokens")).alias("name_compact"), X.joined(F.col("_n_tokens")).alias("name_tokens"), X.token_sorted(F.col("_n_tokens")).alias("name_token_sorted"),
        X.joined(F.col("_n_core")).alias("name_core"), X.joined(F.col("_n_translit")).alias("name_transliterated"),
        F.col("business_address").alias("address_raw"), F.col("_a_nfkc").alias("address_nfkc"), F.col("_a_casefold").alias("address_casefold"), F.col("_a_accent").alias("address_accent_fold"),
        X.joined(F.col("_a_tokens")).alias("address_normalized"), X.compact(F.col("_a_tokens")).alias("address_compact"), X.token_sorted(F.col("_a_tokens")).alias("address_token_sorted"),
        F.array_join("_nums", "|").alias("numeric_tokens"), F.try_element_at("_nums", F.lit(1)).alias("primary_number"),
        F.array_join(X.postal_like(F.col("_nums"), config["postal_min_length"], config["postal_max_length"]), "|").alias("postal_like_tokens"),
        X.missing(F.col("business_name")).alias("name_missing"), X.missing(F.col("business_address")).alias("address_missing"),
    )


def profile(normalized: DataFrame, *by: str) -> DataFrame:
    c = F.col
    return normalized.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count_distinct("entity_id").alias("unique_ids"),
        F.count_if(c("name_missing")).alias("names_missing"), F.count_if(c("address_missing")).alias("addresses_missing"),
        F.count_if(c("name_accent_fold") != c("name_casefold")).alias("accents_changed"),
        F.count_if(c("name_transliterated") != c("name_tokens")).alias("transliterated"),
        F.count_if(c("name_core") != c("name_tokens")).alias("cores_changed"),
        F.round(F.avg(F.length("name_tokens")), 6).alias("avg_name_length"), F.max(F.length("name_tokens")).cast("long").alias("max_name_length"),
        F.round(F.avg(F.length("address_normalized")), 6).alias("avg_address_length"), F.max(F.length("address_normalized")).cast("long").alias("max_address_length"),
    )


def sample_by_category(normalized: DataFrame, each: int = 4) -> DataFrame:
    """Up to `each` records of every category, the first by id: a limit that is the feature."""
    from pyspark.sql import Window

    c = F.col
    tests = {
        "ascii": ~c("name_raw").rlike(r"[^\x00-\x7F]"), "latin_extended": c("name_raw").rlike(r"[\x{00C0}-\x{024F}]"), "devanagari": X.script_flags(c("name_raw"))["devanagari"],
        "other_indic": X.script_flags(c("name_raw"))["other_indic"], "punctuation": c("name_raw").rlike(r"\p{Punct}"), "numbers": c("numeric_tokens") != "",
        "suffix": c("name_core") != c("name_tokens"), "missing": c("name_missing") | c("address_missing"),
    }
    held = F.array_compact(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]))
    rows = normalized.withColumn("category", F.explode(held))
    place = F.row_number().over(Window.partitionBy("category").orderBy("entity_id"))
    return rows.withColumn("place", place).where(F.col("place") <= each).select("category", F.col("place").cast("long").alias("place"), "entity_id")
