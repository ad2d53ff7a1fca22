"""Cleaning stages: DataFrame in, DataFrame out, with a trail of what was done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUTO_KINDS = ("hyphen_split", "inci_truncated", "spelling_variant", "genus_level_entry", "inci_not_binomial", "hybrid")


def correct_family(df: DataFrame, typos: DataFrame, renames: DataFrame, split: list[str], family: str) -> DataFrame:
    """family_accepted, family_needs_gbif and family_correction: typo, then nomenclature, then families that were split.

    typos and renames are (raw, to): vocabularies of people, whose sizes Spark knows when it joins.
    """
    j = df.join(typos.select(F.col("raw").alias("_t"), F.col("to").alias("_typo")), F.col(family) == F.col("_t"), "left")
    j = j.withColumn("_f", F.coalesce("_typo", family)).join(renames.select(F.col("raw").alias("_r"), F.col("to").alias("_new")), F.col("_f") == F.col("_r"), "left")
    j = j.withColumn("_g", F.coalesce("_new", "_f")).withColumn("family_needs_gbif", F.col("_g").isin(*split))
    step = lambda name, a, b: F.when(F.col(b).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(a), F.lit("->"), F.col(b)))
    trail = F.concat_ws("; ", step("typo", family, "_typo"), step("rename", "_f", "_new"), F.when(F.col("family_needs_gbif"), F.concat(F.lit("split: "), F.col("_g"))))
    return j.withColumn("family_accepted", F.when(~F.col("family_needs_gbif"), F.col("_g"))).withColumn("family_correction", F.nullif(trail, F.lit(""))).drop("_t", "_typo", "_f", "_r", "_new", "_g")


def reconcile(df: DataFrame, kind: Column, inci: Column, description: Column) -> DataFrame:
    """species, taxon_source and taxon_status of two paths: agree, one only, a difference that is known, or unresolved."""
    k = F.col("kind")
    return (
        df.withColumn("kind", kind)
        .withColumn("species", F.when(k.isin("agree", *AUTO_KINDS), description).when(k == "desc_unparsed", inci))
        .withColumn("taxon_source", F.when(k == "agree", "both").when(k == "desc_unparsed", "inci").when(k.isin(*AUTO_KINDS), "description").otherwise("unresolved"))
        .withColumn("taxon_status", F.when(k == "agree", "agree").when(k.isin("desc_unparsed", *AUTO_KINDS), "auto").otherwise("manual"))
    )


def adjudicate(df: DataFrame, a_name: str, a_conf: str, b_name: str, b_conf: str) -> DataFrame:
    """resolved_to and reason, from two candidates' accepted names and confidences (0: none)."""
    a, b, ca, cb = F.col(a_name), F.col(b_name), F.col(a_conf), F.col(b_conf)
    weak = ((ca > 0) & (ca < 90)) | ((cb > 0) & (cb < 90))
    reason = (
        F.when(a.isNull() & b.isNull(), "no_match")
        .when(weak, "weak_match")
        .when(a.isNull() | b.isNull(), "one_side")
        .when(a == b, "same_name")
        .otherwise("two_species")
    )
    return df.withColumn("reason", reason).withColumn("resolved_to", F.when(F.col("reason").isin("one_side", "same_name"), F.coalesce(a, b)))


def match_guard(match_type: Column, rank: Column, kingdom: Column) -> Column:
    """Why a name match isn't accepted, null where it is."""
    return (
        F.when(match_type.isin("NONE", "HIGHERRANK") | match_type.isNull(), "no_species_match")
        .when(~rank.isin("SPECIES", "SUBSPECIES", "VARIETY", "FORM"), "rank")
        .when(~kingdom.isin("Plantae", "Fungi", "Animalia", "Chromista", "Bacteria", "Protozoa"), "kingdom")
    )


def attach_taxonomy(df: DataFrame, species: DataFrame, genera: DataFrame, key: str, genus: str) -> DataFrame:
    """family_final and family_source: by species, else by genus, else the offline family; a genus fallback stays not ok."""
    s = species.select(F.col("name").alias("_s"), F.col("family").alias("_fs"))
    g = genera.select(F.col("name").alias("_g"), F.col("family").alias("_fg"))
    j = df.join(s, F.col(key) == F.col("_s"), "left").join(g, F.col(genus) == F.col("_g"), "left")
    return (
        j.withColumn("family_final", F.coalesce("_fs", "_fg", "family"))
        .withColumn("family_source", F.when(F.col("_fs").isNotNull(), "species").when(F.col("_fg").isNotNull(), "genus_fallback").when(F.col("family").isNotNull(), "offline"))
        .withColumn("ok", F.col("_fs").isNotNull())
        .drop("_s", "_g", "_fs", "_fg")
    )


def parts_and_processes(df: DataFrame, words: Column, description: Column, parts: dict[str, str], processes: dict[str, str], implied: dict[str, str], modifiers: list[str]) -> DataFrame:
    """plant_part (with its source), process, process_all and process_modifiers of a product name's tokens."""
    from florispark.functions.text import map_tokens

    of_name = map_tokens(words, parts)
    of_name = F.when(F.size(of_name) > 1, F.array_remove(of_name, "whole_plant")).otherwise(of_name)
    by_process = map_tokens(words, implied)
    phrase = F.upper(F.regexp_extract(description, r"(?i)\b(?:of|from) the (?:\w+ ){0,2}?(" + "|".join(parts) + r")S?\b", 1))
    of_text = map_tokens(F.array(phrase), parts)
    df = df.withColumn("_name", of_name).withColumn("_implied", by_process).withColumn("_text", F.coalesce(of_text, F.array().cast("array<string>")))
    has = lambda c: F.size(c) > 0
    return (
        df.withColumn("plant_part", F.when(has("_name"), F.col("_name")).when(has("_implied"), F.col("_implied")).when(has("_text"), F.col("_text")))
        .withColumn("part_source", F.when(has("_name"), "inci").when(has("_implied"), "process_implied").when(has("_text"), "description"))
        .withColumn("process_all", map_tokens(words, processes))
        .withColumn("process", F.get("process_all", 0))
        .withColumn("process_modifiers", F.array_distinct(F.filter(words, lambda x: x.isin(*modifiers))))
        .drop("_name", "_implied", "_text")
    )


def aliases(names: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(species, alias, via): names as they are, and synonyms that are verified, of more than a word, no catalogue name, and one species' only.

    synonyms has species, alias, match_type, status, accepted_key, own_key.
    """
    own = names.select("species", F.col("species").alias("alias"), F.lit("name").alias("via"))
    s = synonyms.where("match_type = 'EXACT' and status = 'SYNONYM' and accepted_key = own_key").where(F.contains("alias", F.lit(" "))).select("species", "alias").distinct()
    s = s.join(names.select(F.col("species").alias("alias")), "alias", "left_anti")
    unique = s.groupBy("alias").agg(F.count("*").alias("n")).where("n = 1").select("alias")
    return own.unionByName(s.join(unique, "alias").select("species", "alias", F.lit("synonym").alias("via")))
