"""Queries of the problems that this subpackage solves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import abuse, address, entities, groups, mojibake, packing, tokens
from wayfold.plans.runtime import materialize, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.consolidate(table(spark, sf_dir, "node_match_pairs"), "from_node_id", "canonical_node_id")


def _facility_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Removed facilities and remove candidates in the form that entities.match takes."""
    r = table(spark, sf_dir, "facility_priority_manual_removed_applied").where("removed_id is not null").drop("ingested_at", "removed_at").dropDuplicates(["removed_id"])
    c = table(spark, sf_dir, "facility_priority_manual_remove_candidates").where("candidate_id is not null").dropDuplicates(["candidate_id"])
    parts = [address.parsed(df, key, col) for df, key, col in ((r, "removed_id", "public_facility_address"), (r, "removed_id", "address"), (c, "candidate_id", "address"))]
    places = address.buildings(materialize(reduce(DataFrame.unionByName, parts)))
    found = places.groupBy("record_id").agg(F.collect_set("building").alias("buildings"), F.min("road").alias("road"))  # two addresses a record at most
    empty = F.array().cast("array<string>")

    def side(df: DataFrame, key: str, names: list[str], category: str, metres: str) -> DataFrame:
        rest = df.select(F.col(key).alias("record_id"), F.col("district_gu").alias("district"), F.col(category).alias("category"), F.col(metres).alias("metres"))
        return entities.described(df, key, names).drop("pieces").join(rest, "record_id").join(found, "record_id", "left").withColumn("buildings", F.coalesce("buildings", empty))

    return side(r, "removed_id", ["name", "public_facility_name"], "db_category", "case_kakao_distance_m"), side(c, "candidate_id", ["kakao_place_name", "name", "poi_name"], "db_category", "kakao_distance_m")


def _facility_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.match(*_facility_sides(spark, sf_dir))[0]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.decide(_facility_marginals(spark, sf_dir)).select(F.col("left_id").alias("removed_id"), F.col("right_id").alias("candidate_id"))


def p3_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every accepted pair with its marginal probability."""
    return entities.decide(_facility_marginals(spark, sf_dir)).select(F.col("left_id").alias("removed_id"), F.col("right_id").alias("candidate_id"), F.round("probability", 6).alias("confidence"))


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = address.parsed(table(spark, sf_dir, "places"), "place_id", "address")
    removed = address.parsed(table(spark, sf_dir, "facility_priority_manual_removed_applied"), "removed_id", "public_facility_address")
    return materialize(places.unionByName(removed))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address.same_building(_addresses(spark, sf_dir))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.garbled_cells(table(spark, sf_dir, "places"), "place_id", ["name", "address"]).select("place_id", "field_name").distinct()


def p7_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The garbled cells with the text as it was meant, null where it is lost."""
    return mojibake.garbled_cells(table(spark, sf_dir, "places"), "place_id", ["name", "address"]).distinct()


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"))


def _packed(spark: SparkSession, sf_dir: str) -> list[tuple[str, int, DataFrame]]:
    sizes = materialize(tokens.count(table(spark, sf_dir, "documents")))
    names = table(spark, sf_dir, "pack_capacities").where("capacity_tokens > 0").collect()  # a fixed table of three rows
    return [(r["capacity_name"], r["capacity_tokens"], packing.pack(sizes, r["capacity_tokens"])) for r in sorted(names, key=lambda r: r["capacity_tokens"])]


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """capacity_name, container_id, doc_id, part_no, n_tokens: where every document is put, for every capacity."""
    rows = [p.select(F.lit(name).alias("capacity_name"), "container_id", F.col("item_id").alias("doc_id"), "part_no", F.col("size").alias("n_tokens")) for name, _, p in _packed(spark, sf_dir)]
    return reduce(DataFrame.unionByName, rows)


def p9_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [packing.summary(p, c).select(F.lit(name).alias("capacity_name"), F.lit(c).cast("bigint").alias("capacity_tokens"), "*") for name, c, p in _packed(spark, sf_dir)]
    return reduce(DataFrame.unionByName, rows)


def _abuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = abuse.trained(documents, table(spark, sf_dir, "document_labels"))
    return abuse.scored(documents, model)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _abuse(spark, sf_dir).where("found").select("doc_id").distinct()


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _abuse(spark, sf_dir).select("doc_id", "source", "language", F.round("score", 4).alias("score"), "found")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, findings and their share by source."""
    per = _abuse(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if("found").alias("n_found"))
    return per.withColumn("rate", F.round(F.col("n_found") / F.col("n_docs"), 6))


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p3_confidence": p3_confidence, "p5_found": p5_found, "p7_found": p7_found, "p7_restored": p7_restored, "p8_ids": p8_ids, "p9_pack": p9_pack, "p9_summary": p9_summary, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates}

ORACLES = {
    "p1_found": """
    with recursive e as (select from_node_id x, canonical_node_id y from node_match_pairs where from_node_id is not null and canonical_node_id is not null
                         union select canonical_node_id, from_node_id from node_match_pairs where from_node_id is not null and canonical_node_id is not null),
    v as (select from_node_id v from node_match_pairs where from_node_id is not null union select canonical_node_id from node_match_pairs where canonical_node_id is not null),
    r(v, g) as (select v, v from v union select e.y, r.g from r join e on e.x = r.v where r.g < e.y)
    select v as vertex_id, min(g) as group_id from r group by v
    """,
}
