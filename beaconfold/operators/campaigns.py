"""Reconciling partner campaigns met in event data with internal campaigns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconfold.schemas import CAMPAIGN_PAIRS, UNNAMED_CAMPAIGN

CAMPAIGN = "partner_measured_campaign_id"
ENTITY = "ias_adv_entity_id"

# How a pair relates to the mapping on record.
NO_CAMPAIGN_ID = "MISSING_CAMPAIGN"
INVALID_ENTITY = "INVALID_ENTITY"
OVERRIDE_REJECTED = "OVERRIDE_REJECTED"
UNCHANGED = "UNCHANGED"
AMBIGUOUS = "AMBIGUOUS"
UPDATE = "UPDATE"
INSERT = "INSERT"
EXCEPTIONS = (NO_CAMPAIGN_ID, INVALID_ENTITY, OVERRIDE_REJECTED, AMBIGUOUS)

# Line format of rejected overrides in the exceptions report.
OVERRIDE_LINE = "%-19s | %-24s | %-19s"


def extract_pairs(events: DataFrame) -> DataFrame:
    """Distinct (campaign, entity) pairs of events mapped to an entity.

    Copies collapse in the map tasks; an event whose entity is 0 or NULL is not mapped.
    """
    return events.where(F.col(ENTITY) != 0).select(*CAMPAIGN_PAIRS.names).distinct()


def classify_pairs(pairs: DataFrame, entities: DataFrame, campaigns: DataFrame, source_id: int) -> DataFrame:
    """What each pair means for the campaign table.

    Both lookups are left joins to tables with unique ids, planned by size: broadcast when
    small, otherwise a shuffle join in which adaptive execution splits a skewed left side.
    A campaign that would be written with two different values is AMBIGUOUS and not written.
    """
    resolved = pairs.join(entities.select(F.col("ID").alias(ENTITY), F.col("CAMPAIGN_ID").alias("new")), ENTITY, "left")
    on_record = campaigns.where(F.col("MEASUREMENT_SOURCE_ID") == source_id).select(
        F.col("ID").alias(CAMPAIGN), F.col("CAMPAIGN_ID").alias("existing"), F.lit(True).alias("_on_record")
    )
    contested = (
        resolved.groupBy(CAMPAIGN)
        .agg(F.min("new").alias("_least"), F.max("new").alias("_most"))
        .where(F.col("_least") < F.col("_most"))
        .select(CAMPAIGN, F.lit(True).alias("_contested"))
    )
    verdict = (
        F.when(F.col(CAMPAIGN).isNull(), NO_CAMPAIGN_ID)
        .when(F.col("new").isNull(), INVALID_ENTITY)
        .when(F.col("existing") != F.col("new"), OVERRIDE_REJECTED)
        .when(F.col("existing") == F.col("new"), UNCHANGED)
        .when(F.col("_contested"), AMBIGUOUS)
        .when(F.col("_on_record"), UPDATE)
        .otherwise(INSERT)
    )
    return (
        resolved.join(on_record, CAMPAIGN, "left")
        .join(contested, CAMPAIGN, "left")
        .select(CAMPAIGN, ENTITY, "existing", "new", verdict.alias("class"))
    )


def apply_pairs(campaigns: DataFrame, classified: DataFrame, source_id: int) -> DataFrame:
    """Next snapshot of the campaign table: updated and inserted mappings, all other rows as they are."""
    writes = (
        classified.where(F.col("class").isin(UPDATE, INSERT))
        .select(F.lit(source_id).alias("MEASUREMENT_SOURCE_ID"), F.col(CAMPAIGN).alias("ID"), "new")
        .distinct()
    )
    key = ["MEASUREMENT_SOURCE_ID", "ID"]
    merged = {
        "NAME": F.coalesce("NAME", F.when(F.col("_on_record").isNull(), UNNAMED_CAMPAIGN)),
        "CAMPAIGN_ID": F.coalesce("new", "CAMPAIGN_ID"),
    }
    return (
        campaigns.withColumn("_on_record", F.lit(True))
        .join(writes, key, "full_outer")
        .select(*[merged.get(c, F.col(c)).alias(c) for c in campaigns.columns])
    )


def mapping_exceptions(classified: DataFrame) -> DataFrame:
    """Distinct exceptions, each reduced to the columns that identify it, with its report line."""
    kind = F.col("class")

    def only(column: str, *kinds: str) -> Column:
        return F.when(kind.isin(*kinds), F.col(column))

    return (
        classified.where(kind.isin(*EXCEPTIONS))
        .select(
            kind.alias("kind"),
            only(CAMPAIGN, OVERRIDE_REJECTED, AMBIGUOUS).alias(CAMPAIGN),
            only("existing", OVERRIDE_REJECTED).alias("existing"),
            only("new", OVERRIDE_REJECTED, AMBIGUOUS).alias("new"),
            only(ENTITY, INVALID_ENTITY, NO_CAMPAIGN_ID).alias(ENTITY),
        )
        .distinct()
        .withColumn(
            "report_line",
            F.when(F.col("kind") == OVERRIDE_REJECTED, F.format_string(OVERRIDE_LINE, CAMPAIGN, "existing", "new"))
            .when(F.col("kind") == AMBIGUOUS, F.format_string(OVERRIDE_LINE, CAMPAIGN, F.lit("none"), "new"))
            .otherwise(F.col(ENTITY).cast("string")),
        )
    )
