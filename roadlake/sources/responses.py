"""Raw JSON responses to contract records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.functions.flow import speed_ratio
from roadlake.functions.lookup import category_name
from roadlake.sources import contracts


CORRUPT = "_corrupt_record"


def parsed(body: Column, schema: T.StructType) -> Column:
    """The response, with its text in ``_corrupt_record`` where a field has the wrong type."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = schema.fields + [T.StructField(CORRUPT, T.StringType())]
    return F.from_json(body, T.StructType(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def well_formed(responses: DataFrame, schema: T.StructType, part: str, body: str = "body") -> DataFrame:
    """Adds ``response`` to the responses that parse and hold ``part`` with the right types.

    It comes out of a one-element explode, so no filter parses the text again.
    """
    rows = responses.withColumn("response", F.explode(F.array(parsed(F.col(body), schema))))
    return rows.where(_reason(part).isNull())


def _reason(part: str) -> Column:
    response = F.col("response")
    malformed = response.isNull() | response[CORRUPT].isNotNull()
    return F.when(malformed, "malformed response").when(response[part].isNull(), f"missing {part}")


def dead_letters(responses: DataFrame, schema: T.StructType, part: str, body: str = "body") -> DataFrame:
    """The other responses, whole, with the reason: nothing is read as zeros or left out."""
    rows = responses.withColumn("response", F.explode(F.array(parsed(F.col(body), schema)))).withColumn("reason", _reason(part))
    return rows.where("reason IS NOT NULL").select(
        F.current_timestamp().alias("failed_at"), "reason", F.col(body).alias("record"),
        *[c for c in responses.columns if c != body],
    )


FLOW_PART, INCIDENT_PART = "flowSegmentData", "incidents"


def middle(items: Column) -> Column:
    """The element at half the length of an array, NULL for an empty or missing one."""
    return F.try_element_at(items, (F.size(items) / 2).cast("int") + 1)


def joined_or_null(items: Column) -> Column:
    """Array as comma text; empty and missing arrays give NULL."""
    return F.nullif(F.array_join(F.coalesce(items, F.array().cast("array<string>")), ", "), F.lit(""))


def flow_records(responses: DataFrame, body: str = "body") -> DataFrame:
    """One record per flow response.

    Needs ``ingested_at, location_name, query_lat, query_lon`` next to the JSON
    text. Absent numbers become 0, absent text "", an absent closure false. A body that
    is malformed or has a value of the wrong type gives none: see ``dead_letters``.
    """
    fitting = well_formed(responses, contracts.RAW_FLOW, FLOW_PART, body)
    parsed = fitting.withColumn("seg", F.col("response")[FLOW_PART])

    def zero(field: str) -> Column:
        return F.coalesce(F.col(f"seg.{field}"), F.lit(0))

    current, free_flow = zero("currentSpeed"), zero("freeFlowSpeed")
    centre = middle(F.col("seg.coordinates.coordinate"))
    return parsed.select(
        "ingested_at",
        "location_name",
        "query_lat",
        "query_lon",
        centre["latitude"].alias("segment_lat"),
        centre["longitude"].alias("segment_lon"),
        F.coalesce(F.col("seg.frc"), F.lit("")).alias("frc"),
        current.alias("current_speed_kmh"),
        free_flow.alias("free_flow_speed_kmh"),
        zero("currentTravelTime").alias("current_travel_time"),
        zero("freeFlowTravelTime").alias("free_flow_travel_time"),
        F.coalesce(F.col("seg.confidence"), F.lit(0.0)).cast("float").alias("confidence"),
        F.coalesce(F.col("seg.roadClosure"), F.lit(False)).alias("road_closed"),
        speed_ratio(current, free_flow).alias("congestion_ratio"),
    )


def incident_position(kind: Column, coordinates: Column) -> Column:
    """``[lon, lat]`` of a geometry: the middle vertex of a line, a point itself."""
    line = middle(F.from_json(coordinates, "array<array<double>>"))
    pair = F.from_json(coordinates, "array<double>")
    return F.when(kind == "LineString", line).when((kind == "Point") & (F.size(pair) >= 2), pair)


def message_key(bbox_name: Column, position: Column) -> Column:
    return F.concat_ws("_", bbox_name, position)


def each_incident(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row per element of each response's list: its place, its text, and the parsed ``incident``
    with a ``reason`` where it is none (a value of the wrong type, null, or no object)."""
    fitting = well_formed(responses, contracts.RAW_INCIDENTS, INCIDENT_PART, body)
    kept = [c for c in responses.columns if c != body]
    each = fitting.select(*kept, F.posexplode(F.col("response")[INCIDENT_PART]).alias("position", "text"))
    each = each.withColumn("incident", F.explode(F.array(parsed(F.col("text"), contracts.RAW_INCIDENT))))
    malformed = F.col("incident").isNull() | F.col("incident")[CORRUPT].isNotNull()
    return each.withColumn("reason", F.when(malformed, "malformed incident"))


def incident_dead_letters(responses: DataFrame, body: str = "body") -> DataFrame:
    """Responses that hold no list, whole, and the single incidents that do not fit, with their place."""
    whole = dead_letters(responses, contracts.RAW_INCIDENTS, INCIDENT_PART, body).withColumn("position", F.lit(None).cast("int"))
    single = each_incident(responses, body).where("reason IS NOT NULL").select(
        F.current_timestamp().alias("failed_at"), "reason", F.coalesce("text", F.lit("null")).alias("record"),
        *[c for c in responses.columns if c != body], "position",
    )
    return whole.unionByName(single)


def incident_records(responses: DataFrame, body: str = "body", with_key: bool = False) -> DataFrame:
    """One record per sound incident of each response; needs ``ingested_at, bbox_name``.

    A response with an empty list yields nothing; what is malformed is a dead letter (see
    ``incident_dead_letters``): an incident alone, or a response without a list. ``with_key`` adds the
    message key, the area name and the incident's place in its response.
    """
    each = each_incident(responses, body).where("reason IS NULL").select(
        "ingested_at",
        "bbox_name",
        "position",
        F.col("incident.properties").alias("p"),
        incident_position(F.col("incident.geometry.type"), F.col("incident.geometry.coordinates")).alias("at"),
    )

    def zero(field: str) -> Column:
        return F.coalesce(F.col(f"p.{field}"), F.lit(0))

    key = [message_key(F.col("bbox_name"), F.col("position")).alias("record_key")] if with_key else []
    return each.select(
        *key,
        "ingested_at",
        "bbox_name",
        category_name(zero("iconCategory")).alias("category"),
        zero("iconCategory").alias("icon_category_id"),
        zero("magnitudeOfDelay").alias("magnitude"),
        F.col("p.from").alias("from_location"),
        F.col("p.to").alias("to_location"),
        zero("delay").alias("delay_seconds"),
        zero("length").alias("length_meters"),
        joined_or_null(F.col("p.roadNumbers")).alias("road_numbers"),
        F.col("p.startTime").alias("start_time"),
        F.col("p.endTime").alias("end_time"),
        F.col("p.timeValidity").alias("time_validity"),
        F.col("p.probabilityOfOccurrence").alias("probability_of_occurrence"),
        F.col("p.numberOfReports").alias("number_of_reports"),
        F.col("p.lastReportTime").alias("last_report_time"),
        F.try_element_at(F.col("at"), F.lit(2)).alias("lat"),
        F.try_element_at(F.col("at"), F.lit(1)).alias("lon"),
    )
