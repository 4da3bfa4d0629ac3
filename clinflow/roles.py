"""Clinical tables derived from general business tables.

Lets every operator run on any scale of the TPC-H-like data: orders and events act as
encounters, line items as laboratory results, parts as conditions, customers as patients.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clinflow.functions import los_hours
from clinflow.operators.storage import scratch_path

EVENT_CLASS = {"error": "EMER", "purchase": "IMP", "view": "AMB", "signup": "HH", "click": "VR"}
# The fifth priority has no class: it stands for encounters without a code.
ORDER_CLASS = {
    "1-URGENT": "EMER", "2-HIGH": "IMP", "3-MEDIUM": "AMB", "4-NOT SPECIFIED": "HH",
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a table; its footers are read for the schema only the first time."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _mapped(col: Column, mapping: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, value in mapping.items():
        out = F.when(col == key, value).otherwise(out)
    return out


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("bigint") * 1_000_000)


def encounters_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat encounters: ``value`` is the stay in hours. Long overlapping histories per user."""
    start = F.col("ts").cast("timestamp")
    seconds = F.floor(F.col("value") * 3600.0)
    return table(spark, sf_dir, "events").select(
        _text("event_id").alias("encounter_id"),
        _text("user_id").alias("patient_id"),
        F.lit("finished").alias("status"),
        _mapped(F.col("event_type"), EVENT_CLASS).alias("encounter_class"),
        F.col("event_type").alias("encounter_type"),
        F.get_json_object("props", "$.k").alias("encounter_snomed_code"),
        F.concat(F.lit("EpisodeOfCare/"), _text("user_id")).alias("episode_of_care_ref"),
        start.alias("admit_timestamp"),
        _plus_seconds(start, seconds).alias("discharge_timestamp"),
        F.col("value").alias("los_hours"),
        F.concat(F.lit("provider-"), (F.col("user_id") % 7).cast("string")).alias("service_provider"),
        F.lit(None).cast("string").alias("location_display"),
        F.lit(None).cast("string").alias("reason_for_visit"),
    )


def _episode_id(customer: Column, date: Column) -> Column:
    return F.concat_ws("-", customer.cast("string"), F.year(date).cast("string"))


def encounters_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat encounters: stays of 0 to 9 days, with provider, region and episode."""
    orders = table(spark, sf_dir, "orders")
    first_supplier = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("s_suppkey"))
    providers = first_supplier.join(table(spark, sf_dir, "supplier"), "s_suppkey").select(
        "o_orderkey", "s_name")
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("o_custkey"), "r_name")
    )
    start = F.col("o_orderdate").cast("timestamp")
    days = F.col("o_orderkey") % 10
    return orders.join(providers, "o_orderkey", "left").join(places, "o_custkey", "left").select(
        _text("o_orderkey").alias("encounter_id"),
        _text("o_custkey").alias("patient_id"),
        F.lit("finished").alias("status"),
        _mapped(F.col("o_orderpriority"), ORDER_CLASS).alias("encounter_class"),
        F.col("o_orderstatus").alias("encounter_type"),
        F.lit(None).cast("string").alias("encounter_snomed_code"),
        F.concat(F.lit("EpisodeOfCare/"), _episode_id(F.col("o_custkey"), F.col("o_orderdate")))
        .alias("episode_of_care_ref"),
        start.alias("admit_timestamp"),
        _plus_seconds(start, days * 86400).alias("discharge_timestamp"),
        (days * 24.0).alias("los_hours"),
        F.col("s_name").alias("service_provider"),
        F.col("r_name").alias("location_display"),
        F.col("o_orderpriority").alias("reason_for_visit"),
    )


def encounters_from_shipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat encounters whose end is the last ship date: missing, negative and very long stays."""
    shipped = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    start, end = F.col("o_orderdate").cast("timestamp"), F.col("shipped").cast("timestamp")
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "orders").join(shipped, "o_orderkey", "left").select(
        _text("o_orderkey").alias("encounter_id"),
        _text("o_custkey").alias("patient_id"),
        F.col("o_orderstatus").alias("status"),
        _mapped(F.col("o_orderpriority"), ORDER_CLASS).alias("encounter_class"),
        F.col("o_orderpriority").alias("encounter_type"),
        none.alias("encounter_snomed_code"),
        none.alias("episode_of_care_ref"),
        start.alias("admit_timestamp"),
        end.alias("discharge_timestamp"),
        los_hours(start, end).alias("los_hours"),
        none.alias("service_provider"),
        none.alias("location_display"),
        none.alias("reason_for_visit"),
    )


def patients_from_customers(spark: SparkSession, sf_dir: str, known_only: bool = False) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    if known_only:
        customers = customers.filter("c_acctbal > 0")
    return (
        customers
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            _text("c_custkey").alias("patient_id"),
            F.lit(None).cast("string").alias("gender"),
            F.lit(None).cast("string").alias("birth_date"),
            F.col("c_name").alias("name_family"),
            F.lit(None).cast("string").alias("name_given"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lit(None).cast("string").alias("country"),
            F.col("c_mktsegment").alias("marital_status"),
        )
    )


def observations_from_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat observations: brand is the code, return flag the unit, quantity the result."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("observation_id"),
            _text("o_custkey").alias("patient_id"),
            _text("l_orderkey").alias("encounter_id"),
            F.col("l_linestatus").alias("status"),
            F.col("p_brand").alias("loinc_code"),
            F.col("p_name").alias("observation_name"),
            F.col("p_type").alias("obs_category"),
            F.col("l_shipdate").cast("timestamp").alias("effective_datetime"),
            F.col("l_quantity").alias("result_value"),
            F.col("l_returnflag").alias("result_unit"),
            F.lit(None).cast("string").alias("result_text"),
        )
    )


def episodes_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat episodes: the orders of a customer in a year."""
    year = F.year("o_orderdate")
    grouped = table(spark, sf_dir, "orders").groupBy("o_custkey", year.alias("year")).agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return grouped.select(
        F.concat_ws("-", _text("o_custkey"), _text("year")).alias("episode_id"),
        _text("o_custkey").alias("patient_id"),
        F.lit("active").alias("episode_status"),
        F.concat(F.lit("year "), _text("year")).alias("episode_type"),
        F.col("first").cast("timestamp").alias("episode_start"),
        F.col("last").cast("timestamp").alias("episode_end"),
    )


# Nested resources as NDJSON, for the scan and the flatteners.

# Lines of one file: it is compressed, so one task reads it whole.
FILE_LINES = 250_000


def write_lines(lines: DataFrame, folder: str, resource: str, shard: int = 0) -> None:
    """One shard, compressed: lines repeat their field names and take many times the space of their rows."""
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).text(
        f"{folder}/{resource}_{shard:03d}.ndjson")


def write_ndjson(rows: DataFrame, folder: str, resource: str, shard: int = 0) -> None:
    write_lines(rows.select(F.to_json(F.struct(*rows.columns)).alias("value")), folder, resource, shard)


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _entry(**fields: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def patient_lines(spark: SparkSession, sf_dir: str) -> str:
    """Patients: every third has no name array, every fourth an empty address array."""
    rows = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key = F.col("c_custkey")
    name = F.array(
        _entry(family=F.col("c_name"), given=F.array(F.col("c_mktsegment"), F.lit("second"))),
        _entry(family=F.lit("former"), given=F.array(F.lit("other"))))
    address = F.array(_entry(city=F.col("n_name"), state=F.col("r_name"), country=F.lit("US")))
    nested = rows.select(
        _text("c_custkey").alias("id"),
        F.when(key % 2 == 0, "female").otherwise("male").alias("gender"),
        F.lit("1970-01-31").alias("birthDate"),
        F.when(key % 3 != 0, name).alias("name"),
        F.when(key % 4 == 0, F.filter(address, lambda a: F.lit(False))).otherwise(address)
        .alias("address"),
        _entry(text=F.col("c_mktsegment")).alias("maritalStatus"),
        F.lit("ignored").alias("extraField"),
    )
    folder = scratch_path(spark, "ndjson")
    write_ndjson(nested, folder, "Patient")
    return folder


def encounter_lines(spark: SparkSession, sf_dir: str) -> str:
    """Encounters: types absent, empty, without coding or double; starts with two offsets; ends
    missing, malformed or before the start; a second version of every seventh encounter; lines cut off."""
    key, start = F.col("event_id"), F.col("ts").cast("timestamp")
    seconds = F.floor(F.col("value") * 3600.0)
    end = _iso(_plus_seconds(start, F.when(key % 50 == 2, -seconds).otherwise(seconds)))
    code = F.concat(F.lit("c"), F.get_json_object("props", "$.k"))
    kind = F.array(
        _entry(text=F.col("event_type"), coding=F.array(_entry(code=code), _entry(code=F.lit("x")))),
        _entry(text=F.lit("second"), coding=F.array(_entry(code=F.lit("y")))))
    bare = F.array(_entry(
        text=F.col("event_type"), coding=F.filter(F.array(_entry(code=code)), lambda c: F.lit(False))))
    types = (
        F.when(key % 4 == 1, F.filter(kind, lambda t: F.lit(False)))
        .when(key % 4 == 2, bare)
        .when(key % 4 == 3, kind)
    )
    nested = table(spark, sf_dir, "events").select(
        key,
        _text("event_id").alias("id"),
        F.lit("finished").alias("status"),
        _entry(code=_mapped(F.col("event_type"), EVENT_CLASS)).alias("class"),
        types.alias("type"),
        _entry(reference=F.concat(
            F.when(key % 11 == 0, "urn:uuid:").otherwise("Patient/"), _text("user_id")))
        .alias("subject"),
        F.array(_entry(reference=F.concat(F.lit("EpisodeOfCare/"), _text("user_id"))))
        .alias("episodeOfCare"),
        _entry(
            start=F.when(key % 2 == 0, F.concat(_iso(start), F.lit("+00:00")))
            .otherwise(F.concat(_iso(_plus_seconds(start, F.lit(-18000))), F.lit("-05:00"))),
            end=F.when(key % 50 == 1, "not a date")
            .when(key % 50 != 0, F.concat(end, F.lit("Z"))),
        ).alias("period"),
        F.array(_entry(location=_entry(display=F.concat(F.lit("ward "), (key % 5).cast("string")))))
        .alias("location"),
    )
    folder = scratch_path(spark, "ndjson")
    write_ndjson(nested.drop("event_id"), folder, "Encounter")
    second = nested.filter(key % 7 == 0).drop("event_id").withColumn("status", F.lit("amended"))
    write_ndjson(second, folder, "Encounter", 1)
    # Lines that do not parse: every 97th encounter once more, cut off in the middle.
    whole = nested.filter(key % 97 == 0).drop("event_id")
    cut = whole.select(F.to_json(F.struct(*whole.columns)).alias("value")).select(
        F.expr("left(value, 40)").alias("value"))
    write_lines(cut, folder, "Encounter", 2)
    return folder


def condition_lines(spark: SparkSession, sf_dir: str) -> str:
    """Conditions: one coding per word of the part name, every ninth part without coding."""
    key = F.col("p_partkey")
    words = F.transform(
        F.split("p_name", " "),
        lambda word, i: F.struct(
            F.concat(F.lit("system-"), i.cast("string")).alias("system"),
            word.alias("code"), F.upper(word).alias("display")))
    status = _entry(coding=F.array(_entry(code=F.col("p_type"))))
    nested = table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("id"),
        _entry(reference=F.concat(F.lit("Patient/"), (key % 100).cast("string"))).alias("subject"),
        _entry(reference=F.concat(F.lit("Encounter/"), (key % 50).cast("string"))).alias("encounter"),
        F.when(key % 9 != 0, _entry(coding=words)).alias("code"),
        status.alias("clinicalStatus"),
        _entry(coding=F.array(_entry(code=F.lit("confirmed")))).alias("verificationStatus"),
        F.array(_entry(coding=F.array(_entry(display=F.col("p_brand"))))).alias("category"),
        F.lit("2001-02-03T04:05:06+02:00").alias("onsetDateTime"),
        F.when(key % 3 == 0, "broken").when(key % 3 == 1, "2002-02-03T04:05:06Z")
        .alias("abatementDateTime"),
        F.lit("2001-02-03T23:30:00-05:00").alias("recordedDate"),
    )
    folder = scratch_path(spark, "ndjson")
    write_ndjson(nested, folder, "Condition")
    return folder


def observation_lines(spark: SparkSession, sf_dir: str) -> str:
    """Observations in two shards, with a LOINC coding, a local one and one without system."""
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    coding = F.array(
        _entry(system=F.lit("http://local"), code=F.lit("z"), display=F.lit("local")),
        _entry(system=F.lit("http://loinc.org"), code=F.col("p_brand"), display=F.col("p_name")),
        _entry(system=F.lit(None).cast("string"), code=F.lit("n"), display=F.lit("none")))
    local = F.array(_entry(
        system=F.lit("http://local"), code=F.lit("z"), display=F.lit("local")))
    nested = rows.select(
        "l_orderkey",
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("id"),
        F.lit("final").alias("status"),
        _entry(reference=F.concat(F.lit("Patient/"), _text("l_suppkey"))).alias("subject"),
        _entry(reference=F.concat(F.lit("Encounter/"), _text("l_orderkey"))).alias("encounter"),
        _entry(coding=F.when(F.col("l_linenumber") == 7, local).otherwise(coding)).alias("code"),
        F.array(_entry(coding=F.array(_entry(code=F.col("p_type"))))).alias("category"),
        F.concat(_iso(F.col("l_shipdate").cast("timestamp")), F.lit("Z")).alias("effectiveDateTime"),
        F.when(F.col("l_linenumber") != 1, _entry(value=F.col("l_quantity"), unit=F.col("l_returnflag")))
        .alias("valueQuantity"),
        F.when(F.col("l_linenumber") == 1, _entry(text=F.col("l_linestatus")))
        .alias("valueCodeableConcept"),
    )
    folder = scratch_path(spark, "ndjson")
    for shard in (0, 1):
        write_ndjson(
            nested.filter(F.col("l_orderkey") % 2 == shard).drop("l_orderkey"),
            folder, "Observation", shard)
    return folder


def episode_lines(spark: SparkSession, sf_dir: str) -> str:
    flat = episodes_from_orders(spark, sf_dir)
    nested = flat.select(
        F.col("episode_id").alias("id"),
        _entry(reference=F.concat(F.lit("Patient/"), F.col("patient_id"))).alias("patient"),
        F.col("episode_status").alias("status"),
        F.array(_entry(coding=F.array(_entry(display=F.col("episode_type"))))).alias("type"),
        _entry(
            start=F.concat(_iso(F.col("episode_start")), F.lit("Z")),
            end=F.concat(_iso(F.col("episode_end")), F.lit("Z"))).alias("period"),
    )
    folder = scratch_path(spark, "ndjson")
    write_ndjson(nested, folder, "EpisodeOfCare")
    return folder
