"""A workspace laid over plain relational tables (customers, orders, conversations …).

People are customers, teams are regions, channels are nations, posts are orders and
direct channels are conversations. Faults a real export has (unknown people, repeated
ids, missing and forward parents) come from the rows' own attributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatloom.plans.workspace import ATTACHMENTS, Workspace

# Channels are dealt out by order key; one slot per nation of the TPC-H-like schema.
CHANNEL_SLOTS = 25


_KNOWN: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; its schema is read from the file footer once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _KNOWN:
        _KNOWN[path] = spark.read.parquet(path).schema
    return spark.read.schema(_KNOWN[path]).parquet(path)


def person_name(name: Column, balance: Column, segment: Column) -> Column:
    """Low balances share guest accounts, so names repeat, raw and after slugging."""
    return (
        F.when(balance < -900, F.concat(F.lit("Guest "), segment))
        .when(balance < -850, F.concat(F.lit("guest-"), F.lower(segment)))
        .otherwise(name)
    )


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their username and home nation and region."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("username", person_name(F.col("c_name"), F.col("c_acctbal"), F.col("c_mktsegment")))
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    name = person_name(F.col("c_name"), F.col("c_acctbal"), F.col("c_mktsegment"))
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("u_idx"),
        name.alias("username"),
        F.concat("c_name", F.lit("@Example.COM")).alias("email"),
        F.col("c_name").alias("nickname"),
    )


def user_teams(spark: SparkSession, folder: str) -> DataFrame:
    wanted = F.array_compact(
        F.array(
            F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("r_name")),
            F.when(F.col("c_acctbal") < -500, F.col("c_mktsegment")),
        )
    )
    return people(spark, folder).select(
        F.col("c_custkey").alias("u_idx"), "username", F.explode(wanted).alias("team_name")
    )


def teams(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        F.col("r_regionkey").cast("bigint").alias("t_idx"),
        F.col("r_name").alias("name"),
        F.initcap("r_name").alias("display_name"),
        F.concat(F.lit("Region "), "r_name").alias("description"),
    )


def team_people(spark: SparkSession, folder: str) -> DataFrame:
    folk = people(spark, folder)
    region = table(spark, folder, "region")
    nation = table(spark, folder, "nation")
    members = folk.filter(F.col("c_acctbal") >= 0).select(
        F.col("r_regionkey").alias("t_idx"), F.col("r_name").alias("team_name"), "username"
    )
    vendors = (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_regionkey").alias("t_idx"),
            F.col("r_name").alias("team_name"),
            F.col("s_name").alias("username"),
        )
    )
    # Rich customers own the team of the region after their own.
    owners = (
        folk.filter(F.col("c_acctbal") > 9500)
        .select("username", ((F.col("n_regionkey") + 1) % 5).alias("owned"))
        .join(region, F.col("owned") == F.col("r_regionkey"))
        .select(F.col("r_regionkey").alias("t_idx"), F.col("r_name").alias("team_name"), "username")
    )
    return (
        members.unionByName(vendors)
        .withColumn("is_owner", F.lit(False))
        .unionByName(owners.withColumn("is_owner", F.lit(True)))
        .withColumn("t_idx", F.col("t_idx").cast("bigint"))
    )


def channels(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_regionkey").cast("bigint").alias("t_idx"),
        F.col("n_nationkey").cast("bigint").alias("c_idx"),
        F.col("r_name").alias("team_name"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("Nation "), F.col("n_nationkey")).alias("display_name"),
        (F.col("n_nationkey") > 15).alias("is_private"),
    )


def channel_people(spark: SparkSession, folder: str) -> DataFrame:
    folk = people(spark, folder).select(
        F.col("r_regionkey").cast("bigint").alias("t_idx"),
        F.col("n_nationkey").cast("bigint").alias("c_idx"),
        F.col("r_name").alias("team_name"),
        F.col("n_name").alias("channel_name"),
        "username",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("c_mktsegment") == "BUILDING", F.lit(False)),
                    F.when(F.col("c_acctbal") > 9000, F.lit(True)),
                )
            )
        ).alias("is_owner"),
    )
    return folk


def posts(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    places = channels(spark, folder).select(
        "t_idx", "c_idx", "team_name", F.col("name").alias("channel_name")
    )
    key = F.col("o_orderkey")
    priority = F.col("o_orderpriority")
    year = F.year("o_orderdate").cast("string")
    author = person_name(F.col("c_name"), F.col("c_acctbal"), F.col("c_mktsegment"))
    step = F.when(F.col("o_orderstatus") == "F", F.lit(-CHANNEL_SLOTS)).when(
        F.col("o_orderstatus") == "P",
        F.when(priority == "5-LOW", F.lit(CHANNEL_SLOTS)).otherwise(F.lit(-3 * CHANNEL_SLOTS)),
    )
    no_url = F.lit(None).cast("string")
    files = F.array(
        F.struct(
            F.lit("invoice.pdf").alias("name"),
            F.concat(F.lit("invoices/"), "o_custkey", F.lit("/invoice "), year, F.lit(".pdf")).alias("path"),
            no_url.alias("url"),
        ),
        F.struct(
            F.lit("terms.pdf").alias("name"),
            F.concat(F.lit("terms/"), year, F.lit(".pdf")).alias("path"),
            F.concat(F.lit("https://files.example.com/terms/"), year, F.lit(".pdf")).alias("url"),
        ),
    )
    return (
        table(spark, folder, "orders")
        .withColumn("_slot", key % CHANNEL_SLOTS)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("_slot") == F.col("c_idx"))
        .select(
            "t_idx",
            "c_idx",
            key.alias("p_idx"),
            "team_name",
            "channel_name",
            F.when(F.col("o_totalprice") > 450000, F.concat(F.lit("Desk "), priority))
            .otherwise(author)
            .alias("username"),
            F.concat(F.lit("Order "), key, F.lit(" "), priority, F.lit(" for "), F.col("c_name")).alias("message"),
            epoch_ms(F.col("o_orderdate")).alias("timestamp_ms"),
            F.when(priority == "1-URGENT", F.lit(None).cast("string"))
            .when(F.col("o_totalprice") < 5000, F.concat(F.lit("quote-"), year))
            .otherwise(F.concat(F.lit("o"), key))
            .alias("id"),
            F.concat(F.lit("o"), key + step).alias("parent_id"),
            F.when(priority == "2-HIGH", files).otherwise(F.array().cast(ATTACHMENTS)).alias("attachments"),
        )
    )


def _speaker() -> Column:
    return F.when(
        F.col("role") == "user",
        F.concat(F.lit("Customer#"), F.lpad(F.col("conv_id").cast("string"), 9, "0")),
    ).otherwise(F.col("role"))


def direct_channels(spark: SparkSession, folder: str) -> DataFrame:
    """Members are the roles that wrote at least one message of some length."""
    wrote = F.when(F.length("text") >= 120, _speaker())
    return (
        table(spark, folder, "conversations")
        .groupBy(F.col("conv_id").alias("d_idx"))
        .agg(F.array_sort(F.collect_set(wrote)).alias("members"))
    )


def direct_posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("d_idx"),
        F.col("turn").alias("p_idx"),
        _speaker().alias("username"),
        F.col("text").alias("message"),
        (F.lit(1_700_000_000_000) + F.col("conv_id") * 1000 + (F.col("turn") * 3) % 4).alias("timestamp_ms"),
        F.lit(None).cast("string").alias("id"),
        F.array().cast(ATTACHMENTS).alias("attachments"),
    )


def workspace(spark: SparkSession, folder: str) -> Workspace:
    return Workspace(
        users=users(spark, folder),
        user_teams=user_teams(spark, folder),
        teams=teams(spark, folder),
        team_people=team_people(spark, folder),
        channels=channels(spark, folder),
        channel_people=channel_people(spark, folder),
        posts=posts(spark, folder),
        direct_channels=direct_channels(spark, folder),
        direct_posts=direct_posts(spark, folder),
    )


def target_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the target system's posts table: id, createat and JSON props.

    Error events carry no import id, sign-ups an import id the capture cannot read.
    """
    number = F.get_json_object("props", "$.k")
    props = (
        F.when(F.col("event_type") == "error", F.concat(F.lit('{"note": '), number, F.lit("}")))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"import_id": '), number, F.lit("}")))
        .otherwise(F.concat(F.lit('{"import_id" : "post-'), number, F.lit('"}')))
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"), epoch_ms(F.col("ts")).alias("createat"), props.alias("props")
    )


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Metric samples: a wrapping counter, a gauge and an up/down state per user."""
    second = F.date_trunc("second", F.col("ts").cast("timestamp"))
    label = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type"))
    labels = F.create_map(
        F.lit("series"), F.col("user_id").cast("string"), F.lit("container"), label
    )
    measures = F.array(
        F.struct(F.lit("work_total").alias("metric"), (F.col("event_id") % 1000).cast("double").alias("value")),
        F.struct(F.lit("memory_bytes").alias("metric"), F.col("value").alias("value")),
        F.struct(
            F.lit("up").alias("metric"),
            F.when(F.col("value") < 25, F.lit(0.0)).otherwise(F.lit(1.0)).alias("value"),
        ),
    )
    return (
        table(spark, folder, "events")
        .select(second.alias("ts"), labels.alias("labels"), F.explode(measures).alias("m"), "event_id")
        .select("ts", "event_id", F.col("m.metric").alias("metric"), "labels", F.col("m.value").alias("value"))
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON log lines with the container name the log shipper attaches."""
    service = F.when(F.col("value") < 20, F.lit("postgres")).when(
        F.col("value") < 60, F.lit("chat-server")
    ).otherwise(F.concat(F.lit("postgres-"), F.col("event_type")))
    line = F.to_json(
        F.struct(
            F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
            F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
            F.lit("job").alias("logger"),
            service.alias("service"),
            F.concat(F.lit("run-"), F.col("user_id")).alias("correlation_id"),
            F.concat(F.col("event_type"), F.lit(" handled")).alias("message"),
            F.when(F.col("event_type") == "error", F.lit("run_failed")).alias("event"),
            F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("details"),
        )
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("line_no"),
        F.concat(F.lit("/"), service, F.lit("-1")).alias("container_name"),
        line.alias("line"),
    )
