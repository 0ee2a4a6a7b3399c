"""Views that give the test tables the shape of survey data.

Each view reads and joins only what the asked columns need, and leaves the kind of join to Spark,
which broadcasts a side only where its measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions.answers import band
from tallywell.functions.lexicon import Lexicon

PRICE_EDGES = [100_000.0, 200_000.0, 300_000.0]
PRICE_CODES = ["under100k", "100k_199k", "200k_299k", "300kplus"]
GENDER_CODES = ["male", "female", "other", "no_answer"]

# Frequent words of the invented texts stand in for terms; "ABV" and others stay without a term.
POSITIVE = Lexicon.of([
    ("the", "Appearance", 1), ("of", "Aroma", 2), ("de", "Flavor", 1), ("der", "Flavor", 2),
    ("la", "PriceValue", 1), ("is", "Availability", 3),
])
NEGATIVE = Lexicon.of([
    ("and", "Flavor", 1), ("to", "PackagingDesign", 2), ("que", "Aroma", 2), ("le", "PriceValue", 1),
    ("und", "ShelfLifeStorage", 2), ("die", "Appearance", 1), ("it", "SocialAcceptability", 3),
])
SCENE = Lexicon.of_terms(["with", "for", "mit", "por", "pour", "dans"])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any store that Spark reads is a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def answers(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Coded answers, one row per order."""
    df = table(spark, folder, "orders")
    if {"occupation", "region"} & set(columns):
        customer = table(spark, folder, "customer")
        df = df.join(customer, df.o_custkey == customer.c_custkey)
    if "region" in columns:
        nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
        df = df.join(nation, F.col("c_nationkey") == nation.n_nationkey)
        df = df.join(region, F.col("n_regionkey") == region.r_regionkey)
    key = F.col("o_orderkey")
    gender = F.element_at(F.array(*[F.lit(g) for g in GENDER_CODES]), (key % 4 + 1).cast("int"))
    views = {
        "id": key,
        "submitted_at": F.col("o_orderdate").cast("timestamp"),
        "gender": F.when(key % 11 != 0, gender),
        "occupation": F.col("c_mktsegment"),
        "region": F.col("r_name"),
        "drives_weekly": key % 2 == 0,
        "satisfaction": F.substring("o_orderpriority", 1, 1),
        "satisfaction_int": F.substring("o_orderpriority", 1, 1).try_cast("int"),
        "purchase_intent": F.when(F.col("o_orderstatus") == "F", "def_buy")
        .when(F.col("o_orderstatus") == "O", "maybe").when(F.col("o_orderstatus") == "P", "no"),
        "price_band": band(F.col("o_totalprice"), PRICE_EDGES, PRICE_CODES),
    }
    return df.select(*[views[c].alias(c) for c in columns])


ANSWER_COLUMNS = ["id", "submitted_at", "gender", "occupation", "region", "drives_weekly",
                  "satisfaction_int", "purchase_intent", "price_band"]


def multi_answers(spark: SparkSession, folder: str) -> DataFrame:
    """(id, options): the part types of each order that has line items.

    The exchange carries the distinct options of an id, at most the number of part types, so an
    order with very many lines is as light as any other.
    """
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.sort_array(F.collect_set("p_type")).alias("options"))
    )


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """(id, segment, free_comment) from the documents."""
    docs = table(spark, folder, "documents")
    return docs.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("segment"), F.col("text").alias("free_comment"))


def timeline(spark: SparkSession, folder: str) -> DataFrame:
    """(id, submitted_at, label, value) from the events."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("submitted_at"),
        F.col("event_type").alias("label"), "value")


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    """The timeline as a stream, with every third response sent twice."""
    events = table(spark, folder, "events")
    reader = spark.readStream.schema(events.schema)
    if not is_folder(spark, f"{folder}/events.parquet"):
        # The table is a file; a stream reads folders.
        events = reader.option("pathGlobFilter", "events.parquet").parquet(folder)
    else:
        events = reader.parquet(f"{folder}/events.parquet")
    return (
        events.select(
            F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("submitted_at"),
            F.col("event_type").alias("label"))
        .withColumn("_copy", F.explode(F.when(F.col("id") % 3 == 0, F.array(F.lit(1), F.lit(2)))
                                       .otherwise(F.array(F.lit(1)))))
        .drop("_copy")
    )
