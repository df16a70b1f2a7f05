"""Transaction tables derived from the ``events`` table.

The test tables hold no card data. These projections supply every column of the transaction
contract from event columns; they are narrow, so pruning and pushdown reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def project_transactions(events: DataFrame) -> DataFrame:
    """The columns every operator needs, one transaction per event."""
    ts = F.col("ts").cast("timestamp")
    user = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    home_lat = (F.pmod(user * 37, F.lit(140)) - 70).cast("double")
    home_long = (F.pmod(user * 53, F.lit(340)) - 170).cast("double")
    return events.select(
        F.col("event_id").alias("row_id"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("trans_date_trans_time"),
        user.cast("string").alias("cc_num"),
        F.concat(F.lit("m"), F.get_json_object("props", "$.k")).alias("merchant"),
        F.col("event_type").alias("category"),
        F.col("value").alias("amt"),
        home_lat.alias("lat"),
        home_long.alias("long"),
        (F.pmod(user * 7919, F.lit(100000)) + 100).cast("bigint").alias("city_pop"),
        F.unix_seconds(ts).alias("unix_time"),
        (home_lat + (k - 50) / F.lit(25.0)).alias("merch_lat"),
        (home_long + (F.pmod(k, F.lit(10)) - 5) / F.lit(5.0)).alias("merch_long"),
        F.md5(F.col("event_id").cast("string")).alias("trans_num"),
        (
            (F.col("value") > 150) | ((F.col("event_type") == "error") & (F.col("value") > 100))
        )
        .cast("int")
        .alias("is_fraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_transactions(table(spark, sf_dir, "events"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 23 columns in contract order, with rows that break a rule here and there."""
    events = table(spark, sf_dir, "events")
    base = project_transactions(events.select("event_id", "ts", "user_id", "event_type", "value", "props"))
    card = F.col("cc_num").cast("bigint")
    rid = F.col("row_id")
    letter = lambda c: F.char((F.pmod(c, F.lit(26)) + 65).cast("bigint"))
    return base.select(
        "row_id",
        F.when(rid % 911 == 0, F.replace("trans_date_trans_time", F.lit("2024-01"), F.lit("2024-13")))
        .otherwise(F.col("trans_date_trans_time"))
        .alias("trans_date_trans_time"),
        F.when(rid % 499 == 0, F.concat("cc_num", F.lit("x"))).otherwise(F.col("cc_num")).alias("cc_num"),
        F.when(rid % 997 != 0, F.col("merchant")).alias("merchant"),
        F.when(rid % 983 == 0, F.lit("")).otherwise(F.col("category")).alias("category"),
        F.when(rid % 701 == 0, -F.col("amt")).otherwise(F.col("amt")).alias("amt"),
        F.concat(F.lit("first"), (card % 97).cast("string")).alias("first"),
        F.concat(F.lit("last"), (card % 89).cast("string")).alias("last"),
        F.when(rid % 603 == 0, F.lit("U"))
        .when(card % 2 == 0, F.lit("F"))
        .otherwise(F.lit("M"))
        .alias("gender"),
        F.concat((card % 900).cast("string"), F.lit(" Main St")).alias("street"),
        F.concat(F.lit("city"), (card % 50).cast("string")).alias("city"),
        F.when(rid % 887 == 0, F.lit("usa"))
        .otherwise(F.concat(letter(card), letter(card * 7)))
        .alias("state"),
        F.pmod(card * 6007, F.lit(100000)).cast("string").alias("zip"),
        F.when(rid % 1201 == 0, F.col("lat") + 200).otherwise(F.col("lat")).alias("lat"),
        "long",
        "city_pop",
        F.concat(F.lit("job"), (card % 31).cast("string")).alias("job"),
        F.when(rid % 809 == 0, F.lit("1990-02-30"))
        .otherwise(
            F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), F.pmod(card * 37, F.lit(18000)).cast("int")), "yyyy-MM-dd")
        )
        .alias("dob"),
        "trans_num",
        "unix_time",
        "merch_lat",
        "merch_long",
        F.col("is_fraud").cast("tinyint").alias("is_fraud"),
    )
