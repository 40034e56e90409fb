"""Raw rank observations as a view over the sales tables: one per line item, part = book, order priority = list,
order date = rank date. Dirty values are placed by modulus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankhouse.operators.windows import parts_for

# Ties of one book and date, settled in this order on both sides of the comparison.
TIE_BREAKERS = "popularity read_count score number rank_name status words_num".split()

COLUMNS = {
    "book_id": "case when mod(l_orderkey,101)=0 then 'http://bad/'||cast(l_partkey as string) "
    "when mod(l_orderkey,103)=0 then null else 'B'||cast(l_partkey as string) end",
    "title": "case when mod(l_orderkey,107)=0 then '0' when mod(l_orderkey,109)=0 then null "
    "when mod(l_partkey,7)=0 then replace(p_name,' ',char(10)) else p_name end",
    "author": "p_brand",
    "category1_name": "case when mod(l_partkey,53)=0 then null else p_type end",
    "category2_name": "'S'||cast(cast(floor(p_size/10) as int) as string)",
    "words_num": "case when mod(l_partkey,4)=0 then cast(p_size*4 as string)||'万字' "
    "when mod(l_partkey,4)=1 then cast(p_size*40000 as string)||'字' when mod(l_partkey,59)=0 then '0x1.8p1' when mod(l_partkey,5)=0 then '未找到' "
    "else cast(p_size*40000 as string) end",
    "image_link": "cast(null as string)",
    "status": "case o_orderstatus when 'F' then '1' when 'O' then '0' end",
    "number": "cast(cast(l_quantity as int) as string)",
    "unit": "'万'",
    "rank_name": "case o_orderpriority when '1-URGENT' then '月票榜' when '2-HIGH' then '打赏榜' "
    "when '3-MEDIUM' then '大热' when '5-LOW' then '新书' end",
    "date_type": "'月榜'",
    "date_month": "date_format(o_orderdate,'yyyyMM')",
    "rank_date": "case when mod(l_orderkey,113)=0 then 'bad' else cast(cast(o_orderdate as date) as string) end",
    "score": "case when mod(l_orderkey,11)=0 then '未找到' when mod(l_orderkey,59)=0 then '0x1p3' when mod(l_orderkey,61)=0 then '5'||char(10) "
    "when mod(l_orderkey,67)=0 then ' 7.5 ' when mod(l_orderkey,71)=0 then '9.0d' when mod(l_orderkey,73)=0 then '1e1' else cast(5+mod(l_partkey,5) as string)||'.'||"
    "cast(mod(cast(round(l_discount*100) as int),10) as string) end",
    "read_count": "case when mod(l_orderkey,17)=0 then '获取失败' "
    "when mod(p_size,5)=0 then cast(cast(l_quantity as int) as string) "
    "when mod(p_size,5)=1 then cast(cast(l_quantity*1000 as int) as string) "
    "when mod(p_size,5)=2 then cast(cast(l_quantity as int) as string)||'万' "
    "else cast(cast(l_quantity*20 as int) as string)||'万' end",
    "popularity": "case when mod(l_orderkey,13)=0 then null when mod(l_orderkey,59)=0 then '0x1p3万' when mod(l_orderkey,61)=0 then '3e5' "
    "when mod(p_size,4)=0 then cast(cast(floor(l_extendedprice) as bigint) as string) "
    "when mod(p_size,4)=1 then cast(cast(floor(l_extendedprice/100) as bigint) as string)||'万' "
    "when mod(p_size,4)=2 then cast(cast(floor(l_extendedprice/50) as bigint) as string)||'万' "
    "else cast(cast(floor(l_extendedprice/50000) as bigint) as string)||'亿' end",
    "gender_type": "case when mod(l_partkey,2)=0 then 'male' else 'female' end",
    "created_at": "case when mod(l_suppkey,2)=0 then cast(l_shipdate as timestamp) "
    "else cast(o_orderdate as timestamp) - interval 30 day end",
    "updated_at": "cast(l_shipdate as timestamp)",
}
JOIN = "lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, parts: int, key: str) -> DataFrame:
    """The side of a join, dealt into more parts than the session's where the other side needs them; Spark deals that one alike."""
    return df if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(parts, key)


def rank_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    parts = parts_for(spark, lineitem.count())
    orders, part = (dealt(table(spark, sf_dir, name), parts, key) for name, key in (("orders", "o_orderkey"), ("part", "p_partkey")))
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(*(F.expr(text).alias(name) for name, text in COLUMNS.items()))


def duckdb_sql() -> str:
    """The same view for the oracle."""
    def translate(text: str) -> str:
        text = text.replace("as string", "as varchar").replace("char(10)", "chr(10)")
        return text.replace("date_format(o_orderdate,'yyyyMM')", "strftime(o_orderdate,'%Y%m')")

    columns = ", ".join(f"{translate(text)} AS {name}" for name, text in COLUMNS.items())
    return f"SELECT {columns} FROM {JOIN}"


def user_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily value per user, categorised by the user's most frequent event type."""
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("d"), "event_type", "value")
    daily = events.groupBy("user_id", "d").agg(F.sum("value").alias("metric"))
    counts = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    favourite = counts.groupBy("user_id").agg(F.min_by("event_type", F.struct(-F.col("n"), "event_type")).alias("category"))
    return daily.join(favourite, "user_id")
