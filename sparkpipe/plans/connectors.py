"""Source connectors exercised end to end on data derived from the test tables
(S03-S06, S08-S12, P02, P03, P08, U03, A14).

Each query first writes the table in the source's format under the shared checkpoint
folder, then reads it back with the library reader, exactly as a job would read files
landing from elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import round_half_up
from ..session import scratch_path
from ..sources.files import load_many, read_csv, read_json_documents, read_table
from . import bindings as B
from ..operators.quality import file_stats
from ..operators.ticks import clean_ticks
from ..operators.union import concat_frames
from ..sinks.writers import JSON_TS_NTZ_FORMAT, load_batches, write_json_lake, write_parquet

ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
PRODUCTS_PER_DOCUMENT = 100   # at most 100 products per document, whatever the key distribution
ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("amount", T.DoubleType()), T.StructField("order_ts", T.TimestampNTZType()),
    T.StructField("service_type", T.StringType()),
])


def zones_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone seed as CSV with a header and a surplus column, read with a declared schema
    (S03 S06 S08 S09): surplus tokens are dropped, the declared types apply."""
    z = B.zones(spark, sf_dir)
    path = scratch_path(spark, "zones_csv")
    (z.select(F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"),
              F.col("zone").alias("Zone"), "service_zone", F.lit("x").alias("extra"))
      .write.option("header", True).csv(path))
    return read_csv(spark, path, ZONE_SCHEMA, header=True)


def products_brand_avg_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product documents (``{"products": [{brand, price, ...}]}``) exploded with ``inline``,
    missing fields defaulted, then the average price per brand (S10 P08 A14)."""
    p = read_table(spark, sf_dir, "part")
    # Row position within the input partition (partition id in the high bits): a document
    # is 100 neighbouring rows of one partition, so no group can grow with a hot key.
    position = F.monotonically_increasing_id()
    doc = (p.groupBy(F.floor(position / PRODUCTS_PER_DOCUMENT).alias("doc_id"))
             .agg(F.collect_list(F.struct(F.col("p_brand").alias("brand"),
                                          F.col("p_retailprice").alias("price"),
                                          F.col("p_name").alias("name"))).alias("products")))
    path = scratch_path(spark, "products_json")
    doc.write.json(path)
    schema = "doc_id long, products array<struct<brand:string,price:double,name:string>>"
    items = read_json_documents(spark, path, "products", schema=schema, multi_line=False)
    items = items.select(F.coalesce("brand", F.lit("N/A")).alias("brand"), "price")
    return (items.groupBy("brand").agg(round_half_up(F.avg("price"), 2).alias("avg_price"))
                 .orderBy(F.desc("avg_price"), "brand"))


def orders_multi_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-service files loaded, renamed, tagged and concatenated; a missing file is
    skipped and reported (S11 S12 S19 P02 P03 U03)."""
    o = read_table(spark, sf_dir, "orders")
    root = scratch_path(spark, "orders_by_status")
    file = F.when(F.col("o_orderstatus").isin("F", "O"), F.col("o_orderstatus")).otherwise("P")  # every row has one
    o.withColumn("file", file).write.partitionBy("file").parquet(root)
    rename = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "amount",
              "o_orderdate": "order_ts"}
    frames = []
    for status, service in (("F", "Yellow"), ("O", "Green"), ("P", "FHV"), ("X", "Missing")):
        df, _ = load_many(spark, [f"{root}/file={status}"], list(rename.values()),
                               rename=rename, constants={"service_type": service}, schema=ORDER_SCHEMA)
        frames.append(df)                    # an absent file gives an empty frame of the schema
    return concat_frames(frames, [f.name for f in ORDER_SCHEMA.fields])


def repartition_copy_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repartition to a fixed file count and overwrite (K01), then count the files and rows
    of the copy from file metadata (Q09)."""
    path = scratch_path(spark, "lineitem_4")
    write_parquet(read_table(spark, sf_dir, "lineitem"), path, mode="overwrite", num_files=4)
    files = file_stats(spark, path).select("num_files")
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
    return _stats_pair(files, rows)


def _stats_pair(files: DataFrame, rows: DataFrame) -> DataFrame:
    a = files.select(F.lit("num_files").alias("stat"), F.col("num_files").alias("value"))
    b = rows.select(F.lit("row_count").alias("stat"), F.col("row_count").alias("value"))
    return a.unionByName(b)


def chunked_load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunked load (K07, K10, K12): the first chunk replaces the target, later chunks append.
    Chunks are the remainders of the order key, which every row has (null counts as 0);
    each is one distributed write."""
    o = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders_chunks")
    o.limit(1).write.parquet(path)          # an old target the first chunk must replace
    chunk = F.coalesce(F.pmod("o_orderkey", F.lit(3)), F.lit(0))
    batches = (o.filter(chunk == n) for n in range(3))
    load_batches(batches, path)
    return spark.read.parquet(path)


def load_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load disposition (K10): a target with rows is left alone, an empty one is made anew."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    filled, empty = scratch_path(spark, "filled"), scratch_path(spark, "empty")
    c.filter(F.col("c_custkey") % 2 == 0).write.parquet(filled)
    c.filter("false").write.parquet(empty)
    sizes = [load_batches([c], path, skip_if_rows=spark) for path in (filled, empty)]
    out = [spark.read.parquet(path).select("c_custkey", "c_mktsegment", F.lit(n).alias("batches"))
           for path, n in zip((filled, empty), sizes, strict=True)]
    return out[0].unionByName(out[1])


def tick_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean ticks exported as JSON under kind/yyyy/MM/dd (K15, F18), read back."""
    kept, _, _ = clean_ticks(B.tick_messages(spark, sf_dir))
    cols = ["event_id", "symbol", "ts", "price", "volume", "exchange", "bid", "ask"]
    root = scratch_path(spark, "lake")
    write_json_lake(kept.select(*cols), root, "ts", "ticks")
    schema = ("event_id long, symbol string, ts timestamp_ntz, price double, volume double, "
              "exchange string, bid double, ask double")
    return (spark.read.schema(schema).option("timestampNTZFormat", JSON_TS_NTZ_FORMAT)
                 .json(f"{root}/ticks").select(*cols))


QUERIES = {
    "zones_from_csv": zones_from_csv,
    "products_brand_avg_json": products_brand_avg_json,
    "orders_multi_file_load": orders_multi_file_load,
    "repartition_copy_stats": repartition_copy_stats,
    "chunked_load_orders": chunked_load_orders,
    "tick_lake": tick_lake,
    "load_if_empty": load_if_empty,
}
