"""Bindings of the jobs to the scale-factor test tables.

Basket relations (basket, item):

* ``order_brand``      order  x  brand of the ordered part (25 items)
* ``order_brand_type`` order  x  brand|type of the part (150 items)
* ``customer_brand``   customer  x  brand of the parts the customer ordered (25 items, long baskets)
* ``user_k``           user   x  value of ``props.k`` of the user's events (dense)

Documents (doc_id, text) come from ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.itemsets import basket_distinct, item_dictionary
from tessera.sources.readers import read_table


def order_brand_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = li.join(part, li.l_partkey == part.p_partkey)
    return basket_distinct(joined, "l_orderkey", "p_brand")


def order_brand_type_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws("|", "p_brand", "p_type").alias("brand_type"))
    joined = li.join(part, li.l_partkey == part.p_partkey)
    return basket_distinct(joined, "l_orderkey", "brand_type")


def customer_brand_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(part, li.l_partkey == part.p_partkey).join(orders, li.l_orderkey == orders.o_orderkey)
    return basket_distinct(joined, "o_custkey", "p_brand")


def user_k_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select(
        "user_id", F.get_json_object("props", "$.k").alias("k"))
    return basket_distinct(ev, "user_id", "k")


def brand_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """brand -> smallest part name of that brand."""
    return item_dictionary(read_table(spark, sf_dir, "part"), "p_brand", "p_name")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents labelled toxic (the lookup set of ``similar_to``)."""
    return read_table(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select("doc_id")
