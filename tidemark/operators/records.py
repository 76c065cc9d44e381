"""Feature records: aggregates as keyed structs, ready for a key-value table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import feature_key

#: Key prefixes, suffixes and seconds to live by product (fixed values of the key-value layout).
PRODUCTS = {
    "user_1h": ("rec:user_feature:{", "uid", "}:post1h", 600), "user_24h": ("rec:user_feature:{", "uid", "}:post24h", 7200), "item_1h": ("rec:item_feature:{", "post_id", "}:post1h", 600), "item_24h": ("rec:item_feature:{", "post_id", "}:post24h", 7200), "item_48h": ("rec:item_feature:{", "post_id", "}:post48h", 7200),
    "user_author_24h": ("rec:user_author_feature:{", "uid", "}:post24h", 7200), "anchor_5min": ("rec:anchor_feature:{", "anchor_id", "}:live5min", 120), "live_5min": ("rec:live_id_feature:{", "live_id", "}:live5min", 600), "user_anchor_15min": ("rec:user_anchor_feature:{", "uid", "}:live15min", 600),
}


def records(df: DataFrame, product: str, fields: list[str]) -> DataFrame:
    """key, record (struct), ttl_s. A record's type is the struct's; ``to_protobuf`` takes it where Spark's package is there."""
    prefix, ident, suffix, ttl = PRODUCTS[product]
    return df.select(feature_key(prefix, ident, suffix).alias("key"), F.struct(*fields).alias("record"), F.lit(ttl).alias("ttl_s"))


def hash_records(df: DataFrame, product: str, field: str, fields: list[str]) -> DataFrame:
    """key, field, record, ttl_s: an entry of a hash for each author or anchor."""
    prefix, ident, suffix, ttl = PRODUCTS[product]
    return df.select(feature_key(prefix, ident, suffix).alias("key"), F.col(field).cast("string").alias("field"), F.struct(*fields).alias("record"), F.lit(ttl).alias("ttl_s"))


def as_text(rows: DataFrame) -> DataFrame:
    """The record as JSON in ``value``, what a table of texts stores."""
    return rows.withColumn("value", F.to_json("record")).drop("record")
