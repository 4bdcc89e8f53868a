"""Views over the driver's tables in the shape of the domain's tables, as SQL
that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .functions.verdict import SHIPPED_LOWER, SHIPPED_UPPER

REGISTRY = """select * from (values
  ('m1', 'patchcore', 'models', 1, 0, 0, true), ('m2', 'patchcore', 'models', 1, 9, 0, true),
  ('m3', 'patchcore', 'models', 1, 10, 0, true), ('m4', 'patchcore', 'models', 2, 0, 0, false),
  ('m5', 'patchcore', 'models', 1, 10, 3, false), ('d1', 'dinov2', 'models', 1, 0, 0, true),
  ('d2', 'dinov2', 'models', 1, 0, 2, true))
  as r(model_id, model_type, bucket, major_version, minor_version, patch_version, is_valid)"""

RESULTS = f"""select cast(event_id as varchar(20)) as event_id, concat('img-', cast(event_id as varchar(20))) as image_id,
  case event_id % 3 when 0 then 'm3' when 1 then 'm2' else 'd1' end as model_id,
  concat('img-', cast(event_id as varchar(20)), '.png') as object_key, 'images' as bucket,
  value / 6 as anomaly_score,
  case when value / 6 < {SHIPPED_LOWER} then 'normal' when value / 6 > {SHIPPED_UPPER} then 'anomaly' else 'pending' end as status,
  concat('heatmap/img-', cast(event_id as varchar(20)), '.png') as heatmap_key, ts as inferred_at from events"""

CLUSTERS = """select concat('c', cast(event_id as varchar(20))) as event_id, concat('img-', cast(event_id as varchar(20))) as image_id,
  cast(event_id % 7 as int) - 1 as cluster_id, value / 1000 as probability, ts as clustered_at from events where event_id % 3 = 0"""

MESSAGES = """select event_id as offset, case when event_id % 11 = 0 then 'notjson' when event_id % 13 = 0 then null
  when event_id % 17 = 0 then concat('{"event": "inference", "bucket": "b', cast(event_id % 5 as varchar(20)), '"}')
  else concat('{"event": "', case when event_id % 4 = 0 then 'train' else 'inference' end, '", "bucket": "images", "object_key": "', event_type, '/',
    cast(event_id as varchar(20)), '.png", "created_at": "2024-01-02T03:04:05"',
    case when event_id % 2 = 0 then concat(', "size_bytes": ', cast(event_id as varchar(20)), ', "content_type": "image/png"') else '' end, '}') end as value from events"""

DEMO = """select event_id as offset, case when event_id % 11 = 0 then 'notjson' when event_id % 13 = 0 then null
  else concat('{"event": "', event_type, '", "data": "', case when event_id % 5 = 0 then 'ALERT ' else '' end, 'value ', cast(event_id as varchar(20)), '"}') end as value from events"""

#: Vectors as patches of images, and the normal ones among them as the bank.
PATCHES = "select vec_id div 10 as image_id, cast(vec_id % 10 as int) as patch_idx, vec_id, label, embedding as vec from embeddings where not (label <= 4 and vec_id % 2 = 0)"
BANK = "select vec_id as row_id, embedding as vec from embeddings where label <= 4 and vec_id % 2 = 0"


def duck(sql: str) -> str:
    """The DuckDB form of a fixture: integer division is written otherwise."""
    return sql.replace(" div ", " // ")


def view(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    """A fixture over one table of ``sf_dir``."""
    text = sql.replace("{", "{{").replace("}", "}}").replace(f"from {table}", "from {source}")
    return spark.sql(text, source=spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))


def registry(spark: SparkSession) -> DataFrame:
    return spark.sql(REGISTRY)


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, RESULTS, "events")
