"""attrlake: a Spark-native bronze/silver/gold pipeline for mobile-attribution events.

Entry points::

    from attrlake import create_session, Lake, run_jobs, register_views
    spark = create_session("jobs")
    lake = Lake(spark, "s3a://<bucket>/lake")       # or Lake(spark, "catalog", "iceberg")
    run_jobs(spark, lake, "s3a://<bucket>/checkpoints", topic=kafka_topic(spark, servers, topic))
    register_views(spark, lake)                     # bronze/silver/gold + reporting views for SQL
"""

from attrlake.plans.catalog import register_views
from attrlake.session import create_session
from attrlake.store import LakeTable
from attrlake.streaming.pipeline import file_topic, kafka_topic
from attrlake.streaming.runner import JOBS, Lake, run_jobs

__all__ = ["JOBS", "Lake", "LakeTable", "create_session", "file_topic", "kafka_topic", "register_views", "run_jobs"]
