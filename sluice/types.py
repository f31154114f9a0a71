"""Schemas of the tables that operators read and keep."""

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType


def _schema(**columns) -> StructType:
    kinds = {"long": LongType(), "int": IntegerType(), "string": StringType(), "double": DoubleType(), "timestamp": TimestampType(), "boolean": BooleanType()}
    return StructType([StructField(name, kinds[kind]) for name, kind in columns.items()])


QUEUE = _schema(id="long", target_db="string", target_table="string", schema_version="int", payload_json="string", queued_at="string")
OUTCOME = _schema(deliverable_id="long", pipeline="string", kind="string", reason="string", accepted_cursor="long", records="long", n_bytes="long", cursor_after="long", ts="timestamp")
CURSOR = _schema(source_id="string", dest_id="string", table_name="string", cursor="long", last_ack="timestamp")
DELIVERABLE = _schema(id="long", pipeline="string", enqueued_at="timestamp", attempts="int", next_attempt_at="timestamp", cursor_after="long")
ATTEMPT = _schema(seq="long", ts="timestamp", pipeline="string", outcome="string", records="long", n_bytes="long", error="string")
DEAD_LETTER = _schema(ts="timestamp", pipeline="string", deliverable_id="long", final_error="string")
