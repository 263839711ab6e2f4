"""Record payloads parsed by a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_payload(
    records: DataFrame, schema: str, encoding: str = "avro", value: str = "value"
) -> DataFrame:
    """The payload's fields in place of its bytes; bytes that do not parse are an error.

    ``avro`` takes an Avro schema in JSON and needs Spark's ``spark-avro`` module;
    ``json`` takes a Spark schema.
    """
    if encoding == "avro":
        from pyspark.sql.avro.functions import from_avro

        parsed = from_avro(F.col(value), schema)
    elif encoding == "json":
        parsed = F.from_json(F.col(value).cast("string"), schema, {"mode": "FAILFAST"})
    else:
        raise ValueError(f"unknown payload encoding {encoding!r}")
    others = [c for c in records.columns if c != value]
    return records.select(*others, parsed.alias("_payload")).select(*others, "_payload.*")
