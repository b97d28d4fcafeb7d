"""Cleaning is row-wise, so it runs unchanged on a streaming DataFrame."""

import os

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from pitlane.operators.clean import clean


def test_clean_on_a_file_stream(spark, workdir):
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "TelemetryData_1.csv"), "w") as f:
        f.write("pilot_index,frameIdentifier,pitStatus,tyresWear\n0,1,pitting,1/2/3/4\n0,2,,5/6\n")
    schema = StructType(
        [
            StructField("pilot_index", IntegerType()),
            StructField("frameIdentifier", LongType()),
            StructField("pitStatus", StringType()),
            StructField("tyresWear", StringType()),
        ]
    )
    stream = spark.readStream.schema(schema).option("header", True).csv(src)
    q = (
        clean(stream)
        .writeStream.format("memory")
        .queryName("cleaned_stream")
        .option("checkpointLocation", os.path.join(workdir, "ckpt"))
        .start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = sorted(spark.sql("SELECT frameIdentifier, pitting, inPitArea, RR_tyresWear FROM cleaned_stream").collect())
    assert [tuple(r) for r in rows] == [(1, True, True, 4.0), (2, False, False, None)]
