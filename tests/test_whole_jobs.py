"""Jobs that once left rows out."""

from pyspark.sql import functions as F

from parityloom.functions import nested
from parityloom.plans import catalogue

SF = "/root/testdata/sf0.001"


def test_roundtrip_sees_every_row_of_every_format(spark, monkeypatch):
    read = catalogue.readers.read
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert catalogue.sink_roundtrip(spark, SF).count() == n
    for key in range(1, 5):
        # one format loses one row
        monkeypatch.setattr(catalogue.readers, "read", lambda s, p, schema, key=key: read(s, p, schema).where((F.col("c_custkey") != key) | F.lit("csv" not in p)))
        assert catalogue.sink_roundtrip(spark, SF).count() == n + 1


def test_corrected_population_grows_with_the_orders(spark):
    assert catalogue.corrected_population(spark, SF).count() == spark.read.parquet(f"{SF}/orders.parquet").count() != 2000


def test_bounds_beyond_ten_thousand(spark):
    bounds = spark.range(12_000).selectExpr("CAST(id AS STRING) AS key", "2 AS least", "3 AS most")
    rows = spark.range(1).select(F.map_from_arrays(F.transform(F.sequence(F.lit(0), F.lit(11_999)), lambda i: i.cast("string")), F.array_repeat(F.lit("x"), 12_000)).alias("m"))
    assert nested.bounded_fields(rows, "m", bounds).count() == 12_000
