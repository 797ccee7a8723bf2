"""Registry, lookups and the shared folder."""

import pytest

from millrace.sources.session import cut_lineage, shared_folder
from millrace.sources.tables import SOURCES, Tables, catalog_tables, read_seed_csv, read_source, read_tables_by_pattern
from tests.helpers import rows

SF = "/root/testdata/sf0.001"


def test_registered_tables_only(spark):
    assert read_source(spark, SF, "region").count() == 5
    with pytest.raises(KeyError):
        read_source(spark, SF, "unknown")
    tables = Tables(spark, SF)
    assert set(tables) == set(SOURCES) and len(tables) == 14


def test_pattern_union_with_lineage(spark):
    one, two = spark.range(2).toDF("id"), spark.range(1).selectExpr("id", "'x' as extra")
    got = read_tables_by_pattern({"events_1": one, "events_2": two, "other": one}, "^events_")
    assert rows(got, "_source", "id", "extra") == [("events_1", 0, None), ("events_1", 1, None), ("events_2", 0, "x")]
    assert read_tables_by_pattern({"events_1": one, "events_2": two}, "^events_", "2$").count() == 2
    with pytest.raises(ValueError):
        read_tables_by_pattern({"a": one}, "^b")


def test_catalog_tables(spark):
    spark.range(1).createOrReplaceTempView("millrace_probe_a")
    assert list(catalog_tables(spark, "millrace_probe_*")) == ["millrace_probe_a"]


def test_seed_csv_is_typed(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("status,rank\nF,1\nO,\n")
    assert rows(read_seed_csv(spark, str(path), "status string, rank int")) == [("F", 1), ("O", None)]


def test_cut_lineage_writes_to_the_named_folder(spark):
    df = cut_lineage(spark.range(3).toDF("id"), "probe")
    assert df.count() == 3 and all(shared_folder(spark) in f for f in df.inputFiles())
