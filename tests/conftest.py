from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("keygroup-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "4000")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Piers by coast and bay, with their berths and the boats that sail from them. One pier
# has no boats; one coast is known from its boats only.
HARBOURS = [
    ("north", "Alder Bay", "Old Pier", 4),
    ("north", "Alder Bay", "New Pier", 6),
    ("north", "Heron Sound", "Mill Pier", 2),
    ("east", "Sand Bay", "Long Pier", 9),
    ("east", "Salt Creek", "Ropewalk", 1),
    ("south", "Pine Cove", "Stone Pier", 3),
    ("west", "Gull Bay", "Ferry Steps", 5),
]
SAILINGS = [
    ("north", "Alder Bay", "Old Pier", "Tern"),
    ("north", "Alder Bay", "Old Pier", "Curlew"),
    ("north", "Alder Bay", "New Pier", "Plover"),
    ("north", "Heron Sound", "Mill Pier", "Knot"),
    ("north", "Heron Sound", "Mill Pier", "Dunlin"),
    ("north", "Heron Sound", "Mill Pier", "Avocet"),
    ("east", "Sand Bay", "Long Pier", "Petrel"),
    ("east", "Sand Bay", "Long Pier", "Fulmar"),
    ("south", "Pine Cove", "Stone Pier", "Shag"),
    ("west", "Gull Bay", "Ferry Steps", "Skua"),
    ("west", "Gull Bay", "Ferry Steps", "Gannet"),
    ("isles", "Out Skerry", "Slipway", "Puffin"),
    ("isles", "Out Skerry", "Slipway", "Auk"),
]


@pytest.fixture(scope="session")
def coasts(spark):
    """Two tables that share the key ``coast``: harbours and sailings."""
    from keygroup import Catalog, KeyedTable

    harbours = spark.createDataFrame(HARBOURS, "coast string, bay string, pier string, berths int")
    sailings = spark.createDataFrame(SAILINGS, "coast string, bay string, pier string, boat string")
    return (
        Catalog(spark)
        .add("sea", "harbours", KeyedTable.of(harbours, "coast", ["bay", "pier"], unique=True))
        .add("sea", "sailings", KeyedTable.of(sailings, "coast", ["bay", "pier", "boat"]))
    )
