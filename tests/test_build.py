import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowcube.operators import olap
from flowcube.plans import build
from flowcube.plans import olap as olap_plan
from flowcube.sources import published
from flowcube.sources.tables import Tables
from tests.conftest import SF_SMALL


@pytest.fixture
def data(tmp_path):
    """A copy of the star layer's inputs that a test may change."""
    for name in build.INPUTS:
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    return str(tmp_path)


def folders(spark, data):
    return [v.folder for v in published.versions(spark, published.root_of(spark, "star", data))]


def test_star_layer_is_written_audited_and_published_once(spark, data):
    fact, mart = build.star_layer(spark, data)
    fresh = olap.monthly_mart(olap_plan.fact(Tables(spark, data)))
    assert mart.exceptAll(fresh).count() == 0 and fresh.exceptAll(mart).count() == 0
    [folder] = folders(spark, data)
    gates = [json.loads(line) for f in Path(f"{folder}/gates").glob("part-*.json") for line in f.open()]
    assert len(gates) == 4 and all(g["ok"] for g in gates)
    build._READ.clear()  # as another application would
    build.star_layer(spark, data)
    assert folders(spark, data) == [folder]


def test_months_are_few_files(spark, data):
    build.star_layer(spark, data)
    [folder] = folders(spark, data)
    for name in ("fact_item", "mart_monthly"):
        months = list(Path(f"{folder}/{name}").glob("month=*"))
        assert len(months) > 50 and all(len(list(m.glob("*.parquet"))) == 1 for m in months)


def test_changed_input_is_built_again_and_a_false_gate_publishes_nothing(spark, data, monkeypatch):
    fact, _ = build.star_layer(spark, data)
    rows = fact.count()
    [first] = folders(spark, data)
    items = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    items.filter("l_orderkey % 2 = 0").toPandas().to_parquet(f"{data}/lineitem.parquet", coerce_timestamps="us")
    mart = olap.monthly_mart
    with monkeypatch.context() as m:
        m.setattr(build.olap, "monthly_mart", lambda f: mart(f).filter(F.col("items") > 1))
        with pytest.raises(published.GateError, match="mart_items_eq_fact"):
            build.star_layer(spark, data)
        assert folders(spark, data) == [first] and spark.read.parquet(f"{first}/fact_item").count() == rows
    fact, _ = build.star_layer(spark, data)
    assert fact.count() == items.filter("l_orderkey % 2 = 0").count() < rows
    assert len(folders(spark, data)) == 2 and folders(spark, data)[0] == first
