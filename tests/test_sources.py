import json
import os

import pytest
from pyspark.sql import functions as F

from lodgecurve import schemas
from lodgecurve.operators import ordering
from lodgecurve.plans.ingest import ingest
from lodgecurve.sources import readers, writers

CSV = """Listing ID,Listing Price,Room-Type,Host Is Superhost,multi,biz,weekend,city
1,99.5,Private room,True,1,0,false,rome
2,,Entire home,no,0,yes,1,oslo
"""


def lines(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            out += open(os.path.join(path, name)).read().splitlines()
    return out


def test_ingest(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    out = ingest(spark, str(tmp_path / "in.csv"), str(tmp_path / "main"), str(tmp_path / "copy"))
    a, b = out.orderBy("listing_id").collect()
    assert (a["listing_price"], a["room_type"], a["host_is_superhost"], a["multi"], a["weekend"]) == (99.5, "Private room", 1, 1, 0)
    assert (b["listing_price"], b["host_is_superhost"], b["biz"], b["weekend"]) == (None, 0, 1, 1)
    assert readers.read_table(spark, str(tmp_path / "copy")).count() == 2
    ingest(spark, str(tmp_path / "in.csv"), str(tmp_path / "main"))
    assert readers.read_table(spark, str(tmp_path / "main")).count() == 2


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_listings_csv(spark, str(tmp_path / "none.csv"))


def test_csv_with_schema(spark, tmp_path):
    (tmp_path / "in.csv").write_text("listing_id,listing_price\n1,2.5\n")
    schema = "listing_id long, listing_price double"
    df = readers.read_listings_csv(spark, str(tmp_path / "in.csv"), schema)
    assert df.schema.simpleString() == "struct<listing_id:bigint,listing_price:double>" and df.count() == 1


def test_elasticity_files(spark, tmp_path):
    rows = [("a", "high", 1, "low", -0.1, 5.0), ("a", "high", 1, "high", -0.8, 5.0), ("b", "low", 0, "all", -0.3, None)]
    df = spark.createDataFrame(rows, schemas.ELASTICITY_SCHEMA)
    writers.write_json_lines(df, str(tmp_path / "rows"))
    assert any('"breakpoint_log_price":null' in line for line in lines(tmp_path / "rows"))
    assert sorted(map(tuple, readers.read_elasticity_rows(spark, str(tmp_path / "rows")).collect())) == sorted(rows)
    writers.write_elasticity(df, str(tmp_path / "docs"))
    assert sorted(map(tuple, readers.read_elasticity_documents(spark, str(tmp_path / "docs")).collect())) == sorted(rows)
    whole = {}
    for line in lines(tmp_path / "docs"):
        whole |= json.loads(line)
    (tmp_path / "whole.json").write_text(json.dumps(whole, indent=2))
    back = readers.read_elasticity_documents(spark, str(tmp_path / "whole.json"), whole_files=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_csv_preview_and_documents(spark, tmp_path):
    df = spark.range(10).select("id", F.struct((F.col("id") * 2).alias("x")).alias("s"))
    writers.write_csv(df.select("id"), str(tmp_path / "csv"))
    assert len([v for v in lines(tmp_path / "csv") if v != "id"]) == 10
    writers.write_preview(df.select("id"), str(tmp_path / "preview"), rows=3)
    assert len(lines(tmp_path / "preview")) == 4
    writers.write_rows_as_documents(df, str(tmp_path / "json"))
    assert {json.loads(v)["s"]["x"] for v in lines(tmp_path / "json")} == set(range(0, 20, 2))


def test_generated_rows_and_order(spark):
    assert readers.literal_row(spark, a=1, b="x", c=F.lit(2.5)).first().asDict() == {"a": 1, "b": "x", "c": 2.5}
    frame = readers.segment_frame(spark.createDataFrame([("rome",), ("oslo",)], "city string"))
    assert frame.count() == 12
    ordered = ordering.by_season(frame.orderBy("segment_name"), "city").collect()
    assert [r["segment_name"] for r in ordered[:3]] == ["high_season_weekday", "high_season_weekend", "shoulder_season_weekday"]
