"""Every query with a SQL twin gives the twin's rows; every query runs."""

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = __import__("regionloom.plans.registry", fromlist=["x"])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _sorted(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(r[k] for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(OWN.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(entry.oracle_sql()[name])
    want = _sorted([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want
    assert got[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_quirks(spark):
    """Sides: touching boxes have no overlap; suppression at .3 drops, exactly at the strict bound keeps."""
    from regionloom.operators import folds

    rows = spark.createDataFrame([(1, 1, 0, 0, 10, 10, 900), (1, 2, 10, 0, 10, 10, 800), (1, 3, 0, 0, 10, 5, 700)], "page_id long, pos long, x long, y long, w long, h long, conf_milli long")
    assert [r.pos for r in folds.suppress(rows, ["page_id"]).collect()] == [1, 2]
    assert [r.pos for r in folds.suppress(rows, ["page_id"], 5, strict=True).collect()] == [1, 2, 3]


def test_merged_intervals(spark):
    """Open ends come last, as in the SQL; equal intervals stay in one span however the rows come."""
    from regionloom.operators import selection

    schema = "page long, s long, e long"
    open_ended = spark.createDataFrame([(1, 5, 100), (1, 5, None), (1, 200, 210)], schema)
    assert sorted(map(tuple, selection.merged_intervals(open_ended, ["page"], "s", "e", 10).collect()), key=repr) == [(1, 200, 210, 1), (1, 5, 100, 2)]
    equal = spark.createDataFrame([(p, s, s + 5) for p in range(50) for s in range(0, 900, 30) for _ in range(3)], schema)
    got = selection.merged_intervals(equal, ["page"], "s", "e", 10)
    assert got._jdf.queryExecution().sparkPlan().toString().count("Window [") == 2 and got._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    assert sorted(map(tuple, got.collect())) == [(p, s, s + 5, 3) for p in range(50) for s in range(0, 900, 30)]


def test_overlaps_resolved(spark):
    """The less confident of a pair goes and stops comparing; ties keep the earlier; exempt boxes stand aside."""
    from pyspark.sql import functions as F
    from regionloom.operators import selection

    schema = "page_id long, pos long, x long, y long, w long, h long, conf_milli long, category string"
    rows = [(1, 1, 0, 0, 10, 10, 500, "A"), (1, 2, 0, 0, 10, 9, 900, "A"), (1, 3, 0, 0, 10, 8, 900, "A"), (1, 4, 0, 0, 10, 10, 100, "N"), (2, 1, 0, 0, 10, 10, 1, "A"), (2, 2, 50, 0, 10, 10, 1, "A")]
    kept = selection.resolve_overlaps(spark.createDataFrame(rows, schema), ["page_id"], F.col("category") == "N")
    assert sorted(map(tuple, kept.collect())) == [(1, 2), (1, 4), (2, 1), (2, 2)]


def test_coco_and_flattening(spark, tmp_path):
    """Annotations of unknown categories and with malformed boxes are dropped; nested columns get joined names."""
    import json

    from regionloom.sources import formats

    (tmp_path / "a.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "p.png"}], "categories": [{"id": 1, "name": "dr"}, {"id": 2, "name": "x"}], "annotations": [{"id": 1, "image_id": 1, "category_id": 1, "bbox": [1, 2, 3, 4]}, {"id": 2, "image_id": 1, "category_id": 2, "bbox": [1, 2, 3, 4]}, {"id": 3, "image_id": 1, "category_id": 1, "bbox": [1]}]}))
    got = formats.read_coco(spark, str(tmp_path / "a.json"), spark.createDataFrame([("dr", "door")], "name string, category string"))
    assert [tuple(r) for r in got.collect()] == [("p.png", "door", 1.0, 2.0, 3.0, 4.0)]
    assert formats.flattened(spark.sql("SELECT struct(1 AS a, struct(2 AS c) AS b) AS s, 3 AS t")).columns == ["s.a", "s.b.c", "t"]


def test_metrics_stream(spark, tmp_path):
    """The stream of run metrics ends at the batch's rows."""
    import shutil

    from regionloom.streaming import metrics

    (tmp_path / "in").mkdir()
    shutil.copy(f"{DATA}/events.parquet", tmp_path / "in" / "events.parquet")
    batch = spark.read.parquet(f"{DATA}/events.parquet")
    stream = metrics.hourly(metrics.read_stream(spark, str(tmp_path / "in"), batch.schema))
    running = stream.writeStream.outputMode("complete").format("memory").queryName("hourly").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    running.awaitTermination(60)
    assert sorted(map(tuple, spark.table("hourly").collect())) == sorted(map(tuple, metrics.hourly(batch).collect()))


def test_writers(spark, tmp_path):
    """Label lines come back as the boxes; categories are ranked; splits get a folder each."""
    from regionloom.sources import exports, formats

    boxes = spark.createDataFrame([(1, 1, 10, 20, 30, 40, "b"), (1, 2, 0, 0, 100, 80, "a"), (2, 1, 5, 5, 10, 10, "b")], "page_id long, pos long, x long, y long, w long, h long, category string")
    exports.write_label_files(boxes, str(tmp_path / "labels"), "page_id", "3", 1000, 800)
    read = formats.parse_label_lines(spark.read.text(str(tmp_path / "labels")), "value", 1000, 800)
    assert sorted((r.page_id, round(r.x1), round(r.y1), round(r.x2), round(r.y2)) for r in read.collect()) == [(1, 0, 0, 100, 80), (1, 10, 20, 40, 60), (2, 5, 5, 15, 15)]
    exports.write_coco(boxes.selectExpr("page_id AS id").distinct(), boxes.selectExpr("page_id * 10 + pos AS id", "page_id AS image_id", "category", "array(x, y, w, h) AS bbox").withColumnRenamed("id", "annotation_id"), str(tmp_path / "coco"))
    assert sorted((r.id, r.name) for r in spark.read.json(str(tmp_path / "coco" / "categories")).collect()) == [(1, "a"), (2, "b")]
    assert spark.read.json(str(tmp_path / "coco" / "annotations")).count() == 3
    exports.write_by_split(boxes.selectExpr("page_id", "IF(page_id = 1, 'train', 'test') AS split"), str(tmp_path / "splits"))
    assert {r.split: r["count"] for r in spark.read.json(str(tmp_path / "splits")).groupBy("split").count().collect()} == {"train": 2, "test": 1}
