"""Pages as named objects: names, replacement, and nothing left behind by a failed write."""

import os

import pytest
from pyspark.sql import functions as F

from domus.operators import pages as pages_op
from domus.sinks.named_pages import write_named_pages
from domus.sources.pages import read_pages

DDL = "file_name string, value string"


def _page(day, n, *codes):
    elements = ", ".join(f'{{"propertyCode": "{c}"}}' for c in codes)
    return f"response2024_05_{day:02d}_p_{n}.json", f'{{\n "elementList": [{elements}],\n "actualPage": {n}, "totalPages": 9\n}}'


def _objects(path):
    return sorted(x for x in os.listdir(path) if not x.startswith("_"))


def test_landed_pages_are_read_by_name(spark, tmp):
    rows = [_page(d, n, f"{d}-{n}-a", f"{d}-{n}-b") for d in (1, 2) for n in range(1, 9)]
    write_named_pages(spark.createDataFrame(rows, DDL).repartition(5), tmp + "/land")
    assert _objects(tmp + "/land") == sorted(r[0] for r in rows)
    back = read_pages(spark, tmp + "/land", layout="named")
    got = {(r.file_name, str(r.page_date), r.page_no, r.pos, r.element) for r in pages_op.explode_pages(back).collect()}
    assert len(got) == 32
    assert ("response2024_05_02_p_8.json", "2024-05-02", 8, 1, '{"propertyCode":"2-8-b"}') in got
    assert os.listdir(tmp + "/land/_staging") == []


def test_relanding_replaces_objects_of_the_same_name(spark, tmp):
    write_named_pages(spark.createDataFrame([_page(1, 1, "a"), _page(1, 2, "b")], DDL), tmp + "/land")
    write_named_pages(spark.createDataFrame([_page(1, 2, "c"), _page(1, 3, "d")], DDL), tmp + "/land")
    rows = pages_op.explode_pages(read_pages(spark, tmp + "/land", layout="named")).collect()
    assert sorted((r.page_no, r.element) for r in rows) == [(n, f'{{"propertyCode":"{c}"}}') for n, c in ((1, "a"), (2, "c"), (3, "d"))]


@pytest.mark.parametrize("name", ["a/b", None])
def test_a_failing_task_leaves_no_object(spark, tmp, name):
    rows = [_page(1, n, "x") for n in range(1, 13)] + [(name, "{}")]
    with pytest.raises(Exception):
        write_named_pages(spark.createDataFrame(rows, DDL).repartition(4), tmp + "/land")
    assert not os.path.exists(tmp + "/land") or _objects(tmp + "/land") == []  # what a killed task staged is hidden


def test_null_texts_no_rows_and_wrong_columns(spark, tmp):
    write_named_pages(spark.createDataFrame([("response2024_05_01_p_1.json", None)], DDL), tmp + "/a")
    assert os.path.getsize(tmp + "/a/response2024_05_01_p_1.json") == 0
    write_named_pages(spark.createDataFrame([], DDL), tmp + "/b")
    assert not os.path.exists(tmp + "/b") or _objects(tmp + "/b") == []
    with pytest.raises(Exception, match="two text columns"):
        write_named_pages(spark.range(1).select(F.col("id").alias("file_name"), F.lit("x").alias("value")), tmp + "/c")
