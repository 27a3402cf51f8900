"""Files of about one size."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from contractspark.operators.sized import sized
from contractspark.operators.write import save
from contractspark.spec import ObjectSpec

OBJ = ObjectSpec.from_dict({"name": "t", "properties": [{"name": n, "logicalType": t, "physicalType": p} for n, t, p in (
    ("p", "string", "STRING"), ("id", "integer", "BIGINT"), ("w", "string", "STRING"))]})


def rows(spark, n=60_000):
    """A third of all rows in one value of p, some in a null one, a few in many small ones."""
    p = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("v"), (F.col("id") % 4).cast("string"))).when(F.col("id") % 100 == 2, F.lit(None)).otherwise("rest")
    return spark.range(0, n, 1, 16).select(p.alias("p"), "id", F.sha2(F.col("id").cast("string"), 256).alias("w"))


@pytest.mark.parametrize("keys", [[], ["p"]])
def test_files_have_about_the_target_size(spark, tmp_path, keys):
    df, out, target = rows(spark), str(tmp_path / "out"), 200_000
    save(df, OBJ, path=out, partition_by=keys, file_bytes=target)
    back = spark.read.parquet(out).select("p", "id", "w")
    assert back.count() == 60_000 and back.exceptAll(df).count() == 0
    by_folder = {}
    for f in glob.glob(f"{out}/**/*.parquet", recursive=True):
        by_folder.setdefault(os.path.dirname(f), []).append(os.path.getsize(f))
    assert len(by_folder) == (7 if keys else 1)
    for sizes in by_folder.values():
        if len(sizes) > 1 or not keys:
            assert target / 2 <= min(sizes) and max(sizes) <= 2 * target, sizes
        else:
            assert sizes[0] <= 2 * target
    assert sum(map(len, by_folder.values())) < 40  # 16 tasks and 7 values would make about 100
    assert sorted(os.listdir(tmp_path)) == ["out"]


def test_empty_and_hot_and_nested(spark, tmp_path):
    assert sized(rows(spark).limit(0), str(tmp_path), 1000, ["p"]).count() == 0
    odd = spark.range(100).select(F.lit(None).cast("string").alias("p"), F.create_map(F.lit("a"), "id").alias("m"))
    assert sized(odd, str(tmp_path), 100, ["p"]).count() == 100 and sized(odd, str(tmp_path), 100).count() == 100
    with pytest.raises(ValueError):
        save(rows(spark), OBJ, table="nowhere", file_bytes=100)
