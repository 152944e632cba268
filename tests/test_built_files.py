"""Files that are built of rows, whatever their keys."""

import pytest

from paperloom.plans import formats
from paperloom.sources import native


def sizes(kind, width, height, frames=1):
    rows = native.decoded("raster", "d", formats.raster(kind, width, height, frames))
    assert rows[0]["kind"] == "profile" and len(rows) == frames + 1
    return int(rows[1]["properties"]["width_px"]), int(rows[1]["properties"]["height_px"])


@pytest.mark.parametrize("kind", ["png", "gif", "bmp", "tiff"])
def test_images_of_any_width_are_built_and_stay_apart(kind):
    small, large = [2, 65534, 65535], [65536, 65537, 131070, 131071, 360_001, 20_000_000, (1 << 31) - 1, 1 << 31, 4_000_000_000]
    found = {w: sizes(kind, w, 3) for w in small + large}
    assert all(found[w] == (w, 3) for w in small) and len(set(found.values())) == len(found)
    assert all(w > 0 and h > 0 for w, h in found.values())
    assert min(sizes(kind, 1 << 40, 3)) > 0  # more than two sides of a GIF can tell apart
    if kind != "gif":
        assert found[360_001] == (360_001, 3)


def test_images_of_many_suppliers(spark, tmp_path):
    spark.range(0, 400_000, 9_999).selectExpr("id AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    rows = formats.image_files(spark, str(tmp_path)).collect()
    assert len(rows) == 41 and len({r.document_id for r in rows}) == 41
    units = native.decode(spark.createDataFrame(rows), spark.createDataFrame(rows).selectExpr("artifact_id", "'png' AS format_name", "'raster' AS family"))
    frames = units.filter("kind = 'frame'").groupBy("document_id").count().collect()
    want = {f"artifact_{i}": 1 if i % 4 in (0, 2) else i % 5 + 1 for i in range(0, 400_000, 9_999)}
    assert {r.document_id: r["count"] for r in frames} == {r.document_id: want[r.artifact_id] for r in rows}
