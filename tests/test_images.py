from __future__ import annotations

import colorsys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayer.operators import colour, images, metrics
from assayer.operators.images import (
    as_rgb,
    band_ratios,
    image_features,
    pixel_rows,
    resize,
    resize_images,
)
from assayer.operators.vectors import assemble, fit_scaler, pixel_vectors, scale, with_class_codes, with_label_codes
from assayer.plans import standins
from assayer.plans.image_files import png
from assayer.sources import images as scans
from assayer.sources.images import readable, scan_images, unreadable


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(3)
    for name, count in (("Potato___healthy", 3), ("Potato___Early_blight", 4)):
        (tmp_path / name).mkdir()
        for i in range(count):
            pixels = rng.integers(0, 256, (6 + i, 9, 3), dtype=np.uint8)
            (tmp_path / name / f"{i}.{'JPG' if i % 2 else 'jpg'}").write_bytes(png(pixels))
    (tmp_path / "Potato___healthy" / "broken.jpg").write_bytes(b"no image")
    (tmp_path / "Potato___healthy" / "list.txt").write_text("x")
    return str(tmp_path)


def test_scan_keeps_readable_and_names_broken_files(spark, folder):
    images = scan_images(spark, folder)
    counts = {r["class"]: r["count"] for r in readable(images).groupBy("class").count().collect()}
    assert counts == {"Potato___healthy": 3, "Potato___Early_blight": 4}
    assert [r["path"].split("/")[-1] for r in unreadable(images).collect()] == ["broken.jpg"]


def test_channel_order(spark, tmp_path):
    (tmp_path / "c").mkdir()
    red = np.zeros((2, 2, 3), dtype=np.uint8)
    red[:, :, 0] = 200
    (tmp_path / "c" / "a.jpg").write_bytes(png(red))
    rows = pixel_rows(resize_images(scan_images(spark, str(tmp_path)), ["class"], 2), ["class"], 2).collect()
    assert {(r["r"], r["g"], r["b"]) for r in rows} == {(200, 0, 0)} and len(rows) == 4
    assert as_rgb(bytes([7, 9]), 1, 2, 1).tolist() == [[[7, 7, 7], [9, 9, 9]]]


def test_resize_known_cases():
    flat = np.full((5, 7, 3), 93, dtype=np.uint8)
    assert (resize(flat, 64) == 93).all()
    two = np.array([[[0], [100]], [[100], [200]]], dtype=np.uint8).repeat(3, axis=2)
    assert resize(two, 4)[:, :, 0].tolist() == [
        [0, 25, 75, 100], [25, 50, 100, 125], [75, 100, 150, 175], [100, 125, 175, 200]]
    assert (resize(two, 2) == two).all()


def test_hsv_near_the_standard_conversion(spark):
    rng = np.random.default_rng(5)
    rows = [tuple(int(v) for v in rng.integers(0, 256, 3)) for _ in range(300)] + [(0, 0, 0), (9, 9, 9)]
    df = colour.with_hsv(spark.createDataFrame(rows, "r int, g int, b int"))
    for row in df.collect():
        h, s, v = colorsys.rgb_to_hsv(row["r"] / 255, row["g"] / 255, row["b"] / 255)
        gap = abs(row["h"] - h * 180) % 180
        assert min(gap, 180 - gap) <= 0.5 + 1e-9 and abs(row["s"] - s * 255) <= 0.5 + 1e-9
        assert row["v"] == round(v * 255)


def test_both_ratio_forms_agree(spark, folder):
    resized = resize_images(readable(scan_images(spark, folder)), ["path"], 8)
    rows = colour.colour_ratios(pixel_rows(resized, ["path"], 8), ["path"])
    names = [f"{n}_ratio" for n in ("brown", "green", "dark")]
    slow = {r["path"]: [r[n] for n in names] for r in rows.collect()}
    fast = {r["path"]: [r[n] for n in names] for r in image_features(resized, ["path"], 8).collect()}
    assert fast == {p: pytest.approx(v) for p, v in slow.items()}
    assert band_ratios(np.zeros((2, 2, 3), dtype=np.uint8)) == [0.0, 0.0, 1.0]


def test_vectors_have_fixed_length_and_range(spark, folder):
    row = image_features(resize_images(readable(scan_images(spark, folder)), ["path"]), ["path"]).first()
    assert len(row["features"]) == 64 * 64 * 3
    assert 0 <= min(row["features"]) and max(row["features"]) <= 1


def test_colour_rule_order(spark):
    df = spark.createDataFrame([(0.5, 0.5), (0.5, 0.0), (0.0, 0.0)], "brown_ratio double, dark_ratio double")
    assert [r["prediction"] for r in colour.with_colour_rule(df, 0.5, 0.5).collect()] == [1, 0, 2]


def test_colour_sweep_equals_scoring_each_point(spark):
    df = spark.range(300).select(
        F.rand(1).alias("brown_ratio"), (F.rand(2) * 0.5).alias("dark_ratio"), (F.col("id") % 3).cast("int").alias("label")
    ).cache()
    grid = [0.1, 0.3, 0.35000000000000003]
    point = ["grid_pos", "min_brown", "min_dark"]
    swept = metrics.macro_scores(colour.sweep_colours(df, "label", grid, grid), by=point).collect()
    assert len(swept) == 9
    for row in swept:
        ruled = colour.with_colour_rule(df, row["min_brown"], row["min_dark"])
        one = metrics.macro_scores(metrics.confusion(ruled, "label", "prediction")).first()
        assert row["f1"] == pytest.approx(one["f1"])


def test_label_codes_follow_code_points(spark):
    names = ["Potato___healthy", "Potato___Late_blight", "Potato___Early_blight"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: r["label_code"] for r in with_label_codes(df, "name").collect()}
    assert got == {"Potato___Early_blight": 0, "Potato___Late_blight": 1, "Potato___healthy": 2}


def test_class_codes_by_name(spark):
    names = ["Potato___Early_blight", "Potato___Late_blight", "Potato___healthy"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name string")
    got = {r["name"]: r["label"] for r in with_class_codes(df, "name", names).collect()}
    assert got == {n: i for i, n in enumerate(names)}
    with pytest.raises(ValueError, match="absent classes .'Potato___Late_blight'"):
        with_class_codes(df.where("name <> 'Potato___Late_blight'"), "name", names)
    with pytest.raises(ValueError, match="unknown classes .'None', 'other'"):
        with_class_codes(df.unionByName(spark.createDataFrame([("other",), (None,)], "name string")), "name", names)


def test_output_is_cut_by_bytes(spark, folder, monkeypatch):
    rows = readable(scan_images(spark, folder))
    whole = sorted(map(str, image_features(resize_images(rows, ["path"], 8), ["path"], 8).collect()))
    monkeypatch.setattr(images, "OUTPUT_BYTES", 300)
    batches = [pd.DataFrame({"n": range(7)}), pd.DataFrame({"n": range(2)})]
    assert [len(part) for part in images.slices(iter(batches), 100)] == [3, 3, 1, 2]
    assert [len(part) for part in images.slices(iter(batches), 1000)] == [1] * 9
    assert sorted(map(str, image_features(resize_images(rows, ["path"], 8), ["path"], 8).collect())) == whole


def test_small_files_share_a_task(spark, tmp_path, monkeypatch):
    (tmp_path / "c").mkdir()
    for i in range(300):
        (tmp_path / "c" / f"{i}.jpg").write_bytes(b"no image")
    monkeypatch.setattr(scans, "LEAST_DEALT", 0)
    found = scan_images(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 1 and unreadable(found).count() == 300


def test_images_are_written_from_one_row_each(spark):
    embeddings = "/root/testdata/sf0.001"
    rows = standins.pixel_arrays(spark, embeddings)
    assert "Generate" not in rows._jdf.queryExecution().toString()
    flat = pixel_vectors(standins.pixels(spark, embeddings), ["image_id"]).collect()
    want = {r["image_id"]: [round(v * 255) for v in r["features"]] for r in flat}
    assert {r["image_id"]: r["cells"] for r in rows.collect()} == want


def test_pixel_rows_are_cut_from_arrow_batches(spark, monkeypatch):
    cells = [(1, bytes(range(12))), (None, bytes(12)), (3, None)]
    df = spark.createDataFrame(cells, "image_id bigint, rgb binary")
    monkeypatch.setattr(images, "OUTPUT_BYTES", 1)
    rows = pixel_rows(df, ["image_id"], 2)
    assert "regexp" not in rows._jdf.queryExecution().toString()
    assert [tuple(r) for r in rows.collect()] == [
        (1, 0, 0, 0, 1, 2), (1, 1, 0, 3, 4, 5), (1, 0, 1, 6, 7, 8), (1, 1, 1, 9, 10, 11),
        (None, 0, 0, 0, 0, 0), (None, 1, 0, 0, 0, 0), (None, 0, 1, 0, 0, 0), (None, 1, 1, 0, 0, 0)]


def test_scaler_uses_population_deviation_and_centres_constants(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "features array<double>")
    got = [r["scaled"] for r in scale(df, "features", fit_scaler(df, "features")).collect()]
    assert got == [[-1.0, 0.0], [1.0, 0.0]]


def test_assembling_a_null_raises_unless_told_otherwise(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    with pytest.raises(Exception, match="null"):
        assemble(df, ["a", "b"]).collect()
    assert assemble(df, ["a", "b"], invalid="skip").count() == 1
