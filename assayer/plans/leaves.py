"""Queries over images: colours, colour rule and its sweep, vectors, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.fixed_values import COLOUR_THRESHOLDS
from assayer.operators import colour, metrics, sweep
from assayer.operators.images import image_features, pixel_rows, resize_images
from assayer.operators.split import stratified_split
from assayer.operators.vectors import fit_scaler, pixel_vectors, scale, with_class_codes
from assayer.plans.image_files import leaf_image_folder
from assayer.plans.standins import leaves, pixels, sql_split, sql_with, vectors
from assayer.session import settle
from assayer.sources.images import readable, scan_images, unreadable

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def sql_hsv(source: str) -> str:
    return f"""
        hsv AS (
          SELECT * EXCLUDE (hi, lo),
                 cast(CASE WHEN hi = lo THEN 0 ELSE round((CASE
                   WHEN hi = r AND g >= b THEN (g - b)::double / (hi - lo)
                   WHEN hi = r THEN (g - b)::double / (hi - lo) + 6
                   WHEN hi = g THEN (b - r)::double / (hi - lo) + 2
                   ELSE (r - g)::double / (hi - lo) + 4 END) * 30.0::double) % 180 END AS int) AS h,
                 cast(CASE WHEN hi = 0 THEN 0 ELSE round(255.0::double * (hi - lo) / hi) END AS int) AS s,
                 hi AS v
          FROM (SELECT *, greatest(r, g, b) AS hi, least(r, g, b) AS lo FROM {source})),
        bands AS (
          SELECT image_id, label,
                 avg(cast(h BETWEEN 5 AND 30 AND s BETWEEN 60 AND 255 AND v BETWEEN 40 AND 255 AS int)) AS brown_ratio,
                 avg(cast(h BETWEEN 35 AND 90 AND s BETWEEN 40 AND 255 AND v BETWEEN 40 AND 255 AS int)) AS green_ratio,
                 avg(cast(h BETWEEN 0 AND 180 AND s BETWEEN 0 AND 255 AND v BETWEEN 0 AND 60 AS int)) AS dark_ratio
          FROM hsv GROUP BY image_id, label)"""


RATIOS = ("brown_ratio", "green_ratio", "dark_ratio")
SHOW_RATIOS = ", ".join(f"round({c}, 6) AS {c}" for c in RATIOS)


@query("rgb_to_hsv", sql_with("pixels", sql_hsv("pixels")) + " SELECT image_id, x, y, h, s, v FROM hsv")
def rgb_to_hsv(spark: SparkSession, folder: str) -> DataFrame:
    return colour.with_hsv(pixels(spark, folder)).select("image_id", "x", "y", "h", "s", "v")


@query(
    "colour_ratios",
    sql_with("pixels", sql_hsv("pixels")) + f" SELECT image_id, label, {SHOW_RATIOS} FROM bands",
)
def colour_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(colour.colour_ratios(pixels(spark, folder), ["image_id", "label"]), *RATIOS)


LEAVES = sql_with("pixels leaves", sql_hsv("leaves"))


def leaf_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return colour.colour_ratios(leaves(spark, folder), ["image_id", "label"])


@query(
    "colour_rule",
    LEAVES
    + """
    SELECT image_id, label, prediction, label = prediction AS correct
    FROM (SELECT image_id, label, CASE WHEN dark_ratio >= 0.2::double THEN 1
                                       WHEN brown_ratio >= 0.1::double THEN 0 ELSE 2 END AS prediction
          FROM bands)""",
)
def colour_rule(spark: SparkSession, folder: str) -> DataFrame:
    ruled = colour.with_colour_rule(leaf_ratios(spark, folder), 0.1, 0.2, "label")
    return ruled.select("image_id", "label", "prediction", "correct")


def _sweep_sql() -> str:
    k = len(COLOUR_THRESHOLDS)
    points = ", ".join(
        f"({i * k + j}, {a!r}::double, {b!r}::double)"
        for i, a in enumerate(COLOUR_THRESHOLDS)
        for j, b in enumerate(COLOUR_THRESHOLDS)
    )
    return sql_with(
        "pixels leaves",
        sql_hsv("leaves"),
        sql_split("bands", "image_id", "label"),
        f"grid(grid_pos, min_brown, min_dark) AS (VALUES {points})",
        """
        said AS (SELECT grid_pos, min_brown, min_dark, label,
                        CASE WHEN dark_ratio >= min_dark THEN 1 WHEN brown_ratio >= min_brown THEN 0 ELSE 2 END AS p
                 FROM placed, grid WHERE split = 'val'),
        classes AS (SELECT DISTINCT grid_pos, c FROM (SELECT grid_pos, unnest([label, p]) AS c FROM said)),
        f1s AS (SELECT grid_pos, c, 2.0::double * count(*) FILTER (WHERE label = c AND p = c)
                       / (count(*) FILTER (WHERE label = c) + count(*) FILTER (WHERE p = c)) AS f
                FROM said JOIN classes USING (grid_pos) GROUP BY ALL),
        points AS (SELECT grid_pos, min_brown, min_dark, accuracy, f1
                   FROM (SELECT grid_pos, min_brown, min_dark,
                                avg(CASE WHEN label = p THEN 1.0::double ELSE 0 END) AS accuracy
                         FROM said GROUP BY ALL)
                   JOIN (SELECT grid_pos, avg(f) AS f1 FROM f1s GROUP BY grid_pos) USING (grid_pos))""",
    )


POINT = ["grid_pos", "min_brown", "min_dark"]


def colour_scores(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Placed images and the validation score of every grid point."""
    placed = stratified_split(settle(leaf_ratios(spark, folder), "ratios"), "image_id", "label")
    counts = colour.sweep_colours(placed.where(F.col("split") == "val"), "label")
    return placed, metrics.macro_scores(counts, by=POINT).select(*POINT, "accuracy", "f1")


@query(
    "colour_sweep",
    _sweep_sql()
    + """ SELECT grid_pos, round(min_brown, 3) AS min_brown, round(min_dark, 3) AS min_dark,
                 round(accuracy, 4) AS accuracy, round(f1, 4) AS f1
          FROM points ORDER BY round(f1, 4) DESC, grid_pos LIMIT 10""",
)
def colour_sweep(spark: SparkSession, folder: str) -> DataFrame:
    top = sweep.top_points(colour_scores(spark, folder)[1])
    return rounded(rounded(top, "accuracy", "f1", digits=4), "min_brown", "min_dark", digits=3)


@query(
    "colour_best",
    _sweep_sql()
    + """ SELECT grid_pos, round(min_brown, 6) AS min_brown, round(min_dark, 6) AS min_dark,
                 round(accuracy, 6) AS accuracy, round(f1, 6) AS f1
          FROM points ORDER BY round(f1, 12) DESC, grid_pos LIMIT 1""",
)
def colour_best(spark: SparkSession, folder: str) -> DataFrame:
    best = sweep.best_point(colour_scores(spark, folder)[1])
    return rounded(best, "min_brown", "min_dark", "accuracy", "f1")


@query(
    "colour_test_confusion",
    _sweep_sql()
    + """, best AS (SELECT * FROM points ORDER BY round(f1, 12) DESC, grid_pos LIMIT 1)
    SELECT label, prediction, count(*) AS n
    FROM (SELECT label, CASE WHEN dark_ratio >= min_dark THEN 1
                             WHEN brown_ratio >= min_brown THEN 0 ELSE 2 END AS prediction
          FROM placed, best WHERE split = 'test') GROUP BY ALL""",
)
def colour_test_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """Thresholds chosen on validation images, counted on test images."""
    placed, scores = colour_scores(spark, folder)
    best = sweep.best_point(scores).first()
    test = placed.where(F.col("split") == "test")
    ruled = colour.with_colour_rule(test, best["min_brown"], best["min_dark"])
    return metrics.confusion(ruled, "label", "prediction")


@query(
    "pixel_vector",
    sql_with("pixels")
    + """,
    channels AS (SELECT image_id, y * 24 + x * 3 + c AS pos, [r, g, b][c + 1] / 255.0::double AS value
                 FROM pixels, (SELECT unnest(range(3)) AS c))
    SELECT image_id, cast(pos AS int) AS pos, round(value, 6) AS value FROM channels""",
)
def pixel_vector(spark: SparkSession, folder: str) -> DataFrame:
    """Flattened vectors, unrolled again for comparison."""
    flat = pixel_vectors(pixels(spark, folder), ["image_id"])
    return rounded(flat.select("image_id", F.posexplode("features").alias("pos", "value")), "value")


@query(
    "standardise",
    sql_with(
        "",
        "vectors AS (SELECT vec_id AS id, label, embedding FROM embeddings)",
        sql_split("vectors", "id", "label"),
    )
    + """,
    long AS (SELECT id, split, pos, cast(embedding[pos + 1] AS double) AS value
             FROM placed, (SELECT unnest(range(64)) AS pos)),
    stats AS (SELECT pos, avg(value) AS m, stddev_pop(value) AS s FROM long WHERE split = 'train' GROUP BY pos)
    SELECT id, split, cast(pos AS int) AS pos,
           round((value - m) / CASE WHEN s = 0 THEN 1 ELSE s END, 6) AS value
    FROM long JOIN stats USING (pos)""",
)
def standardise(spark: SparkSession, folder: str) -> DataFrame:
    """Scaling learned on training vectors, applied to all of them."""
    placed = stratified_split(vectors(spark, folder), "id", "label")
    scaler = fit_scaler(placed.where(F.col("split") == "train"), "features")
    scaled = scale(placed, "features", scaler)
    return rounded(scaled.select("id", "split", F.posexplode("scaled").alias("pos", "value")), "value")


def with_image_id(images: DataFrame) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return images.withColumn("image_id", F.regexp_extract(name, r"(\d+)\.", 1).cast("bigint"))


def scanned(spark: SparkSession, folder: str) -> DataFrame:
    return with_image_id(scan_images(spark, leaf_image_folder(spark, folder)))


@query(
    "image_scan",
    """
    SELECT vec_id AS image_id, 'class_' || (label % 3) AS class, 8 AS height, 8 AS width FROM embeddings""",
)
def image_scan(spark: SparkSession, folder: str) -> DataFrame:
    return readable(scanned(spark, folder)).select("image_id", "class", "height", "width")


@query(
    "image_unreadable",
    "SELECT vec_id AS image_id, 'class_' || (label % 3) AS class FROM embeddings WHERE vec_id % 11 = 0",
)
def image_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    broken = unreadable(scan_images(spark, leaf_image_folder(spark, folder)))
    return with_image_id(broken).select("image_id", "class")


@query(
    "image_pixels",
    sql_with("pixels") + " SELECT image_id, x, y, r, g, b FROM pixels",
)
def image_pixels(spark: SparkSession, folder: str) -> DataFrame:
    """Files at their own size: decoding and the channel order leave every pixel as it was."""
    return pixel_rows(resize_images(readable(scanned(spark, folder)), ["image_id"], 8), ["image_id"], 8)


@query(
    "resize_bilinear",
    sql_with("pixels")
    + """,
    spots AS (SELECT i, floor(p)::int AS lo, least(floor(p)::int + 1, 7) AS hi, p - floor(p) AS f
           FROM (SELECT i, greatest(least((i + 0.5::double) * 8 / 12 - 0.5::double, 7), 0)::double AS p
                 FROM (SELECT unnest(range(12)) AS i))),
    corners AS (
      SELECT p.image_id, ax.i AS x, ay.i AS y, p.r, p.g, p.b,
             (CASE WHEN p.x = ax.lo THEN 1 - ax.f ELSE 0 END + CASE WHEN p.x = ax.hi THEN ax.f ELSE 0 END)
             * (CASE WHEN p.y = ay.lo THEN 1 - ay.f ELSE 0 END + CASE WHEN p.y = ay.hi THEN ay.f ELSE 0 END) AS w
      FROM pixels p JOIN spots ax ON p.x IN (ax.lo, ax.hi) JOIN spots ay ON p.y IN (ay.lo, ay.hi))
    SELECT image_id, cast(x AS int) AS x, cast(y AS int) AS y, cast(floor(round(sum(r * w), 9) + 0.5::double) AS int) AS r,
           cast(floor(round(sum(g * w), 9) + 0.5::double) AS int) AS g,
           cast(floor(round(sum(b * w), 9) + 0.5::double) AS int) AS b
    FROM corners GROUP BY ALL""",
)
def resize_bilinear(spark: SparkSession, folder: str) -> DataFrame:
    """8 x 8 files brought to 12 x 12."""
    return pixel_rows(resize_images(readable(scanned(spark, folder)), ["image_id"], 12), ["image_id"], 12)


@query(
    "image_colour_ratios",
    sql_with("pixels", sql_hsv("pixels")) + f" SELECT image_id, {SHOW_RATIOS} FROM bands",
)
def image_colour_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """Ratios straight from image rows, one image per row and no shuffle."""
    resized = resize_images(readable(scanned(spark, folder)), ["image_id"], 8)
    return rounded(image_features(resized, ["image_id"], 8, vectors=False), *RATIOS)


# The network's numbers are of single precision.
@query(
    "image_vectors",
    SQL["pixel_vector"].replace("round(value, 6)", "round(cast(cast(value AS float) AS double), 6)"),
)
def image_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors that the network reads, straight from image rows, unrolled for comparison."""
    resized = resize_images(readable(scanned(spark, folder)), ["image_id"], 8)
    flat = image_features(resized, ["image_id"], 8).select("image_id", F.posexplode("features").alias("pos", "value"))
    return rounded(flat.withColumn("value", F.col("value").cast("double")), "value")


CLASSES = ["class_0", "class_1", "class_2"]


@query(
    "image_side_by_side",
    _sweep_sql()
    + f""",
    best AS (SELECT min_brown, min_dark FROM points ORDER BY round(f1, 12) DESC, grid_pos LIMIT 1),
    ruled AS (SELECT image_id, label, {", ".join(RATIOS)},
                     CASE WHEN dark_ratio >= min_dark THEN 1 WHEN brown_ratio >= min_brown THEN 0 ELSE 2 END AS prediction
              FROM placed, best WHERE split = 'test')
    SELECT image_id, 'class_' || label AS class, cast(label AS int) AS label, {SHOW_RATIOS}, prediction,
           label = prediction AS correct
    FROM ruled""",
)
def image_side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    """From image files to the rule's verdict on each test image, at the thresholds chosen on validation images."""
    resized = resize_images(readable(scanned(spark, folder)), ["image_id", "class"], 8)
    featured = settle(image_features(resized, ["image_id", "class"], 8, vectors=False), "image-features")
    placed = stratified_split(with_class_codes(featured, "class", CLASSES), "image_id", "label")
    counts = colour.sweep_colours(placed.where(F.col("split") == "val"), "label")
    best = sweep.best_point(metrics.macro_scores(counts, by=POINT)).first()
    test = placed.where(F.col("split") == "test")
    ruled = colour.with_colour_rule(test, best["min_brown"], best["min_dark"], "label")
    return rounded(ruled.select("image_id", "class", "label", *RATIOS, "prediction", "correct"), *RATIOS)
