from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from assayer.operators.impute import impute
from assayer.operators.vectors import assemble
from assayer.plans.streams import BATCH_BYTES, collected, sliced_stream
from assayer.sources.tables import PREDICTORS, SENTINEL_COLUMNS, read_csv, read_headlines, stream_csv
from assayer.sources.versions import PROMOTED, RECORD, ModelStore
from assayer.streaming.retrain import Retrainer, drain, start
from assayer.streaming.scorer import Scorer

HEADER = ",".join([*PREDICTORS, "Outcome"])


def write(folder, name, n, seed=0, one_class=False):
    rng = random.Random(seed)
    lines = [HEADER]
    for _ in range(n):
        glucose = rng.choice([0, *range(80, 180)])
        outcome = 0 if one_class else int(glucose + rng.random() * 30 > 140)
        lines.append(f"{rng.randrange(9)},{glucose},70,0,0,{rng.random() * 20 + 20:.1f},0.5,{rng.randrange(20, 70)},{outcome}")
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def incoming(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    return folder


def run(spark, incoming, tmp_path, store, **options):
    retrainer = Retrainer(store, trees=5, **options)
    drain(start(stream_csv(spark, str(incoming)), retrainer, str(tmp_path / "progress")), 300)


def test_one_file_one_model_and_nothing_twice(spark, tmp_path, incoming):
    for i in range(2):
        write(incoming, f"{i}.csv", 120, seed=i)
    write(incoming, "empty.csv", 0)
    write(incoming, "same.csv", 40, one_class=True)
    store = ModelStore(spark, str(tmp_path / "store"))
    run(spark, incoming, tmp_path, store)
    records = store.records().collect()
    assert sorted(r["status"] for r in records) == ["empty", "promoted", "promoted", "too few classes"]
    promoted = [r for r in records if r["status"] == "promoted"]
    assert all(r["n_rows"] == 120 and r["auc"] > 0.5 for r in promoted)
    assert all(r["auc"] is None for r in records if r["status"] != "promoted")
    assert store.latest().getNumTrees == 5
    # A restart on the same progress folder finds nothing to do.
    run(spark, incoming, tmp_path, store)
    assert store.records().count() == 4
    # A new file becomes one more batch, and only the newest models are kept.
    write(incoming, "late.csv", 120, seed=9)
    run(spark, incoming, tmp_path, store)
    assert store.records().count() == 5
    kept = [store._exists(store.model_path(r["batch_id"])) for r in store.records().collect() if r["status"] == "promoted"]
    assert sum(kept) == 2
    newest = max(r["batch_id"] for r in store.records().collect() if r["status"] == "promoted")
    assert store.promoted()[0] == newest


def test_a_replayed_batch_changes_nothing(spark, tmp_path, incoming):
    write(incoming, "a.csv", 100)
    store = ModelStore(spark, str(tmp_path / "store"))
    batch = read_csv(spark, str(incoming))
    retrainer = Retrainer(store, trees=3)
    retrainer(batch, 0)
    before = store.records().collect()
    retrainer(batch.limit(0), 0)
    assert store.records().collect() == before


def test_all_files_in_one_batch_without_a_limit(spark, tmp_path, incoming):
    for i in range(3):
        write(incoming, f"{i}.csv", 5)
    sizes = []
    stream = stream_csv(spark, str(incoming), files_per_batch=None)
    drain(start(stream, lambda batch, _: sizes.append(batch.count()), str(tmp_path / "p")), 120)
    assert sizes == [15]


def test_reordered_header_raises(spark, tmp_path):
    (tmp_path / "x.csv").write_text(HEADER.replace("Glucose,BloodPressure", "BloodPressure,Glucose") + "\n" + ",".join("1" * 9) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "x.csv")).collect()


def test_headline_quotes(spark, tmp_path):
    (tmp_path / "h.csv").write_text('news_headline,is_sarcastic\n"a ""b"", c",1\nplain,0\n')
    rows = read_headlines(spark, str(tmp_path / "h.csv")).collect()
    assert sorted((r["text"], r["label"]) for r in rows) == [('a "b", c', 1), ("plain", 0)]
    assert len({r["id"] for r in rows}) == 2


class CountedFiles:
    """Passes calls on and counts them by name."""

    def __init__(self, files):
        self.files, self.calls = files, []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            return getattr(self.files, name)(*args)

        return call


def blank(spark, status=PROMOTED):
    names = [c.split() for c in RECORD.split(", ")]
    return spark.range(1).select(*[F.lit(status if n == "status" else None).cast(t).alias(n) for n, t in names])


def test_a_batch_costs_the_same_however_old_the_stream(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"), span=4)
    store.files = CountedFiles(store.files)
    costs = []
    for batch_id in range(18):
        store.files.calls.clear()
        assert not store.has_record(batch_id)
        store.record(blank(spark), batch_id, promoted=True)
        costs.append(len(store.files.calls))
    plain = [c for i, c in enumerate(costs) if (i + 1) % 4 and i > 2]
    compacting = [c for i, c in enumerate(costs) if not (i + 1) % 4]
    assert len(set(plain)) == 1 and len(set(compacting)) == 1
    assert store.pointer().models == [17, 16] and store.pointer().compacted == 4
    assert sorted(r["batch_id"] for r in store.records().collect()) == list(range(18))
    folders = {f.name for f in (tmp_path / "store" / "records" / "recent").iterdir()}
    assert folders == {"batch_id=16", "batch_id=17"}


def test_a_crash_before_the_pointer_moves_is_replayed(spark, tmp_path, monkeypatch):
    store = ModelStore(spark, str(tmp_path / "store"), span=2)
    store.record(blank(spark), 0, promoted=True)
    monkeypatch.setattr(store, "_point", lambda at: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.record(blank(spark, "empty"), 1)
    monkeypatch.undo()
    assert not store.has_record(1) and store.promoted() == [0]
    assert [r["batch_id"] for r in store.records().collect()] == [0]
    store.record(blank(spark, "empty"), 1)
    again = ModelStore(spark, str(tmp_path / "store"), span=2)
    assert again.has_record(1) and again.pointer().compacted == 1
    assert sorted((r["batch_id"], r["status"]) for r in again.records().collect()) == [(0, PROMOTED), (1, "empty")]


def test_scores_follow_the_pointer(spark, tmp_path, incoming):
    store = ModelStore(spark, str(tmp_path / "store"))
    prepare = lambda batch: assemble(impute(batch, SENTINEL_COLUMNS), PREDICTORS)
    scorer = Scorer(store, str(tmp_path / "scored"), prepare, ["Glucose"])

    def score():
        drain(start(stream_csv(spark, str(incoming)), scorer, str(tmp_path / "score-progress")), 300)

    write(incoming, "0.csv", 50, seed=1)
    score()  # before there is a model
    run(spark, incoming, tmp_path, store)
    write(incoming, "1.csv", 60, seed=2)
    score()
    write(incoming, "2.csv", 40, one_class=True)
    run(spark, incoming, tmp_path, store)  # trains on 1.csv, records 2.csv without a model
    score()
    rows = spark.read.parquet(str(tmp_path / "scored")).collect()
    stamps = {(r["batch_id"], r["model_batch"]) for r in rows}
    assert len(rows) == 150 and {s for b, s in stamps if b == 0} == {None} and {s for b, s in stamps if b == 1} == {0}
    assert {s for b, s in stamps if b == 2} == {store.promoted()[0]} and scorer.loads == 2
    assert all((r["score"] is None) == (r["model_batch"] is None) for r in rows)
    # a batch that comes again replaces its rows
    scorer(read_csv(spark, str(incoming / "0.csv")), 0)
    assert spark.read.parquet(str(tmp_path / "scored")).count() == 150


def test_small_files_share_a_batch(spark, tmp_path, incoming):
    for i in range(6):
        write(incoming, f"{i}.csv", 30, seed=i)
    size = max(f.stat().st_size for f in incoming.iterdir())
    seen = []

    def on_batch(batch, _):
        seen.append([r["n"] for r in batch.groupBy("file").agg(F.count("*").alias("n")).collect()])

    stream = stream_csv(spark, str(incoming), bytes_per_batch=3 * size, file_column="file")
    drain(start(stream, on_batch, str(tmp_path / "p")), 120)
    assert 1 < len(seen) < 6 and sorted(n for batch in seen for n in batch) == [30] * 6


def test_the_sliced_query_has_fewer_batches_than_files(spark, small):
    stream, files = sliced_stream(spark, small)
    out = collected(spark, stream, lambda batch: batch.groupBy("file").agg(F.count("*").alias("n")))
    row = out.agg(F.count_distinct("batch_id").alias("batches"), F.count("*").alias("files")).first()
    assert row["batches"] < row["files"] == files and BATCH_BYTES > 0


def test_batches_do_not_follow_the_number_of_files(spark):
    """Each batch has jobs and logs of its own, so 30 files of 1.3 MB share one."""
    stream, files = sliced_stream(spark, "/root/testdata/sf0.1")
    found = collected(spark, stream, lambda batch: batch.groupBy("file").agg(F.count("*").alias("n")))
    row = found.agg(F.count_distinct("batch_id").alias("batches"), F.count("*").alias("files"), F.sum("n").alias("n")).first()
    assert row["batches"] == 1 and row["files"] == files == 30 and row["n"] > 590_000


def test_headline_ids_follow_content(spark, tmp_path):
    texts = [("a", 1), ("a", 1), ("a", 0), (None, 1), ("", 1), ('say ""x""\nagain, "y"', 0), ("a", None), ("1|a", None)]
    texts += [("same", 1)] * 50
    df = spark.createDataFrame(texts, "news_headline string, is_sarcastic int")
    ids = []
    for parts in (1, 5):
        path = str(tmp_path / f"cut{parts}")
        df.repartition(parts).write.options(header=True, escape='"').csv(path)
        rows = read_headlines(spark, path, many_lines=True).collect()
        assert sorted((str(r["text"]), str(r["label"])) for r in rows) == sorted((str(t), str(n)) for t, n in texts)
        ids.append(sorted((r["id"], str(r["text"])) for r in rows))
        assert len({i for i, _ in ids[-1]}) == len(texts)
    assert ids[0] == ids[1]
    same = sorted(int(i.split("-")[1]) for i, t in ids[0] if t == "same")
    assert same == list(range(50))


def test_files_of_a_batch_have_models_of_their_own(spark, tmp_path, incoming):
    for i in range(7):
        write(incoming, f"{i}.csv", 100 + i, seed=i)
    write(incoming, "same.csv", 40, one_class=True)
    alone = ModelStore(spark, str(tmp_path / "alone"))
    run(spark, incoming, tmp_path, alone)
    together = ModelStore(spark, str(tmp_path / "together"), span=4)
    retrainer, batches = Retrainer(together, trees=5, file_column="file"), []

    def on_batch(batch, batch_id):
        batches.append(batch_id)
        retrainer(batch, batch_id)
        retrainer(batch.limit(0), batch_id)  # a replay changes nothing

    size = max(f.stat().st_size for f in incoming.iterdir())
    stream = stream_csv(spark, str(incoming), bytes_per_batch=6 * size, file_column="file")
    drain(start(stream, on_batch, str(tmp_path / "p")), 300)
    columns = [c.split()[0] for c in RECORD.split(", ")][1:]
    rows = [[sorted(tuple(str(r[c]) for c in columns) for r in s.records().collect())] for s in (alone, together)]
    assert rows[0] == rows[1] and len(batches) < 8
    assert sorted(r["batch_id"] for r in together.records().collect()) == list(range(8))
    assert together.pointer().compacted == 2 and together.pointer().last == 7
    assert len(together.promoted()) == 2 and together.latest().getNumTrees == 5
    # as do the files after them
    (incoming / "sub").mkdir()
    write(incoming / "sub", "late.csv", 90, seed=8)
    retrainer(read_csv(spark, str(incoming / "sub")).withColumn("file", F.lit("late")), max(batches) + 1)
    assert together.pointer().last == 8 and together.promoted()[0] == 8


def test_only_stored_models_reach_python(spark, tmp_path, incoming, monkeypatch):
    """PySpark's model wraps every tree, which fits side by side would wait for; a large file's rows are dealt out."""
    from assayer.streaming import retrain

    monkeypatch.setattr(retrain, "TASK_ROWS", 200)
    wrapped, create = [], retrain.RandomForestClassifier._create_model
    monkeypatch.setattr(retrain.RandomForestClassifier, "_create_model", lambda self, java: wrapped.append(java) or create(self, java))
    fitted, fit = [], retrain.RandomForestClassifier._fit_java
    monkeypatch.setattr(
        retrain.RandomForestClassifier, "_fit_java", lambda self, rows: fitted.append(rows.rdd.glom().map(len).collect()) or fit(self, rows)
    )
    for i in range(5):
        write(incoming, f"{i}.csv", 100, seed=i)
    write(incoming, "large.csv", 600, seed=9)
    store = ModelStore(spark, str(tmp_path / "store"))
    retrainer = Retrainer(store, trees=3, file_column="file")
    rows = read_csv(spark, str(incoming)).withColumn("file", F.col("_metadata.file_name"))
    retrainer(rows.limit(0), 0)
    assert store.records().isEmpty() and not wrapped
    retrainer(rows, 1)
    assert len(wrapped) == store.keep and len(fitted) == 6
    assert sorted(map(len, fitted)) == [1] * 5 + [3] and max(max(parts) for parts in fitted) <= 200
    found = store.records().collect()
    assert sorted(r["n_rows"] for r in found) == [100] * 5 + [600] and all(r["auc"] > 0.5 for r in found)
    assert store.latest().getNumTrees == 3
    assert not [f for f in (tmp_path.parent).rglob("sides-*") if f.is_dir()]


def test_large_batches_are_fitted_in_small_parts(spark, tmp_path, incoming, monkeypatch):
    from assayer.streaming import retrain

    monkeypatch.setattr(retrain, "TASK_ROWS", 20)
    fitted, fit = [], retrain.RandomForestClassifier.fit
    monkeypatch.setattr(retrain.RandomForestClassifier, "fit", lambda self, rows: fitted.append(rows) or fit(self, rows))
    write(incoming, "a.csv", 120, seed=1)
    batch = read_csv(spark, str(incoming)).coalesce(1)
    store = ModelStore(spark, str(tmp_path / "store"))
    parts = []
    monkeypatch.setattr(retrain, "evaluate_model", lambda model, *a: parts.append(fitted[-1].rdd.glom().map(len).collect()) or fail())
    with pytest.raises(ZeroDivisionError):
        Retrainer(store, trees=3)(batch, 0)
    assert len(parts[0]) >= 4 and max(parts[0]) <= 21 and 70 < sum(parts[0]) < 120


def fail():
    return 1 / 0
