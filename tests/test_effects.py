"""What is stored, copied, sent and read: retrains, objects, letters, databases."""

import json
import os

import pytest
from pyspark import SparkFiles
from pyspark.sql import functions as F

from inspectra import fixtures as fx
from inspectra.operators import metrics
from inspectra.operators import registry as reg
from inspectra.plans import retrain as plan
from inspectra.sources import assets, jdbc, sinks
from inspectra.streaming import flows


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}"


def candidate(spark):
    bank = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "row_id int, vec array<double>")
    band = spark.createDataFrame([(1.5, 2.5)], "lower double, upper double")
    row = spark.createDataFrame([("patchcore-1.0.1", "patchcore", "models", 1, 0, 1, False)], "model_id string, model_type string, bucket string, major_version int, minor_version int, patch_version int, is_valid boolean")
    return plan.Candidate((1, 0, 1), bank, band, row, "1.0.0")


def test_commit_stores_copies_and_registers_last(spark, tmp_path, root):
    old = tmp_path / "assets/patchcore/1.0.0"
    (old / "config").mkdir(parents=True)
    (old / "net.onnx").write_bytes(b"weights")
    (old / "config/a.txt").write_text("a")
    c, at = candidate(spark), f"{root}/assets"
    with pytest.raises(FileNotFoundError):
        plan.commit(c, at, f"{root}/registry", ["net.onnx", "absent"])
    assert not os.path.exists(tmp_path / "registry")
    # The failed run left a bank under the version; the next one replaces it.
    assert plan.commit(c, at, f"{root}/registry", ["net.onnx", "config"]) == "1.0.1"
    assert assets.read_bank(spark, at, "patchcore", "1.0.1").count() == 2
    assert assets.read_band(spark, at, "patchcore", "1.0.1") == (1.5, 2.5)
    new = tmp_path / "assets/patchcore/1.0.1"
    assert (new / "net.onnx").read_bytes() == b"weights" and (new / "config/a.txt").read_text() == "a"
    stored = spark.read.parquet(f"{root}/registry").collect()
    assert [(r.model_id, r.is_valid) for r in stored] == [("patchcore-1.0.1", False)] and stored[0].created_at is not None
    with pytest.raises(ValueError):
        plan.commit(c, at, f"{root}/registry")
    with pytest.raises(LookupError):
        reg.latest(spark.read.parquet(f"{root}/registry"), "patchcore")


def test_assets_reach_the_tasks(spark, tmp_path, root):
    at = tmp_path / "m/dino/2.0.0"
    at.mkdir(parents=True)
    (at / "pca-2.bin").write_bytes(b"12345")
    names = assets.fetch_assets(spark, f"{root}/m", "dino", "2.0.0", ["pca-2.bin"])
    size = F.udf(lambda n: os.path.getsize(SparkFiles.get(n)), "long")
    assert spark.createDataFrame([(names["pca-2.bin"],)], "n string").select(size("n")).first()[0] == 5
    with pytest.raises(FileNotFoundError):
        assets.fetch_assets(spark, f"{root}/m", "dino", "2.0.0", ["pca-2.bin", "x"])
    assert assets.copy_assets(spark, f"{root}/m", "dino", "2.0.0", "2.0.1", ["pca-2.bin"]) == ["pca-2.bin"]
    assert assets.copy_assets(spark, f"{root}/m", "dino", "2.0.0", "2.0.1", ["pca-2.bin"]) == []


def test_train_events_of_pending_results(spark):
    rows = [(str(i), s, "m3", "b", f"{i}.png") for i, s in enumerate(["pending", "normal", "pending", "pending"])]
    results = spark.createDataFrame(rows, "event_id string, status string, model_id string, bucket string, object_key string")
    registry = fx.registry(spark).drop("bucket")
    got = {r.event_id: (r.key, json.loads(r.value)) for r in plan.train_events(results, registry, ["0", "1", "2"]).collect()}
    model = registry.where("model_id = 'm3'").first().model_type
    assert got == {i: ("train", {"event": "train", "model": model, "images": f"/b/{i}.png"}) for i in ("0", "2")}


def test_objects_in_chunks(spark, root):
    rows = spark.createDataFrame([("images", "a.png", "image/png", bytearray(b"x" * 70_000)), ("models", "b", None, bytearray(b"m")), ("images", "e", None, None)], "bucket string, object_key string, content_type string, content binary")
    sizes = {r.object_key: r.size_bytes for r in sinks.put_objects(rows, f"{root}/o").collect()}
    assert sizes == {"a.png": 70_000, "b": 1, "e": 0}
    kind, chunks = sinks.stream_object(spark, f"{root}/o", "images", "a.png")
    assert kind == "image/png" and [len(c) for c in chunks] == [32768, 32768, 4464]
    assert sinks.stream_object(spark, f"{root}/o", "models", "b", ("models",))[0] == "application/octet-stream"
    assert sinks.get_object(spark, f"{root}/o", "images", "e") == b""
    with pytest.raises(PermissionError):
        sinks.stream_object(spark, f"{root}/o", "models", "b")
    with pytest.raises(KeyError):
        sinks.stream_object(spark, f"{root}/o", "images", "b")


def test_a_large_object_is_read_window_by_window(spark, root, monkeypatch):
    """A reader asks for 16 stored chunks at once, and pieces need not fit them."""
    content = os.urandom(1000) * 2500
    rows = spark.createDataFrame([("images", "big", None, bytearray(content))], "bucket string, object_key string, content_type string, content binary")
    sinks.put_objects(rows, f"{root}/o", 10_000)
    asked = []
    real = type(rows).collect

    def collect(df):
        got = real(df)
        asked.append(sum(len(r.content) for r in got) if got and "content" in got[0] else 0)
        return got

    monkeypatch.setattr(type(rows), "collect", collect)
    _, pieces = sinks.stream_object(spark, f"{root}/o", "images", "big", chunk=7777)
    first = next(pieces)
    assert first == content[:7777] and sum(asked) == 160_000
    assert first + b"".join(pieces) == content and max(asked) == 160_000 and sum(asked) == len(content)
    sinks.put_objects(rows.selectExpr("bucket", "object_key", "content_type", "cast('new' as binary) as content"), f"{root}/o")
    assert sinks.get_object(spark, f"{root}/o", "images", "big") == b"new"


def test_keyed_inserts_read_the_touched_buckets_only(spark, tmp_path, root):
    rows = spark.range(200).selectExpr("cast(id as string) as k", "id as v")
    for _ in range(2):
        sinks.insert_if_absent(rows, f"{root}/t", "k", 16)
    stored = spark.read.parquet(f"{root}/t")
    assert stored.count() == 200 and stored.where("v = 7").count() == 1
    few = rows.where("v in (3, 7)")
    kept = sinks.stored_keys(few, f"{root}/t", "k", 16)
    touched = {str(tmp_path / "t" / f"{sinks.BUCKET}={r[0]}") for r in few.select(sinks._bucket("k", 16)).distinct().collect()}
    assert {"/" + os.path.dirname(f).removeprefix("file:").lstrip("/") for f in kept.select("_metadata.file_path").distinct().toPandas()["file_path"]} <= touched
    plan = kept._jdf.queryExecution().toString()
    assert f"PartitionFilters: [{sinks.BUCKET}" in plan and "PartitionFilters: []" not in plan
    sinks.insert_if_absent(rows.where("v = 3").withColumn("v", F.lit(-1).cast("long")).unionByName(spark.createDataFrame([("new", 1)], rows.schema)), f"{root}/t", "k", 16)
    assert spark.read.parquet(f"{root}/t").count() == 201 and stored.where("v = -1").count() == 0


def test_letters_of_a_batch_are_written_once(spark, root):
    rows = spark.createDataFrame([("bad",)], "value string")
    for batch in (0, 0, 1):
        sinks.dead_letter(rows, f"{root}/l", batch)
    assert spark.read.json(f"{root}/l").count() == 2


def test_the_first_error_of_an_ingest_is_seen(spark, tmp_path, root, monkeypatch):
    box = tmp_path / "files"
    box.mkdir()
    (box / "a.png").write_bytes(b"one")
    from inspectra.sources import images

    real = sinks.insert_if_absent

    def insert(rows, path, key):
        if path.endswith("out"):
            raise OSError("no broker")
        real(rows, path, key)

    def letter(*_):
        raise OSError("no disk")

    monkeypatch.setattr(sinks, "insert_if_absent", insert)
    monkeypatch.setattr(sinks, "dead_letter", letter)
    with pytest.raises(Exception, match="no broker"):
        flows.ingest(images.scan_stream(spark, f"{root}/files"), f"{root}/objects", f"{root}/images", f"{root}/out", f"{root}/letters", f"{root}/cp").awaitTermination()


def test_export_by_cluster(spark, tmp_path, root):
    """Real files under the manifest's names; what is absent or fails is counted."""
    files = spark.createDataFrame([("/d/a.png", bytearray(b"a")), ("/e/a.png", bytearray(b"later")), ("/d/b.png", bytearray(b"b"))], "path string, content binary")
    rows = spark.createDataFrame([("/d/a.png", "cut", 0), ("/e/a.png", "cut", 0), ("/d/b.png", "hole", -1), ("/d/c.png", "hole", 1)], "path string, label string, cluster int")
    for _ in range(2):
        assert sinks.export_clusters(files, rows, f"{root}/x", f"{root}/report") == {"written": 2, "failed": 0, "absent": 1}
    got = {str(p.relative_to(tmp_path / "x")): p.read_bytes() for p in (tmp_path / "x").rglob("*") if p.is_file()}
    assert got == {"cluster0/cut_a.png": b"later", "noise/hole_b.png": b"b"}
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "noise").write_text("a file where a folder should be")
    assert sinks.export_clusters(files, rows, f"{root}/y", f"{root}/report") == {"written": 1, "failed": 1, "absent": 1}
    bad = sinks.write_files(spark.createDataFrame([("../out", bytearray(b"x")), (None, None)], "name string, content binary"), f"{root}/z").collect()
    assert all(r.bytes is None and r.error for r in bad)


def test_a_retrain_that_is_handed_on_twice_registers_once(spark, tmp_path, root):
    """The batch stops after a commit, before its stream notes it, and runs again."""
    (tmp_path / "in").mkdir()
    line = lambda i: json.dumps({"topic": "t", "partition": 0, "offset": i, "timestamp": "2024-01-01T00:00:00", "key": "train", "value": json.dumps({"event": "train", "model": "patchcore", "images": f"/b/{i}.png"})})
    (tmp_path / "in" / "a.json").write_text("\n".join(line(i) for i in range(3)))
    made, stop = [], [True]

    def make(event, registry):
        made.append(event.object_key)
        if len(made) == 3 and stop[0]:
            raise OSError("killed")
        c = candidate(spark)
        version = (1, 0, registry.count() + 1)
        row = c.row.withColumn("model_id", F.lit(f"patchcore-{version[2]}")).withColumn("patch_version", F.lit(version[2]))
        return plan.Candidate(version, c.bank, c.band, row, c.base)

    def handle(events):
        plan.retrain_events(events, f"{root}/registry", f"{root}/assets", make)
        if stop[0]:
            raise OSError("killed after the commit")

    def start():
        flows.training(flows.files(spark, f"{root}/in"), handle, f"{root}/bad", f"{root}/cp").awaitTermination()

    with pytest.raises(Exception, match="killed"):
        start()
    assert spark.read.parquet(f"{root}/registry").count() == 2
    made.append("again")
    with pytest.raises(Exception, match="killed after"):
        start()  # does the third, then dies before the stream notes the batch
    stop[0] = False
    start()
    assert made == ["0.png", "1.png", "2.png", "again", "2.png"]
    stored = spark.read.parquet(f"{root}/registry").collect()
    assert len(stored) == 3 == len({r.source_event for r in stored}) and {r.patch_version for r in stored} == {1, 2, 3}


def test_leftovers_of_a_failed_run_are_replaced(spark, tmp_path, root):
    old, left = tmp_path / "assets/patchcore/1.0.0", tmp_path / "assets/patchcore/1.0.1"
    for folder, text in ((old, b"right"), (left, b"left over")):
        folder.mkdir(parents=True)
        (folder / "net.onnx").write_bytes(text)
    plan.commit(candidate(spark), f"{root}/assets", f"{root}/registry", ["net.onnx"])
    assert (left / "net.onnx").read_bytes() == b"right"


def test_database_in_ranges(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    rows = spark.range(100).select(F.when(F.col("id") > 2, F.col("id")).alias("n"), F.concat(F.lit("v"), "id").alias("v"))
    rows.coalesce(1).write.option("createTableColumnTypes", "v varchar(20)").jdbc(url, "readings", properties={"driver": driver})
    got = jdbc.read_table(spark, url, "readings", "n", (20, 60), 4, driver=driver)
    assert got.rdd.getNumPartitions() == 4 and got.count() == 100
    assert sorted(r.v for r in got.where("n > 97").collect()) == ["v98", "v99"]
    assert "PushedFilters: [*IsNotNull(n), *GreaterThan(n,97)]" in got.where("n > 97")._jdf.queryExecution().toString()
    assert jdbc.read_table(spark, url, "readings", driver=driver).count() == 100
    with pytest.raises(ValueError):
        jdbc.read_table(spark, url, "readings", "n", driver=driver)
    got.createOrReplaceTempView("readings")
    assert jdbc.rows(spark, "select n, v from readings where v = :v", v="v7' or 1=1") == []
    assert jdbc.rows(spark, "select n, v from readings where v = :v", v="v7") == [{"n": 7, "v": "v7"}]
    with pytest.raises(ValueError):
        jdbc.rows(spark, "select * from readings", most=10)


def test_wide_margins_in_pieces(spark, monkeypatch):
    rows = spark.createDataFrame([(i, i % 3, (i * 7 + i // 50) % 4) for i in range(900)], "item_id int, predicted int, truth int")
    whole = metrics.adjusted_mutual_information(metrics.cells(rows)).first().ami
    monkeypatch.setattr(metrics, "SUPPORT_PIECE", 7)
    assert metrics.adjusted_mutual_information(metrics.cells(rows)).first().ami == whole
