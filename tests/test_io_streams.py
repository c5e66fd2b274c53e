"""Sources, sinks, streams and image steps."""

import datetime
import json

import numpy as np
from pyspark.sql import functions as F

from paperloom.operators import images
from paperloom.sources import readers, sinks
from paperloom.streaming import queues


def test_scanned_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "b.JPG").write_bytes(b"\xff\xd8")
    (tmp_path / "c.txt").write_bytes(b"no")
    got = {r.doc_id: (r.file_ext, r.is_pdf) for r in readers.scanned_files(spark, str(tmp_path)).collect()}
    assert got == {"a": ("pdf", True), "b": ("jpg", False)}


def test_pdf_pages(spark):
    docs = spark.createDataFrame([("a", bytearray(b"1,2")), ("b", bytearray(b""))], "doc_id string, content binary")
    rows = readers.pdf_pages(docs, lambda c: [p.encode() for p in c.decode().split(",")] if c else []).collect()
    assert {(r.doc_id, r.total_pages, r.error) for r in rows} == {("a_p01", 2, None), ("a_p02", 2, None), ("b_p00", 0, "no pages")}


def test_requests_schemas_and_outputs(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"doc_id": "d", "image_base64": "aGk="}) + "\n")
    assert bytes(readers.requests(spark, str(tmp_path / "r.json")).first().content) == b"hi"
    folder = tmp_path / "schemas"
    folder.mkdir()
    for name, version, old in (("a", "1.0", False), ("b", "2.0", False), ("c", "3.0", True)):
        (folder / f"{name}.json").write_text(json.dumps({"$id": "s", "x-version": version, "x-deprecated": old, "x-assembly-rules": {"f": "a.f"}}))
    latest = readers.latest_schemas(readers.schema_files(spark, str(folder))).first()
    assert latest.version == "2.0" and readers.assembly_rules("s", latest.schema) == [("s", 0, "f", "a.f")]
    run = tmp_path / "run" / "doc" / "p01"
    run.mkdir(parents=True)
    (run / "ok.json").write_text('{"a": 1}')
    (run / "bad.json").write_text("{")
    rows = readers.run_outputs(spark, str(tmp_path / "run"), "a int").select("a", readers.document_of_path(F.col("path"), "/run").alias("d")).collect()
    assert [(r.a, r.d) for r in rows] == [(1, "doc/p01")]


def test_documents_out(spark):
    df = spark.createDataFrame([("d", "값 <1>", None)], "doc_id string, value string, note string")
    out = sinks.serialized(df, ["doc_id", "value", "note"]).first()
    assert json.loads(out.json_output) == {"doc_id": "d", "value": "값 <1>", "note": None} and "값 &lt;1" in out.xml_output
    titled = spark.range(1).select(sinks.titled(F.lit('{"a":1}'), F.lit('T "x"')).alias("o")).first().o
    assert list(json.loads(titled)) == ["document_title", "a"] and json.loads(titled)["document_title"] == 'T "x"'
    assert sinks.csv_rows(df.withColumn("ok", F.lit(True))).first().ok == "true"


def test_upserts(spark, tmp_path):
    at = lambda n: datetime.datetime(2024, 1, n)
    old = spark.createDataFrame([("a", 1, at(1)), ("b", 1, at(1))], "doc_id string, v int, processed_at timestamp")
    new = spark.createDataFrame([("b", 2, at(2)), ("b", 3, at(3)), ("c", 4, at(1))], "doc_id string, v int, processed_at timestamp")
    assert {(r.doc_id, r.v) for r in sinks.upserted(old, new).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    assert {(r.doc_id, r.v) for r in sinks.replaced(old, new).collect()} == {("a", 1), ("b", 2), ("b", 3), ("c", 4)}
    for value in (1, 2):
        sinks.stage_table(old.withColumn("v", F.lit(value)), str(tmp_path), "P4", "t1")
    sinks.stage_table(old, str(tmp_path), "P4", "t2")
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "P4")).collect()) == [1, 1, 2, 2]

    def broken(_):
        raise OSError("gone")

    assert sinks.written_or_kept(old, broken, str(tmp_path / "dead")).startswith("OSError") and spark.read.json(str(tmp_path / "dead")).count() == 2


def test_windows_drop_late_rows_and_survive_a_restart(spark, tmp_path):
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    schema, source = "enqueued_at timestamp, priority string", tmp_path / "in"

    def put(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source / name))

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(source))
        q = queues.queue_windows(stream, "enqueued_at", "5 minutes", "5 minutes", "priority").writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination(120)

    put("1", [(at(1), "normal"), (at(2), "normal"), (at(20), "normal")])
    run()
    put("2", [(at(3), "normal"), (at(40), "critical")])
    run()
    rows = {(r.window_start, r.priority): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows[(at(0), "normal")] == 2 and rows[(at(20), "normal")] == 1


def test_health_states(spark, tmp_path):
    schema = "service string, ts timestamp, ok boolean"
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    spark.createDataFrame([("s", at(m), ok) for m, ok in enumerate([False, False, False, True, False])], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = queues.health_states(stream).writeStream.outputMode("append").format("memory").queryName("health").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.streak, r.healthy) for r in spark.table("health").orderBy("ts").collect()] == [(1, True), (2, True), (3, False), (0, True), (1, True)]


def test_images(spark):
    page = np.full((60, 80), 255, np.uint8)
    page[10:14, 10:60] = 0
    row = spark.createDataFrame([("d", bytearray(page.tobytes()), 60, 80, 300)], "doc_id string, pixels binary, height int, width int, dpi int")
    got = images.page_statistics(row).first()
    assert 0.02 < got.ink < 0.1 and got.brightness > 200 and got.sharpness > 100
    ink = images.binarized(page.astype(float), 29)
    assert (ink[11, 20:50] == 0).all() and ink[50, 50] == 255
    assert images.resized(page.astype(float), 30, 40).shape == (30, 40)
    rgb = np.full((100, 100, 3), 255, np.uint8)
    y, x = np.ogrid[:100, :100]
    rgb[np.abs(np.hypot(y - 50, x - 40) - 20) < 2] = (220, 20, 20)
    cy, cx, radius = images.red_circle(rgb)
    assert abs(cy - 50) < 2 and abs(cx - 40) < 2 and abs(radius - 21) < 2
    assert images.unwrapped_seal(rgb[..., 0], cy, cx, radius).shape == (64, 256)


def test_picture_steps():
    r = np.random.default_rng(1)
    dark, bright = r.integers(0, 60, (64, 64)).astype(float), r.integers(215, 255, (64, 64)).astype(float)
    assert images.brightened(dark).mean() > dark.mean() + 20 and np.ptp(images.brightened(bright)) > np.ptp(bright) and images.brightened(dark + 100) is not None
    flat = np.full((40, 40), 100.0)
    flat[20, 20] = 255
    assert images.denoised(flat).max() == 100 and images.opened(flat, 3).max() == 100 and images.opened(flat, 1) is flat
    page = np.full((120, 160), 255.0)
    y, x = np.mgrid[:120, :160]
    page[np.abs((y - 60) - (x - 80) * np.tan(np.radians(5))) < 2] = 0
    level = images.rotated(page, 5.0)
    assert (level[58:63, 30:130] < 128).any(0).all() and (level[:50] > 200).all() and images.rotated(page, 0.1) is page
    corners = np.array([[20, 15], [140, 15], [140, 118], [20, 118]])
    flat = images.flattened(x + 1000.0 * y, corners[[2, 0, 3, 1]])  # values tell where they come from
    assert flat.shape == (103, 120) and np.allclose(flat[[0, 0, -1, -1], [0, -1, -1, 0]], corners @ [1, 1000]) and images.flattened(page, corners // 4) is page
    large = images.enlarged(np.tile(np.arange(0, 200, 10.0), (20, 1)), 3.0)
    assert large.shape == (40, 40) and abs(large[20, 21] - 102.5) < 3


def test_png_and_cleaned_pages(spark):
    import base64
    import struct
    import zlib

    page = np.random.default_rng(2).integers(0, 255, (30, 50)).astype(np.uint8)
    file = images.png(page)
    assert file[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", file[16:24]) == (50, 30)
    data = zlib.decompress(file[41 : 41 + struct.unpack(">I", file[33:37])[0]])
    assert (np.frombuffer(data, np.uint8).reshape(30, 51)[:, 1:] == page).all()
    white = np.full((60, 80), 255, np.uint8)
    white[20:24, 10:70] = 0
    rows = [("low", bytearray(white.tobytes()), 60, 80, 100, 0.0), ("mid", bytearray(white.tobytes()), 60, 80, 200, 3.0), ("broken", bytearray(b"x"), 60, 80, 200, 0.0)]
    got = {x.doc_id: x for x in images.cleaned_pages(spark.createDataFrame(rows, "doc_id string, pixels binary, height int, width int, dpi int, angle double")).collect()}
    assert (got["low"].height, got["low"].width, got["low"].dpi) == (120, 160, 200) and (got["mid"].height, got["mid"].width, got["mid"].dpi) == (90, 120, 300)
    assert got["broken"].image is None and 0 < got["mid"].ink < 0.3 and base64.b64decode(got["low"].image)[1:4] == b"PNG"
    band, found = images.seal_band(np.full((50, 50, 3), 255, np.uint8))
    assert not found and band.shape == (50, 50, 3)
