import io
import json
import struct
import tarfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern import cli
from quern.plans.steps import FilterStep
from quern.sinks import files, uids
from quern.sources import download, images, shards, tabular
from quern.streaming.shards import filtered_to, shard_stream


def jpeg(w, h):
    return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xc0" + struct.pack(">HBHHB", 11, 8, h, w, 1) + b"\x01\x11\x00\xff\xd9"


def png(w, h):
    head = struct.pack(">II", w, h) + b"\x08\x02\x00\x00\x00"
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + head + struct.pack(">I", zlib.crc32(b"IHDR" + head))


def put(path, samples):
    with tarfile.open(path, "w") as tar:
        for key, members in samples:
            for ending, body in members.items():
                m = tarfile.TarInfo(f"{key}.{ending}")
                m.size = len(body)
                tar.addfile(m, io.BytesIO(body))


@pytest.fixture
def folder(tmp_path):
    at = tmp_path / "shards"
    at.mkdir()
    for s in range(3):
        rows = []
        for i in range(5):
            n = s * 5 + i
            meta = {"uid": f"{n * 2**60:032x}", "width": 100, "caption": "x"}
            rows.append((f"{n:012d}", {"jpg": jpeg(80 + 10 * i, 100), "json": json.dumps(meta).encode(), "txt": f" of the caption number{n} \n".encode()}))
        put(at / f"{s:08d}.tar", rows)
    put(at / "9.tar", [("a", {"txt": b"no json"}), ("b", {"json": b"{}"}), ("c", {"json": b'{"uid": null}', "jpg": png(7, 9)}), ("d", {"json": b"broken"})])
    return str(at)


def test_scan(spark, folder):
    df = shards.read_shards(spark, folder)
    assert df.rdd.getNumPartitions() == 4
    rows = {r["key"]: r for r in df.collect()}
    assert len(rows) == 19
    assert rows["000000000003"]["txt"] == "of the caption number3" and rows["000000000003"]["shard"] == "00000000.tar"
    assert [rows[k]["uid"] for k in "abcd"] == ["unknown", "unknown", None, "unknown"]
    assert rows["b"]["txt"] is None and rows["a"]["jpg"] is None
    part = shards.read_shards(spark, [folder], columns=("txt",)).collect()
    assert all(r["jpg"] is None and r["meta"] is None and r["uid"] is not None or r["key"] == "c" for r in part)
    other = shards.read_binary_shards(spark, folder)
    assert sorted(map(str, other.collect())) == sorted(map(str, df.collect()))
    sizes = {r["shard"]: r["samples"] for r in shards.shard_sizes(spark, folder).collect()}
    assert sizes == {"00000000.tar": 5, "00000001.tar": 5, "00000002.tar": 5, "9.tar": 4}
    assert shards.with_meta(df).where("m.width = 100").count() == 15


def test_uid_filters(spark, folder):
    wanted = [f"{n * 2**60:032x}" for n in (1, 7)]
    assert shards.read_shards(spark, folder, uids=wanted).count() == 2
    got = shards.read_shards(spark, folder, uids=spark.createDataFrame([(u,) for u in wanted], "uid string"))
    assert got.columns == ["key", "uid", "txt", "jpg", "meta", "shard"] and got.count() == 2


def test_no_shards(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        shards.read_shards(spark, str(tmp_path))


def test_sizes(spark):
    webp = b"RIFF\0\0\0\0WEBPVP8X\x0a\0\0\0\0\0\0\0" + (99).to_bytes(3, "little") + (49).to_bytes(3, "little")
    cases = [(jpeg(640, 480), (640, 480)), (png(3, 4), (3, 4)), (b"GIF89a" + struct.pack("<HH", 5, 6), (5, 6)), (webp, (100, 50)), (b"", None), (None, None), (b"\xff\xd8\xff", None), (b"text", None)]
    assert [images.size_of(x) for x, _ in cases] == [y for _, y in cases]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, b binary")
    got = [tuple(r["s"]) for r in df.orderBy("i").select(images.size_column(F.col("b")).alias("s")).collect()]
    assert got == [y or (None, None) for _, y in cases]


def test_image_files(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(jpeg(30, 20))
    (tmp_path / "b.txt").write_bytes(b"none")
    got = {r["path"][-5:]: (r["width"], r["height"]) for r in images.read_images(spark, str(tmp_path)).collect()}
    assert got == {"a.jpg": (30, 20), "b.txt": (None, None)}


def test_npy(spark, tmp_path):
    given = [f"{(n * 0x9E3779B97F4A7C15F39CC0605CEDC835) % 2**128:032x}" for n in range(1, 500)]
    df = spark.createDataFrame([(u.upper() if i % 2 else u,) for i, u in enumerate(given)], "uid string").repartition(7)
    path = uids.save_uids(df, str(tmp_path))
    want = np.array(sorted((int(u[:16], 16), int(u[16:], 16)) for u in given), dtype=uids.DTYPE)
    got = np.load(path)
    assert got.dtype == uids.DTYPE and (got == want).all()
    assert uids.read_uids(path) == sorted(given)
    assert len(np.load(uids.save_uids(df.limit(0), str(tmp_path / "none")))) == 0
    with pytest.raises(Exception, match="not a 32-digit uid"):
        uids.save_uids(spark.createDataFrame([("unknown",)], "uid string"), str(tmp_path / "bad"))


def test_tar_writer(spark, folder, tmp_path):
    df = shards.read_shards(spark, folder).where("shard <> '9.tar'")
    out = str(tmp_path / "out")
    made = {r["shard"]: r["samples"] for r in files.write_shards(df, out, 4).collect()}
    assert made == {"00000000.tar": 4, "00000001.tar": 4, "00000002.tar": 4, "00000003.tar": 3}
    again = shards.read_shards(spark, out)
    assert sorted(map(tuple, again.drop("shard").collect())) == sorted(map(tuple, df.drop("shard").collect()))
    some = df.where("key < '000000000006'").select("uid")
    assert sum(r["samples"] for r in files.resharded(df, some, str(tmp_path / "sub"), 10).collect()) == 6
    assert [r["key"] for r in files.first_samples(df, 3).collect()] == [f"{i:012d}" for i in range(3)]


def test_text_files(spark, tmp_path):
    p = spark.createDataFrame([("B",), ("A_B",), ("B",)], "pattern string")
    files.save_patterns(p, str(tmp_path / "p"))
    assert sorted(r["pattern"] for r in tabular.read_lines(spark, str(tmp_path / "p")).collect()) == ["A_B", "B"]
    (tmp_path / "x.tsv").write_text("caption\turl\na \"q\" b\thttp://x\n\thttp://y\n")
    rows = tabular.read_tsv(spark, str(tmp_path / "x.tsv")).collect()
    assert (rows[0]["caption"], rows[0]["url"]) == ('a "q" b', "http://x") and len(rows) == 2
    a, b = spark.createDataFrame([(1, "x")], "k int, c string"), spark.createDataFrame([(2, 5)], "k int, d int")
    assert tabular.concatenated([a, b]).columns == ["k", "c", "d"]
    a.write.parquet(str(tmp_path / "a"))
    assert tabular.read_metadata(spark, str(tmp_path / "a"), ["k"]).columns == ["k"]
    assert tabular.described(spark, str(tmp_path / "a")).collect()[0]["type"] == "int"
    files.save_field(spark.createDataFrame([("a\nb",), (None,)], "c string"), "c", str(tmp_path / "f"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "f")).collect()) == ["", "a b"]


def test_download(spark):
    meta = spark.createDataFrame([(f"{i:032x}", f"u{i}", f"t{i}") for i in range(25)], "uid string, url string, text string")
    plan = download.planned(meta, per_shard=10)
    assert {r["shard_id"]: r["count"] for r in plan.groupBy("shard_id").count().collect()} == {0: 10, 1: 10, 2: 5}

    def fetch(url):
        if url == "u7":
            raise OSError("gone")
        return url.encode()

    got = {r["url"]: r for r in download.fetched(plan, fetch, retries=1, change=lambda b, r: b + b"!").collect()}
    assert bytes(got["u3"]["jpg"]) == b"u3!" and got["u7"]["status"] == "failed_to_download" and got["u7"]["error_message"] == "OSError: gone"
    assert download.blurred_boxes([[0.1, 0.2, 0.5, 2.0], [0.5, 0.5, 0.5, 0.9]], 100, 50) == [(10, 10, 50, 50)]


def test_stream(spark, folder, tmp_path):
    step = FilterStep("s").add("ok", lambda d: F.col("uid").startswith("0") & (F.length("txt") > 3))
    q = filtered_to(shard_stream(spark, folder), step, str(tmp_path / "o"), str(tmp_path / "c"))
    assert q.awaitTermination(120)
    want = {r["uid"] for r in step.plan(shards.read_shards(spark, folder)).collect()}
    assert {r["uid"] for r in spark.read.parquet(str(tmp_path / "o")).collect()} == want and want


def test_command_line(spark, folder, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"unimodal": {"lang_detection_score_threshold": 0.3}}))
    args = cli.arguments(["--shards-path", folder, "--output-folder", str(tmp_path / "o"), "--log-folder", str(tmp_path / "l"), "--config-path", str(tmp_path / "c.json")])
    conf = cli.settings.read_config(args.config_path)
    good = [f"{folder}/0000000{i}.tar" for i in range(3)]
    left = cli.run(spark, good, conf, args.log_folder, args.output_folder)
    ratios = {n for n in range(15) if 0.8 < (80 + 10 * (n % 5)) / 100 < 1.8}
    assert {r["uid"] for r in left.collect()} == {f"{n * 2**60:032x}" for n in ratios}
    assert len(np.load(tmp_path / "o" / "ok_uids.npy")) == len(ratios)
    found = json.loads(next((tmp_path / "l").glob("metrics_summary_vision_*.json")).read_text())
    assert found["filter_metrics"]["aspect_ratio"]["total_input"] == 15
