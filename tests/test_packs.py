"""The pack source and sink: guards, two phases, refused packs."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from spanframe.sources import packs, typed_packs


def rows(spark, packs_=("a", "b"), n=3):
    data = [(p, f"m{m}", k, f"{p}{m}{k}\n".encode()) for p in packs_ for m in range(2) for k in range(n)]
    return spark.createDataFrame(data, "pack string, member string, at int, content binary").repartition(3)


def test_round_trip_and_equal_bytes(spark, tmp_path):
    packs.write_packs(rows(spark), str(tmp_path / "x"), ["at"])
    packs.write_packs(rows(spark).repartition(5), str(tmp_path / "y"), ["at"])
    assert sorted(os.listdir(tmp_path / "x")) == ["a.zip", "b.zip"]
    assert all((tmp_path / "x" / n).read_bytes() == (tmp_path / "y" / n).read_bytes() for n in ("a.zip", "b.zip"))
    got = {(os.path.basename(r["path"]), r["member"]): bytes(r["content"]) for r in packs.open_packs(spark, str(tmp_path / "x")).collect()}
    assert got == {(f"{p}.zip", f"m{m}"): b"".join(f"{p}{m}{k}\n".encode() for k in range(3)) for p in "ab" for m in range(2)}
    assert packs.open_packs(spark, f"file://{tmp_path}/x").count() == 4
    with pytest.raises(Exception, match="read_packs"):
        packs.open_packs(spark, "hdfs://x/y").count()


def test_a_failed_task_leaves_no_pack(spark, tmp_path):
    at = str(tmp_path / "out")
    many = rows(spark, [f"p{k}" for k in range(8)])
    fails = F.when((F.col("pack") == "p5") & (F.col("at") == 2), F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.col("content"))
    with pytest.raises(Exception, match="broken"):
        packs.write_packs(many.withColumn("content", fails), at, ["at"])
    assert not os.path.exists(at) or os.listdir(at) == []
    with pytest.raises(Exception, match="guard"):
        packs.write_packs(many, at, ["at"], member_bytes=5)
    assert not os.path.exists(at) or os.listdir(at) == []
    packs.write_packs(many.filter("pack < 'p3'"), at, ["at"])
    before = sorted(os.listdir(at))
    with pytest.raises(Exception, match="already"):  # nothing is overwritten, nothing new appears
        packs.write_packs(many, at, ["at"])
    assert sorted(os.listdir(at)) == before == ["p0.zip", "p1.zip", "p2.zip"]


def test_refused_packs(spark, tmp_path):
    packs.write_packs(rows(spark), str(tmp_path), ["at"])
    good = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "broken.zip").write_bytes(good[:-30])
    with zipfile.ZipFile(tmp_path / "bomb.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x", b"0" * (2 << 20))
    with zipfile.ZipFile(tmp_path / "path.zip", "w") as z:
        z.writestr("../x", b"0")
    with zipfile.ZipFile(tmp_path / "flipped.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("x", b"some content of the member")
    flipped = bytearray((tmp_path / "flipped.zip").read_bytes())
    flipped[40] ^= 1
    (tmp_path / "flipped.zip").write_bytes(bytes(flipped))
    found = packs.open_packs(spark, str(tmp_path)).collect()
    bad = {os.path.basename(r["path"]): r["problem"] for r in found if r["problem"]}
    assert set(bad) == {"broken.zip", "bomb.zip", "path.zip", "flipped.zip"} and "tightly" in bad["bomb.zip"] and "CRC" in bad["flipped.zip"]
    assert sum(r["problem"] is None for r in found) == 4
    assert {os.path.basename(r["path"]) for r in packs.open_packs(spark, str(tmp_path), members=1).filter("problem IS NOT NULL").collect()} >= {"a.zip", "b.zip"}


def test_corrections_of_a_refused_pack(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("/x", b"0")
    with zipfile.ZipFile(tmp_path / "q.zip", "w") as z:
        z.writestr("manifest.json", b'{"format": NaN}')
    found = typed_packs.read_corrections(packs.open_packs(spark, str(tmp_path)))
    got = {(os.path.basename(r["path"]), r["code"]) for r in found["issues"].collect()}
    assert got == {("p.zip", "refused"), ("q.zip", "manifest_fields")}
    assert all(found[n].count() == 0 for n in ("manifests", "utterances", "holes", "candidates"))


def test_returns_without_pack_or_report(spark, tmp_path):
    line = b'{"note":null,"review_required":false,"target":"t","uid":"u1"}\n'
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("translated_batch_001.jsonl", line + line + b'{"uid": 1}\n')
    sent = spark.createDataFrame([(str(tmp_path / "p.zip"), 1, 1, "u1"), (str(tmp_path / "p.zip"), 2, 1, "u2"), (str(tmp_path / "gone.zip"), 1, 1, "u3")], "path string, batch bigint, position int, uid string")
    found = typed_packs.read_returns(packs.open_packs(spark, str(tmp_path)), sent)
    got = {(os.path.basename(r["path"]), r["member"], r["code"]) for r in found["issues"].collect()}
    first = "translated_batch_001.jsonl"
    assert got == {("gone.zip", None, "no_pack"), ("p.zip", "translation_report.json", "missing"), ("p.zip", "translated_batch_002.jsonl", "missing"), ("p.zip", first, "bad_line"), ("p.zip", first, "double_uid"), ("p.zip", first, "extra_record")}
    assert found["records"].filter("problem IS NULL").count() == 2


def test_clips_are_wav(spark):
    import io
    import wave

    clip = bytes(spark.range(1).select(typed_packs.wav(F.lit(100), F.lit(350)).alias("c")).first()["c"])
    with wave.open(io.BytesIO(clip)) as w:
        assert (w.getnchannels(), w.getsampwidth(), w.getframerate(), w.getnframes()) == (1, 2, 16_000, 4000)
