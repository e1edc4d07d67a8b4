import io
import json
import zipfile

import pytest

from tidemark.sinks import files as sinks
from tidemark.sources import archives, files


def test_archive_round_trip(tmp_path):
    archive = tmp_path / "a.zip"
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("data.csv", "a,b\n1,2\n")
    assert archives.inspect_zip(archive)[0]["filename"] == "data.csv"
    got = archives.extract_member(archive, "data.csv", tmp_path / "out.csv", chunk_bytes=3)
    assert got["bytes"] == 8 and got["sha256"] == archives.sha256_of(tmp_path / "out.csv")
    with pytest.raises(FileExistsError):
        archives.extract_member(archive, "data.csv", tmp_path / "out.csv")
    said = {"archive_filename": "a.zip", "compressed_bytes": archive.stat().st_size, "sha256": archives.sha256_of(archive), "archive_members": []}
    archives.verify_archive(archive, said)
    with pytest.raises(ValueError, match="SHA-256"):
        archives.verify_archive(archive, said | {"sha256": "0"})
    (tmp_path / "m.json").write_text(json.dumps({"sha256": "x"}))
    with pytest.raises(ValueError, match="lacks"):
        archives.load_metadata(tmp_path / "m.json")


@pytest.mark.parametrize("name", ["../x", "/x", "a/../../x", "C:\\x", "..\\x"])
def test_unsafe_members(name):
    with pytest.raises(ValueError):
        archives.check_member_name(name)


def test_guards(tmp_path):
    (tmp_path / "no.zip").write_bytes(b"no")
    with pytest.raises(ValueError):
        archives.inspect_zip(tmp_path / "no.zip")
    with pytest.raises(ValueError):
        archives.check_free_space(tmp_path, 1, 1)
    with pytest.raises(ValueError):
        archives.copied(io.BytesIO(b"x"), tmp_path / "t", 0)


def test_download_is_checked(tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("d.csv", "x")
    body = data.getvalue()

    class Response(io.BytesIO):
        status = 200
        headers = {"Content-Type": "application/zip", "Content-Length": str(len(body))}

    got = archives.acquire("http://example.org/d.zip", tmp_path / "d.zip", tmp_path / "m.json", len(body), open_url=lambda *_, **__: Response(body))
    assert got["archive_members"][0]["filename"] == "d.csv" and archives.load_metadata(tmp_path / "m.json")["sha256"] == got["sha256"]
    with pytest.raises(ValueError):
        archives.acquire("http://example.org/d.zip", tmp_path / "e.zip", tmp_path / "n.json", 1, open_url=lambda *_, **__: Response(body))
    assert not list(tmp_path.glob("*.part"))


def test_csv_source(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('\ufeffid,text,label\n1,"a ""quoted"", line\nbreak",NA\n2,,b\n', encoding="utf-8")
    got = files.read_csv(spark, str(path), ["id", "text", "label"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("1", 'a "quoted", line\nbreak', None), ("2", None, "b")]
    with pytest.raises(ValueError, match="missing"):
        files.read_csv(spark, str(path), ["missing"])
    assert files.text_format(str(path))["has_bom"]
    with pytest.raises(ValueError):
        files.text_format(str(path), delimiter=";")
    with pytest.raises(ValueError, match="without text"):
        files.load_split(files.read_csv(spark, str(path)), "text", "label")


def test_sinks(spark, tmp_path):
    df = spark.range(3)
    sinks.write_csv(df.limit(0), str(tmp_path / "empty"))
    assert files.csv_columns(spark, str(tmp_path / "empty")) == ["id"]
    df.createOrReplaceTempView("vw_numbers")
    got = sinks.export_views(spark, {"vw_numbers": "n.csv"}, str(tmp_path / "out"))[0]
    assert got["rows"] == 3 and (tmp_path / "out/n.csv").read_text().split() == ["id", "0", "1", "2"]
    with pytest.raises(FileExistsError):
        sinks.write_json({}, str(tmp_path / "out/n.csv"))
    sinks.write_json({"a": 1}, str(tmp_path / "r.json"))
    assert files.read_json(str(tmp_path / "r.json")) == {"a": 1}


def test_config(tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_config(str(tmp_path / "no.yaml"))
    (tmp_path / "bad.yaml").write_text("- 1\n")
    with pytest.raises(ValueError):
        files.load_config(str(tmp_path / "bad.yaml"))
    (tmp_path / "ok.yaml").write_text("a: 1\n")
    assert files.load_config(str(tmp_path / "ok.yaml")) == {"a": 1}
