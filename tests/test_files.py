"""Files that one writer creates as a whole, on a local path and through a file system that only Hadoop opens."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import threading

import pytest

from tidemark.errors import StoreError
from tidemark.sources.files import Files, place_of
from tidemark.sources.store import Store


@pytest.fixture(params=["local", "hadoop"])
def files(spark, tmp_path, request):
    if request.param == "local":
        return Files(spark, str(tmp_path))
    name = f"store{abs(hash(tmp_path))}"
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{name}.link./in", f"file://{tmp_path}")
    return Files(spark, f"viewfs://{name}/in/store")


def test_created_once_and_whole(files, tmp_path):
    assert files.read("log/1.json") is None and files.names("log") == []
    assert files.create("log/1.json", "one é") and not files.create("log/1.json", "two") and files.read("log/1.json") == "one é"
    assert files.create("log/_empty", "") and files.read("log/_empty") == ""
    assert files.names("log") == ["1.json", "_empty"]
    assert not [n for _, _, names in os.walk(tmp_path) for n in names if n.endswith(".tmp")]


def test_one_of_many_writers(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    won: list[int] = []

    def write(k: int) -> None:
        if files.create("log/7.json", json.dumps({"writer": k})):
            won.append(k)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and json.loads(files.read("log/7.json")) == {"writer": won[0]}


def test_a_writer_that_dies_before_it_publishes(spark, files, tmp_path, monkeypatch):
    """The draft is there, the name is not: nobody reads it, and the next writer gets the name."""

    def die(*_: object, **__: object) -> None:
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(os, "link", die)
        patch.setattr(os, "unlink", lambda _: None)
        patch.setattr(Files, "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            files.create("log/1.json", "never")
    if files.local:
        assert any(n.endswith(".tmp") for n in os.listdir(f"{files.local}/log"))
    else:
        fs, path = files._hadoop("log/1.json.0.tmp")
        fs.create(path, False).close()
    assert files.names("log") == [] and files.read("log/1.json") is None
    assert files.create("log/1.json", "mine") and files.read("log/1.json") == "mine" and files.names("log") == ["1.json"]


def test_roots():
    for root in ("/data/raw", "file:/data/raw", "file:///data/raw/", "file:////data/raw", "FILE:/data/x/../raw", "/data//raw/"):
        assert place_of(root) == ("file:///data/raw", "/data/raw")
    assert place_of("hdfs://n:8020/data/raw/") == ("hdfs://n:8020/data/raw", None)
    for root in ("data/raw", "./x", "file:data", "", "s3a://bucket/x", "gs://b/x"):
        with pytest.raises(StoreError):
            place_of(root)


def test_one_store_from_two_folders(spark, tmp_path):
    """Whatever folder a process works in and however it writes the root, it opens the same store."""
    one = Store(spark, f"file:{tmp_path}/raw")
    one.bootstrap()
    code = f"import os; os.chdir({str(tmp_path)!r}); from tidemark.sources.files import Files; f = Files(None, 'file://{tmp_path}/raw'); print(f.read('_schema.json') is not None, sorted(os.listdir('.')))"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))})
    assert said.stdout.strip() == "True ['raw']", said.stderr
    assert Store(spark, f"{tmp_path}/raw").bootstrap() == one.bootstrap()
