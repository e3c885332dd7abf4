from __future__ import annotations

import base64
import gzip
import hashlib
import shutil
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapforge.functions import crypto
from snapforge.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    shutil.rmtree(base, ignore_errors=True)


class Exports:
    """Writes encrypted export files and gives their manifest and key table."""

    def __init__(self, spark, root: Path, cipher: str = "ctr", codec: str = "gzip") -> None:
        self.spark, self.root, self.cipher, self.codec = spark, root, cipher, codec
        self.entries: list[tuple] = []
        self.keys: dict[str, str] = {}

    def write(self, files: dict[str, str | bytes], corrupt: tuple[str, ...] = ()) -> "Exports":
        pack = gzip.compress if self.codec == "gzip" else zlib.compress
        rows = []
        for name, content in files.items():
            data = content.encode() if isinstance(content, str) else content
            packed = b"not compressed at all" if name in corrupt else pack(data)
            digest = hashlib.sha256(name.encode()).digest()
            rows.append((name, bytearray(packed), bytearray(digest[:16]), bytearray(digest[16:])))
        frame = self.spark.createDataFrame(rows, "name string, data binary, iv binary, key binary")
        started = crypto.with_start(frame, self.cipher, "iv", "key")
        sealed = crypto.ctr_transform(F.col("data"), F.col("key"), F.col("start"))
        for row in started.withColumn("sealed", sealed).collect():
            target = self.root / row["name"]
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(row["sealed"])
            sealed_key = f"sealed:{row['name']}"
            self.entries.append((str(target), base64.b64encode(row["iv"]).decode(), sealed_key, "master-1"))
            self.keys[sealed_key] = base64.b64encode(row["key"]).decode()
        return self

    @property
    def manifest(self):
        return self.spark.createDataFrame(self.entries, "path string, iv string, ciphertext string, key_id string")

    @property
    def key_table(self):
        return self.spark.createDataFrame(list(self.keys.items()), "ciphertext string, plain_key string")


@pytest.fixture
def exports(spark, tmp_path):
    def make(cipher: str = "ctr", codec: str = "gzip", folder: str = "in") -> Exports:
        return Exports(spark, tmp_path / folder, cipher, codec)

    return make
