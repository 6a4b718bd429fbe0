"""Manifests of files that no reader takes whole."""

import hashlib

from mapjobs.operators import manifest


def test_large_files_are_streamed(spark, tmp_path):
    (tmp_path / "a b" / "c").mkdir(parents=True)
    files = {"a b/c/lärge 100%.bin": b"x" * 5000 + "é".encode(), "small": b".", "a b/s#1": b"12345"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    want = {(name, len(data), hashlib.md5(data).hexdigest()) for name, data in files.items()}
    for whole in (manifest.WHOLE, 100, 0):
        assert set(map(tuple, manifest.read_manifest(spark, str(tmp_path), whole=whole).collect())) == want


def test_files_beyond_two_gigabytes(spark, tmp_path):
    with (tmp_path / "holes").open("wb") as f:
        f.truncate((1 << 31) + 7)  # takes no room on the disk
    found = hashlib.md5()
    for _ in range(1 << 8):
        found.update(bytes(1 << 23))
    found.update(bytes(7))
    assert [tuple(r) for r in manifest.read_manifest(spark, str(tmp_path)).collect()] == [("holes", (1 << 31) + 7, found.hexdigest())]
