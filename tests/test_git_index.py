import struct
import subprocess

import pytest

from tessera.sources.git_index import index_paths, list_files, mark_tracked
from tessera.sources.repository import read_repository


def entry(name, flags=0):
    raw = b"\0" * 60 + struct.pack(">H", flags | min(len(name), 0xFFF)) + (b"\0\0" if flags & 0x4000 else b"") + name
    return raw + b"\0" * (8 - len(raw) % 8)


def test_format():
    body = entry(b"a.py") + entry("ü/b.py".encode()) + entry(b"c", 0x4000) + entry(b"x" * 5000) + entry(b"x" * 5000)
    assert index_paths(b"DIRC" + struct.pack(">II", 3, 5) + body + b"\0" * 20) == ["a.py", "ü/b.py", "c", "x" * 5000]
    for bad in (b"", b"DIRC", b"XXXX" + struct.pack(">II", 2, 0), b"DIRC" + struct.pack(">II", 4, 0), b"DIRC" + struct.pack(">II", 2, 3)):
        assert index_paths(bad) is None
    assert index_paths(b"DIRC" + struct.pack(">II", 2, 0)) == []


def test_tracked_files(spark, tmp_path):
    for name in ("a.py", "sub dir/b.md", "untracked.txt"):
        f = tmp_path / name
        f.parent.mkdir(exist_ok=True)
        f.write_text("x\n")
    files = read_repository(spark, str(tmp_path), "demo")
    assert {r.path for r in list_files(spark, files, str(tmp_path)).collect()} == {"a.py", "sub dir/b.md", "untracked.txt"}
    try:
        subprocess.run(["git", "init", "-q"], cwd=tmp_path, check=True)
    except (OSError, subprocess.CalledProcessError):
        pytest.skip("no git")
    subprocess.run(["git", "add", "a.py", "sub dir/b.md"], cwd=tmp_path, check=True)
    files = read_repository(spark, str(tmp_path), "demo")
    assert {r.path: r.git_tracked for r in mark_tracked(spark, files, str(tmp_path)).collect()} == {"a.py": True, "sub dir/b.md": True, "untracked.txt": False}
    assert {r.path for r in list_files(spark, files, str(tmp_path)).collect()} == {"a.py", "sub dir/b.md"}
