import io
import os
import random
import tarfile
import zipfile

import pandas as pd
import pytest

from corpusframe import list_files
from corpusframe.sources import archives, storage
from corpusframe.sources.archives import archive_members, fetch_members, member_index


def body(k):
    rng = random.Random(k)
    return bytes(rng.choices(b"abcdefgh \n", k=rng.randint(0, 300)))


@pytest.fixture()
def packs(tmp_path):
    """Archives of each kind, and what they hold."""
    held = {}
    for name, method in (("d.zip", zipfile.ZIP_DEFLATED), ("s.zip", zipfile.ZIP_STORED), ("b.zip", zipfile.ZIP_BZIP2), ("l.zip", zipfile.ZIP_LZMA)):
        with zipfile.ZipFile(tmp_path / name, "w", method) as out:
            for k in range(25):
                info = zipfile.ZipInfo(f"in/ä{k}.txt")
                info.compress_type, info.extra = method, b"\x99\x99\x04\x00abcd" * (k % 3)
                out.writestr(info, body(k))
                held[f"{tmp_path}/{name}", f"in/ä{k}.txt"] = body(k)
    with tarfile.open(tmp_path / "t.tar", "w") as out:
        for k in range(25):
            info = tarfile.TarInfo("long/" * 30 + f"{k}.txt")
            info.size = len(body(k))
            out.addfile(info, io.BytesIO(body(k)))
            held[f"{tmp_path}/t.tar", "long/" * 30 + f"{k}.txt"] = body(k)
    return str(tmp_path), held


def contents(df):
    return {(r.archive, r.member): None if r.content is None else bytes(r.content) for r in df.collect()}


def test_members_equal_what_was_packed(spark, packs, tmp_path_factory):
    root, held = packs
    files = list_files(spark, root)
    assert contents(archive_members(files, r"\.txt$")) == held
    assert contents(archive_members(files)) == dict.fromkeys(held)
    store = str(tmp_path_factory.mktemp("index") / "i")
    member_index(files).write.parquet(store)
    index = spark.read.parquet(store)
    some = index.filter("member like '%7.txt'")
    assert contents(fetch_members(some)) == {k: v for k, v in held.items() if k[1].endswith("7.txt")}
    assert fetch_members(index.limit(0)).count() == 0 and member_index(files.limit(0)).count() == 0


def test_changed_archives_are_noticed(spark, packs):
    root, _ = packs
    archive = f"{root}/s.zip"
    index = pd.DataFrame(archives._locate(archive), columns=[p.split()[0] for p in archives.LOCATED.split(", ")])
    row = index[index.length > 20].iloc[:1]
    raw = bytearray(open(archive, "rb").read())
    at = raw.find(body(0)[:20]) if len(body(0)) > 20 else int(row.place.iloc[0]) + 60
    raw[at + 3] ^= 1
    open(archive, "wb").write(raw)
    with pytest.raises(ValueError, match="damaged|listed"):
        list(archives._fetch(index))
    with pytest.raises(ValueError, match="no member where"):
        list(archives._fetch(row.assign(place=row.place + 1)))


def test_two_members_of_a_large_zip_read_only_their_ranges(tmp_path, monkeypatch):
    archive = str(tmp_path / "large.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for k in range(100_000):
            out.writestr(f"m{k}", b"x%d" % k if k % 50_000 else os.urandom(10_000))
    read = []

    class Counted(io.FileIO):
        def read(self, size=-1):
            found = super().read(size)
            read.append(len(found))
            return found

        def readinto(self, buffer):
            n = super().readinto(buffer)
            read.append(n)
            return n

    monkeypatch.setattr(storage, "open_binary", lambda path: Counted(path))
    index = pd.DataFrame(archives._locate(archive), columns=[p.split()[0] for p in archives.LOCATED.split(", ")])
    with zipfile.ZipFile(archive) as z:
        directory = os.path.getsize(archive) - z.start_dir
    assert len(index) == 100_000 and sum(read) <= directory + 200_000
    read.clear()
    found = list(archives._fetch(index[index.member.isin(["m0", "m77777"])]))
    assert [len(f[3]) for f in found] == [10_000, 6] and sum(read) <= 10_500
