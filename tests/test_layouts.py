import io
import json
import tarfile
import zipfile

import pytest
from conftest import rows

from corpusframe import LoadSpec, list_files, load, manifest_of
from corpusframe.operators.locate import missing_folders
from corpusframe.sources.archives import archive_members, safe_member
from corpusframe.sources.files import file_digests, glob_regex

TWO = {"p": {"source_column": "path"}, "t": {"source_column": "sentence"}}


def spec(task, **more):
    return LoadSpec.from_dict({"dataset_id": "d", "task": task, **more})


def test_multi_split(spark, tree):
    line = "path\tsentence\n{0}.mp3\t{0}\n"
    root = tree({f"cv/{n}.tsv": line.format(n) for n in ("train", "dev", "test", "other")})
    tree({"cv/old/train.tsv": line.format("older")})
    out = load(spark, spec("ASR", root_strategy="multi_split", splits=["train", "dev", "none"], columns=TWO), root)
    assert rows(out) == [{"p": f"{n}.mp3", "t": n, "split": n} for n in ("dev", "train")]
    with pytest.raises(FileNotFoundError):
        load(spark, spec("ASR", root_strategy="multi_split", splits=["none"], columns=TWO), root)
    with pytest.raises(ValueError):
        load(spark, spec("ASR", root_strategy="multi_split", columns=TWO), root)


def test_multi_split_raw_unions_by_name_and_overwrites_split(spark, tree):
    root = tree({"train.csv": "path,split\na,x\n", "dev.csv": "path,extra\nb,7\n"})
    out = load(spark, spec("ASR", root_strategy="multi_split", splits=["train", "dev"], splits_file_pattern="*.csv"), root)
    assert out.columns == ["path", "extra", "split"]
    assert rows(out) == [
        {"path": "a", "extra": None, "split": "train"},
        {"path": "b", "extra": "7", "split": "dev"},
    ]
    mapped = {"p": {"source_column": "path"}, "s": {"source_column": "split"}}
    out = load(spark, spec("ASR", root_strategy="multi_split", splits=["train", "dev"],
                           splits_file_pattern="*.csv", columns=mapped), root)
    assert rows(out) == [{"p": "a", "s": "train", "split": "train"}, {"p": "b", "s": "dev", "split": "dev"}]


def test_multi_sections(spark, tree):
    root = tree({f"dataset/{s}/metadata.tsv": f"audio\ttext\n{s}.wav\t{s}\n" for s in ("General", "Chat", "Other")})
    s = spec("TTS", root_strategy="multi_sections", section_root="dataset", index_file="metadata.tsv",
             sections=["General", "Chat"], columns=TWO)
    out = load(spark, s, root)
    assert out.columns == ["audio", "text", "section"]
    assert [r.section for r in out.collect()] == ["General", "Chat"]
    with pytest.raises(FileNotFoundError):
        load(spark, spec("TTS", root_strategy="multi_sections", section_root="dataset",
                         index_file="metadata.tsv", sections=["General", "No"]), root)


def test_paired_text(spark, tree):
    files = {f"{d}/{i:03}.txt": f"  {d} {i}\n" for d in ("General", "Chat") for i in range(3)}
    files |= {n.replace(".txt", ".webm"): "" for n in files if n != "Chat/002.txt"}
    root = tree({**files, "General/[1] 100%.txt": "odd", "General/[1] 100%.webm": ""})
    s = spec("TTS", root_strategy="paired_glob", file_pattern="**/*.txt", audio_extension="webm")
    out = rows(load(spark, s, root))
    assert len(out) == 6
    assert {"audio_path": f"{root}/Chat/001.webm", "transcription": "Chat 1", "split": "Chat"} in out
    assert {"audio_path": f"{root}/General/[1] 100%.webm", "transcription": "odd", "split": "General"} in out
    with pytest.raises(FileNotFoundError):
        load(spark, spec("TTS", root_strategy="paired_glob", file_pattern="*.txt", audio_extension=".ogg"), root)


DOC = {
    "call": {"media": "desk-4.webm", "seconds": 12.5, "labels": ["x", "y"]},
    "office": {"floor": "third", "desk": 7},
    "dotted.name": "as it is",
    "voice": "of the record",
    "turns": [
        {"ref": "q1", "voice": "v1", "said": "which floor", "at": {"from": 0.5}},
        {"ref": "q2", "voice": "v2", "said": "the third", "at": {"from": 1}},
    ],
}
JSON_COLUMNS = {
    "audio_path": {"source_column": "call.media", "dtype": "file_path", "path_match_strategy": "exact"},
    "ref": {"source_column": "ref"},
    "said": {"source_column": "said"},
    "start": {"source_column": "at.from", "dtype": "float"},
    "voice": {"source_column": "voice"},
    "flat": {"source_column": "dotted.name"},
    "desk": {"source_column": "office.desk", "dtype": "int"},
    "labels": {"source_column": "call.labels"},
    "age": {"source_column": "office.age", "optional": True},
}


def test_paired_json_records(spark, tree):
    other = {**DOC, "turns": []}
    root = tree({"a/desk4.call.json": json.dumps(DOC), "a/b[1].call.json": json.dumps(other),
                 "a/._desk4.call.json": "junk", "a/desk-4.webm": ""})
    more = dict(format="json", root_strategy="paired_glob", file_pattern="**/*.call.json", record_path="turns")
    out = load(spark, spec("ASR", columns=JSON_COLUMNS, **more), root)
    assert out.columns == [c for c in JSON_COLUMNS if c != "age"]
    assert rows(out, "ref")[0] == {
        "audio_path": f"{root}/a/desk-4.webm", "ref": "q1", "said": "which floor", "start": 0.5,
        "voice": "of the record", "flat": "as it is", "desk": 7, "labels": '["x","y"]',
    }
    assert out.count() == 2
    required = {**JSON_COLUMNS, "age": {"source_column": "office.age"}}
    with pytest.raises(KeyError, match="office.age"):
        load(spark, spec("ASR", columns=required, **more), root)
    tree({"a/z.call.json": json.dumps({"call": {"media": "desk-4.webm"}})})
    with pytest.raises(Exception, match="record_path 'turns' not found"):
        load(spark, spec("ASR", columns=JSON_COLUMNS, **more), root).collect()


def test_paired_json_without_records(spark, tree):
    root = tree({"one.json": json.dumps(DOC), "two.json": json.dumps([{"Id": 1, "id": 2}, {"Id": 3, "id": 4}])})
    columns = {"g": {"source_column": "office.floor"}, "i": {"source_column": "Id"}, "j": {"source_column": "id"}}
    out = load(spark, spec("ASR", format="json", root_strategy="paired_glob", file_pattern="*.json", columns=columns), root)
    assert rows(out, "i") == [
        {"g": None, "i": "1", "j": "2"}, {"g": None, "i": "3", "j": "4"}, {"g": "third", "i": None, "j": None},
    ]
    with pytest.raises(ValueError, match="json"):
        load(spark, spec("ASR", root_strategy="paired_glob", file_pattern="*.json", columns=columns), root)


def test_glob_layout_with_and_without_splits(spark, tree):
    root = tree({"train/spk1/en/a.wav": "", "train/spk2/fr/b.wav": "", "dev/spk1/en/c.wav": "",
                 "dev/spk1/en/._c.wav": "", "dev/spk1/en/c.txt": ""})
    out = rows(load(spark, spec("OTH", root_strategy="glob", file_pattern="**/*.wav"), root))
    assert out[0] == {"audio_path": f"{root}/dev/spk1/en/c.wav", "language": "en", "speaker_id": "spk1"}
    assert len(out) == 3
    out = rows(load(spark, spec("OTH", root_strategy="glob", file_pattern="*.wav", splits=["train"]), root))
    assert [(r["speaker_id"], r["split"]) for r in out] == [("spk1", "train"), ("spk2", "train")]
    with pytest.raises(FileNotFoundError, match="none"):
        load(spark, spec("OTH", root_strategy="glob", file_pattern="*.wav", splits=["train", "none"]), root)
    files = manifest_of(list_files(spark, root), root)
    assert rows(missing_folders(files, ["train", "none"])) == [{"folder": "none"}]


def test_listing_keeps_hidden_names_and_takes_single_files(spark, tree):
    root = tree({"_x/.h/a.wav": "1", "b c%20.wav": "22", "d/e": ""})
    listed = rows(list_files(spark, [root, f"{root}/none"]).select("path", "length"))
    assert [(r["path"].removeprefix(root), r["length"]) for r in listed] == [("/_x/.h/a.wav", 1), ("/b c%20.wav", 2), ("/d/e", 0)]
    assert rows(list_files(spark, f"{root}/d/e").select("path")) == [{"path": f"{root}/d/e"}]


def _tar(files, mode):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as tar:
        for name, content in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))
    return out.getvalue()


def _zip(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as packed:
        for name, content in files.items():
            packed.writestr(name, content)
    return out.getvalue()


def test_archive_members_of_every_kind(spark, tree):
    files = {"s/en/a.txt": b"text", "s/en/a.wav": b"12345"}
    root = tree({"a.tar.gz": _tar(files, "w:gz"), "b.zip": _zip(files), "c.tar": _tar(files, "w")})
    out = rows(archive_members(list_files(spark, root), r"\.txt$"), "archive", "member")
    assert [(r["archive"].rsplit("/")[-1], r["member"], r["length"], r["content"]) for r in out] == [
        (a, m, n, c)
        for a in ("a.tar.gz", "b.zip", "c.tar")
        for m, n, c in (("s/en/a.txt", 4, b"text"), ("s/en/a.wav", 5, None))
    ]


def test_members_outside_the_target(spark, tree):
    root = tree({"a.tgz": _tar({"../x.txt": b"", "ok.txt": b"1"}, "w:gz")})
    archives = list_files(spark, root)
    with pytest.raises(Exception, match="outside"):
        archive_members(archives).collect()
    assert [r.member for r in archive_members(archives, on_error="null").collect()] == ["ok.txt"]
    assert safe_member("/a/./b", zipped=False) == "a/b"
    assert safe_member("../a/b", zipped=True) == "a/b"


def test_load_from_inner_archives(spark, tree):
    index = b"path\tsentence\nx\thello\n"
    root = tree({
        "data/Train.tar.gz": _tar({"train.tsv": index, "clips/x.wav": b"RIFF"}, "w:gz"),
        "data/Dev.zip": _zip({"dev.tsv": index.replace(b"x\t", b"y\t"), "clips/y.wav": b"RIFF"}),
    })
    columns = {"p": {"source_column": "path", "dtype": "file_path", "path_match_strategy": "exact"},
               "t": {"source_column": "sentence"}}
    s = spec("ASR", root_strategy="multi_split", splits=["train", "dev"], columns=columns,
             extract_files=["data/Train.tar.gz", "Dev.zip"])
    assert rows(load(spark, s, root)) == [
        {"p": f"{root}/data/clips/x.wav", "t": "hello", "split": "train"},
        {"p": f"{root}/data/clips/y.wav", "t": "hello", "split": "dev"},
    ]
    with pytest.raises(FileNotFoundError, match="Gone"):
        load(spark, spec("OTH", index_file="x.csv", extract_files=["Gone.zip"]), root)


def test_paired_text_inside_an_archive(spark, tree):
    packed = _tar({"en/1.txt": b" hi ", "en/1.webm": b"x", "en/2.txt": b"alone"}, "w:gz")
    root = tree({"in.tar.gz": packed})
    s = spec("TTS", root_strategy="paired_glob", file_pattern="**/*.txt", audio_extension=".webm", extract_files=["in.tar.gz"])
    assert rows(load(spark, s, root)) == [{"audio_path": f"{root}/en/1.webm", "transcription": "hi", "split": "en"}]


def test_digest_of_files(spark, tree):
    import hashlib

    root = tree({"a": "x" * 100, "b": ""})
    out = rows(file_digests(list_files(spark, root)))
    assert [(r["bytes_read"], r["sha256"]) for r in out] == [
        (100, hashlib.sha256(b"x" * 100).hexdigest()), (0, hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("pattern,path,hit", [
    ("**/*.txt", "a.txt", True), ("**/*.txt", "x/y/a.txt", True), ("*.txt", "x/a.txt", True),
    ("x/*.txt", "w/x/a.txt", True), ("x/*.txt", "x/y/a.txt", False), ("a?.[tj]*", "ab.txt", True),
    ("a[!b].txt", "ab.txt", False), ("a.b", "aXb", False), ("x/**/a", "x/a", True), ("x/**/a", "x/1/2/a", True),
])
def test_glob_regex(pattern, path, hit):
    import re

    assert bool(re.match(glob_regex(pattern), path)) is hit


def test_index_with_quoted_line_breaks_keeps_its_records_at_small_splits(spark, tree):
    import csv
    import random

    from corpusframe.sources.delimited import read_index

    rng = random.Random(7)
    alphabet = ["a", "ü", '"', "\n", ",", " ", "x\ny", '""', "5\" disk"]
    data = [[str(i)] + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))).strip(" ") for _ in range(2)] for i in range(3000)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["id", "one", "two"], *data])
    body = out.getvalue().replace("7,", '7, ', 1) + 'last,5" x,"y\nz"\n'
    root = tree({"m.csv": body})
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        frame = read_index(spark, f"{root}/m.csv", spec("OTH", index_file="m.csv"))
        found = sorted(tuple(r) for r in frame.rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    null = lambda v: v if v not in ("",) else None
    expected = sorted([tuple(null(v) for v in r) for r in data] + [("last", '5" x', "y\nz")],)
    key = lambda r: [v or "" for v in r]
    assert sorted(found, key=key) == sorted(expected, key=key)
