import pytest
from pyspark.sql import functions as F

from corpusframe import load
from corpusframe.plans import datasource
from corpusframe.sources.files import scan_manifest
from corpusframe.spec import SpecError

SPEC = {"dataset_id": "d", "task": "OTH", "root_strategy": "glob", "file_pattern": "**/*"}
FILES = {
    "train/anna/de/1.wav": b"one",
    "train/anna/de/2.txt": b"two",
    "train/bo b/fr/3.wav": b"",
    "train/bo b/fr/no_extension": b"four",
    "dev/cy/de/5.wav": b"f\0ve",
    "dev/cy/de/._5.wav": b"companion",
    "a=b%/dora/é/6.wav": b"six",
}


@pytest.fixture()
def prepared(spark, tree, tmp_path_factory):
    datasource.register_source(spark)

    def make(**more):
        target = str(tmp_path_factory.mktemp("prepared") / "list")
        root = tree(FILES)
        spec = {**SPEC, **more}
        datasource.prepare(spark, spec, root, target)
        return root, spec, target

    return make


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rows_are_those_of_load(spark, prepared):
    root, spec, target = prepared(splits=["train", "dev", "a=b%"])
    want = load(spark, spec, root)
    assert rows(spark.read.format("corpus").load(target).select(*want.columns)) == rows(want)
    root, spec, target = prepared()
    got = spark.read.format("corpus").load(target)
    want = load(spark, spec, root)
    assert rows(got.select(*want.columns)) == rows(want)
    assert got.filter("split is not null").count() == 0
    sizes = scan_manifest(spark, root).filter("name not like '._%'")
    assert rows(got.select("audio_path", "length", "modified")) == rows(sizes.select("path", "length", "modified"))


def test_content_is_read_where_the_schema_names_it(spark, prepared, monkeypatch):
    root, _, target = prepared()
    got = spark.read.format("corpus").schema("content binary, audio_path string").load(target).collect()
    assert {r.audio_path: bytes(r.content) for r in got} == {f"{root}/{p}": c for p, c in FILES.items() if "._" not in p}
    with pytest.raises(Exception, match="of another type"):
        spark.read.format("corpus").schema("audio_path int").load(target).collect()


def test_long_batches_are_cut(spark, prepared, monkeypatch):
    monkeypatch.setattr(datasource, "BATCH_ROWS", 2)
    monkeypatch.setattr(datasource, "BATCH_BYTES", 4)
    root, _, target = prepared()
    reader = datasource.CorpusFiles({"path": target}).reader(datasource.T.StructType.fromDDL("name string, content binary"))
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert max(map(len, batches)) <= 2
    assert sorted(v for b in batches for v in b.column("content").to_pylist()) == sorted(c for p, c in FILES.items() if "._" not in p)


def test_options_leave_out_parts(spark, prepared):
    _, _, target = prepared(splits=["train", "dev", "a=b%"])

    def names(**options):
        return sorted(r.name for r in datasource.read_files(spark, target, ["name"], **options).collect())

    def parts(**options):
        return datasource.read_files(spark, target, ["name"], **options).rdd.getNumPartitions()

    assert names(splits=["dev"], extensions=[".wav"]) == ["5.wav"]
    assert parts(splits=["dev"], extensions=[".wav"]) == 1 < parts(extensions=[".wav"]) < parts()
    assert names(splits=["a=b%", "absent"]) == ["6.wav"]
    assert names(extensions=[""]) == ["no_extension"] and parts(extensions=[""]) == 1
    assert names(splits=["absent"]) == names(splits=[]) == []


def test_filters_of_one_query_do_not_reach_the_next(spark, prepared):
    _, _, target = prepared(splits=["train", "dev", "a=b%"])
    whole = spark.read.format("corpus").load(target)
    dev = whole.filter("split = 'dev'")
    assert dev.count() == 1
    assert whole.count() == 6
    assert dev.union(whole.filter("split = 'train'")).count() == 5
    assert dev.join(whole.select("name"), "name").count() == 1
    assert [r.name for r in whole.filter("ext = ''").collect()] == ["no_extension"]


def test_unfinished_lists_and_other_layouts_are_errors(spark, prepared, tmp_path):
    root, spec, target = prepared()
    (tmp_path / "half").mkdir()
    with pytest.raises(Exception, match="no complete list"):
        spark.read.format("corpus").load(str(tmp_path / "half")).collect()
    with pytest.raises(SpecError):
        datasource.prepare(spark, {**SPEC, "root_strategy": None, "index_file": "a.tsv"}, root, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        datasource.prepare(spark, {**SPEC, "file_pattern": "*.none"}, root, str(tmp_path / "u"))
