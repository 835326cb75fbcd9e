import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corpusframe import LoadSpec, manifest_of
from corpusframe.functions import paths as P, sizes as S, text as X
from corpusframe.operators import ledger as L, quality as Q
from corpusframe.operators.json_records import redact_json, tolerant_records
from corpusframe.operators.mapping import Corpus, map_columns
from corpusframe.operators.splits import split_views, write_splits
from corpusframe.streaming.ingest import loaded_so_far, stream_index, stream_sidecars

COMPLETE = {
    "name": "n", "longDescription": "d", "task": "ASR", "locale": "en", "format": "TSV", "restrictions": "r",
    "forbiddenUsage": "f", "pointOfContactFullName": "p", "pointOfContactEmail": "e", "showContactInfo": True,
    "visibility": "public", "licenseAbbreviation": "CC-BY-4.0", "agreeToSubmit": True, "fileUploadId": "u",
}


def submission(spark, **fields):
    types = ", ".join(f"`{k}` {Q.field_type(k) if k in Q.all_fields() else 'string'}" for k in fields)
    return spark.createDataFrame([tuple(fields.values())], types)


@pytest.mark.parametrize("fields,broken", [
    (COMPLETE, []),
    ({"name": " ", "locale": "\t"}, ["name:empty", "locale:empty"]),
    ({"task": "asr"}, ["task:not_listed"]),
    ({"task": " TTS "}, []),
    ({"visibility": "internal"}, ["visibility:not_listed"]),
    ({"licenseAbbreviation": "Custom"}, ["license:required"]),
    ({"licenseAbbreviation": ""}, ["license:required"]),
    ({"licenseAbbreviation": "", "license": "L"}, []),
    ({"licenseUrl": "https://x"}, ["license:required"]),
    ({"licenseAbbreviation": "MIT", "licenseUrl": "https://x"}, ["license:required"]),
    ({"isPaid": True}, ["basePriceCents:required"]),
    ({"isPaid": True, "basePriceCents": 5}, []),
    ({"basePriceCents": 5}, ["isPaid:required"]),
    ({"isPaid": False, "basePriceCents": 5}, ["isPaid:required"]),
    ({"name": "x", "brandNew": "1"}, ["brandNew:unknown"]),
    ({"isPaid": True, "basePriceCents": 5, "currency": "eur"}, ["currency:unknown"]),
])
def test_submission_rules(spark, fields, broken):
    assert Q.validate_submissions(submission(spark, **fields)).first()["violations"] == broken


def test_valid_rows_are_trimmed_and_bad_ones_set_aside(spark):
    both = submission(spark, name="  My Set ", task="TTS").union(submission(spark, name="x", task="no"))
    clean, bad = Q.split_valid(Q.validate_submissions(both))
    assert rows(clean) == [{"name": "My Set", "task": "TTS"}]
    assert [r.violations for r in bad.collect()] == [["task:not_listed"]]


def test_completeness_in_order(spark):
    df = submission(spark, **COMPLETE)
    assert df.select(Q.missing_fields(df, True)).first()[0] == []
    bare = submission(spark, agreeToSubmit=False)
    assert bare.select(Q.missing_fields(bare, True)).first()[0] == [
        *Q.REQUIRED_FIELDS, "licenseAbbreviation|license", "agreeToSubmit", "fileUploadId"]


def test_payload(spark):
    df = submission(spark, **COMPLETE, license="L", licenseUrl="U", isPaid=True, basePriceCents=9)
    payload = json.loads(df.select(Q.submission_payload(df, Q.UPDATE_FIELDS)).first()[0])
    assert payload["currency"] == "usd" and payload["basePriceCents"] == 9
    assert not {"license", "licenseUrl", "agreeToSubmit", "fileUploadId"} & set(payload)
    custom = submission(spark, licenseAbbreviation="X", license="L", isPaid=False)
    assert json.loads(custom.select(Q.submission_payload(custom, Q.UPDATE_FIELDS)).first()[0]) == {
        "licenseAbbreviation": "X", "license": "L", "isPaid": False}


def masked(value):
    if isinstance(value, dict):
        return {k: "***REDACTED***" if any(s in k.casefold() for s in ("url", "token")) else masked(v) for k, v in value.items()}
    return [masked(v) for v in value] if isinstance(value, list) else value


def test_redaction_equals_a_recursive_walk(spark):
    rng = random.Random(5)
    keys = ["a", "downloadUrl", "b\"url", "Token", "tok", "x\\", "KKoken toKen", "ü"]
    texts = ['"url": "x"', "}]", "\\", "plain", "ürl \n", '\\"token\\":1']

    def build(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.4:
            return rng.choice([None, True, 1, 2.5, *texts])
        if kind < 0.7:
            return {rng.choice(keys): build(depth - 1) for _ in range(rng.randint(0, 4))}
        return [build(depth - 1) for _ in range(rng.randint(0, 3))]

    documents = [build(5) for _ in range(300)]
    forms = [dict(ensure_ascii=False), dict(ensure_ascii=True), dict(ensure_ascii=False, indent=1)]
    data = [(i, json.dumps(d, **forms[i % 3])) for i, d in enumerate(documents)] + [(-1, "{not json")]
    df = spark.createDataFrame(data, "i int, t string")
    found = dict(df.select("i", redact_json(F.col("t"))).collect())
    assert found.pop(-1) is None
    assert [json.loads(found[i]) for i in range(len(documents))] == [masked(d) for d in documents]
    hidden = json.dumps({"x": 1}).replace("x", "\\u0075rl")
    assert json.loads(spark.createDataFrame([(hidden,)], "t string").select(redact_json(F.col("t"))).first()[0]) == {"url": "***REDACTED***"}
    for depth in (80, 400):
        nested = '{"url":' + "[" * depth + '"x"' + "]" * depth + ',"long":"' + 'a\\n"'.replace('"', '\\"') * 30_000 + '"}'
        assert spark.createDataFrame([(nested,)], "t string").select(redact_json(F.col("t"))).first()[0].startswith('{"url":"***REDACTED***","long"')
    deep = '{"url":' + "[" * 600 + "]" * 600 + "}"
    with pytest.raises(Exception, match="too deeply"):
        spark.createDataFrame([(deep,)], "t string").select(redact_json(F.col("t"))).collect()


def test_tolerant_records(spark):
    data = ['{"id":"a","name":null,"new":{"x":1}}', '{"filename":"f"}', '{"id":7}', '{"id":"b","task":"BRAND_NEW"}']
    df = spark.createDataFrame(list(enumerate(data)), "i int, doc string")
    out = tolerant_records(df, "doc", ("id", "name", "task", "filename")).orderBy("i").collect()
    assert out[0]["present"] == ["id", "name", "new"] and {k: v.toPython() for k, v in out[0]["extras"].items()} == {"new": {"x": 1}}
    assert [r["problem"] for r in out] == [None, "id:required", "id:required", None]
    assert out[3]["task"] == "BRAND_NEW" and out[1]["filename"] == "f"


def test_resume_states(spark):
    cases = {  # final, part, checksum file, stored -> state
        "complete": (True, True, True, "c"), "resume": (False, True, True, "c"), "stale": (False, True, True, "old"),
        "untracked": (False, True, False, None), "orphan": (False, False, True, "c"), "fresh": (False, False, False, None),
        "empty": (False, True, True, ""),
    }
    expected = spark.createDataFrame([(n, "c", 1) for n in [*cases, "unseen"]], "name string, checksum string, size int")
    landed = spark.createDataFrame([(n, *c) for n, c in cases.items()] + [("extra", True, False, False, None)],
                                   "name string, final_exists boolean, part_exists boolean, checksum_exists boolean, stored string")
    found = {r["name"]: (r["state"], r["cleanup"]) for r in L.reconcile_landing(expected, landed).collect()}
    assert found == {
        "complete": ("complete", False), "resume": ("resume", False), "stale": ("stale", True),
        "untracked": ("untracked", True), "orphan": ("orphan", True), "fresh": ("fresh", False),
        "empty": ("fresh", False), "unseen": ("fresh", False), "extra": ("unexpected", False),
    }


def test_load_once_ledger(spark, tmp_path):
    current = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", ""), ("d", None)], "path string, checksum string")
    L.record_loaded(current.filter("path <> 'b'").selectExpr("path", "checksum"), str(tmp_path / "l"))
    again = L.changed_since(current, spark.read.parquet(str(tmp_path / "l")))
    assert [r["path"] for r in rows(again)] == ["b", "c", "d"]


def test_split_views_and_output(spark, tmp_path):
    df = spark.createDataFrame([("x", "train"), ("y", "train"), ("z", "test"), ("n", None)], "t string, split string")
    views = split_views(df, ["train", "test"])
    assert {k: rows(v) for k, v in views.items()} == {"test": [{"t": "z"}], "train": [{"t": "x"}, {"t": "y"}]}
    assert split_views(df, None) is df
    write_splits(df, str(tmp_path / "o"), ["train", "test"])
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_streams_take_each_file_once(spark, tree, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    root = tree({"in/a.tsv": "path\tn\nx\t1\n", "json/a[1].json": json.dumps({"f": "x.wav", "r": [{"t": "1"}, {"t": "2"}]})})
    columns = {"p": {"source_column": "path", "dtype": "file_path", "file_extension": "wav"}, "n": {"source_column": "n", "dtype": "int"}}
    spec = LoadSpec.from_dict({"dataset_id": "d", "task": "OTH", "columns": columns, "format": "tsv"})
    corpus = Corpus("/c", "/c", manifest_of(spark.createDataFrame([("/c/x.wav",)], "path string"), "/c"))
    for _ in range(2):
        stream_index(spark, f"{root}/in", spec, corpus, f"{out}/i", f"{out}/i-state").awaitTermination()
    assert rows(loaded_so_far(spark, f"{out}/i")) == [{"p": "/c/x.wav", "n": 1}]
    tree({"in/b.tsv": "path\tn\ny\t2\n"})
    stream_index(spark, f"{root}/in", spec, corpus, f"{out}/i", f"{out}/i-state").awaitTermination()
    assert rows(loaded_so_far(spark, f"{out}/i")) == [{"p": "/c/x.wav", "n": 1}, {"p": "/c/y", "n": 2}]
    columns = {"p": {"source_column": "f", "dtype": "file_path"}, "t": {"source_column": "t"}, "o": {"source_column": "gone"}}
    spec = LoadSpec.from_dict({"dataset_id": "d", "task": "ASR", "columns": columns, "record_path": "r"})
    for _ in range(2):
        stream_sidecars(spark, f"{root}/json", spec, corpus, f"{out}/j", f"{out}/j-state").awaitTermination()
    assert rows(loaded_so_far(spark, f"{out}/j"), "t") == [
        {"p": "/c/x.wav", "t": "1", "o": None}, {"p": "/c/x.wav", "t": "2", "o": None}]


def test_stream_reads_landed_files_once_and_passes_over_a_written_table(spark, tree, tmp_path_factory, monkeypatch):
    from corpusframe.streaming import ingest

    out = str(tmp_path_factory.mktemp("out"))
    root = tree({"in/a b.tsv": "path\tn\nx\t1\n", "in/c+d.tsv": "path\tn\ny\t2\n"})
    columns = {"p": {"source_column": "path", "dtype": "file_path", "file_extension": "wav"}, "n": {"source_column": "n", "dtype": "int"}}
    spec = LoadSpec.from_dict({"dataset_id": "d", "task": "OTH", "columns": columns, "format": "tsv"})
    corpus = Corpus("/c", "/c", manifest_of(spark.createDataFrame([("/c/x.wav",)], "path string"), "/c"))
    plans, inputs = [], []

    def seen(frame, spec, corpus):
        inputs.append(sorted({f.rsplit("/", 2)[0] for f in frame.rows.inputFiles()}))
        plans.append(frame.rows._jdf.queryExecution().executedPlan().toString())
        return map_columns(frame, spec, corpus)

    monkeypatch.setattr(ingest, "map_columns", seen)
    stream_index(spark, f"{root}/in", spec, corpus, f"{out}/i", f"{out}/i-state", files_per_batch=1).awaitTermination()
    assert rows(loaded_so_far(spark, f"{out}/i"), "n") == [{"p": "/c/x.wav", "n": 1}, {"p": "/c/y", "n": 2}]
    assert len(plans) == 2 and all("parquet" in p and "csv" not in p.lower() and "InMemoryTableScan" not in p for p in plans)
    assert inputs[0] and inputs[0] == inputs[1]  # one folder, which the next batch replaces


def test_scalar_expressions(spark):
    one = spark.range(1)
    value = lambda column: one.select(column).first()[0]
    assert value(X.strip(F.lit(" \t a b  \n"))) == "a b"
    assert value(X.squeeze(F.lit(" a \n  b "))) == "a b"
    for path, stem, suffix in [("a/001.merged.json", "001.merged", ".json"), ("noext", "noext", ""), (".hid", ".hid", ""),
                               ("x.", "x.", ""), ("a.b.c", "a.b", ".c")]:
        assert (value(P.stem(F.lit(path))), value(P.suffix(F.lit(path)))) == (stem, suffix)
    assert value(P.with_suffix(F.lit("/a.b/001.merged.json"), ".webm")) == "/a.b/001.merged.webm"
    for raw, clean in [("a//b", "a/b"), ("./a/./b/", "a/b"), (".", "."), ("", "."), ("a/../b", "a/../b"), ("/a/", "/a"),
                       ("./.hid", ".hid"), ("s3://b/x", "s3://b/x")]:
        assert value(P.normalise(F.lit(raw))) == clean
    for size, text in [(0, "0.0 B"), (1536, "1.5 KB"), (1280, "1.2 KB"), (5 << 50, "5.0 PB"), (5 << 60, "5120.0 PB")]:
        assert value(S.human_bytes(F.lit(size).cast("long"))) == text
    assert value(S.human_bytes(F.lit(1500), 1000)) == "1.5 KB"
    assert value(S.remaining_percentage(F.lit(1), F.lit(3))) == 66.67
    assert value(S.remaining_percentage(F.lit(1), F.lit(0))) == 0.0


def test_spec_parsing(tmp_path):
    raw = {"dataset_id": 5, "task": "asr", "columns": {"a": {"source_column": 0}, "junk": "x"}, "new_key": 1}
    spec = LoadSpec.from_dict(raw)
    assert (spec.dataset_id, spec.task, list(spec.columns), dict(spec.extra)) == ("5", "ASR", ["a"], {"new_key": 1})
    (tmp_path / "s.yaml").write_text("dataset_id: d\ntask: tts\nsplits: [a, b]\n")
    assert LoadSpec.from_yaml(tmp_path / "s.yaml").splits == ["a", "b"]
    for bad in ({"task": "ASR"}, {"dataset_id": "d"}, [], {**raw, "columns": {"a": {"source_column": 0, "path_match_strategy": "odd"}}}):
        with pytest.raises(ValueError):
            LoadSpec.from_dict(bad)


def test_unknown_task_and_own_layout(spark):
    from corpusframe import load, register_layout

    with pytest.raises(ValueError, match="supported tasks: ASR, OTH, TTS"):
        load(spark, {"dataset_id": "d", "task": "XYZ", "index_file": "a.csv"}, "/none")
    register_layout("numbers", lambda spark, spec, corpus: spark.range(3))
    assert load(spark, {"dataset_id": "d", "task": "XYZ", "root_strategy": "numbers"}, "/none").count() == 3
