import pytest
from conftest import rows

from corpusframe import load
from corpusframe.spec import SpecError


def spec(columns=None, task="ASR", **more):
    base = {"dataset_id": "d", "task": task}
    if columns is not None:
        base["columns"] = columns
    return {**base, **more}


def path_column(**more):
    return {"source_column": "path", "dtype": "file_path", **more}


TEXT = {"source_column": "sentence", "dtype": "string"}


def test_tsv_index_with_media_and_category(spark, tree):
    root = tree({"train.tsv": "path\tsentence\tclient_id\na.mp3\thello\tc1\nb.mp3\tbye\tc2\n"})
    out = load(
        spark,
        spec(
            {
                "audio_path": path_column(),
                "transcription": TEXT,
                "speaker_id": {"source_column": "client_id", "dtype": "category"},
            },
            index_file="train.tsv",
            format="tsv",
            base_audio_path="audio/",
        ),
        root,
    )
    assert out.columns == ["audio_path", "transcription", "speaker_id"]
    assert rows(out) == [
        {"audio_path": f"{root}/audio/a.mp3", "transcription": "hello", "speaker_id": "c1"},
        {"audio_path": f"{root}/audio/b.mp3", "transcription": "bye", "speaker_id": "c2"},
    ]


def test_optional_column_absent_and_required_column_missing(spark, tree):
    root = tree({"m.csv": "path,sentence\na.wav,x\n"})
    columns = {"t": TEXT, "age": {"source_column": "age", "dtype": "int", "optional": True}}
    assert load(spark, spec(columns, index_file="m.csv"), root).columns == ["t"]
    columns["age"]["optional"] = False
    with pytest.raises(KeyError, match="age"):
        load(spark, spec(columns, index_file="m.csv"), root)


def test_nested_index_is_found_and_shallowest_wins(spark, tree):
    root = tree({"x/y/m.csv": "path,sentence\na,deep\n", "x/m.csv": "path,sentence\na,shallow\n"})
    out = load(spark, spec({"t": TEXT}, index_file="m.csv"), root)
    assert rows(out) == [{"t": "shallow"}]
    with pytest.raises(FileNotFoundError):
        load(spark, spec({"t": TEXT}, index_file="none.csv"), root)


def test_casts(spark, tree):
    lines = ["age,score,code", "30,0.95,007", "bad,inf,NA", "7.0,,x", "1e3,0x10,None", "9007199254740993,1,a"]
    root = tree({"m.csv": "\n".join(lines) + "\n"})
    columns = {
        "age": {"source_column": "age", "dtype": "int"},
        "score": {"source_column": "score", "dtype": "float"},
        "code": {"source_column": "code"},
    }
    out = load(spark, spec(columns, index_file="m.csv"), root)
    found = [tuple(r) for r in out.collect()]
    assert found == [
        (30, 0.95, "007"),
        (None, float("inf"), None),
        (7, None, "x"),
        (1000, None, None),
        (9007199254740993, 1.0, "a"),
    ]


def test_fraction_in_int_column_follows_policy(spark, tree):
    root = tree({"m.csv": "age\n1\n1.5\n"})
    s = spec({"age": {"source_column": "age", "dtype": "int"}}, index_file="m.csv")
    with pytest.raises(Exception, match="not_whole"):
        load(spark, s, root).collect()
    # the check is a filter, so it also fires when no column is selected
    with pytest.raises(Exception, match="not_whole"):
        load(spark, s, root).count()
    assert [r.age for r in load(spark, s, root, on_error="null").collect()] == [1, None]
    q = load(spark, s, root, on_error="quarantine")
    assert [(r.age, r._problems) for r in q.collect()] == [(1, []), (None, ["age:not_whole"])]


def test_template_builds_names_under_second_root(spark, tree):
    root = tree(
        {
            "station/lists/log.csv": "Observer,Shelf  Mark,Remark\nnora,B17,wind from west\n",
            "station/tapes/outdoor/B17 by nora.flac": "",
        }
    )
    columns = {
        "audio_path": {"source_column": "Shelf Mark", "dtype": "file_path", "path_template": "${ shelf  mark } by ${Observer}.flac"},
        "remark": {"source_column": "Remark"},
    }
    folders = ["station/tapes/indoor/", "station/tapes/outdoor/"]
    out = load(spark, spec(columns, index_file="station/lists/log.csv", base_audio_path=folders), root)
    assert rows(out) == [{"audio_path": f"{root}/station/tapes/outdoor/B17 by nora.flac", "remark": "wind from west"}]
    columns["audio_path"]["path_template"] = "${Weather}.flac"
    with pytest.raises(KeyError, match="Weather"):
        load(spark, spec(columns, index_file="log.csv"), root)


@pytest.mark.parametrize("strategy", ["direct", "exact", "contains"])
def test_template_in_media_root(spark, tree, strategy):
    root = tree(
        {
            "m.csv": "path,Split\nclip1,train\nclip1,dev\n",
            "data/train/x_clip1.wav" if strategy == "contains" else "data/train/clip1.wav": "",
            "data/dev/clip1_y.wav" if strategy == "contains" else "data/dev/sub/clip1.wav": "",
        }
    )
    column = path_column(path_match_strategy=strategy, file_extension="wav")
    s = spec({"p": column}, index_file="m.csv", base_audio_path="data/${Split}/")
    found = [r["p"].removeprefix(root) for r in rows(load(spark, s, root))]
    assert found == {
        "direct": ["/data/dev/clip1", "/data/train/clip1.wav"],
        "exact": ["/data/dev/sub/clip1.wav", "/data/train/clip1.wav"],
        "contains": ["/data/dev/clip1_y.wav", "/data/train/x_clip1.wav"],
    }[strategy]


def test_second_root_wins_when_only_it_holds_the_file(spark, tree):
    root = tree({"m.csv": "path\nc.wav\n", "secondary/c.wav": ""})
    s = spec({"p": path_column()}, index_file="m.csv", base_audio_path=["primary/", "secondary/"])
    assert rows(load(spark, s, root)) == [{"p": f"{root}/secondary/c.wav"}]


def test_value_that_already_holds_the_media_folder(spark, tree):
    root = tree({"m.csv": "path\ntapes/west/gull.wav\n./tapes//west/gull.wav\n", "tapes/west/gull.wav": ""})
    s = spec({"p": path_column()}, index_file="m.csv", base_audio_path="tapes/west/")
    assert rows(load(spark, s, root)) == [{"p": f"{root}/tapes/west/gull.wav"}] * 2


def test_exact_search(spark, tree):
    found = ["birds/north/a/gull.wav", "birds/owl.wav", "birds/south/Heron.WAV"]
    passed_over = ["birds/._owl.wav", "birds/owl.csv", "frogs/owl.wav"]
    root = tree({"m.csv": "path\nowl\nSouth/Heron\nelsewhere/gull.wav\n", **dict.fromkeys(found + passed_over, "")})
    column = path_column(path_match_strategy="exact", file_extension=".wav")
    s = spec({"p": column}, index_file="m.csv", base_audio_path="birds/")
    assert [r["p"].removeprefix(f"{root}/") for r in rows(load(spark, s, root))] == found


def test_contains_search_and_ambiguity(spark, tree):
    files = {"m.csv": "path\nGULL-7\n", "birds/north/dawn gull-7 far.wav": ""}
    root = tree(files)
    s = spec({"p": path_column(path_match_strategy="contains")}, index_file="m.csv", base_audio_path="birds/")
    assert rows(load(spark, s, root)) == [{"p": f"{root}/birds/north/dawn gull-7 far.wav"}]
    tree({"birds/dusk gull-7 near.wav": ""})
    with pytest.raises(Exception, match="p:ambiguous.*near.wav.*far.wav"):
        load(spark, s, root).collect()
    quarantined = rows(load(spark, s, root, on_error="quarantine"))
    assert quarantined == [{"p": None, "_problems": ["p:ambiguous"]}]


def test_missing_file_policies(spark, tree):
    root = tree({"m.csv": "path\nnope\n\"\"\n", "a/x.wav": ""})
    s = spec({"p": path_column(path_match_strategy="exact")}, index_file="m.csv", base_audio_path="a")
    with pytest.raises(Exception, match="p:missing"):
        load(spark, s, root).collect()
    assert rows(load(spark, s, root, on_error="null"))[0] == {"p": None}


def test_separator_override_sniff_and_header_trim(spark, tree):
    root = tree(
        {
            "d.csv": "path|sentence\na.wav|hello\n",
            "s.csv": "Topic; Sentence ID ; Sentences \nfood;1;rice, hot\nfood;2;soup\n",
        }
    )
    out = load(spark, spec({"t": TEXT}, index_file="d.csv", format="csv", separator="|"), root)
    assert rows(out) == [{"t": "hello"}]
    columns = {"id": {"source_column": "sentence id", "dtype": "int"}, "t": {"source_column": "Sentences"}}
    out = load(spark, spec(columns, index_file="s.csv", format="csv"), root)
    assert rows(out) == [{"id": 1, "t": "rice, hot"}, {"id": 2, "t": "soup"}]


def test_headerless_and_raw_passthrough(spark, tree):
    root = tree({"metadata.csv": "clip1.wav|Hello world\nclip2.wav|Bye\n", "meta.csv": "a,b,c\n1,2,3\n"})
    columns = {"p": {"source_column": 0}, "t": {"source_column": 1}}
    out = load(spark, spec(columns, "TTS", index_file="metadata.csv", format="pipe", has_header=False), root)
    assert [r["t"] for r in rows(out, "p")] == ["Hello world", "Bye"]
    raw = load(spark, spec(None, "TTS", index_file="meta.csv"), root)
    assert raw.columns == ["a", "b", "c"] and rows(raw) == [{"a": "1", "b": "2", "c": "3"}]


def test_byte_order_mark_and_encodings(spark, tree):
    text = "path\tsentence\na.wav\tgrüezi\n"
    root = tree({"m.tsv": text.encode("utf-8-sig"), "l.tsv": text.encode("latin-1")})
    for name, codec in (("m.tsv", "utf-8-sig"), ("l.tsv", "latin-1")):
        out = load(spark, spec({"t": TEXT}, index_file=name, encoding=codec), root)
        assert rows(out) == [{"t": "grüezi"}]


def test_quoted_line_breaks_doubled_quotes_and_ragged_rows(spark, tree):
    root = tree({"m.csv": 'path,sentence\na, "two\nlines ""x"" "\n\nb\nc,d,e\n'})
    s = spec({"p": {"source_column": "path"}, "t": TEXT}, index_file="m.csv")
    with pytest.raises(Exception, match="too many fields"):
        load(spark, s, root).collect()
    found = load(spark, s, root, on_error="quarantine")
    assert [tuple(r) for r in found.collect()] == [
        ("a", 'two\nlines "x" ', []),
        ("b", None, []),
        ("c", "d", ["record:too_long"]),
    ]


def test_duplicate_and_ambiguous_headers(spark, tree):
    root = tree({"m.csv": "Path,path,a,a,Some  Name\n1,2,3,4,5\n"})
    columns = {n: {"source_column": s} for n, s in {"x": "Path", "y": "path", "z": "a.1", "w": "some name"}.items()}
    assert rows(load(spark, spec(columns, index_file="m.csv"), root)) == [{"x": "1", "y": "2", "z": "4", "w": "5"}]
    with pytest.raises(KeyError, match="several"):
        load(spark, spec({"x": {"source_column": "PATH"}}, index_file="m.csv"), root)


@pytest.mark.parametrize("extension", [None, "txt"])
def test_file_content(spark, tree, extension):
    value = "clip" if extension else " transcripts / clip.txt"
    root = tree({"m.csv": f"audio,transcript\na.wav,{value}\nb.wav,\n", "transcripts/clip.txt": "  Hi\r\nyou \n"})
    column = {"source_column": "transcript", "dtype": "file_content", "file_extension": extension}
    s = spec({"t": column}, index_file="m.csv", base_audio_path="transcripts" if extension else "")
    assert [r["t"] for r in rows(load(spark, s, root))] == ["Hi\nyou", None]


def test_unreadable_content(spark, tree):
    root = tree({"m.csv": "t\nnone.txt\n"})
    s = spec({"t": {"source_column": "t", "dtype": "file_content"}}, index_file="m.csv")
    assert rows(load(spark, s, root, on_error="null")) == [{"t": f"{root}/none.txt"}]
    with pytest.raises(Exception, match="t:unreadable"):
        load(spark, s, root).collect()


def test_sharded_index_folder(spark, tree):
    root = tree({"x/train.tsv/part-0.csv": "path\tn\na\t1\n", "x/train.tsv/part-1.csv": "path\tn\nb\t2\n",
                 "x/train.tsv/_SUCCESS": ""})
    s = spec({"p": {"source_column": "path"}, "n": {"source_column": "n", "dtype": "int"}}, index_file="train.tsv")
    assert rows(load(spark, s, root)) == [{"p": "a", "n": 1}, {"p": "b", "n": 2}]


def test_shards_with_another_header_are_refused(spark, tree):
    root = tree({"m.csv/part-0.csv": "a,b\n1,2\n", "m.csv/part-1.csv": "b,a\n20,10\n"})
    columns = {c: {"source_column": c, "dtype": "int"} for c in "ab"}
    with pytest.raises(SpecError, match="part-1.csv.*others have"):
        load(spark, spec(columns, index_file="m.csv"), root)
    root = tree({"_m.csv": "a,b\n1,2\n"})
    with pytest.raises(SpecError, match="renamed"):
        load(spark, spec(columns, index_file="_m.csv"), root)


@pytest.mark.parametrize("text", ['\na,b\n1,"x\ny"\n2,z\n', 'a,b\r1,"x\ry"\r2,z\r', 'a,b\r\n1,"x\r\ny"\r\n2,z\r\n', "\n\na,b\n1,x\n",
    "a,b\n" + "".join(f'{i},\t"p\nq {i}"\n' for i in range(40)), 'a,b\n1,x\n99,"never closed\nlast line\n'])
def test_same_rows_at_every_file_size(spark, tree, text):
    root = tree({"m.csv": text * 1})
    columns = {"a": {"source_column": "a", "dtype": "int"}, "b": {"source_column": "b"}}
    whole = rows(load(spark, spec(columns, index_file="m.csv"), root))
    assert whole and all(r["a"] is not None for r in whole) and len(whole) in (1, 2, 40)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("9b", "100b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert rows(load(spark, spec(columns, index_file="m.csv"), root)) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
