import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(zip(ids, texts))], DOCS)
