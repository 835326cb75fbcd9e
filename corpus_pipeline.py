"""From raw documents to a training mix: quality, line dedup, near-duplicates, decontamination, source weights."""

from pyspark.sql import functions as F

from corpusframe.llm import decontaminate, lines, mixing, quality, simhash
from corpusframe.llm.registry import register, table
from corpusframe.sources.scratch import written


def good_quality(spark, docs, sf_dir):
    """Documents that the classifier scores one half or more; it learns from the labels of these documents."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def repeated_lines(spark, docs, sf_dir):
    """All documents, without later copies of runs of lines; ``n_chars`` follows the text."""
    return lines.without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates, the one with the least id."""
    return simhash.keep_one(docs)


def benchmark_passages(spark, docs, sf_dir):
    """Documents of which less than one word in twenty is in a benchmark passage."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_weights(spark, docs, sf_dir):
    """Documents that the mix takes, with the number of copies."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("mixing", source_weights),
]

ORACLE_SQL = None


@register("pipeline")
def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
