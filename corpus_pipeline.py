"""Documents to packed training sequences: five stages, each over all that its predecessor kept."""

from pyspark.sql import functions as F

from motorpool.llm import decontamination, language, near_dedup, packing, secret_scan
from motorpool.llm.shared import read, written


def language_id(spark, docs, sf_dir):
    """Documents in a learned language: those without a letter, or far from all of them, go."""
    found = language.identified(docs, language.fit(docs))
    good = found.where((F.col("lang_pred") != language.UNKNOWN) & F.col("near"))
    return good.select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies (five-word shingles, similarity 0.8): the least
    doc_id. Rows without doc_id stay."""
    gone = near_dedup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that aren't contaminated by the benchmark."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def secret_redaction(spark, docs, sf_dir):
    """All documents, each secret in their texts replaced by a mark; n_chars follows the text."""
    clean = secret_scan.redacted(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def best_fit_packing(spark, docs, sf_dir):
    """Where each piece of each document goes: see packing.packed."""
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_redaction", secret_redaction),
    ("best_fit_packing", best_fit_packing),
]

#: No stage but decontamination can be written in SQL: kernels, signatures, tests and packing are not.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
