"""The operators over their whole tables, with production parameters."""

import zlib

import numpy as np

from . import (
    block_dedup, decontamination, filter_audit, html_text, language, near_dedup, nearest, packing, periodic_runs,
    ppm, private_data, secret_scan, suffix_dedup,
)
from .shared import read


def op1_html_text(spark, sf_dir):
    return html_text.extracted(read(spark, sf_dir, "pages"))


def op2_secret_scan(spark, sf_dir):
    return secret_scan.secrets(read(spark, sf_dir, "documents"))


def op3_private_data(spark, sf_dir):
    return private_data.private(read(spark, sf_dir, "documents"))


def op4_minhash_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), size=2, percent=80)


def op5_block_dedup(spark, sf_dir):
    return block_dedup.repeats_removed(read(spark, sf_dir, "documents")).drop("text")


def op6_decontamination(spark, sf_dir):
    return decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_packing(spark, sf_dir):
    return packing.packed(read(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeats_removed(read(spark, sf_dir, "documents")).drop("kept")


def op9_nearest(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    return nearest.nearest(rows, rows.where("vec_id % 50 = 0"))


def op10_language(spark, sf_dir):
    return language.languages(read(spark, sf_dir, "documents"))


def op11_ppm_score(spark, sf_dir):
    return ppm.scored(read(spark, sf_dir, "documents"), ~ppm.held_out(7, 2))


def _repeated_tail(doc_id, n):
    """The words that one document in ten is judged by: from some word on, a part of them over and over."""
    if doc_id is None:
        return None
    number, kind = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if kind:
        return None
    start = number % n
    period = 1 + (n - start) // (3 + number % 8)
    places = np.arange(n)
    return np.where(places < start, places, start + (places - start) % period)


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.digests(periodic_runs.periodic_runs(read(spark, sf_dir, "documents"), _repeated_tail))


def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    name: function for name, function in globals().items()
    if name == "pipeline" or (name.startswith("op") and name[2].isdigit())
}
