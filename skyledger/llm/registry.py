"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

import functools

from skyledger.llm import (
    chat,
    embeddings,
    fingerprints,
    licenses,
    linededup,
    minhash,
    mixing,
    packing,
    quality,
    repair,
    secrets,
    vectorcodes,
    warc,
)
from skyledger.llm.common import ship_package


def shipped(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    name: shipped(query)
    for name, query in {
        "op1_mix_sources": mixing.query,
        "op2_fingerprint_documents": fingerprints.query,
        "op3_write_warc": warc.query,
        "op4_scan_secrets": secrets.query,
        "op5_pack_windows": packing.query,
        "op6_embedding_duplicates": embeddings.query,
        "op7_format_chat": chat.query,
        "op8_score_quality": quality.query,
        "op9_scan_licenses": licenses.query,
        "op10_near_duplicates": minhash.query,
        "op11_repair_conversations": repair.query,
        "op12_drop_repeated_lines": linededup.query,
        "op13_compress_vectors": vectorcodes.query,
    }.items()
}

# The others cannot be put in SQL; tests hold them against brute force or a round trip.
SQL = {
    "op1_mix_sources": mixing.SQL,
    "op2_fingerprint_documents": fingerprints.SQL,
    "op3_write_warc": warc.SQL,
    "op11_repair_conversations": repair.SQL,
    "op12_drop_repeated_lines": linededup.SQL,
    "op13_compress_vectors": vectorcodes.SQL,
}
