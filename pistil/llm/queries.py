"""Queries and SQL twins of this subpackage, for the repository's entry file."""

from __future__ import annotations

import corpus_pipeline

from . import (bisector, decontam, graph_neardup, langid, licenses, ngram_join, packing, quality, repeats, runs, url_filter,
               warc, xent)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_warc": warc.op2_warc,
    "op3_packing": packing.op3_packing,
    "op4_graph_neardup": graph_neardup.op4_graph_neardup,
    "op5_decontam": decontam.op5_decontam,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_ppm_langid": langid.op7_ppm_langid,
    "op8_repeats": repeats.op8_repeats,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_xent_score": xent.op10_xent_score,
    "op11_periodic_runs": runs.op11_periodic_runs,
    "op12_bisector_clusters": bisector.op12_bisector_clusters,
    "op13_quality_rules": quality.op13_quality_rules,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_license_scan": licenses.ORACLE,
    "op2_warc": warc.ORACLE,
    "op5_decontam": decontam.ORACLE,
    "op6_url_filter": url_filter.ORACLE,
    "op12_bisector_clusters": bisector.ORACLE,
    "op13_quality_rules": quality.ORACLE,
}
