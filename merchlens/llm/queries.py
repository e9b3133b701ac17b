"""Registered queries of the operators in this package, with SQL where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
from merchlens.llm import (
    bpe_stream, chat_format, collocations, decontaminate, license_scan, order_minhash, quality_rules, secrets, site_templates, spelling, toxicity, warc, wavelet)

QUERIES = {
    "op1_chat_format": chat_format.op1_chat_format,
    "op2_warc": warc.op2_warc,
    "op3_order_minhash": order_minhash.op3_order_minhash,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_secrets": secrets.op8_secrets,
    "op9_wavelet": wavelet.op9_wavelet,
    "op10_bpe_stream": bpe_stream.op10_bpe_stream,
    "op11_spelling": spelling.op11_spelling,
    "op12_site_templates": site_templates.op12_site_templates,
    "op13_collocations": collocations.op13_collocations,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_chat_format": chat_format.OP1_SQL,
    "op2_warc": warc.OP2_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op6_quality_rules": quality_rules.OP6_SQL,
    "op8_secrets": secrets.OP8_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
