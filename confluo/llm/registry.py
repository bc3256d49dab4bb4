"""The queries of this folder, by name, and their SQL where it can express them."""

from . import decontaminate, filter_audit, katz, langid, linededup, oph, quality, search, sentencepiece, sharding, simhash, url_filter, warc

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_warc": warc.query,
    "op3_linededup": linededup.query,
    "op4_simhash": simhash.query,
    "op5_sentencepiece": sentencepiece.query,
    "op6_langid": langid.query,
    "op7_sharding": sharding.query,
    "op8_quality": quality.query,
    "op9_url_filter": url_filter.query,
    "op10_katz": katz.query,
    "op11_filter_audit": filter_audit.query,
    "op12_search": search.query,
    "op13_oph": oph.query,
}

ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op2_warc": warc.ORACLE,
    "op9_url_filter": url_filter.oracle(),
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_search": search.ORACLE,
    "op13_oph": oph.ORACLE,
}
