"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from folioscope.llm import decontaminate, langid, licenses, mixing, neardup, pii, sharding, substrings, topk, urlrules

QUERIES = {
    "op1_topk": topk.op1_topk,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_urlrules": urlrules.op3_urlrules,
    "op4_substrings": substrings.op4_substrings,
    "op5_neardup": neardup.op5_neardup,
    "op6_langid": langid.op6_langid,
    "op7_mixing": mixing.op7_mixing,
    "op8_pii": pii.op8_pii,
    "pii_patterns": pii.pii_patterns,
    "op9_licenses": licenses.op9_licenses,
    "op10_sharding": sharding.op10_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op4_substrings": substrings.ORACLE_SQL,
    "op5_neardup": neardup.ORACLE_SQL,
    "op7_mixing": mixing.ORACLE_SQL,
    "op1_topk": topk.ORACLE_SQL,
    "op3_urlrules": urlrules.ORACLE_SQL,
    "op9_licenses": licenses.oracle_sql(),
    "op10_sharding": sharding.ORACLE_SQL,
    "pii_patterns": pii.PATTERNS_SQL,
}
