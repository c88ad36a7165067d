"""Wide-table column naming.

Names are computed as Spark column expressions over the distinct catalog; a
plain-Python twin exists for unit tests and for small driver-side checks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the naming rule ----------------------------------------
# Characters replaced by '_' (then spaces -> '_', runs of '_' collapsed,
# leading/trailing '_' stripped, lower-cased, cut to 40 characters).
SPECIAL_CHARS = "+/\\?=<>()&|!@#$%^*,.:;`\"'[]{}"
MAX_NAME_LEN = 40
FAMILY_SUFFIX = {"numeric": "value", "text": "text", "datetime": "datetime", "drug": "drug_id"}
# ---------------------------------------------------------------------------

_JAVA_CLASS = "[" + "".join("\\" + ch for ch in SPECIAL_CHARS) + "]"
_PY_CLASS = re.compile("[" + re.escape(SPECIAL_CHARS) + "]")


def safe_name_col(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    s = F.regexp_replace(c, _JAVA_CLASS, "_")
    s = F.regexp_replace(s, " ", "_")
    s = F.regexp_replace(s, "_+", "_")
    s = F.btrim(s, F.lit("_"))
    return F.substring(F.lower(s), 1, MAX_NAME_LEN)


def column_name_col(family: Column, concept: Column, answer: Column) -> Column:
    """``{concept}_{answer}`` for coded, ``{concept}_{suffix}`` otherwise."""
    suffix = F.when(family == "coded", safe_name_col(answer))
    for fam, suf in FAMILY_SUFFIX.items():
        suffix = suffix.when(family == fam, F.lit(suf))
    return F.concat_ws("_", safe_name_col(concept), suffix)


def dedupe_names(names: list[str], taken: set[str] | None = None) -> list[str]:
    """Make names unique (case-insensitive) in list order: later ones get ``_2``, ``_3``..."""
    seen = {t.lower() for t in (taken or set())}
    out = []
    for n in names:
        cand, i = n, 1
        while cand.lower() in seen:
            i += 1
            cand = f"{n}_{i}"
        seen.add(cand.lower())
        out.append(cand)
    return out
