"""Text helpers: client keys, report kinds, movement cases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockrecon.domain import BAD_STATES, NO_SUBJECT, OPPOSITE_REASON


def client_key(subject: Column) -> Column:
    """Client name from a subject line: first word without reply/forward marks."""
    bare = F.regexp_replace(F.regexp_replace(subject, "Re:", ""), "Fwd:", "")
    word = F.regexp_extract(bare, r"(?U)([^\s\x1c-\x1f]+)", 1)
    return F.when(word == "", NO_SUBJECT).otherwise(F.coalesce(word, F.lit(NO_SUBJECT)))


def repeat_suffix(moment: Column) -> Column:
    """Suffix that tells a repeated package of one client apart."""
    return F.date_format(moment, "_yyMMdd_HHmmss")


def movement_case(reason: str = "reason", disposition: str = "disposition") -> Column:
    """``reason-disposition``; null when either part is null."""
    return F.concat(F.col(reason), F.lit("-"), F.col(disposition))


def rule_keys() -> list[str]:
    """Bad-state cases in text order; the position is the code used in sums."""
    return sorted(f"{r}-{d}" for r in OPPOSITE_REASON for d in BAD_STATES)


def file_kind_matches(file_name: Column, kind: str) -> Column:
    """Whether a report file name announces ``kind`` after a separator."""
    return F.lower(file_name).rlike(rf"[ _-]{kind}.*\.csv")
