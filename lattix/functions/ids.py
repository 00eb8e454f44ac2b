"""Graph identities: a label's number in the top 16 bits of a 64-bit integer, a serial in the low 48.

Identities are unsigned, Spark's BIGINT is not: order by ``(labid, locid)``, never by the packed number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LABID, MAX_LOCID = 65535, (1 << 48) - 1


def pack(labid: Column | int, locid: Column) -> Column:
    lab = F.lit(labid) if isinstance(labid, int) else labid
    return F.shiftleft(lab.cast("long"), 48).bitwiseOR(locid.cast("long"))


def labid(id_: Column) -> Column:
    return F.shiftrightunsigned(id_, 48).cast("int")


def locid(id_: Column) -> Column:
    return id_.bitwiseAND(F.lit(MAX_LOCID))


def format_id(id_: Column) -> Column:
    """``labid.locid``; null for null."""
    return F.concat(labid(id_).cast("string"), F.lit("."), locid(id_).cast("string"))


def parse_id(text: Column) -> Column:
    """The packed identity of ``labid.locid``: whole text, ASCII digits, within bounds; else null."""
    shaped = text.rlike(r"\A0*[0-9]{1,5}\.0*[0-9]{1,15}\z")
    lab, loc = (F.substring_index(text, ".", n).try_cast("long") for n in (1, -1))
    return F.when(shaped & (lab <= MAX_LABID) & (loc <= MAX_LOCID), pack(lab, loc))


def unsigned(id_: Column) -> Column:
    """The identity as it is counted without a sign, for export."""
    return F.when(id_ >= 0, id_.cast("decimal(20,0)")).otherwise(id_.cast("decimal(20,0)") + F.lit(str(1 << 64)).cast("decimal(20,0)"))


def order(id_: Column, descending: bool = False) -> list[Column]:
    """Sort keys for the order of identities."""
    keys = [labid(id_), locid(id_)]
    return [k.desc_nulls_first() if descending else k.asc_nulls_last() for k in keys]
