"""Country codes: ISO and the shorter codes of vehicle plates that timetables use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO code and timetable code.
TO_PLATE = {
    "AT": "A", "BE": "B", "BA": "BA", "BY": "BY", "CH": "CH", "CZ": "CZ", "DE": "D", "DK": "DK", "EE": "EST", "ES": "E", "FR": "F", "GB": "GB", "GR": "GR", "HR": "HR", "HU": "H", "IT": "I", "LI": "FL",
    "LT": "LT", "LU": "L", "LV": "LV", "MD": "MD", "ME": "MNE", "MK": "MK", "NL": "NL", "NO": "N", "PL": "PL", "RO": "RO", "RS": "SRB", "SE": "S", "SI": "SLO", "SK": "SK", "TR": "TR", "UA": "UA",
}
TO_ISO = {v: k for k, v in TO_PLATE.items() if v != k}


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(pairs.items()) for x in kv])


def plate_code(c: Column) -> Column:
    """Timetable code; blank gives null, an unknown code stays as it is, in capitals."""
    code = F.nullif(F.upper(F.trim(c)), F.lit(""))
    return F.coalesce(_map(TO_PLATE)[code], code)


def iso_code(c: Column) -> Column:
    """ISO code of a code in any form; blank gives null, an unknown code stays, in capitals."""
    code = plate_code(c)
    return F.coalesce(_map(TO_ISO)[code], code)


def home_or(c: Column) -> Column:
    """Timetable code, the home country where there is none."""
    return F.coalesce(plate_code(c), F.lit("CZ"))


def border_code(c: Column) -> Column:
    """The two codes that timetable archives write in ISO form; a trailing semicolon goes."""
    code = F.rtrim(c, F.lit(";"))
    return F.when(code == "AT", "A").when(code == "DE", "D").otherwise(code)
