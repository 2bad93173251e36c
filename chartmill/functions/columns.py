"""Column expressions shared by the jobs.  All are built-in Spark functions; none needs a UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.functions import fixed_values as fixed


def first_text(*cols: Column | str) -> Column:
    """First value that is present, as text; the casts let coded, dated, numeric and text values mix."""
    return F.coalesce(*[_col(c).cast("string") for c in cols])


def truthy(col: Column | str) -> Column:
    """A number used as a condition: present and not zero."""
    return _col(col).isNotNull() & (_col(col) != 0)


def flag_text(col: Column | str) -> Column:
    """'0' becomes 'false', any other value 'true'; a missing flag stays missing."""
    text = _col(col).cast("string")
    return F.when(text == "0", "false").when(text.isNotNull(), "true")


def strip_for_type(value: Column | str, type_col: Column | str, type_value: str, text: str = "-") -> Column:
    """Remove `text` from the values of one type only."""
    return F.when(_col(type_col) == type_value, F.replace(_col(value), F.lit(text), F.lit(""))).otherwise(_col(value))


def raw_or_code(datatype: Column | str, raw: Column | str, code: Column | str, raw_types: Iterable[int] = (1, 2)):
    """Datatypes in `raw_types` keep their value, the others take the dictionary's code."""
    return F.when(_col(datatype).isin(*raw_types), _col(raw)).otherwise(_col(code))


def or_default(col: Column | str, default: str) -> Column:
    """The looked-up value, or the text that stands for a missing one."""
    return F.coalesce(_col(col), F.lit(default))


def whole_number(col: Column | str) -> Column:
    """Text to integer; junk raises, as under ANSI rules."""
    return _col(col).cast("int")


def split_whole_numbers(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose `cols` all read as integers, rows that do not) so that one bad value need not stop a load."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast("int").isNull())
    good = df.where(~bad).withColumns({c: F.col(c).try_cast("int") for c in cols})
    return good, df.where(bad)


def natural_uuid(*cols: Column | str) -> Column:
    """An id in uuid form made from the natural key, so that a retried task or a replayed load repeats it.

    128 bits keep collisions out of reach at 10^12 rows, which 64 would not.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(_ABSENT)) for c in cols]
    digest = F.md5(F.concat_ws(_BETWEEN, *parts))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in _UUID_GROUPS])


_BETWEEN, _ABSENT = "\x1f", "\x1e"  # control characters, so that neither a joined text nor a null can pass for another key
_UUID_GROUPS = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]


def random_uuid() -> Column:
    """A new random id per row.  A retried task draws other ids, so use it only where nothing refers back to it."""
    return F.uuid()


def patient_type(form_id: Column | str, concept_id: Column | str, transfer_in: bool = False) -> Column:
    """New for the first-visit form, transit for any other form, nothing without a form.

    With `transfer_in`, an observation of the transfer-in concept wins over transit.
    """
    form = _col(form_id)
    ladder = F.when(form == fixed.NEW_PATIENT_FORM, fixed.PATIENT_TYPE_NEW)
    if transfer_in:
        ladder = ladder.when(_col(concept_id) == fixed.TRANSFER_IN_CONCEPT, fixed.PATIENT_TYPE_TRANSFER_IN)
    return ladder.when(form.isNotNull(), fixed.PATIENT_TYPE_TRANSIT)


def entry_point(concept_id: Column | str, value_coded: Column | str) -> Column:
    """Target code of the entry point; a code outside the ladder falls through unchanged."""
    coded = _col(value_coded)
    ladder = F
    for source, target in fixed.ENTRY_POINTS.items():
        ladder = ladder.when((_col(concept_id) == fixed.ENTRY_POINT_CONCEPT) & (coded == source), F.lit(target))
    return ladder.otherwise(coded)


def first_care_date(concept_id: Column | str, value_datetime: Column | str) -> Column:
    return F.when(_col(concept_id) == fixed.FIRST_CARE_DATE_CONCEPT, _col(value_datetime))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
