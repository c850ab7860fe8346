"""Departments and communes."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_DEPARTEMENT = "69"
OVERSEAS = ("97", "98")


def departement_argument(value: str | None = None) -> str:
    """Department code from a job argument: upper case, padded to two characters.

    Overseas departments may be given by three; two select all that begin with them.
    """
    code = (value or DEFAULT_DEPARTEMENT).upper().zfill(2)
    if len(code) != 2 and not (len(code) == 3 and code[:2] in OVERSEAS):
        raise ValueError(f"{value!r} is no department")
    return code


def departement_of(code: Column | str, overseas: bool = False) -> Column:
    """Department of a commune code: two characters, or three for 97x / 98x with `overseas`."""
    code = F.col(code) if isinstance(code, str) else code
    two = F.substring(code, 1, 2)
    if not overseas:
        return two
    return F.when(two.isin(*OVERSEAS), F.substring(code, 1, 3)).otherwise(two)


def in_departements(code: Column | str, departements: Iterable[str]) -> Column:
    """Commune code inside one of the departments.

    A prefix test reaches the Parquet scan (`StringStartsWith`), `substring(...) = x` does not. It
    also takes the three-character overseas departments.
    """
    code = F.col(code) if isinstance(code, str) else code
    tests = [code.startswith(departement_argument(d)) for d in departements]
    if not tests:
        raise ValueError("no department given")
    return reduce(lambda a, b: a | b, tests)
