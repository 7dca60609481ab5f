"""The normalised area key ``COUNTY-ST``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

from areastats.config import STATE_CODES


def state_code(state: Column, codes: Mapping[str, str] = STATE_CODES) -> Column:
    """Postal code of a full state name; NULL for a name without one."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])[state]


def area_key(
    county: Column,
    state: Column,
    *,
    upper: bool = True,
    trim: bool = True,
    strict: bool = False,
    sep: str = "-",
) -> Column:
    """Join county and state code to one key.

    By default a NULL part is skipped, so an unknown state gives the bare county. With
    ``strict`` a NULL part makes the key NULL, for the caller to filter.
    """
    name = F.trim(county) if trim else county
    name = F.upper(name) if upper else name
    if strict:
        return F.concat(name, F.lit(sep), state)
    return F.concat_ws(sep, name, state)


def key_state(key: Column, sep: str = "-", codes: Iterable[str] = tuple(STATE_CODES.values())) -> Column:
    """The state code after the last separator (county names may hold the separator themselves).

    NULL if what stands there is no known code, as in keys of areas without a state.
    """
    last = F.substring_index(key, sep, -1)
    return F.when(F.contains(key, F.lit(sep)) & last.isin(*codes), last)
