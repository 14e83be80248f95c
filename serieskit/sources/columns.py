"""Binding of file headers to logical columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def plain(header: object) -> str:
    """Header reduced to lower-case ASCII letters and digits."""
    return "".join(re.findall(r"[a-z0-9]", str(header).casefold()))


def find_column(headers: Iterable[str], aliases: Sequence[str], required: bool = True) -> str | None:
    """First alias that some header matches; of two equal headers the later one wins."""
    headers = list(headers)
    by_plain = {plain(h): h for h in headers}
    for alias in aliases:
        if plain(alias) in by_plain:
            return by_plain[plain(alias)]
    if required:
        raise ValueError(f"no column for {list(aliases)} among {headers}")
    return None


def bind(headers: Iterable[str], aliases: Mapping[str, Sequence[str]], optional: Sequence[str] = ()) -> dict[str, str]:
    """Logical name -> header, leaving out optional columns that are absent."""
    headers = list(headers)
    found = {name: find_column(headers, names, name not in optional) for name, names in aliases.items()}
    return {name: header for name, header in found.items() if header is not None}


def resolve(df: DataFrame, aliases: Mapping[str, Sequence[str]], optional: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Select the logical columns (and ``keep``), so the scan reads nothing else."""
    bound = bind([c for c in df.columns if c not in keep], aliases, optional)
    return df.select(*[F.col(f"`{header}`").alias(name) for name, header in bound.items()], *keep)


def dtype_of(df: DataFrame, name: str) -> str:
    return dict(df.dtypes)[name]
