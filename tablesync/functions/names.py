"""Name rules for columns, tables and list parameters."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A column by its literal name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_column(name: str) -> str:
    """Whitespace, ``.`` and ``:`` become ``__``; parentheses disappear."""
    return re.sub(r"[()]", "", re.sub(r"[\s.:]", "__", name, flags=re.ASCII))


def clean_columns(names: Sequence[str], case_sensitive: bool = False) -> list[str]:
    """Clean every name; two names that end up equal are an error."""
    origin = defaultdict(list)
    cleaned = [clean_column(n) for n in names]
    for before, after in zip(names, cleaned):
        origin[after if case_sensitive else after.lower()].append(before)
    clashes = [group for group in origin.values() if len(group) > 1]
    if clashes:
        raise ValueError(f"columns share one name after cleaning: {clashes}")
    return cleaned


def clean_identifier(text: str, replacement: str = "_") -> str:
    """Replace every character that is not an ASCII word character."""
    return re.sub(r"\W", replacement, text, flags=re.ASCII)


def target_table_name(schema: str, tab: str) -> str:
    return f"{clean_identifier(schema).lower()}__{clean_identifier(tab).lower()}"


def name_list(value: str | Iterable[str] | None) -> tuple[str, ...]:
    """``"['a', b]"``, ``"a,b"`` or ``["a", "b"]`` as a tuple of names."""
    if value is None:
        return ()
    if isinstance(value, str):
        value = re.sub(r"[\[\]']", "", value).split(",")
    return tuple(v.strip() for v in value if v.strip())


def resolve(df: DataFrame, name: str) -> str:
    """The column of ``df`` meant by a source-side or cleaned name, in any case."""
    by_lower = {c.lower(): c for c in df.columns}
    for wanted in (name, clean_column(name)):
        if wanted in df.columns:
            return wanted
        if wanted.lower() in by_lower:
            return by_lower[wanted.lower()]
    raise ValueError(f"no column {name!r} among {df.columns}")
