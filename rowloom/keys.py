"""Primary key of a table: partition columns first, clustering columns after."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class KeySpec:
    partition: tuple[str, ...]
    clustering: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.partition, *self.clustering]

    def require_in(self, df: DataFrame) -> None:
        """Raise if a key column is missing from ``df``."""
        have = {c.lower() for c in df.columns}
        missing = [c for c in self.columns if c.lower() not in have]
        if missing:
            raise ValueError(f"key fields not in the input: {', '.join(missing)}")


def _flat(part) -> list[str]:
    if isinstance(part, str):
        return [part.strip()]
    return [name for p in part for name in _flat(p)]


def key_spec(spec: KeySpec | str | Sequence) -> KeySpec:
    """Build a :class:`KeySpec`.

    ``"a"`` and ``("a",)`` give partition key ``a``. In ``("a", "b")`` the first
    element is the partition key and the rest cluster; ``(("a", "b"), "c")``
    has the two-column partition key ``(a, b)``.
    """
    if isinstance(spec, KeySpec):
        return spec
    parts = [spec] if isinstance(spec, str) else list(spec)
    columns = _flat(parts)
    if not parts or not all(columns):
        raise ValueError("a key needs at least one column")
    if len(set(columns)) != len(columns):
        raise ValueError(f"key names a column twice: {columns}")
    first = _flat(parts[0])
    return KeySpec(tuple(first), tuple(columns[len(first):]))
