"""Columns of a stored table: names in the files, names in the table, and which changes files can take.

A column keeps the name it was first stored under, so a rename changes the record alone; a name that was ever
stored is never given to another column.
"""

from __future__ import annotations

from dataclasses import dataclass

from ..config import TableSpec

#: Changes of type under which files written before can still be read.
WIDER = {("int", "bigint"), ("int", "double"), ("float", "double")}


class SchemaChange(ValueError):
    """The configuration asks for columns that the stored table cannot take."""


@dataclass(frozen=True)
class Columns:
    """(name in the files, name, type) of every column, and all names that files have had."""

    held: tuple[tuple[str, str, str], ...]
    used: tuple[str, ...]

    @property
    def stored_schema(self) -> str:
        return ", ".join(f"`{stored}` {kind}" for stored, _, kind in self.held)

    @property
    def schema(self) -> str:
        return ", ".join(f"`{name}` {kind}" for _, name, kind in self.held)

    def stored(self, name: str) -> str:
        return next(s for s, n, _ in self.held if n == name)

    def to_record(self) -> dict:
        return {"columns": [list(c) for c in self.held], "usedNames": list(self.used)}


def from_record(record: dict) -> Columns:
    return Columns(tuple(tuple(c) for c in record["columns"]), tuple(record["usedNames"]))


def columns_of(spec: TableSpec, record: dict | None) -> Columns:
    """The columns after a batch of ``spec``; SchemaChange if files of ``record`` could not be read with them.

    New columns are NULL in older rows, a column that the configuration no longer names is dropped, ``renames``
    ({old: new}) carry a column over, and types may widen, but not those of keys, which decide on the bucket.
    """
    if record is None:
        return Columns(tuple((name, name, kind) for name, kind in spec.wide), tuple(name for name, _ in spec.wide))
    before, keys = from_record(record), {c for c, _ in spec.keys}
    there = {name: (stored, kind) for stored, name, kind in before.held}
    old_name = {new: old for old, new in spec.renames if new not in there and old in there}
    held, used, errors = [], list(before.used), []
    for name, kind in spec.wide:
        stored, had = there.get(old_name.get(name, name), (None, None))
        if stored is None and name in keys:
            errors.append(f"key '{name}' is not stored")
        elif stored is None:
            stored = name
            while stored in used:
                stored = f"{stored}_"
            used.append(stored)
        elif had != kind and (name in keys or (had, kind) not in WIDER):
            errors.append(f"'{name}' is stored as {had} and configured as {kind}")
        held.append((stored, name, kind))
    taken = [stored for stored, _, _ in held]
    errors += [f"'{new}' and the column it is renamed from are both configured" for new, old in old_name.items() if taken.count(there[old][0]) > 1]
    if errors:
        raise SchemaChange(f"{spec.name}: " + "; ".join(errors))
    return Columns(tuple(held), tuple(used))
